"""Fixed values of the intensive-care study: names, limits, default values and texts.

These are data, not code: every operator takes them as arguments.
"""

from anchorframe.operators.rules import TextRule

# ---- fixed values ----------------------------------------------------------

VITAL_LIMITS = {
    "Heart Rate": (20, 300),
    "Systolic Blood Pressure": (50, 250),
    "Diastolic Blood Pressure": (30, 150),
    "Mean Arterial Pressure": (30, 200),
    "Temperature": (30, 45),
    "Respiratory Rate": (5, 60),
    "Oxygen Saturation": (50, 100),
}

FLUID_CATEGORY = "Fluids/Intake"

DIURETICS = [
    "Bumetanide (Bumex)",
    "Furosemide (Lasix)",
    "Furosemide (Lasix) 250/50",
    "Torasemide",
    "Metolazon",
    "Chloortalidon",
]

DIURETIC_NAMES = {
    "mannitol 20 %": "Mannitol 20%",
    "mannitol 20%": "Mannitol 20%",
    "furosemide": "Furosemide",
    "metolazone": "Metolazone",
}

ACE_DRUGS = ["Captopril", "Enalapril Maleate", "Enalaprilat", "Lisinopril", "Quinapril"]

ARB_DRUGS = ["Losartan Potassium", "Valsartan"]

ANTIBIOTICS = [
    "Vancomycin",
    "Teicoplanin",
    "Co-trimoxazole",
    "Sulfadiazine",
    "Sulfacetamide",
    "Gentamicin",
    "Tobramycin",
    "Amikacin",
    "Streptomycin",
    "Piperacillin",
    "Meropenem",
    "Cefepime",
    "Flucloxacillin",
    "Methicillin",
    "Bactrim (SMX/TMP)",
]

OTHER_MEDICATION = ["Cyclosporine", "Ketorolac (Toradol)"]

INOTROPICS = [
    "Dopamine",
    "Norepinephrine",
    "Epinephrine",
    "Milrinone",
    "Metoprolol",
    "Esmolol",
    "Verapamil",
    "Diltiazem",
]

PRESENCE_PROCEDURES = ["Intubation"]

TIMED_PROCEDURES = ["Non-invasive ventilation", "Invasive ventilation"]

# Medians given to a new patient whose vitals are missing.
NEW_PATIENT_VALUES = {
    "age_12h_before_AKI": 68,
    "Diastolic Blood Pressure": 61,
    "Heart Rate": 88.18,
    "Mean Arterial Pressure": 73.10,
    "Oxygen Saturation": 96.77,
    "Respiratory Rate": 20.17,
    "Systolic Blood Pressure": 110,
}

MEDIAN_COLUMNS = [
    "age_12h_before_AKI",
    "Diastolic Blood Pressure",
    "Heart Rate",
    "Mean Arterial Pressure",
    "Oxygen Saturation",
    "Respiratory Rate",
    "Systolic Blood Pressure",
]

DROPPED_COLUMNS = ["Temperature"]

OUTCOME_COLUMN = "died_within_90d_after_AKI"

STAY_COLUMN = "ICU_stay_12hforakitime"

MODEL_FEATURES = [
    "age_12h_before_AKI",
    "Diastolic Blood Pressure",
    "Heart Rate",
    "Mean Arterial Pressure",
    "Oxygen Saturation",
    "Furosemide",
    "Vancomycin",
    "Cefepime",
    "Metoprolol",
    "Invasive ventilation",
    "Diabetes Mellitus",
    "Heart Failure",
    "Hypertension",
]

BINARY_FEATURES = ["Furosemide", "Invasive ventilation", "Diabetes Mellitus", "Heart Failure", "Hypertension"]

COMPARED_FEATURES = ["Oxygen Saturation", "Furosemide", "Vancomycin", "Norepinephrine", "Heart Failure"]

STAGE_NEGATIVES = ["no aki", "aki determination not possible", "nan", "none"]

FLAG_POSITIVES = ["true", "1", "yes", "aki"]

STAGE_RELABEL = {"AKI stage 1 (48h rise ≥0.3 mg/dL)": "AKI stage 1"}

STAGE_ORDER = ["AKI determination not possible", "No AKI", "AKI stage 1", "AKI stage 2", "AKI stage 3"]

STATUS = ("AKI", "No AKI")

DASHBOARD_COLUMNS = [
    "cluster",
    "cluster_prob",
    "Autoimmune / Vasculitis",
    "Chronic Kidney Disease",
    "Diabetes Mellitus",
    "Heart Failure",
    "Hypertension",
    "Malignancy",
    "Obstructive Uropathy",
    "Sepsis",
    "silhouette",
    "density_strength",
    "Invasive ventilation",
    "Cefepime",
    "age_12h_before_AKI",
    "Metoprolol",
    "Furosemide (Lasix)",
    "Furosemide (Lasix) 250/50",
    "Vancomycin",
]

CLUSTER_TEXT = {
    3: "Cluster 3 shows the lowest mortality (13.9%), and a short ICU stay (~2d). Patients display more stable physiology and fewer high-risk features, making this the most favorable phenotype.",
    4: "Cluster 4 shows the highest mortality (18.1%) and the moderate ICU stay (~5.7d). This phenotype concentrates more high-risk features and represents the least favorable survival profile.",
    5: "Cluster 5 shows moderate mortality (14.9%) but the longest ICU stay (~6.7d). This phenotype suggests a prolonged recovery trajectory despite not having the highest morality.",
}

FEATURE_TEXT = [
    TextRule("Heart Failure", "History of heart failure, strongly associated with higher mortality risk.", 1),
    TextRule("Diabetes Mellitus", "History of diabetes, associated with elevated mortality risk.", 1),
    TextRule("Hypertension", "History of hypertension, associated with longer ICU stay.", 1),
    TextRule("Invasive ventilation", "Invasive ventilation shows strong association with increased mortality odds.", 0, above=True),
    TextRule("Cefepime", "Cefepime use is strongly associated with higher mortality risk.", 0, above=True),
    TextRule("age_12h_before_AKI", "Age shows modest positive association with mortality odds in the model.", 0, above=True),
    TextRule("Metoprolol", "Metoprolol shows a modest association with increased mortality odds.", 0, above=True),
    TextRule("Furosemide (Lasix)", "Furosemide is associated with a shorter ICU stay.", 0, above=True),
    TextRule("Furosemide (Lasix) 250/50", "Furosemide is associated with a shorter ICU stay.", 0, above=True),
    TextRule("Vancomycin", "Vancomycin is linked to a reduced ICU stay duration.", 0, above=True),
]
