"""The catalogue's queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

DAY = 86_400_000_000
HOUR = 3_600_000_000
H12 = 12 * HOUR
H72 = 72 * HOUR

ANCHORS = """anchors AS (SELECT user_id AS entity, min(ts) AS anchor_ts FROM events
  WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-10' GROUP BY 1)"""
CUSTOMER_ANCHORS = """canchors AS (SELECT c_custkey AS entity,
  CAST(DATE '1995-06-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS anchor_ts FROM customer)"""
COHORT = "cohort AS (SELECT DISTINCT user_id AS entity FROM events WHERE value > 150)"
SEGMENT = "segment AS (SELECT c_custkey AS entity FROM customer WHERE c_mktsegment = 'BUILDING')"
POINTS = "points AS (SELECT user_id AS entity, ts, event_type AS label, value FROM events)"
ORDERS = "opoints AS (SELECT o_custkey AS entity, o_orderdate AS ts, o_orderpriority AS label, o_totalprice AS value FROM orders)"
INTERVALS = """intervals AS (SELECT user_id AS entity, epoch_us(ts) AS s,
  epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 6000000 AS e, event_type AS label, value AS amount FROM events)"""
MIXED = """mixed AS (SELECT * REPLACE (CASE WHEN entity % 3 = 0 THEN upper(label) WHEN entity % 3 = 1 THEN ' ' || label || ' '
  ELSE label END AS label) FROM intervals)"""
ANCHOR_US = "anc AS (SELECT entity, epoch_us(anchor_ts) AS a FROM anchors)"
I_JOIN = "ij AS (SELECT i.*, a FROM intervals i JOIN anc USING (entity))"
M_JOIN = "mj AS (SELECT i.*, a FROM mixed i JOIN anc USING (entity))"
P_JOIN = "pj AS (SELECT entity, epoch_us(ts) AS t, label, value, a FROM points JOIN anc USING (entity))"
LIMITS = """((label = 'click' AND value BETWEEN 1 AND 200) OR (label = 'purchase' AND value BETWEEN 5 AND 150)
  OR (label = 'signup' AND value BETWEEN 0 AND 100) OR (label = 'view' AND value BETWEEN 0.5 AND 300))"""
LABELS = ["click", "error", "purchase", "signup", "view"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def baseline(points: str, anchors: str) -> list[str]:
    """Baseline rules as a chain of common tables ending in ``base``."""
    return [
        f"""near AS (SELECT p.entity, p.ts, p.value, epoch_us(p.ts) - epoch_us(k.anchor_ts) AS off
  FROM {points} p JOIN {anchors} k USING (entity))""",
        f"""tally AS (SELECT entity,
  count(*) FILTER (off BETWEEN -{7 * DAY} AND 0) AS n7,
  count(value) FILTER (off > -{30 * DAY} AND off <= 0) AS n30,
  count(value) FILTER (off > -{90 * DAY} AND off <= 0) AS n90,
  count(value) FILTER (off > -{365 * DAY} AND off <= 0) AS n365,
  count(*) FILTER (off BETWEEN 0 AND {30 * DAY}) AS p30,
  count(*) FILTER (off > 0 AND off <= {365 * DAY}) AS p365,
  min(value) FILTER (off BETWEEN -{7 * DAY} AND 0) AS v7,
  min(value) FILTER (off BETWEEN 0 AND {30 * DAY}) AS v30,
  median(value) FILTER (off > -{30 * DAY} AND off <= 0) AS m30,
  median(value) FILTER (off > -{90 * DAY} AND off <= 0) AS m90,
  median(value) FILTER (off > -{365 * DAY} AND off <= 0) AS m365
  FROM near GROUP BY entity)""",
        """ruled AS (SELECT *, CASE WHEN n7 >= 2 THEN 'pre_7d_min' WHEN n30 > 0 THEN 'pre_1m_median'
  WHEN n90 > 0 THEN 'pre_3m_median' WHEN n365 > 0 THEN 'pre_1y_median' WHEN p30 > 0 THEN 'post_1m_min'
  WHEN p365 > 0 THEN 'post_1y_oldest' ELSE 'none' END AS rule FROM tally)""",
        f"""ranked AS (SELECT n.entity, n.ts, n.value, r.rule, row_number() OVER (PARTITION BY n.entity ORDER BY
    CASE r.rule WHEN 'pre_7d_min' THEN n.value WHEN 'post_1m_min' THEN n.value
      WHEN 'pre_1m_median' THEN abs(n.value - m30) WHEN 'pre_3m_median' THEN abs(n.value - m90)
      WHEN 'pre_1y_median' THEN abs(n.value - m365) ELSE 0 END, n.ts, n.value) AS rn
  FROM near n JOIN ruled r USING (entity)
  WHERE CASE r.rule WHEN 'pre_7d_min' THEN off BETWEEN -{7 * DAY} AND 0
      WHEN 'pre_1m_median' THEN off > -{30 * DAY} AND off <= 0
      WHEN 'pre_3m_median' THEN off > -{90 * DAY} AND off <= 0
      WHEN 'pre_1y_median' THEN off > -{365 * DAY} AND off <= 0
      WHEN 'post_1m_min' THEN off BETWEEN 0 AND {30 * DAY}
      WHEN 'post_1y_oldest' THEN off > 0 AND off <= {365 * DAY} ELSE false END)""",
        f"""base AS (SELECT k.entity, k.anchor_ts,
    CASE r.rule WHEN 'pre_7d_min' THEN v7 WHEN 'pre_1m_median' THEN m30 WHEN 'pre_3m_median' THEN m90
      WHEN 'pre_1y_median' THEN m365 WHEN 'post_1m_min' THEN v30 WHEN 'post_1y_oldest' THEN f.value END AS baseline_value,
    f.ts AS baseline_ts, coalesce(r.rule, 'none') AS baseline_rule
  FROM {anchors} k LEFT JOIN ruled r USING (entity) LEFT JOIN (SELECT * FROM ranked WHERE rn = 1) f USING (entity))""",
    ]


def onsets(rise: float, name: str) -> list[str]:
    return [
        f"""{name}_post AS (SELECT b.entity, p.ts, p.value, b.anchor_ts, b.baseline_value,
  p.value - min(p.value) OVER (PARTITION BY p.entity ORDER BY p.ts
    RANGE BETWEEN INTERVAL '47 hours 59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW) >= {rise} AS rose,
  coalesce(p.value >= 1.5 * b.baseline_value, false) AND epoch_us(p.ts) <= epoch_us(b.anchor_ts) + {7 * DAY} AS reached
  FROM points p JOIN base b USING (entity) WHERE p.ts >= b.anchor_ts)""",
        f"""{name}_hits AS (SELECT entity, bool_or(rose) AS rise_flag, min(ts) FILTER (rose) AS rise_ts,
  bool_or(reached) AS ratio_flag, min(ts) FILTER (reached) AS ratio_ts FROM {name}_post GROUP BY 1)""",
        f"""{name} AS (SELECT b.entity, b.anchor_ts, b.baseline_value,
  coalesce(rise_flag, false) AS rise_flag, rise_ts, coalesce(ratio_flag, false) AS ratio_flag, ratio_ts,
  coalesce(rise_flag, false) OR coalesce(ratio_flag, false) AS onset_flag, least(rise_ts, ratio_ts) AS onset_ts,
  (epoch_us(least(rise_ts, ratio_ts)) - epoch_us(b.anchor_ts)) / {DAY}.0 AS days_to_onset
  FROM base b LEFT JOIN {name}_hits USING (entity))""",
    ]


E_BASE = [POINTS, ANCHORS, *baseline("points", "anchors")]
E_ONSETS = [*E_BASE, *onsets(50, "o50")]
TWO_ONSETS = [*E_ONSETS, *onsets(120, "o120")]
COMPARED = """cmp AS (SELECT entity, o.onset_flag AS fo, n.onset_flag AS fn, o.onset_ts AS t_o, n.onset_ts AS t_n,
  abs(epoch_us(n.onset_ts) - epoch_us(o.onset_ts)) AS gap_us FROM o50 o JOIN o120 n USING (entity))"""
E_INT = [ANCHORS, ANCHOR_US, INTERVALS, I_JOIN]
E_MIX = [ANCHORS, ANCHOR_US, INTERVALS, MIXED, M_JOIN]
E_PTS = [POINTS, ANCHORS, ANCHOR_US, P_JOIN]


def pivot(agg: str, names: list[str], key: str = "label", prefix: str = "", wrap: str = "{}") -> str:
    return ", ".join(
        wrap.format(f"{agg} FILTER ({key} = '{n}')") + f' AS "{prefix}{n}"' for n in names
    )


def clip_islands(source: str, keys: str, where: str, win: int) -> list[str]:
    """Gap-and-island merge of the intervals clipped to the window before the anchor."""
    return [
        f"clip AS (SELECT {keys}, greatest(s, a - {win}) AS cs, least(e, a) AS ce FROM {source} WHERE {where} AND least(e, a) > greatest(s, a - {win}))",
        f"flagged AS (SELECT *, CASE WHEN cs <= max(ce) OVER (PARTITION BY {keys} ORDER BY cs, ce ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM clip)",
        f"numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY cs, ce ROWS UNBOUNDED PRECEDING) AS island FROM flagged)",
        f"islands AS (SELECT {keys}, island, max(ce) - min(cs) AS len FROM numbered GROUP BY {keys}, island)",
    ]


MATRIX = [
    *E_PTS, INTERVALS, I_JOIN,
    f"""means AS (SELECT entity, {pivot("avg(value)", ["click", "purchase", "signup", "view"], prefix="mean_")} FROM pj
  WHERE t BETWEEN a - {H72} AND a AND {LIMITS} GROUP BY 1)""",
    f"""doses AS (SELECT entity, {pivot("sum(amount)", ["click", "view"], prefix="dose_")} FROM ij
  WHERE s BETWEEN a - {H12} AND a AND label IN ('click', 'view') GROUP BY 1)""",
    f"""given AS (SELECT entity, {pivot("sum(amount)", ["purchase", "signup"], prefix="given_", wrap="coalesce({}, 0)")} FROM ij
  WHERE e BETWEEN a - {H12} AND a AND label IN ('purchase', 'signup') GROUP BY 1)""",
    f"""flags AS (SELECT entity, {pivot("max(CAST(1 AS DOUBLE))", ["signup", "view"], prefix="flag_")} FROM ij
  WHERE e >= a - {H12} AND s <= a AND label IN ('signup', 'view') GROUP BY 1)""",
    *clip_islands("ij", "entity", "label = 'click'", H72),
    'mins AS (SELECT entity, sum(len) / 60000000.0 AS min_click FROM islands GROUP BY 1)',
    """joined AS (SELECT entity, mean_click, mean_purchase, mean_signup, mean_view, dose_click, dose_view, given_purchase, given_signup,
  coalesce(flag_signup, CAST(0 AS DOUBLE)) AS flag_signup, coalesce(flag_view, CAST(0 AS DOUBLE)) AS flag_view, min_click
  FROM means LEFT JOIN doses USING (entity) LEFT JOIN given USING (entity) LEFT JOIN flags USING (entity) LEFT JOIN mins USING (entity))""",
    """matrix AS (SELECT * FROM joined WHERE NOT (coalesce(mean_click, 0) = 0 AND coalesce(mean_purchase, 0) = 0 AND coalesce(mean_view, 0) = 0
  AND coalesce(dose_click, 0) = 0 AND coalesce(dose_view, 0) = 0 AND coalesce(given_purchase, 0) = 0 AND coalesce(given_signup, 0) = 0
  AND flag_signup = 0 AND flag_view = 0 AND coalesce(min_click, 0) = 0))""",
]
MATRIX_COLUMNS = ["mean_click", "mean_purchase", "mean_signup", "mean_view", "dose_click", "dose_view", "given_purchase",
                  "given_signup", "flag_signup", "flag_view", "min_click"]
MED = "meds AS (SELECT median(mean_click) AS mc, median(mean_purchase) AS mp, median(mean_view) AS mv FROM matrix)"

EVENT_LOG = [
    ANCHORS,
    """src AS (SELECT user_id AS entity, event_type AS item, value AS amount, 'unit' AS unit, ts FROM events WHERE event_type IN ('purchase', 'view')
  UNION ALL SELECT user_id, event_type, NULL, NULL, ts FROM events WHERE event_type IN ('view', 'signup', 'click'))""",
    f"""logged AS (SELECT s.*, anchor_ts FROM src s JOIN anchors USING (entity)
  WHERE epoch_us(ts) BETWEEN epoch_us(anchor_ts) - {H72} AND epoch_us(anchor_ts))""",
]
LONG_STAYS = [*E_INT, COHORT,
    f"stays AS (SELECT entity, s, s + (e - s) * 20 AS e2, a FROM ij WHERE s BETWEEN a - {H12} AND a AND s + (e - s) * 20 >= a - {H12})"]

SQL: dict[str, str] = {
    "cohort_semi": with_(ORDERS, SEGMENT) + """SELECT entity, epoch_us(ts) AS ts_us, round(value, 6) AS value FROM opoints o
  WHERE EXISTS (SELECT 1 FROM segment s WHERE s.entity = o.entity)""",
    "first_anchor": with_(ANCHORS) + "SELECT entity, epoch_us(anchor_ts) AS anchor_us FROM anchors",
    "peak_summary": with_(POINTS, ANCHORS, f"""w AS (SELECT p.*, anchor_ts FROM points p JOIN anchors USING (entity)
  WHERE epoch_us(ts) BETWEEN epoch_us(anchor_ts) AND epoch_us(anchor_ts) + {7 * DAY})""",
        """pk AS (SELECT entity, min(anchor_ts) AS anchor_ts, count(*) AS n_points, max(value) AS peak_value FROM w GROUP BY 1)""",
        "pt AS (SELECT w.entity, min(w.ts) AS peak_ts FROM w JOIN pk USING (entity) WHERE w.value = pk.peak_value GROUP BY 1)")
    + f"""SELECT pk.entity, epoch_us(pk.anchor_ts) AS anchor_us, n_points, round(peak_value, 6) AS peak_value,
  epoch_us(peak_ts) AS peak_us, round((SELECT min(w.value) FROM w WHERE w.entity = pk.entity
    AND epoch_us(w.ts) BETWEEN epoch_us(peak_ts) - {48 * HOUR} AND epoch_us(peak_ts)), 6) AS min_before_peak
  FROM pk JOIN pt USING (entity)""",
    "baseline_cascade": with_(ORDERS, CUSTOMER_ANCHORS, *baseline("opoints", "canchors"))
    + "SELECT entity, round(baseline_value, 6) AS baseline_value, coalesce(epoch_us(baseline_ts), -1) AS baseline_us, baseline_rule FROM base",
    "rolling_min": with_(POINTS) + """SELECT entity, epoch_us(ts) AS ts_us, round(value, 6) AS value, round(min(value) OVER (
    PARTITION BY entity ORDER BY ts RANGE BETWEEN INTERVAL '47 hours 59 minutes 59.999999 seconds' PRECEDING AND CURRENT ROW), 6) AS rolling_min
  FROM points""",
    "detect_onset": with_(*E_ONSETS) + """SELECT entity, epoch_us(anchor_ts) AS anchor_us, round(baseline_value, 6) AS baseline_value,
  CAST(rise_flag AS INTEGER) AS rise_flag, coalesce(epoch_us(rise_ts), -1) AS rise_us, CAST(ratio_flag AS INTEGER) AS ratio_flag, coalesce(epoch_us(ratio_ts), -1) AS ratio_us,
  CAST(onset_flag AS INTEGER) AS onset_flag, coalesce(epoch_us(onset_ts), -1) AS onset_us, round(days_to_onset, 6) AS days_to_onset,
  CASE WHEN onset_flag THEN 'onset' ELSE 'no onset' END AS status FROM o50""",
    "compare_onsets": with_(*TWO_ONSETS, COMPARED) + f"""SELECT entity, CAST(fo AS INTEGER) AS flag_orig, CAST(fn AS INTEGER) AS flag_new,
  coalesce(epoch_us(t_o), -1) AS orig_us, coalesce(epoch_us(t_n), -1) AS new_us, coalesce(gap_us, -1) AS gap_us, CAST(coalesce(gap_us <= {6 * HOUR}, false) AS INTEGER) AS matches
  FROM cmp WHERE fo OR fn""",
    "compare_onsets_tally": with_(*TWO_ONSETS, COMPARED) + f"""SELECT count(*) AS n_total, count(*) FILTER (gap_us <= {6 * HOUR}) AS n_match,
  count(*) FILTER (t_n IS NULL) AS n_missing_new, count(*) FILTER (t_o IS NULL) AS n_missing_orig,
  count(*) FILTER (gap_us > {6 * HOUR}) AS n_mismatch FROM cmp WHERE fo AND fn""",
    "time_to_onset": with_(*E_ONSETS) + """SELECT entity, epoch_us(anchor_ts) AS anchor_us, round(days_to_onset, 6) AS days_to_onset
  FROM o50 WHERE days_to_onset BETWEEN 0 AND 7""",
    "onset_histogram": with_(*E_ONSETS, """binned AS (SELECT least(CAST(floor(days_to_onset * 4) AS BIGINT), 27) AS bin, count(*) AS n
  FROM o50 WHERE days_to_onset BETWEEN 0 AND 7 GROUP BY 1)""")
    + """SELECT g.bin, round(g.bin * CAST(0.25 AS DOUBLE), 6) AS bin_lo, round((g.bin + CAST(0.5 AS DOUBLE)) * CAST(0.25 AS DOUBLE), 6) AS bin_center, coalesce(n, 0) AS n
  FROM (SELECT range AS bin FROM range(28)) g LEFT JOIN binned USING (bin)""",
    "stage_distribution": """WITH m AS (SELECT DISTINCT o_custkey AS entity, CASE o_orderpriority WHEN '2-HIGH' THEN 'HIGH' ELSE o_orderpriority END AS stage FROM orders),
  n AS (SELECT stage, count(*) AS n FROM m GROUP BY 1), s AS (SELECT *, n / sum(n) OVER () AS share FROM n),
  o AS (SELECT * FROM (VALUES (0, '1-URGENT'), (1, 'HIGH'), (2, '3-MEDIUM'), (3, '5-LOW')) v(position, stage))
  SELECT o.position, stage, n, round(share, 6) AS share FROM s JOIN o USING (stage)""",
    "onset_cohort": with_(*E_ONSETS) + "SELECT DISTINCT entity, 'onset' AS stage FROM o50 WHERE onset_flag",
    "point_window": with_(*E_PTS) + f"SELECT entity, t AS ts_us, label, round(value, 6) AS value FROM pj WHERE t BETWEEN a - {H12} AND a",
    "end_window": with_(*E_INT) + f"SELECT entity, s AS start_us, e AS end_us, label, round(amount, 6) AS amount FROM ij WHERE e BETWEEN a - {H72} AND a",
    "overlap_closed": with_(*E_INT) + f"SELECT entity, s AS start_us, e AS end_us, label FROM ij WHERE e >= a - {H12} AND s <= a",
    "overlap_strict": with_(*E_INT) + f"SELECT entity, s AS start_us, e AS end_us, label FROM ij WHERE e > a - {H12} AND s < a",
    "plausible_values": with_(POINTS) + f"SELECT entity, epoch_us(ts) AS ts_us, label, round(value, 6) AS value FROM points WHERE {LIMITS}",
    "keep_first": with_(POINTS) + """SELECT entity, label, epoch_us(ts) AS ts_us, round(value, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, label ORDER BY ts, value) AS rn FROM points) WHERE rn = 1""",
    "entities_without": with_(*E_PTS) + f"SELECT entity FROM anchors EXCEPT SELECT entity FROM pj WHERE label <> 'error' AND t BETWEEN a - {H12} AND a",
    "entities_in_both": with_(ANCHORS, COHORT) + "SELECT entity FROM anchors INTERSECT SELECT entity FROM cohort",
    "union_of_sources": with_(POINTS, ORDERS) + """SELECT entity, epoch_us(ts) AS ts_us, label, round(value, 6) AS value FROM points
  UNION ALL SELECT entity, epoch_us(ts), label, NULL FROM opoints""",
    "label_matching": with_(INTERVALS, MIXED) + """SELECT lower(trim(label)) AS label,
  upper(substr(trim(label), 1, 1)) || lower(substr(trim(label), 2)) AS title, count(*) AS n FROM mixed GROUP BY 1, 2""",
    "decimal_comma_text": "SELECT o_orderkey, replace(CAST(o_totalprice AS VARCHAR), '.', ',') AS o_totalprice, o_orderpriority FROM orders",
    "value_counts": with_(POINTS) + """SELECT label, count(*) AS n, count(DISTINCT entity) AS entities,
  round(count(*) * 100 / sum(count(*)) OVER (), 6) AS pct FROM points GROUP BY label""",
    "window_mean_pivot": with_(*E_PTS) + f"""SELECT entity, {pivot("avg(value)", ["click", "purchase", "signup", "view"], wrap="round({}, 6)")}
  FROM pj WHERE t BETWEEN a - {H72} AND a AND {LIMITS} GROUP BY 1""",
    "nearest_attribute": with_(ORDERS, CUSTOMER_ANCHORS) + f"""SELECT entity, round(value, 6) AS value FROM (
  SELECT o.entity, o.value, row_number() OVER (PARTITION BY o.entity ORDER BY abs(epoch_us(o.ts) - epoch_us(c.anchor_ts) + {H12}), o.ts, o.value) AS rn
  FROM opoints o LEFT JOIN canchors c USING (entity)) WHERE rn = 1""",
    "dose_sum_start": with_(*E_INT, COHORT) + f"""SELECT c.entity, {pivot("sum(amount)", ["click", "purchase", "view"], wrap="round({}, 6)")}
  FROM cohort c LEFT JOIN (SELECT * FROM ij WHERE s BETWEEN a - {H72} AND a) w USING (entity) GROUP BY 1""",
    "dose_sum_end": with_(*E_INT) + f"""SELECT entity, {pivot("sum(amount)", ["click", "view"], wrap="round(coalesce({}, 0), 6)")}
  FROM ij WHERE e BETWEEN a - {H72} AND a AND label IN ('click', 'view', 'absent') GROUP BY 1""",
    "overlap_flags": with_(*E_INT, COHORT) + f"""SELECT c.entity, {pivot("max(1)", LABELS, wrap="coalesce({}, 0)")}
  FROM cohort c LEFT JOIN (SELECT * FROM ij WHERE e >= a - {H12} AND s <= a) w USING (entity) GROUP BY 1""",
    "overlap_sum": with_(*E_INT, COHORT) + f"""SELECT c.entity, {pivot("sum(amount)", ["signup", "view"], wrap="round({}, 6)")}
  FROM (SELECT entity FROM cohort INTERSECT SELECT entity FROM anchors) c
  LEFT JOIN (SELECT * FROM ij WHERE e >= a - {H12} AND s <= a) w USING (entity) GROUP BY 1""",
    "prorated_sum": with_(*E_MIX, f"""pr AS (SELECT entity, upper(substr(trim(label), 1, 1)) || lower(substr(trim(label), 2)) AS drug,
  amount * (CAST(least(e, a) - greatest(s, a - {H12}) AS DOUBLE) / greatest(e - s, 1000000)) AS part
  FROM mj WHERE s < a AND e > a - {H12})""") + f"""SELECT entity, {pivot("sum(part)", ["Click", "Error", "Purchase", "Signup", "View"], "drug", "in_", "round(coalesce({}, 0), 6)")}
  FROM pr GROUP BY 1""",
    "union_minutes": with_(*E_MIX, "named AS (SELECT entity, lower(trim(label)) AS feature, s, e, a FROM mj)",
                           *clip_islands("named", "entity, feature", "feature IN ('click', 'view')", H72))
    + "SELECT entity, feature, round(CAST(sum(len) AS DOUBLE) / 1000000, 6) AS seconds FROM islands GROUP BY 1, 2",
    "merged_islands": with_(*E_INT, *clip_islands("ij", "entity", "true", H72))
    + "SELECT entity, CAST(sum(len) AS BIGINT) AS covered_us, count(*) AS islands FROM islands GROUP BY 1",
    "interval_presence": with_(*E_MIX) + f"""SELECT entity, lower(trim(label)) AS feature, 1 AS value FROM mj
  WHERE lower(trim(label)) IN ('purchase', 'error') AND least(e, a) > greatest(s, a - {H12}) GROUP BY 1, 2""",
    "std_flags": with_(*E_MIX, f"""std AS (SELECT entity, CASE lower(trim(label)) WHEN 'click' THEN 'Click' WHEN 'view' THEN 'View'
  WHEN 'purchase' THEN 'Purchase' ELSE label END AS name FROM mj WHERE e BETWEEN a - {H72} AND a)""")
    + f"""SELECT entity, {pivot("count(*)", ["Click", "Purchase", "View", "signup", " signup "], "name", wrap="CAST({} > 0 AS INTEGER)")}
  FROM std WHERE name IN ('Click', 'Purchase', 'View', 'signup', ' signup ') GROUP BY 1""",
    "fixed_flags": with_(*E_INT) + f"""SELECT entity, {pivot("count(*)", ["click", "purchase", "refund"], wrap="CAST({} > 0 AS INTEGER)")}
  FROM ij WHERE e BETWEEN a - {H72} AND a GROUP BY 1""",
    "event_classes": with_(POINTS) + """SELECT CASE WHEN label IN ('view', 'click') THEN 'read' WHEN label = 'purchase' THEN 'write' ELSE 'Other' END AS class,
  count(*) AS n FROM points GROUP BY 1""",
    "combined_interval_features": with_(*E_INT, COHORT,
        f"d AS (SELECT entity, {pivot('sum(amount)', ['click', 'view'])} FROM ij WHERE s BETWEEN a - {H72} AND a AND label IN ('click', 'view') GROUP BY 1)",
        f"p AS (SELECT entity, CAST(1 AS DOUBLE) AS x FROM ij WHERE label = 'error' AND least(e, a) > greatest(s, a - {H72}) GROUP BY 1)",
        *clip_islands("ij", "entity, label", "label IN ('view', 'signup')", H72),
        f"m AS (SELECT entity, {pivot('sum(len)', ['view', 'signup'])} FROM islands GROUP BY 1)")
    + """SELECT c.entity, round(coalesce(d.click, 0), 6) AS "Click", round(coalesce(d.view, 0), 6) AS "View", coalesce(x, CAST(0 AS DOUBLE)) AS p_error,
  round(coalesce(m.view, 0) / 60000000.0, 6) AS p_view, round(coalesce(m.signup, 0) / 60000000.0, 6) AS p_signup
  FROM (SELECT entity FROM cohort INTERSECT SELECT entity FROM anchors) c LEFT JOIN d USING (entity) LEFT JOIN p USING (entity) LEFT JOIN m USING (entity)""",
    "history_matrix": with_(ORDERS, SEGMENT) + f"""SELECT s.entity, {pivot("count(*)", PRIORITIES, wrap="CAST({} > 0 AS INTEGER)")}
  FROM segment s LEFT JOIN opoints o USING (entity) GROUP BY 1""",
    "horizon_outcome": with_(CUSTOMER_ANCHORS, SEGMENT, """out AS (SELECT o_custkey AS entity, min(o_orderdate) AS event_ts FROM orders
  WHERE o_orderstatus = 'P' GROUP BY 1)""") + f"""SELECT entity,
  CAST(greatest(CAST(floor((epoch_us(event_ts) - epoch_us(anchor_ts)) / {DAY}.0) AS BIGINT), 0) BETWEEN 0 AND 90 AS INTEGER) AS outcome
  FROM out JOIN segment USING (entity) JOIN canchors USING (entity)""",
    "stay_before_anchor": with_(*LONG_STAYS, "last AS (SELECT entity, arg_max(floor((e2 - s) / 86400000000.0), s) AS days FROM stays GROUP BY 1)")
    + "SELECT c.entity, CAST(coalesce(days, 0) AS BIGINT) AS stay_days FROM cohort c LEFT JOIN last USING (entity)",
    "stay_lengths": with_(*LONG_STAYS) + """SELECT c.entity, CAST(coalesce(floor((e2 - s) / 86400000000.0), 0) AS BIGINT) AS stay_days, count(*) AS n
  FROM cohort c LEFT JOIN stays USING (entity) GROUP BY 1, 2""",
    "feature_matrix": with_(*MATRIX) + "SELECT entity, " + ", ".join(f"round({c}, 6) AS {c}" for c in MATRIX_COLUMNS) + " FROM matrix",
    "impute": with_(*MATRIX, MED) + """SELECT entity, round(coalesce(mean_click, mc), 6) AS mean_click,
  round(coalesce(mean_purchase, mp), 6) AS mean_purchase, round(coalesce(mean_view, mv), 6) AS mean_view, """
    + ", ".join(f"round(coalesce({c}, 0), 6) AS {c}" for c in MATRIX_COLUMNS[4:]) + " FROM matrix, meds",
    "impute_medians": with_(*MATRIX, MED) + """SELECT 'mean_click' AS feature, round(mc, 6) AS median FROM meds
  UNION ALL SELECT 'mean_purchase', round(mp, 6) FROM meds UNION ALL SELECT 'mean_view', round(mv, 6) FROM meds""",
    "null_counts": with_(*MATRIX) + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing FROM matrix" for c in ["entity", *MATRIX_COLUMNS]),
    "joined_matrix": with_(*MATRIX[:-2], f"st AS (SELECT entity, arg_max(floor((e - s) / 86400000000.0), s) AS d FROM ij WHERE s BETWEEN a - {H12} AND a GROUP BY 1)")
    + """SELECT k.entity, round(mean_click, 6) AS click, round(mean_purchase, 6) AS purchase, round(mean_signup, 6) AS signup, round(mean_view, 6) AS view,
  CAST(coalesce(d, 0) AS BIGINT) AS stay_days FROM anchors k LEFT JOIN means USING (entity) LEFT JOIN st USING (entity)""",
    "nonempty_rows": with_(*E_INT) + f"""SELECT entity, {pivot("sum(amount)", ["click", "purchase"], wrap="round({}, 6)")}
  FROM ij WHERE s BETWEEN a - {H12} AND a AND label IN ('click', 'purchase') GROUP BY 1 HAVING sum(amount) > 0""",
    "centred_series": with_(*E_BASE) + f"""SELECT p.entity, epoch_us(p.ts) AS ts_us, round(p.value, 6) AS value, round(baseline_value, 6) AS baseline_value,
  epoch_us(b.anchor_ts) AS anchor_us FROM points p JOIN base b USING (entity) WHERE abs(epoch_us(p.ts) - epoch_us(b.anchor_ts)) <= {H12}""",
    "chronological": with_(*E_PTS) + f"""SELECT entity, label, round((a - t) / {HOUR}.0, 6) AS hours_before, round(avg(value), 6) AS value FROM pj
  WHERE t BETWEEN a - {H72} AND a AND ((label = 'click' AND value BETWEEN 1 AND 200) OR (label = 'view' AND value BETWEEN 0.5 AND 300)) GROUP BY 1, 2, 3""",
    "history_long": with_(ORDERS, SEGMENT) + "SELECT entity, label, 1 AS value FROM opoints WHERE entity IN (SELECT entity FROM segment)",
    "event_log_amounts": with_(*EVENT_LOG) + """SELECT entity, item, round(amount, 6) AS amount, unit, epoch_us(ts) AS start_us, epoch_us(anchor_ts) AS anchor_us FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, item, unit, ts, anchor_ts ORDER BY amount NULLS LAST) AS rn FROM logged) WHERE rn = 1 AND amount IS NOT NULL""",
    "event_log_flags": with_(*EVENT_LOG) + """SELECT entity, item, 1 AS amount, epoch_us(ts) AS start_us, epoch_us(anchor_ts) AS anchor_us FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, item, ts, anchor_ts ORDER BY amount NULLS LAST) AS rn FROM logged) WHERE rn = 1 AND amount IS NULL""",
    "rule_annotations": """SELECT event_id AS id, CAST(user_id % 7 AS INTEGER) AS cluster, round(value / 100, 6) AS score, round(value, 6) AS load,
  CAST(event_type = 'error' AS INTEGER) AS failed, CASE WHEN value / 100 < 0.7 THEN '#FF0000' ELSE '#000000' END AS score_colour,
  CASE user_id % 7 WHEN 3 THEN 'three' WHEN 4 THEN 'four' WHEN 5 THEN 'five' END AS cluster_advice,
  CASE WHEN event_type = 'error' THEN 'failed once' END AS failed_advice, CASE WHEN value > 90 THEN 'heavy' END AS load_advice FROM events""",
}

# ---- cluster statistics ----------------------------------------------------

FEATURES = ["n_orders", "avg_price", "max_price", "balance", "avg_quantity", "avg_discount", "returned", "urgent"]
CUSTOMERS = [
    """per_order AS (SELECT l_orderkey, count(*) AS lines, sum(CAST(round(l_quantity * 100) AS BIGINT)) AS qty,
  sum(CAST(round(l_discount * 100) AS BIGINT)) AS disc, count(*) FILTER (l_returnflag = 'R') AS ret FROM lineitem GROUP BY 1)""",
    """per_customer AS (SELECT o_custkey AS entity, CAST(count(*) AS DOUBLE) AS n_orders,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS avg_price, max(o_totalprice) AS max_price,
  CAST(sum(qty) AS DOUBLE) / CAST(sum(lines) AS DOUBLE) / 100 AS avg_quantity,
  CAST(sum(disc) AS DOUBLE) / CAST(sum(lines) AS DOUBLE) / 100 AS avg_discount,
  CAST(coalesce(sum(ret), 0) AS DOUBLE) AS returned, CAST(max(CAST(o_orderpriority = '1-URGENT' AS INTEGER)) AS DOUBLE) AS urgent
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey GROUP BY 1)""",
    """matrix AS (SELECT c_custkey AS entity, c_mktsegment AS segment, n_orders, avg_price, max_price, c_acctbal AS balance,
  avg_quantity, avg_discount, returned, urgent, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
    WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS cluster
  FROM customer LEFT JOIN per_customer ON c_custkey = entity)""",
    "full_matrix AS (SELECT entity, segment, cluster, " + ", ".join(f"coalesce({f}, 0) AS {f}" for f in FEATURES) + " FROM matrix)",
]


def long_rows(source: str, features: list[str], extra: str = "cluster") -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS value, {extra} FROM {source} WHERE {f} IS NOT NULL" for f in features)


def ranks(features: list[str]) -> list[str]:
    return [
        *CUSTOMERS,
        f"lng AS ({long_rows('matrix', features)})",
        """rk AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS mid,
  count(*) OVER (PARTITION BY feature, value) AS ties FROM lng WINDOW w AS (PARTITION BY feature ORDER BY value))""",
        """grp AS (SELECT feature, cluster, count(*) AS n, CAST(sum(mid) AS DOUBLE) AS r, count(DISTINCT value) AS dv, avg(value) AS mean FROM rk GROUP BY 1, 2)""",
        """tot AS (SELECT feature, CAST(count(*) AS DOUBLE) AS nn, CAST(sum(CAST(ties AS DOUBLE) * ties - 1) AS DOUBLE) AS tt FROM rk GROUP BY 1)""",
    ]


def rounded(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


POINTS_VEC = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, CAST(label AS BIGINT) AS cluster FROM embeddings)"


def silhouettes(distance: str) -> str:
    return with_(
        POINTS_VEC,
        f"d AS (SELECT a.id, a.cluster AS own, b.cluster AS other, sum({distance}) AS s, count(*) AS n FROM pts a, pts b GROUP BY 1, 2, 3)",
        """ab AS (SELECT id, own, max(n) FILTER (own = other) AS n, max(s / (n - 1)) FILTER (own = other) AS a, min(s / n) FILTER (own <> other) AS b
  FROM d GROUP BY 1, 2)""",
    ) + "SELECT id, own AS cluster, round(CASE WHEN n < 2 THEN 0 ELSE (b - a) / greatest(a, b) END, 6) + 0 AS silhouette FROM ab"


#: Two-sided p of a standard normal z, from the series of the error function.
NORMAL_P = """CASE WHEN {z} = 0 THEN 1 ELSE 1 - 2 / sqrt(pi()) * exp(-{z} * {z} / 2) * list_sum(list_transform(range(0, 200),
  lambda i: exp(i * ln(4) + lgamma(i + 1) - lgamma(2 * i + 2) + (2 * i + 1) * ln(abs({z}) / sqrt(2))))) END"""
KRUSKAL = """h AS (SELECT feature, (12.0 / (nn * (nn + 1)) * sum(r * r / n) - 3 * (nn + 1)) / (1 - tt / (nn * nn * nn - nn)) AS h,
  count(*) AS k, nn, min(dv) AS dv FROM grp JOIN tot USING (feature) GROUP BY feature, nn, tt)"""


def least_squares(source: str, features: list[str], y: str) -> list[str]:
    """Coefficient and HC3 error of each feature: columns are made orthogonal in turn, the feature's own last."""
    parts = [f"sc AS (SELECT {y} - avg({y}) OVER () AS y, " + ", ".join(
        f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS {f}, stddev_pop({f}) OVER () AS sd_{f}" for f in features) + f", count(*) OVER () AS n FROM {source})"]
    for own in features:
        order, before = [f for f in features if f != own] + [own], "sc"
        for i, q in enumerate(order):
            left = [*order[i + 1 :], "y"]
            now = f"o{i}_{own}"
            keep = ", ".join([*order[: i + 1], f"sd_{own}", "n"])
            beta = f", sum(y * {q}) OVER () / sum({q} * {q}) OVER () AS beta" if q == own else ""
            parts.append(f"{now} AS (SELECT {keep}{beta}, " + ", ".join(f"{c} - {q} * (sum({c} * {q}) OVER () / sum({q} * {q}) OVER ()) AS {c}" for c in left) + f" FROM {before})")
            before = now
        lever = " + ".join(f"{q} * {q} / sum({q} * {q}) OVER ()" for q in order)
        parts.append(f"h_{own} AS (SELECT *, 1.0 / n + {lever} AS lever FROM {before})")
        parts.append(f"""e_{own} AS (SELECT '{own}' AS feature, any_value(beta) / any_value(sd_{own}) AS coef,
  sqrt(sum(({own} * y / (1 - lever)) ** 2)) / sum({own} * {own}) / any_value(sd_{own}) AS err FROM h_{own})""")
    return [*parts, "est AS (" + " UNION ALL ".join(f"SELECT * FROM e_{f}" for f in features) + ")"]


def logistic(source: str, features: list[str], y: str, steps: int = 12) -> list[str]:
    """Maximum-likelihood coefficient and error of each feature: reweighted least squares, each step by columns made orthogonal in turn; a constant one has NULLs."""
    scaled = ", ".join(f"coalesce(({f} - avg({f}) OVER ()) / nullif(stddev_pop({f}) OVER (), 0), 0) AS {f}, nullif(stddev_pop({f}) OVER (), 0) AS sd_{f}" for f in features)
    parts = [f"g0 AS (SELECT {y}::DOUBLE AS y, 0::DOUBLE AS eta, 1::DOUBLE AS one, {scaled} FROM {source})"]
    sds = [f"sd_{f}" for f in features]

    def orthogonal(before: str, order: list[str], tag: str) -> str:
        """Takes the columns out of those after them and of z, in turn, under the weights w."""
        for i, q in enumerate(order):
            left = [*order[i + 1 :], "z"]
            now = f"{tag}_{i}"
            parts.append(f"{now} AS (SELECT * REPLACE (" + ", ".join(f"{c} - {q} * coalesce(sum(w * {c} * {q}) OVER () / nullif(sum(w * {q} * {q}) OVER (), 0), 0) AS {c}" for c in left)
                         + f"){', sum(w * z * ' + q + ') OVER () / sum(w * ' + q + ' * ' + q + ') OVER () AS beta' if i + 1 == len(order) else ''} FROM {before})")
            before = now
        return before

    for t in range(steps):
        keep = ", ".join(["y", "one", *features, *sds])
        parts.append(f"w{t} AS (SELECT {keep}, eta, p * (1 - p) AS w, eta + (y - p) / (p * (1 - p)) AS z, eta + (y - p) / (p * (1 - p)) AS full_z, "
                     + ", ".join(f"{f} AS raw_{f}" for f in features) + f" FROM (SELECT *, 1 / (1 + exp(-eta)) AS p FROM g{t}))")
        last = orthogonal(f"w{t}", ["one", *features], f"s{t}")
        # what the columns explain of z are the next fitted values
        parts.append(f"g{t + 1} AS (SELECT y, full_z - z AS eta, 1::DOUBLE AS one, " + ", ".join(f"raw_{f} AS {f}" for f in features) + ", " + ", ".join(sds) + f" FROM {last})")
    for f in features:
        order = ["one", *[g for g in features if g != f], f]
        last = orthogonal(f"w{steps - 1}", order, f"f_{f}")
        parts.append(f"e_{f} AS (SELECT '{f}' AS feature, any_value(beta) / any_value(sd_{f}) AS coef, 1 / sqrt(nullif(sum(w * {f} * {f}), 0)) / any_value(sd_{f}) AS err FROM {last})")
    return [*parts, "est AS (" + " UNION ALL ".join(f"SELECT * FROM e_{f}" for f in features) + ")"]


#: Five clusters, so four degrees of freedom, whose tail is a sum of two terms.
TESTED = ["tst AS (SELECT *, exp(-h / 2) * (1 + h / 2) AS p, (h - k + 1) / (nn - k) AS eta FROM h WHERE dv > 1 AND k = 5)",
          """fdr AS (SELECT *, least(1, min(p * m / rk) OVER (ORDER BY rk DESC ROWS UNBOUNDED PRECEDING)) AS p_fdr
  FROM (SELECT *, row_number() OVER (ORDER BY p, feature) AS rk, count(*) OVER () AS m FROM tst))"""]
PAIRS = [f"""prs AS (SELECT *, {NORMAL_P.format(z="z")} AS p FROM (SELECT a.feature, a.cluster AS cluster_a, b.cluster AS cluster_b,
  (a.r / a.n - b.r / b.n) / sqrt((nn * (nn + 1) / 12 - tt / (12 * (nn - 1))) * (1.0 / a.n + 1.0 / b.n)) AS z, a.mean AS mean_a, b.mean AS mean_b
  FROM grp a JOIN grp b ON a.feature = b.feature AND a.cluster < b.cluster JOIN tot t ON t.feature = a.feature))""",
         """adj AS (SELECT *, least(1, max(p * (m - rk + 1)) OVER (PARTITION BY feature ORDER BY rk ROWS UNBOUNDED PRECEDING)) AS p_adj
  FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY p, cluster_a, cluster_b) AS rk, count(*) OVER (PARTITION BY feature) AS m FROM prs))"""]

PSEUDO = [POINTS, """ps AS (SELECT label, entity % 10 AS grp, CAST(count(*) FILTER (value > 120) AS DOUBLE) / count(*) AS p FROM points GROUP BY 1, 2)""",
          "o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY p, grp) AS rk, count(*) OVER (PARTITION BY label) AS m FROM ps)"]

SQL.update({
    "variance_filter": with_(*CUSTOMERS, f"lng AS ({long_rows('full_matrix', FEATURES)})")
    + "SELECT feature, round(var_pop(value), 6) AS variance, CAST(var_pop(value) > 0.05 AS INTEGER) AS kept FROM lng GROUP BY 1",
    "column_quartiles": with_(*CUSTOMERS, f"lng AS ({long_rows('matrix', FEATURES)})")
    + """SELECT feature, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS q2,
  round(quantile_cont(value, 0.75), 6) AS q3 FROM lng GROUP BY 1""",
    "robust_scale": with_(*CUSTOMERS, "q AS (SELECT " + ", ".join(
        f"median({f}) AS m_{f}, CASE WHEN quantile_cont({f}, 0.75) = quantile_cont({f}, 0.25) THEN 1 ELSE quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) END AS i_{f}"
        for f in FEATURES) + " FROM full_matrix)")
    + "SELECT entity, " + ", ".join(f"round(({f} - m_{f}) / i_{f}, 6) + 0 AS {f}" for f in FEATURES) + " FROM full_matrix, q",
    "cluster_profile": """WITH n AS (SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY 1 HAVING count(*) >= 47)
  SELECT cluster, n, round(CAST(n * 100 AS DOUBLE) / sum(n) OVER (), 6) AS pct FROM n""",
    "outcome_rates": with_(*CUSTOMERS) + """SELECT cluster, round(avg(urgent), 6) AS outcome_rate,
  round(avg(returned) FILTER (returned <> 0), 6) AS mean_stay FROM matrix GROUP BY 1""",
    "cluster_means": with_(*CUSTOMERS) + """SELECT cluster, round(avg(n_orders), 6) AS n_orders, round(avg(balance), 6) AS balance,
  round(avg(avg_quantity), 6) AS avg_quantity FROM matrix GROUP BY 1""",
    "silhouette": silhouettes("CASE WHEN a.id = b.id THEN 0 ELSE list_distance(a.vec, b.vec) END"),
    "silhouette_squared": silhouettes("CASE WHEN a.id = b.id THEN 0 ELSE list_distance(a.vec, b.vec) ** 2 END"),
    "davies_bouldin": with_(
        POINTS_VEC,
        "dims AS (SELECT cluster, unnest(vec) AS x, unnest(range(64)) AS dim FROM pts)",
        "cm AS (SELECT cluster, dim, avg(x) AS m FROM dims GROUP BY 1, 2)",
        "ctr AS (SELECT cluster, list(m ORDER BY dim) AS c FROM cm GROUP BY 1)",
        "sc AS (SELECT p.cluster, avg(list_distance(p.vec, c.c)) AS s FROM pts p JOIN ctr c USING (cluster) GROUP BY 1)",
        """w AS (SELECT a.cluster, max((sa.s + sb.s) / list_distance(a.c, b.c)) AS r FROM ctr a JOIN ctr b ON a.cluster <> b.cluster
  JOIN sc sa ON sa.cluster = a.cluster JOIN sc sb ON sb.cluster = b.cluster GROUP BY 1)""",
    ) + "SELECT round(avg(r), 6) AS davies_bouldin FROM w",
    "mid_ranks": with_(*ranks(["n_orders", "balance", "urgent"]))
    + "SELECT DISTINCT feature, round(value, 6) AS value, ties, round(CAST(mid AS DOUBLE), 6) AS mid_rank FROM rk",
    "kruskal_h": with_(*ranks(FEATURES), """h AS (SELECT feature, (12.0 / (nn * (nn + 1)) * sum(r * r / n) - 3 * (nn + 1)) / (1 - tt / (nn * nn * nn - nn)) AS h,
  count(*) AS k, nn, min(dv) AS dv FROM grp JOIN tot USING (feature) GROUP BY feature, nn, tt)""")
    + """SELECT feature, round(h, 6) AS "H", k, CAST(nn AS BIGINT) AS n, round((h - k + 1) / (nn - k), 6) + 0 AS eta_sq FROM h WHERE dv > 1 AND k = 5""",
    "dunn_z": with_(*ranks(FEATURES)) + """SELECT a.feature, a.cluster AS cluster_a, b.cluster AS cluster_b,
  round((a.r / a.n - b.r / b.n) / sqrt((nn * (nn + 1) / 12 - tt / (12 * (nn - 1))) * (1.0 / a.n + 1.0 / b.n)), 6) + 0 AS z,
  round(a.mean, 6) AS mean_a, round(b.mean, 6) AS mean_b, round(b.mean - a.mean, 6) + 0 AS diff_b_minus_a
  FROM grp a JOIN grp b ON a.feature = b.feature AND a.cluster < b.cluster JOIN tot t ON t.feature = a.feature""",
    "bh_q": with_(*PSEUDO) + """SELECT label, grp, round(p, 6) AS p, round(least(1, min(p * m / rk) OVER (PARTITION BY label ORDER BY rk DESC
    ROWS UNBOUNDED PRECEDING)), 6) AS q FROM o""",
    "holm_p": with_(*PSEUDO) + """SELECT label, grp, round(p, 6) AS p, round(least(1, max(p * (m - rk + 1)) OVER (PARTITION BY label ORDER BY rk
    ROWS UNBOUNDED PRECEDING)), 6) AS p_adj FROM o""",
    "xy_prepare": with_(*CUSTOMERS, "t AS (SELECT * REPLACE (CASE WHEN balance < 0 THEN 'overdrawn' ELSE CAST(balance AS VARCHAR) END AS balance) FROM matrix)")
    + """SELECT entity, round(TRY_CAST(balance AS DOUBLE), 6) AS balance, CASE WHEN returned > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS returned,
  round(avg_quantity, 6) AS avg_quantity, round(avg_price, 6) AS avg_price FROM t WHERE avg_price IS NOT NULL""",
    "ols_hc3": with_(
        *CUSTOMERS,
        "xy AS (SELECT avg_price, balance, avg_quantity, CAST(urgent > 0 AS DOUBLE) AS urgent, ln(1 + returned) AS target FROM full_matrix)",
        *least_squares("xy", ["avg_price", "balance", "avg_quantity", "urgent"], "target"),
        f"pv AS (SELECT *, {NORMAL_P.format(z='(coef / err)')} AS p FROM est)",
        """qv AS (SELECT *, least(1, min(p * m / rk) OVER (ORDER BY rk DESC ROWS UNBOUNDED PRECEDING)) AS q
  FROM (SELECT *, row_number() OVER (ORDER BY p, feature) AS rk, count(*) OVER () AS m FROM pv))""",
    ) + """SELECT feature, round(coef, 6) + 0 AS coef, round(err, 6) AS std_err, round(p, 6) AS p_value, round((exp(coef) - 1) * 100, 6) + 0 AS approx_pct_change,
  round(q, 6) AS q_value, q < 0.05 AS significant FROM qv""",
    "logit": with_(
        *CUSTOMERS,
        "xy AS (SELECT n_orders, balance, avg_quantity, CAST(returned > 0 AS DOUBLE) AS returned, urgent FROM full_matrix)",
        *logistic("xy", ["n_orders", "balance", "avg_quantity", "returned"], "urgent"),
        f"pv AS (SELECT *, {NORMAL_P.format(z='(coef / err)')} AS p FROM est)",
        """qv AS (SELECT *, CASE WHEN p IS NOT NULL THEN least(1, min(p * m / rk) OVER (ORDER BY rk DESC ROWS UNBOUNDED PRECEDING)) END AS q
  FROM (SELECT *, row_number() OVER (ORDER BY p NULLS LAST, feature) AS rk, count(p) OVER () AS m FROM pv))""",
    ) + """SELECT feature, round(coef, 6) + 0 AS coef, round(p, 6) AS p_value, round(exp(coef), 6) AS odds_ratio, round(q, 6) AS q_value, coalesce(q < 0.05, false) AS significant FROM qv""",
    "mixture_posterior": with_(
        *CUSTOMERS,
        "pts AS (SELECT entity, cluster, balance / 1000 AS a, n_orders / 4 AS b FROM full_matrix)",
        """mo AS (SELECT cluster, count(*) / sum(count(*)) OVER () AS w, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS saa, covar_pop(a, b) AS sab, var_pop(b) AS sbb
  FROM pts GROUP BY 1)""",
        """de AS (SELECT entity, mo.cluster, w / (2 * pi() * sqrt(saa * sbb - sab * sab)) *
  exp(-0.5 * (sbb * (a - ma) ** 2 - 2 * sab * (a - ma) * (b - mb) + saa * (b - mb) ** 2) / (saa * sbb - sab * sab)) AS p FROM pts, mo)""",
    ) + "SELECT entity, CAST(arg_max(cluster, p) AS INTEGER) AS cluster, round(max(p) / sum(p), 6) AS cluster_prob FROM de GROUP BY 1",
    "cluster_distances": with_(*CUSTOMERS, "pts AS (SELECT entity, cluster, balance / 1000 AS a, n_orders / 4 AS b FROM full_matrix)")
    + """SELECT x.entity AS id, CAST(y.cluster AS BIGINT) AS cluster, round(avg(sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2)), 6) AS mean_dist, count(*) AS n
  FROM pts x, pts y GROUP BY 1, 2""",
    "kruskal_p": with_(*ranks(FEATURES), KRUSKAL, *TESTED)
    + """SELECT feature, round(h, 6) AS "H", k, CAST(nn AS BIGINT) AS n, round(eta, 6) + 0 AS eta_sq, round(p, 6) AS p, round(p_fdr, 6) AS p_fdr,
  p_fdr < 0.05 AND eta > 0.06 AS consider FROM fdr""",
    "dunn_p": with_(*ranks(FEATURES), *PAIRS)
    + """SELECT feature, cluster_a, cluster_b, round(z, 6) + 0 AS z, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b,
  round(mean_b - mean_a, 6) + 0 AS diff_b_minus_a, round(p, 6) AS p, round(p_adj, 6) AS p_adj, p_adj < 0.05 AS significant FROM adj""",
    "cluster_comparison": with_(*ranks(FEATURES), KRUSKAL, *TESTED, *PAIRS)
    + """SELECT 'mean' AS kind, feature, cluster AS cluster_a, -1 AS cluster_b, round(avg(value), 6) AS value FROM lng GROUP BY feature, cluster
UNION ALL SELECT 'p_fdr', feature, -1, -1, round(p_fdr, 6) FROM fdr UNION ALL SELECT 'p_adj', feature, cluster_a, cluster_b, round(p_adj, 6) FROM adj""",
    "pca_plane": with_(
        *CUSTOMERS,
        "m AS (SELECT entity, balance / (quantile_cont(balance, 0.75) OVER () - quantile_cont(balance, 0.25) OVER ()) AS x, avg_quantity / (quantile_cont(avg_quantity, 0.75) OVER () - quantile_cont(avg_quantity, 0.25) OVER ()) AS y FROM full_matrix)",
        "c AS (SELECT entity, x - avg(x) OVER () AS x, y - avg(y) OVER () AS y FROM m)",
        "s AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS d FROM c)",
        "g AS (SELECT *, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b) AS top, atan2(2 * b, a - d) / 2 AS turn FROM s)",
    ) + """SELECT entity, CASE WHEN top / (a + d) > 0.6 THEN 1 ELSE 2 END AS components,
  round(CASE WHEN top / (a + d) > 0.6 THEN abs(x * cos(turn) + y * sin(turn)) ELSE sqrt(x * x + y * y) END, 6) AS length FROM c, g""",
    "csv_scan": """SELECT o_orderkey AS order_id, epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS day_us, round(o_totalprice, 6) AS price,
  CASE WHEN o_totalprice < 100000 THEN o_orderpriority ELSE 'none' END AS priority FROM orders""",
    "cohort_scan": with_(COHORT, """b AS (SELECT user_id, ts, event_type FROM events WHERE user_id IN (SELECT entity FROM cohort)
  UNION ALL SELECT user_id, NULL, event_type FROM events WHERE user_id IN (SELECT entity FROM cohort))""")
    + "SELECT event_type, count(*) AS n, count(ts) AS ended, max(epoch_us(ts)) AS last_us, count(DISTINCT user_id) AS entities FROM b GROUP BY 1",
    "row_positions": "SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS place FROM orders",
    "indexed_csv": """SELECT row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1 AS place, c_custkey,
  replace(CAST(c_acctbal AS VARCHAR), '.', ',') AS c_acctbal, c_mktsegment FROM customer""",
    "ranking_scores": """WITH e AS (SELECT user_id % 10 AS grp, (event_type = 'error')::DOUBLE AS y, value FROM events),
b AS (SELECT grp, value, sum(y) AS h, count(*) AS n FROM e GROUP BY 1, 2),
w AS (SELECT *, sum(h) OVER s - h AS hb, sum(n) OVER s AS upto FROM b WINDOW s AS (PARTITION BY grp ORDER BY value DESC))
SELECT grp, round(sum((n - h) * (hb + h / 2)) / (sum(h) * sum(n - h)), 6) AS roc_auc, round(sum(h * (hb + h) / upto) / sum(h), 6) AS average_precision FROM w GROUP BY 1""",
    "value_scores": """WITH o AS (SELECT o_orderpriority AS label, o_totalprice / 1000 AS price, (o_custkey % 200 + 50)::DOUBLE AS guess FROM orders)
SELECT label, round(avg(abs(price - guess)), 6) AS mae, round(1 - sum((price - guess) ** 2) / (var_pop(price) * count(*)), 6) AS r2 FROM o GROUP BY 1""",
    "neighbour_density": with_(
        *CUSTOMERS,
        "pts AS (SELECT entity AS e, balance / 1000 AS a, n_orders / 4 AS b, avg_quantity / 5 AS c FROM full_matrix)",
        "away AS (SELECT x.e, y.e AS f, sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c)) AS r FROM pts x JOIN pts y ON x.e <> y.e)",
        "core AS (SELECT e, r AS core FROM away QUALIFY row_number() OVER (PARTITION BY e ORDER BY r) = 8)",
        "eps AS (SELECT min(core) AS eps FROM (SELECT core, count(*) OVER (ORDER BY core) AS upto, count(*) OVER () AS n FROM core) WHERE upto >= 0.7::DOUBLE * n)",
        "dense AS (SELECT e, core FROM core, eps WHERE core <= eps)",
        "near AS (SELECT e, f FROM away, eps WHERE r <= eps AND e IN (SELECT e FROM dense) AND f IN (SELECT e FROM dense))",
        "reach AS (SELECT e, e AS root FROM dense UNION SELECT near.f, reach.root FROM reach JOIN near ON near.e = reach.e)",
        "comp AS (SELECT e, min(root) AS component FROM reach GROUP BY e)",
        "sized AS (SELECT component, quantile_cont(core, 0.5) AS scale FROM comp JOIN dense USING (e) GROUP BY 1 HAVING count(*) >= 10)",
    ).replace("WITH ", "WITH RECURSIVE ", 1)
    + """SELECT pts.e AS entity, round(core.core, 6) AS density_distance, coalesce(sized.component, -1) AS component,
  round(CASE WHEN sized.component IS NULL THEN 0 WHEN core.core <= scale THEN 1 ELSE scale / core.core END, 6)::DOUBLE AS density_strength
FROM pts LEFT JOIN core USING (e) LEFT JOIN comp USING (e) LEFT JOIN sized USING (component)""",
    "fold_numbers": with_(*CUSTOMERS, "u AS (SELECT urgent, row_number() OVER (PARTITION BY urgent ORDER BY entity) - 1 AS i FROM full_matrix)")
    + "SELECT urgent, CAST(i % 5 AS INTEGER) AS fold, count(*) AS n FROM u GROUP BY 1, 2",
})
