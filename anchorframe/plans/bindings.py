"""The sample star-schema tables in the canonical shapes of ``core``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorframe.session import configure

EVENT_LIMITS = {"click": (1.0, 200.0), "purchase": (5.0, 150.0), "signup": (0.0, 100.0), "view": (0.5, 300.0)}
EVENT_LABELS = ["click", "error", "purchase", "signup", "view"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
MIXED_NAMES = {"click": "Click", "view": "View", "purchase": "Purchase"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_points(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("entity"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("label"),
        "value",
    )


def event_anchors(spark, sf_dir) -> DataFrame:
    """First error of each user on or after 10 January; the filter reaches the scan."""
    e = table(spark, sf_dir, "events")
    late = (F.col("event_type") == "error") & (F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return (
        e.filter(late)
        .groupBy(F.col("user_id").alias("entity"))
        .agg(F.min("ts").cast("timestamp").alias("anchor_ts"))
    )


def event_intervals(spark, sf_dir) -> DataFrame:
    """Each event lasts ten minutes per unit of value."""
    e = table(spark, sf_dir, "events")
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    length = F.round(F.col("value") * 100).cast("long") * F.lit(6_000_000)
    return e.select(
        F.col("user_id").alias("entity"),
        F.col("ts").cast("timestamp").alias("start_ts"),
        F.timestamp_micros(start + length).alias("end_ts"),
        F.col("event_type").alias("label"),
        F.col("value").alias("amount"),
    )


def mixed_case_events(spark, sf_dir) -> DataFrame:
    """Event intervals whose labels differ in case and padding from user to user."""
    i = event_intervals(spark, sf_dir)
    mixed = (
        F.when(F.col("entity") % 3 == 0, F.upper("label"))
        .when(F.col("entity") % 3 == 1, F.concat(F.lit(" "), F.col("label"), F.lit(" ")))
        .otherwise(F.col("label"))
    )
    return i.withColumn("label", mixed)


def event_cohort(spark, sf_dir) -> DataFrame:
    """Users with at least one event of value above 150."""
    e = table(spark, sf_dir, "events")
    return e.filter(F.col("value") > 150).select(F.col("user_id").alias("entity")).distinct()


def order_points(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("entity"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderpriority").alias("label"),
        F.col("o_totalprice").alias("value"),
    )


def customer_anchors(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    day = F.date_add(F.lit("1995-06-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
    return c.select(F.col("c_custkey").alias("entity"), day.cast("timestamp").alias("anchor_ts"))


def segment_cohort(spark, sf_dir, segment: str = "BUILDING") -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.filter(F.col("c_mktsegment") == segment).select(F.col("c_custkey").alias("entity"))


MATRIX_FEATURES = ["n_orders", "avg_price", "max_price", "balance", "avg_quantity", "avg_discount", "returned", "urgent"]


def customer_matrix(spark, sf_dir) -> DataFrame:
    """Numeric features of each customer, NULL where there are no orders; ``segment`` serves as cluster.

    Line items are summed per order first, so the join to orders meets one row
    per order and the hot customer's rows are already few.
    """
    o, li, c = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    # Sums of these two-decimal numbers are taken as whole hundredths: exact in any order.
    hundredths = lambda x: F.round(F.col(x) * 100).cast("long")
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(hundredths("l_quantity")).alias("qty"),
        F.sum(hundredths("l_discount")).alias("disc"),
        F.count_if(F.col("l_returnflag") == "R").alias("ret"),
    )
    per_customer = (
        o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
        .groupBy(F.col("o_custkey").alias("entity"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("n_orders"),
            (F.sum(hundredths("o_totalprice")) / F.count(F.lit(1)) / 100).alias("avg_price"),
            F.max("o_totalprice").alias("max_price"),
            (F.sum("qty") / F.sum("lines") / 100).alias("avg_quantity"),
            (F.sum("disc") / F.sum("lines") / 100).alias("avg_discount"),
            F.coalesce(F.sum("ret"), F.lit(0)).cast("double").alias("returned"),
            F.max((F.col("o_orderpriority") == "1-URGENT").cast("double")).alias("urgent"),
        )
    )
    base = c.select(F.col("c_custkey").alias("entity"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return base.join(per_customer, "entity", "left").select("entity", "segment", *MATRIX_FEATURES)


def complete_matrix(spark, sf_dir) -> DataFrame:
    """The customer matrix with 0 for missing values."""
    return customer_matrix(spark, sf_dir).fillna(0.0, subset=MATRIX_FEATURES)


def embedding_points(spark, sf_dir) -> DataFrame:
    """``(id, vec, cluster)`` with double components."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), F.col("label").alias("cluster")
    )
