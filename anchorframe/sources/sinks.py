"""Writing result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorframe.functions.scalar import decimal_comma
from anchorframe.session import ensure_checkpoint_dir

_FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)


def with_decimal_commas(df: DataFrame) -> DataFrame:
    """Fractional columns as text with a comma in place of the point."""
    return df.select(
        *[
            decimal_comma(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, _FRACTIONAL) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def with_position(df: DataFrame, order: Sequence[str], name: str = "index", partitions: int | None = None) -> DataFrame:
    """Each row's place, from 0, in the order of the listed columns (NULLs first); rows that are equal there in any order.

    No task holds the whole order: rows are dealt by ranges of it and written with their range's number, ranges are
    numbered on their own, and moved by the sizes of those before (one number a range comes back).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    by = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *by).withColumn("__range", F.spark_partition_id()).checkpoint()
    ahead, starts = 0, []
    for r in sorted(dealt.groupBy("__range").count().collect()):
        starts.append((r["__range"], ahead))
        ahead += r["count"]
    offsets = spark.createDataFrame(starts, "__range int, __ahead long")
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*by))
    return dealt.join(F.broadcast(offsets), "__range").withColumn(name, F.col("__ahead") + own - 1).drop("__range", "__ahead")


def write_csv(df: DataFrame, path: str, comma: bool = False, index_by: Sequence[str] | None = None) -> None:
    """CSV shards with a header; with ``index_by`` in that order, with an unnamed first column that counts the rows."""
    if index_by is not None:
        placed = with_position(df, index_by, "__index")
        df = placed.select(F.col("__index").alias(""), *[F.col(f"`{c}`") for c in df.columns]).sortWithinPartitions(F.col("``"))
    (with_decimal_commas(df) if comma else df).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
