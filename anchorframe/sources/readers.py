"""Reading tables: explicit schemas, NULL for anything unreadable, no inference."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorframe.functions.scalar import blank_to_null, to_double, to_id

_COLUMNAR = {".parquet", ".pq"}


def require_columns(df: DataFrame, columns: Sequence[str], table: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{table} lacks columns {missing}; it has {df.columns}")
    return df


def column_position(df: DataFrame, name: str) -> int:
    if name not in df.columns:
        raise ValueError(f"column '{name}' not found")
    return df.columns.index(name)


def normalise_names(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


# How each logical type is parsed by the CSV reader itself; ids arrive as text because of forms like '12.0'.
_PARSED = {
    "id": T.StringType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def read_csv_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    types: Mapping[str, str] | None = None,
    strict: bool = False,
    multiline: bool = False,
    corrupt: str | None = None,
) -> DataFrame:
    """One or more CSV shards with a header; shards may differ in their columns.

    Column names are stripped and lower-cased.  ``types`` gives the type of
    listed columns ('id', 'double', 'timestamp', 'date'); others are text.
    Blank values (also quoted ones and spaces) are NULL; unreadable ones are
    NULL, or an error with ``strict``.  ``multiline`` reads line breaks inside
    quotes as text (such a file is one task).  ``corrupt`` names a column that
    keeps the source of every record that could not be read as it should, NULL
    for the others, so that losses can be counted.
    Typing happens in the reader, so unused columns are never parsed.
    """
    types = types or {}
    paths = [paths] if isinstance(paths, str) else list(paths)
    # the header line decides the order of the schema
    headers = [[c.strip().lower() for c in spark.read.option("header", True).option("multiLine", multiline).csv(p).columns] for p in paths]

    def shard_group(header: list[str], group: list[str]) -> DataFrame:
        fields = [T.StructField(c, _PARSED[types.get(c, "string")]) for c in header]
        reader = spark.read.schema(T.StructType(fields + ([T.StructField(corrupt, T.StringType())] if corrupt else [])))
        reader = reader.option("header", True).option("nullValue", "NaN").option("multiLine", multiline)
        reader = reader.option("columnNameOfCorruptRecord", corrupt) if corrupt else reader
        df = reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(group)
        cols = []
        for c in header:
            kind = types.get(c, "string")
            col = F.col(f"`{c}`")
            if kind == "id":
                col = to_id(col)
            elif kind == "date":
                col = col.cast("timestamp")
            elif kind == "string":
                col = blank_to_null(col)
            cols.append(col.alias(c))
        return df.select(*cols, *([corrupt] if corrupt else []))

    groups: dict[tuple[str, ...], list[str]] = {}
    for h, p in zip(headers, paths):
        groups.setdefault(tuple(h), []).append(p)
    parts = [shard_group(list(h), g) for h, g in groups.items()]
    df = parts[0]
    for other in parts[1:]:
        df = df.unionByName(other, allowMissingColumns=True)
    return df


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV or Parquet by suffix; any other suffix is an error."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix == ".csv":
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    if suffix in _COLUMNAR:
        return spark.read.parquet(path)
    raise ValueError(f"Unsupported file type: {suffix}")


def load_for_cohort(spark: SparkSession, path: str, cohort: DataFrame, entity: str = "entity") -> DataFrame:
    return load(spark, path).join(cohort.select(entity).distinct(), entity, "left_semi")


def with_end_column(df: DataFrame, candidates: Sequence[str] = ("endtime", "stoptime"), name: str = "end_ts") -> DataFrame:
    """End time from the first candidate column that exists, else NULL."""
    for c in candidates:
        if c in df.columns:
            return df.withColumn(name, F.col(c).try_cast("timestamp"))
    return df.withColumn(name, F.lit(None).cast("timestamp"))


def _entity(df: DataFrame) -> DataFrame:
    return df.filter(F.col("entity").isNotNull())


def as_points(df: DataFrame, entity: str, ts: str, value: str | None = None, label: str | None = None) -> DataFrame:
    cols = [F.col(entity).alias("entity"), F.col(ts).cast("timestamp").alias("ts")]
    if label:
        cols.append(F.col(label).alias("label"))
    if value:
        cols.append(to_double(value).alias("value"))
    return _entity(df.select(*cols))


def as_intervals(
    df: DataFrame, entity: str, start: str | None, end: str | None, label: str, amount: str | None = None
) -> DataFrame:
    null_ts = F.lit(None).cast("timestamp")
    return _entity(
        df.select(
            F.col(entity).alias("entity"),
            (F.col(start).cast("timestamp") if start else null_ts).alias("start_ts"),
            (F.col(end).cast("timestamp") if end else null_ts).alias("end_ts"),
            F.col(label).alias("label"),
            (to_double(amount) if amount else F.lit(None).cast("double")).alias("amount"),
        )
    )
