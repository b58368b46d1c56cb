"""Helpers shared by the corpus operators: text columns, the shared folder, linking."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import weakref

import anchorframe
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Python tasks carry the library's functions with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(anchorframe)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates alphanumeric words: every ASCII character but letters and digits (upper case is lowered first).
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_FOLDERS: dict[str, str] = {}
_WRITTEN: dict[int, tuple] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    return F.filter(F.split(lowered(text), NOT_ALNUM), lambda w: w != "")


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application in the shared folder that the cluster names in spark.checkpoint.dir.

    Only where none is named (a local test) one is made on this machine.  It is removed when Python ends.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _FOLDERS:
        base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
        if base is None:
            if not re.fullmatch(r"local(\[[^-\]]*\])?", sc.master):  # local-cluster has executors of its own
                raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
            base = "file://" + tempfile.mkdtemp(prefix="corpus-")
            atexit.register(_remove, spark, base)
        folder = _FOLDERS[sc.applicationId] = f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, folder)
    return _FOLDERS[sc.applicationId]


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session may have ended before
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[id(out)] = (weakref.ref(out), path)
    return out


def forget(df: DataFrame) -> None:
    """Removes what `written` wrote for df, once nothing reads it any more; the rest goes when Python ends."""
    known, path = _WRITTEN.pop(id(df), (None, None))
    if known is not None and known() is df:
        _remove(df.sparkSession, path)


def floored(x: Column, scale: float) -> Column:
    """floor(scale * x) as a double of any size, x as double; floor() alone would hold it to a long."""
    y = x.cast("double") * scale
    return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)  # a larger double is whole


#: What a Python task holds of its input at a time.  Texts differ in length by far, so bytes are bounded too.
BATCH_ROWS, BATCH_BYTES = 4_000, 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, after its session has been told to hand rows to Python in small batches; a long row is a batch of its own."""
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        if conf.get(name, None) is None:  # what the session sets itself stays
            conf.set(name, str(most))
    return df


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the edges; root is the smallest node it can reach.

    Alternates large-star and small-star steps: each hangs neighbours on the smallest node seen so far.  The least
    neighbours are written before they are joined, so Spark sees the join's real sides and can split a hot node; the
    number of edges never grows, the rounds grow with the logarithm of the chain length, and tables of earlier rounds go.
    """
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v"))).distinct()
        before = state
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large-star")
        lower = written(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        small = large.join(lower, "u").select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        after = written(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        for old in (e, least, large, lower):
            forget(old)
        e = after
