"""Assigning new rows to an existing clustering."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorframe.operators.cluster import Density, assign, project, score_density
from anchorframe.operators.matrix import fill_from_constants
from anchorframe.operators.mixture import Mixture
from anchorframe.operators.balls import TOLERANCE, BallIndex, ball_index, ball_sums
from anchorframe.operators.stats import _silhouette_from, distance_sums


@dataclass
class ClusterBundle:
    """Everything needed to score new rows: fitted models, core rows, the density of all rows, settings."""

    projection: PipelineModel
    mixture: Mixture
    core: DataFrame  # id, vec, cluster
    density: Density
    valid: list[int]
    fills: Mapping[str, float] = field(default_factory=dict)
    key: str = "entity"
    balls: BallIndex | None = None  # the core rows in leaves; made when it is first needed

    def ball_index(self) -> BallIndex:
        if self.balls is None:
            self.balls = ball_index(self.core)
        return self.balls

    def save(self, path: str) -> None:
        self.projection.write().overwrite().save(f"{path}/projection")
        self.core.write.mode("overwrite").parquet(f"{path}/core")
        self.density.save(f"{path}/density")
        self.ball_index().save(f"{path}/balls")
        settings = {
            "mixture": self.mixture.to_lists(),
            "valid": list(self.valid),
            "fills": dict(self.fills),
            "key": self.key,
        }
        spark = self.core.sparkSession
        spark.createDataFrame([(json.dumps(settings),)], "settings string").write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ClusterBundle:
        s = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        return cls(
            PipelineModel.load(f"{path}/projection"),
            Mixture.from_lists(s["mixture"]),
            spark.read.parquet(f"{path}/core"),
            Density.load(spark, f"{path}/density"),
            s["valid"],
            s["fills"],
            s["key"],
            BallIndex.load(spark, f"{path}/balls"),
        )


def core_points(df: DataFrame, key: str, vec: str = "projected") -> DataFrame:
    return df.select(F.col(key).alias("id"), vector_to_array(F.col(vec)).alias("vec"), F.col("cluster").cast("long").alias("cluster"))


def score_rows(rows: DataFrame, bundle: ClusterBundle, tolerance: float | None = TOLERANCE, block_rows: int = 2048) -> DataFrame:
    """New rows with cluster, posterior, density strength and silhouette against the core.

    The silhouette of a new row needs only its own distances to the core rows, summed by cluster.  Groups of core rows
    that lie far from a row are summed as a whole, within the tolerance; with tolerance None every pair is evaluated.
    """
    filled = fill_from_constants(rows, dict(bundle.fills), bundle.key)
    placed = assign(project(filled, bundle.projection), bundle.mixture, bundle.valid)
    dense = score_density(placed, "projected", bundle.key, bundle.density).drop("density_component")

    new = core_points(placed, bundle.key)  # density adds columns, not rows
    asked = new.select("id", "vec").dropDuplicates(["id"])
    sums = distance_sums(asked, bundle.core, block_rows, same_rows=False) if tolerance is None else ball_sums(asked, bundle.ball_index(), tolerance)
    own = new.select("id", F.col("cluster").alias("own")).dropDuplicates(["id"])
    sil = _silhouette_from(sums, own, 0).select(F.col("id").alias(bundle.key), "silhouette")
    return dense.join(sil, bundle.key, "left").drop("projected")


def append_scored(core: DataFrame, scored: DataFrame) -> DataFrame:
    return core.unionByName(scored, allowMissingColumns=True)
