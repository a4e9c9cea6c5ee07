"""Small state tables between micro-batches.

A batch writes the keys it touched; every `FULL_EVERY`-th batch writes all keys. Reading takes
the last full batch and what follows, newest row per key. State is a function of the batch id,
so a repeated batch reads what it read before and overwrites its own folder. A table may start from a snapshot of
another one (`base`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.sources.sinks import batch_folder

FULL_EVERY = 20


@dataclass(frozen=True)
class StateTable:
    folder: str
    keys: tuple[str, ...]
    full_every: int = FULL_EVERY
    base: str | None = None

    def before(self, spark: SparkSession, batch_id: int, touched: DataFrame | None = None) -> DataFrame | None:
        """The state the batch starts from, or that of the `touched` devices; None for the first batch."""
        full = max(0, batch_id - 1) // self.full_every * self.full_every
        paths = [batch_folder(self.folder, i) for i in range(full, batch_id)]
        rows = spark.read.option("basePath", self.folder).parquet(*paths) if paths else None
        if self.base is not None and full == 0:
            base = spark.read.parquet(self.base).withColumn("batch", F.lit(-1))
            rows = base if rows is None else rows.unionByName(base)
        if rows is None:
            return None
        if touched is not None:
            rows = rows.join(touched, touched.columns, "left_semi")
        if len(paths) + (self.base is not None) == 1:
            return rows.drop("batch")
        rest = [c for c in rows.columns if c not in (*self.keys, "batch")]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "batch").alias("s"))
        return newest.select(*self.keys, "s.*")

    def write(self, batch_id: int, touched: DataFrame) -> None:
        """Store the new state of the touched keys, and of all others when a full batch is due."""
        rows = touched
        if batch_id and batch_id % self.full_every == 0:  # the first batch has the snapshot beside it
            others = self.before(touched.sparkSession, batch_id)
            rows = touched.unionByName(others.join(touched.select(*self.keys), list(self.keys), "left_anti"))
        rows.write.mode("overwrite").parquet(batch_folder(self.folder, batch_id))
