"""Keyed table fed by an update-mode stream: a versioned log with a bounded number of parts.

Each micro-batch writes its changed keys to a ``delta-N`` folder and then a manifest that
names the folders in force. When ``merge_every`` deltas have gathered, they and the base
are merged into a new base with one row a key, in which the rows marked as dropped are
gone. So a reader opens a bounded number of folders, and what is stored follows the keys,
not the batches.

A manifest appears by one rename, after all it names. A batch that is replayed, before or
after its manifest was written, starts from the manifest before it: folders are deleted
only once neither the current manifest nor the one before names them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marlspike.session import delete, exists, names, rename

MERGE_EVERY = 8


@dataclass(frozen=True)
class KeyedTable:
    """``drop`` is a condition (SQL) on rows that a merge need not keep."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    merge_every: int = MERGE_EVERY
    drop: str | None = None
    _empty: dict = field(default_factory=lambda: {"batch": -1, "folders": []}, repr=False)

    def manifest(self, before: int | None = None) -> dict:
        """The newest manifest, or the newest one of an earlier batch than ``before``."""
        found = [int(n.removesuffix(".json")) for n in names(self.spark, f"{self.path}/manifest") if n.endswith(".json")]
        found = [n for n in found if before is None or n < before]
        if not found:
            return self._empty
        text = self.spark.read.text(f"{self.path}/manifest/{max(found):012d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def log(self, manifest: dict) -> DataFrame:
        """All rows that a manifest names, with their ``batch``."""
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in manifest["folders"]])

    def current(self, before: int | None = None, schema: str | None = None) -> DataFrame:
        """Latest row of every key; a filter on keys reaches the scan.

        A table without rows needs ``schema`` to be read.
        """
        manifest = self.manifest(before)
        if not manifest["folders"] and schema is not None:
            return self.spark.createDataFrame([], schema)
        return self._latest(self.log(manifest)).drop("batch")

    def _latest(self, log: DataFrame) -> DataFrame:
        values = [c for c in log.columns if c not in self.keys]
        return log.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*self.keys, "v.*")

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """Put the changed rows of one batch in force."""
        old = self.manifest(batch_id)
        delta = f"delta-{batch_id:012d}"
        changes.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.path}/{delta}")
        folders = [*old["folders"], delta]
        if sum(f.startswith("delta") for f in folders) > self.merge_every:
            base = f"base-{batch_id:012d}"
            rows = self._latest(self.log({"folders": folders}))
            rows = rows if self.drop is None else rows.filter(f"NOT ({self.drop})")
            rows.sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(f"{self.path}/{base}")
            folders = [base]
        self._publish({"batch": batch_id, "folders": folders})
        self._clean(keep={*folders, *old["folders"]}, manifests={batch_id, old["batch"]})

    def _publish(self, manifest: dict) -> None:
        target, text = f"{self.path}/manifest/{manifest['batch']:012d}.json", json.dumps(manifest)
        draft = f"{self.path}/draft-{manifest['batch']:012d}"
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(draft)
        part = next(n for n in names(self.spark, draft) if n.startswith("part-"))
        if exists(self.spark, target):
            delete(self.spark, target)  # replayed: the manifest before it still stands
        rename(self.spark, f"{draft}/{part}", target)
        delete(self.spark, draft)

    def _clean(self, keep: set[str], manifests: set[int]) -> None:
        for name in names(self.spark, self.path):
            if name.startswith(("base-", "delta-")) and name not in keep:
                delete(self.spark, f"{self.path}/{name}")
        for name in names(self.spark, f"{self.path}/manifest"):
            if name.endswith(".json") and int(name.removesuffix(".json")) not in manifests:
                delete(self.spark, f"{self.path}/manifest/{name}")


def start_upsert(
    counts: DataFrame, table: KeyedTable, checkpoint: str,
    after_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Run the stream over all available input in update mode and stop.

    ``checkpoint`` is kept: a later start goes on after the last committed batch.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        if after_batch is None:
            table.write(batch, batch_id)
            return
        batch.persist()
        try:
            table.write(batch, batch_id)
            after_batch(batch, batch_id)
        finally:
            batch.unpersist()

    return (
        counts.writeStream.outputMode("update").foreachBatch(sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def start_append(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append mode to a parquet file sink: a window is written once, after the watermark passed it."""
    return (
        counts.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
