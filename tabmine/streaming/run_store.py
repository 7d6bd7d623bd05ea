"""Run store (M22): the run history kept up to date batch by batch.

A store is a folder.  Histories are dealt over a fixed number of buckets by a hash of the algorithm.  A
batch rewrites the buckets it touches, each from its last version and the batch's rows, below
``data/batch=<id>``, then commits by writing ``manifest/batch=<id>``, which names the version of every bucket.  A
reader takes the newest finished manifest, so a batch is seen whole or not at all; a batch that failed half way is
written again over its own folder, and one that is already committed changes nothing.

Only the newest run of a signature and the ``keep`` newest of an algorithm are stored.  That is enough: a run that fell out
was older than ``keep`` others, whose times never go back, so no later batch can bring it up again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabmine.operators.runs import run_history


@dataclass
class RunStore:
    """Runs of the columns ``algorithm``, ``signature``, ``ts``, ``tiebreak`` and any others (the same in every batch)."""

    spark: SparkSession
    path: str
    algorithm: str = "algorithm"
    signature: str = "signature"
    ts: str = "ts"
    tiebreak: str | None = None
    keep: int = 12
    buckets: int = 64

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def committed(self) -> list[int]:
        """Ids of the committed batches whose manifests are kept, rising."""
        fs, root = self._fs(f"{self.path}/manifest")
        if not fs.exists(root):
            return []
        names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(root)]
        return sorted(int(n.split("=")[1]) for n, full in names if n.startswith("batch=") and fs.exists(self._fs(f"{full}/_SUCCESS")[1]))

    def _manifest(self) -> dict[int, int]:
        """``bucket -> batch`` of the newest version of every bucket (at most ``buckets`` rows)."""
        done = self.committed()
        if not done:
            return {}
        rows = self.spark.read.schema("bucket int, version bigint").parquet(f"{self.path}/manifest/batch={done[-1]}").collect()
        return {r["bucket"]: r["version"] for r in rows}

    def _versions(self, versions: dict[int, int], schema) -> DataFrame | None:
        paths = [f"{self.path}/data/batch={v}/bucket={b}" for b, v in sorted(versions.items())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def _history(self, rows: DataFrame) -> DataFrame:
        return run_history(rows, self.algorithm, self.signature, self.ts, self.tiebreak, self.keep)

    def upsert(self, batch: DataFrame, batch_id: int) -> bool:
        """Take in one batch; ids rise from batch to batch.  ``False`` if it is committed already (a retry)."""
        done = self.committed()
        if done and batch_id <= done[-1]:
            return False
        versions = self._manifest()
        bucket = F.pmod(F.xxhash64(F.col(self.algorithm).cast("string")), F.lit(self.buckets)).cast("int")
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]              # at most ``buckets``
        old = self._versions({b: v for b, v in versions.items() if b in touched}, batch.schema)
        # the newest runs of the batch first: a batch of any size is a few rows an algorithm when it meets the store
        rows = self._history(batch).drop("rank").select(*batch.columns)
        if old is not None:
            rows = self._history(old.select(*batch.columns).unionByName(rows)).drop("rank").select(*batch.columns)
        rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/batch={batch_id}")
        named = [(b, batch_id if b in touched else versions[b]) for b in sorted({*versions, *touched})]
        self.spark.createDataFrame(named, "bucket int, version bigint").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch_id}")
        return True

    def history(self, schema) -> DataFrame:
        """The stored runs with ``rank`` (1: the newest of the algorithm).  ``schema``: that of the batches."""
        rows = self._versions(self._manifest(), schema)
        return self._history(self.spark.createDataFrame([], schema) if rows is None else rows)

    def vacuum(self) -> int:
        """Remove versions and manifests that the newest manifest does not need; the number of folders removed."""
        done, removed = self.committed(), 0
        if not done:
            return 0
        needed = set(self._manifest().values())
        for folder, kept in (("manifest", {done[-1]}), ("data", needed)):
            fs, root = self._fs(f"{self.path}/{folder}")
            for s in fs.listStatus(root) if fs.exists(root) else []:
                n = int(s.getPath().getName().split("=")[1]) if s.getPath().getName().startswith("batch=") else None
                if n is not None and n <= done[-1] and n not in kept:
                    removed += bool(fs.delete(s.getPath(), True))
        return removed

    def follow(self, runs: DataFrame, checkpoint: str) -> StreamingQuery:
        """Keep the store up to date from a streaming DataFrame; each micro-batch is one ``upsert``."""
        return (runs.writeStream.foreachBatch(lambda df, n: self.upsert(df, n) and None).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
