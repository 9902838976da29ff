"""Keyed tables that a stream merges into: a batch rewrites only the buckets it touches.

Rows lie in buckets by the hash of their key. A version is a batch id: it holds
new files for the buckets that its batch touched, and a commit that names for
every bucket the version its rows are in. Readers go by the newest commit, so a
batch becomes visible at once, and a batch that runs again starts from its
predecessor's commit and replaces its own files. The cost of a batch follows
from what it touches: neither earlier batches nor other buckets are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tremorgrid.session import folders, remove_path

COMMIT = "bucket int, at long"


class BucketedTable:
    """Rows of one schema under ``root``, found by ``key``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: list[str], buckets: int = 64):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), list(key), buckets
        self.schema = schema

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def commits(self) -> list[int]:
        """Committed versions, the newest last (a commit without ``_SUCCESS`` is none)."""
        found = sorted(int(n.removeprefix("version=")) for n in folders(self.spark, f"{self.root}/commits"))
        return [v for v in found if self._done(v)]

    def _done(self, version: int) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits/version={version}/_SUCCESS")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def places(self, before: int | None = None) -> dict[int, int]:
        """bucket -> version of its rows, by the newest commit (``before`` a version); as many entries as buckets."""
        known = [v for v in self.commits() if before is None or v < before]
        if not known:
            return {}
        rows = self.spark.read.schema(COMMIT).parquet(f"{self.root}/commits/version={known[-1]}")
        return {r.bucket: r.at for r in rows.collect()}

    def read(self, before: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The rows in use, or only those of some buckets."""
        places = {b: v for b, v in self.places(before).items() if buckets is None or b in buckets}
        if not places:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/rows/version={v}/bucket={b}" for b, v in sorted(places.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def touched(self, rows: DataFrame) -> set[int]:
        """Buckets of these rows: a few numbers, whatever the rows."""
        return {r[0] for r in rows.select(self.bucket()).distinct().collect()}

    def replace(self, rows: DataFrame, touched: set[int], version: int) -> None:
        """Commit ``rows`` as the whole content of the touched buckets; the others stay as they are."""
        target = f"{self.root}/rows/version={version}"
        places = self.places(version)
        if touched:
            # a bucket is dealt to one task unless it is large; a bucket left empty has no folder
            (rows.select(*self.schema.names).withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
             .write.mode("overwrite").partitionBy("bucket").parquet(target))
        full = {int(n.removeprefix("bucket=")) for n in folders(self.spark, target)} if touched else set()
        places = {b: v for b, v in places.items() if b not in touched} | {b: version for b in full}
        commit = self.spark.createDataFrame(sorted(places.items()), COMMIT)
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/version={version}")

    def of_keys(self, keys: DataFrame, touched: set[int], before: int) -> DataFrame:
        """Rows in use that have one of these keys, read from the touched buckets alone."""
        return self.read(before, touched).join(keys.select(*self.key).distinct(), self.key, "left_semi")

    def vacuum(self) -> int:
        """Remove files that the two newest commits do not name, and older commits; returns the folders removed.

        The last but one stays, since the newest batch may have to run again.
        """
        commits = self.commits()
        used = {f"version={v}/bucket={b}" for c in commits[-2:] for b, v in self.places(c + 1).items()}
        gone = 0
        for version in folders(self.spark, f"{self.root}/rows"):
            if commits and int(version.removeprefix("version=")) > commits[-1]:
                continue  # being written
            own = folders(self.spark, f"{self.root}/rows/{version}")
            for bucket in own:
                if f"{version}/{bucket}" not in used:
                    remove_path(self.spark, f"{self.root}/rows/{version}/{bucket}")
                    gone += 1
            if not any(f"{version}/{b}" in used for b in own):
                remove_path(self.spark, f"{self.root}/rows/{version}")
        for version in commits[:-2]:
            remove_path(self.spark, f"{self.root}/commits/version={version}")
        return gone
