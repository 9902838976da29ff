"""Versioned tables, reports and all-or-nothing publishing.

A table is a folder with one sub-folder per run. Data is written under its
run first; the run becomes visible only with the rows that one manifest file
adds afterwards. A failed or repeated run therefore never mixes with the
version in use, and earlier versions stay as backups: any of them can be read by
its run, and a rollback makes it current again by a new manifest file. Nothing in
the manifest is ever changed; ``prune`` adds rows without a path for the runs
whose folders it removes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tremorgrid.session import folders, remove_path

MANIFEST = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("artifact", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])


class TableStore:
    """Artifacts of the pipeline under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, artifact: str, run_id: str) -> str:
        return f"{self.root}/{artifact}/run_id={run_id}"

    def write(self, df: DataFrame, artifact: str, run_id: str,
              month_of: str | None = None, sort_by: list[str] | None = None) -> str:
        """Write a table version; optionally partitioned by the month of a date.

        Months are dealt out first, so that a month has a few files and not one
        per task. A run that is published already is refused: its readers
        would lose their files.
        """
        self.refuse_published(artifact, run_id)
        parts: list[str] = []
        if month_of:
            df = df.withColumn("month", F.date_format(month_of, "yyyy-MM"))
            parts = ["month"]
            df = df.hint("rebalance", "month")
        if sort_by:
            df = df.sortWithinPartitions(*parts, *sort_by)
        target = self.path(artifact, run_id)
        df.write.mode("overwrite").partitionBy(*parts).parquet(target)
        return target

    def write_report(self, report: DataFrame, artifact: str, run_id: str) -> str:
        """Write a small report (one row of nested values) as JSON."""
        self.refuse_published(artifact, run_id)
        target = self.path(artifact, run_id)
        report.coalesce(1).write.mode("overwrite").json(target)
        return target

    def publish(self, run_id: str, artifacts: dict[str, str],
                details: dict[str, str] | None = None) -> None:
        """Make all artifacts of a run visible at once, by one manifest file."""
        self._append([(run_id, name, path, (details or {}).get(name)) for name, path in artifacts.items()])

    def _append(self, rows: list[tuple]) -> None:
        """One file of manifest rows, numbered behind all earlier ones."""
        schema = T.StructType(MANIFEST.fields[:-2])
        last = self._rows().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
        (self.spark.createDataFrame(rows, schema)
         .withColumns({"published_at": F.current_timestamp(), "seq": F.lit(last + 1).cast("long")})
         .coalesce(1).write.mode("append").parquet(f"{self.root}/manifest"))

    def _rows(self) -> DataFrame:
        """The manifest; no rows before the first publication."""
        if "manifest" not in folders(self.spark, self.root):
            return self.spark.createDataFrame([], MANIFEST)
        return self.manifest()

    def versions(self, artifact: str) -> list[dict]:
        """Published versions that can still be read, the current one first.

        A run counts once, by its last row; one whose folder was removed is left out.
        """
        newest = Window.partitionBy("run_id").orderBy(F.desc("seq"), F.desc("published_at"))
        rows = self._rows().where(F.col("artifact") == artifact).withColumn("_n", F.row_number().over(newest))
        kept = rows.where("_n = 1 and path is not null").drop("_n").orderBy(F.desc("seq"), F.desc("published_at"))
        return [r.asDict() for r in kept.collect()]  # one row for each run

    def version(self, artifact: str, run_id: str | None = None) -> dict | None:
        """Manifest row of a run's version, or of the current one; None if there is none."""
        found = self.versions(artifact)
        if run_id is not None:
            found = [r for r in found if r["run_id"] == run_id]
        return found[0] if found else None

    def artifacts(self, run_id: str) -> dict[str, str]:
        """Path of every artifact of a run that can still be read."""
        names = [r[0] for r in self._rows().where(F.col("run_id") == run_id).select("artifact").distinct().collect()]
        found = {name: self.version(name, run_id) for name in sorted(names)}
        return {name: row["path"] for name, row in found.items() if row}

    def rollback(self, run_id: str) -> None:
        """Make all artifacts of an earlier run current again, at once."""
        known = self.artifacts(run_id)
        if not known:
            raise FileNotFoundError(f"no published run {run_id} under {self.root}")
        self._append([(run_id, name, path, "rollback") for name, path in known.items()])

    def prune(self, artifact: str, keep: int = 2) -> list[str]:
        """Remove all but the ``keep`` newest versions; returns the removed runs.

        The manifest loses sight of a run before its folder goes, so a reader
        never finds a path without files. Folders of runs that were never
        published go only if a version was published under a later run id (run
        ids in order of time): a run still being written is left alone.
        """
        if keep < 1:
            raise ValueError("the current version stays")
        found = self.versions(artifact)
        gone = found[keep:]
        if gone:
            self._append([(r["run_id"], artifact, None, "removed") for r in gone])
        published = {r[0] for r in self._rows().where(F.col("artifact") == artifact).select("run_id").distinct().collect()}
        at = [name.removeprefix("run_id=") for name in folders(self.spark, f"{self.root}/{artifact}")]
        newest = max((r["run_id"] for r in found), default="")
        stale = [run for run in at if run not in published and run < newest]
        removed = [r["run_id"] for r in gone] + stale
        for run in removed:
            remove_path(self.spark, self.path(artifact, run))
        return removed

    def refuse_published(self, artifact: str, run_id: str) -> None:
        taken = (F.col("artifact") == artifact) & (F.col("run_id") == run_id)
        if not self._rows().where(taken).isEmpty():
            raise FileExistsError(f"run {run_id} of {artifact} is published; write under another run id")

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")

    def current(self, artifact: str) -> dict | None:
        """Manifest row of the version in use; None if there is none."""
        return self.version(artifact)

    def _found(self, artifact: str, run_id: str | None) -> str:
        row = self.version(artifact, run_id)
        if row is None:
            asked = f"run {run_id}" if run_id else "published version"
            raise FileNotFoundError(f"no {asked} of {artifact} under {self.root}")
        return row["path"]

    def read(self, artifact: str, schema: T.StructType | None = None, run_id: str | None = None) -> DataFrame:
        """The version in use, or that of a run."""
        path = self._found(artifact, run_id)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(path)

    def read_report(self, artifact: str, schema: T.StructType | str | None = None, run_id: str | None = None) -> DataFrame:
        path = self._found(artifact, run_id)
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.json(path)
