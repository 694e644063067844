"""Landed extracts: one folder per report period, reused while their sources are unchanged.

An extract is a Parquet table partitioned by ``period``.  Landing a period
overwrites the folder of that period alone (dynamic partition overwrite), and
reading one prunes the others.  Beside the data lies a manifest row for each
(extract, period): a fingerprint of the source files (path, size, time), summed
by Spark over the file listing, and of the parameters.  A later run, in the
same or another application, reads the folder again if the fingerprint is the
same and builds it anew if not.  The manifest is written after the data, so an
interrupted landing is never taken for a complete one.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Changes with any file under ``paths``: count and sums of hashes of (path, size, modification time)."""
    parts = []
    for path in paths:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                 .select("path", "length", "modificationTime"))
        row = files.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime")
                                                           .cast("decimal(38,0)")).alias("h")).first()
        parts.append(f"{path}:{row['n']}:{row['h']}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def period_name(first: dt.date, last: dt.date) -> str:
    return f"{first.isoformat()}_{last.isoformat()}"


class ExtractStore:
    """Extracts by name and period under one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _data(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _manifest(self, name: str, period: str) -> str:
        return f"{self.root}/_manifests/{name}/{period}"

    def fingerprint(self, name: str, period: str) -> str | None:
        """The fingerprint of a landed period; None if it is not there or was never finished."""
        try:
            row = self.spark.read.parquet(self._manifest(name, period)).first()
        except AnalysisException:
            return None
        return row["fingerprint"] if row else None

    def read(self, name: str, period: str, schema=None) -> DataFrame:
        """The rows of one period; only its folder is listed and read."""
        table = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return table.parquet(self._data(name)).where(F.col("period") == period).drop("period")

    def land(self, name: str, period: str, fingerprint: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The extract of ``period``: the landed one if the fingerprint is that of its manifest, else built anew."""
        if self.fingerprint(name, period) != fingerprint:
            df = build()
            rows = df.withColumn("period", F.lit(period))
            self._delete(self._manifest(name, period))
            if rows.isEmpty():  # no partition is written for no rows: an earlier one must not stay
                self._delete(f"{self._data(name)}/period={period}")
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period")
             .parquet(self._data(name)))
            (self.spark.createDataFrame([(name, period, fingerprint, df.schema.json())],
                                        "name string, period string, fingerprint string, columns string")
             .coalesce(1).write.mode("overwrite").parquet(self._manifest(name, period)))
        from pyspark.sql.types import StringType, StructType
        import json
        landed = self.spark.read.parquet(self._manifest(name, period)).first()
        schema = StructType.fromJson(json.loads(landed["columns"])).add("period", StringType())
        return self.read(name, period, schema)

    def periods(self, name: str) -> list[str]:
        """Finished periods of an extract, oldest first."""
        try:
            rows = self.spark.read.parquet(f"{self.root}/_manifests/{name}/*").select("period").distinct().collect()
        except AnalysisException:
            return []
        return sorted(r["period"] for r in rows)

    def expire(self, name: str, keep: int) -> list[str]:
        """Delete all but the ``keep`` latest periods of an extract; returns what went."""
        known = self.periods(name)
        gone = known[:max(0, len(known) - keep)]
        for period in gone:
            self._delete(self._manifest(name, period))
            self._delete(f"{self._data(name)}/period={period}")
        return gone

    def _delete(self, path: str) -> None:
        """Remove a folder of this store, through the file system that Spark reads it with."""
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
