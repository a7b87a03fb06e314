"""All-or-nothing outputs: folders that count only once a log names them.

A writer puts its tables into a folder of its own and then appends one row to
the log of commits, which Spark's output commit makes visible as a whole.  A
reader looks up the newest fitting row and reads that folder.  A writer that
fails leaves a folder that no row names; the former output stays what readers
see.  Two writers at once are both kept, and the later row wins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import folder_exists, remove_folder

_ENTRY = "commit_no long, committed_at timestamp, key string, folder string, about string"


class Commits:
    """The commits under ``root``, a folder that every executor reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> DataFrame | None:
        folder = f"{self.root}/commits"
        return self.spark.read.schema(_ENTRY).json(folder) if folder_exists(self.spark, folder) else None

    def latest(self, key: str | None = None) -> tuple[str, dict] | None:
        """(folder, what was said about it) of the newest commit, of ``key`` if given."""
        log = self._log()
        if log is None:
            return None
        rows = log if key is None else log.where(F.col("key") == key)
        row = rows.orderBy(F.desc("commit_no"), F.desc("committed_at"), F.desc("folder")).first()
        return None if row is None else (row["folder"], json.loads(row["about"]))

    def write(self, key: str, tables: Callable[[str], dict]) -> tuple[str, dict]:
        """Call ``tables`` with a new folder, in which it writes whatever belongs together and returns
        what is to be said about it; then commit.  Nothing is committed if it raises."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        about = tables(folder)
        log = self._log()
        number = 0 if log is None else (log.agg(F.max("commit_no")).first()[0] or 0)
        (self.spark.range(1).select(F.lit(number + 1).cast("long").alias("commit_no"), F.current_timestamp().alias("committed_at"),
                                    F.lit(key).alias("key"), F.lit(folder).alias("folder"), F.lit(json.dumps(about)).alias("about"))
         .coalesce(1).write.mode("append").json(f"{self.root}/commits"))
        return folder, about

    def drop_older(self, keep: int = 2) -> int:
        """Remove the data of all but the newest ``keep`` commits (readers of the one before the last go on); how many."""
        log = self._log()
        if log is None:
            return 0
        old = [r["folder"] for r in log.orderBy(F.desc("commit_no"), F.desc("committed_at"), F.desc("folder")).collect()[keep:]]
        return sum(remove_folder(self.spark, f) for f in old)
