"""A loaded dataset kept as a materialised view, and reused while its files stay the same.

The view's key is a fingerprint of the raw files (path, length and time of
change of each) and of the loading parameters.  ``load`` looks the key up in
the log of commits: if it is there, the typed rows, their issues and counts
are read from the view and no raw file is opened; else the raw files are
loaded by one pass, written beside the former view and committed, so readers
switch from one to the other at once.  Appended, replaced or removed files
change the fingerprint; files that change while they are read are loaded
again.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlens.operators import cleaning
from adlens.params import Params
from adlens.sources.commits import Commits
from adlens.sources.readers import DatasetError, load_parquet, read_raw_csv

#: Loads again so many times if files change meanwhile; commits whose data are kept.
ATTEMPTS, KEPT = 3, 2


def fingerprint(spark: SparkSession, path: str) -> str:
    """Files, bytes and two checksums over (path, length, time of change) of all files; contents are not read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        raise DatasetError(f"Dataset file not found: {path}") from e
    about = [F.col("path"), F.col("length"), F.col("modificationTime").cast("double")]
    sums = [F.sum(F.xxhash64(F.lit(seed), *about).cast("decimal(38,0)")) for seed in (1, 2)]
    n, size, a, b = files.select("path", "length", "modificationTime").agg(F.count("*"), F.sum("length"), *sums).first()
    if not n:
        raise DatasetError(f"Dataset file not found: {path}")
    return f"{n}-{size}-{a}-{b}"


@dataclass
class View:
    """A loaded dataset; ``reused`` tells whether the raw files were left alone."""

    clean: DataFrame
    issues: DataFrame
    counts: DataFrame
    folder: str
    reused: bool


def load(spark: SparkSession, path: str, root: str, params: Params = Params(), kind: str = "csv",
         max_missing: float | None = None, **options) -> View:
    """The dataset at ``path`` (``csv`` or ``parquet``), from its view under ``root`` where that is current.

    ``options`` go to ``read_raw_csv``.  With ``max_missing`` a load in which
    a required field lacks more than that share of all rows raises
    ``MissingShareError`` and leaves the former view in place.
    """
    commits = Commits(spark, root)
    for _ in range(ATTEMPTS):
        files = fingerprint(spark, path)
        key = hashlib.sha256(repr((files, params, kind, max_missing, sorted(options.items()))).encode()).hexdigest()
        if found := commits.latest(key):
            return _view(spark, *found, reused=True)
        raw = read_raw_csv(spark, path, **options) if kind == "csv" else load_parquet(spark, path)
        flagged, numeric = cleaning.flag_rows(raw, params)
        required = list(params.required_fields)

        def write(folder: str) -> dict:
            clean, counts = cleaning.load_clean(flagged, numeric, required, f"{folder}/clean", max_missing)
            issues = cleaning.quality_issues(flagged, numeric, required)
            counts.coalesce(1).write.parquet(f"{folder}/counts")
            issues.coalesce(1).write.parquet(f"{folder}/issues")
            if fingerprint(spark, path) != files:
                raise _Changed()
            return {"files": files, "schema": clean.schema.json(), "counts": counts.schema.json()}

        try:
            found = commits.write(key, write)
        except _Changed:
            continue
        commits.drop_older(KEPT)
        return _view(spark, *found, reused=False)
    raise DatasetError(f"Dataset changes while it is read: {path}")


class _Changed(Exception):
    pass


def _view(spark: SparkSession, folder: str, about: dict, reused: bool) -> View:
    schema = {name: StructType.fromJson(json.loads(about[key])) for name, key in (("clean", "schema"), ("counts", "counts"))}
    return View(spark.read.schema(schema["clean"]).parquet(f"{folder}/clean"),
                spark.read.schema(cleaning.ISSUE_SCHEMA).parquet(f"{folder}/issues"),
                spark.read.schema(schema["counts"]).parquet(f"{folder}/counts"), folder, reused)
