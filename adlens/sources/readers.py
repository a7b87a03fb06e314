"""Readers for the fact table: strict CSV (all strings, cleaned later), lenient
CSV, parquet, or any DataFrame."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators import cleaning
from adlens.params import Params


class DatasetError(ValueError):
    """Missing path, empty file or unreadable dataset."""


#: Quoting as spreadsheets and most writers do it: a quote inside a quoted field is doubled.
QUOTING = {"quote": '"', "escape": '"'}
TOO_LONG, _CUT = ("cut", "drop", "fail"), "_malformed_line"


def read_raw_csv(spark: SparkSession, path: str, too_long: str = "cut", multi_line: bool = False,
                 columns: tuple | None = None) -> DataFrame:
    """Header CSV with every column as STRING (no inference pass over the data).

    Only the header line of one file is inspected to name the columns, and
    none if ``columns`` names them; the scan itself is a normal distributed
    CSV read with column pruning.  A line with too
    few fields has nulls for the rest.  A line with too many is cut to the
    header's fields, dropped, or ends the job (``too_long``).  ``multi_line``
    allows line breaks inside quotes; a file is then one task, so it is for
    many files of moderate size.
    """
    if too_long not in TOO_LONG:
        raise ValueError(f"too_long is one of {TOO_LONG}")
    reader = lambda: spark.read.options(**QUOTING, header=True, multiLine=multi_line)
    try:
        probe = reader().option("inferSchema", False).csv(path) if columns is None else spark.read.text(path)
    except AnalysisException as e:  # path does not exist
        raise DatasetError(f"Dataset file not found: {path}") from e
    cols = list(columns or probe.columns)
    if not cols:
        raise DatasetError(f"Dataset file is empty: {path}")
    schema = ", ".join(f"`{c}` STRING" for c in cols)
    marked = "" if too_long == "cut" else f", `{_CUT}` STRING"
    scan = reader().option("mode", "PERMISSIVE").option("nullValue", None).schema(schema + marked)
    if marked:                                               # all fields of a line are needed to count them
        scan = scan.option("columnNameOfCorruptRecord", _CUT).option("columnPruning", False)
    rows = scan.csv(path)
    # a row's place: its file, the block of it, and the order of reading inside the block
    # (Spark packs blocks into partitions by size, so an id alone is not file order)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at"))
    rows = rows.select("*", place.alias(cleaning.ORD)) if cleaning.ORD not in cols else rows
    if not marked:
        return rows
    # of a marked line, the commas outside quotes are counted (a doubled quote ends one quoted part and begins another)
    commas = F.length(F.regexp_replace(F.regexp_replace(_CUT, '"[^"]*"', ""), "[^,]", ""))
    longer = F.coalesce(commas >= len(cols), F.lit(False))
    if too_long == "drop":
        return rows.where(~longer).drop(_CUT)
    message = F.concat(F.lit(f"Failed to load dataset: a line has more than {len(cols)} fields: "), F.col(_CUT))
    return rows.where(F.when(longer, F.raise_error(message).cast("boolean")).otherwise(True)).drop(_CUT)


def load_strict(spark: SparkSession, path: str, params: Params = Params(), **options) -> cleaning.Cleaned:
    """CSV -> required-column check -> cleaning rules (missing, dates, numerics)."""
    raw = read_raw_csv(spark, path, **options)
    cleaning.check_required(raw, params.required_fields)
    return cleaning.clean(raw, params)


def load_lenient(spark: SparkSession, path: str, params: Params = Params(), **options) -> DataFrame:
    """CSV -> coerced dates/numerics, no row dropped, no date filter."""
    return cleaning.lenient(read_raw_csv(spark, path, **options), params)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        raise DatasetError(f"Dataset file not found: {path}") from e
