"""Loading rules for raw (all-string) fact rows: missing values, dates, numerics.

Semantics, in order:
  1. missing required values are counted (before anything is dropped) and
     those rows are excluded;
  2. dates are parsed with the configured strptime pattern; failures are
     counted with the first five (row position after step 1, raw value) and
     excluded;
  3. numeric columns are coerced; failures are counted with the first five
     raw values and become NULL, the row is kept.

The rows are read once.  All counts are observed while the numbers and
failing values of the rows kept by step 1 are written as a narrow table
(``quality_pass``); the examples are the first five rows of each field in
that table (a window whose limit is pushed below its shuffle), and the row
position of a date example is a count over it.  ``load_clean`` observes the
same counts while it writes the typed rows.  An observed count is exact
because it stands in the job's last stage, where each partition counts once,
whatever tasks are repeated.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.params import NA_STRINGS, NUMERIC_FIELDS, Params
from adlens.session import cut_lineage, fresh_folder

ORD = "row_ord"
#: Decimal literals (a cast alone would also take suffixes and hexadecimal digits).
NUMBER = r"^[ \t\r\n]*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)[ \t\r\n]*$"
N_EXAMPLES = 5


class MissingColumnsError(ValueError):
    def __init__(self, missing, required):
        super().__init__(f"Missing required fields in dataset: {list(missing)}")
        self.missing_fields = list(missing)
        self.required_fields = list(required)


class MissingShareError(ValueError):
    """A required field is missing in more than the allowed share of all rows; ``shares`` has all that are."""

    def __init__(self, shares: dict, limit: float):
        super().__init__(f"Missing values above {limit:.0%} of all rows: "
                         + ", ".join(f"{k} {v:.2%}" for k, v in sorted(shares.items())))
        self.shares, self.limit = shares, limit


def check_required(df: DataFrame, required) -> None:
    """Raise with the full list of absent required columns."""
    missing = [f for f in required if f not in df.columns]
    if missing:
        raise MissingColumnsError(missing, required)


def with_ordinal(raw: DataFrame) -> DataFrame:
    """Add an input ordinal (file order) when the frame has none."""
    if ORD in raw.columns:
        return raw
    return raw.withColumn(ORD, F.monotonically_increasing_id())


def normalize_na(raw: DataFrame) -> DataFrame:
    """Turn the usual CSV missing-value markers into NULL in every string column."""
    na = list(NA_STRINGS)
    cols = []
    for f in raw.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(na), F.lit(None).cast("string")).otherwise(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def _parsed_date(df: DataFrame, fmt: str) -> Column:
    dtype = df.schema["date"].dataType
    if isinstance(dtype, T.DateType):
        return F.col("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.col("date").cast("date")
    return F.try_to_date(F.col("date").cast("string"), fmt)


def _coerced(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        x = F.col(name).cast("double")
    else:
        return F.when(F.col(name).rlike(NUMBER), F.expr(f"try_cast(`{name}` AS DOUBLE)"))     # NUMBER has no NaN
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


class Cleaned:
    """Result of the loading rules; each table is built lazily on first access."""

    def __init__(self, flags: DataFrame, numeric_fields: list, required: list):
        self.flags = flags                    # raw rows + flag columns (internal)
        self.numeric_fields = numeric_fields
        self.required = required
        self._cache: dict = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def clean(self) -> DataFrame:
        """Typed rows that survived."""
        return self._get("clean", lambda: clean_rows(self.flags, self.numeric_fields))

    @property
    def profile(self) -> DataFrame:
        """One row of counts."""
        return self._get("profile", lambda: quality_profile(self.flags, self.numeric_fields, self.required))

    @property
    def issues(self) -> DataFrame:
        """Issue rows (ord, issue_type, field, count, action, examples)."""
        return self._get("issues", lambda: quality_issues(self.flags, self.numeric_fields, self.required))


def flag_rows(raw: DataFrame, params: Params = Params()) -> tuple[DataFrame, list]:
    required = list(params.required_fields)
    check_required(raw, required)
    df = normalize_na(with_ordinal(raw))
    numeric = [f for f in NUMERIC_FIELDS if f in df.columns]
    missing_any = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in required])
    parsed = _parsed_date(df, params.spark_date_format)
    cols = [F.col(f"`{c}`") for c in df.columns]
    cols += [missing_any.alias("_missing"), parsed.alias("_date")]
    cols += [_coerced(df, f).alias(f"_num_{f}") for f in numeric]
    flagged = df.select(*cols)
    flagged = flagged.withColumns({
        "_q2": ~F.col("_missing"),
        "_date_fail": ~F.col("_missing") & F.col("_date").isNull(),
        "_keep": ~F.col("_missing") & F.col("_date").isNotNull(),
    })
    flagged = flagged.withColumns({
        f"_fail_{f}": F.col("_keep") & F.col(f).isNotNull() & F.col(f"_num_{f}").isNull()
        for f in numeric})
    return flagged, numeric


def clean_rows(flagged: DataFrame, numeric: list) -> DataFrame:
    """Surviving rows with a DATE column and DOUBLE numerics (NULL where coercion failed)."""
    out = []
    for c in flagged.columns:
        if c.startswith("_"):
            continue
        if c == "date":
            out.append(F.col("_date").alias("date"))
        elif c in numeric:
            out.append(F.col(f"_num_{c}").alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return flagged.where("_keep").select(*out)


def quality_profile(flagged: DataFrame, numeric: list, required: list) -> DataFrame:
    """One fused aggregate: raw rows, per-field missing, date and numeric failures, kept rows."""
    return flagged.agg(*_profile_aggregates(numeric, required))


def _profile_aggregates(numeric: list, required: list) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("raw_rows")]
    aggs += [F.count_if(F.col(f).isNull()).alias(f"missing_{f}") for f in required]
    aggs += [F.count_if("_date_fail").alias("date_failures")]
    aggs += [F.count_if(f"_fail_{f}").alias(f"nonnum_{f}") for f in numeric]
    aggs += [F.count_if("_keep").alias("clean_rows")]
    return aggs


def _observed(spark, seen: Observation, numeric: list, required: list) -> DataFrame:
    """The one row of counts that a finished job has observed."""
    names = ["raw_rows", *[f"missing_{f}" for f in required], "date_failures", *[f"nonnum_{f}" for f in numeric], "clean_rows"]
    found = seen.get
    return spark.createDataFrame([tuple(int(found.get(n, 0)) for n in names)], ", ".join(f"`{n}` bigint" for n in names))


def quality_pass(flagged: DataFrame, numeric: list, required: list) -> tuple[DataFrame, DataFrame]:
    """One scan: (one row of counts, rows kept by step 1 as (o, fails)).

    ``o`` is a row's ordinal and ``fails`` the fields whose value did not
    parse, with the values; null for most rows.  The second table is written
    in the shared folder, so the counts are there as well.
    """
    seen = Observation()
    failed = {"date": F.col("_date_fail")} | {f: F.col(f"_fail_{f}") for f in numeric}
    values = F.filter(F.array(*[F.when(cond, F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")))
                                for f, cond in failed.items()]), lambda x: x.isNotNull())
    anything = reduce(lambda a, b: a | b, failed.values())
    rows = (flagged.observe(seen, *_profile_aggregates(numeric, required)).where("_q2")
            .select(F.col(ORD).alias("o"), F.when(anything, values).alias("fails")))
    rows = cut_lineage(rows)
    return _observed(flagged.sparkSession, seen, numeric, required), rows


def load_clean(flagged: DataFrame, numeric: list, required: list, path: str | None = None,
               max_missing: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Write the surviving rows; (the rows read back, the one row of counts), from one scan of the raw rows.

    With ``max_missing``, required fields that lack more than that share of
    all rows raise ``MissingShareError``: what was written then counts for
    nothing, and a commit that comes after it is not made.
    """
    seen = Observation()
    clean = clean_rows(flagged.observe(seen, *_profile_aggregates(numeric, required)), numeric)
    path = path or fresh_folder(flagged.sparkSession, "clean")
    clean.write.parquet(path)
    if max_missing is not None:
        check_missing(seen.get, required, max_missing)
    return (flagged.sparkSession.read.schema(clean.schema).parquet(path),
            _observed(flagged.sparkSession, seen, numeric, required))


def check_missing(counts: dict, required: list, limit: float) -> None:
    """Raise if a required field is missing in more than ``limit`` of all rows; no rows pass."""
    n = counts.get("raw_rows", 0)
    over = {f: counts[f"missing_{f}"] / n for f in required if n and counts[f"missing_{f}"] > limit * n}
    if over:
        raise MissingShareError(over, limit)


def first_failures(rows: DataFrame) -> DataFrame:
    """First five failing values of every field, from the table of ``quality_pass``: (field, pos, o, value).

    Every partition keeps its first five of a field before the shuffle, so a
    field that fails on a third of all rows costs no more than another.
    """
    fails = rows.where("fails IS NOT NULL").select("o", F.explode("fails").alias("e")).select("o", "e.field", "e.value")
    ranked = fails.withColumn("rank", F.row_number().over(Window.partitionBy("field").orderBy("o"))).where(F.col("rank") <= N_EXAMPLES)
    return ranked.select("field", (F.col("rank") - 1).alias("pos"), "o", "value")


def _date_positions(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """One row with ``dates``: an array of (row, value), row = rows kept by step 1 before the example."""
    at = firsts.where("field = 'date'").agg(F.sort_array(F.collect_list(F.struct("pos", "o", "value")))).scalar()
    before = [F.count_if(F.col("o") < F.get(F.col("_at"), F.lit(i)).getField("o")).alias(f"_before_{i}") for i in range(N_EXAMPLES)]
    counted = rows.select("o", at.alias("_at")).agg(*before, F.first("_at").alias("_at"))
    dates = F.transform(F.col("_at"), lambda e, i: F.struct(
        F.get(F.array(*[F.col(f"_before_{k}") for k in range(N_EXAMPLES)]), i).alias("row"), e["value"].alias("value")))
    return counted.select(F.coalesce(dates, F.array().cast(_EX_TYPE)).alias("dates"))


def _local(firsts: DataFrame) -> DataFrame:
    """At most five rows of each field, brought to the driver once instead of computed for each use."""
    return firsts.sparkSession.createDataFrame(firsts.collect(), firsts.schema)


def date_examples(flagged: DataFrame) -> DataFrame:
    """First five unparsable dates: (pos, row, value), row = position among rows kept by step 1."""
    _, rows = quality_pass(flagged, [], [])
    found = _date_positions(rows, _local(first_failures(rows)))
    return found.select(F.posexplode("dates").alias("pos", "e")).select("pos", "e.row", "e.value")


def numeric_examples(flagged: DataFrame, numeric: list) -> DataFrame:
    """First five raw values per numeric field that failed coercion: (field, pos, value)."""
    _, rows = quality_pass(flagged, numeric, [])
    return first_failures(rows).where("field <> 'date'").select("field", "pos", "value")


_EX_TYPE = "array<struct<row:bigint,value:string>>"
ISSUE_SCHEMA = f"ord int, issue_type string, field string, count bigint, action string, examples {_EX_TYPE}"


def quality_issues(flagged: DataFrame, numeric: list, required: list,
                   with_examples: bool = True) -> DataFrame:
    """Issue rows in reference order: missing values, invalid dates, non-numeric values.

    One scan of the raw rows (``quality_pass``); the examples and their
    positions come from the narrow table that it writes.
    """
    if not with_examples:
        return _issue_rows(quality_profile(flagged, numeric, required), numeric, required)
    counts, rows = quality_pass(flagged, numeric, required)
    firsts = _local(first_failures(rows))
    issues = _issue_rows(counts, numeric, required)
    dates = _date_positions(rows, firsts).scalar()
    values = firsts.where("field <> 'date'").groupBy("field").agg(
        F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("a")).select(
        F.col("field").alias("_field"),
        F.transform("a", lambda e: F.struct(F.lit(None).cast("bigint").alias("row"), e["value"].alias("value"))).alias("_values"))
    found = (F.when(F.col("issue_type") == "invalid_dates", dates)
             .when(F.col("issue_type") == "non_numeric_values", F.col("_values")))
    return (issues.join(values, F.col("field") == F.col("_field"), "left")
            .select("ord", "issue_type", "field", "count", "action",
                    F.coalesce(found, F.array()).cast(_EX_TYPE).alias("examples")))


def _issue_rows(prof: DataFrame, numeric: list, required: list) -> DataFrame:
    """One row per issue that occurs, from the one row of counts."""
    rows = []
    for i, f in enumerate(required):
        rows.append((i, "missing_values", f, f"missing_{f}", "excluded_rows"))
    rows.append((len(required), "invalid_dates", None, "date_failures", "excluded_rows"))
    for j, f in enumerate(numeric):
        rows.append((len(required) + 1 + j, "non_numeric_values", f, f"nonnum_{f}", "converted_to_nan"))
    structs = [F.struct(F.lit(o).alias("ord"), F.lit(t).alias("issue_type"),
                        F.lit(f).cast("string").alias("field"),
                        F.col(c).cast("bigint").alias("count"), F.lit(a).alias("action"))
               for o, t, f, c, a in rows]
    return prof.select(F.explode(F.array(*structs)).alias("i")).select("i.*").where(F.col("count") > 0)


def clean(raw: DataFrame, params: Params = Params()) -> Cleaned:
    """Apply the loading rules; every part is a lazy DataFrame."""
    flagged, numeric = flag_rows(raw, params)
    return Cleaned(flagged, numeric, list(params.required_fields))


def lenient(raw: DataFrame, params: Params = Params()) -> DataFrame:
    """Coerce-only load: dates and numerics cast (failures -> NULL), no row dropped."""
    df = normalize_na(raw)
    cols = []
    for c in df.columns:
        if c == "date":
            dtype = df.schema["date"].dataType
            cols.append((F.col("date") if isinstance(dtype, T.DateType)
                         else F.try_to_date(F.col("date").cast("string"))).alias("date"))
        elif c in NUMERIC_FIELDS:
            cols.append(_coerced(df, c).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return df.select(*cols)


def invalid_rows(profile: DataFrame, numeric: list, required: list) -> DataFrame:
    """One row: invalid_rows (sum of issue counts), raw_rows, clean_rows, rows_removed."""
    parts = ([F.col(f"missing_{f}") for f in required] + [F.col("date_failures")]
             + [F.col(f"nonnum_{f}") for f in numeric])
    total = reduce(lambda a, b: a + b, parts)
    return profile.select(total.cast("bigint").alias("invalid_rows"), "raw_rows", "clean_rows",
                          (F.col("raw_rows") - F.col("clean_rows")).alias("rows_removed"))
