"""Quality rules as a short-circuit cascade.

Every rule rejects a row by a condition over features of its text.  A feature
is computed when the first rule that reads it is reached, and only for rows
that no rule has rejected yet; features that the caller wants returned are
computed for every row, before all rules.

``rule_order`` estimates on a bounded sample of texts what each rule costs
(the time that its features take there, unless they are returned and so computed anyway) and
how often it rejects, and orders the rules by rejections per cost.  The order
changes the cost and the name of the first failing rule, never the verdict.

Only DataFrame functions are used; all features of a text are computed inside
its own row, so there is no shuffle at all.  Repeated five-word windows are
found on 64-bit window hashes: a text without repeats is settled by a hash
set, others by one sort of (hash, position), both near linear in its length.

Defined results: null text counts as empty; an empty text has zero features
and fails the base rule on words; repeated rows get equal verdicts; an empty
table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, let, written

#: Rows of the sample that orders the rules (on average); it has no influence on verdicts.
SAMPLE_ROWS = 2000
#: Times that the cost of a rule is measured; the least counts.
MEASURED = 3
#: Seconds that a comparison of features counts.
COMPARISON = 1e-4
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over features, ``cost`` SQL for the units of work it takes on a row where it is not measured."""

    name: str
    rejects: str
    cost: str = "1"

    def reads(self) -> list[str]:
        """The features that the rule needs."""
        return [f for f in FEATURES if re.search(rf"\b{f}\b", self.rejects)]


#: The base rules first; limits of the others are those common for web text.
BASE_RULES = (
    Rule("few_words", "n_words < 10", "n_chars"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words", "n_chars + 40 * n_words"),
)
EXTRA_RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "2 * n_chars"),
    Rule("duplicate_lines", "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines", "n_chars + 20 * n_lines"),
    Rule("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words)", "n_chars"),
    Rule("shouting", "2 * n_caps > word_chars and n_words > 0", "3 * n_chars"),
)


def _without(text: Column, chars: str) -> Column:
    """Bytes of a text that are none of some ASCII characters."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return F.octet_length(text)


def _repeat_words(words: Column) -> Column:
    """Words inside five-word windows that occur twice or more, the first included."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def of_windows(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of_sorted(p: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(p, i)["h"] == F.get(p, j)["h"], F.lit(False))
            hit = F.filter(p, lambda x, i: same(i, i - 1) | same(i, i + 1))
            at = F.sort_array(F.transform(hit, lambda x: x["i"]))
            return let(at, lambda a: F.aggregate(
                F.transform(a, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(a, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("long"), lambda s, x: s + x))

        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(pairs, of_sorted))

    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) > WINDOW, let(windows, of_windows)).otherwise(F.lit(0).cast("long"))


#: Arrays that features share, and the features, as expressions over the text ``_t`` and those arrays.
ARRAYS = {
    "_w": lambda: F.filter(F.split("_t", SPACE_CLASS + "+"), lambda w: w != ""),
    "_l": lambda: F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
}
FEATURES = {
    "n_chars": lambda: F.char_length("_t").cast("long"),
    "n_words": lambda: F.size("_w").cast("long"),
    "n_lines": lambda: F.size("_l").cast("long"),
    "word_chars": lambda: (F.char_length("_t") - F.octet_length("_t") + _without(F.col("_t"), " \t\n\x0b\x0c\r")).cast("long"),
    "n_symbols": lambda: (F.octet_length("_t") - _without(F.col("_t"), SYMBOLS)).cast("long"),
    "n_dup_lines": lambda: (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
    "n_caps": lambda: F.char_length(F.regexp_replace("_t", r"\P{Lu}+", "")).cast("long"),
    "n_repeat_words": lambda: _repeat_words(F.col("_w")),
}
_NEEDS = {"n_words": "_w", "n_repeat_words": "_w", "n_lines": "_l", "n_dup_lines": "_l"}
#: The features that a verdict comes with.
RETURNED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _with(df: DataFrame, names, standing: Column | None = None) -> DataFrame:
    """``df`` with the named features, where ``standing`` holds (null elsewhere); those it has stay."""
    def column(expression: Column) -> Column:
        return expression if standing is None else F.when(standing, expression)

    arrays = [a for a in dict.fromkeys(_NEEDS.get(n) for n in names) if a and a not in df.columns]
    if arrays:
        df = df.withColumns({a: column(ARRAYS[a]()) for a in arrays})
    new = [n for n in names if n not in df.columns]
    return df.withColumns({n: column(FEATURES[n]()) for n in new}) if new else df


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the feature columns of its texts."""
    df = docs.withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))
    return _with(df, list(FEATURES)).drop("_t", *ARRAYS)


def measured_costs(sample: DataFrame, rules: tuple[Rule, ...], returned: tuple[str, ...] = ()) -> list[float]:
    """Seconds that each rule's features take on ``sample`` (column ``_t``) beyond reading it; the ``returned``
    features are there anyway and cost a rule only ``COMPARISON``."""
    def seconds(names: list[str]) -> float:
        took = []
        for _ in range(MEASURED):
            began = time.perf_counter()
            _with(sample, names).agg(F.sum(F.octet_length("_t")), *[F.sum(F.col(n)) for n in names]).collect()
            took.append(time.perf_counter() - began)
        return min(took)

    own = [sorted(set(r.reads()) - set(returned)) for r in rules]
    if not any(own):
        return [COMPARISON] * len(rules)
    least = seconds([])
    return [max(seconds(n) - least, 0.0) + COMPARISON if n else COMPARISON for n in own]


def rule_order(sample: DataFrame, rules: tuple[Rule, ...], costs: list[float] | None = None) -> list[dict]:
    """The rules by rejections per unit of cost on ``sample`` (feature columns), best first.

    ``costs`` are those of ``measured_costs``; without them the rules' own formulas count.
    Only one row of averages reaches the driver.  An empty sample keeps the given order.
    """
    sums = sample.agg(*[
        x for i, r in enumerate(rules) for x in (
            F.avg(F.expr(f"cast({r.rejects} as int)")).alias(f"rejects_{i}"),
            F.avg(F.expr(f"cast({r.cost} as double)")).alias(f"cost_{i}"))]).first() if rules else {}
    found = [{"rule": r, "rejects": sums[f"rejects_{i}"] or 0.0,
              "cost": costs[i] if costs else max(sums[f"cost_{i}"] or 1.0, 1.0)} for i, r in enumerate(rules)]
    return sorted(found, key=lambda x: -x["rejects"] / x["cost"])


def cascade(features: DataFrame, rules: list[Rule], failed: str = "failed_rule") -> DataFrame:
    """``features`` with the first of the ordered rules that rejects the row, null for rows that pass all."""
    verdict = None
    for r in rules:
        verdict = F.when(F.expr(r.rejects), r.name) if verdict is None else verdict.when(F.expr(r.rejects), r.name)
    return features.withColumn(failed, F.lit(None).cast("string") if verdict is None else verdict)


def lazy_cascade(df: DataFrame, rules: list[Rule], failed: str = "failed_rule") -> DataFrame:
    """``df`` (text ``_t`` and the features it has) with the first rule that rejects each row.

    Each rule's missing features are computed behind the condition that the
    row still stands, so a rejected row pays for nothing that comes later.
    """
    df = df.withColumn(failed, F.lit(None).cast("string"))
    standing = F.col(failed).isNull()
    for r in rules:
        df = _with(df, r.reads(), standing)
        df = df.withColumn(failed, F.when(standing & F.expr(r.rejects), F.lit(r.name)).otherwise(F.col(failed)))
    return df


def sample_of(rows: DataFrame, n: int) -> DataFrame:
    """About ``n`` rows from all over the table, written, so that nothing is computed for others."""
    total = rows.count()
    return written(rows if total <= n else rows.sample(min(1.0, n / total), seed=5))


def quality_verdicts(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + EXTRA_RULES, sample_rows: int = SAMPLE_ROWS,
                     id_col: str = "doc_id", text_col: str = "text", returned: tuple[str, ...] = RETURNED) -> DataFrame:
    """doc_id, failed_rule and the ``returned`` features of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    order = list(rules)
    if len(rules) > 1:
        sample = sample_of(rows.select("_t"), sample_rows)
        order = [x["rule"] for x in rule_order(_with(sample, list(FEATURES)), rules, measured_costs(sample, rules, returned))]
    return lazy_cascade(_with(rows, returned), order).select("doc_id", *returned, "failed_rule")
