import re
from collections import Counter

from adlens.llm import quality as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


TEXTS = ["", "a b c d e", "a b c d e a b c d e", "a a a a a a a a", "x y\nx y\n\n \nx y", "#*$ %&| <> é😀 \x0b b\x0cc\rd",
         " ".join(f"w{i % 9}" for i in range(200)), " ".join(f"w{i}" for i in range(200)),
         "A b c d e f A b c d e f q"]


def test_features_equal_brute_force(spark):
    got = {r["k"]: r for r in Q.with_features(spark.createDataFrame(list(enumerate(TEXTS)), "k long, text string")).collect()}
    for k, t in enumerate(TEXTS):
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(t), t


def test_order_is_by_rejections_per_cost_and_leaves_verdicts(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "x long")
    rules = (Q.Rule("dear", "x < 60", "100"), Q.Rule("cheap", "x < 50", "1"), Q.Rule("never", "x < 0", "1"))
    order = [x["rule"].name for x in Q.rule_order(df, rules)]
    assert order == ["cheap", "dear", "never"]
    for given in (rules, rules[::-1]):
        assert Q.cascade(df, list(given)).where("failed_rule is null").count() == 40


def test_early_rules_spare_later_ones(spark):
    df = spark.createDataFrame([(1,), (2,)], "x long")
    rules = [Q.Rule("first", "x > 0", "1"), Q.Rule("second", "raise_error('evaluated') is null", "1")]
    assert {r["failed_rule"] for r in Q.cascade(df, rules).collect()} == {"first"}


def test_messy_and_empty(messy):
    rows = Q.quality_verdicts(messy).collect()
    assert len(rows) == messy.count()
    none = [r for r in rows if r["doc_id"] == 2][0]
    assert (none["n_words"], none["n_repeat_words"], none["failed_rule"]) == (0, 0, "few_words")
    assert Q.quality_verdicts(messy.limit(0)).count() == 0
    assert Q.quality_verdicts(messy, rules=()).where("failed_rule is not null").count() == 0


def _boom():
    from pyspark.sql import functions as F
    return F.raise_error(F.lit("computed")).cast("long")


def test_features_of_later_rules_are_not_computed_for_rejected_rows(spark, monkeypatch):
    monkeypatch.setitem(Q.FEATURES, "n_boom", _boom)
    df = spark.createDataFrame([("some text",), (None,), ("",)], "text string").selectExpr("coalesce(text, '') AS _t")
    rules = [Q.Rule("all", "n_words >= 0"), Q.Rule("boom", "n_boom > 0")]
    assert {r["failed_rule"] for r in Q.lazy_cascade(df, rules).select("failed_rule").collect()} == {"all"}
    import pytest
    with pytest.raises(Exception, match="computed"):
        Q.lazy_cascade(df, rules[::-1]).select("failed_rule").collect()
    some = [Q.Rule("empty", "n_words < 1"), Q.Rule("boom", "n_boom > 0")]
    with pytest.raises(Exception, match="computed"):          # one row still stands
        Q.lazy_cascade(df, some).select("failed_rule").collect()


def test_verdicts_do_not_depend_on_the_order(spark):
    import itertools
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("doc_id", "text AS _t")
    verdicts = [{r["doc_id"] for r in Q.lazy_cascade(df, list(p)).where("failed_rule is null").select("doc_id").collect()}
                for p in list(itertools.permutations(Q.BASE_RULES + Q.EXTRA_RULES))[::97]]
    assert all(v == verdicts[0] for v in verdicts)


def test_costs_are_measured_and_the_sample_is_bounded(spark):
    long = " ".join(f"w{i}" for i in range(2000)) + " W"
    rows = spark.range(4000).selectExpr("id AS doc_id", f"concat('{long} ', id) AS _t")
    sample = Q.sample_of(rows, 200)
    assert 100 < sample.count() < 400 and len({r[0] // 1000 for r in sample.select("doc_id").collect()}) == 4      # from all over
    rules = (Q.Rule("cheap", "n_chars < 0"), Q.Rule("dear", "n_repeat_words < 0"))
    cheap, dear = Q.measured_costs(sample, rules)
    assert 0 < cheap < dear
    order = [x["rule"].name for x in Q.rule_order(Q._with(sample, list(Q.FEATURES)), (
        Q.Rule("dear", "n_repeat_words >= 0"), Q.Rule("cheap", "n_chars >= 0")), [dear, cheap])]
    assert order == ["cheap", "dear"]


def test_a_verdict_without_features(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    a = {r["doc_id"]: r["failed_rule"] is None for r in Q.quality_verdicts(df, returned=()).collect()}
    b = {r["doc_id"]: r["failed_rule"] is None for r in Q.quality_verdicts(df).collect()}
    assert a == b and len(a) == len(TEXTS)
