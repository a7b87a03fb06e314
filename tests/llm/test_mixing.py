import numpy as np
import pytest

from adlens.llm import mixing as M


def cells(spark, rows):
    return spark.createDataFrame(rows, "_source string, _lang string, _topic string, tokens long")


FULL = [(f"s{i}", f"l{j}", f"t{k}", 10 + 7 * i + 13 * j * k + (i * j * k) % 5) for i in range(4) for j in range(3) for k in range(2)]
TARGETS = {"_source": {"s0": 0.1, "s1": 0.2, "s2": 0.3, "s3": 0.4}, "_lang": {"l0": 0.5, "l1": 0.3, "l2": 0.2}, "_topic": {"t0": 0.7, "t1": 0.3}}


def brute(rows, targets, rounds=500):
    """Plain raking over a dict."""
    weight = {r[:3]: float(r[3]) for r in rows}
    for _ in range(rounds):
        for axis, target in enumerate(targets.values()):
            sums = {}
            for k, w in weight.items():
                sums[k[axis]] = sums.get(k[axis], 0) + w
            total = sum(weight.values())
            weight = {k: w * target.get(k[axis], 0) * total / sums[k[axis]] if sums[k[axis]] else 0 for k, w in weight.items()}
    factor = {r[:3]: weight[r[:3]] / r[3] if r[3] else 0 for r in rows}
    return {k: f / max(factor.values()) for k, f in factor.items()}


@pytest.mark.parametrize("bound", [M.DRIVER_CELLS, 0])
def test_both_ways_equal_plain_raking(spark, bound):
    got = {(r["_source"], r["_lang"], r["_topic"]): r["probability"]
           for r in M.raked(cells(spark, FULL), TARGETS, driver_cells=bound, rounds=12).collect()}
    want = brute(FULL, TARGETS)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
    tokens = {r[:3]: r[3] * got[r[:3]] for r in FULL}
    for axis, target in enumerate(TARGETS.values()):
        for value, share in target.items():
            assert abs(sum(t for k, t in tokens.items() if k[axis] == value) / sum(tokens.values()) - share) < 1e-6


def test_values_without_target_or_documents(spark):
    targets = {**TARGETS, "_lang": {"l0": 0.5, "l1": 0.25, "absent": 0.25}}
    got = {(r["_source"], r["_lang"], r["_topic"]): r["probability"] for r in M.raked(cells(spark, FULL), targets).collect()}
    assert all((p == 0) == (k[1] == "l2") for k, p in got.items())
    tokens = {r[:3]: r[3] * got[r[:3]] for r in FULL}
    assert abs(sum(t for k, t in tokens.items() if k[1] == "l0") / sum(tokens.values()) - 2 / 3) < 1e-6


def test_sample_meets_the_targets(spark):
    docs = spark.range(6000).selectExpr(
        "id as doc_id", "concat_ws(' ', array_repeat(concat('wordnr', id % 7), 5 + cast(id % 11 as int))) as text",
        "if(id % 3 = 0, 'big', concat('s', id % 4)) as source", "if(id % 5 < 3, 'en', 'de') as lang")
    celled = M.with_cells(docs)
    table = M.cells_of(celled)
    targets = M.tempered(table, {"_source": 0.5, "_lang": 0.5, "_topic": 0.7})
    rows = M.mixed(celled, table, targets).toPandas()
    assert len(rows) == 6000
    kept = rows[rows["_kept"]]
    for m, target in targets.items():
        got = kept.groupby(m)["_tokens"].sum() / kept["_tokens"].sum()
        assert all(abs(got.get(v, 0) - share) < 0.04 for v, share in target.items())
    again = M.mixed(M.with_cells(docs.repartition(5)), table, targets).where("_kept").count()
    assert again == len(kept)


def test_messy_and_empty(spark, messy):
    celled = M.with_cells(messy)
    table = M.cells_of(celled)
    rows = M.mixed(celled, table, M.tempered(table, {m: 1.0 for m in M.MARGINS})).collect()
    assert len(rows) == messy.count()
    # observed shares as targets: whatever has tokens is kept
    assert all(r["_kept"] and r["_probability"] > 0.999 for r in rows if r["_tokens"])
    none = M.with_cells(messy.limit(0))
    assert M.mixed(none, M.cells_of(none), M.tempered(M.cells_of(none), {m: 0.5 for m in M.MARGINS})).count() == 0
    assert M.topic_of([]) == "topic_none" and M.topic_of([b"aaaaaa", b"bbbbbb", b"bbbbbb"]) == f"topic_{98 * 6 % M.TOPICS}"


@pytest.mark.parametrize("powers, uplift, most", [((0.9, 0.95, 1.0), 1.1, 1.25), ((0.5, 0.7, 0.8), M.UPLIFT, M.MOST)])
def test_one_document_cannot_set_the_rate(spark, powers, uplift, most):
    # a hot source, and one document alone in a source, a null source and a topic of its language
    rows = [(f"s{i}", f"l{j}", f"t{k}", 10 ** 6 * (20 if i == 0 else 1) * (1 + (i + j + k) % 3))
            for i in range(8) for j in range(3) for k in range(2)]
    rows += [("blog", "l0", "t0", 20), ("", "l1", "t1", 20), ("s0", "l2", "rare", 20)]
    table = cells(spark, rows)
    targets = M.tempered(table, dict(zip(M.MARGINS, powers)), uplift)
    total = sum(r[3] for r in rows)
    for axis, target in enumerate(targets.values()):
        assert abs(sum(target.values()) - 1) < 1e-9
        for value, share in target.items():
            assert share <= uplift * sum(r[3] for r in rows if r[axis] == value) / total + 1e-12
    got = {tuple(r)[:3]: r["probability"] for r in M.raked(table, targets, most=most).collect()}
    assert sum(r[3] * got[r[:3]] for r in rows) / total > 0.95 / most
    assert got["blog", "l0", "t0"] > 0.8


def test_a_cell_beside_contradicting_margins_is_held(spark):
    rows = [("a", "x", "t", 500_000), ("b", "x", "u", 500_000), ("b", "x", "t", 20)]
    targets = {"_source": {"a": 0.45, "b": 0.55}, "_lang": {"x": 1.0}, "_topic": {"t": 0.5, "u": 0.5}}
    for bound in (M.DRIVER_CELLS, 0):
        got = {tuple(r)[:3]: r["probability"]
               for r in M.raked(cells(spark, rows), targets, driver_cells=bound, rounds=4, most=1.25).collect()}
        assert sum(r[3] * got[r[:3]] for r in rows) > 0.75 * 1_000_020


def test_both_ways_are_equal_with_cells_without_tokens(spark):
    # the rarest values meet in a cell of empty texts, whose factor would be the largest
    # (its language and topic have tokens elsewhere, so all of its margins step up)
    rows = [(s, g, t, 0 if (s, g, t) == ("s1", "l1", "t1") else 1000 * (9 if s == "s0" else 1) * (9 if g == "l0" else 1))
            for s in ("s0", "s1") for g in ("l0", "l1") for t in ("t0", "t1")]
    rows += [("s2", "l0", "topic_none", 0)]
    targets = {"_source": {"s0": 0.5, "s1": 0.5}, "_lang": {"l0": 0.5, "l1": 0.5}, "_topic": {"t0": 0.5, "t1": 0.5}}
    for most in (float("inf"), 2.0):
        here, apart = ({tuple(r)[:3]: r["probability"] for r in
                        M.raked(cells(spark, rows), targets, driver_cells=bound, rounds=8, most=most).collect()}
                       for bound in (M.DRIVER_CELLS, 0))
        assert here.keys() == apart.keys() == {r[:3] for r in rows}
        assert all(abs(here[k] - apart[k]) < 1e-9 for k in here)
        assert max(p for k, p in apart.items() if k in {r[:3] for r in rows if r[3]}) == 1.0


def test_both_ways_stop_at_the_same_round(spark, monkeypatch):
    # a rare value is far off in its own measure while its share is within the tolerance
    rows = [("big", "x", "t", 10 ** 9), ("big", "y", "t", 10 ** 9), ("rare", "x", "t", 10)]
    targets = {"_source": {"big": 1 - 4e-8, "rare": 4e-8}, "_lang": {"x": 0.5, "y": 0.5}, "_topic": {"t": 1.0}}
    monkeypatch.setattr(M, "TOLERANCE", 1e-6)
    here, apart = ({tuple(r)[:3]: r["probability"] for r in
                    M.raked(cells(spark, rows), targets, driver_cells=bound, rounds=6).collect()}
                   for bound in (M.DRIVER_CELLS, 0))
    assert all(abs(here[k] - apart[k]) < 1e-12 for k in here)
    written = []
    monkeypatch.setattr(M, "written", lambda df, w=M.written: written.append(1) or w(df))
    M._rake_apart(cells(spark, rows), targets, rounds=6)
    assert len(written) == 4        # one round: a table for each margin and the cells


def test_topics_are_clusters_of_words(spark):
    """Three planted vocabularies, whatever the partitions; common words tell nothing."""
    import random
    r = random.Random(3)
    vocabulary = {k: [f"{k}word{i:02d}" for i in range(40)] for k in ("sports", "cooking", "physics")}
    rows = []
    for i in range(600):
        k = r.choice(list(vocabulary))
        rows.append((i, k, " ".join(r.choices(vocabulary[k], k=12) + r.choices(["common", "everyone", "through"], k=12))))
    docs = spark.createDataFrame(rows, "doc_id long, truth string, text string").selectExpr("*", "'s' AS source", "'l' AS lang")
    fitted = M.fit_topics(docs.repartition(5), topics=3, sample=200)
    again = M.fit_topics(docs.coalesce(1), topics=3, sample=200)
    assert np.array_equal(fitted.centres, again.centres) and len(fitted.centres) == 3
    got = M.with_cells(docs, topics=fitted).groupBy("truth", "_topic").count().collect()
    assert len(got) == 3 and len({r["_topic"] for r in got}) == 3
    empty = M.with_cells(docs.limit(2).withColumn("text", __import__("pyspark").sql.functions.lit(None).cast("string")), topics=fitted)
    assert {r["_topic"] for r in empty.collect()} == {"topic_none"}
    assert M.with_cells(docs.limit(0), topics=M.fit_topics(docs.limit(0))).count() == 0


def test_targets_as_tables_equal_those_as_values(spark):
    table = cells(spark, FULL)
    power = {"_source": 0.4, "_lang": 0.5, "_topic": 0.6}
    small, large = M.tempered(table, power, 1.2), M.tempered(table, power, 1.2, driver_cells=0)
    for m in power:
        got = {r[m]: r["share"] for r in large[m].collect()}
        assert got.keys() == small[m].keys() and all(abs(got[k] - small[m][k]) < 1e-9 for k in got)
    a, b = ({(r["_source"], r["_lang"], r["_topic"]): r["probability"] for r in M.raked(table, t, rounds=12).collect()} for t in (small, large))
    assert all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_errors_are_reported(spark):
    table = cells(spark, FULL)
    met = M.reached(table, M.raked(table, TARGETS), TARGETS).collect()
    assert len(met) == 9 and all(r["error"] < 1e-6 for r in met)
    held = M.reached(table, M.raked(table, TARGETS, most=1.01), TARGETS).collect()
    assert max(r["error"] for r in held) > 0.01
    short = M.reached(table, M.raked(table, {**TARGETS, "_lang": {"l0": 0.6, "gone": 0.4}}), {**TARGETS, "_lang": {"l0": 0.6, "gone": 0.4}}).collect()
    assert {r["value"]: round(r["error"], 6) for r in short if r["margin"] == "_lang"} == {"l0": 0.4, "gone": 0.4, "l1": 0.0, "l2": 0.0}


def _two_topics(spark, n):
    """Texts of two vocabularies and, for each hundredth text, of a third: its words are in few texts."""
    rows = [(i, " ".join(f"{'rareone' if i % 100 == 7 else 'sports' if i % 2 else 'cooking'}{(i * 7 + j * 11) % 20:02d}" for j in range(9)) + f" own{i}")
            for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' AS source", "'l' AS lang")


def test_topics_learn_from_all_texts(spark):
    """Weights count every distinct text, beyond any bounded number of them; copies and null texts count once or not at all."""
    docs = _two_topics(spark, 2600)
    fitted = M.fit_topics(docs.unionByName(docs).unionByName(docs.withColumn("text", M.F.lit(None).cast("string"))), topics=2)
    words = [f"{k}{i:02d}" for k in ("sports", "cooking") for i in range(20)]
    texts = [r["text"].encode() for r in docs.select("text").collect()]
    for w in words:
        b = M.zlib.crc32(w.encode()) % M.TOPIC_BUCKETS
        seen = sum(any(M.zlib.crc32(x) % M.TOPIC_BUCKETS == b for x in set(t.split()) if len(x) >= 6) for t in texts)
        assert abs(fitted.weight[b] - np.log(2601 / seen)) < 1e-12


def test_counted_rows_need_no_text(spark):
    docs = _two_topics(spark, 300)
    counted = M.with_counts(docs).drop("text")
    a, b = M.fit_topics(counted, topics=2), M.fit_topics(docs.repartition(3), topics=2)
    assert np.array_equal(a.centres, b.centres) and np.array_equal(a.weight, b.weight)
    one, two = ({r["doc_id"]: (r["_topic"], r["_tokens"], r["_draw"]) for r in M.with_cells(x, topics=a).collect()} for x in (counted, docs))
    assert one == two
    assert {t for i, (t, _, _) in one.items() if i % 100 != 7 and i % 2} != {t for i, (t, _, _) in one.items() if i % 100 != 7 and not i % 2}


def test_a_task_holds_few_entries_at_once(spark, monkeypatch):
    docs = _two_topics(spark, 200)
    whole = M.fit_topics(docs, topics=3)
    import pyarrow as pa
    at = pa.array([np.array(x, np.uint16).tobytes() for x in ([1, 2], [], [3], [1, 3, 5], [4])], pa.binary())[1:]
    n = pa.array([np.array(x, np.float32).tobytes() for x in ([9, 9], [], [2], [1, 2, 1], [3])], pa.binary())[1:]
    monkeypatch.setattr(M, "TOPIC_ENTRIES", 2)
    parts = list(M._vectors(at, n, np.ones(M.TOPIC_BUCKETS)))
    assert [(v.first, v.size, list(v.at)) for v in parts] == [(0, 2, [3]), (2, 1, [1, 3, 5]), (3, 1, [4])]
    assert np.allclose(parts[1].x, np.sqrt([1 / 6, 4 / 6, 1 / 6])) and list(parts[0].there) == [False, True]
    assert len(whole.centres) == 3
