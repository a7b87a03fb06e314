"""Class-based language model: base counts and scores against plain Python, the exchange's gains against recomputation."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlens.llm import class_lm as C

SCHEMA = "doc_id long, text string, codes string, n string"


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def training(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 != 1


def plain_base(rows):
    """{row: (n_tokens, n_known, train_tokens, base)} in plain Python."""
    counts = Counter()
    for doc_id, text, *_ in rows:
        if training(doc_id):
            counts.update([*tokens_of(text), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text, *_ in rows:
        own = [*tokens_of(text), None]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((-1 if doc_id is None else doc_id, len(own), sum(counts[t] > 0 for t in own), n, round(base, 6)))
    return sorted(out)


def base_of(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                  for r in df.collect())


def scored(spark, rows, **k):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return C.score_documents(df, C.is_training(F.col("doc_id")), **k)


@pytest.fixture(scope="module")
def corpus():
    """Sentences of article, adjective, noun and verb: classes a bigram model should find."""
    pick = np.random.default_rng(2)
    kinds = [["the", "a"], [f"adj{i}" for i in range(40)], [f"noun{i}" for i in range(60)], [f"verbs{i}" for i in range(50)]]

    def text():
        return " ".join(pick.choice(k) for _ in range(int(pick.integers(1, 12))) for k in kinds)

    rows = [(i, text(), "c", "n") for i in range(400)]
    rows += [(1000, None, "", ""), (1001, "", "", ""), (1002, " \t\n", "", ""), (None, "The A adj1 unheard", "", ""),
             (7, rows[7][1], "", ""), (7, rows[7][1], "", ""), (1003, "never Seen 12 ! ééééééé", "", ""),
             (1004, " ".join(f"w{i % 5000}" for i in range(300_000)), "", "")]
    return rows


def test_base_equals_plain_counting(spark, corpus):
    assert base_of(scored(spark, corpus, rounds=1)) == plain_base(corpus)


def test_few_frequent_words_give_the_same_base(spark, corpus, monkeypatch):
    monkeypatch.setattr(C, "SHARE", 50)                        # nearly all words are joined
    assert base_of(scored(spark, corpus, rounds=1)) == plain_base(corpus)


def test_held_out_perplexity_is_far_below_the_base(spark, corpus):
    rows = [r for r in scored(spark, corpus).collect() if not r["training"] and r["doc_id"] is not None and r["doc_id"] < 400]
    n = sum(r["n_tokens"] for r in rows)
    base, own = (10 ** (-sum(r[c] for r in rows) / n) for c in ("base_score", "score"))
    assert len(rows) > 50 and own < 0.6 * base
    assert all(math.isclose(r["perplexity"], 10 ** (-r["score"] / r["n_tokens"]), rel_tol=1e-9) for r in rows)


def coded(texts, n_words, words):
    """Sequences of codes as the pairs' table has them."""
    return [[n_words, *(words.get(w, n_words + 1 + C.form_of(w)) for w in tokens_of(t)), n_words] for t in texts]


def plain_matrix(sequences, class_of):
    m = np.zeros((C.ALL, C.ALL))
    for s in sequences:
        for a, b in zip(s, s[1:]):
            m[class_of[a], class_of[b]] += 1
    return m


def plain_model(texts_by_id, classes, words):
    """Score of each text, token by token, from dictionaries."""
    n = len(words.words)
    train = [t for d, t in texts_by_id if training(d)]
    counts = Counter(w for t in train for w in tokens_of(t))
    matrix = plain_matrix(coded(train, n, words.words), classes.class_of)
    total, types = matrix.sum(0), np.zeros(C.FORMS)
    for w in counts:
        if w not in words.words:
            types[C.form_of(w)] += 1
    share = (total + 0.5) / (total.sum() + 0.5 * C.ALL)
    out = []
    for _, t in texts_by_id:
        score, before = 0.0, C.END
        for w in [*tokens_of(t), None]:
            code = n if w is None else words.words.get(w, n + 1 + C.form_of(w))
            c = classes.class_of[code]
            score += math.log10((matrix[before, c] + C.PRIOR * share[c]) / (matrix[before].sum() + C.PRIOR))
            if w is not None and w in words.words:
                score += math.log10(counts[w] / total[c])
            elif w is not None:
                f = C.form_of(w)
                unseen = (types[f] + 0.5) / (total[c] + types[f] + 1)
                score += math.log10((1 - unseen) * counts[w] / total[c] if counts[w] else unseen)
            before = c
        out.append(score)
    return out


def test_scores_equal_the_model_token_by_token(spark, corpus, monkeypatch):
    kept = {}
    build = C.build
    monkeypatch.setattr(C, "SHARE", 10_000)
    monkeypatch.setattr(C, "build", lambda words, classes, types: kept.update(words=words, classes=classes) or build(words, classes, types))
    got = sorted((r["n_tokens"], round(r["score"], 5)) for r in scored(spark, corpus).collect())
    texts = [(d, t) for d, t, *_ in corpus]
    want = plain_model(texts, kept["classes"], kept["words"])
    assert got == sorted((len(tokens_of(t)) + 1, round(s, 5)) for (_, t), s in zip(texts, want))
    history = kept["classes"].history
    assert len(history) > 1 and all(a < b for a, b in zip(history, history[1:]))
    n = len(kept["words"].words)
    matrix = plain_matrix(coded([t for d, t in texts if training(d)], n, kept["words"].words), kept["classes"].class_of)
    assert np.array_equal(matrix, kept["classes"].matrix) and math.isclose(C.likelihood(matrix), history[-1], rel_tol=1e-12)


def test_gains_equal_recomputed_likelihoods():
    """Every move of every word, against the likelihood of the matrix counted anew."""
    pick = np.random.default_rng(4)
    n = 30
    sequences = [[n, *pick.integers(0, n, size=15).tolist(), n + 1 + int(pick.integers(0, C.FORMS)), 3, 3, n] for _ in range(40)]
    class_of = np.concatenate([np.arange(n) % C.CLASSES % 7, [C.END], C.CLASSES + np.arange(C.FORMS)])
    matrix = plain_matrix(sequences, class_of)
    pairs = Counter((a, b) for s in sequences for a, b in zip(s, s[1:]))
    for w in range(n):
        right, left, itself = np.zeros((1, C.ALL)), np.zeros((1, C.ALL)), np.zeros(1)
        for (a, b), k in pairs.items():
            if a == b == w:
                itself[0] += k
            elif a == w:
                right[0, class_of[b]] += k
            elif b == w:
                left[0, class_of[a]] += k
        gains = C.move_gains(class_of[[w]], right, left, itself, matrix)[0]
        for to in (0, 3, 6, 20):
            moved = class_of.copy()
            moved[w] = to
            want = C.likelihood(plain_matrix(sequences, moved)) - C.likelihood(matrix)
            assert math.isclose(gains[to] - gains[class_of[w]], want, rel_tol=1e-9, abs_tol=1e-7)


def test_probabilities_of_the_vocabulary_sum_to_one(spark, corpus, monkeypatch):
    kept = {}
    build = C.build
    monkeypatch.setattr(C, "SHARE", 10_000)
    monkeypatch.setattr(C, "build", lambda *a: kept.setdefault("model", build(*a)))
    scored(spark, corpus).count()
    model = kept["model"]
    assert np.allclose((10 ** model.transition).sum(1), 1)
    n = len(model.words.words)
    for c in range(C.CLASSES):
        own = model.classes.class_of[:n] == c
        if own.any():
            assert math.isclose((10 ** model.emission[:n][own]).sum(), 1, rel_tol=1e-9)


def test_form_as_expression_equals_function(spark):
    words = [b"a", b"word", b"longwords9", b"!", b"x" * 50, "é".encode(), b"ab1", b"Z"]
    df = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    assert [r[0] for r in df.select(C._form_column("word")).collect()] == [C.form_of(w) for w in words]


def test_no_training_rows_and_no_rows(spark):
    held = [d for d in range(50) if not training(d)]
    rows = [(d, "some words here", "", "") for d in held]
    got = scored(spark, rows).collect()
    assert len(got) == len(rows)
    assert all((r["n_known"], r["train_tokens"], round(r["base_score"], 9)) == (0, 0, 0.0) and math.isfinite(r["score"]) for r in got)
    assert scored(spark, []).collect() == []


def test_form_codes_equal_the_function(monkeypatch):
    words = [b"x" * n + bytes([last]) for n in (0, 1, 2, 3, 5, 6, 8, 9, 10, 40) for last in (0, 33, 48, 57, 97, 122, 127, 128, 255)]
    expected = [-1 - C.form_of(w) for w in words]
    monkeypatch.setattr(C, "form_of", None)                    # a form is looked up, not worked out for each rare word
    codes = C._Codes({})
    assert [codes[w] for w in words] == expected and codes.rest == words


def test_rare_words_join_their_counts_without_a_sort(spark, corpus):
    plan = scored(spark, corpus, rounds=1)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [word" in plan and "SortMergeJoin [word" not in plan


def test_a_step_of_the_exchange_sends_python_its_own_words_only(spark, corpus, monkeypatch):
    """Codes that the moves of a step are given: frequent words of one part."""
    def codes(class_of, matrix):
        def task(batches):
            for batch in batches:
                got = batch.column("code").to_numpy()
                assert len(set(got % 2)) <= 1 and got.max(initial=0) < 5
                yield pa.RecordBatch.from_pydict({"code": pa.array([], pa.int32()), "best": pa.array([], pa.int32()), "gain": pa.array([], pa.float64())})
        return task

    monkeypatch.setattr(C, "_moves", codes)
    pairs = spark.createDataFrame([(a, b, 1 + a + b) for a in range(9) for b in range(9)], "a int, b int, n long")
    found = C.exchange(C.written(C._neighbours(pairs)), 5)
    assert len(found.history) == 1 and found.matrix.sum() == sum(1 + a + b for a in range(9) for b in range(9))


def test_class_matrix_counts_every_pair(spark):
    pick = np.random.default_rng(8)
    rows = [(int(a), int(b), int(pick.integers(1, 1 << 40))) for a, b in sorted({tuple(x) for x in pick.integers(0, 30, size=(200, 2)).tolist()})]
    near = C.written(C._neighbours(spark.createDataFrame(rows, "a int, b int, n long").repartition(3)))
    class_of = pick.integers(0, C.ALL, size=30)
    want = np.zeros((C.ALL, C.ALL))
    for a, b, n in rows:
        want[class_of[a], class_of[b]] += n
    assert np.array_equal(C.class_matrix(near, class_of), want)
