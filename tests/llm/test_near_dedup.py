import random

import numpy as np
import pytest

from adlens.llm import near_dedup as N
from adlens.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(5)]))


def brute(rows, threshold):
    """{doc_id: smallest reachable id} over distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= threshold * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i in ids}


def near_copies(seed, bases=6, copies=14, words=60):
    r = random.Random(seed)
    rows, k = [], 0
    for _ in range(bases):
        base = [f"w{r.randrange(500)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(r.randrange(4)):
                own[r.randrange(words)] = f"e{r.randrange(9999)}"
            rows.append((k * 3 % 1009, " ".join(own)))
            k += 1
    return rows


@pytest.mark.parametrize("threshold", [80, 85])
def test_components_equal_brute_force(spark, threshold):
    rows = near_copies(threshold)
    got = {r["doc_id"]: r for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), threshold).collect()}
    want = brute(rows, threshold)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(shingles(t)) for i, t in rows for r in [got[i]])
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_small_blocks_lose_no_link(spark, monkeypatch):
    """With blocks of a few rows every bucket and cluster is split into block pairs."""
    monkeypatch.setattr(N, "BLOCK_CLASSES", 5)
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 200)
    monkeypatch.setattr(N, "BROADCAST_MEMBERS", 0)
    rows = near_copies(3, bases=3, copies=30)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows, 85)


def drifting(seed, steps=60, words=60):
    """Texts that each change two more words: neighbours are linked, the ends share little."""
    r = random.Random(seed)
    own, rows = [f"w{r.randrange(500)}" for _ in range(words)], []
    for i in range(steps):
        own[(i * 7) % words] = f"d{i}"
        rows.append((1000 + i, " ".join(own)))
    return rows


@pytest.mark.parametrize("rounds", [1, 4])
def test_contraction_loses_no_link(spark, monkeypatch, rounds):
    """Chains whose links lie far from every pivot, beside several stars, with rounds used up or not."""
    monkeypatch.setattr(N, "BLOCK_CLASSES", 4)
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 150)
    monkeypatch.setattr(N, "ROUNDS", rounds)
    rows = near_copies(5, bases=2, copies=25) + drifting(1) + [(5000 + i, t) for i, t in drifting(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (80, 85, 100):
        got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(docs, threshold).collect()}
        assert got == brute(rows, threshold)


def test_group_of_near_copies_is_written_a_few_times(spark):
    """400 near copies in blocks of 10: block pairs would write each 40 times."""
    r = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        own = list(base)
        own[r.randrange(300)] = f"e{i}"
        rows.append((1, i, 300, " ".join(own).encode(), 40))
    hot = spark.createDataFrame(rows, "unit long, node long, size long, payload binary, blocks long")
    links, units = N._contracted(hot, N._meet_pivot(*N._jaccard_to(85)), 5, 300 * 10)
    assert sorted(r["b"] for r in links.collect()) == list(range(1, 400))
    assert units.count() <= 2 * len(rows)


def test_two_far_stars_do_not_meet(spark):
    """Signatures of two groups that differ everywhere: the stripes keep their blocks apart."""
    same = bytes(N.COORDINATES), bytes([1] * N.COORDINATES)
    rows = [(1, i, 1, same[i % 2], 20) for i in range(200)]
    hot = spark.createDataFrame(rows, "unit long, node long, size long, payload binary, blocks long")
    links, units = N._contracted(hot, N._meet_pivot(*N._agreement()), N.APART, 10)
    assert sorted((r["a"], r["b"]) for r in links.collect()) == sorted([(0, i) for i in range(2, 200, 2)] + [(1, i) for i in range(3, 200, 2)])
    assert units.count() == 0


def test_signature_agreement_estimates_jaccard():
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words).encode(), " ".join(words[:360] + [f"x{i}" for i in range(40)]).encode()
    h, n = N.distinct_per_text(*N.shingle_hashes([a, b]))
    s = N.signatures(h, n)
    true = len(shingles(a.decode()) & shingles(b.decode())) / len(shingles(a.decode()) | shingles(b.decode()))
    assert abs((s[0] == s[1]).mean() - true) < 0.15


def test_hashing_is_that_of_words_not_of_batches():
    texts = [b"", b"A b", b"a B c d e f", b"  a  b c d\te f ", b"x" * 3000]
    together, n = N.shingle_hashes(texts)
    apart = [N.shingle_hashes([t])[0] for t in texts]
    assert n.tolist() == [0, 1, 2, 2, 1]
    assert np.array_equal(together, np.concatenate(apart))
    assert np.array_equal(apart[2], apart[3])


def test_messy_rows(messy):
    got = N.near_duplicates(messy, 85).collect()
    assert len(got) == messy.count()
    of = {}
    for r in got:
        of.setdefault(r["doc_id"], []).append(r)
    assert [r["component_id"] for r in of[1]] == [1, 1]
    assert of[2][0]["n_shingles"] == of[3][0]["n_shingles"] == of[4][0]["n_shingles"] == 0
    assert of[6][0]["component_id"] == of[7][0]["component_id"] == 6 and not of[7][0]["kept"]
    assert all(r["component_id"] is None and r["kept"] for r in of[None])
    assert of[2][0]["component_id"] == 2 and of[2][0]["kept"]


def test_keep_one_of_each(spark, messy, monkeypatch):
    for bound in (N.BROADCAST_MEMBERS, 0):
        monkeypatch.setattr(N, "BROADCAST_MEMBERS", bound)
        kept = N.keep_one_of_each(messy, 85)
        assert kept.columns == messy.columns
        ids = sorted((r["doc_id"] or 0) for r in kept.select("doc_id").collect())
        assert ids == [0, 0, 1, 2, 3, 4, 5, 6, 8]


def test_empty_table(spark, messy):
    assert N.near_duplicates(messy.limit(0), 85).count() == 0
    assert N.keep_one_of_each(messy.limit(0), 85).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 164)] + [(7, 7), (3, 9)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 165)}, 3: 3, 9: 3}
