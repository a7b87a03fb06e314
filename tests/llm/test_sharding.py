import zlib

import pytest

from adlens.llm.sharding import numbered, place_of, shard_documents


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 17, 257, 1000])
def test_permutation(n):
    assert sorted(place_of(i, n, 7) for i in range(n)) == list(range(n))
    if n > 100:
        assert [place_of(i, n, 7) for i in range(n)] != [place_of(i, n, 8) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1003])
def test_spark_equals_plain_permutation(spark, n):
    docs = spark.range(n).selectExpr("id * 3 as doc_id", "repeat('ä', cast(id % 50 as int)) as text")
    got = {r["doc_id"]: r for r in shard_documents(docs, 8, 5).collect()}
    for i in range(n):
        r, place = got[i * 3], place_of(i, n, 5)
        text = ("ä" * (i % 50)).encode()
        assert (r["shard"], r["slot"]) == (place % 8, place // 8)
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)


def test_counts_and_slots(spark):
    docs = spark.range(1003).selectExpr("id as doc_id", "'same text' as text")
    rows = shard_documents(docs, 8, 5).collect()
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(8)}
    assert all(x == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_messy_and_empty(messy):
    rows = shard_documents(messy, 8).collect()
    assert len(rows) == messy.count()
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)
    assert sorted(r["row_no"] for r in rows) == list(range(len(rows)))
    assert shard_documents(messy.limit(0), 8).count() == 0


def test_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(500).selectExpr("(id * 7919) % 500 as k")
    for parts in (1, 7):
        got = numbered(df.repartition(parts), ["k"]).collect()
        assert all(r["row_no"] == r["k"] and r["n_rows"] == 500 for r in got)
