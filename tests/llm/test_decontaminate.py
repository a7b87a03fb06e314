import random

import pytest
from pyspark.sql import functions as F

from adlens.llm import decontaminate as D


def fewest_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_myers_equals_the_table_of_edits():
    r = random.Random(1)
    for _ in range(500):
        item = "".join(r.choice("abc") for _ in range(r.randrange(1, 80)))
        text = "".join(r.choice("abc") for _ in range(r.randrange(0, 90)))
        most = r.randrange(12)
        assert D.myers_search(item, text, most) == min(fewest_edits(item, text), most + 1)


def edited(text, n, r):
    out = list(text)
    for _ in range(n):
        k, what = r.randrange(len(out)), r.randrange(3)
        if what == 0:
            out[k] = "~"
        elif what == 1:
            del out[k]
        else:
            out.insert(k, "^")
    return "".join(out)


def test_every_occurrence_within_the_budget_is_found(spark):
    r = random.Random(5)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("ane", "olt", "irk", "usp")]
    items = [(k, " ".join(r.choice(words) for _ in range(r.randrange(8, 40)))) for k in range(25)]
    docs = []
    for i in range(120):
        filler = lambda: " ".join(r.choice(words) for _ in range(r.randrange(60)))
        item = D.normalised(r.choice(items)[1])
        docs.append((i, f"{filler()}\n{edited(item, r.randrange(D.error_budget(item) + 3), r).upper()} \t{filler()}"))
    want = {(i, k): e for i, t in docs for k, x in items
            if (e := fewest_edits(D.normalised(x), D.normalised(t))) <= D.error_budget(D.normalised(x))}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    for block in (D.BLOCK_CHARS, 300):
        got = {(r["doc_id"], h["item_id"]): h["edits"] for r in D.find_items(frame, tests, block_chars=block).collect()
               for h in r["benchmark_hits"]}
        assert got == want
    assert 0 < len(want) < len(docs) * len(items)


@pytest.mark.parametrize("n", [32, 95, 160, 401])
def test_pieces(n):
    item = "".join(chr(97 + i % 26) for i in range(n))
    parts = D.pieces(item)
    assert "".join(p for _, p in parts) == item and len(parts) == D.error_budget(item) + 1
    assert all(item[a:a + len(p)] == p for a, p in parts)


def test_messy_and_empty(spark, messy):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "short"), (None, "x" * 50),
                                   (4, "one two three four five six seven"), (5, "One two  three four five six seven")],
                                  "item_id long, text string")
    out = D.find_items(messy.withColumn("benchmark_hits", F.lit("clash")), items)
    assert sorted(out.columns) == sorted([*messy.columns, "benchmark_hits"])
    for r in out.collect():
        assert [h["item_id"] for h in r["benchmark_hits"]] == ([4, 5] if (r["text"] or "").startswith("one") else [])
    assert D.find_items(messy.limit(0), items).count() == 0
    assert all(r["benchmark_hits"] == [] for r in D.find_items(messy, items.limit(0)).collect())


def test_short_items_are_found_as_whole_words(spark):
    items = spark.createDataFrame([(1, "What is 2 + 2?"), (2, "capital of  Peru"), (3, "how many legs has a spid")], "item_id long, text string")
    texts = [(0, "So WHAT is\n2 + 2? Four.", [1]), (1, "what is 2 + 3?", []), (2, "the capital of Peru", [2]),
             (3, "capital of peruvians, then the capital of peru.", [2]), (4, "a supercapital of peru", []),
             (5, "capital of peruvians", []), (6, "how many legs has a spider", []), (7, "what is 2 + 2?capital of peru", [1, 2]), (8, None, [])]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    got = {r["doc_id"]: [(h["item_id"], h["edits"]) for h in r["benchmark_hits"]] for r in D.find_items(docs, items).collect()}
    assert got == {k: [(n, 0) for n in want] for k, _, want in texts}


def test_short_items_forgive_an_edit_between_words(spark):
    items = spark.createDataFrame([(1, "name the seven wonders"), (2, "what is 2 + 2?"), (3, "who wrote hamlet then?")], "item_id long, text string")
    texts = [(0, "so: name the sevem wonders, please", [(1, 1)]), (1, "name the seven wonders", [(1, 0)]), (2, "rename the seven wonders", [(1, 2)][:0]),
             (3, "name the sevn wonderss", []), (4, "what is 2 + 3?", []), (5, "Who wrote Hamlet, then?", [(3, 1)]), (6, "name the seven wonder", [(1, 1)]),
             (7, "names the seven wonders", [(1, 1)])]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    got = {r["doc_id"]: [(h["item_id"], h["edits"]) for h in r["benchmark_hits"]] for r in D.find_items(docs, items).collect()}
    assert got == {k: want for k, _, want in texts}


def test_blocks_are_passes_of_their_own_and_names_do_not_clash(spark, messy):
    items = spark.createDataFrame([(k, f"item number {k} of the block {'x' * 40}") for k in range(12)] + [(20, "one two three four five six seven")],
                                  "item_id long, text string")
    docs = messy.withColumns({c: F.lit("own") for c in ("_block_hits", "_own", "_of", "_found", "c0", "found", "item_id")})
    one = D.find_items(docs, items).orderBy("doc_id", "text").collect()
    many = D.find_items(docs, items, block_chars=100).orderBy("doc_id", "text").collect()
    assert one == many and len(one) == messy.count()
    assert {r["doc_id"] for r in many if r["benchmark_hits"]} == {1, None}
