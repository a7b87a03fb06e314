"""The filter audit against plain Python, over tables whose order of arrival makes ids retract each other."""

import itertools
import random
import re

import pytest

from adlens.llm.filter_audit import BIT, FILTERS, audit_of, filter_audit, mask_counters, mask_of, word_counts

SCHEMA = "doc_id long, text string, lang string, mask string, n long"
LABELS = "doc_id long, quality int, toxic int"


def plain(rows, labels):
    """{(part, order, step): counts} by applying every order to every document."""
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs = []
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        fails = {f for f, failed in (
            ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text))),
            ("E", doc_id is not None and doc_id > first[text])) if failed}
        docs.append((lang or "", fails, doc_id in good, doc_id in toxic))
    out = {}
    orders = ["".join(o) for o in itertools.permutations(FILTERS)]
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys(FILTERS, 0)
        rows_of = {}
        for order in orders:
            left = own
            for step, f in enumerate(order):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(removed)
                failing = sum(f in d[1] for d in own)
                rows_of[order, step + 1] = [len(left), len(removed), failing - len(removed), sum(d[1] == {f} for d in own),
                                            sum(d[2] for d in removed), sum(d[3] for d in removed)]
        out |= {(part, o, s): (*v, shapley[o[s - 1]]) for (o, s), v in rows_of.items()}
    return out


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"],
                                                        r["good_lost"], r["toxic_lost"], r["shapley"]) for r in df.collect()}


def write(spark, rows, path, files=5):
    for i in range(files):
        spark.createDataFrame(rows[i::files], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(5)
    texts = ["", None, "few words", " \t\n ", "A" * 300, "one #tag " * 80, " ".join(f"w{i}" for i in range(150)),
             " ".join(f"Word{i % 40}" for i in range(120)), " ".join(f"é{i} |" for i in range(130)),
             " ".join(f"long{i % 9000}" for i in range(200_000))]
    rows = [(pick.choice([None, *range(60)]) if pick.random() < 0.2 else i, pick.choice(texts[:9]), pick.choice(["en", "de", "", None]), "m", i)
            for i in range(400)]
    rows += [(1000 + i, texts[6], "en", "m", i) for i in range(300)]          # a text that a third of the rows share
    rows += [(5000, texts[9], "fr", "m", 1), (4999, texts[9], "fr", "m", 1), (7, "few words", "en", "m", 1), (7, "few words", "en", "m", 1)]
    pick.shuffle(rows)
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1])) for i in range(0, 1300, 3)] + [(6, 0, 1), (6, 1, 0), (None, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("batches", [1, 3])
def test_equals_plain_application_of_every_order(spark, tmp_path, corpus, batches):
    rows, labels = corpus
    path = write(spark, rows, str(tmp_path / "docs"))
    got = found(filter_audit(spark, path, spark.createDataFrame(labels, LABELS), batches=batches))
    assert got == plain(rows, labels)


def test_smaller_ids_that_arrive_later_retract(spark, tmp_path):
    """Files in descending order of ids, one micro-batch each: every batch retracts the one before."""
    path = str(tmp_path / "docs")
    for i in range(6):
        rows = [(10 * (6 - i) + k, "same text", "en" if i % 2 else "de", "m", 0) for k in range(2)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    labels = spark.createDataFrame([], LABELS)
    cells = {(r["part"], r["mask"]): r["n"] for r in mask_counters(spark, path, labels, batches=6).collect()}
    a = BIT["A"]
    assert cells == {("en", a): 1, ("en", a | BIT["E"]): 5, ("de", a | BIT["E"]): 6}


def test_empty_table(spark, tmp_path):
    path = write(spark, [], str(tmp_path / "docs"), files=1)
    assert filter_audit(spark, path, spark.createDataFrame([], LABELS)).collect() == []


def test_single_file(spark, tmp_path, corpus):
    rows, labels = corpus
    path = write(spark, rows[:50], str(tmp_path / "docs"), files=1)
    one = next((tmp_path / "docs").glob("part-*.parquet"))
    assert found(filter_audit(spark, str(one), spark.createDataFrame(labels, LABELS))) == plain(rows[:50], labels), path


def test_every_part_has_every_order_and_step(spark):
    cells = spark.createDataFrame([("x", 31, True, False, 3), ("x", 0, False, False, 2)], "part string, mask int, good boolean, toxic boolean, n long")
    got = audit_of(cells).collect()
    assert len(got) == 600 and all(r["shapley"] == 72 for r in got)          # 3 documents, each filter first in 24 orders
    assert all(r["kept"] == 2 and r["removed"] == (3 if r["step"] == 1 else 0) and r["good_lost"] == r["removed"] for r in got)


def test_words_of_long_texts_are_counted_in_pieces():
    words = [f"w{i % 50_021}" for i in range(400_000)]
    text = "  \n".join(words).encode()
    assert word_counts(text) == (400_000, 50_021)
    assert word_counts(b"") == (0, 0) and word_counts(b"x" * (3 << 20)) == (1, 1)
    assert mask_of(b"", 0) == BIT["A"]
