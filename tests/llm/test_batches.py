import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlens.llm import common as C
from adlens.llm.decontaminate import find_items
from adlens.llm.mixing import with_counts
from adlens.llm.near_dedup import near_duplicates
from adlens.llm.toxicity import ToxicityModel, score_toxicity


@pytest.fixture
def unset(spark):
    """The session without a limit of its own, before and after."""
    spark.conf.unset(C._BATCH_SETTING)
    yield spark
    spark.conf.unset(C._BATCH_SETTING)


def packed(docs):
    """(rows, largest batch in bytes) of what a Python task is given."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})
    found = docs.mapInArrow(sizes, "n long, size long").collect()
    return sum(x.n for x in found), max(x.size for x in found)


OPERATORS = {
    "near_duplicates": lambda docs, items: near_duplicates(docs),
    "score_toxicity": lambda docs, items: score_toxicity(docs, ToxicityModel()),
    "find_items": lambda docs, items: find_items(docs, items),
    "with_counts": lambda docs, items: with_counts(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_texts_reach_python_in_small_batches(unset, name):
    docs = unset.createDataFrame([(1, "one two three four five six", "en", "a")], "doc_id long, text string, lang string, source string")
    items = unset.createDataFrame([(1, "an item of a benchmark that no document has")], "item_id long, text string")
    OPERATORS[name](docs, items).collect()
    large = unset.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("word "), 1000).alias("text"))       # 20 MB, below 10,000 rows
    rows, most = packed(large)
    assert rows == 4000 and most < 2 * C.BATCH_BYTES


def test_a_limit_that_was_set_stays(unset):
    unset.conf.set(C._BATCH_SETTING, "1m")
    C.in_small_batches(unset.range(1))
    assert unset.conf.get(C._BATCH_SETTING) == "1m"


def test_groups_across_batches_lose_no_link(unset):
    """Batches of one row or two give the results of large ones."""
    rows = [(100 * g + k, " ".join([f"w{g}_{i}" for i in range(60)] + [f"last{k}"])) for g in range(5) for k in range(12)]
    docs = unset.createDataFrame(rows, "doc_id long, text string")
    expected = {tuple(r) for r in near_duplicates(docs).collect()}
    unset.conf.set(C._BATCH_SETTING, "500")
    assert {tuple(r) for r in near_duplicates(docs).collect()} == expected
    assert len({r[3] for r in expected}) == 5


def test_python_is_given_at_most_two_mb_at_once(unset):
    C.in_small_batches(unset.range(1))
    rows, most = packed(unset.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("word "), 1000).alias("text")))
    assert rows == 4000 and most < 2 << 20


def test_a_task_gives_its_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(C, "give_back", lambda: calls.append(len(out)))
    out = []
    for x in C.giving_back(lambda batches: (2 * b for b in batches))(iter([1, 2, 3])):
        out.append(x)
    assert out == [2, 4, 6] and calls == [3]
    assert list(C.giving_back(lambda batches: iter(batches))(iter([]))) == [] and len(calls) == 2


def test_freed_memory_leaves_the_process():
    code = r"""
import re
import pyarrow as pa
from adlens.llm.common import giving_back
held = lambda: int(re.search(r"VmRSS:\s+(\d+)", open("/proc/self/status").read())[1]) >> 10
def task(batches):
    some = [bytes(3000) for _ in range(40_000)]
    kept.extend(some[-1:])
    yield len(some)
kept, before = [], held()
list(task([]))
after = held()
kept.clear()
list(giving_back(task)([]))
print(before, after, held())
"""
    before, after, end = map(int, subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True).stdout.split())
    assert after > before + 100 and end < before + 40
