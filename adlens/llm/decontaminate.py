"""Benchmark decontamination: pigeonhole pieces and Myers' bit-parallel distance.

A document contains a test item if some part of it is within an error budget
of k edits of the item (texts case-folded, white space collapsed).  The item
is split into k + 1 pieces: k edits leave at least one of them untouched, so
every occurrence has an exact piece hit.  The hits, found for all pieces at
once with one automaton, give windows of the document, and Myers' algorithm
verifies each window.

The items are the query set, a table that is read in blocks of bounded size
(``BLOCK_CHARS``): the driver and the tasks hold one block at a time.  One
block makes one pass over the documents, without a shuffle.  With more of
them each block is a pass of its own, whose hits (a text's digest, item and
edits) are written before the next block is read, and the documents join all
hits by digest at the end.  Texts are read whole, and all hits are verified.

The budget is one edit for ``CHARS_PER_EDIT`` characters.  Items shorter than
``MIN_CHARS`` have to stand between word boundaries, so that they are not
found inside other words; their edits are counted against whole words.

Defined results: null and empty texts contain nothing; null or blank items are
in no document; items whose texts
are equal are all reported; repeated rows get equal results; empty tables
give no findings; other columns pass through, one named like a result column
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import giving_back, in_small_batches, written

#: One edit is allowed for so many characters of an item; its pieces are then about as long.
CHARS_PER_EDIT = 16
#: Shorter items would be found by chance inside other words: they are sought as whole words.
MIN_CHARS = 32
#: Characters of items that one block may hold: the bound of what is sent to every task.
BLOCK_CHARS = 4_000_000


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def error_budget(item: str) -> int:
    return len(item) // CHARS_PER_EDIT


def stands_alone(text: str, start: int, stop: int) -> bool:
    """No letter or digit goes on beyond either end of ``text[start:stop]``."""
    return not (start and text[start - 1].isalnum() and text[start].isalnum()
                or stop < len(text) and text[stop - 1].isalnum() and text[stop].isalnum())


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of the budget + 1 pieces of an item, of nearly equal length."""
    n = error_budget(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers_search(item: str, text: str, most: int) -> int:
    """Fewest edits between ``item`` and any part of ``text``; ``most`` + 1 if more than ``most``.

    One step for each character of the text on columns kept as bits of an integer.
    """
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, min(m, most + 1)        # vertical differences of +1 and -1
    for c in text:
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        rise, fall = (down | ~(across | up)) & full, up & across
        score += bool(rise & high) - bool(fall & high)
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = (fall | ~(eq | down | rise)) & full, rise & (eq | down)
        best = min(best, score)
    return best


def edits_of_words(item: str, text: str, start: int, stop: int, most: int) -> int:
    """Fewest edits between ``item`` and a run of whole words of ``text`` in ``start`` to ``stop``; ``most`` + 1 if more.

    A word is cut where a letter or digit meets something else, as in ``stands_alone``.
    """
    best = most + 1
    for a in range(start, stop):
        for b in range(max(a + 1, a + len(item) - most), min(stop, a + len(item) + most) + 1):
            if stands_alone(text, a, b):
                best = min(best, whole_distance(item, text[a:b], most))
    return best


def whole_distance(a: str, b: str, most: int) -> int:
    """Edits between two short strings, ``most`` + 1 if more, by a table of bands."""
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        if min(new) > most:
            return most + 1
        row = new
    return min(row[-1], most + 1)


class ItemFinder:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, t) in enumerate(items):
            for offset, piece in pieces(t):
                places.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> dict[int, int]:
        """Fewest edits for each item that the text contains within its budget."""
        text = normalised(text)
        windows: dict[int, list[tuple[int, int]]] = {}
        found: dict[int, int] = {}
        if not text or not len(self.automaton):
            return {}
        for end, (size, where) in self.automaton.iter(text):
            for k, offset in where:
                number, item = self.items[k]
                if not error_budget(item):                    # the one piece is the item
                    if stands_alone(text, end + 1 - size, end + 1):
                        found[number] = 0
                    continue
                budget, start = error_budget(item), end + 1 - size - offset
                windows.setdefault(k, []).append((max(0, start - budget), start + len(item) + budget))
        for k, spans in windows.items():
            number, item = self.items[k]
            budget = error_budget(item)
            spans.sort()
            merged = [list(spans[0])]
            for a, b in spans[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            best = budget + 1
            for a, b in merged:
                part = text[a:b]
                near = 0 if item in part else myers_search(item, part, budget)
                if near <= budget and len(item) < MIN_CHARS:
                    near = edits_of_words(item, text, a, min(b, len(text)), budget)
                best = min(best, near)
            if best <= budget:
                found[number] = min(best, found.get(number, best))
        return found


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Normalised items (number, text) in blocks of at most ``block_chars`` characters (or one item).

    ``items`` has item_id and text.  Blocks reach the driver one at a time.
    """
    rows = written(items.where("item_id is not null").select("item_id", "text"))
    block, size = [], 0
    for row in rows.toLocalIterator():
        text = normalised(row["text"])
        if not text:
            continue
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int64())]))
_FOUND = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("edits", T.LongType())]))


def _find_in(batches: Iterator[pa.RecordBatch], block: list, text_col: str, hits: str) -> Iterator[pa.RecordBatch]:
    finder = ItemFinder(block)
    for batch in batches:
        found = [[{"item_id": k, "edits": e} for k, e in sorted(finder.find(t).items())]
                 for t in batch.column(text_col).to_pylist()]
        yield batch.append_column(hits, pa.array(found, _HITS))


def _with_hits(docs: DataFrame, block: list, text_col: str, hits: str) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, T.StructField(hits, _FOUND)])
    return docs.mapInArrow(giving_back(lambda batches: _find_in(batches, block, text_col, hits)), schema)


def find_items(docs: DataFrame, items: DataFrame, text_col: str = "text", hits: str = "benchmark_hits",
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``hits``: array of (item_id, edits) of the test items that each text contains."""
    docs = in_small_batches(docs).drop(hits)
    blocks = item_blocks(items, block_chars)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        found = _with_hits(docs, first, text_col, hits)
        return found.withColumn(hits, F.array_sort(hits))
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.select(digest.alias("digest"), F.col(text_col).alias("text"))
    parts = []
    for block in (first, second, *blocks):                   # the generator reads a block when the one before is done
        part = _with_hits(texts, block, "text", "found").where(F.size("found") > 0).select("digest", F.inline("found"))
        parts.append(written(part.distinct()))
    everything = reduce(DataFrame.union, parts).groupBy("digest").agg(F.array_sort(F.collect_set(F.struct("item_id", "edits"))).alias("found"))
    everything = everything.select(F.col("digest").alias("_of"), F.col("found").alias("_found"))
    away = {c: f"c{i}" for i, c in enumerate(docs.columns)}                            # so that no name of ours clashes
    own = docs.toDF(*away.values())
    joined = own.withColumn("_own", F.md5(F.coalesce(F.col(away[text_col]), F.lit("")))).join(everything, F.col("_own") == F.col("_of"), "left")
    return joined.select(*[F.col(a).alias(c) for c, a in away.items()], F.coalesce("_found", F.array().cast(_FOUND)).alias(hits))
