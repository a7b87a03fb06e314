"""Audit of how filters interact, by a retracting stream.

Five filters judge a document: A too few words, B too few distinct words, C
too many capitals, D a forbidden character, E a text that a document with a
smaller id has as well.  For every order in which the filters could run, and
every part (language) of the table, the audit tells what each step removes.

A to D need one document, E the whole table.  All files run through one
Structured Streaming query as available-now micro-batches:

1. One pass over a micro-batch's texts gives each document's mask of A to D
   and a 128-bit digest of the text.
2. Every task combines its rows by digest before anything is shuffled: the
   smallest id is counted as passing E, larger ids as failing it, so a text
   that a third of all rows share leaves a task as one row.
3. A state table keyed by text holds the rows with the smallest id so far,
   and the counters under which they were counted.  The combined rows and the
   state meet by text; where a smaller id arrives, the earlier rows' mask is
   retracted from their part's counters and counted anew with E, and a larger
   id is corrected at once.  What remains is the next state.
4. Counters, corrections and state of a micro-batch are one write into its
   own folder.

After the last micro-batch the summed counters are a table of at most 32
masks x 4 label combinations for each part, from which every order, step and
Shapley value follows without another look at the documents.

The state has a row of some 50 bytes for each text and is read and written
once for each of the few micro-batches, by a shuffle that spills, so nothing
of it is held in memory.  (Spark's own state store was tried first: a Python
call for each text took 860 CPU seconds a GB, and RocksDB 4 MB of disk for
each of its partitions.)  State, counters and the stream's offsets are in the
session's shared folder; a lost executor repeats tasks, and a repeated
micro-batch reads the state before it and overwrites its own folder only.

Defined results: null texts are empty and null languages the empty string; a
null id never fails E and makes no other row fail; rows that repeat an id are
each counted, all with the smallest id as passing E; several label rows of an
id count where any of them is 1; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_folder, texts_as_bytes, written

FILTERS = "ABCDE"
#: Bit of each filter in a mask.
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT, FORBIDDEN = 100, 80, 10, b"#$%&*|"
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
#: Micro-batches of one run, digests that a task combines at once, bytes of a text split at once, label copies.
BATCHES, COMBINED, PIECE, SALTS = 4, 200_000, 1 << 20, 8
DIGEST_BYTES = 16


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words of a text, split in pieces so that a long text is never held as a list."""
    n, distinct, start = 0, set(), 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and not (text[end] == 32 or 9 <= text[end] <= 13):
            end += 1
        words = text[start:end].split()
        n, start = n + len(words), end
        distinct.update(words)
    return n, len(distinct)


def mask_of(text: bytes, characters: int) -> int:
    """The filters A to D that a text fails."""
    words, distinct = word_counts(text)
    mask = BIT["A"] if words < MIN_WORDS else 0
    if 100 * distinct < MIN_DISTINCT_PERCENT * words:
        mask |= BIT["B"]
    if 100 * len(text.translate(None, _NOT_CAPITAL)) > MAX_CAPITAL_PERCENT * characters:
        mask |= BIT["C"]
    return mask | (BIT["D"] if len(text.translate(None, FORBIDDEN)) < len(text) else 0)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = 0
    for batch in batches:
        texts = texts_as_bytes(batch)
        sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
        salts = [(row + i) % SALTS for i in range(len(texts))]
        row += len(texts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pc.fill_null(batch.column("part"), ""),
             pa.array([hashlib.blake2b(t, digest_size=DIGEST_BYTES).digest() for t in texts], pa.binary()),
             pa.array(map(mask_of, texts, sizes), pa.int32()), pa.array(salts, pa.int32())],
            names=["doc_id", "part", "text_key", "mask", "salt"])


_KEYED = "text_key binary, doc_id long, part string, mask int, good boolean, toxic boolean, n long"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task by text: those with the smallest id of each text, and the task's counters under keys of their own."""
    held: dict[bytes, tuple[int, Counter]] = {}
    counters: Counter = Counter()
    for batch in batches:
        for key, doc_id, part, mask, good, toxic in zip(*(batch.column(c).to_pylist() for c in (
                "text_key", "doc_id", "part", "mask", "good", "toxic"))):
            cell = (part, mask, good, toxic)
            if doc_id is None:
                counters[cell] += 1
                continue
            best = held.get(key)
            if best is None or doc_id < best[0]:
                for c, n in best[1].items() if best else ():
                    counters[c] -= n
                    counters[_fails(c)] += n
                held[key] = (doc_id, Counter({cell: 1}))
                counters[cell] += 1
            elif doc_id == best[0]:
                best[1][cell] += 1
                counters[cell] += 1
            else:
                counters[_fails(cell)] += 1
        if len(held) >= COMBINED:
            yield _keyed(held, counters)
            held, counters = {}, Counter()
    yield _keyed(held, counters)


def _fails(cell: tuple) -> tuple:
    return cell[0], cell[1] | BIT["E"], *cell[2:]


def _keyed(held: dict, counters: Counter) -> pa.RecordBatch:
    rows = [(key, doc_id, *cell, n) for key, (doc_id, cells) in held.items() for cell, n in cells.items()]
    rows += [(uuid.uuid4().bytes + b"#", 0, *cell, n) for cell, n in counters.items() if n]
    kinds = (pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                      names=["text_key", "doc_id", "part", "mask", "good", "toxic", "n"])


def _retract(rows: DataFrame) -> DataFrame:
    """``kind`` of each row of a micro-batch and of the state before it: "state" (still the smallest id of its text),
    "lost" (was counted as passing E, and fails it) or "counter" (a task's counters, which stand)."""
    best = F.min("doc_id").over(Window.partitionBy("text_key"))         # one row per text and task at most, besides the state
    return rows.withColumn("kind", F.when(F.octet_length("text_key") != DIGEST_BYTES, "counter")
                           .when(F.col("doc_id") > best, "lost").otherwise("state"))


def _positive(labels: DataFrame) -> DataFrame:
    """(doc_id, salt, good, toxic) of ids with a label of 1, once for each salt, so that no id meets in one task."""
    any_of = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")).where("good OR toxic")
    return any_of.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))


def mask_counters(spark: SparkSession, path: str, labels: DataFrame, part: str = "lang", batches: int = BATCHES) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of the table at ``path`` fail just the filters of a mask."""
    path = path.rstrip("/")
    table = spark.read.parquet(path)
    folder = f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    files = len(table.inputFiles())
    positive = written(_positive(labels))
    exactly = f"{path[:-1]}[{path[-1]}]"                     # a pattern: a stream takes a single file only by one
    stream = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // batches))).parquet(exactly)
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(part).cast("string").alias("part"), "text"))

    epochs: set[int] = set()

    def micro_batch(docs: DataFrame, epoch: int) -> None:
        measured = docs.mapInArrow(_measure, "doc_id long, part string, text_key binary, mask int, salt int")
        judged = (measured.join(positive, ["doc_id", "salt"], "left")
                  .select("text_key", "doc_id", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"),
                          F.coalesce("toxic", F.lit(False)).alias("toxic")))
        rows = judged.mapInArrow(_combine, _KEYED)
        if epoch:
            rows = rows.union(_epoch(docs.sparkSession, folder, epoch - 1).where("kind = 'state'").drop("kind"))
        _retract(rows).write.mode("overwrite").partitionBy("kind").parquet(f"{folder}/epoch={epoch}")
        epochs.add(epoch)

    query = (stream.writeStream.foreachBatch(micro_batch).option("checkpointLocation", f"{folder}/stream")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if not epochs:
        return spark.createDataFrame([], _COUNTERS)
    found = reduce(DataFrame.union, [_epoch(spark, folder, e) for e in sorted(epochs)]).where("kind <> 'state'")
    lost = F.col("kind") == "lost"                           # counted once as passing E: that goes, and E comes
    change = F.when(lost, F.array(F.struct("mask", (-F.col("n")).alias("n")),
                                  F.struct(F.col("mask").bitwiseOR(BIT["E"]).alias("mask"), "n"))).otherwise(F.array(F.struct("mask", "n")))
    found = found.select("part", "good", "toxic", F.explode(change).alias("c"))
    return (found.groupBy("part", F.col("c.mask").alias("mask"), "good", "toxic").agg(F.sum("c.n").alias("n")).where("n <> 0"))


_COUNTERS = "part string, mask int, good boolean, toxic boolean, n long"


def _epoch(spark: SparkSession, folder: str, epoch: int) -> DataFrame:
    """What a micro-batch has written."""
    return spark.read.schema(f"{_KEYED}, kind string").parquet(f"{folder}/epoch={epoch}")


def audit_of(counters: DataFrame) -> DataFrame:
    """Every order and step of every part, from the mask counters."""
    cells = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))   # at most 32
    steps = [{"filter_order": "".join(order), "step": i + 1, "own": BIT[f], "prior": sum(BIT[x] for x in order[:i])}
             for order in itertools.permutations(FILTERS) for i, f in enumerate(order)]
    kind = "array<struct<filter_order: string, step: int, own: int, prior: int>>"
    rows = parts.select("part", "cells", F.explode(F.from_json(F.lit(json.dumps(steps)), kind)).alias("at"))
    own, prior = F.col("at.own"), F.col("at.prior")

    def total(what: str, holds):
        return F.aggregate(F.filter("cells", holds), F.lit(0).cast("long"), lambda sum_, c: sum_ + c[what])

    def removed(c):
        return (c["mask"].bitwiseAND(own) != 0) & (c["mask"].bitwiseAND(prior) == 0)

    orders = 120                                              # of five filters; each of m failing ones comes first in 120 / m
    share = F.aggregate(
        F.transform(F.filter("cells", lambda c: c["mask"].bitwiseAND(own) != 0),
                    lambda c: c["n"] * (F.lit(orders) / F.bit_count(c["mask"])).cast("long")),
        F.lit(0).cast("long"), lambda sum_, x: sum_ + x)
    return rows.select(
        "part", F.col("at.filter_order").alias("filter_order"), F.col("at.step").alias("step"),
        total("n", lambda c: c["mask"].bitwiseAND(own + prior) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda c: (c["mask"].bitwiseAND(own) != 0) & (c["mask"].bitwiseAND(prior) != 0)).alias("redundant"),
        total("n", lambda c: c["mask"] == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"),
        share.alias("shapley"))


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, part: str = "lang", batches: int = BATCHES) -> DataFrame:
    """One row per part, order of the five filters and step; see the module."""
    return audit_of(written(mask_counters(spark, path, labels, part, batches)))
