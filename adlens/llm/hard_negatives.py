"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label.  Every positive
opens a window of scores, from ``floor`` per cent of its own score up to its
own score, and the best rows of other labels inside the window are its hard
negatives.  The windows of one anchor overlap, so they are not searched one
by one:

1. The positives' scores, in descending order, are the upper limits.  They
   split the scores into disjoint slots: slot j reaches from its own limit
   down to the next one (the last slot down to the lowest window's floor).
2. One pass over all rows.  Every task is a combiner that keeps the best
   ``k`` rows of each (anchor, slot); a row falls into one slot at most.  The
   tasks' bests meet by (anchor, slot) and again the best ``k`` stay.
3. Going through the slots from the last to the first, the best ``k`` of a
   slot and all below it are the slot's own ones followed by those of the
   suffix below.  Window i is the suffix at slot i, cut at the window's floor.

Anchors are dealt into groups of a bounded size in bytes.  A group's matrix
goes to the tasks, which score it against their rows by matrix products; a
group's result is written before the next group is read, so the driver and
the tasks hold one group at a time, whatever the number of anchors.

Scores are integers: components are floor(scale * x).  Products run in double
precision where all partial sums are exact (below 2**53), and in whole
numbers of any size elsewhere.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; rows score only with rows of equal
length (an empty vector scores 0 with another); "other rows" are those of
another id, so repeated rows count each for itself, and a repeated anchor
repeats its result; ties go to the smaller id, then to the smaller label;
scores beyond 64 bits take no part; positives with a negative score have an
empty window; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_folder, written
from .sharding import numbered

#: Bytes of one group's anchors as doubles, and of one block of scores.
GROUP_BYTES, BLOCK_BYTES = 4 << 20, 16 << 20
#: Largest sum that doubles hold exactly, and largest score of 64 bits.
EXACT, LARGEST = float(1 << 53), (1 << 63) - 1


def vectors_of(column: pa.Array, scale: int = 256) -> list[np.ndarray | None]:
    """floor(scale * x) of each vector's components; None for a null vector or one with a null or non-finite component."""
    out = []
    for x in column:
        v = x.values
        if v is None or v.null_count:
            out.append(None)
            continue
        q = np.asarray(v.to_numpy(zero_copy_only=False), dtype=np.float64)
        with np.errstate(over="ignore"):
            scaled = np.floor(scale * q)
        out.append(scaled if np.isfinite(scaled).all() else None)
    return out


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, anchors x rows: int64 where they fit exactly, else Python integers."""
    width = anchors.shape[1]
    high = (np.abs(anchors).max(initial=0.0) * np.abs(rows).max(initial=0.0)) * max(width, 1)
    if high < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = [[[int(c) for c in v] for v in side] for side in (anchors, rows)]
    out = np.empty((len(anchors), len(rows)), dtype=object)
    for i, a in enumerate(whole[0]):
        out[i] = [sum(x * y for x, y in zip(a, r)) for r in whole[1]]
    return out


class _Best:
    """The best ``k`` (score, id, label) of each key, by score descending, id and label ascending."""

    def __init__(self, keys: int, k: int):
        self.k, self.keys = k, keys
        self.least: list = [None] * keys                      # the k-th best score, once there are k
        self.held: dict[int, list[tuple]] = {}

    def bound(self, keys: np.ndarray, dtype) -> np.ndarray:
        low = -(1 << 62) if dtype != object else -(1 << 200)
        return np.array([low if self.least[i] is None else self.least[i] for i in keys], dtype=dtype)

    def add(self, key: int, found: list[tuple]) -> None:
        own = sorted(self.held.get(key, []) + found)[:self.k]   # tuples of (-score, id, label)
        self.held[key] = own
        if len(own) == self.k:
            self.least[key] = -own[-1][0]

    def rows(self) -> Iterator[tuple]:
        for key, own in self.held.items():
            for minus, vec_id, label in own:
                yield key, -minus, vec_id, label


_FOUND = "anchor_no long, slot int, score long, vec_id long, label int"


def _scan(group: dict, k: int, scale: int, limits: np.ndarray | None = None, floors: np.ndarray | None = None):
    """The task that scores its rows against ``group`` and keeps the best of each (anchor, slot).

    Without ``limits``: the best rows of the anchor's label.  With them (anchors x
    slots, descending; floors: the least score that slot's windows take): the best rows of other labels in each slot.
    """
    slots = 1 if limits is None else limits.shape[1]
    block = max(1, BLOCK_BYTES // (8 * max(1, len(group["ids"]))))
    lengths = {}
    for i, v in enumerate(group["vectors"]):
        lengths.setdefault(len(v), []).append(i)
    by_length = {n: (np.array(at), np.stack([group["vectors"][i] for i in at])) for n, at in lengths.items()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(group["ids"]) * slots, k)
        for batch in batches:
            ids, labels = batch.column("vec_id").to_numpy(zero_copy_only=False), batch.column("label").to_numpy(zero_copy_only=False)
            vectors = vectors_of(batch.column("embedding"), scale)
            sorted_by_length = {}
            for i, v in enumerate(vectors):
                if v is not None and len(v) in by_length:
                    sorted_by_length.setdefault(len(v), []).append(i)
            for n, at in sorted_by_length.items():
                anchor_at, matrix = by_length[n]
                for start in range(0, len(at), block):
                    own = np.array(at[start:start + block])
                    _keep_best(best, anchor_at, matrix, np.stack([vectors[i] for i in own]), ids[own], labels[own])
        found = [(group["numbers"][key // slots], key % slots, score, vec_id, label)
                 for key, score, vec_id, label in best.rows()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in found], kind) for c, kind in
             enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()))],
            names=["anchor_no", "slot", "score", "vec_id", "label"])

    def _keep_best(best, anchor_at, matrix, rows, ids, labels):
        s = scores(matrix, rows)
        fits = np.ones(s.shape, bool) if s.dtype != object else (s <= LARGEST) & (s >= -LARGEST)
        same = group["labels"][anchor_at][:, None] == labels[None, :]
        for slot in range(slots):
            keys = anchor_at * slots + slot
            if limits is None:
                inside = same & (group["ids"][anchor_at][:, None] != ids[None, :])
            else:
                inside = ~same & (s <= limits[anchor_at, slot][:, None]) & (s >= floors[anchor_at, slot][:, None])
                if slot + 1 < slots:
                    inside &= s > limits[anchor_at, slot + 1][:, None]
            inside = (inside & fits & (s >= best.bound(keys, s.dtype)[:, None])).astype(bool)
            for a in np.flatnonzero(inside.any(axis=1)):
                at = np.flatnonzero(inside[a])
                mine = s[a, at]
                if len(at) > 4 * best.k and mine.dtype != object:   # the rest cannot be among the best; ties stay
                    at = at[mine >= np.partition(mine, len(mine) - best.k)[len(mine) - best.k]]
                    order = np.lexsort((labels[at], ids[at], -s[a, at]))[:best.k]
                    at = at[order]
                best.add(int(keys[a]), [(-int(s[a, i]), int(ids[i]), int(labels[i])) for i in at])

    return task


def _best_of_tasks(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each (anchor, slot) over all tasks."""
    order = Window.partitionBy("anchor_no", "slot").orderBy(F.desc("score"), "vec_id", "label")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _limits(positives: list, group: dict, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper limit and least score of each (anchor, slot); a missing positive's slot is empty."""
    kind = object if any(abs(r["score"]) > (1 << 53) for r in positives) else np.int64
    at = {n: i for i, n in enumerate(group["numbers"])}
    limits = np.full((len(at), k), -1, dtype=kind)            # windows below 0 are empty, so none reaches here
    floors = np.zeros((len(at), k), dtype=kind)
    for r in positives:
        i, j = at[r["anchor_no"]], r["place"] - 1
        limits[i, j], floors[i, j] = r["score"], -(-floor * r["score"] // 100)
    for j in range(k):
        floors[:, j] = np.maximum(floors[:, j], 0)
    return limits, floors


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, floor: int = 80,
                   scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor's windows.

    ``rows`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a
    condition on them.  A window takes negatives with
    ``floor * positive <= 100 * negative <= 100 * positive``.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "embedding")
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    anchors = numbered(rows.where(is_anchor), ["vec_id", "label"], "anchor_no", "n_anchors")
    anchors = written(anchors.select("anchor_no", "vec_id", "label", "embedding"))
    n, width = anchors.agg(F.count("*"), F.max(F.size("embedding"))).first()
    per_group = max(1, GROUP_BYTES // (8 * max(width or 1, 1)))
    folder = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
    for start in range(0, n, per_group):
        part = _group(anchors.where(F.col("anchor_no").between(start, start + per_group - 1)), scale)
        _mine(rows, part, positives, negatives, floor, scale).write.parquet(f"{folder}/group={start}")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/group={start}" for start in range(0, n, per_group)])


def _group(anchors: DataFrame, scale: int) -> dict:
    """One group's anchors (bounded by GROUP_BYTES), as arrays."""
    t = anchors.toArrow()
    vectors = [v for c in t.column("embedding").chunks for v in vectors_of(c, scale)]
    keep = [i for i, v in enumerate(vectors) if v is not None]
    return {"numbers": [t.column("anchor_no")[i].as_py() for i in keep], "vectors": [vectors[i] for i in keep],
            "ids": np.array([t.column("vec_id")[i].as_py() for i in keep], np.int64),
            "labels": np.array([t.column("label")[i].as_py() for i in keep], np.int64)}


def _mine(rows: DataFrame, group: dict, positives: int, negatives: int, floor: int, scale: int) -> DataFrame:
    """The result rows of one group of anchors."""
    spark = rows.sparkSession
    own = written(_best_of_tasks(rows.mapInArrow(_scan(group, positives, scale), _FOUND), positives))
    limits, floors = _limits(own.collect(), group, positives, floor)       # anchors of a group x positives
    slots = _best_of_tasks(rows.mapInArrow(_scan(group, negatives, scale, limits, floors), _FOUND), negatives)
    slots = slots.groupBy("anchor_no").agg(F.sort_array(F.collect_list(F.struct(
        "slot", "place", "vec_id", "score"))).alias("in_slots"))          # slots x negatives at most
    # a slot's suffix: its own best, then those of the slots below, which all score less
    suffix = F.slice(F.filter("in_slots", lambda x: x["slot"] >= F.col("place") - 1), 1, negatives)
    window = F.filter(suffix, lambda x: (F.lit(floor).cast("decimal(20,0)") * F.col("score") <= F.lit(100).cast("decimal(20,0)") * x["score"]))
    names = spark.createDataFrame(list(zip(group["numbers"], group["ids"].tolist())), "anchor_no long, anchor_id long")
    return (own.join(slots, "anchor_no").join(names, "anchor_no")
            .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                    F.posexplode(window).alias("at", "found"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
                    F.col("found.vec_id").alias("negative_id"), "positive_score",
                    F.col("found.score").alias("negative_score")))
