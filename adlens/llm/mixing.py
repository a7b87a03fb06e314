"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (source, language, topic) with their tokens.
Raking multiplies the cells' weights, margin by margin, until the weighted
tokens meet the target share of every source, language and topic; the factor
of a cell, scaled so that the largest is 1, is the probability with which each
of its documents is sampled.  The sample's expected token shares are then the
targets, and no document is needed twice.

The largest factor is what the whole sample pays for: every other document is
kept that much less often.  So ``tempered`` gives no value more than ``uplift``
times its observed share, and raking holds every cell's factor at ``most``: a
value or a cell of one document stays whole and sets no one else's rate, and
about 1 / ``most`` of the tokens or more are kept however skewed the cells are.

Topics are clusters of words: ``fit_topics`` fits them on all distinct texts,
and every text, whole, goes to the nearest one.  ``with_counts`` tokenises the
texts, once; the fit and the topics read its counts of hashed words.  Every
step of the fit is a Spark job that sums whole numbers over all texts, so that
the topics are the same whatever the partitions, and what reaches the driver is
at most ``TOPICS`` x ``TOPIC_BUCKETS`` sums.

The counting is one grouped aggregation (a hot source is summed in part by
every task).  Cells, not documents, are raked: on the driver while there are
at most ``DRIVER_CELLS`` of them, beyond by the same steps as Spark jobs over
the table of cells, with targets and shares as tables too.  ``reached`` tells
how near every value came to its target.  A document's draw is a hash of the seed, its id and its
text, so samples are repeatable and need no shuffle.

Defined results: a null source, language or topic is a value of its own (the
empty string); null and empty texts have no tokens and go with their cell; a
value without a target is not sampled, a target without documents is shared
out among the others; where empty cells make the targets contradict each
other, the last margins raked are met exactly and the others as nearly as the
steps reach; where cells are held at ``most``, targets are met as nearly as that
allows; repeated rows share one draw; an empty table gives an empty
result; other columns pass through, those named like an added one are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.session import cut_lineage

from .common import giving_back, in_small_batches, texts_as_bytes, words_of, written

#: Cells that are raked on the driver (and broadcast); more are raked by Spark.
DRIVER_CELLS = 200_000
#: Raking stops at this largest error of a share, or after so many rounds.
TOLERANCE, ROUNDS = 1e-9, 200
#: Halvings by which a table of targets finds its rate.
RATE_STEPS = 60
#: Largest target of a value over its observed share, and largest factor of a cell.
UPLIFT, MOST = 1.5, 2.5
#: Topics, and the least letters of a word that tells them.
TOPICS, TOPIC_LETTERS = 6, 6
#: Buckets that words are hashed to, steps of the fit at most, texts tried for the start of each topic, rounds of drawing them.
TOPIC_BUCKETS, TOPIC_STEPS, TOPIC_TRIES, TOPIC_ROUNDS = 4096, 15, 4, 2
#: Parts of 1 that the fit's sums are counted in, and entries of texts that a task holds at once.
TOPIC_UNIT, TOPIC_ENTRIES = 1 << 24, 100_000
#: Words whose buckets a task remembers.
REMEMBERED = 60_000
MARGINS = ("_source", "_lang", "_topic")
#: Columns that ``mixed`` adds.
ADDED = [*MARGINS, "_tokens", "_draw", "_probability", "_kept"]
#: Columns of ``with_counts`` that ``with_cells`` replaces by the topic: hash of the text, its buckets (2 bytes each) and the
#: square roots of their counts (4 bytes each).
COUNTED = ["_text_row", "_buckets", "_bucket_roots"]


def topic_of(words: list[bytes]) -> str:
    """Topic group of a text: that of its most frequent long word (the first in order, of equals)."""
    counts = Counter(w for w in words if len(w) >= TOPIC_LETTERS)
    if not counts:
        return "topic_none"
    most = max(counts.values())
    word = min(w for w, n in counts.items() if n == most)
    return f"topic_{sum(word) % TOPICS}"


def topic_counts(words: list[bytes], buckets: dict[bytes, int]) -> Counter:
    """How often each hash bucket of a text's long words occurs; ``buckets`` keeps those of words met."""
    counts: Counter = Counter()
    for w, n in Counter(w for w in words if len(w) >= TOPIC_LETTERS).items():
        if (b := buckets.get(w)) is None:
            if len(buckets) > REMEMBERED:
                buckets.clear()
            b = buckets[w] = zlib.crc32(w) % TOPIC_BUCKETS
        counts[b] += n
    return counts


@dataclass(frozen=True)
class Vectors:
    """Some texts as vectors of length 1 over buckets: entry ``i`` is ``x[i]`` in bucket ``at[i]`` of text ``row[i]``."""

    first: int                   # place of text 0 in its batch
    size: int
    row: np.ndarray
    at: np.ndarray
    x: np.ndarray
    there: np.ndarray            # texts with any word that tells

    def likeness(self, centres: np.ndarray) -> np.ndarray:
        """centres x texts; summed text by text, so that a text's batch makes no difference."""
        return np.array([np.bincount(self.row, self.x * c[self.at], self.size) for c in centres])


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(first entry of each row and the end, all entries) of a column of packed numbers."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    packed = data[int(offsets[0]):int(offsets[-1])].to_pybytes() if data is not None else b""
    return (offsets - offsets[0]) // np.dtype(kind).itemsize, np.frombuffer(packed, kind)


def _vectors(buckets: pa.Array, roots: pa.Array, weight: np.ndarray) -> Iterator[Vectors]:
    if not len(buckets):
        return
    (offsets, at_all), (_, roots_all), lo = _flat(buckets, np.uint16), _flat(roots, np.float32), 0
    while lo < len(buckets):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + TOPIC_ENTRIES, "right")) - 1)
        start, stop = int(offsets[lo]), int(offsets[hi])
        at = at_all[start:stop].astype(np.int64)
        row = np.repeat(np.arange(hi - lo), np.diff(offsets[lo:hi + 1]))
        x = roots_all[start:stop] * weight[at]
        norm = np.sqrt(np.bincount(row, x * x, hi - lo))
        yield Vectors(lo, hi - lo, row, at, x / np.where(norm > 0, norm, 1.0)[row], norm > 0)
        lo = hi


@dataclass(frozen=True)
class Topics:
    """Centres of clusters of texts over hashed words."""

    weight: np.ndarray           # of each bucket, by how few texts have it
    centres: np.ndarray          # topics x buckets, of length 1

    def column(self, buckets: str, roots: str) -> Column:
        """The topic of each text from its buckets and the roots of their counts."""
        weight, centres = self.weight, self.centres

        @F.arrow_udf("string")
        def topic(at: pa.Array, n: pa.Array) -> pa.Array:
            out = []
            for v in _vectors(at, n, weight):
                out += [f"topic_{k}" if there else "topic_none" for k, there in zip(v.likeness(centres).argmax(0), v.there)]
            return pa.array(out, pa.string())

        return topic(F.col(buckets), F.col(roots))


def _summed(rows: DataFrame, weight: np.ndarray, size: int, sums: Callable[[Vectors], np.ndarray]) -> np.ndarray:
    """The sum of ``sums`` (``size`` whole numbers) over all texts."""
    @giving_back
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for v in _vectors(batch.column("_buckets"), batch.column("_bucket_roots"), weight):
                total += sums(v).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["at", "n"])

    parts = rows.select("_buckets", "_bucket_roots").mapInArrow(add, "at long, n long")
    found = parts.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out


def _tried(rows: DataFrame, weight: np.ndarray, former: np.ndarray, step: int, number: int) -> np.ndarray:
    """``number`` texts drawn, by a hash, from all in proportion to how unlike every former one they are."""
    @giving_back
    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = []
        for batch in batches:
            buckets, roots = batch.column("_buckets"), batch.column("_bucket_roots")
            ids = batch.column("_text_row").to_numpy()
            draw = (batch.column("draw").to_numpy() + 0.5) / float(1 << 53)
            for v in _vectors(buckets, roots, weight):
                here = slice(v.first, v.first + v.size)
                unlike = np.where(v.there, 1.0 - v.likeness(former).max(0) if len(former) else 1.0, 0.0)
                key = np.full(v.size, np.inf)
                np.divide(-np.log(draw[here]), unlike, out=key, where=unlike > 1e-9)
                near = np.lexsort((ids[here], key))[:number]
                best += [(key[i], int(ids[v.first + i]), buckets[v.first + i].as_py(), roots[v.first + i].as_py())
                         for i in near if np.isfinite(key[i])]
                best = sorted(best)[:number]
        yield pa.RecordBatch.from_arrays([pa.array([b[i] for b in best], t) for i, t in enumerate(
            (pa.float64(), pa.int64(), pa.binary(), pa.binary()))], names=["key", "row", "at", "roots"])

    drawn = rows.withColumn("draw", F.xxhash64("_text_row", F.lit(step)).bitwiseAND((1 << 53) - 1))
    tried = drawn.mapInArrow(race, "key double, row long, at binary, roots binary").orderBy("key", "row").limit(number).collect()
    out = np.zeros((len(tried), TOPIC_BUCKETS))
    for i, r in enumerate(tried):
        at = np.frombuffer(r["at"], np.uint16)
        out[i, at] = np.frombuffer(r["roots"], np.float32) * weight[at]
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _means(rows: DataFrame, weight: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean, of length 1, of the texts nearest to each centre (the centre where there are none), and how many they are."""
    def total(v: Vectors) -> np.ndarray:
        own = v.likeness(centres).argmax(0)
        sums = np.bincount(own[v.row] * TOPIC_BUCKETS + v.at, np.rint(v.x * TOPIC_UNIT), centres.size)
        return np.concatenate([sums, np.bincount(own[v.there], minlength=len(centres))])

    found = _summed(rows, weight, centres.size + len(centres), total)
    sums = found[:centres.size].reshape(centres.shape).astype(float)
    sums = np.where(sums.any(1, keepdims=True), sums, centres)
    return sums / np.linalg.norm(sums, axis=1, keepdims=True), found[centres.size:]


def _starts(means: np.ndarray, texts: np.ndarray, topics: int) -> np.ndarray:
    """Up to ``topics`` of the means of so many ``texts`` each, one after the other the one that leaves all nearest to a start."""
    like, chosen = np.maximum(means @ means.T, 0.0), []
    best = np.zeros(len(means))
    while len(chosen) < min(topics, len(means)):
        gain = np.array([-1.0 if i in chosen else float((texts * np.maximum(like[i], best)).sum()) for i in range(len(means))])
        chosen.append(int(gain.argmax()))
        best = np.maximum(best, like[chosen[-1]])
    return means[chosen]


def fit_topics(docs: DataFrame, text_col: str = "text", topics: int = TOPICS, sample: int | None = None) -> Topics:
    """Spherical k-means over all distinct texts of ``docs``, which may have the columns of ``with_counts``.

    Words weigh by how few texts have them.  The starts are found as k-means||
    does: a few texts for each topic are drawn from all, in rounds, in
    proportion to how unlike those drawn before they are; every text is counted
    with the nearest of them, and of the means those that stand for the most
    texts are the starts.  Then every text goes to the nearest topic and topics become the
    mean of their texts, until nothing changes or ``TOPIC_STEPS`` times.  The
    fit depends on the texts alone.  A caller may ask for a ``sample`` of so
    many texts; no query does.
    """
    counted = docs if _is_counted(docs) else _with_buckets(docs.select(text_col), text_col)
    rows = counted.where("_text_row IS NOT NULL").select(*COUNTED).dropDuplicates(["_text_row"])
    rows = written(rows if sample is None else rows.orderBy("_text_row").limit(sample))
    even = np.ones(TOPIC_BUCKETS)
    seen = _summed(rows, even, TOPIC_BUCKETS, lambda v: np.bincount(v.at, minlength=TOPIC_BUCKETS))
    weight = np.where(seen > 0, np.log((rows.count() + 1) / np.maximum(seen, 1)), 0.0)
    tried = np.zeros((0, TOPIC_BUCKETS))
    for step in range(TOPIC_ROUNDS):
        tried = np.vstack([tried, _tried(rows, weight, tried, step, -(-TOPIC_TRIES * topics // TOPIC_ROUNDS))])
    if not len(tried):
        return Topics(weight, np.zeros((1, TOPIC_BUCKETS)))
    means, texts = _means(rows, weight, tried)
    centres = _starts(means, texts, topics)
    for _ in range(TOPIC_STEPS):
        former, (centres, _) = centres, _means(rows, weight, centres)
        if np.array_equal(former, centres):
            break
    return Topics(weight, centres)


def _with_buckets(docs: DataFrame, text_col: str) -> DataFrame:
    docs = in_small_batches(docs)

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: dict[bytes, int] = {}
        for batch in batches:
            words = (words_of(t) for t in texts_as_bytes(batch, text_col))
            found = [(len(w), topic_counts(w, buckets)) for w in words]
            yield (batch.append_column("_tokens", pa.array([n for n, _ in found], pa.int64()))
                   .append_column("_buckets", pa.array([np.fromiter(c, np.uint16, len(c)).tobytes() for _, c in found], pa.binary()))
                   .append_column("_bucket_roots", pa.array([np.sqrt(np.fromiter(c.values(), np.float32, len(c))).tobytes()
                                                             for _, c in found], pa.binary())))

    schema = T.StructType([*docs.schema.fields, T.StructField("_tokens", T.LongType()),
                           *[T.StructField(c, T.BinaryType()) for c in COUNTED[1:]]])
    row = F.when(F.col(text_col).isNotNull(), F.xxhash64(F.lit("topics"), F.col(text_col)))
    return docs.mapInArrow(count, schema).withColumn("_text_row", row)


def _draw(text_col: str) -> Column:
    return F.xxhash64(F.lit("mixing"), F.col("doc_id"), F.col(text_col)).bitwiseAND((1 << 53) - 1) / float(1 << 53)


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all that mixing takes from texts: _tokens, _draw and the columns ``COUNTED`` that topics read."""
    return _with_buckets(docs.drop(*ADDED, *COUNTED), text_col).withColumn("_draw", _draw(text_col))


def _is_counted(docs: DataFrame) -> bool:
    return {"_tokens", "_draw", *COUNTED} <= set(docs.columns)


def _with_groups(docs: DataFrame, text_col: str) -> DataFrame:
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(topic_of(w), len(w)) for w in (words_of(t) for t in texts_as_bytes(batch, text_col))]
            yield (batch.append_column("_topic", pa.array([x[0] for x in found], pa.string()))
                   .append_column("_tokens", pa.array([x[1] for x in found], pa.int64())))

    schema = T.StructType([*docs.schema.fields, T.StructField("_topic", T.StringType()), T.StructField("_tokens", T.LongType())])
    return docs.mapInArrow(describe, schema).withColumn("_draw", _draw(text_col))


def with_cells(docs: DataFrame, text_col: str = "text", topics: Topics | None = None) -> DataFrame:
    """``docs`` (doc_id, text, source, lang, ...) with _source, _lang, _topic, _tokens and _draw (0 to 1).

    With ``topics``, rows of ``with_counts`` need no text any more.  Without, a text's topic is only a
    group of its most frequent long word.
    """
    if topics is None:
        found = _with_groups(docs.drop(*ADDED), text_col)
    else:
        counted = docs if _is_counted(docs) else with_counts(docs, text_col)
        found = counted.withColumn("_topic", topics.column(*COUNTED[1:])).drop(*COUNTED)
    none = F.lit("")
    return found.withColumns({"_source": F.coalesce(F.col("source"), none), "_lang": F.coalesce(F.col("lang"), none)})


def bounded(raised: dict[str, float], observed: dict[str, float], uplift: float) -> dict[str, float]:
    """Shares in proportion to ``raised``, none above ``uplift`` (1 or more) times its observed share."""
    there, free, left = sum(observed.values()), sum(raised.values()), 1.0
    out = {}
    for k in sorted(raised, key=lambda k: (-raised[k] / observed[k], k)):    # those that gain most reach the bound first
        out[k] = min(raised[k] * left / free, uplift * observed[k] / there)
        left, free = max(left - out[k], 0.0), max(free - raised[k], 1e-300)
    return out


def bounded_table(values: DataFrame, margin: str, uplift: float) -> DataFrame:
    """``bounded`` over a table (margin, n, raised): (margin, share), by halving the interval of the common rate."""
    there = values.agg(F.sum("n")).first()[0] or 0
    limit = F.lit(float(uplift)) * F.col("n") / float(max(there, 1))

    def total(rate: float) -> float:
        return values.agg(F.sum(F.least(F.col("raised") * rate, limit))).first()[0] or 0.0

    low, high = 0.0, 1.0 / (values.agg(F.min("raised")).first()[0] or 1.0) * uplift
    for _ in range(RATE_STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return written(values.select(margin, F.least(F.col("raised") * high, limit).alias("share")))


def tempered(cells: DataFrame, power: dict[str, float], uplift: float = UPLIFT, driver_cells: int = DRIVER_CELLS) -> dict:
    """Targets for each margin: its observed token shares to a power, below 1 to level them, within ``uplift``.

    A margin's targets are a dict, or a table (margin, share) where there are more than ``driver_cells`` cells.
    """
    targets = {}
    large = cells.count() > driver_cells
    for margin, p in power.items():
        if large:
            values = written(cells.groupBy(margin).agg(F.sum("tokens").alias("n")).where("n > 0")
                             .withColumn("raised", F.pow(F.col("n").cast("double"), F.lit(float(p)))))
            targets[margin] = bounded_table(values, margin, uplift)
            continue
        rows = cells.groupBy(margin).agg(F.sum("tokens").alias("n")).where("n > 0").collect()     # a row for each value
        raised = {r[margin]: float(r["n"]) ** p for r in rows}
        targets[margin] = bounded(raised, {r[margin]: float(r["n"]) for r in rows}, uplift)
    return targets


def _shares(targets: dict[str, float], there) -> dict[str, float]:
    kept = {k: v for k, v in targets.items() if k in there and v > 0}
    return {k: v / sum(kept.values()) for k, v in kept.items()}


def _rake_here(cells, targets: dict[str, dict[str, float]], most: float = np.inf, rounds: int = ROUNDS) -> np.ndarray:
    """Factor, up to ``most``, of each cell of a pandas frame with the margins and ``tokens``."""
    tokens = cells["tokens"].to_numpy(float)
    factor = np.ones(len(cells))
    if not tokens.sum():
        return factor
    codes = {}
    for m, t in targets.items():
        values, code = np.unique(cells[m].to_numpy(str), return_inverse=True)
        share = _shares(t, set(values[np.bincount(code, tokens) > 0]))
        codes[m] = code, np.array([share.get(v, 0.0) for v in values])
    for _ in range(rounds):
        worst = 0.0
        for code, share in codes.values():
            now = np.bincount(code, tokens * factor, len(share))
            worst = max(worst, float(np.abs(now / max(now.sum(), 1e-300) - share).max(initial=0.0)))
            factor *= np.divide(share * tokens.sum(), now, out=np.zeros_like(now), where=now > 0)[code]
            np.minimum(factor, most, out=factor)
        if worst < TOLERANCE:
            break
    return factor


def _rake_apart(cells: DataFrame, targets: dict[str, dict[str, float]], rounds: int, most: float = np.inf) -> DataFrame:
    """The same steps as Spark jobs: one aggregation and join per margin, written after every round."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    now = cells.withColumn("factor", F.lit(1.0))
    shares = {}
    for m, t in targets.items():
        given = t if isinstance(t, DataFrame) else spark.createDataFrame(list(t.items()) or [("", 0.0)], f"{m} string, share double")
        there = cells.where("tokens > 0").select(m).distinct()
        kept = cut_lineage(given.where("share > 0").join(there, m, "left_semi"))
        whole = kept.agg(F.sum("share")).first()[0] or 1.0
        shares[m] = kept.select(m, (F.col("share") / whole).alias("share"))
    for _ in range(rounds):
        worst = []
        for m, share in shares.items():
            sums = now.groupBy(m).agg(F.sum(F.col("tokens") * F.col("factor")).alias("sum")).join(share, m, "left")
            wanted = F.coalesce("share", F.lit(0.0))
            step = F.when(F.col("sum") > 0, wanted * total / F.col("sum")).otherwise(0.0)
            ratio = written(sums.select(m, "sum", wanted.alias("share"), step.alias("step")))
            weight = ratio.agg(F.sum("sum")).first()[0] or 0.0
            off = F.abs(F.col("sum") / max(weight, 1e-300) - F.col("share"))
            worst.append(ratio.agg(F.max(off)).first()[0] or 0.0)
            ratio = ratio.select(m, "step")
            now = now.join(ratio, m).withColumn("factor", F.least(F.lit(float(most)), F.col("factor") * F.col("step"))).drop("step")
        now = written(now)
        if max(worst, default=0.0) < TOLERANCE:
            break
    return now


def raked(cells: DataFrame, targets: dict[str, dict[str, float]], driver_cells: int = DRIVER_CELLS,
          rounds: int = ROUNDS, most: float = np.inf) -> DataFrame:
    """``cells`` (margins, tokens) with each cell's ``probability``; no factor is above ``most``."""
    margins = list(targets)
    if cells.count() <= driver_cells and not any(isinstance(t, DataFrame) for t in targets.values()):
        here = cells.select(*margins, "tokens").toPandas()
        here["factor"] = _rake_here(here, targets, most, rounds)
        found = cells.sparkSession.createDataFrame(
            list(here[[*margins, "factor"]].itertuples(index=False, name=None)),
            ", ".join(f"{m} string" for m in margins) + ", factor double")
        largest = float(here.loc[here["tokens"] > 0, "factor"].max()) if (here["tokens"] > 0).any() else 0.0
        found = F.broadcast(found)
    else:
        found = _rake_apart(cells, targets, rounds, most)
        largest = found.where("tokens > 0").agg(F.max("factor")).first()[0] or 0.0
        found = found.select(*margins, "factor")
    scaled = F.least(F.lit(1.0), F.col("factor") / largest) if largest > 0 else F.lit(1.0)
    return found.withColumn("probability", scaled).drop("factor")


def reached(cells: DataFrame, found: DataFrame, targets: dict) -> DataFrame:
    """(margin, value, target, share, error): the expected token share of every value in the sample beside its target.

    ``found`` is the result of ``raked``.  Where cells are held at ``most``, or the rounds did not
    suffice, the errors say by how much.
    """
    spark = cells.sparkSession
    weighted = written(cells.join(found, list(targets)).withColumn("_w", F.col("tokens") * F.col("probability")))
    total = weighted.agg(F.sum("_w")).first()[0] or 0.0
    out = []
    for m, t in targets.items():
        given = t if isinstance(t, DataFrame) else spark.createDataFrame(list(t.items()) or [("", 0.0)], f"{m} string, share double")
        sums = weighted.groupBy(m).agg((F.sum("_w") / max(total, 1e-300)).alias("there"))
        both = sums.join(given, m, "full")
        out.append(both.select(F.lit(m).alias("margin"), F.col(m).alias("value"), F.coalesce("share", F.lit(0.0)).alias("target"),
                               F.coalesce("there", F.lit(0.0)).alias("share")))
    return reduce(DataFrame.union, out).withColumn("error", F.abs(F.col("share") - F.col("target")))


def mixed(celled: DataFrame, cells: DataFrame, targets: dict[str, dict[str, float]], **how) -> DataFrame:
    """Rows of ``with_cells`` with the ``_probability`` of their cell and whether the draw keeps them (``_kept``)."""
    found = raked(cells, targets, **how).withColumnRenamed("probability", "_probability")
    return celled.join(found, list(targets)).withColumn("_kept", F.col("_draw") < F.col("_probability"))


def cells_of(celled: DataFrame) -> DataFrame:
    return written(celled.groupBy(*MARGINS).agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("documents")))
