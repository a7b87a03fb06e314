"""Language-model scoring by Brown class-based bigrams.

Words fall into classes; the probability of a word after another is that of
its class after the other's class times that of the word within its class:
``P(w | v) = P(class w | class v) * P(w | class w)``.  Texts are sequences
that start after an end mark and finish with one.

1. Counts.  Every task counts its words; the counts of all training texts
   meet by word.  Their number grows with the corpus and they stay a table.
2. Vocabulary of the classes.  Words with at least one in ``SHARE`` of all
   training tokens (two occurrences at least) are frequent; there cannot be
   more than ``SHARE`` of them, which bounds what is sent to tasks at any
   size of the corpus.  All other words, unseen ones too, have a class given
   by their form (length and kind of the last character).
3. Texts become sequences of numbers of frequent words and classes of forms.
   Pairs of neighbours are counted per task and then by pair.
4. Exchange clustering of the frequent words.  A word's row has its left and
   right neighbours with counts.  For every word the change of the corpus's
   log-likelihood is computed for each class it could move to, exactly, from
   its neighbours' classes and the matrix of class pairs.  Half of the words
   may move at a time; where the moves together lower the likelihood, only
   the better half of them is kept, and so on.  A pass moves no data.
5. Scores.  Frequent words and all transitions are summed where the text is;
   the other words join the counts by word and are summed per text.

Smoothing: a transition is its relative frequency with ``PRIOR`` occurrences
of the following class's own share mixed in; in a class of forms unseen words
together have the mass of as many more tokens as the class has words (Witten
and Bell's estimate).

Defined results: null texts are empty, which is an end mark alone; a null id
is hashed as the empty text; repeated rows are scored and counted each; with
no training texts every token has the same class and word probabilities; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, texts_as_bytes, written

#: A frequent word has at least one in so many of all tokens; classes that words are exchanged between.
SHARE, CLASSES = 1 << 20, 64
#: Kinds of last characters and lengths that make the classes of forms, and the end mark's class after all.
KINDS, LENGTHS = 4, (3, 6, 9)
FORMS = KINDS * (len(LENGTHS) + 1)
END, ALL = CLASSES + FORMS, CLASSES + FORMS + 1
#: Rounds of the exchange, parts of the words that may move one after the other, weight of the prior.
ROUNDS, PARTS, PRIOR = 3, 2, 8.0
#: Words and pairs that a task counts before it hands them on; bytes of texts coded, and of one split, at once; words compared at once.
HELD, PAIRS, PART, PIECE, AT_ONCE = 300_000, 1_500_000, 4 << 20, 1 << 20, 128


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, in lists of bounded size."""
    start = 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and not (text[end] == 32 or 9 <= text[end] <= 13):
            end += 1
        yield text[start:end].translate(LOWER_BYTES).split()
        start = end


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch's rows in parts of about ``PART`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > PART:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    yield batch.slice(start)


def form_of(word: bytes) -> int:
    """The class of forms of a word, from 0 to FORMS - 1."""
    last = word[-1]
    kind = 0 if 97 <= last <= 122 else 1 if 48 <= last <= 57 else 2 if last < 128 else 3
    return kind * (len(LENGTHS) + 1) + sum(len(word) > n for n in LENGTHS)


#: -1 - form_of(word) by the word's last byte and its length, of which no more than LONGEST counts.
LONGEST = LENGTHS[-1] + 1
_FORM_CODES = [[0, *(-1 - form_of(b"x" * n + bytes([last])) for n in range(LONGEST))] for last in range(256)]


def is_training(doc_id: Column, folds: int = 5, held_out: int = 1) -> Column:
    """Whether a document is learned from: the remainder of its id's checksum is not ``held_out``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds != held_out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for part in parts_of(batch):
            for text in texts_as_bytes(part):
                for words in pieces_of(text):
                    held.update(words)
                if len(held) > HELD:
                    yield out(held)
                    held = Counter()
    yield out(held)


@dataclass
class Vocabulary:
    """Frequent words by number, with what all training tokens add up to."""

    words: dict[bytes, int]
    counts: np.ndarray          # of the frequent words, by number
    tokens: int                 # training tokens, end marks among them
    distinct: int               # distinct training tokens, the end mark among them
    texts: int                  # training texts, which are as many end marks
    least: int                  # occurrences of a frequent word


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """The frequent words of ``counts`` (word, n); at most SHARE of them reach the driver."""
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens = words + texts
    least = max(2, -(-tokens // SHARE))
    frequent = counts.where(F.col("n") >= least).toArrow()
    listed = sorted(zip(frequent.column("n").to_pylist(), frequent.column("word").to_pylist()), key=lambda x: (-x[0], x[1]))
    return Vocabulary({w: i for i, (_, w) in enumerate(listed)}, np.array([k for k, _ in listed], np.int64),
                      tokens, distinct + (texts > 0), texts, least)


_CODED = ("row_no long, n_tokens long, codes array<int>, others array<struct<word: binary, n: long>>")


class _Codes(dict):
    """Numbers of frequent words; any other word gives -1 - form and is noted in ``rest``."""

    def __init__(self, words: dict[bytes, int]):
        super().__init__(words)
        self.rest: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.rest.append(word)
        size = len(word)
        return _FORM_CODES[word[-1]][size if size < LONGEST else LONGEST]


def _code(words: dict[bytes, int], at: int):
    """Numbers of frequent words, -1 - form for the others; and the others with their counts."""
    def coded(codes_of: _Codes, texts: list[bytes], rows: pa.RecordBatch) -> pa.RecordBatch:
        codes, sizes, others, numbers, starts = [], [], [], [], [0]
        for text in texts:
            codes_of.rest, size = [], 0
            for piece in pieces_of(text):
                codes.append(np.fromiter(map(codes_of.__getitem__, piece), np.int32, len(piece)))
                size += len(piece)
            rest = Counter(codes_of.rest)
            sizes.append(size)
            others.extend(rest.keys())
            numbers.extend(rest.values())
            starts.append(len(others))
        codes_of.rest = []
        flat = pa.array(np.concatenate(codes) if codes else np.empty(0, np.int32), pa.int32())
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        pairs = pa.StructArray.from_arrays([pa.array(others, pa.binary()), pa.array(numbers, pa.int64())], ["word", "n"])
        columns = [rows.column("row_no"), pa.array([n + 1 for n in sizes], pa.int64()),
                   pa.ListArray.from_arrays(ends, flat), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pairs)]
        return pa.RecordBatch.from_arrays(columns + [rows.column(i) for i in range(at)], names=[
            "row_no", "n_tokens", "codes", "others"] + rows.schema.names[:at])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of = _Codes(words)
        for batch in batches:
            for part in parts_of(batch):
                yield coded(codes_of, texts_as_bytes(part), part)
    return task


def _pairs(n_words: int):
    """Counts of neighbouring codes; the end mark is code ``n_words`` and form f is ``n_words + 1 + f``."""
    width = n_words + 1 + FORMS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(chunks):
            pair, n = np.unique(np.concatenate(chunks), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pair // width, pa.int32()), pa.array(pair % width, pa.int32()),
                                               pa.array(n, pa.int64())], names=["a", "b", "n"])
        chunks, size = [], 0
        for batch in batches:
            column = batch.column("codes")
            ends, flat = np.asarray(column.offsets).astype(np.int64), np.asarray(column.values).astype(np.int64)
            flat, ends = flat[ends[0]:ends[-1]], ends - ends[0]
            flat = np.where(flat < 0, n_words - flat, flat)
            whole = np.insert(flat, ends, n_words)             # an end mark before the first text and after each
            chunks.append(whole[:-1] * width + whole[1:])
            size += len(whole)
            if size > PAIRS:
                yield out(chunks)
                chunks, size = [], 0
        if chunks:
            yield out(chunks)
    return task


_PACKED = {"other0": np.int32, "n0": np.int64, "other1": np.int32, "n1": np.int64}


def _neighbours(pairs: DataFrame) -> DataFrame:
    """One row for each code with its neighbours on both sides, at most two for each code there is.

    The four lists (following codes and counts, preceding codes and counts) are
    packed as bytes, since every step of the exchange reads them all again.
    """
    both = F.explode(F.array(F.struct(F.col("a").alias("code"), F.lit(True).alias("after"), F.col("b").alias("other"), "n"),
                             F.struct(F.col("b").alias("code"), F.lit(False).alias("after"), F.col("a").alias("other"), "n")))
    sided = pairs.select(both.alias("x")).select("x.*")
    rows = [F.collect_list(F.when(F.col("after") == after, F.col(c))).alias(f"{name}{i}")
            for i, after in enumerate((True, False)) for c, name in (("other", "other"), ("n", "n"))]
    return sided.groupBy("code").agg(*rows).mapInArrow(_pack, "code int, " + ", ".join(f"{c} binary" for c in _PACKED))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), AT_ONCE):
            rows = batch.slice(start, AT_ONCE)
            columns = [rows.column("code")]
            for name, kind in _PACKED.items():
                ends = np.asarray(rows.column(name).offsets)
                values = np.ascontiguousarray(np.asarray(rows.column(name).values)[ends[0]:ends[-1]], dtype=kind)
                at = ((ends - ends[0]) * values.itemsize).astype(np.int32)
                columns.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at), pa.py_buffer(values)]))
            yield pa.RecordBatch.from_arrays(columns, names=["code", *_PACKED])


def _near(batch: pa.RecordBatch, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, neighbour and count of everything packed for one side."""
    out = []
    for name in (f"other{side}", f"n{side}"):
        column, kind = batch.column(name), np.dtype(_PACKED[f"{name}"])
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
        data = column.buffers()[2]
        out.append(np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].copy().view(kind) if data is not None else np.empty(0, kind))
        sizes = np.diff(ends) // kind.itemsize
    return np.repeat(np.arange(len(batch)), sizes), *out


def _class_counts(batch: pa.RecordBatch, side: int, class_of: np.ndarray) -> np.ndarray:
    """Rows x classes: how often each row's neighbours of one side are of each class."""
    row, other, n = _near(batch, side)
    return np.bincount(row * ALL + class_of[other], weights=n, minlength=len(batch) * ALL).reshape(len(batch), ALL)


def _matrix(class_of: np.ndarray):
    """The task that counts pairs of classes: a row for each first class, a column for each next one."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALL * ALL)
        for batch in batches:
            row, other, n = _near(batch, 0)
            total += np.bincount(class_of[batch.column("code").to_numpy()][row] * ALL + class_of[other], weights=n, minlength=ALL * ALL)
        total = total.reshape(ALL, ALL)
        first = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32())] + [pa.array(c) for c in total[first].astype(np.int64).T],
                                         names=["first"] + [f"c{i}" for i in range(ALL)])
    return task


def class_matrix(near: DataFrame, class_of: np.ndarray) -> np.ndarray:
    """Counts of (class, next class) over all training texts."""
    columns = [f"c{i}" for i in range(ALL)]
    found = near.select("code", "other0", "n0").mapInArrow(_matrix(class_of), "first int, " + ", ".join(f"{c} long" for c in columns))
    out = np.zeros((ALL, ALL))
    for row in found.groupBy("first").agg(*[F.sum(c).alias(c) for c in columns]).collect():      # ALL rows at most
        out[row["first"]] = row[1:]
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.where(x > 0, x, 1.0))


def likelihood(matrix: np.ndarray) -> float:
    """The part of the training texts' log-likelihood that depends on the classes."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(1)).sum() - _xlogx(matrix.sum(0)).sum())


def move_gains(own: np.ndarray, right: np.ndarray, left: np.ndarray, itself: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Words x CLASSES: the likelihood with each word in each class, up to a constant of the word.

    ``own``: the words' classes; ``right`` and ``left``: how often each class
    follows and precedes the word, without the pairs of the word with itself
    (``itself``).  Exact for one move while all other words stay.
    """
    m, at = len(own), np.arange(len(own))
    without = np.repeat(matrix[None], m, axis=0)               # the matrix without the word
    without[at, own, :] -= right
    without[at, :, own] -= left
    without[at, own, own] -= itself
    logs = np.repeat(_xlogx(matrix)[None], m, axis=0)          # of ``without``, which differs in a row and a column
    logs[at, own, :] = _xlogx(without[at, own, :])
    logs[at, :, own] = _xlogx(without[at, :, own])
    rows, columns = without.sum(2) + left, without.sum(1) + right         # totals that hold wherever the word goes
    n_out, n_in = right.sum(1) + itself, left.sum(1) + itself
    first, diagonal = without[:, :CLASSES, :], np.arange(CLASSES)
    second = without[:, :, :CLASSES].transpose(0, 2, 1)
    gain = (_xlogx(first + right[:, None, :]) - logs[:, :CLASSES, :]).sum(2)
    gain += (_xlogx(second + left[:, None, :]) - logs[:, :, :CLASSES].transpose(0, 2, 1)).sum(2)
    cell = without[:, diagonal, diagonal]
    r, l_ = right[:, :CLASSES], left[:, :CLASSES]
    gain += _xlogx(cell + r + l_ + itself[:, None]) - _xlogx(cell + r) - _xlogx(cell + l_) + _xlogx(cell)
    gain -= _xlogx(rows[:, :CLASSES] + n_out[:, None]) - _xlogx(rows[:, :CLASSES])
    return gain - (_xlogx(columns[:, :CLASSES] + n_in[:, None]) - _xlogx(columns[:, :CLASSES]))


def _moves(class_of: np.ndarray, matrix: np.ndarray):
    """The task that finds the best class of each word it is given: (code, best, gain) of the words that gain."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), AT_ONCE):
                rows = batch.slice(start, AT_ONCE)
                code = rows.column("code").to_numpy()
                right, left = (_class_counts(rows, side, class_of) for side in (0, 1))
                row, near, n = _near(rows, 0)
                itself = np.bincount(row[near == code[row]], weights=n[near == code[row]], minlength=len(code))
                own, at = class_of[code].astype(np.int64), np.arange(len(code))
                right[at, own] -= itself
                left[at, own] -= itself
                value = move_gains(own, right, left, itself, matrix)
                gain = value - value[at, own][:, None]
                best = gain.argmax(1)
                better = gain[at, best] > 1e-6
                yield pa.RecordBatch.from_arrays([pa.array(code[better], pa.int32()), pa.array(best[better], pa.int32()),
                                                  pa.array(gain[at, best][better], pa.float64())], names=["code", "best", "gain"])
    return task


@dataclass
class Classes:
    """Class of every code, counts of class pairs, and the likelihood before and after each accepted step."""

    class_of: np.ndarray
    matrix: np.ndarray
    history: list[float]


def exchange(near: DataFrame, n_words: int, rounds: int = ROUNDS) -> Classes:
    """Exchange clustering of the frequent words; the likelihood never falls from step to step."""
    class_of = np.concatenate([np.arange(n_words) % CLASSES, [END], CLASSES + np.arange(FORMS)]).astype(np.int64)
    matrix = class_matrix(near, class_of)
    history = [likelihood(matrix)]
    for _ in range(rounds):
        before = history[-1]
        for part in range(PARTS):
            words = near.where((F.col("code") < n_words) & (F.col("code") % PARTS == part))
            found = words.mapInArrow(_moves(class_of, matrix), "code int, best int, gain double").toArrow()   # at most SHARE rows
            code, best, gain = (found.column(c).to_numpy() for c in ("code", "best", "gain"))
            order = np.lexsort((code, -gain))
            while len(order):
                tried = class_of.copy()
                tried[code[order]] = best[order]
                then = class_matrix(near, tried)
                if likelihood(then) > history[-1]:
                    class_of, matrix = tried, then
                    history.append(likelihood(then))
                    break
                order = order[:len(order) // 2]
        if history[-1] - before <= 1e-3 * abs(before):
            break
    return Classes(class_of, matrix, history)


@dataclass
class Model:
    words: Vocabulary
    classes: Classes
    transition: np.ndarray       # log10 P(next class | class)
    emission: np.ndarray         # log10 P(word | class) of the frequent words and the end mark
    form_tokens: np.ndarray      # training tokens of each class of forms
    unseen: np.ndarray           # probability that a token of a class of forms is an unseen word


def build(words: Vocabulary, classes: Classes, types: np.ndarray) -> Model:
    """Probabilities from the counts; ``types``: distinct training words of each class of forms."""
    matrix, n = classes.matrix, len(words.words)
    total = matrix.sum(0)                                      # every token follows another, so this counts tokens
    share = (total + 0.5) / (total.sum() + 0.5 * ALL)
    transition = np.log10((matrix + PRIOR * share[None, :]) / (matrix.sum(1)[:, None] + PRIOR))
    own = classes.class_of[:n]
    emission = np.concatenate([np.log10(words.counts / total[own]) if n else [], [0.0]])
    forms = total[CLASSES:CLASSES + FORMS]
    return Model(words, classes, transition, emission, forms, (types + 0.5) / (forms + types + 1))


def _score(model: Model):
    n = len(model.words.words)
    class_of, emission, transition = model.classes.class_of, model.emission, model.transition
    known = np.concatenate([np.log10(model.words.counts + 0.5), [math.log10(model.words.texts + 0.5)]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("codes")
            base, score, frequent = [], [], []
            ends = np.asarray(column.offsets)
            values = np.asarray(column.values)
            for i in range(len(column)):
                codes = values[ends[i]:ends[i + 1]].astype(np.int64)
                codes = np.append(np.where(codes < 0, n - codes, codes), n)
                classes = class_of[codes]
                here = codes[codes <= n]
                before = np.concatenate([[END], classes[:-1]])
                base.append(float(known[here].sum()))
                score.append(float(transition[before, classes].sum() + emission[here].sum()))
                frequent.append(len(here))
            yield pa.RecordBatch.from_arrays([batch.column("row_no"), pa.array(base, pa.float64()), pa.array(score, pa.float64()),
                                              pa.array(frequent, pa.int64())], names=["row_no", "base", "score", "frequent"])
    return task


def score_documents(docs: DataFrame, training: Column, rounds: int = ROUNDS) -> DataFrame:
    """Every row's tokens, training counts and log10 probabilities.

    ``docs`` has ``doc_id`` and ``text``; ``training`` is a condition on it.
    Columns: doc_id, training, n_tokens, n_known, train_tokens, base_score
    (add-one-half unigrams), score (the class model), perplexity (of the model).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(training, F.lit(False)).alias("training"))
    texts = docs.where("training").count()
    counts = written(docs.where("training").select("text").mapInArrow(_count, "word binary, n long")
                     .groupBy("word").agg(F.sum("n").alias("n")))
    words = vocabulary(counts, texts)
    n = len(words.words)
    coded = written(docs.withColumn("row_no", F.monotonically_increasing_id()).select("doc_id", "training", "text", "row_no")
                    .mapInArrow(_code(words.words, 2), f"{_CODED}, doc_id long, training boolean"))
    pairs = (coded.where("training").select("codes").mapInArrow(_pairs(n), "a int, b int, n long")
             .groupBy("a", "b").agg(F.sum("n").alias("n")))
    near = written(_neighbours(pairs))
    classes = exchange(near, n, rounds)

    form = _form_column("word")
    types = np.zeros(FORMS)
    for f, k in counts.where(F.col("n") < words.least).groupBy(form.alias("form")).count().collect():      # FORMS rows at most
        types[f] = k
    model = build(words, classes, types)

    own = coded.select("row_no", "codes").mapInArrow(_score(model), "row_no long, base double, score double, frequent long")
    rest = coded.select("row_no", F.explode("others").alias("o")).select("row_no", "o.word", F.col("o.n").alias("k"))
    rest = rest.join(counts.hint("shuffle_hash"), "word", "left").withColumn("form", form)
    tokens = F.array(*[F.lit(float(x)) for x in model.form_tokens])
    unseen = F.array(*[F.lit(float(x)) for x in model.unseen])
    within = F.when(F.col("n").isNull(), F.log10(F.get(unseen, "form"))).otherwise(
        F.log10((1 - F.get(unseen, "form")) * F.col("n") / F.get(tokens, "form")))
    rest = rest.groupBy("row_no").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rest_base"),
        F.sum(F.col("k") * within).alias("rest_score"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("rest_known"))
    below = math.log10(words.tokens + 0.5 * (words.distinct + 1))
    known_end = 0 if texts else 1                              # without training texts the end mark is unknown too
    found = coded.select("row_no", "doc_id", "training", "n_tokens").join(own, "row_no").join(rest, "row_no", "left")
    score = F.col("score") + F.coalesce("rest_score", F.lit(0.0))
    return found.select(
        "doc_id", "training", "n_tokens",
        (F.col("frequent") - known_end + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", F.lit(0.0)) - F.col("n_tokens") * below).alias("base_score"),
        score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"))


def _form_column(word: str) -> Column:
    """``form_of`` as an expression over a binary column."""
    size = F.octet_length(word)
    last = F.conv(F.hex(F.substring(word, -1, 1)), 16, 10).cast("int")
    kind = (F.when(last.between(97, 122), 0).when(last.between(48, 57), 1).when(last < 128, 2).otherwise(3))
    length = sum((F.when(size > n, 1).otherwise(0) for n in LENGTHS), F.lit(0))
    return (kind * (len(LENGTHS) + 1) + length).cast("int")
