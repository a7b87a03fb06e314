"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import checkpoint_dir, cut_lineage

#: White space between words, everywhere in this package: U+0020 and U+0009-U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Bytes of SPACE_CLASS mapped to a blank, A-Z to a-z: for ``bytes.translate``.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
#: The same without lower-casing.
SPACE_BYTES = bytes(32 if 9 <= b <= 13 else b for b in range(256))
#: Bytes of rows that Spark packs for a Python task at once.  Up to Spark's own limit (64 MB) a batch is held
#: several times over, by Spark outside its heap and by the worker, which never gives all of it back.
BATCH_BYTES = 1 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark whatever the file system."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder; an error where none is set on a cluster."""
    folder = checkpoint_dir(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back, so that a
    lost executor never changes it or causes it to be computed anew."""
    shared_folder(df.sparkSession)
    return cut_lineage(df)


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, whose session packs about BATCH_BYTES for Python at once from now on; a limit that was set stays."""
    conf = docs.sparkSession.conf
    conf.set(_BATCH_SETTING, conf.get(_BATCH_SETTING, str(BATCH_BYTES)))
    return docs


def give_back() -> None:
    """Hand what this process has freed to the system: else Arrow and the C library keep it for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # of the GNU library only
    if trim is not None:
        trim(0)


def giving_back(task: Callable) -> Callable:
    """``task`` over batches, after which the worker, which stays for other tasks, holds no more than it needs."""
    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()
    return run


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda's variable, not a repeated expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(numbers: Column) -> Column:
    """The sum of all numbers before each place of an array of longs.

    An array can only grow by being copied, so the sums are made in about
    sqrt(n) blocks of sqrt(n) numbers, and each block is moved by the sum of
    those before it: n ** 1.5 steps instead of n ** 2.
    """
    def one_by_one(x: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(x, start, lambda acc, v: F.struct((acc["at"] + v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                           lambda acc: acc["out"])

    def in_blocks(size: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(numbers), size), lambda k: F.slice(numbers, k, size))
        total = lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, v: s + v)
        return let(blocks, lambda bs: let(one_by_one(F.transform(bs, total)), lambda before: F.flatten(F.transform(
            bs, lambda b, i: F.transform(one_by_one(b), lambda v: v + F.get(before, i))))))

    size = F.ceil(F.sqrt(F.size(numbers))).cast("int")
    return F.when(F.size(numbers) <= 16, one_by_one(numbers)).otherwise(let(size, in_blocks))


def texts_as_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A batch's texts in UTF-8; null is empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def words_of(text: bytes, lower: bool = True) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased on request."""
    return [w for w in text.translate(LOWER_BYTES if lower else SPACE_BYTES).split(b" ") if w]


def clear_of(docs: DataFrame, reserved: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns of reserved names renamed, and the function that gives a result
    exactly the columns that ``docs`` had."""
    away = {c: f"{c}__own{i}" for i, c in enumerate(docs.columns) if c.lower() in {r.lower() for r in reserved}}
    names = list(docs.columns)

    def back(result: DataFrame) -> DataFrame:
        return result.select(*[F.col(f"`{away.get(c, c)}`").alias(c) for c in names])

    return docs.withColumnsRenamed(away), back
