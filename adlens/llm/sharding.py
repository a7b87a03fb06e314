"""Sharding: a Feistel permutation of global row numbers.

Every row gets a gapless global number (its rank by id, checksum and size),
a keyed permutation of 0..n-1 turns the number into a place, and the place
gives shard (place mod shards) and slot (place div shards).  Shard and slot
of any row are therefore computable from its number, the seed and n alone,
and shard sizes differ by one row at most.

The permutation is a Feistel network over the grid a x b that just covers n
(a = ceil(sqrt n), b = ceil(n / a)): each round adds a keyed hash of one
half to the other, modulo that half's size.  Fewer than ``a`` of the a*b
points lie beyond n; a row that lands there walks on (the permutation is
applied again) until it is inside, which keeps it a permutation of 0..n-1.

Only DataFrame functions are used.  Numbering takes one range shuffle of the
narrow columns (texts stay behind) and a table of one row per partition.

Defined results: null text has size 1 and the checksum of the empty text;
null ids sort first; equal ids are ordered by checksum, size and a hash of
the text, rows equal in all of these are interchangeable; an empty table
gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

ROUNDS = 6
#: Modulus and multipliers of the round hash; products stay below 2**62.
PRIME, MUL1, MUL2 = 2147483647, 1103515245, 1664525247
#: Walks beyond n; each has a chance of about 1/sqrt(n), and below 256 rows no walk is longer.
WALKS = 16


def round_keys(seed: int) -> list[int]:
    """One key below PRIME for each round, from the seed."""
    keys, x = [], (seed * 2654435761 + 12345) % PRIME
    for _ in range(ROUNDS):
        x = (x * 48271 + 11) % PRIME
        keys.append(x)
    return keys


def numbered(df: DataFrame, order: list[str], number: str = "row_no", total: str = "n_rows") -> DataFrame:
    """``df`` with each row's rank from 0 by ``order`` and the number of rows.

    The rows are range-partitioned and sorted, and written with their place
    in the partition; a running sum over the partitions' sizes gives the
    ranks.  No window spans the rows.
    """
    dealt = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    dealt = written(dealt.withColumn("_place", F.monotonically_increasing_id()))
    dealt = dealt.withColumns({"_part": F.shiftright("_place", 33),
                               "_at": F.col("_place").bitwiseAND((1 << 33) - 1)}).drop("_place")
    parts = dealt.groupBy("_part").agg((F.max("_at") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
                         F.sum("_size").over(every).alias(total))
    return (dealt.join(parts, dealt["_part"] == parts["_p"])
            .withColumn(number, F.col("_before") + F.col("_at")).drop("_part", "_at", "_p", "_before", "_size"))


def _round_hash(y: Column, key: Column) -> Column:
    first = (y * MUL1 + key) % PRIME
    second = (first.bitwiseXOR(F.shiftright(first, 15)) * MUL2 + key) % PRIME
    return second.bitwiseXOR(F.shiftright(second, 13))


def _network(value: Column, a: Column, b: Column, seed: int) -> Column:
    """One pass of the Feistel network over 0 .. a*b-1."""
    def one_round(h: Column, key: Column) -> Column:
        return F.struct(h["y"].alias("x"), ((h["x"] + _round_hash(h["y"], key)) % h["mx"]).alias("y"),
                        h["my"].alias("mx"), h["mx"].alias("my"))

    start = F.struct(((value - value % b) / b).cast("long").alias("x"),
                     (value % b).alias("y"), a.alias("mx"), b.alias("my"))
    keys = F.array(*[F.lit(k).cast("long") for k in round_keys(seed)])
    return F.aggregate(keys, start, one_round, lambda h: h["x"] * h["my"] + h["y"])


def permuted(df: DataFrame, number: str, total: str, seed: int, place: str = "place") -> DataFrame:
    """``df`` with the permuted place (0 .. total-1) of each row number."""
    n = F.col(total)
    df = df.withColumn("_a", F.ceil(F.sqrt(n)).cast("long"))
    df = df.withColumn("_b", F.ceil(n / F.col("_a")).cast("long"))
    a, b = F.col("_a"), F.col("_b")
    df = df.withColumn("_first", _network(F.col(number), a, b, seed))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), F.col("_first"),
                         lambda v, _: F.when(v < n, v).otherwise(_network(v, a, b, seed)))
    df = df.withColumn("_walked", walked)
    inside = F.when(F.col("_walked") < n, F.col("_walked")).otherwise(
        F.raise_error(F.lit("a cycle walk did not end")).cast("long"))
    return df.withColumn(place, inside).drop("_a", "_b", "_first", "_walked")


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 2024, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Shard and slot of every document, with its size and checksum.

    Law ``rows``: shard counts are at most one apart; slots have no gaps.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_text_hash"))
    rows = numbered(rows, ["doc_id", "text_crc32", "size", "_text_hash"])
    rows = permuted(rows, "row_no", "n_rows", seed)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        ((F.col("place") - F.col("place") % shards) / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_no")


def place_of(number: int, total: int, seed: int) -> int:
    """The same permutation for one row number, in plain Python: where a row
    lies can be computed without the table."""
    a = int(total ** 0.5)
    a += a * a < total
    b = -(-total // a)
    value = number
    while True:
        x, y, mx, my = value // b, value % b, a, b
        for key in round_keys(seed):
            h = (y * MUL1 + key) % PRIME
            h = ((h ^ (h >> 15)) * MUL2 + key) % PRIME
            x, y, mx, my = y, (x + (h ^ (h >> 13))) % mx, my, mx
        value = x * my + y
        if value < total:
            return value
