"""Near-duplicate detection: circulant MinHash, banding, exact Jaccard verification.

A document's set is its distinct five-word shingles (words lower-cased A-Z).
Two permutations make all signature coordinates: the first scatters the
shingles over a ring of 2**32 places, the second is applied after shifting the
ring by k places for coordinate k, and the coordinate is the smallest value
(C-MinHash).  Bands of coordinates give the candidate links.

1. Signatures, set sizes and a digest of the word sequence, one pass over the
   texts (Arrow batches, vectorised).  Documents with equal words are one
   class; its smallest id stands for it, so copies cost nothing later on.
2. Classes that share a band meet in that band's bucket; buckets of one are
   dropped by a count.  Inside a bucket, signatures that agree in enough
   coordinates are connected; a bucket emits a forest, never its pairs.
3. The forest's components are coarse clusters, a superset of the true ones.
   Each cluster's texts meet once; exact intersections of the full sets,
   through an inverted index of the cluster, decide the links, and again only
   a forest is emitted: a link between two documents that are connected
   already adds nothing to components.
4. Components of the verified links, and the smallest id of each.

Large buckets and clusters are contracted first.  Every member is compared
with the group's pivot, its smallest node.  Members linked with the pivot (the
star) are connected already and never meet each other again.  The rest may
still hold a link to a member of the star, so both meet, but only where their
distances to the pivot allow it: differing coordinates and Jaccard distance
are metrics, so two members whose distances to the pivot differ by more than
the limit cannot be linked.  The rest, if still large, gets a pivot of its own
in the next round; what ``ROUNDS`` rounds leave is dealt into blocks, and
every pair of blocks is one unit of work.  No link is lost, no unit holds more
than two blocks, and a group of near copies is written a few times, whatever
its size.

Chance of losing a link at Jaccard 0.8: banding (0.59**24, under 1e-5) plus
the agreement filter (under 1e-7); at 0.85 together under 1e-7, and less above.

Defined results: null, empty or blank texts have an empty set and are linked
with nothing; with fewer than five words the whole sequence is the one
shingle; repeated rows get equal results, and rows that share an id but not
the words count as different documents; rows with a null id link to nothing,
have a null component and are kept; an empty table gives an empty result;
columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, clear_of, giving_back, in_small_batches, texts_as_bytes, written
from .components import connected_components
from .sharding import numbered

SHINGLE = 5
BANDS, BAND_ROWS = 24, 4
COORDINATES = BANDS * BAND_ROWS
#: Coordinates of 96 that must agree for a bucket to connect two classes (expected at 0.8: 77).
AGREE = 55
#: A bucket's block has at most about so many classes, a cluster's block so many shingles.
BLOCK_CLASSES, BLOCK_SHINGLES = 4000, 1_000_000
#: Rounds of contraction; large groups still left are dealt into pairs of blocks.
ROUNDS = 4
#: Two signatures whose differences to a third lie so many stripes of STRIPE coordinates apart differ too much.
STRIPE, APART = 14, 4
#: Up to so many members of clusters (40 bytes each) are broadcast; more are joined by shuffling.
BROADCAST_MEMBERS = 300_000
#: Bytes of text hashed at once.
CHUNK_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)           # odd: has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACES = np.array([0x8CB92BA72F3D8DD7, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                    0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _first_permutation(x: np.ndarray) -> np.ndarray:
    """64-bit shingle hashes scattered over the ring of 2**32 places."""
    return (_mix64(x) >> np.uint64(32)).astype(np.uint32)


def _second_permutation(x: np.ndarray) -> np.ndarray:
    """A bijection of the ring; called with shifted places."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        with np.errstate(over="ignore"):
            _POWERS[0] = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, x, np.uint64))])
                               for x in (_BASE, _BASE_INVERSE))
    return _POWERS[0]


def shingle_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all five-word shingles of some texts, and how many each text has.

    Words are hashed by a polynomial over their bytes, taken from prefix sums;
    a text with one to four words has the one shingle of all its words.
    """
    low = [t.translate(LOWER_BYTES) for t in texts]
    raw = np.frombuffer(b" ".join(low) + b" ", dtype=np.uint8)
    ends_of_texts = np.cumsum([len(t) + 1 for t in low])
    gap = raw == 32
    word = ~gap
    starts = np.flatnonzero(word & np.concatenate([[True], gap[:-1]]))
    ends = np.flatnonzero(word & np.concatenate([gap[1:], [True]])) + 1
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    with np.errstate(over="ignore"):
        power, inverse = _powers(len(raw))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)])])
        words = _mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        text_of = np.searchsorted(ends_of_texts, starts, side="right")
        n_words = np.bincount(text_of, minlength=len(texts))
        first = np.cumsum(n_words) - n_words
        n_shingles = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
        total = int(n_shingles.sum())
        at = np.arange(total) + np.repeat(first - (np.cumsum(n_shingles) - n_shingles), n_shingles)
        left = np.repeat(n_words + first, n_shingles)          # one past the text's last word
        out = np.zeros(total, np.uint64)
        for k in range(SHINGLE):
            there = at + k < left
            out += np.where(there, words[np.minimum(at + k, len(words) - 1)], np.uint64(0)) * _PLACES[k]
        return _mix64(out), n_shingles


def distinct_per_text(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text, and how many."""
    text = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[new], np.bincount(t[new], minlength=len(n))


def signatures(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Circulant MinHash signatures (texts x coordinates) of texts with at least one shingle each."""
    places = _first_permutation(hashes)
    starts = np.cumsum(n) - n
    out = np.empty((len(n), COORDINATES), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(COORDINATES):
            out[:, k] = np.minimum.reduceat(_second_permutation(places + np.uint32(k)), starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, the band's number mixed in."""
    with np.errstate(over="ignore"):
        key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(signature), axis=0)
        for r in range(BAND_ROWS):
            key = _mix64(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::BAND_ROWS].astype(np.uint64))
    return key.view(np.int64)


def _chunks(sizes: list[int]) -> Iterator[slice]:
    """Neighbouring texts of about CHUNK_BYTES together; a longer text is one by itself."""
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > CHUNK_BYTES:
            yield slice(start, i)
            start, size = i, 0
        size += n + 1
    if start < len(sizes):
        yield slice(start, len(sizes))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                     ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, text_hash = batch.column("doc_id"), batch.column("text_hash")
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        for part in _chunks(sizes):
            own = texts_as_bytes(batch.slice(part.start, part.stop - part.start))      # never a whole batch as objects
            hashes, n = distinct_per_text(*shingle_hashes(own))
            full = np.flatnonzero(n)
            signature = signatures(hashes, n[full]) if len(full) else np.empty((0, COORDINATES), np.uint32)
            keys, at = band_keys(signature), {int(i): j for j, i in enumerate(full)}
            digests = [hashlib.blake2b(b" ".join(t.translate(LOWER_BYTES).split()), digest_size=16).digest() for t in own]
            yield pa.RecordBatch.from_arrays([
                ids.slice(part.start, len(own)), text_hash.slice(part.start, len(own)), pa.array(n, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([(signature[at[i]] & 255).astype(np.uint8).tobytes() if i in at else None for i in range(len(own))], pa.binary()),
                pa.array([keys[at[i]] if i in at else None for i in range(len(own))], pa.list_(pa.int64()))], schema=_SIGNED)


def signed(docs: DataFrame) -> DataFrame:
    """Set size, digest of the words, signature (a byte per coordinate) and bands of every row of
    ``docs`` (doc_id, text_hash, text); signature and bands are null for empty sets."""
    return docs.mapInArrow(giving_back(_sign), "doc_id long, text_hash long, n_shingles long, digest binary, "
                                  "signature binary, bands array<long>")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group of a stream that is sorted by ``keys``, one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        change[0] = last is not None and last != tuple(c[0] for c in columns)
        cuts = [0, *np.flatnonzero(change), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if change[a] and held:
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def _forest(n: int, linked) -> list[tuple[int, int]]:
    """A spanning forest of the graph whose ``linked(i, rest)`` says which of ``rest`` node i is linked with."""
    rest, found = np.arange(n), []
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            i = front.pop()
            hit = linked(i, rest)
            found += [(i, int(j)) for j in rest[hit]]
            front += [int(j) for j in rest[hit]]
            rest = rest[~hit]
    return found


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges(pairs: list[tuple[int, int]], ids: np.ndarray) -> pa.RecordBatch:
    at = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ids[at[:, 0]]), pa.array(ids[at[:, 1]])], schema=_EDGES)


def _bucket_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _runs(batches, ["unit", "pair"]):
        ids, first = np.unique(group.column("node").to_numpy(), return_index=True)
        if len(ids) > 1:
            kept = group.column("payload").combine_chunks().take(pa.array(first))
            signature = np.frombuffer(b"".join(kept.to_pylist()), np.uint8).reshape(len(ids), COORDINATES)
            found = _forest(len(ids), lambda i, rest: (signature[rest] == signature[i]).sum(axis=1) >= AGREE)
            if found:
                yield _edges(found, ids)


def _verified_forest(threshold: int):
    """Links of 100 * intersection >= threshold * union between the full sets of a cluster's block pair."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["unit", "pair"]):
            ids, first = np.unique(group.column("node").to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            texts = [x or b"" for x in group.column("payload").combine_chunks().take(pa.array(first)).to_pylist()]
            parts = [distinct_per_text(*shingle_hashes(texts[p])) for p in _chunks([len(t) for t in texts])]
            hashes, n = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
            _, shingle = np.unique(hashes, return_inverse=True)
            owner = np.repeat(np.arange(len(n)), n)
            starts = np.cumsum(n) - n
            by = np.argsort(shingle, kind="stable")
            posting, ends = owner[by], np.cumsum(np.bincount(shingle))
            begins = ends - np.bincount(shingle)

            def linked(i, rest):
                own = shingle[starts[i]:starts[i] + n[i]]
                size = ends[own] - begins[own]
                at = np.repeat(begins[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                common = np.bincount(posting[at], minlength=len(n))[rest]
                return 100 * common >= threshold * (n[i] + n[rest] - common)

            if found := _forest(len(ids), linked):
                yield _edges(found, ids)
    return verify


def _block_pairs(df: DataFrame) -> DataFrame:
    """Each row (node, blocks) once for every pair of blocks that its block is in; ``pair`` holds both numbers."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    pair = lambda other: F.least(F.col("_own"), other) * F.col("blocks") + F.greatest(F.col("_own"), other)
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    return df.withColumn("_own", own).withColumn("pair", F.explode(F.transform(every, pair))).drop("_own", "blocks")


def _jaccard_to(threshold: int):
    """What ``_meet_pivot`` does with texts: exact links with the pivot, and Jaccard distances in thirds of the limit."""
    third = max(100 - threshold, 1) / 3

    def prepared(lead: bytes) -> np.ndarray:
        return np.unique(shingle_hashes([lead])[0])

    def compare(lead: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        near, stripe = [], []
        for part in _chunks([len(t) for t in texts]):
            hashes, n = distinct_per_text(*shingle_hashes(texts[part]))
            common = np.bincount(np.repeat(np.arange(len(n)), n)[np.isin(hashes, lead)], minlength=len(n))
            union = np.maximum(n + len(lead) - common, 1)
            near.append(100 * common >= threshold * union)
            stripe.append((100 * (union - common) / union) // third)
        return np.concatenate(near), np.concatenate(stripe)
    return prepared, compare


def _agreement():
    """What ``_meet_pivot`` does with signatures: enough agreement with the pivot, and differences in stripes."""
    def prepared(lead: bytes) -> np.ndarray:
        return np.frombuffer(lead, np.uint8)

    def compare(lead: np.ndarray, signatures_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        differ = (np.frombuffer(b"".join(signatures_), np.uint8).reshape(-1, COORDINATES) != lead).sum(axis=1)
        return differ <= COORDINATES - AGREE, differ // STRIPE
    return prepared, compare


_SEEN = pa.schema([("unit", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("payload", pa.binary()),
                   ("pivot", pa.int64()), ("near", pa.bool_()), ("stripe", pa.int32())])


def _meet_pivot(prepared, compare):
    """Members of each part of a group after the group's pivot, which leads the part; the pivot's copies are left out."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = lead = None
        for batch in batches:
            leads = np.flatnonzero(batch.column("lead").to_numpy(zero_copy_only=False))
            for a, b in zip([0, *leads], [*leads, batch.num_rows]):
                part = batch.slice(a, b - a)
                if part.num_rows and part.column("lead")[0].as_py():
                    pivot, lead = part.column("node")[0].as_py(), prepared(part.column("payload")[0].as_py() or b"")
                    part = part.slice(1)
                if part.num_rows:
                    near, stripe = compare(lead, [x or b"" for x in part.column("payload").to_pylist()])
                    yield pa.RecordBatch.from_arrays([
                        *[part.column(c) for c in ("unit", "node", "size", "payload")],
                        pa.array(np.full(part.num_rows, pivot, np.int64)), pa.array(near.astype(bool)),
                        pa.array(stripe.astype(np.int32))], schema=_SEEN)
    return meet


def _star_meets_rest(seen: DataFrame, apart: int, block: int) -> DataFrame:
    """(unit, pair, node, payload): blocks of the star and of the rest whose stripes are less than ``apart``
    apart, one ``pair`` for two blocks."""
    sizes = written(seen.groupBy("unit", "near", "stripe").agg(F.ceil(F.sum("size") / block).cast("long").alias("blocks")))
    others = sizes.select(F.col("unit").alias("_unit"), (~F.col("near")).alias("_near"),
                          F.col("stripe").alias("_stripe"), F.col("blocks").alias("_blocks"))
    meeting = sizes.join(others, (F.col("unit") == F.col("_unit")) & (F.col("near") == F.col("_near"))
                         & (F.abs(F.col("stripe") - F.col("_stripe")) < apart))
    rows = seen.join(meeting.drop("_unit", "_near"), ["unit", "near", "stripe"])
    rows = rows.withColumn("_own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    mine, theirs = ["stripe", "_own"], ["_stripe", "_other"]
    # a number for two blocks; if two of them shared one, more members would meet, none fewer
    pair = F.when(F.col("near"), F.xxhash64("pivot", *mine, *theirs)).otherwise(F.xxhash64("pivot", *theirs, *mine))
    return rows.select("unit", pair.alias("pair"), "node", "payload")


def _contracted(hot: DataFrame, meet, apart: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Links of large groups with their pivots, and the units of work that hold all other possible links.

    ``hot`` has unit (the group), node, size, payload and blocks.
    """
    columns = ["unit", "pair", "node", "payload"]
    links, units = [], []
    for _ in range(ROUNDS):
        pivots = hot.groupBy("unit").agg(F.min("node").alias("pivot"), F.first("blocks").alias("_parts"))
        leads = hot.join(pivots.withColumnRenamed("unit", "_unit"), (F.col("unit") == F.col("_unit")) & (F.col("node") == F.col("pivot")))
        leads = leads.select("unit", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("part"),
                             F.lit(True).alias("lead"), "node", "size", "payload")
        members = hot.select("unit", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("part"),
                             F.lit(False).alias("lead"), "node", "size", "payload")
        rows = leads.unionByName(members).repartition("unit", "part")
        rows = rows.sortWithinPartitions("unit", "part", F.desc("lead")).drop("part")
        seen = written(rows.mapInArrow(giving_back(meet), "unit long, node long, size long, payload binary, pivot long, near boolean, stripe int"))
        links.append(seen.where("near AND node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")))
        units.append(_star_meets_rest(seen, apart, block))
        rest = seen.where("NOT near")
        left = written(rest.groupBy("unit").agg(F.ceil(F.sum("size") / block).cast("long").alias("blocks")))
        rest = rest.join(left, "unit").select("unit", "node", "size", "payload", "blocks")
        units.append(rest.where("blocks = 1").withColumn("pair", F.lit(0).cast("long")).select(*columns))
        hot = rest.where("blocks > 1")
        if not left.where("blocks > 1").limit(1).count():
            break
    else:
        units.append(_block_pairs(hot).select(*columns))
    return reduce(DataFrame.union, links), reduce(DataFrame.union, units)


def coarse_links(classes: DataFrame) -> DataFrame:
    """Forest links (a, b) between classes (node, signature, bands) that share a band and agree enough."""
    meets = classes.select("node", F.explode("bands").alias("band"))
    full = meets.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    full = written(full.select("band", F.ceil(F.col("n") / BLOCK_CLASSES).cast("long").alias("blocks")))
    large = full.where("blocks > 1")
    rows = meets.join(full, "band").join(classes.select("node", "signature"), "node")
    units = rows.where("blocks = 1").select(F.col("band").alias("unit"), F.lit(0).cast("long").alias("pair"), "node", F.col("signature").alias("payload"))
    links = None
    if large.limit(1).count():
        hot = written(rows.where("blocks > 1").select(
            F.col("band").alias("unit"), "node", F.lit(1).cast("long").alias("size"), F.col("signature").alias("payload"), "blocks"))
        links, more = _contracted(hot, _meet_pivot(*_agreement()), APART, BLOCK_CLASSES)
        units = units.unionByName(more)
    units = units.repartition("unit", "pair").sortWithinPartitions("unit", "pair")
    found = units.mapInArrow(giving_back(_bucket_forest), "a long, b long")
    return found if links is None else found.union(links)


def verified_links(texts: DataFrame, clusters: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Forest links (a, b) inside each cluster by exact Jaccard on full sets.

    ``texts`` has doc_id, text_hash and text, ``classes`` what stands for each
    node.  The members are broadcast only after their number was checked.
    """
    members = classes.join(clusters.withColumnRenamed("component", "unit"), "node")
    blocks = members.groupBy("unit").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("long").alias("blocks"))
    members = written(members.join(blocks, "unit").select("node", "doc_id", "text_hash", "unit", "n_shingles", "blocks"))

    def rows_of(kept: DataFrame) -> DataFrame:
        if kept.count() <= BROADCAST_MEMBERS:
            kept = F.broadcast(kept)
        return texts.join(kept, ["doc_id", "text_hash"]).withColumn("payload", F.col("text").cast("binary"))

    units = rows_of(members.where("blocks = 1")).select("unit", F.lit(0).cast("long").alias("pair"), "node", "payload")
    links = None
    if members.where("blocks > 1").limit(1).count():
        hot = written(rows_of(members.where("blocks > 1")).select("unit", "node", F.col("n_shingles").alias("size"), "payload", "blocks"))
        # stripes are thirds of the limit: from the fifth on the difference is above it, whatever the rounding
        links, more = _contracted(hot, _meet_pivot(*_jaccard_to(threshold)), 5, BLOCK_SHINGLES)
        units = units.unionByName(more)
    units = units.repartition("unit", "pair").sortWithinPartitions("unit", "pair")
    found = units.mapInArrow(giving_back(_verified_forest(threshold)), "a long, b long")
    return found if links is None else found.union(links)


def near_duplicates(docs: DataFrame, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept of every row; ``threshold`` is per cent of Jaccard."""
    rows = in_small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                                         F.col(text_col).alias("text"))
    sets = written(signed(rows))
    linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    classes = sets.where(linkable).groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("row"), F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    # nodes are numbered in the order of ids, so a component's smallest node has its smallest id
    classes = numbered(classes.select("row.doc_id", "row.text_hash", "digest", "n_shingles", "signature", "bands"),
                       ["doc_id", "digest"], "node", "n_nodes").drop("n_nodes")
    clusters = written(connected_components(coarse_links(classes)))
    stands = classes.select("node", "doc_id", "text_hash", "digest", "n_shingles")
    found = connected_components(verified_links(rows, clusters, stands, threshold))
    names = stands.select(F.col("node").alias("component"), F.col("doc_id").alias("component_id"))
    linked = found.join(names, "component").join(stands.select("node", "digest"), "node").select("digest", "component_id")
    own = stands.select("digest", F.col("doc_id").alias("own_id"))
    named = own.join(linked, "digest", "left").select("digest", F.coalesce("component_id", "own_id").alias("component_id"))
    named = written(named)          # then both sides of the next join are plain exchanges, whose hot digests Spark splits
    columns = ["doc_id", "text_hash", "n_shingles", "component_id"]
    out = sets.where(linkable).join(named, "digest").select(*columns)
    alone = sets.where(~linkable).withColumn("component_id", F.col("doc_id")).select(*columns)
    return out.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but one row of each group of near-duplicates; all columns pass through.

    The rows to drop are taken out by an anti-join on (id, hash of the text),
    broadcast only after their number was checked.  Rows that share id and
    text count as copies of one document: one of them stays.
    """
    found = written(near_duplicates(docs, threshold, id_col, text_col).select("doc_id", "text_hash", "kept"))
    dropped = found.where(~F.col("kept")).select("doc_id", "text_hash").distinct()
    repeated = written(found.groupBy("doc_id", "text_hash").count().where("count > 1").select("doc_id", "text_hash"))

    def matching(rows: DataFrame, keys: DataFrame, kind: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        if keys.count() <= BROADCAST_MEMBERS:
            keys = F.broadcast(keys)
        return rows.join(keys, rows["_row_id"].eqNullSafe(keys["_id"]) & (rows["_row_hash"] == keys["_hash"]), kind)

    docs, back = clear_of(docs, ["_row_id", "_row_hash", "_id", "_hash"])
    rows = docs.withColumns({"_row_id": F.col(id_col).cast("long"), "_row_hash": F.xxhash64(text_col)})
    rows = matching(rows, written(dropped), "left_anti")
    if repeated.limit(1).count():
        once = matching(rows, repeated, "left_semi").dropDuplicates(["_row_id", "_row_hash"])
        rows = matching(rows, repeated, "left_anti").unionByName(once)
    return back(rows)
