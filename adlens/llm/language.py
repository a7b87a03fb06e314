"""Language identification by fusing evidence.

For every text the posterior of each language is proportional to

* the text's likelihood: hashed byte trigrams, counted by language over all
  labelled texts in one grouped aggregation;
* the chance of the language that the markup declares, and of that in the
  address (country suffix or a two-letter first folder): how often a
  declaration goes with each language is counted on the rows themselves;
* the host's prior: the languages of the host's other rows, shrunk towards
  those of its domain, which are shrunk towards all rows'.  These sums come
  from grouped aggregations of the text posteriors, so a host with a third of
  all rows is summed in part by every task.

Sizes that reach the driver are bounded by the languages (at most
``MAX_LANGUAGES``): one trigram table and the declaration counts.  The join of
rows with their host's sums is an equi-join that Spark splits where a host is
hot.

Defined results: null and empty texts have no likelihood and rest on the other
evidence; unknown declarations count as none; a null host is a host of its
own; ties go to the language first in the alphabet; without training texts
every language is null; repeated rows get equal results; an empty table gives an empty result;
columns not named are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Hash buckets of trigrams; languages that a model has at most, and the code of all others together beyond.
BUCKETS, MAX_LANGUAGES, OTHERS = 1 << 13, 256, "und"
#: Overlapping trigrams repeat each other's evidence; its weight is this part.
TEXT_WEIGHT = 0.3
#: Pseudo-rows of the domain's mix in a host's, of all rows' in a domain's, of a uniform mix in a declaration's.
HOST_SHRINK, DOMAIN_SHRINK, DECLARED_SHRINK = 5.0, 20.0, 2.0
#: Country suffixes that stand for a language of another code.
SUFFIX_LANGUAGE = {"at": "de", "mx": "es", "ar": "es", "cl": "es", "uk": "en", "us": "en", "au": "en", "ie": "en", "br": "pt"}
CHUNK_BYTES = 1 << 20

_LETTERS = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_OPENS = re.compile(r"<(script|style)\b", re.IGNORECASE)
_CLOSES = re.compile(r"</(script|style)\s*>", re.IGNORECASE)
_SPACES = re.compile(rb" {2,}")


def visible_text(page: str | None) -> str:
    """A page's text without tags, scripts, styles and comments, in time linear in its length.

    A comment, script or style that nothing closes is only a tag, and a ``<``
    that no ``>`` follows is text.  What is searched for further on (the next
    end of a comment, closing tag or ``>``) is looked up once and kept until
    the scan has passed it.
    """
    page = page or ""
    out, at, comment, tag = [], 0, 0, 0
    closings: dict[str, list[tuple[int, int]]] | None = None
    while (lt := page.find("<", at)) >= 0:
        out.append(page[at:lt])
        end = -1
        if page.startswith("<!--", lt):
            if 0 <= comment < lt + 4:
                comment = page.find("-->", lt + 4)
            end = comment + 3 if comment >= 0 else -1
        elif opening := _OPENS.match(page, lt):
            if closings is None:
                closings = {"script": [], "style": []}
                for m in _CLOSES.finditer(page):
                    closings.setdefault(m[1].lower(), []).append((m.start(), m.end()))
            own = closings.get(opening[1].lower(), [])
            k = bisect_left(own, (opening.end(), 0))
            end = own[k][1] if k < len(own) else -1
        if end < 0:
            if 0 <= tag < lt + 1:
                tag = page.find(">", lt + 1)
            if tag < 0:
                at = lt
                break
            end = tag + 1
        out.append(" ")
        at = end
    return html.unescape("".join(out) + page[at:])


def trigram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts, and how many each text has (a text's length in bytes, as it is padded)."""
    raws = [_SPACES.sub(b" ", t.lower().encode("utf-8", "replace").translate(_LETTERS)) for t in texts]
    raws = [b"" if not r.strip() else r for r in raws]
    n = np.array([len(r) for r in raws], dtype=np.int64)
    joined = np.frombuffer(b"".join(r + b"  " for r in raws), dtype=np.uint8).astype(np.uint32)
    if not n.sum():
        return np.empty(0, np.int64), n
    with np.errstate(over="ignore"):
        mixed = joined[:-2] * np.uint32(0x01000193) ^ joined[1:-1] * np.uint32(0x0001F351) ^ joined[2:] * np.uint32(0x9E3779B1)
        mixed = (mixed * np.uint32(0x85EBCA6B)) >> np.uint32(19)
    starts = np.cumsum(n + 2) - (n + 2)
    at = np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)
    return mixed[at].astype(np.int64), n


def _chunks(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, x in sums.items():
            there = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(there), pa.string()), pa.array(there, pa.int64()),
                                              pa.array(x[there], pa.int64())], names=["lang", "bucket", "n"])

    for batch in batches:
        texts, langs = [x or "" for x in batch.column("text").to_pylist()], batch.column("lang").to_pylist()
        for part in _chunks(texts):
            buckets, n = trigram_buckets(texts[part])
            names = sorted(set(langs[part]))
            of = np.repeat([names.index(x) for x in langs[part]], n)
            both = np.bincount(of * BUCKETS + buckets, minlength=len(names) * BUCKETS) if len(buckets) else None
            for i, lang in enumerate(names if both is not None else ()):
                own = both[i * BUCKETS:(i + 1) * BUCKETS]
                sums[lang] = sums[lang] + own if lang in sums else own
        if len(sums) > MAX_LANGUAGES:
            yield from out()
            sums.clear()
    yield from out()


class TextModel:
    """Log-likelihoods of trigrams by language."""

    def __init__(self, langs: list[str], table: np.ndarray):
        self.langs, self.table = langs, table

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood of each text (rows) in each language, weighted; zero for empty texts."""
        out = np.zeros((len(texts), len(self.langs)))
        for part in _chunks(texts):
            buckets, n = trigram_buckets(texts[part])
            full = np.flatnonzero(n)
            if len(full):
                starts = np.cumsum(n[full]) - n[full]
                for k in range(len(self.langs)):
                    out[part.start + full, k] = TEXT_WEIGHT * np.add.reduceat(self.table[k][buckets], starts)
        return out


def train(texts: DataFrame) -> TextModel:
    """Counts over all rows of ``texts`` (text, lang) whose language is known."""
    known = texts.where("lang is not null and text is not null").select("text", "lang")
    counted = known.mapInArrow(_count_trigrams, "lang string, bucket long, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = written(rows)
    sizes = written(rows.groupBy("lang").agg(F.sum("n").alias("size")))
    most = sizes.orderBy(F.desc("size"), "lang").limit(MAX_LANGUAGES)
    if sizes.count() > MAX_LANGUAGES:                           # all others together are one more language
        kept = F.broadcast(most.limit(MAX_LANGUAGES - 1).select(F.col("lang").alias("_kept")))
        rows = rows.join(kept, F.col("lang") == F.col("_kept"), "left").groupBy(
            F.coalesce("_kept", F.lit(OTHERS)).alias("lang"), "bucket").agg(F.sum("n").alias("n"))
        rows = written(rows)
    langs = sorted(x["lang"] for x in rows.select("lang").distinct().collect())
    table = np.full((len(langs), BUCKETS), 0.5)
    place = {x: i for i, x in enumerate(langs)}
    got = rows.toPandas()                                       # at most MAX_LANGUAGES * BUCKETS short rows
    table[got["lang"].map(place).to_numpy(int), got["bucket"].to_numpy(int)] += got["n"].to_numpy(float)
    return TextModel(langs, np.log(table / table.sum(axis=1, keepdims=True)))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def domain_of(host: Column) -> Column:
    """The host's last two labels."""
    return F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)


def declared_language(page: Column) -> Column:
    """Language in the markup: the html element's, or a content-language header's."""
    own = F.regexp_extract(page, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    meta = F.regexp_extract(page, r"(?i)http-equiv\s*=\s*[\"']?content-language[\"']?\s+content\s*=\s*[\"']?([A-Za-z]+)", 1)
    return F.lower(F.when(own != "", own).otherwise(meta))


def address_language(url: Column, host: Column) -> Column:
    """Language in the address: a country suffix, else a two-letter first folder."""
    suffix = F.regexp_extract(host, r"\.([a-z]{2})$", 1)
    folder = F.lower(F.regexp_extract(url, r"^[^/]*//[^/]+/([A-Za-z]{2})(?:[-_/?#]|$)", 1))
    table = F.create_map(*[F.lit(x) for kv in SUFFIX_LANGUAGE.items() for x in kv])
    return F.when(folder != "", folder).otherwise(F.coalesce(F.try_element_at(table, suffix), suffix))


def _posterior(log: np.ndarray) -> np.ndarray:
    x = np.exp(log - log.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _score(model: TextModel, keep: tuple[str, ...]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            markup = batch.column("_markup").to_pylist()
            texts = [visible_text(x) if m else x or "" for x, m in zip(batch.column("_text").to_pylist(), markup)]
            log = model.scores(texts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(list(log), pa.list_(pa.float64())),
                 pa.array(list(_posterior(log)), pa.list_(pa.float64())), pa.array(log.argmax(axis=1), pa.int32())],
                names=[*keep, "text_log", "text_posterior", "text_best"])
    return score


def _fuse(langs: list[str], declared: dict, address: dict, total: np.ndarray, keep: tuple[str, ...]):
    total = (total + 1) / (total + 1).sum()

    def table(counts: dict) -> dict[str, np.ndarray]:
        """log P(declaration | language), smoothed; relative to the declaration's overall share."""
        return {code: np.log((x + DECLARED_SHRINK * total) / ((x.sum() + DECLARED_SHRINK) * total)) for code, x in counts.items()}

    by_declared, by_address = table(declared), table(address)

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = lambda c: np.array(batch.column(c).to_pylist(), float).reshape(-1, len(langs))
            own, host, domain = matrix("text_posterior"), matrix("host_sum"), matrix("domain_sum")
            beyond = np.maximum(domain - host, 0)                         # the domain's other hosts
            host = np.maximum(host - own, 0)                              # the host's other rows
            mix = (beyond + DOMAIN_SHRINK * total) / (beyond.sum(axis=1, keepdims=True) + DOMAIN_SHRINK)
            prior = (host + HOST_SHRINK * mix) / (host.sum(axis=1, keepdims=True) + HOST_SHRINK)
            log = matrix("text_log") + np.log(prior)
            for column, found in (("declared", by_declared), ("address", by_address)):
                for i, code in enumerate(batch.column(column).to_pylist()):
                    if code in found:
                        log[i] += found[code]
            posterior = _posterior(log)
            best = posterior.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array([langs[k] for k in best], pa.string()),
                 pa.array(posterior[np.arange(len(best)), best]),
                 pa.array([langs[k] for k in batch.column("text_best").to_pylist()], pa.string())],
                names=[*keep, "language", "confidence", "text_language"])
    return fuse


def identify(rows: DataFrame, model: TextModel, keep: tuple[str, ...]) -> DataFrame:
    """Language, confidence and the text's own language of each of ``rows``.

    ``rows`` has text, is_markup (text is a page's markup), host, domain,
    declared and address (null or empty where there is none); ``keep`` names
    the columns to return beside.
    """
    langs = model.langs
    kinds = {x.name: x.dataType.simpleString() for x in rows.schema.fields}
    kept = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    if not langs:
        return rows.select(*keep, F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("confidence"),
                           F.lit(None).cast("string").alias("text_language"))
    known = lambda c: F.when(F.col(c).isin(langs), F.col(c))
    rows = rows.withColumns({"declared": known("declared"), "address": known("address"),
                             "host": F.coalesce("host", F.lit("")), "domain": F.coalesce("domain", F.lit(""))})
    through = tuple(dict.fromkeys([*keep, "host", "domain", "declared", "address"]))
    kinds = {x.name: x.dataType.simpleString() for x in rows.schema.fields}
    scored = written(rows.select(F.col("text").alias("_text"), F.col("is_markup").alias("_markup"), *through).mapInArrow(
        _score(model, through), ", ".join(f"`{c}` {kinds[c]}" for c in through)
        + ", text_log array<double>, text_posterior array<double>, text_best int"))
    sums = [F.sum(F.get("text_posterior", F.lit(k))).alias(f"s{k}") for k in range(len(langs))]
    hosts = written(scored.groupBy("domain", "host").agg(*sums))
    again = [F.sum(f"s{k}").alias(f"d{k}") for k in range(len(langs))]
    domains = hosts.groupBy("domain").agg(*again)
    hosts = hosts.join(domains, "domain").select(
        F.col("domain").alias("_domain"), F.col("host").alias("_host"),
        F.array(*[f"s{k}" for k in range(len(langs))]).alias("host_sum"),
        F.array(*[f"d{k}" for k in range(len(langs))]).alias("domain_sum"))
    hosts = written(hosts)
    total = np.array([list(domains.agg(*[F.sum(f"d{k}") for k in range(len(langs))]).first())], dtype=float)[0]
    total = np.nan_to_num(total)
    counted = {}
    for c in ("declared", "address"):
        got = scored.where(F.col(c).isNotNull()).groupBy(c).agg(*sums).collect()       # a row for each known language
        counted[c] = {x[c]: np.array([x[f"s{k}"] for k in range(len(langs))]) for x in got}
    both = scored.join(hosts, (scored["domain"] == hosts["_domain"]) & (scored["host"] == hosts["_host"]))
    return both.mapInArrow(_fuse(langs, counted["declared"], counted["address"], total, keep),
                           kept + ", language string, confidence double, text_language string")


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) as rows for ``identify``."""
    url = F.coalesce("url", F.lit(""))
    rows = pages.select("page_id", url.alias("url"), F.coalesce("html", F.lit("")).alias("text"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    return rows.select("page_id", "text", F.lit(True).alias("is_markup"), "host", domain_of(F.col("host")).alias("domain"),
                       declared_language(F.col("text")).alias("declared"),
                       address_language(F.col("url"), F.col("host")).alias("address"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, source) as rows for ``identify``: the source is the host."""
    none = F.lit(None).cast("string")
    return docs.select("doc_id", "text", F.lit(False).alias("is_markup"), F.col("source").alias("host"),
                       F.lit("").alias("domain"), none.alias("declared"), none.alias("address"))
