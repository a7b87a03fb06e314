"""Secret scans over a trigram inverted index.

From each rule's regex a Boolean query over trigrams is derived: strings that
every match must contain, as groups of alternatives (a match has, from each
group, all trigrams of one alternative).  The inverted index holds, for the
trigrams that some rule asks for, the documents whose lower-cased text has
them; intersecting its postings gives each rule's candidates, and only those
are verified with the regex.  Rules whose regex has no mandatory trigram scan
every text.

Only DataFrame functions are used.  The index is written as a table of
(trigram, document key); intersecting takes one shuffle by document key, so a
trigram that a third of all documents have is no hot key.  Candidates go back
to the texts by a join that is broadcast only after their number was checked.

Defined results: null text counts as empty and has no spans; documents are
told apart by id and text, so rows repeated with one id get equal results;
null ids work like any id; an empty table gives an empty result; columns
other than id and text are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, running_sums, written

#: Candidate keys (16 bytes each) up to this number are broadcast; more are joined by shuffling.
BROADCAST_KEYS = 500_000
#: A set of exact strings grows to this many before it is turned into a query.
MAX_STRINGS = 64


@dataclass(frozen=True)
class SecretRule:
    """``regex`` finds matches (Java syntax, also read by Python's ``re``);
    those whose ``group`` is shorter than ``min_length`` are dropped."""

    kind: str
    regex: str
    group: int = 0
    min_length: int = 0


#: Kinds in the order that breaks ties between spans.
BASE_RULES = (
    SecretRule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
EXTRA_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    SecretRule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}"),
)


def trigram_query(regex: str) -> list[list[frozenset[str]]]:
    """The trigrams that any match must contain, lower-cased: groups, each a
    list of alternatives, each a set of trigrams.  Empty if none is mandatory.
    """
    parser = re._parser  # the parsed form of a regex, from the standard library

    groups: list[list[frozenset[str]]] = []

    def flush(strings: set[str]) -> None:
        if all(len(s) >= 3 for s in strings):
            groups.append([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(strings)])

    def exact(node) -> set[str] | None:
        """All strings of a node, if they are few."""
        kind, arg = str(node[0]), node[1]
        if kind == "LITERAL":
            return {chr(arg).lower()}
        if kind == "IN" and all(str(x[0]) == "LITERAL" for x in arg):
            return {chr(x[1]).lower() for x in arg}
        if kind == "SUBPATTERN":
            return sequence(arg[3])
        if kind == "BRANCH":
            parts = [sequence(x) for x in arg[1]]
            return None if None in parts else set().union(*parts)
        if kind == "MAX_REPEAT" and arg[1] == 1:
            part = sequence(arg[2])
            return None if part is None else part | ({""} if arg[0] == 0 else set())
        if kind == "MAX_REPEAT" and arg[0] == arg[1] <= 8:
            part = sequence(arg[2])
            return None if part is None else {"".join(x) for x in product(part, repeat=arg[0])}
        return None

    def sequence(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            part = exact(node)
            if part is None or len(out) * len(part) > MAX_STRINGS:
                return None
            out = {a + b for a in out for b in part}
        return out

    run = {""}
    for node in parser.parse(regex):
        part = exact(node)
        if part is not None and len(run) * len(part) <= MAX_STRINGS:
            run = {a + b for a in run for b in part}
        else:
            flush(run)
            run = part or {""}
    flush(run)
    return groups


def _clauses(rules) -> tuple[list[tuple], list[str]]:
    """(trigram, clause, size of the clause, group, rule, groups of the rule) and the rules to scan fully."""
    rows, scanned, clause = [], [], 0
    for r in rules:
        groups = trigram_query(r.regex)
        if not groups:
            scanned.append(r.kind)
        for g, alternatives in enumerate(groups):
            for trigrams in alternatives:
                clause += 1
                rows += [(t, clause, len(trigrams), g, r.kind, len(groups)) for t in sorted(trigrams)]
    return rows, scanned


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id, text_hash) of ``docs`` (doc_id, text) for the given trigrams."""
    found = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.lower("text").alias("_low"))
    asked = F.array(*[F.lit(t) for t in trigrams])
    return found.select(F.explode(F.filter(asked, lambda t: F.contains(F.col("_low"), t))).alias("trigram"),
                        "doc_id", "text_hash")


def candidates(index: DataFrame, clauses: list[tuple]) -> DataFrame:
    """(doc_id, text_hash, rules): intersection of the postings by each rule's query."""
    spark = index.sparkSession
    asked = spark.createDataFrame(clauses, "trigram string, clause int, size int, grp int, rule string, n_groups int")
    keyed = index.distinct().join(F.broadcast(asked), "trigram").repartition("doc_id", "text_hash")
    whole = (keyed.groupBy("doc_id", "text_hash", "rule", "n_groups", "grp", "clause", "size").count()
             .where("count = size"))
    rules = (whole.groupBy("doc_id", "text_hash", "rule", "n_groups").agg(F.countDistinct("grp").alias("have"))
             .where("have = n_groups"))
    return rules.groupBy("doc_id", "text_hash").agg(F.collect_set("rule").alias("rules"))


def _spans(text: Column, rule: SecretRule, place: int) -> Column:
    """Kept matches of one rule: array of (start, kind's place, kind, end), code points, leftmost first."""
    kept = F.lit(rule.regex)

    def of(m: Column) -> Column:
        lengths = F.transform(F.regexp_extract_all(text, kept, F.lit(rule.group)), lambda g: F.char_length(g))
        gaps = F.split(text, rule.regex, -1)

        def placed(gap: Column) -> Column:
            there = F.transform(m, lambda x, i: F.struct(F.char_length(F.get(gap, i)).alias("gap"), F.char_length(x).alias("own")))

            def spans(sizes: Column) -> Column:
                before = running_sums(F.transform(sizes, lambda x: (x["gap"] + x["own"]).cast("long")))
                return let(before, lambda at: F.transform(sizes, lambda x, i: F.struct(
                    (F.get(at, i) + x["gap"]).cast("int").alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"),
                    (F.get(at, i) + x["gap"] + x["own"]).cast("int").alias("end"))))

            return let(there, spans)

        found = let(gaps, placed)
        if rule.min_length:
            found = let(lengths, lambda n: F.filter(found, lambda _, i: F.get(n, i) >= rule.min_length))
        return F.when(F.size(m) == 0, _no_spans()).otherwise(found)

    return let(F.regexp_extract_all(text, kept, F.lit(0)), of)


def _no_spans() -> Column:
    return F.expr("cast(array() as array<struct<start:int,place:int,kind:string,end:int>>)")


def scan_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = BASE_RULES + EXTRA_RULES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with ``spans``: array of (start, place, kind, end) by start, then kind's place."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    clauses, scanned = _clauses(rules)
    if clauses:
        index = written(trigram_index(rows, sorted({c[0] for c in clauses})))
        hits = written(candidates(index, clauses))
        small = hits.count() <= BROADCAST_KEYS
        hits = hits.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "rules")
        rows = rows.withColumn("text_hash", F.xxhash64("text"))
        rows = rows.join(F.broadcast(hits) if small else hits,
                         rows["doc_id"].eqNullSafe(hits["_id"]) & (rows["text_hash"] == hits["_hash"]), "left")
    else:
        rows = rows.withColumn("rules", F.lit(None).cast("array<string>"))
    found = []
    for place, r in enumerate(rules):
        spans = _spans(F.col("text"), r, place)
        if r.kind not in scanned:
            spans = F.when(F.array_contains("rules", r.kind), spans).otherwise(_no_spans())
        found.append(spans)
    return rows.select("doc_id", F.sort_array(F.concat(*found)).alias("spans"))


def joined(spans: Column | str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")
