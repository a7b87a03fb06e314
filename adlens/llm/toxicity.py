"""Toxicity scores: Levenshtein automata over a lexicon trie, scored in context.

The lexicon is a trie of terms: a short fixed list plus stems learned from
labelled texts.  A lazily built automaton runs the trie and the edit-distance
automata of all its terms at once: one state is the set of (trie node, errors)
pairs that a word's letters can have reached, so a word is read once whatever
the lexicon's size, and most words reach the dead state in a few letters.
Terms of 4 and 5 letters, to which the automaton allows no edit, are looked up
with one edit in a table of their blurred spellings.  A word that clean labelled
texts use as well ("lose", "moon"), or one of a short fixed list of common words
("reward", "closer"), is no misspelling of any term.  Underscores around words
are markup; a word with some inside is read whole and in its parts.

Each hit is judged in a window of words around it: within quotation marks, or
misspelled beside a verb of saying, it counts as quotation; an exact one beside
a verb of saying counts as a hit and as reported, for which labels set a weight;
others, misspelled ones too, count as abuse beside a second person and
strengthen each other when close together.  A logistic model over these few
counts gives the score.  What a misspelled hit weighs is learned as well: each
toxic training text is learned from a second time with one edit in every hit.

Learning uses at most ``train_rows`` labelled rows, chosen by a hash of their
id: stems are counted by grouped aggregation on that sample, and a greedy
cover of its toxic texts keeps those needed.  The score's inputs are the text
alone.  Scoring is one pass over the texts without a shuffle.

Defined results: null and empty texts get the score of a text without hits;
repeated rows get equal scores; a row whose label is null is not learned
from, of several labels of one id the highest counts; without labelled rows
the prior weights and the fixed list are the model; an empty table gives an
empty result; other columns pass through, one named like the score is replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import giving_back, in_small_batches, written

#: Common terms of abuse; a closing "$" asks for the word's end.
TERMS = ("idiot", "moron$", "morons$", "scum$", "stupid", "pathetic$", "worthless$", "loser$", "losers$", "disgusting$",
         "imbecile", "dumbass", "retard$", "bastard", "asshole")
#: Words of saying and of address, in the languages at hand.
SAYING = frozenset("said says wrote called quoted quote quoting reported term word sagte schrieb zitat nannte "
                   "dit écrit appelé cite citation dijo escribió llamó cita".split())
ADDRESS = frozenset("you your yours youre du dich dein ihr euch tu te toi vous votre tú usted ustedes".split())
#: Common words one or two edits from a fixed term.
COMMON = frozenset("reward rewards rewarded regard regards regarded apathetic empathetic discussing digesting distrusting mormon mormons moran "
                   "morn boron closer closers loose looser lower laser lover lovers loner loners poser user loser's idiom idioms scam "
                   "scams sum slum scrum scud scuba stupor custard mustard bastion".split())
#: Largest labelled sample, most learned terms, covers of a toxic text, letters of a stem.
TRAIN_ROWS, MAX_TERMS, COVERS, STEM = 20_000, 300, 4, (4, 8)
#: Words on either side of a hit that make its context; hits this close support each other.
CONTEXT, CLOSE = 6, 25
#: Least letters of a term that is sought with one edit as a whole word, and as a word's beginning.
SHORT_WORD, SHORT_STEM = 4, 5
#: Clean training texts from which a word near a short term is a word of its own.
ORDINARY = 2
#: Weights before any label is seen, and how strongly they are held.
PRIOR = (-4.0, 2.5, 2.0, 0.2, 1.0, 0.5, -1.0)
HOLD = 0.5
#: What an edited copy of a toxic training text counts beside the text itself, and look-alikes of letters.
EDITED = 0.5
LOOKALIKES = dict(zip("aeiostbg", "43105+86"))

#: Words whose errors are remembered by a task, of each table.
REMEMBERED = 150_000

#: Counts of a text.
COUNTS = 6

_WORD = re.compile(r"[^\W_]+(?:_+[^\W_]+)*")
_QUOTES = re.compile("[\"“”„«»]")


def errors_allowed(term: str) -> int:
    """Edits a term forgives: none below 6 letters, one below 10, then two."""
    n = len(term.rstrip("$"))
    return 0 if n < 6 else 1 if n < 10 else 2


class LexiconAutomaton:
    """All terms' Levenshtein automata along their trie, determinised as words ask for states."""

    def __init__(self, terms):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]             # errors that the term ending at a node forgives
        self.allowed: list[int] = [0]           # most errors of any term below a node
        for term in terms:
            node, e = 0, errors_allowed(term)
            self.allowed[0] = max(self.allowed[0], e)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.allowed.append(0)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], e)
            self.ends[node] = max(self.ends[node], e)
        self.letters = frozenset(c for x in self.children for c in x)
        start = self._closed({0: 0})
        self.states, self.numbers = [start], {start: 0}
        self.found = [self._best(start)]
        self.steps: list[dict[str, int]] = [{}]
        self.words: dict[str, int] = {}

    def _closed(self, state: dict[int, int]) -> frozenset:
        """With the nodes reached by leaving letters of the term out; fewest errors for each node."""
        todo = list(state.items())
        while todo:
            node, e = todo.pop()
            if state.get(node, 9) < e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.allowed[child] and state.get(child, 9) > e + 1:
                    state[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(state.items())

    def _best(self, state: frozenset) -> int:
        return min((e for node, e in state if e <= self.ends[node]), default=9)

    def _step(self, number: int, letter: str) -> int:
        out: dict[int, int] = {}
        for node, e in self.states[number]:
            for c, child in self.children[node].items():
                cost = e + (c != letter)
                if cost <= self.allowed[child] and out.get(child, 9) > cost:
                    out[child] = cost
            if e + 1 <= self.allowed[node] and out.get(node, 9) > e + 1:
                out[node] = e + 1
        state = self._closed(out)
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.found.append(self._best(state))
            self.steps.append({})
        return self.numbers[state]

    def errors(self, word: str) -> int:
        """Fewest errors with which a term is the word's beginning (its whole, for terms with "$"); 9 if none is near."""
        got = self.words.get(word)
        if got is None:
            number, got = 0, 9
            for c in word + "$":
                c = c if c in self.letters else " "
                nxt = self.steps[number].get(c)
                if nxt is None:
                    nxt = self.steps[number][c] = self._step(number, c)
                number = nxt
                if self.found[number] < got:
                    got = self.found[number]
                if got == 0 or not self.states[number]:
                    break
            if len(self.words) > REMEMBERED:
                self.words.clear()
            self.words[word] = got
        return got


class ShortTerms:
    """One-edit spellings of the terms to which the automaton allows none.

    A word is near a term if it is one edit from it as a whole, or, for terms
    without "$", if a beginning is that ends in the term's last letter (else
    "idiom" and "idio..." were all near).  "?" stands for any letter.
    """

    def __init__(self, terms):
        self.spellings: set[str] = set()
        self.words: dict[str, bool] = {}
        for term in terms:
            letters = term.rstrip("$")
            if errors_allowed(term) or len(letters) < SHORT_WORD:
                continue
            for whole in {letters + "$", term} if len(letters) >= SHORT_STEM else {letters + "$"}:
                body, last = whole[:-1], whole[-1]
                for i in range(len(body) + 1):
                    self.spellings.add(f"{body[:i]}?{body[i:]}{last}")
                for i in range(len(body)):
                    self.spellings.update((f"{body[:i]}?{body[i + 1:]}{last}", f"{body[:i]}{body[i + 1:]}{last}"))
        self.sizes = sorted({len(x) for x in self.spellings})

    def near(self, word: str) -> bool:
        got = self.words.get(word)
        if got is None:
            got = self._sought(word + "$")
            if len(self.words) > REMEMBERED:
                self.words.clear()
            self.words[word] = got
        return got

    def _sought(self, word: str) -> bool:
        for n in self.sizes:
            if n > len(word):
                break
            part = word[:n]
            if part in self.spellings or any(f"{part[:i]}?{part[i + 1:]}" in self.spellings for i in range(n - 1)):
                return True
        return False


class Lexicon:
    """All terms: the automaton's, and the short ones' spellings but for words that are ``ordinary``."""

    def __init__(self, terms, ordinary=()):
        self.automaton, self.short, self.ordinary = LexiconAutomaton(terms), ShortTerms(terms), frozenset(ordinary)

    def errors(self, word: str) -> int:
        """As the automaton's; 1 for a word that is near a short term."""
        got = self.automaton.errors(word)
        if got and word in self.ordinary:
            got = 9
        elif got > 1 and self.short.near(word):
            got = 1
        if got and "_" in word:
            got = min(got, *(self.errors(x) for x in word.split("_") if x))
        return got


def context_counts(text: str, lexicon: Lexicon | LexiconAutomaton) -> tuple[float, ...]:
    """(exact, misspelled, quoted, near each other, addressed, reported): evidence of a text's hits, before logarithms."""
    low = text.lower()
    errors = lexicon.errors
    hits = {w: e for w in set(_WORD.findall(low)) if (e := errors(w)) < 9}
    if not hits:
        return (0.0,) * COUNTS
    quotes = [m.start() for m in _QUOTES.finditer(low)]
    words = [(m.group(), m.start()) for m in _WORD.finditer(low)]
    exact = fuzzy = quoted = close = addressed = reported = 0.0
    last, passed, open_at = -10 ** 9, 0, -1
    for i, (w, at) in enumerate(words):
        e = hits.get(w)
        if e is None:
            continue
        while passed < len(quotes) and quotes[passed] < at:
            open_at = quotes[passed] if open_at < 0 else -1
            passed += 1
        around = {x for x, _ in words[max(0, i - CONTEXT):i + CONTEXT + 1]}
        inside = open_at >= 0 and at - open_at < 400 and passed < len(quotes) and quotes[passed] - at < 400
        said = bool(around & SAYING)
        if inside or (said and e):
            quoted += 1
        else:
            if e:
                fuzzy += 1.0 / e
            else:
                exact += 1
                if said:
                    reported += 1
                    continue
            addressed += bool(around & ADDRESS)
            close += i - last <= CLOSE
            last = i
    return exact, fuzzy, quoted, close, addressed, reported


def misspelled(word: str, turn: int) -> str:
    """``word`` with one edit near its beginning: a look-alike, a letter dropped, doubled or put in, as ``turn`` says."""
    at = 1 + turn // 4 % max(1, min(len(word) - 1, 4))
    kind = turn % 4
    if kind == 0:
        return word[:at] + LOOKALIKES.get(word[at:at + 1], "*" if turn % 8 < 4 else "x") + word[at + 1:]
    if kind == 1:
        return word[:at] + word[at + 1:]
    return word[:at] + (word[at - 1] if kind == 2 else "x") + word[at:]


def misspelled_text(text: str, lexicon: Lexicon) -> str:
    """``text`` in lower case with one edit in every exact hit; the kind of edit follows from the word's place."""
    low, turn = text.lower(), 0

    def edit(m: re.Match) -> str:
        nonlocal turn
        if lexicon.errors(m.group()):
            return m.group()
        turn += 1
        return misspelled(m.group().strip("_"), 5 * turn + len(low))
    return _WORD.sub(edit, low)


def _features(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(counts), 1)), np.log1p(counts)], axis=1)


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[str, ...] = TERMS
    weights: tuple[float, ...] = PRIOR
    ordinary: tuple[str, ...] = ()

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(counts) @ np.array(self.weights), -30, 30)))


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def stems_of(text: str) -> set[str]:
    """Beginnings of the text's words, and the whole words with "$"."""
    out = set()
    for w in set(_WORD.findall(text.lower())):
        out.update(w[:k] for k in range(STEM[0], min(STEM[1], len(w)) + 1))
        if len(w) >= STEM[0]:
            out.add(w + "$")
    return out


def _count_stems(only: frozenset | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text in _texts(batch, "text"):
                found.update(stems_of(text) if only is None else stems_of(text) & only)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                             names=["stem", "n"])
    return count


def _incidence(only: frozenset):
    def list_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(k, s) for k, text in zip(batch.column("row").to_pylist(), _texts(batch, "text"))
                     for s in stems_of(text) & only]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                              pa.array([p[1] for p in pairs], pa.string())], names=["row", "stem"])
    return list_stems


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(row, text, toxic): at most ``train_rows`` labelled texts outside the held-out fifth, copies once.

    Held out is every id whose crc32 (as text) is divisible by five.
    """
    kept = labels.where("doc_id is not null and toxic is not null and crc32(cast(doc_id as string)) % 5 <> 0")
    kept = kept.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    kept = kept.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)   # bounded, so it may be broadcast
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(kept), "doc_id")
    rows = written(rows.select(F.xxhash64("text").alias("row"), "text", "toxic"))
    first = rows.groupBy("row").agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    return written(first)


def _related(a: str, b: str) -> bool:
    """One is the other's beginning."""
    a, b = a.rstrip("$"), b.rstrip("$")
    return a.startswith(b) or b.startswith(a)


def learned_terms(rows: DataFrame, max_terms: int = MAX_TERMS) -> list[str]:
    """Stems that mark toxic training texts and hardly occur in others, by a greedy cover."""
    sizes = {x["toxic"]: x["count"] for x in rows.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sum(sizes.values()) - sizes.get(1, 0)
    if not n1 or not n0:
        return []
    least = max(5, int(np.ceil(20 / np.log((n1 + n0) / n1))))
    counted = "stem string, n long"
    toxic, clean = rows.where("toxic = 1").select("text"), rows.where("toxic <> 1").select("text")
    often = toxic.mapInArrow(_count_stems(None), counted).groupBy("stem").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    seen = {x["stem"]: x["n"] for x in often.collect()}                     # bounded by the sample
    if not seen:
        return []
    others = clean.mapInArrow(_count_stems(frozenset(seen)), counted).groupBy("stem").agg(F.sum("n").alias("n"))
    there = {x["stem"]: x["n"] for x in others.collect()}
    marks = frozenset(s for s, n in seen.items() if there.get(s, 0) / n0 <= 0.02 * n / n1)
    if not marks:
        return []
    has: dict[str, set] = defaultdict(set)
    for x in rows.where("toxic = 1").select("row", "text").mapInArrow(_incidence(marks), "row long, stem string").collect():
        has[x["stem"]].add(x["row"])
    covered: Counter = Counter()
    chosen: list[str] = []
    for term in TERMS:                                                       # known already: what they cover counts
        near = [x for x in has if _related(x, term)]
        covered.update(set().union(*[has.pop(x) for x in near]))
    while has and len(chosen) < max_terms:
        gain = {s: sum(covered[r] < COVERS for r in r_s) for s, r_s in has.items()}
        most = max(gain.values())
        if most < least:
            break
        best = max((s for s in gain if gain[s] >= 0.9 * most), key=lambda s: (len(s), s))
        covered.update(has.pop(best))
        chosen.append(best)
        has = {s: r for s, r in has.items() if not _related(s, best) and gain[s] >= least}
    return chosen


def _count_near(terms: tuple[str, ...]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms, COMMON)
        for batch in batches:
            found: Counter = Counter()
            for text in _texts(batch, "text"):
                words = set(_WORD.findall(text.lower()))
                found.update(w for w in words.union(*(w.split("_") for w in words if "_" in w)) if 0 < lexicon.errors(w) < 9)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                             names=["word", "n"])
    return count


def ordinary_words(rows: DataFrame, terms: tuple[str, ...]) -> tuple[str, ...]:
    """Words near a term that clean training texts use too: in ORDINARY of them or more, and at least
    half as often as toxic ones."""
    sizes = {x["toxic"]: x["count"] for x in rows.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sum(sizes.values()) - sizes.get(1, 0)

    def counted(which: str) -> dict[str, int]:
        near = rows.where(which).select("text").mapInArrow(_count_near(terms), "word string, n long")
        return {x["word"]: x["n"] for x in near.groupBy("word").agg(F.sum("n").alias("n")).collect()}    # bounded by the sample

    clean, toxic = counted("toxic <> 1"), counted("toxic = 1")
    return tuple(sorted(w for w, n in clean.items() if n >= ORDINARY and 2 * n * n1 >= toxic.get(w, 0) * n0))


def _count_contexts(terms: tuple[str, ...], ordinary: tuple[str, ...], passed: tuple[str, ...], edited: bool = False):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms, (*ordinary, *COMMON))
        for batch in batches:
            texts = [misspelled_text(t, lexicon) if edited else t for t in _texts(batch, "text")]
            counts = np.array([context_counts(t, lexicon) for t in texts], float).reshape(-1, COUNTS)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], *[pa.array(counts[:, k]) for k in range(COUNTS)]],
                                             names=[*passed, *[f"c{k}" for k in range(COUNTS)]])
    return count


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Lexicon and weights from labelled ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    rows = training_rows(in_small_batches(docs), labels, train_rows)
    terms = tuple(dict.fromkeys([*TERMS, *learned_terms(rows)]))
    ordinary = ordinary_words(rows, terms)
    kinds = "toxic int, " + ", ".join(f"c{k} double" for k in range(COUNTS))
    got = rows.select("text", "toxic").mapInArrow(_count_contexts(terms, ordinary, ("toxic",)), kinds).toPandas()     # at most train_rows short rows
    if not len(got):
        return ToxicityModel(terms, ordinary=ordinary)
    again = rows.where("toxic = 1").select("text", "toxic").mapInArrow(_count_contexts(terms, ordinary, ("toxic",), True), kinds).toPandas()
    again = again[again[[f"c{k}" for k in range(1, COUNTS)]].to_numpy().any(axis=1)]      # those that had a hit to edit
    weight = np.concatenate([np.ones(len(got)), np.full(len(again), EDITED)])
    counts = np.concatenate([f[[f"c{k}" for k in range(COUNTS)]].to_numpy() for f in (got, again)])
    x, y = _features(counts), np.concatenate([(f["toxic"] == 1).to_numpy(float) for f in (got, again)])
    prior = np.array(PRIOR)
    w = prior.copy()
    for _ in range(50):                                                      # Newton steps to the penalised optimum
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - HOLD * (w - prior)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + HOLD * np.eye(len(w)), slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return ToxicityModel(terms, tuple(float(v) for v in w), ordinary)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score: str = "toxicity") -> DataFrame:
    """``docs`` with the score of each text; all other columns pass through."""
    docs = in_small_batches(docs).drop(score)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms, (*model.ordinary, *COMMON))
        for batch in batches:
            counts = np.array([context_counts(t, lexicon) for t in _texts(batch, text_col)], float).reshape(-1, COUNTS)
            yield batch.append_column(score, pa.array(model.scores(counts)))

    return docs.mapInArrow(run, schema)
