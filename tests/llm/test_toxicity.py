import random

import pytest
from pyspark.sql import functions as F

from adlens.llm import toxicity as X


def edits_to_beginning(term, word):
    """Fewest edits from a term to any beginning of a word, by the textbook table."""
    row = list(range(len(term) + 1))
    best = row[-1]
    for j, c in enumerate(word, 1):
        new = [j]
        for i, t in enumerate(term, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (t != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_automaton_equals_the_table_of_edits():
    r = random.Random(2)
    terms = ["".join(r.choice("abcd") for _ in range(r.randrange(3, 12))) + r.choice(["", "$"]) for _ in range(12)]
    automaton = X.LexiconAutomaton(terms)
    for _ in range(3000):
        word = "".join(r.choice("abcde") for _ in range(r.randrange(1, 14)))
        near = [e for t in terms if (e := edits_to_beginning(t, word + "$")) <= X.errors_allowed(t)]
        assert (automaton.errors(word) < 9) == bool(near), word
        if near:
            assert automaton.errors(word) == min(near)


@pytest.mark.parametrize("word, errors", [("idiot", 0), ("idiots", 0), ("idi0t", 9), ("stupidly", 0), ("stupld", 1),
                                          ("pathetc", 1), ("worthlss", 1), ("disgustin", 1), ("scum", 0), ("scumbag", 9), ("the", 9)])
def test_fixed_terms(word, errors):
    assert X.LexiconAutomaton(X.TERMS).errors(word) == errors


def test_context_separates_quotation_from_abuse():
    automaton = X.LexiconAutomaton(X.TERMS)
    abuse = X.context_counts("you are an idiot and a stupid loser", automaton)
    quoted = X.context_counts("the report quotes the word \"idiot\" once", automaton)
    assert abuse[0] == 3 and abuse[2] == 0 and abuse[3] == 2 and abuse[4] >= 1
    assert quoted[0] == 0 and quoted[2] == 1
    model = X.ToxicityModel()
    scores = model.scores(X.np.array([abuse, quoted, X.context_counts("", automaton)]))
    assert scores[0] > 0.5 > scores[1] and scores[2] < 0.1


def corpus(n=400, seed=3):
    r = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in ("an", "el", "or") for c in ("ta", "mi", "su", "ke")]
    rows = []
    for i in range(n):
        text = [r.choice(words) for _ in range(60)]
        toxic = int(r.random() < 0.2)
        if toxic:
            for _ in range(4):
                text[r.randrange(60)] = "grumvok" + r.choice(["", "s", "ish"])
        rows.append((i, " ".join(text), toxic))
    return rows


def test_terms_are_learned_and_generalise(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    model = X.fit(docs, labels)
    assert any(t.startswith("grum") for t in model.terms)
    got = {r["doc_id"]: r["toxicity"] for r in X.score_toxicity(docs, model).collect()}
    held = [i for i, _, _ in rows if X_crc(i) % 5 == 0]
    right = sum((got[i] >= 0.5) == bool(rows[i][2]) for i in held) / len(held)
    assert right > 0.97
    # held-out labels are never read
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert X.fit(docs, flipped) == model


def X_crc(i):
    import zlib
    return zlib.crc32(str(i).encode())


def test_messy_and_empty(spark, messy):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (8, 1, None)], "doc_id long, quality int, toxic int")
    model = X.fit(messy, labels)
    out = X.score_toxicity(messy.withColumn("toxicity", F.lit("clash")), model)
    assert sorted(out.columns) == sorted([*messy.columns, "toxicity"])
    rows = out.collect()
    assert len(rows) == messy.count() and all(0 <= r["toxicity"] <= 1 for r in rows)
    assert X.score_toxicity(messy.limit(0), model).count() == 0
    assert X.fit(messy, labels.limit(0)).weights == X.PRIOR


def misspelled(term):
    """One planted misspelling of each kind, the leading letter's among them."""
    t = term.rstrip("$")
    return ["x" + t, "0" + t[1:], t[1:], t[:2] + "0" + t[3:], t[:2] + t[3:], t[:2] + "x" + t[2:]]


@pytest.mark.parametrize("term", [*X.TERMS, "trash$", "clown$"])
def test_misspelled_terms_are_near(term):
    lexicon = X.Lexicon([*X.TERMS, "trash$", "clown$"])
    clean = X.context_counts("the weather was fine and we went home", lexicon)
    for word in misspelled(term):
        assert 0 < lexicon.errors(word) < 9, word
        assert X.context_counts(f"the weather was {word} and we went home", lexicon) != clean, word
    for word in (term.rstrip("$"), f"_{term.rstrip('$')}_", f"__{term.rstrip('$')}__", f"so_{term.rstrip('$')}"):
        assert X.context_counts(f"well {word} then", lexicon)[0] == 1, word


@pytest.mark.parametrize("word", ["idiom", "idioms", "scumbag", "scale", "the", "idiosyncratic", "clothes"])
def test_other_words_are_not_near_short_terms(word):
    assert X.Lexicon(["scum$", "clown$", "idiot"], ordinary=["idiom"]).errors("idiom") == 9
    assert X.Lexicon(["scum$", "clown$", "idiot"]).errors(word) == (1 if word == "idiom" else 9)


def test_short_spellings_equal_the_table_of_edits():
    r = random.Random(4)
    terms = ["".join(r.choice("abc") for _ in range(r.choice((4, 5)))) + r.choice(["", "$"]) for _ in range(4)]
    short = X.ShortTerms(terms)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            new = [i]
            for j, d in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return row[-1]

    for _ in range(4000):
        word = "".join(r.choice("abcd") for _ in range(r.randrange(1, 9)))
        want = any(edits(t.rstrip("$"), word) <= 1 or (not t.endswith("$") and len(t) >= X.SHORT_STEM and any(
            word[n - 1] == t[-1] and edits(t[:-1], word[:n - 1]) <= 1 for n in range(1, len(word) + 1))) for t in terms)
        exact = any(word == t.rstrip("$") or (not t.endswith("$") and word.startswith(t)) for t in terms)
        assert exact or short.near(word) == want, word


def test_misspelled_short_abuse_is_learned(spark, monkeypatch):
    monkeypatch.setattr(X, "learned_terms", lambda rows, *_: [])
    r = random.Random(9)
    rows = [(i, " ".join(["we", "lose", "or", "fine"] * 2 + [f"n{i}"] + [r.choice(["idi0t", "xmoron", "l0ser", "_sccum_"]) for _ in range(4 * (i % 4 == 0))]),
             int(i % 4 == 0)) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    assert model.ordinary == ("lose",)
    scored = {x["doc_id"]: x["toxicity"] for x in X.score_toxicity(docs, model).collect()}
    assert all((scored[i] >= 0.5) == bool(y) for i, _, y in rows)


@pytest.mark.parametrize("text", ["she said he was an idiot", "the report called them scum", "er schrieb du bist ein idiot"])
def test_exact_hits_beside_a_saying_word_are_reported(text):
    lexicon = X.Lexicon(X.TERMS)
    plain = " ".join("xx" if w in X.SAYING else w for w in text.split())
    said, unsaid = X.context_counts(text, lexicon), X.context_counts(plain, lexicon)
    assert said[0] == unsaid[0] == 1 and said[5] == 1 and unsaid[5] == 0 and said[3] == said[4] == 0
    scores = X.ToxicityModel().scores(X.np.array([said, unsaid]))
    assert scores[0] < scores[1]


def test_labels_set_the_weight_of_reported_hits(spark):
    rows = [(i, f"n{i} " + ("we say you idiot" if i % 2 else "she said he was an idiot"), i % 2) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = X.fit(docs, spark.createDataFrame([r[::2] for r in rows], "doc_id long, toxic int"))
    assert model.weights[6] < X.PRIOR[6]


@pytest.fixture(scope="module")
def given(spark):
    """A model of the given small tables."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    return X.fit(docs.select("doc_id", "text"), labels)


def score_of(model, text):
    return float(model.scores(X.np.array([X.context_counts(text, X.Lexicon(model.terms, (*model.ordinary, *X.COMMON)))]))[0])


def test_misspelled_abuse_is_caught(given):
    """Second-person texts with one-edit misspellings of every term."""
    frames = ("you {} and you {}, you {}", "well you {} you {} {}", "your {} {} friend, you are a {}")
    planted = [frames[k % 3].format(*(X.misspelled(t.rstrip("$"), 7 * k + j) for j in range(3))) for t in given.terms for k in range(12)]
    assert sum(score_of(given, t) >= 0.5 for t in planted) >= 0.9 * len(planted)
    assert score_of(given, "You stup1d idi0t, you m0ron, you worthles pathet1c l0ser, you disgustinq scvm.") > 0.9


@pytest.mark.parametrize("text", ["your reward and you with regard to it", "you apathetic crowd, you are discussing it", "your idiom, your scam, you moran",
                                  "a mormon came closer to you", "he said \"idi0t\" and \"m0ron\" to nobody", "the report called them stup1d and pathet1c"])
def test_common_words_and_quoted_misspellings_are_left_alone(given, text):
    assert score_of(given, text) < 0.2


def test_misspelled_held_out_texts(spark):
    """Held-out toxic texts with one edit in each hit, against the same texts as they are."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = X.fit(docs.select("doc_id", "text"), labels)
    lexicon = X.Lexicon(model.terms, (*model.ordinary, *X.COMMON))
    held = docs.join(labels.where("toxic IS NOT NULL"), "doc_id").where("crc32(cast(doc_id AS string)) % 5 = 0").select("text", "toxic").collect()
    toxic = [r["text"] or "" for r in held if r["toxic"] == 1]
    caught = [t for t in toxic if score_of(model, t) >= 0.5]
    again = [t for t in caught if score_of(model, X.misspelled_text(t, lexicon)) >= 0.5]
    assert len(caught) >= 0.9 * len(toxic) and len(again) >= 0.9 * len(caught)
    clean = [r["text"] or "" for r in held if r["toxic"] == 0]
    assert sum(score_of(model, t) < 0.5 for t in clean) >= 0.98 * len(clean)


def plain_counts(text, terms, ordinary):
    """Counts of a text with edit distances by the table, word by word."""
    import re
    low = text.lower()
    words = [(m.group(), m.start()) for m in re.finditer(r"[^\W_]+(?:_+[^\W_]+)*", low)]

    def errors(word):
        near = [edits_to_beginning(t, word + "$") for t in terms]
        got = min((e for t, e in zip(terms, near) if e <= X.errors_allowed(t)), default=9)
        if got and word in ordinary:
            return 9
        return 1 if got > 1 and X.ShortTerms(terms).near(word) else got

    out, last = [0.0] * 6, -10 ** 9
    for i, (w, at) in enumerate(words):
        if (e := errors(w)) == 9:
            continue
        around = {x for x, _ in words[max(0, i - 6):i + 7]}
        before, after = [m.start() for m in re.finditer('["“”„«»]', low[:at])], re.search('["“”„«»]', low[at:])
        inside = len(before) % 2 == 1 and at - before[-1] < 400 and after is not None and after.start() < 400
        said = bool(around & X.SAYING)
        if inside or (said and e):
            out[2] += 1
            continue
        out[1 if e else 0] += 1 / e if e else 1
        if said:
            out[5] += 1
            continue
        out[4] += bool(around & X.ADDRESS)
        out[3] += i - last <= 25
        last = i
    return tuple(out)


def test_counts_equal_plain_counting():
    r = random.Random(6)
    terms, ordinary = ["grumvok", "blatherskite", "snark$", "zorb$", "idiot"], ("snarl",)
    lexicon = X.Lexicon(terms, ordinary)
    words = [*terms, "you", "said", "the", "snarl", "\"", "«", "fine", "day", "grumvoks", "x" * 500]
    for _ in range(400):
        text = " ".join(X.misspelled(w.rstrip("$"), r.randrange(40)) if w in terms and r.random() < 0.5 else w.rstrip("$")
                        for w in r.choices(words, k=r.randrange(0, 60)))
        assert X.context_counts(text, lexicon) == plain_counts(text, terms, ordinary), text
    w = X.np.array(X.PRIOR)
    c = X.np.array([[1.0, 2.0, 0.0, 3.0, 1.0, 0.0]])
    want = 1 / (1 + X.np.exp(-(w[0] + sum(w[k + 1] * X.np.log1p(c[0][k]) for k in range(6)))))
    assert abs(X.ToxicityModel().scores(c)[0] - want) < 1e-12
