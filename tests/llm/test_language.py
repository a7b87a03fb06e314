import random

from pyspark.sql import functions as F

from adlens.llm import language as L

SYLLABLES = {"de": ["sch", "ung", "ein", "ver", "keit"], "fr": ["eau", "tion", "que", "oui", "ment"], "es": ["cion", "ado", "lla", "rro", "ez"]}


def text(lang, r, n=40):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n))


def train_frame(spark, seed=1, n=60):
    r = random.Random(seed)
    rows = [(lang, text(lang, r)) for lang in SYLLABLES for _ in range(n)]
    return spark.createDataFrame(rows, "lang string, text string")


def test_counts_are_of_all_texts_whatever_the_partitions(spark):
    frame = train_frame(spark)
    a, b = L.train(frame.repartition(1)), L.train(frame.repartition(7))
    assert a.langs == ["de", "es", "fr"]
    assert L.np.allclose(a.table, b.table)


def test_held_out_accuracy(spark):
    model = L.train(train_frame(spark))
    r = random.Random(9)
    rows = [(i, lang, text(lang, r, 6), f"s{i % 3}") for i in range(150) for lang in SYLLABLES]
    docs = spark.createDataFrame(rows, "doc_id long, truth string, text string, source string")
    got = L.identify(L.document_evidence(docs).withColumn("truth", F.lit("x")), model, ("doc_id", "text")).collect()
    truth = {t: lang for _, lang, t, _ in rows}
    assert sum(x["language"] == truth[x["text"]] for x in got) / len(rows) > 0.99
    assert all(0 < x["confidence"] <= 1 for x in got)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_markup_address_and_host_decide_where_the_text_cannot(spark):
    model = L.train(train_frame(spark))
    r = random.Random(4)
    page = lambda lang, body: f'<html lang="{lang}"><script>var einung;</script><p>{body}</p></html>'
    rows = []
    for i, lang in enumerate(SYLLABLES):
        for k in range(20):
            rows.append((100 * i + k, f"https://www.{lang}site.example.com/{lang}/{k}", page(lang, text(lang, r))))
    rows += [(900, "https://x.example.org/fr/1", page("fr", "123")), (901, "https://www.essite.example.com/q", "<p></p>"),
             (902, "https://other.example.org/1", "<html lang=de>")]
    got = {x["page_id"]: x["language"] for x in L.identify(L.page_evidence(pages(spark, rows)), model, ("page_id",)).collect()}
    assert (got[900], got[901], got[902]) == ("fr", "es", "de")
    assert all(got[100 * i + k] == lang for i, lang in enumerate(SYLLABLES) for k in range(20))


def test_parts_of_addresses_and_markup(spark):
    rows = [(1, "https://user@a.b.example.fr:80/x", "<HTML LANG='pt-BR'>"), (2, "http://a.at/de-AT/1", "<html><meta http-equiv=\"Content-Language\" content=\"es\">"),
            (3, None, None), (4, "no address", "plain")]
    got = {x["page_id"]: (x["host"], x["domain"], x["declared"], x["address"]) for x in L.page_evidence(pages(spark, rows)).collect()}
    assert got[1] == ("a.b.example.fr", "example.fr", "pt", "fr")
    assert got[2] == ("a.at", "a.at", "es", "de")
    assert got[3][:2] == ("", "") and got[4][0] == ""
    assert L.visible_text("<!-- x --><style>p{}</style><p>a&amp;b<br>c</p>").split() == ["a&b", "c"]


def test_messy_and_empty(spark, messy):
    model = L.train(messy.select("text", "lang"))
    rows = L.identify(L.document_evidence(messy), model, ("doc_id",)).collect()
    assert len(rows) == messy.count() and all(r["language"] in ("de", "en", "fr") for r in rows)
    assert L.identify(L.document_evidence(messy.limit(0)), model, ("doc_id",)).count() == 0
    nothing = L.train(messy.limit(0).select("text", "lang"))
    assert nothing.langs == []
    assert {r["language"] for r in L.identify(L.document_evidence(messy), nothing, ("doc_id",)).collect()} == {None}


def plain_visible(page):
    """Markup taken out by one regular expression (quadratic on unclosed markup)."""
    import html
    import re
    return html.unescape(re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", " ", page, flags=re.DOTALL | re.IGNORECASE))


def test_visible_text_equals_the_regular_expression():
    r = random.Random(8)
    parts = ["<", ">", "<!--", "-->", "<script", "</script >", "</SCRIPT>", "<style>", "</style>", "<p a='>'>", "text", " ", "&amp;", "<scripty>", "--", "-", "!"]
    for _ in range(5000):
        page = "".join(r.choices(parts, k=r.randrange(0, 14)))
        assert L.visible_text(page) == plain_visible(page), page


def test_hostile_markup_takes_linear_time():
    import time
    for page in ("<!--" * 2_500_000, "<script>" * 1_250_000, "<" * 10_000_000, "<style>x</style>" * 600_000, "<a " * 3_000_000, "<!-- >" * 1_500_000):
        began = time.perf_counter()
        L.visible_text(page)
        assert time.perf_counter() - began < 10


def test_more_languages_than_the_model_holds(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 3)
    r = random.Random(1)
    rows = [(lang, text(lang, r)) for lang in SYLLABLES for _ in range(30)] + [(f"x{i}", "zq wv zq") for i in range(20)]
    model = L.train(spark.createDataFrame(rows, "lang string, text string"))
    assert len(model.langs) == 3 and L.OTHERS in model.langs
    docs = spark.createDataFrame([(1, "zq wv zq zq", None), (2, None, None)], "doc_id long, text string, source string")
    got = {x["doc_id"]: x["language"] for x in L.identify(L.document_evidence(docs), model, ("doc_id",)).collect()}
    assert got[1] == L.OTHERS and len(got) == 2


def plain_posterior(rows, model):
    """Language and confidence of each row (text, host, domain, declared, address), evidence fused in plain loops."""
    import math
    langs = model.langs
    k = len(langs)

    def softmax(x):
        e = [math.exp(v - max(x)) for v in x]
        return [v / sum(e) for v in e]

    logs = [list(model.scores([t])[0]) for t, *_ in rows]
    own = [softmax(x) for x in logs]
    add = lambda items: [sum(x[j] for x in items) for j in range(k)]
    total = add(own)
    share = [(v + 1) / (sum(total) + k) for v in total]
    found = []
    for i, (_, host, domain, *codes) in enumerate(rows):
        at_host = add([own[j] for j, r in enumerate(rows) if r[1:3] == (host, domain)])
        at_domain = add([own[j] for j, r in enumerate(rows) if r[2] == domain])
        beyond = [max(a - b, 0) for a, b in zip(at_domain, at_host)]
        others = [max(a - b, 0) for a, b in zip(at_host, own[i])]
        mix = [(b + L.DOMAIN_SHRINK * s) / (sum(beyond) + L.DOMAIN_SHRINK) for b, s in zip(beyond, share)]
        log = [x + math.log((o + L.HOST_SHRINK * m) / (sum(others) + L.HOST_SHRINK)) for x, o, m in zip(logs[i], others, mix)]
        for place, code in enumerate(codes):
            if code in langs:
                same = add([own[j] for j, r in enumerate(rows) if r[3 + place] == code])
                log = [x + math.log((c + L.DECLARED_SHRINK * s) / ((sum(same) + L.DECLARED_SHRINK) * s)) for x, c, s in zip(log, same, share)]
        p = softmax(log)
        found.append((langs[p.index(max(p))], round(max(p), 8)))
    return found


def test_posteriors_equal_plain_fusion(spark):
    model = L.train(train_frame(spark))
    r = random.Random(12)
    rows = []
    for i in range(60):
        lang = r.choice(list(SYLLABLES))
        rows.append((text(lang, r, r.randrange(0, 4)), r.choice(["h1.a.com", "h2.a.com", "h.b.org", ""]), "", r.choice([lang, "xx", None]), r.choice([lang, None, "de"])))
    rows = [(t, h, h.split(".", 1)[1] if h else "", d, a) for t, h, _, d, a in rows]
    df = spark.createDataFrame([(i, t, False, h, d, x, a) for i, (t, h, d, x, a) in enumerate(rows)],
                               "doc_id long, text string, is_markup boolean, host string, domain string, declared string, address string")
    got = {x["doc_id"]: (x["language"], round(x["confidence"], 8)) for x in L.identify(df, model, ("doc_id",)).collect()}
    assert [got[i] for i in range(len(rows))] == plain_posterior(rows, model)
