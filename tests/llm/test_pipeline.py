import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder of the three tables with planted cases."""
    r = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in ("an", "el", "or", "it") for c in ("ta", "mi", "su", "ke")]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    item = prose(20)
    docs = [(i, prose(80), "en", f"s{i % 3}", 0) for i in range(300)]
    for i in range(0, 60):
        docs[i] = (i, docs[i][1] + " zarkomul you zarkomul are zarkomul zarkomul", *docs[i][2:])
    base = prose(100).split()
    for i in range(100, 130):
        own = list(base)
        own[r.randrange(100)] = f"edit{i}"
        docs[i] = (i, " ".join(own), *docs[i][2:])
    for i in range(200, 215):
        docs[i] = (i, prose(20) + " " + item.replace(item[30], "~", 1) + " " + prose(20), *docs[i][2:])
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i < 60)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_catch_the_planted_and_leave_the_clean(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages = dict(P.STAGES)
    everyone = set(range(300))
    assert ids(stages["toxicity"](spark, docs, small)) == everyone - set(range(60))
    assert ids(stages["near_duplicates"](spark, docs, small)) == everyone - set(range(101, 130))
    assert ids(stages["decontamination"](spark, docs, small)) == everyone - set(range(200, 215))
    for name in ("toxicity", "near_duplicates", "decontamination", "mixing"):
        assert stages[name](spark, docs, small).columns == docs.columns


def test_run_equals_the_stages_in_order(spark, small):
    got = P.run(spark, small).collect()
    left = set(range(300)) - set(range(60)) - set(range(101, 130)) - set(range(200, 215))
    assert {r["doc_id"] for r in got} <= left
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_clashing_columns_pass_through_every_stage(spark, messy):
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, messy, SF)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in messy.schema], name
        assert out.exceptAll(messy).count() == 0, name
        assert stage(spark, messy.limit(0), SF).count() == 0
    assert P.STAGES[-1][1](spark, messy, SF).count() == messy.count()


def test_repeated_null_and_empty_rows(spark, messy):
    kept = P.near_duplicates(spark, messy, SF)
    assert kept.where("doc_id = 1").count() == 1 and kept.where("doc_id is null").count() == 2
    assert P.decontamination(spark, messy, SF).count() == messy.count()
    assert P.toxicity(spark, messy.where(F.coalesce(F.col("text"), F.lit("")) == ""), SF).count() == 3


def test_mixing_fits_topics_on_all_documents(spark, small, monkeypatch):
    fitted = []
    monkeypatch.setattr(P, "fit_topics", lambda counted, fit=P.fit_topics: fitted.append((counted, fit(counted))) or fitted[-1][1])
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source", "lang", F.concat("text", F.lit(" number"), "doc_id").alias("text"))
    docs = docs.crossJoin(spark.range(8)).select("doc_id", "source", "lang", F.concat("text", F.lit(" copynumber"), "id").alias("text"))
    P.mixing(spark, docs, small).count()
    counted, topics = fitted[0]
    assert counted.count() == 2400 and "_text_row" in counted.columns
    from adlens.llm.mixing import TOPIC_BUCKETS, zlib
    import numpy as np
    for i in (0, 7):                                         # a word of an eighth of all 2400 texts, beyond 2000
        seen = (2401 / np.exp(topics.weight[zlib.crc32(f"copynumber{i}".encode()) % TOPIC_BUCKETS]))
        assert 300 <= round(seen) <= 2400 and abs(seen - round(seen)) < 1e-6
