import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from adlens.operators import report as R
from adlens.plans.workflow import analyze, report_tables
from adlens.sources import sinks


@pytest.fixture(scope="module")
def analysis(facts):
    return analyze(facts)


def test_workflow_contracts_hold(analysis):
    t = report_tables(analysis)
    bad = [(r.table_name, r.rule) for r in t["contracts"].collect() if r.violations]
    assert bad == []
    s = t["summary"].collect()[0]
    assert s.total_rows == 6000 and s.validated_hypotheses >= 3
    assert s.top_insight == analysis.validated.where("rank = 1").first().hypothesis_text
    ins = t["insights"].collect()
    assert [r.rank for r in sorted(ins, key=lambda r: r.rank)] == [1, 2, 3]


def test_supporting_metrics_strip_non_printable(spark):
    v = spark.createDataFrame(
        [(1, [("a​b", 1.0, " x\ty "), (" ", 2.0, "c"), ("m", 3.0, "\u0007")])],
        "rank int, evidence_metrics array<struct<metric_name:string,value:double,comparison:string>>")
    rows = R.supporting_metrics(v).collect()
    assert [(r.metric_name, r.comparison) for r in rows] == [("ab", "xy")]


def test_recommendation_rows(analysis):
    rows = R.recommendation_rows(analysis.recommendations).collect()
    per = {}
    for r in rows:
        per.setdefault(r.campaign, []).append(r.variation)
    assert per and all(sorted(v) == list(range(1, len(v) + 1)) and len(v) >= 3 for v in per.values())


def test_json_sinks_round_trip(spark, analysis):
    d = tempfile.mkdtemp(prefix="adlens-out-")
    sinks.write_insights(analysis.validated, analysis.top_insights, d, "why did roas drop", "sf0.001",
                         "2025-01-01T00:00:00Z")
    sinks.write_recommendations(spark, analysis.recommendations, d, 0.01, "why did roas drop", "sf0.001",
                                "2025-01-01T00:00:00Z")
    back = spark.read.json(f"{d}/validated_hypotheses")
    assert back.count() == analysis.validated.count()
    one = json.loads(open([os.path.join(f"{d}/top_insights", f) for f in os.listdir(f"{d}/top_insights")
                           if f.endswith(".json")][0]).readline())
    assert set(one) >= {"hypothesis", "validated_confidence", "query", "timestamp", "dataset"}
    assert spark.read.json(f"{d}/creatives").where(F.size("new_creatives") < 3).count() == 0
    assert sorted(map(str, sinks.read_recommendations(spark, d).collect())) == \
        sorted(map(str, analysis.recommendations.select(*sinks.read_recommendations(spark, d).columns).collect()))
    meta = spark.read.json(f"{d}/creatives_metadata").first().asDict()
    assert meta == {"query": "why did roas drop", "timestamp": "2025-01-01T00:00:00Z", "dataset": "sf0.001",
                    "low_ctr_threshold": 0.01}
    seg = analysis.segments()
    rt = sinks.json_round_trip(seg)
    assert sorted(map(tuple, rt.collect())) == sorted(map(tuple, seg.collect()))


def test_recommendations_that_were_not_asked_for(spark):
    d = tempfile.mkdtemp(prefix="adlens-out-")
    sinks.write_recommendations(spark, None, d, 0.01, "analyze roas", "x", "2025-01-01T00:00:00Z")
    assert sinks.read_recommendations(spark, d).count() == 0
    assert "not requested" in spark.read.json(f"{d}/creatives_metadata").first()["note"]


@pytest.mark.parametrize("text, kept", [
    ("\t \t", None), ("\t x", "x"), ("\u00a0\u2003", None), ("\u00a0y\u3000", "y"), ("\n a\tb \r\n", "ab"),
    ("\x1c\x1f", None), ("a\u2028b", "ab"), ("a  b", "a  b"), ("\x85z", "z")])
def test_supporting_metrics_strip_white_space_first(spark, text, kept):
    v = spark.createDataFrame([(1, [(text, 1.0, "c"), ("m", 2.0, text)])],
                              "rank int, evidence_metrics array<struct<metric_name:string,value:double,comparison:string>>")
    rows = [(r.metric_name, r.comparison) for r in R.supporting_metrics(v).orderBy("pos").collect()]
    assert rows == ([] if kept is None else [(kept, "c"), ("m", kept)])


def test_request_runs_what_it_asks_for(facts):
    from adlens.plans.workflow import run_request
    analysis_only = run_request(facts, "Analyze ROAS for last 30 days", "1998-06-30")
    assert analysis_only["recommendations"] is None
    s = analysis_only["analysis"].summary.first()
    assert str(s.start_date) >= "1998-05-31" and str(s.end_date) <= "1998-06-30"
    creative = run_request(facts, "Generate creative ideas from 1997-01-01 to 1997-06-30", "1998-06-30")
    assert creative["recommendations"].count() > 0
    assert run_request(facts, "how was it on 1997-01-08", "1998-06-30")["recommendations"] is not None
    with pytest.raises(ValueError):
        run_request(facts, "\t a \n", "1998-06-30")


def test_narratives(analysis):
    from adlens.operators import creatives as C
    from adlens.operators import evidence as E
    a = analysis
    n1 = R.insight_narrative(a.metrics, a.trends, a.seg, a.hypotheses).collect()[0]
    assert n1.think.startswith("Analyzing data to understand ROAS performance changes. Current overall ROAS: 2.48.")
    assert "- by_campaign: 101 segments identified" in n1.analyze
    n2 = R.evaluation_narrative(a.hypotheses, a.validated, E.status_counts(a.validated)).collect()[0]
    assert n2.conclude.startswith("Validation complete for 5 hypotheses.")
    summ = C.recommendation_summary(a.variations, a.low_ctr)
    n3 = R.creative_narrative(a.low_ctr, a.variations, summ, 0.01).collect()[0]
    assert n3.think.startswith("Analyzing campaigns to identify those with CTR below 0.0100.")


def test_evidence_from_separate_frame(spark, facts):
    from adlens.operators import cleaning as Q
    from adlens.sources.facts import raw_ad_rows
    c = Q.clean(raw_ad_rows(spark, "/root/testdata/sf0.001"))
    lenient = Q.lenient(raw_ad_rows(spark, "/root/testdata/sf0.001")).withColumns({
        "ctr": F.col("clicks") / F.nullif(F.col("impressions"), F.lit(0.0)),
        "roas": F.col("revenue") / F.nullif(F.col("spend"), F.lit(0.0))})
    clean = c.clean.withColumns({"ctr": F.col("clicks") / F.nullif(F.col("impressions"), F.lit(0.0)),
                                 "roas": F.col("revenue") / F.nullif(F.col("spend"), F.lit(0.0))})
    a = analyze(clean, evidence_facts=lenient)
    ev = {r.category: r for r in a.evidence.collect()}
    # the creative t-test uses every lenient row of the worst/best types (more rows than the clean frame)
    n_clean = {r.value: r.ctr_n for r in a.seg.where("dimension = 'creative_type'").collect()}
    assert ev["creative"].has_test and ev["creative"].dof > sum(sorted(n_clean.values())[:2]) - 2
    assert a.recommendations.count() > 0
