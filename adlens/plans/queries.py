"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables of ``sf_dir`` in full (the fact view
joins lineitem, part, orders, customer and nation) and runs the library
functions on them.  Floating columns whose value depends on summation order
(means, variances, test statistics) are rounded so that independent engines
can be compared; exact quantities (integer-cent sums and their ratios) are
returned unrounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators import cleaning as Q
from adlens.operators import creatives as C
from adlens.operators import evidence as E
from adlens.operators import filters as FL
from adlens.operators import hypotheses as H
from adlens.operators import metrics as M
from adlens.operators import report as R
from adlens.operators import requests as RQ
from adlens.operators import segments as S
from adlens.operators import seasonality as Z
from adlens.operators import sketches as K
from adlens.operators.contracts import contract_violations
from adlens.params import Params
from adlens.plans import workflow as W
from adlens.session import cut_lineage, fresh_folder
from adlens.sources import readers, sinks, views
from adlens.sources.facts import ad_facts, numbered_ad_rows, raw_ad_rows, table
from adlens.sources.sinks import json_round_trip

P = Params()
AS_OF = "1998-06-30"          # reference date of the relative-period queries
RANGE = ("1996-01-01", "1997-12-31")


def _r(c, d=10):
    return F.round(c, d)


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return ad_facts(spark, sf)


def _cleaned(spark, sf):
    return Q.clean(raw_ad_rows(spark, sf), P)


# -- data quality -------------------------------------------------------------

def scan_clean(spark, sf):
    return Q.clean(numbered_ad_rows(spark, sf), P).clean


def lenient_scan(spark, sf):
    return Q.lenient(numbered_ad_rows(spark, sf), P)


def missing_profile(spark, sf):
    c = _cleaned(spark, sf)
    return (c.issues.where(F.col("issue_type") == "missing_values")
            .select("field", F.col("count").alias("missing")))


def date_failures(spark, sf):
    c = _cleaned(spark, sf)
    return Q.date_examples(c.flags).select(F.col("pos").cast("bigint").alias("pos"),
                                           F.col("row").cast("bigint").alias("row"), "value")


def numeric_failures(spark, sf):
    c = _cleaned(spark, sf)
    return Q.numeric_examples(c.flags, c.numeric_fields).select(
        "field", F.col("pos").cast("bigint").alias("pos"), "value")


def column_missing(spark, sf):
    return M.missing_by_column(_cleaned(spark, sf).clean)


def quality_issues(spark, sf):
    c = _cleaned(spark, sf)
    examples = F.array_join(F.transform("examples", lambda e: F.concat_ws(":", e["row"].cast("string"), e["value"])), "|")
    return Q.quality_issues(c.flags, c.numeric_fields, c.required).select(
        F.col("ord").cast("bigint").alias("ord"), "issue_type", "field", "count", "action", examples.alias("examples"))


def invalid_rows(spark, sf):
    c = _cleaned(spark, sf)
    return Q.invalid_rows(c.profile, c.numeric_fields, c.required)


def load_counts(spark, sf):
    """Counts observed while the clean rows are written, and the rows that were."""
    c = _cleaned(spark, sf)
    clean, counts = Q.load_clean(c.flags, c.numeric_fields, c.required)
    return counts.withColumn("written_rows", clean.select(F.count("*")).scalar())


def missing_share_gate(spark, sf):
    """What a load with a limit for missing values does at two limits: it goes through, or names the fields and stops."""
    c = _cleaned(spark, sf)
    out = []
    for limit in (0.10, 0.01):
        try:
            Q.load_clean(c.flags, c.numeric_fields, c.required, max_missing=limit)
            out.append((limit, "loaded", None, None))
        except Q.MissingShareError as e:
            out += [(limit, "stopped", field, share) for field, share in e.shares.items()]
    return spark.createDataFrame(out, "share_limit double, outcome string, field string, share double").withColumn("share", _r(F.col("share")))


# -- files ---------------------------------------------------------------------

CSV_COLUMNS = ("campaign_name", "adset_name", "date", "spend", "impressions", "clicks", "purchases", "revenue", "creative_type",
               "creative_message", "audience_type", "platform", "country")


def _quoted_rows(spark, sf):
    """The raw rows, every seventh with quotes, separators and a line break in its message."""
    odd = F.concat("creative_message", F.lit(' says "'), "platform", F.lit('",\n'), "country")
    return raw_ad_rows(spark, sf).withColumn("creative_message", F.when(F.col("row_ord") % 7 == 0, odd).otherwise(F.col("creative_message")))


def _as_csv(rows, folder, mode="error"):
    rows.write.mode(mode).options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                                  **readers.QUOTING).csv(folder)


def csv_scan(spark, sf):
    """The raw rows written as CSV and loaded by the strict rules: quoting, line breaks, missing values, dates, numbers."""
    folder = fresh_folder(spark, "csv")
    _as_csv(_quoted_rows(spark, sf).select(*CSV_COLUMNS), folder)
    return readers.load_strict(spark, folder, P, multi_line=True, too_long="fail", columns=CSV_COLUMNS).clean.select(*CSV_COLUMNS)


def csv_lenient(spark, sf):
    """The raw rows as CSV, some lines two fields short and some a field too long, loaded leniently."""
    folder = fresh_folder(spark, "csv")
    rows = raw_ad_rows(spark, sf).withColumn("kind", F.col("row_ord") % 5)
    own = cut_lineage(rows.select("kind", *CSV_COLUMNS))
    _as_csv(own.where("kind > 1").drop("kind"), folder)
    _as_csv(own.where("kind = 1").drop("kind", "platform", "country"), folder, "append")
    _as_csv(own.where("kind = 0").withColumn("extra", F.lit("x")).drop("kind"), folder, "append")
    return readers.load_lenient(spark, folder, P, too_long="drop", columns=CSV_COLUMNS).select(*CSV_COLUMNS)


def view_reload(spark, sf):
    """A CSV dataset loaded twice through its view: the issues that the second load, which opens no raw file, has kept."""
    folder, root = fresh_folder(spark, "csv"), fresh_folder(spark, "view")
    _as_csv(raw_ad_rows(spark, sf).select(*CSV_COLUMNS), folder)
    views.load(spark, folder, root, P)
    again = views.load(spark, folder, root, P)
    return again.issues.select(F.col("ord").cast("bigint").alias("ord"), "issue_type", "field", "count", "action",
                               F.size("examples").cast("bigint").alias("n_examples"),
                               again.clean.select(F.count("*")).scalar().alias("clean_rows"), F.lit(again.reused).alias("reused"))


QUERY, DATASET, STAMP = "Analyze ROAS", "ad_facts", "2025-01-01T00:00:00Z"


def insights_published(spark, sf):
    """Validated hypotheses and top insights published all or nothing, and read back with their metadata."""
    a, root = _analysis(spark, sf), fresh_folder(spark, "published")
    sinks.publish_insights(a.validated, a.top_insights, root, QUERY, DATASET, STAMP)
    validated, top, _ = sinks.published_insights(spark, root)
    return validated.join(top.select(F.col("hypothesis").alias("hypothesis_text"), F.lit(True).alias("is_top")), "hypothesis_text", "left").select(
        "hypothesis_id", "hypothesis_text", "validation_status", F.col("rank").cast("bigint").alias("rank"),
        _r(F.col("adjusted_confidence_score")).alias("adjusted_confidence_score"),
        F.size("evidence.metrics").cast("bigint").alias("n_metrics"), F.coalesce("is_top", F.lit(False)).alias("is_top"),
        "query", "dataset", "timestamp")


def recommendations_published(spark, sf):
    """Recommendations published all or nothing, and read back with their metadata."""
    root = fresh_folder(spark, "published")
    sinks.publish_recommendations(spark, _full(spark, sf).recommendations, root, P.low_ctr, QUERY, DATASET, STAMP)
    recs, meta = sinks.published_recommendations(spark, root)
    return _recommendation_rows(recs).select("*", F.lit(meta["query"]).alias("query"), F.lit(meta["dataset"]).alias("dataset"),
                                             F.lit(meta["timestamp"]).alias("timestamp"), F.lit(meta["low_ctr_threshold"]).alias("low_ctr_threshold"))


# -- filters and aggregates ----------------------------------------------------

def date_range_filter(spark, sf):
    return M.dataset_summary(FL.date_range(facts(spark, sf), *RANGE))


def last_n_days(spark, sf):
    return M.dataset_summary(FL.last_n_days(facts(spark, sf), 30, AS_OF))


def dataset_summary(spark, sf):
    return M.dataset_summary(facts(spark, sf))


def overall_metrics(spark, sf):
    return M.overall_metrics(facts(spark, sf))


def weekly_metrics(spark, sf):
    return M.period_metrics(facts(spark, sf), "week")


def monthly_metrics(spark, sf):
    return M.period_metrics(facts(spark, sf), "month")


def weekly_mean_ctr(spark, sf):
    m = M.period_mean(facts(spark, sf), "week", "ctr")
    return m.select("period", _r(F.col("mean_ctr")).alias("mean_ctr"))


def trend_changes(spark, sf):
    return M.trend_changes(facts(spark, sf)).select("roas_wow", "ctr_wow", "roas_mom", "ctr_mom")


def seasonality(spark, sf):
    """Cycle of the daily roas and ctr, if there is one."""
    found = Z.seasonality(M.daily_sums(facts(spark, sf)))
    return found.select("metric", "days", "gaps", F.col("lag").cast("bigint").alias("lag"),
                        _r(F.col("autocorrelation"), 8).alias("autocorrelation"), "seasonal")


def period_sketches(spark, sf):
    """Distinct campaigns and the ctr quantile of every month from daily sketches; whether the quantile keeps its bound."""
    f = facts(spark, sf)
    month = F.date_trunc("month", F.col("date")).cast("date").alias("month")
    got = cut_lineage(K.merged(cut_lineage(K.daily_sketches(f)), month))
    rank = (f.where("ctr IS NOT NULL").select(month, "ctr").join(got.select("month", "q75"), "month").groupBy("month")
            .agg(F.avg((F.col("ctr") < F.col("q75")).cast("int")).alias("below"), F.avg((F.col("ctr") <= F.col("q75")).cast("int")).alias("upto")))
    bound = 3 * K.RANK_ERROR + F.lit(1.0) / F.col("values")
    kept = (F.col("below") - bound <= 0.75) & (F.lit(0.75) <= F.col("upto") + bound)
    return got.join(rank, "month").select("month", "rows", F.col("distinct_estimate").alias("campaigns"), "values", kept.alias("q75_in_bounds"))


def trend_direction(spark, sf):
    return M.trends(facts(spark, sf), P)


def _segment_query(field):
    def q(spark, sf):
        return S.segment_by(facts(spark, sf), field)
    q.__name__ = f"segments_{field}"
    return q


segments_campaign = _segment_query("campaign_name")
segments_creative = _segment_query("creative_type")
segments_audience = _segment_query("audience_type")
segments_platform = _segment_query("platform")


def segments_all(spark, sf):
    return S.segments(facts(spark, sf))


def best_worst_segments(spark, sf):
    return S.best_worst(S.segment_aggregates(facts(spark, sf), moments=False)).drop("worst", "best")


def _under(dim, metric, factor):
    def q(spark, sf):
        a = _analysis(spark, sf)
        return H.underperformers(a.seg, a.metrics, dim, metric, factor)
    return q


underperforming_campaigns = _under("campaign_name", "roas", 0.8)
low_ctr_creatives = _under("creative_type", "ctr", 0.8)
low_roas_audiences = _under("audience_type", "roas", 0.7)


def platform_gap(spark, sf):
    return H.platform_gap(S.segment_aggregates(facts(spark, sf), moments=False))


# -- hypotheses and evidence ------------------------------------------------------

def _analysis(spark, sf, params=P, creatives=False):
    return W.analyze(facts(spark, sf), params, creatives=creatives, checkpoint=True)


def hypotheses_numeric(spark, sf):
    a = _analysis(spark, sf)
    return a.hypotheses.select("ord", "category", "subject", "confidence_score", "hypothesis_text")


def hypotheses_padded(spark, sf):
    a = _analysis(spark, sf, P.with_(max_hypotheses=2))
    return a.hypotheses.select("ord", "category", "subject", "confidence_score")


def segment_stats(spark, sf):
    seg = S.segment_aggregates(facts(spark, sf), moments=True)
    return seg.select("dimension", "value", "ctr_n", _r(F.col("ctr_mean")).alias("ctr_mean"),
                      _r(F.col("ctr_var"), 12).alias("ctr_var"), "roas_n",
                      _r(F.col("roas_mean")).alias("roas_mean"), _r(F.col("roas_var")).alias("roas_var"))


def ttest_pairs(spark, sf):
    ev = _analysis(spark, sf).evidence
    return ev.where("has_test").select(
        "category", _r(F.col("t_stat"), 6).alias("t_stat"), "dof",
        _r(F.col("ci_lower"), 8).alias("ci_lower"), _r(F.col("ci_upper"), 8).alias("ci_upper"),
        _r(F.col("p_value"), 6).alias("p_value"))


def evidence_metrics(spark, sf):
    ev = _analysis(spark, sf).evidence
    return ev.select("category", F.posexplode("metrics").alias("pos", "m")).select(
        "category", F.col("pos").cast("bigint").alias("pos"), F.col("m.metric_name").alias("metric_name"),
        _r(F.col("m.value")).alias("value"), F.col("m.comparison").alias("comparison"))


def validation_scores(spark, sf):
    v = _analysis(spark, sf).validated
    return v.select("ord", "category", "validation_status", "has_test",
                    _r(F.col("validation_strength")).alias("validation_strength"),
                    _r(F.col("segmentation_evidence")).alias("segmentation_evidence"),
                    _r(F.col("adjusted_confidence_score")).alias("adjusted_confidence_score"))


def hypothesis_rank(spark, sf):
    return _analysis(spark, sf).validated.select(F.col("rank").cast("bigint").alias("rank"), "ord", "category")


def top_insights(spark, sf):
    t = _analysis(spark, sf).top_insights
    return t.select(F.col("rank").cast("bigint").alias("rank"), "hypothesis",
                    _r(F.col("validated_confidence")).alias("validated_confidence"))


def segment_counts(spark, sf):
    return R.segment_dimension_counts(S.segment_aggregates(facts(spark, sf), moments=False))


def hypothesis_categories(spark, sf):
    return R.hypothesis_categories(_analysis(spark, sf).hypotheses)


def top_hypothesis(spark, sf):
    t = R.top_hypothesis(_analysis(spark, sf).hypotheses)
    return t.select("hypothesis_text", _r(F.col("confidence_score")).alias("confidence_score"))


def validated_hypotheses(spark, sf):
    a = _analysis(spark, sf)
    j = R.validated_with_input(a.validated, a.hypotheses)
    return j.select("hypothesis_id", "ord", "category", _r(F.col("confidence_score")).alias("confidence_score"),
                    _r(F.col("adjusted_confidence_score")).alias("adjusted_confidence_score"),
                    "validation_status", F.col("rank").cast("bigint").alias("rank"))


def report_counts(spark, sf):
    a = _full(spark, sf)
    return R.report_counts(a.validated, a.recommendations)


def status_counts(spark, sf):
    return E.status_counts(_analysis(spark, sf).validated)


# -- creatives -------------------------------------------------------------------

def low_ctr_campaigns(spark, sf):
    return _creatives(spark, sf)["low_ctr"].select(
        "campaign", "current_ctr", "current_creative_type", "current_message")


def campaign_modes(spark, sf):
    return C.campaign_modes(facts(spark, sf))


def ctr_p75(spark, sf):
    return C.ctr_p75(facts(spark, sf))


def high_ctr_messages(spark, sf):
    return C.high_ctr_messages(facts(spark, sf)).select(
        F.col("rank").cast("bigint").alias("rank"), "creative_message", "rows")


def best_creative_types(spark, sf):
    b = C.best_creative_types(_analysis(spark, sf).seg)
    return b.select(F.posexplode("best_types").alias("pos", "creative_type")).select(
        (F.col("pos") + 1).cast("bigint").alias("rank"), "creative_type")


def audience_tags(spark, sf):
    modes = C.campaign_modes(facts(spark, sf))
    return modes.select("campaign_name", C.audience_tag(
        F.col("campaign_name"), F.col("mode_audience_type"), P.audience_substring_rules).alias("audience_tag"))


def _creatives(spark, sf):
    """Creative pipeline over the materialised single-scan cube (segments + modes)."""
    a = _analysis(spark, sf, creatives=True)
    a.recommendations  # builds and materialises the variations
    return a._creative_pipe()


def creative_candidates(spark, sf):
    c = _creatives(spark, sf)["candidates"]
    return c.select("campaign", "n_variations", F.posexplode("candidate_types").alias("pos", "candidate_type")) \
        .select("campaign", F.col("n_variations").cast("bigint").alias("n_variations"),
                F.col("pos").cast("bigint").alias("pos"), "candidate_type")


def creative_variations(spark, sf):
    return _variation_rows(_creatives(spark, sf)["variations"])


def _variation_rows(v):
    return v.select("campaign", F.col("i").cast("bigint").alias("i"), "creative_type", "creative_message",
                    "audience_type", _r(F.col("confidence_score")).alias("confidence_score"),
                    _r(F.col("expected_ctr_improvement")).alias("expected_ctr_improvement"), "rationale")


def creative_variations_four(spark, sf):
    """Variations where some campaigns have a type outside the standard ones or none at all: four candidates, four variations."""
    own = (F.when(F.col("campaign_name").startswith("Brand#1"), F.lit(None).cast("string"))
           .when(F.col("campaign_name").startswith("Brand#2"), F.lit("story")).otherwise(F.col("creative_type")))
    changed = facts(spark, sf).withColumn("creative_type", own)
    return _variation_rows(W.analyze(changed, P, creatives=True, checkpoint=True).variations)


def recommendation_summary(spark, sf):
    c = _creatives(spark, sf)
    s = C.recommendation_summary(c["variations"], c["low_ctr"])
    return s.select("low_ctr_campaigns", _r(F.col("avg_low_ctr")).alias("avg_low_ctr"), "total_variations",
                    _r(F.col("avg_variations_per_campaign")).alias("avg_variations_per_campaign"),
                    _r(F.col("avg_confidence")).alias("avg_confidence"))


# -- request tagging -------------------------------------------------------------------

def request_rows(spark, sf):
    """Requests to tag: all conversation texts, and one worded request per customer (stand-in input;
    negative conv_id) that goes through phrasings, periods, dates and blank texts."""
    k = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit("1996-01-01").cast("date"), (k % 700).cast("int")), "yyyy-MM-dd")
    later = F.date_format(F.date_add(F.lit("1996-03-01").cast("date"), (k % 700).cast("int")), "yyyy-MM-dd")
    words = [F.lit("Analyze ROAS for last 7 days"), F.lit("Why did click rates fall in the PAST 14 days?"),
             F.lit("Generate creative recommendations for last month"),
             F.concat(F.lit("Show conversion from "), day, F.lit(" to "), later),
             F.concat(F.lit("How was the return on ad spend on "), day), F.lit(""), F.lit("\t\n\t\n\t"), F.lit(" help "),
             F.lit("\u00a0\u2003ab\u3000"), F.lit("Ad copy ideas, CVR dropping since 1997-13-45"),
             F.lit("ab\n\n\n"), F.lit("last 2 weeks: ROI and CTR"), F.lit(None).cast("string"), F.lit("\x1fhello\x85")]
    text = F.element_at(F.array(*words), (k % len(words) + 1).cast("int"))
    worded = table(spark, sf, "customer").select((-k - 1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
                                                 text.alias("text"))
    return table(spark, sf, "conversations").select("conv_id", "turn", "text").unionByName(worded)


def _requests(spark, sf):
    return RQ.tag_requests(request_rows(spark, sf), "text", AS_OF)


def request_intent(spark, sf):
    return _requests(spark, sf).select("conv_id", "turn", "intent")


def request_focus(spark, sf):
    return _requests(spark, sf).select("conv_id", "turn", "focus_metric")


def request_period(spark, sf):
    return _requests(spark, sf).select("conv_id", "turn", "date_from", "date_to")


def request_workflow(spark, sf):
    return _requests(spark, sf).select("conv_id", "turn", "workflow_type")


def request_validity(spark, sf):
    return _requests(spark, sf).select("conv_id", "turn", "valid")


# -- report tables and contracts ------------------------------------------------------

def _full(spark, sf):
    return W.analyze(facts(spark, sf), P, creatives=True, checkpoint=True)


def report_summary(spark, sf):
    a = _full(spark, sf)
    s = R.executive_summary(a.summary, a.validated, a.recommendations)
    return s.select("start_date", "end_date", "total_rows", "total_spend", "total_revenue",
                    "validated_hypotheses", "recommendation_sets", "top_insight",
                    _r(F.col("top_confidence")).alias("top_confidence"))


def report_insights(spark, sf):
    return _insight_rows(_analysis(spark, sf).validated)


def _insight_rows(validated, k=3):
    return R.key_insights(validated, k).select(
        F.col("rank").cast("bigint").alias("rank"), "hypothesis_text",
        _r(F.col("adjusted_confidence_score")).alias("adjusted_confidence_score"),
        "validation_status", _r(F.col("p_value"), 6).alias("p_value"), "evaluation_band", "report_band",
        "validation_reasoning")


def report_metrics(spark, sf):
    m = R.supporting_metrics(_analysis(spark, sf).validated)
    return m.select(F.col("rank").cast("bigint").alias("rank"), F.col("pos").cast("bigint").alias("pos"),
                    "metric_name", _r(F.col("value")).alias("value"), "comparison")


def report_metrics_cells(spark, sf):
    """Supporting metrics of a table whose names and comparisons are blank, unprintable or wrapped in white space (made from customers)."""
    k = F.col("c_custkey")

    def cell(by):
        odd = ["", "  ", "\u200b", "\t\u00a0\u2003", " \u0007 ", "\u2028x\u00a0y ", "a\u200bb\u0001", "\ufeffok\u3000"]
        forms = F.array(*map(F.lit, odd), F.lit(None).cast("string"), F.concat(F.lit(" "), "c_name", F.lit("\n")), F.col("c_name"))
        return F.element_at(forms, (by % 11 + 1).cast("int"))

    metrics = F.array(*[F.struct(cell(k * (i + 1) + i).alias("metric_name"), (k + i).cast("double").alias("value"),
                                 cell(k + 3 * i).alias("comparison")) for i in range(3)])
    rows = table(spark, sf, "customer").select(k.cast("int").alias("rank"), metrics.alias("evidence_metrics"))
    found = R.supporting_metrics(rows, k=1 << 30)
    return found.select(F.col("rank").cast("bigint").alias("rank"), F.col("pos").cast("bigint").alias("pos"), "metric_name", "value", "comparison")


def report_recommendations(spark, sf):
    return _recommendation_rows(_full(spark, sf).recommendations)


def _recommendation_rows(recs):
    r = R.recommendation_rows(recs)
    return r.select("campaign", F.col("variation").cast("bigint").alias("variation"), "creative_type",
                    "creative_message", "audience_type",
                    _r(F.col("expected_ctr_improvement")).alias("expected_ctr_improvement"),
                    _r(F.col("confidence_score")).alias("confidence_score"))


# Requests of the registered request runs: an analysis without creatives, a creative run and a full one, each
# with a period that leaves few rows per segment.
REQUESTS = {
    "analysis": "Analyze ROAS for last 7 days",
    "creative": "Generate creative recommendations for 1997-03-01 to 1997-03-03",
    "full": "What happened on 1996-05-05",
    "summer": "Compare clicks from 1995-06-14 to 1995-08-23",
    "before": "Review everything from 1994-01-01 to 1994-03-12",    # before the first fact: default hypotheses only
}


def _request_run(kind):
    def q(spark, sf):
        """All ranked hypotheses of a request, with the number of its recommendations (null: not asked for)."""
        run = W.run_request(facts(spark, sf), REQUESTS[kind], AS_OF, P.with_(max_hypotheses=6))
        recs = run["recommendations"]
        n = F.lit(None).cast("bigint") if recs is None else recs.select(F.count(F.lit(1))).scalar()
        return _insight_rows(run["validated"], 100).withColumn("recommendation_sets", n)
    q.__name__ = f"request_run_{kind}"
    return q


def request_run_lenient(spark, sf):
    """The analysis request with t-test moments from the unfiltered facts."""
    f = facts(spark, sf)
    return _insight_rows(W.run_request(f, REQUESTS["analysis"], AS_OF, evidence_facts=f)["validated"], 100)


def hypotheses_six(spark, sf):
    """With room for a sixth hypothesis (the low-CTR rule)."""
    return _analysis(spark, sf, P.with_(max_hypotheses=6)).hypotheses.select(
        "ord", "category", "subject", "confidence_score", "hypothesis_text")


def contract_check(spark, sf):
    a = _full(spark, sf)
    return contract_violations(a.summary, a.trends, a.hypotheses, a.validated, a.recommendations, a.metrics)


def contract_defects(spark, sf):
    """The contract rules over result-like tables made from customers, with a defect of one kind or another
    in most rows (stand-in input)."""
    k = F.col("c_custkey")
    base = table(spark, sf, "customer").select("c_custkey")
    null, inf = F.lit(None), F.lit(float("inf"))

    def every(m, r, bad, good):
        return F.when(k % m == r, bad).otherwise(good)

    def metric(name, value):
        return F.struct(name.cast("string").alias("metric_name"), value.cast("double").alias("value"),
                        F.lit("c").alias("comparison"))

    summary = base.select(every(11, 0, null, k).cast("bigint").alias("total_rows"), F.lit("a").alias("start_date"),
                          every(13, 0, null, F.lit("b")).cast("string").alias("end_date"),
                          every(7, 1, F.lit(-1), F.lit(1)).cast("bigint").alias("campaigns_count"),
                          every(5, 2, F.lit(-2), F.lit(0)).cast("bigint").alias("invalid_rows"))
    trends = base.select(every(9, 0, null, every(9, 1, F.lit("up"), F.lit("stable"))).cast("string").alias("direction"),
                         every(10, 3, inf, F.lit(0.5)).alias("week_over_week_change"),
                         F.lit(1.0).alias("month_over_month_change"))
    hyp = base.select(F.lit("h").alias("hypothesis_id"), every(6, 0, null, F.lit("t")).cast("string").alias("hypothesis_text"),
                      every(8, 1, F.lit("other"), F.lit("budget")).alias("category"),
                      every(9, 2, F.lit(1.5), every(9, 3, null, F.lit(0.5))).cast("double").alias("confidence_score"))
    two = F.array(metric(every(12, 1, null, F.lit("m")), F.lit(1)), metric(F.lit("n"), every(12, 2, inf, F.lit(2))))
    validated = base.select(
        F.lit("h").alias("hypothesis_id"), F.lit("t").alias("hypothesis_text"),
        every(7, 0, F.lit("maybe"), F.lit("confirmed")).alias("validation_status"),
        F.when(k % 10 == 0, null).when(k % 10 == 1, F.slice(two, 1, 1)).otherwise(two).alias("evidence_metrics"),
        every(11, 3, F.lit(-0.1), F.lit(0.5)).cast("double").alias("adjusted_confidence_score"),
        every(13, 1, F.lit(1.2), every(13, 2, null, F.lit(0.5))).cast("double").alias("p_value"),
        (k % 2 == 0).alias("has_test"), every(14, 2, null, F.lit(0.1)).cast("double").alias("ci_lower"),
        F.lit(0.2).alias("ci_upper"))
    creative = F.struct(every(15, 1, F.lit(""), F.lit("msg")).alias("creative_message"),
                        every(15, 2, null, F.lit("video")).cast("string").alias("creative_type"),
                        every(15, 3, null, F.lit("Broad")).cast("string").alias("audience_type"),
                        F.lit("why").alias("rationale"),
                        every(15, 4, F.lit(2.0), F.lit(0.5)).alias("confidence_score"))
    recs = base.select(F.lit("c").alias("campaign"), every(16, 0, null, F.lit(0.1)).cast("double").alias("current_ctr"),
                       F.when(k % 17 == 0, null).when(k % 17 == 1, F.array(creative)).otherwise(
                           F.array(creative, creative, creative)).alias("new_creatives"))
    metrics = base.select(F.lit(1.0).alias("overall_roas"), F.lit(1.0).alias("overall_ctr"),
                          F.lit(1.0).alias("avg_cpc"))                       # conversion_rate is absent
    stamps = ["2025-01-01T00:00:00Z", "2025-01-01", "yesterday", "2025-13-01T00:00:00Z", "2025-01-01T10:00:00.123456Z"]
    outputs = base.select(F.element_at(F.array(*map(F.lit, stamps)), (k % 5 + 1).cast("int")).alias("timestamp"))
    return contract_violations(summary, trends, hyp, validated, recs, metrics, outputs)


def json_round_trip_segments(spark, sf):
    return json_round_trip(S.segments(facts(spark, sf)))


def narratives(spark, sf):
    a = _full(spark, sf)
    counts = E.status_counts(a.validated)
    summ = C.recommendation_summary(a.variations, a.low_ctr)
    return (R.insight_narrative(a.metrics, a.trends, a.seg, a.hypotheses, P.focus_metric)
            .unionByName(R.evaluation_narrative(a.hypotheses, a.validated, counts))
            .unionByName(R.creative_narrative(a.low_ctr, a.variations, summ, P.low_ctr)))


REGISTRY = {
    "load_counts": load_counts, "missing_share_gate": missing_share_gate, "csv_scan": csv_scan, "csv_lenient": csv_lenient,
    "view_reload": view_reload, "insights_published": insights_published, "recommendations_published": recommendations_published,
    "report_metrics_cells": report_metrics_cells, "creative_variations_four": creative_variations_four,
    "seasonality": seasonality, "period_sketches": period_sketches,
    "scan_clean": scan_clean, "lenient_scan": lenient_scan, "missing_profile": missing_profile, "date_failures": date_failures,
    "numeric_failures": numeric_failures, "column_missing": column_missing, "quality_issues": quality_issues,
    "invalid_rows": invalid_rows, "date_range_filter": date_range_filter, "last_n_days": last_n_days,
    "dataset_summary": dataset_summary, "overall_metrics": overall_metrics, "weekly_metrics": weekly_metrics,
    "monthly_metrics": monthly_metrics, "trend_changes": trend_changes, "trend_direction": trend_direction,
    "segments_campaign": segments_campaign, "segments_creative": segments_creative,
    "segments_audience": segments_audience, "segments_platform": segments_platform,
    "segments_all": segments_all, "best_worst_segments": best_worst_segments,
    "underperforming_campaigns": underperforming_campaigns, "low_ctr_creatives": low_ctr_creatives,
    "low_roas_audiences": low_roas_audiences, "platform_gap": platform_gap,
    "hypotheses_numeric": hypotheses_numeric, "hypotheses_padded": hypotheses_padded,
    "segment_stats": segment_stats, "ttest_pairs": ttest_pairs, "evidence_metrics": evidence_metrics,
    "validation_scores": validation_scores, "hypothesis_rank": hypothesis_rank, "top_insights": top_insights,
    "status_counts": status_counts, "low_ctr_campaigns": low_ctr_campaigns, "campaign_modes": campaign_modes,
    "ctr_p75": ctr_p75, "high_ctr_messages": high_ctr_messages, "best_creative_types": best_creative_types,
    "audience_tags": audience_tags, "creative_candidates": creative_candidates,
    "creative_variations": creative_variations, "recommendation_summary": recommendation_summary,
    "request_intent": request_intent, "request_focus": request_focus, "request_period": request_period,
    "request_workflow": request_workflow, "request_validity": request_validity,
    "report_summary": report_summary, "report_insights": report_insights, "report_metrics": report_metrics,
    "report_recommendations": report_recommendations, "contract_violations": contract_check,
    "contract_defects": contract_defects, "hypotheses_six": hypotheses_six,
    "request_run_analysis": _request_run("analysis"), "request_run_creative": _request_run("creative"),
    "request_run_full": _request_run("full"), "request_run_summer": _request_run("summer"),
    "request_run_before": _request_run("before"), "request_run_lenient": request_run_lenient,
    "json_round_trip": json_round_trip_segments, "narratives": narratives,
    "weekly_mean_ctr": weekly_mean_ctr, "segment_counts": segment_counts,
    "hypothesis_categories": hypothesis_categories, "top_hypothesis": top_hypothesis,
    "validated_hypotheses": validated_hypotheses, "report_counts": report_counts,
}
