"""The full analysis as one composition of DataFrame functions.

Physical shape, whatever the data size:

* one scan -- ``fact_cube``: one GROUPING SETS aggregate over the facts
  (four dimensions + date; sums, row counts, t-test moments).  Partial
  aggregation map-side; output is #dates + #segment values rows.
* with creatives a second, column-pruned scan counts (campaign, value) pairs
  for the per-campaign modes (``creatives.campaign_modes``).  Its rows carry
  a count only; as many pairs as rows (a message of its own for each row) do
  not touch the cube.
* the exact ctr quantile histogram and the high-CTR message counts (only
  for the high-CTR message report) scan again.

The cube is written as a table into the session's shared checkpoint folder
and read back (``session.cut_lineage``), and so are one row of metrics and
trends, and the creative variations when first used, so later steps (and an
executor loss) never recompute from the raw facts.
Everything after the scan works on those small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators import creatives as C
from adlens.operators import evidence as E
from adlens.operators import hypotheses as H
from adlens.operators import metrics as M
from adlens.operators import report as R
from adlens.operators import segments as S
from adlens.operators.contracts import contract_violations
from adlens.params import Params
from adlens.session import cut_lineage


class Analysis:
    """Result tables of one analysis; each step is built on first access.

    Building a DataFrame costs plan analysis on the driver, so a query that
    needs only the hypotheses does not pay for evidence or creatives.
    """

    def __init__(self, facts: DataFrame, params: Params, data: dict, creatives: bool, checkpoint: bool,
                 evidence_facts: DataFrame | None = None):
        self.facts, self.params, self._checkpoint = facts, params, checkpoint
        self.evidence_facts = evidence_facts
        self.cube, self.daily, self.seg = data["cube"], data["daily"], data["seg"]
        self.summary = data["summary"]
        self._context_builder = data["context"]
        self._creatives = creatives
        self._cache: dict = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def _set(self, name, value):
        self._cache[name] = value

    _context = property(lambda self: self._get("context", self._context_builder))
    metrics = property(lambda self: self._get("metrics", lambda: self._context.select("metrics.*")))
    trends = property(lambda self: self._get("trends", lambda: self._context.select(F.inline("trends"))))
    hypotheses = property(lambda self: self._get(
        "hypotheses", lambda: H.hypotheses(self.metrics, self.trends, self.seg, self.params)))
    def _evidence_seg(self) -> DataFrame:
        """Segments whose t-test moments come from ``evidence_facts`` when given."""
        if self.evidence_facts is None:
            return self.seg
        moments = [c for m in ("ctr", "roas") for c in (f"{m}_n", f"{m}_mean", f"{m}_var")]
        stats = S.segment_aggregates(self.evidence_facts, moments=True).select("dimension", "value", *moments)
        return self.seg.drop(*moments).join(stats, ["dimension", "value"], "left")

    evidence = property(lambda self: self._get(
        "evidence", lambda: E.evidence_by_category(self._evidence_seg(), self.metrics, self.trends, self.params)))
    validated = property(lambda self: self._get(
        "validated", lambda: E.validate(self.hypotheses, self.evidence, self.params)),
        lambda self, v: self._set("validated", v))
    top_insights = property(lambda self: self._get(
        "top_insights", lambda: E.top_insights(self.validated)),
        lambda self, v: self._set("top_insights", v))

    def _creative_pipe(self):
        def build():
            if self.evidence_facts is not None:
                pipe = C.creative_pipeline(self.seg, self.evidence_facts, self.params)
            else:
                pipe = C.creative_pipeline(self.seg, self.facts, self.params)
            if self._checkpoint:
                pipe["variations"] = cut_lineage(pipe["variations"])
            pipe["recommendations"] = C.recommendations(pipe["variations"])
            return pipe
        return self._get("creative_pipe", build) if self._creatives else None

    low_ctr = property(lambda self: (self._creative_pipe() or {}).get("low_ctr"))
    variations = property(lambda self: (self._creative_pipe() or {}).get("variations"))
    recommendations = property(lambda self: (self._creative_pipe() or {}).get("recommendations"))

    def segments(self) -> DataFrame:
        return self.seg.select(*S.SEGMENT_COLUMNS)


def data_step(facts: DataFrame, params: Params = Params(), issues: DataFrame | None = None,
              checkpoint: bool = True) -> dict:
    """One scan of the facts (the cube), materialised.  Overall metrics and
    trends are one row, built and materialised on first use, since every later
    step reads them through scalar subqueries."""
    cube = S.fact_cube(facts, moments=True, include_daily=True)
    if checkpoint:
        cube = cut_lineage(cube)
    # at most one row per calendar day: in one partition, what follows needs no exchange and is one job
    daily = S.daily_of_cube(cube).coalesce(1)
    seg = S.segments_of_cube(cube)

    def context():
        found = M.trends(facts, params, daily=daily).agg(F.collect_list(F.struct("*"))).scalar()
        row = M.overall_metrics(daily).select(F.struct("*").alias("metrics"), found.alias("trends"))
        return cut_lineage(row) if checkpoint else row

    return dict(cube=cube, daily=daily, seg=seg, context=context,
                summary=M.summary_from_daily(daily, seg, issues))


def analyze(facts: DataFrame, params: Params = Params(), issues: DataFrame | None = None,
            creatives: bool = True, checkpoint: bool = True,
            evidence_facts: DataFrame | None = None) -> Analysis:
    """The data step now (one cube pass, materialised); later steps lazily on access.

    ``evidence_facts``: optional second frame (e.g. the lenient, unfiltered
    load) from which the t-test moments and the creative modes are taken,
    as the analysed tool does.  By default both come from ``facts``.
    """
    return Analysis(facts, params, data_step(facts, params, issues, checkpoint),
                    creatives, checkpoint, evidence_facts)


def materialize_concurrently(builders: dict, threads: int = 4) -> dict:
    """Run independent materialisations as concurrent Spark jobs.

    Each value is a zero-argument callable returning a DataFrame (typically
    ``cut_lineage`` of a small result).  Spark schedules jobs submitted from
    several driver threads side by side, so chains of small, latency-bound
    jobs overlap instead of queueing.
    """
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        futures = {k: pool.submit(fn) for k, fn in builders.items()}
        return {k: f.result() for k, f in futures.items()}


def run_workflow(facts: DataFrame, params: Params = Params(), raw: DataFrame | None = None,
                 request_text: str | None = None, threads: int = 4) -> dict:
    """End-to-end: (optional) loading rules on raw rows, analysis, creatives, report tables.

    Returns the result tables as DataFrames.  The ranked hypotheses and the
    creative variations (independent branches over the materialised cube)
    are materialised concurrently; every report table then reads them.
    """
    from adlens.operators import cleaning as Q
    issues = None
    out = {}
    if raw is not None:
        c = Q.clean(raw, params)
        facts = c.clean
        issues = cut_lineage(c.issues)
        out["quality_issues"] = issues
    a = analyze(facts, params, issues=issues, creatives=True, checkpoint=True)
    done = materialize_concurrently({
        "validated": lambda: cut_lineage(a.validated),
        "creatives": lambda: a.recommendations,        # builds and materialises the variations
    }, threads)
    a.validated = done["validated"]
    a.top_insights = E.top_insights(a.validated)
    out.update(analysis=a, summary=a.summary, metrics=a.metrics, trends=a.trends, segments=a.segments(),
               validated=a.validated, top_insights=a.top_insights, recommendations=a.recommendations)
    out.update({f"report_{k}": v for k, v in report_tables(a, request_text).items() if v is not None})
    return out


def run_request(facts: DataFrame, request_text: str, as_of, params: Params = Params(),
                evidence_facts: DataFrame | None = None, checkpoint: bool = True) -> dict:
    """One free-text request from tagging to results.

    The request's tags decide what runs: its period filters the facts (pushed
    into their scan), its focus metric phrases the hypotheses, and creatives
    are made only for the workflow types that ask for them.  ``evidence_facts``
    (for instance the lenient, unfiltered load) gives the t-test moments and
    the creative modes instead of the filtered facts.  An invalid request
    raises ``ValueError``.
    """
    from adlens.operators import filters as FL
    from adlens.operators import requests as RQ
    spark = facts.sparkSession
    one = spark.createDataFrame([(request_text,)], "text string")
    tags = RQ.tag_requests(one, "text", as_of, keys=()).first()             # one row decides the plan
    if not tags["valid"]:
        raise ValueError("the request is empty or too short")
    wants_creatives = tags["workflow_type"] in ("creative_generation", "full")
    focus = "ctr" if tags["focus_metric"] == "ctr" else "roas"
    a = analyze(FL.date_range(facts, tags["date_from"], tags["date_to"]), params.with_(focus_metric=focus),
                creatives=wants_creatives, checkpoint=checkpoint, evidence_facts=evidence_facts)
    return {"tags": tags, "analysis": a, "validated": a.validated, "top_insights": a.top_insights,
            "recommendations": a.recommendations if wants_creatives else None}


def report_tables(a: Analysis, request_text: str | None = None) -> dict:
    recs = a.recommendations
    if recs is None:
        recs = a.validated.sparkSession.createDataFrame(
            [], "campaign string, current_ctr double, current_creative_type string, "
                "current_message string, new_creatives array<struct<creative_id:string>>")
    return {
        "summary": R.executive_summary(a.summary, a.validated, recs, request_text),
        "insights": R.key_insights(a.validated),
        "metrics": R.supporting_metrics(a.validated),
        "recommendations": R.recommendation_rows(recs) if a.recommendations is not None else None,
        "contracts": contract_violations(a.summary, a.trends, a.hypotheses, a.validated, recs, a.metrics),
    }
