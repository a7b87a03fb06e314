"""Scale properties of the executed plans (guards against silent regressions)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from plan_audit import audit  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["segments_all", "dataset_summary", "trend_direction", "invalid_rows",
                                  "segment_stats", "campaign_modes", "weekly_metrics"])
def test_fact_view_scanned_once(spark, name):
    a = audit(E.queries()[name](spark, SF))
    assert a["scans"].get("lineitem") == 1, a
    assert a["python_eval"] == 0


@pytest.mark.parametrize("name", ["quality_issues", "numeric_failures", "date_failures"])
def test_examples_read_only_the_table_of_failures(spark, name):
    a = audit(E.queries()[name](spark, SF))
    assert not a["scans"] and a["python_eval"] == 0, a


def test_issues_and_examples_read_every_row_once(spark):
    """Rows are counted as they are read, over all jobs of building and running."""
    from adlens.operators import cleaning as Q
    from adlens.sources.facts import raw_ad_rows
    raw = raw_ad_rows(spark, SF).persist()
    n, seen = raw.count(), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    for build in (lambda c: c.issues, lambda c: Q.date_examples(c.flags), lambda c: Q.load_clean(c.flags, c.numeric_fields, c.required)[1]):
        before = seen.value
        build(Q.clean(raw.mapInArrow(counted, raw.schema))).collect()
        assert seen.value - before == n
    raw.unpersist()


def test_cube_is_one_linear_plan(spark, facts):
    from adlens.operators import segments as S
    cube = S.fact_cube(facts, include_daily=True)
    a = audit(cube)
    assert a["scans"].get("lineitem") == 1
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Expand" in plan


def test_date_range_pushed_to_scan(spark):
    a = audit(E.queries()["date_range_filter"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in a["lineitem_pushed"]


def test_analysis_queries_read_materialised_tables(spark):
    for name in ["hypotheses_numeric", "validation_scores", "creative_variations"]:
        a = audit(E.queries()[name](spark, SF))
        assert "lineitem" not in a["scans"] and a["python_eval"] == 0, (name, a)
