import datetime as dt

from adlens.operators import requests as RQ


def test_request_tagging(spark):
    texts = ["Why did ROAS drop in the last 7 days?", "Generate creative ideas for low CTR campaigns",
             "Analyze performance from 2024-01-01 to 2024-01-31", "check conversion on 2024-02-10",
             "help", "   ", None, "report on return on ad spend past 30 days"]
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "conv_id long, turn long, text string")
    rows = RQ.tag_requests(df, "text", as_of="2025-12-01").orderBy("conv_id").collect()
    assert [r.intent for r in rows] == ["roas_analysis", "creative_generation", "full_analysis", "full_analysis",
                                        "full_analysis", "full_analysis", "full_analysis", "roas_analysis"]
    assert [r.focus_metric for r in rows] == ["roas", "ctr", None, "cvr", None, None, None, None]
    assert [r.workflow_type for r in rows][:3] == ["analysis", "creative_generation", "full"]
    assert (rows[0].date_from, rows[0].date_to) == (dt.date(2025, 11, 24), dt.date(2025, 12, 1))
    assert (rows[2].date_from, rows[2].date_to) == (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert (rows[3].date_from, rows[3].date_to) == (dt.date(2024, 2, 3), dt.date(2024, 2, 10))
    assert (rows[7].date_from, rows[7].date_to) == (dt.date(2025, 11, 1), dt.date(2025, 12, 1))
    assert rows[4].date_from is None
    assert [r.valid for r in rows] == [True, True, True, True, False, False, False, True]


def test_white_space_is_not_text(spark):
    texts = ["\t\n\t\n\t", "ab\n\n\n", "\u00a0\u2003ab\u3000", "\x1fhello\x85", " a b c ", "abcde", "\u2028\u2029\u202f\u205f\u1680"]
    df = spark.createDataFrame(list(enumerate(texts)), "conv_id long, text string")
    got = {r.conv_id: r.valid for r in RQ.tag_requests(df, "text", keys=("conv_id",)).collect()}
    assert got == {i: len(t.strip()) >= 5 for i, t in enumerate(texts)}
