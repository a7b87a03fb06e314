"""Property test: the single-pass cube against a pandas brute force on random frames."""

import datetime as dt

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.operators import segments as S
from adlens.operators.creatives import campaign_modes

ROW = st.tuples(
    st.sampled_from(["C1", "C2", "C3"]),                       # campaign
    st.integers(0, 20),                                        # day offset
    st.integers(0, 50_000),                                    # spend cents
    st.integers(0, 5_000),                                     # impressions
    st.integers(0, 300),                                       # clicks
    st.integers(0, 90_000),                                    # revenue cents
    st.sampled_from(["image", "video", None]),                 # creative type
    st.sampled_from(["m1", "m2", "m3"]),                       # message
    st.sampled_from(["a", "b", None]),                         # audience
    st.sampled_from(["Facebook", "Instagram"]),                # platform
)
SCHEMA = ("campaign_name string, date date, spend_cents bigint, impressions bigint, clicks bigint, "
          "revenue_cents bigint, creative_type string, creative_message string, audience_type string, "
          "platform string")


def _mode(series):
    s = series.dropna()
    if s.empty:
        return None
    counts = s.value_counts()
    return min(counts[counts == counts.max()].index)


@settings(max_examples=6, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=40))
def test_cube_matches_pandas(spark, rows):
    data = [(c, dt.date(2024, 1, 1) + dt.timedelta(days=d), *rest) for c, d, *rest in rows]
    df = spark.createDataFrame(data, SCHEMA)
    df = df.withColumns({"spend": df.spend_cents / 100.0, "revenue": df.revenue_cents / 100.0})
    cube = S.fact_cube(df, moments=False, include_daily=True)
    got = {(r.dimension, r.value): r for r in cube.collect()}
    pdf = pd.DataFrame(data, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    for dim in ["campaign_name", "creative_type", "audience_type", "platform"]:
        exp = pdf.dropna(subset=[dim]).groupby(dim).agg(
            sc=("spend_cents", "sum"), rc=("revenue_cents", "sum"), imp=("impressions", "sum"),
            clk=("clicks", "sum"), n=("spend_cents", "size"))
        assert {v for (d, v) in got if d == dim} == set(exp.index)
        for v, e in exp.iterrows():
            r = got[(dim, v)]
            assert (r.spend_cents, r.revenue_cents, r.impressions, r.clicks, r.rows) == \
                (e.sc, e.rc, e.imp, e.clk, e.n)
            assert r.roas == (e.rc / 100.0 / (e.sc / 100.0) if e.sc > 0 else 0.0)
    daily = pdf.groupby("date").agg(sc=("spend_cents", "sum"), n=("spend_cents", "size"))
    for d, e in daily.iterrows():
        r = got[("date", str(d))]
        assert (r.spend_cents, r.rows) == (e.sc, e.n)
    modes = {r.campaign_name: r for r in campaign_modes(df).collect()}
    for f in ["creative_type", "creative_message", "audience_type"]:
        for camp, grp in pdf.groupby("campaign_name"):
            assert modes[camp][f"mode_{f}"] == _mode(grp[f])
