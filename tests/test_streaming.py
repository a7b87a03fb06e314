import os
import tempfile

from pyspark.sql import functions as F

from adlens.operators import segments as S
from adlens.streaming import incremental as I


def test_streaming_cube_equals_batch(spark, facts):
    base = tempfile.mkdtemp(prefix="adlens-stream-")
    src, out, ck = (os.path.join(base, x) for x in ("src", "out", "ck"))
    # fact files arriving in three drops (split by ship year ranges of the driver data)
    cols = [c for c in facts.columns if c != "row_ord"]
    parts = [facts.where(F.year("date") < 1997), facts.where(F.year("date").between(1997, 1998)),
             facts.where(F.year("date") > 1998)]
    parts[0].select(cols).write.parquet(os.path.join(src, "d0"))
    stream = I.fact_stream(spark, os.path.join(src, "*"), facts.select(cols).schema)
    q = I.publish_cube(I.streaming_cube(stream, moments=False), out, ck)
    try:
        q.processAllAvailable()
        for i, p in enumerate(parts[1:], start=1):
            p.select(cols).write.parquet(os.path.join(src, f"d{i}"))
            q.processAllAvailable()
    finally:
        q.stop()
    got = I.latest_cube(spark, out)
    exp = S.fact_cube(facts.select(cols), moments=False, include_daily=True)
    key = ["dimension", "value", "spend_cents", "revenue_cents", "impressions", "clicks", "rows"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, exp.select(key).collect()))
    assert sorted(x for x in os.listdir(out) if x.startswith("epoch")) == ["epoch=1", "epoch=2"]       # the first is gone
