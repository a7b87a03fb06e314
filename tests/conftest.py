import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from adlens.session import local_session
    s = local_session("*", shuffle_partitions=8, app="adlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def facts(spark):
    from adlens.sources.facts import ad_facts
    return ad_facts(spark, SF001)


def fact_frame(spark, rows):
    """Small fact frame from tuples (campaign, date, spend, impressions, clicks, revenue,
    purchases, creative_type, audience_type, platform)."""
    import datetime as dt
    from pyspark.sql import functions as F
    schema = ("campaign_name string, date date, spend double, impressions bigint, clicks bigint, "
              "revenue double, purchases bigint, creative_type string, audience_type string, platform string")
    data = [(r[0], dt.date.fromisoformat(r[1]), *r[2:]) for r in rows]
    df = spark.createDataFrame(data, schema)
    return df.withColumns({
        "ctr": F.col("clicks") / F.nullif(F.col("impressions"), F.lit(0)),
        "roas": F.col("revenue") / F.nullif(F.col("spend"), F.lit(0.0)),
        "creative_message": F.concat(F.lit("msg "), F.col("creative_type")),
    })
