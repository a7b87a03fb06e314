"""Independent SQL formulation of the registered queries (DuckDB dialect).

Used as the correctness oracle: the same driver tables are registered as
views, the fact view is derived with ``FACTS_SQL`` and every query below is
written from the rules directly -- windows, unions and correlated
subqueries instead of the Spark library code.
"""

from __future__ import annotations

# The required fields and the strings that stand for a missing value.
REQUIRED_FIELDS = ["campaign_name", "date", "spend", "impressions", "clicks", "revenue"]
NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
              "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# The fact rows over the driver tables; prefix an oracle query with ``WITH`` + these.
FACTS_BASE_SQL = """
fact_base AS (
  SELECT concat(p_brand, '_', CASE p_size % 5 WHEN 0 THEN 'Female_18-30' WHEN 1 THEN 'Female_31-45'
                WHEN 2 THEN 'Male_18-24' WHEN 3 THEN 'Male_25-40' ELSE 'Broad' END) AS campaign_name,
         concat(p_brand, '/', l_returnflag) AS adset_name,
         CAST(l_shipdate AS DATE) AS date,
         CAST(floor(l_extendedprice * abs(l_discount) * 100 + 0.5) AS BIGINT) AS spend_cents,
         CAST(floor(l_quantity * 1000) AS BIGINT) AS impressions,
         CAST(floor(l_quantity * 1000 * l_tax / 4
              * CAST(CASE p_size % 4 WHEN 0 THEN 0.5 WHEN 1 THEN 1.5 WHEN 2 THEN 1.0 ELSE 1.25 END AS DOUBLE)) AS BIGINT) AS clicks,
         CAST(l_linenumber AS BIGINT) AS purchases,
         CAST(floor(l_extendedprice * l_tax * 300
              * CAST(CASE l_linestatus WHEN 'O' THEN 1.5 ELSE 0.9 END AS DOUBLE)
              * CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 0.4 WHEN 'MACHINERY' THEN 1.2 ELSE 1.0 END AS DOUBLE)
              * CAST(CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 0.5 ELSE 1.0 END AS DOUBLE) + 0.5) AS BIGINT) AS revenue_cents,
         CASE p_size % 4 WHEN 0 THEN 'image' WHEN 1 THEN 'video' WHEN 2 THEN 'carousel' ELSE 'collection' END AS creative_type,
         p_name AS creative_message,
         c_mktsegment AS audience_type,
         CASE l_linestatus WHEN 'O' THEN 'Facebook' ELSE 'Instagram' END AS platform,
         n_name AS country,
         l_orderkey * 8 + l_linenumber AS row_ord,
         l_orderkey, l_partkey, l_suppkey
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
       JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
)"""

FACTS_SQL = FACTS_BASE_SQL + """,
ad_facts AS (
  SELECT campaign_name, adset_name, date, spend_cents / 100.0 AS spend, impressions, clicks, purchases,
         revenue_cents / 100.0 AS revenue, creative_type, creative_message, audience_type, platform, country,
         clicks / nullif(impressions, 0) AS ctr,
         revenue_cents / nullif(spend_cents, 0) AS roas,
         spend_cents, revenue_cents, row_ord
  FROM fact_base
)"""

RAW_SQL = FACTS_BASE_SQL + """,
raw_ad_rows AS (
  SELECT row_ord * 1048576 + (l_partkey * 8191 + l_suppkey) % 1048576 AS row_ord, campaign_name, adset_name,
         CASE WHEN l_orderkey % 89 = 0 THEN 'invalid-date' ELSE CAST(date AS VARCHAR) END AS date,
         CASE WHEN l_orderkey % 97 = 0 THEN 'not-a-number' ELSE CAST(spend_cents AS VARCHAR) END AS spend,
         CAST(impressions AS VARCHAR) AS impressions, CAST(clicks AS VARCHAR) AS clicks,
         CAST(purchases AS VARCHAR) AS purchases,
         CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE CAST(revenue_cents AS VARCHAR) END AS revenue,
         creative_type, creative_message, audience_type, platform, country
  FROM fact_base
)"""

AS_OF = "1998-06-30"
RANGE = ("1996-01-01", "1997-12-31")

# The same rows, lines of one order that share a number numbered one by one.
NUMBERED_RAW_SQL = RAW_SQL.replace("row_ord * 1048576 + (l_partkey * 8191 + l_suppkey) % 1048576 AS row_ord", """row_ord * 1000 + row_number() OVER (
           PARTITION BY row_ord ORDER BY fact_base.date, campaign_name, adset_name, spend_cents, impressions, clicks,
           revenue_cents, creative_message, country, creative_type, audience_type, platform, purchases, l_orderkey) AS row_ord""")

RAW_COLS = ["row_ord", "campaign_name", "adset_name", "date", "spend", "impressions", "clicks", "purchases",
            "revenue", "creative_type", "creative_message", "audience_type", "platform", "country"]
RAW_NUMERIC = ["spend", "impressions", "clicks", "revenue", "purchases"]
DIMS = [("campaign_name", 0), ("creative_type", 1), ("audience_type", 2), ("platform", 3)]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"


# ---------------------------------------------------------------- cleaning ---
_NA = ", ".join(_q(x) for x in NA_STRINGS)
_RAWN = "raw_n AS (SELECT row_ord, " + ", ".join(
    f"CASE WHEN {c} IN ({_NA}) THEN NULL ELSE {c} END AS {c}" for c in RAW_COLS if c != "row_ord") + \
    " FROM raw_ad_rows)"
_MISSING = " OR ".join(f"{c} IS NULL" for c in REQUIRED_FIELDS)
_FLAGS = f"""flags AS (
  SELECT *, ({_MISSING}) AS missing, CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS pdate FROM raw_n)"""
_CLEAN = "clean AS (SELECT " + ", ".join(
    "pdate AS date" if c == "date" else (f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in RAW_NUMERIC else c)
    for c in RAW_COLS) + " FROM flags WHERE NOT missing AND pdate IS NOT NULL)"
CLEAN_CTES = [RAW_SQL.strip(), _RAWN, _FLAGS, _CLEAN]

SCAN_CLEAN = _with(NUMBERED_RAW_SQL.strip(), _RAWN, _FLAGS, _CLEAN) + "SELECT * FROM clean"

LENIENT_SCAN = _with(NUMBERED_RAW_SQL.strip(), _RAWN) + "SELECT " + ", ".join(
    "CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date" if c == "date"
    else (f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in RAW_NUMERIC else c) for c in RAW_COLS) + " FROM raw_n"

MISSING_PROFILE = _with(*CLEAN_CTES) + "SELECT field, missing FROM (" + " UNION ALL ".join(
    f"SELECT {_q(c)} AS field, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing FROM raw_n"
    for c in REQUIRED_FIELDS) + ") WHERE missing > 0"

DATE_FAILURES = _with(*CLEAN_CTES, "q2 AS (SELECT * FROM flags WHERE NOT missing)",
                      "dfail AS (SELECT row_ord, date FROM q2 WHERE pdate IS NULL ORDER BY row_ord LIMIT 5)") + """
SELECT CAST(row_number() OVER (ORDER BY row_ord) - 1 AS BIGINT) AS pos,
       CAST((SELECT count(*) FROM q2 WHERE q2.row_ord < d.row_ord) AS BIGINT) AS "row",
       date AS value
FROM dfail d"""

NUMERIC_FAILURES = _with(*CLEAN_CTES, "nf AS (" + " UNION ALL ".join(
    f"(SELECT {_q(c)} AS field, row_ord, {c} AS value FROM flags WHERE NOT missing AND pdate IS NOT NULL "
    f"AND {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL ORDER BY row_ord LIMIT 5)"
    for c in RAW_NUMERIC) + ")") + """
SELECT field, CAST(row_number() OVER (PARTITION BY field ORDER BY row_ord) - 1 AS BIGINT) AS pos, value FROM nf"""

COLUMN_MISSING = _with(*CLEAN_CTES) + "SELECT field, missing FROM (" + " UNION ALL ".join(
    f"SELECT {_q(c)} AS field, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing FROM clean"
    for c in RAW_COLS) + ") WHERE missing > 0"

_PROFILE = "profile AS (SELECT CAST(count(*) AS BIGINT) AS raw_rows, " + ", ".join(
    [f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_{c}" for c in REQUIRED_FIELDS]
    + ["CAST(count(*) FILTER (WHERE NOT missing AND pdate IS NULL) AS BIGINT) AS date_failures"]
    + [f"CAST(count(*) FILTER (WHERE NOT missing AND pdate IS NOT NULL AND {c} IS NOT NULL "
       f"AND TRY_CAST({c} AS DOUBLE) IS NULL) AS BIGINT) AS nonnum_{c}" for c in RAW_NUMERIC]
    + ["CAST(count(*) FILTER (WHERE NOT missing AND pdate IS NOT NULL) AS BIGINT) AS clean_rows"]) + " FROM flags)"

_ISSUE_ROWS = ([(i, "missing_values", c, f"missing_{c}", "excluded_rows") for i, c in enumerate(REQUIRED_FIELDS)]
               + [(len(REQUIRED_FIELDS), "invalid_dates", None, "date_failures", "excluded_rows")]
               + [(len(REQUIRED_FIELDS) + 1 + j, "non_numeric_values", c, f"nonnum_{c}", "converted_to_nan")
                  for j, c in enumerate(RAW_NUMERIC)])
QUALITY_ISSUES = _with(*CLEAN_CTES, _PROFILE) + """SELECT i.*, coalesce(CASE i.issue_type
  WHEN 'invalid_dates' THEN (SELECT string_agg("row" || ':' || value, '|' ORDER BY pos) FROM (""" + DATE_FAILURES[
    DATE_FAILURES.index("q2 AS ("):].join(["WITH ", ""]) + """))
  WHEN 'non_numeric_values' THEN (SELECT string_agg(value, '|' ORDER BY pos) FROM (""" + NUMERIC_FAILURES[
    NUMERIC_FAILURES.index("nf AS ("):].join(["WITH ", ""]) + """) x WHERE x.field = i.field) END, '') AS examples
FROM (""" + " UNION ALL ".join(
    f"SELECT CAST({o} AS BIGINT) AS ord, {_q(t)} AS issue_type, "
    f"{'CAST(NULL AS VARCHAR)' if f is None else _q(f)} AS field, {col} AS count, {_q(a)} AS action FROM profile"
    for o, t, f, col, a in _ISSUE_ROWS) + ") i WHERE count > 0"

INVALID_ROWS = _with(*CLEAN_CTES, _PROFILE) + "SELECT CAST(" + " + ".join(
    [f"missing_{c}" for c in REQUIRED_FIELDS] + ["date_failures"] + [f"nonnum_{c}" for c in RAW_NUMERIC]) + \
    " AS BIGINT) AS invalid_rows, raw_rows, clean_rows, raw_rows - clean_rows AS rows_removed FROM profile"

# ------------------------------------------------------------- aggregates ---
F = FACTS_SQL.strip()


def _summary_of(src: str) -> str:
    return f"""SELECT CAST(count(*) AS BIGINT) AS total_rows, min(date) AS start_date, max(date) AS end_date,
       CAST(coalesce(sum(spend_cents), 0) AS DOUBLE) / 100.0 AS total_spend,
       CAST(coalesce(sum(revenue_cents), 0) AS DOUBLE) / 100.0 AS total_revenue,
       CAST(count(DISTINCT campaign_name) AS BIGINT) AS campaigns_count,
       CAST(0 AS BIGINT) AS invalid_rows
FROM {src}"""


DATASET_SUMMARY = _with(F) + _summary_of("ad_facts")
DATE_RANGE_FILTER = _with(F) + _summary_of(
    f"(SELECT * FROM ad_facts WHERE date >= DATE '{RANGE[0]}' AND date <= DATE '{RANGE[1]}')")
LAST_N_DAYS = _with(F) + _summary_of(
    f"(SELECT * FROM ad_facts WHERE date >= DATE '{AS_OF}' - INTERVAL 30 DAY AND date <= DATE '{AS_OF}')")

_TOT = """tot AS (SELECT CAST(coalesce(sum(spend_cents), 0) AS DOUBLE) / 100.0 AS spend,
                  CAST(coalesce(sum(revenue_cents), 0) AS DOUBLE) / 100.0 AS revenue,
                  coalesce(sum(impressions), 0) AS impressions, coalesce(sum(clicks), 0) AS clicks,
                  coalesce(sum(purchases), 0) AS purchases FROM ad_facts)"""
_METRICS = """metrics AS (SELECT
    CASE WHEN spend > 0 THEN revenue / spend ELSE 0.0 END AS overall_roas,
    CASE WHEN impressions > 0 THEN CAST(clicks AS DOUBLE) / CAST(impressions AS DOUBLE) ELSE 0.0 END AS overall_ctr,
    CASE WHEN clicks > 0 THEN spend / CAST(clicks AS DOUBLE) ELSE 0.0 END AS avg_cpc,
    CASE WHEN clicks > 0 THEN CAST(purchases AS DOUBLE) / CAST(clicks AS DOUBLE) ELSE 0.0 END AS conversion_rate
  FROM tot)"""
OVERALL_METRICS = _with(F, _TOT, _METRICS) + "SELECT * FROM metrics"


def _period(unit: str, name: str) -> str:
    return f"""{name} AS (
  SELECT period, spend, revenue, impressions, clicks,
         CASE WHEN spend = 0 THEN NULL ELSE revenue / spend END AS roas,
         CASE WHEN impressions = 0 THEN NULL ELSE CAST(clicks AS DOUBLE) / CAST(impressions AS DOUBLE) END AS ctr
  FROM (SELECT CAST(date_trunc('{unit}', date) AS DATE) AS period,
               CAST(coalesce(sum(spend_cents), 0) AS DOUBLE) / 100.0 AS spend,
               CAST(coalesce(sum(revenue_cents), 0) AS DOUBLE) / 100.0 AS revenue,
               coalesce(sum(impressions), 0) AS impressions, coalesce(sum(clicks), 0) AS clicks
        FROM ad_facts GROUP BY 1))"""


WEEKLY_METRICS = _with(F, _period("week", "weekly")) + "SELECT * FROM weekly"
MONTHLY_METRICS = _with(F, _period("month", "monthly")) + "SELECT * FROM monthly"


def _chg(m: str) -> str:
    return (f"CASE WHEN k < 2 THEN 0.0 WHEN {m}_prev IS NULL OR {m}_prev = 0 THEN 0.0 "
            f"ELSE ({m}_last - {m}_prev) / {m}_prev * 100.0 END")


_CHANGES = [
    _period("week", "weekly"), _period("month", "monthly"),
    """pm AS (SELECT 'wow' AS unit, period, roas, ctr FROM weekly UNION ALL
             SELECT 'mom' AS unit, period, roas, ctr FROM monthly)""",
    """rk AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY period DESC) AS r FROM pm)""",
    """pu AS (SELECT unit, count(*) FILTER (WHERE r <= 2) AS k,
                  max(roas) FILTER (WHERE r = 1) AS roas_last, max(roas) FILTER (WHERE r = 2) AS roas_prev,
                  max(ctr) FILTER (WHERE r = 1) AS ctr_last, max(ctr) FILTER (WHERE r = 2) AS ctr_prev
           FROM rk GROUP BY unit)""",
    f"""ch AS (SELECT unit, {_chg('roas')} AS roas, {_chg('ctr')} AS ctr FROM pu)""",
    """changes AS (SELECT max(roas) FILTER (WHERE unit = 'wow') AS roas_wow, max(ctr) FILTER (WHERE unit = 'wow') AS ctr_wow,
                        max(roas) FILTER (WHERE unit = 'mom') AS roas_mom, max(ctr) FILTER (WHERE unit = 'mom') AS ctr_mom,
                        count(*) AS n_units FROM ch)""",
    """trends AS (
      SELECT metric, CASE WHEN (abs(w) + abs(m)) / 2.0 > 5.0
                          THEN CASE WHEN w > 0 OR m > 0 THEN 'increasing' ELSE 'decreasing' END
                          ELSE 'stable' END AS direction,
             w AS week_over_week_change, m AS month_over_month_change
      FROM (SELECT 'roas' AS metric, roas_wow AS w, roas_mom AS m, 0 AS o FROM changes WHERE n_units > 0
            UNION ALL SELECT 'ctr', ctr_wow, ctr_mom, 1 FROM changes WHERE n_units > 0))""",
]
TREND_CHANGES = _with(F, *_CHANGES) + "SELECT roas_wow, ctr_wow, roas_mom, ctr_mom FROM changes"
TREND_DIRECTION = _with(F, *_CHANGES) + "SELECT * FROM trends"

_SEG_AGGS = ("sum(spend_cents) AS sc, sum(revenue_cents) AS rc, coalesce(sum(impressions), 0) AS imp, "
             "coalesce(sum(clicks), 0) AS clk, count(ctr) AS ctr_n, avg(ctr) AS ctr_mean, var_samp(ctr) AS ctr_var, "
             "count(roas) AS roas_n, avg(roas) AS roas_mean, var_samp(roas) AS roas_var")
_SEG = ["seg_raw AS (" + " UNION ALL ".join(
    f"SELECT {_q(d)} AS dimension, {o} AS dim_ord, CAST({d} AS VARCHAR) AS value, {_SEG_AGGS} "
    f"FROM ad_facts WHERE {d} IS NOT NULL GROUP BY {d}" for d, o in DIMS) + ")",
    """seg AS (SELECT dimension, dim_ord, value,
                   CAST(coalesce(sc, 0) AS DOUBLE) / 100.0 AS spend, CAST(coalesce(rc, 0) AS DOUBLE) / 100.0 AS revenue,
                   CAST(imp AS BIGINT) AS impressions, CAST(clk AS BIGINT) AS clicks,
                   CAST(ctr_n AS BIGINT) AS ctr_n, ctr_mean, ctr_var, CAST(roas_n AS BIGINT) AS roas_n, roas_mean, roas_var
            FROM seg_raw)""",
    """segx AS (SELECT *, CASE WHEN spend > 0 THEN revenue / spend ELSE 0.0 END AS roas,
                    CASE WHEN impressions > 0 THEN CAST(clicks AS DOUBLE) / CAST(impressions AS DOUBLE) ELSE 0.0 END AS ctr,
                    CASE WHEN dimension = 'creative_type'
                         THEN CASE WHEN impressions > 0 THEN CAST(clicks AS DOUBLE) / CAST(impressions AS DOUBLE) ELSE 0.0 END
                         ELSE CASE WHEN spend > 0 THEN revenue / spend ELSE 0.0 END END AS metric
             FROM seg)"""]


def _segment_by(field: str) -> str:
    return _with(F) + f"""SELECT CAST({field} AS VARCHAR) AS {field}, spend, revenue,
       CASE WHEN spend > 0 THEN revenue / spend ELSE 0.0 END AS roas, impressions, clicks,
       CASE WHEN impressions > 0 THEN CAST(clicks AS DOUBLE) / CAST(impressions AS DOUBLE) ELSE 0.0 END AS ctr
FROM (SELECT {field}, CAST(coalesce(sum(spend_cents), 0) AS DOUBLE) / 100.0 AS spend,
             CAST(coalesce(sum(revenue_cents), 0) AS DOUBLE) / 100.0 AS revenue,
             CAST(coalesce(sum(impressions), 0) AS BIGINT) AS impressions,
             CAST(coalesce(sum(clicks), 0) AS BIGINT) AS clicks
      FROM ad_facts WHERE {field} IS NOT NULL GROUP BY {field})"""


SEGMENTS_ALL = _with(F, *_SEG) + "SELECT dimension, value, spend, revenue, roas, impressions, clicks, ctr FROM segx"

_BW = _SEG + ["""ranked AS (SELECT *,
        row_number() OVER (PARTITION BY dimension ORDER BY metric ASC, spend DESC, value ASC) AS r_worst,
        row_number() OVER (PARTITION BY dimension ORDER BY metric DESC, spend ASC, value DESC) AS r_best,
        count(*) OVER (PARTITION BY dimension) AS n_segments FROM segx)""",
              """bw AS (SELECT w.dimension, CASE WHEN w.dimension = 'creative_type' THEN 'ctr' ELSE 'roas' END AS metric,
                     CAST(w.n_segments AS BIGINT) AS n_segments,
                     w.value AS worst_value, w.metric AS worst_metric, w.spend AS worst_spend,
                     b.value AS best_value, b.metric AS best_metric, b.spend AS best_spend,
                     w.ctr_n AS w_ctr_n, w.ctr_mean AS w_ctr_mean, w.ctr_var AS w_ctr_var,
                     w.roas_n AS w_roas_n, w.roas_mean AS w_roas_mean, w.roas_var AS w_roas_var,
                     b.ctr_n AS b_ctr_n, b.ctr_mean AS b_ctr_mean, b.ctr_var AS b_ctr_var,
                     b.roas_n AS b_roas_n, b.roas_mean AS b_roas_mean, b.roas_var AS b_roas_var
              FROM ranked w JOIN ranked b ON w.dimension = b.dimension AND w.r_worst = 1 AND b.r_best = 1)"""]
BEST_WORST = _with(F, *_BW) + """SELECT dimension, metric, n_segments, worst_value, worst_metric, worst_spend,
       best_value, best_metric, best_spend FROM bw"""


def _under(dim: str, metric: str, factor: float) -> str:
    return _with(F, _TOT, _METRICS, *_SEG) + f"""SELECT value, spend, {metric}, m.overall_{metric}
FROM segx, metrics m WHERE dimension = {_q(dim)} AND {metric} < m.overall_{metric} * {factor}"""


PLATFORM_GAP = _with(F, *_BW) + """SELECT n_segments AS n_platforms, worst_value AS worst_platform, worst_metric AS worst_roas,
       best_value AS best_platform, best_metric AS best_roas,
       (n_segments >= 2 AND best_metric > worst_metric * 1.2) AS gap_flag
FROM bw WHERE dimension = 'platform'"""

SEGMENT_STATS = _with(F, *_SEG) + """SELECT dimension, value, ctr_n, round(ctr_mean, 10) AS ctr_mean, round(ctr_var, 12) AS ctr_var,
       roas_n, round(roas_mean, 10) AS roas_mean, round(roas_var, 10) AS roas_var FROM segx"""

# ------------------------------------------------------------ hypotheses ---


def _conf(mag: str, mx: int) -> str:
    return f"greatest(0.0, least(1.0, 0.3 + least(coalesce({mag}, 0.0) / {float(mx)}, 1.0) * 0.5))"


_HYP_BASE = _BW + [
    _TOT, _METRICS, *_CHANGES[:-1],
    _CHANGES[-1],
    """tr AS (SELECT max(week_over_week_change) FILTER (WHERE metric = 'roas') AS roas_wow,
                  max(month_over_month_change) FILTER (WHERE metric = 'roas') AS roas_mom,
                  max(direction) FILTER (WHERE metric = 'roas') AS roas_dir,
                  max(week_over_week_change) FILTER (WHERE metric = 'ctr') AS ctr_wow,
                  max(month_over_month_change) FILTER (WHERE metric = 'ctr') AS ctr_mom,
                  max(direction) FILTER (WHERE metric = 'ctr') AS ctr_dir,
                  count(*) FILTER (WHERE metric = 'roas') > 0 AS has_roas,
                  count(*) FILTER (WHERE metric = 'ctr') > 0 AS has_ctr FROM trends)""",
    """trz AS (SELECT coalesce(roas_wow, 0.0) AS rw, coalesce(roas_mom, 0.0) AS rm,
                   coalesce(ctr_wow, 0.0) AS cw, coalesce(ctr_mom, 0.0) AS cm, roas_dir, ctr_dir, has_roas, has_ctr FROM tr)""",
    """under AS (SELECT s.*, row_number() OVER (PARTITION BY dimension ORDER BY metric ASC, spend DESC, value ASC) AS r,
                     count(*) OVER (PARTITION BY dimension) AS n_under
              FROM segx s, metrics m
              WHERE (dimension = 'campaign_name' AND roas < m.overall_roas * 0.8)
                 OR (dimension = 'creative_type' AND ctr < m.overall_ctr * 0.8)
                 OR (dimension = 'audience_type' AND roas < m.overall_roas * 0.7))""",
]


def _gens(focus: str = "roas") -> str:
    FM = focus.upper()
    return f"""gens AS (
  SELECT 1 AS ord, 'seasonality' AS category, 'roas' AS subject,
         CASE WHEN rw < -5 OR rm < -5 THEN printf('ROAS declined due to trend (WoW: %.1f%%, MoM: %.1f%%)', rw, rm)
              ELSE printf('ROAS improved due to trend (WoW: %.1f%%, MoM: %.1f%%)', rw, rm) END AS hypothesis_text,
         {_conf('abs(rw) + abs(rm)', 20)} AS confidence_score
  FROM trz WHERE has_roas AND (abs(rw) > 5 OR abs(rm) > 5)
  UNION ALL
  SELECT 2, 'creative', 'ctr',
         CASE WHEN cw < 0 OR cm < 0 THEN printf('CTR decline (WoW: %.1f%%, MoM: %.1f%%) negatively impacted {FM}', cw, cm)
              ELSE printf('CTR improvement (WoW: %.1f%%, MoM: %.1f%%) positively impacted {FM}', cw, cm) END,
         {_conf('abs(cw) + abs(cm)', 20)}
  FROM trz WHERE has_ctr AND (abs(cw) > 5 OR abs(cm) > 5)
  UNION ALL
  SELECT 3, 'budget', u.value,
         printf('Campaign ''%s'' underperformance (ROAS: %.2f) is dragging down overall {FM}', u.value, u.roas),
         {_conf('abs(m.overall_roas - u.roas) / greatest(m.overall_roas, 0.01) * 100', 50)}
  FROM under u, metrics m WHERE u.dimension = 'campaign_name' AND u.r = 1
  UNION ALL
  SELECT 4, 'creative', u.value,
         printf('''%s'' creative type underperforming with CTR of %.4f vs overall %.4f', u.value, u.ctr, m.overall_ctr),
         {_conf('abs(m.overall_ctr - u.ctr) / greatest(m.overall_ctr, 0.0001) * 100', 50)}
  FROM under u, metrics m WHERE u.dimension = 'creative_type' AND u.r = 1
  UNION ALL
  SELECT 5, 'audience', u.value,
         printf('Audience segment ''%s'' showing poor ROAS of %.2f compared to overall %.2f', u.value, u.roas, m.overall_roas),
         {_conf('abs(m.overall_roas - u.roas) / greatest(m.overall_roas, 0.01) * 100', 50)}
  FROM under u, metrics m WHERE u.dimension = 'audience_type' AND u.r = 1
  UNION ALL
  SELECT 6, 'platform', worst_value,
         printf('Platform ''%s'' (ROAS: %.2f) underperforming compared to ''%s'' (ROAS: %.2f)',
                worst_value, worst_metric, best_value, best_metric),
         {_conf('abs(best_metric - worst_metric) / greatest(worst_metric, 0.01) * 100', 50)}
  FROM bw WHERE dimension = 'platform' AND n_segments >= 2 AND best_metric > worst_metric * 1.2)"""


def _hyp(max_h: int = 5, focus: str = "roas") -> list[str]:
    FM = focus.upper()
    return _HYP_BASE + [_gens(focus), f"""kept AS (SELECT * FROM gens QUALIFY row_number() OVER (ORDER BY ord) <= {max_h})""",
                        f"""defaults AS (
  SELECT * FROM (VALUES
    (100, 'seasonality', 'Seasonal factors may be influencing {FM} performance', 0.4, 0),
    (101, 'creative', 'Ad fatigue may be contributing to {FM} changes', 0.35, 1),
    (102, 'budget', 'Market competition changes may be affecting {FM}', 0.3, 2)) AS t(ord, category, hypothesis_text, confidence_score, idx)
  WHERE idx >= (SELECT count(*) FROM kept))""",
                        """hyp AS (SELECT ord, category, subject, hypothesis_text, CAST(confidence_score AS DOUBLE) AS confidence_score FROM kept
             UNION ALL SELECT ord, category, CAST(NULL AS VARCHAR), hypothesis_text, CAST(confidence_score AS DOUBLE) FROM defaults)"""]


HYPOTHESES_NUMERIC = _with(F, *_hyp()) + "SELECT ord, category, subject, confidence_score, hypothesis_text FROM hyp"
HYPOTHESES_PADDED = _with(F, *_hyp(2)) + "SELECT ord, category, subject, confidence_score FROM hyp"

# ------------------------------------------------------------- evidence -----
# Student t tail by Simpson's rule on s = |t| + u/(1-u), u in [0, 1).
_P_N = 4000


def _p_expr(t: str, v: str) -> str:
    h = 1.0 / _P_N
    u = f"(i * {h})"
    dens = (f"exp(lgamma(({v} + 1) / 2.0) - lgamma({v} / 2.0) - 0.5 * ln({v} * pi()) "
            f"- (({v} + 1) / 2.0) * ln(1 + pow(abs({t}) + {u} / (1 - {u}), 2) / {v})) / pow(1 - {u}, 2)")
    term = (f"list_sum(list_transform(range(0, {_P_N} + 1), lambda i: (CASE WHEN i = 0 OR i = {_P_N} THEN 0 "
            f"WHEN i % 2 = 1 THEN 4 ELSE 2 END) * CASE WHEN i = {_P_N} THEN 0.0 ELSE {dens} END))")
    return f"least(1.0, 2 * ({h} / 3.0) * ({term} + ({dens.replace('(i * ', '(0 * ')})))"


def _tt(prefix_metric: str) -> tuple[str, str, str, str, str, str]:
    m = prefix_metric
    n1, m1, v1 = f"CAST(w_{m}_n AS DOUBLE)", f"w_{m}_mean", f"w_{m}_var"
    n2, m2, v2 = f"CAST(b_{m}_n AS DOUBLE)", f"b_{m}_mean", f"b_{m}_var"
    dof = f"({n1} + {n2} - 2)"
    se = f"sqrt((({n1} - 1) * {v1} + ({n2} - 1) * {v2}) / {dof} * (1.0 / {n1} + 1.0 / {n2}))"
    t = f"(({m1} - {m2}) / {se})"
    ci_se = f"sqrt({v1} / {n1} + {v2} / {n2})"
    lo = f"(({m2} - {m1}) - 1.96 * {ci_se})"
    hi = f"(({m2} - {m1}) + 1.96 * {ci_se})"
    tested = f"(n_segments >= 2 AND w_{m}_n >= 10 AND b_{m}_n >= 10)"
    return tested, t, dof, lo, hi, se


_EVID = []
_CATS = [("creative", "creative_type", "ctr", "creative", "creative type", 0.002, True),
         ("audience", "audience_type", "roas", "audience", "audience", 0.5, True),
         ("platform", "platform", "roas", "platform", "platform", 0.3, True),
         ("budget", "campaign_name", "roas", "campaign", "campaign", 0.5, False)]
_PLURAL = {"creative": "creative type segments", "audience": "audience segments",
           "platform": "platform segments", "budget": "campaign segments"}
for cat, dim, met, lab, tl, thr, test in _CATS:
    tested, t, dof, lo, hi, se = _tt(met)
    if not test:
        tested, t, dof, lo, hi = "FALSE", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"
    _EVID.append(f"""SELECT {_q(cat)} AS category,
       CASE WHEN n_segments >= 2 THEN CASE WHEN best_metric - worst_metric > {thr} THEN 'confirmed'
                                           WHEN best_metric - worst_metric < 0 THEN 'rejected' ELSE 'inconclusive' END
            ELSE 'inconclusive' END AS validation_status,
       coalesce({tested}, FALSE) AS has_test,
       CASE WHEN {tested} THEN CASE WHEN {se} = 0 THEN NULL ELSE {t} END END AS t_stat,
       CASE WHEN {tested} THEN {dof} END AS dof,
       CASE WHEN {tested} THEN {lo} END AS ci_lower, CASE WHEN {tested} THEN {hi} END AS ci_upper,
       CASE WHEN n_segments >= 2 THEN {3 if cat == 'budget' else 2} ELSE 2 END AS n_metrics
FROM (SELECT 1) one LEFT JOIN bw ON bw.dimension = {_q(dim)}""")

_EV_CTES = [
    "ev0 AS (" + " UNION ALL ".join(_EVID) + """
   UNION ALL SELECT 'seasonality', CASE WHEN (abs(rw) + abs(rm)) / 2 > 10 THEN 'confirmed'
                                        WHEN (abs(rw) + abs(rm)) / 2 < 3 THEN 'rejected' ELSE 'inconclusive' END,
                    FALSE, NULL, NULL, NULL, NULL, 3 FROM trz
   UNION ALL SELECT 'generic', 'inconclusive', FALSE, NULL, NULL, NULL, NULL, 2)""",
    f"""ev AS (SELECT *, CASE WHEN has_test THEN CASE WHEN t_stat IS NULL THEN NULL
                                                    WHEN isinf(t_stat) THEN 0.0
                                                    ELSE {_p_expr('t_stat', 'dof')} END END AS p_value FROM ev0)""",
]


def _ev_metric_rows() -> str:
    parts = []
    for cat, dim, met, lab, tl, thr, test in _CATS:
        base = f"FROM (SELECT 1) one LEFT JOIN bw ON bw.dimension = {_q(dim)} CROSS JOIN metrics m"
        ov = "overall_ctr" if met == "ctr" else "overall_roas"
        bl = "Overall CTR baseline" if met == "ctr" else "Overall ROAS baseline"
        parts.append(f"""SELECT {_q(cat)} AS category, 0 AS pos, {_q(f'worst_{lab}_{met}')} AS metric_name, worst_metric AS value,
       'Worst performing {tl}: ' || coalesce(worst_value, 'unknown') AS comparison {base} WHERE coalesce(n_segments, 0) >= 2""")
        parts.append(f"""SELECT {_q(cat)}, 1, {_q(f'best_{lab}_{met}')}, best_metric,
       'Best performing {tl}: ' || coalesce(best_value, 'unknown') {base} WHERE coalesce(n_segments, 0) >= 2""")
        if cat == "budget":
            parts.append(f"""SELECT 'budget', 2, 'worst_campaign_spend', worst_spend,
       printf('Spend on worst campaign: $%.2f', worst_spend) {base} WHERE coalesce(n_segments, 0) >= 2""")
        parts.append(f"""SELECT {_q(cat)}, 0, {_q(f'{lab}_segments_count')}, CAST(coalesce(n_segments, 0) AS DOUBLE),
       'Insufficient {_PLURAL[cat]} for comparison' {base} WHERE coalesce(n_segments, 0) < 2""")
        parts.append(f"""SELECT {_q(cat)}, 1, {_q(ov)}, m.{ov}, {_q(bl)} {base} WHERE coalesce(n_segments, 0) < 2""")
    parts.append("""SELECT 'seasonality', 0, 'roas_wow_change', rw, printf('ROAS week-over-week change: %.1f%%', rw) FROM trz
UNION ALL SELECT 'seasonality', 1, 'roas_mom_change', rm, printf('ROAS month-over-month change: %.1f%%', rm) FROM trz
UNION ALL SELECT 'seasonality', 2, 'ctr_wow_change', cw, printf('CTR week-over-week change: %.1f%%', cw) FROM trz
UNION ALL SELECT 'generic', 0, 'overall_roas', overall_roas, 'Overall ROAS' FROM metrics
UNION ALL SELECT 'generic', 1, 'overall_ctr', overall_ctr, 'Overall CTR' FROM metrics""")
    return "evm AS (" + "\nUNION ALL ".join(parts) + ")"


_VALID = _hyp() + _EV_CTES + [_ev_metric_rows(), """val0 AS (
  SELECT h.ord, h.category, h.hypothesis_text, h.confidence_score AS initial_confidence,
         e.category AS ev_category, e.validation_status, e.has_test, e.p_value, e.n_metrics,
         CASE WHEN e.validation_status = 'confirmed' THEN CAST(0.7 AS DOUBLE)
              WHEN e.validation_status = 'rejected' THEN CAST(0.2 AS DOUBLE) ELSE CAST(0.4 AS DOUBLE) END AS base
  FROM hyp h JOIN ev e ON e.category = CASE WHEN h.category IN ('creative', 'audience', 'platform', 'budget', 'seasonality')
                                            THEN h.category ELSE 'generic' END)""",
                              """val1 AS (SELECT *,
    greatest(0.0, least(1.0, CASE WHEN n_metrics < 2 THEN greatest(0.0, b2 - CAST(0.2 AS DOUBLE)) ELSE b2 END))
      AS validation_strength,
    CASE WHEN n_metrics >= 2 AND EXISTS (SELECT 1 FROM evm x WHERE x.category = ev_category
                                         AND contains(lower(x.comparison), 'vs')) THEN CAST(0.8 AS DOUBLE)
         WHEN n_metrics >= 2 THEN CAST(0.6 AS DOUBLE) WHEN n_metrics >= 1 THEN CAST(0.4 AS DOUBLE)
         ELSE CAST(0.2 AS DOUBLE) END AS segmentation_evidence
  FROM (SELECT *, CASE WHEN has_test AND p_value < 0.05 THEN least(CAST(1.0 AS DOUBLE), base + CAST(0.2 AS DOUBLE))
                       WHEN has_test AND p_value < 0.1 THEN least(CAST(1.0 AS DOUBLE), base + CAST(0.1 AS DOUBLE))
                       ELSE base END AS b2 FROM val0))""",
                              """validated AS (SELECT *,
    greatest(0.0, least(1.0, initial_confidence * CAST(0.4 AS DOUBLE) + validation_strength * CAST(0.4 AS DOUBLE)
                             + segmentation_evidence * CAST(0.2 AS DOUBLE)))
      AS adjusted_confidence_score FROM val1)""",
                              """ranked_v AS (SELECT *, row_number() OVER (ORDER BY adjusted_confidence_score DESC, ord ASC) AS rank
                FROM validated)"""]

TTEST_PAIRS = _with(F, *_VALID) + """SELECT category, round(t_stat, 6) AS t_stat, dof, round(ci_lower, 8) AS ci_lower,
       round(ci_upper, 8) AS ci_upper, round(p_value, 6) AS p_value FROM ev WHERE has_test"""
EVIDENCE_METRICS = _with(F, *_VALID) + """SELECT category, CAST(pos AS BIGINT) AS pos, metric_name, round(value, 10) AS value,
       comparison FROM evm"""
VALIDATION_SCORES = _with(F, *_VALID) + """SELECT ord, category, validation_status, has_test,
       round(validation_strength, 10) AS validation_strength, round(segmentation_evidence, 10) AS segmentation_evidence,
       round(adjusted_confidence_score, 10) AS adjusted_confidence_score FROM validated"""
HYPOTHESIS_RANK = _with(F, *_VALID) + "SELECT CAST(rank AS BIGINT) AS rank, ord, category FROM ranked_v"
TOP_INSIGHTS = _with(F, *_VALID) + """SELECT CAST(rank AS BIGINT) AS rank, hypothesis_text AS hypothesis,
       round(adjusted_confidence_score, 10) AS validated_confidence FROM ranked_v WHERE rank <= 3"""
STATUS_COUNTS = _with(F, *_VALID) + """SELECT CAST(count(*) AS BIGINT) AS validated,
       CAST(count(*) FILTER (WHERE validation_status = 'confirmed') AS BIGINT) AS confirmed,
       CAST(count(*) FILTER (WHERE validation_status = 'rejected') AS BIGINT) AS rejected,
       CAST(count(*) FILTER (WHERE validation_status = 'inconclusive') AS BIGINT) AS inconclusive,
       CAST(count(*) FILTER (WHERE has_test) AS BIGINT) AS with_statistical_test,
       CAST(count(*) FILTER (WHERE adjusted_confidence_score >= 0.7) AS BIGINT) AS high_confidence,
       CAST(count(*) FILTER (WHERE adjusted_confidence_score >= 0.5 AND adjusted_confidence_score < 0.7) AS BIGINT) AS medium_confidence,
       CAST(count(*) FILTER (WHERE adjusted_confidence_score < 0.5) AS BIGINT) AS low_confidence
FROM validated"""
# The wording of the bands and of the reasoning.
_INSIGHTS = """SELECT CAST(rank AS BIGINT) AS rank, hypothesis_text,
       round(adjusted_confidence_score, 10) AS adjusted_confidence_score, validation_status,
       round(CASE WHEN has_test THEN p_value END, 6) AS p_value,
       CASE WHEN adjusted_confidence_score >= 0.7 THEN 'high' WHEN adjusted_confidence_score >= 0.5 THEN 'moderate'
            ELSE 'low' END AS evaluation_band,
       CASE WHEN adjusted_confidence_score >= 0.8 THEN 'highly likely and actionable'
            WHEN adjusted_confidence_score >= 0.6 THEN 'moderately valid, requires monitoring'
            ELSE 'low confidence insight' END AS report_band,
       'Hypothesis validation: ' || validation_status || '. '
         || CASE WHEN n_metrics > 0 THEN printf('Analyzed %d metrics. ', n_metrics)
                 || coalesce((SELECT string_agg(x.comparison || '. ', '' ORDER BY x.pos) FROM evm x
                              WHERE x.category = r.ev_category AND x.pos < 2), '') ELSE '' END
         || CASE WHEN has_test THEN 'Statistical test p-value: ' || coalesce(printf('%.4f', p_value), 'nan') || '. '
                 || CASE WHEN p_value < 0.05 THEN 'Result is statistically significant. '
                         ELSE 'Result is not statistically significant. ' END ELSE '' END
         || printf('Adjusted confidence score: %.2f. ', adjusted_confidence_score)
         || CASE WHEN adjusted_confidence_score >= 0.7 THEN 'High confidence in this hypothesis.'
                 WHEN adjusted_confidence_score >= 0.5 THEN 'Moderate confidence in this hypothesis.'
                 ELSE 'Low confidence - requires further investigation.' END AS validation_reasoning"""
REPORT_INSIGHTS = _with(F, *_VALID) + _INSIGHTS + " FROM ranked_v r WHERE rank <= 3"
REPORT_METRICS = _with(F, *_VALID) + """SELECT CAST(r.rank AS BIGINT) AS rank, CAST(e.pos AS BIGINT) AS pos, e.metric_name,
       round(e.value, 10) AS value, e.comparison
FROM ranked_v r JOIN evm e ON e.category = CASE WHEN r.category IN ('creative', 'audience', 'platform', 'budget', 'seasonality')
                                               THEN r.category ELSE 'generic' END
WHERE r.rank <= 3"""

# ------------------------------------------------------------- creatives ----
_MODES = ["""mode_src AS (
  SELECT campaign_name, 'creative_type' AS field, creative_type AS value FROM ad_facts WHERE creative_type IS NOT NULL
  UNION ALL SELECT campaign_name, 'creative_message', creative_message FROM ad_facts WHERE creative_message IS NOT NULL
  UNION ALL SELECT campaign_name, 'audience_type', audience_type FROM ad_facts WHERE audience_type IS NOT NULL)""",
          """mode_cnt AS (SELECT campaign_name, field, value, count(*) AS cnt FROM mode_src GROUP BY ALL)""",
          """mode_pick AS (SELECT * FROM mode_cnt QUALIFY row_number() OVER (PARTITION BY campaign_name, field
                                                                              ORDER BY cnt DESC, value ASC) = 1)""",
          """modes AS (SELECT c.campaign_name,
                   max(value) FILTER (WHERE field = 'creative_type') AS mode_creative_type,
                   max(value) FILTER (WHERE field = 'creative_message') AS mode_creative_message,
                   max(value) FILTER (WHERE field = 'audience_type') AS mode_audience_type
            FROM (SELECT DISTINCT campaign_name FROM ad_facts) c LEFT JOIN mode_pick p ON p.campaign_name = c.campaign_name
            GROUP BY c.campaign_name)"""]
CAMPAIGN_MODES = _with(F, *_MODES) + "SELECT * FROM modes"

_LOW = _SEG + _MODES + ["""low AS (
  SELECT s.value AS campaign, s.ctr AS current_ctr, s.spend, coalesce(m.mode_creative_type, 'unknown') AS current_creative_type,
         coalesce(m.mode_creative_message, '') AS current_message, m.mode_audience_type
  FROM segx s JOIN modes m ON m.campaign_name = s.value
  WHERE s.dimension = 'campaign_name' AND s.ctr < 0.01)"""]
LOW_CTR_CAMPAIGNS = _with(F, *_LOW) + "SELECT campaign, current_ctr, current_creative_type, current_message FROM low"

_P75 = ["""ctrv AS (SELECT ctr AS v FROM ad_facts WHERE ctr IS NOT NULL AND NOT isnan(ctr))""",
        """ordv AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM ctrv)""",
        """pos AS (SELECT count(*) AS n, 0.75 * (count(*) - 1) AS p FROM ctrv)""",
        """p75 AS (SELECT n, CASE WHEN n = 0 THEN NULL
                              WHEN p - floor(p) >= 0.5 THEN b - (b - a) * (1 - (p - floor(p)))
                              ELSE a + (b - a) * (p - floor(p)) END AS q
          FROM (SELECT n, p, (SELECT v FROM ordv WHERE k = floor(pos.p)) AS a,
                             (SELECT v FROM ordv WHERE k = ceil(pos.p)) AS b FROM pos))"""]
CTR_P75 = _with(F, *_P75) + "SELECT CAST(n AS BIGINT) AS ctr_values, q AS ctr_p75 FROM p75"
HIGH_CTR_MESSAGES = _with(F, *_P75) + """SELECT CAST(row_number() OVER (ORDER BY rows DESC, creative_message ASC) AS BIGINT) AS rank,
       creative_message, rows
FROM (SELECT creative_message, CAST(count(*) AS BIGINT) AS rows FROM ad_facts
      WHERE ctr > (SELECT q FROM p75) AND creative_message IS NOT NULL GROUP BY creative_message
      ORDER BY rows DESC, creative_message ASC LIMIT 3)"""

_BEST = ["""best AS (SELECT value AS creative_type, row_number() OVER (ORDER BY ctr DESC, spend DESC, value ASC) AS rank
          FROM segx WHERE dimension = 'creative_type' QUALIFY rank <= 2)"""]
BEST_CREATIVE_TYPES = _with(F, *_SEG, *_BEST) + "SELECT CAST(rank AS BIGINT) AS rank, creative_type FROM best"


def _tag(name: str, mode: str) -> str:
    n = f"lower({name})"
    return f"""CASE WHEN contains({n}, 'female') AND contains({n}, '18') THEN 'female_18_30'
            WHEN contains({n}, 'female') AND (contains({n}, '30') OR contains({n}, '31')) THEN 'female_31_45'
            WHEN contains({n}, 'male') AND contains({n}, '18') THEN 'male_18_24'
            WHEN contains({n}, 'male') AND (contains({n}, '25') OR contains({n}, '30')) THEN 'male_25_40'
            ELSE coalesce({mode}, 'default') END"""


AUDIENCE_TAGS = _with(F, *_MODES) + f"SELECT campaign_name, {_tag('campaign_name', 'mode_audience_type')} AS audience_tag FROM modes"

_TEMPL = """templ(aud, idx, template) AS (VALUES
  ('female_18_30', 0, 'Trendy comfort meets style - {discount}'), ('female_18_30', 1, 'Feel confident all day - {discount}'),
  ('female_18_30', 2, 'Your perfect fit awaits - {discount}'),
  ('female_31_45', 0, 'Premium quality for everyday comfort - {discount}'), ('female_31_45', 1, 'Designed for your lifestyle - {discount}'),
  ('female_31_45', 2, 'Comfort that lasts - {discount}'),
  ('male_18_24', 0, 'Athletic performance meets comfort - {discount}'), ('male_18_24', 1, 'Minimalist design, maximum comfort - {discount}'),
  ('male_18_24', 2, 'Built for your active life - {discount}'),
  ('male_25_40', 0, 'Professional comfort for busy days - {discount}'), ('male_25_40', 1, 'Quality essentials for modern men - {discount}'),
  ('male_25_40', 2, 'Upgrade your basics - {discount}'),
  ('default', 0, 'Premium comfort at great prices - {discount}'), ('default', 1, 'Discover your new favorites - {discount}'),
  ('default', 2, 'Quality you can feel - {discount}'))"""
_DISC = """disc(idx, discount) AS (VALUES (0, '20% off'), (1, 'Buy 1 Get 1'), (2, '30% off first order'), (3, 'Free shipping'))"""
_STD = """std(o, t) AS (VALUES (0, 'image'), (1, 'video'), (2, 'carousel'), (3, 'collection'))"""

_CANDS = _LOW + _BEST + [_TEMPL, _DISC, _STD, """seed AS (
  SELECT o, t FROM (SELECT rank AS o, creative_type AS t FROM best)
  UNION ALL SELECT o, t FROM (VALUES (1, 'video'), (2, 'carousel'), (3, 'image')) v(o, t) WHERE NOT EXISTS (SELECT 1 FROM best))""",
                         f"""cand0 AS (
  SELECT l.campaign, 0 AS src, s.o, s.t FROM low l, seed s WHERE s.t IS DISTINCT FROM l.current_creative_type
  UNION ALL SELECT l.campaign, 1, d.o, d.t FROM low l, std d WHERE d.t IS DISTINCT FROM l.current_creative_type)""",
                         """cand AS (SELECT campaign, t AS candidate_type, row_number() OVER (PARTITION BY campaign ORDER BY fs, fo) - 1 AS pos
          FROM (SELECT campaign, t, min(src) AS fs, arg_min(o, src * 100 + o) AS fo FROM cand0 GROUP BY campaign, t))""",
                         """ncand AS (SELECT campaign, count(*) AS nc, greatest(3, least(4, count(*))) AS n_variations FROM cand GROUP BY campaign)"""]
CREATIVE_CANDIDATES = _with(F, *_CANDS) + """SELECT c.campaign, CAST(n.n_variations AS BIGINT) AS n_variations,
       CAST(c.pos AS BIGINT) AS pos, c.candidate_type FROM cand c JOIN ncand n USING (campaign)"""

_VARS = _CANDS + [f"""var0 AS (
  SELECT l.campaign, i.i, c.candidate_type AS creative_type, l.current_ctr, l.current_creative_type,
         {_tag('l.campaign', 'l.mode_audience_type')} AS audience_type
  FROM low l JOIN ncand n ON n.campaign = l.campaign
  CROSS JOIN LATERAL (SELECT unnest(range(0, n.n_variations)) AS i) i
  JOIN cand c ON c.campaign = l.campaign AND c.pos = i.i % n.nc)""",
                  """var1 AS (
  SELECT v.*, replace(t.template, '{discount}', d.discount) AS creative_message, s.ctr AS type_ctr,
         (SELECT rank FROM best b WHERE b.creative_type = v.creative_type) AS best_pos
  FROM var0 v
  JOIN templ t ON t.aud = CASE WHEN v.audience_type IN ('female_18_30', 'female_31_45', 'male_18_24', 'male_25_40')
                              THEN v.audience_type ELSE 'default' END AND t.idx = v.i % 3
  JOIN disc d ON d.idx = v.i % 4
  LEFT JOIN segx s ON s.dimension = 'creative_type' AND s.value = v.creative_type)""",
                  """var2 AS (SELECT *,
    greatest(10.0, least(100.0, (coalesce(type_ctr, current_ctr * 1.5) - current_ctr) / greatest(current_ctr, 0.001) * 100)) AS imp,
    CAST(0.6 AS DOUBLE) + CASE WHEN best_pos = 1 THEN CAST(0.2 AS DOUBLE) WHEN best_pos = 2 THEN CAST(0.1 AS DOUBLE)
                               ELSE CAST(0.0 AS DOUBLE) END
        + CASE WHEN type_ctr IS NOT NULL AND type_ctr > current_ctr * 1.5 THEN CAST(0.1 AS DOUBLE)
               ELSE CAST(0.0 AS DOUBLE) END AS conf
  FROM var1)""",
                  """variations AS (SELECT *, concat_ws(', ',
      CASE WHEN creative_type IS DISTINCT FROM current_creative_type
           THEN 'Switching from ' || coalesce(current_creative_type, 'None') || ' to ' || creative_type || ' format' END,
      CASE WHEN best_pos IS NOT NULL THEN creative_type || ' is among top-performing creative types' END,
      CASE WHEN audience_type <> 'default' THEN 'tailored for ' || audience_type || ' audience' END,
      printf('expected to improve CTR by %.0f%%', imp)) AS parts FROM var2)"""]
CREATIVE_VARIATIONS = _with(F, *_VARS) + """SELECT campaign, CAST(i AS BIGINT) AS i, creative_type, creative_message, audience_type,
       round(greatest(0.0, least(1.0, conf)), 10) AS confidence_score, round(imp, 10) AS expected_ctr_improvement,
       upper(substr(parts, 1, 1)) || substr(parts, 2) || '.' AS rationale
FROM variations"""
RECOMMENDATION_SUMMARY = _with(F, *_VARS) + """SELECT CAST((SELECT count(*) FROM low) AS BIGINT) AS low_ctr_campaigns,
       round((SELECT avg(current_ctr) FROM low), 10) AS avg_low_ctr,
       CAST((SELECT count(*) FROM variations) AS BIGINT) AS total_variations,
       round((SELECT CASE WHEN count(DISTINCT campaign) > 0 THEN count(*) / count(DISTINCT campaign) END FROM variations), 10)
         AS avg_variations_per_campaign,
       round((SELECT avg(greatest(0.0, least(1.0, conf))) FROM variations), 10) AS avg_confidence"""
REPORT_RECOMMENDATIONS = _with(F, *_VARS) + """SELECT campaign, CAST(i + 1 AS BIGINT) AS variation, creative_type, creative_message,
       audience_type, round(imp, 10) AS expected_ctr_improvement,
       round(greatest(0.0, least(1.0, conf)), 10) AS confidence_score FROM variations"""

# --------------------------------------------------------------- requests ---


def _any(words) -> str:
    return "(" + " OR ".join(f"contains(lower(text), {_q(w)})" for w in words) + ")"


_INTENT = (f"CASE WHEN {_any(['roas', 'return on ad spend', 'roi'])} THEN 'roas_analysis' "
           f"WHEN {_any(['creative', 'ad copy', 'recommendation'])} THEN 'creative_generation' ELSE 'full_analysis' END")
REQUEST_INTENT = f"SELECT conv_id, turn, {_INTENT} AS intent FROM conversations"
REQUEST_FOCUS = f"""SELECT conv_id, turn, CASE WHEN {_any(['ctr', 'click'])} THEN 'ctr' WHEN {_any(['roas'])} THEN 'roas'
       WHEN {_any(['conversion', 'cvr'])} THEN 'cvr' END AS focus_metric FROM conversations"""
REQUEST_WORKFLOW = f"""SELECT conv_id, turn, CASE {_INTENT} WHEN 'roas_analysis' THEN 'analysis'
       WHEN 'creative_generation' THEN 'creative_generation' ELSE 'full' END AS workflow_type FROM conversations"""
REQUEST_VALIDITY = "SELECT conv_id, turn, coalesce(length(trim(text)) >= 5, FALSE) AS valid FROM conversations"
_PH = [(7, ["last 7 days", "past 7 days", "last week"]), (14, ["last 14 days", "past 14 days", "last 2 weeks"]),
       (30, ["last 30 days", "past 30 days", "last month"])]
REQUEST_PERIOD = f"""SELECT conv_id, turn,
  CASE {' '.join(f"WHEN {_any(p)} THEN CAST(DATE '{AS_OF}' - INTERVAL {d} DAY AS DATE)" for d, p in _PH)}
       WHEN len(ds) >= 2 THEN CAST(try_strptime(ds[1], '%Y-%m-%d') AS DATE)
       WHEN len(ds) = 1 THEN CAST(CAST(try_strptime(ds[1], '%Y-%m-%d') AS DATE) - INTERVAL 7 DAY AS DATE) END AS date_from,
  CASE {' '.join(f"WHEN {_any(p)} THEN DATE '{AS_OF}'" for d, p in _PH)}
       WHEN len(ds) >= 2 THEN CAST(try_strptime(ds[2], '%Y-%m-%d') AS DATE)
       WHEN len(ds) = 1 THEN CAST(try_strptime(ds[1], '%Y-%m-%d') AS DATE) END AS date_to
FROM (SELECT *, regexp_extract_all(lower(text), '\\d{{4}}-\\d{{2}}-\\d{{2}}') AS ds FROM conversations)"""

# -------------------------------------------------------------- requests ----
_REQUEST_ROWS = """(SELECT conv_id, turn, text FROM conversations UNION ALL
  SELECT -c_custkey - 1, 0, [
    'Analyze ROAS for last 7 days', 'Why did click rates fall in the PAST 14 days?',
    'Generate creative recommendations for last month',
    'Show conversion from ' || strftime(DATE '1996-01-01' + (c_custkey % 700)::INTEGER, '%Y-%m-%d') || ' to '
      || strftime(DATE '1996-03-01' + (c_custkey % 700)::INTEGER, '%Y-%m-%d'),
    'How was the return on ad spend on ' || strftime(DATE '1996-01-01' + (c_custkey % 700)::INTEGER, '%Y-%m-%d'),
    '', chr(9) || chr(10) || chr(9) || chr(10) || chr(9), ' help ', chr(160) || chr(8195) || 'ab' || chr(12288),
    'Ad copy ideas, CVR dropping since 1997-13-45', 'ab' || chr(10) || chr(10) || chr(10), 'last 2 weeks: ROI and CTR',
    NULL, chr(31) || 'hello' || chr(133)][(c_custkey % 14 + 1)::INTEGER] FROM customer)"""
REQUEST_INTENT, REQUEST_FOCUS, REQUEST_WORKFLOW, REQUEST_PERIOD = (
    q.replace("FROM conversations", f"FROM {_REQUEST_ROWS}")
    for q in (REQUEST_INTENT, REQUEST_FOCUS, REQUEST_WORKFLOW, REQUEST_PERIOD))
# Unicode white space, spelled out: what stands at both ends does not count
_ENDS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || chr(133)" \
    " || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198)" \
    " || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
REQUEST_VALIDITY = f"SELECT conv_id, turn, coalesce(length(trim(text, {_ENDS})) >= 5, FALSE) AS valid FROM {_REQUEST_ROWS}"


def _request_run(where: str, recs: bool, max_h: int = 6, lenient: bool = False, focus: str = "roas") -> str:
    """The insights of an analysis whose facts are cut to ``where``; ``lenient`` takes the moments from all facts."""
    cut = F.replace("FROM fact_base\n)", f"FROM fact_base WHERE {where}\n)")
    assert cut != F
    valid = _hyp(max_h, focus) + _VALID[len(_hyp()):]
    ctes = [*valid, *[c for c in _VARS if c not in _VALID]] if recs else valid
    if lenient:
        cut += ",\nall_facts AS (SELECT * FROM (" + F[F.index("ad_facts AS (") + len("ad_facts AS ("):].rstrip().rstrip(")") + "))"
        every = _SEG[0].replace("seg_raw AS", "seg_all AS").replace("FROM ad_facts", "FROM all_facts")
        moments = ", ".join(f"a.{m}_{x}" for m in ("ctr", "roas") for x in ("n", "mean", "var"))
        ctes = [every, *[c.replace("FROM seg_raw)", f"FROM (SELECT s.dimension, s.dim_ord, s.value, s.sc, s.rc, s.imp, s.clk, "
                                                    f"{moments} FROM seg_raw s LEFT JOIN seg_all a USING (dimension, value)))")
                         for c in ctes]]
    n = "(SELECT CAST(count(*) AS BIGINT) FROM low)" if recs else "CAST(NULL AS BIGINT)"
    return _with(cut, *ctes) + _INSIGHTS + ("" if lenient else f", {n} AS recommendation_sets") + " FROM ranked_v r"


_WEEK = f"date >= DATE '{AS_OF}' - INTERVAL 7 DAY AND date <= DATE '{AS_OF}'"
REQUEST_RUN_ANALYSIS = _request_run(_WEEK, recs=False)
REQUEST_RUN_CREATIVE = _request_run("date >= DATE '1997-03-01' AND date <= DATE '1997-03-03'", recs=True)
REQUEST_RUN_FULL = _request_run("date >= DATE '1996-04-28' AND date <= DATE '1996-05-05'", recs=True)
REQUEST_RUN_SUMMER = _request_run("date >= DATE '1995-06-14' AND date <= DATE '1995-08-23'", recs=True, focus="ctr")
REQUEST_RUN_BEFORE = _request_run("date >= DATE '1994-01-01' AND date <= DATE '1994-03-12'", recs=True)
REQUEST_RUN_LENIENT = _request_run(_WEEK, recs=False, max_h=5, lenient=True)
HYPOTHESES_SIX = _with(F, *_hyp(6)) + "SELECT ord, category, subject, confidence_score, hypothesis_text FROM hyp"

# each rule over the customers' numbers, from the places where the stand-in tables put defects
_K = "c_custkey"
_DEFECTS = [
    ("summary", "required_fields", f"{_K} % 11 = 0 OR {_K} % 13 = 0"),
    ("summary", "non_negative_counts", f"{_K} % 7 = 1 OR {_K} % 5 = 2"),
    ("trends", "direction_enum", f"{_K} % 9 IN (0, 1)"),
    ("trends", "finite_changes", f"{_K} % 10 = 3"),
    ("hypotheses", "required_fields", f"{_K} % 6 = 0 OR {_K} % 9 = 3"),
    ("hypotheses", "category_enum", f"{_K} % 8 = 1"),
    ("hypotheses", "confidence_range", f"{_K} % 9 IN (2, 3)"),
    ("hypotheses", "min_count", "false"),
    ("validated", "required_fields", f"{_K} % 10 = 0"),
    ("validated", "status_enum", f"{_K} % 7 = 0"),
    ("validated", "confidence_range", f"{_K} % 11 = 3"),
    ("validated", "min_metrics", f"{_K} % 10 IN (0, 1)"),
    ("validated", "metric_fields", f"{_K} % 12 = 1 AND {_K} % 10 <> 0"),
    ("validated", "p_value_range", f"{_K} % 13 = 1"),
    ("validated", "finite_statistics", f"{_K} % 12 = 2 AND {_K} % 10 NOT IN (0, 1)"),
    ("validated", "interval_pair", f"{_K} % 2 = 0 AND {_K} % 14 = 2"),
    ("recommendations", "required_fields", f"{_K} % 16 = 0 OR {_K} % 17 = 0"),
    ("recommendations", "min_variations", f"{_K} % 17 IN (0, 1)"),
    ("recommendations", "confidence_range", f"{_K} % 15 = 4 AND {_K} % 17 <> 0"),
    ("recommendations", "non_empty_fields", f"{_K} % 15 IN (1, 2, 3) AND {_K} % 17 <> 0"),
    ("metrics", "required_fields", None), ("metrics", "finite_metrics", None),
    ("outputs", "iso_timestamp", f"{_K} % 5 IN (2, 3)"),
]
CONTRACT_DEFECTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{r}' AS rule, " + ("CAST(max(1) AS BIGINT)" if w is None else f"CAST(count(*) FILTER (WHERE {w}) AS BIGINT)")
    + " AS violations FROM customer" for t, r, w in _DEFECTS)

# ----------------------------------------------------------------- report ---
REPORT_SUMMARY = _with(F, *_VALID, *[c for c in _VARS if c not in _VALID]) + """SELECT
  (SELECT min(date) FROM ad_facts) AS start_date, (SELECT max(date) FROM ad_facts) AS end_date,
  (SELECT CAST(count(*) AS BIGINT) FROM ad_facts) AS total_rows,
  (SELECT CAST(coalesce(sum(spend_cents), 0) AS DOUBLE) / 100.0 FROM ad_facts) AS total_spend,
  (SELECT CAST(coalesce(sum(revenue_cents), 0) AS DOUBLE) / 100.0 FROM ad_facts) AS total_revenue,
  (SELECT CAST(count(*) AS BIGINT) FROM validated) AS validated_hypotheses,
  (SELECT CAST(count(*) AS BIGINT) FROM low) AS recommendation_sets,
  (SELECT hypothesis_text FROM ranked_v WHERE rank = 1) AS top_insight,
  (SELECT round(adjusted_confidence_score, 10) FROM ranked_v WHERE rank = 1) AS top_confidence"""

WEEKLY_MEAN_CTR = _with(F) + """SELECT CAST(date_trunc('week', date) AS DATE) AS period, round(avg(ctr), 10) AS mean_ctr
FROM ad_facts GROUP BY 1"""
SEGMENT_COUNTS = _with(F, *_SEG) + "SELECT dimension, CAST(count(*) AS BIGINT) AS segments FROM segx GROUP BY dimension"
HYPOTHESIS_CATEGORIES = _with(F, *_hyp()) + "SELECT DISTINCT category FROM hyp"
TOP_HYPOTHESIS = _with(F, *_hyp()) + """SELECT hypothesis_text, round(confidence_score, 10) AS confidence_score
FROM hyp ORDER BY confidence_score DESC, ord ASC LIMIT 1"""
VALIDATED_HYPOTHESES = _with(F, *_VALID) + """SELECT sha256(concat_ws('~', CAST(ord AS VARCHAR), category, hypothesis_text))
         AS hypothesis_id, ord, category, round(initial_confidence, 10) AS confidence_score,
       round(adjusted_confidence_score, 10) AS adjusted_confidence_score, validation_status,
       CAST(rank AS BIGINT) AS rank FROM ranked_v"""
REPORT_COUNTS = _with(F, *_VALID, *[c for c in _VARS if c not in _VALID]) + """SELECT
  (SELECT CAST(count(*) AS BIGINT) FROM validated) AS validated_hypotheses,
  (SELECT CAST(count(*) AS BIGINT) FROM low) AS recommendation_sets,
  (SELECT hypothesis_text FROM ranked_v WHERE rank = 1) AS top_hypothesis"""

CONTRACT_VIOLATIONS = _with(F, *_VALID, *[c for c in _VARS if c not in _VALID], """summ AS (
  SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(coalesce(sum(spend_cents), 0) AS DOUBLE) / 100.0 AS total_spend,
         CAST(coalesce(sum(revenue_cents), 0) AS DOUBLE) / 100.0 AS total_revenue,
         CAST(count(DISTINCT campaign_name) AS BIGINT) AS campaigns_count, CAST(0 AS BIGINT) AS invalid_rows,
         min(date) AS start_date, max(date) AS end_date
  FROM ad_facts)""", """nmet AS (SELECT category, count(*) AS n FROM evm GROUP BY category)""",
  """vfull AS (SELECT v.*, e.t_stat, e.ci_lower, e.ci_upper, coalesce(m.n, 0) AS n_metrics_rows,
                   EXISTS (SELECT 1 FROM evm x WHERE x.category = v.ev_category AND (isnan(x.value) OR isinf(x.value)))
                     AS bad_metric
            FROM validated v JOIN ev e ON e.category = v.ev_category LEFT JOIN nmet m ON m.category = v.ev_category)""",
  """recs AS (SELECT campaign, count(*) AS n,
                  count(*) FILTER (WHERE NOT coalesce(greatest(0.0, least(1.0, conf)) BETWEEN 0 AND 1, FALSE)) AS bad_conf,
                  count(*) FILTER (WHERE coalesce(length(creative_message) = 0 OR length(upper(substr(parts, 1, 1))
                                                      || substr(parts, 2) || '.') = 0, TRUE)) AS empty_fields
           FROM variations GROUP BY campaign)""") + """
SELECT 'summary' AS table_name, 'required_fields' AS rule,
       CAST(count(*) FILTER (WHERE total_rows IS NULL OR start_date IS NULL OR end_date IS NULL
                                   OR campaigns_count IS NULL) AS BIGINT) AS violations FROM summ
UNION ALL SELECT 'summary', 'non_negative_counts',
       CAST(count(*) FILTER (WHERE total_rows < 0 OR campaigns_count < 0 OR invalid_rows < 0) AS BIGINT) FROM summ
UNION ALL SELECT 'trends', 'direction_enum',
       CAST(count(*) FILTER (WHERE NOT coalesce(direction IN ('increasing', 'decreasing', 'stable'), FALSE)) AS BIGINT) FROM trends
UNION ALL SELECT 'trends', 'finite_changes',
       CAST(count(*) FILTER (WHERE coalesce(isnan(week_over_week_change) OR isinf(week_over_week_change), FALSE)
                                OR coalesce(isnan(month_over_month_change) OR isinf(month_over_month_change), FALSE)) AS BIGINT)
       FROM trends
UNION ALL SELECT 'hypotheses', 'required_fields',
       CAST(count(*) FILTER (WHERE hypothesis_text IS NULL OR category IS NULL OR confidence_score IS NULL) AS BIGINT) FROM hyp
UNION ALL SELECT 'hypotheses', 'category_enum',
       CAST(count(*) FILTER (WHERE NOT coalesce(category IN ('creative', 'audience', 'platform', 'budget', 'seasonality'),
                                                FALSE)) AS BIGINT) FROM hyp
UNION ALL SELECT 'hypotheses', 'confidence_range',
       CAST(count(*) FILTER (WHERE NOT coalesce(confidence_score BETWEEN 0 AND 1, FALSE)) AS BIGINT) FROM hyp
UNION ALL SELECT 'hypotheses', 'min_count', CAST(CASE WHEN count(*) < 3 THEN 1 ELSE 0 END AS BIGINT) FROM hyp
UNION ALL SELECT 'validated', 'required_fields',
       CAST(count(*) FILTER (WHERE validation_status IS NULL OR adjusted_confidence_score IS NULL) AS BIGINT) FROM vfull
UNION ALL SELECT 'validated', 'status_enum',
       CAST(count(*) FILTER (WHERE NOT coalesce(validation_status IN ('confirmed', 'rejected', 'inconclusive'), FALSE))
            AS BIGINT) FROM vfull
UNION ALL SELECT 'validated', 'confidence_range',
       CAST(count(*) FILTER (WHERE NOT coalesce(adjusted_confidence_score BETWEEN 0 AND 1, FALSE)) AS BIGINT) FROM vfull
UNION ALL SELECT 'validated', 'min_metrics', CAST(count(*) FILTER (WHERE n_metrics_rows < 2) AS BIGINT) FROM vfull
UNION ALL SELECT 'validated', 'metric_fields', CAST(count(DISTINCT v.category) AS BIGINT)
       FROM vfull v JOIN evm x ON x.category = v.ev_category WHERE x.metric_name IS NULL OR x.value IS NULL
UNION ALL SELECT 'metrics', 'required_fields',
       CAST(count(*) FILTER (WHERE overall_roas IS NULL OR overall_ctr IS NULL OR avg_cpc IS NULL OR conversion_rate IS NULL) AS BIGINT)
       FROM metrics
UNION ALL SELECT 'metrics', 'finite_metrics',
       CAST(count(*) FILTER (WHERE isinf(overall_roas + overall_ctr + avg_cpc + conversion_rate)
                                OR isnan(overall_roas + overall_ctr + avg_cpc + conversion_rate)) AS BIGINT) FROM metrics
UNION ALL SELECT 'validated', 'p_value_range',
       CAST(count(*) FILTER (WHERE p_value IS NOT NULL AND NOT p_value BETWEEN 0 AND 1) AS BIGINT) FROM vfull
UNION ALL SELECT 'validated', 'finite_statistics',
       CAST(count(*) FILTER (WHERE coalesce(isnan(p_value) OR isinf(p_value), FALSE)
                                OR coalesce(isnan(ci_lower) OR isinf(ci_lower), FALSE)
                                OR coalesce(isnan(ci_upper) OR isinf(ci_upper), FALSE) OR bad_metric) AS BIGINT) FROM vfull
UNION ALL SELECT 'validated', 'interval_pair',
       CAST(count(*) FILTER (WHERE has_test AND (ci_lower IS NULL OR ci_upper IS NULL)) AS BIGINT) FROM vfull
UNION ALL SELECT 'recommendations', 'required_fields', CAST(count(*) FILTER (WHERE campaign IS NULL) AS BIGINT) FROM recs
UNION ALL SELECT 'recommendations', 'min_variations', CAST(count(*) FILTER (WHERE n < 3) AS BIGINT) FROM recs
UNION ALL SELECT 'recommendations', 'confidence_range', CAST(count(*) FILTER (WHERE bad_conf > 0) AS BIGINT) FROM recs
UNION ALL SELECT 'recommendations', 'non_empty_fields', CAST(count(*) FILTER (WHERE empty_fields > 0) AS BIGINT) FROM recs"""

_NARR_EXTRA = ["""narr_in AS (
  SELECT 'insight' AS step,
    'Analyzing data to understand ROAS performance changes. '
      || printf('Current overall ROAS: %.2f. ', (SELECT overall_roas FROM metrics))
      || CASE WHEN EXISTS (SELECT 1 FROM trends) THEN 'Trend data available for analysis. ' ELSE '' END
      || printf('Segmentation data available across %d dimensions. ', (SELECT count(DISTINCT dimension) FROM segx)) AS think,
    'Data pattern analysis:' || chr(10)
      || coalesce((SELECT string_agg(printf('- %s trend: %s (WoW: %.1f%%, MoM: %.1f%%)', upper(metric), direction,
                                            week_over_week_change, month_over_month_change) || chr(10), ''
                                     ORDER BY CASE WHEN metric = 'roas' THEN 0 ELSE 1 END) FROM trends), '')
      || coalesce((SELECT string_agg(printf('- %s: %d segments identified',
                                            CASE dimension WHEN 'campaign_name' THEN 'by_campaign'
                                                           WHEN 'creative_type' THEN 'by_creative_type'
                                                           WHEN 'audience_type' THEN 'by_audience_type'
                                                           ELSE 'by_platform' END, n) || chr(10), '' ORDER BY o)
                   FROM (SELECT dimension, count(*) AS n, min(dim_ord) AS o FROM segx GROUP BY dimension)), '')
      || printf(chr(10) || 'Generated %d hypotheses across categories: ', (SELECT count(*) FROM hyp))
      || coalesce((SELECT string_agg(category, ', ' ORDER BY category) FROM (SELECT DISTINCT category FROM hyp)), '')
      AS analyze,
    printf('Generated %d testable hypotheses to explain ROAS performance. ', (SELECT count(*) FROM hyp))
      || coalesce((SELECT printf('Top hypothesis (confidence: %.2f): ', confidence_score) || hypothesis_text || '. '
                   FROM hyp ORDER BY confidence_score DESC, ord ASC LIMIT 1), '')
      || 'These hypotheses require validation through the Evaluator Agent using quantitative metrics. '
      || 'Each hypothesis includes a validation approach for testing.' AS conclude)""",
    """narr_ev AS (
  SELECT 'evaluation' AS step,
    printf('Validating %d hypotheses using quantitative metrics and statistical analysis. ', (SELECT count(*) FROM hyp))
      || 'Each hypothesis will be tested against dataset segments and compared for statistical significance. '
      || 'Confidence scores will be adjusted based on validation strength and segmentation evidence.' AS think,
    printf('Validation analysis:' || chr(10) || '- Confirmed hypotheses: %d' || chr(10) || '- Rejected hypotheses: %d'
           || chr(10) || '- Inconclusive hypotheses: %d' || chr(10)
           || '- Hypotheses with statistical significance tests: %d' || chr(10) || '- High confidence (≥0.7): %d'
           || chr(10) || '- Medium confidence (0.5-0.7): %d' || chr(10) || '- Low confidence (<0.5): %d',
           count(*) FILTER (WHERE validation_status = 'confirmed'), count(*) FILTER (WHERE validation_status = 'rejected'),
           count(*) FILTER (WHERE validation_status = 'inconclusive'), count(*) FILTER (WHERE has_test),
           count(*) FILTER (WHERE adjusted_confidence_score >= 0.7),
           count(*) FILTER (WHERE adjusted_confidence_score >= 0.5 AND adjusted_confidence_score < 0.7),
           count(*) FILTER (WHERE adjusted_confidence_score < 0.5)) AS analyze,
    printf('Validation complete for %d hypotheses. ', count(*))
      || coalesce((SELECT printf('Top hypothesis (confidence: %.2f): ', adjusted_confidence_score) || hypothesis_text
                          || '. Status: ' || validation_status || '. ' FROM ranked_v WHERE rank = 1), '')
      || printf('Generated %d top insights for reporting. ', least(count(*), 3))
      || 'Hypotheses ranked by adjusted confidence score using weighted formula: '
      || '(InsightConfidence * 0.4) + (ValidationStrength * 0.4) + (SegmentationEvidence * 0.2).' AS conclude
  FROM validated)""",
    """narr_cr AS (
  SELECT 'creative' AS step,
    printf('Analyzing campaigns to identify those with CTR below %.4f. ', 0.01)
      || printf('Found %d campaigns requiring creative optimization. ', (SELECT count(*) FROM low))
      || 'Will generate creative variations based on high-performing creative attributes and audience targeting.'
      AS think,
    'Creative performance analysis:' || chr(10)
      || CASE WHEN (SELECT count(*) FROM low) > 0 THEN
           printf('- Average CTR of low-performing campaigns: %.4f', (SELECT avg(current_ctr) FROM low)) || chr(10)
           || printf('- Campaigns identified: %d', (SELECT count(*) FROM low)) || chr(10)
           || coalesce((SELECT string_agg(printf('  * %s: CTR %.4f', campaign, current_ctr) || chr(10), ''
                                          ORDER BY spend DESC, campaign ASC)
                        FROM (SELECT * FROM low ORDER BY spend DESC, campaign ASC LIMIT 3)), '')
           || CASE WHEN (SELECT count(*) FROM low) > 3
                   THEN printf('  * ... and %d more', (SELECT count(*) FROM low) - 3) || chr(10) ELSE '' END
         ELSE '- No campaigns found below CTR threshold' || chr(10) END
      || printf(chr(10) || 'Generated %d creative variations ', (SELECT count(*) FROM variations))
      || printf('across %d campaigns.', (SELECT count(*) FROM low)) AS analyze,
    printf('Generated creative recommendations for %d low-CTR campaigns. ', (SELECT count(*) FROM low))
      || CASE WHEN (SELECT count(*) FROM low) > 0 THEN
           printf('Each campaign received %.1f creative variations on average. ',
                  (SELECT count(*) / count(DISTINCT campaign) FROM variations))
           || printf('Average confidence score: %.2f. ',
                     (SELECT avg(greatest(0.0, least(1.0, conf))) FROM variations)) ELSE '' END
      || 'Recommendations include creative type, message, audience targeting, and expected CTR improvement.' AS conclude)"""]
NARRATIVES = _with(F, *_VALID, *[c for c in _VARS if c not in _VALID], *_NARR_EXTRA) + """SELECT * FROM narr_in
UNION ALL SELECT * FROM narr_ev UNION ALL SELECT * FROM narr_cr"""

SEGMENTS = {
    "campaign_name": _segment_by("campaign_name"), "creative_type": _segment_by("creative_type"),
    "audience_type": _segment_by("audience_type"), "platform": _segment_by("platform"),
}

# ------------------------------------------------------- files and outputs ---
_CSV_COLS = [c for c in RAW_COLS if c != "row_ord"]
_QUOTED = RAW_SQL.strip().replace("raw_ad_rows AS (", "raw_plain AS (") + """,
raw_ad_rows AS (SELECT * REPLACE (CASE WHEN row_ord % 7 = 0 THEN creative_message || ' says "' || platform || '",' || chr(10) || country
                                       ELSE creative_message END AS creative_message) FROM raw_plain)"""
CSV_SCAN = _with(_QUOTED, _RAWN, _FLAGS, _CLEAN) + f"SELECT {', '.join(_CSV_COLS)} FROM clean"
_SHORT = RAW_SQL.strip().replace("raw_ad_rows AS (", "raw_plain AS (") + """,
raw_ad_rows AS (SELECT * REPLACE (CASE WHEN row_ord % 5 = 1 THEN NULL ELSE platform END AS platform,
                                  CASE WHEN row_ord % 5 = 1 THEN NULL ELSE country END AS country) FROM raw_plain WHERE row_ord % 5 <> 0)"""
CSV_LENIENT = _with(_SHORT, _RAWN) + "SELECT " + ", ".join(
    "CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date" if c == "date"
    else (f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in RAW_NUMERIC else c) for c in _CSV_COLS) + " FROM raw_n"
LOAD_COUNTS = _with(*CLEAN_CTES, _PROFILE) + "SELECT *, clean_rows AS written_rows FROM profile"
MISSING_SHARE_GATE = _with(*CLEAN_CTES, _PROFILE, "share AS (" + " UNION ALL ".join(
    f"SELECT {_q(c)} AS field, missing_{c} / raw_rows AS share FROM profile" for c in REQUIRED_FIELDS) + ")",
    "lim(share_limit) AS (VALUES (CAST(0.1 AS DOUBLE)), (CAST(0.01 AS DOUBLE)))") + """
SELECT share_limit, 'stopped' AS outcome, field, round(share, 10) AS share FROM lim JOIN share ON share > share_limit
UNION ALL SELECT share_limit, 'loaded', NULL, NULL FROM lim WHERE NOT EXISTS (SELECT 1 FROM share WHERE share > share_limit)"""
VIEW_RELOAD = _with(*CLEAN_CTES, _PROFILE, "issues AS (" + " UNION ALL ".join(
    f"SELECT CAST({o} AS BIGINT) AS ord, {_q(t)} AS issue_type, "
    f"{'CAST(NULL AS VARCHAR)' if f is None else _q(f)} AS field, {col} AS count, {_q(a)} AS action FROM profile"
    for o, t, f, col, a in _ISSUE_ROWS) + ")") + """SELECT i.*,
       CAST(CASE WHEN issue_type = 'missing_values' THEN 0 ELSE least(count, 5) END AS BIGINT) AS n_examples,
       (SELECT clean_rows FROM profile) AS clean_rows, TRUE AS reused FROM issues i WHERE count > 0"""
_META = "'Analyze ROAS' AS query, 'ad_facts' AS dataset, '2025-01-01T00:00:00Z' AS timestamp"
INSIGHTS_PUBLISHED = _with(F, *_VALID) + f"""SELECT sha256(concat_ws('~', CAST(ord AS VARCHAR), category, hypothesis_text)) AS hypothesis_id,
       hypothesis_text, validation_status, CAST(rank AS BIGINT) AS rank, round(adjusted_confidence_score, 10) AS adjusted_confidence_score,
       CAST(n_metrics AS BIGINT) AS n_metrics, rank <= 3 AS is_top, {_META} FROM ranked_v"""
RECOMMENDATIONS_PUBLISHED = REPORT_RECOMMENDATIONS.replace(
    " FROM variations", f", {_META}, CAST(0.01 AS DOUBLE) AS low_ctr_threshold FROM variations")

_FOUR = F.replace("ad_facts AS (", "ad_facts_plain AS (") + """,
ad_facts AS (SELECT * REPLACE (CASE WHEN starts_with(campaign_name, 'Brand#1') THEN NULL WHEN starts_with(campaign_name, 'Brand#2') THEN 'story'
                                    ELSE creative_type END AS creative_type) FROM ad_facts_plain)"""
CREATIVE_VARIATIONS_FOUR = CREATIVE_VARIATIONS.replace(F, _FOUR)

_CELL = """[ '', '  ', chr(8203), chr(9) || chr(160) || chr(8195), ' ' || chr(7) || ' ', chr(8232) || 'x' || chr(160) || 'y ',
  'a' || chr(8203) || 'b' || chr(1), chr(65279) || 'ok' || chr(12288), NULL, ' ' || c_name || chr(10), c_name ]"""
_WHITE = r"[\x09-\x0D\x1C-\x1F\x20\x{85}\pZ]"


def _printable(c: str) -> str:
    ends = f"regexp_replace({c}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"
    spaces = r"\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
    return f"regexp_replace({ends}, '[\\pC\\p{{Zl}}\\p{{Zp}}{spaces}]', '', 'g')".replace("\\\\", "\\")


REPORT_METRICS_CELLS = f"""SELECT * FROM (SELECT c_custkey AS rank, i AS pos, {_printable('metric')} AS metric_name,
         CAST(c_custkey + i AS DOUBLE) AS value, {_printable('cmp')} AS comparison
  FROM (SELECT c_custkey, i, ({_CELL})[(c_custkey * (i + 1) + i) % 11 + 1] AS metric, ({_CELL})[(c_custkey + 3 * i) % 11 + 1] AS cmp
        FROM customer, (SELECT unnest(range(0, 3)) AS i)))
WHERE metric_name <> '' AND comparison <> ''"""

SEASONALITY = _with(F, """daily AS (SELECT date, sum(spend_cents) / 100.0 AS spend, sum(revenue_cents) / 100.0 AS revenue,
           sum(impressions) AS impressions, sum(clicks) AS clicks FROM ad_facts WHERE date IS NOT NULL GROUP BY date)""",
                    """series AS (SELECT 'roas' AS metric, date, revenue / nullif(spend, 0) AS value FROM daily
  UNION ALL SELECT 'ctr', date, clicks / nullif(impressions, 0) FROM daily)""",
                    """days AS (SELECT metric, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM series GROUP BY metric)""",
                    """steps AS (SELECT d.metric, d.date, s.date IS NULL AS gap, s.value - lag(s.value) OVER (PARTITION BY d.metric ORDER BY d.date) AS d
  FROM days d LEFT JOIN series s ON s.metric = d.metric AND s.date = d.date)""",
                    "centred AS (SELECT metric, date, gap, d - avg(d) OVER (PARTITION BY metric) AS x FROM steps)",
                    """own AS (SELECT metric, count(*) AS days, count(*) FILTER (gap) AS gaps, count(x) AS changes, sum(x * x) AS own
  FROM centred GROUP BY metric)""",
                    """auto AS (SELECT a.metric, k.lag, sum(a.x * b.x) / any_value(o.own) AS r
  FROM centred a, (SELECT unnest(range(2, 29)) AS lag) k, centred b, own o
  WHERE b.metric = a.metric AND b.date = a.date - CAST(k.lag AS INTEGER) AND o.metric = a.metric GROUP BY a.metric, k.lag)""",
                    "best AS (SELECT * FROM auto QUALIFY row_number() OVER (PARTITION BY metric ORDER BY r DESC, lag) = 1)") + """
SELECT o.metric, CAST(days AS BIGINT) AS days, CAST(gaps AS BIGINT) AS gaps, CAST(lag AS BIGINT) AS lag, round(r, 8) AS autocorrelation,
       r >= 0.3 AND r > 3.0 / sqrt(changes) AS seasonal FROM own o JOIN best b ON b.metric = o.metric"""

PERIOD_SKETCHES = _with(F) + """SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(DISTINCT campaign_name) AS BIGINT) AS campaigns, CAST(count(ctr) AS BIGINT) AS values, TRUE AS q75_in_bounds
FROM ad_facts WHERE date IS NOT NULL GROUP BY 1 HAVING count(ctr) > 0"""

ORACLE = {
    "load_counts": LOAD_COUNTS, "missing_share_gate": MISSING_SHARE_GATE, "csv_scan": CSV_SCAN, "csv_lenient": CSV_LENIENT,
    "view_reload": VIEW_RELOAD, "insights_published": INSIGHTS_PUBLISHED, "recommendations_published": RECOMMENDATIONS_PUBLISHED,
    "report_metrics_cells": REPORT_METRICS_CELLS, "creative_variations_four": CREATIVE_VARIATIONS_FOUR,
    "seasonality": SEASONALITY, "period_sketches": PERIOD_SKETCHES,
    "scan_clean": SCAN_CLEAN, "lenient_scan": LENIENT_SCAN, "missing_profile": MISSING_PROFILE, "date_failures": DATE_FAILURES,
    "numeric_failures": NUMERIC_FAILURES, "column_missing": COLUMN_MISSING, "quality_issues": QUALITY_ISSUES,
    "invalid_rows": INVALID_ROWS, "date_range_filter": DATE_RANGE_FILTER, "last_n_days": LAST_N_DAYS,
    "dataset_summary": DATASET_SUMMARY, "overall_metrics": OVERALL_METRICS, "weekly_metrics": WEEKLY_METRICS,
    "monthly_metrics": MONTHLY_METRICS, "trend_changes": TREND_CHANGES, "trend_direction": TREND_DIRECTION,
    "segments_campaign": SEGMENTS["campaign_name"], "segments_creative": SEGMENTS["creative_type"],
    "segments_audience": SEGMENTS["audience_type"], "segments_platform": SEGMENTS["platform"],
    "segments_all": SEGMENTS_ALL, "best_worst_segments": BEST_WORST,
    "underperforming_campaigns": _under("campaign_name", "roas", 0.8),
    "low_ctr_creatives": _under("creative_type", "ctr", 0.8),
    "low_roas_audiences": _under("audience_type", "roas", 0.7),
    "platform_gap": PLATFORM_GAP, "hypotheses_numeric": HYPOTHESES_NUMERIC, "hypotheses_padded": HYPOTHESES_PADDED,
    "segment_stats": SEGMENT_STATS, "ttest_pairs": TTEST_PAIRS, "evidence_metrics": EVIDENCE_METRICS,
    "validation_scores": VALIDATION_SCORES, "hypothesis_rank": HYPOTHESIS_RANK, "top_insights": TOP_INSIGHTS,
    "status_counts": STATUS_COUNTS, "low_ctr_campaigns": LOW_CTR_CAMPAIGNS, "campaign_modes": CAMPAIGN_MODES,
    "ctr_p75": CTR_P75, "high_ctr_messages": HIGH_CTR_MESSAGES, "best_creative_types": BEST_CREATIVE_TYPES,
    "audience_tags": AUDIENCE_TAGS, "creative_candidates": CREATIVE_CANDIDATES,
    "creative_variations": CREATIVE_VARIATIONS, "recommendation_summary": RECOMMENDATION_SUMMARY,
    "request_intent": REQUEST_INTENT, "request_focus": REQUEST_FOCUS, "request_period": REQUEST_PERIOD,
    "request_workflow": REQUEST_WORKFLOW, "request_validity": REQUEST_VALIDITY,
    "report_summary": REPORT_SUMMARY, "report_insights": REPORT_INSIGHTS, "report_metrics": REPORT_METRICS,
    "report_recommendations": REPORT_RECOMMENDATIONS,
    "json_round_trip": SEGMENTS_ALL,
    "weekly_mean_ctr": WEEKLY_MEAN_CTR, "segment_counts": SEGMENT_COUNTS,
    "hypothesis_categories": HYPOTHESIS_CATEGORIES, "top_hypothesis": TOP_HYPOTHESIS,
    "validated_hypotheses": VALIDATED_HYPOTHESES, "report_counts": REPORT_COUNTS,
    "contract_violations": CONTRACT_VIOLATIONS, "narratives": NARRATIVES,
    "contract_defects": CONTRACT_DEFECTS, "hypotheses_six": HYPOTHESES_SIX,
    "request_run_analysis": REQUEST_RUN_ANALYSIS, "request_run_creative": REQUEST_RUN_CREATIVE,
    "request_run_summer": REQUEST_RUN_SUMMER, "request_run_before": REQUEST_RUN_BEFORE,
    "request_run_full": REQUEST_RUN_FULL, "request_run_lenient": REQUEST_RUN_LENIENT,
}
