"""News and market tables derived from the driver's parquet tables.

Each block is plain SQL over the given tables and over earlier blocks. The text is
the same for Spark and for the check engine; only the way to name a base table and
to turn a list into rows differs, so those two are filled in per dialect.
"""

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

BLOCKS = {
    "fx_calendar": """
SELECT DISTINCT CAST(ts AS DATE) AS trading_date FROM {events}
WHERE extract(day FROM ts) NOT IN (1, 6, 7, 13, 14, 15, 20, 21, 27, 28)""",
    "fx_issuers": "SELECT DISTINCT user_id AS permno FROM {events}",
    "fx_daily": """
SELECT u.permno, c.trading_date AS date,
  CASE WHEN (u.permno + u.dom) % 19 = 0 THEN NULL
       ELSE ((u.permno * 31 + u.dom * 17) % 41 - 20) / CAST(1000 AS DOUBLE) END AS ret,
  CAST(10 + (u.permno * 7 + u.dom) % 90 AS DOUBLE) * (CASE WHEN u.permno % 4 = 0 THEN -1 ELSE 1 END) AS prc,
  CAST(100 + u.permno % 13 AS DOUBLE) AS shrout
FROM (SELECT permno, {rows(1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16,17,18,19,20,21,22,23,24,25,26,27,28,29,30,31)} AS dom
      FROM fx_issuers) u
JOIN (SELECT trading_date, CAST(extract(day FROM trading_date) AS INT) AS dom FROM fx_calendar) c ON c.dom = u.dom""",
    "fx_headlines": """
SELECT CAST((event_id * 3 - (event_id * 3) % 4) / 4 AS BIGINT) AS rp_story_id,
  ts AS timestamp_utc, user_id AS permno, user_id + 1000000 AS rp_entity_id,
  CASE WHEN event_id % 17 = 0 THEN NULL
       WHEN event_id % 13 = 0 THEN '  ' || substr(event_type, 1, 4) || ' '
       ELSE event_type END AS headline,
  CAST(event_id % 101 AS INT) AS relevance,
  CASE WHEN event_id % 10 = 9 THEN 'PERS' ELSE 'COMP' END AS entity_type,
  CASE WHEN event_id % 8 = 7 THEN 'CA' ELSE 'US' END AS country_code,
  CAST(event_id % 3 AS INT) AS provider_id,
  CAST((event_id - event_id % 6) / 6 AS BIGINT) AS provider_story_id,
  value AS event_sentiment_score
FROM {events}""",
    "fx_dse": """
SELECT permno, CASE WHEN permno % 23 = 0 THEN NULL ELSE lpad(CAST(permno AS STRING), 8, '0') END AS ncusip
FROM fx_issuers""",
    "fx_rp_company_names": """
SELECT permno + 1000000 AS rp_entity_id,
  CASE WHEN permno % 29 = 0 THEN NULL
       WHEN permno % 31 = 0 THEN 'US' || lpad(CAST(permno AS STRING), 8, '0')
       ELSE 'US' || lpad(CAST(permno AS STRING), 8, '0') || '5' END AS isin
FROM fx_issuers
UNION
SELECT permno + 1000000, CASE WHEN permno % 10 = 3 THEN 'US' || lpad(CAST(permno + 1 AS STRING), 8, '0') || '7' ELSE NULL END
FROM fx_issuers""",
    "fx_sec_hist": """
SELECT permno, DATE '2024-01-01' AS secinfostartdt, DATE '2024-01-12' AS secinfoenddt,
  'EQTY' AS securitytype, 'COM' AS securitysubtype,
  CASE WHEN permno % 6 = 0 THEN 'AD' ELSE 'NS' END AS sharetype, 'Y' AS usincflg
FROM fx_issuers
UNION ALL
SELECT permno, DATE '2024-01-13', DATE '2024-12-31', 'EQTY', 'COM', 'NS',
  CASE WHEN permno % 7 = 0 THEN 'N' ELSE 'Y' END
FROM fx_issuers""",
    "fx_spells": """
SELECT permno, CASE WHEN permno % 5 = 0 THEN NULL ELSE CAST(10 + 5 * (permno % 11) AS STRING) END AS gsector,
  DATE '2024-01-01' AS effstartdt, DATE '2024-01-16' AS effenddt
FROM fx_issuers
UNION ALL
SELECT permno, CASE WHEN permno % 5 = 0 THEN NULL ELSE CAST(10 + 5 * ((permno + 3) % 11) AS STRING) END,
  DATE '2024-01-16', DATE '2024-12-31'
FROM fx_issuers""",
    "fx_membership": """
SELECT permno, DATE '2024-01-02' AS mbrstartdt,
  CASE WHEN permno % 3 = 0 THEN DATE '2024-01-20' ELSE DATE '2024-12-31' END AS mbrenddt
FROM fx_issuers""",
    "fx_stocknames": """
SELECT DISTINCT user_id AS permno,
  CASE WHEN user_id % 9 = 0 THEN event_type || ' Group, Ltd.'
       ELSE event_type || ' & CO ' || CAST(user_id % 9 AS STRING) || ', Holdings Inc.' END AS comnam,
  upper(substr(event_type, 1, 3)) AS ticker,
  CASE WHEN event_type = 'error' THEN DATE '2024-01-15' ELSE DATE '2023-06-01' END AS namedt,
  CASE WHEN event_type = 'click' THEN DATE '2024-01-01' ELSE DATE '2025-12-31' END AS nameenddt
FROM {events}""",
    "fx_ccm": """
SELECT permno AS lpermno, 'G' || CAST(permno AS STRING) AS gvkey,
  CASE WHEN permno % 5 = 0 THEN 'NU' WHEN permno % 2 = 0 THEN 'LC' ELSE 'LU' END AS linktype,
  CASE WHEN permno % 3 = 0 THEN 'C' ELSE 'P' END AS linkprim,
  DATE '2020-01-01' AS linkdt,
  CASE WHEN permno % 4 = 0 THEN DATE '2024-01-10' ELSE NULL END AS linkenddt
FROM fx_issuers""",
    "fx_hgic": """
SELECT 'G' || CAST(permno AS STRING) AS gvkey, CAST(10 + 5 * (permno % 11) AS STRING) AS gsector,
  DATE '2019-01-01' AS indfrom, DATE '2024-01-15' AS indthru
FROM fx_issuers
UNION ALL
SELECT 'G' || CAST(permno AS STRING), CAST(10 + 5 * ((permno + 3) % 11) AS STRING),
  DATE '2024-01-16', CAST(NULL AS DATE)
FROM fx_issuers""",
    "fx_predictions": """
SELECT DISTINCT rp_story_id, 2024 AS oos_year, ((rp_story_id * 37) % 101) / CAST(100 AS DOUBLE) AS p_up
FROM fx_headlines WHERE relevance >= 15""",
    "fx_etf": """
SELECT CASE k WHEN 10 THEN 'XLE' WHEN 15 THEN 'XLB' WHEN 20 THEN 'XLI' WHEN 25 THEN 'XLY' WHEN 30 THEN 'XLP'
    WHEN 35 THEN 'XLV' WHEN 40 THEN 'XLF' WHEN 45 THEN 'XLK' WHEN 50 THEN 'XLC' WHEN 55 THEN 'XLU' ELSE 'XLRE' END AS ticker,
  date, CAST(40 + (k * 7 + extract(day FROM date) * 3) % 20 AS DOUBLE) AS adj_close
FROM (SELECT trading_date AS date, {rows(10,15,20,25,30,35,40,45,50,55,60)} AS k FROM fx_calendar) t
WHERE NOT (k = 60 AND extract(day FROM date) < 10)""",
    "fx_index": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
  ((extract(year FROM o_orderdate) * 372 + extract(month FROM o_orderdate) * 31 + extract(day FROM o_orderdate)) * 17 % 41 - 20)
    / CAST(1000 AS DOUBLE) AS vwretd
FROM {orders}""",
    "fx_macro": """
SELECT CASE k WHEN 3 THEN 'IORB' WHEN 2 THEN 'IOER' WHEN 5 THEN 'TREAST' WHEN 7 THEN 'WALCL' ELSE 'OBFR' END AS series_id, date,
  CASE WHEN extract(day FROM date) % k = 0 THEN CAST(1000 * k + extract(day FROM date) AS DOUBLE) ELSE NULL END AS value
FROM (SELECT date, {rows(3,2,5,7,4)} AS k FROM fx_index) t""",
    "fx_labeled": """
SELECT o.o_orderkey AS rp_story_id, o.o_custkey AS permno, CAST(o.o_orderdate AS DATE) AS article_date,
  e.vec_id, o.o_totalprice AS market_cap, CASE WHEN e.label >= 5 THEN 1 ELSE 0 END AS label
FROM (SELECT *, o_orderkey % n AS vec FROM {orders} JOIN (SELECT count(*) AS n FROM {embeddings}) s ON n > 0) o
JOIN {embeddings} e ON e.vec_id = o.vec""",
    "fx_forecasts": """
SELECT permno, date, ((permno * 13 + extract(day FROM date) * 5) % 97) / CAST(97 AS DOUBLE) AS score, ret
FROM fx_daily""",
    "fx_tokens": """
SELECT CAST((vec_id - vec_id % 4) / 4 AS BIGINT) AS text_id, CAST(vec_id % 4 AS INT) AS pos,
  CASE WHEN vec_id % 7 = 0 OR vec_id % 4 = 3 THEN 0 ELSE 1 END AS attention_mask, embedding
FROM {embeddings}""",
}


def _needed(text: str, found: list[str] | None = None) -> list[str]:
    found = [] if found is None else found
    for name in re.findall(r"\bfx_\w+", text):
        if name in BLOCKS and name not in found:
            _needed(BLOCKS[name], found)
            found.append(name)
    return found


def with_fixtures(text: str, table, rows) -> str:
    """Put the blocks that ``text`` uses in front of it and fill in one dialect."""
    blocks = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in _needed(text))
    if blocks:
        head = text.lstrip()
        opening = re.match(r"WITH (RECURSIVE )?", head, re.I)
        text = f"{opening[0]}{blocks},\n{head[opening.end():]}" if opening else f"WITH {blocks}\n{text}"
    text = re.sub(r"\{rows\((.*?)\)\}", lambda m: rows(m.group(1)), text)
    return re.sub(r"\{(" + "|".join(BASE_TABLES) + r")\}", lambda m: table(m.group(1)), text)


def check_sql(text: str) -> str:
    """The text for the check engine, where the base tables are views."""
    return with_fixtures(text, lambda name: name, lambda items: f"unnest([{items}])")


def derive(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A base table or a derived table of one data folder."""
    if name in BASE_TABLES:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    return spark.sql(
        with_fixtures(
            f"SELECT * FROM {name}",
            lambda base: f"parquet.`{folder}/{base}.parquet`",
            lambda items: f"explode(array({items}))",
        )
    )
