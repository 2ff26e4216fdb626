"""Registry of queries and of the SQL that checks them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsalpha.fixtures import check_sql, derive
from newsalpha.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of one data folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), str(folder)
        self.known: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self.known:
            self.known[name] = derive(self.spark, self.folder, name)
        return self.known[name]


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its own name, with its check where there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = check_sql(sql)
        return build

    return register


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round double columns, so that two engines can be compared."""
    return df.select(*(
        F.round(c, special.get(c, digits)).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes
    ))


# Pieces of check SQL that several queries share.
DAILY = """daily AS (
  SELECT permno, date, ret, prc, shrout * 1000 AS shrout, abs(prc) * (shrout * 1000) AS market_cap FROM fx_daily)"""

DATED = """local_news AS (
  SELECT *, timezone('America/New_York', timezone('UTC', timestamp_utc)) AS local_ts FROM fx_headlines),
next_days AS (
  SELECT d.day, min(c.trading_date) AS next_day
  FROM (SELECT DISTINCT CAST(local_ts AS DATE) AS day FROM local_news) d
  JOIN fx_calendar c ON c.trading_date > d.day GROUP BY d.day),
dated AS (
  SELECT n.* EXCLUDE (local_ts),
    CASE WHEN CAST(local_ts AS TIME) >= TIME '09:00:00' AND CAST(local_ts AS TIME) < TIME '09:30:00'
         THEN coalesce(x.next_day, CAST(local_ts AS DATE)) ELSE CAST(local_ts AS DATE) END AS article_date
  FROM local_news n LEFT JOIN next_days x ON x.day = CAST(local_ts AS DATE))"""

CLEAN = f"""{DAILY},
{DATED},
single_rows AS (
  SELECT * FROM dated WHERE permno IS NOT NULL AND rp_story_id IN
    (SELECT rp_story_id FROM dated WHERE permno IS NOT NULL GROUP BY 1 HAVING count(DISTINCT permno) = 1)),
priced_rows AS (
  SELECT s.* FROM single_rows s
  WHERE EXISTS (SELECT 1 FROM daily d WHERE d.permno = s.permno AND d.date = s.article_date AND d.ret IS NOT NULL)),
long_rows AS (SELECT * FROM priced_rows WHERE length(trim(headline)) >= 5),
clean AS (
  SELECT * FROM long_rows
  QUALIFY row_number() OVER (PARTITION BY permno, article_date, headline ORDER BY timestamp_utc, rp_story_id) = 1)"""

WINDOWS = """ret_windows AS (
  SELECT permno, date, (1 + a) * (1 + ret) * (1 + b) - 1 AS ret_window
  FROM (SELECT permno, date, ret, lag(ret) OVER w AS a, lead(ret) OVER w AS b FROM daily
        WINDOW w AS (PARTITION BY permno ORDER BY date)) x
  WHERE a IS NOT NULL AND ret IS NOT NULL AND b IS NOT NULL)"""

LABELED = f"""{CLEAN},
{WINDOWS},
labeled AS (
  SELECT c.rp_story_id, c.permno, c.article_date, c.headline, w.ret_window, d.market_cap,
    CASE WHEN w.ret_window > 0 THEN 1 ELSE 0 END AS label
  FROM clean c
  JOIN ret_windows w ON w.permno = c.permno AND w.date = c.article_date
  LEFT JOIN daily d ON d.permno = c.permno AND d.date = c.article_date)"""

NAMES = """sector_names(gsector, sector_name) AS (VALUES
  ('10', 'Energy'), ('15', 'Materials'), ('20', 'Industrials'), ('25', 'Consumer Discretionary'),
  ('30', 'Consumer Staples'), ('35', 'Health Care'), ('40', 'Financials'), ('45', 'Information Technology'),
  ('50', 'Communication Services'), ('55', 'Utilities'), ('60', 'Real Estate'))"""

FUNDS = """sector_funds(gsector, ticker) AS (VALUES
  ('10', 'XLE'), ('15', 'XLB'), ('20', 'XLI'), ('25', 'XLY'), ('30', 'XLP'), ('35', 'XLV'),
  ('40', 'XLF'), ('45', 'XLK'), ('50', 'XLC'), ('55', 'XLU'), ('60', 'XLRE'))"""

SECTORED = f"""{LABELED},
{NAMES},
sectored AS (
  SELECT l.*, s.gsector, n.sector_name
  FROM labeled l
  JOIN (SELECT p.permno, p.article_date, f.gsector
        FROM (SELECT DISTINCT permno, article_date FROM labeled) p
        JOIN fx_spells f ON f.permno = p.permno AND p.article_date BETWEEN f.effstartdt AND f.effenddt
        WHERE f.gsector IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY p.permno, p.article_date ORDER BY f.effstartdt DESC, f.gsector) = 1) s
    ON s.permno = l.permno AND s.article_date = l.article_date
  LEFT JOIN sector_names n ON n.gsector = s.gsector)"""

DAILY_SECTORS = """daily_sectors AS (
  SELECT d.permno, d.date, d.ret, d.market_cap, f.gsector
  FROM daily d JOIN fx_spells f ON f.permno = d.permno AND d.date BETWEEN f.effstartdt AND f.effenddt
  WHERE f.gsector IS NOT NULL AND d.ret IS NOT NULL AND d.market_cap > 0
  QUALIFY row_number() OVER (PARTITION BY d.permno, d.date ORDER BY f.effstartdt DESC, f.gsector) = 1),
synthetic AS (
  SELECT gsector, date, sum(ret * market_cap) / sum(market_cap) AS synthetic_ret FROM daily_sectors GROUP BY gsector, date)"""

FUND_RETURNS = """fund_returns AS (
  SELECT ticker, date, adj_close, adj_close / lag(adj_close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM fx_etf)"""

SCORED = f"""{SECTORED},
scored AS (
  SELECT s.rp_story_id, s.permno, s.article_date, s.market_cap, s.gsector, p.p_up - 0.5 AS sentiment_score
  FROM sectored s JOIN fx_predictions p ON p.rp_story_id = s.rp_story_id),
sentiment AS (
  SELECT gsector, article_date AS date, sum(sentiment_score * market_cap) / sum(market_cap) AS sentiment, count(*) AS n_headlines
  FROM scored WHERE market_cap > 0 GROUP BY gsector, article_date)"""

PANEL = f"""{SCORED},
{DAILY_SECTORS},
{FUNDS},
{FUND_RETURNS},
panel AS (
  SELECT s.gsector, n.sector_name, s.date, s.n_headlines, s.sentiment, y.synthetic_ret, r.ret AS etf_ret
  FROM sentiment s
  JOIN synthetic y ON y.gsector = s.gsector AND y.date = s.date
  LEFT JOIN sector_names n ON n.gsector = s.gsector
  LEFT JOIN sector_funds f ON f.gsector = s.gsector
  LEFT JOIN fund_returns r ON r.ticker = f.ticker AND r.date = s.date)"""
