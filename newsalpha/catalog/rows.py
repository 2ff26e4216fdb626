"""Queries over filters, derived columns and scalar functions."""

from pyspark.sql import functions as F

from newsalpha.catalog.base import DAILY, NAMES, query, rounded
from newsalpha.constants import NAME_SUFFIXES
from newsalpha.functions import dates, numbers, text, vectors
from newsalpha.operators import filters, linking, macro, sectors, statistics
from newsalpha.operators.labels import assign_binary_label
from newsalpha.operators.panel import sentiment_score
from newsalpha.plans.macro import macro_table

NEWS_COLUMNS = ["rp_story_id", "permno", "headline", "relevance"]
NEWS_TEST = "entity_type = 'COMP' AND country_code = 'US' AND relevance >= 90"
START, END = "2024-01-03 00:00:00", "2024-01-25 00:00:00"


@query(f"""
SELECT rp_story_id, permno, headline, relevance FROM fx_headlines
WHERE {NEWS_TEST} AND timestamp_utc BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'""")
def filter_us_company_relevant(t):
    return filters.filter_us_company_relevant(t("fx_headlines"), START, END).select(NEWS_COLUMNS)


@query(f"""
SELECT rp_story_id, permno, headline, relevance FROM fx_headlines
WHERE {NEWS_TEST} AND headline IS NOT NULL AND timestamp_utc BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'""")
def filter_scraped(t):
    return filters.filter_scraped(t("fx_headlines"), START, END).select(NEWS_COLUMNS)


@query("SELECT rp_story_id, permno, headline FROM fx_headlines WHERE length(trim(headline)) >= 5")
def filter_headline_length(t):
    return filters.filter_headline_length(t("fx_headlines")).select("rp_story_id", "permno", "headline")


@query("""
SELECT rp_story_id, permno, article_date, label FROM fx_labeled
WHERE article_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""")
def date_split(t):
    return filters.date_split(t("fx_labeled"), "1996-01-01", "1998-12-31").select(
        "rp_story_id", "permno", "article_date", "label"
    )


@query("""
SELECT permno, secinfostartdt, secinfoenddt, 'new' AS layout FROM fx_sec_hist
WHERE securitytype = 'EQTY' AND securitysubtype = 'COM' AND sharetype = 'NS' AND usincflg = 'Y'
UNION ALL
SELECT permno, secinfostartdt, secinfoenddt, 'old' FROM fx_sec_hist WHERE sharetype = 'NS'""")
def filter_common_stock(t):
    history = t("fx_sec_hist")
    columns = ["permno", "secinfostartdt", "secinfoenddt"]
    coded = history.withColumn("shrcd", F.when(F.col("sharetype") == "NS", 11).otherwise(31))
    new = filters.filter_common_stock(history).select(*columns, F.lit("new").alias("layout"))
    return new.unionByName(filters.filter_common_stock(coded).select(*columns, F.lit("old").alias("layout")))


@query("""
SELECT permno, secinfostartdt, CASE WHEN usincflg = 'N' THEN 'FUND' ELSE securitytype END AS securitytype
FROM fx_sec_hist WHERE usincflg <> 'N'""")
def filter_equity(t):
    """Some histories count as funds, so that there is something to leave out."""
    kinds = F.when(F.col("usincflg") == "N", "FUND").otherwise(F.col("securitytype"))
    return filters.filter_equity(t("fx_sec_hist").withColumn("securitytype", kinds)).select("permno", "secinfostartdt", "securitytype")


@query("SELECT permno, date, ret FROM fx_daily WHERE ret IS NOT NULL")
def drop_null_keys(t):
    return filters.drop_null_keys(t("fx_daily"), "permno", "ret").select("permno", "date", "ret")


@query(f"WITH {DAILY} SELECT permno, date, shrout, market_cap FROM daily")
def daily_market_cap(t):
    return filters.daily_market_cap(t("fx_daily")).select("permno", "date", "shrout", "market_cap")


@query("""
SELECT permno, date, ret, round(altprc, 6) AS altprc, adj_shrout, round(adj_prc, 6) AS adj_prc,
  round(adj_prc * adj_shrout, 3) AS market_cap
FROM (SELECT permno, date, ret, abs(prc) AS altprc, shrout * 1000 * (1 + permno % 3) AS adj_shrout,
        abs(prc) / CAST(1 + permno % 3 AS DOUBLE) AS adj_prc FROM fx_daily) x""")
def monthly_adjusted_cap(t):
    factor = (1 + F.col("permno") % 3).cast("double")
    pulled = t("fx_daily").select(
        "permno", F.col("date").alias("mthcaldt"), F.col("ret").alias("mthret"), F.col("prc").alias("mthprc"),
        "shrout", factor.alias("mthcumfacshr"), factor.alias("mthcumfacpr"),
    )
    adjusted = filters.monthly_adjusted_cap(pulled)
    return rounded(
        adjusted.select("permno", "date", "ret", "altprc", "adj_shrout", "adj_prc", "market_cap"), market_cap=3
    )


@query("""
SELECT permno, date, CASE WHEN ret > 0 THEN 1 WHEN ret <= 0 THEN 0 ELSE NULL END AS label FROM fx_daily""",
       name="assign_binary_label")
def assign_binary_label_query(t):
    rows = t("fx_daily").select("permno", "date", F.col("ret").alias("ret_window"))
    return assign_binary_label(rows).select("permno", "date", F.col("label").cast("int").alias("label"))


@query("SELECT rp_story_id, round(p_up - 0.5, 6) AS sentiment_score FROM fx_predictions", name="sentiment_score")
def sentiment_score_query(t):
    return rounded(sentiment_score(t("fx_predictions")).select("rp_story_id", "sentiment_score"))


@query("SELECT rp_story_id, rp_entity_id, permno, headline, event_sentiment_score, relevance FROM fx_headlines")
def project_available(t):
    return filters.project_available(t("fx_headlines")).drop("timestamp_utc")


@query("SELECT permno, date, ret FROM fx_daily")
def drop_columns(t):
    return t("fx_daily").drop("prc", "shrout", "not_there")


@query("""
SELECT CAST(date_trunc('month', date) AS DATE) AS date, round(sum(ln(1 + vwretd)) * 100, 6) AS market_return FROM fx_index
WHERE CAST(date_trunc('month', date) AS DATE) BETWEEN DATE '1996-03-01' AND DATE '2000-06-01' GROUP BY 1""")
def slice_months(t):
    months = macro.monthly_market(t("fx_index")).select("date", "market_return")
    return rounded(filters.slice_months(months, "1996-03", "2000-06"))


@query("""
SELECT event_id, CAST(local_ts AS DATE) AS local_date, CAST(hour(local_ts) AS INT) AS local_hour,
  CAST(minute(local_ts) AS INT) AS local_minute
FROM (SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS local_ts FROM {events}) x""")
def utc_to_eastern(t):
    local = dates.utc_to_eastern(F.col("ts"))
    return t("events").select(
        "event_id", F.to_date(local).alias("local_date"), F.hour(local).alias("local_hour"),
        F.minute(local).alias("local_minute"),
    )


@query("""
SELECT event_id, CAST(ts AS DATE) AS day, CAST(year(ts) AS INT) AS year, CAST(hour(ts) AS INT) AS hour,
  CAST(minute(ts) AS INT) AS minute, CAST(date_trunc('month', ts) AS DATE) AS month
FROM {events}""")
def date_parts(t):
    ts = F.col("ts")
    return t("events").select(
        "event_id", F.to_date(ts).alias("day"), F.year(ts).alias("year"), F.hour(ts).alias("hour"),
        F.minute(ts).alias("minute"), dates.month_start(F.to_date(ts)).alias("month"),
    )


@query("""
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM {orders}),
steps AS (
  SELECT day, CAST(k AS INT) AS k, CAST(day + CAST(k AS INT) AS DATE) AS moved
  FROM (SELECT day, unnest(generate_series(-20, 20)) AS k FROM days) x),
weekdays AS (
  SELECT day, moved, k,
    row_number() OVER (PARTITION BY day, k > 0 ORDER BY k) AS ahead,
    row_number() OVER (PARTITION BY day, k < 0 ORDER BY k DESC) AS back
  FROM steps WHERE k <> 0 AND isodow(moved) <= 5)
SELECT d.day, b.moved AS back_5, f.moved AS ahead_5, x.moved AS ahead_10,
  CAST(d.day - INTERVAL 1 MONTH AS DATE) AS month_before
FROM days d
JOIN weekdays b ON b.day = d.day AND b.k < 0 AND b.back = 5
JOIN weekdays f ON f.day = d.day AND f.k > 0 AND f.ahead = 5
JOIN weekdays x ON x.day = d.day AND x.k > 0 AND x.ahead = 10""")
def business_day_pad(t):
    day = F.col("day")
    return t("orders").select(F.to_date("o_orderdate").alias("day")).distinct().select(
        "day",
        dates.add_business_days(day, -5).alias("back_5"),
        dates.add_business_days(day, 5).alias("ahead_5"),
        dates.add_business_days(day, 10).alias("ahead_10"),
        dates.months_before(day).alias("month_before"),
    )


@query(r"""
SELECT doc_id, CAST(length(text) AS INT) AS characters,
  CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS INT) AS words
FROM {documents}""")
def char_word_counts(t):
    return statistics.char_word_counts(t("documents"), "text").select("doc_id", "characters", "words")


SUFFIX_SQL = "|".join(NAME_SUFFIXES)
NORMALIZED = rf"""
trim(regexp_replace(regexp_replace(regexp_replace(lower(comnam), '[&.'',]', ' ', 'g'),
  '\b({SUFFIX_SQL})\b', ' ', 'g'), '\s+', ' ', 'g'))"""


@query(f"SELECT permno, ticker, comnam, {NORMALIZED} AS comnam_norm FROM fx_stocknames")
def normalize_company_name(t):
    return t("fx_stocknames").select(
        "permno", "ticker", "comnam", text.normalize_company_name(F.col("comnam")).alias("comnam_norm")
    )


@query(f"""
SELECT * FROM (SELECT DISTINCT permno, comnam, ticker, {NORMALIZED} AS comnam_norm FROM fx_stocknames WHERE comnam IS NOT NULL) x
WHERE length(comnam_norm) >= 5""")
def names_lookup(t):
    return linking.names_lookup(t("fx_stocknames"))


@query("SELECT rp_entity_id, isin, substring(isin, 3, 8) AS cusip FROM fx_rp_company_names WHERE isin IS NOT NULL")
def isin_to_cusip(t):
    names = t("fx_rp_company_names").where(F.col("isin").isNotNull())
    return names.select("rp_entity_id", "isin", text.isin_to_cusip(F.col("isin")).alias("cusip"))


SERIES = ["IORB", "IOER", "TREAST", "WALCL", "OBFR"]
WIDE = "SELECT date, " + ", ".join(
    f"max(CASE WHEN series_id = '{s}' THEN value END) AS {s}" for s in SERIES
) + " FROM fx_macro GROUP BY date"


@query(f"""WITH wide AS ({WIDE}) SELECT date, coalesce(IORB, IOER) AS gen_iorb FROM wide""")
def coalesce_rates(t):
    return macro.coalesce_rates(macro.widen(t("fx_macro"), SERIES)).select("date", "gen_iorb")


@query("""
SELECT series_id, date, CASE WHEN series_id IN ('TREAST', 'WALCL') THEN value / 1000 ELSE value END AS value FROM fx_macro""")
def unit_scale(t):
    return macro.unit_scale(t("fx_macro"))


@query("""
WITH filled AS (
  SELECT series_id, date, CASE WHEN series_id IN ('OBFR', 'TREAST', 'WALCL')
      THEN last_value(v IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date ROWS UNBOUNDED PRECEDING)
      ELSE v END AS value
  FROM (SELECT series_id, date, CASE WHEN series_id IN ('TREAST', 'WALCL') THEN value / 1000 ELSE value END AS v
        FROM fx_macro) x)
SELECT date, max(CASE WHEN series_id = 'TREAST' THEN value END) AS TREAST,
  max(CASE WHEN series_id = 'WALCL' THEN value END) AS WALCL, max(CASE WHEN series_id = 'OBFR' THEN value END) AS OBFR,
  coalesce(max(CASE WHEN series_id = 'IORB' THEN value END), max(CASE WHEN series_id = 'IOER' THEN value END)) AS gen_iorb,
  CAST(NULL AS DOUBLE) AS counterparty_limit, CAST(NULL AS DOUBLE) AS aggregate_limit
FROM filled GROUP BY date""", name="macro_table")
def macro_table_query(t):
    """Scaled and filled series, the joined reserve rate and the (later) policy limits."""
    return macro_table(t("fx_macro"), SERIES)


@query("""
SELECT permno, greatest(mbrstartdt, indfrom) AS effstartdt, least(mbrenddt, coalesce(indthru, mbrenddt)) AS effenddt
FROM fx_membership JOIN fx_hgic ON gvkey = 'G' || CAST(permno AS STRING)""")
def effective_interval(t):
    members = t("fx_membership").withColumn("gvkey", F.concat(F.lit("G"), F.col("permno").cast("string")))
    joined = members.join(t("fx_hgic"), "gvkey")
    return joined.select(
        "permno",
        *(c.alias(n) for n, c in linking.effective_interval("mbrstartdt", "mbrenddt", "indfrom", "indthru").items()),
    )


@query(f"""WITH {NAMES}
SELECT f.permno, f.effstartdt, f.gsector, n.sector_name FROM fx_spells f LEFT JOIN sector_names n ON n.gsector = f.gsector""")
def sector_name(t):
    return t("fx_spells").select("permno", "effstartdt", "gsector", sectors.sector_name(F.col("gsector")).alias("sector_name"))


@query("""
SELECT date, round(ln(1 + vwretd), 9) AS log_ret, round(abs(vwretd), 6) AS size FROM fx_index""")
def log_return(t):
    return t("fx_index").select(
        "date", F.round(numbers.log_return(F.col("vwretd")), 9).alias("log_ret"), F.round(F.abs("vwretd"), 6).alias("size")
    )


@query("""
SELECT v.vec_id, round(1 / (1 + exp(-(list_sum(list_transform(v.embedding::DOUBLE[], lambda x: x * 0.25)) + 0.1))), 6) AS p_up
FROM {embeddings} v""")
def sigmoid_score(t):
    """Logistic score of each vector under one given weight vector."""
    weights = F.transform("embedding", lambda x: F.lit(0.25))
    return t("embeddings").select(
        "vec_id", F.round(vectors.linear_score(F.col("embedding"), weights, F.lit(0.1)), 6).alias("p_up")
    )


@query("""
SELECT vec_id, CAST(i AS INT) AS pos, round(CASE WHEN len = 0 THEN 0 ELSE e / len END, 6) AS value
FROM (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS e,
        sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS len FROM {embeddings}) x""")
def l2_normalize(t):
    unit = vectors.l2_normalize(F.col("embedding"))
    return rounded(t("embeddings").select("vec_id", F.posexplode(unit).alias("pos", "value")))
