"""Queries over linking, the funnel, labels and sectors."""

from pyspark.sql import functions as F

from newsalpha.catalog.base import (
    CLEAN, DAILY, DAILY_SECTORS, DATED, FUND_RETURNS, FUNDS, LABELED, PANEL, SCORED, SECTORED, WINDOWS, query, rounded,
)
from newsalpha.constants import LINK_RANKS, LINK_TYPES
from newsalpha.operators import funnel, labels, linking, panel, rolling, sectors, sessions
from newsalpha.operators.embedding import not_yet_embedded as still_to_embed
from newsalpha.operators.filters import company_news, daily_market_cap
from newsalpha.plans.headlines import labeled_with_sector, linked_news, sector_label_share

# Issuers and entities by the eight characters that an ISIN has behind its country code.
CROSSWALK = """by_code AS (
  SELECT code, list(permno) AS issuers, list(entity) AS entities FROM (
    SELECT ncusip AS code, permno, NULL AS entity FROM fx_dse
    UNION ALL SELECT isin[3:10], NULL, rp_entity_id FROM fx_rp_company_names WHERE length(isin) > 10) x
  WHERE code IS NOT NULL GROUP BY code),
each_issuer AS (SELECT unnest(issuers) AS permno, entities FROM by_code),
crosswalk AS (
  SELECT permno, entity AS rp_entity_id FROM (SELECT permno, unnest(entities) AS entity FROM each_issuer) x
  WHERE permno IS NOT NULL AND entity IS NOT NULL GROUP BY ALL),
lookup AS (SELECT rp_entity_id, permno FROM crosswalk QUALIFY row_number() OVER (PARTITION BY rp_entity_id ORDER BY permno) = 1)"""
NEWS_TEST = "entity_type = 'COMP' AND country_code = 'US' AND relevance >= 90"


def daily(t):
    return daily_market_cap(t("fx_daily"))


def dated(t):
    return sessions.shift_opening_window(t("fx_headlines"), t("fx_calendar"))


def clean(t):
    return funnel.clean_headlines(t("fx_headlines"), t("fx_daily"), t("fx_calendar"))


def labeled(t):
    return labels.build_labeled_dataset(clean(t), daily(t))


def sectored(t):
    return labeled_with_sector(t("fx_headlines"), daily(t), t("fx_calendar"), t("fx_spells"))


def scored(t):
    return panel.join_predictions(sectored(t), t("fx_predictions"))


def crosswalk(t):
    return linking.build_crosswalk(t("fx_dse"), t("fx_rp_company_names"))


def fund_returns(t):
    return panel.etf_returns(t("fx_etf"))


def built_panel(t):
    return panel.sector_panel(sectored(t), t("fx_predictions"), daily(t), t("fx_spells"), fund_returns(t))


@query(f"WITH {CROSSWALK} SELECT permno, rp_entity_id FROM crosswalk")
def build_crosswalk(t):
    return crosswalk(t)


@query(f"""WITH {CROSSWALK}
SELECT h.rp_story_id, h.rp_entity_id, h.headline, l.permno FROM fx_headlines h JOIN lookup l ON l.rp_entity_id = h.rp_entity_id""")
def attach_permno(t):
    linked = linking.attach_permno(t("fx_headlines"), crosswalk(t))
    return linked.select("rp_story_id", "rp_entity_id", "headline", "permno")


@query(f"""WITH {CROSSWALK}
SELECT h.rp_story_id, h.rp_entity_id, l.permno FROM fx_headlines h JOIN lookup l ON l.rp_entity_id = h.rp_entity_id
WHERE {NEWS_TEST} AND headline IS NOT NULL""")
def merge_permno(t):
    news = t("fx_headlines").where(company_news() & F.col("headline").isNotNull())
    return linking.attach_permno(news, crosswalk(t)).select("rp_story_id", "rp_entity_id", "permno")


@query(f"WITH {CROSSWALK} SELECT rp_entity_id, permno FROM lookup")
def first_by_key(t):
    return linking.one_issuer_per_entity(crosswalk(t))


# A story is about one firm when its smallest and its largest entity are the same.
SINGLE_FIRM = f"""firm_news AS (
  SELECT *, min(rp_entity_id) OVER story AS lowest, max(rp_entity_id) OVER story AS highest
  FROM (SELECT * FROM fx_headlines WHERE {NEWS_TEST}) x WINDOW story AS (PARTITION BY provider_id, provider_story_id)),
single_news AS (SELECT * FROM firm_news WHERE lowest = highest AND provider_id IS NOT NULL AND provider_story_id IS NOT NULL)"""


@query(f"WITH {SINGLE_FIRM} SELECT DISTINCT provider_id, provider_story_id FROM firm_news WHERE lowest = highest")
def single_firm_stories(t):
    return linking.single_firm_stories(t("fx_headlines"))


@query(f"WITH {SINGLE_FIRM} SELECT rp_story_id, rp_entity_id, provider_id, provider_story_id, headline FROM single_news")
def single_firm_join(t):
    return linking.single_firm_join(t("fx_headlines")).select(
        "rp_story_id", "rp_entity_id", "provider_id", "provider_story_id", "headline"
    )


@query(f"""WITH {CROSSWALK}, {SINGLE_FIRM}
SELECT s.rp_story_id, rp_entity_id, l.permno FROM single_news s JOIN lookup l USING (rp_entity_id)""", name="linked_news")
def linked_news_query(t):
    return linked_news(t("fx_headlines"), crosswalk(t)).select("rp_story_id", "rp_entity_id", "permno")


@query(f"""WITH {CROSSWALK}, joined AS (SELECT l.permno FROM fx_headlines h LEFT JOIN lookup l ON l.rp_entity_id = h.rp_entity_id)
SELECT count(*) AS total, count(permno) AS matched, count(DISTINCT permno) AS issuers,
  round(count(permno) * 100.0 / count(*), 6) AS matched_pct FROM joined""")
def link_coverage(t):
    lookup = linking.one_issuer_per_entity(crosswalk(t))
    joined = t("fx_headlines").drop("permno").join(lookup, "rp_entity_id", "left")
    return rounded(linking.link_coverage(joined))


@query("""
SELECT d.permno, d.date, d.ret, h.sharetype, h.usincflg
FROM fx_daily d JOIN fx_sec_hist h ON h.permno = d.permno AND h.secinfostartdt <= d.date AND d.date <= h.secinfoenddt""")
def security_interval_join(t):
    joined = linking.security_interval_join(t("fx_daily"), t("fx_sec_hist"))
    return joined.select("permno", "date", "ret", "sharetype", "usincflg")


def listed(values):
    return ", ".join(f"'{v}'" for v in values)


@query(f"""
WITH member_days AS (
  SELECT permno, CAST(unnest(generate_series(mbrstartdt, mbrenddt, INTERVAL 1 DAY)) AS DATE) AS day FROM fx_membership),
-- Names, links and sectors of a member are those that hold on one of its days at least; the shared days are the effective window.
named AS (
  SELECT DISTINCT n.* FROM member_days m JOIN fx_stocknames n ON n.permno = m.permno AND m.day BETWEEN n.namedt AND n.nameenddt),
linked AS (
  SELECT DISTINCT m.permno, k.gvkey, k.linkdt FROM member_days m JOIN fx_ccm k ON k.lpermno = m.permno AND m.day >= k.linkdt
  WHERE k.linktype IN ({listed(LINK_TYPES)}) AND k.linkprim IN ({listed(LINK_RANKS)}) AND (k.linkenddt IS NULL OR m.day <= k.linkenddt)),
tagged AS (
  SELECT m.permno, g.gvkey, g.gsector, g.indfrom, g.indthru, min(m.day) AS first_day, max(m.day) AS last_day
  FROM member_days m JOIN (SELECT DISTINCT permno, gvkey FROM linked) k ON k.permno = m.permno
  JOIN fx_hgic g ON g.gvkey = k.gvkey AND m.day >= g.indfrom AND (g.indthru IS NULL OR m.day <= g.indthru) GROUP BY ALL)
SELECT m.permno, m.mbrstartdt, m.mbrenddt, n.comnam, n.ticker, n.namedt, n.nameenddt, k.gvkey, g.gsector,
  g.indfrom AS gics_startdt, g.indthru AS gics_enddt, coalesce(g.first_day, m.mbrstartdt) AS effstartdt, coalesce(g.last_day, m.mbrenddt) AS effenddt
FROM fx_membership m LEFT JOIN named n ON n.permno = m.permno LEFT JOIN linked k ON k.permno = m.permno
LEFT JOIN tagged g ON g.permno = k.permno AND g.gvkey = k.gvkey""")
def constituent_spells(t):
    spells = linking.constituent_spells(t("fx_membership"), t("fx_stocknames"), t("fx_ccm"), t("fx_hgic"))
    return spells.drop("linkdt", "linkenddt")


@query(f"""WITH {DATED.replace("dated AS (", "unused AS (")}
SELECT d.day, coalesce(n.next_day, d.day) AS next_day
FROM (SELECT DISTINCT CAST(local_ts AS DATE) AS day FROM local_news) d LEFT JOIN next_days n ON n.day = d.day""")
def next_trading_day(t):
    from newsalpha.functions.dates import utc_to_eastern

    days = t("fx_headlines").select(F.to_date(utc_to_eastern(F.col("timestamp_utc"))).alias("day")).distinct()
    days = days.withColumnRenamed("day", "news_day")
    following = sessions.next_trading_day(days, t("fx_calendar"), "news_day", "next_day")
    return following.withColumnRenamed("news_day", "day")


@query(f"WITH {DATED} SELECT rp_story_id, permno, headline, article_date FROM dated")
def opening_window_shift(t):
    return dated(t).select("rp_story_id", "permno", "headline", "article_date")


@query(f"""WITH {DAILY}, {DATED}
SELECT h.rp_story_id, h.permno, h.article_date FROM dated h
WHERE EXISTS (SELECT 1 FROM daily d WHERE d.permno = h.permno AND d.date = h.article_date AND d.ret IS NOT NULL)""")
def has_return_semi(t):
    return funnel.has_return_semi(dated(t), t("fx_daily")).select("rp_story_id", "permno", "article_date")


@query("""
SELECT rp_story_id, permno, headline FROM fx_headlines WHERE permno IS NOT NULL AND rp_story_id IN
  (SELECT rp_story_id FROM fx_headlines WHERE permno IS NOT NULL GROUP BY 1 HAVING count(DISTINCT permno) = 1)""")
def single_entity_stories(t):
    return funnel.single_entity_stories(t("fx_headlines")).select("rp_story_id", "permno", "headline")


@query(f"""WITH {DATED}
SELECT rp_story_id, permno, article_date, headline FROM dated
QUALIFY row_number() OVER (PARTITION BY permno, article_date, headline ORDER BY timestamp_utc, rp_story_id) = 1""")
def dedup_headlines(t):
    return funnel.dedup_headlines(dated(t)).select("rp_story_id", "permno", "article_date", "headline")


STAGES = f"""{CLEAN},
stages AS (
  SELECT '0_raw' AS stage, count(*) AS n FROM dated
  UNION ALL SELECT '1_single_entity', count(*) FROM single_rows
  UNION ALL SELECT '2_has_return', count(*) FROM priced_rows
  UNION ALL SELECT '3_length_filter', count(*) FROM long_rows
  UNION ALL SELECT '4_deduplicated', count(*) FROM clean)"""


@query(f"WITH {STAGES} SELECT stage, n FROM stages")
def funnel_stage_counts(t):
    return funnel.funnel_stage_counts(t("fx_headlines"), t("fx_daily"), t("fx_calendar"))


def funnelled(t):
    return funnel.filtering_funnel(t("fx_headlines"), t("fx_daily"), t("fx_calendar"))


@query(f"WITH {CLEAN} SELECT rp_story_id, permno, article_date, headline, relevance FROM clean")
def filtering_funnel(t):
    return funnelled(t)[0].select("rp_story_id", "permno", "article_date", "headline", "relevance")


@query(f"WITH {STAGES} SELECT stage, n FROM stages")
def filtering_funnel_counts(t):
    """The counts of the run that makes the rows."""
    return funnelled(t)[1]


@query(f"""WITH {STAGES},
labels(stage, label) AS (VALUES ('0_raw', 'All news rows'), ('1_single_entity', 'About one issuer only'),
  ('2_has_return', 'Issuer traded that day'), ('3_length_filter', 'Five characters or more'), ('4_deduplicated', 'One copy a day')),
prior AS (SELECT stage, n, lag(n) OVER (ORDER BY stage) AS p, first_value(n) OVER (ORDER BY stage) AS r FROM stages)
SELECT stage, label, n, round(n * 100.0 / r, 6) AS pct_of_raw, p - n AS dropped, round((p - n) * 100.0 / p, 6) AS pct_dropped
FROM prior JOIN labels USING (stage)""")
def funnel_table(t):
    return rounded(funnel.funnel_table(funnel_stage_counts(t)))


@query(f"WITH {DAILY}, {WINDOWS} SELECT permno, date, round(ret_window, 9) AS ret_window FROM ret_windows")
def compute_return_window(t):
    return rounded(labels.compute_return_window(t("fx_daily")), 9)


@query("SELECT permno, date, ret FROM fx_daily WHERE permno IN (SELECT permno FROM fx_headlines)")
def universe_semi(t):
    return labels.universe_semi(t("fx_daily"), t("fx_headlines")).select("permno", "date", "ret")


@query(f"""WITH {LABELED}
SELECT rp_story_id, permno, article_date, headline, round(ret_window, 9) AS ret_window, market_cap, label FROM labeled""")
def build_labeled_dataset(t):
    return rounded(labeled(t), 9).withColumn("label", F.col("label").cast("int"))


@query(f"""WITH {SECTORED}
SELECT rp_story_id, permno, article_date, headline, round(ret_window, 9) AS ret_window, label, gsector, sector_name FROM sectored""")
def merge_sector(t):
    rows = sectors.merge_sector(labeled(t), t("fx_spells")).drop("market_cap")
    return rounded(rows, 9).withColumn("label", F.col("label").cast("int"))


@query(f"""WITH {SECTORED}
SELECT gsector, article_date AS date, round(sum(label * market_cap) / sum(market_cap), 6) AS positive_share, count(*) AS n_headlines
FROM sectored WHERE market_cap > 0 GROUP BY gsector, article_date""", name="sector_label_share")
def sector_label_share_query(t):
    return rounded(sector_label_share(sectored(t)))


@query("""
SELECT d.permno, d.date, d.ret, f.gsector
FROM fx_daily d JOIN fx_spells f ON f.permno = d.permno AND d.date BETWEEN f.effstartdt AND f.effenddt
WHERE f.gsector IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY d.permno, d.date ORDER BY f.effstartdt DESC, f.gsector) = 1""")
def sector_on_daily(t):
    return sectors.sector_on_daily(t("fx_daily"), t("fx_spells")).select("permno", "date", "ret", "gsector")


@query(f"""WITH {SCORED}
SELECT rp_story_id, permno, article_date, gsector, round(sentiment_score, 6) AS sentiment_score FROM scored""")
def join_predictions(t):
    return rounded(scored(t).drop("market_cap"))


@query(f"WITH {SCORED} SELECT gsector, date, round(sentiment, 6) AS sentiment, n_headlines FROM sentiment")
def aggregate_sentiment(t):
    return rounded(panel.aggregate_sentiment(scored(t)))


@query(f"WITH {DAILY}, {DAILY_SECTORS} SELECT gsector, date, round(synthetic_ret, 9) AS synthetic_ret FROM synthetic")
def synthetic_sector_returns(t):
    return rounded(panel.synthetic_sector_returns(daily(t), t("fx_spells")), 9)


@query(f"""WITH {SCORED}, {DAILY_SECTORS}
SELECT s.gsector, s.date, round(s.sentiment, 6) AS sentiment, s.n_headlines, round(y.synthetic_ret, 6) AS synthetic_ret
FROM sentiment s JOIN synthetic y ON y.gsector = s.gsector AND y.date = s.date""")
def panel_join(t):
    sentiment = panel.aggregate_sentiment(scored(t))
    return rounded(panel.panel_join(sentiment, panel.synthetic_sector_returns(daily(t), t("fx_spells"))))


@query(f"WITH {FUND_RETURNS} SELECT ticker, date, adj_close, round(ret, 9) AS ret FROM fund_returns")
def etf_returns(t):
    return rounded(fund_returns(t), 9)


@query(f"""WITH {DAILY}, {DAILY_SECTORS}, {FUNDS}, {FUND_RETURNS}
SELECT y.gsector, y.date, round(y.synthetic_ret, 6) AS synthetic_ret, round(r.ret, 6) AS etf_ret
FROM synthetic y LEFT JOIN sector_funds f ON f.gsector = y.gsector
LEFT JOIN fund_returns r ON r.ticker = f.ticker AND r.date = y.date""")
def attach_etf_returns(t):
    returns = panel.synthetic_sector_returns(daily(t), t("fx_spells"))
    return rounded(panel.attach_etf_returns(returns, fund_returns(t)))


@query(f"""WITH {PANEL}
SELECT gsector, sector_name, date, n_headlines, round(sentiment, 6) AS sentiment,
  round(synthetic_ret, 6) AS synthetic_ret, round(etf_ret, 6) AS etf_ret FROM panel""")
def sector_panel(t):
    return rounded(built_panel(t))


@query("""
SELECT l.rp_story_id, l.article_date, l.label, CAST(len(e.embedding) AS INT) AS dims, round(list_sum(e.embedding::DOUBLE[]), 4) AS total,
  round(list_sum(list_transform(e.embedding::DOUBLE[], lambda x: abs(x))), 4) AS size
FROM fx_labeled l JOIN {embeddings} e ON e.vec_id = l.vec_id""")
def join_embeddings(t):
    rows = t("fx_labeled").withColumnRenamed("rp_story_id", "story").withColumnRenamed("vec_id", "rp_story_id")
    vectors = t("embeddings").select(F.col("vec_id").alias("rp_story_id"), "embedding")
    joined = rolling.join_embeddings(rows, vectors)

    def total(entry):
        return F.round(F.aggregate(F.transform(F.col("embedding").cast("array<double>"), entry), F.lit(0.0), lambda a, x: a + x), 4)

    return joined.select(
        F.col("story").alias("rp_story_id"), "article_date", "label", F.size("embedding").alias("dims"),
        total(lambda x: x).alias("total"), total(F.abs).alias("size"),
    )


@query("""
SELECT DISTINCT rp_story_id FROM fx_headlines h
WHERE NOT EXISTS (SELECT 1 FROM fx_predictions p WHERE p.rp_story_id = h.rp_story_id)""")
def not_yet_embedded(t):
    """Stories without a stored row."""
    return still_to_embed(t("fx_headlines").select("rp_story_id").distinct(), t("fx_predictions"))
