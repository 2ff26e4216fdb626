"""Queries over sources and sinks."""

from pyspark.sql import functions as F

from newsalpha.catalog.base import CLEAN, LABELED, Tables, query, rounded
from newsalpha.operators.embedding import append_new_embeddings, hashing_embedder
from newsalpha.operators.filters import company_news, daily_market_cap
from newsalpha.operators.funnel import clean_headlines, funnel_stage_counts
from newsalpha.operators.labels import build_labeled_dataset
from newsalpha.plans.headlines import daily_stock
from newsalpha.schemas import SCHEMAS, conform
from newsalpha.session import new_folder
from newsalpha.sources.readers import normalize_daily, scan_chunks, scan_columns, scan_years, union_years
from newsalpha.sources.writers import append_dataset, read_report, write_csv, write_dataset, write_report


def new_path(t: Tables, name: str) -> str:
    return new_folder(t.spark, name)


@query("SELECT doc_id, lang, n_chars FROM {documents} WHERE text IS NOT NULL", name="scan_columns")
def scan_columns_query(t):
    return scan_columns(t.spark, f"{t.folder}/documents.parquet", ["doc_id", "lang", "n_chars"], F.col("text").isNotNull())


@query("""
SELECT vec_id AS rp_story_id, len(embedding) AS dims, round(list_sum(embedding::DOUBLE[]), 4) AS total
FROM {embeddings}""", name="scan_chunks")
def scan_chunks_query(t):
    """Vectors written as two overlapping sets of chunk files, read as one table."""
    vectors = t("embeddings").select(F.col("vec_id").alias("rp_story_id"), "embedding", "label")
    folder = new_path(t, "chunks")
    for side in (F.col("label") >= 4, F.col("label") <= 5):
        append_dataset(vectors.where(side).select("rp_story_id", "embedding"), folder)
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return scan_chunks(t.spark, folder, pattern="part-*.parquet").select(
        "rp_story_id", F.size("embedding").cast("bigint").alias("dims"), F.round(total, 4).alias("total")
    )


@query("""
SELECT o_orderkey AS rp_story_id, CAST(o_orderdate AS DATE) AS article_date, CAST(year(o_orderdate) AS INT) AS year
FROM {orders}""")
def scan_yearly_union(t):
    """Written once with a folder per year, then read: one scan, whatever the number of years."""
    orders = t("orders").select(
        F.col("o_orderkey").alias("rp_story_id"), F.col("o_orderdate").cast("date").alias("article_date")
    )
    path = new_path(t, "years")
    write_dataset(orders.withColumn("year", F.year("article_date")), path, partition_by=("year",))
    return scan_years(t.spark, path, 1900, 2100)


@query("""
SELECT o_orderkey AS rp_story_id, CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS priority FROM {orders}
WHERE year(o_orderdate) BETWEEN 1994 AND 1995""")
def union_years_by_table(t):
    """One table per year, of which the later ones have a column more."""
    orders = t("orders").select(F.col("o_orderkey").alias("rp_story_id"), F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("priority"))
    return union_years({year: orders.where(F.col("y") == year).drop("y") for year in (1995, 1994)})


@query("""
SELECT permno, date, ret, prc, shrout, 'new' AS layout FROM fx_daily
UNION ALL SELECT permno, date, ret, prc, shrout, 'old' AS layout FROM fx_daily""", name="normalize_daily")
def normalize_daily_query(t):
    old = t("fx_daily")
    new = old.withColumnsRenamed({"date": "dlycaldt", "ret": "dlyret", "prc": "dlyprc", "shrout": "dlyshrout"})
    return normalize_daily(new).withColumn("layout", F.lit("new")).unionByName(
        normalize_daily(old).withColumn("layout", F.lit("old"))
    )


@query("""
SELECT d.permno, d.date, d.ret, d.prc, d.shrout * 1000 AS shrout, abs(d.prc) * (d.shrout * 1000) AS market_cap
FROM fx_daily d JOIN fx_sec_hist h ON h.permno = d.permno AND d.date BETWEEN h.secinfostartdt AND h.secinfoenddt
WHERE h.securitytype = 'EQTY' AND h.securitysubtype = 'COM' AND h.sharetype = 'NS' AND h.usincflg = 'Y'""")
def daily_stock_file(t):
    return daily_stock(t("fx_daily"), t("fx_sec_hist"))


def labeled(t):
    daily = daily_market_cap(t("fx_daily"))
    clean = clean_headlines(t("fx_headlines"), daily, t("fx_calendar"))
    return build_labeled_dataset(clean, daily)


@query(f"""WITH {LABELED}
SELECT rp_story_id, permno, article_date, headline, round(ret_window, 9) AS ret_window, market_cap, label FROM labeled""",
       name="write_dataset")
def write_dataset_query(t):
    path = new_path(t, "labeled")
    rows = labeled(t).withColumn("year", F.year("article_date"))
    write_dataset(rows, path, partition_by=("year",), sort_by=("article_date", "permno"))
    stored = conform(t.spark.read.parquet(path), "labeled")
    return rounded(stored, 9).withColumn("label", F.col("label").cast("int"))


@query("SELECT DISTINCT rp_story_id, CAST(1 AS BIGINT) AS copies, CAST(768 AS BIGINT) AS dims FROM fx_headlines",
       name="append_new_embeddings")
def append_new_embeddings_query(t):
    """First the company news, then everything: the second run must only add what is missing."""
    news, path, model = t("fx_headlines"), new_path(t, "vectors"), hashing_embedder()
    append_new_embeddings(news.where(company_news()), path, model)
    append_new_embeddings(news, path, model)
    return t.spark.read.parquet(path).groupBy("rp_story_id").agg(
        F.count("*").alias("copies"), F.max(F.size("embedding")).cast("bigint").alias("dims")
    )


@query("SELECT series_id, date, value FROM fx_macro", name="write_csv")
def write_csv_query(t):
    path = new_path(t, "macro")
    write_csv(t("fx_macro").select("series_id", "date", "value"), path)
    return t.spark.read.schema("series_id string, date date, value double").option("header", True).csv(path)


@query(f"""WITH {CLEAN}
SELECT '0_raw' AS stage, count(*) AS n FROM dated
UNION ALL SELECT '1_single_entity', count(*) FROM single_rows
UNION ALL SELECT '2_has_return', count(*) FROM priced_rows
UNION ALL SELECT '3_length_filter', count(*) FROM long_rows
UNION ALL SELECT '4_deduplicated', count(*) FROM clean""")
def report_json(t):
    path = new_path(t, "stages")
    write_report(funnel_stage_counts(t("fx_headlines"), t("fx_daily"), t("fx_calendar")), path)
    return read_report(t.spark, path, SCHEMAS["stage_counts"])
