"""One schema per dataset. Timestamps are zone-free and hold UTC."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMAS = {
    "daily": "permno bigint, date date, ret double, prc double, shrout double",
    "headlines": "rp_story_id bigint, timestamp_utc timestamp_ntz, permno bigint, rp_entity_id bigint, "
    "headline string, relevance int, entity_type string, country_code string",
    "spells": "permno bigint, gsector string, effstartdt date, effenddt date",
    "predictions": "rp_story_id bigint, oos_year int, p_up double",
    "fund_prices": "ticker string, date date, adj_close double",
    "labeled": "rp_story_id bigint, permno bigint, article_date date, headline string, ret_window double, "
    "market_cap double, label tinyint",
    "panel": "gsector string, sector_name string, date date, n_headlines bigint, sentiment double, "
    "synthetic_ret double, etf_ret double",
    "embeddings": "rp_story_id bigint, embedding array<float>",
    "rolling_metrics": "model string, oos_year int, best_c double, val_accuracy double, accuracy double, "
    "n_train bigint, n_val bigint, n_test bigint",
    "stage_counts": "stage string, n bigint",
}


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Fail where a key occurs twice. Daily rows need it: a second row for an issuer and day
    would shift its return windows, and the one row per trading day bounds their groups."""
    double = df.groupBy(*keys).count().where(F.col("count") > 1).first()
    if double is not None:
        raise ValueError(f"key occurs {double['count']} times: {[double[k] for k in keys]}")
    return df


def conform(df: DataFrame, name: str) -> DataFrame:
    """Check that the columns of a dataset are there, cast them, and turn NaN to null."""
    wanted = df.sparkSession.createDataFrame([], SCHEMAS[name]).schema
    missing = [field.name for field in wanted if field.name not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {', '.join(missing)}")
    columns = []
    for field in wanted:
        column = F.col(field.name).cast(field.dataType)
        if field.dataType.typeName() in ("double", "float"):
            column = F.when(~F.isnan(column), column)
        columns.append(column.alias(field.name))
    return df.select(columns)
