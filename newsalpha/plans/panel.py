"""The sector panel from stored tables."""

from pyspark.sql import SparkSession

from newsalpha.operators.panel import sector_panel
from newsalpha.sources.readers import scan_columns
from newsalpha.sources.writers import write_dataset

# Columns that the panel needs from each input.
INPUT_COLUMNS = {
    "headlines": ["rp_story_id", "permno", "article_date", "market_cap", "gsector"],
    "predictions": ["rp_story_id", "p_up"],
    "daily": ["permno", "date", "ret", "market_cap"],
    "spells": ["permno", "gsector", "effstartdt", "effenddt"],
    "funds": ["ticker", "date", "ret"],
}


def build_panel(spark: SparkSession, inputs: dict[str, str], output: str) -> None:
    """Read the five inputs (name to path), write the panel."""
    tables = {name: scan_columns(spark, inputs[name], columns) for name, columns in INPUT_COLUMNS.items()}
    write_dataset(sector_panel(**tables), output, sort_by=("gsector", "date"))
