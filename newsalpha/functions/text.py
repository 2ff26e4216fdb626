"""Text expressions. All of them stay on the JVM side and read the whole text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsalpha.constants import NAME_SUFFIXES


def strip_spaces(text: Column) -> Column:
    """Trim every kind of Unicode white space; ``trim`` would only take blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def char_count(text: Column) -> Column:
    """Number of code points."""
    return F.length(text)


def word_count(text: Column) -> Column:
    """Number of words between white space; an empty text has none."""
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda word: word != ""))


def token_count(text: Column) -> Column:
    """Number of runs of letters or digits plus single punctuation marks."""
    return F.size(F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}\s])"), F.lit(1)))


def normalize_company_name(name: Column) -> Column:
    """Lower case, punctuation to blanks, legal-form words out, blanks collapsed."""
    text = F.regexp_replace(F.lower(name), r"[&.',]", " ")
    text = F.regexp_replace(text, r"\b(" + "|".join(NAME_SUFFIXES) + r")\b", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def isin_to_cusip(isin: Column) -> Column:
    """The eight issuer characters inside an ISIN."""
    return F.substring(isin, 3, 8)
