"""Text cleaning as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def strip(col: Column) -> Column:
    """Trim every kind of white space; Spark's plain ``trim`` removes spaces only."""
    return F.btrim(col, F.lit(_BLANKS))


def title_case(col: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the others.

    ``initcap`` starts a word after white space only. Text of plain letters and spaces takes
    that fast path; "semi-private" and "o'neil" are split at every non-letter.
    """
    pieces = F.regexp_extract_all(col, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), 1)
    by_run = F.array_join(F.transform(pieces, F.initcap), "")
    return F.when(col.rlike("^[A-Za-z ]*$"), F.initcap(col)).otherwise(by_run)


def clean_title(col: Column) -> Column:
    return title_case(strip(col))


def fill_text(col: Column, default: str) -> Column:
    return F.coalesce(col, F.lit(default))


def quarter_label(quarter: Column) -> Column:
    return F.concat(F.lit("Q"), quarter.cast("string"))
