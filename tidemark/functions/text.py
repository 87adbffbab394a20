"""Parsing of vendor text: codes, numbers with signs and separators, titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import as_col


def ticker_code(c: Column | str, width: int = 6) -> Column:
    """Digits only, left-padded with zeros."""
    digits = F.regexp_replace(as_col(c).cast("string"), "[^0-9]", "")
    return F.when(digits != "", F.lpad(digits, width, "0"))


def parse_number(c: Column | str) -> Column:
    """Number from text with thousands separators, percent signs and arrows.

    A down arrow or leading minus makes the value negative; ``-``, ``.`` and the
    empty text are null.
    """
    raw = F.trim(as_col(c).cast("string"))
    negative = raw.rlike("^[▼-]")
    body = F.regexp_replace(raw, "[,%▲▼+\\s-]", "").try_cast("double")
    return F.when(negative, -F.abs(body)).otherwise(body)


def clean_text_number(c: Column | str) -> Column:
    """Vendor number: thousands separators dropped; empty text and ``.`` are null."""
    return F.regexp_replace(F.trim(as_col(c)), ",", "").try_cast("double")


def compact_number(c: Column | str) -> Column:
    """Number from exchange text: everything but digits, dot and minus is dropped."""
    return F.regexp_replace(as_col(c).cast("string"), "[^0-9.\\-]", "").try_cast("double")


def sorted_distinct_text(c: Column | str, sep: str = ";", width: int = 200) -> Column:
    """Aggregate: sorted distinct values joined, cut to ``width`` characters (A2)."""
    return F.substring(F.array_join(F.array_sort(F.collect_set(as_col(c))), sep), 1, width)


def strip_suffix(c: Column | str, suffix_pattern: str) -> Column:
    return F.regexp_replace(as_col(c), suffix_pattern + "$", "")


def first_json_value(doc: Column | str, paths: Sequence[str]) -> Column:
    """First present value over known JSON paths."""
    return F.coalesce(*[F.get_json_object(as_col(doc), p) for p in paths])


def row_digest(*cols: Column | str) -> Column:
    """SHA-256 of the JSON form of the columns."""
    return F.sha2(F.to_json(F.struct(*[as_col(c) for c in cols])), 256)
