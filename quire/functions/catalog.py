"""Catalog expressions: keys, reading-ease scores and bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import fixed_values as V


def file_key(file_name: Column, pattern: str = V.CATALOG_FILE_KEY) -> Column:
    """Key in a file name; the name without its last suffix when the pattern does not match."""
    found = F.nullif(F.regexp_extract(file_name, pattern, 1), F.lit(""))
    return F.coalesce(found, F.regexp_replace(file_name, r"(?<=.)\.[^.]*$", ""))


def is_english(lang: Column) -> Column:
    return lang.eqNullSafe(V.ENGLISH)


def score(note: Column, exact: bool = False) -> Column:
    """Reading-ease score in a free-text note, or null. ``exact`` keeps the decimals."""
    digits = F.regexp_extract(note, V.SCORE_DECIMAL if exact else V.SCORE_DIGITS, 1)
    return F.nullif(digits, F.lit("")).try_cast("double")


def score_band(value: Column) -> Column:
    """Name of the band a score falls in."""
    first = F.when(value.isNull(), V.NO_SCORE_BAND)
    bands = reduce(lambda case, band: case.when(value <= band[1], band[0]), V.SCORE_BANDS, first)
    return bands.otherwise(V.TOP_BAND)
