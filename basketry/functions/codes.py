"""Product-code expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a product code is cut out, cleaned and padded.
CODE_PATTERN = r"([\d]*\d{7})"
UNWANTED_CHARACTERS = r"[^-0-9a-zA-z]+"
CODE_LENGTH = 14
CODE_PADDING = "0"


def pad_code(code: Column) -> Column:
    """Pad to 14 characters with zeros on the left; a longer code keeps its first 14."""
    return F.lpad(code, CODE_LENGTH, CODE_PADDING)


def normalize_code(gtin: Column, alternative: Column) -> Column:
    """The padded code of a product.

    A product with a gtin takes its first run of seven or more digits, and has no code when there
    is none. Only a product without any gtin falls back on the alternative code, cleaned.
    """
    found = F.nullif(F.regexp_extract(gtin, CODE_PATTERN, 1), F.lit(""))
    cleaned = F.regexp_replace(alternative, UNWANTED_CHARACTERS, "")
    return pad_code(F.when(gtin.isNotNull(), found).otherwise(cleaned))
