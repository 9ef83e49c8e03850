"""Code normalisation and code -> label mapping (Column -> Column).

Everything here compiles to ``CASE WHEN`` / ``trim`` / ``upper`` inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.functions.util import as_col

# ---------------------------------------------------------------------------
# These labels must equal the source system's for the silver
# and gold tables to carry the same text. Keep them exactly as listed.
# ---------------------------------------------------------------------------
UNKNOWN = "Unknown"
MARITAL_STATUS_MAP = {"M": "Married", "S": "Single"}
CRM_GENDER_MAP = {"F": "Female", "M": "Male"}
PRODUCT_LINE_MAP = {"R": "Road", "S": "Other Sales", "M": "Mountain", "T": "Touring"}
ERP_GENDER_MAP = {"M": "Male", "F": "Female", "FEMALE": "Female", "MALE": "Male", "": "Unknown"}
COUNTRY_MAP = {"": "Unknown", "DE": "Germany", "US": "United States", "USA": "United States"}
# ---------------------------------------------------------------------------


def normalize_code(c: Column | str) -> Column:
    """Upper-case and strip surrounding spaces."""
    return F.trim(F.upper(as_col(c)))


def replace_values(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Exact-match replacement; values without an entry pass through.

    Same semantics as ``DataFrame.na.replace(mapping, subset=[c])`` but
    usable inside any expression.
    """
    c = as_col(c)
    if not mapping:
        return c
    expr = None
    for code, label in mapping.items():
        expr = (F.when(c == F.lit(code), F.lit(label)) if expr is None
                else expr.when(c == F.lit(code), F.lit(label)))
    return expr.otherwise(c)


def map_codes(c: Column | str, mapping: Mapping[str, str],
              default: str | None = UNKNOWN, normalize: bool = True) -> Column:
    """normalize -> replace known codes -> null becomes ``default``."""
    c = normalize_code(c) if normalize else as_col(c)
    out = replace_values(c, mapping)
    return F.coalesce(out, F.lit(default)) if default is not None else out


def map_country(c: Column | str) -> Column:
    """Country label on the normalised code; unknown codes keep the raw,
    untrimmed input value; null becomes ``Unknown``."""
    raw = as_col(c)
    code = normalize_code(raw)
    expr = None
    for key, label in COUNTRY_MAP.items():
        expr = (F.when(code == F.lit(key), F.lit(label)) if expr is None
                else expr.when(code == F.lit(key), F.lit(label)))
    return F.coalesce(expr.otherwise(raw), F.lit(UNKNOWN))


def prefer_known(primary: Column | str, fallback: Column | str,
                 unknown: str = UNKNOWN) -> Column:
    """``primary`` unless it equals ``unknown`` (or is null); then
    ``fallback``; then ``unknown``."""
    p = as_col(primary)
    return F.when(p != F.lit(unknown), p).otherwise(
        F.coalesce(as_col(fallback), F.lit(unknown)))
