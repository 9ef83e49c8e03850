"""Column-shape helpers (DataFrame -> DataFrame); all are projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def move_column(df: DataFrame, column: str, after: str) -> DataFrame:
    """Place ``column`` directly behind ``after``."""
    cols = [c for c in df.columns if c != column]
    if column not in df.columns:
        raise ValueError(f"{column!r} not in {df.columns}")
    idx = cols.index(after)
    return df.select(*cols[:idx + 1], column, *cols[idx + 1:])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; names missing from ``df`` are ignored (case-insensitive)."""
    return df.withColumnsRenamed(dict(mapping))


def fill_strings(df: DataFrame, value: str, subset: Sequence[str] | None = None) -> DataFrame:
    """Null -> ``value`` on string columns (all of them when ``subset`` is None)."""
    if subset is None:
        subset = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.na.fill(value, subset=list(subset))


def with_audit(df: DataFrame, name: str | None) -> DataFrame:
    """Append the load timestamp column, or nothing when ``name`` is None
    (tests and oracle checks switch it off because it is not
    reproducible)."""
    return df if name is None else df.withColumn(name, F.current_timestamp())
