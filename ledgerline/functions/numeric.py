"""Numeric column helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN -> NULL in floating columns (keeping each column's type), for
    inputs where NaN means "missing": comparisons and ``IS NOT NULL`` then
    skip it, and aggregates ignore it instead of returning NaN."""
    floating = {f.name: f.dataType for f in df.schema.fields
                if f.dataType.typeName() in ("double", "float")}
    targets = [c for c in (cols or df.columns) if c in floating]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(floating[c])) for c in targets})


def earnings_surprise(est: Column, actual: Column) -> Column:
    """Surprise in percent, ``(actual - est) / est * 100`` rounded to 2
    places; 0 when the estimate is 0; NULL when the estimate is NULL."""
    return (F.when(est.isNull(), F.lit(None).cast("double"))
            .when(est != 0, F.round((actual - est) / est * 100, 2))
            .otherwise(F.lit(0.0)))
