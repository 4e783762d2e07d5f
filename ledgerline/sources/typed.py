"""Declared types of raw tables, applied where a table is resolved.

Loaders differ in what they keep: CSV files give text, data frames give NaN
for a missing number and a timestamp for a day.  ``TypedSources`` puts one
rule per declared type between any resolver and the models.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from ledgerline.functions.numeric import nan_to_null
from ledgerline.schemas import RAW_TYPES


def _as(column: Column, have: DataType, want: DataType) -> Column:
    """``column`` as ``want``; text that does not say such a value becomes NULL."""
    if have == want:
        return column
    if have.typeName() == "string":
        text = F.trim(column)
        if want.typeName() in ("long", "integer", "short", "byte"):
            # loaders that went through a float write 12 as 12.0; a fraction is no integer
            number = text.try_cast("decimal(38,6)")
            return F.when(number == F.floor(number), number).try_cast(want)
        return text.try_cast(want)
    return column.cast(want)


def coerce(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the declared columns in their declared types, in their order.

    Text is parsed (dates also from a full timestamp), NaN becomes NULL, a
    column that is absent is NULL, and columns that are not declared follow
    unchanged.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    declared = [(_as(F.col(f.name), have[f.name], f.dataType) if f.name in have
                 else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    rest = [F.col(c) for c in df.columns if c not in schema.names]
    return nan_to_null(df.select(*declared, *rest), schema.names)


class TypedSources:
    """A resolver whose declared tables come in their declared types."""

    def __init__(self, sources: Callable[[str], DataFrame], schemas: Mapping[str, StructType] = RAW_TYPES):
        self._sources, self._schemas = sources, dict(schemas)

    def __call__(self, name: str) -> DataFrame:
        df = self._sources(name)
        return coerce(df, self._schemas[name]) if name in self._schemas else df
