"""Column-name sanitising for warehouse-safe identifiers.

Metadata only: names are rewritten on the driver from the schema and applied
with one ``toDF``; no row is touched.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# The characters a warehouse identifier is made of.
_RUN = re.compile("[0-9A-Za-z]+")


def warehouse_identifier(name: str) -> str:
    """The name's runs of letters and digits, joined by single underscores; an
    underscore before a leading digit, and alone where nothing is left."""
    runs = _RUN.findall(name)
    if not runs or runs[0][0].isdigit():
        runs.insert(0, "")
    return "_".join(runs) or "_"


def sanitize_columns(df: DataFrame, on_collision: str = "raise") -> DataFrame:
    """Rename every column with ``warehouse_identifier`` in one projection.

    Two names that sanitise to the same identifier (compared
    case-insensitively, as Spark resolves names) raise unless
    ``on_collision="suffix"``, which appends ``_2``, ``_3`` ...
    """
    new, seen = [], {}
    for old in df.columns:
        name = warehouse_identifier(old)
        key = name.lower()
        if key in seen:
            if on_collision != "suffix":
                raise ValueError(f"columns {seen[key]!r} and {old!r} both sanitise to {name!r}")
            n = 2
            while f"{key}_{n}" in seen:
                n += 1
            name, key = f"{name}_{n}", f"{key}_{n}"
        seen[key] = old
        new.append(name)
    return df.toDF(*new)
