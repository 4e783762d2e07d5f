"""Declarative data-quality checks: not_null, unique, unique combination.

Each check returns rows ``(test_id, test, model, column_name, failures)``.
Checks are evaluated per model in as few passes as possible: uniqueness
checks are a grouped count (partial aggregation on the map side, one shuffle
on the key) that also yields the NULL counts of the key columns; other
not-null checks share one global aggregate.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

RESULT_COLS = ("test_id", "test", "model", "column_name", "failures")


@dataclass(frozen=True)
class Check:
    test_id: str
    test: str            # "not_null" | "unique" | "unique_combination"
    model: str
    columns: tuple[str, ...]


# The declared data-quality checks (test id, kind, model,
# columns), in declaration order.
CHECKS = (
    Check("D-1", "not_null", "stg_streaming_stock_data", ("symbol",)),
    Check("D-2", "not_null", "stg_streaming_stock_data", ("timestamp",)),
    Check("D-3", "not_null", "stg_sandp500_data", ("date",)),
    Check("D-4", "not_null", "stg_crypto_price_history", ("date",)),
    Check("D-5", "not_null", "stg_crypto_price_history", ("symbol",)),
    Check("D-6", "not_null", "stg_test_realtime_stock_data", ("symbol",)),
    Check("D-7", "not_null", "stg_test_realtime_stock_data", ("timestamp",)),
    Check("D-8", "not_null", "stg_test_realtime_stock_data", ("date",)),
    Check("D-9", "not_null", "stg_test_realtime_stock_data", ("time",)),
    Check("D-10", "unique_combination", "int_daily_stock_summary", ("symbol", "date")),
    Check("D-11", "not_null", "int_daily_stock_summary", ("symbol",)),
    Check("D-12", "not_null", "int_daily_stock_summary", ("date",)),
    Check("D-13", "not_null", "daily_stock_signals", ("symbol",)),
    Check("D-14", "not_null", "daily_stock_signals", ("date",)),
    Check("D-15", "not_null", "date_dim", ("date",)),
    Check("D-16", "unique", "date_dim", ("date",)),
    Check("D-17", "not_null", "dim_stock", ("symbol",)),
    Check("D-18", "unique", "dim_stock", ("symbol",)),
    Check("D-19", "not_null", "stock_feature_mart", ("symbol",)),
    Check("D-20", "unique", "stock_feature_mart", ("symbol",)),
)


# Warning-level checks (logged, never failing a build): inputs whose
# duplicates the models keep on purpose but that fan out left joins.
WARNINGS = (
    Check("W-sp500", "unique", "stg_sandp500_data", ("date",)),
)


def _row(check: Check, failures) -> "F.Column":
    return F.struct(F.lit(check.test_id).alias("test_id"), F.lit(check.test).alias("test"),
                    F.lit(check.model).alias("model"),
                    F.lit(",".join(check.columns)).alias("column_name"),
                    failures.cast("bigint").alias("failures"))


def not_null_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """NULL counts for several columns of one model, one scan."""
    wide = df.agg(*[F.count_if(F.col(c.columns[0]).isNull()).alias(f"_f{i}")
                    for i, c in enumerate(checks)])
    return wide.select(F.inline(F.array(*[_row(c, F.col(f"_f{i}")) for i, c in enumerate(checks)])))


def keyed_counts(df: DataFrame, keys: tuple[str, ...], unique_checks: list[Check],
                 null_checks: list[Check]) -> DataFrame:
    """Uniqueness checks over ``keys`` plus not-null checks of key columns,
    from one grouped count (partial aggregation, one shuffle on the keys).

    ``unique`` ignores NULL keys; ``unique_combination`` counts every
    duplicated combination; a key column's NULL count is the size of the
    groups whose key is NULL.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    aggs = []
    for i, c in enumerate(unique_checks):
        dup = F.col("_n") > 1
        if c.test == "unique":
            dup = dup & F.col(c.columns[0]).isNotNull()
        aggs.append(F.count_if(dup).alias(f"_u{i}"))
    for i, c in enumerate(null_checks):
        aggs.append(F.coalesce(F.sum(F.when(F.col(c.columns[0]).isNull(), F.col("_n"))),
                               F.lit(0)).alias(f"_n{i}"))
    wide = groups.agg(*aggs)
    rows = ([_row(c, F.col(f"_u{i}")) for i, c in enumerate(unique_checks)]
            + [_row(c, F.col(f"_n{i}")) for i, c in enumerate(null_checks)])
    return wide.select(F.inline(F.array(*rows)))


def duplicate_keys(df: DataFrame, check: Check) -> DataFrame:
    """Number of key values occurring more than once (one uniqueness check)."""
    return keyed_counts(df, check.columns, [check], [])


def run_checks(wh, checks=CHECKS) -> DataFrame:
    """Evaluate ``checks`` against the models of ``wh``; one result row each.

    Per model: the uniqueness checks sharing a key set and the not-null
    checks of those key columns take one grouped pass; the remaining
    not-null checks take one global aggregate pass.
    """
    by_model: OrderedDict[str, list[Check]] = OrderedDict()
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    parts: list[DataFrame] = []
    for model, cs in by_model.items():
        df = wh.ref(model)
        nulls = [c for c in cs if c.test == "not_null"]
        by_keys: OrderedDict[tuple[str, ...], list[Check]] = OrderedDict()
        for c in cs:
            if c.test != "not_null":
                by_keys.setdefault(c.columns, []).append(c)
        for keys, uniques in by_keys.items():
            folded = [c for c in nulls if c.columns[0] in keys]
            nulls = [c for c in nulls if c not in folded]
            parts.append(keyed_counts(df, keys, uniques, folded))
        if nulls:
            parts.append(not_null_counts(df, nulls))
    return reduce(DataFrame.unionByName, parts).select(*RESULT_COLS)


def run_checks_stored(wh, root: str, checks=CHECKS) -> DataFrame:
    """As ``run_checks``, with every checked model evaluated once.

    The model is written to ``<root>/<model>`` and pinned, so models that
    build on it start from the stored rows; the NULL counts of its not-null
    checks are observed during that write, and duplicates are counted from
    the stored keys.
    """
    by_model: OrderedDict[str, list[Check]] = OrderedDict()
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    observed, parts = [], []
    for model, cs in by_model.items():
        df, path = wh.ref(model), f"{root.rstrip('/')}/{model}"
        nulls = [c for c in cs if c.test == "not_null"]
        obs = Observation(f"checks of {model}")
        counts = [F.count_if(F.col(c.columns[0]).isNull()).alias(f"_f{i}") for i, c in enumerate(nulls)]
        df.observe(obs, F.count(F.lit(1)).alias("rows"), *counts).write.mode("overwrite").parquet(path)
        got = obs.get
        observed += [(c.test_id, c.test, c.model, ",".join(c.columns), got.get(f"_f{i}", 0)) for i, c in enumerate(nulls)]
        stored = df.sparkSession.read.schema(df.schema).parquet(path)
        wh.pin(model, stored)
        parts += [keyed_counts(stored, c.columns, [c], []) for c in cs if c.test != "not_null"]
    schema = "test_id string, test string, model string, column_name string, failures bigint"
    return reduce(DataFrame.unionByName, parts, wh.spark.createDataFrame(observed, schema)).select(*RESULT_COLS)


def assert_passing(results: DataFrame) -> None:
    """Raise if any check has failures (the result is tiny: one row per check)."""
    failing = results.where(F.col("failures") > 0).collect()
    if failing:
        raise AssertionError("data-quality checks failed: " +
                             ", ".join(f"{r.test_id} {r.test}({r.model}.{r.column_name})={r.failures}"
                                       for r in failing))
