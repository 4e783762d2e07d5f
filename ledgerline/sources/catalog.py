"""Raw-table resolvers and the model context (``source`` / ``ref``)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.feeds import is_feed_table, read_batches

Resolver = Callable[[str], DataFrame]


class TableSources:
    """Raw tables stored as ``<root>/<name>`` in a file format (default parquet);
    a feed table's folders are read together, whoever wrote them."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet",
                 options: Mapping[str, str] | None = None):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.options = dict(options or {})

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if self.fmt == "parquet" and is_feed_table(self.spark, path):
            return read_batches(self.spark, path)
        return self.spark.read.format(self.fmt).options(**self.options).load(path)


class CatalogSources:
    """Raw tables registered in the session catalog (``db.name``)."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark, self.database = spark, database

    def __call__(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}" if self.database else name)


class Warehouse:
    """Resolves raw tables and models lazily, memoising each DataFrame.

    A model is a function ``model(wh) -> DataFrame`` that calls
    ``wh.source(raw)`` and ``wh.ref(other_model)``; nothing executes until an
    action, so stacked views collapse into one Catalyst plan.  Reusing the
    same DataFrame object for a ref lets Spark reuse its exchanges when a
    model is consumed twice in one plan.
    """

    def __init__(self, spark: SparkSession, sources: Resolver,
                 models: Mapping[str, Callable[["Warehouse"], DataFrame]] | None = None,
                 include_disabled: bool = True, params: Mapping[str, object] | None = None):
        from ledgerline.plans.registry import MODELS
        self.spark = spark
        self.params = dict(params or {})
        self._sources = sources
        self._models = dict(models or {n: m.fn for n, m in MODELS.items()
                                        if include_disabled or m.enabled})
        self._src_cache: dict[str, DataFrame] = {}
        self._ref_cache: dict[str, DataFrame] = {}
        self._overrides: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._src_cache:
            self._src_cache[name] = self._sources(name)
        return self._src_cache[name]

    def ref(self, name: str) -> DataFrame:
        if name in self._overrides:
            return self._overrides[name]
        if name not in self._ref_cache:
            if name not in self._models:
                raise KeyError(f"unknown or disabled model {name!r}")
            self._ref_cache[name] = self._models[name](self)
        return self._ref_cache[name]

    def param(self, name: str, default=None):
        """Model parameter (e.g. ``economy_country``)."""
        return self.params.get(name, default)

    def pin(self, name: str, df: DataFrame) -> None:
        """Make ``ref(name)`` return ``df`` (e.g. a materialised table)."""
        self._overrides[name] = df

    def register_views(self, names=None) -> list[str]:
        """Register models (default: all) as temporary views, so they can be
        queried with ``spark.sql``; the views stay lazy."""
        done = []
        for name in names or self._models:
            self.ref(name).createOrReplaceTempView(name)
            done.append(name)
        return done

    @property
    def resolver(self) -> Resolver:
        """The raw-table resolver this warehouse reads from."""
        return self._sources

    @property
    def model_names(self) -> list[str]:
        return list(self._models)
