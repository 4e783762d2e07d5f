from ledgerline.sources.catalog import CatalogSources, TableSources, Warehouse
from ledgerline.sources.fixtures import FixtureSources

__all__ = ["CatalogSources", "FixtureSources", "TableSources", "Warehouse"]
