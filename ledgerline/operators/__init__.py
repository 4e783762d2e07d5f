"""Reusable DataFrame operators: daily rollup, top-k, checked broadcast, sinks, data-quality checks."""
