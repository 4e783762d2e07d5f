"""ledgerline — a PySpark-native market-data pipeline.

Layers:

* ``sources``   — raw tables: driver-table adapters, CSV directories, landed
                  JSON responses, tick message streams.
* ``functions`` — column-level helpers (JSON codecs, name sanitiser, time).
* ``operators`` — reusable DataFrame operators (daily OHLCV rollup, top-k,
                  joins, data-quality checks, sinks).
* ``plans``     — the warehouse models as lazy DataFrame functions.
* ``streaming`` — Structured Streaming versions of ingest and rollups.
"""

from ledgerline.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
