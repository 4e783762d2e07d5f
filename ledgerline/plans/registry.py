"""Model registry: name -> (function, materialisation, enabled)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Model:
    name: str
    fn: Callable[..., DataFrame]
    materialized: str  # "view" or "table"
    enabled: bool
    layer: str


MODELS: dict[str, Model] = {}


def model(layer: str, materialized: str = "view", enabled: bool = True, name: str | None = None):
    def deco(fn):
        n = name or fn.__name__
        MODELS[n] = Model(n, fn, materialized, enabled, layer)
        return fn
    return deco


def _load_all() -> None:
    # Importing the layer modules fills MODELS.
    from ledgerline.plans import dims, facts, intermediate, marts, staging  # noqa: F401


_load_all()
