"""The warehouse models as lazy DataFrame functions."""

from ledgerline.plans.registry import MODELS, Model, model

__all__ = ["MODELS", "Model", "model"]
