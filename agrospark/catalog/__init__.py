"""Registered queries over the driver's tables, each with its SQL twin where SQL can say it."""

from agrospark.catalog import (  # noqa: F401  (importing a section registers its queries)
    sources, normalize, quality, phenology, indices, features, training, models, drift, streaming,
)
from agrospark.catalog.base import REGISTRY

__all__ = ["REGISTRY"]
