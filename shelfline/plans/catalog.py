"""Importing this module registers every query."""

from shelfline.plans import customers, features, forecast, frames, inventory, monitoring, profiling, quality, sources, streaming, timeseries  # noqa: F401
from shelfline.plans.registry import ORACLES, QUERIES  # noqa: F401
