"""Every query of the engine by name, with its SQL where SQL can express it."""

from __future__ import annotations

from sitegrain.plans import places, streams, tables, web, workflow  # noqa: F401  (registers its queries)
from sitegrain.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
