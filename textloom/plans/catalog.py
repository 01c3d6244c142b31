"""All queries by name."""

from __future__ import annotations

from textloom.plans import pages, search, texts, training_data
from textloom.plans.common import Query

CATALOG: dict[str, Query] = {**texts.QUERIES, **pages.QUERIES, **search.QUERIES, **training_data.QUERIES}
