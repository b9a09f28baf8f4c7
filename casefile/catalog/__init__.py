"""Named queries over the test tables, each with its check in SQL where one exists."""

from __future__ import annotations

from casefile.catalog import clusters, evaluate, learn, prepare, profile, sample, series  # noqa: F401
from casefile.catalog.registry import QUERIES, SQL  # noqa: F401
