"""Every operator as a query over the given tables, beside plain SQL with the same answer."""

from __future__ import annotations

from linfit.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    ensembles,
    fitted,
    jobs,
    models,
    rows,
    scans,
    searches,
    tuning,
    vectors,
)
from linfit.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
