"""Demonstration queries on the driver tables, each with its SQL twin."""

from __future__ import annotations


def load_all() -> None:
    from geocadence.catalog import (  # noqa: F401
        alerts_q, grids_q, inventory_q, kernel_q, plans_q, project_q, scenario_q, series_q, sources_q, stream_q, time_q,
    )
