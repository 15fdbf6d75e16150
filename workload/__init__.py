"""Registered queries over the given tables, and the SQL that checks them."""

from __future__ import annotations


def catalog() -> dict[str, tuple]:
    from workload import q_io, q_jobs, q_joins, q_pixels, q_scalars, q_vetting  # noqa: F401
    from workload.sqlkit import CATALOG

    return CATALOG
