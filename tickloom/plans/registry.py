"""All registered queries and their SQL."""

from __future__ import annotations

from tickloom.plans import certification, events, market, research, streams, vendor  # noqa: F401  importing a module registers its queries


def queries() -> dict:
    return dict(market.FUNCTIONS)


def oracle_sql() -> dict[str, str]:
    return dict(market.SQL)
