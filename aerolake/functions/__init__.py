"""Column expressions (all built-in Spark functions; no Python UDFs)."""

from aerolake.functions.dates import (
    calendar_parts,
    guarded_date,
    pg_day_name,
    pg_day_of_week,
    pg_month_name,
)
from aerolake.functions.flags import flight_status, pct, route_key
from aerolake.functions.text import normalise_na

__all__ = [
    "calendar_parts", "guarded_date", "pg_day_name", "pg_day_of_week", "pg_month_name",
    "flight_status", "pct", "route_key", "normalise_na",
]
