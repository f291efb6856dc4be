"""Flight status, route key and the safe percentage used by the gold views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolake.schema import STATUS_ARRIVED, STATUS_IN_FLIGHT, STATUS_SCHEDULED

# Fixed value: separator of the route key.
ROUTE_SEPARATOR = " -> "


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flight_status(arrival: str | Column, departure: str | Column) -> Column:
    """Arrival recorded wins; else departure recorded; else still scheduled."""
    return (
        F.when(_col(arrival).isNotNull(), F.lit(STATUS_ARRIVED))
        .when(_col(departure).isNotNull(), F.lit(STATUS_IN_FLIGHT))
        .otherwise(F.lit(STATUS_SCHEDULED))
    )


def route_key(origin: str | Column, destination: str | Column) -> Column:
    """``ORIG -> DEST``; NULL when either end is NULL (``concat``, not ``concat_ws``)."""
    return F.concat(_col(origin), F.lit(ROUTE_SEPARATOR), _col(destination))


def pct(numerator: str | Column, denominator: str | Column, digits: int = 1) -> Column:
    """``round(100 * a / nullif(b, 0), 1)`` computed in DOUBLE, NULL when b is 0 or NULL."""
    den = _col(denominator)
    safe = F.when(den != 0, den)
    return F.round(F.lit(100.0) * _col(numerator) / safe, digits)
