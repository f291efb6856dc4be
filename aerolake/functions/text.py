"""Text-value normalisation for bronze."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolake.schema import NA_TOKENS


def normalise_na(c: str | Column, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    """NULL for the missing-value tokens a pandas reader would also turn into NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~col.isin(list(tokens)), col)


def normalise_na_sql(column: str, tokens: tuple[str, ...] = NA_TOKENS) -> str:
    """SQL text of ``normalise_na`` (one string per column keeps wide projections cheap)."""
    quoted = ", ".join("'" + t.replace("'", "''") + "'" for t in tokens)
    name = "`" + column.replace("`", "``") + "`"
    return f"CASE WHEN {name} IN ({quoted}) THEN NULL ELSE {name} END AS {name}"
