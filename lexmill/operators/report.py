"""SNK-12: reports as JSON text and Markdown lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_json(rows: DataFrame) -> DataFrame:
    """One JSON text per row."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json"))


def as_markdown(rows: DataFrame) -> DataFrame:
    """One table line per row."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
