"""Wide rows as (row, qualifier, value) cells and back.

Splitting and joining cells is row-local: a row's cells arrive together, so
neither direction shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.functions.messages import parse_cell
from reelrank.schemas import CELL_COLUMNS, CELL_FAMILY, MISSING_CELL


def explode_cells(rows: DataFrame) -> DataFrame:
    """Newline-joined JSON cells -> (row_key, qualifier, value)."""
    cells = F.transform(F.split("value", "\n"), parse_cell)
    return rows.select("row_key", F.inline(cells))


def cell_value(cells: Column, qualifier: str) -> Column:
    hits = F.filter(cells, lambda c: c["qualifier"] == F.lit(qualifier))
    return F.get(hits, F.lit(0))["value"]


def pivot_cells(
    rows: DataFrame,
    columns: Sequence[str] = tuple(CELL_COLUMNS),
    missing: str | None = None,
) -> DataFrame:
    """Cell text -> one column per qualifier; missing cells are null, or the
    ``missing`` text (the stored format writes ``"Null"``)."""
    cells = F.transform(F.split("value", "\n"), parse_cell)
    wide = rows.select("row_key", cells.alias("cells"))
    values = []
    for name in columns:
        value = cell_value(F.col("cells"), name)
        values.append((F.coalesce(value, F.lit(missing)) if missing else value).alias(name))
    return wide.select("row_key", *values)


def pivot_cells_as_stored(rows: DataFrame) -> DataFrame:
    return pivot_cells(rows, missing=MISSING_CELL)


def unpivot_cells(
    ratings: DataFrame, columns: Sequence[str] = tuple(CELL_COLUMNS), family: str = CELL_FAMILY
) -> DataFrame:
    """Rating rows -> ``family:column`` cells with text values."""
    texts = ratings.select(
        "key", *(F.col(c).cast("string").alias(f"{family}:{c}") for c in columns)
    )
    return texts.unpivot("key", [f"{family}:{c}" for c in columns], "qualifier", "value")


def cell_rows(ratings: DataFrame, columns: Sequence[str] = tuple(CELL_COLUMNS)) -> DataFrame:
    """Rating rows -> one text of JSON cells per row; null columns have no cell."""
    cells = [
        F.when(
            F.col(c).isNotNull(),
            F.to_json(
                F.struct(F.lit(c).alias("qualifier"), F.col(c).cast("string").alias("value"))
            ),
        )
        for c in columns
    ]
    return ratings.select(F.col("key").alias("row_key"), F.concat_ws("\n", *cells).alias("value"))
