"""Genre sets as sorted int arrays and as bit masks.

The genre domain is fixed and small, so a movie's genres fit one int. The
mask lets an aggregation count all genres of a rating without exploding it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelrank.schemas import GENRE_FLAGS, NUM_GENRES


def flags_to_genres(flags: Sequence[Column]) -> Column:
    """One-hot columns -> ascending array of the positions set to 1.

    Flags may be text such as ``1`` or ``1.0``; a flag set beyond the genre domain raises.
    """
    positions = []
    for i, flag in enumerate(flags):
        genre = F.lit(i)
        if i >= NUM_GENRES:
            genre = F.raise_error(F.lit(f"genre id outside 0..{NUM_GENRES - 1}: {i}")).cast("int")
        positions.append(F.when(flag.cast("double").cast("int") == 1, genre))
    return F.array_compact(F.array(*positions))


def genre_mask(genres: Column) -> Column:
    """Genre array -> int with bit g set for every genre g; ids outside the domain raise."""
    message = F.lit(f"genre id outside 0..{NUM_GENRES - 1}: ")

    def bit(g: Column) -> Column:
        known = F.when((g >= 0) & (g < NUM_GENRES), F.call_function("shiftleft", F.lit(1), g))
        return known.otherwise(F.raise_error(F.concat(message, g.cast("string"))).cast("int"))

    return F.aggregate(
        F.filter(genres, lambda g: g.isNotNull()),
        F.lit(0),
        lambda mask, g: mask.bitwiseOR(bit(g)),
    )


def has_genre(genre_id: int, mask: str = "mask") -> str:
    """SQL predicate: the genre is in the mask column.

    Expressions over all 19 genres are SQL text: one parsed expression each,
    rather than a call per node.
    """
    return f"{mask} & {1 << genre_id} != 0"


def genre_hits(counted: str = "true") -> list[Column]:
    """Columns ``g0`` .. ``g18``: rows with the genre among those ``counted``."""
    return [
        F.expr(f"count_if({counted} AND {has_genre(g)}) AS {name}")
        for g, name in enumerate(GENRE_FLAGS)
    ]


def masked_sum(values: Sequence[str], mask: str = "mask") -> Column:
    """Sum of the per-genre columns ``values`` whose genre is in the mask, nulls as 0."""
    terms = [f"IF({has_genre(g, mask)}, coalesce({v}, 0D), 0D)" for g, v in enumerate(values)]
    return F.expr(" + ".join(terms))
