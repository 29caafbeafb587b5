"""Cutting an axis into pieces of about equal numbers of rows, so that one key's rows can be worked on by several tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_ROWS = 200_000
# Values sampled for each piece, and pieces at most: both bound what the driver sees.
SAMPLED = 20
MAX_PIECES = 16384


def cuts(df: DataFrame, column: str, piece_rows: int = PIECE_ROWS) -> list:
    """Values of ``column`` that part its rows evenly, from a sample of a bounded size; none where one piece is enough."""
    known = df.where(F.col(column).isNotNull())
    total = known.count()
    pieces = min(MAX_PIECES, -(-total // piece_rows))
    if pieces <= 1:
        return []
    share = min(1.0, SAMPLED * pieces / total)
    drawn = F.pmod(F.xxhash64(F.col(column), F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30))
    some = sorted(r[0] for r in known.where(drawn).select(column).limit(2 * SAMPLED * pieces).collect())
    return sorted({some[len(some) * i // pieces] for i in range(1, pieces)}) if some else []


def piece_of(key: Column, found: list, kind: str) -> Column:
    """How many of the cuts are at most the key (NULL for a NULL key), by halving: a look at one cut for each power of two."""
    if not found:
        return F.when(key.isNotNull(), F.lit(0))
    values = F.sort_array(F.lit(found).cast(f"array<{kind}>"))  # a constant, in Spark's order
    steps = [1 << i for i in reversed(range(len(found).bit_length()))]
    # beyond the last cut the look gives NULL, which is not at most the key
    at_most = F.aggregate(F.lit(steps), F.lit(0), lambda n, step: F.when(F.get(values, n + step - 1) <= key, n + step).otherwise(n))
    return F.when(key.isNotNull(), at_most)
