"""Ranks and running aggregates within keys, for keys of any size.

A window by key alone puts all rows of a key in one task. Here the first order column is cut into pieces of about PIECE_ROWS rows
(from a bounded sample), and the window runs by key and piece: one exchange, and a key with most of the rows is spread over its
pieces. What a (key, piece) adds up to is one small row, added up where the rows are read; a window over those gives what comes
before each piece, and that is joined back by the same struct of key and piece, so the rows aren't shuffled or sorted again. The results are those of ``... OVER (PARTITION BY keys ORDER BY order_by ROWS UNBOUNDED PRECEDING)``.

Rows of one key that are equal in the first order column stay in one piece. NULLs sort first, last with ``desc``, as in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pieces import PIECE_ROWS, cuts, piece_of

RANKS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}
RUNNING = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def _terms(order_by) -> list[tuple[str, bool]]:
    """(column, descending) of each order term: a name, or a pair (name, "desc")."""
    terms = [order_by] if isinstance(order_by, str) else list(order_by)
    out = [(t, False) if isinstance(t, str) else (t[0], t[1] == "desc") for t in terms]
    if not out:
        raise ValueError("an order is needed")
    return out


def running(df: DataFrame, keys: str | Sequence[str], order_by, outputs: dict, piece_rows: int = PIECE_ROWS,
            found: list | None = None) -> DataFrame:
    """``df`` with a column for each of ``outputs``: name -> "row_number", "rank", "dense_rank", or a pair of "sum", "count",
    "min", "max" or "avg" and a column, which runs up to and with the row.

    Rows that tie in the whole order are taken in any order, as in SQL. NULL is a key like any other. Only the cuts are
    computed when this is called; ``found`` gives them, where ``cuts`` of the first order column is known already.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    terms = _terms(order_by)
    first, down = terms[0]
    kind = dict(df.dtypes)[first]
    piece = piece_of(F.col(f"`{first}`"), cuts(df, first, piece_rows) if found is None else found, kind)
    # pieces count up in the order of the rows; NULLs have one of their own at their end
    number = F.coalesce(-piece if down else piece, F.lit((1 << 30) if down else -(1 << 30)))
    # as a struct, whose NULL keys are equal: the window and the join ask for the same distribution and order
    rows = df.withColumn("_at", F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], number.alias("piece")))
    at = Window.partitionBy("_at").orderBy(*[
        F.col(f"`{c}`").desc() if d else F.col(f"`{c}`").asc() for c, d in terms])
    so_far = at.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    within: dict[str, Column] = {}  # what runs within a piece
    total: dict[str, Column] = {}   # what a piece adds up to
    carry: dict[str, str] = {}      # how pieces are put together
    final: dict[str, Column] = {}

    def part(name: str, run: Column, whole: Column, joined: str) -> tuple[Column, Column]:
        within[name], total[name], carry[name] = run, whole, joined
        return F.col(name), F.col(f"_before{name}")

    for i, (name, what) in enumerate(outputs.items()):
        if what in ("row_number", "rank"):
            here, before = part(f"_r{i}", RANKS[what]().over(at), F.count(F.lit(1)), "sum")
            final[name] = here + F.coalesce(before, F.lit(0))
        elif what == "dense_rank":  # a piece has as many places as different rows; equal rows are in one piece
            here, before = part(f"_r{i}", F.dense_rank().over(at), F.count_distinct(F.struct(*[F.col(f"`{c}`") for c, _ in terms])), "sum")
            final[name] = here + F.coalesce(before, F.lit(0))
        elif isinstance(what, tuple) and what[0] == "avg":
            c = F.col(f"`{what[1]}`")
            s, s0 = part(f"_s{i}", F.sum(c).over(so_far), F.sum(c), "sum")
            n, n0 = part(f"_n{i}", F.count(c).over(so_far), F.count(c), "sum")
            number = n + F.coalesce(n0, F.lit(0))
            final[name] = F.when(number > 0, (F.coalesce(s, F.lit(0)) + F.coalesce(s0, F.lit(0))) / number)
        elif isinstance(what, tuple) and what[0] in RUNNING:
            c = F.col(f"`{what[1]}`")
            fn = RUNNING[what[0]]
            here, before = part(f"_a{i}", fn(c).over(so_far), fn(c), "sum" if what[0] in ("sum", "count") else what[0])
            if what[0] in ("sum", "count"):
                both = F.coalesce(here + before, here, before)
            else:
                both = (F.least if what[0] == "min" else F.greatest)(here, before)
            final[name] = both
        else:
            raise ValueError(f"not a rank or a running aggregate: {what!r}")

    ran = rows.withColumns(within)
    sums = rows.groupBy(F.col("_at").alias("_of")).agg(*[c.alias(n) for n, c in total.items()])
    earlier = Window.partitionBy(*[f"_of.k{i}" for i in range(len(keys))]).orderBy("_of.piece").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("_of", *[RUNNING[carry[n]](n).over(earlier).alias(f"_before{n}") for n in total])
    joined = ran.join(before, F.col("_at") == F.col("_of"), "left")
    columns = [c for c in df.columns if c not in final]
    return joined.select(*[F.col(f"`{c}`") for c in columns], *[c.alias(n) for n, c in final.items()])
