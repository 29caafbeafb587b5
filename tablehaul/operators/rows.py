"""Row windows: previews, pages, a LIMIT kept inside a derived table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .partition import partition_assign

# Preview rows per stage, and the export page size.
PREVIEW_ROWS = 5
PAGE_ROWS = 100_000


def _keys(order_by) -> list[str]:
    if not order_by:
        raise ValueError("an order is needed")
    return [order_by] if isinstance(order_by, str) else list(order_by)


def _total_order(df: DataFrame, order_by) -> list:
    """The keys, then every other column: rows that tie in it are equal rows."""
    keys = _keys(order_by)
    return [F.col(f"`{c}`") for c in [*keys, *(c for c in df.columns if c not in keys)]]


def head(df: DataFrame, n: int = PREVIEW_ROWS, order_by=None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` the n smallest keys (per-task top-n, then merge)."""
    return (df if order_by is None else df.orderBy(*_keys(order_by))).limit(n)


def page(df: DataFrame, order_by, offset: int = 0, n: int = PAGE_ROWS, after=None) -> DataFrame:
    """One page of ``n`` rows in a total order: ``order_by``, then all other columns.

    One path for every size, and nothing runs before an action: a top-k per task, merged. Equal orders on
    every page mean that consecutive pages neither repeat nor lose a row.

    A reader that walks through a large table passes ``after``, the ``order_by`` values of the last row of
    the page before (keyset paging): the comparison is pushed into the scan and each page costs a top-n
    of ``n`` rows, however deep it lies. ``order_by`` must then be a key. ``offset`` counts rows instead; each task then
    ranks ``offset + n`` rows, which suits browsing the first pages. Deep pages, or many of them, come from a
    ``pages.PageIndex``, which is written once and reads one or two ranges for any page. A whole table is exported by a sink.
    """
    if offset < 0 or n < 0:
        raise ValueError("offset and n must be >= 0")
    keys = _keys(order_by)
    if after is not None:
        values = [after] if len(keys) == 1 and not isinstance(after, (tuple, list)) else list(after)
        if len(values) != len(keys):
            raise ValueError("after needs one value per order column")
        later = F.lit(False)
        for k, v in reversed(list(zip(keys, values))):  # lexicographic comparison
            later = (F.col(f"`{k}`") > F.lit(v)) | ((F.col(f"`{k}`") == F.lit(v)) & later)
        # implied by the comparison, and simple enough for the scan
        df = df.where((F.col(f"`{keys[0]}`") >= F.lit(values[0])) & later)
    return df.orderBy(*_total_order(df, order_by)).offset(offset).limit(n)


def limit_then_partition(df: DataFrame, limit: int, order_by, column: str, n: int,
                         part_col: str = "part") -> DataFrame:
    """``LIMIT`` inside the derived table, then the range parts of ``column`` over it.

    The limited table follows a total order and is written when this is called, so its bounds and its parts see the same
    rows: up to PAGE_ROWS rows by a top-k per task, merged; more by a page index, of which whole ranges and a part of
    one are taken, so that no task merges them. Bounds are the floored MIN/MAX of the limited rows; NULL rows are dropped.
    """
    from ..session import ensure_checkpoint_dir, scratch_path
    from .pages import PageIndex
    from .partition import check_numeric

    spark = df.sparkSession
    check_numeric(df, column)
    if limit <= PAGE_ROWS:
        ensure_checkpoint_dir(spark)
        limited = df.orderBy(*_total_order(df, order_by)).limit(limit).checkpoint()
    else:
        limited = PageIndex.build(df, _keys(order_by), scratch_path(spark, "limit", unique=True)).first(limit)
    return partition_assign(limited, column, n, part_col=part_col)
