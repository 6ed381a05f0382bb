"""Previews, sorts, pages and row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions import values
from kerbside.session import pin

# --- fixed values ---
PREVIEW_DEFAULT, PREVIEW_MAX = 50, 500
PREDICTIONS_DEFAULT, PREDICTIONS_MAX = 500, 10_000
PAGE_SIZE = 200
# --- end of fixed values ---

SORT_KEYS = ("_number", "_time", "_text")


def preview(df: DataFrame, limit: int = PREVIEW_DEFAULT) -> DataFrame:
    """Some rows of the frame, 1 to 500 of them."""
    if not 1 <= limit <= PREVIEW_MAX:
        raise ValueError(f"limit must be between 1 and {PREVIEW_MAX}")
    return df.limit(limit)


def first_predictions(scored: DataFrame, limit: int = PREDICTIONS_DEFAULT) -> DataFrame:
    """First rows by road and time, each with the total row count.

    The rows are evaluated once and pinned; the count then reads no columns.
    """
    if not 1 <= limit <= PREDICTIONS_MAX:
        raise ValueError(f"limit must be between 1 and {PREDICTIONS_MAX}")
    scored = pin(scored)
    total = scored.agg(F.count(F.lit(1)).alias("n")).scalar()
    return scored.orderBy("road_name", "recordDatetime").limit(limit).withColumn("row_count", total)


def with_sort_keys(df: DataFrame, column: str) -> DataFrame:
    """Columns ``_number, _time, _text`` by which a column of any content sorts.

    They are a projection of their own, so that a sort compares values and does not parse texts again.
    """
    text, number = values.text_of(df, column), values.number_of(df, column)
    keyed = df.withColumns({"_number": number, "_text": text})
    return keyed.withColumns({"_time": F.when(F.col("_number").isNull(), F.try_to_timestamp("_text")), "_text": F.lower("_text")})


def any_order(descending: bool = False) -> list[Column]:
    """Sort order over ``with_sort_keys``: numbers first by value, then times, then text
    without regard to case; empty values last."""
    keys = [F.col(c) for c in SORT_KEYS]
    return [k.desc_nulls_last() if descending else k.asc_nulls_last() for k in keys]


def number_order(column: str, descending: bool = False) -> Column:
    return F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()


def _numbered(df: DataFrame, order: Sequence[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows numbered 1..n in ``order``, and the sizes of the partitions that hold them.

    The range-sorted rows are pinned, so their partition and place are fixed; adding the sizes
    of the partitions before (one row per partition) gives each row's number.
    """
    placed = pin(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    within = F.col("_place").bitwiseAND((1 << 33) - 1)
    return numbered.withColumn(name, F.col("_offset") + within + 1).drop("_place", "_part", "_offset"), sizes


def with_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Number all rows 1..n in ``order`` without gathering them in one task."""
    return _numbered(df, order, name)[0]


def page_bounds(total: int, page: int, size: int = PAGE_SIZE) -> tuple[int, int, int]:
    """(page, first row, pages): the page held to 1..pages, of which there is at least one."""
    pages = max(1, -(-total // size))
    page = max(1, min(pages, page))
    return page, (page - 1) * size, pages


def page_rows(df: DataFrame, order: Sequence[Column], page: int, size: int = PAGE_SIZE) -> DataFrame:
    """One page of the ordered rows.

    Rows that tie in ``order`` are set in the order of all their columns, so pages neither repeat nor miss
    one. All pages come from one numbering, whose partition sizes also give the total: the
    input is evaluated once, and no task holds everything before the page.
    """
    tail = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    numbered, sizes = _numbered(df, [*order, tail], "_row")
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    _, start, _ = page_bounds(total, page, size)
    return numbered.filter(F.col("_row").between(start + 1, start + size)).orderBy("_row").drop("_row")
