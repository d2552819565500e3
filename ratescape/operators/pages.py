"""Pages of a sorted table: every row is reachable, none by a deep offset.

``write_pages`` keeps a sorted snapshot in which each row has its position and page.
Files hold ranges of positions, so a page is read from the row groups that have it.
``rows_after`` goes on from the last row of a page by its values, also in a later
snapshot with rows added or gone.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratescape.session import materialize

#: Rows of one range of the sort, about; any value gives the same pages.
RANGE_ROWS = 1_000_000
#: monotonically_increasing_id is partition times 2**33 plus the row's place in it.
_PLACE_BITS = 33

Order = list[tuple[str, bool]]


def order_columns(rows: DataFrame, order: Order) -> list[Column]:
    """Sort keys, (name, descending), nulls last; the other columns by name break ties."""
    names = [name for name, _ in order]
    keys = [F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_last() for n, down in order]
    return [*keys, *[F.col(c).asc_nulls_last() for c in sorted(rows.columns) if c not in names]]


def write_pages(rows: DataFrame, order: Order, path: str, size: int, range_rows: int = RANGE_ROWS) -> None:
    """Write ``rows`` with ``position`` and ``page`` (both from 0, long) in the order of ``order``.

    Ties are broken by all other columns, so a key of a third of all rows spreads over
    ranges and pages agree between runs; rows equal in every column are interchangeable.
    Columns named position and page are replaced. No rows give no pages.
    """
    kept = rows.drop("position", "page")
    keys = order_columns(kept, order)
    ranges = kept.count() // range_rows + 1
    # the place is taken after the sort and stored, so that it stays as it is
    placed = kept.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    paged = with_positions(materialize(placed, "sorted"), size)
    paged.select(*kept.columns, "position", "page").sortWithinPartitions("position").write.mode("overwrite").parquet(path)


def with_positions(stored: DataFrame, size: int) -> DataFrame:
    """Stored rows with position and page, from their ``_place``; they stay where they are.

    The first position of each range is sent to them: one row per ``RANGE_ROWS`` rows or so.
    """
    stored = stored.withColumn("_range", F.shiftright("_place", _PLACE_BITS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = stored.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    placed = stored.join(F.broadcast(offsets), "_range").withColumn("position", position)
    return placed.withColumn("page", F.floor(F.col("position") / F.lit(size)).cast("long"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_page(spark: SparkSession, path: str, page: int) -> DataFrame:
    """The rows of a page in order; a page past the end is empty."""
    return read_pages(spark, path).filter(F.col("page") == page).orderBy("position")


def page_index(pages: DataFrame, names: list[str]) -> DataFrame:
    """(page, row_count) with the first and last values of ``names``: where to go on from, without the rows."""
    ends = [F.min_by(n, "position").alias(f"first_{n}") for n in names] + [F.max_by(n, "position").alias(f"last_{n}") for n in names]
    return pages.groupBy("page").agg(F.count(F.lit(1)).alias("row_count"), *ends)


def beyond(order: Order, cursor: dict) -> Column:
    """Rows that sort after the values of ``cursor``; nulls are last.

    The first key's own bound stands apart, so that row groups before it are skipped.
    """

    def same(name: str) -> Column:
        return F.col(name).isNull() if cursor[name] is None else F.col(name) == F.lit(cursor[name])

    def after(name: str, down: bool) -> Column:
        value = F.lit(cursor[name])
        return F.lit(False) if cursor[name] is None else F.col(name).isNull() | ((F.col(name) < value) if down else (F.col(name) > value))

    steps = [reduce(and_, [*(same(n) for n, _ in order[:i]), after(*key)]) for i, key in enumerate(order)]
    return (same(order[0][0]) | after(*order[0])) & reduce(or_, steps)


def rows_after(pages: DataFrame, order: Order, cursor: dict, size: int) -> DataFrame:
    """The next ``size`` rows past those with the values of ``cursor``, a value per column of ``order``.

    ``order`` must tell rows apart (name a key last); rows equal to the cursor are passed over.
    """
    keys = [F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_last() for n, down in order]
    return pages.filter(beyond(order, cursor)).orderBy(*keys).limit(size)
