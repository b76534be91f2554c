"""Search, sort and page over any table, cells compared as shown text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelake.operators.numbering import with_position

# Rows per page, characters a sort ignores, what counts as a number.
PAGE_SIZE = 10
IGNORED = (
    "[$,%\\s\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]"
)
NUMBER = r"^[+-]?(Infinity|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)$"

# Rows a single task may be asked to keep for one page; pages further in are located by
# position instead.
NEAR_ROWS = 50_000
FEW = 10_000  # rows of a page whose keys are broadcast to fetch it


def _shown(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name).cast("string"), F.lit("")))


def table_search(df: DataFrame, query: str) -> DataFrame:
    """Rows in which every word of ``query`` occurs in some column.

    No word has a blank in it, so joining the columns with blanks cannot make one up, and
    a row is put in lower case once instead of once per column and word.
    """
    words = [word for word in query.lower().split(" ") if word]
    if not words:
        return df
    row = F.lower(F.concat_ws(" ", *[F.col(name).cast("string") for name in df.columns]))
    return df.where(reduce(Column.__and__, [row.contains(word) for word in words]))


def _with_sort_keys(df: DataFrame, name: str) -> DataFrame:
    """Adds ``_number``, null for text cells, and ``_text``, null for number cells.

    As columns, they are worked out once a row; as sort expressions, once a comparison.
    """
    bare = F.regexp_replace(F.coalesce(F.col(name).cast("string"), F.lit("")), IGNORED, "")
    number = F.when(bare.rlike(NUMBER), bare.try_cast("double"))
    return df.withColumn("_number", number).withColumn(
        "_text", F.when(F.col("_number").isNull(), _shown(name))
    )


def _sort_order(ascending: bool, row_key: str) -> list[Column]:
    """Numbers, then text; descending turns both around but not equal cells."""
    if ascending:
        keys = [F.col("_number").asc_nulls_last(), F.col("_text").asc()]
    else:
        keys = [F.col("_number").desc_nulls_first(), F.col("_text").desc()]
    return [*keys, F.col(row_key).asc()]


def table_sort(
    df: DataFrame, name: str, *, row_key: str, ascending: bool = True
) -> DataFrame:
    """``df`` with its place ``pos`` after sorting by ``name``.

    Numbers compare as numbers, other cells as lower-case text. ``row_key`` is unique and
    ascending in the order the rows had before.
    """
    return with_position(
        _with_sort_keys(df, name), *_sort_order(ascending, row_key), keep=df.columns
    )


def table_page(
    df: DataFrame, name: str | None = None, *, row_key: str, ascending: bool = True,
    page: int = 1, size: int = PAGE_SIZE, near_rows: int = NEAR_ROWS,
) -> DataFrame:
    """Rows of one page of ``df``, sorted by ``name`` or left in ``row_key`` order.

    A page near the front is a top-k. One far in would make a single task keep all rows
    before it, so there only the keys are numbered and the page's rows are fetched by them.
    Rows equal in ``row_key`` too come in any order, and each once.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    keyed, order = df, [F.col(row_key).asc()]
    if name is not None:
        keyed, order = _with_sort_keys(df, name), _sort_order(ascending, row_key)
    if page * size <= near_rows:
        found = keyed.orderBy(*order).offset((page - 1) * size).limit(size)
        return found.select(*df.columns)
    places = [row_key] if name is None else ["_number", "_text", row_key]
    ranked = with_position(keyed, *order, keep=places)
    on_page = ranked.where(F.col("pos").between((page - 1) * size + 1, page * size))
    found = on_page.select(*[F.col(c).alias(f"_at{i}") for i, c in enumerate(places)]).distinct()
    if size <= FEW:
        found = F.broadcast(found)

    def fetched(rows: DataFrame) -> DataFrame:
        same = [rows[c].eqNullSafe(found[f"_at{i}"]) for i, c in enumerate(places)]
        return rows.join(found, same, "left_semi")

    # Rows that nothing tells apart share a place; those of them before the page are passed over.
    first = fetched(ranked).agg(F.coalesce(F.min("pos"), F.lit(1))).first()[0]
    skipped = max(0, (page - 1) * size + 1 - first)
    return fetched(keyed).orderBy(*order).offset(skipped).limit(size).select(*df.columns)


def page_count(df: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    return df.agg(F.ceil(F.count(F.lit(1)) / size).alias("pages"))
