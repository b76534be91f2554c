import random

import pytest
from pyspark.sql import functions as F

from cratelake.operators import browse
from cratelake.operators.numbering import with_position


@pytest.fixture(scope="module")
def table(spark):
    cells = ["10", "$1,200", "9 %", " 1e2 ", "Apple", "apple", "banana", "", None, "-.5", "7.",
             "0x10", "1d", "Infinity", "12 kg", "NaN"]
    return spark.createDataFrame(list(enumerate(cells)), "id int, cell string")


def _cells(df):
    return [r["cell"] for r in df.orderBy("pos").collect()]


def test_numbers_come_before_text(table):
    assert _cells(browse.table_sort(table, "cell", row_key="id")) == [
        "-.5", "7.", "9 %", "10", " 1e2 ", "$1,200", "Infinity",
        "", None, "0x10", "12 kg", "1d", "Apple", "apple", "banana", "NaN",
    ]


def test_descending_turns_both_parts_but_not_ties(table):
    assert _cells(browse.table_sort(table, "cell", row_key="id", ascending=False)) == [
        "NaN", "banana", "Apple", "apple", "1d", "12 kg", "0x10", "", None,
        "Infinity", "$1,200", " 1e2 ", "10", "9 %", "7.", "-.5",
    ]


@pytest.mark.parametrize("query, found", [
    ("", 3), ("ANN", 2), ("ann mesa", 1), ("mesa ann", 1), ("5 x", 0), ("ann  tempe", 1), (" ", 3),
])
def test_search(spark, query, found):
    df = spark.createDataFrame(
        [(1, "Ann", "Mesa"), (5, "Joanne", "Tempe"), (7, None, "Mesa")],
        "id int, name string, city string",
    )
    assert browse.table_search(df, query).count() == found


@pytest.mark.parametrize("near_rows", [browse.NEAR_ROWS, 0])
def test_pages_cover_the_table_in_order(spark, near_rows):
    df = spark.range(23).selectExpr("id", "id % 3 AS g")
    expected = sorted(range(23), key=lambda i: (i % 3, i))
    seen = []
    for page in range(1, browse.page_count(df).first()["pages"] + 1):
        rows = browse.table_page(df, "g", row_key="id", page=page, near_rows=near_rows).collect()
        assert len(rows) <= browse.PAGE_SIZE
        seen += [r["id"] for r in rows]
    assert seen == expected
    assert browse.table_page(df, "g", row_key="id", page=4, near_rows=near_rows).count() == 0


def test_page_starts_at_one(spark):
    with pytest.raises(ValueError):
        browse.table_page(spark.range(3), "id", row_key="id", page=0)


def test_position_with_a_value_most_rows_share(spark):
    order = list(range(5000))
    random.Random(1).shuffle(order)
    df = spark.createDataFrame([(i, "hot" if i % 10 else "cold") for i in order], "id int, v string")
    found = with_position(df.repartition(8), "v", "id").orderBy("pos").collect()
    assert [r["pos"] for r in found] == list(range(1, 5001))
    assert [r["id"] for r in found] == sorted(range(5000), key=lambda i: (i % 10 > 0, i))


def test_position_of_an_empty_table(spark):
    assert with_position(spark.range(0), "id").count() == 0


@pytest.mark.parametrize("page", [1, 2, 4, 5])
@pytest.mark.parametrize("name", ["cell", None])
def test_pages_agree_near_and_far_where_keys_repeat(spark, name, page):
    df = spark.range(40).select((F.col("id") % 10).alias("key"), (F.col("id") % 3).cast("string").alias("cell"))
    near, far = (
        [tuple(r) for r in browse.table_page(df, name, row_key="key", page=page, near_rows=n).collect()]
        for n in (50_000, 0)
    )
    assert len(far) == (10 if page < 5 else 0)
    if name:
        assert near == far
    else:
        assert [r[0] for r in near] == [r[0] for r in far]
