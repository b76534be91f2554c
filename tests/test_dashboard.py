import datetime as dt

from pyspark.sql import functions as F

from cratelake.operators import dashboard

END = dt.date(2023, 12, 6)


def _requests(spark):
    rows = [
        ("1", "2023-11-29", True), ("2", "2023-11-30", True), ("2", "2023-12-06", False),
        ("3", "2023-12-06", True), ("4", "2023-12-07", True), ("5", None, None),
    ]
    return spark.createDataFrame(rows, "crate_id string, day string, done boolean").withColumn(
        "day", F.col("day").cast("date")
    )


def test_cards_count_crates_once(spark):
    card = dashboard.kpi_cards(_requests(spark), F.col("done")).first()
    assert tuple(card) == (5, 6, 4)
    assert tuple(dashboard.kpi_cards(_requests(spark).limit(0), F.col("done")).first()) == (0, 0, 0)


def test_every_day_is_present(spark):
    week = dashboard.requests_per_day(_requests(spark), F.col("day"), END).orderBy("day").collect()
    assert [r["n"] for r in week] == [1, 0, 0, 0, 0, 0, 2]
    assert week[0]["day"] == dt.date(2023, 11, 30) and week[-1]["day"] == END


def test_two_series(spark):
    both = dashboard.requested_vs_flagged(
        _requests(spark), F.col("day"), END, F.col("done"), days=1
    )
    assert [tuple(r) for r in both.collect()] == [(END, 2, 1)]


def test_twelve_months(spark):
    year = dashboard.fulfilled_by_month(_requests(spark), F.col("day"), 2023, F.col("done"))
    found = {r["month"]: r["n"] for r in year.collect()}
    assert len(found) == 12 and found[11] == 2 and found[12] == 2 and found[1] == 0
    assert dashboard.series_max(year).first()[0] == 2


def test_shares_add_up(spark):
    share = dashboard.category_share(_requests(spark), "crate_id").collect()
    assert sum(r["share"] for r in share) == 1
    assert {r["crate_id"]: r["n"] for r in share}["2"] == 2
