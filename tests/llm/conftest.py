import pytest

from cratelake.llm.ship import ship

AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, key string, n long, label int, spans int, _part int"


@pytest.fixture
def docs(spark):
    """Documents with columns whose names clash with those operators use inside."""
    ship(spark)

    def make(*rows):
        full = [(*r, *[None] * (4 - len(r)), 0, "k", 1, 2, 3, 4) for r in rows]
        return spark.createDataFrame(full, AWKWARD)

    return make


@pytest.fixture
def labels(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, text string")
