import pytest

from cratelake import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def rows(spark):
    """DataFrame of text rows: first the column names, then the values."""
    def make(names, *values):
        schema = ", ".join(f"{n} string" if " " not in n else n for n in names)
        return spark.createDataFrame(list(values), schema)

    return make


@pytest.fixture
def crate():
    """A valid crate record; keyword arguments replace fields."""
    from cratelake.model import CRATE_FIELDS

    def make(**fields):
        record = {
            "crate_id": "000123", "customer_id": "CUST007", "customer_name": "Ann Ö",
            "delivery_address": "1 Main St", "city": "Mesa", "state": "Arizona",
            "delivery_date": "2023-12-01", "delivery_time": "10:20:30",
            "return_date": "2023-12-08", "return_time": "08:15",
            "contents": "Canned Goods, Pasta", "batch_order_number": "ORD001",
            "transportation_details": "Truck - Refrigerated", "return_status": "Returned",
            "qr_code_generation_date": "2023-12-01", "additional_notes": "Fragile",
            "temperature": "3.45 C", "weight": "250.00 kg", "expiration_date": "2023-12-08",
            "handling_instructions": "Handle with care", "shipment_status": "Delivered",
            "company_name": "Depot Ltd", "creation_date": "2023-12-01", **fields,
        }
        return tuple(record[name] for name in CRATE_FIELDS)

    return make
