"""Session and a sample of ten order lines, with one repeated and two postal codes missing."""

import pytest

from saleslens.operators.cleaning import clean
from saleslens.schema import RAW_SCHEMA
from saleslens.session import local_session

TESTDATA = "/root/testdata"

# Order lines of an invented stationery and camping shop.
# row, order, ordered, shipped, mode, customer, segment, city, state, postal code, region, product,
# category, sub-category, sales, quantity, discount, profit
LINES = [
    ("1", "B-01", "2021-03-04", "2021-03-06", "Courier", "K1", "School", "Alba", "Nordia", "01001", "North", "P1", "Paper", "Pads", "40", "4", "0", "10"),
    ("2", "B-02", "2021-03-09", "2021-03-13", "Courier", "K2", "School", "Alba", "Nordia", "01001", "North", "P2", "Paper", "Pads", "60", "3", "0.1", "12"),
    ("3", "B-03", "2021-03-20", "2021-03-21", "Van", "K3", "Office", "Brix", "Nordia", "01002", "North", "P3", "Tents", "Domes", "500", "1", "0.3", "-50"),
    ("4", "B-04", "2021-07-02", "2021-07-07", "Van", "K4", "Office", "Corra", "Meridia", "02001", "South", "P4", "Tents", "Domes", "300", "2", "0", "90"),
    ("5", "B-05", "2021-07-11", "2021-07-12", "Bike", "K5", "Home", "Corra", "Meridia", None, "South", "P5", "Ink", "Pens", "20", "5", "0.5", "-8"),
    ("6", "B-06", "2021-07-15", "2021-07-18", "Bike", "K6", "Home", "Dorn", "Meridia", None, "South", "P6", "Ink", "Pens", "80", "8", "0", "24"),
    ("7", "B-07", "2022-03-01", "2022-03-04", "Courier", "K7", "School", "Dorn", "Meridia", "02002", "South", "P7", "Paper", "Rolls", "100", "10", "0.2", "5"),
    ("8", "B-08", "2022-03-15", "2022-03-19", "Van", "K8", "Office", "Elm", "Occida", "03001", "West", "P8", "Tents", "Domes", "400", "1", "0.1", "100"),
    ("9", "B-09", "2022-03-30", "2022-04-01", "Courier", "K9", "Home", "Elm", "Occida", "03001", "West", "P9", "Ink", "Bottles", "50", "2", "0.4", "1"),
    ("10", "B-10", "2022-07-07", "2022-07-09", "Courier", "K10", "School", "Fenn", "Occida", "03002", "West", "P10", "Paper", "Rolls", "200", "20", "0", "66"),
]


def sample_rows() -> list[tuple]:
    rows = []
    for line in LINES:
        row, order, ordered, shipped, mode, customer, segment, city, state, postal, region, product, kind, sub, *amounts = line
        name, product_name = f"Name {customer}", f"Item {product}"
        rows.append((row, order, ordered, shipped, mode, customer, name, segment, "Ruritania", city, state, postal, region, product, kind, sub, product_name, *amounts))
    return [*rows, rows[0]]


@pytest.fixture(scope="session")
def spark():
    return local_session(4, memory="4g")


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame(sample_rows(), RAW_SCHEMA)


@pytest.fixture(scope="session")
def lines(spark, raw, tmp_path_factory):
    """The cleaned sample."""
    path = str(tmp_path_factory.mktemp("silver") / "lines")
    clean(raw).write.parquet(path)
    return spark.read.parquet(path)


def make_raw(spark, *changes: dict):
    """Sample-like raw rows, one per dict of changed columns; row numbers count up."""
    from saleslens.schema import RAW_COLUMNS

    base = dict(zip(RAW_COLUMNS, sample_rows()[0], strict=True))
    rows = [{**base, "row_id": str(i), "order_id": f"O{i}", **c} for i, c in enumerate(changes, 1)]
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)


def values(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]
