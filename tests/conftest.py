from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from rollcall.schemas import CRM_RAW, TRANSACTION_RAW

SMALL = "/root/testdata/sf0.001"

MATCH_READY = (
    "normalized_email string, normalized_phone string, first_name string, "
    "last_name string, city string, country string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def crm_raw(spark):
    """Complete rows, missing contacts, compact dates and an older duplicate."""
    return spark.createDataFrame(
        [
            ("C1", "Ann", "Lee", " Ann.Lee@Mail.com", "+447911000001", "1 High St",
             "Leeds", "UK", "2020-01-31", "2024-03-01"),
            ("C1", "Ann", "Lee", "ann.lee@mail.com", "+447911000001", "9 Old St",
             "York", "UK", "2020-01-31", "2023-03-01"),
            ("C2", "Bea", "Roy", "bea@mail.fr", "06 12 00 00 02", None,
             "Nice", "France", "20210615", "20240102"),
            ("C3", "Cal", "Poe", None, "07911 000003", "3 Mill Rd",
             "Leeds", "UK", "2022-02-30", "2024-01-01"),
            ("C4", "Dee", "Fox", None, None, "4 Park Ln",
             "Bath", "UK", "2030-01-01", "2024-01-01"),
            ("C5", "Eve", "Kay", "eve@mail.com", None, None,
             None, None, None, None),
        ],
        CRM_RAW,
    )


@pytest.fixture
def trx_raw(spark):
    """Two purchases by email, one by phone, one by name, one guest, one nobody."""
    return spark.createDataFrame(
        [
            ("T1", "ann.lee@mail.com", "Ann", "Lee", "07911000001", "1 New St",
             "Hull", "UK", "2024-01-10"),
            ("T2", "ANN.LEE@mail.com ", "Anna", "Lee", None, None,
             None, "UK", "20240520"),
            ("T3", "other@mail.com", "Cal", "Poe", "+44 7911 000003", "3 Mill Rd",
             "Hull", "UK", "2023-07-01"),
            ("T4", None, "Dee", "Fox", None, "4 Park Ln", "Bath", "UK", "2024-02-02"),
            ("T5", "guest@mail.com", "Gus", "Tan", "+15550001111", "5 Elm",
             "Rome", "Italy", "bad date"),
            ("T6", None, None, None, None, None, None, None, None),
        ],
        TRANSACTION_RAW,
    )


@pytest.fixture
def customers(spark):
    """Match-ready customers from tuples."""
    return lambda *rows: spark.createDataFrame(
        list(rows), f"customer_id string, {MATCH_READY}"
    )


@pytest.fixture
def transactions(spark):
    """Match-ready transactions from tuples."""
    return lambda *rows: spark.createDataFrame(
        list(rows), f"transaction_id string, {MATCH_READY}"
    )
