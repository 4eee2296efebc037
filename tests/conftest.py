import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SOURCE = (
    "transaction_id STRING, transaction_date STRING, posting_date STRING, gl_account STRING, "
    "department STRING, debit_amount DOUBLE, credit_amount DOUBLE, currency STRING, "
    "exchange_rate DOUBLE, approved_by STRING"
)
TARGET = (
    "ledger_transaction_id STRING, debit_amount DOUBLE, credit_amount DOUBLE, gl_account STRING, "
    "department STRING, transaction_date STRING, currency STRING, ledger_status STRING"
)
DAY = "2023-11-01"


def transactions(spark, rows):
    """rows: (id, gl, department, debit, credit, currency, rate, approver)"""
    full = [(r[0], DAY, DAY, r[1], r[2], r[3], r[4], r[5], r[6], r[7]) for r in rows]
    return spark.createDataFrame(full, SOURCE)


def ledger(spark, rows, status="Cleared"):
    """rows: (id, debit, credit)"""
    full = [(r[0], r[1], r[2], "4100", "IT", DAY, "GBP", status) for r in rows]
    return spark.createDataFrame(full, TARGET)


@pytest.fixture(scope="session")
def clean_source(spark):
    return transactions(
        spark,
        [
            ("TXN001", "4100", "Finance", 500.00, 0.0, "GBP", 1.0, "user1"),
            ("TXN002", "4200", "IT", 1200.50, 0.0, "GBP", 1.0, "user2"),
            ("TXN003", "4300", "HR", 750.00, 0.0, "USD", 1.27, "user3"),
            ("TXN004", "4400", "Ops", 300.00, 0.0, "GBP", 1.0, "user4"),
            ("TXN005", "4500", "Sales", 900.00, 0.0, "EUR", 1.15, "user5"),
        ],
    )


@pytest.fixture(scope="session")
def faulty_source(spark):
    return transactions(
        spark,
        [
            ("TXN001", "4100", "Finance", 500.00, 0.0, "GBP", 1.0, "user1"),
            ("TXN001", "4200", "IT", 0.00, 0.0, "GBP", 1.0, "user2"),
            ("TXN003", "INVALID", "HR", -100.00, 0.0, "XYZ", 1.0, "user3"),
            (None, "4400", "Ops", None, None, "GBP", 1.0, "user4"),
            ("TXN005", "4500", "Sales", 15000.00, 0.0, "GBP", 1.0, None),
        ],
    )


@pytest.fixture(scope="session")
def clean_target(spark):
    return ledger(spark, [("TXN001", 500.0, 0.0), ("TXN002", 1200.5, 0.0), ("TXN003", 750.0, 0.0)])


def records(df):
    return [r.asDict() for r in df.collect()]
