"""The two advisory input schemas: names decide, order and extra columns do not."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: column names and types of the two inputs. ---
_SOURCE = """
transaction_id STRING, transaction_date STRING, posting_date STRING, gl_account STRING,
cost_centre STRING, department STRING, vendor_id STRING, transaction_type STRING,
debit_amount DOUBLE, credit_amount DOUBLE, currency STRING, exchange_rate DOUBLE,
reference_number STRING, description STRING, status STRING, created_by STRING,
approved_by STRING, erp_batch_id STRING
"""
_TARGET = """
ledger_transaction_id STRING, transaction_date STRING, posting_date STRING, gl_account STRING,
cost_centre STRING, department STRING, vendor_id STRING, transaction_type STRING,
debit_amount DOUBLE, credit_amount DOUBLE, currency STRING, exchange_rate DOUBLE,
reference_number STRING, description STRING, status STRING, entered_by STRING,
authorised_by STRING, ledger_batch_id STRING, ledger_entry_date STRING, ledger_status STRING
"""
# --- End of fixed values. ---


def _schema(text: str) -> T.StructType:
    # StructType.fromDDL would need a running session at import time.
    types = {"STRING": T.StringType(), "DOUBLE": T.DoubleType()}
    columns = [c.split() for c in text.split(",")]
    return T.StructType([T.StructField(name, types[kind]) for name, kind in columns])


SOURCE_SCHEMA = _schema(_SOURCE)
TARGET_SCHEMA = _schema(_TARGET)


def number_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]
