"""Transactions and a matching ledger, derived by Spark from the orders and lineitem tables.

The given tables hold no ledger and no bad rows, so both sides and their faults are made from the
order key by modular rules: every row of ``orders`` becomes a transaction, and the ledger is the
same set with other ids, amounts and gaps. The text is SQL that Spark and DuckDB both accept: it
defines the inputs of the registered queries on the one side and heads their oracle SQL on the
other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from .params import Rules
from .schemas import SOURCE_SCHEMA, TARGET_SCHEMA

# Rules of the registered queries: a fixed clock and the fiscal year that the data spans.
FIXTURE_RULES = Rules(
    as_of=dt.date(2001, 7, 1),
    run_ts=dt.datetime(2001, 7, 1),
    fiscal_start=dt.date(1998, 1, 1),
    fiscal_end=dt.date(1998, 12, 31),
)

SOURCE_TRANSACTIONS = """
SELECT CASE WHEN k % 997 = 0 THEN NULL WHEN k % 101 = 0 THEN concat('TXN', CAST(k - 1 AS STRING)) ELSE concat('TXN', CAST(k AS STRING)) END AS transaction_id,
  CASE WHEN k % 241 = 0 THEN NULL ELSE d END AS transaction_date,
  d + CAST(k % 11 - 1 AS INT) AS posting_date,
  d - CAST(k % 37 AS INT) AS value_date,
  CASE WHEN k % 163 = 0 THEN NULL WHEN k % 157 = 0 THEN '9999' WHEN k % 5 = 0 THEN '1000' WHEN k % 5 = 1 THEN '2100' WHEN k % 5 = 2 THEN '4100' WHEN k % 5 = 3 THEN '4200' ELSE '4300' END AS gl_account,
  CASE WHEN k % 167 = 0 THEN 'CC999' ELSE concat('CC00', CAST(k % 8 + 1 AS STRING)) END AS cost_centre,
  CASE WHEN k % 4 = 0 THEN 'Finance' WHEN k % 4 = 1 THEN 'IT' WHEN k % 4 = 2 THEN 'HR' ELSE 'Sales' END AS department,
  CASE WHEN k % 89 = 0 THEN NULL WHEN k % 97 = 0 THEN '' ELSE concat('V', CAST(k % 50 AS STRING)) END AS vendor_id,
  CASE WHEN k % 3 = 0 THEN 'INVOICE' WHEN k % 3 = 1 THEN 'JOURNAL' ELSE 'PAYMENT' END AS transaction_type,
  CASE WHEN k % 431 = 0 THEN NULL WHEN k % 401 = 0 THEN 0.0 WHEN k % 409 = 0 THEN p WHEN k % 419 = 0 THEN -p WHEN k % 2 = 0 THEN p ELSE 0.0 END AS debit_amount,
  CASE WHEN k % 401 = 0 THEN 0.0 WHEN k % 409 = 0 THEN p WHEN k % 419 = 0 THEN 0.0 WHEN k % 2 = 0 THEN 0.0 ELSE p END AS credit_amount,
  CASE WHEN k % 151 = 0 THEN NULL WHEN k % 149 = 0 THEN 'XYZ' WHEN k % 3 = 0 THEN 'GBP' WHEN k % 3 = 1 THEN 'USD' ELSE 'EUR' END AS currency,
  CAST(CASE WHEN k % 179 = 0 THEN NULL WHEN k % 173 = 0 THEN 1.1 WHEN k % 3 = 0 THEN 1.0 WHEN k % 3 = 1 THEN 1.27 ELSE 1.15 END AS DOUBLE) AS exchange_rate,
  concat('REF', CAST(k AS STRING)) AS reference_number,
  concat('order ', CAST(k AS STRING)) AS description,
  CASE WHEN k % 10 = 0 THEN 'PENDING' ELSE 'POSTED' END AS status,
  CASE WHEN k % 211 = 0 THEN NULL WHEN k % 223 = 0 THEN '' ELSE 'user1' END AS created_by,
  CASE WHEN k % 83 = 0 THEN NULL ELSE 'mgr1' END AS approved_by,
  CASE WHEN k % 53 = 0 THEN concat('S', CAST(k AS STRING)) ELSE concat('B', CAST(CAST(floor(k / 4) AS BIGINT) AS STRING)) END AS erp_batch_id,
  CASE WHEN k % 181 = 0 THEN 'XX_BAD' WHEN k % 5 = 0 THEN 'GB_CORP' WHEN k % 5 = 1 THEN 'GB_RETAIL' WHEN k % 5 = 2 THEN 'GB_SERVICES' WHEN k % 5 = 3 THEN 'IE_CORP' ELSE 'DE_CORP' END AS entity
FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d,
             CASE WHEN o_orderkey % 307 = 0 THEN round(o_totalprice * 3, 2) ELSE o_totalprice END AS p
      FROM orders) b
"""

TARGET_LEDGER = """
SELECT CASE WHEN k % 991 = 0 THEN NULL WHEN k % 127 = 0 THEN concat('LED', CAST(k AS STRING)) WHEN k % 131 = 0 THEN concat('TXN', CAST(k - 1 AS STRING)) ELSE concat('TXN', CAST(k AS STRING)) END AS ledger_transaction_id,
  concat('L', CAST(CASE WHEN k % 139 = 0 THEN k - 1 ELSE k END AS STRING)) AS ledger_id,
  d AS transaction_date,
  d + CAST(k % 11 - 1 AS INT) AS posting_date,
  CASE WHEN k % 5 = 0 THEN '1000' WHEN k % 5 = 1 THEN '2100' WHEN k % 5 = 2 THEN '4100' WHEN k % 5 = 3 THEN '4200' ELSE '4300' END AS gl_account,
  CASE WHEN k % 4 = 0 THEN 'Finance' WHEN k % 4 = 1 THEN 'IT' WHEN k % 4 = 2 THEN 'HR' ELSE 'Sales' END AS department,
  CASE WHEN k % 3 = 0 THEN 'GBP' WHEN k % 3 = 1 THEN 'USD' ELSE 'EUR' END AS currency,
  CASE WHEN k % 397 = 0 THEN 0.0 WHEN k % 2 = 0 THEN p + e ELSE 0.0 END AS debit_amount,
  CASE WHEN k % 397 = 0 THEN 0.0 WHEN k % 2 = 0 THEN 0.0 ELSE p + e END AS credit_amount,
  CASE WHEN k % 103 = 0 THEN NULL WHEN k % 107 = 0 THEN 'Unknown' WHEN k % 3 = 0 THEN 'Cleared' WHEN k % 3 = 1 THEN 'Open' ELSE 'Voided' END AS ledger_status
FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d,
             CASE WHEN o_orderkey % 307 = 0 THEN round(o_totalprice * 3, 2) ELSE o_totalprice END AS p,
             CAST(CASE WHEN o_orderkey % 59 = 0 THEN 0.05 WHEN o_orderkey % 61 = 0 THEN 0.005 ELSE 0.0 END AS DOUBLE) AS e
      FROM orders WHERE o_orderkey % 113 <> 0) b  -- the gaps of the ledger: these ids are MISSING_IN_TARGET
"""

DQ_SOURCE = """
SELECT *, debit_amount - credit_amount + CASE WHEN CAST(substr(reference_number, 4) AS BIGINT) % 421 = 0 THEN 1.0 ELSE 0.0 END AS net_amount,
  erp_batch_id AS batch_id
FROM source_transactions
"""

DQ_TARGET = """
SELECT *, ledger_transaction_id AS source_ref, debit_amount - credit_amount AS net_amount FROM target_ledger
"""

# A third of all rows, on both sides, share one id, with as many amounts as there are orders;
# every 7th row is a copy of one amount. The other rows have their own id.
HOT_SOURCE = """
SELECT CASE WHEN k % 3 = 0 THEN 'TXN-HOT' ELSE concat('TXN', CAST(k AS STRING)) END AS transaction_id,
  CASE WHEN k % 431 = 0 THEN NULL WHEN k % 7 = 0 THEN 500.0 WHEN k % 2 = 0 THEN p ELSE 0.0 END AS debit_amount,
  CASE WHEN k % 7 = 0 OR k % 2 = 0 THEN 0.0 ELSE p END AS credit_amount,
  CASE WHEN k % 163 = 0 THEN NULL WHEN k % 5 = 0 THEN '1000' WHEN k % 5 = 1 THEN '2100' ELSE '4100' END AS gl_account
FROM (SELECT o_orderkey AS k, o_totalprice AS p FROM orders) b
"""

HOT_LEDGER = """
SELECT CASE WHEN k % 3 = 0 THEN 'TXN-HOT' ELSE concat('TXN', CAST(k AS STRING)) END AS ledger_transaction_id,
  CASE WHEN k % 7 = 0 THEN 500.0 WHEN k % 2 = 0 THEN p + e ELSE 0.0 END AS debit_amount,
  CASE WHEN k % 439 = 0 THEN NULL WHEN k % 7 = 0 OR k % 2 = 0 THEN 0.0 ELSE p + e END AS credit_amount
FROM (SELECT o_orderkey AS k, o_totalprice AS p,
             CAST(CASE WHEN o_orderkey % 59 = 0 THEN 0.05 WHEN o_orderkey % 61 = 0 THEN 0.005 ELSE 0.0 END AS DOUBLE) AS e
      FROM orders) b
"""

# Order lines as transactions: ids repeat naturally, an order is a batch.
LINE_SOURCE = """
SELECT concat('TXN', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS transaction_id,
  CAST(l_shipdate AS DATE) AS posting_date,
  CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0.0 END AS debit_amount,
  CASE WHEN l_linestatus = 'F' THEN 0.0 ELSE l_extendedprice END AS credit_amount,
  CASE WHEN l_returnflag = 'N' THEN 'JOURNAL' ELSE 'INVOICE' END AS transaction_type,
  CAST(l_orderkey AS STRING) AS batch_id
FROM lineitem
"""

# Both inputs as a CSV reader sees them: text in every documented column and one more, with spellings of
# missing values, numbers in many forms, and cells that are no numbers.
_BAD_CELL = (
    "CASE WHEN {n} % 29 = 0 THEN 'n/a' WHEN {n} % 31 = 0 THEN '12d' WHEN {n} % 37 = 0 THEN '1e3' WHEN {n} % 41 = 0 THEN '.5' "
    "WHEN {n} % 43 = 0 THEN '1,000' WHEN {n} % 47 = 0 THEN 'inf' WHEN {n} % 53 = 0 THEN '-2.5E-1' WHEN {n} % 59 = 0 THEN '' "
    "WHEN {n} % 61 = 0 THEN '+7.' ELSE {cell} END"
)
_BAD_TEXT = "CASE WHEN {n} % 67 = 0 THEN 'NULL' WHEN {n} % 71 = 0 THEN '#N/A' WHEN {n} % 73 = 0 THEN 'say \"hi\", twice' ELSE {cell} END"


def _raw(base: str, number: str, columns: dict[str, str], numbers: tuple[str, ...], spoilt: tuple[str, ...]) -> str:
    cells = []
    for i, (name, cell) in enumerate(columns.items()):
        text = f"CAST({cell} AS STRING)"
        if name in numbers or name in spoilt:
            text = (_BAD_CELL if name in numbers else _BAD_TEXT).format(n=f"(n + {i})", cell=text)
        cells.append(f"{text} AS {name}")
    return f"SELECT {', '.join(cells)}\nFROM (SELECT *, {number} AS n FROM {base}) b"


_NUMBERS = ("debit_amount", "credit_amount", "exchange_rate")
_SAME = ("transaction_date", "posting_date", "gl_account", "department", "debit_amount", "credit_amount", "currency")
RAW_SOURCE = _raw(
    "source_transactions",
    "CAST(substr(reference_number, 4) AS BIGINT)",
    {c: c for c in (*SOURCE_SCHEMA.names, "entity")},
    _NUMBERS,
    ("department", "description", "vendor_id", "status", "approved_by"),
)
RAW_LEDGER = _raw(
    "target_ledger",
    "CAST(substr(ledger_id, 2) AS BIGINT)",
    {
        "ledger_transaction_id": "ledger_transaction_id",
        **{c: c for c in _SAME},
        "ledger_status": "ledger_status",
        "exchange_rate": "1.25",
        **{c: f"concat('{c[0].upper()}', CAST(n % 17 AS STRING))" for c in TARGET_SCHEMA.names
           if c not in ("ledger_transaction_id", "ledger_status", "exchange_rate", *_SAME)},
        "ledger_id": "ledger_id",
    },
    _NUMBERS,
    ("department", "description", "entered_by", "ledger_status"),
)

# Master lists that grow with the tables and repeat codes: ids of shipped orders, with and without a null.
MASTER_LIST = "SELECT concat('TXN', CAST(l_orderkey AS STRING)) AS code FROM lineitem WHERE l_linestatus = 'F'"
MASTER_LIST_NULL = """
SELECT CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE concat('TXN', CAST(l_orderkey AS STRING)) END AS code
FROM lineitem
"""

# A ledger that is off by exactly a cent, a little more, or not at all; some amounts are missing.
CENT_LEDGER = """
SELECT ledger_transaction_id, transaction_date, gl_account, department, currency,
  CASE WHEN n % 7 = 0 THEN NULL WHEN n % 3 = 0 THEN debit_amount + 0.01 WHEN n % 3 = 1 THEN debit_amount - 0.0101 ELSE debit_amount END AS debit_amount,
  CASE WHEN n % 5 = 0 THEN credit_amount - 0.01 WHEN n % 5 = 1 THEN credit_amount + 0.0101 ELSE credit_amount END AS credit_amount
FROM (SELECT *, CAST(substr(ledger_id, 2) AS BIGINT) AS n FROM target_ledger) b
"""

VIEWS = {
    "source_transactions": SOURCE_TRANSACTIONS,
    "target_ledger": TARGET_LEDGER,
    "dq_source": DQ_SOURCE,
    "dq_target": DQ_TARGET,
    "hot_source": HOT_SOURCE,
    "hot_ledger": HOT_LEDGER,
    "line_source": LINE_SOURCE,
    "raw_source": RAW_SOURCE,
    "raw_ledger": RAW_LEDGER,
    "master_list": MASTER_LIST,
    "master_list_null": MASTER_LIST_NULL,
    "cent_ledger": CENT_LEDGER,
}
# The view each view is defined over; the others read a given table.
_BASE = {"dq_source": "source_transactions", "dq_target": "target_ledger", "cent_ledger": "target_ledger",
         "raw_source": "source_transactions", "raw_ledger": "target_ledger"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """View ``name`` over the parquet tables in ``sf_dir``; a lazy plan, nothing is registered."""
    base = _BASE.get(name)
    if base is None:
        base = "lineitem" if "FROM lineitem" in VIEWS[name] else "orders"
        over = spark.read.parquet(f"{sf_dir}/{base}.parquet")
    else:
        over = view(spark, sf_dir, base)
    text = VIEWS[name].replace(f"FROM {base}", "FROM {base}")
    return spark.sql(text, base=over)


def with_views(names: list[str], query: str) -> str:
    """``query`` headed by the views it uses, for an engine that has the given tables."""
    needed = []
    for name in names:
        for v in (_BASE.get(name), name):
            if v and v not in needed:
                needed.append(v)
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in needed) + "\n" + query
