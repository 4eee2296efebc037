"""Business constants. Every one is a parameter: build a ``Rules`` with other values to change it."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field, fields

# --- Fixed values: they decide which rows pass, so they must not be altered. ---
VALID_CURRENCIES = ("GBP", "USD", "EUR")
VALID_LEDGER_STATUSES = ("Cleared", "Open", "Voided")
VALID_GL_ACCOUNTS = (
    "1000", "1100", "1200", "2000", "2100", "3000", "3100",
    "4000", "4100", "4200", "4300", "4400", "4500", "4600",
)
# The rule catalogue (dq_*) is checked against another chart of accounts than the 16 named checks.
VALID_GL_ACCOUNTS_DQ = (
    "4100", "4200", "4300", "5100", "5200", "6000", "6100", "7000", "7100", "8000",
)
VALID_COST_CENTRES = ("CC001", "CC002", "CC003", "CC004", "CC005", "CC006", "CC007", "CC008")
VALID_ENTITIES = ("GB_CORP", "GB_RETAIL", "GB_SERVICES", "IE_CORP", "DE_CORP")
GL_ACCOUNT_NAMES = {
    "1000": "Cash",
    "1100": "Accounts Receivable",
    "1200": "Inventory",
    "2000": "Accounts Payable",
    "2100": "Accrued Liabilities",
    "3000": "Revenue",
    "3100": "Other Income",
    "4000": "COGS",
    "4100": "Salaries",
    "4200": "Rent",
    "4300": "Utilities",
    "4400": "IT Expenses",
    "4500": "Marketing",
    "4600": "Travel",
}
# Cells that a CSV reader with default settings takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
MATCHED = "MATCHED"
MISSING_IN_TARGET = "MISSING_IN_TARGET"
MISSING_IN_SOURCE = "MISSING_IN_SOURCE"
AMOUNT_DISCREPANCY = "AMOUNT_DISCREPANCY"
GREEN_FILL = "C6EFCE"
AMBER_FILL = "F4A300"
RED_FILL = "FFC7CE"
STATUS_FILLS = {
    MISSING_IN_TARGET: "FFC7CE",
    MISSING_IN_SOURCE: "FFEB9C",
    AMOUNT_DISCREPANCY: "FCE4D6",
}
# --- End of fixed values. ---


@dataclass(frozen=True)
class Rules:
    """Thresholds and master lists of one run. All comparisons with limits are strict."""

    currencies: tuple[str, ...] = VALID_CURRENCIES
    ledger_statuses: tuple[str, ...] = VALID_LEDGER_STATUSES
    gl_accounts: tuple[str, ...] = VALID_GL_ACCOUNTS
    gl_accounts_dq: tuple[str, ...] = VALID_GL_ACCOUNTS_DQ
    cost_centres: tuple[str, ...] = VALID_COST_CENTRES
    entities: tuple[str, ...] = VALID_ENTITIES
    gl_names: dict[str, str] = field(default_factory=lambda: dict(GL_ACCOUNT_NAMES))
    home_currency: str = "GBP"
    max_amount: float = 1_000_000.0
    outlier_amount: float = 500_000.0
    approval_amount: float = 10_000.0
    max_posting_lag_days: int = 7
    max_value_lag_days: int = 30
    fiscal_start: dt.date = dt.date(2024, 1, 1)
    fiscal_end: dt.date = dt.date(2024, 12, 31)
    tolerance: float = 0.01
    # "double" compares binary amounts, as money in floating point does: two amounts a cent apart may or may
    # not be further apart than 0.01. "decimal" compares DECIMAL(18,4) amounts, and a cent is a cent.
    amounts: str = "double"
    balance_limit: float = 0.01
    stale_after_days: int = 1
    green_rate_pct: float = 98.0
    date_format: str = "yyyy-M-d"
    # Wall clock: None means the day / moment of the run.
    as_of: dt.date | None = None
    run_ts: dt.datetime | None = None

    def __post_init__(self):
        if self.amounts not in ("double", "decimal"):
            raise ValueError(f"amounts must be 'double' or 'decimal', not {self.amounts!r}")

    def today(self) -> dt.date:
        return self.as_of or dt.date.today()

    def run_stamp(self, fmt: str = "%Y-%m-%d %H:%M:%S") -> str:
        return (self.run_ts or dt.datetime.now()).strftime(fmt)


    @classmethod
    def from_json(cls, text: str) -> Rules:
        """Rules from a JSON object of field names; dates in ISO form, lists for the master lists."""
        given = json.loads(text)
        known = {f.name for f in fields(cls)}
        if unknown := sorted(set(given) - known):
            raise ValueError(f"unknown rules: {', '.join(unknown)}; known are {', '.join(sorted(known))}")
        read = {"as_of": dt.date.fromisoformat, "fiscal_start": dt.date.fromisoformat,
                "fiscal_end": dt.date.fromisoformat, "run_ts": dt.datetime.fromisoformat}
        values = {}
        for name, value in given.items():
            if isinstance(value, list):
                value = tuple(value)
            values[name] = read[name](value) if name in read and value is not None else value
        return cls(**values)


DEFAULT_RULES = Rules()
