"""Inline VALUES sources (A12): reference data shipped as code.

These rows are fixed values that must equal the reference's seeds for the
star schema and analytic answers to agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values (payment types: id, name, description) -------------------
PAYMENT_TYPES = [
    (1, "Credit Card", "Payment made by credit card"),
    (2, "Cash", "Payment made in cash"),
    (3, "No Charge", "No charge trip"),
    (4, "Dispute", "Disputed transaction"),
    (5, "Unknown", "Unknown payment type"),
    (6, "Voided Trip", "Voided trip"),
]

# --- fixed values (vendors: id, name) --------------------------------------
VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "Curb Mobility, LLC"),
    (6, "Myle Technologies Inc"),
    (7, "Helix"),
]

# --- fixed values (rate codes: id, name) -----------------------------------
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Unknown / Null"),
]

# Defaults used by the fact build when the trip carries no code.
UNKNOWN_RATE_CODE = 99
UNKNOWN_PAYMENT_TYPE = 5

_SCHEMAS = {
    "payment_type": "payment_type_id int, payment_type_name string, description string",
    "vendor": "vendor_id int, vendor_name string",
    "rate_code": "rate_code_id int, rate_code_name string",
}
_ROWS = {"payment_type": PAYMENT_TYPES, "vendor": VENDORS, "rate_code": RATE_CODES}


def seed(spark: SparkSession, domain: str) -> DataFrame:
    """The seed rows of one domain as a DataFrame (bounded by construction)."""
    df = spark.createDataFrame(_ROWS[domain], _SCHEMAS[domain])
    df._lakegov_max_rows = len(_ROWS[domain])
    return df


def seed_sql(domain: str) -> str:
    """The same rows as a SQL VALUES list (used by SQL oracles and views)."""
    cols = [c.split()[0] for c in _SCHEMAS[domain].split(", ")]

    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)

    rows = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in _ROWS[domain])
    return f"SELECT * FROM (VALUES {rows}) AS t({', '.join(cols)})"
