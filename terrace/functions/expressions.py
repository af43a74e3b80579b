"""Column expressions shared by the operators (all built-in functions, JVM-side)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: analyzer pattern - runs of letters and digits, matched on lower-cased text.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def lsn_hex(col: Column) -> Column:
    """Binary LSN (or integer) as fixed-width upper-case hex; string order equals
    byte order."""
    return F.lpad(F.hex(col), 20, "0")


def tokenize(text: Column) -> Column:
    """Array of lower-case letter/digit tokens of the whole text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def extended_price(quantity: Column, unit_price: Column) -> Column:
    return quantity * unit_price


def tax_amount(extended: Column, tax_rate: Column) -> Column:
    """Tax rate is a percentage; no rounding per line. Operand order fixes the
    decimal scale of the result."""
    return extended * tax_rate / F.lit(100)


def snake_case(name: str) -> str:
    """``OrderID`` -> ``order_id``, ``LastEditedWhen`` -> ``last_edited_when``."""
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s)
    return re.sub(r"_+", "_", s).strip("_").lower()
