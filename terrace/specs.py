"""Table specifications: which tables are loaded, their keys and cursors.

A spec is plain data. Composite primary keys are allowed; ``tiebreakers`` extend the
"latest row" ordering past the cursor and the load id so that dedupe always has a
total order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Bookkeeping columns added at load time (row id and load id).
ROW_ID = "_row_id"
LOAD_ID = "_load_id"
BOOKKEEPING = (ROW_ID, LOAD_ID)

# Change-feed metadata columns.
CHANGE_LSN = "change_lsn"
CHANGE_SEQVAL = "change_seqval"
CHANGE_OPERATION = "change_operation"
CHANGE_COLUMNS = (CHANGE_LSN, CHANGE_SEQVAL, CHANGE_OPERATION)

# Change operation codes of the source's change tables.
OP_DELETE = 1
OP_INSERT = 2
OP_UPDATE_BEFORE = 3
OP_UPDATE_AFTER = 4

# Fixed value: a 10-byte LSN as 20 hex characters; the initial watermark sorts first.
INITIAL_LSN = "0" * 20


@dataclass(frozen=True)
class TableSpec:
    """One source table: its landing name, primary key and incremental cursor."""

    name: str
    primary_key: tuple[str, ...]
    cursor: str = "last_edited_when"
    tiebreakers: tuple[str, ...] = field(default_factory=tuple)
    source_schema: str | None = None
    source_table: str | None = None

    def __post_init__(self) -> None:
        if isinstance(self.primary_key, str):
            object.__setattr__(self, "primary_key", (self.primary_key,))
        if isinstance(self.tiebreakers, str):
            object.__setattr__(self, "tiebreakers", (self.tiebreakers,))
        if not self.primary_key:
            raise ValueError(f"{self.name}: a primary key is required")


# The four registered sales tables (landing name, key, cursor).
SALES_TABLES: tuple[TableSpec, ...] = (
    TableSpec("sales_orders", ("order_id",), source_schema="Sales", source_table="Orders"),
    TableSpec(
        "sales_orderlines",
        ("order_line_id",),
        tiebreakers=("stock_item_id",),
        source_schema="Sales",
        source_table="OrderLines",
    ),
    TableSpec("sales_invoices", ("invoice_id",), source_schema="Sales", source_table="Invoices"),
    TableSpec(
        "sales_invoicelines",
        ("invoice_line_id",),
        tiebreakers=("stock_item_id",),
        source_schema="Sales",
        source_table="InvoiceLines",
    ),
)

def spec_by_name(name: str, specs: tuple[TableSpec, ...] = SALES_TABLES) -> TableSpec:
    for spec in specs:
        if spec.name == name:
            return spec
    raise KeyError(name)
