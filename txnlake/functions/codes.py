"""Column-level predicates and labels of the transaction model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must equal the reference's for identical results.
# Transaction types, in the order classification tests them.
ACCOUNT_ADJUSTMENT = "Account Adjustment"
CANCELLATION = "Cancellation"
INVENTORY_ADJUSTMENT = "Inventory Adjustment"
ZERO_VALUE = "Zero-Value Transaction"
SALE = "Sale"
# Types given to rows moved out of sales and cancellations by stock code.
ADMINISTRATIVE = "Administrative / Postage"
FINANCIAL_ADJUSTMENT = "Financial Adjustment"
# Reserved stock codes (case-sensitive, tested before trimming).
ADMIN_CODES = ("POST", "DOT", "C2", "PADS")
ADMIN_PREFIX = "gift"
FIN_ADJ_CODES = ("B", "M", "m", "BANK CHARGES", "AMAZONFEE", "S", "D")
FIN_ADJ_PREFIX = "DCG"
CANCELLATION_PREFIX = "C"
# Audit label and the fill value of missing text.
POTENTIAL_DUPLICATE = "Potential Duplicate"
UNKNOWN = "Unknown"
# Product code of lines without a stock code.
MISSING_CODE = "nan"

# Processed-table kinds in the order the loader concatenates them.
KINDS = ("sales", "cancellations", "adjustments", "non_sales")
KIND_RANK = {k: i + 1 for i, k in enumerate(KINDS)}


def is_admin_code(code: Column) -> Column:
    """Postage / administrative codes (null-safe: null code -> false)."""
    return F.coalesce(code.isin(*ADMIN_CODES) | code.startswith(ADMIN_PREFIX), F.lit(False))


def is_fin_adj_code(code: Column) -> Column:
    """Financial-adjustment codes (null-safe: null code -> false)."""
    return F.coalesce(code.isin(*FIN_ADJ_CODES) | code.startswith(FIN_ADJ_PREFIX), F.lit(False))


_WS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace, as Python's str.strip does."""
    return F.btrim(c, F.lit(_WS))
