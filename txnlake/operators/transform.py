"""Raw lines -> processed lines (the transform stage as one lazy plan)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import classify as C
from . import quality as Q


@dataclass
class Processed:
    """Routed lines (column ``kind`` names the processed table: sales,
    cancellations, adjustments, non_sales) and the potential-duplicate audit
    rows, which keep the signed quantity and the type before routing."""
    lines: DataFrame
    audit: DataFrame

    def kind(self, name: str) -> DataFrame:
        return self.lines.filter(F.col("kind") == name)


def audit_of(lines: DataFrame) -> DataFrame:
    """T8 over routed lines: flagged rows with their pre-routing type and
    signed quantity."""
    return Q.potential_duplicates(lines).withColumns({
        "TransactionType": F.col("OriginalType"),
        "Quantity": F.col("SignedQuantity"),
    })


def transform(raw: DataFrame) -> Processed:
    """Type, classify, drop exact copies, flag near copies, route.

    One shuffle, by invoice: exact copies and groups (invoice, code, quantity)
    both lie within one. Lines without an invoice are dealt by the rest of
    their group. A group is sorted within its task, which may spill.
    """
    typed = C.cast_customer(C.parse_ts(raw))
    # The type follows from the raw columns, so it need not be shuffled.
    flagged = Q.flag_duplicates(typed)
    classified = C.classify(flagged).select(*[c for c in Q.ROW_COLUMNS if c in (*flagged.columns, "TransactionType")],
                                            *[c for c in flagged.columns if c not in Q.ROW_COLUMNS])
    lines = C.route(classified.withColumns({
        "OriginalType": F.col("TransactionType"),
        "SignedQuantity": F.col("Quantity"),
    }))
    return Processed(lines=lines, audit=audit_of(lines))


def from_lines(lines: DataFrame) -> Processed:
    """Processed tables from stored lines."""
    return Processed(lines=lines, audit=audit_of(lines))
