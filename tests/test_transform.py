"""Classification, routing and duplicate rules (FIXTURES.md sections 2 and 3)."""

from decimal import Decimal

from builders import line, raw_rows
from pyspark.sql import functions as F

from txnlake.operators import quality as Q
from txnlake.operators.transform import transform
from txnlake.plans.warehouse import build

ROWS = [
    line("536365", "85123A", 6, 2.55, 17850),        # 1 sale
    line("C536379", "22556", -12, 1.65, 14527),      # 2 cancellation
    line("C536380", "D", -1, 27.50, 14527),          # 3 cancelled fin. adjustment
    line("C536381", "POST", -1, 18.00, 14527),       # 4 cancelled postage
    line("A563186", "B", 1, -11062.06, None),        # 5 account adjustment
    line("C900001", "B", 1, -5.00, None),            # 6 price sign before C prefix
    line("536414", "22139", -56, 0.00, None),        # 7 inventory adjustment
    line("536415", "22139", -56, 0.00, 12345),       # 8 sale (catch-all)
    line("536416", "22139", 5, 0.00, None),          # 9 zero-value
    line("536417", "22139", 0, 0.00, None),          # 10 sale (catch-all)
    line("536418", "22139", 3, None, 12345),         # 11 sale, null revenue
    line("536419", "gift_0001_20", 1, 16.67, None),  # 12 non-sale by prefix
    line("536420", "GIFT_0001_20", 1, 16.67, None),  # 13 sale (case-sensitive)
    line("536421", "DCGS0004", 1, 8.00, 12345),      # 14 adjustment by prefix
    line("536422", "m", 1, 3.00, 12345),             # 15 adjustment
    line("536423", " POST ", 1, 3.00, 12345),        # 16 sale, stored as POST
    line("c536424", "22139", -1, 2.00, 12345),       # 17 sale (lower-case c)
    line("536425", "22139", 3, 1.65, 12345),         # 18 revenue 4.95
    line("536426", "PADS", 2, 0.001, 12345),         # 19 non-sale, price 0.00
]

EXPECTED = {  # row -> (kind, type, quantity)
    0: ("sales", "Sale", 6),
    1: ("cancellations", "Cancellation", 12),
    2: ("adjustments", "Financial Adjustment", 1),
    3: ("non_sales", "Administrative / Postage", 1),
    4: ("adjustments", "Account Adjustment", 1),
    5: ("adjustments", "Account Adjustment", 1),
    6: ("adjustments", "Inventory Adjustment", -56),
    7: ("sales", "Sale", -56),
    8: ("non_sales", "Zero-Value Transaction", 5),
    9: ("sales", "Sale", 0),
    10: ("sales", "Sale", 3),
    11: ("non_sales", "Administrative / Postage", 1),
    12: ("sales", "Sale", 1),
    13: ("adjustments", "Financial Adjustment", 1),
    14: ("adjustments", "Financial Adjustment", 1),
    15: ("sales", "Sale", 1),
    16: ("sales", "Sale", -1),
    17: ("sales", "Sale", 3),
    18: ("non_sales", "Administrative / Postage", 2),
}


def test_classification_and_routing(spark):
    p = transform(raw_rows(spark, ROWS))
    got = {r["_ord"]: (r["kind"], r["TransactionType"], r["Quantity"]) for r in p.lines.collect()}
    assert got == EXPECTED


def test_revenue_signs_and_rounding(spark):
    wh = build(transform(raw_rows(spark, ROWS)))
    sales = {r["invoice_no"]: r for r in wh.fact_sales.collect()}
    assert sales["536365"]["revenue"] == Decimal("15.30")
    assert sales["536425"]["revenue"] == Decimal("4.95")   # 3 * 1.65 = 4.9499999...
    assert sales["536418"]["revenue"] is None
    assert sales["536423"]["stock_code"] == "POST"          # trimmed after routing
    canc = {r["invoice_no"]: r for r in wh.fact_cancellations.collect()}
    assert canc["C536379"]["quantity"] == 12 and canc["C536379"]["revenue"] == Decimal("-19.80")
    adj = {r["invoice_no"]: r for r in wh.fact_adjustment.collect()}
    assert adj["C536380"]["quantity"] == 1 and adj["C536380"]["revenue"] == Decimal("-27.50")
    ns = {r["invoice_no"]: r for r in wh.fact_non_sale.collect()}
    assert ns["536426"]["unit_price"] == Decimal("0.00")
    assert ns["536416"]["transaction_type"] == "Zero-Value Transaction"


def test_exact_duplicates_keep_one(spark):
    rows = [line("1", "A", 2, 1.0, 5), line("1", "A", 2, 1.0, 5)]
    p = transform(raw_rows(spark, rows))
    assert p.lines.count() == 1
    assert p.audit.count() == 0


def test_near_duplicate_flags_and_group_size(spark):
    rows = [line("1", "A", 2, 1.0, 5), line("1", "A", 2, 1.0, 5), line("1", "A", 2, 1.5, 5)]
    p = transform(raw_rows(spark, rows))
    lines = p.lines.collect()
    assert len(lines) == 2
    assert all(r["IsPotentialDuplicateLine"] and r["duplicate_group_count"] == 2 for r in lines)


def test_audit_keeps_signed_quantity_and_original_type(spark):
    rows = [line("C9", "A", -3, 1.0, 5), line("C9", "A", -3, 2.0, 5)]
    audit = transform(raw_rows(spark, rows)).audit.collect()
    assert sorted(r["Quantity"] for r in audit) == [-3, -3]
    assert {r["TransactionType"] for r in audit} == {"Cancellation"}


def test_null_key_flagged_with_null_group_size(spark):
    rows = [line("7", None, 1, 1.0, 5), line("7", None, 1, 2.0, 5)]
    lines = transform(raw_rows(spark, rows)).lines.collect()
    assert all(r["IsPotentialDuplicateLine"] for r in lines)
    assert all(r["duplicate_group_count"] is None for r in lines)


def test_rows_differing_only_by_customer_collapse_in_fact(spark):
    rows = [line("8", "A", 1, 1.0, 5), line("8", "A", 1, 1.0, 6)]
    p = transform(raw_rows(spark, rows))
    wh = build(p)
    assert p.kind("sales").count() == 2
    assert p.audit.count() == 2
    facts = wh.fact_sales.collect()
    assert len(facts) == 1 and facts[0]["customer_id"] == 5   # first row wins


def test_flag_exact_duplicates_marks_later_copies(spark):
    df = raw_rows(spark, [line("1", "A", 1, 1.0), line("1", "A", 1, 1.0), line("2", "A", 1, 1.0)])
    flags = {r["_ord"]: r["IsExactDuplicate"] for r in Q.flag_exact_duplicates(df).collect()}
    assert flags == {0: False, 1: True, 2: False}


def test_hot_key_group_size(spark):
    """A third of the rows share one (invoice, code, quantity): exact size."""
    rows = [line("H", "X", 1, 1.0 + i / 100) for i in range(300)] + \
           [line(str(i), "Y", 1, 1.0) for i in range(600)]
    lines = transform(raw_rows(spark, rows)).lines
    hot = lines.filter(F.col("InvoiceNo") == "H").select("duplicate_group_count").distinct().collect()
    assert [r[0] for r in hot] == [300]
