"""Property test: classification and routing against a plain-Python
statement of the rules, on random lines (including nulls and edge values)."""

from builders import raw_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txnlake.operators.transform import transform

ADMIN = {"POST", "DOT", "C2", "PADS"}
FIN = {"B", "M", "m", "BANK CHARGES", "AMAZONFEE", "S", "D"}


def expected(inv, code, qty, price, cust):
    """(kind, type, quantity) by the written rules, first match wins."""
    lt = lambda a, b: a is not None and b is not None and a < b
    eq = lambda a, b: a is not None and b is not None and a == b
    if lt(price, 0):
        t = "Account Adjustment"
    elif inv is not None and inv.startswith("C"):
        t = "Cancellation"
    elif lt(qty, 0) and eq(price, 0) and cust is None:
        t = "Inventory Adjustment"
    elif lt(0, qty) and eq(price, 0):
        t = "Zero-Value Transaction"
    else:
        t = "Sale"
    q = abs(qty) if (t == "Cancellation" and qty is not None) else qty
    admin = code is not None and (code in ADMIN or code.startswith("gift"))
    fin = code is not None and (code in FIN or code.startswith("DCG"))
    if t in ("Sale", "Cancellation") and admin:
        return "non_sales", "Administrative / Postage", q
    if t in ("Sale", "Cancellation") and fin:
        return "adjustments", "Financial Adjustment", q
    kind = {"Sale": "sales", "Cancellation": "cancellations", "Account Adjustment": "adjustments",
            "Inventory Adjustment": "adjustments", "Zero-Value Transaction": "non_sales"}[t]
    return kind, t, q


lines = st.tuples(
    st.one_of(st.none(), st.sampled_from(["536365", "C536379", "c1", "A1", "C"])),
    st.one_of(st.none(), st.sampled_from(["85123A", "POST", "DOT", "gift_1", "GIFT", "B", "m", "M", "DCGS",
                                          "dcg", " POST", "BANK CHARGES", "22"])),
    st.one_of(st.none(), st.integers(-5, 5)),
    st.one_of(st.none(), st.sampled_from([-2.5, 0.0, 0.001, 1.65, 3.0])),
    st.one_of(st.none(), st.integers(1, 3)),
)


@settings(max_examples=100, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(lines, min_size=1, max_size=40, unique=True))
def test_routing_matches_rules(spark, rows):
    df = raw_rows(spark, [{"InvoiceNo": i, "StockCode": c, "Quantity": q, "UnitPrice": p, "CustomerID": u}
                          for i, c, q, p, u in rows])
    got = {r["_ord"]: (r["kind"], r["TransactionType"], r["Quantity"]) for r in transform(df).lines.collect()}
    want = {i: expected(*row) for i, row in enumerate(rows)}
    assert got == want
