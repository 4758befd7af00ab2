"""View semantics on hand-made rows (FIXTURES.md section 5)."""

import datetime as dt
from decimal import Decimal

from builders import line, raw_rows

from txnlake.operators.transform import transform
from txnlake.plans import catalog
from txnlake.plans.views import cancellation as CA
from txnlake.plans.views import customer as CU
from txnlake.plans.views import geographic as GE
from txnlake.plans.views import product as PR
from txnlake.plans.views import sales as SA
from txnlake.plans.warehouse import build


def wh_of(spark, rows):
    return build(transform(raw_rows(spark, rows)))


def d(y, m, day=1):
    return dt.datetime(y, m, day, 9, 0)


def test_lag_skips_missing_month_and_first_is_null(spark):
    rows = [line("1", "A", 1, 100.0, 1, InvoiceDate=d(2011, 1)),
            line("2", "A", 1, 150.0, 1, InvoiceDate=d(2011, 2)),
            line("3", "A", 1, 75.0, 1, InvoiceDate=d(2011, 4))]
    out = {r["month"]: r for r in SA.revenue_trends(wh_of(spark, rows)).collect()}
    assert out[1]["prior_month_revenue"] is None and out[1]["mom_growth_pct"] is None
    assert out[2]["mom_growth_pct"] == Decimal("50.00")
    assert out[4]["prior_month_revenue"] == Decimal("150.00")
    assert out[4]["mom_growth_pct"] == Decimal("-50.00")
    assert out[4]["month_year_label"] == "Apr 2011" and out[4]["year_month_sort"] == 201104


def test_growth_trends_excludes_first_month(spark):
    rows = [line("1", "A", 1, 100.0, 1, InvoiceDate=d(2011, 1), Country="X"),
            line("2", "A", 1, 110.0, 1, InvoiceDate=d(2011, 2), Country="X"),
            line("3", "A", 1, 99.0, 1, InvoiceDate=d(2011, 3), Country="X"),
            line("4", "A", 1, 10.0, 2, InvoiceDate=d(2011, 1), Country="Y")]
    out = {r["country"]: r for r in GE.growth_trends(wh_of(spark, rows)).collect()}
    assert set(out) == {"X"}
    assert (out["X"]["months_of_growth"], out["X"]["months_of_decline"]) == (1, 1)
    assert out["X"]["avg_monthly_growth_rate"] == Decimal("0.00")  # (10.00 + -10.00) / 2


def test_cancellation_rates_by_country(spark):
    rows = [line("1", "A", 1, 1.0, 1, Country="NoCancels"),
            line("2", "A", 1, 1.0, 1, Country="Both"), line("C3", "A", -1, 1.0, 1, Country="Both"),
            line("C4", "A", -1, 1.0, 1, Country="OnlyCancels")]
    out = {r["country"]: r for r in CA.rates_by_country(wh_of(spark, rows)).collect()}
    assert set(out) == {"NoCancels", "Both"}
    assert (out["NoCancels"]["total_cancels"], out["NoCancels"]["cancellation_rate"]) == (0, Decimal("0.00"))
    assert out["Both"]["cancellation_rate"] == Decimal("50.00")


def test_rfm_ties_at_median_go_low(spark):
    rows = []
    # three customers, one order each in one month: frequency 1.00 for all;
    # AOVs 10, 20, 30 -> median 20: customer 2 sits exactly on both medians
    for cust, price in ((1, 10.0), (2, 20.0), (3, 30.0)):
        rows.append(line(str(cust), "A", 1, price, cust))
    out = {r["customer_id"]: r["customer_segment"] for r in CU.rfm_segments(wh_of(spark, rows)).collect()}
    assert out == {1: "Low Frequency and Low AOV", 2: "Low Frequency and Low AOV",
                   3: "Low Frequency and High AOV"}


def test_sales_decline_midpoint(spark):
    # days 1..4 of a month: (4-1) div 2 = 1 -> midpoint day 2 counts as first half
    rows = [line("1", "A", 5, 1.0, 1, InvoiceDate=d(2011, 3, 1), Description="P"),
            line("2", "A", 4, 1.0, 1, InvoiceDate=d(2011, 3, 2), Description="P"),
            line("3", "A", 2, 1.0, 1, InvoiceDate=d(2011, 3, 4), Description="P")]
    out = PR.sales_decline(wh_of(spark, rows)).collect()
    assert [(r["first_half_sales"], r["second_half_sales"], r["sales_drop"]) for r in out] == [(9, 2, 7)]


def _orders(country, n, cust_offset=0, customers=None):
    return [line(f"{country}{i}", "A", 1, 10.0, (customers and (i % customers)) or (cust_offset + i),
                 Country=country) for i in range(n)]


def test_having_edges(spark):
    rows = _orders("Ten", 10) + _orders("Fifty", 50) + _orders("FiftyOne", 51) + _orders("Nine", 9)
    wh = wh_of(spark, rows)
    assert {r["country"] for r in GE.high_aov(wh).collect()} == {"Ten", "Fifty", "FiftyOne"}
    assert {r["country"] for r in GE.high_volume_low_aov(wh).collect()} == {"FiftyOne"}
    assert {r["country"] for r in GE.low_volume_high_aov(wh).collect()} == {"Ten", "Fifty"}
    rows = _orders("K10", 10, 1000) + _orders("K11", 11, 2000)
    assert {r["country"] for r in GE.revenue_per_customer(wh_of(spark, rows)).collect()} == {"K11"}


def test_units_threshold_and_zero_quantity_guard(spark):
    rows = [line("1", "F", 50, 1.0, 1, Description="fifty"), line("2", "G", 51, 1.0, 1, Description="fiftyone"),
            line("3", "Z", 2, 1.0, 1, Description="zero"), line("4", "Z", -2, 1.0, 1, Description="zero")]
    wh = wh_of(spark, rows)
    assert {r["description"] for r in CA.rates_by_product(wh).collect()} == {"fiftyone"}
    avg = {r["description"]: r["avg_selling_price"] for r in PR.top_product_by_avg_price(wh).collect()}
    assert avg["zero"] is None and avg["fifty"] == Decimal("1.00")


def test_manual_thresholds_defaults(spark):
    rows = [line("1", "A", 56, 40.0, 1, Description="in"), line("2", "B", 57, 100.0, 1, Description="volume"),
            line("3", "C", 10, 10.0, 1, Description="revenue")]
    out = PR.high_revenue_low_volume_manual(wh_of(spark, rows)).collect()
    assert [(r["description"], r["total_volume"], r["total_revenue"]) for r in out] == [("in", 56, Decimal("2240.00"))]


def test_every_view_runs_on_fixture(spark):
    rows = [line(str(i), f"S{i % 5}", 1 + i % 3, 2.0 + i, i % 4 + 1, InvoiceDate=d(2011, 1 + i % 6, 1 + i % 20))
            for i in range(40)] + [line("C77", "S1", -1, 2.0, 1), line("5", "POST", 1, 3.0, 1),
                                   line("6", "M", 1, 3.0, 1), line("7", "S2", 3, 0.0, None)]
    wh = wh_of(spark, rows)
    for v in catalog.VIEWS:
        v.fn(wh).collect()
