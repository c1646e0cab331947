"""The saved reports come in the order their users read them in."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

# Report -> its order: column and whether it descends; later ones break ties.
ORDERS = {
    "revenue_by_category": [("revenue", True)],
    "revenue_by_channel_region": [("revenue", True), ("channel", False), ("region_name", False)],
    "ticket_by_category_month": [("year", True), ("month", True), ("category", False)],
    "top10_products": [("units", True)],
    "cancelled_by_month": [("year", True), ("month", True)],
    "customers_by_segment": [("customers", True), ("segment", False), ("state", False)],
    "monthly_trend": [("month", False), ("category", False)],
}



@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, name):
    got = entry.queries()[name](spark, SMALL).collect()
    want = list(got)
    for column, descending in reversed(ORDERS[name]):
        # Missing values come last either way.
        want.sort(key=lambda r, c=column, d=descending: ((r[c] is None) != d, r[c] or 0), reverse=descending)
    assert len(got) > 1 and [tuple(r) for r in got] == [tuple(r) for r in want]
