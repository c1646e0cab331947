"""The check suites of the layers, and the column contracts of the models."""

from __future__ import annotations

from marlstone import rules
from marlstone.operators.quality import (
    accepted_values,
    non_negative,
    not_null,
    positive,
    unique,
    unique_values,
)


def _complete(*columns: str):
    return tuple(not_null(column, rules.COMPLETENESS) for column in columns)


def _present(*columns: str):
    return tuple(not_null(column) for column in columns)


def _money_rules():
    return (non_negative("total_value"), positive("quantity"))


BRONZE = {
    "sales": (
        not_null("sale_id"),
        unique("sale_id"),
        *_present("customer_id", "product_id", "region_id", "sale_date", "status"),
        accepted_values("status", rules.STATUSES),
        not_null("channel"),
        *_complete("quantity", "unit_price", "total_value"),
        *_money_rules(),
    ),
    "customers": (
        not_null("customer_id"),
        unique("customer_id"),
        *_complete("customer_name", "email", "segment", "state"),
    ),
    "products": (
        not_null("product_id"),
        unique("product_id"),
        *_complete("product_name", "category", "list_price"),
    ),
    "regions": (not_null("region_id"), unique("region_id"), *_complete("region_name")),
}

SILVER = {
    "enriched_sales": (
        not_null("sale_id"),
        unique("sale_id"),
        *_present("customer_id", "product_id", "region_id", "status"),
        accepted_values("status", rules.STATUSES),
        *_present("channel", "is_high_value"),
        *_complete("customer_name", "product_name", "region_name"),
        *_money_rules(),
    ),
}

# Column contracts. A unique column here fails per repeated value and lets NULL pass.
_SALES_CONTRACT = (
    not_null("sale_id"),
    unique_values("sale_id"),
    *_present("customer_id", "product_id", "region_id", "sale_date", "year", "month"),
    *_present("quantity", "unit_price", "total_value", "status"),
    accepted_values("status", rules.STATUSES),
    not_null("channel"),
)
_CUSTOMERS_CONTRACT = (
    not_null("customer_id"),
    unique_values("customer_id"),
    *_present("customer_name", "email", "cpf", "segment", "state"),
)
_PRODUCTS_CONTRACT = (
    not_null("product_id"),
    unique_values("product_id"),
    *_present("product_name", "category", "list_price"),
)
_REGIONS_CONTRACT = (
    not_null("region_id"),
    unique_values("region_id"),
    not_null("region_name"),
)

SOURCE_CONTRACT = {
    "sales": _SALES_CONTRACT,
    "customers": _CUSTOMERS_CONTRACT,
    "products": _PRODUCTS_CONTRACT,
    "regions": _REGIONS_CONTRACT,
}
STAGING_CONTRACT = {
    "stg_sales": _SALES_CONTRACT,
    "stg_customers": _CUSTOMERS_CONTRACT,
    "stg_customers_marketing": (
        not_null("customer_id"),
        unique_values("customer_id"),
        *_present("customer_name", "email", "segment", "state"),
    ),
    "stg_products": _PRODUCTS_CONTRACT,
    "stg_regions": _REGIONS_CONTRACT,
}
SILVER_CONTRACT = {
    "enriched_sales": (
        not_null("sale_id"),
        unique_values("sale_id"),
        *_present("customer_id", "product_id", "region_id", "sale_date", "year", "month"),
        *_present("channel", "status"),
        accepted_values("status", rules.STATUSES),
        *_present("quantity", "total_value", "is_high_value"),
        accepted_values("is_high_value", (True, False)),
    ),
}
GOLD_CONTRACT = {
    "sales_mart": _present(
        "category",
        "region_name",
        "channel",
        "year",
        "month",
        "orders",
        "units",
        "revenue",
        "ticket_mean",
        "largest_sale",
        "smallest_sale",
    ),
}
CONTRACTS = {
    "source": SOURCE_CONTRACT,
    "staging": STAGING_CONTRACT,
    "silver": SILVER_CONTRACT,
    "gold": GOLD_CONTRACT,
}
