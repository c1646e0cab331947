"""Typed staging of raw tables: cast, normalise, drop rows without a key, keep what failed."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.numbers import MONEY


class StagedColumn(NamedTuple):
    """A target column: its type (None keeps the raw value) and a rule applied to the raw value."""

    name: str
    type: str | None = None
    rule: Callable[[Column], Column] | None = None


class StagedTable(NamedTuple):
    key: str
    columns: tuple[StagedColumn, ...]


def is_yes(value: Column) -> Column:
    """'S', in any case and with blanks around it, means yes; everything else means no."""
    return F.coalesce(F.upper(F.trim(value)) == "S", F.lit(False))


_AUDIT = StagedColumn("ingestion_ts")

SALES = StagedTable(
    "sale_id",
    (
        StagedColumn("sale_id", "bigint"),
        StagedColumn("sale_date", "date"),
        StagedColumn("year", "int"),
        StagedColumn("month", "int"),
        StagedColumn("product_id", "bigint"),
        StagedColumn("customer_id", "bigint"),
        StagedColumn("region_id", "int"),
        StagedColumn("quantity", "int"),
        StagedColumn("unit_price", MONEY),
        StagedColumn("discount", "decimal(5,4)"),
        StagedColumn("total_value", MONEY),
        StagedColumn("channel"),
        StagedColumn("status"),
        _AUDIT,
    ),
)

CUSTOMERS = StagedTable(
    "customer_id",
    (
        StagedColumn("customer_id", "bigint"),
        StagedColumn("customer_name"),
        StagedColumn("email", rule=F.lower),
        StagedColumn("cpf"),
        StagedColumn("segment"),
        StagedColumn("state", rule=F.upper),
        StagedColumn("region_id", "int"),
        StagedColumn("registered_on", "date"),
        _AUDIT,
    ),
)

PRODUCTS = StagedTable(
    "product_id",
    (
        StagedColumn("product_id", "bigint"),
        StagedColumn("product_name"),
        StagedColumn("category"),
        StagedColumn("list_price", MONEY),
        StagedColumn("supplier"),
        StagedColumn("active", rule=is_yes),
        _AUDIT,
    ),
)

REGIONS = StagedTable(
    "region_id",
    (StagedColumn("region_id", "int"), StagedColumn("region_name")),
)


def stage(raw: DataFrame, table: StagedTable) -> DataFrame:
    """Typed rows of `table` that have a key of its type.

    Any other value that does not fit its type becomes NULL; `cast_failures` lists both. Columns that
    the raw input does not have (an audit timestamp, say) are left out.
    """
    present = [c for c in table.columns if c.name in raw.columns]
    return raw.filter(_has_key(table)).select(
        *[_target(column).alias(column.name) for column in present]
    )


def without_key(raw: DataFrame, table: StagedTable) -> DataFrame:
    """The raw rows that `stage` leaves out."""
    return raw.filter(~_has_key(table))


def staged_beside_raw(raw: DataFrame, table: StagedTable) -> DataFrame:
    """Every raw row, as struct `raw`, next to its typed columns; `has_key` where `stage` takes it."""
    present = [c for c in table.columns if c.name in raw.columns]
    return raw.select(
        F.struct(*raw.columns).alias("raw"),
        *[_target(column).alias(column.name) for column in present],
        _has_key(table).alias("has_key"),
    )


def _has_key(table: StagedTable) -> Column:
    typed = next((_target(c) for c in table.columns if c.name == table.key), F.col(table.key))
    return F.col(table.key).isNotNull() & typed.isNotNull()


def cast_failures(raw: DataFrame, table: StagedTable) -> DataFrame:
    """Raw rows with a key in which a value is present but does not fit its type.

    Adds `failed_columns`, the names of those columns in table order.
    """
    typed = [c for c in table.columns if c.type and c.name in raw.columns]
    failed = F.array_compact(
        F.array(
            *[
                F.when(F.col(c.name).isNotNull() & _target(c).isNull(), F.lit(c.name))
                for c in typed
            ]
        )
    )
    return (
        raw.filter(F.col(table.key).isNotNull())
        .withColumn("failed_columns", failed)
        .filter(F.size("failed_columns") > 0)
    )


def _target(column: StagedColumn) -> Column:
    value = F.col(column.name)
    if column.rule is not None:
        value = column.rule(value)
    return value.try_cast(column.type) if column.type else value
