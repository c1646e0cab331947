"""The sales history as mergeable cells, from which features of any day can be folded.

A cell sums the sales of one customer, month, channel, category and profile. Cells add up: those of
two sets of sales are merged by the same sums, least and greatest values. Stored by the month of the
sale, a new month adds cells and changes no others; the history as of a day is made of the cells of
the months before it and of the few sales of its own month.
"""

from __future__ import annotations

from datetime import date, timedelta
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone import rules
from marlstone.functions.calendar import days_since, known_by, trailing_months
from marlstone.functions.numbers import TOTAL, mean_of_total, ratio
from marlstone.operators.sizing import TASK_BYTES, stored_bytes
from marlstone.sources.writers import write_parquet

CELL = ("customer_id", "year", "month", "channel", "category", "segment", "state")
# The month by which a cell is stored, as yyyy-MM of the day of sale; sales without a day are known
# at all times, so they are stored before all months.
SOLD_IN, UNDATED = "sold_in", "0000-00"
# What cells are made of.
SALE = ("sale_id", "sale_date", *CELL, "status", "total_value", "is_high_value")
# Sales that one task sums to the cells of a month.
TASK_SALES = 1 << 18


def cells(enriched: DataFrame) -> DataFrame:
    """One row per cell. Sales are spread by cell first, so that many sales of one customer share out."""
    return _summed(_spread(_measured(enriched), *CELL), *CELL)


def _measured(enriched: DataFrame) -> DataFrame:
    """What cells sum of a sale, in few bytes since all sales are shuffled."""
    done = F.coalesce(F.col("status") == rules.COMPLETED, F.lit(False))
    return enriched.select(
        *CELL,
        "sale_date",
        F.when(done, F.col("total_value")).alias("value"),
        done.alias("done"),
        F.coalesce(F.col("status") == rules.CANCELLED, F.lit(False)).alias("cancelled"),
        F.coalesce(done & F.col("is_high_value"), F.lit(False)).alias("high"),
        F.col("sale_id").isNotNull().alias("known"),
    )


def _summed(measured: DataFrame, *keys: str) -> DataFrame:
    return measured.groupBy(*keys).agg(
        F.count_if("done").alias("done"),
        F.count_if(F.col("done") & F.col("known")).alias("orders"),
        F.count_if("known").alias("sales"),
        F.count_if("cancelled").alias("cancelled"),
        F.count_if("high").alias("high"),
        F.sum("value").cast(TOTAL).alias("revenue"),
        F.count("value").alias("priced"),
        F.max("value").alias("largest"),
        F.min("value").alias("smallest"),
        F.max(F.when(F.col("done"), F.col("sale_date"))).alias("last_purchase"),
        F.max("sale_date").alias("last_sale"),
    )


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by their keys over as many tasks as the stored bytes they are read from ask for.

    Rows that come from no file are left to adaptive execution.
    """
    stored = stored_bytes(df)
    return df.repartition(max(2, ceil(stored / TASK_BYTES)), *keys) if stored else df.repartition(*keys)


def write_cells(enriched: DataFrame, path: str, *, whole: bool = False) -> None:
    """Store the cells of these sales by month. Months that are stored already are replaced, so the
    sales must hold whole months; `whole` replaces all of them.

    The sales are counted by month first. Each month is then summed and written by as many tasks as its
    sales ask for, small ones share a task, and cells are not shuffled again to be written.
    """
    sold_in = F.coalesce(F.date_format("sale_date", "yyyy-MM"), F.lit(UNDATED))
    # As many rows as there are months.
    counted = enriched.groupBy(sold_in.alias(SOLD_IN)).agg(F.count(F.lit(1)).alias("sales")).collect()
    dealt, tasks = _dealt({month: sales for month, sales in sorted(counted)})
    months = enriched.sparkSession.createDataFrame(dealt, f"{SOLD_IN} string, _first int, _tasks int")
    dated = _measured(enriched).withColumn(SOLD_IN, sold_in).join(F.broadcast(months), SOLD_IN, "left")
    task = F.col("_first") + F.pmod(F.xxhash64(*CELL), F.col("_tasks"))
    spread = dated.withColumn("_task", F.coalesce(task, F.lit(0)).cast("int")).drop("_first", "_tasks", SOLD_IN)
    spread = spread.repartitionById(tasks, "_task").withColumn(SOLD_IN, sold_in)
    summed = _summed(spread, *CELL, SOLD_IN, "_task").drop("_task")
    write_parquet(summed, path, (SOLD_IN,), whole=whole, gather=False)


def _dealt(sales: dict[str, int]) -> tuple[list[tuple[str, int, int]], int]:
    """(month, its first task, its tasks) of each month, and the tasks of all."""
    dealt, task, filled = [], 0, 0
    for month, rows in sales.items():
        if filled and filled + rows > TASK_SALES:
            task, filled = task + 1, 0
        own = ceil(rows / TASK_SALES)
        dealt.append((month, task, own))
        task, filled = (task + own, 0) if own > 1 else (task, filled + rows)
    return dealt, task + 1


def cells_as_of(spark: SparkSession, path: str, enriched: DataFrame, as_of: date) -> DataFrame:
    """Cells of the sales up to a day: stored ones of whole months, and those of its own month.

    Only the folders of earlier months are read. The sales are read for the days since the first
    of the month only, and not at all on its last day.
    """
    ends_month = (as_of + timedelta(days=1)).day == 1
    month = f"{as_of:%Y-%m}"
    stored = spark.read.schema(f"{_schema(enriched)}, {SOLD_IN} string").parquet(path)
    before = F.col(SOLD_IN) <= month if ends_month else F.col(SOLD_IN) < month
    known = stored.filter(before).drop(SOLD_IN)
    if ends_month:
        return known
    current = enriched.filter(F.col("sale_date").between(as_of.replace(day=1), as_of))
    return known.unionByName(cells(current))


def _schema(enriched: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells(enriched).schema)


def fold(known: DataFrame, as_of: date, months: int = rules.TRAILING_MONTHS) -> DataFrame:
    """All features that need one customer's history only; one row per customer with a purchase.

    Cells, as few as a customer has combinations of months, channels, categories and profiles, are
    shuffled once by customer. They are merged by channel and then by customer; months and categories
    travel as sets, whose sizes are bounded by the number of months and categories there are.
    """
    bought = F.col("done") > 0
    month = F.struct("year", "month")
    recent = bought & trailing_months(F.col("year"), F.col("month"), as_of, months)
    sums = ("done", "orders", "sales", "cancelled", "high", "priced")
    by_channel = _spread(known, "customer_id").groupBy("customer_id", "channel").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.sum("revenue").cast(TOTAL).alias("revenue"),
        F.max("largest").alias("largest"),
        F.min("smallest").alias("smallest"),
        F.max("last_purchase").alias("last_purchase"),
        F.sum(F.when(recent, F.col("orders"))).alias("recent_orders"),
        F.collect_set(F.when(bought, month)).alias("months"),
        F.collect_set(F.when(recent, month)).alias("recent_months"),
        F.collect_set(F.when(bought, F.col("category"))).alias("categories"),
        F.max(F.struct("last_sale", "segment", "state")).alias("latest"),
    )

    def distinct(sets: str) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(sets)))).cast("bigint")

    per_customer = by_channel.groupBy("customer_id").agg(
        *[F.sum(c).alias(c) for c in (*sums, "recent_orders")],
        F.sum("revenue").cast(TOTAL).alias("total_revenue"),
        F.max("largest").alias("ticket_max"),
        F.min("smallest").alias("ticket_min"),
        F.max("last_purchase").alias("last_purchase"),
        distinct("months").alias("active_months"),
        distinct("recent_months").alias("recent_months"),
        distinct("categories").alias("category_count"),
        F.min(F.when(bought, F.struct((-F.col("done")).alias("rank"), "channel"))).alias("favourite"),
        F.max("latest").alias("latest"),
    )
    return per_customer.filter(bought).select(
        "customer_id",
        F.col("latest.segment").alias("customer_segment"),
        F.col("latest.state").alias("customer_state"),
        "orders",
        ratio(F.col("orders"), F.greatest(F.col("active_months"), F.lit(1))).alias("orders_per_month"),
        F.coalesce(ratio(F.col("recent_orders"), F.col("recent_months")), F.lit(0.0)).alias(
            "orders_per_month_6m"
        ),
        "total_revenue",
        mean_of_total(F.col("total_revenue"), F.col("priced")).alias("ticket_mean"),
        "ticket_max",
        "ticket_min",
        "category_count",
        F.col("favourite.channel").alias("preferred_channel"),
        ratio(F.col("cancelled"), F.col("sales")).alias("cancel_rate"),
        F.col("high").alias("high_value_orders"),
        days_since(F.col("last_purchase"), as_of).alias("days_since_purchase"),
    )


def customer_base(
    enriched: DataFrame, as_of: date, months: int = rules.TRAILING_MONTHS
) -> DataFrame:
    """`fold` of the sales known by a day, without stored cells."""
    return fold(cells(enriched.filter(known_by(F.col("sale_date"), as_of))), as_of, months)
