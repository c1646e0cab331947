"""SQL text shared by the oracles: the test tables as sales, customers and so on."""

from __future__ import annotations

import re

_NEEDS = {
    "sales": (),
    "dirty_sales": ("sales",),
    "raw_sales": ("dirty_sales",),
    "raw_customers": (),
    "customers": ("raw_customers",),
    "raw_products": (),
    "products": ("raw_products",),
    "regions": (),
    "valid": ("dirty_sales",),
    "enriched": ("valid", "customers", "products", "regions"),
    "done": ("enriched",),
    "mart": ("done",),
    "months": ("done",),
    "channels": ("done",),
    "base": ("done", "months", "channels", "enriched"),
    "scored": ("base",),
}


def mean6(total: str, count: str) -> str:
    """total / count rounded half up to six places, exact for sums of cents that are not negative."""
    cents = f"cast(cast({total} as decimal(38,2)) * 100 as hugeint)"
    micros = f"(({cents} * 20000 + {count}) // (2 * {count}))"
    return f"cast(cast({micros} as double) / 1000000 as decimal(22,6))"


def mean2(total: str, count: str) -> str:
    """total / count rounded half up to two places, for sums of cents that are not negative."""
    cents = f"cast(cast({total} as decimal(38,2)) * 100 as hugeint)"
    return f"cast(cast(({cents} * 2 + {count}) // (2 * {count}) as double) / 100 as decimal(18,2))"


def mean2_of_means(mean: str, count: str = "count(*)") -> str:
    """Plain mean of six-place means, rounded half up to two places."""
    micros = f"cast(cast(sum({mean}) as decimal(38,6)) * 1000000 as hugeint)"
    return (
        f"cast(cast(({micros} * 2 + {count} * 10000) // (2 * {count} * 10000) as double) / 100 "
        "as decimal(18,2))"
    )


def rate4(part: str, whole: str) -> str:
    """part / whole of counts, rounded half up to four places."""
    return (
        f"cast((cast({part} as hugeint) * 20000 + {whole}) // (2 * {whole}) as double) / 10000"
    )


_TEXT = {
    "sales": """
select l_orderkey as sale_id, cast(o_orderdate as date) as sale_date,
  cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
  l_partkey as product_id, o_custkey as customer_id, n_regionkey as region_id,
  cast(l_quantity as integer) as quantity,
  cast(l_extendedprice as decimal(18,2)) as unit_price,
  cast(l_discount as decimal(5,4)) as discount,
  cast(round(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(5,4))), 2)
    as decimal(18,2)) as total_value,
  o_orderpriority as channel,
  case o_orderstatus when 'F' then 'Concluída' when 'P' then 'Cancelada'
    when 'O' then 'Em andamento' end as status
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey""",
    "dirty_sales": """
select sale_id, sale_date, year, month,
  case when sale_id % 73 = 0 then -product_id - 1 else product_id end as product_id,
  case when sale_id % 97 <> 0 then customer_id end as customer_id, region_id,
  case when sale_id % 89 = 0 then 0 else quantity end as quantity, unit_price, discount,
  cast(case when sale_id % 83 = 0 then -total_value else total_value end as decimal(18,2))
    as total_value,
  channel, case when sale_id % 79 = 0 then 'Invalid' else status end as status
from sales""",
    "raw_sales": """
select case when sale_id % 101 <> 0 then cast(sale_id as varchar) end as sale_id,
  cast(sale_date as varchar) as sale_date, cast(year as varchar) as year,
  cast(month as varchar) as month, cast(product_id as varchar) as product_id,
  cast(customer_id as varchar) as customer_id, cast(region_id as varchar) as region_id,
  case when sale_id % 71 = 0 then 'n/a' else cast(quantity as varchar) end as quantity,
  cast(unit_price as varchar) as unit_price, cast(discount as varchar) as discount,
  cast(total_value as varchar) as total_value, channel, status
from dirty_sales""",
    "raw_customers": """
select cast(c_custkey as varchar) as customer_id, c_name as customer_name,
  case when c_custkey % 50 <> 0 then replace(c_name, '#', '.') || '@Mail.Example' end as email,
  substr(lpad(cast(c_custkey as varchar), 11, '0'), 1, 3) || '.'
    || substr(lpad(cast(c_custkey as varchar), 11, '0'), 4, 3) || '.'
    || substr(lpad(cast(c_custkey as varchar), 11, '0'), 7, 3) || '-'
    || substr(lpad(cast(c_custkey as varchar), 11, '0'), 10, 2) as cpf,
  c_mktsegment as segment, lower(n_name) as state, cast(n_regionkey as varchar) as region_id,
  cast(date '1995-01-01' + cast(c_custkey % 365 as integer) as varchar) as registered_on
from customer join nation on c_nationkey = n_nationkey""",
    "customers": """
select try_cast(customer_id as bigint) as customer_id, customer_name, lower(email) as email, cpf,
  segment, upper(state) as state, try_cast(region_id as integer) as region_id,
  try_cast(registered_on as date) as registered_on
from raw_customers where customer_id is not null""",
    "raw_products": """
select cast(p_partkey as varchar) as product_id, p_name as product_name, p_type as category,
  cast(cast(p_retailprice as decimal(18,2)) as varchar) as list_price, p_brand as supplier,
  case when p_partkey % 10 = 9 then null when p_partkey % 3 = 0 then ' s '
    when p_partkey % 3 = 1 then 'N' else 'S' end as active
from part""",
    "products": """
select try_cast(product_id as bigint) as product_id, product_name, category,
  try_cast(list_price as decimal(18,2)) as list_price, supplier,
  coalesce(upper(trim(active)) = 'S', false) as active
from raw_products where product_id is not null""",
    "regions": """
select r_regionkey as region_id, r_name as region_name from region where r_regionkey is not null""",
    "valid": """
select * from dirty_sales
where sale_id is not null and customer_id is not null and quantity > 0 and total_value >= 0
  and status in ('Concluída', 'Cancelada', 'Em andamento')""",
    "enriched": """
select v.sale_id, v.sale_date, v.year, v.month, v.product_id, p.product_name, p.category,
  v.customer_id, c.customer_name, c.segment, c.state, v.region_id, r.region_name, v.channel,
  v.status, v.quantity, v.unit_price, v.discount, v.total_value,
  coalesce(v.total_value > 10000, false) as is_high_value
from valid v left join customers c on v.customer_id = c.customer_id
left join products p on v.product_id = p.product_id
left join regions r on v.region_id = r.region_id""",
    "done": "select * from enriched where status = 'Concluída'",
    "mart": f"""
select category, region_name, channel, year, month, count(sale_id) as orders,
  cast(sum(quantity) as bigint) as units, cast(sum(total_value) as decimal(38,2)) as revenue,
  {mean6("sum(total_value)", "count(total_value)")} as ticket_mean,
  max(total_value) as largest_sale, min(total_value) as smallest_sale
from done group by category, region_name, channel, year, month""",
    "months": """
select customer_id, year, month, count(sale_id) as month_orders
from done group by customer_id, year, month""",
    "channels": """
select customer_id, channel, count(*) as channel_orders,
  row_number() over (partition by customer_id
    order by count(*) desc, channel asc nulls first) as rn,
  rank() over (partition by customer_id order by count(*) desc) as rk
from done group by customer_id, channel""",
    "base": f"""
select m.customer_id, segment as customer_segment, state as customer_state, m.orders,
  {rate4("m.orders", "a.active_months")} as orders_per_month,
  coalesce(s.orders_per_month_6m, 0.0) as orders_per_month_6m, total_revenue, ticket_mean,
  ticket_max, ticket_min, category_count, k.channel as preferred_channel, t.cancel_rate,
  high_value_orders, days_since_purchase
from (
  select customer_id, count(sale_id) as orders,
    cast(sum(total_value) as decimal(38,2)) as total_revenue,
    {mean6("sum(total_value)", "count(total_value)")} as ticket_mean,
    max(total_value) as ticket_max, min(total_value) as ticket_min,
    count(distinct category) as category_count,
    count(*) filter (where is_high_value) as high_value_orders,
    cast(date_diff('day', max(sale_date), date '2001-08-01') as integer) as days_since_purchase
  from done group by customer_id) m
left join (select customer_id, count(*) as active_months from months group by customer_id) a
  on m.customer_id = a.customer_id
left join (
  select customer_id, {rate4("sum(month_orders)", "count(*)")} as orders_per_month_6m
  from months where year > 2001 or (year = 2001 and month >= 2) group by customer_id) s
  on m.customer_id = s.customer_id
left join (
  select customer_id,
    {rate4("count(*) filter (where status = 'Cancelada')", "count(sale_id)")} as cancel_rate
  from enriched group by customer_id) t on m.customer_id = t.customer_id
left join channels k on m.customer_id = k.customer_id and k.rn = 1
left join (
  select customer_id, segment, state,
    row_number() over (partition by customer_id
      order by sale_date desc, segment desc nulls last, state desc nulls last) as rn
  from enriched) d on m.customer_id = d.customer_id and d.rn = 1""",
    "scored": """
select *, cast(round(cast(
    recency_rank * 100 * 0.35::double + frequency_rank * 100 * 0.35::double
    + monetary_rank * 100 * 0.30::double as decimal(18,6)), 2) as double) as rfm_score,
  cast(case when days_since_purchase > 90 then 1 else 0 end as integer) as churn_label
from (
  select *, percent_rank() over (order by days_since_purchase desc nulls last) as recency_rank,
    percent_rank() over (order by orders asc nulls first) as frequency_rank,
    percent_rank() over (order by total_revenue asc nulls first) as monetary_rank
  from base) ranked""",
}


def with_ctes(body: str, *names: str, **extra: str) -> str:
    """`body` with the named CTEs, and those they need, put in front of it.

    `extra` adds or replaces CTEs, in the order given, after the named ones.
    """
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for needed in _NEEDS[name]:
                visit(needed)
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} as ({_TEXT[name]})" for name in ordered]
    parts += [f"{name} as ({text})" for name, text in extra.items()]
    return f"with {', '.join(parts)} {body}" if parts else body


def restated(name: str, **read: str) -> str:
    """The text of a CTE that reads others in place of those named: restated("done", enriched="mine")."""
    text = _TEXT[name]
    for old, new in read.items():
        text = re.sub(rf"\b(from|join) {old}\b", rf"\1 {new}", text)
    return text
