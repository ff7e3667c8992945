"""SQL counterparts of the registered queries, for an independent engine.

They restate each result from the given tables with the plainest SQL that says it: windows,
correlated subqueries, unions, whole-number arithmetic for rounding. Every output column is
cast to the type which the Spark side states.
"""

from __future__ import annotations

import re


def rounded(top: str, bottom: str, scale: int, kind: str) -> str:
    """top / bottom for whole numbers, halves away from zero at ``scale``; NULL over 0."""
    top, bottom = f"cast({top} as hugeint)", f"cast({bottom} as hugeint)"
    unit = "cast(" + f"{10.0 ** -scale:.{scale}f}" + f" as decimal({scale + 1},{scale}))"
    whole = f"((2 * abs({top}) * {10 ** scale} + {bottom}) // (2 * nullif({bottom}, 0)))"
    sign = f"case when {top} < 0 then -1 else 1 end"
    return f"cast(cast({sign} * {whole} as decimal(24,0)) * {unit} as {kind})"


def cents(expr: str) -> str:
    return f"cast({expr} as decimal(22,2)) * cast(100 as decimal(3,0))"


def mean_money(column: str = "total_amount") -> str:
    return rounded(cents(f"sum({column})"), f"100 * count({column})", 6, "decimal(16,6)")


def mean_percent(column: str = "profit_margin") -> str:
    return rounded(cents(f"sum({column})"), f"100 * count({column})", 6, "decimal(9,6)")


def money(expr: str) -> str:
    return f"cast(sum({expr}) as decimal(22,2))"


ITEMS = "cast(sum(quantity) as bigint)"
ORDERS = "count(distinct order_id)"
BUYERS = "count(distinct customer_key)"
HUNDREDTH = "cast(0.01 as decimal(3,2))"

_CUSTOMER_ATTRIBUTES = (
    "customer_name, email, phone, address, city, country, registration_date, customer_segment"
)
_PRODUCT_ATTRIBUTES = (
    "product_name, category, subcategory, supplier, cost_price, msrp, profit_margin"
)

_margin_of_list = rounded(
    f"({cents('msrp')} - {cents('cost_price')}) * cast(100 as decimal(3,0))",
    cents("msrp"), 2, "decimal(18,2)",
)

BASE = f"""
line_cents as (
  select *, cast(l_quantity as integer) as quantity,
         cast(round(l_extendedprice * 100) as bigint) as total_cents
  from lineitem
),
unit_cents as (
  select *, (total_cents * 2 + quantity) // (quantity * 2) as per_unit from line_cents
),
raw_sales as (
  select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey,
                            l_extendedprice, l_quantity, l_shipdate, l_discount, l_tax)
           as staging_id,
         concat('ORD', l_orderkey) as order_id,
         cast(o_orderdate as date) as order_date,
         concat('CUST', o_custkey) as customer_id,
         concat('PROD', l_partkey) as product_id,
         quantity,
         cast(cast(per_unit as decimal(18,0)) * {HUNDREDTH} as decimal(10,2)) as unit_price,
         cast(cast(case when l_linenumber = 7 then total_cents else per_unit * quantity end
                   as decimal(18,0)) * {HUNDREDTH} as decimal(12,2)) as total_amount,
         concat('sales_', strftime(o_orderdate, '%Y%m'), '.csv') as file_name
  from unit_cents join orders on l_orderkey = o_orderkey
),
raw_customers as (
  select row_number() over (order by c_custkey) as staging_id,
         concat('CUST', c_custkey) as customer_id,
         concat(' ', c_name, ' ') as customer_name,
         case when c_custkey % 20 = 7 then concat('User', c_custkey, '.example.com')
              else concat(' User', c_custkey, '@Example.com ') end as email,
         cast(null as varchar) as phone, cast(null as varchar) as address,
         n_name as city, r_name as country,
         cast(date '1994-01-01' + cast(c_custkey % 2500 as integer) as date)
           as registration_date,
         'customers.csv' as file_name
  from customer join nation on c_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey
),
raw_products as (
  select row_number() over (order by p_partkey) as staging_id,
         concat('PROD', p_partkey) as product_id,
         p_name as product_name, p_type as category, p_name as subcategory,
         p_brand as supplier,
         cast(cast(p_retailprice as decimal(10,2))
              * cast(0.50 + 0.06 * (p_partkey % 10) as decimal(4,2)) as decimal(10,2))
           as cost_price,
         cast(p_retailprice as decimal(10,2)) as msrp,
         'products.csv' as file_name
  from part
),
sales as (
  select *, case
      when quantity < 1 then 'Quantity below minimum'
      when quantity > 1000 then 'Quantity above maximum'
      when unit_price < 0.01 then 'Unit price below minimum'
      when unit_price > 10000.00 then 'Unit price above maximum'
      when total_amount <> unit_price * quantity then 'Total amount mismatch'
      when order_date not between date '1995-01-01' and date '2001-06-30'
        then 'Order date out of range'
    end as error_message
  from raw_sales
),
customers as (
  select staging_id, customer_id, trim(customer_name) as customer_name,
         lower(trim(email)) as email, phone, address, trim(city) as city,
         trim(country) as country, registration_date, file_name,
         case when lower(trim(email)) not like '%@%.%' then 'Invalid email format' end
           as error_message
  from raw_customers
),
products as (
  select staging_id, product_id, trim(product_name) as product_name,
         upper(trim(category)) as category,
         concat(upper(left(trim(subcategory), 1)), lower(substr(trim(subcategory), 2)))
           as subcategory,
         trim(supplier) as supplier, cost_price, msrp, file_name,
         case when cost_price <= 0 then 'Invalid cost price'
              when msrp <= 0 then 'Invalid MSRP'
              when msrp < cost_price then 'MSRP lower than cost' end as error_message
  from raw_products
),
kept as (
  select * from sales s
  where s.error_message is not null
     or not exists (select 1 from sales l where l.order_id = s.order_id
                    and l.product_id = s.product_id and l.staging_id > s.staging_id)
),
valid_sales as (select * from kept where error_message is null),
segments as (
  select *, case when country in ('AMERICA', 'EUROPE') then 'INTERNATIONAL'
                 when country = 'ASIA' and city in ('NATION_2', 'NATION_7')
                   then 'MAJOR_CITY'
                 else 'OTHER' end as customer_segment
  from customers where error_message is null
),
margins as (
  select *, cast(greatest(least({_margin_of_list}, 999.99), -999.99) as decimal(5,2))
    as profit_margin
  from products where error_message is null
),
dim_customer as (
  select row_number() over (order by customer_id) as customer_key, customer_id,
         {_CUSTOMER_ATTRIBUTES}, date '2001-06-30' as valid_from,
         cast(null as date) as valid_to, true as is_current
  from segments
),
dim_product as (
  select row_number() over (order by product_id) as product_key, product_id,
         {_PRODUCT_ATTRIBUTES}, date '2001-06-30' as valid_from,
         cast(null as date) as valid_to, true as is_current
  from margins
),
dim_date as (
  select cast(strftime(day_at, '%Y%m%d') as integer) as date_key,
         cast(day_at as date) as full_date,
         cast(day(day_at) as integer) as "day", cast(month(day_at) as integer) as "month",
         cast(quarter(day_at) as integer) as "quarter",
         cast(year(day_at) as integer) as "year",
         cast(isodow(day_at) as integer) as day_of_week,
         dayname(day_at) as day_name, monthname(day_at) as month_name,
         isodow(day_at) > 5 as is_weekend, false as is_holiday
  from generate_series(timestamp '1995-01-01', timestamp '2001-06-30', interval 1 day)
       as days(day_at)
),
resolved as (
  select s.*, c.customer_key, c.registration_date, p.product_key, d.date_key,
         {cents('s.total_amount')} as paid,
         {cents('s.total_amount')} - s.quantity * {cents('m.cost_price')} as gained,
         case when p.product_key is null then 'Unknown product'
              when c.customer_key is null then 'Unknown customer'
              when d.date_key is null then 'Date outside calendar' end as reject_reason
  from valid_sales s
       left join margins m on m.product_id = s.product_id
       left join dim_product p on p.product_id = s.product_id
       left join dim_customer c on c.customer_id = s.customer_id
       left join dim_date d on d.full_date = s.order_date
),
shares as (
  select *, cast(abs(gained) as hugeint) * 10000 // cast(paid as hugeint) as whole,
         cast(abs(gained) as hugeint) * 10000 % cast(paid as hugeint) as rest
  from resolved where reject_reason is null
),
even_shares as (
  select *, (whole + case when 2 * rest > paid or (2 * rest = paid and whole % 2 = 1)
                          then 1 else 0 end) * case when gained < 0 then -1 else 1 end
            as hundredths
  from shares
),
fact as (
  select row_number() over (order by date_key, order_id, product_id) as sales_key,
         date_key, customer_key, product_key, order_id, quantity, unit_price, total_amount,
         cast((paid - gained) * {HUNDREDTH} as decimal(12,2)) as cost_amount,
         cast(gained * {HUNDREDTH} as decimal(12,2)) as profit_amount,
         cast(cast(greatest(least(hundredths, 99999), -99999) as decimal(18,0))
              * {HUNDREDTH} as decimal(5,2)) as profit_margin,
         cast(order_date as timestamp) as order_timestamp, registration_date
  from even_shares
)
"""

FACT_COLUMNS = (
    "sales_key, date_key, customer_key, product_key, order_id, quantity, unit_price, "
    "total_amount, cost_amount, profit_amount, profit_margin, order_timestamp"
)
MEASURES = FACT_COLUMNS.removeprefix("sales_key, ")
_KEPT = "processed_flag, error_message"
_LOAD_TIME = "timestamp '2001-06-30 02:00:00' as load_timestamp"
_FLAG = "error_message is null as processed_flag"
_OPEN = f"{_LOAD_TIME}, false as processed_flag, cast(null as varchar) as error_message"


def _agg_grain(keys: str, buyers: str) -> str:
    mean = rounded(cents("sum(unit_price)"), "100 * count(unit_price)", 2, "decimal(10,2)")
    group = ", ".join(k for k in keys.split(", ") if not k.startswith("cast("))
    return f"""
  select {keys}, {ITEMS} as total_quantity, {money('total_amount')} as total_amount,
         {mean} as avg_unit_price, {ORDERS} as order_count, {buyers} as unique_customers
  from fact group by {group}"""


AGG = ("select date_key, customer_key, product_key, total_quantity, total_amount, "
       "avg_unit_price, order_count, unique_customers from (" + " union all by name ".join([
           _agg_grain("date_key, cast(null as bigint) as customer_key, "
                      "cast(null as bigint) as product_key", BUYERS),
           _agg_grain("date_key, customer_key, cast(null as bigint) as product_key",
                      "cast(1 as bigint)"),
           _agg_grain("date_key, cast(null as bigint) as customer_key, product_key", BUYERS),
       ]) + ")")


def _scd2(first: str, second: str, key: str, natural: str, attributes: str,
          tracked: str) -> str:
    """Versions after a second batch one day later."""
    differs = " or ".join(f"o.{c} is distinct from n.{c}" for c in tracked.split(", "))
    old = ", ".join(f"o.{c}" for c in attributes.split(", "))
    new = ", ".join(f"n.{c}" for c in attributes.split(", "))
    return f"""
, old_versions as (
  select row_number() over (order by {natural}) as {key}, {natural}, {attributes} from ({first})
),
new_rows as (select {natural}, {attributes} from ({second})),
paired as (
  select o.{natural} as old_id, n.{natural} as new_id, ({differs}) as differs,
         coalesce(o.{natural}, n.{natural}) as any_id
  from old_versions o full outer join new_rows n on o.{natural} = n.{natural}
),
opened as (
  select any_id, row_number() over (order by any_id)
         + (select count(*) from old_versions) as {key}
  from paired where new_id is not null and (old_id is null or differs)
)
select o.{key}, o.{natural}, {old}, date '2001-06-30' as valid_from,
       case when p.new_id is not null and p.differs then date '2001-06-30' end as valid_to,
       not (p.new_id is not null and p.differs) as is_current
from old_versions o join paired p on p.old_id = o.{natural}
union all
select w.{key}, n.{natural}, {new}, date '2001-07-01', null, true
from opened w join new_rows n on n.{natural} = w.any_id
"""


_BY_DATE = "fact join dim_date using (date_key)"
_BY_CUSTOMER = "fact join dim_customer using (customer_key)"
_MONTHLY = f"""
select "year", "month", month_name, {money('total_amount')} as monthly_sales,
       {money('profit_amount')} as monthly_profit, {ORDERS} as order_count,
       {BUYERS} as customer_count
from {_BY_DATE} group by "year", "month", month_name"""
_DAILY_TREND = f"""
select full_date, day_name, month_name, "year", {money('total_amount')} as daily_sales,
       {money('profit_amount')} as daily_profit, {ITEMS} as daily_quantity,
       {ORDERS} as daily_orders
from {_BY_DATE} {{where}} group by full_date, day_name, month_name, "year" order by 1"""
_TOP_PRODUCTS = f"""
select product_name, category, {ITEMS} as total_quantity,
       {money('total_amount')} as revenue, {money('profit_amount')} as profit,
       {mean_percent('fact.profit_margin')} as avg_margin
from fact join dim_product using (product_key) {{where}}
group by product_name, category
order by revenue desc, product_name, category limit {{limit}}"""


def _hourly(source: str, item: str, amount: str, time: str) -> str:
    return f"""
select cast(hour({time}) as integer) as hour_of_day, count(distinct {item}) as order_count,
       {money(amount)} as hourly_sales, {mean_money(amount)} as avg_order_value
from {source} where {time} is not null group by 1 order by 1"""


def _running(name: str, period: str) -> str:
    return f"""
, daily as (
  select full_date, "year", "month", {money('total_amount')} as daily_sales
  from {_BY_DATE} group by 1, 2, 3
)
select full_date, daily_sales,
       cast(sum(daily_sales) over (partition by {period} order by full_date
            rows unbounded preceding) as decimal(22,2)) as {name}
from daily"""


_PRODUCT_VIEW = f"""
, sold as (
  select product_key, product_id, product_name, category, subcategory, supplier, cost_price,
         msrp, p.profit_margin as expected_margin, {ORDERS} as times_ordered,
         {ITEMS} as total_quantity_sold, {money('total_amount')} as total_revenue,
         {money('cost_amount')} as total_cost, {money('profit_amount')} as total_profit,
         {mean_percent('f.profit_margin')} as actual_margin,
         cast(sum(quantity) * cost_price as decimal(22,2)) as inventory_cost
  from fact f join dim_product p using (product_key)
  where is_current
  group by product_key, product_id, product_name, category, subcategory, supplier,
           cost_price, msrp, p.profit_margin
),
ranked as (
  select *, rank() over (order by total_revenue desc) as revenue_rank,
         rank() over (order by total_profit desc) as profit_rank,
         cast(sum(total_revenue) over (partition by category) as decimal(22,2))
           as category_revenue,
         cast(sum(times_ordered) over (partition by category) as bigint) as category_orders
  from sold
)"""

_ZERO = "cast(coalesce({}, 0) as decimal(22,2))"


def _invariants() -> str:
    parts = [
        f"select 'amount of {grain} grain differs from facts', "
        + _ZERO.format(f"abs((select sum(total_amount) from fact) - (select sum(total_amount) "
                       f"from agg where {where}))")
        for grain, where in (
            ("day", "customer_key is null and product_key is null"),
            ("customer", "customer_key is not null"), ("product", "product_key is not null"))
    ]
    for name in ("customer", "product"):
        parts.append(
            f"select '{name} without exactly one current version', " + _ZERO.format(
                f"(select count(*) from (select {name}_id from dim_{name} group by 1 "
                f"having count(*) filter (is_current) <> 1))"))
    parts.append("select 'fact key repeated', " + _ZERO.format(
        "(select count(*) from (select 1 from fact group by order_id, product_key "
        "having count(*) > 1))"))
    for name in ("customer", "product", "date"):
        parts.append(
            f"select 'facts without {name}', " + _ZERO.format(
                f"(select count(*) from fact where {name}_key not in "
                f"(select {name}_key from dim_{name}))"))
    parts.append("select 'staged sales neither valid, invalid nor removed', " + _ZERO.format(
        "abs((select count(*) from sales) - (select count(*) from kept) - (select count(*) from "
        "sales where staging_id not in (select staging_id from kept)))"))
    parts.append("select 'valid sales neither loaded nor rejected', " + _ZERO.format(
        "(select count(*) from valid_sales) - (select count(*) from fact) - (select count(*) "
        "from resolved where reject_reason is not null)"))
    parts.append("select 'facts differ from sales taken', " + _ZERO.format(
        "abs((select count(*) from fact) - (select count(*) from resolved "
        "where reject_reason is null))"))
    body = " union all ".join(parts)
    return f', agg as ({AGG}) select "check", n from ({body}) as t("check", n)'


_BODIES = {
    "stage_sales": f"""
select staging_id, order_id, order_date, customer_id, product_id, quantity, unit_price,
       total_amount, file_name, {_OPEN} from raw_sales""",
    "stage_customers": f"""
select staging_id, customer_id, customer_name, email, phone, address, city, country,
       registration_date, file_name, {_OPEN} from raw_customers""",
    "stage_products": f"""
select staging_id, product_id, product_name, category, subcategory, supplier, cost_price,
       msrp, file_name, {_OPEN} from raw_products""",
    "extract_sales": """
select order_id, order_date, customer_id, product_id, quantity, unit_price, total_amount
from raw_sales""",
    "extract_customers": """
select customer_id, ' "' || customer_name || '", ' as customer_name, email, phone, address,
       city, country, registration_date from raw_customers""",
    "extract_customer_lines": """
select customer_id, customer_name || chr(10) || '"' || city || '"' || chr(10) as customer_name,
       email, phone, address, city, country, registration_date from raw_customers""",
    "extract_products": """
select product_id, product_name, category, subcategory, supplier, cost_price, msrp
from raw_products""",
    "pending_files": "select distinct file_name from raw_sales where file_name >= 'sales_199901'",
    "ledger_status": """
select process_id, status, event_time, event_id from (
  select user_id as process_id, event_type as status, ts as event_time, event_id,
         row_number() over (partition by user_id order by ts desc, event_id desc) as place
  from events) where place = 1""",
    "validate_sales": f"""
select staging_id, order_id, product_id, {_FLAG}, error_message from sales""",
    "dedup_sales": f"""
select staging_id, order_id, product_id, {_FLAG}, error_message from kept""",
    "clean_sales": """
select staging_id, order_id, order_date, customer_id, product_id, quantity, unit_price,
       total_amount from valid_sales""",
    "clean_customers": f"""
select staging_id, customer_id, customer_name, email, phone, address, city, country,
       registration_date, file_name, {_FLAG}, error_message from customers""",
    "validate_customers": f"""
select staging_id, customer_id, {_FLAG}, error_message from customers""",
    "clean_products": f"""
select staging_id, product_id, product_name, category, subcategory, supplier, cost_price,
       msrp, file_name, {_FLAG}, error_message from products""",
    "validate_products": f"""
select staging_id, product_id, {_FLAG}, error_message from products""",
    "quality_summary": """
select table_name, coalesce(error_message, 'Valid') as outcome, count(*) as row_count
from (select 'sales' as table_name, error_message from sales
      union all select 'customers', error_message from customers
      union all select 'products', error_message from products)
group by 1, 2""",
    "customer_segment": "select customer_id, country, city, customer_segment from segments",
    "distinct_customers": f"select distinct customer_id, {_CUSTOMER_ATTRIBUTES} from segments",
    "dim_date": "select * from dim_date",
    "dim_customer": "select * from dim_customer",
    "dim_product": "select * from dim_product",
    "scd2_customers": _scd2(
        "select * from segments where country <> 'MIDDLE EAST'",
        """select * replace (case when city = 'NATION_3' then 'NATION_3 EAST' else city end
                               as city,
                             cast(registration_date + 1 as date) as registration_date)
           from segments where country <> 'AFRICA'""",
        "customer_key", "customer_id", _CUSTOMER_ATTRIBUTES,
        "customer_name, email, phone, address, city, country"),
    "scd2_products": _scd2(
        "select * from margins",
        """select * replace (case when category = 'STANDARD'
                                  then cast(cost_price * cast(0.9 as decimal(2,1))
                                            as decimal(10,2))
                                  else cost_price end as cost_price)
           from margins where supplier <> 'Brand#1'""",
        "product_key", "product_id", _PRODUCT_ATTRIBUTES,
        "product_name, category, subcategory, supplier, cost_price, msrp"),
    "fact_sales": f"select {FACT_COLUMNS} from fact",
    "full_run": f"select {FACT_COLUMNS} from fact",
    "stream_run": f"select {FACT_COLUMNS} from fact",
    "published_views": f"""
select country, city, {BUYERS} as customer_count, {ORDERS} as order_count,
       {money('total_amount')} as total_sales, {BUYERS} as customers,
       {money('total_amount')} as lifetime_value
from fact join dim_customer using (customer_key)
where is_current and country is not null and city is not null group by country, city""",
    "fact_rejects": """
select staging_id, order_id, customer_id, product_id, order_date, reject_reason
from resolved where reject_reason is not null""",
    "fact_reject_counts": """
select reject_reason, count(*) as row_count from resolved
where reject_reason is not null group by 1""",
    "fact_insert_ignore": f"""
select {MEASURES} from (
  select * replace (cast(case when order_timestamp < timestamp '1999-01-01'
                              then -total_amount else total_amount end as decimal(12,2))
                    as total_amount) from fact)""",
    "incremental_facts": f"""
select {MEASURES}, case when registration_date < date '1997-01-01' then 1 else 2 end as run
from fact""",
    "fact_reload_after_version": f"select {MEASURES}, 1 as run from fact",
    "agg_sales_daily": f"""
select cast(cast(date_key as bigint) * 274877906944
            + case when customer_key is not null then 1 when product_key is not null then 2
                   else 0 end * 68719476736
            + coalesce(customer_key, product_key, 0) as bigint) as agg_key, *
from ({AGG})""",
    "agg_daily_union": AGG,
    "agg_daily_grouping_sets": AGG,
    "daily_sales": f"""
select full_date, day_name, {money('total_amount')} as daily_sales, {ITEMS} as total_quantity,
       {ORDERS} as order_count, {BUYERS} as customer_count
from {_BY_DATE} group by full_date, day_name order by full_date desc limit 30""",
    "top_customers": f"""
select customer_name, city, country, {money('total_amount')} as total_spent,
       {ORDERS} as order_count, {mean_money()} as avg_order_value
from {_BY_CUSTOMER} where is_current group by customer_name, city, country
order by total_spent desc, customer_name, city, country limit 10""",
    "product_performance": f"""
select product_name, category, subcategory, {ITEMS} as total_quantity,
       {money('total_amount')} as revenue, {money('cost_amount')} as cost,
       {money('profit_amount')} as profit, {mean_percent('fact.profit_margin')} as avg_margin
from fact join dim_product using (product_key) where is_current
group by product_name, category, subcategory
order by profit desc, product_name, category, subcategory limit 20""",
    "monthly_trend": f'{_MONTHLY} order by "year" desc, "month" desc',
    "monthly_performance": f"""
select *, concat(month_name, ' ', "year") as month_year from ({_MONTHLY})
order by "year", "month\"""",
    "segment_analysis": f"""
select customer_segment, {BUYERS} as customer_count,
       {money('total_amount')} as segment_revenue, {mean_money()} as avg_customer_value,
       {rounded(ORDERS, BUYERS, 4, 'decimal(22,4)')} as avg_orders_per_customer
from {_BY_CUSTOMER} where is_current group by customer_segment
order by segment_revenue desc, customer_segment""",
    "hourly_pattern": _hourly("fact", "order_id", "total_amount", "order_timestamp"),
    "hourly_events": _hourly(
        f"""(select ts, event_id, cast(cast(cast(round("value" * 100) as bigint)
             as decimal(18,0)) * {HUNDREDTH} as decimal(12,2)) as amount from events)""",
        "event_id", "amount", "ts"),
    "yoy_growth": f"""
, by_month as (
  select "year", "month", month_name, {money('total_amount')} as sold
  from {_BY_DATE} group by 1, 2, 3
)
select cur."year", cur."month", cur.month_name, cur.sold as monthly_sales,
       prev.sold as prev_year_sales,
       {rounded(f"100 * ({cents('cur.sold')} - {cents('prev.sold')})", cents('prev.sold'), 2,
                'decimal(18,2)')} as yoy_growth_percent
from by_month cur
     left join by_month prev on prev."month" = cur."month" and prev."year" = 2000
where cur."year" = 2001 order by 1 desc, 2 desc""",
    "category_performance": f"""
select category, count(distinct product_key) as product_count, {ITEMS} as total_quantity,
       {money('total_amount')} as category_revenue, {money('profit_amount')} as category_profit,
       {rounded(f"100 * {cents('sum(profit_amount)')}", cents('sum(total_amount)'), 2,
                'decimal(18,2)')} as category_margin
from fact join dim_product using (product_key) where is_current
group by category order by category_profit desc, category""",
    "retention": f"""
, last_years as (
  select c.customer_key, cast(year(c.registration_date) as integer) as registration_year,
         year(max(f.order_timestamp)) as last_year
  from dim_customer c left join fact f on f.customer_key = c.customer_key
  where c.is_current group by c.customer_key, c.registration_date
)
select registration_year, count(customer_key) as total_customers,
       count(*) filter (last_year >= registration_year) as retained_customers,
       {rounded('100 * count(*) filter (last_year >= registration_year)',
                'count(customer_key)', 2, 'decimal(18,2)')} as retention_rate
from last_years group by registration_year order by registration_year desc""",
    "sales_by_geography": f"""
select country, city, {BUYERS} as customer_count, {money('total_amount')} as regional_sales,
       {ORDERS} as order_count, {mean_money()} as avg_order_value
from {_BY_CUSTOMER} where is_current group by country, city
order by regional_sales desc, country, city""",
    "sales_view": """
select f.sales_key, f.order_id, f.order_timestamp, f.quantity, f.unit_price, f.total_amount,
       f.cost_amount, f.profit_amount, f.profit_margin, d.full_date, d."year", d."month",
       d.month_name, d."quarter", d.day_of_week, d.day_name, d.is_weekend, c.customer_id,
       c.customer_name, c.email, c.phone, c.city, c.country, c.customer_segment,
       c.registration_date, p.product_id, p.product_name, p.category, p.subcategory,
       p.supplier, p.cost_price, p.msrp, p.profit_margin as product_profit_margin
from fact f, dim_date d, dim_customer c, dim_product p
where f.date_key = d.date_key and f.customer_key = c.customer_key
  and f.product_key = p.product_key and c.is_current and p.is_current""",
    "daily_aggregates": f"""
, daily as (
  select full_date, "year", "month", month_name, day_name, is_weekend,
         {ORDERS} as order_count, {BUYERS} as customer_count, {ITEMS} as total_quantity,
         {money('total_amount')} as total_sales, {money('cost_amount')} as total_cost,
         {money('profit_amount')} as total_profit, {mean_percent()} as avg_profit_margin
  from {_BY_DATE} group by all
),
recent as (
  select *, sum(total_sales) over w as seven, count(*) over w as present
  from daily window w as (order by full_date rows between 6 preceding and current row)
)
select * exclude (seven, present),
       {rounded(cents('seven'), '100 * present', 6, 'decimal(24,6)')} as weekly_moving_avg,
       total_sales as mtd_sales, total_sales as ytd_sales
from recent""",
    "mtd_running": _running("mtd_sales", '"year", "month"'),
    "ytd_running": _running("ytd_sales", '"year"'),
    "customer_analysis": f"""
, per_customer as (
  select customer_key, customer_id, customer_name, city, country, customer_segment,
         c.registration_date, {ORDERS} as total_orders, {ITEMS} as total_quantity,
         {money('total_amount')} as lifetime_value, {mean_money()} as avg_order_value,
         cast(date '2001-06-30' - max(full_date) as integer) as days_since_last_order,
         date '2001-06-30' - min(full_date) as active_days
  from fact f join dim_customer c using (customer_key) join dim_date d using (date_key)
  where is_current
  group by customer_key, customer_id, customer_name, city, country, customer_segment,
           c.registration_date
)
select * exclude (active_days),
       {rounded('total_orders * 3044', '100 * active_days', 4, 'decimal(22,4)')}
         as monthly_frequency,
       case when lifetime_value > 10000 then 'VIP' when lifetime_value > 5000 then 'Premium'
            when lifetime_value > 1000 then 'Regular' else 'Basic' end as customer_tier
from per_customer""",
    "product_performance_view": f"{_PRODUCT_VIEW} select * from ranked",
    "product_ranks_spread": f"""{_PRODUCT_VIEW}
select product_key, total_revenue, total_profit, revenue_rank, profit_rank,
       category_revenue, category_orders from ranked""",
    "geographic_analysis": f"""
select country, city, {BUYERS} as customer_count, {ORDERS} as order_count,
       {ITEMS} as total_quantity, {money('total_amount')} as total_sales,
       {money('profit_amount')} as total_profit,
       {rounded(cents('sum(total_amount)'), f'100 * {BUYERS}', 6, 'decimal(24,6)')}
         as sales_per_customer,
       {rounded('sum(quantity)', BUYERS, 4, 'decimal(22,4)')} as quantity_per_customer,
       cast(coalesce(sum(total_amount) filter (full_date >= date '2001-05-31'), 0)
            as decimal(22,2)) as last_30_days_sales,
       cast(coalesce(sum(total_amount) filter (full_date >= date '2001-04-01'), 0)
            as decimal(22,2)) as last_90_days_sales
from fact join dim_customer using (customer_key) join dim_date using (date_key)
where is_current group by country, city""",
    "kpi_summary": f"""
select {money('total_amount')} as total_sales, {money('profit_amount')} as total_profit,
       {ITEMS} as total_quantity, {ORDERS} as order_count, {mean_percent()} as avg_margin
from fact""",
    "kpi_export": f"""
select "Metric", "Value" from (
  select cast({money('total_amount')} as varchar) as "Total Sales",
         cast({money('profit_amount')} as varchar) as "Total Profit",
         cast({ITEMS} as varchar) as "Quantity Sold",
         cast({ORDERS} as varchar) as "Total Orders",
         cast({mean_percent()} as varchar) as "Avg Margin"
  from fact) unpivot ("Value" for "Metric" in (*))""",
    "daily_trend": _DAILY_TREND.format(where=""),
    "daily_trend_filtered": _DAILY_TREND.format(
        where="where full_date between date '1997-03-01' and date '1998-02-28'"),
    "top_products": _TOP_PRODUCTS.format(where="", limit=20),
    "top_products_10": _TOP_PRODUCTS.format(where="", limit=10),
    "top_products_filtered": _TOP_PRODUCTS.format(where="where category = 'ECONOMY'", limit=20),
    "product_categories": "select distinct category from dim_product order by 1",
    "customers_by_place": f"""
select city, country, customer_segment, {BUYERS} as customer_count,
       {money('total_amount')} as total_sales, {ORDERS} as order_count,
       {mean_money()} as avg_order_value
from {_BY_CUSTOMER} group by city, country, customer_segment""",
    "segment_sales": f"""
select customer_segment, {money('total_amount')} as total_sales
from {_BY_CUSTOMER} group by customer_segment""",
    "validation": f"""
select 'Total Customers' as label,
       (select cast(count(*) as varchar) from dim_customer where is_current) as "value"
union all
select 'Total Products', (select cast(count(*) as varchar) from dim_product where is_current)
union all select 'Total Sales Records', (select cast(count(*) as varchar) from fact)
union all select 'Total Sales Amount',
                 (select cast({money('total_amount')} as varchar) from fact)
union all select 'Unique Orders', (select cast({ORDERS} as varchar) from fact)
union all select 'Date Range Start', (select cast(min(full_date) as varchar) from dim_date)
union all select 'Date Range End', (select cast(max(full_date) as varchar) from dim_date)""",
    "warehouse_invariants": _invariants(),
}


def _base_for(body: str) -> str:
    """The base definitions which a statement refers to, directly or through others."""
    parts = re.split(r"(?m)^(?=\w+ as \()", BASE.strip())
    names = {part.split(" ", 1)[0]: part.rstrip().rstrip(",") for part in parts}
    needed: set[str] = set()
    texts = [body]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for name in (words & names.keys()) - needed:
            needed.add(name)
            texts.append(names[name].split("(", 1)[1])
    return ",\n".join(text for name, text in names.items() if name in needed)


def statements() -> dict[str, str]:
    out = {}
    for name, body in _BODIES.items():
        base, body = _base_for(body), body.strip()
        head = f"with {base}" if base else ""
        if body.startswith(",") and not base:
            head, body = "with", body[1:]
        out[name] = f"{head}\n{body}"
    return out
