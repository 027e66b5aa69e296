"""The retail views over the star-schema test tables, as DuckDB SQL."""

from __future__ import annotations

TOTAL = "decimal(24,2)"


def half_up(part: str, whole: str, digits: int = 2, part_scale: int = 100, whole_scale: int = 1) -> str:
    """Exact ``part / whole`` rounded half-up, by integer arithmetic.

    The scales turn ``part`` and ``whole`` into integers: 100 for money, 1 for a count.
    """
    top = f"cast(({part}) * {part_scale} as hugeint) * {10**digits * whole_scale}"
    below = f"({part_scale} * cast(({whole}) * {whole_scale} as hugeint))"
    rounded = f"((2 * abs({top}) + {below}) // (2 * nullif({below}, 0)))"
    unit = "0." + "0" * (digits - 1) + "1"
    return f"cast(cast(sign({top}) * {rounded} as decimal(28,0)) * {unit} as decimal(18,{digits}))"


def share(part: str, whole: str) -> str:
    """Exact percentage of two money totals, half-up."""
    return half_up(f"({part}) * 100", whole, whole_scale=100)


def count_share(part: str, whole: str) -> str:
    """Exact percentage of two counts, half-up."""
    return half_up(f"({part}) * 100", whole, part_scale=1)


def money(expr: str) -> str:
    return f"cast(coalesce(sum({expr}), 0) as {TOTAL})"


def big(expr: str) -> str:
    return f"cast(coalesce(sum({expr}), 0) as bigint)"


JOINED = """
  from lineitem
  join orders on l_orderkey = o_orderkey
  join part on l_partkey = p_partkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
"""

INVOICE_NO = "concat(case when l_returnflag = 'R' then 'C' else '' end, cast(l_orderkey as varchar))"
QUANTITY = "cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end as integer)"
PRICE = "cast(p_retailprice as decimal(10,2))"

FACT = f"""fact_sales as (
  select {INVOICE_NO} as invoice_no,
         cast(l_partkey as varchar) as stock_code,
         p_name as description,
         {QUANTITY} as quantity,
         o_orderdate as invoice_date,
         {PRICE} as unit_price,
         case when c_mktsegment = 'HOUSEHOLD' then null else cast(o_custkey as integer) end as customer_id,
         n_name as country,
         cast({QUANTITY} * {PRICE} as decimal(12,2)) as gross_amount,
         case when l_returnflag = 'R' then 1 else 0 end as is_cancellation,
         cast(year(o_orderdate) as integer) as transaction_year,
         cast(month(o_orderdate) as integer) as transaction_month
  {JOINED}
)"""

FEED = f"""sales_feed as (
  select ' ' || {INVOICE_NO} || ' ' as invoice_raw,
         '  p' || cast(l_partkey as varchar) || ' ' as stock_raw,
         case when p_size = 1 then '  ' else p_name end as description_raw,
         {QUANTITY} as quantity,
         case n_regionkey
              when 0 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              when 1 then strftime(o_orderdate, '%-m/%-d/%Y %-H:%M')
              when 2 then strftime(o_orderdate, '%Y-%m-%d')
              when 3 then strftime(o_orderdate, '%d/%m/%Y %H:%M')
              else 'not a date' end as date_raw,
         {PRICE} as unit_price,
         case when c_mktsegment = 'HOUSEHOLD' then '' else cast(o_custkey as varchar) || '.0' end as customer_raw,
         ' ' || n_name as country_raw
  {JOINED}
)"""

PARSED_DATE = """coalesce(try_strptime(date_raw, '%Y-%m-%d %H:%M:%S'),
         try_strptime(date_raw, '%m/%d/%Y %H:%M'),
         try_strptime(date_raw, '%d/%m/%Y %H:%M'),
         try_strptime(date_raw, '%Y-%m-%d'))"""

TYPED = f"""typed_sales as (
  select trim(invoice_raw) as invoice_no,
         upper(trim(stock_raw)) as stock_code,
         coalesce(nullif(trim(description_raw), ''), 'UNKNOWN DESCRIPTION') as description,
         quantity,
         {PARSED_DATE} as invoice_date,
         unit_price,
         cast(try_cast(nullif(trim(customer_raw), '') as double) as integer) as customer_id,
         coalesce(nullif(trim(country_raw), ''), 'Unknown') as country,
         cast(quantity * unit_price as decimal(12,2)) as gross_amount,
         case when starts_with(trim(invoice_raw), 'C') or quantity < 0 then 1 else 0 end as is_cancellation
  from sales_feed
)"""

CURATED = """curated as (
  select * exclude (rn) from (
    select *, cast(year(invoice_date) as integer) as transaction_year,
           cast(month(invoice_date) as integer) as transaction_month,
           row_number() over (
             partition by invoice_no, stock_code, invoice_date, quantity
             order by description nulls first, unit_price nulls first,
                      customer_id nulls first, country nulls first) as rn
    from typed_sales where invoice_no is not null and invoice_date is not null)
  where rn = 1
)"""

TIMED = """timed_sales as (
  select cast(event_id as varchar) as invoice_no, ts as invoice_date, 1 as quantity,
         cast(value as decimal(10,2)) as unit_price,
         cast(cast(value as decimal(10,2)) as decimal(12,2)) as gross_amount,
         case when event_type = 'error' then 1 else 0 end as is_cancellation
  from events
)"""

RUNS = """runs as (
  select 'RUN_' || cast(user_id as varchar) as run_id, 'sales_pipeline' as pipeline_name,
         ts as start_time, ts + to_seconds(cast(trunc(value) as integer)) as end_time,
         case when event_type = 'error' then 'FAILED' else 'COMPLETED' end as status,
         event_id as records_processed,
         cast(case when event_type = 'error' then 1 else 0 end as bigint) as records_rejected,
         case when event_type = 'error' then event_type end as error_message,
         props as metrics_json, ts + to_seconds(cast(trunc(value) as integer)) as logged_at
  from events
)"""

RAW_ORDERS = f"""raw_orders as (
  select cast(l_orderkey as varchar) as order_id,
         case when o_orderstatus = 'O' then strftime(o_orderdate, '%Y/%m/%d')
              else strftime(o_orderdate, '%Y-%m-%d') end as order_date,
         case when c_mktsegment = 'HOUSEHOLD' then ' ' else cast(o_custkey as varchar) end as customer_id,
         cast(l_partkey as varchar) as product_id,
         cast({QUANTITY} as varchar) || case l_linenumber % 3 when 1 then '.0' when 2 then '.7' else '' end as quantity,
         case when p_size = 1 then 'n/a' else cast({PRICE} as varchar) end as unit_price,
         case when l_linestatus = 'F' then cast(cast(l_discount * 100 as decimal(5,2)) as varchar) end as discount,
         ' ' || lower(r_name) || '   zone' as region,
         case when l_linestatus = 'F' then 'card' else ' ' end as payment_method,
         case o_orderstatus when 'O' then '' when 'F' then 'in FULL delivery' else 'pending' end as order_status,
         'STAR_SCHEMA' as source_system,
         strftime(l_shipdate, '%Y-%m-%d') as ingestion_timestamp
  {JOINED} join region on n_regionkey = r_regionkey
)"""

# title case, word by word: first letter upper, the rest lower
TITLE = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"

CLEAN_ORDERS = f"""clean_orders as (
  select * exclude (rn) from (
    select *, row_number() over (partition by order_id, product_id order by order_date nulls first,
             customer_id nulls first, quantity nulls first, unit_price nulls first, discount nulls first,
             region nulls first, payment_method nulls first, order_status nulls first,
             source_system nulls first, ingestion_timestamp nulls first) as rn
    from (
      select trim(order_id) as order_id,
             cast(try_strptime(replace(trim(order_date), '/', '-'), '%Y-%m-%d') as date) as order_date,
             trim(customer_id) as customer_id, trim(product_id) as product_id,
             try_cast(trunc(try_cast(trim(quantity) as double)) as integer) as quantity,
             try_cast(trim(unit_price) as decimal(10,2)) as unit_price,
             coalesce(try_cast(trim(discount) as decimal(5,2)), 0.00::decimal(5,2)) as discount,
             {TITLE.format("regexp_replace(coalesce(nullif(trim(region), ''), 'Unknown'), '\\s+', ' ', 'g')")} as region,
             coalesce(nullif(trim(payment_method), ''), 'Unknown') as payment_method,
             {TITLE.format("coalesce(nullif(trim(order_status), ''), 'Completed')")} as order_status,
             trim(source_system) as source_system,
             trim(ingestion_timestamp) as ingestion_timestamp
      from raw_orders))
  where rn = 1
)"""

ORDER_LINES = f"""order_lines as (
  select l_orderkey as order_id, l_linenumber as line_number, cast(o_orderdate as date) as order_date,
         o_custkey as customer_id, l_partkey as product_id, cast(l_suppkey as varchar) as store_id,
         p_type as category, {QUANTITY} as quantity, {PRICE} as unit_price,
         cast(l_discount * 100 as decimal(5,2)) as discount, o_orderstatus as order_status
  {JOINED}
)"""

GROSS = "cast(quantity * unit_price as decimal(12,2))"
DISCOUNT = f"cast(round({GROSS} * discount * 0.01, 2) as decimal(12,2))"

PRICED = f"""priced as (
  select *, {GROSS} as gross_amount, {DISCOUNT} as discount_amount,
         cast({GROSS} - {DISCOUNT} as decimal(12,2)) as net_amount
  from order_lines
)"""

DAILY = f"""daily as (
  select order_date as sale_date, store_id, category,
         count(distinct order_id) as total_orders, {big('quantity')} as total_items_sold,
         {money('gross_amount')} as gross_revenue, {money('discount_amount')} as total_discount,
         {money('net_amount')} as net_revenue
  from priced group by all
)"""

DIM_PRODUCTS = f"""dim_products as (
  select stock_code, arg_max(description, rk) as description,
         arg_max(unit_price, rk) as latest_unit_price,
         min(invoice_date) as first_sold_at, max(invoice_date) as last_sold_at,
         {big('quantity')} as total_units_sold
  from (select *, row_number() over (partition by stock_code order by invoice_date, invoice_no,
               unit_price, description) as rk from fact_sales)
  group by stock_code
)"""

DIM_CUSTOMERS = """dim_customers as (
  select customer_id, arg_min(country, rk) as country, count(distinct invoice_no) as total_orders,
         cast(sum(gross_amount) as decimal(14,2)) as total_spend,
         min(invoice_date) as first_order_date, max(invoice_date) as last_order_date
  from (select *, row_number() over (partition by customer_id order by invoice_date, invoice_no,
               country) as rk from fact_sales where customer_id is not null)
  group by customer_id
)"""

DIM_PRODUCTS_LAKE = f"""dim_products as (
  select stock_code, max(description) as description,
         {big('case when is_cancellation = 0 then quantity else 0 end')} as total_units_sold,
         cast({half_up('sum(unit_price)', 'count(unit_price)')} as decimal(10,2)) as latest_unit_price,
         min(invoice_date) as first_sold_at, max(invoice_date) as last_sold_at
  from fact_sales group by stock_code
)"""

DIM_CUSTOMERS_LAKE = """dim_customers as (
  select customer_id, max(country) as country, count(distinct invoice_no) as total_orders,
         cast(sum(gross_amount) as decimal(14,2)) as total_spend,
         min(invoice_date) as first_order_date, max(invoice_date) as last_order_date
  from fact_sales where customer_id is not null and is_cancellation = 0
  group by customer_id
)"""


def with_views(*views: str) -> str:
    return "with " + ",\n".join(views) + "\n"
