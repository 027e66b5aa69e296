"""Reports, curation and dimension queries with their reference SQL."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from registry import views_sql as V
from registry.views_sql import big, count_share, half_up, money, share, with_views
from tillspark import constants as K
from tillspark.constants import Band
from tillspark.functions.money import line_amount
from tillspark.functions.parsing import nan_to_null, nullable_id, parse_timestamp
from tillspark.functions.sales import cancellation_flag
from tillspark.operators import dedup, dimensions, rollups, sketches
from tillspark.plans import curate, customers, geography, kpis, products, search
from tillspark.session import staged
from tillspark.sources import star_views as S

HOME = S.HOME_COUNTRY

# spend and price bands that fit the test tables' price level
SPEND_BANDS = (
    Band("VIP", low=Decimal("1000000")),
    Band("High", low=Decimal("600000"), high=Decimal("999999.99")),
    Band("Mid", low=Decimal("300000"), high=Decimal("599999.99")),
)
PRICE_BANDS = (
    Band("Low", below=Decimal("930")),
    Band("Middle", low=Decimal("930"), high=Decimal("960")),
    Band("High", low=Decimal("960.01"), high=Decimal("990")),
)


def band_label(value: str, bands, rest: str) -> str:
    """SQL for the label of the first band that holds ``value``: a range join on the bands."""

    def bound(number, default: str) -> str:
        return default if number is None else str(number)

    rows = ", ".join(
        f"({i}, '{b.label}', {bound(b.low, '-1e18')}, {bound(b.high, '1e18')}, {bound(b.below, '1e18')})"
        for i, b in enumerate(bands)
    )
    return f"""coalesce((select arg_min(label, place) from (values {rows}) bands(place, label, low, high, below)
      where {value} >= low and {value} <= high and {value} < below), '{rest}')"""


QUERIES = {}
ORACLE = {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep


def on_facts(name: str, report, sql: str | None = None):
    """Register a report over the sales fact."""
    register(name, sql and with_views(V.FACT) + sql)(lambda spark, sf: report(S.sales_lines(spark, sf)))


# --- whole-business figures ---------------------------------------------------

on_facts(
    "kpi_summary",
    kpis.kpi_summary,
    f"""select count(distinct invoice_no) as total_invoices, count(*) as total_line_items,
      {big('case when is_cancellation = 0 then quantity else 0 end')} as units_sold,
      {big('case when is_cancellation = 1 then abs(quantity) else 0 end')} as units_returned,
      {money('case when is_cancellation = 0 then gross_amount else 0 end')} as total_gross_sales,
      {money('case when is_cancellation = 1 then abs(gross_amount) else 0 end')} as total_returns,
      {money('gross_amount')} as net_revenue
    from fact_sales""",
)

on_facts(
    "monthly_cumulative",
    kpis.monthly_cumulative,
    f"""select transaction_year, transaction_month, count(distinct invoice_no) as total_orders,
      {big('quantity')} as net_items_sold, {money('gross_amount')} as net_monthly_revenue,
      cast(sum(sum(gross_amount)) over (order by transaction_year, transaction_month) as decimal(24,2))
        as cumulative_revenue
    from fact_sales where is_cancellation = 0 group by transaction_year, transaction_month""",
)


def _kpi_sql(where: str) -> str:
    """Per invoice first, with conditional sums as filters; ratios come last."""
    sold, gone = "filter (where is_cancellation = 0)", "filter (where is_cancellation = 1)"
    guest = "filter (where is_cancellation = 0 and customer_id is null)"
    return f""", slice as (select * from fact_sales where {where}),
    invoices as (select invoice_no, count(*) as line_count, count(*) {gone} as gone_lines,
        count(*) {guest} as guest_lines, sum(quantity) {sold} as units, sum(gross_amount) as net,
        sum(gross_amount) {sold} as gross, sum(gross_amount) {gone} as gone, sum(gross_amount) {guest} as guest
      from slice group by invoice_no),
    sums as (select {big('line_count')} as total_records, count(*) as total_orders,
        (select count(distinct customer_id) from slice) as active_customers, {big('units')} as units_sold,
        {money('gross')} as gross_sales, {money('gone')} as cancellation_amount, {money('net')} as net_sales,
        {big('gone_lines')} as cancellation_records, count(*) filter (where gone_lines > 0) as cancelled_orders,
        {big('guest_lines')} as guest_records, {money('guest')} as guest_sales
      from invoices)
    select sums.*, total_orders - cancelled_orders as valid_orders,
      coalesce(cast(gross_sales as double) / nullif(greatest(total_orders - cancelled_orders, 0), 0), 0.0) as aov,
      coalesce(cast(cancelled_orders as double) / nullif(total_orders, 0) * 100, 0.0) as return_rate_pct,
      case when gross_sales > 0 then {share('guest_sales', 'gross_sales')} else 0 end as guest_pct
    from sums"""


on_facts("sales_kpis", kpis.sales_kpis, _kpi_sql("true"))
on_facts(
    "sales_kpis_domestic",
    lambda facts: kpis.sales_kpis(facts, region=K.DOMESTIC_SLICE, domestic=HOME),
    _kpi_sql(f"country = '{HOME}'"),
)
on_facts(
    "sales_kpis_international_year",
    lambda facts: kpis.sales_kpis(facts, 1997, K.INTERNATIONAL_SLICE, domestic=HOME),
    _kpi_sql(f"transaction_year = 1997 and country <> '{HOME}'"),
)
on_facts(
    "sales_kpis_country",
    lambda facts: kpis.sales_kpis(facts, region="NATION_7"),
    _kpi_sql("country = 'NATION_7'"),
)
on_facts(
    "sales_kpis_empty_slice",
    lambda facts: kpis.sales_kpis(facts, region="Atlantis"),
    _kpi_sql("country = 'Atlantis'"),
)


def _trend_sql(where: str) -> str:
    sold = "case when is_cancellation = 0 then gross_amount else 0 end"
    return f"""select transaction_year, transaction_month,
      cast(transaction_year as varchar) || '-' || lpad(cast(transaction_month as varchar), 2, '0') as period_ym,
      count(distinct invoice_no) as total_orders,
      {big('case when is_cancellation = 0 then quantity else 0 end')} as units_sold,
      {money(sold)} as gross_sales,
      {money('case when is_cancellation = 1 then abs(gross_amount) else 0 end')} as refunds,
      {money('gross_amount')} as net_sales,
      {half_up(f'sum({sold})', 'count(distinct case when is_cancellation = 0 then invoice_no end)')}
        as avg_order_value
    from fact_sales where {where} group by transaction_year, transaction_month"""


on_facts("sales_trends", kpis.sales_trends, _trend_sql("true"))
on_facts(
    "sales_trends_domestic_year",
    lambda facts: kpis.sales_trends(facts, 1997, K.DOMESTIC_SLICE, domestic=HOME),
    _trend_sql(f"transaction_year = 1997 and country = '{HOME}'"),
)

on_facts(
    "sales_by_day",
    kpis.sales_by_day,
    f"""select dayname(invoice_date) as day_name, cast(dayofweek(invoice_date) + 1 as integer) as day_num,
      count(distinct invoice_no) as order_count, {money('gross_amount')} as total_sales
    from fact_sales where is_cancellation = 0 group by all""",
)

register(
    "sales_by_hour",
    with_views(V.TIMED)
    + f"""select cast(hour(invoice_date) as integer) as order_hour,
      count(distinct invoice_no) as order_count, {money('gross_amount')} as total_sales
    from timed_sales where is_cancellation = 0 group by all""",
)(lambda spark, sf: kpis.sales_by_hour(S.timed_sales(spark, sf)))

on_facts(
    "cancellation_analysis",
    kpis.cancellation_analysis,
    f"""select count(distinct case when is_cancellation = 1 then invoice_no end) as total_cancellations,
      {count_share('count(distinct case when is_cancellation = 1 then invoice_no end)',
                   'count(distinct invoice_no)')} as cancellation_rate_pct,
      {money('case when is_cancellation = 1 then abs(gross_amount) else 0 end')} as total_refunded_value
    from fact_sales""",
)

on_facts(
    "average_order_value",
    kpis.average_order_value,
    f"""select count(*) as completed_invoices, {half_up('sum(t)', 'count(*)')} as avg_order_value,
      cast(min(t) as decimal(24,2)) as min_order_value, cast(max(t) as decimal(24,2)) as max_order_value
    from (select invoice_no, sum(gross_amount) as t from fact_sales
          where is_cancellation = 0 group by invoice_no)""",
)

on_facts(
    "guest_vs_registered",
    kpis.guest_vs_registered,
    f"""select *, {share('total_gross_sales', 'sum(total_gross_sales) over ()')} as revenue_share_pct
    from (select case when customer_id is null then 'Guest Checkout' else 'Registered Customer' end
             as checkout_type, count(distinct invoice_no) as distinct_invoices,
             count(*) as total_line_items, {money('gross_amount')} as total_gross_sales
          from fact_sales where is_cancellation = 0 group by 1)""",
)

# --- products -------------------------------------------------------------------

_TOP = f"""select stock_code, description, {big('quantity')} as total_units,
      {money('gross_amount')} as total_revenue,
      {half_up('sum(unit_price)', 'count(unit_price)')} as avg_unit_price
    from fact_sales where is_cancellation = 0 and %s
    group by stock_code, description order by %s desc, stock_code, description limit %d"""

on_facts("top_products_revenue", products.top_products, _TOP % ("true", "total_revenue", 10))
on_facts(
    "top_products_units",
    lambda facts: products.top_products(facts, 25, order_by="units"),
    _TOP % ("true", "total_units", 25),
)
on_facts(
    "top_products_international",
    lambda facts: products.top_products(facts, 15, region=K.INTERNATIONAL_SLICE, domestic=HOME),
    _TOP % (f"country <> '{HOME}'", "total_revenue", 15),
)
on_facts(
    "top_products_ranked",
    products.top_products_ranked,
    f"""select * from (select stock_code, coalesce(description, 'UNKNOWN') as description,
        {big('quantity')} as units_sold, {money('gross_amount')} as total_revenue,
        cast(dense_rank() over (order by sum(gross_amount) desc) as integer) as revenue_rank
      from fact_sales where is_cancellation = 0 and unit_price > 0 group by stock_code, description)
    order by revenue_rank, stock_code, description limit 10""",
)
on_facts(
    "top_returned_products",
    products.top_returned_products,
    f"""select stock_code, coalesce(description, 'UNKNOWN') as description,
      {big('abs(quantity)')} as total_returned_units, {money('abs(gross_amount)')} as total_returned_value
    from fact_sales where is_cancellation = 1 group by stock_code, fact_sales.description
    order by total_returned_units desc, stock_code, description limit 10""",
)


def _tier_sql(table: str, label: str) -> str:
    return f"""select {label} as price_tier, count(*) as transaction_lines,
      {big('quantity')} as units_sold, {money('gross_amount')} as total_revenue
    from {table} where is_cancellation = 0 group by 1"""


register(
    "price_tiers",
    with_views(V.TIMED) + _tier_sql("timed_sales", band_label("unit_price", K.PRICE_BANDS, K.PRICE_BAND_REST)),
)(lambda spark, sf: products.price_tiers(S.timed_sales(spark, sf)))

on_facts(
    "price_tiers_by_bands",
    lambda facts: products.price_tiers(facts, PRICE_BANDS, "Top"),
    _tier_sql("fact_sales", band_label("unit_price", PRICE_BANDS, "Top")),
)

_SEARCH = """select stock_code, description, total_units_sold as total_units,
      latest_unit_price as unit_price,
      cast(total_units_sold * latest_unit_price as decimal(18,2)) as estimated_revenue,
      first_sold_at as first_sale, last_sold_at as latest_sale
    from dim_products where stock_code {like} '%{term}%' or description {like} '%{term}%'
    order by total_units_sold desc, stock_code limit 25"""

register(
    "product_search", with_views(V.FACT, V.DIM_PRODUCTS_LAKE) + _SEARCH.format(like="ilike", term="RING")
)(
    lambda spark, sf: products.product_search(
        dimensions.dim_products_lake(S.sales_lines(spark, sf)), "RING"
    )
)
register(
    "product_search_exact_case",
    with_views(V.FACT, V.DIM_PRODUCTS) + _SEARCH.format(like="like", term="b_ue"),
)(
    lambda spark, sf: products.product_search(
        dimensions.dim_products(S.sales_lines(spark, sf)), "b_ue", case_sensitive=True
    )
)

# --- dimensions -----------------------------------------------------------------

for _name, _build, _view in (
    ("dim_products", dimensions.dim_products, V.DIM_PRODUCTS),
    ("dim_customers", dimensions.dim_customers, V.DIM_CUSTOMERS),
    ("dim_products_lake", dimensions.dim_products_lake, V.DIM_PRODUCTS_LAKE),
    ("dim_customers_lake", dimensions.dim_customers_lake, V.DIM_CUSTOMERS_LAKE),
):
    on_facts(_name, _build, f", {_view} select * from {_name.removesuffix('_lake')}")

# --- customers ------------------------------------------------------------------


def on_lake_customers(name: str, report, sql: str):
    register(name, with_views(V.FACT, V.DIM_CUSTOMERS_LAKE) + sql)(
        lambda spark, sf: report(dimensions.dim_customers_lake(S.sales_lines(spark, sf)))
    )


_TIER_REST = f"""count(*) as customer_count, {money('total_spend')} as tier_revenue,
      {half_up('sum(total_orders)', 'count(total_orders)', 1, 1)} as avg_orders_per_customer
    from dim_customers group by 1"""

def _spend_sql(bands, rest: str) -> str:
    return f"select {band_label('total_spend', bands, rest)} as spend_tier, " + _TIER_REST


on_lake_customers(
    "customer_tiers",
    lambda dim: customers.customer_tiers(dim, SPEND_BANDS, "Budget"),
    _spend_sql(SPEND_BANDS, "Budget"),
)
# spending in hundredths brings the customers into the default bands
register(
    "customer_tiers_default_bounds",
    with_views(V.FACT, V.DIM_CUSTOMERS_LAKE)
    + ", cents as (select * replace (cast(total_spend / 100 as decimal(14,2)) as total_spend) from dim_customers) "
    + _spend_sql(K.SPEND_BANDS, K.SPEND_BAND_REST).replace("from dim_customers", "from cents"),
)(
    lambda spark, sf: customers.customer_tiers(
        dimensions.dim_customers_lake(S.sales_lines(spark, sf)).withColumn(
            "total_spend", (F.col("total_spend") / 100).cast("decimal(14,2)")
        )
    )
)
on_lake_customers(
    "top_vips",
    customers.top_vips,
    f"""select customer_id, country, total_orders, total_spend,
      {half_up('total_spend', 'total_orders')} as avg_order_value, first_order_date, last_order_date
    from dim_customers order by total_spend desc, customer_id limit 10""",
)
register(
    "top_customers",
    with_views(V.FACT, V.DIM_CUSTOMERS)
    + """select customer_id, country, total_orders, total_spend as lifetime_spend,
      first_order_date, last_order_date
    from dim_customers order by total_spend desc, customer_id limit 10""",
)(lambda spark, sf: customers.top_customers(dimensions.dim_customers(S.sales_lines(spark, sf))))

# --- geography ------------------------------------------------------------------

_GEO = f"""geography as (select country, count(distinct invoice_no) as total_orders,
      {big('case when is_cancellation = 0 then quantity else 0 end')} as total_units,
      {money('case when is_cancellation = 0 then gross_amount else 0 end')} as gross_sales,
      {money('gross_amount')} as net_sales,
      count(distinct customer_id) as distinct_customers,
      {half_up('sum(case when is_cancellation = 0 then gross_amount else 0 end)',
               'count(distinct case when is_cancellation = 0 then invoice_no end)')} as avg_order_value
    from fact_sales group by country)"""


def on_geography(name: str, report, sql: str):
    register(name, with_views(V.FACT, _GEO) + sql)(
        lambda spark, sf: report(geography.geographic_sales(S.sales_lines(spark, sf)))
    )


on_geography("geographic_sales", lambda geo: geo, "select * from geography")
on_geography(
    "domestic_export_split",
    lambda geo: geography.domestic_export_split(geo, HOME),
    f"""select domestic_sales, export_sales, domestic_pct,
      cast(100 - domestic_pct as decimal(18,2)) as export_pct, market_count,
      best.country as top_export_country, best.gross_sales as top_export_sales,
      best.total_orders as top_export_orders
    from (select {money(f"case when country = '{HOME}' then gross_sales end")} as domestic_sales,
            {money(f"case when country <> '{HOME}' then gross_sales end")} as export_sales,
            {share(f"sum(case when country = '{HOME}' then gross_sales else 0 end)", 'sum(gross_sales)')}
              as domestic_pct, count(*) as market_count from geography) f,
         (select * from geography where country <> '{HOME}'
          order by gross_sales desc, country limit 1) best""",
)
on_geography(
    "top_export_countries",
    lambda geo: geography.top_export_countries(geo, domestic=HOME),
    f"""select * from geography where country <> '{HOME}'
    order by gross_sales desc, country limit 10""",
)
on_facts(
    "country_share",
    geography.country_share,
    f"""select country, order_count, units_sold, total_revenue,
      {share('total_revenue', 'sum(total_revenue) over ()')} as revenue_pct
    from (select country, count(distinct invoice_no) as order_count, {big('quantity')} as units_sold,
            {money('gross_amount')} as total_revenue
          from fact_sales where is_cancellation = 0 group by country)
    order by total_revenue desc, country limit 15""",
)
on_facts("country_list", geography.country_list, "select distinct country from fact_sales")

# --- search ---------------------------------------------------------------------

_MATCH = """(invoice_no ilike '%{t}%' or stock_code ilike '%{t}%' or description ilike '%{t}%'
      or cast(customer_id as varchar) ilike '%{t}%')"""
_FOUND = """select invoice_no, invoice_date, customer_id, country, stock_code, description, quantity,
      unit_price, gross_amount,
      case when is_cancellation = 1 then 'Returned' else 'Completed' end as order_status
    from fact_sales where %s
    order by invoice_date desc, invoice_no, stock_code, quantity, unit_price,
      customer_id nulls first, country limit 50"""

on_facts("order_search", search.order_search, _FOUND % "true")
on_facts(
    "order_search_returned_text",
    lambda facts: search.order_search(
        facts, text="Gear", country="NATION_3", status=K.RETURNED_ORDERS
    ),
    _FOUND % (_MATCH.format(t="Gear") + " and country = 'NATION_3' and is_cancellation = 1"),
)
on_facts(
    "filtered_totals",
    lambda facts: search.result_totals(
        search.matching_lines(facts, text="12", status=K.COMPLETED_ORDERS)
    ),
    f"""select count(*) as record_count, {money('gross_amount')} as gross_sales
    from fact_sales where {_MATCH.format(t='12')} and is_cancellation = 0""",
)

# --- curation -------------------------------------------------------------------

_FEED_VIEWS = (V.FEED, V.TYPED, V.CURATED)


def _curated(spark, sf):
    """Curated frame in wall-clock time, without the per-run lineage columns."""
    df = curate.curate(S.sales_feed(spark, sf), S.SOURCE_SYSTEM)
    return df.drop("source_system", "ingestion_timestamp").withColumn(
        "invoice_date", F.col("invoice_date").cast("timestamp_ntz")
    )


register("curate_sales", with_views(*_FEED_VIEWS) + "select * from curated")(_curated)

register(
    "curation_metrics",
    with_views(*_FEED_VIEWS)
    + f"""select count(*) as total_records, count(distinct invoice_no) as unique_invoices,
      count(distinct stock_code) as unique_products, count(distinct customer_id) as unique_customers,
      count(*) filter (customer_id is null) as guest_order_records,
      count(*) filter (is_cancellation = 1) as cancellation_records,
      min(invoice_date) as min_invoice_date, max(invoice_date) as max_invoice_date,
      {money('gross_amount')} as total_gross_amount from curated""",
)(lambda spark, sf: rollups.curation_metrics(_curated(spark, sf)))

register(
    "approximate_metrics",
    with_views(*_FEED_VIEWS)
    + f"""select count(*) as total_records, true as invoices_within, true as products_within,
      true as customers_within, count(*) filter (customer_id is null) as guest_order_records,
      count(*) filter (is_cancellation = 1) as cancellation_records,
      min(invoice_date) as min_invoice_date, max(invoice_date) as max_invoice_date,
      {money('gross_amount')} as total_gross_amount from curated""",
)(lambda spark, sf: _approximate(spark, sf))


def _approximate(spark, sf):
    """The one-scan metrics, each estimate compared with the exact count."""
    curated = staged(_curated(spark, sf).select(*rollups.METRIC_COLUMNS), "curated-metrics")
    exact = rollups.curation_metrics(curated, stored=True).first()
    found = rollups.approximate_metrics(curated)
    close = {
        f"{short}_within": sketches.within_error(F.col(f"unique_{short}"), F.lit(exact[f"unique_{short}"]))
        for short in ("invoices", "products", "customers")
    }
    return found.withColumns(close).drop("unique_invoices", "unique_products", "unique_customers")


register(
    "curation_counters",
    with_views(*_FEED_VIEWS)
    + """select total as initial_raw_records, cast(0 as bigint) as malformed_records,
      total - usable as rejected_records, usable - kept as duplicates_removed,
      kept as final_curated_records
    from (select count(*) as total, count(invoice_date) as usable from typed_sales),
         (select count(*) as kept from curated)""",
)(lambda spark, sf: curate.curation_counters(S.sales_feed(spark, sf)))

register(
    "rejected_sales",
    with_views(V.FEED)
    + """select trim(invoice_raw) as invoice_no, upper(trim(stock_raw)) as stock_code,
      coalesce(nullif(trim(description_raw), ''), 'UNKNOWN DESCRIPTION') as description, quantity,
      unit_price, cast(try_cast(nullif(trim(customer_raw), '') as double) as integer) as customer_id,
      trim(country_raw) as country, date_raw as raw_invoice_date,
      'unreadable invoice date' as reject_reason
    from sales_feed where """
    + V.PARSED_DATE
    + " is null",
)(lambda spark, sf: curate.rejected_sales(S.sales_feed(spark, sf)))

register(
    "parse_multi_format_ts",
    with_views(V.FEED)
    + f"""select trim(invoice_raw) as invoice_no, date_raw, {V.PARSED_DATE} as invoice_date
    from sales_feed""",
)(
    lambda spark, sf: S.sales_feed(spark, sf).select(
        F.trim("InvoiceNo").alias("invoice_no"),
        F.col("InvoiceDate").alias("date_raw"),
        parse_timestamp(F.col("InvoiceDate")).cast("timestamp_ntz").alias("invoice_date"),
    )
)

register(
    "nullable_customer_id",
    with_views(V.FEED)
    + """select customer_raw, cast(try_cast(nullif(trim(customer_raw), '') as double) as integer)
      as customer_id, count(*) as line_count from sales_feed group by all""",
)(
    lambda spark, sf: S.sales_feed(spark, sf)
    .groupBy(F.col("CustomerID").alias("customer_raw"))
    .agg(F.count("*").alias("line_count"))
    .withColumn("customer_id", nullable_id(F.col("customer_raw")))
)

register(
    "cancellation_flag",
    with_views(V.FEED)
    + """select trim(invoice_raw) as invoice_no, quantity,
      case when starts_with(trim(invoice_raw), 'C') or quantity < 0 then 1 else 0 end as is_cancellation
    from sales_feed""",
)(
    lambda spark, sf: S.sales_feed(spark, sf).select(
        F.trim("InvoiceNo").alias("invoice_no"),
        F.col("Quantity").alias("quantity"),
        cancellation_flag(F.trim("InvoiceNo"), F.col("Quantity")).alias("is_cancellation"),
    )
)

register(
    "gross_amount",
    with_views(V.FEED)
    + """select quantity, unit_price, cast(quantity * unit_price as decimal(12,2)) as gross_amount
    from sales_feed""",
)(
    lambda spark, sf: S.sales_feed(spark, sf).select(
        F.col("Quantity").alias("quantity"),
        F.col("UnitPrice").alias("unit_price"),
        line_amount(F.col("Quantity"), F.col("UnitPrice")).alias("gross_amount"),
    )
)


def _delivered_twice(spark, sf):
    """The whole fact delivered two times, the second time with another description."""
    facts = S.sales_lines(spark, sf)
    return facts.unionByName(facts.withColumn("description", F.upper("description")))


register(
    "dedup_sales",
    with_views(V.FACT)
    + """select * exclude (rn) from (select *, row_number() over (
        partition by invoice_no, stock_code, invoice_date, quantity
        order by description nulls first, unit_price nulls first, customer_id nulls first,
                 country nulls first) as rn
      from (select * from fact_sales union all by name
            select * replace (upper(description) as description) from fact_sales))
    where rn = 1""",
)(lambda spark, sf: dedup.first_per_key(_delivered_twice(spark, sf), K.SALES_KEY))

# --- table-level checks -----------------------------------------------------------

register(
    "table_row_counts",
    with_views(V.FACT, V.DIM_PRODUCTS, V.DIM_CUSTOMERS)
    + """select 'fact_sales' as table_name, count(*) as row_count from fact_sales
    union all select 'dim_products', count(*) from dim_products
    union all select 'dim_customers', count(*) from dim_customers""",
)(
    lambda spark, sf: rollups.table_counts(
        {
            "fact_sales": S.sales_lines(spark, sf),
            "dim_products": dimensions.dim_products(S.sales_lines(spark, sf)),
            "dim_customers": dimensions.dim_customers(S.sales_lines(spark, sf)),
        }
    )
)

register(
    "nan_to_null",
    """select event_id, case when event_type = 'error' then null else value end as value from events""",
)(
    lambda spark, sf: nan_to_null(
        S.table(spark, sf, "events").select(
            "event_id",
            F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        )
    )
)
