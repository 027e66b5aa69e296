"""Order lines, keyed loads and data quality queries with their reference SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry import views_sql as V
from registry.sales_queries import ORACLE, register
from registry.views_sql import big, count_share, money, with_views
from tillspark import constants as K
from tillspark.operators import dedup, dimensions, joins, merge, quality, rollups, sketches
from tillspark.plans import health, order_lines, reload, rolled, search
from tillspark.plans import warehouse as warehouse_plan
from tillspark.session import (
    DROP_SHUFFLES, FILES_AT_ONCE, SMALL_READS, delete_path, input_bytes, settings, shared_folder, staged, staging
)
from tillspark.sinks import buckets
from tillspark.sinks.versions import Change, TextIndex, VersionedTable
from tillspark.sources import star_views as S
from tillspark.sources.lake import read_lake

# A first load up to the end of 1999, and a later batch that delivers 1998 on again:
# together they cover every order, and two years arrive twice.
STORED_UNTIL = "2000-01-01"
BATCH_FROM = "1998-01-01"


def _stored(df, day: str):
    return df.where(F.col(day) < F.lit(STORED_UNTIL).cast("date"))


def _batch(df, day: str):
    return df.where(F.col(day) >= F.lit(BATCH_FROM).cast("date"))


def _split(view: str, day: str) -> str:
    return f"""stored as (select * from {view} where {day} < date '{STORED_UNTIL}'),
    batch as (select * from {view} where {day} >= date '{BATCH_FROM}')"""


# --- order lines ------------------------------------------------------------------

register("clean_orders", with_views(V.RAW_ORDERS, V.CLEAN_ORDERS) + "select * from clean_orders")(
    lambda spark, sf: order_lines.clean_order_lines(S.raw_orders(spark, sf))
)

register(
    "dedup_order_lines",
    with_views(V.ORDER_LINES)
    + """select * exclude (rn) from (select *, row_number() over (partition by order_id, product_id
        order by line_number, order_date, customer_id, store_id, category, quantity, unit_price,
                 discount, order_status) as rn from order_lines) where rn = 1""",
)(lambda spark, sf: dedup.first_per_key(S.order_lines(spark, sf), K.ORDER_LINE_KEY))

register("sales_financials", with_views(V.ORDER_LINES, V.PRICED) + "select * from priced")(
    lambda spark, sf: rollups.with_financials(S.order_lines(spark, sf))
)


def _priced(spark, sf):
    return rollups.with_financials(S.order_lines(spark, sf))


register(
    "daily_summary",
    with_views(V.ORDER_LINES, V.PRICED)
    + f"""select order_date, count(distinct order_id) as total_orders, {big('quantity')} as total_items,
      {money('gross_amount')} as gross_revenue, {money('discount_amount')} as total_discounts,
      {money('net_amount')} as net_revenue, count(distinct customer_id) as unique_customers
    from priced group by order_date""",
)(lambda spark, sf: rollups.daily_summary(_priced(spark, sf)))


def _daily(spark, sf):
    return rollups.daily_sales(_priced(spark, sf).withColumnRenamed("order_date", "sale_date"))


register("daily_sales_agg", with_views(V.ORDER_LINES, V.PRICED, V.DAILY) + "select * from daily")(_daily)

# --- dimension joins ----------------------------------------------------------------

_PRODUCTS = """left join part p on o.product_id = p.p_partkey"""
_CUSTOMERS = """left join (select * from customer join nation on c_nationkey = n_nationkey) c
      on o.customer_id = c.c_custkey"""
_CONTACTS = "left join supplier c on o.customer_id = c.s_suppkey"
_PRODUCT_COLUMNS = """p_name as product_name, p_type as product_category, p_brand as product_brand,
      p_retailprice as catalog_price, p_size as catalog_stock"""

register(
    "enrich_products",
    with_views(V.ORDER_LINES) + f"select o.*, {_PRODUCT_COLUMNS} from order_lines o {_PRODUCTS}",
)(lambda spark, sf: joins.with_products(S.order_lines(spark, sf), S.product_catalog(spark, sf)))


def _enriched(spark, sf, people=S.customer_master):
    return joins.enrich_order_lines(
        S.order_lines(spark, sf), S.product_catalog(spark, sf), people(spark, sf)
    )


register(
    "enrich_sales",
    with_views(V.ORDER_LINES)
    + f"""select o.*, {_PRODUCT_COLUMNS}, c_name as customer_name, c_mktsegment as customer_city,
      cast(null as varchar) as customer_state, n_name as customer_country
    from order_lines o {_PRODUCTS} {_CUSTOMERS}""",
)(_enriched)



def _buckets(df) -> int:
    """At least eight, and more as a stored table grows: a bucket is one task."""
    return max(8, buckets.bucket_count(df.count()))


def _co_partitioned(spark, sf):
    """The enriched lines from tables bucketed by customer, the products joined as usual."""
    folder = f"{shared_folder(spark)}/buckets-{uuid.uuid4().hex}"
    lines = staged(joins.with_products(S.order_lines(spark, sf), S.product_catalog(spark, sf)), "lines")
    fact = buckets.write_buckets(lines, f"{folder}/lines", ["customer_id"], buckets=_buckets(lines))
    people = buckets.write_buckets(
        S.customer_master(spark, sf), f"{folder}/people", ["customer_id"], buckets=fact.buckets, hot=False
    )
    return buckets.with_attributes(fact, people, joins.CUSTOMER_ATTRIBUTES)


register("co_partitioned_sales", ORACLE["enrich_sales"])(_co_partitioned)


def _bucketed_upsert(spark, sf):
    folder = f"{shared_folder(spark)}/buckets-{uuid.uuid4().hex}"
    stored, batch = _loaded_lines(spark, sf)
    kept = staged(stored, "stored")
    table = buckets.write_buckets(kept, f"{folder}/lines", K.ORDER_LINE_KEY, buckets=_buckets(kept))
    return buckets.upsert_buckets(table, batch, f"{folder}/loaded", order=["line_number"]).read()


register(
    "orphans_after_enrichment",
    with_views(V.ORDER_LINES)
    + f"""select order_id, line_number, o.customer_id from order_lines o {_CONTACTS}
    where s_name is null""",
)(
    lambda spark, sf: joins.unmatched_after_enrichment(_enriched(spark, sf, S.supplier_contacts)).select(
        "order_id", "line_number", "customer_id"
    )
)

_KNOWN = "(select s_suppkey from supplier)"

register(
    "fk_orphans",
    with_views(V.ORDER_LINES)
    + f"""select customer_id, count(*) as row_count from order_lines
    where customer_id not in {_KNOWN} group by customer_id""",
)(
    lambda spark, sf: joins.orphan_keys(
        S.order_lines(spark, sf), "customer_id", S.supplier_contacts(spark, sf), "customer_id"
    )
)

register(
    "fk_orphan_rows",
    with_views(V.ORDER_LINES) + f"select * from order_lines where customer_id not in {_KNOWN}",
)(
    lambda spark, sf: joins.orphan_rows(
        S.order_lines(spark, sf), "customer_id", S.supplier_contacts(spark, sf), "customer_id"
    )
)

register(
    "orphan_customers",
    with_views(V.FACT)
    + f"""select count(distinct customer_id) as orphan_count from fact_sales
    where customer_id is not null and customer_id not in {_KNOWN}""",
)(
    lambda spark, sf: joins.orphan_key_count(
        S.sales_lines(spark, sf), "customer_id", S.supplier_contacts(spark, sf), "customer_id"
    )
)

# --- keyed loads ----------------------------------------------------------------------

register(
    "merge_insert_ignore",
    with_views(V.FACT, _split("fact_sales", "invoice_date"))
    + """, fresh as (select * exclude (rn) from (select *, row_number() over (
        partition by invoice_no, stock_code, invoice_date, quantity
        order by description, unit_price, customer_id nulls first, country) as rn from batch b
      where not exists (select 1 from stored s where s.invoice_no = b.invoice_no
        and s.stock_code = b.stock_code and s.invoice_date = b.invoice_date
        and s.quantity = b.quantity)) where rn = 1)
    select * from stored union all by name select * from fresh""",
)(
    lambda spark, sf: merge.insert_ignore(
        _stored(S.sales_lines(spark, sf), "invoice_date"),
        _batch(S.sales_lines(spark, sf), "invoice_date"),
        K.SALES_KEY,
    )
)


def _loaded_lines(spark, sf):
    """Stored lines as first priced; the batch repeats them with the discount raised."""
    stored = rollups.with_financials(
        dedup.first_per_key(_stored(S.order_lines(spark, sf), "order_date"), K.ORDER_LINE_KEY)
    )
    changed = _batch(S.order_lines(spark, sf), "order_date").withColumn(
        "discount", (F.col("discount") + 1).cast("decimal(5,2)")
    )
    return stored, rollups.with_financials(changed)


register(
    "merge_upsert",
    with_views(V.ORDER_LINES)
    + f""", priced_stored as (select *, {V.GROSS} as gross_amount, {V.DISCOUNT} as discount_amount,
        cast({V.GROSS} - {V.DISCOUNT} as decimal(12,2)) as net_amount
      from (select * exclude (rn) from (select *, row_number() over (partition by order_id, product_id
          order by line_number, order_date, customer_id, store_id, category, quantity, unit_price,
                   discount, order_status) as rn
        from order_lines where order_date < date '{STORED_UNTIL}') where rn = 1)),
    priced_batch as (select *, {V.GROSS} as gross_amount, {V.DISCOUNT} as discount_amount,
        cast({V.GROSS} - {V.DISCOUNT} as decimal(12,2)) as net_amount
      from (select * replace (cast(discount + 1 as decimal(5,2)) as discount) from order_lines
            where order_date >= date '{BATCH_FROM}')),
    last_batch as (select * exclude (rn) from (select *, row_number() over (
        partition by order_id, product_id order by line_number desc, order_date desc, customer_id desc,
          store_id desc, category desc, quantity desc, unit_price desc, discount desc,
          order_status desc) as rn from priced_batch) where rn = 1)
    select * from last_batch
    union all by name
    select * from priced_stored s where not exists (select 1 from last_batch b
      where b.order_id = s.order_id and b.product_id = s.product_id)""",
)(
    lambda spark, sf: merge.upsert(
        *_loaded_lines(spark, sf), K.ORDER_LINE_KEY, order=["line_number"]
    )
)

register("bucketed_upsert", ORACLE["merge_upsert"])(_bucketed_upsert)


def _dimension_sql(view: str, key: str, columns: list[str], frozen: str) -> str:
    """Partial upsert of a dimension: ``frozen`` keeps the stored value."""
    name = view.split(" ", 1)[0]
    stored = view.replace(f"{name} as", "old_dim as", 1).replace("fact_sales", "stored")
    batch = view.replace(f"{name} as", "new_dim as", 1).replace("fact_sales", "batch")
    picked = ", ".join(
        f"coalesce(o.{c}, n.{c}) as {c}"
        if c == frozen
        else f"case when n.{key} is not null then n.{c} else o.{c} end as {c}"
        for c in columns
    )
    return (
        with_views(V.FACT, _split("fact_sales", "invoice_date"), stored, batch)
        + f"select coalesce(o.{key}, n.{key}) as {key}, {picked} "
        f"from old_dim o full outer join new_dim n on o.{key} = n.{key}"
    )


register(
    "merge_upsert_partial",
    _dimension_sql(
        V.DIM_PRODUCTS,
        "stock_code",
        ["description", "latest_unit_price", "first_sold_at", "last_sold_at", "total_units_sold"],
        "first_sold_at",
    ),
)(
    lambda spark, sf: merge.upsert(
        dimensions.dim_products(_stored(S.sales_lines(spark, sf), "invoice_date")),
        dimensions.dim_products(_batch(S.sales_lines(spark, sf), "invoice_date")),
        ["stock_code"],
        frozen=["first_sold_at"],
    )
)
register(
    "merge_customer_dimension",
    _dimension_sql(
        V.DIM_CUSTOMERS,
        "customer_id",
        ["country", "total_orders", "total_spend", "first_order_date", "last_order_date"],
        "first_order_date",
    ),
)(
    lambda spark, sf: merge.upsert(
        dimensions.dim_customers(_stored(S.sales_lines(spark, sf), "invoice_date")),
        dimensions.dim_customers(_batch(S.sales_lines(spark, sf), "invoice_date")),
        ["customer_id"],
        frozen=["first_order_date"],
    )
)

register(
    "merge_daily_aggregates",
    with_views(V.ORDER_LINES, V.PRICED, V.DAILY, _split("daily", "sale_date"))
    + """select * from batch union all by name
    select * from stored s where not exists (select 1 from batch b where b.sale_date = s.sale_date
      and b.store_id = s.store_id and b.category = s.category)""",
)(
    lambda spark, sf: merge.upsert(
        _stored(_daily(spark, sf), "sale_date"),
        _batch(_daily(spark, sf), "sale_date"),
        K.DAILY_SALES_KEY,
    )
)


# Together the stored part and the feed hold every product: those up to size 35 are stored,
# one price change behind, and the feed brings those from size 16 on, without a stock column.
STORED_UP_TO, FEED_FROM = 35, 16


def _synced_products(spark, sf):
    price = F.col("price").cast("decimal(10,2)")
    catalog = S.product_catalog(spark, sf).withColumn("price", price)
    stored = catalog.where(F.col("stock") <= STORED_UP_TO).withColumn("price", (price - 1).cast("decimal(10,2)"))
    feed = catalog.where(F.col("stock") >= FEED_FROM).drop("stock")
    return merge.upsert(stored, feed, ["product_id"])


register(
    "sync_products",
    f"""select p_partkey as product_id, p_name as product_name, p_type as category, p_brand as brand,
      cast(p_retailprice - case when p_size >= {FEED_FROM} then 0 else 1 end as decimal(10,2)) as price,
      case when p_size <= {STORED_UP_TO} then p_size end as stock from part""",
)(_synced_products)

# Key parts go missing where the part has a certain size, in every such line of the table.
_GAPS_SQL = """gaps as (select * replace (case when p_size % 7 = 0 then null else stock_code end as stock_code,
    case when p_size % 5 = 0 then null else quantity end as quantity)
  from fact_sales join part on stock_code = cast(p_partkey as varchar))"""


def _with_gaps(spark, sf):
    sizes = S.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("stock_code"), "p_size")
    lines = S.sales_lines(spark, sf).join(sizes, "stock_code")
    return lines.withColumns(
        {
            "stock_code": F.when(F.col("p_size") % 7 != 0, F.col("stock_code")),
            "quantity": F.when(F.col("p_size") % 5 != 0, F.col("quantity")),
        }
    ).select("invoice_no", "stock_code", "invoice_date", "quantity", "unit_price", "country")


register(
    "merge_null_keys",
    with_views(V.FACT, _GAPS_SQL)
    + """select invoice_no, stock_code, invoice_date, quantity, max(unit_price) as unit_price,
      max(country) as country
    from gaps group by invoice_no, stock_code, invoice_date, quantity""",
)(
    lambda spark, sf: merge.upsert(
        merge.latest_per_key(_stored(_with_gaps(spark, sf), "invoice_date"), K.SALES_KEY, ["unit_price"]),
        _batch(_with_gaps(spark, sf), "invoice_date"),
        K.SALES_KEY,
        order=["unit_price"],
    )
)

# --- incremental warehouse ------------------------------------------------------------

_DEDUPED = """deduped as (select * exclude (rn) from (select *, row_number() over (
    partition by invoice_no, stock_code, invoice_date, quantity
    order by description, unit_price, customer_id nulls first, country) as rn from fact_sales) where rn = 1)"""


def _two_loads(spark, sf):
    """A new warehouse after two loads: the stored part, then the batch that overlaps it."""
    warehouse = f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex}"
    lines = S.sales_lines(spark, sf).withColumns(
        {"source_system": F.lit(S.SOURCE_SYSTEM), "ingestion_timestamp": F.lit(STORED_UNTIL).cast("timestamp")}
    )
    # looked at several times in each load, for its months, its keys and its rows
    lines = staged(lines, "loads")
    for part in (_stored(lines, "invoice_date"), _batch(lines, "invoice_date")):
        warehouse_plan.load_fact(spark, part, warehouse)
        warehouse_plan.refresh_dimensions(spark, warehouse)
    return warehouse


def _loaded(spark, sf, name: str):
    table = warehouse_plan.read_table(spark, _two_loads(spark, sf), name)
    return table.select(
        *[F.col(f.name).cast("timestamp_ntz") if f.dataType.typeName().startswith("timestamp") else f.name for f in table.schema]
    )


register("incremental_fact", with_views(V.FACT, _DEDUPED) + "select * from deduped")(
    lambda spark, sf: _loaded(spark, sf, "fact_sales").drop("source_system", "ingestion_timestamp")
)
for _name, _view in (("dim_products", V.DIM_PRODUCTS), ("dim_customers", V.DIM_CUSTOMERS)):
    register(
        f"incremental_{_name}",
        with_views(V.FACT, _DEDUPED, _view.replace("fact_sales", "deduped")) + f"select * from {_name}",
    )(lambda spark, sf, name=_name: _loaded(spark, sf, name))

# --- kept roll-ups: the same reports from them, over the whole fact in two loads ------------


def _rolled(spark, sf) -> rolled.Rollups:
    lines = S.sales_lines(spark, sf)
    later = F.col("invoice_date") >= F.lit(STORED_UNTIL).cast("date")
    loads = [lines.where(~later), lines.where(later)]
    kept = [staged(k.made(loads[0]).unionByName(k.made(loads[1])), name) for name, k in rolled.ROLLUPS.items()]
    return rolled.Rollups(*kept)


for _name, _report in (
    ("kpi_summary", rolled.Rollups.kpi_summary),
    ("sales_kpis", rolled.Rollups.sales_kpis),
    ("sales_trends", rolled.Rollups.sales_trends),
    ("geographic_sales", rolled.Rollups.geographic_sales),
    ("top_products_revenue", lambda r: r.top_products(10, "revenue")),
):
    register(f"rolled_{_name}", ORACLE[_name])(lambda spark, sf, report=_report: report(_rolled(spark, sf)))

# --- search by trigram filters ----------------------------------------------------------


def _searched(spark, sf, **filters):
    """The search over a stored fact, clustered by invoice, that reads only files that may match."""
    table = VersionedTable(spark, f"{shared_folder(spark)}/search-{uuid.uuid4().hex}", K.SALES_PARTITIONS)
    lines = staged(S.sales_lines(spark, sf), "searched")
    folders, _ = table.write(lines, cluster=["invoice_no"])
    TextIndex(table, search.SEARCHED).add(folders, lines.schema)
    table.commit(table.version(), Change(folders, schema=lines.schema))
    return search.indexed_lines(table, **filters)


register("indexed_order_search", ORACLE["order_search_returned_text"])(
    lambda spark, sf: search.newest_lines(
        _searched(spark, sf, text="Gear", country="NATION_3", status=K.RETURNED_ORDERS)
    )
)
register("indexed_totals", ORACLE["filtered_totals"].replace("%12%", "%100%"))(
    lambda spark, sf: search.result_totals(_searched(spark, sf, text="100", status=K.COMPLETED_ORDERS))
)

# --- reload by file -----------------------------------------------------------------------


# bytes of the lines' table from which on the feed is made in parts and comes in compressed files
LARGE_FEED = 64_000_000


def _reloaded(spark, sf):
    """The lake after a feed of files per region was loaded, and again after its files changed.

    A large region is written by several tasks, a file each; files of a large feed are compressed.
    At first every file lacks its countries' orders of odd keys and holds prices one higher; then all
    files but those of region 0, which are right from the start, are replaced by the whole feed.
    """
    folder = f"{shared_folder(spark)}/reload-{uuid.uuid4().hex}"
    feed = S.sales_feed(spark, sf)
    regions = S.table(spark, sf, "nation").select(F.concat(F.lit(" "), "n_name").alias("Country"), "n_regionkey")
    large = input_bytes(S.table(spark, sf, "lineitem")) > LARGE_FEED

    def deliver(state):
        with settings(spark, FILES_AT_ONCE | SMALL_READS):
            (
                state.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").partitionBy("n_regionkey")
                .option("header", "true").option("escape", '"')
                .option("compression", "gzip" if large else "none").csv(f"{folder}/feed")
            )

    def load():
        reload.reload_feed(spark, f"{folder}/feed/*", f"{folder}/typed", f"{folder}/lake", S.SOURCE_SYSTEM)

    with staging(spark):
        with settings(spark, DROP_SHUFFLES):
            named = feed.join(regions, "Country").select(*feed.columns, "n_regionkey")
            lines = staged(named, "feed", parts=2 if large else 1, by="InvoiceNo")
        keys = F.regexp_extract("InvoiceNo", "([0-9]+)", 1).cast("bigint")
        older = lines.where((F.col("n_regionkey") == 0) | (keys % 2 == 0)).withColumn(
            "UnitPrice", F.when(F.col("n_regionkey") == 0, F.col("UnitPrice")).otherwise(F.col("UnitPrice") + 1)
        )
        deliver(older)
        load()
        deliver(lines.where(F.col("n_regionkey") > 0))
    load()
    for name in ("feed", "typed"):  # the lake is what is asked for
        delete_path(spark, f"{folder}/{name}")
    return read_lake(spark, f"{folder}/lake").drop("source_system", "ingestion_timestamp").withColumn(
        "invoice_date", F.col("invoice_date").cast("timestamp_ntz")
    )


register("reloaded_sales", ORACLE["curate_sales"])(_reloaded)

# --- sketches ---------------------------------------------------------------------------

_COUNTS = ", ".join(f"count(distinct {c}) as {n}, true as {n}_within" for c, n in sketches.COUNTED.items())


def _checked_estimates(spark, sf, by):
    """Exact distinct counts, and whether the merged monthly sketches come close to them."""
    lines = S.sales_lines(spark, sf)
    monthly = staged(sketches.distinct_sketches(lines), "sketches")
    estimates = sketches.distinct_estimates(monthly, by)
    exact = {n: lines.select(*by, c).distinct().groupBy(*by).agg(F.count(c).alias(f"exact_{n}")) for c, n in sketches.COUNTED.items()}
    for counts in exact.values():
        estimates = estimates.join(counts, by)
    columns = [[F.col(f"exact_{n}").alias(n), sketches.within_error(F.col(n), F.col(f"exact_{n}")).alias(f"{n}_within")] for n in exact]
    return estimates.select(*by, *[c for pair in columns for c in pair])


for _by in ("country", "transaction_year"):
    register(f"sketched_counts_by_{_by}", with_views(V.FACT) + f"select {_by}, {_COUNTS} from fact_sales group by {_by}")(
        lambda spark, sf, by=_by: _checked_estimates(spark, sf, [by])
    )

_LATEST_RUNS = """latest as (select * exclude (rn) from (select *, row_number() over (
    partition by run_id order by logged_at desc, start_time desc, status desc, records_processed desc) as rn from runs)
  where rn = 1)"""

register("run_log_state", with_views(V.RUNS, _LATEST_RUNS) + "select * from latest")(
    lambda spark, sf: health.current_runs(S.run_records(spark, sf))
)
register(
    "pipeline_health",
    with_views(V.RUNS, _LATEST_RUNS)
    + """select run_id, pipeline_name, start_time, end_time,
      cast(epoch(end_time - start_time) as bigint) as duration_seconds, status, records_processed,
      records_rejected, error_message
    from latest order by start_time desc, run_id limit 10""",
)(lambda spark, sf: health.pipeline_health(health.current_runs(S.run_records(spark, sf))))

# --- data quality -------------------------------------------------------------------

_BLANK = "({0} is null or trim({0}) = '')"
_QTY = "coalesce(trunc(try_cast(quantity as double)) <= 0, true)"
_NUM = "coalesce(try_cast(unit_price as double) < 0, true)"
_DAY = """coalesce(not (year(try_strptime(replace(trim(order_date), '/', '-'), '%Y-%m-%d'))
  between 2000 and 2100), true)"""
_KNOWN_CUSTOMER = """customer_id is not null and trim(customer_id) not in
  (select cast(c_custkey as varchar) from customer)"""
_KNOWN_PRODUCT = """product_id is not null and trim(product_id) not in
  (select cast(s_suppkey as varchar) from supplier)"""

def _sql_rule(texts, broken, value=None, field=""):
    """(name, condition, reason as SQL, finding) of one rule."""
    name, reason, finding = (text.format(field) if field else text for text in texts)
    before, _, after = (part.replace("'", "''") for part in reason.partition("{}"))
    shown = f"'{before}'" if value is None else f"'{before}' || {value} || '{after}'"
    return name, broken, shown, finding


_REASONS = [
    *[_sql_rule(K.RULE_MISSING, _BLANK.format(c), field=c) for c in K.MANDATORY_ORDER_IDS],
    _sql_rule(K.RULE_QUANTITY, _QTY, "coalesce(quantity, 'None')"),
    _sql_rule(K.RULE_PRICE, _NUM, "coalesce(unit_price, 'None')"),
    _sql_rule(K.RULE_DATE, _DAY, "coalesce(order_date, 'None')"),
    _sql_rule(K.RULE_CUSTOMER, _KNOWN_CUSTOMER, "customer_id"),
    _sql_rule(K.RULE_PRODUCT, _KNOWN_PRODUCT, "product_id"),
]
_CHECKED = "checked as (select *, concat_ws('; ', {}) as quarantine_reason from raw_orders)".format(
    ", ".join(f"case when {broken} then {reason} end" for _, broken, reason, _ in _REASONS)
)


def _checked(spark, sf):
    """Rules with both id lists, whole tables: customers, and suppliers as product numbers."""
    return quality.check_order_lines(
        S.raw_orders(spark, sf),
        customers=S.customer_master(spark, sf),
        products=S.supplier_contacts(spark, sf).withColumnRenamed("customer_id", "product_id"),
    )


register(
    "quarantine_rows",
    with_views(V.RAW_ORDERS, _CHECKED) + "select * from checked where quarantine_reason <> ''",
)(lambda spark, sf: _checked(spark, sf).quarantined())
register(
    "valid_rows",
    with_views(V.RAW_ORDERS, _CHECKED)
    + "select * exclude (quarantine_reason) from checked where quarantine_reason = ''",
)(lambda spark, sf: _checked(spark, sf).valid())

register(
    "rule_evaluations",
    with_views(V.RAW_ORDERS)
    + "select rule_name, case when records_failed > 0 then 'FAILED' else 'PASSED' end as status,"
    " records_evaluated, records_failed, case when records_failed > 0 then"
    " 'Found ' || records_failed || ' ' || finding else 'Clean' end as error_message from ("
    + " union all ".join(
        f"""select '{name}' as rule_name, count(*) as records_evaluated,
        count(*) filter ({broken}) as records_failed, '{finding.replace("'", "''")}' as finding
        from raw_orders"""
        for name, broken, _, finding in _REASONS
    )
    + ")",
)(lambda spark, sf: _checked(spark, sf).rule_evaluations())

register(
    "quality_gate",
    with_views(V.RAW_ORDERS, _CHECKED)
    + f"""select total as total_records, total - bad as valid_records, bad as rejected_records,
      {count_share('bad', 'total')} as quarantine_pct,
      case when bad = 0 then 'PASSED' when {count_share('bad', 'total')} <= 5 then 'WARNING'
           else 'FAILED' end as status
    from (select count(*) as total, count(*) filter (quarantine_reason <> '') as bad from checked)""",
)(lambda spark, sf: _checked(spark, sf).report(5.0).drop("evaluations"))

_RAW_COLUMNS = [
    "order_id", "order_date", "customer_id", "product_id", "quantity", "unit_price",
    "discount", "region", "payment_method", "order_status", "source_system", "ingestion_timestamp",
]
register(
    "null_profile",
    with_views(V.RAW_ORDERS)
    + " union all ".join(
        f"""select '{c}' as column_name, count(*) as total_records,
        count(*) filter ({c} is null) as null_count,
        {count_share(f'count(*) filter ({c} is null)', 'count(*)')} as null_pct from raw_orders"""
        for c in _RAW_COLUMNS
    ),
)(lambda spark, sf: quality.null_profile(S.raw_orders(spark, sf)))

register(
    "duplicate_keys",
    with_views(V.ORDER_LINES)
    + """select order_id, line_number, count(*) as row_count from order_lines
    group by order_id, line_number having count(*) > 1""",
)(lambda spark, sf: dedup.duplicate_keys(S.order_lines(spark, sf), ["order_id", "line_number"]))


def _audited(spark, sf):
    lines = rollups.with_financials(_enriched(spark, sf, S.supplier_contacts)).withColumn(
        "transaction_id",
        F.concat_ws("-", F.col("order_id").cast("string"), F.col("line_number").cast("string")),
    )
    return quality.quality_audit(
        lines, S.table(spark, sf, "lineitem"), transaction_date="order_date"
    )


_AUDIT = f"""audited as (select o.*, s_name as customer_name,
    cast(order_id as varchar) || '-' || cast(line_number as varchar) as transaction_id
  from priced o {_CONTACTS})"""
_AUDIT_CONDITIONS = {
    "null_customer_ids": "customer_id is null",
    "null_product_ids": "product_id is null",
    "null_store_ids": "store_id is null or store_id = ''",
    "negative_or_zero_quantities": "quantity <= 0",
    "negative_unit_prices": "unit_price < 0",
    "invalid_transaction_dates": "order_date is null",
    "negative_net_amounts": "net_amount < 0",
    "referential_integrity_customers": "customer_name is null",
}
register(
    "quality_audit",
    with_views(V.ORDER_LINES, V.PRICED, _AUDIT)
    + """select check_name, case when failed_records = 0 then 'PASSED'
      when check_name = 'referential_integrity_customers' then 'WARNING' else 'FAILED' end as status,
      failed_records, 0 as threshold, 'Found ' || failed_records || ' ' || what as details from (
      select 'duplicate_transaction_ids' as check_name, count(*) as failed_records,
        'duplicate transaction_ids' as what
      from (select transaction_id from audited group by 1 having count(*) > 1)"""
    + "".join(
        f" union all select '{name}', count(*) filter ({broken}), '{K.AUDIT_FINDINGS[name]}' from audited"
        for name, broken in _AUDIT_CONDITIONS.items()
    )
    + ")",
)(lambda spark, sf: quality.audit_checks(_audited(spark, sf)))

_FAILED = "count(*) filter ({})"
register(
    "audit_report",
    with_views(V.ORDER_LINES, V.PRICED, _AUDIT)
    + f"""select (select count(*) from lineitem) as input_record_count, count(*) as output_record_count,
      (select count(*) from (select 1 from audited group by transaction_id having count(*) > 1))
        as duplicate_record_count,
      count(*) filter (quantity <= 0) + count(*) filter (unit_price < 0)
        + count(*) filter (net_amount < 0) as invalid_record_count,
      count(*) filter (customer_id is null) + count(*) filter (product_id is null)
        + count(*) filter (store_id is null) + count(*) filter (order_date is null) as null_value_count,
      case when count(*) > count(distinct transaction_id) or count(*) filter (quantity <= 0 or unit_price < 0
          or net_amount < 0 or customer_id is null or product_id is null or store_id is null
          or order_date is null) > 0 then 'FAILED'
        when count(*) filter (customer_name is null) > 0 then 'WARNING' else 'PASSED' end as status
    from audited""",
)(lambda spark, sf: _audited(spark, sf).drop("checks"))
