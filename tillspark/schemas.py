"""Declared schemas of the feeds and warehouse tables. Nothing is inferred."""

from __future__ import annotations

CORRUPT_RECORD = "_corrupt_record"

RAW_SALES = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, "
    "InvoiceDate string, UnitPrice decimal(10,2), CustomerID string, Country string"
)
RAW_SALES_COLUMNS = [field.split()[0] for field in RAW_SALES.split(", ")]

RAW_ORDERS = (
    "order_id string, order_date string, customer_id string, product_id string, "
    "quantity string, unit_price string, discount string, region string, "
    "payment_method string, order_status string, source_system string, "
    "ingestion_timestamp string"
)

PRODUCT_CATALOG = (
    "product_id string, product_name string, category string, brand string, "
    "price double, stock int, source_system string, ingestion_timestamp string"
)

CUSTOMER_MASTER = (
    "customer_id string, customer_name string, city string, state string, "
    "country string, source_system string, ingestion_timestamp string"
)

FACT_SALES = (
    "invoice_no string, stock_code string, description string, quantity int, "
    "invoice_date timestamp, unit_price decimal(10,2), customer_id int, country string, "
    "gross_amount decimal(12,2), is_cancellation int, transaction_year int, "
    "transaction_month int, source_system string, ingestion_timestamp timestamp"
)
FACT_SALES_COLUMNS = [field.split()[0] for field in FACT_SALES.split(", ")]

DIM_PRODUCTS = (
    "stock_code string, description string, latest_unit_price decimal(10,2), "
    "first_sold_at timestamp, last_sold_at timestamp, total_units_sold bigint"
)

DIM_CUSTOMERS = (
    "customer_id int, country string, total_orders bigint, total_spend decimal(14,2), "
    "first_order_date timestamp, last_order_date timestamp"
)

RUN_LOG = (
    "run_id string, pipeline_name string, start_time timestamp, end_time timestamp, "
    "status string, records_processed bigint, records_rejected bigint, "
    "error_message string, metrics_json string, logged_at timestamp"
)

DAILY_SALES = (
    "sale_date date, store_id string, category string, total_orders bigint, "
    "total_items_sold bigint, gross_revenue decimal(24,2), total_discount decimal(24,2), "
    "net_revenue decimal(24,2)"
)

# Columns of the stored master tables, key first; a feed may lack some.
MASTERS = {
    "products": (
        "product_id string, product_name string, category string, brand string, "
        "price double, stock int"
    ),
    "customers": (
        "customer_id string, customer_name string, customer_email string, city string, "
        "state string, country string, customer_segment string"
    ),
    "stores": "store_id string, store_name string, city string, state string",
}
