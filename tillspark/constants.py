"""Names, labels, formats and bounds that results depend on."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Band:
    """One labelled value range. ``low``/``high`` are inclusive, ``below`` is exclusive."""

    label: str
    low: Decimal | None = None
    high: Decimal | None = None
    below: Decimal | None = None


# --- fixed values: invoice line feed ---------------------------------------
UNKNOWN_DESCRIPTION = "UNKNOWN DESCRIPTION"
UNKNOWN_COUNTRY = "Unknown"
INVOICE_DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "M/d/yyyy H:mm",
    "dd/MM/yyyy HH:mm",
    "yyyy-MM-dd",
)
CANCELLED_INVOICE_PREFIX = "C"
SALES_KEY = ("invoice_no", "stock_code", "invoice_date", "quantity")
SALES_PARTITIONS = ("transaction_year", "transaction_month")
FORBIDDEN_SALES_COLUMNS = ("discount", "store_id", "payment_method", "order_status")

# --- fixed values: order line feed ------------------------------------------
UNKNOWN_PAYMENT = "Unknown"
UNKNOWN_REGION = "Unknown"
DEFAULT_ORDER_STATUS = "Completed"
ORDER_LINE_KEY = ("order_id", "product_id")
DAILY_SALES_KEY = ("sale_date", "store_id", "category")
ORDER_DATE_YEARS = (2000, 2100)
MANDATORY_ORDER_IDS = ("order_id", "order_date", "customer_id", "product_id")
REQUIRED_ORDER_COLUMNS = MANDATORY_ORDER_IDS + ("quantity", "unit_price")

# --- fixed values: order line rules (name, reason, finding) -------------------
# {} in a reason stands for the value, in names and the reason of a missing field for the field
RULE_MISSING = ("null_check_{}", "Missing mandatory field '{}'", "null or empty values in '{}'")
RULE_QUANTITY = (
    "valid_quantity_positive",
    "Invalid quantity '{}': must be integer > 0",
    "non-positive or non-numeric quantities",
)
RULE_PRICE = (
    "valid_price_non_negative",
    "Invalid unit price '{}': must be float >= 0",
    "negative or non-numeric unit prices",
)
RULE_DATE = ("valid_date_format", "Unparseable or out-of-bounds order_date '{}'", "unparseable dates")
RULE_CUSTOMER = ("fk_customer_id_exists", "Unknown customer_id '{}'", "orphan customer IDs")
RULE_PRODUCT = ("fk_product_id_exists", "Unknown product_id '{}'", "orphan product IDs")
FINDING = "Found %d {}"

# --- fixed values: checks of the curated audit and what they find ---------------
AUDIT_FINDINGS = {
    "duplicate_transaction_ids": "duplicate transaction_ids",
    "null_customer_ids": "null customer_ids",
    "null_product_ids": "null product_ids",
    "null_store_ids": "null store_ids",
    "negative_or_zero_quantities": "non-positive quantities",
    "negative_unit_prices": "negative unit prices",
    "invalid_transaction_dates": "invalid transaction dates",
    "negative_net_amounts": "negative net revenue amounts",
    "referential_integrity_customers": "orphan customer references",
}

# --- fixed values: slices and report labels ----------------------------------
DOMESTIC_COUNTRY = "United Kingdom"
DOMESTIC_SLICE = "UK"
INTERNATIONAL_SLICE = "International"
GLOBAL_SLICE = "Global"
COMPLETED_ORDERS = "Completed Sales"
RETURNED_ORDERS = "Cancelled / Returned"
STATUS_RETURNED = "Returned"
STATUS_COMPLETED = "Completed"
GUEST_CHECKOUT = "Guest Checkout"
REGISTERED_CHECKOUT = "Registered Customer"

# --- fixed values: price and spend bands (closed ranges, first match wins) ----
PRICE_BANDS = (
    Band("Budget (< £2.00)", below=Decimal("2.00")),
    Band("Standard (£2.00 - £5.00)", low=Decimal("2.00"), high=Decimal("5.00")),
    Band("Premium (£5.01 - £15.00)", low=Decimal("5.01"), high=Decimal("15.00")),
)
PRICE_BAND_REST = "Luxury / Bulk (> £15.00)"
SPEND_BANDS = (
    Band("VIP Tier (>£10k)", low=Decimal("10000")),
    Band("High-Value (£2k-£10k)", low=Decimal("2000"), high=Decimal("9999.99")),
    Band("Mid-Tier (£500-£2k)", low=Decimal("500"), high=Decimal("1999.99")),
)
SPEND_BAND_REST = "Budget (<£500)"

# --- column types shared by all reports ---------------------------------------
PRICE = "decimal(10,2)"
AMOUNT = "decimal(12,2)"
SPEND = "decimal(14,2)"
TOTAL = "decimal(24,2)"
RATIO = "decimal(18,2)"
