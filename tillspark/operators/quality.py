"""Declarative row rules, quarantine, gates, null profile and the curated audit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark import constants as K
from tillspark.functions.money import percent
from tillspark.functions.once import with_columns_once
from tillspark.functions.parsing import parse_ymd, whole_number
from tillspark.functions.text import is_blank
from tillspark.session import staged


class QualityGateError(ValueError):
    """A schema contract or a quality threshold was broken."""


# --- schema contract -----------------------------------------------------------


def require_columns(
    df: DataFrame, required: Sequence[str], forbidden: Sequence[str] = ()
) -> DataFrame:
    """Pass ``df`` through, or raise where its columns break the contract."""
    missing = [c for c in required if c not in df.columns]
    unwanted = [c for c in forbidden if c in df.columns]
    if missing or unwanted:
        raise QualityGateError(f"missing columns {missing}, forbidden columns {unwanted}")
    return df


# --- row rules -------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """``broken`` marks a failing row, ``reason`` explains it, ``finding`` sums it up."""

    name: str
    broken: Column
    reason: Column
    finding: str


def _shown(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("None"))


def _positive_quantity(name: str) -> Column:
    # the cast that cleaning applies: a quantity that is valid here is a number there
    return F.coalesce(whole_number(F.col(name)) <= 0, F.lit(True))


def _valid_price(name: str) -> Column:
    price = F.col(name).try_cast("double")
    return F.coalesce((price < 0) | F.isnan(price), F.lit(True))


def _date_in_years(name: str, first: int, last: int) -> Column:
    return F.coalesce(~F.year(parse_ymd(F.col(name))).between(first, last), F.lit(True))


def _unknown(key: str, flag: str) -> Column:
    return F.col(key).isNotNull() & F.col(flag).isNull()


def order_line_rules(check_customers: bool = False, check_products: bool = False) -> list[Rule]:
    """The order line rules, in the order their reasons are listed."""
    def rule(texts: tuple[str, str, str], broken: Column, value: Column | None = None, field: str = "") -> Rule:
        name, reason, finding = (text.format(field) if field else text for text in texts)
        before, _, after = reason.partition("{}")
        shown = F.lit(reason) if value is None else F.concat(F.lit(before), value, F.lit(after))
        return Rule(name, broken, shown, K.FINDING.format(finding))

    rules = [rule(K.RULE_MISSING, is_blank(F.col(name)), field=name) for name in K.MANDATORY_ORDER_IDS]
    rules += [
        rule(K.RULE_QUANTITY, _positive_quantity("quantity"), _shown("quantity")),
        rule(K.RULE_PRICE, _valid_price("unit_price"), _shown("unit_price")),
        rule(K.RULE_DATE, _date_in_years("order_date", *K.ORDER_DATE_YEARS), _shown("order_date")),
    ]
    if check_customers:
        rules.append(rule(K.RULE_CUSTOMER, _unknown("customer_id", "_known_customer_id"), _shown("customer_id")))
    if check_products:
        rules.append(rule(K.RULE_PRODUCT, _unknown("product_id", "_known_product_id"), _shown("product_id")))
    return rules


def _with_known_flag(lines: DataFrame, key: str, ids: DataFrame, id_column: str) -> DataFrame:
    """Left join to the distinct known ids; the flag is NULL for an unknown key.

    An empty list knows nothing and so rejects nothing: then the key itself is the flag.
    The list is staged, because adaptive execution splits a hot key (the blank of all guests)
    only where both sides of the join come from a shuffle, without an aggregate in between.
    """
    flag = f"_known_{key}"
    known = staged(ids.select(F.trim(F.col(id_column).cast("string")).alias("_id")).distinct(), "known-ids")
    joined = lines.join(known, F.trim(F.col(key)) == F.col("_id"), "left")
    accepted = F.when(_any_row(known), F.col("_id")).otherwise(F.col(key).cast("string"))
    return joined.withColumn(flag, accepted).drop("_id")


def _any_row(df: DataFrame) -> Column:
    """Whether ``df`` has a row, found when the plan that holds it runs."""
    return df.limit(1).agg(F.count("*") > 0).scalar()


@dataclass(frozen=True)
class Checked:
    """Order lines with one boolean per rule and the joined reasons."""

    rows: DataFrame
    rules: list[Rule]
    columns: list[str]

    def valid(self) -> DataFrame:
        """Rows that broke no rule, in the input's own schema."""
        return self.rows.where(~self._rejected()).select(*self.columns)

    def quarantined(self) -> DataFrame:
        """Rejected rows with all their reasons."""
        return self.rows.where(self._rejected()).select(*self.columns, "quarantine_reason")

    def _rejected(self) -> Column:
        return F.greatest(*[F.col(f"_broken.{r.name}") for r in self.rules])

    def _failures(self) -> DataFrame:
        return self.rows.agg(
            F.count("*").alias("total"),
            F.count_if(self._rejected()).alias("rejected"),
            *[F.count_if(F.col(f"_broken.{r.name}")).alias(r.name) for r in self.rules],
        )

    def _evaluations(self) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule_name"),
                    F.when(F.col(r.name) > 0, "FAILED").otherwise("PASSED").alias("status"),
                    F.col("total").alias("records_evaluated"),
                    F.col(r.name).alias("records_failed"),
                    F.when(F.col(r.name) > 0, F.format_string(r.finding, F.col(r.name)))
                    .otherwise("Clean")
                    .alias("error_message"),
                )
                for r in self.rules
            ]
        )

    def rule_evaluations(self) -> DataFrame:
        """One row per rule: how many rows it saw and failed. One pass over the data."""
        return self._failures().select(F.inline(self._evaluations()))

    def report(self, max_quarantine_pct: float) -> DataFrame:
        """One-row report with the overall status and the rule evaluations."""
        share = F.coalesce(percent(F.col("rejected"), F.col("total")), F.lit(0).cast(K.RATIO))
        return self._failures().select(
            F.col("total").alias("total_records"),
            (F.col("total") - F.col("rejected")).alias("valid_records"),
            F.col("rejected").alias("rejected_records"),
            share.alias("quarantine_pct"),
            F.when(F.col("rejected") == 0, "PASSED")
            .when(share <= F.lit(max_quarantine_pct), "WARNING")
            .otherwise("FAILED")
            .alias("status"),
            self._evaluations().alias("evaluations"),
        )


def check_order_lines(
    lines: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
) -> Checked:
    """Evaluate every rule on every line. An absent id list skips its rule, an empty one passes."""
    require_columns(lines, K.REQUIRED_ORDER_COLUMNS)
    columns = lines.columns
    flagged = lines
    with_customers, with_products = customers is not None, products is not None
    if with_customers:
        flagged = _with_known_flag(flagged, "customer_id", customers, "customer_id")
    if with_products:
        flagged = _with_known_flag(flagged, "product_id", products, "product_id")
    rules = order_line_rules(with_customers, with_products)
    broken = F.struct(*[r.broken.alias(r.name) for r in rules])
    reasons = F.concat_ws("; ", *[F.when(F.col(f"_broken.{r.name}"), r.reason) for r in rules])
    rows = with_columns_once(flagged, _broken=broken).withColumn("quarantine_reason", reasons)
    return Checked(rows.select(*columns, "_broken", "quarantine_reason"), rules, columns)


def enforce_gate(report: DataFrame, max_quarantine_pct: float) -> None:
    """Raise where the one-row report exceeds the threshold."""
    row = report.select("quarantine_pct", "rejected_records", "total_records").first()
    if float(row["quarantine_pct"]) > max_quarantine_pct:
        raise QualityGateError(
            f"{row['rejected_records']} of {row['total_records']} records rejected: "
            f"{row['quarantine_pct']}% is above {max_quarantine_pct}%"
        )


# --- null profile -----------------------------------------------------------------


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, NULLs and their percentage, from one scan."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    profile = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("_rows").alias("total_records"),
                F.col(c).alias("null_count"),
                F.coalesce(percent(F.col(c), F.col("_rows")), F.lit(0).cast(K.RATIO)).alias("null_pct"),
            )
            for c in columns
        ]
    )
    return counted.select(F.inline(profile))


# --- curated audit -----------------------------------------------------------------


def quality_audit(
    curated: DataFrame,
    raw: DataFrame | None = None,
    *,
    transaction_id: str = "transaction_id",
    customer_id: str = "customer_id",
    product_id: str = "product_id",
    store_id: str = "store_id",
    transaction_date: str = "transaction_date",
    customer_name: str = "customer_name",
) -> DataFrame:
    """One-row audit report with nine checks, from one grouped pass over ``curated``.

    Rows are first reduced to one per transaction id (which the duplicate check needs
    anyway); the other checks ride along as counters.
    """

    def absent(name: str) -> Column:
        return F.col(name).isNull() | (F.col(name).cast("string") == "")

    checks = {
        "null_customer_ids": absent(customer_id),
        "null_product_ids": absent(product_id),
        "null_store_ids": absent(store_id),
        "negative_or_zero_quantities": F.col("quantity") <= 0,
        "negative_unit_prices": F.col("unit_price") < 0,
        "invalid_transaction_dates": F.col(transaction_date).isNull(),
        "negative_net_amounts": F.col("net_amount") < 0,
        "referential_integrity_customers": F.col(customer_name).isNull(),
    }
    per_id = curated.groupBy(transaction_id).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(broken).alias(name) for name, broken in checks.items()],
    )
    counted = per_id.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("output_record_count"),
        F.count_if(F.col("_rows") > 1).alias("duplicate_transaction_ids"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in checks],
    )
    findings = K.AUDIT_FINDINGS
    warning_only = "referential_integrity_customers"

    def status(name: str) -> Column:
        return F.when(F.col(name) == 0, "PASSED").otherwise(
            "WARNING" if name == warning_only else "FAILED"
        )

    results = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                status(name).alias("status"),
                F.col(name).alias("failed_records"),
                F.lit(0).alias("threshold"),
                F.format_string(K.FINDING.format(what), F.col(name)).alias("details"),
            )
            for name, what in findings.items()
        ]
    )
    failed = sum((F.col(name) for name in findings if name != warning_only), F.lit(0))
    nulls = sum(
        F.col(c)
        for c in ("null_customer_ids", "null_product_ids", "null_store_ids", "invalid_transaction_dates")
    )
    invalid = sum(
        F.col(c)
        for c in ("negative_or_zero_quantities", "negative_unit_prices", "negative_net_amounts")
    )
    raw_count = F.col("output_record_count") if raw is None else raw.agg(F.count("*")).scalar()
    return counted.select(
        raw_count.alias("input_record_count"),
        "output_record_count",
        F.col("duplicate_transaction_ids").alias("duplicate_record_count"),
        invalid.alias("invalid_record_count"),
        nulls.alias("null_value_count"),
        F.when(failed > 0, "FAILED")
        .when(F.col(warning_only) > 0, "WARNING")
        .otherwise("PASSED")
        .alias("status"),
        results.alias("checks"),
    )


def audit_checks(report: DataFrame) -> DataFrame:
    """The nine checks of an audit report as rows."""
    return report.select(F.inline("checks"))
