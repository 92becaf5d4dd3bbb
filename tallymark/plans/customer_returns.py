"""Customer returns: was every refund returned, reimbursed, settled and restocked?

Inputs (snake case; extra columns are ignored):

* payments: posted, type, order_id, sku, description, quantity, total
* returns: order_id, sku, status, quantity, return_date, fulfillment_center_id
* reimbursements: reason, approval_date, amazon_order_id, sku, amount_total,
  quantity_reimbursed_cash, quantity_reimbursed_inventory, quantity_reimbursed_total
* ledger: date_text, msku, quantity, fulfillment_center, event_type, disposition
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.keys import SKU_PREFIX, normalize_ledger_sku, normalize_sku
from tallymark.functions.values import iso_day, money, or_zero, prorated, sum_or_zero, us_day
from tallymark.operators.grouping import all_present, sum_by
from tallymark.operators.matching import daily_units, match_nearest
from tallymark.operators.staging import stage
from tallymark.operators.units import negative_quantities, non_negative, split_runs

# What the reports themselves write in these columns.
REFUND = "Refund"
SETTLEMENT = "FBA Inventory Reimbursement - Customer Return"
CUSTOMER_RETURN = "CustomerReturn"
REIMBURSED = "Reimbursed"
RESTOCKED = ("Unit returned to inventory", "Repackaged Successfully")
NOT_RETURNED = "Not found in customer returns"
RETURN_EVENT = "CustomerReturns"
SELLABLE = "SELLABLE"
MONTH_CHARS = 3

ORDER = ("order_id", "sku")
BLOCK = ("sku", "fulfillment_center_id")
REIMBURSED_MEASURES = (
    "amount_total",
    "quantity_reimbursed_cash",
    "quantity_reimbursed_inventory",
    "quantity_reimbursed_total",
)


@dataclass(frozen=True)
class ReturnsOptions:
    """``month`` keeps refunds whose date text starts with it, for example ``Feb``.

    Quantities below 0 cannot become units: they raise, or with ``reject_negative`` go to
    a report of their own.
    """

    month: str | None = None
    sku_prefix: str = SKU_PREFIX
    ledger_date_pattern: str = "M/d/yyyy"
    thousands: bool = False
    strict: bool = True
    reject_negative: bool = False


DEFAULTS = ReturnsOptions()


def _sku(options: ReturnsOptions, name: str = "sku") -> Column:
    return normalize_sku(F.col(name), options.sku_prefix)


def _money(options: ReturnsOptions, name: str) -> Column:
    return money(F.col(name), options.thousands, options.strict)


def refunds(payments: DataFrame, options: ReturnsOptions = DEFAULTS) -> DataFrame:
    """Refunded quantity and amount per order and SKU."""
    lines = payments.filter(F.col("type") == REFUND)
    if options.month is not None:
        lines = lines.filter(F.substring("posted", 1, MONTH_CHARS) == options.month)
    lines = lines.select("order_id", _sku(options).alias("sku"), "quantity", (-_money(options, "total")).alias("total"))
    return sum_by(lines, ORDER, quantity_refund="quantity", total="total")


def settlements(payments: DataFrame, options: ReturnsOptions = DEFAULTS) -> DataFrame:
    """Quantity and amount settled in cash per order and SKU."""
    lines = payments.filter(F.col("description") == SETTLEMENT).select(
        "order_id", _sku(options).alias("sku"), "quantity", _money(options, "total").alias("total")
    )
    return sum_by(lines, ORDER, quantity_settled="quantity", amount_settled="total")


def normalized_returns(returns: DataFrame, options: ReturnsOptions = DEFAULTS) -> DataFrame:
    return returns.select(
        "order_id",
        _sku(options).alias("sku"),
        "status",
        "return_date",
        "fulfillment_center_id",
        F.col("quantity").alias("quantity_returns"),
    )


def returns_by(returned: DataFrame, *grain: str) -> DataFrame:
    """Normalised returns at the grain of order, SKU, status and more columns."""
    return sum_by(returned, [*ORDER, "status", *grain], quantity_returns="quantity_returns")


def normalized_reimbursements(reimbursements: DataFrame, options: ReturnsOptions = DEFAULTS) -> DataFrame:
    return reimbursements.filter(F.col("reason") == CUSTOMER_RETURN).select(
        F.col("amazon_order_id").alias("order_id"),
        _sku(options).alias("sku"),
        "approval_date",
        _money(options, "amount_total").alias("amount_total"),
        "quantity_reimbursed_cash",
        "quantity_reimbursed_inventory",
        "quantity_reimbursed_total",
    )


def reimbursements_by(reimbursed: DataFrame, *grain: str) -> DataFrame:
    return sum_by(reimbursed, [*ORDER, *grain], **{name: name for name in REIMBURSED_MEASURES})


def refunds_vs_returns(refunded: DataFrame, returned: DataFrame) -> DataFrame:
    """Report 1.  Refund figures count once per return status, as in the report."""
    lines = refunded.join(returns_by(returned), list(ORDER), "left").select(
        *refunded.columns,
        F.coalesce("status", F.lit(NOT_RETURNED)).alias("status"),
        or_zero(F.col("quantity_returns")).alias("quantity_returns"),
    )
    difference = F.col("quantity_refund") - F.col("quantity_returns")
    return sum_by(
        lines,
        ORDER,
        quantity_refund="quantity_refund",
        total="total",
        quantity_returns="quantity_returns",
        reimbursed=F.when(F.col("status") == REIMBURSED, F.col("quantity_returns")),
        returned_to_inventory=F.when(F.col("status").isin(*RESTOCKED), F.col("quantity_returns")),
        quantity_difference=difference,
        amount_difference=prorated(F.col("total"), F.col("quantity_refund"), difference),
    )


def reimbursed_refunds(refunded: DataFrame, returned: DataFrame) -> DataFrame:
    """Refunds whose return was reimbursed, per centre; the returned quantity is not 0."""
    lines = returns_by(returned.filter(F.col("status") == REIMBURSED), "fulfillment_center_id")
    return refunded.join(lines.filter(F.col("quantity_returns") != 0), list(ORDER)).select(
        *ORDER, "fulfillment_center_id", "quantity_returns", F.col("quantity_returns").alias("reimbursed"), "total"
    )


def returns_vs_reimbursements(reimbursed_lines: DataFrame, reimbursements: DataFrame) -> DataFrame:
    """Report 2, from ``reimbursed_refunds`` and reimbursements per order and SKU."""
    joined = reimbursed_lines.join(reimbursements, list(ORDER), "left").withColumns(
        {name: or_zero(F.col(name)) for name in REIMBURSED_MEASURES}
    )
    difference = F.col("quantity_returns") - F.col("quantity_reimbursed_total")
    return joined.select(
        *ORDER,
        "total",
        "reimbursed",
        *REIMBURSED_MEASURES,
        difference.alias("quantity_difference"),
        prorated(F.col("total"), F.col("reimbursed"), difference).alias("amount_difference"),
    )


def cash_reimbursement(reimbursed_lines: DataFrame, reimbursements: DataFrame, settled: DataFrame) -> DataFrame:
    """Report 3: cash reimbursements against settlements."""
    paid = reimbursements.filter(F.col("quantity_reimbursed_cash") != 0)
    joined = (
        reimbursed_lines.select(*ORDER)
        .join(paid.select(*ORDER, "quantity_reimbursed_cash", "amount_total"), list(ORDER))
        .join(settled, list(ORDER), "left")
        .withColumns({name: or_zero(F.col(name)) for name in ("quantity_settled", "amount_settled")})
    )
    return joined.select(
        *ORDER,
        "quantity_reimbursed_cash",
        "amount_total",
        "quantity_settled",
        "amount_settled",
        (F.col("quantity_reimbursed_cash") - F.col("quantity_settled")).alias("quantity_difference"),
        (F.col("amount_total") - F.col("amount_settled")).alias("amount_difference"),
    )


def restocked_runs(refunded: DataFrame, returned: DataFrame, options: ReturnsOptions = DEFAULTS) -> DataFrame:
    """Returned units that went back to stock, in runs of alike units."""
    lines = returns_by(returned.filter(F.col("status").isin(*RESTOCKED)), "return_date", "fulfillment_center_id")
    lines = non_negative(lines, "quantity_returns") if options.reject_negative else lines
    joined = lines.join(refunded.select(*ORDER, "total"), list(ORDER)).withColumn(
        "return_day", iso_day(F.col("return_date"), options.strict)
    )
    return split_runs(joined, "quantity_returns").drop("quantity_returns", "first_unit")


def inventory_reimbursed_runs(
    reimbursed_lines: DataFrame, dated_reimbursements: DataFrame, options: ReturnsOptions = DEFAULTS
) -> DataFrame:
    """Units reimbursed in inventory, in runs of alike units."""
    paid = dated_reimbursements.filter(F.col("quantity_reimbursed_inventory") != 0)
    paid = non_negative(paid, "quantity_reimbursed_inventory") if options.reject_negative else paid
    joined = reimbursed_lines.join(
        paid.select(*ORDER, "approval_date", "quantity_reimbursed_inventory"), list(ORDER)
    ).withColumn("approval_day", iso_day(F.col("approval_date"), options.strict))
    return split_runs(joined, "quantity_reimbursed_inventory").drop("quantity_reimbursed_inventory", "first_unit", "quantity_returns")


def restocked_ledger(ledger: DataFrame, options: ReturnsOptions = DEFAULTS) -> DataFrame:
    """Ledger lines by which returned units became sellable again."""
    return ledger.filter((F.col("event_type") == RETURN_EVENT) & (F.col("disposition") == SELLABLE)).select(
        us_day(F.col("date_text"), options.ledger_date_pattern, options.strict).alias("ledger_day"),
        normalize_ledger_sku(F.col("msku"), options.sku_prefix).alias("sku"),
        F.col("fulfillment_center").alias("fulfillment_center_id"),
        "quantity",
    )


def ledger_days(ledger: DataFrame, options: ReturnsOptions = DEFAULTS) -> DataFrame:
    """Units restocked per SKU, centre and day."""
    lines = restocked_ledger(ledger, options)
    lines = non_negative(lines, "quantity") if options.reject_negative else lines
    return daily_units(lines, BLOCK, "ledger_day", "quantity")


def rejected_quantities(
    returned: DataFrame, dated_reimbursements: DataFrame, ledger: DataFrame, options: ReturnsOptions = DEFAULTS
) -> DataFrame:
    """Lines that reports 4 and 5 leave out because their quantity is below 0."""
    restocked = returns_by(returned.filter(F.col("status").isin(*RESTOCKED)), "return_date", "fulfillment_center_id")
    none = F.lit(None).cast("string")
    sides = (
        ("returns", restocked, "quantity_returns", F.col("order_id"), F.col("return_date")),
        ("reimbursements", dated_reimbursements, "quantity_reimbursed_inventory", F.col("order_id"), F.col("approval_date")),
        ("ledger", restocked_ledger(ledger, options), "quantity", none, F.col("ledger_day").cast("string")),
    )
    lines = [
        negative_quantities(df, name).select(
            F.lit(source).alias("source"), order.alias("order_id"), "sku", date.alias("date"), F.col(name).cast("bigint").alias("quantity")
        )
        for source, df, name, order, date in sides
    ]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


def _verdict(matched: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """One row per unit, with what is missing for an unmatched unit."""
    found = F.col("right_date").isNotNull()
    one = F.lit(1).cast("bigint")
    return (
        matched.hint("rebalance")  # a hot day's runs leave their task before they become units
        .withColumn("_unit", F.explode(F.sequence(one, F.col("units"))))
        .select(
            *columns,
            F.col("right_date").alias("date_added"),
            F.when(found, one).alias("quantity_added"),
            F.col("gap_days").cast("bigint").alias("days_difference"),
            F.when(found, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("quantity_difference"),
            F.when(found, F.lit(0)).otherwise(F.col("total")).alias("amount_difference"),
        )
    )


def returned_to_inventory(runs: DataFrame, ledger_by_day: DataFrame, options: ReturnsOptions = DEFAULTS) -> DataFrame:
    """Report 4, from ``restocked_runs`` and ``ledger_days``."""
    matched = match_nearest(
        runs,
        ledger_by_day,
        block=BLOCK,
        left_date="return_day",
        order=("order_id", "status", "return_date", "run_no"),
    )
    one = F.lit(1).cast("bigint")
    return _verdict(matched, [*map(F.col, BLOCK), F.col("return_day"), one.alias("return_quantity"), F.col("total")])


def inventory_reimbursement(runs: DataFrame, ledger_by_day: DataFrame, options: ReturnsOptions = DEFAULTS) -> DataFrame:
    """Report 5, from ``inventory_reimbursed_runs`` and the same ledger days."""
    matched = match_nearest(
        runs,
        ledger_by_day,
        block=BLOCK,
        left_date="approval_day",
        order=("order_id", "approval_date", "run_no"),
    )
    return _verdict(matched, [*map(F.col, BLOCK), F.col("approval_day"), F.col("reimbursed"), F.col("total")])


def reconcile(
    payments: DataFrame,
    returns: DataFrame,
    reimbursements: DataFrame,
    ledger: DataFrame,
    options: ReturnsOptions = DEFAULTS,
) -> dict[str, DataFrame]:
    """All five reports.  What several of them read is staged once."""
    refunded = stage(refunds(payments, options), "refunds")
    # Grouped with the null dates and centres, which only the coarser grains keep.
    returned = stage(
        normalized_returns(returns, options)
        .filter(all_present([*ORDER, "status"]))
        .groupBy(*ORDER, "status", "return_date", "fulfillment_center_id")
        .agg(sum_or_zero(F.col("quantity_returns")).alias("quantity_returns")),
        "returns",
    )
    dated = stage(
        normalized_reimbursements(reimbursements, options)
        .filter(all_present(ORDER))
        .groupBy(*ORDER, "approval_date")
        .agg(*[sum_or_zero(F.col(name)).alias(name) for name in REIMBURSED_MEASURES]),
        "reimbursements",
    )
    by_key = reimbursements_by(dated)
    reimbursed_lines = stage(reimbursed_refunds(refunded, returned), "reimbursed")
    restocked = restocked_runs(refunded, returned, options)
    granted = inventory_reimbursed_runs(reimbursed_lines, dated.filter(F.col("approval_date").isNotNull()), options)
    days = stage(ledger_days(ledger, options), "ledger")
    rejected = {"rejected_quantities": rejected_quantities(returned, dated, ledger, options)} if options.reject_negative else {}
    return rejected | {
        "refunds_vs_returns": refunds_vs_returns(refunded, returned),
        "returns_vs_reimbursements": returns_vs_reimbursements(reimbursed_lines, by_key),
        "cash_reimbursement": cash_reimbursement(reimbursed_lines, by_key, settlements(payments, options)),
        "returned_to_inventory": returned_to_inventory(restocked, days, options),
        "inventory_reimbursement": inventory_reimbursement(granted, days, options),
    }
