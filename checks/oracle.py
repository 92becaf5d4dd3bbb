"""SQL counterparts of the registered queries, written against the raw tables.

They spell the reports out the plain way: one row per unit, joins before grouping,
no pre-aggregation.
"""

from __future__ import annotations

from checks.inputs import common_tables
from tallymark.operators.reporting import REPORTS

ORACLE: dict[str, str] = {}


def _sku(column: str, prefix: str = "SKU-") -> str:
    plain = f"replace(replace(coalesce({column}, 'Not Available'), '_New', ''), '_NEW', '')"
    return f"'{prefix}' || case when length({plain}) > 13 then substr({plain}, 9, 12) else {plain} end"


LEDGER_SKU = "'SKU-' || substr(case when substr(msku, 1, 4) = 'amzn' then substr(msku, 9, 12) else msku end, 1, 12)"
LEDGER_DAY = "cast(substr(date_text, 7, 4) || '-' || substr(date_text, 1, 2) || '-' || substr(date_text, 4, 2) as date)"
RESTOCKED = "('Unit returned to inventory', 'Repackaged Successfully')"

STEPS: dict[str, str] = {
    "refunds": f"""
      select order_id, {_sku('sku')} as sku, sum(quantity) as quantity_refund, sum(-total) as total
      from fx_payments where type = 'Refund' and order_id is not null group by 1, 2""",
    "settled": f"""
      select order_id, {_sku('sku')} as sku, sum(quantity) as quantity_settled, sum(total) as amount_settled
      from fx_payments where description = 'FBA Inventory Reimbursement - Customer Return'
      group by 1, 2""",
    "returned": f"""
      select order_id, {_sku('sku')} as sku, status, quantity, return_date, fulfillment_center_id
      from fx_returns""",
    "paid_back": f"""
      select amazon_order_id as order_id, {_sku('sku')} as sku, approval_date, amount_total,
        quantity_reimbursed_cash, quantity_reimbursed_inventory, quantity_reimbursed_total
      from fx_reimbursements where reason = 'CustomerReturn'""",
    "reimbursed": """
      select r.order_id, r.sku, t.fulfillment_center_id, t.quantity, r.total
      from refunds r join (
        select order_id, sku, status, fulfillment_center_id, sum(quantity) as quantity from returned
        where fulfillment_center_id is not null group by all) t using (order_id, sku)
      where t.status = 'Reimbursed' and t.quantity <> 0""",
    "reimbursed_and_paid": """
      select b.*, coalesce(p.amount_total, 0) as amount_total, coalesce(p.cash, 0) as cash,
        coalesce(p.stock, 0) as stock, coalesce(p.both_kinds, 0) as both_kinds
      from reimbursed b left join (
        select order_id, sku, sum(amount_total) as amount_total, sum(quantity_reimbursed_cash) as cash,
          sum(quantity_reimbursed_inventory) as stock, sum(quantity_reimbursed_total) as both_kinds
        from paid_back group by all) p using (order_id, sku)""",
    "ledger_units": f"""
      select {LEDGER_SKU} as sku, fulfillment_center as fulfillment_center_id, {LEDGER_DAY} as day,
        unnest(generate_series(1, quantity)) as unit_of_line
      from fx_ledger where event_type = 'CustomerReturns' and disposition = 'SELLABLE'""",
    "restocked_units": f"""
      select row_number() over (order by order_id, sku, status, return_date, fulfillment_center_id, unit_no) as left_id, *
      from (
        select r.order_id, r.sku, t.status, t.return_date, t.fulfillment_center_id, r.total,
          cast(substr(t.return_date, 1, 10) as date) as day, unnest(generate_series(1, t.quantity)) as unit_no
        from refunds r join (
          select order_id, sku, status, return_date, fulfillment_center_id, cast(sum(quantity) as bigint) as quantity
          from returned where fulfillment_center_id is not null group by all) t using (order_id, sku)
        where t.status in {RESTOCKED})""",
    "granted_units": """
      select row_number() over (order by order_id, sku, fulfillment_center_id, approval_date, unit_no) as left_id, *
      from (
        select b.order_id, b.sku, b.fulfillment_center_id, p.approval_date, b.quantity as reimbursed, b.total,
          cast(substr(p.approval_date, 1, 10) as date) as day, unnest(generate_series(1, p.stock)) as unit_no
        from reimbursed b join (
          select order_id, sku, approval_date, cast(sum(quantity_reimbursed_inventory) as bigint) as stock
          from paid_back group by all) p using (order_id, sku)
        where p.stock <> 0)""",
    "bookings": """
      select fba_id, replace(replace(regexp_replace(sku, '\\.0$', ''), '_New', ''), '_NEW', '') as sku,
        cartons, qty, booking_date
      from fx_bookings where length(fba_id) = 12""",
    "dispatches": """
      select fba_id, dispatch_date, regexp_replace(sku, '\\.0$', '') as sku, inv_qty from fx_dispatches
      where fba_id in (select fba_id from bookings) and sku is not null""",
    "received": f"""
      select reference_id as fba_id, substr(coalesce(msku, 'nan'), 1, 12) as sku, {LEDGER_DAY} as receipt_date, quantity
      from fx_ledger where event_type = 'Receipts' and reference_id in (select fba_id from bookings)""",
    "detail": """
      select fba_id, booking_date, dispatch_date, sku, coalesce(cartons, 0) as cartons_booked,
        coalesce(inv_qty, 0) as cartons_dispatched, coalesce(qty, 0) as units_booked,
        coalesce(quantity, 0) as units_received, receipt_date,
        coalesce(dispatch_date - booking_date, 0) as dispatch_days,
        coalesce(receipt_date - dispatch_date, 0) as receipt_days
      from bookings full join dispatches using (fba_id, sku) full join received using (fba_id, sku)""",
    "by_sku": """
      select *, cartons_booked - cartons_dispatched as cartons_short, units_booked - units_received as units_short
      from (
        select fba_id, sku, cartons_booked, cartons_dispatched, units_booked, sum(units_received) as units_received
        from detail group by all)""",
    "packed": """
      select substr(carton_id, 1, 12) as fba_id, coalesce(upc_number, 'nan') as sku_id, bl_date, total_qty
      from fx_packing where carton_id is not null""",
    "all_received": f"""
      select reference_id as fba_id, coalesce(msku, 'nan') as sku_id, {LEDGER_DAY} as receipt_date, quantity
      from fx_ledger where event_type = 'Receipts' and reference_id is not null""",
}


def _matched(units: str) -> str:
    """Bracket matching of single units: two windows over one row per unit."""
    return f"""
    events as (
      select sku, fulfillment_center_id, day, 0 as side, -left_id as ord, 1 as change, left_id from {units}
      union all
      select sku, fulfillment_center_id, day, 1, row_number() over (), -1, null from ledger_units),
    depths as (
      select *, sum(change) over (partition by sku, fulfillment_center_id order by day, side, ord
        rows between unbounded preceding and current row) as depth from events),
    pairs as (
      select *, lead(day) over (partition by sku, fulfillment_center_id, case when side = 0 then depth else depth + 1 end
        order by day, side, ord) as right_day from depths),
    matched as (
      select u.*, p.right_day from {units} u join pairs p on p.side = 0 and p.left_id = u.left_id)"""


def _add(name: str, fixtures: str, steps: str, final: str) -> None:
    parts = [common_tables(*fixtures.split())]
    for step in steps.split():
        parts.append(_matched(step.split(":")[1]) if step.startswith("match:") else f"{step} as ({STEPS[step]})")
    ORACLE[name] = "with " + ",\n".join(parts) + final


_add("sku_from_report", "fx_payments", "", f"""
  select {_sku('sku')} as sku, {_sku('sku', '')} as bare_sku, count(*) as lines
  from fx_payments where type = 'Refund' group by fx_payments.sku""")

_add("sku_from_ledger", "fx_ledger", "", f"""
  select msku, {LEDGER_SKU} as sku, count(*) as lines from fx_ledger group by msku""")

_add("clean_booking_sku", "fx_bookings fx_dispatches", "bookings dispatches", """
  select 'booking' as side, fba_id, sku, cast(sum(cartons) as bigint) as quantity from bookings group by all
  union all
  select 'dispatch', fba_id, sku, cast(sum(inv_qty) as bigint) from dispatches group by all""")

_add("parse_dates_and_gaps", "fx_returns fx_ledger", "", f"""
  , a as (select order_id, max(cast(return_date as date)) as return_day from fx_returns group by 1)
  , b as (select 'O-' || cast(cast(substr(reference_id, 4) as bigint) as string) as order_id, max({LEDGER_DAY}) as receipt_day
          from fx_ledger where reference_id is not null group by 1)
  select order_id, cast(return_day as string) as return_day, strftime(receipt_day, '%m/%d/%Y') as receipt_day,
    receipt_day - return_day as gap_days
  from a full join b using (order_id)""")

_add("refunds_by_key", "fx_payments", "refunds", """
  select order_id, sku, cast(quantity_refund as bigint) as quantity_refund, cast(total as double) as total from refunds""")

_add("refunds_of_month", "fx_payments", "", f"""
  select order_id, {_sku('sku', '')} as sku, cast(sum(quantity) as bigint) as quantity_refund,
    cast(sum(-total) as double) as total
  from fx_payments where type = 'Refund' and substr(posted, 1, 3) = '199' group by 1, 2""")

_add("returns_by_status", "fx_returns", "returned", """
  select order_id, sku, status, cast(sum(quantity) as bigint) as quantity_returns from returned group by all""")

_add("returns_by_centre", "fx_returns", "returned", """
  select order_id, sku, status, fulfillment_center_id, cast(sum(quantity) as bigint) as quantity_returns
  from returned where fulfillment_center_id is not null group by all""")

_add("returns_by_date", "fx_returns", "returned", """
  select order_id, sku, status, return_date, fulfillment_center_id, cast(sum(quantity) as bigint) as quantity_returns
  from returned where fulfillment_center_id is not null group by all""")

for _name, _grain in (("reimbursements_by_key", ""), ("reimbursements_by_date", "approval_date, ")):
    _add(_name, "fx_reimbursements", "paid_back", f"""
  select order_id, sku, {_grain}cast(sum(amount_total) as double) as amount_total,
    cast(sum(quantity_reimbursed_cash) as bigint) as quantity_reimbursed_cash,
    cast(sum(quantity_reimbursed_inventory) as bigint) as quantity_reimbursed_inventory,
    cast(sum(quantity_reimbursed_total) as bigint) as quantity_reimbursed_total
  from paid_back group by all""")

_add("settlements_by_key", "fx_payments", "settled", """
  select order_id, sku, cast(quantity_settled as bigint) as quantity_settled,
    cast(amount_settled as double) as amount_settled
  from settled""")

REFUND_LINES = """
  , lines as (
    select r.order_id, r.sku, r.quantity_refund, r.total, coalesce(t.status, 'Not found in customer returns') as status,
      coalesce(t.quantity, 0) as quantity
    from refunds r left join (
      select order_id, sku, status, sum(quantity) as quantity from returned group by all) t using (order_id, sku))
  , report as (
    select order_id, sku, sum(quantity_refund) as c3, sum(total) as c4, sum(quantity) as c5,
      sum(case when status = 'Reimbursed' then quantity else 0 end) as c6,
      sum(case when status in ('Unit returned to inventory', 'Repackaged Successfully') then quantity else 0 end) as c7,
      sum(quantity_refund - quantity) as c8,
      sum(cast(round(cast(total as double) / nullif(quantity_refund, 0) * (quantity_refund - quantity), 6) as decimal(28,6))) as c9
    from lines group by all)"""
REFUND_COLUMNS = """order_id as "Order ID", sku as "SKU", cast(c3 as bigint) as "Refund Quantity",
    cast(c4 as double) as "Refund Amount", cast(c5 as bigint) as "Customer Returns", cast(c6 as bigint) as "Reimbursed",
    cast(c7 as bigint) as "Added to Inventory", cast(c8 as bigint) as "Quantity Difference",
    cast(c9 as double) as "Amount Difference" """

_add("refunds_vs_returns", "fx_payments fx_returns", "refunds returned", f"{REFUND_LINES} select {REFUND_COLUMNS} from report")

_add("report_totals", "fx_payments fx_returns", "refunds returned", f"""{REFUND_LINES}
  select {REFUND_COLUMNS}, 'DETAIL' as "Row Kind" from report
  union all
  select null, null, cast(sum(c3) as bigint), cast(sum(c4) as double), cast(sum(c5) as bigint), cast(sum(c6) as bigint),
    cast(sum(c7) as bigint), cast(sum(c8) as bigint), cast(sum(c9) as double), 'TOTAL'
  from report""")

_add("returns_vs_reimbursements", "fx_payments fx_returns fx_reimbursements",
     "refunds returned paid_back reimbursed reimbursed_and_paid", """
  select order_id as "Order ID", sku as "SKU", cast(total as double) as "Refund Amount",
    cast(quantity as bigint) as "Reimbursed Quantity", cast(amount_total as double) as "Reimbursed Amount",
    cast(cash as bigint) as "Cash Reimbursement", cast(stock as bigint) as "Inventory Reimbursement",
    cast(both_kinds as bigint) as "Total Reimbursement", cast(quantity - both_kinds as bigint) as "Quantity Difference",
    cast(cast(round(cast(total as double) / quantity * (quantity - both_kinds), 6) as decimal(28,6)) as double)
      as "Amount Difference"
  from reimbursed_and_paid""")

_add("cash_reimbursement", "fx_payments fx_returns fx_reimbursements",
     "refunds settled returned paid_back reimbursed reimbursed_and_paid", """
  select order_id as "Order ID", sku as "SKU", cast(cash as bigint) as "Quantity Reimbursed",
    cast(amount_total as double) as "Amount Reimbursed", cast(coalesce(quantity_settled, 0) as bigint) as "Quantity Settled",
    cast(coalesce(amount_settled, 0) as double) as "Amount Settled",
    cast(cash - coalesce(quantity_settled, 0) as bigint) as "Quantity Difference",
    cast(amount_total - coalesce(amount_settled, 0) as double) as "Amount Difference"
  from reimbursed_and_paid left join settled using (order_id, sku) where cash <> 0""")

_add("unit_identities", "fx_ledger", "ledger_units", """
  select sku, fulfillment_center_id, cast(day as string) as ledger_day,
    row_number() over (partition by sku, fulfillment_center_id, day) as unit_no
  from ledger_units""")

_add("nearest_date_match", "fx_payments fx_returns fx_ledger",
     "refunds returned ledger_units restocked_units match:restocked_units", """
  select sku, fulfillment_center_id, order_id, status, cast(day as string) as return_day,
    coalesce(cast(right_day as string), 'none') as right_day, count(*) as units
  from matched group by all""")

_add("returned_to_inventory", "fx_payments fx_returns fx_ledger",
     "refunds returned ledger_units restocked_units match:restocked_units", """
  select sku as "SKU", fulfillment_center_id as "Fulfillment Center", strftime(day, '%m/%d/%Y') as "Return Date",
    cast(1 as bigint) as "Return Quantity", cast(total as double) as "Amount",
    strftime(right_day, '%m/%d/%Y') as "Date added to Inventory",
    case when right_day is not null then cast(1 as bigint) end as "Quantity Added", right_day - day as "Days Difference",
    cast(case when right_day is not null then 0 else 1 end as bigint) as "Quantity Difference",
    case when right_day is not null then cast(0 as double) else cast(total as double) end as "Amount Difference"
  from matched""")

_add("inventory_reimbursement", "fx_payments fx_returns fx_reimbursements fx_ledger",
     "refunds returned paid_back reimbursed ledger_units granted_units match:granted_units", """
  select sku as "SKU", fulfillment_center_id as "Fulfillment Center", strftime(day, '%m/%d/%Y') as "Approval Date",
    cast(reimbursed as bigint) as "Quantity", cast(total as double) as "Amount",
    case when right_day is not null then cast(1 as bigint) end as "Quantity Received",
    strftime(right_day, '%m/%d/%Y') as "Received Date", right_day - day as "Days Difference",
    cast(case when right_day is not null then 0 else 1 end as bigint) as "Quantity Difference",
    case when right_day is not null then cast(0 as double) else cast(total as double) end as "Amount Difference"
  from matched""")

_add("booked_receipts", "fx_bookings fx_ledger", "", f"""
  select reference_id as fba_id, substr(coalesce(msku, 'nan'), 1, 12) as sku, cast({LEDGER_DAY} as string) as receipt_date,
    cast(quantity as bigint) as quantity
  from fx_ledger where event_type = 'Receipts'
    and reference_id in (select fba_id from fx_bookings where cartons % 3 = 1)""")

SHIPMENT_FIXTURES = "fx_bookings fx_dispatches fx_ledger"
SHIPMENT_STEPS = "bookings dispatches received detail"
DETAIL_COLUMNS = """fba_id as "FBA ID", coalesce(cast(booking_date as string), 'NOT AVAILABLE') as "BOOKING DATE",
    coalesce(cast(dispatch_date as string), 'NOT AVAILABLE') as "DISPATCH DATE", sku as "SKU",
    cast(cartons_booked as bigint) as "CARTONS BOOKED", cast(cartons_dispatched as bigint) as "CARTONS DISPATCHED",
    cast(units_booked as bigint) as "UNITS BOOKED", cast(units_received as bigint) as "UNITS RECEIVED",
    coalesce(cast(receipt_date as string), 'NOT AVAILABLE') as "RECEIPT DATE",
    cast(dispatch_days as bigint) as "DISPATCH DAYS", cast(receipt_days as bigint) as "RECEIPT DAYS" """
SKU_COLUMNS = """fba_id as "FBA ID", sku as "SKU", cast(cartons_booked as bigint) as "CARTONS BOOKED",
    cast(cartons_dispatched as bigint) as "CARTONS DISPATCHED", cast(cartons_short as bigint) as "CARTONS SHORT DISPATCHED",
    cast(units_booked as bigint) as "UNITS BOOKED", cast(units_received as bigint) as "UNITS RECEIVED",
    cast(units_short as bigint) as "UNITS SHORT RECEIVED" """
SKU_FLAGS = """case when cartons_short = 0 then 'PASS' else 'FAIL' end as "CARTONS SHORT DISPATCHED Status",
    case when units_short = 0 then 'PASS' else 'FAIL' end as "UNITS SHORT RECEIVED Status" """

_add("shipment_detail", SHIPMENT_FIXTURES, SHIPMENT_STEPS, f" select {DETAIL_COLUMNS} from detail")

_add("detail_flags", SHIPMENT_FIXTURES, SHIPMENT_STEPS, f"""
  select {DETAIL_COLUMNS},
    case when booking_date is null then 'FAIL' else 'PASS' end as "BOOKING DATE Status",
    case when dispatch_date is null then 'FAIL' else 'PASS' end as "DISPATCH DATE Status",
    case when receipt_date is null then 'FAIL' else 'PASS' end as "RECEIPT DATE Status",
    case when cartons_booked = 0 then 'FAIL' else 'PASS' end as "CARTONS BOOKED Status",
    case when cartons_dispatched = 0 then 'FAIL' else 'PASS' end as "CARTONS DISPATCHED Status",
    case when units_booked = 0 then 'FAIL' else 'PASS' end as "UNITS BOOKED Status",
    case when units_received = 0 then 'FAIL' else 'PASS' end as "UNITS RECEIVED Status"
  from detail""")

_add("shipment_by_sku", SHIPMENT_FIXTURES, f"{SHIPMENT_STEPS} by_sku", f" select {SKU_COLUMNS} from by_sku")

_add("shipment_exceptions", SHIPMENT_FIXTURES, f"{SHIPMENT_STEPS} by_sku", f"""
  select {SKU_COLUMNS} from by_sku where cartons_short <> 0 or units_short <> 0""")

_add("report_flags", SHIPMENT_FIXTURES, f"{SHIPMENT_STEPS} by_sku", f" select {SKU_COLUMNS}, {SKU_FLAGS} from by_sku")

_add("written_report", SHIPMENT_FIXTURES, f"{SHIPMENT_STEPS} by_sku", f"""
  select {SKU_COLUMNS}, {SKU_FLAGS}, 'DETAIL' as "Row Kind" from by_sku
  union all
  select null, null, cast(sum(cartons_booked) as bigint), cast(sum(cartons_dispatched) as bigint),
    cast(sum(cartons_short) as bigint), cast(sum(units_booked) as bigint), cast(sum(units_received) as bigint),
    cast(sum(units_short) as bigint), null, null, 'TOTAL'
  from by_sku""")

_add("shipment_without_dispatch", "fx_bookings fx_ledger", "bookings received", """
  , by_sku as (
    select fba_id, sku, cartons as cartons_booked, 0 as cartons_dispatched, qty as units_booked,
      coalesce(sum(quantity), 0) as units_received
    from bookings full join received using (fba_id, sku) where cartons is not null and qty is not null group by all)
  select fba_id as "FBA ID", sku as "SKU", cast(cartons_booked as bigint) as "CARTONS BOOKED",
    cast(0 as bigint) as "CARTONS DISPATCHED", cast(cartons_booked as bigint) as "CARTONS SHORT DISPATCHED",
    cast(units_booked as bigint) as "UNITS BOOKED", cast(units_received as bigint) as "UNITS RECEIVED",
    cast(units_booked - units_received as bigint) as "UNITS SHORT RECEIVED"
  from by_sku""")

_add("shipment_summary", SHIPMENT_FIXTURES, f"{SHIPMENT_STEPS} by_sku", """
  select fba_id as "FBA ID", count(sku) as "SKU", cast(sum(cartons_booked) as bigint) as "CARTONS BOOKED",
    cast(sum(cartons_dispatched) as bigint) as "CARTONS DISPATCHED",
    cast(sum(greatest(-cartons_short, 0)) as bigint) as "EXCESS CARTONS DISPATCHED",
    cast(sum(greatest(cartons_short, 0)) as bigint) as "SHORT CARTONS DISPATCHED",
    cast(sum(units_booked) as bigint) as "UNITS BOOKED", cast(sum(units_received) as bigint) as "UNITS RECEIVED",
    cast(sum(greatest(-units_short, 0)) as bigint) as "EXCESS UNITS RECEIVED",
    cast(sum(greatest(units_short, 0)) as bigint) as "SHORT UNITS RECEIVED"
  from by_sku group by fba_id""")

_add("shipment_kpis", SHIPMENT_FIXTURES, f"{SHIPMENT_STEPS} by_sku", """
  select cast(sum(units_booked) as bigint) as "UNITS BOOKED",
    cast(sum(greatest(-units_short, 0)) as bigint) as "EXCESS UNITS RECEIVED",
    cast(-sum(greatest(units_short, 0)) as bigint) as "SHORT UNITS RECEIVED",
    cast(-sum(units_received) as bigint) as "UNITS RECEIVED",
    count(*) filter (where units_short = 0) as "MATCHING SKUS",
    count(*) filter (where units_short <> 0) as "MISMATCHING SKUS"
  from by_sku""")

_add("packing_vs_receipts", "fx_packing fx_ledger", "packed all_received", """
  select p.fba_id as "FBA ID", p.sku_id as "SKU ID", cast(p.quantity as bigint) as "Qty: Packing List",
    cast(coalesce(r.quantity, 0) as bigint) as "Qty: Inv Ledger",
    cast(coalesce(r.quantity, 0) - p.quantity as bigint) as "Excess/(Short) Received"
  from (select fba_id, sku_id, sum(total_qty) as quantity from packed group by all) p
  left join (select fba_id, sku_id, sum(quantity) as quantity from all_received group by all) r using (fba_id, sku_id)""")

_add("packing_vs_receipts_dated", "fx_packing fx_ledger", "packed all_received", """
  select p.fba_id as "FBA ID", p.sku_id as "SKU ID", cast(p.quantity as bigint) as "Qty: Packing List",
    cast(p.bl_date as string) as "BL Date", cast(coalesce(r.quantity, 0) as bigint) as "Qty: Inv Ledger",
    coalesce(cast(r.receipt_date as string), '-') as "Receipt Date", r.receipt_date - p.bl_date as "Transit Days"
  from (select fba_id, sku_id, bl_date, sum(total_qty) as quantity from packed group by all) p
  left join (select fba_id, sku_id, receipt_date, sum(quantity) as quantity from all_received group by all) r
    using (fba_id, sku_id)""")

_add("packing_sheets", "", "", """
  select fba_id || '-' || base_sku || '-' || cast(d as string) as file,
    fba_id || 'U' || lpad(cast(l_linenumber as string), 6, '0') as carton_id, base_sku as upc_number,
    cast(sum(q) as bigint) as total_qty, cast(d as string) as bl_date
  from fx_base where l_returnflag = 'N' group by fba_id, base_sku, d, l_linenumber""")

_add("dispatch_sheets", "fx_bookings", "", """
  , heads as (
    select fba_id, cast(min(d) + 2 as string) as dispatch_date from fx_base
    where l_returnflag = 'N' and l_linenumber <> 6 group by 1)
  select fba_id, dispatch_date, base_sku as sku, cast(sum(1 + q % 10) as bigint) as inv_qty
  from fx_base join heads using (fba_id)
  where l_returnflag = 'N' and l_linenumber <> 6
    and fba_id in (select fba_id from fx_bookings where cartons % 3 = 1)
  group by fba_id, dispatch_date, base_sku, l_linenumber""")

_add("union_ledgers", "fx_ledger", "", """
  select date_text, msku, cast(quantity as bigint) as quantity, fulfillment_center, event_type, disposition, reference_id
  from fx_ledger""")

_add("booking_date_from_file", "fx_bookings", "", """
  select fba_id, replace(sku, '_NEW', '') as sku, cast(cartons as bigint) as cartons, cast(qty as bigint) as qty,
    cast(cast(date_trunc('month', booking_date) as date) as string) as booking_date
  from fx_bookings where length(fba_id) = 12""")

_add("ledger_with_header_text", "fx_ledger", "", """
  select date_text, msku, cast(quantity as bigint) as quantity,
    case quantity when 1 then 'Reference ID' when 2 then '12" ruler, "blue"' else fulfillment_center end as fulfillment_center,
    event_type, disposition, reference_id
  from fx_ledger""")

_add("csv_payments", "fx_payments", "", """
  select posted, type, order_id, sku, description, cast(quantity as bigint) as quantity, cast(total as double) as total
  from fx_payments""")

_add("csv_returns", "fx_returns", "", """
  select order_id, sku, status, cast(quantity as bigint) as quantity, return_date, fulfillment_center_id from fx_returns""")

_add("csv_reimbursements", "fx_reimbursements", "", """
  select reason, approval_date, amazon_order_id, sku, cast(amount_total as double) as amount_total,
    cast(quantity_reimbursed_cash as bigint) as quantity_reimbursed_cash,
    cast(quantity_reimbursed_inventory as bigint) as quantity_reimbursed_inventory,
    cast(quantity_reimbursed_total as bigint) as quantity_reimbursed_total
  from fx_reimbursements""")

_add("rejected_quantities", "fx_ledger", "", f"""
  , lines as (
    select {LEDGER_SKU} as sku, fulfillment_center as fulfillment_center_id, cast({LEDGER_DAY} as string) as day,
      case when quantity = 3 then -quantity else quantity end as quantity
    from fx_ledger where event_type = 'CustomerReturns' and disposition = 'SELLABLE')
  select 'rejected' as kind, sku, fulfillment_center_id, day, cast(quantity as bigint) as quantity from lines where quantity < 0
  union all
  select 'kept', sku, fulfillment_center_id, day, cast(sum(quantity) as bigint) from lines
  where quantity >= 1 group by all""")


def _totals(name: str, columns: list[str]) -> str:
    return " union all ".join(
        f"""select '{name}' as report, '{c}' as "column", cast(sum(cast("{c}" as decimal(38,6))) as double) as total
        from ({ORACLE[name]})""" for c in columns
    )


ORACLE["written_totals"] = " union all ".join(
    _totals(name, [REPORTS[name].columns[c] for c in REPORTS[name].totals])
    for name in ("refunds_vs_returns", "returns_vs_reimbursements", "cash_reimbursement")
)

_add("booking_files", "fx_bookings", "", """
  select fba_id, replace(sku, '_NEW', '') as sku, cast(cartons as bigint) as cartons, cast(qty as bigint) as qty,
    cast(cast(date_trunc('month', booking_date) as date) as string) as booking_date
  from fx_bookings where length(fba_id) = 12""")

ORACLE["written_detail"] = ORACLE["detail_flags"]

_add("written_packing", "fx_packing fx_ledger", "packed all_received", """
  select p.fba_id as "FBA ID", p.sku_id as "SKU ID", cast(p.quantity as bigint) as "Qty: Packing List",
    cast(coalesce(r.quantity, 0) as bigint) as "Qty: Inv Ledger",
    cast(coalesce(r.quantity, 0) - p.quantity as bigint) as "Excess/(Short) Received",
    case when coalesce(r.quantity, 0) = p.quantity then 'PASS' else 'FAIL' end as "Excess/(Short) Received Status",
    null as "BL Date", null as "Receipt Date", null as "Transit Days", 'SKU-wise' as "Report"
  from (select fba_id, sku_id, sum(total_qty) as quantity from packed group by all) p
  left join (select fba_id, sku_id, sum(quantity) as quantity from all_received group by all) r using (fba_id, sku_id)
  union all
  select p.fba_id, p.sku_id, cast(p.quantity as bigint), cast(coalesce(r.quantity, 0) as bigint), null, null,
    cast(p.bl_date as string), coalesce(cast(r.receipt_date as string), '-'), r.receipt_date - p.bl_date, 'SKU-wise Date-wise'
  from (select fba_id, sku_id, bl_date, sum(total_qty) as quantity from packed group by all) p
  left join (select fba_id, sku_id, receipt_date, sum(quantity) as quantity from all_received group by all) r
    using (fba_id, sku_id)""")

_PLANTED = """
  , planted as (
    select *, case when substr(date_text, 1, 3) = '02/' then '02/31/' || substr(date_text, 7, 4) else date_text end as day,
      case quantity when 7 then 'seven' when 9 then null else cast(quantity as string) end as count,
      substr(date_text, 1, 3) = '02/' as bad_day, quantity in (7, 9) as bad_count
    from fx_ledger)"""

_add("ledger_good_lines", "fx_ledger", "", f"""
  select date_text, msku, cast(quantity as bigint) as quantity, fulfillment_center, event_type, disposition, reference_id
  from fx_ledger where substr(date_text, 1, 3) <> '02/' and quantity not in (7, 9)""")

_add("ledger_rejects", "fx_ledger", "", _PLANTED + """
  select 'date_text' as "column", day as raw, 'not a date' as reason, count(*) as lines from planted where bad_day group by day
  union all
  select 'quantity', count, case when count is null then 'missing' else 'not a number' end, count(*) from planted where bad_count group by count
  union all
  select 'any', null, '', count(*) from planted where bad_day or bad_count""")

ORACLE["written_flags"] = " union all ".join(
    f"""select '{report}' as report, '{column}' as "column",
      cast(count(*) filter (where "{column} Status" = 'PASS') as bigint) as passed,
      cast(count(*) filter (where "{column} Status" = 'FAIL') as bigint) as failed from ({rows})"""
    for report, rows in (
        ("shipment_by_sku", ORACLE["report_flags"]),
        ("packing_vs_receipts", f"""select * from ({ORACLE['written_packing']}) where "Report" = 'SKU-wise'"""),
    )
    for column in (REPORTS[report].columns[c] for c in REPORTS[report].flags)
)
