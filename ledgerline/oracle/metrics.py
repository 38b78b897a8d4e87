"""Comparison SQL for the metric layer."""

from __future__ import annotations

from ledgerline.oracle.build import query
from ledgerline.plans.metrics import CATALOG, CATALOG_NAMES, CHANNEL, MONTHLY

# Base sums per fact as DuckDB SQL: table, date column, sums.
SOURCES = {
    "sales": ("fct_orders", "date_id", """sum(gross_revenue) filter (where order_status <> 'cancelled') as gross,
        sum(total_discount) as disc, sum(total_cost) as cost, sum(unit_count) as units,
        count(distinct order_id) filter (where order_status <> 'cancelled') as orders_n,
        sum(total_refunds) as booked_refunds"""),
    "returned": ("fct_refunds", "date_id", """sum(amount) as refunded, count(*) as refund_n,
        count(*) filter (where is_over_refund) as over_n"""),
    "paid": ("fct_payments", "date_id", """count(*) filter (where reconciliation_status = 'EXCEPTION') as pay_exc,
        count(*) filter (where reconciliation_status = 'WARNING') as pay_warn"""),
    "joiners": ("(select o.customer_id, o.date_id from fct_orders o join (select customer_id, min(date_id) as d "
                "from fct_orders group by 1) f on f.customer_id = o.customer_id and f.d = o.date_id)", "date_id",
                "count(distinct customer_id) as new_n"),
    "ads": ("fct_ad_spend", "date_id", """sum(spend) as spent, sum(attributed_revenue) as attributed,
        sum(conversions) as conv, sum(clicks) as clicked, sum(impressions) as shown"""),
    "stock": ("fct_inventory", "date_id", """sum(inventory_value) as stock_value,
        count(distinct month(date_id)) as stock_months,
        count(distinct product_id) filter (where stock_status = 'out_of_stock') as out_n,
        count(distinct product_id) filter (where stock_status = 'low_stock') as low_n"""),
    "shipped": ("fct_shipments", "date_id", """count(*) as ship_n, count(*) filter (where is_on_time) as on_time_n,
        sum(transit_days) as transit, count(transit_days) as transit_n,
        count(*) filter (where days_late > 0) as late_n"""),
    "paidout": ("fct_payouts", "date_id", """sum(net_payout) as payout, sum(payout_variance) as variance,
        count(*) filter (where reconciliation_status = 'EXCEPTION') as recon_n"""),
}
BASES = (
    "gross disc cost units orders_n booked_refunds refunded refund_n over_n pay_exc pay_warn new_n spent attributed conv "
    "clicked shown stock_value stock_months out_n low_n ship_n on_time_n transit transit_n late_n payout variance recon_n"
).split()
PEOPLE = (
    "(select count(*) as people, count(*) filter (where is_repeat_customer) as repeaters, "
    "sum(lifetime_revenue) as lifetime from dim_customer)"
)


def _blank(parts: str, *names: str) -> str:
    return f"if(coalesce({', '.join(names)}) is null, null, {parts})"


def _div(a: str, b: str) -> str:
    return f"(({a})::double / nullif(({b})::double, 0))"


def formulas(refunds: str = "refunded") -> dict[str, str]:
    net = _blank(f"ifnull(gross,0)-ifnull(disc,0)-ifnull({refunds},0)", "gross", "disc", refunds)
    profit = _blank(f"ifnull(gross,0)-ifnull(disc,0)-ifnull({refunds},0)-ifnull(cost,0)", "gross", "disc", refunds, "cost")
    return {
        "gross_revenue": "gross", "net_revenue": net, "cogs": "cost", "gross_profit": profit,
        "gross_margin_pct": _div(profit, net), "order_count": "orders_n", "aov": _div(net, "orders_n"),
        "new_customers": "new_n", "cac": _div("spent", "new_n"), "roas": _div("attributed", "spent"),
        "refund_rate": _div(refunds, "gross"),
        "inventory_turnover": _div("cost", _div("stock_value", "stock_months")), "ltv": _div("lifetime", "people"),
        "total_discounts": "disc", "total_refunds": refunds, "units_sold": "units", "total_customers": "people",
        "repeat_customers": "repeaters", "total_ad_spend": "spent", "attributed_revenue": "attributed",
        "total_conversions": "conv", "ctr": _div("clicked", "shown"), "cvr": _div("conv", "clicked"),
        "refund_count": "refund_n", "over_refund_count": "over_n", "payment_exceptions": "pay_exc",
        "payment_warnings": "pay_warn", "total_inventory_value": "stock_value", "out_of_stock_skus": "out_n",
        "low_stock_skus": "low_n", "shipment_count": "ship_n", "on_time_rate": _div("on_time_n", "ship_n"),
        "avg_transit_days": _div("transit", "transit_n"), "late_shipments": "late_n", "total_net_payout": "payout",
        "total_payout_variance": "variance", "recon_exceptions": "recon_n",
        "payout_delta": _blank(f"ifnull({net}, 0) - ifnull(payout, 0)", f"({net})", "payout"),
    }


COUNTS = {
    "order_count", "new_customers", "units_sold", "total_customers", "repeat_customers", "total_conversions",
    "refund_count", "over_refund_count", "payment_exceptions", "payment_warnings", "out_of_stock_skus",
    "low_stock_skus", "shipment_count", "late_shipments", "recon_exceptions",
}


def outputs(names, refunds: str = "refunded", as_double: bool = False) -> str:
    made = formulas(refunds)
    parts = []
    for n in names:
        if n in COUNTS and not as_double:
            parts.append(f"({made[n]})::bigint as {n}")
        else:
            parts.append(f"({made[n]})::double as {n}")
    return ", ".join(parts)


def based(grain: str | None, sources=tuple(SOURCES)) -> str:
    """All base sums side by side per period."""
    period = {"day": "{d}", None: "date '2000-01-01'"}.get(grain, f"date_trunc('{grain}', {{d}})::date")
    joined = ""
    for i, s in enumerate(sources):
        table, day, sums = SOURCES[s]
        part = f"(select {period.format(d=day)} as p, {sums} from {table} group by 1)"
        joined += part + f" t{i}" if i == 0 else f" full join {part} t{i} using (p)"
    return f"(select * from {joined}) b cross join {PEOPLE} c"


def _long(source: str, names, refunds: str = "refunded", keys: str = "p") -> str:
    made = formulas(refunds)
    return " union all ".join(
        f"select {keys}, '{n}' as metric, ({made[n]})::double as value from {source}" for n in names
    )


def _compared(long: str, month: str, keys: str = "") -> str:
    on = f" and a.{keys} = x.{keys}" if keys else ""
    on2 = f" and b.{keys} = x.{keys}" if keys else ""
    return f"""
        select x.{month} as month, {f'x.{keys}, ' if keys else ''}x.metric, x.value,
          a.value as pm, b.value as py,
          ((ifnull(x.value, 0) - a.value) / nullif(a.value, 0)) as mom_pct,
          ((ifnull(x.value, 0) - b.value) / nullif(b.value, 0)) as yoy_pct
        from {long} x left join {long} a on a.metric = x.metric and a.{month} = x.{month} - interval 1 month{on}
          left join {long} b on b.metric = x.metric and b.{month} = x.{month} - interval 1 year{on2}"""


def _by_channel(month: bool) -> str:
    p = "date_trunc('month', date_id)::date as p, " if month else ""
    keys = "p, channel_id" if month else "channel_id"
    sales, ads = SOURCES["sales"][2], SOURCES["ads"][2]
    return (
        f"((select {p}channel_id, {sales} from fct_orders group by all) full join "
        f"(select {p}channel_id, {ads} from fct_ad_spend group by all) using ({keys}))"
    )


_RUNNING = [b for b in BASES if b not in ("stock_months", "out_n", "low_n")]


def _to_date() -> str:
    def running(keys: str) -> str:
        return ", ".join(
            f"sum({b}) over (partition by {keys} order by date_id rows unbounded preceding) as {b}"
            for b in [*_RUNNING, "stock_months"]
        )

    plain = ", ".join([*_RUNNING, "stock_months"])
    parts = [
        f"select date_id, 'day' as horizon, {plain} from spread",
        f"select date_id, 'mtd', {running('year, month_number')} from spread",
        f"select date_id, 'qtd', {running('year, quarter_number')} from spread",
        f"select date_id, 'ytd', {running('year')} from spread",
    ]
    return f"""
        select date_id, horizon, {outputs(CATALOG_NAMES, as_double=False)}
        from ({' union all '.join(parts)}) cross join {PEOPLE}"""


SPREAD = f"""
    select date_id, year, quarter_number, month_number, {', '.join(_RUNNING)},
      case when stock_value is not null and row_number() over (partition by year, month_number, stock_value is null
        order by date_id) = 1 then 1 end as stock_months
    from dim_date left join (select * from {based('day')}) on p = date_id"""


def _text(value: str | None) -> str:
    return "null::varchar" if value is None else "'" + value.replace("'", "''") + "'"


def _catalog() -> str:
    made = formulas()
    rows = " union all ".join(
        "select "
        + ", ".join(
            f"{_text(getattr(m, f))} as {f}"
            for f in ("name", "display_name", "description", "formula", "grain", "unit", "format", "filters", "limitations")
        )
        + f", ({made[m.name]})::double as value from totals"
        for m in CATALOG
    )
    return query(rows, {"totals": f"select * from {based(None)}"})


_LONG = {
    "by_month": f"select * from {based('month')}",
    "long_months": _long("by_month", CATALOG_NAMES),
    "by_month_channel": f"select * from {_by_channel(True)}",
    "long_channels": _long("by_month_channel", CHANNEL, "booked_refunds", "p, channel_id"),
}

SQL = {
    "met_catalog": _catalog(),
    "met_monthly": query(f"select p as month, {outputs(MONTHLY)} from {based('month')}"),
    "met_quarterly": query(f"select p as quarter, {outputs(MONTHLY)} from {based('quarter')}"),
    "met_yearly": query(f"select p as year, {outputs(MONTHLY)} from {based('year')}"),
    "met_by_channel": query(f"select channel_id, {outputs(CHANNEL, 'booked_refunds')} from {_by_channel(False)}"),
    "met_by_month_and_channel": query(
        f"select p as month, channel_id, {outputs(CHANNEL, 'booked_refunds')} from {_by_channel(True)}"
    ),
    "ti_to_date": query(_to_date(), {"spread": SPREAD}),
    "ti_compare_months": query(_compared("long_months", "p"), _LONG),
    "ti_compare_months_by_channel": query(_compared("long_channels", "p", "channel_id"), _LONG),
    "ti_margin_change": query(
        """select x.p as month, x.value as gross_margin_pct,
             (if(coalesce(x.value, a.value) is null, null, ifnull(x.value, 0) - ifnull(a.value, 0))) as mom_pp
           from long_months x left join long_months a on a.metric = x.metric and a.p = x.p - interval 1 month
           where x.metric = 'gross_margin_pct'""",
        {**_LONG, "by_month": f"select * from {based('month', ('sales', 'returned'))}",
         "long_months": _long("by_month", ("gross_margin_pct",))},
    ),
    "met_ltv": query("select customer_id, lifetime_revenue::double as ltv from dim_customer"),
}

# Which facts a single metric draws on decides which months it has rows for.
DRAWS_ON = {
    "gross_revenue": ("sales",), "net_revenue": ("sales", "returned"), "cogs": ("sales",),
    "gross_profit": ("sales", "returned"), "gross_margin_pct": ("sales", "returned"), "order_count": ("sales",),
    "aov": ("sales", "returned"), "new_customers": ("joiners",), "cac": ("joiners", "ads"), "roas": ("ads",),
    "refund_rate": ("sales", "returned"), "inventory_turnover": ("sales", "stock"),
    "total_discounts": ("sales",), "total_refunds": ("returned",), "units_sold": ("sales",),
    "total_ad_spend": ("ads",), "attributed_revenue": ("ads",), "total_conversions": ("ads",), "ctr": ("ads",),
    "cvr": ("ads",), "refund_count": ("returned",), "over_refund_count": ("returned",),
    "payment_exceptions": ("paid",), "payment_warnings": ("paid",), "total_inventory_value": ("stock",),
    "out_of_stock_skus": ("stock",), "low_stock_skus": ("stock",), "shipment_count": ("shipped",),
    "on_time_rate": ("shipped",), "avg_transit_days": ("shipped",), "late_shipments": ("shipped",),
    "total_net_payout": ("paidout",), "total_payout_variance": ("paidout",), "recon_exceptions": ("paidout",),
    "payout_delta": ("sales", "returned", "paidout"),
}
SQL.update(
    {
        f"met_{n}": query(f"select p as month, {outputs((n,))} from {based('month', sources)}")
        for n, sources in DRAWS_ON.items()
    }
)
SQL.update({f"met_{n}": query(f"select {outputs((n,))} from {PEOPLE}") for n in ("total_customers", "repeat_customers")})
