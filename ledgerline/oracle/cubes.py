"""Comparison SQL for distinct counts and cubes."""

from __future__ import annotations

from ledgerline.oracle.build import query
from ledgerline.plans.cubes import CHANNEL, MONTH

_ACTIVE = {
    "active": """select date_id as d, channel_id as c, customer_id as k from fct_orders
        where order_status not in ('cancelled', 'unknown')""",
    "monthly_customers": "select distinct cast(date_trunc('month', d) as date) as month, k from active where k is not null",
}


def _customers(grain: str, period: str | None, channel: bool) -> str:
    start = "null::date" if period is None else "d" if period == "day" else f"cast(date_trunc('{period}', d) as date)"
    return (
        f"select '{grain}' as grain, {start} as period, {'c' if channel else 'null::int'} as channel_id, "
        "count(distinct k) as customers from active where k is not null group by all"
    )


_CUTS = (
    ("day", "day", False), ("month", "month", False), ("quarter", "quarter", False), ("year", "year", False),
    ("channel", None, True), ("month and channel", "month", True), ("all", None, False),
)
_LINES = {
    "cube_lines": """select cast(date_trunc('month', date_id) as date) as month, channel_id, category, quantity, revenue,
        discount, gross_profit from fct_order_items""",
}
_SUMS = "sum(quantity)::bigint as units_sold, (sum(revenue) - sum(discount))::double as net_revenue"
_MARGIN = "sum(gross_profit)::double / nullif(sum(revenue)::double, 0) as margin"


def _step(name: str, kept: tuple[str, ...], where: str = "true") -> str:
    types = {"month": "date", "channel_id": "int", "category": "varchar"}
    columns = ", ".join(c if c in kept else f"null::{t} as {c}" for c, t in types.items())
    grouped = f"group by {', '.join(kept)}" if kept else ""
    return f"select '{name}' as step, {columns}, {_SUMS}, {_MARGIN} from cube_lines where {where} {grouped}"


SQL = {
    "met_distinct_customers": query(" union all ".join(_customers(*cut) for cut in _CUTS), _ACTIVE),
    "met_retained_customers": query(
        """select a.month, count(*) as customers, count(b.k) as retained from monthly_customers a
           left join monthly_customers b on b.k = a.k and b.month = a.month - interval 1 month group by a.month""",
        _ACTIVE,
    ),
    "rpt_sales_cube": query(
        f"""select month, channel_id, category, grouping(month, channel_id, category) as level, {_SUMS},
              sum(revenue)::double as revenue, sum(gross_profit)::double as gross_profit
            from cube_lines group by cube (month, channel_id, category)""",
        _LINES,
    ),
    "rpt_drill_path": query(
        " union all ".join(
            (
                _step("all", ()),
                _step("channels", ("channel_id",)),
                _step("months of a channel", ("month",), f"channel_id = {CHANNEL}"),
                _step("categories of the month", ("category",), f"channel_id = {CHANNEL} and month = date '{MONTH}'"),
                _step("channels and categories", ("channel_id", "category")),
            )
        ),
        _LINES,
    ),
}
