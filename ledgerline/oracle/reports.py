"""Comparison SQL for the report datasets."""

from __future__ import annotations

from ledgerline.oracle.build import query
from ledgerline.oracle.metrics import SPREAD, based, formulas, outputs
from ledgerline.plans.reports import CATEGORY, MONTH_NAMES, WAREHOUSE_CODES

_F = formulas()


def _pivot(keys: str, value: str, column: str, names) -> str:
    return ", ".join([keys, *(f"{value} filter (where {column} = '{n}') as \"{n}\"" for n in names)])


_NET = _F["net_revenue"]
_YEARS = "date_id between date '1997-01-01' and date '1998-12-31'"

SQL = {
    "rpt_executive_kpis": query(
        f"""select p as month,
              {outputs(('net_revenue', 'gross_profit', 'gross_margin_pct', 'order_count', 'aov', 'refund_rate'))},
              ((ifnull(net, 0) - yago) / nullif(yago, 0)) as net_revenue_yoy_pct,
              ((ifnull(orders_n::double, 0) - mago) / nullif(mago, 0)) as order_count_mom_pct,
              0.03::double as refund_rate_target, {_F['refund_rate']} <= 0.03::double as refund_rate_met
            from (select x.*, ({_NET})::double as net, y.yago, m.mago from by_month x
                  left join (select p + interval 1 year as p, ({_NET})::double as yago from by_month) y on y.p = x.p
                  left join (select p + interval 1 month as p, orders_n::double as mago from by_month) m on m.p = x.p)""",
        {"by_month": f"select * from {based('month', ('sales', 'returned'))}"},
    ),
    "rpt_revenue_trend": query(
        """select a.date_id, a.v as net_revenue_mtd, b.v as net_revenue_mtd_py
           from running a left join running b on b.date_id = a.date_id - interval 1 year""",
        {
            "spread": SPREAD,
            "running": f"""select date_id, ({_NET})::double as v from (
                select date_id, {', '.join(f'sum({c}) over (partition by year, month_number order by date_id) as {c}'
                                           for c in ('gross', 'disc', 'refunded'))} from spread)""",
        },
    ),
    "rpt_revenue_by_channel": query("""
        select channel_id, channel_name, (sum(gross_revenue) filter (where order_status <> 'cancelled')
          - sum(total_discount) - sum(total_refunds))::double as net_revenue
        from fct_orders join dim_channel using (channel_id) group by all"""),
    "rpt_top_categories": query("""
        select category, sum(gross_profit)::double as gross_profit from fct_order_items
        group by 1 order by sum(gross_profit) desc, category limit 10"""),
    "rpt_revenue_waterfall": query(
        """select 1 as step, 'gross' as stage, gross::double as amount from t
           union all select 2, 'discounts', -disc::double from t union all select 3, 'refunds', -refunded::double from t
           union all select 4, 'net', (gross - disc - refunded)::double from t""",
        {"t": f"select * from {based(None, ('sales', 'returned'))}"},
    ),
    "rpt_monthly_trend": query(
        f"select p as month, {outputs(('net_revenue', 'gross_profit', 'aov'))} from {based('month', ('sales', 'returned'))}"
    ),
    "rpt_category_margin_matrix": query(
        f"select {_pivot('category', 'any_value(m)', 'monthname', MONTH_NAMES)} from monthly group by category",
        {
            "monthly": """select category, monthname(date_id) as monthname,
                sum(gross_profit)::double / nullif(sum(revenue)::double, 0) as m from fct_order_items group by all"""
        },
    ),
    "rpt_channel_by_category": query("""
        select channel_name, category, (sum(revenue) - sum(discount))::double as net_revenue
        from fct_order_items join dim_channel using (channel_id) group by all"""),
    "rpt_top_products": query("""
        select i.product_id, any_value(product_name) as product_name, sum(quantity)::bigint as units_sold,
          (sum(revenue) - sum(discount))::double as net_revenue,
          (sum(gross_profit)::double / nullif(sum(revenue)::double, 0)) as gross_margin_pct
        from fct_order_items i left join stg_products p on p.product_id = i.product_id
        group by i.product_id order by sum(revenue) - sum(discount) desc, i.product_id limit 20"""),
    "rpt_new_and_repeat": query("""
        select (select count(distinct customer_id) from fct_orders) as new_customers,
          (select count(*) from dim_customer where is_repeat_customer) as repeat_customers"""),
    "rpt_cac_trend": query(
        f"select p as month, {outputs(('total_ad_spend', 'new_customers', 'cac'))} from {based('month', ('joiners', 'ads'))}"
    ),
    "rpt_ltv_histogram": query("""
        select value_tier, customer_segment, count(*) as customers,
          (sum(lifetime_revenue)::double / count(*)) as avg_ltv from dim_customer group by all"""),
    "rpt_roas_by_channel": query("""
        select channel, r as roas, case when r > 3 then 'green' when r >= 1 then 'yellow' when r < 1 then 'red'
          end as band from (select channel, sum(attributed_revenue)::double / nullif(sum(spend), 0)::double as r
                            from fct_ad_spend group by 1)"""),
    "rpt_campaign_table": query("""
        select channel, campaign_name, sum(spend)::double as spend,
          sum(attributed_revenue)::double as attributed_revenue,
          (sum(attributed_revenue)::double / nullif(sum(spend), 0)::double) as roas,
          (sum(clicks)::double / nullif(sum(impressions), 0)) as ctr,
          (sum(conversions)::double / nullif(sum(clicks), 0)) as cvr from fct_ad_spend group by all"""),
    "rpt_cohort_matrix": query(
        f"select {_pivot('signup_cohort', 'sum(n)', 'joined', MONTH_NAMES).replace(') as', ')::bigint as')} "
        "from counted group by 1",
        {
            "counted": """select date_trunc('month', signup_date)::date as signup_cohort,
                monthname(first_order_date) as joined, count(*) as n
                from dim_customer where first_order_date is not null group by all"""
        },
    ),
    "rpt_stock_kpis": query("""
        select count(distinct product_id) filter (where stock_status = 'out_of_stock') as out_of_stock_skus,
          count(distinct product_id) filter (where stock_status = 'low_stock') as low_stock_skus,
          sum(inventory_value)::double as total_inventory_value from fct_inventory"""),
    "rpt_stock_by_category": query("""
        select category, stock_status, count(distinct i.product_id) as skus
        from fct_inventory i left join stg_products p on p.product_id = i.product_id group by all"""),
    "rpt_on_time_gauge": query("""
        select count(*) as shipment_count, (count(*) filter (where is_on_time)::double / count(*)) as on_time_rate,
          0.95::double as target, count(*) filter (where is_on_time)::double / count(*) >= 0.95::double as met
        from fct_shipments"""),
    "rpt_value_by_warehouse": query(
        "select "
        + _pivot("category", "sum(inventory_value)", "warehouse_code", WAREHOUSE_CODES).replace(") as", ")::double as")
        + " from fct_inventory i left join stg_products p on p.product_id = i.product_id "
        "join dim_warehouse using (warehouse_id) group by category"
    ),
    "rpt_late_by_carrier": query(
        "select carrier, count(*) filter (where days_late > 0) as late_shipments from fct_shipments group by 1"
    ),
    "rpt_transit_trend": query("""
        select date_trunc('month', date_id)::date as month, (avg(transit_days)) as avg_transit_days
        from fct_shipments group by 1"""),
    "rpt_at_risk_products": query("""
        select inventory_id, product_name, closing_qty, days_of_supply, stock_status
        from fct_inventory i left join stg_products p on p.product_id = i.product_id where stock_status <> 'in_stock'"""),
    "rpt_reconciliation_waterfall": query("""
        select 1 as step, 'net_revenue' as stage, sum(net_revenue)::double as amount from fct_orders
        union all select 2, 'payments', sum(amount)::double from stg_payments where status = 'completed'
        union all select 3, 'refunds', -sum(total_refunds)::double from fct_orders
        union all select 4, 'fees', -sum(fees)::double from stg_payouts
        union all select 5, 'net_payout', sum(net_payout)::double from stg_payouts"""),
    "rpt_finance_kpis": query(
        f"select {outputs(('payment_exceptions', 'payment_warnings', 'total_payout_variance'))} "
        f"from {based(None, ('paid', 'paidout'))}"
    ),
    "rpt_exception_trend": query("""
        select date_trunc('month', date_id)::date as month,
          count(*) filter (where reconciliation_status = 'EXCEPTION') as recon_exceptions from fct_payouts group by 1"""),
    "rpt_status_by_platform": query(
        "select platform, reconciliation_status, count(*) as payouts from fct_payouts group by all"
    ),
    "rpt_payout_table": query("""
        select year_month, platform, gross_revenue::double as gross_revenue, net_payout::double as net_payout,
          payout_variance::double as payout_variance, reconciliation_status from mart_finance"""),
    "rpt_refund_anomalies": query("""
        select refund_id, order_id, amount::double as refund_amount, order_paid_amount::double as payment_amount,
          is_over_refund from fct_refunds where is_over_refund"""),
    "rpt_order_detail": query("""
        select order_id, o.customer_id, customer_segment, date_id, channel_name, order_status,
          net_revenue::double as net_revenue, gross_profit::double as gross_profit, total_amount::double as total_amount
        from fct_orders o join dim_channel using (channel_id) join stg_customers c on c.customer_id = o.customer_id
        where date_id between date '1997-01-01' and date '1998-12-31' and channel_name = 'email'
          and customer_segment = 'BUILDING'"""),
    "rpt_sliced_revenue_by_channel": query(f"""
        select channel_id, channel_name, (sum(gross_revenue) filter (where order_status <> 'cancelled')
          - sum(total_discount) - sum(total_refunds))::double as net_revenue
        from fct_orders join dim_channel using (channel_id) where {_YEARS} group by all"""),
    "rpt_sliced_channel_by_category": query(f"""
        select channel_name, category, (sum(revenue) - sum(discount))::double as net_revenue
        from fct_order_items join dim_channel using (channel_id)
        where {_YEARS} and channel_name = 'email' and category = '{CATEGORY}' group by all"""),
    "rpt_sliced_campaigns": query(f"""
        select channel, campaign_name, sum(spend)::double as spend,
          sum(attributed_revenue)::double as attributed_revenue,
          (sum(attributed_revenue)::double / nullif(sum(spend), 0)::double) as roas,
          (sum(clicks)::double / nullif(sum(impressions), 0)) as ctr,
          (sum(conversions)::double / nullif(sum(clicks), 0)) as cvr
        from fct_ad_spend where {_YEARS} and campaign_name = 'Campaign 3' and channel_id = 2 group by all"""),
    "rpt_sliced_late_by_carrier": query(f"""
        select carrier, count(*) filter (where days_late > 0) as late_shipments from fct_shipments
        where {_YEARS} and warehouse_id = 2 and carrier = 'UPS' group by 1"""),
    "rpt_sliced_status_by_platform": query(f"""
        select platform, reconciliation_status, count(*) as payouts from fct_payouts
        where {_YEARS} and platform = 'direct' and reconciliation_status = 'EXCEPTION' group by all"""),
}
