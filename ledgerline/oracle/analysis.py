"""Comparison SQL for the analyses, validation reports and canned questions."""

from __future__ import annotations

from ledgerline.oracle.build import query, table_query
from ledgerline.oracle.tables import SALE
from ledgerline.plans.warehouse import LAYERS

SQL = {
    "an_customer_ltv_segments": query("""
        select customer_segment, value_tier, date_trunc('month', signup_date)::date as signup_cohort,
          count(*) as customer_count, round(sum(lifetime_revenue)::double / count(*), 2) as avg_ltv,
          round(avg(order_count), 1) as avg_orders, count(*) filter (where is_repeat_customer) as repeat_customers,
          round(count(*) filter (where is_repeat_customer)::double / count(*) * 100, 1) as repeat_rate_pct
        from dim_customer where lifetime_revenue > 0 group by all"""),
    "an_inventory_risk": query("""
        select inventory_id, p.category, p.subcategory, p.product_name, p.sku, w.warehouse_code as warehouse,
          i.closing_qty, i.stock_status, round(days_of_supply, 1) as days_of_supply,
          inventory_value::double as inventory_value
        from fct_inventory i join stg_products p using (product_id) join dim_warehouse w using (warehouse_id)
        where stock_status <> 'in_stock'"""),
    "an_marketing_roas": query("""
        select year, month_name, channel, campaign_name, sum(spend)::double as total_spend,
          sum(attributed_revenue)::double as attributed_revenue,
          round(sum(attributed_revenue)::double / nullif(sum(spend), 0)::double, 2) as roas,
          sum(impressions)::bigint as impressions, sum(clicks)::bigint as clicks,
          sum(conversions)::bigint as conversions,
          round(sum(clicks)::double / nullif(sum(impressions), 0) * 100, 2) as ctr_pct,
          round(sum(spend)::double / nullif(sum(conversions), 0), 2) as cost_per_conversion
        from fct_ad_spend join dim_date using (date_id) group by year, month_name, channel, campaign_name"""),
    "an_payment_reconciliation": query("""
        select payment_id, p.order_id, p.date_id as payment_date, amount::double as payment_amount,
          net_revenue::double as order_net_revenue, abs(amount - net_revenue)::double as variance,
          reconciliation_status, payment_method
        from fct_payments p join fct_orders o using (order_id) join dim_date d on d.date_id = p.date_id
        where reconciliation_status in ('EXCEPTION', 'WARNING')"""),
    "an_refund_analysis": query("""
        select year, month_name, count(*) as refund_count, sum(amount)::double as total_refunds,
          sum(gross_revenue)::double as gross_revenue,
          round(sum(amount)::double / nullif(sum(gross_revenue), 0)::double * 100, 2) as refund_rate_pct,
          count(*) filter (where is_over_refund) as over_refund_count
        from fct_refunds r join fct_orders o using (order_id) join dim_date d on d.date_id = r.date_id
        group by year, month_name"""),
    "an_revenue_by_channel": query("""
        select year, month_name, channel_name, count(distinct order_id) as order_count,
          sum(gross_revenue)::double as gross_revenue, sum(total_discount)::double as total_discounts,
          sum(total_refunds)::double as total_refunds, sum(net_revenue)::double as net_revenue,
          sum(gross_profit)::double as gross_profit, round(sum(net_revenue)::double / count(*), 2) as aov,
          round(sum(gross_profit)::double / nullif(sum(net_revenue), 0)::double * 100, 1) as gross_margin_pct
        from fct_orders join dim_date using (date_id) join dim_channel using (channel_id)
        group by year, month_name, channel_name"""),
    "val_financial_integrity": query("""
        select 'over_refunds' as check_name, count(*) as failed_records from fct_refunds where is_over_refund
        union all select 'negative_net_revenue', count(*) from fct_orders where net_revenue < 0
        union all select 'payment_exceptions', count(*) from fct_payments where reconciliation_status = 'EXCEPTION'
        union all select 'payout_exceptions', count(*) from fct_payouts where reconciliation_status = 'EXCEPTION'
        union all select 'large_negative_profit', count(*) from fct_orders where gross_profit < -1000"""),
    "val_orphan_records": query(" union all ".join(
        f"select 'orphan_{t}' as check_name, count(*) as failed_records from fct_{t} c "
        f"where not exists (from fct_orders o where o.order_id = c.order_id)"
        for t in ("order_items", "payments", "refunds", "shipments"))),
    "val_row_counts": query(" union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}" for t in LAYERS["marts"])),
    "ask_monthly_revenue": query(f"""
        select date_trunc('month', date_id)::date as month, sum(net_revenue)::double as net_revenue,
          sum(gross_profit)::double as gross_profit from fct_orders where {SALE} group by 1"""),
    "ask_refunds_by_reason": query("""
        select reason, count(*) as refund_count, sum(amount)::double as total_amount from stg_refunds group by 1"""),
    "ask_top_products_by_margin": query("""
        select product_id, product_name, category, realised_margin_pct
        from dim_product order by dim_product.realised_margin_pct desc, product_id limit 20"""),
    "ask_campaigns_by_roas": query("""
        select year_month, campaign_name, channel, total_spend::double as total_spend,
          total_attributed_revenue::double as total_attributed_revenue, roas from mart_marketing"""),
    "ask_order_sample": table_query("fct_orders") + " order by order_id limit 10",
    "dim_channel": query("""
        select d.*, n as orders
        from dim_channel d left join (select channel_id, count(*) as n from fct_orders group by 1) using (channel_id)"""),
    "dim_warehouse": query("""
        select d.*, n as shipments from dim_warehouse d
        left join (select warehouse_id, count(*) as n from fct_shipments group by 1) using (warehouse_id)"""),
    "dim_date": query("""
        select d.*, n as orders
        from dim_date d left join (select order_date, count(*) as n from stg_orders group by 1) on order_date = date_id"""),
}
# The same numbers, whether they are counted in the plans or read from the footers of written tables.
SQL["val_written_counts"] = SQL["val_row_counts"]
