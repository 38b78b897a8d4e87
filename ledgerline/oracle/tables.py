"""The raw feeds and models restated in DuckDB SQL, for comparing results.

Each entry is the body of one common table expression. Money is exact decimal in here, as in the jobs;
:func:`ledgerline.oracle.build.table_query` turns it into doubles for the output.
"""

from __future__ import annotations

# The names of channels and warehouses, in the order of their ids.
CHANNEL_CASE = (
    "case {k}%7+1 when 1 then 'organic_search' when 2 then 'paid_search' when 3 then 'social_media' "
    "when 4 then 'email' when 5 then 'direct' when 6 then 'affiliate' else 'referral' end"
)
WAREHOUSE_CASE = (
    "case {k} when 1 then 'WH-EAST' when 2 then 'WH-WEST' when 3 then 'WH-CENTRAL' when 4 then 'WH-SOUTH' "
    "else 'WH-NORTH' end"
)

RAW = {
    "batches": "select 1 as _batch_id union all select 2",
    "copies": "select 0 as copy union all select 1",
    "raw_customers": f"""
        select c_custkey as customer_id, concat(' ', substr(c_name,1,8), ' ') as first_name,
          concat(substr(c_name,10), ' ') as last_name,
          case when c_custkey%100=3 then null
               else concat(' User', cast(c_custkey as string), '@Example.COM ') end as email,
          date '1995-01-01' + cast(c_custkey%365 as int) as signup_date, concat(' ', lower(n_name)) as country,
          lower(r_name) as state, concat(n_name,' ') as city, c_mktsegment as customer_segment,
          {CHANNEL_CASE.format(k='c_custkey')} as acquisition_channel, _batch_id
        from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey
          cross join batches where _batch_id=1 or c_custkey%50=11""",
    "raw_products": """
        select p_partkey as product_id,
          case when p_partkey%150=7 then null else concat('SKU-',cast(p_partkey as string)) end as sku,
          concat(' ',p_name) as product_name, p_type as category, p_brand as subcategory, p_brand as brand,
          cast(cast(p_retailprice as decimal(18,2))
               *cast(case when p_partkey%200=9 then 1.1 else 0.6 end as decimal(4,2)) as decimal(18,2)) as unit_cost,
          cast(p_retailprice as decimal(18,2)) as list_price,
          concat('SUP-',cast(p_size as string)) as supplier, 1 as _batch_id
        from part""",
    "raw_orders": f"""
        select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as date) as order_date,
          cast(o_orderkey%7+1 as int) as channel_id, {CHANNEL_CASE.format(k='o_orderkey')} as channel,
          case when o_orderkey%125=0 then 'UNKNOWN_STATUS' when o_orderstatus='F' and o_orderkey%10=3 then 'refunded'
               when o_orderstatus='F' then 'Completed' when o_orderstatus='O' and o_orderkey%8=1 then 'cancelled'
               when o_orderstatus='O' then 'PROCESSING' else 'shipped' end as order_status,
          cast(o_totalprice as decimal(18,2))-cast(o_orderkey%20 as decimal(18,2))-cast(o_orderkey%9 as decimal(18,2))
            +cast(case when o_orderkey%6=1 then o_orderkey%5 else 0 end as decimal(18,2)) as subtotal,
          cast(case when o_orderkey%6=1 then o_orderkey%5 else 0 end as decimal(18,2)) as discount,
          cast(o_orderkey%9 as decimal(18,2)) as tax,
          cast(o_orderkey%20 as decimal(18,2)) as shipping, cast(o_totalprice as decimal(18,2)) as total_amount,
          _batch_id
        from orders cross join batches where _batch_id=1 or o_orderkey%100=7""",
    "raw_order_items": """
        select concat_ws('-',l_orderkey,l_linenumber,l_partkey,l_suppkey) as order_item_id,
          case when (l_orderkey*7+l_partkey)%300=5 then -1 else l_orderkey end as order_id, l_partkey as product_id,
          cast(l_quantity as int) as quantity, cast(p_retailprice as decimal(18,2)) as unit_price,
          cast(cast(l_extendedprice as decimal(18,2))*cast(l_discount as decimal(4,2)) as decimal(18,2)) as discount,
          cast(cast(l_extendedprice as decimal(18,2))*cast(0.6 as decimal(4,2)) as decimal(18,2)) as cost,
          cast(l_extendedprice as decimal(18,2))
            -cast(cast(l_extendedprice as decimal(18,2))*cast(l_discount as decimal(4,2)) as decimal(18,2)) as revenue,
          cast(l_extendedprice as decimal(18,2))
            -cast(cast(l_extendedprice as decimal(18,2))*cast(l_discount as decimal(4,2)) as decimal(18,2))
            -cast(cast(l_extendedprice as decimal(18,2))*cast(0.6 as decimal(4,2)) as decimal(18,2)) as gross_profit,
          cast(l_shipdate as date)+(_batch_id-1) as _ingested_at, _batch_id
        from lineitem join part on l_partkey=p_partkey cross join batches where _batch_id=1 or l_orderkey%90=4""",
    "raw_payments": """
        select if(copy=1,-o_orderkey,o_orderkey) as payment_id, case when o_orderkey%250=9 then -1 else o_orderkey end as order_id,
          cast(o_orderdate as date) as payment_date, o_orderpriority as payment_method,
          case when o_orderkey%50=0 then 'failed' else 'Completed' end as status,
          case when o_orderkey%50=11 then cast(o_totalprice as decimal(18,2))-50
               when o_orderkey%67=5
               then cast(cast(o_totalprice as decimal(18,2))*cast(0.9 as decimal(4,2)) as decimal(18,2))
               else cast(o_totalprice as decimal(18,2)) end as amount, _batch_id
        from orders cross join copies cross join batches
        where (copy=0 or o_orderkey%120=17) and (_batch_id=1 or o_orderkey%250=13)""",
    "raw_refunds": """
        select if(copy=1,-o_orderkey,o_orderkey) as refund_id, case when o_orderkey%290=0 then -1 else o_orderkey end as order_id,
          cast(o_orderdate as date)+cast(o_orderkey%14+1 as int) as refund_date,
          cast(cast(o_totalprice as decimal(18,2))
               *cast(case when o_orderkey%29=0 then 1.5 else 0.25 end as decimal(4,2)) as decimal(18,2)) as amount,
          case o_orderkey%5 when 0 then 'damaged' when 1 then 'not_as_described' when 2 then 'wrong_item'
               when 3 then 'changed_mind' else 'defective' end as reason,
          case when o_orderkey%40=3 then 'pending' else 'completed' end as status, 1 as _batch_id
        from orders cross join copies
        where ((o_orderstatus='F' and o_orderkey%10=3) or o_orderkey%23=0 or o_orderkey%29=0)
          and (copy=0 or o_orderkey%46=0)""",
    "raw_shipments": f"""
        select order_id as shipment_id, case when o.order_id%350=2 then -o.order_id else o.order_id end as order_id,
          cast(o.order_id%5+1 as int) as warehouse_id,
          {WAREHOUSE_CASE.format(k='o.order_id%5+1')} as warehouse,
          case o.order_id%3 when 0 then 'UPS' when 1 then 'FedEx' else 'USPS' end as carrier,
          order_date+cast(o.order_id%3+1 as int) as shipped_date,
          order_date+cast(o.order_id%3+1+o.order_id%8+2 as int) as estimated_delivery_date,
          case when o.order_id%40=0 then null
               else order_date+cast(o.order_id%3+1+o.order_id%11 as int) end as delivered_date,
          case when o.order_id%40=0 then 'in_transit' when o.order_id%333=1 then 'misplaced'
               else 'Delivered' end as shipment_status, 1 as _batch_id
        from raw_orders o where _batch_id=1 and lower(order_status) in ('completed','shipped','refunded')""",
    "inv_base": """
        select l_partkey, l_suppkey%5+1 as wh, cast(date_trunc('month', l_shipdate) as date) as dt,
          cast(sum(cast(l_quantity as int)) as int) as sold
        from lineitem group by 1,2,3""",
    "raw_inventory": f"""
        select concat(cast(l_partkey as string),'-',cast(wh as string),'-',cast(dt as string)) as inventory_id,
          dt as date, l_partkey as product_id, cast(wh as int) as warehouse_id,
          {WAREHOUSE_CASE.format(k='wh')} as warehouse,
          cast((l_partkey*37+month(dt)*11)%120 as int) as opening_qty,
          cast((l_partkey*13+wh)%40 as int) as received_qty, sold as sold_qty,
          cast((l_partkey+wh)%21-10 as int) as adjustment_qty,
          cast((l_partkey*37+month(dt)*11)%120+(l_partkey*13+wh)%40-sold+(l_partkey+wh)%21-10 as int) as closing_qty,
          unit_cost,
          cast(greatest((l_partkey*37+month(dt)*11)%120+(l_partkey*13+wh)%40-sold+(l_partkey+wh)%21-10,0)*unit_cost
               as decimal(18,2)) as inventory_value, 1 as _batch_id
        from inv_base join raw_products on l_partkey=product_id""",
    "raw_ad_spend": """
        select event_id as ad_record_id, date '1995-01-01'+cast(event_id%2400 as int) as date, cast(user_id%12+1 as int) as campaign_id,
          concat('Campaign ',cast(user_id%12+1 as string)) as campaign_name,
          case when user_id%12<6 then 2 else 3 end as channel_id,
          case when user_id%12<6 then 'paid_search' else 'social_media' end as channel,
          cast(event_id%5000+500 as int) as impressions,
          cast(case when event_id%500=17 then 6000 else event_id%97 end as int) as clicks,
          cast(event_id%97%11 as int) as conversions,
          case when event_id%333=0 then cast(0 as decimal(18,2)) else cast(value as decimal(18,2)) end as spend,
          cast(cast(value as decimal(18,2))*cast(event_id%6 as decimal(4,0)) as decimal(18,2)) as attributed_revenue,
          _batch_id
        from events cross join batches""",
    "pay_base": """
        select cast(date_trunc('month',order_date) as date) as ps, last_day(order_date) as pe, sum(total_amount) as g
        from raw_orders where _batch_id=1 and lower(order_status)='completed' group by 1,2""",
    "platforms": """
        select 1 as n, 'direct' as platform, cast(0.50 as decimal(4,2)) as share
        union all select 2, 'marketplace_a', cast(0.30 as decimal(4,2))
        union all select 3, 'marketplace_b', cast(0.20 as decimal(4,2))""",
    "raw_payouts": """
        select concat(cast(ps as string),'-',platform) as payout_id, pe+10 as payout_date, platform,
          ps as period_start, pe as period_end, cast(g*share as decimal(18,2)) as gross_sales,
          cast(g*share*cast(0.03 as decimal(4,2)) as decimal(18,2)) as fees,
          cast(g*share*cast(0.02 as decimal(4,2)) as decimal(18,2)) as refunds, cast(n as decimal(18,2)) as adjustments,
          cast(g*share*cast(0.95 as decimal(4,2)) as decimal(18,2)) as net_payout, 1 as _batch_id
        from pay_base cross join platforms""",
}


def _meta(entity: str) -> str:
    return (
        "strftime(date '2024-01-01' + _batch_id, '%Y-%m-%d %H:%M:%S') as _ingested_at, "
        f"'mock/{entity}' as _source, _batch_id"
    )


def _first(key: str, table: str, order: str = "_batch_id desc") -> str:
    return (
        f"(select * from {table} where {key} is not null "
        f"qualify row_number() over (partition by {key} order by {order}) = 1)"
    )


# Fixed values below: the states that staging lets through.
STAGING = {
    "stg_customers": f"""
        select customer_id, trim(first_name) as first_name, trim(last_name) as last_name, lower(trim(email)) as email,
          signup_date, upper(trim(country)) as country, upper(trim(state)) as state, trim(city) as city,
          customer_segment, acquisition_channel, {_meta('customers')}
        from {_first('customer_id', 'raw_customers')} where email is not null""",
    "stg_products": f"""
        select product_id, sku, trim(product_name) as product_name, category, subcategory, brand, unit_cost,
          list_price, supplier, {_meta('products')}
        from raw_products where sku is not null and 0 < unit_cost and unit_cost < list_price""",
    "stg_orders": f"""
        select order_id, customer_id, order_date, channel_id, channel,
          case when lower(order_status) in ('completed', 'processing', 'shipped', 'refunded', 'cancelled')
               then lower(order_status) else 'unknown' end as order_status,
          subtotal, discount, tax, shipping, total_amount, {_meta('orders')}
        from {_first('order_id', 'raw_orders')} where total_amount >= 0""",
    "stg_order_items": f"""
        select order_item_id, order_id, product_id, quantity, unit_price, discount, cost, revenue, gross_profit,
          strftime(_ingested_at, '%Y-%m-%d %H:%M:%S') as _ingested_at, 'mock/order_items' as _source, _batch_id
        from {_first('order_item_id', 'raw_order_items', '_ingested_at desc')} i
        where quantity > 0 and unit_price > 0 and exists (from stg_orders o where o.order_id = i.order_id)""",
    "stg_payments": f"""
        select payment_id, order_id, payment_date, payment_method,
          case when lower(status) in ('completed', 'failed', 'pending', 'refunded') then lower(status)
               else 'unknown' end as status, amount, {_meta('payments')}
        from {_first('payment_id', 'raw_payments')} where amount > 0""",
    "stg_refunds": f"""
        select refund_id, order_id, refund_date, amount, reason,
          case when lower(status) in ('completed', 'pending', 'failed') then lower(status)
               else 'unknown' end as status, {_meta('refunds')}
        from {_first('refund_id', 'raw_refunds')} where amount > 0""",
    "stg_shipments": f"""
        select shipment_id, order_id, warehouse_id, warehouse, carrier, shipped_date, estimated_delivery_date,
          delivered_date,
          case when lower(shipment_status) in ('delivered', 'delivered_late', 'in_transit', 'lost', 'returned')
               then lower(shipment_status) else 'unknown' end as shipment_status,
          ifnull(delivered_date <= estimated_delivery_date, false) as is_on_time, {_meta('shipments')}
        from raw_shipments""",
    "stg_inventory": f"""
        select inventory_id, date, product_id, warehouse_id, warehouse, opening_qty, received_qty, sold_qty,
          adjustment_qty, greatest(closing_qty, 0) as closing_qty, unit_cost, inventory_value, {_meta('inventory')}
        from raw_inventory""",
    "stg_ad_spend": f"""
        select ad_record_id, date, campaign_id, campaign_name, channel_id, channel, impressions, clicks, conversions,
          spend, attributed_revenue,
          case when spend > 0 then attributed_revenue::double / spend::double end as roas,
          case when impressions > 0 then clicks::double / impressions end as ctr, {_meta('advertising')}
        from {_first('ad_record_id', 'raw_ad_spend')}
        where spend >= 0 and impressions >= 0 and clicks <= impressions""",
    "stg_payouts": f"""
        select payout_id, payout_date, platform, period_start, period_end, gross_sales, fees, refunds, adjustments,
          net_payout, {_meta('payouts')}
        from raw_payouts""",
}

SALE = "order_status not in ('cancelled', 'unknown')"

INTERMEDIATE = {
    "item_sums": """
        select order_id, sum(revenue) as gross_revenue, sum(discount) as total_discount, sum(cost) as total_cost,
          count(*) as item_count, sum(quantity)::bigint as unit_count
        from stg_order_items group by order_id""",
    "refund_sums": """
        select order_id, sum(amount) as total_refunds, count(*) as refund_count
        from stg_refunds where status = 'completed' group by order_id""",
    "payment_sums": """
        select order_id, sum(amount) filter (where status = 'completed') as paid_amount, count(*) as payment_count
        from stg_payments group by order_id""",
    "int_order_revenue": """
        select order_id, customer_id, order_date, channel_id, channel, order_status,
          ifnull(gross_revenue, 0) as gross_revenue, ifnull(total_discount, 0) as total_discount,
          ifnull(total_refunds, 0) as total_refunds,
          ifnull(gross_revenue, 0) - ifnull(total_discount, 0) - ifnull(total_refunds, 0) as net_revenue,
          ifnull(total_cost, 0) as total_cost,
          ifnull(gross_revenue, 0) - ifnull(total_discount, 0) - ifnull(total_refunds, 0)
            - ifnull(total_cost, 0) as gross_profit,
          ifnull(item_count, 0) as item_count, ifnull(unit_count, 0) as unit_count,
          ifnull(refund_count, 0) as refund_count, subtotal, discount as order_discount, tax, shipping, total_amount
        from stg_orders left join item_sums using (order_id) left join refund_sums using (order_id)""",
    "int_customer_orders": f"""
        select c.customer_id, any_value(c.customer_segment) as customer_segment,
          any_value(c.acquisition_channel) as acquisition_channel, any_value(c.signup_date) as signup_date,
          any_value(c.country) as country, any_value(c.state) as state, count(distinct o.order_id) as order_count,
          min(o.order_date) as first_order_date, max(o.order_date) as last_order_date,
          sum(o.net_revenue) as lifetime_revenue, sum(o.gross_profit) as lifetime_gross_profit,
          sum(o.total_refunds) as lifetime_refunds,
          sum(o.net_revenue)::double / nullif(count(o.order_id), 0) as avg_order_value,
          count(distinct o.order_id) > 1 as is_repeat_customer,
          case when count(distinct o.order_id) > 1 then max(o.order_date) - min(o.order_date) else 0 end::int
            as active_days
        from stg_customers c
        left join (from int_order_revenue where {SALE}) o on o.customer_id = c.customer_id
        group by c.customer_id""",
    "int_product_sales": f"""
        select product_id, count(distinct order_id) as order_count, sum(quantity)::bigint as units_sold,
          sum(i.revenue) as gross_revenue, sum(i.discount) as total_discounts, sum(cost) as total_cost,
          sum(gross_profit) as total_gross_profit, sum(unit_price)::double / count(*) as avg_selling_price,
          case when sum(i.revenue) > 0 then sum(gross_profit)::double / sum(i.revenue)::double end as gross_margin_pct,
          min(order_date) as first_sold_date, max(order_date) as last_sold_date
        from stg_order_items i join stg_orders o using (order_id) where {SALE} group by product_id""",
    "int_payment_reconciliation": """
        select order_id, total_amount as order_total, ifnull(paid_amount, 0) as paid_amount,
          ifnull(total_refunds, 0) as refund_amount, ifnull(payment_count, 0) as payment_count,
          total_amount - ifnull(paid_amount, 0) as payment_variance,
          case when abs(total_amount - ifnull(paid_amount, 0)) <= 1 then 'MATCHED'
               when abs(total_amount - ifnull(paid_amount, 0)) <= 100 then 'WARNING'
               else 'EXCEPTION' end as reconciliation_status,
          ifnull(total_refunds, 0) > ifnull(paid_amount, 0) as has_over_refund,
          ifnull(payment_count, 0) > 1 as has_duplicate_payment
        from stg_orders left join payment_sums using (order_id) left join refund_sums using (order_id)""",
    "int_campaign_performance": """
        select campaign_id, campaign_name, channel_id, channel, date_trunc('month', date)::date as year_month,
          sum(impressions)::bigint as total_impressions, sum(clicks)::bigint as total_clicks,
          sum(conversions)::bigint as total_conversions, sum(spend) as total_spend,
          sum(attributed_revenue) as total_attributed_revenue,
          case when sum(spend) > 0 then sum(attributed_revenue)::double / sum(spend)::double end as roas,
          case when sum(impressions) > 0 then sum(clicks)::double / sum(impressions)::double end as avg_ctr,
          case when sum(clicks) > 0 then sum(conversions)::double / sum(clicks)::double end as avg_cvr,
          case when sum(conversions) > 0 then sum(spend)::double / sum(conversions)::double end as cost_per_conversion
        from stg_ad_spend group by all""",
    "int_inventory_movements": """
        select product_id, warehouse_id, warehouse, date as snapshot_date, closing_qty as available_qty, unit_cost,
          inventory_value, if(closing_qty = 0, 'out_of_stock', if(closing_qty < 10, 'low_stock', 'in_stock'))
            as stock_status
        from stg_inventory
        qualify date = max(date) over (partition by product_id, warehouse_id)""",
}

MARTS = {
    "dim_date": """
        select d as date_id, d as full_date, year(d)::int as year, quarter(d)::int as quarter_number,
          month(d)::int as month_number, weekofyear(d)::int as week_of_year, day(d)::int as day_of_month,
          dayofweek(d)::int as day_of_week, 'Q' || quarter(d) as quarter_label, monthname(d) as month_name,
          monthname(d)[:3] as month_abbr, dayname(d) as day_name, dayofweek(d) in (0, 6) as is_weekend,
          year(d)::int as fiscal_year, quarter(d)::int as fiscal_quarter
        from (select unnest(range(date '1995-01-01', date '2025-01-01', interval 1 day))::date as d)""",
    "dim_channel": """
        from (values (1, 'organic_search', 'Organic', 'Search'), (2, 'paid_search', 'Paid', 'Search'),
          (3, 'social_media', 'Paid', 'Social'), (4, 'email', 'Owned', 'Email'), (5, 'direct', 'Organic', 'Direct'),
          (6, 'affiliate', 'Paid', 'Affiliate'), (7, 'referral', 'Organic', 'Referral'))
          t(channel_id, channel_name, channel_type, channel_group)""",
    "dim_warehouse": """
        from (values (1, 'WH-EAST', 'East', 'New York', 'NY'), (2, 'WH-WEST', 'West', 'Los Angeles', 'CA'),
          (3, 'WH-CENTRAL', 'Central', 'Chicago', 'IL'), (4, 'WH-SOUTH', 'South', 'Dallas', 'TX'),
          (5, 'WH-NORTH', 'North', 'Minneapolis', 'MN')) t(warehouse_id, warehouse_code, region, city, state)""",
    "dim_customer": """
        select c.customer_id, c.first_name, c.last_name, c.first_name || ' ' || c.last_name as full_name, c.email,
          c.signup_date, c.country, c.state, c.city, c.customer_segment, c.acquisition_channel, s.order_count,
          s.first_order_date, s.last_order_date, ifnull(s.lifetime_revenue, 0) as lifetime_revenue,
          ifnull(s.lifetime_gross_profit, 0) as lifetime_gross_profit,
          ifnull(s.avg_order_value, 0) as avg_order_value, s.is_repeat_customer,
          if(ifnull(s.lifetime_revenue, 0) < 300, 'Low', if(s.lifetime_revenue < 1000, 'Medium', 'High')) as value_tier
        from stg_customers c join int_customer_orders s using (customer_id)""",
    "dim_product": """
        select p.product_id, sku, product_name, category, subcategory, brand, supplier, unit_cost, list_price,
          list_price - unit_cost as standard_margin,
          (list_price - unit_cost)::double / list_price::double as standard_margin_pct,
          ifnull(units_sold, 0) as units_sold, ifnull(gross_revenue, 0) as gross_revenue,
          ifnull(total_gross_profit, 0) as total_gross_profit, ifnull(gross_margin_pct, 0) as realised_margin_pct,
          category || ' > ' || subcategory as category_path
        from stg_products p left join int_product_sales using (product_id)""",
    "fct_orders": """
        select order_id, customer_id, order_date as date_id, channel_id, order_status, gross_revenue, total_discount,
          total_refunds, net_revenue, total_cost, gross_profit,
          case when net_revenue > 0 then gross_profit::double / net_revenue::double end as gross_margin_pct,
          item_count, unit_count, refund_count, subtotal, order_discount, tax, shipping, total_amount,
          order_status = 'refunded' or refund_count > 0 as has_refund, refund_count > 1 as has_multiple_refunds
        from int_order_revenue""",
    "fct_order_items": """
        select order_item_id, i.order_id, i.product_id, o.customer_id, o.order_date as date_id, o.channel_id,
          p.category, p.subcategory, p.brand, i.quantity, i.unit_price, i.discount, i.cost, i.revenue, i.gross_profit,
          case when i.revenue > 0 then i.gross_profit::double / i.revenue::double end as item_margin_pct,
          case when i.quantity > 0 then i.revenue::double / i.quantity end as effective_unit_price
        from stg_order_items i join stg_orders o using (order_id) left join stg_products p using (product_id)""",
    "fct_payments": """
        select payment_id, p.order_id, payment_date as date_id, payment_method, status, amount,
          ifnull(reconciliation_status, 'UNKNOWN') as reconciliation_status,
          ifnull(payment_variance, 0) as payment_variance, ifnull(has_duplicate_payment, false) as is_duplicate
        from stg_payments p left join int_payment_reconciliation using (order_id)""",
    "fct_refunds": """
        select refund_id, r.order_id, o.customer_id, o.channel_id, refund_date as date_id, reason, status, amount,
          ifnull(paid_amount, 0) as order_paid_amount, amount > ifnull(paid_amount, 0) as is_over_refund
        from stg_refunds r left join (select order_id, customer_id, channel_id from stg_orders) o using (order_id)
          left join payment_sums using (order_id)""",
    "fct_inventory": """
        select inventory_id, date as date_id, product_id, warehouse_id, opening_qty, received_qty, sold_qty,
          adjustment_qty, closing_qty, unit_cost, inventory_value,
          if(closing_qty = 0, 'out_of_stock', if(closing_qty < 10, 'low_stock', 'in_stock')) as stock_status,
          case when sold_qty > 0 then closing_qty::double / (sold_qty::double / 30) end as days_of_supply
        from stg_inventory""",
    "fct_shipments": """
        select shipment_id, order_id, warehouse_id, shipped_date as date_id, carrier, shipment_status, is_on_time,
          estimated_delivery_date, delivered_date, (delivered_date - shipped_date)::int as transit_days,
          (delivered_date - estimated_delivery_date)::int as days_late
        from stg_shipments""",
    "fct_ad_spend": """
        select ad_record_id, date as date_id, campaign_id, campaign_name, channel_id, channel, impressions, clicks,
          conversions, spend, attributed_revenue, roas, ctr
        from stg_ad_spend""",
    "sales_by_month": f"""
        select date_trunc('month', order_date)::date as m, sum(net_revenue) as net, sum(total_refunds) as refunded,
          sum(gross_revenue) as gross, sum(total_discount) as discounts, count(*) as n
        from int_order_revenue where {SALE} group by 1""",
    "fct_payouts": """
        select *, case when abs(payout_variance) <= 1 then 'MATCHED' when abs(payout_variance) <= 100 then 'WARNING'
                       else 'EXCEPTION' end as reconciliation_status
        from (select payout_id, payout_date as date_id, platform, period_start, period_end, gross_sales, fees, refunds,
                adjustments, net_payout, ifnull(net, 0) as period_gross_revenue, ifnull(refunded, 0) as period_refunds,
                net_payout - ifnull(net, 0) + fees + ifnull(refunded, 0) as payout_variance
              from stg_payouts left join sales_by_month on date_trunc('month', period_start) = m)""",
    "mart_sales": f"""
        select date_trunc('month', date_id)::date as year_month, channel_id, channel_name, channel_type, channel_group,
          count(distinct order_id) as order_count, sum(gross_revenue) as gross_revenue,
          sum(total_discount) as total_discounts, sum(total_refunds) as total_refunds, sum(net_revenue) as net_revenue,
          sum(total_cost) as total_cost, sum(gross_profit) as gross_profit,
          case when sum(net_revenue) > 0 then sum(gross_profit)::double / sum(net_revenue)::double end
            as gross_margin_pct,
          sum(net_revenue)::double / count(distinct order_id) as aov, sum(unit_count)::bigint as units_sold,
          count(*) filter (where has_refund) as refund_order_count
        from fct_orders left join dim_channel using (channel_id) where {SALE} group by all""",
    "mart_customer": """
        select * exclude (first_name, last_name), date_trunc('month', signup_date)::date as signup_cohort,
          (date '2001-08-31' - last_order_date)::int as days_since_last_order,
          case when last_order_date >= date '2001-06-01' then 'Active'
               when last_order_date >= date '2000-09-01' then 'Lapsing' else 'Churned' end as recency_status
        from dim_customer""",
    "new_by_month": """
        select date_trunc('month', first_order_date)::date as m, lower(acquisition_channel) as ch, count(*) as n
        from int_customer_orders where first_order_date is not null group by all""",
    "mart_marketing": """
        select p.*, case when n > 0 then total_spend::double / n end as approx_cac
        from int_campaign_performance p left join new_by_month on m = year_month and ch = lower(channel)""",
    "mart_inventory": """
        select i.product_id, product_name, category, subcategory, brand, i.warehouse_id, warehouse_code, region,
          snapshot_date, available_qty, i.unit_cost, i.inventory_value, i.stock_status
        from int_inventory_movements i left join stg_products using (product_id)
          left join dim_warehouse using (warehouse_id)""",
    "payments_by_month": """
        select date_trunc('month', date_id)::date as m, sum(amount) as collected,
          count(*) filter (where status = 'failed') as failed, count(*) as n
        from fct_payments group by 1""",
    "mart_finance": """
        select period_start as year_month, platform, ifnull(r.gross, 0) as gross_revenue,
          ifnull(r.discounts, 0) as total_discounts, ifnull(r.refunded, 0) as total_refunds,
          ifnull(r.net, 0) as net_revenue, ifnull(r.n, 0) as order_count, ifnull(collected, 0) as total_collected,
          ifnull(failed, 0) as failed_payments, ifnull(y.n, 0) as payment_count, gross_sales, fees,
          refunds as payout_refunds, adjustments, net_payout, payout_variance, reconciliation_status,
          ifnull(r.net, 0) - ifnull(collected, 0) as revenue_payment_gap
        from fct_payouts p left join sales_by_month r on r.m = period_start
          left join payments_by_month y on y.m = period_start""",
}

CTES = {**RAW, **STAGING, **INTERMEDIATE, **MARTS}

# Money columns per table, which become doubles in the output; ratios are doubles already.
_ORDER_MONEY = (
    "gross_revenue total_discount total_refunds net_revenue total_cost gross_profit subtotal order_discount tax "
    "shipping total_amount"
)
OUTPUT = {
    "stg_customers": "",
    "stg_products": "unit_cost list_price",
    "stg_orders": "subtotal discount tax shipping total_amount",
    "stg_order_items": "unit_price discount cost revenue gross_profit",
    "stg_payments": "amount",
    "stg_refunds": "amount",
    "stg_shipments": "",
    "stg_inventory": "unit_cost inventory_value",
    "stg_ad_spend": "spend attributed_revenue",
    "stg_payouts": "gross_sales fees refunds adjustments net_payout",
    "int_order_revenue": _ORDER_MONEY,
    "int_customer_orders": "lifetime_revenue lifetime_gross_profit lifetime_refunds",
    "int_product_sales": "gross_revenue total_discounts total_cost total_gross_profit",
    "int_payment_reconciliation": "order_total paid_amount refund_amount payment_variance",
    "int_campaign_performance": "total_spend total_attributed_revenue",
    "int_inventory_movements": "unit_cost inventory_value",
    "dim_customer": "lifetime_revenue lifetime_gross_profit",
    "dim_product": "unit_cost list_price standard_margin gross_revenue total_gross_profit",
    "fct_orders": _ORDER_MONEY,
    "fct_order_items": "unit_price discount cost revenue gross_profit",
    "fct_payments": "amount payment_variance",
    "fct_refunds": "amount order_paid_amount",
    "fct_inventory": "unit_cost inventory_value",
    "fct_shipments": "",
    "fct_ad_spend": "spend attributed_revenue",
    "fct_payouts": "gross_sales fees refunds adjustments net_payout period_gross_revenue period_refunds payout_variance",
    "mart_sales": "gross_revenue total_discounts total_refunds net_revenue total_cost gross_profit",
    "mart_customer": "lifetime_revenue lifetime_gross_profit",
    "mart_marketing": "total_spend total_attributed_revenue",
    "mart_inventory": "unit_cost inventory_value",
    "mart_finance": (
        "gross_revenue total_discounts total_refunds net_revenue total_collected gross_sales fees payout_refunds "
        "adjustments net_payout payout_variance revenue_payment_gap"
    ),
}
