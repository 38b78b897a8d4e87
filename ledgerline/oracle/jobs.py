"""Comparison SQL for ingestion, defects, screening and event intake."""

from __future__ import annotations

from ledgerline.functions.signing import pads
from ledgerline.operators.defects import DATASETS, DEFECT_SHARE, RATES, SEED
from ledgerline.oracle.build import query, table_query
from ledgerline.plans.screening import BLOCKED_PHRASES, FORBIDDEN_WORDS, METRIC_KEYWORDS
from ledgerline.sources.fixtures import FIXTURE_SECRET, QUESTIONS
from ledgerline.sources.ingest import ENTITIES
from ledgerline.streaming.intake import ACCEPTED_EVENTS

_T = "strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}"
_AD_FEED = "select * from raw_ad_spend where _batch_id = 1"


def _since(name: str) -> str:
    entity = ENTITIES[name]
    table = f"({_AD_FEED})" if name == "advertising" else entity.table
    where = f" where {entity.since_column} >= date '1999-01-01'" if entity.since_column else ""
    return f"select '{name}' as entity, count(*) as row_count from {table}{where}"


def _totals(name: str) -> str:
    return (
        f"select '{name}' as entity, '{ENTITIES[name].table}' as table_name, count(*) as rows_loaded "
        f"from {ENTITIES[name].table}"
    )


_CUSTOMER = (
    "acquisition_channel city country customer_id customer_segment email first_name last_name signup_date state".split()
)
_CUSTOMER_JSON = ", ".join(f"'{c}', {c}::varchar" for c in _CUSTOMER)

# -- defects: the same draw, from DuckDB's md5 ---------------------------------------------------------------


def _draw(key: str, name: str) -> str:
    return f"('0x' || substr(md5(({key})::varchar || '|{name}|{SEED}'), 1, 8))::bigint"


def _picked(key: str, name: str) -> str:
    return f"{_draw(key, name)} < {int(RATES[name] * DEFECT_SHARE * 2**32)}"


_DEFECT_CTES = {
    "copied_orders": f"""
        select o.*, c from raw_orders o cross join (values (0), (1)) t(c)
        where _batch_id = 1 and (c = 0 or {_picked('order_id', 'duplicate_orders')})""",
    "changed_payments": f"""
        select payment_id,
          if({_picked('payment_id', 'orphan_payments')}, 'ORD-GHOST-0000', order_id::varchar) as order_id,
          if({_picked('payment_id', 'payment_amount_mismatch')},
             (amount * ((8000 + {_draw('payment_id', 'payment_factor')} % 1500)::decimal(6,0)
               * 0.0001::decimal(5,4))::decimal(6,4))::decimal(18,2), amount) as amount
        from raw_payments where _batch_id = 1""",
    "copied_payments": f"""
        select p.*, c from changed_payments p cross join (values (0), (1)) t(c)
        where c = 0 or {_picked('payment_id', 'duplicate_payments')}""",
}
_COUNTS = {
    "duplicate_orders": "select count(*) from copied_orders where c = 1",
    "orphan_order_items": "select count(*) from raw_order_items where _batch_id = 1 and "
    + _picked("order_item_id", "orphan_order_items"),
    "orphan_payments": "select count(*) from changed_payments where order_id = 'ORD-GHOST-0000'",
    "refund_exceeds_payment": f"select count(*) from raw_refunds where {_picked('refund_id', 'refund_exceeds_payment')}",
    "null_customer_email": "select count(*) from raw_customers where _batch_id = 1 and "
    + _picked("customer_id", "null_customer_email"),
    "null_product_sku": f"select count(*) from raw_products where {_picked('product_id', 'null_product_sku')}",
    "invalid_order_status": "select count(*) from copied_orders where "
    + _picked("order_id || '#' || c", "invalid_order_status"),
    "negative_inventory": f"select count(*) from raw_inventory where {_picked('inventory_id', 'negative_inventory')}",
    "payment_amount_mismatch": "select count(*) from raw_payments where _batch_id = 1 and "
    + _picked("payment_id", "payment_amount_mismatch"),
    "duplicate_payments": "select count(*) from copied_payments where c = 1",
    "late_shipment_date": "select count(*) from raw_shipments where delivered_date is not null and "
    + _picked("shipment_id", "late_shipment_date"),
}


def _defect_query(sql: str) -> str:
    return query(sql, _DEFECT_CTES)


def _least(key: str, name: str, table: str) -> str:
    """The rows with the least draws, as many as wanted; ``wish`` and ``place`` say which."""
    return f"""
        select *, greatest(1, floor(count(*) over () * {DEFECT_SHARE}::double * {RATES[name]}::double))::bigint as wish,
          row_number() over (order by {_draw(key, name)}, ({key})::varchar) as place from {table}"""


_EXACT_CTES = {
    "exact_copies": f"""
        select o.* exclude (wish, place), c from ({_least('order_id', 'duplicate_orders', '(select * from raw_orders where _batch_id = 1)')}) o
        cross join (values (0), (1)) t(c) where c = 0 or place <= wish""",
    "exact_states": _least("order_id || '#' || c", "invalid_order_status", "exact_copies"),
}
_EXACT_TABLES = {
    "duplicate_orders": "raw_orders where _batch_id = 1",
    "invalid_order_status": "exact_copies",
    "orphan_order_items": "(select distinct order_item_id from raw_order_items)",
    "orphan_payments": "raw_payments where _batch_id = 1",
    "payment_amount_mismatch": "raw_payments where _batch_id = 1",
    "duplicate_payments": "raw_payments where _batch_id = 1",
    "refund_exceeds_payment": "raw_refunds",
    "null_customer_email": "raw_customers where _batch_id = 1",
    "null_product_sku": "raw_products",
    "negative_inventory": "raw_inventory",
    "late_shipment_date": "raw_shipments where delivered_date is not null",
}


# -- event intake -------------------------------------------------------------------------------------------

_INNER, _OUTER = pads(FIXTURE_SECRET)
_HMAC = f"'sha256=' || sha256(from_hex('{_OUTER}') || from_hex(sha256(from_hex('{_INNER}') || encode(body))))"
_TYPES = ", ".join(f"'{t}'" for t in ACCEPTED_EVENTS)
_WEBHOOK_CTES = {
    "requests": """
        select event_id as k,
          case when event_id%179=6 then '' when event_id%173=4 then null
               when event_id%50=0 and event_id>0 then (event_id-1)::varchar else event_id::varchar end
            as event_id,
          ts as received_at,
          case when event_id%211=1 then '{not json' when event_id%199=1 then '{"source":"x"}'
               else concat(if(event_id%97=3, '{"event_type":"","type":"order.cancelled"', concat('{"event_type":"',
                 case event_type when 'view' then 'order.updated' when 'click' then 'shipment.updated'
                   when 'signup' then 'order.created' when 'purchase' then 'payment.completed' else 'system.error' end,
                 '"')), if(event_id%89=2, '', ',"source":"shop"'), ',"data":', props, '}') end as body
        from events""",
    "checked": f"""
        select *, case when k%131=7 or k%137=9 or k%139=11 then 'bad_signature'
                       when not json_valid(body) then 'invalid_json'
                       when event_type is null then 'missing_event_type'
                       when event_type not in ({_TYPES}) then 'unknown_event_type' end as reason
        from (select *, if(json_valid(body), coalesce(nullif(body->>'$.event_type', ''), nullif(body->>'$.type', '')),
                null) as event_type,
                if(json_valid(body), ifnull(body->>'$.source', 'unknown'), 'unknown') as source from requests)""",
    "taken": """
        select * from checked where reason is null and event_id <> ''
        qualify row_number() over (partition by event_id order by received_at, body) = 1
        union all select * replace (null as event_id) from checked where reason is null and ifnull(event_id, '') = ''""",
}
_CODE = "case when reason is null then 202 when reason = 'bad_signature' then 401 when reason = 'invalid_json' then 400 else 422 end"
_STAMP = "strftime(received_at, '%Y-%m-%d %H:%M:%S')"


def _webhook_query(sql: str) -> str:
    return query(sql, _WEBHOOK_CTES)


# -- screening ----------------------------------------------------------------------------------------------


def _contains(column: str, phrases) -> str:
    return "(" + " or ".join(f"contains({column}, '{p}')" for p in phrases) + ")"


_TAGS = ", ".join(f"case when {_contains('q', words)} then '{key}' end" for key, words in METRIC_KEYWORDS.items())
_WORDS = "|".join(FORBIDDEN_WORDS)
_ASKED = ", ".join(f"'{q}'" for q in QUESTIONS)
_QUERY_LOG = """
    select event_id, case event_id % 10
      when 0 then 'SELECT * FROM main_marts.fct_orders LIMIT ' || event_id
      when 1 then '  with t as (select ' || event_id || ' as id) select count(*) from t  '
      when 2 then 'DELETE FROM main_marts.fct_orders WHERE order_id = ' || event_id
      when 3 then 'SELECT ' || event_id || '; Drop TABLE fct_orders'
      when 4 then 'select updated_at, created from t where note = ''please call ' || event_id || ''''
      when 5 then '' when 6 then '   ' when 7 then null
      when 8 then 'SELECTED ' || event_id || ' rows from a statement that is longer than forty characters'
      else 'select callout, dropped, grants from report_' || event_id end as sql
    from events"""

SQL = {
    "src_scan_orders": "select * replace (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate) from orders",
    "src_incremental_orders": query("""
        select order_id, customer_id, order_date, channel_id, channel, order_status, subtotal::double as subtotal,
          discount::double as discount, tax::double as tax, shipping::double as shipping,
          total_amount::double as total_amount from raw_orders where order_date >= date '1999-01-01'"""),
    "src_incremental_counts": query(" union all ".join(_since(n) for n in ENTITIES)),
    "src_metadata_customers": query(f"""
        select {', '.join(_CUSTOMER)}, '2024-01-01 00:00:00' as _ingested_at, 'mock/customers' as _source,
          '20240101T000000Z' as _batch_id, md5(json_object({_CUSTOMER_JSON})::varchar) as _record_hash
        from raw_customers"""),
    "src_pipeline_totals": query(" union all ".join(_totals(n) for n in ENTITIES)),
    "src_loaded_counts": query("""
        select 'raw_customers' as table_name, count(*) + count(*) filter (where signup_date >= date '1999-01-01')
          as row_count from raw_customers
        union all select 'raw_products', 2 * count(*) from raw_products
        union all select 'raw_orders', count(*) + count(*) filter (where order_date >= date '1999-01-01')
        from raw_orders"""),
    "src_reload_counts": query("""
        select 'raw_customers' as table_name, count(*) as row_count, count(*) as stamped from raw_customers
        union all select 'raw_products', 2 * count(*), 2 * count(*) from raw_products
        union all select 'raw_payments', count(*), count(*) from raw_payments
        union all select 'raw_refunds', 0, 0"""),
    "src_resumed_commits": query("""
        select 1::bigint as version, 'append' as mode, count(*) as rows, min(order_date)::varchar as low,
          max(order_date)::varchar as high from marked where early
        union all select 2, 'append', count(*), min(order_date)::varchar, max(order_date)::varchar from marked where late
        union all select 3, 'append', 0, null, null""", {"marked": """
        select *, order_date < date '1999-01-01' as early,
            order_date > max(if(order_date < date '1999-01-01', order_date, null)) over () as late from raw_orders"""}),
    "src_resumed_months": query("""
        select cast(date_trunc('month', order_date) as date) as month, count(*) as row_count from raw_orders
        where order_date >= date '2001-03-15' group by 1"""),
    "src_new_files": query("""
        select cast(order_id % 3 + 1 as bigint) as version, count(*) as rows from raw_orders group by 1"""),
    "src_changes": query("""
        select order_id, if(old, 'update', 'insert') as change,
          case when old then 'processing' end as order_status_before, order_status as order_status_after
        from known where changed or not old
        union all select -order_id, 'delete', order_status, null from known where old and order_id % 4000 = 9""", {"known": """
        select distinct order_id, order_date, order_status, order_date < date '2001-03-15' as old,
          year(order_date) = 1998 and order_id % 50 = 3 as changed from raw_orders"""}),
    "src_versions": query("""
        select 1 as version, old + gone as row_count from counted union all select 2, new from counted
        union all select 3, new + old + gone from counted""", {"counted": """
        select count(*) filter (order_date < date '2001-03-15') as old, count(*) as new,
          count(*) filter (order_date < date '2001-03-15' and order_id % 4000 = 9) as gone from raw_orders"""}),
    "inc_order_revenue": table_query("int_order_revenue"),
    "inc_mart_sales": table_query("mart_sales"),
    "inc_mart_finance": table_query("mart_finance"),
    "src_csv_products": query("""
        select * exclude (_batch_id) replace (unit_cost::double as unit_cost, list_price::double as list_price)
        from raw_products"""),
    "src_sql_read": query("""
        select reason, count(*) as refunds, count(*) filter (where is_over_refund) as over_refunds,
          sum(amount)::double as amount from fct_refunds group by 1"""),
    "src_materialised_sales": table_query("mart_sales"),
    "inj_orders": _defect_query(f"""
        select order_id, if({_picked("order_id || '#' || c", 'invalid_order_status')}, 'UNKNOWN_STATUS', order_status)
          as order_status from copied_orders"""),
    "inj_order_items": _defect_query(f"""
        select order_item_id, if({_picked('order_item_id', 'orphan_order_items')}, 'ORD-INVALID-9999', order_id::varchar)
          as order_id from raw_order_items where _batch_id = 1"""),
    "inj_payments": _defect_query("select payment_id, order_id, amount::double as amount from copied_payments"),
    "inj_refunds": _defect_query(f"""
        select refund_id, if({_picked('refund_id', 'refund_exceeds_payment')},
          (amount * ((11000 + {_draw("'all'", 'refund_factor')} % 9000)::decimal(6,0)
            * 0.0001::decimal(5,4))::decimal(6,4))::decimal(18,2), amount)::double as amount from raw_refunds"""),
    "inj_customers": _defect_query(f"""
        select customer_id, if({_picked('customer_id', 'null_customer_email')}, null, email) as email
        from raw_customers where _batch_id = 1"""),
    "inj_products": _defect_query(f"""
        select product_id, if({_picked('product_id', 'null_product_sku')}, null, sku) as sku from raw_products"""),
    "inj_inventory": _defect_query(f"""
        select inventory_id, if({_picked('inventory_id', 'negative_inventory')}, -abs(closing_qty), closing_qty)
          as closing_qty from raw_inventory"""),
    "inj_shipments": _defect_query(f"""
        select shipment_id, if({_picked('shipment_id', 'late_shipment_date')} and delivered_date is not null,
          delivered_date, shipped_date) as shipped_date, delivered_date from raw_shipments"""),
    "inj_report": _defect_query(
        " union all ".join(
            f"select '{n}' as defect_type, '{DATASETS[n][0]}' as dataset, ({sql}) as affected, "
            f"'{DATASETS[n][1]}' as description"
            for n, sql in _COUNTS.items()
        )
    ),
    "inj_exact_orders": query(
        "select order_id, if(place <= wish, 'UNKNOWN_STATUS', order_status) as order_status from exact_states", _EXACT_CTES
    ),
    "inj_exact_counts": query(
        " union all ".join(
            f"select '{n}' as defect_type, greatest(1, floor(count(*) * {DEFECT_SHARE}::double * {RATES[n]}::double))::bigint"
            f" as wanted, wanted as affected from {table}"
            for n, table in _EXACT_TABLES.items()
        ),
        _EXACT_CTES,
    ),
    "wh_signatures": _webhook_query(f"""
        select event_id, {_STAMP} as received_at, {_HMAC} as expected,
          case when k%131=7 then 'sha256=' || repeat('0', 64) when k%137=9 then null
               when k%139=11 then substr({_HMAC}, 8) else {_HMAC} end as signature from requests"""),
    "wh_routed": _webhook_query(f"""
        select event_id, {_STAMP} as received_at, body, event_type, source, reason, ({_CODE})::int as status_code
        from checked"""),
    "wh_accepted": _webhook_query(f"""
        select md5(event_id || '|' || rtrim(rtrim(strftime(received_at, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.'))
            as webhook_event_id, event_id, event_type, {_STAMP} as received_at, source,
          body as payload, 'pending' as processing_status, null::varchar as processed_at, null::varchar as error_message
        from taken"""),
    "wh_rejected": _webhook_query(f"""
        select event_id, {_STAMP} as received_at, body, event_type, ({_CODE})::int as status_code, reason
        from checked where reason is not null"""),
    "wh_ids_state": _webhook_query("select event_id from taken"),
    "wh_ids_watermark": _webhook_query("select event_id from taken"),
    "wh_ids_late": _webhook_query("select event_id from taken"),
    "ai_screened_questions": f"""
        select conv_id, turn, role, ifnull({_contains('q', BLOCKED_PHRASES)}, false) as is_blocked, concat_ws(',', {_TAGS}) as metrics
        from (select *, if((conv_id + turn) % 10 = 0, null, lower(text || [{_ASKED}][((conv_id + turn) % {len(QUESTIONS)} + 1)::int])) as q
              from conversations)""",
    "ai_screened_sql": query(
        f"""
        select event_id, sql, case when clean = '' then 'Empty SQL statement'
            when not regexp_matches(clean, '(?i)^(WITH|SELECT)\\b')
              then 'SQL must begin with SELECT (or WITH for CTEs). Got: ''' || substr(clean, 1, 40) || '…'''
            when regexp_matches(clean, '(?i)\\b({_WORDS})\\b')
              then 'Forbidden operation detected: ''' || regexp_extract(clean, '(?i)\\b({_WORDS})\\b') || ''' at position '
                || length(regexp_extract(clean, '(?is)^(.*?)\\b({_WORDS})\\b', 1))
            else '' end as reason, reason = '' as is_safe
        from (select *, trim(ifnull(sql, '')) as clean from query_log)""",
        {"query_log": _QUERY_LOG},
    ),
    "ai_preview": f"select *, count(*) over () as total_rows from ({table_query('mart_sales')}) "
    "order by year_month, channel_id limit 5",
}
