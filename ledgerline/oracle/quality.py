"""Comparison SQL for the quality checks."""

from __future__ import annotations

from ledgerline.oracle.build import query
from ledgerline.plans.quality import CHECKS, NOT_NULL, WARN_ONLY


def _orphans(table: str) -> str:
    return (
        f"select count(*), count(*) filter (where order_id is not null and order_id not in "
        f"(select order_id from stg_orders)) from {table}"
    )


def _repeats(table: str, key: str) -> str:
    return f"select count(*), count(*) - count(distinct {key}) from {table}"


def _matching(table: str, condition: str) -> str:
    return f"select count(*), count(*) filter (where {condition}) from {table}"


COUNTS = {
    "uniq_001": _repeats("stg_orders", "order_id"),
    "uniq_002": _repeats("stg_customers", "customer_id"),
    "uniq_003": _repeats("stg_payments", "payment_id"),
    "uniq_004": _repeats("stg_products", "product_id"),
    "ref_001": _orphans("stg_order_items"),
    "ref_002": _orphans("stg_payments"),
    "ref_003": _orphans("stg_refunds"),
    "ref_004": _orphans("stg_shipments"),
    "fin_001": _matching("raw_inventory", "closing_qty < 0"),
    "fin_002": _matching("fct_refunds", "is_over_refund"),
    "fin_003": _matching("fct_payments", "reconciliation_status = 'EXCEPTION'"),
    "fin_004": _matching("fct_payments", "reconciliation_status = 'WARNING'"),
    "fin_005": "select count(*), count(*) filter (where n > 1) from (select count(*) as n from stg_payments "
    "where status = 'completed' group by order_id)",
    "fin_006": _matching("fct_payouts", "reconciliation_status = 'EXCEPTION'"),
    "comp_001": _matching("stg_customers", "email is null"),
    "comp_002": _matching("stg_products", "sku is null or trim(sku) = ''"),
    "comp_003": _matching("stg_orders", "order_status = 'unknown'"),
    "comp_004": "select count(*), count(*) filter (where n < 0.7::double * m) "
    "from (select count(*) as n, avg(count(*)) over () as m from stg_orders group by order_date)",
}
AVERAGE = (
    "(select format(' ({:.0f})', avg(n)) from (select count(*) as n from stg_orders group by order_date))"
)


def _row(check) -> str:
    quoted = {k: v.replace("'", "''") for k, v in vars(check).items()}
    detail = AVERAGE if check.check_id == "comp_004" else "''"
    return f"""
        select '{quoted['check_id']}' as check_id, '{quoted['check_name']}' as check_name,
          '{quoted['dataset']}' as dataset, '{check.severity}' as severity,
          case when n = 0 then 'SKIPPED' when bad = 0 then 'PASS' when '{check.severity}' = 'WARNING' then 'WARN'
               else 'FAIL' end as status,
          n as records_checked, bad as records_failed, round(if(n = 0, 1.0::double, 1 - bad::double / n), 4) as pass_rate,
          format('{{:,}}', bad) || ' {quoted['text']}' || {detail} as message
        from ({COUNTS[check.check_id]}) t(n, bad)"""


ALL_CHECKS = " union all ".join(_row(c) for c in CHECKS)
_SUMMARY = """
    select count(*) as total_checks, count(*) filter (where status = 'PASS') as passed,
      count(*) filter (where status = 'WARN') as warned, count(*) filter (where status = 'FAIL') as failed,
      count(*) filter (where status = 'ERROR') as errored,
      count(*) filter (where status in ('FAIL', 'ERROR') and severity = 'CRITICAL') as critical_issues
    from dq_rows"""


def _test(kind: str, table: str, column: str, failures: str) -> str:
    bad = "warn" if (table, column) in WARN_ONLY else "fail"
    return f"""
        select '{kind}_{table}_{column}' as test_name, '{table}' as table_name, '{column}' as column_name,
          f as failures, if(f = 0, 'pass', '{bad}') as status from ({failures}) t(f)"""


SQL = {
    "dq_results": query(ALL_CHECKS),
    "dq_summary": query(_SUMMARY, {"dq_rows": ALL_CHECKS}),
    "dq_broken_table": query(
        f"select check_id, if(check_id in ('uniq_002', 'comp_001'), 'ERROR', status) as status from ({ALL_CHECKS})"
    ),
    "dq_gate": query(
        f"select critical_issues, critical_issues > 0 as blocked from ({_SUMMARY})", {"dq_rows": ALL_CHECKS}
    ),
    "dq_report": query(
        f"select 'run' as run_at, s.*, r.* from ({_SUMMARY}) s cross join dq_rows r", {"dq_rows": ALL_CHECKS}
    ),
    "dq_not_null_tests": query(
        " union all ".join(
            _test("not_null", t, c, f"select count(*) from {t} where {c} is null") for t, cs in NOT_NULL.items() for c in cs
        )
    ),
    "dq_unique_products": query(
        _test(
            "unique",
            "raw_products",
            "product_id",
            "select count(*) from (select product_id from raw_products group by 1 having count(*) > 1)",
        )
    ),
    **{f"dq_{c.check_id}": query(_row(c)) for c in CHECKS},
}
# The same figures, whether they are counted afterwards or observed while the tables are written.
SQL |= {"dq_at_load": SQL["dq_results"], "dq_gate_at_load": SQL["dq_gate"]}
