"""Screening of question and query logs, metric tagging and result previews, as column operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases a question must not contain.
BLOCKED_PHRASES = (
    "drop table",
    "delete from",
    "truncate",
    "insert into",
    "update set",
    "alter table",
    "grant ",
    "revoke ",
    "ignore previous",
    "disregard your instructions",
    "you are now",
    "pretend you are",
    "act as",
)
# Words a read-only query must not contain.
FORBIDDEN_WORDS = (
    "INSERT",
    "UPDATE",
    "DELETE",
    "DROP",
    "ALTER",
    "TRUNCATE",
    "CREATE",
    "REPLACE",
    "MERGE",
    "CALL",
    "EXEC",
    "EXECUTE",
    "GRANT",
    "REVOKE",
    "ATTACH",
    "DETACH",
    "COPY",
    "EXPORT",
    "IMPORT",
)
# Words by which a question refers to a metric.
METRIC_KEYWORDS = {
    "gross_revenue": ("revenue", "gross revenue", "sales"),
    "net_revenue": ("net revenue", "net sales"),
    "cogs": ("cogs", "cost of goods"),
    "gross_profit": ("profit", "gross profit"),
    "gross_margin_pct": ("margin", "margin %"),
    "order_count": ("orders", "order count", "order volume"),
    "aov": ("aov", "average order", "order value"),
    "new_customers": ("new customer", "acquisition"),
    "cac": ("cac", "acquisition cost", "cost per customer"),
    "roas": ("roas", "return on ad", "ad spend"),
    "refund_rate": ("refund", "return rate"),
    "inventory_turnover": ("inventory", "stock", "turnover"),
    "ltv": ("ltv", "lifetime value", "customer value"),
}

# Java patterns; the U flag gives word boundaries and white space their Unicode meaning.
_FORBIDDEN = r"(?iU)\b(" + "|".join(FORBIDDEN_WORDS) + r")\b"
_READ_ONLY = r"(?iU)^(WITH|SELECT)\b"
_EDGES = r"(?U)^\s+|\s+$"


def _any_of(lowered: Column, phrases: tuple[str, ...]) -> Column:
    """One pass over the text for all phrases, taken literally."""
    return lowered.rlike("|".join(re.escape(p) for p in phrases))


def is_blocked(question: Column) -> Column:
    """Whether a question asks for what is not allowed; a missing one does not."""
    return F.coalesce(_any_of(F.lower(question), BLOCKED_PHRASES), F.lit(False))


def metric_tags(question: Column) -> Column:
    """Keys of the metrics a question mentions, in catalog order."""
    lowered = F.lower(question)
    tags = [F.when(_any_of(lowered, words), F.lit(key)) for key, words in METRIC_KEYWORDS.items()]
    return F.filter(F.array(*tags), lambda t: t.isNotNull())


def screen_questions(questions: DataFrame, text: str = "text") -> DataFrame:
    return questions.withColumns({"is_blocked": is_blocked(F.col(text)), "metrics": metric_tags(F.col(text))})


def screen_sql(log: DataFrame, text: str = "sql") -> DataFrame:
    """The three reasons are fixed values. Verdict per logged statement: must be non-empty, start as a read, and name no forbidden word anywhere."""
    cleaned = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), _EDGES, "")
    return (
        log.withColumn("_clean", cleaned)
        .withColumns(
            {
                "_word": F.regexp_extract("_clean", _FORBIDDEN, 0),
                "_reads": F.col("_clean").rlike(_READ_ONLY),
            }
        )
        .withColumn(
            "reason",
            F.when(F.col("_clean") == "", "Empty SQL statement")
            .when(
                ~F.col("_reads"),
                F.concat(
                    F.lit("SQL must begin with SELECT (or WITH for CTEs). Got: '"),
                    F.substring("_clean", 1, 40),
                    F.lit("…'"),
                ),
            )
            .when(
                F.col("_word") != "",
                F.concat(
                    F.lit("Forbidden operation detected: '"),
                    "_word",
                    F.lit("' at position "),
                    (F.regexp_instr("_clean", F.lit(_FORBIDDEN)) - 1).cast("string"),
                ),
            )
            .otherwise(""),
        )
        .withColumn("is_safe", F.col("reason") == "")
        .drop("_clean", "_word", "_reads")
    )


def preview(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows of a result with the number of all of them."""
    total = df.agg(F.count("*")).scalar()
    return df.orderBy(*order).limit(rows).withColumn("total_rows", total)


def _questions(warehouse) -> DataFrame:
    return screen_questions(warehouse.source.question_log()).select(
        "conv_id", "turn", "role", "is_blocked", F.concat_ws(",", "metrics").alias("metrics")
    )


QUERIES = {
    "ai_screened_questions": _questions,
    "ai_screened_sql": lambda warehouse: screen_sql(warehouse.source.query_log()),
    "ai_preview": lambda mart_sales: preview(mart_sales, ["year_month", "channel_id"]),
}
