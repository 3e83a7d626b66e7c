"""Row-level data-quality rules for order lines.

Each rule is a SQL predicate that marks a row bad, plus the description
stored with it.  The first rule that fires names the row; rows no rule
marks are 'Valid'.  Rules test the values as read, before any narrowing cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: order-line rules in evaluation order, and their texts ---
ORDER_RULES = [
    ("quantity IS NULL OR quantity < 0", "Invalid quantity"),
    ("taxamount IS NULL OR taxamount < 0", "Invalid tax amount"),
    ("unitprice IS NULL OR unitprice < 0", "Invalid unit price"),
    ("customer_id IS NULL", "Missing customer ID"),
    ("product_id IS NULL", "Missing product ID"),
    ("supplier_id IS NULL", "Missing supplier_id"),
    ("warehouse_id IS NULL", "Missing warehouse_id"),
    ("createddate IS NULL OR processeddate IS NULL", "Missing date"),
    ("processeddate < createddate", "Invalid date order"),
]
VALID = "Valid"
# ---------------------------------------------------------------------------


def first_failure(rules: list[tuple[str, str]] = ORDER_RULES, valid: str = VALID) -> Column:
    """CASE over the rules: description of the first rule that holds."""
    expr = None
    for predicate, text in rules:
        cond = F.expr(predicate)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr.otherwise(F.lit(valid))


def rules_sql(rules: list[tuple[str, str]] = ORDER_RULES, valid: str = VALID) -> str:
    """The same CASE as SQL text (used by SQL checks and `spark.sql` callers)."""
    branches = " ".join(f"WHEN {p} THEN '{t}'" for p, t in rules)
    return f"CASE {branches} ELSE '{valid}' END"


def flag(df: DataFrame, rules: list[tuple[str, str]] = ORDER_RULES) -> DataFrame:
    """Add `error_description` and `error_flag` (1 when any rule fires)."""
    return (
        df.withColumn("error_description", first_failure(rules))
        .withColumn("error_flag", (F.col("error_description") != F.lit(VALID)).cast("int"))
    )
