"""Contract checks: primary-key uniqueness, NOT NULL and CHECK in-lists.

Every rule is computed in one distributed pass (the NOT NULL and CHECK rules
share a single global aggregate; the key rule is one grouped count), and the
result is a tiny (rule, rows_checked, violations) table — only that reaches
the driver in :func:`enforce`.  A batch that is being written anyway is better
:func:`observed`: its row rules are counted by the writing tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.contracts import Contract

SUMMARY_SCHEMA = "rule string, rows_checked bigint, violations bigint"


def _flag(cond) -> F.Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def not_null_violations(df: DataFrame, columns) -> list[tuple[str, F.Column]]:
    return [(f"not_null:{c}", _flag(F.col(c).isNull())) for c in columns if c in df.columns]


def check_violations(df: DataFrame, checks: dict) -> list[tuple[str, F.Column]]:
    """CHECK (col IN (...)): NULL passes, like a SQL CHECK."""
    out = []
    for c, allowed in checks.items():
        if c in df.columns:
            bad = F.col(c).isNotNull() & ~F.col(c).isin(*allowed)
            out.append((f"check:{c}", _flag(bad)))
    return out


def _rule_table(df: DataFrame, rules: list[tuple[str, F.Column]]) -> DataFrame:
    if not rules:
        return df.sparkSession.createDataFrame([], SUMMARY_SCHEMA)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[expr.alias(f"_r{i}") for i, (_, expr) in enumerate(rules)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("violations"))
        for i, (name, _) in enumerate(rules)
    ])).alias("_rule")
    return agg.select(F.col("_rows").alias("rows_checked"), stacked).select(
        "_rule.rule", "rows_checked", F.coalesce("_rule.violations", F.lit(0)).cast("bigint").alias("violations"))


def key_violations(df: DataFrame, keys) -> DataFrame:
    """Rows beyond the first for each duplicated key (0 when the key is unique)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit("primary_key:" + ",".join(keys)).alias("rule"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_checked"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("violations"),
    )


def violations(df: DataFrame, spec: Contract, include_keys: bool = True) -> DataFrame:
    """All rules of ``spec`` that apply to the columns present in ``df``."""
    table = _rule_table(df, row_rules(df, spec)).select("rule", "rows_checked", "violations")
    if include_keys:
        table = table.unionByName(key_violations(df, spec.keys))
    return table


def observed(df: DataFrame, spec: Contract) -> tuple[DataFrame, Observation]:
    """df with the NOT NULL and CHECK rules of ``spec`` counted while it is written.

    The counts are taken in the tasks that write the rows, so these rules need no read of their own.
    """
    seen = Observation(f"{spec.name}-rules")
    rules = row_rules(df, spec)
    flags = [F.coalesce(expr, F.lit(0).cast("bigint")).alias(f"r{i}") for i, (_, expr) in enumerate(rules)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *flags), seen


def row_rules(df: DataFrame, spec: Contract) -> list[tuple[str, F.Column]]:
    return not_null_violations(df, spec.not_null) + check_violations(df, spec.checks)


def observed_violations(seen: Observation, df: DataFrame, spec: Contract) -> list[tuple[str, int, int]]:
    """(rule, rows checked, violations) of an observed write that has ended."""
    got = seen.get
    return [(name, got["rows"], got[f"r{i}"]) for i, (name, _) in enumerate(row_rules(df, spec))]


def enforce_observed(seen: Observation, staged: DataFrame, spec: Contract) -> int:
    """Raise if a rule is violated: row rules as observed, the key rule by one read of the staged key columns.

    Returns the number of rows.
    """
    found = observed_violations(seen, staged, spec)
    found += [tuple(r) for r in key_violations(staged, spec.keys).collect()]
    _raise_if_any(found, spec)
    return seen.get["rows"]


class ContractViolation(ValueError):
    pass


def enforce(df: DataFrame, spec: Contract) -> None:
    """Raise if any rule is violated (collects only the per-rule summary)."""
    _raise_if_any([tuple(r) for r in violations(df, spec).collect()], spec)


def _raise_if_any(found, spec: Contract) -> None:
    bad = [(rule, n) for rule, _, n in found if n]
    if bad:
        detail = ", ".join(f"{rule}={n}" for rule, n in bad)
        raise ContractViolation(f"{spec.name} contract violated: {detail}")
