"""Data-quality suite.

All NULL, range and emptiness checks of a table share one aggregation; each unique check adds one grouped count.  The
outcome is a small DataFrame with one row per check, so a suite costs 1 + (number of unique checks) passes however long
the list is.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.dedup import surplus_rows
from meterlake.operators.lookups import SALTS
from meterlake.sources.staging import stage

FAILURE_COLUMNS = ["dq_table", "check_name", "check_type", "column_name", "failure_reason", "failed_value"]


# --- check descriptions: plain dicts with name, check_type, column / columns, min_val, max_val ---------------------


def not_null(column: str, name: str | None = None) -> dict:
    return {"name": name or f"{column.lower()}_not_null", "check_type": "not_null", "column": column}


def unique(*columns: str, name: str | None = None) -> dict:
    return {"name": name or f"{columns[0].lower()}_unique", "check_type": "unique", "columns": list(columns)}


def within(column: str, min_val=None, max_val=None, name: str | None = None) -> dict:
    return {
        "name": name or f"{column.lower()}_range",
        "check_type": "range",
        "column": column,
        "min_val": min_val,
        "max_val": max_val,
    }


def not_empty(name: str = "not_empty") -> dict:
    return {"name": name, "check_type": "not_empty"}


def _unique_columns(check: dict) -> list[str]:
    return check.get("columns") or [check["column"]]


def _row_predicate(check: dict) -> Column | None:
    """True for a row that breaks a row-wise check; None when the check has nothing to test."""
    column = F.col(f"`{check['column']}`")
    if check["check_type"] == "not_null":
        return column.isNull()
    bounds = []
    if check.get("min_val") is not None:
        bounds.append(column < check["min_val"])
    if check.get("max_val") is not None:
        bounds.append(column > check["max_val"])
    return reduce(lambda a, b: a | b, bounds) & column.isNotNull() if bounds else None


def _outcome(seq: int, table: str, check: dict, value: Column, failed: Column, column_name: str, reason: Column) -> Column:
    return F.struct(
        F.lit(seq).alias("seq"),
        F.lit(table).alias("dq_table"),
        F.lit(check["name"]).alias("check_name"),
        F.lit(check["check_type"]).alias("check_type"),
        F.lit(column_name).alias("column_name"),
        reason.alias("failure_reason"),
        value.cast("bigint").alias("failed_value"),
        failed.alias("failed"),
    )


def evaluate_checks(df: DataFrame, table: str, checks: list[dict]) -> DataFrame:
    """One row per applicable check: seq, the failure columns and ``failed``.  Unknown check types are ignored."""
    counters: dict[str, Column] = {}
    outcomes: list[Column] = []
    grouped: list[DataFrame] = []
    for seq, check in enumerate(checks):
        kind, counter = check["check_type"], f"__c{seq}"
        if kind in ("not_null", "range"):
            predicate = _row_predicate(check)
            if predicate is None:
                continue
            counters[counter] = F.count_if(predicate)
            column = check["column"]
            text = f" nulls in {column}" if kind == "not_null" else f" out-of-range values in {column}"
            value = F.col(counter)
            reason = F.concat(value.cast("string"), F.lit(text))
            outcomes.append(_outcome(seq, table, check, value, value > 0, column, reason))
        elif kind == "not_empty":
            counters[counter] = F.count(F.lit(1))
            empty = F.col(counter) == 0
            outcomes.append(_outcome(seq, table, check, F.lit(0), empty, "", F.lit("0 rows in dataframe")))
        elif kind == "unique":
            columns = _unique_columns(check)
            value = F.col("surplus")
            reason = F.concat(value.cast("string"), F.lit(f" duplicates on {columns}"))
            row = _outcome(seq, table, check, value, value > 0, ", ".join(columns), reason)
            grouped.append(surplus_rows(df, columns).select(F.inline(F.array(row))))
    parts = []
    if outcomes:
        row = df.agg(*[count.alias(name) for name, count in counters.items()])
        parts.append(row.select(F.inline(F.array(*outcomes))))
    parts += grouped
    if not parts:
        schema = "seq int, dq_table string, check_name string, check_type string, column_name string, "
        return df.sparkSession.createDataFrame([], schema + "failure_reason string, failed_value bigint, failed boolean")
    return reduce(DataFrame.unionByName, parts)


def run_checks(df: DataFrame, table: str, checks: list[dict]) -> DataFrame:
    """The failures only, in the layout of the failure log (without its timestamp)."""
    return evaluate_checks(df, table, checks).filter("failed").select("seq", *FAILURE_COLUMNS).drop("seq")


def summary_text(failures: list) -> str:
    return "; ".join(f"{f['check_name']}: {f['failure_reason']}" for f in failures)


def annotate_checks(
    df: DataFrame,
    table: str,
    checks: list[dict],
    log: Callable[[DataFrame], None] | None = None,
    fail_on_error: bool = False,
) -> DataFrame:
    """Add ``dq_passed`` and ``dq_failed_checks``: one verdict for the whole batch on every row.

    Failures go to ``log`` (a writer of failure rows with ``check_ts``) before ``fail_on_error`` raises.  The suite is
    evaluated now; pass a staged frame when ``df`` is costly.
    """
    outcome = evaluate_checks(df, table, checks).filter("failed").collect()  # at most one row per check
    failures = sorted(outcome, key=lambda row: row["seq"])
    if failures and log is not None:
        schema = "dq_table string, check_name string, check_type string, column_name string, "
        rows = [tuple(row[c] for c in FAILURE_COLUMNS) for row in failures]
        records = df.sparkSession.createDataFrame(rows, schema + "failure_reason string, failed_value bigint")
        log(records.withColumn("check_ts", F.current_timestamp()))
    summary = summary_text(failures)
    if failures and fail_on_error:
        raise RuntimeError(f"Data quality checks failed for {table}: {summary}")
    return df.withColumns({"dq_passed": F.lit(not failures), "dq_failed_checks": F.lit(summary)})


# --- row-level verdicts ---------------------------------------------------------------------------------------------


def flag_duplicates(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """True on every row whose key (NULLs equal) occurs more than once.

    Keys holding at least 1/1000 of all repeated rows are fewer than 1001 and are broadcast; their rows never enter a
    shuffle partition together.  All other keys are joined on the key.
    """
    renamed = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    counts = stage(df.groupBy(*renamed).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1"), "repeated")
    cut = (counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0] or 0) / 1000
    hot = counts.filter(F.col("__n") >= cut).select(*[c for c in counts.columns if c != "__n"], F.lit(True).alias("__hot"))
    cold = counts.filter(F.col("__n") < cut).select(*[c for c in counts.columns if c != "__n"], F.lit(True).alias("__cold"))

    def same_key(df: DataFrame) -> Column:
        pairs = [F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        return reduce(lambda a, b: a & b, pairs)

    key_names = [f"__k{i}" for i in range(len(keys))]
    marked = df.join(F.broadcast(hot), same_key(df), "left").drop(*key_names)
    # Rows of hot keys are settled: a salt other than 0 keeps them off the cold side's partitions.
    spread = F.when(F.col("__hot"), F.pmod(F.spark_partition_id(), F.lit(SALTS)) + 1).otherwise(F.lit(0))
    marked = marked.withColumn("__salt", spread)
    cold = cold.withColumn("__zero", F.lit(0))
    joined = marked.join(cold, same_key(marked) & (F.col("__salt") == F.col("__zero")), "left")
    settled = F.coalesce(F.col("__hot"), F.col("__cold"), F.lit(False))
    return joined.withColumn(flag, settled).select(*df.columns, flag)


def row_flags(df: DataFrame, checks: list[dict]) -> DataFrame:
    """Row-level verdicts: ``dq_row_passed`` and the names of the broken checks, in check order, in
    ``dq_row_failures``.  A table-level check (not_empty) cannot fail on a row."""
    source_columns, flagged, verdicts = df.columns, df, []
    for seq, check in enumerate(checks):
        if check["check_type"] in ("not_null", "range"):
            broken = _row_predicate(check)
        elif check["check_type"] == "unique":
            flagged = flag_duplicates(flagged, _unique_columns(check), f"__dup{seq}")
            broken = F.col(f"__dup{seq}")
        else:
            broken = None
        if broken is not None:
            verdicts.append(F.when(broken, F.lit(check["name"])))
    names = F.array_compact(F.array(*verdicts)) if verdicts else F.array().cast("array<string>")
    flagged = flagged.withColumn("__names", names)
    return flagged.select(
        *source_columns,
        (F.size("__names") == 0).alias("dq_row_passed"),
        F.array_join("__names", "; ").alias("dq_row_failures"),
    )


def passed_only(df: DataFrame, flag: str = "dq_passed") -> DataFrame:
    """Rows whose quality flag is true; frames without the flag pass unchanged."""
    return df.filter(F.col(flag)) if flag in df.columns else df


def expect_or_fail(df: DataFrame, name: str, predicate: Column | str) -> DataFrame:
    """Pass rows through; the job fails on the first row for which ``predicate`` is not true."""
    holds = F.expr(predicate) if isinstance(predicate, str) else predicate
    broken = F.raise_error(F.lit(f"expectation {name} violated")).cast("boolean")
    return df.filter(F.when(holds, F.lit(True)).otherwise(broken))
