"""Consumer views: column masks, row filters and their SQL functions.

Masks belong in views handed to readers, never in inputs of further joins: a masked key matches nothing.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.operators.tables import Lake

# Group names, replacement text and region rules consumers rely on.
ENGINEERS = "energy_data_engineer"
ANALYSTS = "energy_data_analyst"
TEXT_MASK = "********"
MEMBERS = "audit.reader_groups"
REGION_RULES = [("north_team", "NORTH"), ("south_team", "SOUTH")]
# table -> (text columns, numeric columns) that are masked
MASKED_COLUMNS = {
    "silver.dim_customer": (["customer_id", "LCLid"], []),
    "silver.dim_meter": (["LCLid"], []),
    "silver.dim_tariff": ([], ["rate_per_kwh"]),
    "silver.fact_billing": (["customer_id"], ["bill_amount", "rate_per_kwh"]),
    "gold.gold_theft_detection": (["LCLid"], []),
    "gold.gold_revenue_summary": ([], ["total_revenue", "avg_bill_amount"]),
}
FILTERED_TABLES = (
    "silver.dim_customer",
    "silver.dim_meter",
    "silver.dim_tariff",
    "silver.fact_consumption",
    "silver.fact_billing",
)


def mask_text(
    df: DataFrame,
    columns: list[str],
    groups: Collection[str],
    allowed: Collection[str] = (ENGINEERS,),
    replacement: str = TEXT_MASK,
) -> DataFrame:
    """Members of an allowed group see the value, everybody else the replacement (also in place of NULL)."""
    if set(groups) & set(allowed):
        return df
    return df.withColumns({c: F.lit(replacement) for c in columns if c in df.columns})


def mask_numeric(
    df: DataFrame,
    columns: list[str],
    groups: Collection[str],
    allowed: Collection[str] = (ENGINEERS, ANALYSTS),
) -> DataFrame:
    """Members of an allowed group see the value, everybody else NULL."""
    if set(groups) & set(allowed):
        return df
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns if c in df.columns})


def filter_region(
    df: DataFrame,
    groups: Collection[str],
    rules: list[tuple[str, str]] = REGION_RULES,
    column: str = "region",
) -> DataFrame:
    """The first rule whose team the reader belongs to limits the rows to its region; others see all rows."""
    for team, region in rules:
        if team in groups:
            return df.filter(F.col(column) == region)
    return df


def secured(df: DataFrame, table: str, groups: Collection[str]) -> DataFrame:
    """The view of a catalog table that a reader in ``groups`` gets."""
    text, numeric = MASKED_COLUMNS.get(table, ([], []))
    if table in FILTERED_TABLES:
        df = filter_region(df, groups)
    return mask_numeric(mask_text(df, text, groups), numeric, groups)


def secure_revenue(revenue: DataFrame, groups: Collection[str]) -> DataFrame:
    """The revenue mart with its money columns masked, without the quality columns."""
    view = secured(revenue, "gold.gold_revenue_summary", groups)
    return view.drop("dq_passed", "dq_failed_checks")


def install_masks(lake: Lake) -> None:
    """The four security functions for SQL users, persistent in the lake's gold schema.

    They look the reader up by ``session_user()`` in the table MEMBERS.  Nothing a reader can set in a session changes the
    outcome; who may write that table is for the catalog's grants to say.  The lookup is one scalar per query, not per row.
    """
    lake.create_from_contract(MEMBERS, "reader STRING, group_name STRING")

    def member(*groups: str) -> str:
        named = ", ".join(f"'{g}'" for g in groups)
        return f"(SELECT count(*) FROM {lake.name(MEMBERS)} m WHERE m.reader = session_user() AND m.group_name IN ({named})) > 0"

    text = f"CASE WHEN {member(ENGINEERS)} THEN v ELSE '{TEXT_MASK}' END"
    money = f"CASE WHEN {member(ENGINEERS, ANALYSTS)} THEN v END"
    region = " ".join(f"WHEN {member(team)} THEN region = '{name}'" for team, name in REGION_RULES)
    functions = {
        "mask_customer_id(v STRING) RETURNS STRING": text,
        "mask_lclid(v STRING) RETURNS STRING": text,
        "mask_financial_value(v DOUBLE) RETURNS DOUBLE": money,
        "region_filter(region STRING) RETURNS BOOLEAN": f"CASE {region} ELSE TRUE END",
    }
    for signature, body in functions.items():
        lake.spark.sql(f"CREATE OR REPLACE FUNCTION {lake.name('gold')}.{signature} RETURN {body}")


def set_groups(lake: Lake, reader: str, groups: Collection[str]) -> None:
    """From now on ``reader`` is a member of these groups and no others."""
    kept = lake.read(MEMBERS).where(F.col("reader") != reader)
    lake.replace(MEMBERS, kept.unionByName(lake.spark.createDataFrame([(reader, g) for g in groups], "reader string, group_name string")))


def create_secured_view(lake: Lake, view: str, table: str) -> None:
    """A persistent view of a table with its masks and its row filter, for every reader alike."""
    text, numeric = MASKED_COLUMNS.get(table, ([], []))
    schema = lake.name("gold")
    columns = []
    for field in lake.read(table).schema.fields:
        mask = "mask_lclid" if field.name == "LCLid" else "mask_customer_id"
        if field.name in text:
            columns.append(f"{schema}.{mask}(`{field.name}`) AS `{field.name}`")
        elif field.name in numeric:
            columns.append(f"{schema}.mask_financial_value(`{field.name}`) AS `{field.name}`")
        else:
            columns.append(f"`{field.name}`")
    rows = f"WHERE {schema}.region_filter(region)" if table in FILTERED_TABLES else ""
    lake.spark.sql(f"CREATE OR REPLACE VIEW {lake.name(view)} AS SELECT {', '.join(columns)} FROM {lake.name(table)} {rows}")
