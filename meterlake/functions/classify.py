"""Category rules: tariffs, severities and normalisation with a fallback."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results must carry exactly these names, ids and rates.
EVENT_TYPES = ["MAGNETIC_INTERFERENCE", "COVER_REMOVAL", "REVERSE_ENERGY_FLOW", "SEAL_BROKEN", "POWER_OUTAGE"]
SEVERITY_RULES = [(("MAGNETIC_INTERFERENCE", "COVER_REMOVAL"), "CRITICAL"), (("REVERSE_ENERGY_FLOW",), "HIGH")]
SEVERITY_DEFAULT = "MEDIUM"
KNOWN_SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
UNKNOWN = "UNKNOWN"
# tariff name -> (key, id, description, rate per kWh)
TARIFFS = {
    "Normal": (1, "TAR001", "Standard rate tariff", 0.15),
    "Low": (2, "TAR002", "Off-peak low rate tariff", 0.08),
    "High": (3, "TAR003", "Peak high rate tariff", 0.25),
}
OTHER_TARIFF = (0, "TAR000", "Unknown tariff type", 0.0)
FLAT_CLASS = "Std"
FLAT_RATE = 0.15
FLAT_CLASS_TARIFF = "TAR001"
OTHER_CLASS_TARIFF = "TAR002"


def classify(c: Column, rules: list[tuple[tuple[str, ...], object]], default: object) -> Column:
    """First rule whose members contain the value wins, else ``default``."""
    chain = F
    for members, outcome in rules:
        chain = chain.when(c.isin(*members), F.lit(outcome))
    return chain.otherwise(F.lit(default))


def severity(event_type: Column) -> Column:
    return classify(event_type, SEVERITY_RULES, SEVERITY_DEFAULT)


def known_or(c: Column, members: tuple[str, ...] = KNOWN_SEVERITIES, fallback: str = UNKNOWN) -> Column:
    """The value when it is a known category, else the fallback; NULL falls back too."""
    return F.when(c.isin(*members), c).otherwise(F.lit(fallback))


def tariff_attribute(name: Column, position: int) -> Column:
    """One attribute of the tariff a name stands for: 0 key, 1 id, 2 description, 3 rate."""
    rules = [((tariff,), values[position]) for tariff, values in TARIFFS.items()]
    return classify(name, rules, OTHER_TARIFF[position])


def tariff_class(customer_type: Column, null_safe: bool = False) -> Column:
    """Tariff id of a customer class.  By default NULL is treated as not flat; ``null_safe`` treats it as flat."""
    flat = customer_type == FLAT_CLASS
    if null_safe:
        flat = flat | customer_type.isNull()
    return F.when(flat, F.lit(FLAT_CLASS_TARIFF)).otherwise(F.lit(OTHER_CLASS_TARIFF))
