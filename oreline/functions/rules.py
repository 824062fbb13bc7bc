"""Business rules: bands, tiers, statuses and flags."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and limits of the bands, in natural order.
GENDERS = ["Male", "Female", "Other"]
AGE_EDGES = [0, 18, 35, 50, 65, 200]
AGE_LABELS = ["0-18", "19-35", "36-50", "51-65", "65+"]
STAY_LIMITS = [(1, "Same Day"), (3, "Short (1-3d)"), (7, "Medium (4-7d)"), (14, "Long (8-14d)")]
STAY_ABOVE, STAY_UNKNOWN = "Extended (15d+)", "Unknown"
TIER_LIMITS = [(10000, "Low (<10K)"), (50000, "Medium (10K-50K)"), (100000, "High (50K-1L)")]
TIER_ABOVE = "Premium (>1L)"
OCCUPANCY_LIMITS = [(95, "Critical"), (80, "High"), (60, "Moderate")]
OCCUPANCY_BELOW = "Low"
REJECT_DATE_ORDER = "discharge_before_admission"
AMOUNT_TOLERANCE = 1
PARTIAL_SHARE = Decimal("0.5")
# Share of a bill each payer covers, and the split of a bill into components.
PAYER_SHARE = {
    "Star Health": Decimal("0.80"),
    "HDFC Ergo": Decimal("0.75"),
    "New India": Decimal("0.70"),
    "Bajaj Allianz": Decimal("0.65"),
    "Self-Pay": Decimal("0.00"),
    "Government": Decimal("0.90"),
}
COMPONENT_SHARE = {
    "room_charges": Decimal("0.35"),
    "medicine_charges": Decimal("0.25"),
    "procedure_charges": Decimal("0.30"),
    "misc_charges": Decimal("0.10"),
}


def half_open_bins(col: Column, edges: list[int], labels: list[str]) -> Column:
    """Label of the bin [edge, next edge) the value lies in; NULL outside all of them."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(edges, edges[1:], labels))):
        label = F.when((col >= low) & (col < high), F.lit(name)).otherwise(label)
    return label


def age_band(age: Column) -> Column:
    return half_open_bins(age, AGE_EDGES, AGE_LABELS)


def _first_match(pairs: list[tuple[Column, str]], default: str) -> Column:
    label = F.lit(default)
    for condition, name in reversed(pairs):
        label = F.when(condition, F.lit(name)).otherwise(label)
    return label


def stay_category(days: Column) -> Column:
    known = [(days <= limit, name) for limit, name in STAY_LIMITS]
    return _first_match([(days.isNull(), STAY_UNKNOWN), *known], STAY_ABOVE)


def revenue_tier(amount: Column) -> Column:
    """NULL compares false everywhere and so falls to the last tier."""
    return _first_match([(amount < limit, name) for limit, name in TIER_LIMITS], TIER_ABOVE)


def occupancy_status(rate: Column) -> Column:
    """NULL compares false everywhere and so falls to the last status."""
    return _first_match([(rate >= limit, name) for limit, name in OCCUPANCY_LIMITS], OCCUPANCY_BELOW)


def outstanding(status: Column, payable: Column) -> Column:
    """What the patient still owes: nothing if paid, half if partly paid, else all of it."""
    owed = (
        F.when(status == "Paid", F.lit(0))
        .when(status == "Partial", payable * F.lit(PARTIAL_SHARE))
        .otherwise(payable)
    )
    return owed.cast("decimal(18,3)")


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def high_risk(bed_type: Column, readmission: Column) -> Column:
    return F.greatest(flag(bed_type == "ICU"), flag(readmission == 1))


def payer_share(insurance: Column, shares: Mapping[str, Decimal] = PAYER_SHARE) -> Column:
    """Covered share by payer, 0 for any other."""
    share = F.lit(Decimal("0.00"))
    for payer, value in shares.items():
        share = F.when(insurance == payer, F.lit(value)).otherwise(share)
    return share
