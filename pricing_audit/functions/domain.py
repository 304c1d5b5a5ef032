"""Business rules as column expressions: variance, classes, regions, currencies, match statuses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import round_half, safe_ratio

# Class, status and band names.
NO_CONTRACT_MATCH = "NO_CONTRACT_MATCH"
WITHIN_TOLERANCE = "WITHIN_TOLERANCE"
OVERCHARGE = "OVERCHARGE"
UNDERCHARGE = "UNDERCHARGE"
ANOMALY_CLASSES = (NO_CONTRACT_MATCH, OVERCHARGE, UNDERCHARGE, WITHIN_TOLERANCE)
REVIEWED_CLASSES = (OVERCHARGE, UNDERCHARGE)

DEFAULT_REGION = "North America"
DEFAULT_CURRENCY = "USD"


def variance_pct(billed: Column, contract: Column) -> Column:
    """Unrounded percentage by which the billed price exceeds the contract price."""
    return safe_ratio(billed - contract, contract) * 100


def anomaly_class(billed: Column, contract: Column, tolerance_pct: float = 1.0) -> Column:
    """Four-way class; the tolerance band is closed, and 0 billed against 0 agreed has no class."""
    return (
        F.when(contract.isNull(), NO_CONTRACT_MATCH)
        .when(F.abs(variance_pct(billed, contract)) <= tolerance_pct, WITHIN_TOLERANCE)
        .when(billed > contract, OVERCHARGE)
        .when(billed < contract, UNDERCHARGE)
    )


def two_sided_class(billed: Column, contract: Column, tolerance_pct: float = 1.0) -> Column:
    """The shorter rule: only prices outside the band get a class."""
    pct = variance_pct(billed, contract)
    return F.when(pct > tolerance_pct, OVERCHARGE).when(pct < -tolerance_pct, UNDERCHARGE)


def _mentions(region: Column, *words: str) -> Column:
    found = [F.coalesce(F.lower(region).contains(w), F.lit(False)) for w in words]
    result = found[0]
    for f in found[1:]:
        result = result | f
    return result


def region_or_default(region: Column) -> Column:
    return F.coalesce(region, F.lit(DEFAULT_REGION))


def currency_of(region: Column) -> Column:
    return (
        F.when(_mentions(region, "griesheim", "eur"), "EUR")
        .when(_mentions(region, "singapore"), "SGD")
        .otherwise(DEFAULT_CURRENCY)
    )


def regional_price(
    region: Column, usd: Column, eur: Column, sgd: Column, method: str = "A"
) -> Column:
    """Price in the region's currency, else the USD price.

    Method B knows the euro price only for one site name, method A for any European region text.
    """
    euro_words = ("griesheim", "eur") if method == "A" else ("griesheim",)
    local = (
        F.when(_mentions(region, *euro_words), eur)
        .when(_mentions(region, "singapore"), sgd)
        .otherwise(usd)
    )
    return F.coalesce(local, usd)


def fee_price(usd: Column, eur: Column, sgd: Column, method: str = "A") -> Column:
    return F.coalesce(usd, eur, sgd) if method == "A" else F.coalesce(usd, eur)


@dataclass(frozen=True)
class Bands:
    """Tolerances of a validation: absolute, and optionally a percentage band."""

    near: float
    pct: float | None = None


PRICE_BANDS = Bands(near=0.0001, pct=1.0)
FEE_BANDS = Bands(near=0.01)


def match_status(
    got: Column, want: Column, delta: Column, delta_pct: Column, bands: Bands
) -> Column:
    """Text equality counts before numbers, so equal non-numeric texts still match exactly."""
    status = (
        F.when(want.isNull(), "NO_EXPECTED")
        .when(got == want, "EXACT_MATCH")
        .when(delta <= bands.near, "NEAR_MATCH")
    )
    if bands.pct is not None:
        status = status.when(delta_pct <= bands.pct, "WITHIN_1PCT")
    return status.otherwise("MISMATCH")


def compare_status(left: Column, right: Column, missing: bool = True) -> Column:
    """MATCH / DIFF / B_MISSING; without ``missing`` an absent right price is a difference."""
    if not missing:
        return F.when(left == right, "MATCH").otherwise("DIFF")
    return F.when(right.isNull(), "B_MISSING").when(left == right, "MATCH").otherwise("DIFF")


def match_rate(matched: Column, total: Column, unexpected: Column) -> Column:
    comparable = F.nullif(total - unexpected, F.lit(0)).cast("double")
    return round_half(F.lit(100.0) * matched.cast("double") / comparable, 1)


def quality_band(rate: Column) -> Column:
    """Traffic light of a match rate; an undefined rate counts as zero."""
    value = F.coalesce(rate, F.lit(0.0))
    return F.when(value >= 90, "GOOD").when(value >= 70, "WARN").otherwise("BAD")
