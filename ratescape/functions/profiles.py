"""Service-line code profiles as Column expressions.

A profile is a code pattern, a classification and a benchmark policy. All
three stay inside whole-stage code generation: no join is needed to filter or
classify, so the code filter runs directly after the first explode.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape.functions.columns import lookup
from ratescape.schemas import CLASSIFICATION_COLUMNS


@dataclass(frozen=True)
class BenchmarkPolicy:
    max_rate: float | None = None
    allowed_billing_classes: tuple[str, ...] | None = None
    allow_percentage: bool = False

    def eligible(self, negotiated_type: Column, negotiated_rate: Column, billing_class: Column) -> Column:
        """True/false, never null. A null type passes; a null class does not."""
        tests = [negotiated_rate.isNotNull()]
        if not self.allow_percentage:
            tests.append(~negotiated_type.eqNullSafe("percentage"))
        if self.allowed_billing_classes is not None:
            tests.append(F.coalesce(billing_class.isin(*self.allowed_billing_classes), F.lit(False)))
        if self.max_rate is not None:
            tests.append(F.coalesce(negotiated_rate <= float(self.max_rate), F.lit(False)))
        return reduce(Column.__and__, tests)


@dataclass(frozen=True)
class CodeProfile:
    """``pattern`` must match a whole code, or ``codes`` have it; ``attributes`` maps code -> values."""

    name: str
    pattern: str
    policy: BenchmarkPolicy
    attributes: dict[str, dict[str, str]] = field(default_factory=dict)
    codes: frozenset[str] = frozenset()

    @property
    def wanted(self) -> str | frozenset[str]:
        return self.codes or self.pattern

    def contains(self, code: Column) -> Column:
        if self.codes:
            return F.coalesce(code.isin(*sorted(self.codes)), F.lit(False))
        return F.coalesce(code.rlike(rf"\A(?:{self.pattern})\z"), F.lit(False))

    def classify(self, code: Column) -> dict[str, Column]:
        """Classification columns of a code; all null outside the profile."""
        inside = self.contains(code)
        columns = {}
        for name in CLASSIFICATION_COLUMNS:
            if name == "service_line":
                columns[name] = F.when(inside, F.lit(self.name))
                continue
            by_code = {c: a[name] for c, a in self.attributes.items() if name in a}
            if not by_code:
                columns[name] = F.lit(None).cast("string")
                continue
            columns[name] = lookup(by_code, code)
        return columns


def _aba(category: str, subcategory: str, mode: str, role: str) -> dict[str, str]:
    return {
        "service_category": category,
        "service_subcategory": subcategory,
        "unit_basis": "15 minutes",
        "aba_delivery_mode": mode,
        "aba_provider_role": role,
    }


# Adaptive-behaviour codes and their attributes.
ABA_ATTRIBUTES = {
    "97151": _aba("Assessment", "behavior_identification", "individual", "qualified_professional"),
    "97152": _aba("Assessment", "supporting_assessment", "individual", "technician"),
    "97153": _aba("Direct Treatment", "protocol_treatment", "individual", "technician"),
    "97154": _aba("Direct Treatment", "group_protocol_treatment", "group", "technician"),
    "97155": _aba(
        "Supervision/Protocol Modification", "protocol_modification", "individual", "mixed_or_supervisory"
    ),
    "97156": _aba(
        "Caregiver Guidance", "family_caregiver_guidance", "family/caregiver", "qualified_professional"
    ),
}

ABA = CodeProfile(
    name="aba",
    pattern="9715[1-6]",
    policy=BenchmarkPolicy(max_rate=1_000, allowed_billing_classes=("professional",)),
    attributes=ABA_ATTRIBUTES,
)

RADIOLOGY = CodeProfile(
    name="radiology",
    pattern="7[0-9]{4}",
    policy=BenchmarkPolicy(max_rate=100_000),
)

PROFILES = {profile.name: profile for profile in (ABA, RADIOLOGY)}


def list_profiles() -> list[str]:
    return sorted(PROFILES)


def get_profile(name: str) -> CodeProfile:
    if name not in PROFILES:
        raise ValueError(f"no code profile {name!r}; choose from: {', '.join(list_profiles())}")
    return PROFILES[name]


def code_set_profile(codes: Sequence[str], policy: BenchmarkPolicy | None = None) -> CodeProfile:
    """A profile of a user's own code list; it has no classification.

    The list is part of the plan; for codes in a table use :func:`in_code_table`.
    """
    unique = frozenset(code.strip() for code in codes if code.strip())
    if not unique:
        raise ValueError("a code list has at least one code")
    return CodeProfile("custom_code_set", "", policy or BenchmarkPolicy(), codes=unique)


def narrow_profile(profile: CodeProfile, **values: str) -> CodeProfile:
    """The profile's codes with the given classification values, such as ``service_category`` or ``modality``.

    Other codes are left out when a file is parsed.
    """
    kept = {c: a for c, a in profile.attributes.items() if all(a.get(n) == v for n, v in values.items())}
    if not kept:
        raise ValueError(f"no code of {profile.name} has {values}")
    return replace(profile, attributes=kept, codes=frozenset(kept))


def in_code_table(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows whose ``billing_code`` is in a code table of any size."""
    return rows.join(codes.select("billing_code"), "billing_code", "left_semi")


def profile_codes(spark: SparkSession, name: str) -> DataFrame:
    """The codes of a profile with their classification, as a small table."""
    profile = get_profile(name)
    codes = spark.range(100_000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("billing_code"))
    return classify_codes(codes, name)


def classify_codes(codes: DataFrame, profile_name: str) -> DataFrame:
    """Keep the rows whose ``billing_code`` is in the profile and classify them."""
    profile = get_profile(profile_name)
    code = F.col("billing_code")
    return codes.filter(profile.contains(code)).withColumns(profile.classify(code))
