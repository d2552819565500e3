import pytest
from pyspark.sql import functions as F

from ratescape.functions.profiles import (
    ABA,
    RADIOLOGY,
    classify_codes,
    code_set_profile,
    get_profile,
    in_code_table,
    list_profiles,
    narrow_profile,
    profile_codes,
)


def codes(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "billing_code string")


def test_profiles_are_listed_and_unknown_names_fail():
    assert list_profiles() == ["aba", "radiology"]
    with pytest.raises(ValueError, match="aba, radiology"):
        get_profile("cardiology")


def test_membership_is_by_whole_code(spark):
    rows = codes(spark, "97150", "97151", "97156", "97157", "971511", "97153\n", "", None)
    kept = classify_codes(rows, "aba").collect()
    assert [r.billing_code for r in kept] == ["97151", "97156"]
    caregiver = kept[1]
    assert caregiver.service_category == "Caregiver Guidance"
    assert caregiver.aba_delivery_mode == "family/caregiver"
    assert caregiver.unit_basis == "15 minutes"
    assert caregiver.modality is None


def test_radiology_range(spark):
    rows = codes(spark, "69999", "70000", "70551", "79999", "80000", "97151", "7055A")
    kept = classify_codes(rows, "radiology").collect()
    assert [r.billing_code for r in kept] == ["70000", "70551", "79999"]
    assert {r.service_line for r in kept} == {"radiology"}
    assert {r.service_category for r in kept} == {None}
    assert profile_codes(spark, "radiology").count() == 10_000
    assert profile_codes(spark, "aba").count() == 6


@pytest.mark.parametrize(
    ("profile", "kind", "rate", "klass", "expected"),
    [
        (ABA, "negotiated", 42.5, "professional", True),
        (ABA, "negotiated", 42.5, "institutional", False),
        (ABA, "negotiated", 42.5, None, False),
        (ABA, None, 42.5, "professional", True),
        (ABA, "percentage", None, "professional", False),
        (ABA, "percentage", 42.5, "professional", False),
        (ABA, "negotiated", 1000.0, "professional", True),
        (ABA, "negotiated", 1000.01, "professional", False),
        (RADIOLOGY, "negotiated", 5000.0, "institutional", True),
        (RADIOLOGY, "negotiated", 5000.0, None, True),
        (RADIOLOGY, "negotiated", 100_001.0, "institutional", False),
    ],
)
def test_benchmark_policy(spark, profile, kind, rate, klass, expected):
    row = spark.createDataFrame([(kind, rate, klass)], "k string, r double, c string")
    flag = profile.policy.eligible(F.col("k"), F.col("r"), F.col("c"))
    assert row.select(flag.alias("x")).first().x is expected


def test_custom_code_sets(spark):
    profile = code_set_profile([" A.1 ", "97153", ""])
    rows = codes(spark, "A.1", "AX1", "97153", "97151")
    kept = rows.filter(profile.contains(F.col("billing_code"))).collect()
    assert [r.billing_code for r in kept] == ["A.1", "97153"]
    table = codes(spark, "97153", "97153", None)
    assert in_code_table(rows, table).count() == 1
    with pytest.raises(ValueError):
        code_set_profile([])


def test_narrowed_profile(spark):
    profile = narrow_profile(ABA, service_category="Direct Treatment", aba_delivery_mode="group")
    rows = codes(spark, "97153", "97154", "99213", None)
    assert [r.billing_code for r in rows.filter(profile.contains(F.col("billing_code"))).collect()] == ["97154"]
    with pytest.raises(ValueError):
        narrow_profile(ABA, modality="mri")
