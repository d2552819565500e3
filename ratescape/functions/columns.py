"""Derived columns shared by several operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratescape import reference_values as ref


def round_cents(amount: Column) -> Column:
    """Round a double to two places on its binary value."""
    return F.round(amount * F.lit(100.0)) / F.lit(100.0)


def empty_if_null(items: Column) -> Column:
    return F.coalesce(items, F.array().cast("array<string>"))


def modifiers_text(modifiers: Column) -> Column:
    return F.coalesce(F.array_join(modifiers, ","), F.lit(""))


def has_modifier(modifiers: Column, modifier: str) -> Column:
    """Null-safe containment: a null element never hides a miss."""
    return F.coalesce(F.array_contains(modifiers, modifier), F.lit(False))


def component_flags(modifiers: Column) -> dict[str, Column]:
    technical = has_modifier(modifiers, "TC")
    professional = has_modifier(modifiers, "26")
    return {
        "is_technical_component": technical,
        "is_professional_component": professional,
        "is_global": ~technical & ~professional,
    }


def rate_and_percentage(negotiated_type: Column, amount: Column) -> dict[str, Column]:
    """A price of type ``percentage`` is a percentage, any other is a rate."""
    is_percentage = negotiated_type.eqNullSafe("percentage")
    return {
        "negotiated_rate": F.when(~is_percentage, amount),
        "percentage": F.when(is_percentage, amount),
    }


def without_status_modifiers(
    modifiers: Column, excluded: Sequence[str] = ref.STATUS_MODIFIERS
) -> Column:
    """Rows free of procedure-status modifiers. A null list does not pass."""
    overlap = F.arrays_overlap(modifiers, F.array(*[F.lit(m) for m in excluded]))
    return modifiers.isNotNull() & ~F.coalesce(overlap, F.lit(False))


def plan_name(source_url: Column) -> Column:
    return F.regexp_extract(source_url, ref.PLAN_NAME_PATTERN, 1)


def is_named_plan(plan: Column) -> Column:
    return ~plan.rlike(ref.UNNAMED_PLAN_PATTERN)


def provider_name(organization: Column, first: Column, last: Column) -> Column:
    return F.coalesce(organization, F.concat_ws(" ", first, last))


def taxonomy_label(code: str, labels: Sequence[tuple[str, str]] = ref.TAXONOMY_LABELS) -> Column:
    """Label of the first matching prefix of column ``code``.

    Without a match the first ten characters stand in; null becomes ''.
    """
    cases = " ".join(
        f"WHEN startswith({code}, {quoted(prefix)}) THEN {quoted(label)}" for prefix, label in labels
    )
    return F.expr(f"CASE WHEN {code} IS NULL THEN '' {cases} ELSE substring({code}, 1, 10) END")


def is_behavior_analyst(taxonomy: Column) -> Column:
    return F.coalesce(taxonomy.startswith(ref.BCBA_PREFIX), F.lit(False))


def is_not_physician(taxonomy: Column) -> Column:
    pattern = "^(" + "|".join(ref.PHYSICIAN_PREFIXES) + ")"
    return F.coalesce(~taxonomy.rlike(pattern), F.lit(True))


def credential_filter(
    payer: str | None,
    code: str,
    modifier: str | None,
    modifiers: Column,
    conventions: Mapping[str, str] = ref.MODIFIER_CONVENTIONS,
    natural: Mapping[str, str] = ref.NATURAL_CREDENTIALS,
) -> Column | None:
    """The credential predicate in the payer's own convention; None = no filter."""
    if not modifier:
        return None
    convention = conventions.get(payer or "", "explicit")
    if convention == "none":
        return None
    if convention == "cpt_implicit" and natural.get(code) == modifier:
        return modifiers.isNull() | (F.size(modifiers) == 0)
    return has_modifier(modifiers, modifier)


def first_credential(
    candidates: Sequence[Column], credentials: Sequence[str] = ref.CREDENTIAL_MODIFIERS
) -> Column:
    """First of several modifier columns that names a credential, else ''."""
    cleaned = [F.upper(F.trim(c)) for c in candidates]
    return F.coalesce(*[F.when(c.isin(*credentials), c) for c in cleaned], F.lit(""))


def primary_taxonomy(codes: Sequence[Column], switches: Sequence[Column]) -> Column:
    """First code switched to ``Y``, else the first non-empty code, else null."""

    def filled(code: Column) -> Column:
        return F.when(F.length(code) > 0, code)

    flagged = [F.when(s == "Y", filled(c)) for c, s in zip(codes, switches, strict=True)]
    return F.coalesce(*flagged, *[filled(c) for c in codes])


def quoted(text: str) -> str:
    """Text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup(values: Mapping[str, str], key: Column) -> Column:
    """Value of a small fixed mapping; null where the key is missing."""
    entries = ", ".join(quoted(x) for pair in values.items() for x in pair)
    return F.try_element_at(F.expr(f"map({entries})"), key)


def url_path(url: Column) -> Column:
    """Path of a URL, or the text itself when it has no scheme."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    return F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")


def output_name(source: Column, profile: str) -> Column:
    """Table name for a source file: base name, known suffix off, profile on."""
    base = F.regexp_extract(F.regexp_replace(url_path(source), "/+$", ""), r"([^/]*)$", 1)
    base = F.when(base.isin("", "."), F.lit("in-network")).otherwise(base)
    stem = F.regexp_replace(base, r"(\.json\.gz|\.json|\.gz)$", "")
    return F.concat(stem, F.lit(f".{profile}.parquet"))


def source_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)


def without_dot_segments(path: Column) -> Column:
    """A path that starts with '/', its ``.`` and ``..`` steps taken; a query or fragment stays as it is."""
    steps = F.split(F.regexp_extract(path, r"^[^?#]*", 0), "/")
    last = F.element_at(steps, -1)
    steps = F.when(last.isin(".", ".."), F.concat(steps, F.array(F.lit("")))).otherwise(steps)
    taken = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done)
        .when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(step))),
    )
    return F.concat(F.array_join(taken, "/"), F.regexp_extract(path, r"[?#].*$", 0))


def absolute_url(base: str, path: Column) -> Column:
    """Resolve a file path against the folder URL ``base`` (ends with '/')."""
    origin = "/".join(base.split("/", 3)[:3])
    folder = base[len(origin) :]
    scheme = base.split(":", 1)[0]
    return (
        F.when(path.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), path)
        .when(path.startswith("//"), F.concat(F.lit(f"{scheme}:"), path))
        .when(path.startswith("/"), F.concat(F.lit(origin), without_dot_segments(path)))
        .otherwise(F.concat(F.lit(origin), without_dot_segments(F.concat(F.lit(folder), path))))
    )


def index_url(year: Column, month: Column) -> Column:
    """Monthly index address; an impossible month fails the query."""
    stamp = F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-01"))
    url = F.concat(
        F.lit(ref.INDEX_URL_HOST), year.cast("string"), F.lit("/"), stamp, F.lit(ref.INDEX_URL_TAIL)
    )
    return F.when(month.between(1, 12), url).otherwise(
        F.raise_error(F.lit("month must be between 1 and 12"))
    )


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(Column.__and__, predicates, F.lit(True))
