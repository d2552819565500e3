"""Filtered rows and grouped rate summaries over the rate table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescape.functions.columns import all_of, without_status_modifiers
from ratescape.functions.ranks import quantile_statistics, value_counts

# Columns one may filter on, and group or project by.
FILTER_COLUMNS = (
    "service_line",
    "billing_code",
    "service_category",
    "payer_name",
    "modality",
    "body_region",
    "billing_class",
    "negotiated_type",
    "setting",
)
GROUP_COLUMNS = (
    *FILTER_COLUMNS,
    "service_subcategory",
    "aba_delivery_mode",
    "aba_provider_role",
    "is_benchmark_eligible",
)
ROW_COLUMNS = (
    "payer_name",
    "billing_code",
    "service_category",
    "negotiated_rate",
    "billing_class",
    "setting",
    "negotiated_type",
    "is_benchmark_eligible",
    "provider_tin_value",
)
MAX_LIMIT = 10_000


def column_list(text: str | Sequence[str] | None) -> list[str]:
    """Column names from comma-separated text or a sequence, checked."""
    parts = text.split(",") if isinstance(text, str) else list(text or [])
    columns = [part.strip() for part in parts if part.strip()]
    unknown = sorted(set(columns) - set(GROUP_COLUMNS))
    if unknown:
        choices = ", ".join(sorted(GROUP_COLUMNS))
        raise ValueError(f"unsupported column(s) {', '.join(unknown)}; choose from: {choices}")
    return columns


def clamp_limit(limit: int) -> int:
    """The row limit of a page that a user may ask for; callers that want it pass its result."""
    return max(1, min(limit, MAX_LIMIT))


def first_rows(rows: DataFrame, limit: int | None) -> DataFrame:
    """All rows, or the first ``limit`` of them, one at least."""
    return rows if limit is None else rows.limit(max(1, limit))


def rate_predicate(**filters) -> Column:
    """AND of the filters of :func:`group_predicate`; status modifiers are always left out."""
    return group_predicate(**filters) & without_status_modifiers(F.col("billing_code_modifiers"))


def group_predicate(
    *,
    service_line: str | None = None,
    cpt: str | None = None,
    service_category: str | None = None,
    payer: str | None = None,
    modality: str | None = None,
    body_region: str | None = None,
    billing_class: str | None = None,
    negotiated_type: str | None = None,
    benchmark_eligible: bool = False,
    min_rate: float | None = None,
    max_rate: float | None = None,
) -> Column:
    """AND of the given filters, all on columns that a value table has."""
    equal = {
        "service_line": service_line,
        "billing_code": cpt,
        "service_category": service_category,
        "payer_name": payer,
        "modality": modality,
        "body_region": body_region,
        "billing_class": billing_class,
        "negotiated_type": negotiated_type,
    }
    tests = [F.col(name) == value for name, value in equal.items() if value is not None]
    if min_rate is not None:
        tests.append(F.col("negotiated_rate") >= float(min_rate))
    if max_rate is not None:
        tests.append(F.col("negotiated_rate") <= float(max_rate))
    if benchmark_eligible:
        tests.append(F.col("is_benchmark_eligible"))
    return all_of(tests)


def summarize(rates: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Count, bounds, quartiles and mean of ``negotiated_rate`` per group."""
    return _summary(value_counts(rates, list(dict.fromkeys(group_by)), "negotiated_rate"), group_by)


def _summary(counts: DataFrame, group_by: Sequence[str]) -> DataFrame:
    keys = list(dict.fromkeys(group_by))
    stats = quantile_statistics(
        counts,
        keys,
        "negotiated_rate",
        {"p25_rate": 0.25, "median_rate": 0.5, "p75_rate": 0.75},
    )
    return stats.select(
        *keys,
        "row_count",
        F.col("min_value").alias("min_rate"),
        "p25_rate",
        "median_rate",
        "p75_rate",
        F.col("max_value").alias("max_rate"),
        F.col("mean_value").alias("avg_rate"),
    )


def value_table(rates: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """How often each ``negotiated_rate`` occurs per group of all group columns (and ``more``): what summaries need of the rates.

    Rows add up, so tables of parts of the rates may simply be put together.
    """
    kept = rates.filter(without_status_modifiers(F.col("billing_code_modifiers")))
    return value_counts(kept, [*more, *GROUP_COLUMNS], "negotiated_rate")


def run_summary(values: DataFrame, *, group_by: str | Sequence[str] | None = None, limit: int | None = None, **filters) -> DataFrame:
    """``run_query(..., summary=True)`` from a value table, exactly and without the rates."""
    columns = column_list(group_by)
    counts = values.filter(group_predicate(**filters)).groupBy(*dict.fromkeys(columns), "negotiated_rate").agg(F.sum("n").alias("n"))
    ordered = [F.col(c).asc_nulls_last() for c in columns]
    result = _summary(counts, columns)
    return first_rows(result.orderBy(*ordered) if ordered else result, limit)


def run_query(
    rates: DataFrame,
    *,
    group_by: str | Sequence[str] | None = None,
    summary: bool = False,
    limit: int | None = None,
    stable: bool = False,
    **filters,
) -> DataFrame:
    """Rows or a grouped summary of the rates that pass ``filters``.

    Filters are those of :func:`rate_predicate`. Everything is returned unless
    ``limit`` is given (one row at least). Row listings then stop reading as soon as ``limit`` rows are found; ``stable=True`` instead returns the first
    rows in the order of the listed columns, which has to read every match.
    """
    columns = column_list(group_by)
    selected = rates.filter(rate_predicate(**filters))
    if summary:
        ordered = [F.col(c).asc_nulls_last() for c in columns]
        result = summarize(selected, columns)
        return first_rows(result.orderBy(*ordered) if ordered else result, limit)
    rows = selected.select(*(columns or ROW_COLUMNS))
    if stable:
        rows = rows.orderBy(*[F.col(c).asc_nulls_last() for c in rows.columns])
    return first_rows(rows, limit)


def sort_rows(rows: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Order by one column in either direction; nulls come last both ways."""
    key = F.col(column)
    return rows.orderBy(key.desc_nulls_last() if descending else key.asc_nulls_last())


def raw_and_benchmark(
    rates: DataFrame,
    group_by: str | Sequence[str] = "billing_code,service_category",
    limit: int | None = None,
    **filters,
) -> DataFrame:
    """Groups and rows with and without the benchmark filter, one row per view.

    One aggregation carries both counts. With a ``limit``, each view looks at its
    first groups only, as its summary would list them.
    """
    keys = list(dict.fromkeys(column_list(group_by)))
    groups = (
        rates.filter(rate_predicate(**filters))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("raw"),
            F.count_if(F.col("is_benchmark_eligible")).alias("benchmark"),
        )
    )
    order = [F.col(c).asc_nulls_last() for c in keys]
    views = [
        first_rows(groups.filter(F.col(view) > 0).orderBy(*order), limit)
        .agg(
            F.count(F.lit(1)).alias("group_count"),
            F.coalesce(F.sum(view), F.lit(0)).alias("row_total"),
        )
        .select(F.lit(view).alias("view"), "group_count", "row_total")
        for view in ("raw", "benchmark")
    ]
    return views[0].unionByName(views[1])


def facets(rates: DataFrame, payers: Sequence[str] | None = None) -> DataFrame:
    """Distinct codes, payers and modifiers in one pass, as (facet, value).

    Rows are reduced to distinct combinations before lists are opened.
    ``payers`` narrows the payer facet to a known list.
    """
    seen = rates.select("payer_name", "billing_code", "billing_code_modifiers").distinct()
    listed = F.lit(True) if payers is None else F.col("payer_name").isin(*payers)
    entries = F.expr(
        """concat(
            array(struct('payer_names' AS facet, listed_payer AS value),
                  struct('cpt_codes' AS facet, billing_code AS value)),
            transform(coalesce(billing_code_modifiers, CAST(array() AS array<string>)),
                      m -> struct('modifiers' AS facet, m AS value)))"""
    )
    return (
        seen.withColumn("listed_payer", F.when(listed, F.col("payer_name")))
        .select(F.explode(entries).alias("e"))
        .select("e.facet", "e.value")
        .filter(F.col("value") != "")
        .distinct()
        .orderBy("facet", "value")
    )


def file_inventory(rates: DataFrame) -> DataFrame:
    """Rows, payer and schema version per source file."""
    return rates.groupBy("source_file_url").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max("payer_name").alias("payer_name"),
        F.max("schema_version").alias("schema_version"),
    )
