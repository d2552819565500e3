"""The same results in SQL, one statement per query of ``workload.queries``.

Written against the benchmark tables only; nothing here uses the library's
expressions. ``{...}`` parts are shared table expressions.
"""

from __future__ import annotations

from ratescape import reference_values as ref


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


LINES = f"""
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, r_regionkey, p_name,
    CASE r_regionkey WHEN 0 THEN 'Blue Shield of California'
      WHEN 1 THEN 'Anthem Blue Cross California'
      WHEN 2 THEN 'Blue Cross and Blue Shield of Texas'
      WHEN 3 THEN 'United HealthCare Services, Inc.' ELSE r_name END AS payer_name,
    'https://example.test/2026-05-01_' || n_nationkey || '-' ||
      CASE WHEN n_nationkey % 5 = 0 THEN '77'
        WHEN n_nationkey % 5 = 1 THEN 'Blue-Shield-of-California'
        WHEN l_partkey % 16 < 13 THEN {_list(ref.PLAN_LABELS)}[l_partkey % 16 + 1]
        ELSE 'Plan-' || p_type END || '_Blue-Shield-' || n_name || '.json.gz' AS source_file_url,
    CASE WHEN l_partkey % 10 <= 5 THEN CAST(97151 + l_partkey % 10 AS VARCHAR)
      WHEN l_partkey % 10 = 6 THEN '97157'
      WHEN l_partkey % 10 = 7 THEN CAST(70000 + l_partkey % 10000 AS VARCHAR)
      WHEN l_partkey % 10 = 8 THEN '99213' ELSE '70551' END AS billing_code,
    CASE WHEN l_linestatus = 'O' THEN 'professional' ELSE 'institutional' END AS billing_class,
    CASE WHEN l_linenumber % 2 = 1 THEN 'office' ELSE 'inpatient' END AS setting,
    CASE WHEN l_returnflag = 'A' THEN 'negotiated' WHEN l_returnflag = 'N' THEN 'fee schedule'
      WHEN l_linenumber % 2 = 0 THEN 'percentage' ELSE 'per diem' END AS negotiated_type,
    floor(l_extendedprice / l_quantity) / CAST(4 AS DOUBLE) AS raw_rate,
    CAST(10 + l_linenumber AS VARCHAR) AS service_codes,
    CASE l_linenumber WHEN 1 THEN CAST([] AS VARCHAR[]) WHEN 2 THEN ['HM'] WHEN 3 THEN ['HN', 'GT']
      WHEN 4 THEN ['HO'] WHEN 5 THEN ['TC'] WHEN 6 THEN ['26'] WHEN 7 THEN ['53'] END
      AS billing_code_modifiers,
    CASE WHEN l_orderkey % 17 = 0 THEN CAST([] AS VARCHAR[]) ELSE
      [CAST(1000000000 + l_suppkey AS VARCHAR), CAST(1000000000 + l_partkey % 10 AS VARCHAR)] END
      AS provider_npi_list,
    lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS provider_tin_value
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

CLASSES = """
classes(code, service_category, service_subcategory, aba_delivery_mode, aba_provider_role) AS (VALUES
  ('97151', 'Assessment', 'behavior_identification', 'individual', 'qualified_professional'),
  ('97152', 'Assessment', 'supporting_assessment', 'individual', 'technician'),
  ('97153', 'Direct Treatment', 'protocol_treatment', 'individual', 'technician'),
  ('97154', 'Direct Treatment', 'group_protocol_treatment', 'group', 'technician'),
  ('97155', 'Supervision/Protocol Modification', 'protocol_modification', 'individual',
    'mixed_or_supervisory'),
  ('97156', 'Caregiver Guidance', 'family_caregiver_guidance', 'family/caregiver',
    'qualified_professional')
)"""

IS_RADIOLOGY = "(length(billing_code) = 5 AND billing_code BETWEEN '70000' AND '79999')"

RATES = f"""{LINES}, {CLASSES},
priced AS (
  SELECT *, CASE WHEN negotiated_type <> 'percentage' THEN raw_rate END AS negotiated_rate,
    CASE WHEN negotiated_type = 'percentage' THEN raw_rate END AS percentage
  FROM lines
),
rates AS (
  SELECT priced.*, classes.* EXCLUDE (code),
    CASE WHEN code IS NOT NULL THEN 'aba' WHEN {IS_RADIOLOGY} THEN 'radiology' END AS service_line,
    CASE WHEN code IS NOT NULL THEN '15 minutes' END AS unit_basis,
    NOT list_has_any(billing_code_modifiers, ['TC', '26']) AS is_global,
    CASE WHEN code IS NOT NULL THEN negotiated_rate IS NOT NULL AND billing_class = 'professional'
        AND negotiated_rate <= 1000
      WHEN {IS_RADIOLOGY} THEN negotiated_rate IS NOT NULL AND negotiated_rate <= 100000
      ELSE FALSE END AS is_benchmark_eligible
  FROM priced LEFT JOIN classes ON billing_code = code
)"""

NAMES = """
names AS (
  SELECT CAST(CASE WHEN s_suppkey % 5 = 0 THEN 2000000000 ELSE 1000000000 END + s_suppkey AS VARCHAR) AS npi,
    CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS organization_name,
    CASE WHEN s_suppkey % 2 = 1 THEN 'Pat' END AS first_name,
    CASE WHEN s_suppkey % 2 = 1 THEN s_name END AS last_name,
    ['103K00000X', '103TC0700X', '207Q00000X', '1041C0700X', '363LP0808X', NULL, '106H00000X',
      '999ZZZZZZZZZZ'][s_suppkey % 8 + 1] AS primary_taxonomy
  FROM supplier
)"""

NAME = "COALESCE(n.organization_name, CONCAT_WS(' ', n.first_name, n.last_name))"
NO_STATUS = "NOT list_has_any(billing_code_modifiers, ['53', '55', '56'])"
SUMMARY = """CAST(count(*) AS BIGINT) AS row_count, min(negotiated_rate) AS min_rate,
  quantile_cont(negotiated_rate, 0.25) AS p25_rate, median(negotiated_rate) AS median_rate,
  quantile_cont(negotiated_rate, 0.75) AS p75_rate, max(negotiated_rate) AS max_rate,
  avg(negotiated_rate) AS avg_rate"""
ROWS = """payer_name, billing_code, service_category, negotiated_rate, billing_class, setting,
  negotiated_type, is_benchmark_eligible, provider_tin_value"""
ROWS_ORDER = """payer_name NULLS LAST, billing_code NULLS LAST, service_category NULLS LAST,
  negotiated_rate NULLS LAST, billing_class NULLS LAST, setting NULLS LAST, negotiated_type NULLS LAST,
  is_benchmark_eligible NULLS LAST, provider_tin_value NULLS LAST"""


def _details(table: str) -> str:
    """Classification and component columns of a rate."""
    return f"""service_subcategory, unit_basis, CAST(NULL AS VARCHAR) AS modality,
      CAST(NULL AS VARCHAR) AS body_region, CAST(NULL AS VARCHAR) AS with_contrast, aba_delivery_mode,
      aba_provider_role, list_contains({table}.billing_code_modifiers, 'TC') AS is_technical_component,
      list_contains({table}.billing_code_modifiers, '26') AS is_professional_component"""


def _with(body: str, *tables: str) -> str:
    return f"WITH {', '.join(tables)} {body}"


def _rates(body: str) -> str:
    return _with(body, RATES)


# --- rate files -----------------------------------------------------------

DOCS = f"""{RATES},
docs AS (
  SELECT *, l_orderkey // 4096 AS block,
    'r' || r_regionkey || '-b' || (l_orderkey // 4096) AS source,
    l_suppkey % 2 = 1 AS has_ref, l_suppkey % 2 = 0 OR l_linenumber = 3 AS has_inline,
    l_suppkey % 2 = 1 AND r_regionkey = 4 AND (l_orderkey // 4096) % 2 = 0 AND l_suppkey % 10 = 9
      AS ref_is_missing
  FROM rates
),
codes AS (SELECT DISTINCT source, billing_code, service_line = 'aba' AS is_aba FROM docs),
missing AS (
  SELECT DISTINCT source, CAST(l_suppkey AS VARCHAR) AS ref_id FROM docs
  WHERE ref_is_missing AND service_line = 'aba'
),
flat AS (
  SELECT *, array_to_string(provider_npi_list, ',') AS npis, 'ein' AS tin_type,
    provider_tin_value AS tin_value FROM docs WHERE has_inline
  UNION ALL
  SELECT *, CAST(1000000000 + l_suppkey AS VARCHAR), 'npi', 'R' || l_suppkey
  FROM docs WHERE has_ref AND NOT ref_is_missing
)"""


def _flat(index_payer: str, where: str, table: str = "flat") -> str:
    return f"""SELECT {index_payer} AS index_payer, payer_name,
      'Health Insurance Issuer' AS reporting_entity_type, source AS source_file_url,
      '2026-05-01' AS last_updated_on, '2.0.0' AS schema_version, billing_code,
      'CPT' AS billing_code_type, '2026' AS billing_code_type_version,
      'Service ' || billing_code AS name, 'Service ' || billing_code AS description,
      service_line, service_category, 'ffs' AS negotiation_arrangement, billing_class, setting,
      negotiated_type, negotiated_rate, percentage, '2026-12-31' AS expiration_date, service_codes,
      array_to_string(billing_code_modifiers, ',') AS billing_code_modifiers, is_global,
      is_benchmark_eligible, npis AS provider_npi_list, tin_type AS provider_tin_type,
      tin_value AS provider_tin_value, CAST(NULL AS VARCHAR) AS additional_information,
      {_details(table)}
    FROM {table} WHERE {where}"""


REMOTE = """
remote AS (
  SELECT *, l_suppkey % 4 = 1 AND NOT ref_is_missing AS is_remote, l_suppkey // 20 AS ref_block FROM docs WHERE has_ref
),
groups AS (SELECT s_suppkey, s_suppkey // 20 AS group_block FROM supplier
  WHERE s_suppkey % 4 = 1 AND (s_suppkey // 20) % 7 NOT IN (2, 3, 5)),
flat_remote AS (
  SELECT *, array_to_string(provider_npi_list, ',') AS npis, 'ein' AS tin_type,
    provider_tin_value AS tin_value FROM docs WHERE has_inline
  UNION ALL
  SELECT * EXCLUDE (is_remote, ref_block), CAST(1000000000 + l_suppkey AS VARCHAR), 'npi', 'R' || l_suppkey
  FROM remote WHERE NOT is_remote AND NOT ref_is_missing
  UNION ALL
  SELECT * EXCLUDE (is_remote, ref_block, s_suppkey, group_block), CAST(1000000000 + s_suppkey AS VARCHAR), 'npi', 'R' || s_suppkey
  FROM remote JOIN groups ON ref_block = group_block WHERE is_remote
),
unresolved AS (
  SELECT DISTINCT source, CAST(l_suppkey AS VARCHAR) AS ref_id,
    CASE WHEN is_remote THEN 'https://example.test/refs/' || ref_block || '.json.gz' END AS location,
    CASE WHEN NOT is_remote THEN NULL WHEN ref_block % 7 = 3 THEN 'FileNotFoundError' ELSE 'ValueError' END AS error_type,
    CASE WHEN NOT is_remote THEN NULL WHEN ref_block % 7 = 3 THEN 'no file is listed for this location'
      ELSE 'the document ends too early' END AS error
  FROM remote WHERE service_line = 'aba' AND (ref_is_missing OR is_remote AND ref_block % 7 IN (3, 5))
)"""
FLAT_ABA = _with(
    _flat("'payer-index'", "service_line = 'aba' AND source NOT IN (SELECT source FROM missing)"), DOCS
)
COUNTERS = """
  counters AS (
    SELECT c.source, c.scanned_items, c.matched_items, CAST(COALESCE(f.n, 0) AS BIGINT) AS rows_written
    FROM (SELECT source, CAST(count(*) + 1 AS BIGINT) AS scanned_items,
        CAST(count(*) FILTER (WHERE is_aba) AS BIGINT) AS matched_items FROM codes GROUP BY source) c
      LEFT JOIN (SELECT source, count(*) AS n FROM flat WHERE service_line = 'aba'
        AND source NOT IN (SELECT source FROM missing) GROUP BY source) f ON c.source = f.source
  )"""


def _probe(first: bool) -> str:
    if first:
        scanned = "COALESCE(min(place) FILTER (WHERE is_aba AND place <= 2000), least(max(place) + 1, 2000))"
        matched = "COALESCE(min(billing_code) FILTER (WHERE is_aba AND place <= 2000), '')"
    else:
        scanned = "least(max(place) + 1, 2000)"
        matched = (
            "COALESCE(string_agg(billing_code, ',' ORDER BY billing_code)"
            " FILTER (WHERE is_aba AND place <= 2000), '')"
        )
    return f"""SELECT source, 'ok' AS status, CAST({scanned} AS BIGINT) AS items_scanned,
      count(*) FILTER (WHERE is_aba AND place <= 2000) > 0 AS has_match, {matched} AS matched_codes,
      CAST(NULL AS VARCHAR) AS error
    FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CAST(billing_code AS BIGINT)) AS place
      FROM codes) GROUP BY source"""


# --- indexes --------------------------------------------------------------

TOC = """
structures AS (
  SELECT 'toc-' || (l_orderkey // 4096) AS source, l_partkey, l_suppkey, l_linenumber, p_name,
    row_number() OVER (PARTITION BY l_orderkey // 4096
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS structure_ord,
    CAST(1 + l_suppkey % 3 AS BIGINT) AS reporting_plan_count
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
files AS (
  SELECT source, structure_ord, CAST(0 AS BIGINT) AS file_ord, l_suppkey,
    'https://example.test/files/in-network-' || l_partkey || '.json.gz' AS location,
    CASE WHEN l_linenumber % 3 <> 0 THEN p_name END AS description, reporting_plan_count
  FROM structures
  UNION ALL
  SELECT source, structure_ord, 1, l_suppkey,
    'https://example.test/files/regional-' || l_suppkey || '.json.gz', 'regional', reporting_plan_count
  FROM structures WHERE l_linenumber NOT IN (6, 7)
)"""

TOC_FILES = _with(
    "SELECT source, structure_ord, file_ord, location, description, reporting_plan_count FROM files", TOC
)
DEDUPED = """SELECT location, arg_min(description, (source, structure_ord, file_ord))
    FILTER (WHERE description IS NOT NULL) AS description,
  CAST(NULL AS BIGINT) AS content_length_bytes,
  CAST(sum(reporting_plan_count) AS BIGINT) AS reporting_plan_count
FROM files GROUP BY location"""

VENDOR = """
entries AS (
  SELECT 'vendor-' || (o_orderkey // 4096) AS source, o_orderkey, o_custkey,
    o_orderstatus <> 'P' AS is_rates,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'file ' || o_orderkey END AS description,
    CASE o_custkey % 4 WHEN 0 THEN 'https://cdn.example.test/' WHEN 1 THEN '/root/' ELSE 'sub/' END
      || 'rates-' || o_custkey || '.json.gz' AS path,
    CASE o_custkey % 4 WHEN 0 THEN 'https://cdn.example.test/'
      WHEN 1 THEN 'https://egress.example.test/root/'
      ELSE 'https://egress.example.test/payer/latest/sub/' END
      || 'rates-' || o_custkey || '.json.gz' AS location,
    1 + o_orderkey % 4 AS plans
  FROM orders
)"""

MANIFEST = """
manifest AS (
  SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'succeeded' WHEN 1 THEN 'failed' ELSE 'skipped' END
      AS status,
    'https://example.test/files/p' || p_partkey || '.json.gz?sig=x' AS source,
    CAST(NULL AS VARCHAR) AS out_path, 'aba' AS profile,
    CASE WHEN p_partkey % 4 > 1 THEN 'file_too_large' END AS reason,
    CAST(p_size * 100000 AS BIGINT) AS content_length_bytes, CAST(NULL AS BIGINT) AS max_size_bytes,
    CASE WHEN p_partkey % 4 = 0 THEN p_partkey + 2 END AS scanned_items,
    CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 3 END AS matched_items,
    CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 50 END AS rows_written,
    CASE WHEN p_partkey % 4 = 1 THEN 'ValueError' END AS error_type, CAST(NULL AS VARCHAR) AS error
  FROM part
)"""

# --- providers ------------------------------------------------------------


def _benchmark(extra: str = "", types: str = "'fee schedule', 'per diem', 'negotiated'") -> str:
    return f"""WHERE billing_code = '97153' AND billing_class = 'professional'
      AND negotiated_type IN ({types}) AND negotiated_rate IS NOT NULL {extra}"""


NOT_PHYSICIAN = "(n.primary_taxonomy IS NULL OR NOT (" + " OR ".join(
    f"starts_with(n.primary_taxonomy, '{p}')" for p in ref.PHYSICIAN_PREFIXES
) + "))"


def _label(code: str) -> str:
    cases = " ".join(f"WHEN starts_with({code}, '{p}') THEN '{t}'" for p, t in ref.TAXONOMY_LABELS)
    return f"CASE WHEN {code} IS NULL THEN '' {cases} ELSE substr({code}, 1, 10) END"


#: A rate counts for every provider it lists.
LISTED = "listed AS (SELECT rates.*, provider.npi FROM rates, unnest(provider_npi_list) AS provider(npi))"
SPREAD = "round(quantile_cont(r, 0.5), 2) AS median_rate, min(r) AS min_rate, max(r) AS max_rate"


MAX_PROVIDERS = "LIMIT 10000"


def _provider_median(extra: str = "", where: str = "TRUE", limit: str = MAX_PROVIDERS) -> str:
    return _with(
        f"""SELECT npi, {NAME} AS provider_name, {_label("n.primary_taxonomy")} AS type, modifiers, payer_name,
          median_rate, min_rate, max_rate
        FROM per_provider LEFT JOIN names n USING (npi) WHERE {where}
        ORDER BY median_rate DESC NULLS LAST, provider_name, npi, modifiers, payer_name {limit}""",
        RATES,
        NAMES,
        LISTED,
        f"""offers AS (SELECT npi, payer_name, array_to_string(billing_code_modifiers, ',') AS modifiers,
          negotiated_rate AS r FROM listed {_benchmark(f"AND {NO_STATUS} {extra}")} GROUP BY ALL)""",
        f"per_provider AS (SELECT npi, payer_name, modifiers, {SPREAD} FROM offers GROUP BY ALL)",
    )


def _medians(extra: str = "", where: str = "TRUE") -> str:
    return f"""{LISTED},
    offers AS (SELECT npi, negotiated_rate AS r FROM listed {_benchmark(f"AND {NO_STATUS} {extra}")} GROUP BY ALL),
    per_provider AS (SELECT npi, {SPREAD} FROM offers GROUP BY npi),
    medians AS (SELECT npi, median_rate FROM per_provider LEFT JOIN names n USING (npi) WHERE {where}),
    ordered AS (SELECT list(median_rate ORDER BY median_rate) AS m FROM medians),
    trimmed AS (SELECT median_rate FROM medians, ordered WHERE median_rate <= 4 * m[len(m) // 2 + 1]),
    placed AS (SELECT median_rate AS r, row_number() OVER (ORDER BY median_rate) - 1 AS k,
      count(*) OVER () AS n FROM trimmed),
    frame AS (SELECT min(r) AS low, max(r) AS high, least(50, count(DISTINCT r)) AS bins FROM placed),
    bins AS (
      SELECT CASE WHEN high > low THEN round(low + (bin + 0.5::DOUBLE) * ((high - low) / bins), 2) ELSE low END
        AS rate, CAST(count(*) AS BIGINT) AS "count"
      FROM (SELECT low, high, bins, CASE WHEN high > low THEN
          least(floor((r - low) / ((high - low) / bins)), bins - 1) ELSE 0 END AS bin FROM placed, frame)
      GROUP BY bin, low, high, bins)"""


def _npi_summary(extra: str = "", limit: str = "LIMIT 500") -> str:
    return _with(
        f"""SELECT npi, {NAME} AS provider_name, per_provider.* EXCLUDE (npi)
        FROM per_provider LEFT JOIN names n USING (npi) ORDER BY rate_rows DESC, npi, provider_name {limit}""",
        RATES,
        NAMES,
        LISTED,
        f"""offers AS (SELECT npi, negotiated_rate AS r, billing_code, aba_provider_role, aba_delivery_mode FROM listed
          WHERE negotiated_type = 'fee schedule' AND r IS NOT NULL AND billing_class = 'professional' {extra} GROUP BY ALL)""",
        f"""per_provider AS (SELECT npi, CAST(count(*) AS BIGINT) AS rate_rows, round(avg(r), 2) AS avg_rate, {SPREAD}
          FROM offers GROUP BY npi)""",
    )


def _plan_medians(limit: str = MAX_PROVIDERS) -> str:
    return _with(
        f"""SELECT npi, {NAME} AS provider_name, per_provider.* EXCLUDE (npi) FROM per_provider LEFT JOIN names n USING (npi)
        ORDER BY median_rate DESC NULLS LAST, provider_name, npi, modifiers {limit}""",
        RATES,
        NAMES,
        PLAN_ROWS,
        f"""per_provider AS (SELECT npi, modifiers, CAST(count(DISTINCT plan_name) AS BIGINT) AS plan_count, {SPREAD}
          FROM named_offers GROUP BY npi, modifiers)""",
    )


def _plan_pivot(limit: str = MAX_PROVIDERS) -> str:
    return _with(
        f"SELECT npi, provider_name, modifiers, {PLAN_COLUMNS} FROM page WHERE COALESCE({PLAN_COLUMNS}) IS NOT NULL",
        RATES,
        NAMES,
        PLAN_ROWS,
        f"wide AS (SELECT npi, modifiers, {PLAN_MAXIMA} FROM named_offers GROUP BY npi, modifiers)",
        f"""page AS (SELECT wide.*, {NAME} AS provider_name FROM wide LEFT JOIN names n USING (npi)
          ORDER BY provider_name NULLS LAST, modifiers NULLS LAST, npi {limit})""",
    )


PLAN = r"regexp_extract(source_file_url, '\d{4}-\d{2}-\d{2}_\d+-(.+)_Blue-Shield', 1)"
NAMED = r"NOT regexp_full_match(plan_name, '\d+|Blue-Shield-of-California')"
#: What a provider is offered under each named plan.
PLAN_ROWS = f"""{LISTED},
  plan_offers AS (SELECT npi, {PLAN} AS plan_name, array_to_string(billing_code_modifiers, ',') AS modifiers,
    negotiated_rate AS r FROM listed {_benchmark(types="'fee schedule', 'per diem'")} GROUP BY ALL),
  named_offers AS (SELECT * FROM plan_offers WHERE {NAMED})"""
PLAN_COLUMNS = ", ".join(f"plan_{i}" for i in range(len(ref.PLAN_LABELS)))
PLAN_MAXIMA = ", ".join(f"max(r) FILTER (plan_name = '{plan}') AS plan_{i}" for i, plan in enumerate(ref.PLAN_LABELS))

# --- contracts ------------------------------------------------------------

CONTRACTS = """
schedule AS (
  SELECT c_custkey AS line,
    ['Blue Shield of California', 'Anthem Blue Cross of California', 'Blue Cross Blue Shield of Texas',
      'UMR', 'Other Contract'][c_nationkey % 5 + 1] AS customer_name,
    CAST(97151 + c_custkey % 6 AS VARCHAR) AS cpt,
    CASE c_custkey % 5 WHEN 0 THEN 'HM' WHEN 1 THEN 'HN' WHEN 2 THEN 'HO' ELSE '' END AS modifier,
    CAST(10.5 AS DOUBLE) + c_custkey % 400 AS rate
  FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 8 <> 7
),
contracts AS (
  SELECT customer_name, cpt, modifier, arg_min(rate, line) AS rate FROM schedule
  GROUP BY customer_name, cpt, modifier
),
payers(payer_name, customer_name) AS (VALUES
  ('Blue Shield of California', 'Blue Shield of California'),
  ('Anthem Blue Cross California', 'Anthem Blue Cross of California'),
  ('Blue Cross and Blue Shield of Texas', 'Blue Cross Blue Shield of Texas'),
  ('United HealthCare Services, Inc.', 'UMR')
)"""

TEXAS_HM = "AND payer_name = 'Blue Cross and Blue Shield of Texas' AND len(billing_code_modifiers) = 0"


def _convention() -> str:
    contains = "list_contains(billing_code_modifiers, credential)"
    return f"""SELECT payer_name, billing_code, credential, CAST(count(*) AS BIGINT) AS row_count
      FROM rates, (VALUES ('HM'), ('HO')) AS c(credential)
      WHERE billing_code IN ('97151', '97153') AND CASE
        WHEN payer_name = 'Anthem Blue Cross California' THEN TRUE
        WHEN payer_name = 'Blue Cross and Blue Shield of Texas'
            AND credential = CASE billing_code WHEN '97151' THEN 'HO' ELSE 'HM' END
          THEN len(billing_code_modifiers) = 0
        ELSE {contains} END
      GROUP BY ALL"""


REGISTRY = """
SELECT CAST(1000000000 + s_suppkey AS VARCHAR) AS npi,
  CASE WHEN s_suppkey % 2 = 0 THEN '2' ELSE '1' END AS entity_type_code,
  CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS organization_name,
  CASE WHEN s_suppkey % 2 = 1 THEN s_name END AS last_name,
  CASE WHEN s_suppkey % 2 = 1 THEN 'Pat' END AS first_name,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL
    WHEN s_suppkey % 4 = 0 AND s_suppkey % 5 <> 0 THEN '103K00000X'
    WHEN s_suppkey % 8 = 0 THEN '207Q00000X'
    WHEN s_suppkey % 19 = 0 THEN '390200000X'
    WHEN s_suppkey % 3 <> 0 THEN '101Y00000X'
    WHEN s_suppkey % 5 <> 0 THEN '103K00000X' ELSE '207Q00000X' END AS primary_taxonomy
FROM supplier WHERE s_suppkey % 13 <> 0"""

URL_PATH = (
    "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '')"
)

SQL: dict[str, str] = {
    # sources and ingest
    "ingest_rate_docs": _with(
        """SELECT d.source, payer_name AS reporting_entity_name,
          'Health Insurance Issuer' AS reporting_entity_type, '2026-05-01' AS last_updated_on,
          '2.0.0' AS version, CAST(items + 1 AS BIGINT) AS items, CAST(lines + items AS BIGINT) AS rates,
          CAST(COALESCE(refs, 0) + 1 AS BIGINT) AS refs
        FROM (SELECT source, max(payer_name) AS payer_name, count(DISTINCT billing_code) AS items,
            count(*) AS lines FROM docs GROUP BY source) d
          LEFT JOIN (SELECT source, sum(1 + CASE WHEN l_suppkey % 4 = 1 THEN 1 ELSE 0 END) AS refs FROM
            (SELECT DISTINCT source, l_suppkey FROM docs WHERE has_ref AND NOT ref_is_missing)
            GROUP BY source) r ON d.source = r.source""",
        DOCS,
    ),
    "ingest_errors": _with(
        """SELECT source, 'ValueError' AS error_type, CASE source[:3] WHEN 'r1-' THEN 'the document ends too early'
          ELSE 'a rate breaks the schema' END AS error, CAST(NULL AS BIGINT) AS entries FROM broken
        UNION ALL
        SELECT source, NULL, NULL, CAST(count(*) + count(DISTINCT billing_code) AS BIGINT) FROM docs
        WHERE service_line = 'aba' AND source NOT IN (SELECT source FROM broken) GROUP BY source""",
        DOCS,
        """broken AS (SELECT DISTINCT source FROM docs
          WHERE source[:3] = 'r1-' OR source[:3] = 'r2-' AND billing_code = '97153')""",
    ),
    "toc_errors": _with(
        """SELECT source, 'ValueError' AS error_type, 'the document ends too early' AS error, CAST(NULL AS BIGINT) AS files
        FROM structures WHERE CAST(source[5:] AS BIGINT) % 2 = 0 GROUP BY source
        UNION ALL
        SELECT source, NULL, NULL, CAST(count(*) AS BIGINT) FROM files
        WHERE CAST(source[5:] AS BIGINT) % 2 = 1 GROUP BY source""",
        TOC,
    ),
    "provider_refs": _with(
        """SELECT DISTINCT source, CAST(l_suppkey AS VARCHAR) AS ref_id,
          CAST(1000000000 + l_suppkey AS VARCHAR) AS npis
        FROM docs WHERE has_ref AND NOT ref_is_missing""",
        DOCS,
    ),
    "profile_filter": _with(
        """SELECT source, billing_code, CAST(count(*) + 1 AS BIGINT) AS entries FROM docs
        WHERE service_line = 'aba' GROUP BY source, billing_code""",
        DOCS,
    ),
    "flatten_rates": FLAT_ABA,
    "flatten_rates_radiology": _with(_flat("'payer-index'", "service_line = 'radiology'"), DOCS),
    "flatten_rates_category": _with(_flat("'payer-index'", "service_category = 'Direct Treatment'"), DOCS),
    "flatten_rates_large": FLAT_ABA,
    "stream_ingest": FLAT_ABA,
    "stream_events": _with(
        """SELECT source, 'ValueError' AS error_type, 'undefined provider reference ' || min(ref_id) AS error
        FROM missing GROUP BY source""",
        DOCS,
    ),
    "stream_large": FLAT_ABA,
    "stream_run_events": _with(
        """SELECT c.source, CASE WHEN m.ref_id IS NULL THEN 'succeeded' ELSE 'failed' END AS status,
          'undefined provider reference ' || m.ref_id AS error, CASE WHEN m.ref_id IS NULL THEN c.rows_written END AS rows_written
        FROM counters c LEFT JOIN (SELECT source, min(ref_id) AS ref_id FROM missing GROUP BY source) m USING (source)""",
        DOCS,
        COUNTERS,
    ),
    "resolve_refs": _with(
        """SELECT source, billing_code, CAST(count(*) FILTER (WHERE has_inline) AS BIGINT) AS inline_origins,
          CAST(count(*) FILTER (WHERE has_ref AND NOT ref_is_missing) AS BIGINT) AS resolved,
          CAST(count(*) FILTER (WHERE ref_is_missing) AS BIGINT) AS missing
        FROM docs WHERE service_line = 'aba' GROUP BY source, billing_code""",
        DOCS,
    ),
    "missing_refs": _with("SELECT source, ref_id FROM missing", DOCS),
    "remote_refs": _with(_flat("'payer-index'", "service_line = 'aba'", "flat_remote"), DOCS, REMOTE),
    "remote_refs_missing": _with("SELECT * FROM unresolved", DOCS, REMOTE),
    "remote_refs_quarantine": _with(
        """SELECT source, CAST(count(*) AS BIGINT) AS row_count FROM flat_remote
        WHERE service_line = 'aba' AND source NOT IN (SELECT source FROM unresolved) GROUP BY source""",
        DOCS,
        REMOTE,
    ),
    "parse_counters": _with("SELECT * FROM counters", DOCS, COUNTERS),
    "probe_files": _with(_probe(True), DOCS),
    "probe_files_large": _with(_probe(True), DOCS),
    "probe_files_full": _with(_probe(False), DOCS),
    "probe_summary": _with(
        f"""SELECT CAST(count(*) AS BIGINT) AS total_files,
          CAST(count(*) FILTER (WHERE has_match) AS BIGINT) AS with_match, CAST(0 AS BIGINT) AS errors,
          CAST(count(*) FILTER (WHERE NOT has_match) AS BIGINT) AS without_match
        FROM ({_probe(True)})""",
        DOCS,
    ),
    "write_rates": _rates(
        f"""SELECT 'index-' || r_regionkey AS index_payer, payer_name,
          'Health Insurance Issuer' AS reporting_entity_type, source_file_url,
          '2026-05-01' AS last_updated_on, '2.0.0' AS schema_version, billing_code,
          'CPT' AS billing_code_type, '2026' AS billing_code_type_version, p_name AS name,
          p_name || ' service' AS description, service_line, service_category,
          'ffs' AS negotiation_arrangement, billing_class, setting, negotiated_type, negotiated_rate,
          percentage, '2026-12-31' AS expiration_date, service_codes,
          array_to_string(billing_code_modifiers, ',') AS billing_code_modifiers, is_global,
          is_benchmark_eligible, array_to_string(provider_npi_list, ',') AS provider_npi_list,
          'ein' AS provider_tin_type, provider_tin_value, CAST(NULL AS VARCHAR) AS additional_information,
          {_details("rates")}
        FROM rates"""
    ),
    "scan_many": _rates(
        """SELECT payer_name, CASE WHEN r_regionkey < 4 THEN setting END AS setting,
          CAST(count(*) AS BIGINT) AS row_count FROM rates GROUP BY 1, 2"""
    ),
    # indexes and batch
    "toc_files": TOC_FILES,
    "toc_files_large": TOC_FILES,
    "toc_file_plans": _with(
        """SELECT location, 'Plan ' || (l_suppkey + p) AS plan_name, 'ein' AS plan_id_type,
          CAST(l_suppkey + p AS VARCHAR) AS plan_id, CAST(count(*) AS BIGINT) AS listings
        FROM (SELECT *, unnest(range(reporting_plan_count)) AS p FROM files) GROUP BY ALL""",
        TOC,
    ),
    "plan_classes": _with(
        """SELECT location, 'Plan ' || plan AS plan_name, 'ein' AS plan_id_type, CAST(plan AS VARCHAR) AS plan_id,
          CAST(count(*) AS BIGINT) AS listings
        FROM (SELECT location, unnest(range(l_suppkey, l_suppkey + reporting_plan_count)) AS plan FROM files) GROUP BY ALL""",
        TOC,
    ),
    "plan_class_sizes": _with(
        """SELECT CAST(l_suppkey AS VARCHAR) AS first_plan, max(reporting_plan_count) AS plans,
          CAST(count(DISTINCT location) AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS listings
        FROM files GROUP BY l_suppkey""",
        TOC,
    ),
    "index_dedupe": _with(DEDUPED, TOC),
    "index_written": _with(DEDUPED, TOC),
    "index_headers": _with(
        """SELECT s.source, 'Example Payer' AS reporting_entity_name,
          'Health Insurance Issuer' AS reporting_entity_type, '2026-05-01' AS last_updated_on,
          '2.0.0' AS version, CAST(n + 1 AS BIGINT) AS reporting_structure_count,
          CAST(m AS BIGINT) AS in_network_file_count
        FROM (SELECT source, count(*) AS n FROM structures GROUP BY source) s
          JOIN (SELECT source, count(DISTINCT location) AS m FROM files GROUP BY source) f
          ON s.source = f.source""",
        TOC,
    ),
    "index_files": """SELECT 'index-' || (p_partkey // 500) AS source,
          'https://example.test/files/p' || p_partkey || '.json.gz?sig=x' AS location,
          p_name AS description,
          CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size * 100000 AS BIGINT) END AS content_length_bytes
        FROM part WHERE p_partkey % 9 <> 0""",
    "index_roundtrip": _with(
        """SELECT location, description, content_length_bytes, reporting_plan_count, piece,
          row_number() OVER (PARTITION BY source, piece ORDER BY structure_ord, file_ord) - 1 AS place
        FROM (SELECT d.*, f.source, f.structure_ord, f.file_ord, f.structure_ord // 1000 AS piece
          FROM deduped d JOIN (SELECT location, unnest(min((source, structure_ord, file_ord)::ROW(source VARCHAR, structure_ord BIGINT, file_ord BIGINT)))
            FROM files GROUP BY location) f ON d.location = f.location)""",
        TOC,
        f"deduped AS ({DEDUPED})",
    ),
    "index_plans_roundtrip": _with(
        """SELECT location, CAST(sum(reporting_plan_count) AS BIGINT) AS reporting_plan_count, CAST(count(*) AS BIGINT) AS listings,
          CAST(sum(reporting_plan_count * l_suppkey + reporting_plan_count * (reporting_plan_count - 1) // 2) AS BIGINT) AS plan_ids,
          CAST(sum(reporting_plan_count) AS BIGINT) AS plans, 'Example Payer' AS entity, '2.0.0' AS version
        FROM files GROUP BY location""",
        TOC,
    ),
    "vendor_index": _with(
        """SELECT location, first_description AS description, CAST(NULL AS BIGINT) AS content_length_bytes,
          CAST(sum(plans) AS BIGINT) AS reporting_plan_count
        FROM (SELECT *, first_value(description) OVER (PARTITION BY location ORDER BY source, o_orderkey)
          AS first_description FROM entries WHERE is_rates) GROUP BY location, first_description""",
        VENDOR,
    ),
    "vendor_file_plans": _with(
        """SELECT location, 'Plan ' || p AS plan_name, CAST(o_custkey + p AS VARCHAR) AS plan_id,
          CAST(count(*) AS BIGINT) AS listings
        FROM (SELECT *, unnest(range(plans)) AS p FROM entries WHERE is_rates) GROUP BY ALL""",
        VENDOR,
    ),
    "vendor_header": _with(
        """SELECT source, 'Example Vendor Payer' AS reporting_entity_name,
          CAST(NULL AS VARCHAR) AS reporting_entity_type, '2026-05-01' AS last_updated_on,
          CAST(NULL AS VARCHAR) AS version, CAST(count(*) + 1 AS BIGINT) AS reporting_structure_count,
          CAST(count(DISTINCT path) FILTER (WHERE is_rates) AS BIGINT) AS in_network_file_count
        FROM entries GROUP BY source""",
        VENDOR,
    ),
    "batch_plan": """SELECT p_partkey AS file_ord, source, 'out/p' || p_partkey || '.aba.parquet' AS out_path,
          'aba' AS profile, CASE WHEN reason IS NULL THEN 'planned' ELSE 'skipped' END AS status, reason,
          content_length_bytes,
          CASE WHEN reason = 'file_too_large' THEN CAST(3670016 AS BIGINT) END AS max_size_bytes
        FROM (SELECT *, CASE WHEN content_length_bytes > 3670016 THEN 'file_too_large'
            WHEN p_partkey % 4 = 0 THEN 'output_exists' END AS reason
          FROM (SELECT p_partkey, 'https://example.test/files/p' || p_partkey || '.json.gz?sig=x' AS source,
            CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size * 100000 AS BIGINT) END AS content_length_bytes
            FROM part))""",
    "batch_manifest": _with("SELECT * EXCLUDE (p_partkey) FROM manifest", MANIFEST),
    "batch_counters": _with(
        """SELECT CAST(count(*) FILTER (WHERE status IN ('succeeded', 'failed')) AS BIGINT) AS attempted,
          CAST(count(*) FILTER (WHERE status = 'succeeded') AS BIGINT) AS succeeded,
          CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS failed,
          CAST(count(*) FILTER (WHERE status = 'skipped') AS BIGINT) AS skipped FROM manifest""",
        MANIFEST,
    ),
    "batch_run": _with(
        """SELECT c.source, CASE WHEN m.ref_id IS NULL THEN 'succeeded' ELSE 'failed' END AS status,
          'aba' AS profile, CASE WHEN m.ref_id IS NULL THEN scanned_items END AS scanned_items,
          CASE WHEN m.ref_id IS NULL THEN matched_items END AS matched_items,
          CASE WHEN m.ref_id IS NULL THEN rows_written END AS rows_written,
          CASE WHEN m.ref_id IS NOT NULL THEN 'undefined provider reference ' || m.ref_id END AS error
        FROM counters c LEFT JOIN (SELECT source, min(ref_id) AS ref_id FROM missing GROUP BY source) m
          ON c.source = m.source""",
        DOCS,
        COUNTERS,
    ),
    "batch_remote": _with(
        """SELECT c.source, CASE WHEN u.ref_id IS NULL THEN 'succeeded' ELSE 'failed' END AS status, 'aba' AS profile,
          CASE WHEN u.ref_id IS NULL THEN scanned_items END AS scanned_items,
          CASE WHEN u.ref_id IS NULL THEN matched_items END AS matched_items,
          CASE WHEN u.ref_id IS NULL THEN CAST(COALESCE(f.n, 0) AS BIGINT) END AS rows_written,
          'undefined provider reference ' || u.ref_id AS error
        FROM counters c LEFT JOIN (SELECT source, min(ref_id) AS ref_id FROM unresolved GROUP BY source) u ON c.source = u.source
          LEFT JOIN (SELECT source, count(*) AS n FROM flat_remote WHERE service_line = 'aba' GROUP BY source) f ON c.source = f.source""",
        DOCS,
        REMOTE,
        COUNTERS,
    ),
    "probe_written": _with(
        f"""SELECT *, CASE WHEN has_match THEN 'out/' || source || '.aba.parquet' END AS out_path,
          CASE WHEN has_match THEN 'planned' END AS plan FROM ({_probe(True)})""",
        DOCS,
    ),
    "batch_rerun": _with(
        _flat("'payer-index'", """service_line = 'aba' AND source NOT IN (SELECT source FROM missing)
          AND (source[:2] IN ('r2', 'r4') OR source[:2] = 'r0' AND l_linenumber = 1)"""),
        DOCS,
    ),
    "summary_incremental": _rates(
        f"SELECT billing_code, service_category, billing_class, {SUMMARY} FROM rates WHERE {NO_STATUS} GROUP BY ALL"
    ),
    "output_name": f"""SELECT page_id, regexp_replace(CASE WHEN base IN ('', '.') THEN 'in-network'
            ELSE base END, '(\\.json\\.gz|\\.json|\\.gz)$', '') || '.aba.parquet' AS output_name
        FROM (SELECT page_id, regexp_extract(regexp_replace({URL_PATH}, '/+$', ''), '([^/]*)$', 1) AS base
          FROM pages)""",
    "source_host": """SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1) AS host
        FROM pages""",
    "index_url_by_month": """SELECT CAST(year(o_orderdate) AS BIGINT) AS year,
          CAST(month(o_orderdate) AS BIGINT) AS month, CAST(count(*) AS BIGINT) AS orders,
          'https://mktg.bluecrossmn.com/mrf/' || strftime(any_value(o_orderdate), '%Y/%Y-%m') ||
            '-01_Blue_Cross_and_Blue_Shield_of_Minnesota_index.json' AS index_url
        FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""",
    # derived columns
    "classify_aba": _rates(
        """SELECT billing_code, CAST(count(*) AS BIGINT) AS lines, 'aba' AS service_line, service_category,
          service_subcategory, '15 minutes' AS unit_basis, CAST(NULL AS VARCHAR) AS modality,
          CAST(NULL AS VARCHAR) AS body_region, CAST(NULL AS VARCHAR) AS with_contrast,
          aba_delivery_mode, aba_provider_role
        FROM rates WHERE service_line = 'aba' GROUP BY ALL"""
    ),
    "classify_radiology": _rates(
        """SELECT billing_code, CAST(count(*) AS BIGINT) AS lines, 'radiology' AS service_line,
          CAST(NULL AS VARCHAR) AS service_category, CAST(NULL AS VARCHAR) AS service_subcategory,
          CAST(NULL AS VARCHAR) AS unit_basis, CAST(NULL AS VARCHAR) AS modality,
          CAST(NULL AS VARCHAR) AS body_region, CAST(NULL AS VARCHAR) AS with_contrast,
          CAST(NULL AS VARCHAR) AS aba_delivery_mode, CAST(NULL AS VARCHAR) AS aba_provider_role
        FROM rates WHERE service_line = 'radiology' GROUP BY billing_code"""
    ),
    "component_flags": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          l_linenumber = 5 AS is_technical_component, l_linenumber = 6 AS is_professional_component,
          l_linenumber NOT IN (5, 6) AS is_global
        FROM lineitem""",
    "rate_percentage_split": _rates(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, negotiated_type, negotiated_rate,
          percentage FROM rates"""
    ),
    "benchmark_flag": _rates(
        """SELECT service_line, billing_class, negotiated_type, is_benchmark_eligible,
          CAST(count(*) AS BIGINT) AS row_count, max(negotiated_rate) AS max_rate FROM rates GROUP BY ALL"""
    ),
    "status_modifier_filter": _rates(
        f"""SELECT billing_code, array_to_string(billing_code_modifiers, ',') AS modifiers,
          CAST(count(*) AS BIGINT) AS row_count FROM rates WHERE {NO_STATUS} GROUP BY ALL"""
    ),
    "plan_name": _rates(
        f"""SELECT plan_name, {NAMED} AS is_named, CAST(count(*) AS BIGINT) AS row_count
        FROM (SELECT {PLAN} AS plan_name FROM rates) GROUP BY plan_name"""
    ),
    "taxonomy_label": _with(
        f"""SELECT npi, primary_taxonomy, {_label("primary_taxonomy")} AS label FROM names""", NAMES
    ),
    "npi_registry": REGISTRY,
    "npi_exploded": _rates(
        """SELECT npi, billing_code, CAST(count(*) AS BIGINT) AS row_count, max(negotiated_rate) AS max_rate
        FROM (SELECT unnest(provider_npi_list) AS npi, billing_code, negotiated_rate FROM rates)
        GROUP BY npi, billing_code"""
    ),
    "modifier_convention": _rates(_convention()),
    # rate queries
    "query_rows": _rates(f"SELECT {ROWS} FROM rates WHERE {NO_STATUS} ORDER BY {ROWS_ORDER} LIMIT 10000"),
    "query_rows_grouped_cols": _rates(
        f"""SELECT billing_code, setting, aba_provider_role FROM rates WHERE {NO_STATUS}
        ORDER BY billing_code NULLS LAST, setting NULLS LAST, aba_provider_role NULLS LAST LIMIT 500"""
    ),
    "query_filters": _rates(
        f"""SELECT {ROWS} FROM rates WHERE service_line = 'aba' AND billing_code = '97153'
          AND service_category = 'Direct Treatment'
          AND payer_name = 'Blue Cross and Blue Shield of Texas' AND billing_class = 'professional'
          AND negotiated_type = 'fee schedule' AND {NO_STATUS} ORDER BY {ROWS_ORDER} LIMIT 10000"""
    ),
    "query_rate_bounds": _rates(
        f"""SELECT billing_code, {SUMMARY} FROM rates WHERE negotiated_rate >= 40
          AND negotiated_rate <= 400.25 AND {NO_STATUS} GROUP BY billing_code
        ORDER BY billing_code NULLS LAST"""
    ),
    "query_benchmark": _rates(
        f"""SELECT service_line, payer_name, {SUMMARY} FROM rates WHERE is_benchmark_eligible
          AND {NO_STATUS} GROUP BY ALL ORDER BY service_line NULLS LAST, payer_name NULLS LAST"""
    ),
    "summary_global": _rates(f"SELECT {SUMMARY} FROM rates WHERE {NO_STATUS}"),
    "summary_by_code": _rates(
        f"""SELECT billing_code, service_category, billing_class, {SUMMARY} FROM rates WHERE {NO_STATUS}
        GROUP BY billing_code, service_category, billing_class
        ORDER BY billing_code NULLS LAST, service_category NULLS LAST, billing_class NULLS LAST"""
    ),
    "sorted_rows": _rates(
        f"SELECT billing_code, billing_class, {SUMMARY} FROM rates GROUP BY billing_code, billing_class"
    ),
    "rate_pages": _rates(
        """SELECT page, CAST(count(*) AS BIGINT) AS row_count,
          max(billing_code) FILTER (place = low) AS first_billing_code, max(billing_code) FILTER (place = high) AS last_billing_code,
          max(negotiated_rate) FILTER (place = low) AS first_negotiated_rate, max(negotiated_rate) FILTER (place = high) AS last_negotiated_rate
        FROM (SELECT *, min(place) OVER (PARTITION BY page) AS low, max(place) OVER (PARTITION BY page) AS high
          FROM (SELECT *, place // 1000 AS page FROM (SELECT billing_code, negotiated_rate, row_number() OVER
            (ORDER BY billing_code NULLS LAST, negotiated_rate DESC NULLS LAST) - 1 AS place FROM rates))) GROUP BY page"""
    ),
    "summary_fast": _rates(
        f"""SELECT billing_code, billing_class, CAST(count(*) AS BIGINT) AS row_count, min(negotiated_rate) AS min_rate,
          max(negotiated_rate) AS max_rate, TRUE AS p25_rate_fits, TRUE AS median_rate_fits, TRUE AS p75_rate_fits
        FROM rates WHERE {NO_STATUS} GROUP BY billing_code, billing_class HAVING count(negotiated_rate) > 0"""
    ),
    "raw_vs_benchmark": _with(
        """SELECT 'raw' AS "view", CAST(count(*) AS BIGINT) AS group_count,
          CAST(COALESCE(sum(raw), 0) AS BIGINT) AS row_total
        FROM (SELECT * FROM g)
        UNION ALL
        SELECT 'benchmark', CAST(count(*) AS BIGINT), CAST(COALESCE(sum(benchmark), 0) AS BIGINT)
        FROM (SELECT * FROM g WHERE benchmark > 0)""",
        RATES,
        f"""g AS (SELECT billing_code, service_category, count(*) AS raw,
          count(*) FILTER (WHERE is_benchmark_eligible) AS benchmark FROM rates
          WHERE service_line = 'aba' AND {NO_STATUS} GROUP BY billing_code, service_category)""",
    ),
    "facets": _rates(
        """SELECT DISTINCT facet, value FROM (
          SELECT 'payer_names' AS facet, payer_name AS value FROM rates
          UNION ALL SELECT 'cpt_codes', billing_code FROM rates
          UNION ALL SELECT 'modifiers', unnest(billing_code_modifiers) FROM rates) WHERE value <> ''"""
    ),
    "facets_modifiers": _rates(
        """SELECT DISTINCT value FROM (SELECT unnest(billing_code_modifiers) AS value FROM rates)
        WHERE value <> ''"""
    ),
    "file_inventory": _rates(
        """SELECT source_file_url, CAST(count(*) AS BIGINT) AS row_count, max(payer_name) AS payer_name,
          '2.0.0' AS schema_version FROM rates GROUP BY source_file_url"""
    ),
    "preset_aba_benchmark_summary": _rates(
        f"""SELECT billing_code, service_category, {SUMMARY} FROM rates WHERE service_line = 'aba'
          AND billing_class = 'professional' AND is_benchmark_eligible AND {NO_STATUS}
        GROUP BY ALL ORDER BY billing_code, service_category LIMIT 50"""
    ),
    "preset_aba_raw_summary": _rates(
        f"""SELECT billing_code, service_category, billing_class, negotiated_type, {SUMMARY} FROM rates
        WHERE service_line = 'aba' AND {NO_STATUS} GROUP BY ALL
        ORDER BY billing_code, service_category, billing_class, negotiated_type LIMIT 50"""
    ),
    "preset_97153_raw_rows": _rates(
        f"""SELECT {ROWS} FROM rates WHERE service_line = 'aba' AND billing_code = '97153' AND {NO_STATUS}
        ORDER BY {ROWS_ORDER} LIMIT 100"""
    ),
    "preset_97153_benchmark_rows": _rates(
        f"""SELECT {ROWS} FROM rates WHERE service_line = 'aba' AND billing_code = '97153'
          AND billing_class = 'professional' AND is_benchmark_eligible AND {NO_STATUS}
        ORDER BY {ROWS_ORDER} LIMIT 100"""
    ),
    # providers and distribution
    "npi_summary": _npi_summary(),
    "npi_summary_all": _npi_summary(limit=""),
    "npi_summary_code": _npi_summary("AND billing_code = '97153'"),
    "npi_median": _with("SELECT npi, median_rate FROM medians", RATES, NAMES, _medians()),
    "provider_rates_median": _provider_median(),
    "provider_filter_bcba": _provider_median(where="n.primary_taxonomy LIKE '103K%'"),
    "provider_filter_excl_phys": _provider_median(
        "AND list_contains(billing_code_modifiers, 'HM')", NOT_PHYSICIAN
    ),
    "plan_rates_median": _plan_medians(),
    "plan_rates": _plan_pivot(),
    "npi_summary_code_all": _npi_summary("AND billing_code = '97153'", limit=""),
    "provider_rates_median_all": _provider_median(limit=""),
    "provider_filter_bcba_all": _provider_median(where="n.primary_taxonomy LIKE '103K%'", limit=""),
    "plan_rates_median_all": _plan_medians(limit=""),
    "plan_rates_all": _plan_pivot(limit=""),
    "rate_distribution": _with(
        "SELECT median_rate, CAST(count(*) AS BIGINT) AS n FROM trimmed GROUP BY median_rate",
        RATES,
        NAMES,
        _medians(TEXAS_HM, NOT_PHYSICIAN),
    ),
    "rate_distribution_stats": _with(
        """SELECT min(r) AS min, max(r) FILTER (WHERE k = n // 4) AS p25,
          max(r) FILTER (WHERE k = n // 2) AS median, round(sum(r) / max(n), 2) AS mean,
          max(r) FILTER (WHERE k = 3 * n // 4) AS p75, max(r) FILTER (WHERE k = floor(n * 0.9::DOUBLE)) AS p90,
          max(r) AS max, CAST(max(n) AS BIGINT) AS total FROM placed""",
        RATES,
        NAMES,
        _medians(),
    ),
    "rate_distribution_bins": _with("SELECT * FROM bins", RATES, NAMES, _medians()),
    # contracts
    "contract_rates": _with("SELECT customer_name, cpt, modifier, rate FROM contracts", CONTRACTS),
    "payer_contracts": _with(
        """SELECT payer_name, cpt, modifier, rate FROM contracts JOIN payers USING (customer_name)""",
        CONTRACTS,
    ),
    "contract_lookup": _with(
        """SELECT q.payer_name, q.billing_code, q.modifier, COALESCE(e.rate, b.rate) AS contract_rate
        FROM (SELECT DISTINCT payer_name, billing_code, unnest(CASE WHEN len(billing_code_modifiers) = 0
            THEN [''] ELSE billing_code_modifiers END) AS modifier FROM rates) q
        LEFT JOIN payers p ON q.payer_name = p.payer_name
        LEFT JOIN contracts e ON e.customer_name = p.customer_name AND e.cpt = q.billing_code
          AND e.modifier = q.modifier
        LEFT JOIN contracts b ON b.customer_name = p.customer_name AND b.cpt = q.billing_code
          AND b.modifier = ''""",
        RATES,
        CONTRACTS,
    ),
    "contract_bin": _with(
        """SELECT rate, "count", COALESCE(rate = (SELECT arg_min(rate, (abs(rate - own), rate))
            FROM bins, own WHERE own IS NOT NULL), FALSE) AS is_contract_bin
        FROM bins""",
        RATES,
        NAMES,
        CONTRACTS,
        _medians(TEXAS_HM),
        """own AS (SELECT max(rate) AS own FROM contracts JOIN payers USING (customer_name)
          WHERE payer_name = 'Blue Cross and Blue Shield of Texas' AND cpt = '97153' AND modifier = 'HM')""",
    ),
    # optional
    "custom_code_set": _with(
        f"""SELECT billing_code, {SUMMARY} FROM rates WHERE billing_code IN (
          SELECT CASE WHEN c_custkey % 9 = 0 THEN '99213' ELSE CAST(97151 + c_custkey % 6 AS VARCHAR) END
          FROM customer) GROUP BY billing_code""",
        RATES,
    ),
    "payer_overlap_fast": _with(
        """SELECT a.billing_code, a.payer_name AS payer, b.payer_name AS other_payer, max(m.n) AS rates, max(o.n) AS other_rates,
          CAST(count(*) AS BIGINT) AS shared_rates
        FROM grain a JOIN grain b ON a.billing_code = b.billing_code AND a.payer_name < b.payer_name
            AND a.billing_code_modifiers = b.billing_code_modifiers AND a.billing_class = b.billing_class
            AND a.negotiated_type = b.negotiated_type AND a.provider_tin_value = b.provider_tin_value
            AND a.negotiated_rate IS NOT DISTINCT FROM b.negotiated_rate
          JOIN sizes m ON m.billing_code = a.billing_code AND m.payer_name = a.payer_name
          JOIN sizes o ON o.billing_code = b.billing_code AND o.payer_name = b.payer_name
        GROUP BY ALL""",
        RATES,
        """grain AS (SELECT DISTINCT billing_code, payer_name, billing_code_modifiers, billing_class, negotiated_type,
          negotiated_rate, provider_tin_value FROM rates)""",
        "sizes AS (SELECT billing_code, payer_name, CAST(count(*) AS BIGINT) AS n FROM grain GROUP BY ALL)",
    ),
    "payer_overlap": _rates(
        """SELECT payers, hosts, CAST(max(payer_count) AS INTEGER) AS payer_count,
          CAST(count(*) AS BIGINT) AS shared_rates
        FROM (SELECT string_agg(DISTINCT payer_name, ' | ' ORDER BY payer_name) AS payers,
            string_agg(DISTINCT split_part(source_file_url, '/', 3), ' | ') AS hosts,
            count(DISTINCT payer_name) AS payer_count FROM rates
          GROUP BY billing_code, billing_code_modifiers, billing_class, negotiated_type, negotiated_rate,
            provider_tin_value) GROUP BY payers, hosts"""
    ),
}
