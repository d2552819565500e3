"""Explicit schemas. Nothing in the library infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _string_list(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.StringType()))


def _struct_list(name: str, element: T.StructType) -> T.StructField:
    return T.StructField(name, T.ArrayType(element))


# --- in-network rate file -------------------------------------------------

PROVIDER_GROUP = T.StructType(
    [_string_list("npi"), T.StructField("tin", T.StructType(_strings("type", "value")))]
)

# negotiated_rate is read as text so that quoted numbers survive; it is cast
# to double when the price is flattened.
PRICE = T.StructType(
    [
        *_strings(
            "negotiated_type",
            "negotiated_rate",
            "expiration_date",
            "billing_class",
            "setting",
            "additional_information",
        ),
        _string_list("service_code"),
        _string_list("billing_code_modifier"),
    ]
)

NEGOTIATED_RATE = T.StructType(
    [
        _struct_list("provider_groups", PROVIDER_GROUP),
        _string_list("provider_references"),
        _struct_list("negotiated_prices", PRICE),
    ]
)

ITEM_FIELDS = (
    "negotiation_arrangement",
    "name",
    "billing_code_type",
    "billing_code_type_version",
    "billing_code",
    "description",
)

ITEM_HEAD = T.StructType(_strings(*ITEM_FIELDS))

ITEM = T.StructType([*ITEM_HEAD.fields, _struct_list("negotiated_rates", NEGOTIATED_RATE)])

PROVIDER_REFERENCE = T.StructType(
    [
        T.StructField("provider_group_id", T.StringType()),
        _struct_list("provider_groups", PROVIDER_GROUP),
        T.StructField("location", T.StringType()),
    ]
)

HEADER_FIELDS = (
    "reporting_entity_name",
    "reporting_entity_type",
    "last_updated_on",
    "version",
)

HEADER = T.StructType(_strings(*HEADER_FIELDS))

RATE_DOC = T.StructType(
    [
        *HEADER.fields,
        _struct_list("provider_references", PROVIDER_REFERENCE),
        _struct_list("in_network", ITEM),
    ]
)

# Only what a probe looks at: the JSON reader skips every other field.
PROBE_DOC = T.StructType(
    [_struct_list("in_network", T.StructType(_strings("billing_code")))]
)

# --- flat rate table ------------------------------------------------------

CLASSIFICATION_COLUMNS = (
    "service_line",
    "service_category",
    "service_subcategory",
    "unit_basis",
    "modality",
    "body_region",
    "with_contrast",
    "aba_delivery_mode",
    "aba_provider_role",
)

RATE_TABLE = T.StructType(
    [
        *_strings(
            "index_payer",
            "payer_name",
            "reporting_entity_type",
            "source_file_url",
            "last_updated_on",
            "schema_version",
            "billing_code",
            "billing_code_type",
            "billing_code_type_version",
            "name",
            "description",
            *CLASSIFICATION_COLUMNS,
            "negotiation_arrangement",
            "billing_class",
            "setting",
            "negotiated_type",
        ),
        T.StructField("negotiated_rate", T.DoubleType()),
        T.StructField("percentage", T.DoubleType()),
        *_strings("expiration_date"),
        _string_list("service_codes"),
        _string_list("billing_code_modifiers"),
        T.StructField("is_technical_component", T.BooleanType()),
        T.StructField("is_professional_component", T.BooleanType()),
        T.StructField("is_global", T.BooleanType()),
        T.StructField("is_benchmark_eligible", T.BooleanType()),
        _string_list("provider_npi_list"),
        *_strings("provider_tin_type", "provider_tin_value", "additional_information"),
    ]
)

RATE_COLUMNS = RATE_TABLE.fieldNames()

# --- indexes --------------------------------------------------------------

PLAN = T.StructType(
    _strings(
        "plan_name",
        "plan_id_type",
        "plan_id",
        "issuer_name",
        "plan_market_type",
        "plan_sponsor_name",
    )
)

TOC_STRUCTURE = T.StructType(
    [
        _struct_list("reporting_plans", PLAN),
        _struct_list("in_network_files", T.StructType(_strings("description", "location"))),
    ]
)

TOC = T.StructType([*HEADER.fields, _struct_list("reporting_structure", TOC_STRUCTURE)])

INDEX_ENTRY = T.StructType(
    [
        *_strings("location", "description"),
        T.StructField("content_length_bytes", T.LongType()),
        T.StructField("reporting_plan_count", T.LongType()),
        _struct_list("reporting_plans", PLAN),
    ]
)

NATIVE_INDEX = T.StructType([_struct_list("in_network_files", INDEX_ENTRY)])

VENDOR_PLAN = T.StructType(_strings("planName", "planIdType", "planId", "planMarketType"))

VENDOR_FILE = T.StructType(
    [
        *_strings("reportingEntityName", "lastUpdatedOn", "fileSchema", "fileName", "filePath"),
        _struct_list("reportingPlans", VENDOR_PLAN),
    ]
)

VENDOR_METADATA = T.StructType([_struct_list("files", VENDOR_FILE)])

# --- batch manifest: one superset of every event kind ---------------------

MANIFEST = T.StructType(
    [
        *_strings("status", "source", "out_path", "profile", "reason"),
        T.StructField("content_length_bytes", T.LongType()),
        T.StructField("max_size_bytes", T.LongType()),
        T.StructField("scanned_items", T.LongType()),
        T.StructField("matched_items", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        *_strings("error_type", "error"),
    ]
)

# --- contract schedule ----------------------------------------------------

CONTRACT_COLUMNS = (
    "CustomerName",
    "CPTCode",
    "ContractRatePerUnit",
    "Modifier1500_1",
    "Modifier1500_2",
)
