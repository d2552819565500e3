"""Fixed values of the domain: payer names, credential rules, labels.

Every operator takes these as parameters; the tables here are the defaults.
"""

from __future__ import annotations

# Billing codes with a contract schedule, in code order.
ABA_CODES = ("97151", "97152", "97153", "97154", "97155", "97156")

# Payer name in the rate files -> customer name in the schedule.
CONTRACT_CUSTOMERS = {
    "Blue Shield of California": "Blue Shield of California",
    "Anthem Blue Cross California": "Anthem Blue Cross of California",
    "Blue Cross and Blue Shield of Texas": "Blue Cross Blue Shield of Texas",
    "Blue Cross and Blue Shield of Illinois": "Blue Cross Blue Shield of Illinois",
    "United HealthCare Services, Inc.": "UMR",
    "Cigna Health Life Insurance Company": "CIGNA HealthCare - A1",
    "Aetna Life Insurance Company": "Aetna Health Inc.",
}

# How a payer states the credential of the rendering provider.
# explicit: as a modifier; none: not at all; cpt_implicit: the natural
# credential of a code carries no modifier. Payers not listed are explicit.
MODIFIER_CONVENTIONS = {
    "Blue Shield of California": "explicit",
    "Anthem Blue Cross California": "none",
    "Blue Cross and Blue Shield of Texas": "cpt_implicit",
    "Blue Cross and Blue Shield of Illinois": "none",
    "United HealthCare Services, Inc.": "explicit",
    "Blue Cross and Blue Shield of Massachusetts Inc": "explicit",
}

# Natural credential of each code.
NATURAL_CREDENTIALS = {
    "97151": "HO",
    "97152": "HO",
    "97153": "HM",
    "97154": "HM",
    "97155": "HO",
    "97156": "HO",
}

# Modifiers that name a credential.
CREDENTIAL_MODIFIERS = ("HM", "HN", "HO")

# Procedure-status modifiers (discontinued, postoperative
# management only, preoperative management only).
STATUS_MODIFIERS = ("53", "55", "56")

# Taxonomy prefix and label; the first matching prefix wins.
TAXONOMY_LABELS = (
    ("103K", "BCBA"),
    ("103T", "Psychologist"),
    ("103G", "Psychologist"),
    ("103", "Mental Health"),
    ("1041C", "Clinical Social Worker"),
    ("104", "Social Worker"),
    ("106H", "MFT"),
    ("106", "Counselor"),
    ("101Y", "Counselor"),
    ("101", "Counselor"),
    ("133", "Dietitian"),
    ("163", "Registered Nurse"),
    ("171", "Acupuncturist"),
    ("173", "Independent Med Examiner"),
    ("176", "Foster Care Agency"),
    ("183", "Pharmacist"),
    ("204", "Physician"),
    ("207", "Physician"),
    ("208", "Physician"),
    ("237", "Occupational Therapist"),
    ("251", "Behavioral Health Agency"),
    ("273", "Psychiatric Facility"),
    ("284", "Rehabilitation Hospital"),
    ("291", "Laboratory"),
    ("335", "Prosthetics/Orthotics"),
    ("364", "Clinical Nurse Specialist"),
    ("332", "DME Supplier"),
    ("363L", "Nurse Practitioner"),
    ("363A", "Physician Asst"),
    ("363", "NP/PA"),
    ("367", "CRNA"),
    ("225", "Physical Therapist"),
    ("235", "Speech/Language"),
    ("213", "Podiatrist"),
    ("231", "Audiologist"),
    ("174", "Naturopath"),
    ("170", "Contractor"),
    ("152", "Optometrist"),
    ("111", "Chiropractor"),
    ("122", "Dentist"),
    ("390", "Student"),
    ("282", "Hospital"),
    ("261", "Clinic/Center"),
)

# Taxonomy prefix of behaviour analysts.
BCBA_PREFIX = "103K"

# Taxonomy prefixes left out by the non-physician filter.
PHYSICIAN_PREFIXES = (
    "204",
    "207",
    "208",
    "363",
    "367",
    "225",
    "235",
    "213",
    "174",
    "390",
    "152",
    "231",
    "111",
    "122",
    "103T",
    "173",
    "364",
)

# Plan name inside a source URL, and plans that are not named.
PLAN_NAME_PATTERN = r"\d{4}-\d{2}-\d{2}_\d+-(.+)_Blue-Shield"
UNNAMED_PLAN_PATTERN = r"^(\d+|Blue-Shield-of-California)$"

# Plan name -> short label used as a pivot column.
PLAN_LABELS = {
    "Blue-Shield-Access-Gold-80-HMO-250-35-Child-Dental": "Access Gold HMO",
    "Blue-Shield-Access-Gold-80-HMO-250-35-Child-Dental-INF": "Access Gold HMO INF",
    "Blue-Shield-Access-Platinum-90-HMO-0-20-Child-Dental-INF": "Access Platinum HMO INF",
    "Blue-Shield-Gold-80-PPO-0-25-Child-Dental": "Gold PPO",
    "Blue-Shield-Gold-80-PPO-350-25-Child-Dental": "Gold PPO (Alt)",
    "Blue-Shield-Platinum-90-Trio-HMO-JAN26": "Platinum Trio HMO",
    "Blue-Shield-Silver-70-HDHP-PPO-2300-30-PCP-Child-Dental-Alt-FAM-INF": "Silver HDHP PPO INF",
    "Blue-Shield-Silver-70-PPO-2000-45-Child-Dental": "Silver PPO",
    "Blue-Shield-Trio-Silver-70-HMO-2250-50-Child-Dental": "Trio Silver HMO",
    "Gold-80-PPO-Jan16": "Gold PPO (Jan16)",
    "Platinum-90-HMO-Trio-AI-AN-Jan18": "Platinum HMO AI/AN",
    "Preferred-PPO-Native-American-Jan14": "Preferred PPO AI/AN",
    "Silver-70-PPO-AI-AN-Jan18": "Silver PPO AI/AN",
}

# Text that stands for "no value" in the provider registry.
REGISTRY_NULLS = ("", "NULL", "<UNAVAIL>")

# Registry file column -> our column.
REGISTRY_COLUMNS = {
    "NPI": "npi",
    "Entity Type Code": "entity_type_code",
    "Provider Organization Name (Legal Business Name)": "organization_name",
    "Provider Last Name (Legal Name)": "last_name",
    "Provider First Name": "first_name",
}
TAXONOMY_CODE_COLUMN = "Healthcare Provider Taxonomy Code_{}"
TAXONOMY_SWITCH_COLUMN = "Healthcare Provider Primary Taxonomy Switch_{}"
TAXONOMY_SLOTS = 15

# Schema tag of in-network files in hosted-vendor metadata.
VENDOR_RATE_SCHEMA = "IN_NETWORK_RATES"

# Monthly index address of the one payer with a known pattern.
INDEX_URL_HOST = "https://mktg.bluecrossmn.com/mrf/"
INDEX_URL_TAIL = "_Blue_Cross_and_Blue_Shield_of_Minnesota_index.json"
