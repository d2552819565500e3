"""Small rate documents for the tests of readers and jobs."""

import gzip
import json
from pathlib import Path


def price(rate, kind="negotiated", **more):
    return {
        "negotiated_type": kind,
        "negotiated_rate": rate,
        "expiration_date": "2027-06-30",
        "service_code": ["02", "11"],
        "billing_class": "professional",
        "setting": "office",
        **more,
    }


def group(*npis, tin="381920475"):
    return {"npi": list(npis), "tin": {"type": "ein", "value": tin}}


def item(code, *rates, **more):
    return {
        "negotiation_arrangement": "ffs",
        "name": f"Service {code}",
        "billing_code_type": "CPT",
        "billing_code_type_version": "2025",
        "billing_code": code,
        "description": f"Service {code}",
        "negotiated_rates": list(rates),
        **more,
    }


def rate_doc(*items, references=None, payer="Lakeside Benefit Trust"):
    doc = {
        "reporting_entity_name": payer,
        "reporting_entity_type": "Third-Party Administrator",
        "last_updated_on": "2025-11-17",
        "version": "1.3.1",
    }
    if references is not None:
        doc["provider_references"] = references
    doc["in_network"] = list(items)
    return doc


def write_json(path, doc):
    text = doc if isinstance(doc, str) else json.dumps(doc)
    if str(path).endswith(".gz"):
        with gzip.open(path, "wt", encoding="utf-8") as out:
            out.write(text)
    else:
        Path(path).write_text(text, encoding="utf-8")
    return str(path)


#: Two groups listed inside the rate, one supervised-session code, and an item outside the profile.
INLINE_DOC = rate_doc(
    item("97155", {"provider_groups": [group(1043211118, 1870000025)], "negotiated_prices": [price(61.25, billing_code_modifier=[])]}),
    item("90834"),
    payer="Prairie Mutual",
)

#: One group by reference; its price names neither setting, modifiers nor free text.
_SHORT_PRICE = {k: v for k, v in price(88).items() if k != "setting"}
REFERENCE_DOC = rate_doc(
    item("97152", {"provider_references": [31], "negotiated_prices": [_SHORT_PRICE]}),
    references=[{"provider_group_id": 31, "provider_groups": [group(1629374650, tin="470812345")]}],
    payer="Harbor Cooperative",
)
