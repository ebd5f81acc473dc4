"""Column functions: text keys, identities and measures. No Python UDFs."""

from tallyloom.functions.identity import has_address, person_key, person_key_without_context
from tallyloom.functions.measures import (
    age_as_of,
    conversion_pct,
    mean_ticket,
    pop_stddev,
    price_tiers,
    thousands,
)
from tallyloom.functions.text import (
    blank_to_null,
    ci_key,
    clean_trim,
    code_from_hash,
    code_from_id,
    extract_email,
    not_blank,
    norm_key,
    plain_address,
)

__all__ = [
    "age_as_of", "blank_to_null", "ci_key", "clean_trim", "code_from_hash", "code_from_id",
    "conversion_pct", "extract_email", "has_address", "mean_ticket", "norm_key", "not_blank",
    "person_key", "person_key_without_context", "plain_address", "pop_stddev", "price_tiers",
    "thousands",
]
