"""Column expressions. All of them stay on the JVM; none is a Python UDF."""

from .casts import to_contract_type
from .geo import great_circle_km, parse_coordinate
from .margin import guarded_ratio, homologated_key
from .text import carries_secret, fold_accents, is_https, null_token_to_null

__all__ = [
    "carries_secret", "fold_accents", "great_circle_km", "guarded_ratio", "homologated_key",
    "is_https", "null_token_to_null", "parse_coordinate", "to_contract_type",
]
