"""Column expressions: built-in Spark functions only, no Python UDFs."""

from tallyflow.functions.tokens import (
    split_whitespace, split_spaces, raw_space_split, last_token, exclaim)
from tallyflow.functions.timecols import (
    millis_to_ntz, millis_to_ts, to_event_time, ntz_to_millis, index_name,
    write_time)
from tallyflow.functions.jsonfields import (
    parse_struct, parse_variant, variant_field, variant_field_string,
    variant_type, nested_field, null_to_zero, as_text, parse_int)

__all__ = [
    "split_whitespace", "split_spaces", "raw_space_split", "last_token",
    "exclaim", "millis_to_ntz", "millis_to_ts", "to_event_time",
    "ntz_to_millis", "index_name", "write_time", "parse_struct",
    "parse_variant", "variant_field", "variant_field_string", "variant_type",
    "nested_field", "null_to_zero", "as_text", "parse_int",
]
