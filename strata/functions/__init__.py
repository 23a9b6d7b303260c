"""Column -> Column builders.  All run inside whole-stage codegen; no UDFs."""
from strata.functions.casts import cast_columns, safe_cast, text_to_double, text_to_int, text_to_long
from strata.functions.decode import (
    classify_period, decode, decode_flags, decode_join, flag_to_bool, literal_map, normalize_label,
)
from strata.functions.jsonfields import json_double, json_int, json_scalar, json_timestamp
from strata.functions.measures import (
    any_decrease, attained, coalesced_sum, filled_count, gap, mean_of_cents, null_count,
    reverse_gap, to_cents,
)
from strata.functions.text import (
    normalized_text, pad_id_guarded, pad_id_unguarded, trimmed_text, upper_code,
)

__all__ = [n for n in dir() if not n.startswith("_")]
