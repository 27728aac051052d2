"""DataFrame -> DataFrame operators (cleaning, joins, roll-ups, growth, rankings, quality)."""

from wayfarer.operators.clean import (
    blanks_to_null,
    dedupe,
    drop_null_keys,
    explode_sequence,
    fill_default,
    with_parsed_date,
    year_range,
)
from wayfarer.operators.enrich import DuplicateKeyError, join_dim, unique_by_key
from wayfarer.operators.growth import period_over_period
from wayfarer.operators.ranking import argmax_set, top_n_per_group
from wayfarer.operators.rollup import count_map, kind_rollup, map_entry, null_key_expr

__all__ = [
    "blanks_to_null", "dedupe", "drop_null_keys", "explode_sequence", "fill_default", "with_parsed_date",
    "year_range", "DuplicateKeyError", "join_dim", "unique_by_key", "period_over_period",
    "argmax_set", "top_n_per_group", "count_map", "kind_rollup", "map_entry", "null_key_expr",
]
