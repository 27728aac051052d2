"""Column expressions: each returns a ``Column`` built from ``pyspark.sql.functions`` only."""

from wayfarer.functions.classify import FIXTURE_RULES, REFERENCE_RULES, Rule, RuleSet, classify
from wayfarer.functions.dates import (
    REFERENCE_DATE_FORMATS,
    days_since,
    parse_date_multi,
    period_index,
    quarter_of_month,
)
from wayfarer.functions.maps import map_text, top_keys
from wayfarer.functions.text import (
    blank_to_null,
    composite_id,
    literal_regex,
    not_blank,
    period_label,
    split_keep_empty,
)

__all__ = [
    "FIXTURE_RULES", "REFERENCE_RULES", "Rule", "RuleSet", "classify",
    "REFERENCE_DATE_FORMATS", "days_since", "parse_date_multi", "period_index", "quarter_of_month",
    "map_text", "top_keys",
    "blank_to_null", "composite_id", "literal_regex", "not_blank", "period_label", "split_keep_empty",
]
