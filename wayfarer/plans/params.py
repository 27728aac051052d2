"""Job parameters. Defaults are the values of the original warehouse; tests override them."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from wayfarer.functions.classify import FIXTURE_RULES, REFERENCE_NO_LABEL, REFERENCE_RULES, RuleSet
from wayfarer.functions.dates import REFERENCE_DATE_FORMATS

# Output labels of the original tables.
REFERENCE_NO_PARTNER = "Unrecorded"
REFERENCE_RISING_FLAGS = ("无上期数据", "是", "否")   # no prior period / yes / no
REFERENCE_USER_STATUS = ("流失", "活跃")              # churned / active
REFERENCE_USER_LEVELS = ("高频", "中频", "低频")       # high / mid / low frequency


@dataclass(frozen=True)
class Params:
    # cleaning
    label_default: str = REFERENCE_NO_LABEL
    partner_default: str = REFERENCE_NO_PARTNER
    date_formats: tuple[str, ...] = REFERENCE_DATE_FORMATS
    sequence_sep: str = ";"
    label_sep: str = ";"
    trip_id_sep: str = "_"
    year_min: int = 2011          # inclusive
    year_max: int = 2022          # exclusive
    rules: RuleSet = field(default=REFERENCE_RULES)
    # dimension: made unique on poi_id once, when the clean table is written
    unique_poi: str = "first"          # "first" | "error" | "allow"
    # dimension join in the roll-ups (the clean table is already unique, so no re-check)
    poi_join_unique: str = "allow"     # "first" | "error" | "allow"
    broadcast_poi: str = "auto"        # "auto" (Spark's size check in bytes) | "hint" (a check of its own) | "never"
    hint_bytes: int = 64 << 20         # largest side that gets a broadcast hint
    # rollups
    hot_user_month_visits: int = 1_000_000  # a user-month beyond this is rolled up over many tasks
    null_map_key: str = "drop"    # "drop" | "error" | <label>
    # growth
    rising_threshold: float = 0.3
    growth_gap: str = "bridge"    # "bridge" (last observed period) | "strict" (calendar neighbour)
    rising_flags: tuple[str, str, str] = REFERENCE_RISING_FLAGS
    # portrait
    reference_date: str = "2022-01-01"
    churn_days: int = 365
    high_freq: float = 3.0
    mid_freq: float = 1.0
    user_status: tuple[str, str] = REFERENCE_USER_STATUS
    user_levels: tuple[str, str, str] = REFERENCE_USER_LEVELS
    # rankings
    ranking_year: int | None = 2021    # None: the last year of the table
    top_attractions: int = 50
    top_cities: int = 10

    def with_(self, **kw) -> Params:
        return replace(self, **kw)


REFERENCE_PARAMS = Params()

# The test tables cover 1995-01-01 .. 2001-08-01: the "last year" is 2001 (Q1-Q3) and "now" 2002-01-01.
FIXTURE_PARAMS = Params(
    year_min=1995, year_max=2002, ranking_year=2001, reference_date="2002-01-01", rules=FIXTURE_RULES,
)
