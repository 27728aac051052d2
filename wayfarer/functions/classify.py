"""Ordered keyword classifier: the first rule whose keywords occur in the text wins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfarer.functions.text import literal_regex


@dataclass(frozen=True)
class Rule:
    category: str
    keywords: tuple[str, ...]

    @property
    def pattern(self) -> str:
        """Regex alternation that matches when any keyword occurs anywhere in the text."""
        return "|".join(literal_regex(k) for k in self.keywords)


@dataclass(frozen=True)
class RuleSet:
    """Rules in priority order, then an exact-match sentinel, then a default."""

    rules: tuple[Rule, ...]
    sentinel_text: str
    sentinel_category: str
    default_category: str

    @classmethod
    def of(cls, rules: Sequence[tuple[str, Sequence[str]]], sentinel_text: str, sentinel_category: str,
           default_category: str) -> RuleSet:
        """Build from ``(category, keywords)`` pairs."""
        return cls(tuple(Rule(cat, tuple(words)) for cat, words in rules),
                   sentinel_text, sentinel_category, default_category)


def classify(text: str | Column, ruleset: RuleSet) -> Column:
    """Fold the rule list into one CASE WHEN chain (a single codegen'd expression)."""
    c = F.col(text) if isinstance(text, str) else text
    expr = None
    for rule in ruleset.rules:
        cond = c.rlike(rule.pattern)
        expr = F.when(cond, rule.category) if expr is None else expr.when(cond, rule.category)
    cond = c == ruleset.sentinel_text
    expr = F.when(cond, ruleset.sentinel_category) if expr is None else expr.when(cond, ruleset.sentinel_category)
    return expr.otherwise(ruleset.default_category)


# The attraction categories, their keywords and the "no tag" label, exactly as the
# source data's Chinese labels must be matched for results equal to the original pipeline.
# Order is semantics (first match wins), e.g. 森林公园 is 都市休闲 because 公园 comes before 森林.
REFERENCE_NO_LABEL = "无标签"
REFERENCE_RULES = RuleSet.of(
    [
        ("主题游乐", ("乐园", "游乐场", "漂流", "拓展", "骑行", "露营", "欢乐谷", "方特", "主题体验")),
        ("文化场馆", ("博物馆", "美术馆", "纪念馆", "展览馆", "科技馆", "影视基地", "故居", "名人故居")),
        ("历史人文古迹", ("古镇", "古城", "古建", "古建筑", "寺庙", "石窟", "园林", "古村落", "城墙", "文物古迹", "历史遗址", "古战场", "老城", "文庙", "道观")),
        ("都市地标", ("城市地标", "地标建筑", "城市标志建筑", "高楼", "摩天轮", "网红打卡点")),
        ("都市休闲", ("公园", "商圈", "步行街", "广场", "绿地", "城市公园")),
        ("乡村生态", ("乡村", "农庄", "农家乐", "采摘", "田园", "民俗村")),
        ("自然风光", (
            "山", "河", "江", "湖", "海", "瀑布", "草原", "峡谷", "海滩", "海岛", "红树林", "温泉", "生态", "山水", "风景", "自然景观",
            "湖泊", "江河", "溪流", "湿地", "森林", "花海", "赏花",
        )),
    ],
    sentinel_text=REFERENCE_NO_LABEL,
    sentinel_category="未分类",
    default_category="其他景点",
)

# Rules for the TPC-H-shaped test tables, where a POI label is the words of p_name plus p_type.
# They overlap on purpose ("red ring" is forged, not coloured) to exercise rule order.
FIXTURE_RULES = RuleSet.of(
    [
        ("forged", ("ring", "anvil")),
        ("coloured", ("red", "blue")),
        ("device", ("gear", "gizmo", "widget")),
        ("thermal", ("hot", "cold")),
        ("promo", ("PROMO",)),
    ],
    sentinel_text=REFERENCE_NO_LABEL,
    sentinel_category="unclassified",
    default_category="other",
)
