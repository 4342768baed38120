"""Rule operators as column expressions. Three-valued logic: a null is no match and the row goes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.contracts import log


def _between(c: Column, low, high) -> Column:
    """Both bounds are optional and inclusive."""
    out = F.lit(True)
    if low is not None:
        out = out & (c >= low)
    if high is not None:
        out = out & (c <= high)
    return out


OPERATORS: dict[str, Callable[[Column, dict], Column]] = {
    "not_null": lambda c, p: c.isNotNull(),
    "is_null": lambda c, p: c.isNull(),
    "eq": lambda c, p: c == p["value"],
    "neq": lambda c, p: c != p["value"],
    "gt": lambda c, p: c > p["value"],
    "gte": lambda c, p: c >= p["value"],
    "lt": lambda c, p: c < p["value"],
    "lte": lambda c, p: c <= p["value"],
    "range": lambda c, p: _between(c, p.get("min"), p.get("max")),
    "length_lt": lambda c, p: F.length(c) < p["value"],
    "length_lte": lambda c, p: F.length(c) <= p["value"],
    "length_gt": lambda c, p: F.length(c) > p["value"],
    "length_gte": lambda c, p: F.length(c) >= p["value"],
    "length_eq": lambda c, p: F.length(c) == p["value"],
    "length_range": lambda c, p: _between(F.length(c), p.get("min"), p.get("max")),
    "contains": lambda c, p: c.contains(p["value"]),
    "not_contains": lambda c, p: ~c.contains(p["value"]),
    "startswith": lambda c, p: c.startswith(p["value"]),
    "endswith": lambda c, p: c.endswith(p["value"]),
    "is_in": lambda c, p: c.isin(*p.get("values", [])) if p.get("values") else F.lit(False),
    "not_in": lambda c, p: ~c.isin(*p.get("values", [])) if p.get("values") else F.lit(True),
    "matches": lambda c, p: c.rlike(p["pattern"]),
    "not_matches": lambda c, p: ~c.rlike(p["pattern"]),
    "is_empty": lambda c, p: c.isNull() | (c == ""),
    "is_not_empty": lambda c, p: c.isNotNull() & (c != ""),
}


def predicate(df: DataFrame, rule: dict) -> Column | None:
    """The rule {field, operator, ...params} as a column, or None with a warning if it isn't valid for df."""
    name, op = rule.get("field"), rule.get("operator")
    if name not in df.columns or op not in OPERATORS:
        log.warning("rule is skipped: %s", rule)
        return None
    try:
        return OPERATORS[op](F.col(name), rule.get("params", rule))
    except (KeyError, TypeError) as e:
        log.warning("rule is skipped: %s (%s)", rule, e)
        return None


def rule_filter(df: DataFrame, rules: list[dict], logic: str = "AND") -> DataFrame:
    """Rows for which all (AND) or any (OR) of the rules hold. Invalid rules are left out; with none left the input returns."""
    parts = [p for r in rules if (p := predicate(df, r)) is not None]
    if not parts:
        return df
    return df.where(reduce(lambda a, b: a | b if logic.upper() == "OR" else a & b, parts))


def dynamic_filter(df: DataFrame, config: dict) -> DataFrame:
    """`rules` with `logic`, then each of `rule_groups` with its own logic."""
    if config.get("enabled", True) is False:
        return df
    if config.get("rules"):
        df = rule_filter(df, config["rules"], config.get("logic", "AND"))
    for group in config.get("rule_groups", []):
        df = rule_filter(df, group.get("rules", []), group.get("logic", "AND"))
    return df
