"""Row validation: type and range rules per field, as one array of violation texts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import quoted


@dataclass(frozen=True)
class Rule:
    field: str
    lower: float | None = None
    upper: float | None = None
    integer: bool = False


# Fields of a scoring request in their order, with their ranges.
HOUSING_RULES: tuple[Rule, ...] = (
    Rule("CRIM", 0),
    Rule("ZN", 0, 100),
    Rule("INDUS", 0, 100),
    Rule("CHAS", 0, 1, integer=True),
    Rule("NOX", 0, 1),
    Rule("RM", 0, 20),
    Rule("AGE", 0, 100),
    Rule("DIS", 0),
    Rule("RAD", 1, 24, integer=True),
    Rule("TAX", 0),
    Rule("PTRATIO", 0, 50),
    Rule("B", 0),
    Rule("LSTAT", 0, 100),
)

HOUSING_FIELDS: list[str] = [r.field for r in HOUSING_RULES]

HOUSING_SCHEMA = T.StructType(
    [T.StructField(r.field, T.LongType() if r.integer else T.DoubleType(), True) for r in HOUSING_RULES]
)


def _checks(rule: Rule) -> list[tuple[Column, str]]:
    """What breaks a rule, and how it is called. After the first two the value is a number."""
    raw = quoted(rule.field)
    value = raw.try_cast("double")
    checks: list[tuple[Column, str]] = [
        (raw.isNull(), "missing"),
        (value.isNull() | F.isnan(value), "not a number"),
    ]
    if rule.integer:
        checks.append((value != F.floor(value), "not an integer"))
    if rule.lower is not None:
        checks.append((value < rule.lower, f"below {rule.lower:g}"))
    if rule.upper is not None:
        checks.append((value > rule.upper, f"above {rule.upper:g}"))
    return checks


def rule_violation(rule: Rule) -> Column:
    """The text of the first broken part of a rule, else NULL."""
    out: Column | None = None
    for test, reason in _checks(rule):
        text = F.lit(f"{rule.field}: {reason}")
        out = F.when(test, text) if out is None else out.when(test, text)
    return out


def violations(rules: Sequence[Rule], columns: Sequence[str]) -> Column:
    """All broken rules of a row; an absent column breaks its rule in every row."""
    have = set(columns)
    found = [rule_violation(r) if r.field in have else F.lit(f"{r.field}: missing") for r in rules]
    return F.array_compact(F.array(*found))


def broken(rules: Sequence[Rule], columns: Sequence[str]) -> Column:
    """Whether a row breaks any rule, never NULL: plain comparisons, many times cheaper than the texts."""
    have = set(columns)
    if any(r.field not in have for r in rules):
        return F.lit(True)
    return reduce(or_, [test for r in rules for test, _ in _checks(r)], F.lit(False))
