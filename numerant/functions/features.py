"""Derived features: interactions of two columns, housing formulas, polynomial terms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_double, safe_div

INTERACTION_TYPES = ("product", "ratio", "diff", "sum")


def interaction(kind: str, left: str, right: str) -> Column:
    """One interaction; a ratio over zero is missing."""
    a, b = as_double(left), as_double(right)
    return {"product": a * b, "ratio": safe_div(a, b), "diff": a - b, "sum": a + b}[kind]


# Names and inputs of the housing features, in output order.
DOMAIN_INPUTS: dict[str, tuple[str, str]] = {
    "rooms_per_age": ("RM", "AGE"),
    "tax_per_room": ("TAX", "RM"),
    "accessibility_score": ("DIS", "RAD"),
    "socioeconomic_index": ("LSTAT", "PTRATIO"),
    "property_quality": ("RM", "LSTAT"),
    "crime_per_capita_weighted": ("CRIM", "INDUS"),
    "pollution_residential": ("NOX", "INDUS"),
}


def domain_feature(name: str, mapping: Mapping[str, str] | None = None, division: str = "null") -> Column:
    """A housing feature; ``mapping`` renames its inputs to the caller's columns."""
    mapping = mapping or {}
    left, right = (as_double(mapping.get(c, c)) for c in DOMAIN_INPUTS[name])
    if name == "rooms_per_age":
        return safe_div(left, right + 1, division)
    if name == "tax_per_room":
        return safe_div(left, right, division)
    if name == "accessibility_score":
        return safe_div(right, left + 0.1, division)
    if name in ("property_quality", "pollution_residential"):
        return left * (1 - right / 100)
    return left * right


def available_domain_features(columns: Sequence[str], mapping: Mapping[str, str] | None = None) -> list[str]:
    """The features whose inputs all exist."""
    mapping, have = mapping or {}, set(columns)
    return [n for n, inputs in DOMAIN_INPUTS.items() if all(mapping.get(c, c) in have for c in inputs)]


def polynomial_terms(
    columns: Sequence[str], degree: int = 2, interaction_only: bool = False, include_bias: bool = False
) -> list[tuple[str, tuple[str, ...]]]:
    """(name, factors) of every term: bias, inputs, then combinations in column order."""
    pick = combinations if interaction_only else combinations_with_replacement
    terms: list[tuple[str, tuple[str, ...]]] = [("1", ())] if include_bias else []
    for d in range(1, degree + 1):
        for factors in pick(columns, d):
            parts = []
            for c in dict.fromkeys(factors):
                power = factors.count(c)
                parts.append(c if power == 1 else f"{c}^{power}")
            terms.append((" ".join(parts), factors))
    return terms


def polynomial_term(factors: Sequence[str]) -> Column:
    value = F.lit(1.0)
    for i, c in enumerate(factors):
        value = as_double(c) if i == 0 else value * as_double(c)
    return value
