"""Ordered keyword rules as ``when`` chains, so that they run inside the scan stage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

Rule = tuple[object, Sequence[str]]


def any_keyword(low: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [low.contains(w) for w in words])


def first_rule(low: Column, rules: Sequence[Rule], default: object = None) -> Column:
    """Value of the first rule with a keyword inside the (lower-case) text."""
    chain = None
    for value, words in rules:
        hit = any_keyword(low, words)
        value = F.lit(value)
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    if chain is None:
        return F.lit(default)
    return chain if default is None else chain.otherwise(F.lit(default))


def known_rules(rules: Sequence[Rule], names: Iterable[str]) -> list[Rule]:
    """Rules whose category the dimension has; the others can never win."""
    names = set(names)
    return [(value, words) for value, words in rules if value in names]


def longest_name(low: Column, names: Sequence[str]) -> Column:
    """Longest name that occurs in the (lower-case) text; ties keep the list order."""
    ordered = sorted(names, key=len, reverse=True)
    chain = None
    for name in ordered:
        hit = low.contains(name.lower())
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return chain if chain is not None else F.lit(None).cast("string")
