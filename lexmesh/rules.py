"""A registry of derivation rules: functions from edges and evidence to derived edges."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    build: Callable[[DataFrame], DataFrame]


_RULES: dict[str, Rule] = {}


def register(rule: Rule) -> Rule:
    """Add a rule; the same name with another contract is refused."""
    known = _RULES.get(rule.name)
    if known is not None and (known.predicate, known.build) != (rule.predicate, rule.build):
        raise ValueError(f"rule {rule.name} is registered with another contract")
    _RULES[rule.name] = rule
    return rule


def names() -> list[str]:
    return sorted(_RULES)


def get(name: str) -> Rule:
    return _RULES[name]


def reset() -> None:
    _RULES.clear()


def replay(rule: Rule, inputs: DataFrame, shipped: DataFrame) -> DataFrame:
    """Edges a rule derives now but that were not shipped (missing), and the reverse (extra)."""
    from lexmesh.operators.multiset import set_difference

    return set_difference(rule.build(inputs), shipped)
