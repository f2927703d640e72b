"""Routing predicates: topic routes (F4) and event patterns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def topic_is(topic_col: Column, topic: str) -> Column:
    """``SELECT * FROM '<topic>'`` keeps every field of messages on the topic."""
    return topic_col == F.lit(topic)


def event_pattern(pattern: Mapping[str, object], base: Column | None = None) -> Column:
    """nested pattern ``{field: [allowed, ...] | {sub-pattern}}`` -> one predicate.

    Every listed field must hold one of its allowed values (``isin``); nested
    dicts address struct fields.  A missing field never matches.
    """
    terms: list[Column] = []
    for name, rule in pattern.items():
        c = F.col(name) if base is None else base.getField(name)
        if isinstance(rule, Mapping):
            terms.append(event_pattern(rule, c))
        elif isinstance(rule, Sequence) and not isinstance(rule, str):
            terms.append(c.isin(list(rule)) & c.isNotNull())
        else:
            raise TypeError(f"pattern entry {name!r} must be a list or a nested mapping")
    if not terms:
        return F.lit(True)
    out = terms[0]
    for t in terms[1:]:
        out = out & t
    return out
