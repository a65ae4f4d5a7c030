"""Breach conditions.

Each builder gives a :class:`Condition` with the two complementary forms of one check. Both are
TRUE or FALSE for every row, never NULL: ``broken`` counts and flags, ``holds`` keeps. ``holds`` is
written out instead of negating ``broken`` so that Catalyst can push it down to the file scan.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowguard.functions.values import Moment, Reading


class Condition(NamedTuple):
    broken: Column
    holds: Column


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions) if conditions else F.lit(False)


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions) if conditions else F.lit(True)


def _guarded(reading: Reading, broken: Column, holds: Column) -> Condition:
    """Let NaN pass. Spark orders NaN above every number, so an upper limit would catch it."""
    if reading.maybe_nan:
        nan = F.isnan(reading.value)
        broken, holds = broken & ~nan, holds | nan
    return Condition(reading.value.isNotNull() & broken, reading.value.isNull() | holds)


def below_min(reading: Reading, limit: Any, inclusive: bool = True) -> Condition:
    value = reading.value
    # NaN is never below a limit, so no guard is needed and the whole condition can be pushed down.
    plain = Reading(value)
    if inclusive:
        return _guarded(plain, value < limit, value >= limit)
    return _guarded(plain, value <= limit, value > limit)


def above_max(reading: Reading, limit: Any, inclusive: bool = True) -> Condition:
    value = reading.value
    if inclusive:
        return _guarded(reading, value > limit, value <= limit)
    return _guarded(reading, value >= limit, value < limit)


def outside_domain(reading: Reading, allowed: tuple[Any, ...]) -> Condition:
    inside = reading.value.isin(*allowed)
    return _guarded(reading, ~inside, inside)


def ends_before_start(start: Moment, end: Moment) -> Condition:
    known = start.value.isNotNull() & end.value.isNotNull()
    unknown = start.value.isNull() | end.value.isNull()
    return Condition(
        known & (end.value < start.value),
        unknown | (end.value >= start.value),
    )


def outside_span(moment: Moment, first: Column, beyond: Column) -> Condition:
    """Outside the half-open span ``[first, beyond)``. A span with a null bound never breaks."""
    value = moment.value
    first, beyond = first.cast(moment.type_name), beyond.cast(moment.type_name)
    return Condition(
        value.isNotNull() & ((value < first) | (value >= beyond)),
        value.isNull() | ((value >= first) & (value < beyond)),
    )
