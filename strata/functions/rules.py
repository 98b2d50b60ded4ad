"""Declarative data-quality rules: each rule is a Column yielding 0 (pass) or 1 (issue).

Rules carry their own NULL policy (``null_issue``).  ``issue_count`` sums them,
``any_issue`` ORs them, ``first_match`` builds a status label where the first
matching case wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and domains that must equal the reference's.
INCIDENT_ID_PATTERN = r"^[0-9]{4}-[0-9]{4}-[0-9]{3}$"
COUNTRY_PATTERN = r"^[A-Z]{2}$"
COUNTRY_ALIASES = ["USA", "UNITED STATES"]
INDUSTRY_PATTERN = r"^[0-9]{2}(-[0-9]{2})?$"
TICKER_PATTERN = r"^[A-Z0-9\.-]{1,10}$"
CONFIDENCE_DOMAIN = ["confirmed", "probable", "suspected"]
TIER_DOMAIN = [1, 2, 3, 4, 5]
GRADE_DOMAIN = ["GOLD", "SILVER", "BRONZE"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _flag(issue: Column, value: Column, null_issue: bool) -> Column:
    return (F.when(value.isNull(), F.lit(1 if null_issue else 0))
            .when(issue, F.lit(1)).otherwise(F.lit(0)))


def matches(c: Column | str, pattern: str, null_issue: bool = True,
            also: Sequence[str] = ()) -> Column:
    """Issue when the value does not match ``pattern`` (and is not in ``also``)."""
    v = _col(c)
    ok = v.rlike(pattern)
    if also:
        ok = ok | v.isin(list(also))
    return _flag(~ok, v, null_issue)


def between(c: Column | str, lo=None, hi=None, null_issue: bool = False) -> Column:
    """Issue when the value is below ``lo`` or above ``hi`` (closed range)."""
    v = _col(c)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (v < F.lit(lo))
    if hi is not None:
        bad = bad | (v > F.lit(hi))
    return _flag(bad, v, null_issue)


def negative(c: Column | str, null_issue: bool = False) -> Column:
    return between(c, lo=0, null_issue=null_issue)


def in_set(c: Column | str, values: Sequence, null_issue: bool = False) -> Column:
    """Issue when the value is outside the domain ``values``."""
    v = _col(c)
    return _flag(~v.isin(list(values)), v, null_issue)


def required(c: Column | str) -> Column:
    """Issue when the value is NULL."""
    return F.when(_col(c).isNull(), F.lit(1)).otherwise(F.lit(0))


def ordered(lo: Column | str, hi: Column | str) -> Column:
    """Issue when both are present and ``lo > hi``."""
    a, b = _col(lo), _col(hi)
    return F.when(a.isNotNull() & b.isNotNull() & (a > b), F.lit(1)).otherwise(F.lit(0))


def both_or_neither(a: Column | str, b: Column | str) -> Column:
    """Issue when exactly one of the two is present."""
    x, y = _col(a), _col(b)
    return F.when(x.isNull() != y.isNull(), F.lit(1)).otherwise(F.lit(0))


def not_before(later: Column | str, earlier: Column | str) -> Column:
    """Issue when both are present and ``later < earlier``."""
    return ordered(earlier, later)


def issue_count(rules: Mapping[str, Column] | Iterable[Column]) -> Column:
    cols = list(rules.values()) if isinstance(rules, Mapping) else list(rules)
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def any_issue(rules: Mapping[str, Column] | Iterable[Column]) -> Column:
    cols = list(rules.values()) if isinstance(rules, Mapping) else list(rules)
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def completeness(cols: Sequence[Column | str]) -> Column:
    """Number of non-NULL values among ``cols``."""
    return issue_count([F.when(_col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cols])


def first_match(cases: Sequence[tuple[Column, str]], default: str = "OK") -> Column:
    """Label of the first true condition, else ``default``."""
    expr = None
    for cond, label in cases:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def flags(rules: Mapping[str, Column], prefix: str = "") -> list[Column]:
    """Aliased rule columns, ready for ``select``."""
    return [c.alias(prefix + n) for n, c in rules.items()]
