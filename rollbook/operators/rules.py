"""Row rules.

A rule is a reason code and a condition.  As with an SQL CHECK a row fails only
when the condition is FALSE; NULL passes.  All rules of a list are evaluated in
one narrow pass and every broken one is named.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.text import NA_TOKENS, na_to_null

REASONS = "reasons"


@dataclass(frozen=True)
class Rule:
    reason: str
    holds: Column


def required(col: str) -> Rule:
    return Rule(f"{col}_missing", F.col(col).isNotNull())


_NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"
_WHOLE = r"^\s*[+-]?[0-9]+(\.0*)?\s*$"


def number(col: str, dtype: str = "decimal(5,2)") -> Rule:
    """The text is a number in plain or scientific form, or a named one, that the type can hold.

    Casting alone would also take type letters and hexadecimal forms.
    """
    value = F.col(col)
    good = value.cast("string").rlike(_NUMBER) & value.try_cast(dtype).isNotNull()
    return Rule(f"{col}_bad_number", value.isNull() | good)


def whole_number(col: str, dtype: str = "decimal(10,0)") -> Rule:
    """The text is a number without a fraction."""
    value = F.col(col)
    good = value.cast("string").rlike(_WHOLE) & value.try_cast(dtype).isNotNull()
    return Rule(f"{col}_bad_number", value.isNull() | good)


def in_range(col: str, low: float = 0, high: float = 100, on: str = "stored", dtype: str = "decimal(5,2)") -> Rule:
    """Inclusive range, tested on the value as stored or on the raw number."""
    if on not in ("stored", "raw"):
        raise ValueError("on must be 'stored' or 'raw'")
    value = F.col(col).try_cast(dtype if on == "stored" else "double")
    return Rule(f"{col}_out_of_range", value.between(low, high))


def date_shape(col: str) -> Rule:
    """The text starts like a date; says nothing about the calendar."""
    return Rule(f"{col}_bad_shape", F.col(col).rlike(r"^\d{4}-\d{2}-\d{2}"))


def real_date(col: str) -> Rule:
    return Rule(f"{col}_not_a_date", F.col(col).isNull() | F.col(col).try_cast("date").isNotNull())


def one_of(col: str, values: Sequence[str] = schemas.STATUSES) -> Rule:
    return Rule(f"{col}_not_allowed", F.col(col).isin(*values))


def positive(col: str, dtype: str = "decimal(10,0)") -> Rule:
    return Rule(f"{col}_not_positive", F.col(col).try_cast(dtype) > 0)


def max_length(col: str, limit: int) -> Rule:
    """Blanks beyond the limit do not count; storing drops them."""
    return Rule(f"{col}_too_long", F.length(F.rtrim(F.col(col))) <= limit)


def with_key(col: str, tokens: Sequence[str] = NA_TOKENS) -> Rule:
    return Rule(f"{col}_missing", na_to_null(col, tokens).isNotNull())


def table_rules(table: str, columns: Sequence[str]) -> list[Rule]:
    """The declared constraints of a table that concern the given columns."""
    rules = [required(c) for c in schemas.REQUIRED[table] if c in columns]
    limits: Mapping[str, int] = schemas.MAX_LENGTH[table]
    rules += [max_length(c, n) for c, n in limits.items() if c in columns]
    if table == "courses" and "credits" in columns:
        rules.append(positive("credits"))
    if table == "grades" and "score" in columns:
        rules.append(in_range("score"))
    if table == "attendance" and "status" in columns:
        rules.append(one_of("status"))
    return rules


def passes(rules: Sequence[Rule]) -> Column:
    """True where no rule is broken."""
    test = F.lit(True)
    for r in rules:
        test = test & F.coalesce(r.holds, F.lit(True))
    return test


def broken(rules: Sequence[Rule]) -> Column:
    """Array of the reason codes of all broken rules, in the order given."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(~r.holds, F.lit(r.reason)) for r in rules]))


def first_failing(*stages: Column) -> Column:
    """Reasons of the first stage that found any; later stages do not count."""
    empty = F.array().cast("array<string>")
    return F.coalesce(*[F.when(F.size(s) > 0, s) for s in stages], empty)


def judged(*stages: Sequence[Rule]) -> Column:
    """Reasons of the first stage of rules that is broken.

    As in ``apply_rules`` a stage is told by one boolean condition; reasons are
    put together for the stage that is broken only.
    """
    none = F.array().cast("array<string>")
    why = lambda rules: F.array(F.lit(rules[0].reason)) if len(rules) == 1 else broken(rules)
    return F.coalesce(*[F.when(~passes(rules), why(rules)) for rules in stages], none)


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reasons``).

    Sorting the rows out is one boolean condition; reasons are put together for
    rejected rows only.
    """
    ok = passes(rules)
    return df.where(ok), df.where(~ok).withColumn(REASONS, broken(rules))
