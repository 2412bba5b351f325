"""Codes and flags: code to label, spellings to one code, the several readings of yes and no."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from predia.fixed_values import FALSE_TEXTS, NO, TRUE_TEXTS, YES


def decode(code: Column, labels: Mapping[str, str], otherwise: str | None) -> Column:
    """The label of a code. Codes are compared as text, so ``1`` and ``'1'`` are the same code."""
    text = code.cast("string")
    chain = F
    for value, label in labels.items():
        chain = chain.when(text == value, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def grouped_code(code: Column, groups: Mapping[str, Iterable[str]]) -> Column:
    """Many spellings to one code; a spelling in no group stays as it is."""
    chain = F
    for name, spellings in groups.items():
        chain = chain.when(code.isin(*spellings), F.lit(name))
    return chain.otherwise(code)


def _labelled(condition: Column) -> Column:
    return F.when(condition, F.lit(YES)).otherwise(F.lit(NO))


def yes_no(flag: Column) -> Column:
    """``'1'`` and ``'true'`` are yes, everything else, null too, is no."""
    return _labelled(flag.cast("string").isin(*TRUE_TEXTS))


def one_of_flag(code: Column, yes_codes: Iterable[str]) -> Column:
    """Yes when the code is in a list."""
    return _labelled(code.cast("string").isin(*yes_codes))


def is_known_flag(text: Column) -> Column:
    """Free text as a flag: null and ``'0'`` are no, any other text is yes."""
    return _labelled(text.isNotNull() & (text.cast("string") != FALSE_TEXTS[0]))


def presence_flag(*columns: Column) -> Column:
    """Yes when any of the columns holds a value."""
    return _labelled(F.coalesce(*[c.cast("string") for c in columns]).isNotNull())


def first_positive(*numbers: Column) -> Column:
    """The first number above zero, or the first number when none is."""
    chain = F
    for number in numbers:
        chain = chain.when(number > 0, number)
    return chain.otherwise(numbers[0])


def chosen_by_class(kind: Column, person: str, for_person: Column, for_others: Column) -> Column:
    """One value for persons, another for every other known class, null for an unknown class."""
    return F.when(kind == person, for_person).when(kind != person, for_others)
