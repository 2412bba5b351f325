"""Text expressions: slugs, accent folding, code padding, parts of a code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from predia.fixed_values import ACCENTED, UNACCENTED


def slug(text: Column, trimmed: bool = True) -> Column:
    """Lower case with ``-`` for every blank; ``trimmed`` drops the outer blanks first."""
    lowered = F.lower(text)
    return F.replace(F.trim(lowered) if trimmed else lowered, F.lit(" "), F.lit("-"))


def fold_accents(text: Column) -> Column:
    """The five accented vowels lose their accent; every other letter stays."""
    return F.translate(text, ACCENTED, UNACCENTED)


def or_constant(value: Column, constant: str) -> Column:
    return F.coalesce(value, F.lit(constant))


def pad_city_code(code: Column) -> Column:
    """A four-character code gets a leading zero, codes of any other length stay."""
    text = code.cast("string")
    return F.when(F.length(text) == 4, F.concat(F.lit("0"), text)).otherwise(text)


def state_code(city_code: Column) -> Column:
    """The first two characters of a padded city code."""
    return F.substring(city_code, 1, 2)


def part_of(code: Column, index: int, separator: str = "-") -> Column:
    """The part at ``index`` (from 0) of a separated code, null when the code has fewer parts."""
    return F.get(F.split(code, separator), F.lit(index))
