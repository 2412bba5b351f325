"""Column expressions: text, codes and flags, numbers, times. All native, none of them a Python UDF."""

from predia.functions.codes import (
    chosen_by_class, decode, first_positive, grouped_code, is_known_flag, one_of_flag, presence_flag, yes_no,
)
from predia.functions.numbers import price_per_unit, to_area, to_decimal, to_float, to_int
from predia.functions.text import (
    fold_accents, or_constant, pad_city_code, part_of, slug, state_code,
)
from predia.functions.times import clock, clock_text, days_since, parse_time

__all__ = [
    "chosen_by_class", "clock", "clock_text", "days_since", "decode", "first_positive", "fold_accents",
    "grouped_code", "is_known_flag", "one_of_flag", "or_constant", "pad_city_code", "parse_time", "part_of",
    "presence_flag", "price_per_unit", "slug", "state_code", "to_area", "to_decimal", "to_float", "to_int", "yes_no",
]
