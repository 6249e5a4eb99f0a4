"""Column -> Column cleaners and parsers (C1-C16).  No Python UDFs."""

from feedworks.functions.text import (JAVA_WHITESPACE, cut, jtrim, safe_str, str_or_empty,
                                      within_length)
from feedworks.functions.numeric import (decade, decade_label, double_to_int, int_or_zero,
                                         round2, safe_double, safe_int, to_decimal,
                                         to_int_half_even)
from feedworks.functions.temporal import instant_to_date, parse_date, parse_instant
from feedworks.functions.lists import (nonblank_items, normalize_list, normalize_list_text,
                                       parse_ids, parse_strs, split_quoted)

__all__ = [
    "JAVA_WHITESPACE", "cut", "jtrim", "safe_str", "str_or_empty", "within_length",
    "decade", "decade_label", "double_to_int", "int_or_zero", "round2", "safe_double",
    "safe_int", "to_decimal", "to_int_half_even",
    "instant_to_date", "parse_date", "parse_instant",
    "nonblank_items", "normalize_list", "normalize_list_text", "parse_ids", "parse_strs",
    "split_quoted",
]
