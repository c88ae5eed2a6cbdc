"""Text expressions: money parsing and printing, bathroom descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_value(text: Column, type_name: str, lenient: bool = False) -> Column:
    """``"$2,080.50"`` -> 2080.5; blank -> null. Other text fails the job, or gives null if lenient."""
    cleaned = F.nullif(F.translate(F.trim(text), "$,", ""), F.lit(""))
    return cleaned.try_cast(type_name) if lenient else cleaned.cast(type_name)


def parse_bathrooms(text: Column) -> Column:
    """Number of bathrooms in a description: "3 baths" -> 3, "Private half-bath" -> 0.5, else null."""
    lowered = F.lower(text)
    # a split compiles its pattern for every row, and a cast that fails costs an exception: words that hold no number are told apart first
    first_word = F.regexp_extract(F.trim(lowered), r"^(\S*)", 1)
    number = F.when(first_word.rlike("[0-9]|inf|nan"), first_word.try_cast("double"))
    return F.when(lowered.contains("half"), F.lit(0.5)).otherwise(number)


def format_eur(amount: Column, digits: int = 0) -> Column:
    """Euro text with thousands commas: 98765 -> ``€98,765``, a minus sign stands after the symbol."""
    return F.concat(F.lit("€"), F.format_number(amount, digits))


def signed_percent(value: Column, digits: int = 0) -> Column:
    """``+12%`` / ``-3%`` with the sign always shown."""
    shown = F.format_number(F.abs(F.bround(value, digits)), digits)
    return F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("+")), shown, F.lit("%"))
