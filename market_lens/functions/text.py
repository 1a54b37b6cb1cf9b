"""Numbers and words read out of listing text. All are native column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from market_lens import vocab
from market_lens.functions.columns import ColumnOrName, col, first_containing, non_empty

# One run of characters other than white space, the full-width space included.
_WORD = r"[^\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _fixed_parts(pattern: str) -> list[str]:
    """Texts that every match of ``pattern`` contains: what is left of it outside of groups,
    character classes and what follows them."""
    outside = re.sub(r"\([^()]*\)", "\0", re.sub(r"\[[^\]]*\][?+*]?", "\0", pattern))
    return [part for part in outside.split("\0") if part]


def _match(text: Column, pattern: str) -> Column:
    """Group 1 of the first match. The cheap search for the fixed parts comes first: most
    texts lack most fields, and then the regular expression is not run."""
    match = F.regexp_extract(text, pattern, 1)
    parts = _fixed_parts(pattern)
    if not parts:
        return match
    return F.when(reduce(Column.__and__, [text.contains(part) for part in parts]), match)


def first_number(text: ColumnOrName, pattern: str, default: float | None = None) -> Column:
    """Group 1 of the first match as a double; ``default`` when there is none or it is no number."""
    hit = _match(col(text), pattern).try_cast("double")
    return hit if default is None else F.coalesce(hit, F.lit(float(default)))


def _first_of(text: ColumnOrName, patterns: list[str]) -> Column:
    return F.coalesce(*[first_number(text, p) for p in patterns])


def year(text: ColumnOrName) -> Column:
    def guarded(pattern: str) -> Column:
        found = first_number(text, pattern)
        return F.when(found.between(*vocab.YEAR_RANGE), found)

    return F.coalesce(*[guarded(p) for p in vocab.YEAR_PATTERNS]).cast("int")


def mileage(text: ColumnOrName) -> Column:
    wan = first_number(text, vocab.MILEAGE_WAN_PATTERN)
    km = first_number(text, vocab.MILEAGE_KM_PATTERN)
    return F.coalesce((wan * 10000).try_cast("bigint"), km.try_cast("bigint"))


def displacement(text: ColumnOrName) -> Column:
    litres = first_number(text, vocab.DISPLACEMENT_PATTERN)
    return F.when(litres.between(*vocab.DISPLACEMENT_RANGE), litres)


def transmission(text: ColumnOrName) -> Column:
    return first_containing(text, vocab.TRANSMISSION_WORDS, F.lit(vocab.AUTOMATIC))


def brand(title: ColumnOrName) -> Column:
    """First known brand in list order, else the first word, else the unknown label."""
    word = non_empty(F.regexp_extract(col(title), _WORD, 0))
    known = [(name, [name]) for name in vocab.BRANDS]
    return first_containing(title, known, F.coalesce(word, F.lit(vocab.UNKNOWN_BRAND)))


def price(text: ColumnOrName, strict: bool = False) -> Column:
    """Price of a card, in units of 10,000.

    The default skips a number that is part of a distance; ``strict`` takes the first
    number of that form, whatever follows it.
    """
    return first_number(text, vocab.PRICE_PATTERN if strict else vocab.PRICE_NOT_DISTANCE_PATTERN)


def price_free(text: ColumnOrName) -> Column:
    """First number of a free-form price, thousands separators ignored."""
    return first_number(F.replace(col(text), F.lit(","), F.lit("")), vocab.PRICE_FREE_PATTERN)


def fuel_type(brand: ColumnOrName, model: ColumnOrName, strict: bool = True) -> Column:
    """Fuel by brand, then by words of the model.

    ``strict`` tests the words in their given order, in which the electric words also
    match most plug-in and hybrid names; otherwise the longer words are tested first.
    """
    words = vocab.FUEL_WORDS if strict else vocab.FUEL_WORDS[1:] + vocab.FUEL_WORDS[:1]
    by_model = first_containing(model, words, F.lit(vocab.PETROL))
    return F.when(col(brand).isin(vocab.ELECTRIC_BRANDS), F.lit(vocab.ELECTRIC)).otherwise(by_model)


def vehicle_type(model: ColumnOrName) -> Column:
    return vehicle_type_of_upper(F.upper(col(model)))


def vehicle_type_of_upper(model: ColumnOrName) -> Column:
    """``vehicle_type`` of a model that is in upper case already; each word names the column once more."""
    return first_containing(model, vocab.VEHICLE_WORDS, F.lit(vocab.SEDAN))


def color(text: ColumnOrName) -> Column:
    return first_containing(text, [(name, [name]) for name in vocab.COLORS])


def condition_score(text: ColumnOrName) -> Column:
    return _first_of(text, vocab.CONDITION_PATTERNS)


def fuel_consumption(text: ColumnOrName) -> Column:
    return _first_of(text, vocab.CONSUMPTION_PATTERNS)


def top_speed(text: ColumnOrName) -> Column:
    return _first_of(text, vocab.TOP_SPEED_PATTERNS)


def acceleration(text: ColumnOrName) -> Column:
    return _first_of(text, vocab.ACCELERATION_PATTERNS)
