"""Pieces of the checking SQL."""

from __future__ import annotations

from market_lens import vocab
from market_lens.functions.outline import parse_selector

_WORD = r"[^\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def number(text: str, pattern: str) -> str:
    return f"try_cast(nullif(regexp_extract({text}, {quoted(pattern)}, 1), '') as double)"


def first_number(text: str, patterns: list[str]) -> str:
    return "coalesce(" + ", ".join(number(text, p) for p in patterns) + ")"


def words(text: str, pairs, default: str = "null") -> str:
    arms = [
        f"when {' or '.join(f'contains({text}, {quoted(n)})' for n in needles)} then {quoted(label)}"
        for label, needles in pairs
    ]
    return f"case {' '.join(arms)} else {default} end"


def bands(value: str, limits) -> str:
    arms = [f"when {value} < {upper} then {quoted(label)}" for upper, label in limits[:-1]]
    return f"case when {value} is null then null {' '.join(arms)} else {quoted(limits[-1][1])} end"


def year(text: str) -> str:
    found = [f"try_cast(nullif(regexp_extract({text}, {quoted(p)}, 1), '') as int)" for p in vocab.YEAR_PATTERNS]
    low, high = vocab.YEAR_RANGE
    return "coalesce(" + ", ".join(f"case when {f} between {low} and {high} then {f} end" for f in found) + ")"


def mileage(text: str) -> str:
    wan, km = number(text, vocab.MILEAGE_WAN_PATTERN), number(text, vocab.MILEAGE_KM_PATTERN)
    return f"coalesce(cast(trunc({wan} * 10000) as bigint), cast(trunc({km}) as bigint))"


def displacement(text: str) -> str:
    litres = number(text, vocab.DISPLACEMENT_PATTERN)
    return f"case when {litres} between 0.5 and 8.0 then {litres} end"


def brand(title: str) -> str:
    fallback = f"coalesce(nullif(regexp_extract({title}, {quoted(_WORD)}, 0), ''), {quoted(vocab.UNKNOWN_BRAND)})"
    return words(title, [(b, [b]) for b in vocab.BRANDS], fallback)


def transmission(text: str) -> str:
    return words(text, vocab.TRANSMISSION_WORDS, quoted(vocab.AUTOMATIC))


def fuel(brand_: str, model: str, strict: bool = True) -> str:
    order = vocab.FUEL_WORDS if strict else vocab.FUEL_WORDS[1:] + vocab.FUEL_WORDS[:1]
    electric = ", ".join(map(quoted, vocab.ELECTRIC_BRANDS))
    rest = words(model, order, quoted(vocab.PETROL))
    return f"case when {brand_} in ({electric}) then {quoted(vocab.ELECTRIC)} else {rest} end"


def vehicle(model: str) -> str:
    return words(f"upper({model})", vocab.VEHICLE_WORDS, quoted(vocab.SEDAN))


def color(text: str) -> str:
    return words(text, [(c, [c]) for c in vocab.COLORS])


def city_values() -> str:
    return "values " + ", ".join(f"({quoted(c)}, {quoted(n)})" for c, n in vocab.CITY_NAMES.items())


def brand_values() -> str:
    return "values " + ", ".join(f"({quoted(b)}, {i})" for i, b in enumerate(vocab.BRANDS))


VALID = (
    "brand is not null and brand <> '' and model is not null and model <> '' and price_wan is not null "
    "and model_year is not null and mileage_km is not null and mileage_km <> 0 "
    "and price_wan between 0.1 and 2000 and model_year between 2000 and 2025 and mileage_km between 0 and 1000000"
)
IN_RANGE = "price_wan between 0.1 and 2000 and model_year between 2000 and 2025 and mileage_km between 0 and 1000000"


def parse(cards: str, keep: str, strict: bool = False) -> str:
    """Listings of a relation with ``title, text, city_code`` and the ``keep`` columns."""
    pattern = vocab.PRICE_PATTERN if strict else vocab.PRICE_NOT_DISTANCE_PATTERN
    return f"""
with cards as ({cards}),
read as (
  select {keep}, city_code, text, title as model, {brand('title')} as brand, {number('text', pattern)} as price_wan,
    {year('text')} as model_year, {mileage('text')} as mileage_km
  from cards where title <> ''),
found as (
  select * from read where price_wan > 0 and model_year is not null and mileage_km is not null and mileage_km <> 0)
select {keep}, brand, model, price_wan, model_year, mileage_km, {fuel('brand', 'model')} as fuel_type,
  {transmission('text')} as transmission, {vehicle('model')} as vehicle_type, {quoted(vocab.SOURCE)} as source,
  coalesce(city_name, city_code) as city, {displacement('text')} as displacement_l, {color('text')} as color,
  {first_number('text', vocab.CONDITION_PATTERNS)} as condition_score,
  {first_number('text', vocab.CONSUMPTION_PATTERNS)} as fuel_l_100km,
  {first_number('text', vocab.TOP_SPEED_PATTERNS)} as top_speed_kmh,
  {first_number('text', vocab.ACCELERATION_PATTERNS)} as accel_s,
  {vocab.REFERENCE_YEAR} - model_year as age_years, {bands('price_wan', vocab.PRICE_BANDS)} as price_band,
  {bands('mileage_km', vocab.MILEAGE_BANDS)} as mileage_band
from found left join (select * from ({city_values()}) as v(code, city_name)) on city_code = code
"""


def decoded(text: str) -> str:
    """The text without its frequent references."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", " "), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"replace({text}, '&{name};', {quoted(char)})"
    return text


def flat_text(html: str) -> str:
    """The text nodes of markup, trimmed and joined."""
    space = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
    seen = (
        f"regexp_replace({html}, "
        r"'(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g')"
    )
    out = rf"regexp_replace({seen}, '(?s)</?[A-Za-z!][^>]*>', chr(1), 'g')"
    out = decoded(out)
    return (
        f"array_to_string(list_transform(string_split({out}, chr(1)), "
        f"lambda n: regexp_replace(n, '^{space}|{space}$', '', 'g')), '')"
    )


def titles(html: str, selector: str) -> list[str]:
    """The selector's attribute, if it has one, and its text on the first element that matches; null where it is empty."""
    want = parse_selector(selector)
    name, within, groups = want.tag or r"[A-Za-z][\w-]*", r"(?:\s[^>]*)?", []
    if want.cls:
        classes = "|".join(rf"{q}(?:[^{q}>]*\s)?{want.cls}(?:\s[^{q}>]*)?{q}" for q in "\"'")
        within = rf"\s(?:[^>]*\s)?class\s*=\s*(?:{classes}|{want.cls})(?:\s[^>]*)?"
    elif want.attr:
        within = rf"""\s(?:[^>]*\s)?{want.attr}(?:\s*=\s*(?:"([^">]*)"|'([^'>]*)'|([^\s"'>]+)))?(?:\s[^>]*)?"""
        groups = [2, 3, 4]
    head, tag, *values = (f"regexp_extract({html}, {quoted(f'(?is)<({name}){within}>')}, {k})" for k in (0, 1, *groups))
    behind = f"substr({html}, instr({html}, {head}) + length({head}))"
    inner = rf"regexp_extract({behind}, '(?is)^(.*?)</' || {tag} || '\s*>', 1)"
    found = [f"nullif({decoded(' || '.join(values))}, '')"] if values else []
    return [*found, f"case when {head} <> '' then nullif({flat_text(inner)}, '') end"]
