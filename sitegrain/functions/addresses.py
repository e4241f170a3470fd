"""Street, city, state, postal code and phone functions as Column builders. Null counts as empty text throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrain.functions.text import alnum_key, bound, clean, col, lower_trim

# Abbreviations of directions and street types, words that open a unit.
DIRECTIONS = {"n": "north", "s": "south", "e": "east", "w": "west", "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest"}
STREET_TYPES = {
    "st": "street", "str": "street", "ave": "avenue", "av": "avenue", "rd": "road", "blvd": "boulevard", "dr": "drive", "ln": "lane", "ct": "court", "pl": "place", "pkwy": "parkway", "pky": "parkway",
    "hwy": "highway", "hway": "highway", "cir": "circle", "ter": "terrace", "terr": "terrace", "sq": "square", "trl": "trail", "pt": "point", "plz": "plaza", "expy": "expressway", "fwy": "freeway",
}
ROUTES = {"rte": "route", "rt": "route"}
UNIT_WORDS = ["suite", "ste", "unit", "apt", "apartment", "floor", "fl", "rm", "room", "bldg", "building", "department", "dept"]
UNIT_NAMES = {"ste": "Suite", "suite": "Suite", "unit": "Unit", "apt": "Apt", "apartment": "Apt", "floor": "Floor", "fl": "Floor", "rm": "Room", "room": "Room", "bldg": "Building", "building": "Building", "dept": "Dept", "department": "Dept", "lobby": "Lobby", "level": "Level"}
ROAD_WORDS = ["rd", "road", "rte", "rt", "route", "hwy", "highway"]
SIGNATURE_WORDS = {
    "st": "street", "str": "street", "rd": "road", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "ln": "lane", "dr": "drive", "rt": "route", "rte": "route", "hwy": "highway", "sq": "square", "pkwy": "parkway", "ct": "court", "pl": "place", "ter": "terrace", "cir": "circle",
    "n": "north", "s": "south", "e": "east", "w": "west",
}
CITY_WORDS = {"ft": "fort", "st": "saint", "mt": "mount"}
INDISTINCT = [
    "suite", "ste", "unit", "floor", "apt", "bldg", "building", "north", "south", "east", "west", "street", "st", "avenue", "ave", "road", "rd", "drive", "dr", "lane", "ln", "court", "ct", "place", "pl", "boulevard", "blvd", "highway", "hwy", "route", "rt", "rte", "circle", "cir", "terrace", "ter", "parkway", "pkwy", "way", "trail", "square", "plaza",
]
TERRITORIES = ["VI", "GU", "AS", "MP"]
# The first digit of the postal codes of each state.
ZIP_DIGIT = {
    "0": ["CT", "MA", "ME", "NH", "NJ", "RI", "VT"], "1": ["DE", "NY", "PA"], "2": ["DC", "MD", "NC", "SC", "VA", "WV"], "3": ["AL", "FL", "GA", "MS", "TN"], "4": ["IN", "KY", "MI", "OH"], "5": ["IA", "MN", "MT", "ND", "SD", "WI"],
    "6": ["IL", "KS", "MO", "NE"], "7": ["AR", "LA", "OK", "TX"], "8": ["AZ", "CO", "ID", "NM", "NV", "UT", "WY"], "9": ["AK", "CA", "GU", "HI", "OR", "WA"],
}


def _look(words: dict[str, str], token: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return F.coalesce(F.try_element_at(table, token), token)


def _tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def norm_street(c: Column | str, keep_unit: bool = True) -> Column:
    """Lower-case street with directions and types written out; '#' counts as a suite; without its unit on demand."""
    text = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "#", " suite "), r"[^a-z0-9\s]", " ")
    def written(tokens: Column) -> Column:
        return F.array_join(F.transform(tokens, lambda t: _look(DIRECTIONS | STREET_TYPES, t)), " ")

    if keep_unit:
        return written(_tokens(text))
    return bound(_tokens(text), lambda w: written(F.slice(w, 1, F.coalesce(_first_of(w, UNIT_WORDS) - 1, F.size(w)))))


def _first_of(tokens: Column, words: list[str]) -> Column:
    """The place of the first of the words among the tokens, from 1; null without any."""
    found = F.filter(F.transform(tokens, lambda t, i: F.when(t.isin(*words), i + 1)), lambda i: i.isNotNull())
    return F.get(found, 0)


def _titled(t: Column) -> Column:
    ordinal = F.lower(t).rlike(r"^\d+(st|nd|rd|th)$")
    mixed = t.rlike(r"\d") & t.rlike(r"[A-Za-z]")
    return F.when(ordinal, F.lower(t)).when(mixed, F.upper(t)).otherwise(F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1_000_000))))


def canonical_display(c: Column | str) -> Column:
    """The street as it is shown: words written out and in title case, the unit behind a comma; '' for blank text.

    ``St`` is State before a road word, Street at the end or before a direction or type, else Saint; an ordinal before
    a floor belongs to the unit; a word that repeats the one before it in the unit is dropped.
    """
    text = F.regexp_replace(F.regexp_replace(clean(c), r"(?i)\b(suite|ste)\.?\s*#\s*", "Suite "), r"#\s*", "Suite ")
    known, full = list(DIRECTIONS | STREET_TYPES | ROUTES), DIRECTIONS | STREET_TYPES | ROUTES

    def cut(w: Column) -> Column:
        low = F.transform(w, lambda t: F.lower(t))
        first = _first_of(low, list(UNIT_NAMES))
        floor = F.get(low, first - 1).isin("floor", "fl") & (first > 1) & F.get(low, first - 2).rlike(r"^\d+(st|nd|rd|th)$")
        return F.coalesce(first - 1 - F.when(floor, 1).otherwise(0), F.size(w))

    def shown(main: Column) -> Column:
        def word(t: Column, i: Column) -> Column:
            after, low = F.lower(F.get(main, i + 1)), F.lower(t)
            saint = F.when(after.isin(*ROAD_WORDS), "State").when(after.isNull() | after.isin(*known), "Street").otherwise("Saint")
            return F.when(low == "st", saint).when(low.isin(*known), F.initcap(_look(full, low))).otherwise(_titled(t))

        return F.array_join(F.transform(main, word), " ")

    def unit(rest: Column) -> Column:
        names = F.create_map(*[F.lit(x) for p in UNIT_NAMES.items() for x in p])
        written = F.transform(rest, lambda t: F.coalesce(F.try_element_at(names, F.lower(t)), _titled(t)))
        return bound(written, lambda n: F.array_join(F.filter(n, lambda t, i: (i == 0) | (F.lower(t) != F.lower(F.get(n, i - 1)))), " "))

    def display(w: Column, n: Column) -> Column:
        main = bound(F.slice(w, 1, n), shown)
        return F.when(F.size(w) > n, F.concat(main, F.lit(", "), unit(F.slice(w, n + 1, F.size(w))))).otherwise(main)

    return bound(_tokens(F.regexp_replace(text, "[.,]", " ")), lambda w: bound(cut(w), lambda n: display(w, n)))


def street_signature(c: Column | str) -> Column:
    """struct(number, word): the leading house number and the first run of letters behind it, written out. A building's
    name before the first comma is dropped where a number follows the comma.
    """
    s = lower_trim(c)
    named = s.rlike(r"^[^,]*[a-z][^,]*,\s*\d") & ~s.rlike(r"^\s*\d")
    s = F.when(named, F.regexp_replace(s, r"^[^,]*,", "")).otherwise(s)
    number = F.regexp_extract(s, r"^\s*(\d+)", 1)
    word = bound(F.regexp_extract(F.regexp_replace(s, r"^\s*\d+", ""), "([a-z]+)", 1), lambda w: _look(SIGNATURE_WORDS, w))
    return F.struct(number.alias("number"), word.alias("word"))


def strip_suite(c: Column | str) -> Column:
    """The text before the first word that opens a unit."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?is)\b(suite|ste|unit|apt|apartment|floor|fl|rm|room|bldg|building|dept|department)\b.*$", ""))


def norm_zip(c: Column | str) -> Column:
    """The first five digits, or '' where there are fewer."""
    digits = F.regexp_replace(F.coalesce(col(c), F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5)).otherwise("")


def norm_phone(c: Column | str) -> Column:
    """The last ten digits, a leading 1 of eleven dropped; fewer digits stay as they are."""
    digits = F.regexp_replace(F.coalesce(col(c), F.lit("")), "[^0-9]", "")
    digits = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    return F.when(F.length(digits) >= 10, F.right(digits, F.lit(10))).otherwise(digits)


def city_key(c: Column | str) -> Column:
    """Lower-case letters and digits of the city."""
    return alnum_key(c)


def expand_city(c: Column | str) -> Column:
    """Lower-case city with ft, st and mt written out."""
    out = lower_trim(c)
    for short, long in CITY_WORDS.items():
        out = F.regexp_replace(out, rf"\b{short}\b\.?", long)
    return out


def bad_zip(zip_: Column | str, state: Column | str) -> Column:
    """True for a five-digit code whose first digit no code of the (known) state has."""
    digit = F.substring(col(zip_), 1, 1)
    possible = F.lit(None).cast("string")
    for d, states in ZIP_DIGIT.items():
        possible = F.when(col(state).isin(*states), d).otherwise(possible)
    return F.coalesce(col(zip_).rlike(r"^\d{5}$") & possible.isNotNull() & (digit != possible), F.lit(False))


def has_street(c: Column | str) -> Column:
    """True where the street has a digit."""
    return F.coalesce(col(c), F.lit("")).rlike(r"\d")


def looks_like_placeholder(street: Column | str, phone: Column | str, name: Column | str) -> Column:
    """True where street, phone or name is a made-up value: a 555 number, a sample street, the word example."""
    blob = F.lower(F.concat_ws(" ", *[F.coalesce(col(c), F.lit("")) for c in (street, phone, name)]))
    return blob.rlike(r"\b555[-).\s]?\d{4}\b|\b123 (research|study|main|example)\b|location a|location b|example")


def street_on_page(street: Column | str, page: Column | str) -> Column:
    """True where the street's number and its first distinctive word stand near each other in the page's text.

    A street without a leading number is taken as it is; one without any distinctive word needs its number alone.
    """
    text = F.regexp_replace(F.lower(F.coalesce(col(page), F.lit(""))), "[^a-z0-9]+", " ")
    number = F.regexp_extract(F.coalesce(col(street), F.lit("")), r"^\s*(\d+)", 1)
    words = F.regexp_extract_all(F.lower(F.coalesce(col(street), F.lit(""))), F.lit("([a-z]{3,})"), 1)
    own = F.filter(words, lambda w: ~w.isin(*INDISTINCT))
    rest = F.filter(words, lambda w: ~w.isin("suite", "ste", "unit", "floor"))
    word = F.coalesce(F.get(own, 0), F.get(rest, 0))
    near = F.concat(F.lit(r"\b"), number, F.lit(r"\b[^0-9]{0,50}\b"), word, F.lit(r"\b"))
    alone = F.array_contains(F.split(text, " "), number)
    return F.when(number == "", True).when(word.isNull(), alone).otherwise(F.rlike(text, near))


def parse_address_line(c: Column | str, states: list[str]) -> Column:
    """struct(street, city, state, zip) of a free address line: parts divided by commas, bars or dashes; the first
    five-digit number is the postal code and ends the line; a state code before it; a part with digits is the street.
    """
    line = F.regexp_replace(F.trim(F.coalesce(col(c), F.lit(""))), r"tel:\S+", "")
    line = F.regexp_replace(line, r"\s*[|—]\s*", ", ")

    def placed(parts: Column, state: Column, zip_: Column) -> Column:
        n = F.size(parts)
        at = F.array_position(F.transform(F.slice(parts, 1, 2), lambda p: p.rlike(r"\d")), F.lit(True)).cast("int")
        street = F.when(at > 0, F.get(parts, at - 1)).when((n > 2) & F.get(parts, n - 2).rlike(r"\d"), F.get(parts, n - 2)).otherwise("")
        city = F.when(at > 0, F.coalesce(F.get(parts, at), F.lit(""))).when(n > 0, F.get(parts, n - 1)).otherwise("")
        return F.struct(street.alias("street"), city.alias("city"), state.alias("state"), zip_.alias("zip"))

    def with_state(left: Column, zip_: Column) -> Column:
        code = F.regexp_extract(left, r"\b([A-Z]{2})\s*$", 1)

        def parted(state: Column) -> Column:
            rest = F.when(state != "", F.regexp_replace(left, r",?\s*\b[A-Z]{2}\s*$", "")).otherwise(left)
            parts = F.filter(F.transform(F.split(rest, ","), lambda p: F.trim(p)), lambda p: p != "")
            return bound(parts, lambda p: placed(p, state, zip_))

        return bound(F.when(code.isin(*states), code).otherwise(""), parted)

    def with_zip(whole: Column) -> Column:
        def left(zip_: Column) -> Column:
            rest = F.when(zip_ != "", F.regexp_replace(whole, r"(?s)\b\d{5}(?:-\d{4})?\b.*$", "")).otherwise(whole)
            return bound(F.trim(F.regexp_replace(rest, r"[,\s]+$", "")), lambda x: with_state(x, zip_))

        return bound(F.regexp_extract(whole, r"\b(\d{5})(?:-\d{4})?\b", 1), left)

    return bound(line, with_zip)


def fill_blank(c: Column | str, other: Column | str) -> Column:
    """The value, or the other one where it is blank."""
    return F.when(clean(c) == "", F.coalesce(col(other), F.lit(""))).otherwise(col(c))
