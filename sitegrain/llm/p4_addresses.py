"""Problem 4: the same postal address written differently.

An address is parsed into components (house number, direction, street name, street kind, unit, city, state, postal
code), abbreviations are expanded by the dictionaries of a locale, the order of the parts is made canonical, and the
canonical forms are joined on hierarchical keys: the number with the postal code or the city and the street's first
letter, with the state and the beginning or end of the street, or with the whole street. Rules for each component, missing ones included, then decide on the joined forms.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions.text import clean, is_blank
from sitegrain.llm.p2_residue import dummy_street, dummy_text
from sitegrain.llm.pairs import row_pairs
from sitegrain.sources.tables import materialize, table

# The dictionaries of the locale en_US.
KINDS = {
    "street": "st str", "avenue": "ave av aven", "road": "rd", "drive": "dr drv", "boulevard": "blvd boul bvd", "lane": "ln", "court": "ct crt",
    "place": "pl", "plaza": "plz plza", "parkway": "pkwy pky pkway", "highway": "hwy hiway hiwy", "way": "wy", "trail": "trl", "terrace": "ter terr",
    "circle": "cir circ crcl", "square": "sq", "alley": "aly", "loop": "lp", "expressway": "expy", "freeway": "fwy", "turnpike": "tpke", "pike": "pk", "crossing": "xing", "path": "", "row": "", "walk": "",
}
DIRECTIONS = {"n": "north no", "s": "south so", "e": "east", "w": "west", "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest"}
NAME_WORDS = {"saint": "st", "mount": "mt", "fort": "ft", "port": "pt", "springs": "spgs spg", "heights": "hts", "hills": "hls", "creek": "crk", "lake": "lk", "ridge": "rdg", "mill": "ml", "hill": "hl", "old": "", "new": "", "grove": "grv", "park": "pk", "falls": "fls", "center": "ctr centre"}
FEATURES = ["creek", "lake", "ridge", "mill", "hill", "hills", "grove", "park", "falls", "springs", "heights"]
UNITS = "suite ste unit room rm floor fl building bldg apartment apt number no office ofc"
ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split()
COMPONENTS = ["number", "direction", "name", "feature", "kind", "unit", "city", "state", "zip"]
PARSED = "ord long, raw long, " + ", ".join(f"{c} string" for c in COMPONENTS)

KIND = {short: long for long, shorts in KINDS.items() for short in [long, *shorts.split()]}
DIRECTION = {long: short for short, longs in DIRECTIONS.items() for long in [short, *longs.split()]}
WORD = {short: long for long, shorts in NAME_WORDS.items() for short in [long, *shorts.split()]}
UNIT = set(UNITS.split())
CITY_WORD = WORD | {"n": "north", "s": "south", "e": "east", "w": "west", "no": "north", "so": "south"}
NUMBER_WORD = {w: f"{i}{ {1: 'st', 2: 'nd', 3: 'rd'}.get(i, 'th') }" for i, w in enumerate(ORDINALS, 1)}


def one_slip(a: str, b: str) -> bool:
    """True where one letter dropped, added, replaced or swapped with its neighbour turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) < len(b):
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


@lru_cache(100_000)
def _fuzzy(word: str, which: str) -> str:
    """The entry of a dictionary that the word is, or is one slip from, where that is only one; else ''."""
    known = {"kind": KIND, "direction": DIRECTION, "unit": {u: u for u in UNIT}, "feature": {f: f for f in FEATURES}, "city": CITY_WORD}[which]
    if word in known:
        return known[word]
    if word in WORD:
        return WORD[word] if which == "feature" and WORD[word] in FEATURES else ""
    near = {known[k] for k in known if len(k) >= 4 and len(word) >= 3 and one_slip(word, k)}
    return near.pop() if len(near) == 1 else ""


def _plain(text: str | None) -> str:
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text or "").lower().replace("’", "'").replace(".", "")).strip()


def _zip(text: str) -> str:
    """Five digits, or another country's code without its blanks."""
    found = re.search(r"\b(\d{5})(?:-?\d{4})?\b", text)
    if found:
        return found[1]
    found = re.search(r"\b([a-z]\d[a-z]) ?(\d[a-z]\d)\b", text)
    return found[1] + found[2] if found else "0" + text if re.fullmatch(r"\d{4}", text) else ""


def _city(text: str) -> str:
    words = re.findall(r"[^\W\d_]+", text.replace("'", ""))
    return " ".join(CITY_WORD.get(w) or (len(w) > 3 and len(words) > 1 and _fuzzy(w, "city")) or w for w in words)


@lru_cache(100_000)
def _state(text: str, states: tuple[tuple[str, str], ...]) -> str:
    """The code of a state written as code, name, its beginning or with one slip; '' where it is none."""
    word = re.sub(r"[^a-z ]", "", re.sub(r"\(.*\)", "", text)).strip()
    squashed = word.replace(" ", "")
    for code, name in states:
        if squashed in (code, name.replace(" ", "")):
            return code
    if len(squashed) < 3:
        return ""
    full = re.sub(r"^(n|s|w) ", lambda m: {"n": "north ", "s": "south ", "w": "west "}[m[1]], word).replace(" ", "")
    starts = {code for code, name in states if name.replace(" ", "").startswith(full)}
    near = {code for code, name in states if one_slip(name.replace(" ", ""), squashed)}
    found = starts if len(starts) == 1 else near
    return next(iter(found)) if len(found) == 1 else ""


UNIT_AFTER = re.compile(r"(?:^|\s)(\d+)(?:st|nd|rd|th)? (?:floor|fl)$|(?:^|\s)(\d+)(?:st|nd|rd|th) (?:floor|fl)\b")
UNIT_HASH = re.compile(r"(?:\b([a-z]+) ?)?#+ ?(\d+ ?-?[a-z]?|[a-z])(?=$|\s)")
UNIT_BEFORE = re.compile(r"\b([a-z]+) (\d+ ?-?[a-z]?|[a-z])(?=$|\s)")


def _take_unit(part: str) -> tuple[str, str]:
    """(part without its unit, unit number)."""
    found = UNIT_AFTER.search(part)
    if found and not (found[1] and not re.search(r"\d(?:st|nd|rd|th) ", found[0])):
        return (part[: found.start()] + " " + part[found.end() :]).strip(), found[1] or found[2]
    found = UNIT_HASH.search(part)
    if found:
        kept = "" if found[1] is None or _fuzzy(found[1], "unit") else found[1]
        return f"{part[: found.start()]} {kept} {part[found.end() :]}".strip(), re.sub(r"[ -]", "", found[2])
    for found in UNIT_BEFORE.finditer(part):
        word = found[1]
        if word in UNIT or (len(word) >= 4 and found.start() > 0 and found.end() == len(part) and _fuzzy(word, "unit")):
            return (part[: found.start()] + " " + part[found.end() :]).strip(), re.sub(r"[ -]", "", found[2])
    return part, ""


def parse(street: str, city: str, state: str, code: str, states: tuple[tuple[str, str], ...]) -> tuple[str, ...]:
    """The components in the order of COMPONENTS, each '' where it is missing."""
    unit, whole = "", re.sub(r"\([^()]*\)", " ", _plain(street))
    parts = []
    for part in whole.split(","):
        rest, found = _take_unit(part.strip())
        unit = unit or found
        if rest.strip(" #-"):
            parts.append(re.sub(r"\s+", " ", rest).strip(" #-"))
    city_text, state_text, zip_text = _plain(city), _plain(state), _plain(code)
    zip_code = _zip(zip_text)
    if "," in city_text or re.search(r"\d", city_text):
        zip_code = zip_code or _zip(city_text)
        head, _, tail = city_text.partition(",")
        city_text, state_text = head, state_text or re.sub(r"[\d-]", "", tail).strip()
    main = next((i for i, p in enumerate(parts) if re.search(r"(?:^|\s)\d+[a-z]?(?=$|\s)", p) and re.search(r"[a-z]{3}|\d(?:st|nd|rd|th)\b", p) and not re.fullmatch(r"[a-z]{2,} \d{5}(-\d{4})?", p.strip() if i else "")), 0)
    words = re.findall(r"[\w'&-]+", parts[main]) if parts else []
    for part in parts[main + 1 :]:
        if re.search(r"\d", part):
            zip_code = zip_code or _zip(part)
            state_text = state_text or re.sub(r"[\d-]", "", part).strip()
        elif len(part) == 2 and not state_text:
            state_text = part
        elif not city_text and not re.search(r"\b(plaza|tower|building|center)\b", part):
            city_text = part
    number = ""
    digits = [i for i, w in enumerate(words) if re.fullmatch(r"\d+[a-z]?", w)]
    if digits:
        at = 0 if digits[0] == 0 else digits[-1]
        at = at if at in (0, len(words) - 1) else digits[0]
        if 0 < at < len(words) - 1 and (len(words) - at) > 1:
            words = words[at:]  # a building's name before the number
            at = 0
        number = words.pop(at).lstrip("0") or "0"
    left = [NUMBER_WORD.get(w, w) for w in words]
    direction = kind = feature = ""
    if len(left) > 2 and left[-2:] in (["north", "east"], ["north", "west"], ["south", "east"], ["south", "west"]):
        left[-2:] = ["".join(left[-2:])]
    if len(left) > 2 and left[0] in ("north", "south", "n", "s") and left[1] in ("east", "west", "e", "w"):
        left[:2] = [DIRECTION[left[0]] + DIRECTION[left[1]]]
    if len(left) > 1 and left[-1] in DIRECTION:
        direction = DIRECTION[left.pop()]
    elif len(left) > 2 and len(left[-1]) >= 4 and _fuzzy(left[-1], "direction"):
        direction = _fuzzy(left.pop(), "direction")
    if len(left) > 1 and not direction and (left[0] in DIRECTION or (len(left[0]) >= 4 and len(left) > 2 and _fuzzy(left[0], "direction"))) and not (len(left) == 2 and left[1] in KIND):
        direction = _fuzzy(left.pop(0), "direction")
    if len(left) > 1 and _fuzzy(left[-1], "kind"):
        kind = _fuzzy(left.pop(), "kind")
        if len(left) > 1 and not direction and left[-1] in DIRECTION:
            direction = DIRECTION[left.pop()]
    if len(left) > 1 and _fuzzy(left[-1], "feature"):
        feature = _fuzzy(left.pop(), "feature")
    name = "".join(WORD.get(w, w) for w in left)
    return number, direction, name, feature, kind, unit, _city(city_text), _state(state_text, states), zip_code


def _parse_rows(batches: Iterator[pa.RecordBatch], states: tuple[tuple[str, str], ...]) -> Iterator[pa.RecordBatch]:
    cached = lru_cache(50_000)(partial(parse, states=states))
    for batch in batches:
        street, city, state, code = (batch.column(i).to_pylist() for i in range(2, 6))
        found = [cached(*x) for x in zip(street, city, state, code)]
        cols = [pa.array(c, pa.string()) for c in zip(*found)] if found else [pa.array([], pa.string())] * len(COMPONENTS)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], ["ord", "raw", *COMPONENTS])


def _alike(a: Column, b: Column) -> Column:
    """Equal up to slips of typing: one edit in up to six letters, two in up to nine, three in longer words."""
    longer = F.greatest(F.length(a), F.length(b))
    swapped = (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    allowed = F.when(longer >= 10, F.when(swapped, 4).otherwise(3)).when(longer >= 7, 2).when(longer >= 4, F.when(swapped, 2).otherwise(1)).otherwise(0)
    return (a == b) | ((F.abs(F.length(a) - F.length(b)) <= 3) & (F.pmod(F.levenshtein(a, b, 4), F.lit(100)) <= allowed))  # -1, too far, becomes 99


def same_place(l: str, r: str) -> Column:
    """The rules: numbers and features agree; the street is alike; direction, kind and unit agree or are missing in one;
    the cities are alike; where a city is missing, that of its postal code is alike or the postal codes are; where these
    are missing too the street is equal and the states agree.
    """
    x, y = (lambda c: F.col(f"{l}.{c}")), (lambda c: F.col(f"{r}.{c}"))

    def free(c: str) -> Column:
        return (x(c) == "") | (y(c) == "") | (x(c) == y(c))

    def given(c: str) -> Column:
        return (x(c) != "") & (y(c) != "")

    place = (
        F.when(given("city"), _alike(x("city"), y("city")) & (free("state") | (x("zip") == y("zip"))))
        .when(given("town") | given("zip"), (given("town") & _alike(x("town"), y("town")) | given("zip") & _alike(x("zip"), y("zip"))) & free("state"))
        .otherwise((x("name") == y("name")) & given("state") & free("state"))
    )
    numbered = x("name").rlike(r"\d") | y("name").rlike(r"\d")
    street = (x("name") == y("name")) | (~numbered & _alike(x("name"), y("name")))
    return (x("number") == y("number")) & (x("feature") == y("feature")) & street & free("direction") & free("kind") & free("unit") & place


def parse_addresses(rows: DataFrame, states: tuple[tuple[str, str], ...]) -> DataFrame:
    """(ord, raw, components) of every row whose street is neither blank nor a dummy; ``raw`` is one number for the four fields as stored."""
    stored = [F.when(is_blank(c), "").otherwise(F.col(c)) for c in ("address_street", "address_city", "address_state", "address_zip")]
    kept = rows.where(~is_blank("address_street") & ~F.coalesce(dummy_street("address_street"), F.lit(False)))
    fields = ["address_street", *[F.when(F.coalesce(dummy_text(c), F.lit(False)), "").otherwise(clean(c)).alias(c) for c in ("address_city", "address_state", "address_zip")]]
    return kept.select(F.col("ord").cast("long"), F.xxhash64(*stored).alias("raw"), *fields).mapInArrow(partial(_parse_rows, states=states), PARSED)


def same_addresses(rows: DataFrame, states: tuple[tuple[str, str], ...], zips: DataFrame) -> DataFrame:
    """Pairs (ord_a < ord_b) of rows whose addresses denote one place and differ as stored.

    ``zips`` (zip, city, state) gives the city and state of a row that has a postal code alone; of several the first counts.

    ``rows``: ord (unique), address_street, address_city, address_state, address_zip; other columns are ignored. Null,
    empty and space-only fields are missing components. Rows with no street, a dummy street or no house number are in
    no pair; rows of equal fields are not paired with each other; an empty table gives no pair. Rows are reduced to
    canonical forms before any join, so copies of an address cost one row in the search.
    """
    parsed = materialize(parse_addresses(rows, states).where("number <> '' and name <> ''"), "p4-parsed")
    forms = parsed.groupBy(*COMPONENTS).agg(F.min("ord").alias("form"))
    members = materialize(parsed.join(forms, COMPONENTS).select(F.col("form").alias("grp"), "raw", "ord"), "p4-members")
    known = zips.groupBy("zip").agg(F.min(F.lower("city")).alias("_town"), F.min(F.lower("state")).alias("_area"))
    forms = forms.join(known, "zip", "left").withColumns({"town": F.coalesce(F.expr("nullif(city, '')"), "_town", F.lit("")), "area": F.coalesce(F.expr("nullif(state, '')"), "_area", F.lit(""))})
    initial, head, tail = F.substring("name", 1, 1), F.substring("name", 1, 4), F.expr("right(name, 4)")
    keys = F.array(
        F.when(F.col("zip") != "", F.xxhash64("number", initial, "zip", F.lit("a"))), F.when(F.col("town") != "", F.xxhash64("number", initial, "town", F.lit("b"))),
        F.when(F.col("area") != "", F.xxhash64("number", head, "area", F.lit("c"))), F.when(F.col("area") != "", F.xxhash64("number", tail, "area", F.lit("d"))),
        F.xxhash64("number", "name", "feature", F.lit("e")),
    )
    keyed = forms.select("form", *COMPONENTS, "town", F.explode(F.array_compact(keys)).alias("key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.form") < F.col("b.form"))).where(same_place("a", "b"))
    pairs = met.select(F.col("a.form").alias("ga"), F.col("b.form").alias("gb")).distinct()
    return row_pairs(members, pairs)


def state_list(spark: SparkSession, sf_dir: str) -> tuple[tuple[str, str], ...]:
    """The (code, name) of each state in lower case: a reference list that doesn't grow with the data."""
    rows = table(spark, sf_dir, "state_ref").select("state_code", "state_name").collect()
    return tuple(sorted((r[0].lower(), r[1].lower()) for r in rows if r[0] and r[1]))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of location rows whose addresses denote one place though they are stored differently."""
    rows = table(spark, sf_dir, "locations").select("ord", "address_street", "address_city", "address_state", "address_zip")
    return same_addresses(rows, state_list(spark, sf_dir), table(spark, sf_dir, "zip_dim").select("zip", "city", "state"))


def p4_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical components of every location's address."""
    rows = table(spark, sf_dir, "locations").select("ord", "address_street", "address_city", "address_state", "address_zip")
    return parse_addresses(rows, state_list(spark, sf_dir)).drop("raw")
