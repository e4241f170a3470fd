"""Pieces of ANSI SQL that several queries' texts are built of."""

from __future__ import annotations

from sitegrain.functions.addresses import CITY_WORDS, DIRECTIONS, SIGNATURE_WORDS, STREET_TYPES, UNIT_WORDS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cl(c: str) -> str:
    """Blank-safe trimmed text."""
    return f"trim(coalesce({c}, ''))"


def lt(c: str) -> str:
    return f"lower({cl(c)})"


def alnum(c: str) -> str:
    return f"regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]', '', 'g')"


def cases(t: str, words: dict[str, str]) -> str:
    return f"CASE {t} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items()) + f" ELSE {t} END"


def tokens(text: str) -> str:
    return rf"[t for t in string_split_regex({text}, '\s+') if t <> '']"


def norm_street(c: str) -> str:
    plain = rf"regexp_replace(replace(lower(coalesce({c}, '')), '#', ' suite '), '[^a-z0-9\s]', ' ', 'g')"
    return f"array_to_string([{cases('t', DIRECTIONS | STREET_TYPES)} for t in string_split_regex({plain}, '\\s+') if t <> ''], ' ')"


def norm_street_bare(c: str) -> str:
    """Without the unit: the tokens before the first unit word."""
    plain = rf"regexp_replace(replace(lower(coalesce({c}, '')), '#', ' suite '), '[^a-z0-9\s]', ' ', 'g')"
    listed = ", ".join(quoted(w) for w in UNIT_WORDS)
    cut = rf"regexp_replace(regexp_replace({plain}, '\s+', ' ', 'g'), '(^| )({'|'.join(UNIT_WORDS)})( .*)?$', '')"
    return f"array_to_string([{cases('t', DIRECTIONS | STREET_TYPES)} for t in string_split_regex({cut}, '\\s+') if t <> '' AND t NOT IN ({listed})], ' ')"


def unnamed(c: str) -> str:
    s = lt(c)
    return rf"CASE WHEN regexp_matches({s}, '^[^,]*[a-z][^,]*,\s*\d') AND NOT regexp_matches({s}, '^\s*\d') THEN regexp_replace({s}, '^[^,]*,', '') ELSE {s} END"


def sig_number(c: str) -> str:
    return rf"regexp_extract({unnamed(c)}, '^\s*(\d+)', 1)"


def sig_word(c: str) -> str:
    word = rf"regexp_extract(regexp_replace({unnamed(c)}, '^\s*\d+', ''), '([a-z]+)', 1)"
    return cases(word, SIGNATURE_WORDS)


def expand_city(c: str) -> str:
    out = lt(c)
    for short, long in CITY_WORDS.items():
        out = rf"regexp_replace({out}, '\b{short}\b\.?', '{long}', 'g')"
    return out


def digits(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '[^0-9]', '', 'g')"


def norm_zip(c: str) -> str:
    return f"CASE WHEN length({digits(c)}) >= 5 THEN substr({digits(c)}, 1, 5) ELSE '' END"


def norm_phone(c: str) -> str:
    d = digits(c)
    d = f"(CASE WHEN length({d}) = 11 AND {d} LIKE '1%' THEN substr({d}, 2, 10) ELSE {d} END)"
    return f"CASE WHEN length({d}) >= 10 THEN right({d}, 10) ELSE {d} END"


def contains_any(c: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), {quoted(p)})" for p in phrases) + ")"


def page_key(c: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace({lt(c)}, '[?#].*$', ''), '^[a-z][a-z0-9+.-]*://', ''), '^www\.|/+$', '', 'g')"


def norm_url(c: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({lt(c)}, '^https?://', ''), '[?#].*$', ''), '^www\.', ''), '/+$', '')"


def url_host(c: str) -> str:
    return rf"regexp_replace(regexp_extract(regexp_replace({lt(c)}, '^https?://', ''), '^([^/?#]*)', 1), '^www\.', '')"


def dedup_key(c: str) -> str:
    return rf"lower(regexp_replace(regexp_replace(coalesce({c}, ''), '^https?://(www\.)?', ''), '/+$', ''))"


def segments(c: str) -> str:
    return f"[s for s in string_split({page_key(c)}, '/')[2:] if s <> '']"


def filled(*columns: str) -> str:
    return " + ".join(f"(CASE WHEN {cl(c)} <> '' THEN 1 ELSE 0 END)" for c in columns)
