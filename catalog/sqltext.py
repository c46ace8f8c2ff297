"""Pieces of checker SQL: the rules written a second time, in that engine's own terms."""

from __future__ import annotations

from contactmine.functions.locations import STATES
from contactmine.functions.text import BLOCK_TAGS, ENTITIES, HIDDEN_TAGS, WS

# The patterns of e-mail addresses and phones in text.
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE = rf"\(?\d{{3}}\)?[{WS}.\-]?\d{{3}}[{WS}.\-]?\d{{4}}"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def squeeze(x: str) -> str:
    return trim(f"regexp_replace({x}, '[{WS}]+', ' ', 'g')")


def words(items) -> str:
    return "[" + ", ".join(quoted(i) for i in items) + "]"


def hits(x: str, keywords) -> str:
    return f"list_filter({words(keywords)}, lambda kw: contains(lower({x}), lower(kw)))"


def visible(html: str) -> str:
    hidden = "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in HIDDEN_TAGS)
    x = rf"regexp_replace({html}, '[ \t\r\n\f]+', ' ', 'g')"
    x = rf"regexp_replace({x}, '(?is){hidden}|<!--.*?(?:-->|\z)', ' ', 'g')"
    x = rf"regexp_replace({x}, '(?i)</?(?:{'|'.join(BLOCK_TAGS)})\b[^>]*>', chr(10), 'g')"
    x = rf"regexp_replace({x}, '</?[a-zA-Z!?][^>]*>', '', 'g')"
    x = rf"regexp_replace({x}, ' {{2,}}', ' ', 'g')"
    x = rf"regexp_replace({x}, ' ?\n[ \n]*', chr(10), 'g')"
    for entity, char in ENTITIES.items():
        x = f"replace({x}, {quoted(entity)}, {quoted(char)})"
    return trim(x)


def title(x: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all(lower({x}), '\p{{L}}+|\P{{L}}+'), "
        "lambda w: upper(w[1:1]) || w[2:]), '')"
    )


STATE_MAP = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in STATES.items()) + "}"

# The unanchored patterns; this engine's matcher needs linear time for them.
CITY = rf"([A-Za-z][A-Za-z{WS}.\-'']+)"
CITY_LAZY = rf"([A-Za-z][A-Za-z{WS}.\-'']+?)"
NAMES = rf"([A-Za-z]+(?:[{WS}]+[A-Za-z]+)*)"
ZIP = rf"(?i){CITY_LAZY},[{WS}]*{NAMES}[{WS}]+(?:\d{{5}}(?:-\d{{4}})?)"
CODE = (
    rf"{CITY},[{WS}]*([A-Za-z]{{2}})"
    rf"(?:[{WS}]+\d{{5}}(?:-\d{{4}})?|[{WS}]+United States|[{WS}]|$)"
)
# The look-ahead is taken along: what it holds cannot be part of a city.
NAME = rf"(?i){CITY_LAZY},?[{WS}]*,[{WS}]*{NAMES}[{WS}]*(?:\d{{5}}(?:-\d{{4}})?|$|,)"
EDGE = rf"{CITY},[{WS}]*([A-Za-z]{{2}})(?:[^\p{{L}}\p{{N}}_]|$)"


def location_pass(
    text: str, pattern: str, state: str, title_cities: bool = False
) -> str:
    """First accepted match; ``state`` is SQL over ``p.s``."""
    city = trim("p.c")
    shown = (
        f"CASE WHEN {city} = upper({city}) THEN {title(city)} ELSE {city} END"
        if title_cities
        else city
    )
    pairs = (
        f"list_transform(list_zip(regexp_extract_all({text}, '{pattern}', 1), "
        f"regexp_extract_all({text}, '{pattern}', 2)), lambda z: {{'c': z[1], 's': z[2]}})"
    )
    return (
        f"list_filter(list_transform({pairs}, lambda p: CASE WHEN length({city}) BETWEEN 1 AND 50 "
        f"THEN {shown} || ', ' || {state} END), lambda r: r IS NOT NULL)[1]"
    )


ANY_STATE = (
    f"CASE WHEN regexp_matches({trim('p.s')}, '^[A-Za-z]{{2}}$') THEN upper({trim('p.s')}) "
    f"ELSE {STATE_MAP}[lower({trim('p.s')})] END"
)
NAMED_STATE = f"{STATE_MAP}[lower({trim('p.s')})]"


def location_a(text: str) -> str:
    t = squeeze(text)
    return (
        "coalesce("
        f"{location_pass(t, ZIP, NAMED_STATE)}, {location_pass(t, CODE, 'p.s')}, "
        f"{location_pass(t, NAME, NAMED_STATE)}, {location_pass(t, EDGE, 'p.s')})"
    )


def location_b(text: str) -> str:
    t = squeeze(text)
    return (
        f"coalesce({location_pass(t, ZIP, ANY_STATE, True)}, "
        f"{location_pass(t, CODE, 'upper(p.s)', True)})"
    )


def location_c(text: str) -> str:
    t = squeeze(text)
    return (
        f"coalesce({location_pass(t, ZIP, ANY_STATE)}, "
        f"{location_pass(t, CODE, 'upper(p.s)')}, {location_pass(t, EDGE, 'upper(p.s)')})"
    )
