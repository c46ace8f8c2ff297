"""``City, ST`` out of free text.

Every pass scans the whole text once. A try starts only at the beginning of a
run of city characters (or where the last match ended), and the run is taken
possessively, so time is linear in the text and the regex stack stays flat on
long lines, with exactly the matches an unanchored search would give.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from contactmine.functions.text import (
    WS_JAVA as WS,
    let,
    squeeze_ws,
    text_array,
    title_if_upper,
    trim_ws,
)

# State names and their abbreviations.
STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR",
    "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "district of columbia": "DC", "florida": "FL", "georgia": "GA",
    "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN",
    "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA",
    "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI",
    "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT",
    "nebraska": "NE", "nevada": "NV", "new hampshire": "NH",
    "new jersey": "NJ", "new mexico": "NM", "new york": "NY",
    "north carolina": "NC", "north dakota": "ND", "ohio": "OH",
    "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA",
    "rhode island": "RI", "south carolina": "SC", "south dakota": "SD",
    "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT",
    "virginia": "VA", "washington": "WA", "west virginia": "WV",
    "wisconsin": "WI", "wyoming": "WY",
}

_RUN = rf"A-Za-z{WS}.\-'"
_START = rf"(?:\G|(?<![{_RUN}]))[{WS}.\-']*+"
_CITY = rf"[A-Za-z][{_RUN}]++"
_SP = f"[{WS}]"
_ZIP = r"[0-9]{5}(?:-[0-9]{4})?"

# What follows the comma behind a city; neither a city nor one of these holds a comma.
_ZIP_TAIL = rf"{_SP}*+[A-Za-z][A-Za-z{WS}]*+(?<={_SP}){_ZIP}"
_CODE_TAIL = rf"{_SP}*+[A-Za-z]{{2}}(?:{_SP}+{_ZIP}|{_SP}+United States|{_SP}|\z)"

# Group 1 of each pattern: the match from the first letter of the city on.
ZIP_PATTERN = rf"{_START}({_CITY},{_ZIP_TAIL})"
CODE_PATTERN = rf"{_START}({_CITY},{_CODE_TAIL})"
NAME_PATTERN = (
    rf"{_START}({_CITY}(?:,{_SP}*+)?,{_SP}*+[A-Za-z][A-Za-z{WS}]*+)(?=[0-9]{{5}}|,|\z)"
)
EDGE_PATTERN = rf"{_START}({_CITY},{_SP}*+[A-Za-z]{{2}})(?![\p{{L}}\p{{N}}_])"

_HAS_ZIP = r"[0-9]{5}"


@dataclass(frozen=True)
class LocationRule:
    """How one source reads a location.

    zip_codes: two-letter states count before a zip, not only full names.
    upper: write two-letter states in capitals.
    title: title-case cities written in capitals.
    names / edge: also try the full-name pass and the word-boundary pass.
    cutoff: only matches that start in this leading share of the text.
    strict: two letters must be a known state.
    squeeze: collapse white space first.
    max_scope_chars: longer texts give nothing.
    max_chars: look at this many leading characters.
    """

    zip_codes: bool = True
    upper: bool = True
    title: bool = False
    names: bool = False
    edge: bool = False
    cutoff: float | None = None
    strict: bool = False
    squeeze: bool = True
    max_scope_chars: int | None = None
    max_chars: int | None = None


def state_map() -> Column:
    return F.map_from_arrays(text_array(STATES.keys()), text_array(STATES.values()))


def state_code(raw: Column, strict: bool = False) -> Column:
    """Two letters pass in capitals unchecked (``strict`` checks them); a full name is looked up."""
    name = trim_ws(raw)
    two = F.upper(name)
    if strict:
        two = F.when(two.isin(sorted(STATES.values())), two)
    return F.when(name.rlike(r"^\p{L}{2}$"), two).otherwise(state_from_name(name))


def state_from_name(raw: Column) -> Column:
    return F.try_element_at(state_map(), F.lower(trim_ws(raw)))


def _render(match: Column, state: Callable[[Column], Column], title: bool) -> Column:
    """``City, ST`` of a match, null where its parts are not accepted."""
    return let(
        F.struct(
            trim_ws(F.substring_index(match, ",", 1)).alias("city"),
            state(F.substring_index(match, ",", -1)).alias("state"),
        ),
        lambda p: F.when(
            F.length(p["city"]).between(1, 50) & p["state"].isNotNull(),
            F.concat(
                title_if_upper(p["city"]) if title else p["city"],
                F.lit(", "),
                p["state"],
            ),
        ),
    )


def _first(
    text: Column, pattern: str, state: Callable[[Column], Column], title: bool
) -> Column:
    """The first accepted match of a pattern."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    shown = F.transform(matches, lambda match: _render(match, state, title))
    return F.get(F.filter(shown, lambda x: x.isNotNull()), F.lit(0))


def _first_by(
    text: Column,
    tail: str,
    cutoff: Column,
    state: Callable[[Column], Column],
    title: bool,
) -> Column:
    """The first accepted ``city,tail`` that starts at or before offset ``cutoff``.

    The text is cut behind each tail, which is one quick pass from comma to comma.
    A city is then read in the short stretch since the last comma only. Where no
    city stands before a tail, what follows its comma may begin the next city.
    """
    # \G: a search that fails does not start over one character further on.
    pieces = F.regexp_extract_all(
        text, F.lit(rf"\G(?:[^,]*+,(?!{tail}))*+[^,]*+,{tail}"), F.lit(0)
    )
    pattern = rf"{_START}({_CITY},{tail})"
    zero = F.struct(
        F.lit(0).alias("end"),
        F.lit("").alias("carry"),
        F.lit(None).cast("string").alias("location"),
    )

    def step(acc: Column, piece: Column) -> Column:
        end = acc["end"] + F.length(piece)
        stretch = F.substring_index(F.concat(acc["carry"], piece), ",", -2)

        def read(match: Column) -> Column:
            inside = (match != "") & (end - F.length(match) <= cutoff)
            rest = F.when(match == "", F.substring_index(piece, ",", -1)).otherwise("")
            return F.struct(
                end.alias("end"),
                rest.alias("carry"),
                F.when(inside, _render(match, state, title)).alias("location"),
            )

        found = let(F.regexp_extract(stretch, pattern, 1), read)
        return F.when(acc["location"].isNotNull(), acc).otherwise(found)

    return F.aggregate(pieces, zero, step, lambda acc: acc["location"])


def _pass(
    text: Column,
    tail: str,
    cutoff: Column | None,
    state: Callable[[Column], Column],
    title: bool,
) -> Column:
    if cutoff is None:
        return _first(text, rf"{_START}({_CITY},{tail})", state, title)
    return _first_by(text, tail, cutoff, state, title)


def _two_letters(rule: LocationRule) -> Callable[[Column], Column]:
    def state(rest: Column) -> Column:
        code = F.regexp_extract(rest, rf"^{_SP}*([A-Za-z]{{2}})", 1)
        shown = F.upper(code) if rule.upper else code
        if rule.strict:
            return F.when(F.upper(code).isin(sorted(STATES.values())), shown)
        return shown

    return state


def city_state_zip(
    text: Column, rule: LocationRule = LocationRule(), cutoff: Column | None = None
) -> Column:
    """First ``City, State ZIP`` whose state is known."""

    def state(rest: Column) -> Column:
        words = F.regexp_extract(rest, rf"^([A-Za-z{WS}]*)", 1)
        return state_code(words, rule.strict) if rule.zip_codes else state_from_name(words)

    return F.when(
        text.rlike(_HAS_ZIP),
        _pass(text, _ZIP_TAIL, cutoff, state, rule.title),
    )


def city_state_code(
    text: Column, rule: LocationRule = LocationRule(), cutoff: Column | None = None
) -> Column:
    """First ``City, XX`` followed by a zip, a space or the end."""
    return _pass(text, _CODE_TAIL, cutoff, _two_letters(rule), rule.title)


def city_state_name(text: Column, rule: LocationRule = LocationRule()) -> Column:
    """First ``City, Full State`` before a zip, a comma or the end."""
    return _first(text, NAME_PATTERN, state_from_name, rule.title)


def city_word_edge(text: Column, rule: LocationRule = LocationRule()) -> Column:
    """First ``City, XX`` that ends at a word boundary."""
    return _first(text, EDGE_PATTERN, _two_letters(rule), rule.title)


def has_location(text: Column) -> Column:
    """True where a text holds a ``City, State ZIP`` or a ``City, XX``."""
    return text.rlike(ZIP_PATTERN) | text.rlike(CODE_PATTERN)


def find_location(text: Column, rule: LocationRule) -> Column:
    """All passes of a rule in order, on one text."""

    def passes(t: Column) -> Column:
        cutoff = None
        if rule.cutoff is not None:
            cutoff = F.floor(F.length(t) * F.lit(rule.cutoff)).cast("int")
        tries = [city_state_zip(t, rule, cutoff), city_state_code(t, rule, cutoff)]
        if rule.names:
            tries.append(city_state_name(t, rule))
        if rule.edge:
            head = t if cutoff is None else F.left(t, cutoff)
            tries.append(city_word_edge(head, rule))
        return F.coalesce(*tries)

    scope = text if rule.max_chars is None else F.left(text, F.lit(rule.max_chars))
    ready = squeeze_ws(scope) if rule.squeeze else scope
    allowed = F.contains(scope, F.lit(","))
    if rule.max_scope_chars is not None:
        allowed = allowed & (F.length(scope) <= rule.max_scope_chars)
    return F.when(allowed, let(ready, passes))


def first_location(scopes: Column, rule: LocationRule) -> Column:
    """Location of the first scope (array of texts) that has one."""
    return F.aggregate(
        scopes,
        F.lit(None).cast("string"),
        lambda found, text: F.coalesce(found, find_location(text, rule)),
    )
