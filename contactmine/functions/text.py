"""Text clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

from contactmine.schema import MISSING

# The Unicode white space that string stripping removes, as a
# character list and as the body of a regex class. Java's \s is ASCII only.
WS_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = (
    r"\s\x{000b}\x{001c}-\x{001f}\x{0085}\x{00a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same class for Java patterns over long texts: characters below 256 are one table
# lookup, and the others are only tried from U+1680 to U+3000.
WS_JAVA = (
    r" \t\n\x{000b}\f\r\x{001c}\x{001d}\x{001e}\x{001f}\x{0085}\x{00a0}"
    r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)

# Elements whose text is never shown.
HIDDEN_TAGS = ["script", "style", "noscript", "template", "title"]

# Elements that start and end on a line of their own.
BLOCK_TAGS = [
    "address", "article", "aside", "blockquote", "body", "br", "caption", "dd",
    "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
    "html", "legend", "li", "main", "nav", "ol", "option", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr",
    "ul",
]

# Entities to decode; the ampersand itself comes last.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#34;": '"',
    "&#39;": "'",
    "&apos;": "'",
    "&nbsp;": "\xa0",
    "&#160;": "\xa0",
    "&copy;": "\xa9",
    "&middot;": "\xb7",
    "&raquo;": "\xbb",
    "&ndash;": "–",
    "&mdash;": "—",
    "&commat;": "@",
    "&#64;": "@",
    "&amp;": "&",
}

# The rest of a tag: quoted values may hold any character, and another tag's start
# ends the try, so that a page of unclosed tags takes linear time.
_TAG_REST = r"""(?:=[ \t\r\n\f]*+(?:"[^"]*+"|'[^']*+')|[^<>])*+>"""
HIDDEN_PATTERN = (
    "(?is)"
    + "|".join(rf"<{t}\b{_TAG_REST}.*?(?:</{t}\s*>|\z)" for t in HIDDEN_TAGS)
    + r"|<!--.*?(?:-->|\z)"
)
BLOCK_PATTERN = rf"(?i)</?(?:{'|'.join(BLOCK_TAGS)})\b{_TAG_REST}"
TAG_PATTERN = rf"</?[a-zA-Z!?]{_TAG_REST}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_array(items: Iterable[str]) -> Column:
    """A literal array of texts, built in one call."""
    quoted = [
        "'" + item.replace("\\", "\\\\").replace("'", "\\'") + "'" for item in items
    ]
    return F.expr(f"array({', '.join(quoted)})").cast("array<string>")


def trim_ws(col: Column) -> Column:
    """Strip all Unicode white space from both ends (SQL trim strips only spaces)."""
    return F.btrim(col, F.lit(WS_CHARS))


def squeeze_ws(col: Column) -> Column:
    """Turn every run of white space, no-break space included, into one space."""
    return trim_ws(F.regexp_replace(col, f"[{WS_JAVA}]+", " "))


def blank_to_null(col: Column) -> Column:
    return F.nullif(trim_ws(col), F.lit(""))


def text_or(col: Column, default: str = MISSING) -> Column:
    """Stripped text, or the default when missing or blank."""
    return F.coalesce(blank_to_null(col), F.lit(default))


def title_case(col: Column) -> Column:
    """Upper-case every letter that follows a non-letter (``initcap`` only looks at spaces)."""
    words = F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(
            words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
        ),
        "",
    )


def title_if_upper(col: Column) -> Column:
    """Title-case a text only when it is written in capitals throughout."""
    shouting = (col == F.upper(col)) & col.rlike(r"\p{L}")
    return F.when(shouting, title_case(col)).otherwise(col)


def decode_entities(col: Column) -> Column:
    decoded = col
    for entity, char in ENTITIES.items():
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return decoded


def markup_to_text(html: Column) -> Column:
    """Readable text of an HTML fragment, one line per block element."""
    flat = F.regexp_replace(html, r"[ \t\r\n\f]+", " ")
    shown = F.regexp_replace(flat, HIDDEN_PATTERN, " ")
    lined = F.regexp_replace(shown, BLOCK_PATTERN, "\n")
    bare = F.regexp_replace(lined, TAG_PATTERN, "")
    spaced = F.regexp_replace(bare, r" {2,}", " ")
    return trim_ws(decode_entities(F.regexp_replace(spaced, r" ?\n[ \n]*", "\n")))


def visible_text(html: Column, prefer_main: bool = False) -> Column:
    """Text a reader sees on a page; with ``prefer_main`` that of ``<main>`` when it has any."""
    whole = markup_to_text(html)
    if not prefer_main:
        return whole
    main = F.regexp_extract(html, r"(?is)<main\b[^>]*>(.*?)</main\s*>", 1)
    return F.coalesce(F.nullif(markup_to_text(main), F.lit("")), whole)


def text_lines(col: Column) -> Column:
    """Non-empty stripped lines, in order, as an array."""
    return F.filter(F.transform(F.split(col, "\n"), trim_ws), lambda line: line != "")


def first_line(col: Column) -> Column:
    return trim_ws(F.substring_index(col, "\n", 1))
