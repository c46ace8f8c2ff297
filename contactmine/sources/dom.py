"""Pages to element trees: the one step that needs Python.

Spark hands each task Arrow batches of pages; the standard library's tokenizer
walks a page and a few flat lists go back as one array column. Everything that
reads the tree afterwards is a column expression (``functions.dom``). Plans
run this only on pages that passed the keyword test.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from contactmine.functions.dom import text_of
from contactmine.functions.text import BLOCK_TAGS, HIDDEN_TAGS

# The parser travels with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_TYPE = T.StructType(
    [
        T.StructField("node_id", T.IntegerType()),
        T.StructField("parent_id", T.IntegerType()),
        T.StructField("prev_id", T.IntegerType()),
        T.StructField("next_id", T.IntegerType()),
        T.StructField("last_id", T.IntegerType()),
        T.StructField("sib_ord", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("classes", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("t0", T.IntegerType()),
        T.StructField("t1", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)

# Elements without content, and end tags that may be left out:
# a start tag closes the open elements listed for it, up to the given limits.
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = set(BLOCK_TAGS)
_HIDDEN = set(HIDDEN_TAGS)
_CLOSES = {
    "li": ({"li", "p"}, {"ul", "ol"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_P_LIMITS = {"td", "th", "button", "table"}
_NOT_P = {"body", "html", "br", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}

# Longest element text kept beside its offsets.
_SHORT_TEXT = 256
_SPACES = re.compile(r"[ \t\r\n\f]+")


class _Tree(HTMLParser):
    """Collects a page's elements in document order and its visible text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[int] = []
        self.children: dict[int, list[int]] = {}
        self.pieces: list[str] = []
        self.length = 0
        self.gap = ""
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        closes, limits = _CLOSES.get(tag, (set(), set()))
        if tag in _BLOCK and tag not in _NOT_P and not closes:
            closes, limits = {"p"}, _P_LIMITS
        self._close_implied(closes, limits)
        if tag in _BLOCK:
            self._break()
        here = len(self.nodes)
        above = self.open[-1] if self.open else None
        siblings = self.children.setdefault(above, [])
        before = siblings[-1] if siblings else None
        if before is not None:
            self.nodes[before]["next_id"] = here
        values = {k: v or "" for k, v in attrs}
        self.nodes.append(
            {
                "node_id": here, "parent_id": above, "prev_id": before, "next_id": None,
                "last_id": here, "sib_ord": len(siblings), "depth": len(self.open),
                "tag": tag, "classes": values.get("class"), "attrs": values,
                "t0": self.length, "t1": self.length,
            }
        )
        siblings.append(here)
        if tag not in _VOID:
            self.open.append(here)
            self.hidden += tag in _HIDDEN

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for level in range(len(self.open) - 1, -1, -1):
            name = self.nodes[self.open[level]]["tag"]
            if name == tag:
                self._pop_to(level)
                break
            if name in _BLOCK and tag not in _BLOCK:
                break
        if tag in _BLOCK:
            self._break()

    def handle_data(self, data):
        if self.hidden:
            return
        words = [w for w in _SPACES.split(data) if w]
        if data[:1] in " \t\r\n\f":
            self._space()
        for i, word in enumerate(words):
            if i:
                self._space()
            if self.gap and self.length:
                self._write(self.gap)
            self.gap = ""
            self._write(word)
        if words and data[-1:] in " \t\r\n\f":
            self._space()

    def finish(self) -> str:
        self.close()
        self._pop_to(0)
        body = "".join(self.pieces)
        for node in self.nodes:
            short = node["t1"] - node["t0"] <= _SHORT_TEXT
            node["text"] = body[node["t0"]:node["t1"]].strip() if short else None
        return body

    def _write(self, text):
        self.pieces.append(text)
        self.length += len(text)

    def _space(self):
        self.gap = self.gap or " "

    def _break(self):
        self.gap = "\n"

    def _pop_to(self, level):
        while len(self.open) > level:
            node = self.nodes[self.open.pop()]
            node["last_id"] = len(self.nodes) - 1
            node["t1"] = self.length
            self.hidden -= node["tag"] in _HIDDEN

    def _close_implied(self, closes, limits):
        for level in range(len(self.open) - 1, -1, -1):
            name = self.nodes[self.open[level]]["tag"]
            if name in limits:
                return
            if name in closes:
                self._pop_to(level)


def _parse(html: str | None) -> tuple[list[dict], str | None, str | None]:
    if html is None:
        return [], None, None
    tree = _Tree()
    try:
        tree.feed(html)
        return tree.nodes, tree.finish(), None
    except Exception as error:  # a bad page is marked, the job goes on
        return [], None, f"{type(error).__name__}: {error}"


def _node_array(pages: list[list[dict]]) -> pa.Array:
    flat = [n for nodes in pages for n in nodes]
    offsets = [0]
    for nodes in pages:
        offsets.append(offsets[-1] + len(nodes))
    attr_offsets, keys, values = [0], [], []
    for n in flat:
        keys.extend(n["attrs"].keys())
        values.extend(n["attrs"].values())
        attr_offsets.append(len(keys))
    columns = []
    for field in NODE_TYPE.fields:
        if field.name == "attrs":
            columns.append(
                pa.MapArray.from_arrays(
                    pa.array(attr_offsets, pa.int32()),
                    pa.array(keys, pa.string()),
                    pa.array(values, pa.string()),
                )
            )
        else:
            kind = pa.int32() if isinstance(field.dataType, T.IntegerType) else pa.string()
            columns.append(pa.array([n[field.name] for n in flat], kind))
    structs = pa.StructArray.from_arrays(columns, NODE_TYPE.names)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace ``html`` by ``body_text``, ``dom`` and ``parse_error``.

    Select only the columns you need first: all others pass through Python.
    """
    kept = [f for f in pages.schema.fields if f.name != html]
    schema = T.StructType(
        kept
        + [
            T.StructField("body_text", T.StringType()),
            T.StructField("dom", T.ArrayType(NODE_TYPE)),
            T.StructField("parse_error", T.StringType()),
        ]
    )
    names = [f.name for f in kept]

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                parsed = [_parse(h) for h in part.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in names]
                    + [
                        pa.array([p[1] for p in parsed], pa.string()),
                        _node_array([p[0] for p in parsed]),
                        pa.array([p[2] for p in parsed], pa.string()),
                    ],
                    names=schema.names,
                )

    return pages.mapInArrow(parse_batches, schema)


def nodes_table(parsed: DataFrame, *keys: str) -> DataFrame:
    """One row per element, with its text, for queries that want a table."""
    keys = keys or ("page_id",)
    exploded = parsed.select(*keys, "body_text", F.explode("dom").alias("n"))
    node = F.col("n")
    return exploded.select(
        *keys,
        *[
            node[name].alias(name)
            for name in ["node_id", "parent_id", "sib_ord", "depth", "tag", "classes", "attrs"]
        ],
        node_text(exploded).alias("text"),
    )


def node_text(exploded: DataFrame) -> Column:
    return text_of(exploded["body_text"], exploded["n"])
