"""Pages as nested columns: HTML becomes an array of nodes in document order.

Each element knows the range ``pos .. last`` of its subtree, so "is a descendant of" is
interval containment and a subtree is one array slice. Selector matching, text assembly and
pruning are higher-order functions over that array: a page is one row from scan to article and
nothing is shuffled. Only the tokeniser runs in Python, on Arrow batches. It also
lists the positions of every tag, class and id, so a selector looks at candidates, not at all nodes.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.functions.text import clean_text
from pressroom.functions.urls import col, let
from pressroom.session import small_batches

# The tokeniser travels inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_TYPE = (
    "struct<pos:int,last:int,parent:int,tag:string,id:string,classes:array<string>,attrs:map<string,string>,text:string,"
    "aside:boolean,chars:bigint,plain:bigint>"
)
PAGE_TYPE = f"struct<nodes:array<{NODE_TYPE}>,index:map<string,array<int>>>"
#: Bytes of pages that a task takes apart at once, a single longer page aside.
PIECE = 1 << 18
TEXT = "#text"
CODE = "#code"  # text of script, style and template: never part of an element's text

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that are never main text.
PERIPHERAL = ["nav", "header", "footer", "aside", "form", "button", "select", "noscript", "title", "a"]
CODE_ELEMENTS = frozenset("script style template".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes".split())  # no markup, no entities inside
PLAIN_TEXT = frozenset("title textarea".split())  # no markup inside
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split()
)
PARAGRAPH_SCOPE = frozenset("html table td th caption button object template".split())
# Opening the key closes an open sibling from the first list, looking no further than the second.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "body": ({"head"}, set()),
}


class _NodeLists:
    """Columns of the node structs of one Arrow batch."""

    def __init__(self):
        self.row_starts = [0]
        self.pos, self.last, self.parent, self.tag, self.id, self.text = [], [], [], [], [], []
        self.aside, self.chars, self.plain = [], [], []  # in peripheral elements; text so far, in all and outside of them
        self.class_starts, self.classes = [0], []
        self.attr_starts, self.attr_keys, self.attr_values = [0], [], []
        self.index_starts, self.index_keys, self.index_ends, self.index_positions = [0], [], [0], []

    def end_row(self, index: dict[str, list[int]]):
        self.row_starts.append(len(self.pos))
        for key, positions in index.items():
            self.index_keys.append(key)
            self.index_positions.extend(positions)
            self.index_ends.append(len(self.index_positions))
        self.index_starts.append(len(self.index_keys))

    def to_arrow(self, missing: list[bool]) -> pa.Array:
        strings = pa.string()
        structs = pa.StructArray.from_arrays(
            [
                pa.array(self.pos, pa.int32()),
                pa.array(self.last, pa.int32()),
                pa.array(self.parent, pa.int32()),
                pa.array(self.tag, strings),
                pa.array(self.id, strings),
                pa.ListArray.from_arrays(pa.array(self.class_starts, pa.int32()), pa.array(self.classes, strings)),
                pa.MapArray.from_arrays(
                    pa.array(self.attr_starts, pa.int32()), pa.array(self.attr_keys, strings), pa.array(self.attr_values, strings)
                ),
                pa.array(self.text, strings),
                pa.array(self.aside, pa.bool_()),
                pa.array(self.chars, pa.int64()),
                pa.array(self.plain, pa.int64()),
            ],
            names=["pos", "last", "parent", "tag", "id", "classes", "attrs", "text", "aside", "chars", "plain"],
        )
        ints = pa.int32()
        nodes = pa.ListArray.from_arrays(pa.array(self.row_starts, ints), structs)
        positions = pa.ListArray.from_arrays(pa.array(self.index_ends, ints), pa.array(self.index_positions, ints))
        index = pa.MapArray.from_arrays(pa.array(self.index_starts, ints), pa.array(self.index_keys, strings), positions)
        return pa.StructArray.from_arrays([nodes, index], names=["nodes", "index"], mask=pa.array(missing, pa.bool_()))


# A comment, an end tag, a start tag (values quoted after '=' may hold '>'), a start tag the page breaks off in, or
# another declaration. Possessive repeats keep the search linear in the length of the page.
_MARKUP = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)"""
    r"""|/([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"""
    r"""|([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+)>"""
    r"""|[a-zA-Z][^>]*+(?:>|\Z)"""
    r"""|[!?/][^>]*+(?:>|\Z))""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s/=>][^\s/=>]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")


class _Page:
    """Appends the nodes of one page to the shared lists, closing what HTML leaves open."""

    def __init__(self, out: _NodeLists):
        self.out = out
        self.base = len(out.pos)
        self.open: list[tuple[str, int]] = []
        self.n_open: dict[str, int] = {}  # spares deep pages the walk up when nothing is there to close
        self.index: dict[str, list[int]] = {}
        self.chars = self.plain = 0

    def add(self, tag: str, attributes: str, text: str | None) -> int:
        out = self.out
        node = len(out.pos)
        pos = node - self.base
        out.pos.append(pos)
        out.last.append(pos)
        out.parent.append(self.open[-1][1] - self.base if self.open else None)
        out.tag.append(tag)
        out.text.append(text)
        aside = any(self.n_open.get(name) for name in PERIPHERAL)
        if tag == TEXT:
            self.chars += len(text)
            self.plain += 0 if aside else len(text)
        out.aside.append(aside)
        out.chars.append(self.chars)
        out.plain.append(self.plain)
        out.id.append(self.add_attributes(attributes, pos) if attributes else None)
        out.class_starts.append(len(out.classes))
        out.attr_starts.append(len(out.attr_keys))
        return node

    def add_attributes(self, attributes: str, pos: int) -> str | None:
        out, seen, ident = self.out, set(), None
        for key, double, single, bare in _ATTRIBUTE.findall(attributes):
            key = key.lower()
            if key in seen:
                continue
            seen.add(key)
            value = double or single or bare
            if "&" in value:
                value = unescape(value)
            out.attr_keys.append(key)
            out.attr_values.append(value)
            if key == "id":
                ident = value
                self.index.setdefault("#" + value, []).append(pos)
            elif key == "class":
                names = value.split()
                out.classes.extend(names)
                for name in dict.fromkeys(names):
                    self.index.setdefault("." + name, []).append(pos)
        return ident

    def add_text(self, text: str, raw: bool = False) -> None:
        if not raw and "&" in text:
            text = unescape(text)
        text = text.strip()
        if text:
            inside = self.open[-1][0] if self.open else ""
            self.add(CODE if inside in CODE_ELEMENTS else TEXT, "", text)

    def close_to(self, depth: int) -> None:
        end = len(self.out.pos) - 1 - self.base
        for tag, node in self.open[depth:]:
            self.out.last[node] = end
            self.n_open[tag] -= 1
        del self.open[depth:]

    def close_within(self, tags, scope) -> None:
        if not any(self.n_open.get(tag) for tag in tags):
            return
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth][0]
            if name in tags:
                self.close_to(depth)
                return
            if name in scope:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_PARAGRAPH:
            self.close_within(("p",), PARAGRAPH_SCOPE)
        if tag in IMPLIED_END:
            self.close_within(*IMPLIED_END[tag])
        node = self.add(tag, attributes, None)
        self.index.setdefault(tag, []).append(node - self.base)
        if tag not in VOID:
            self.open.append((tag, node))
            self.n_open[tag] = self.n_open.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if not self.n_open.get(tag):
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self.close_to(depth)
                return

    def read(self, html: str) -> None:
        at, search = 0, _MARKUP.search
        while (found := search(html, at)) is not None:
            if found.start() > at:
                self.add_text(html[at : found.start()])
            at = found.end()
            end_tag, tag, attributes = found.groups()
            if end_tag:
                self.end(end_tag.lower())
                continue
            if tag:
                tag = tag.lower()
                self.start(tag, attributes)
                if tag in RAW_TEXT or tag in PLAIN_TEXT:
                    stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                    until = stop.start() if stop else len(html)
                    self.add_text(html[at:until], raw=tag in RAW_TEXT)
                    at = until
        self.add_text(html[at:])
        self.close_to(0)


def _tokenize(html: pa.Array) -> pa.Array:
    out = _NodeLists()
    missing = []
    for value in html:
        text = value.as_py()
        missing.append(text is None)
        page = _Page(out)
        if text:
            page.read(text)
        out.end_row(page.index)
    return out.to_arrow(missing)


def _in_pieces(html: pa.Array) -> Iterator[pa.Array]:
    """The column in runs of pages of about ``PIECE`` bytes, at least one page a run."""
    lengths = pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, length in enumerate(lengths.tolist()):
        if size and size + length > PIECE:
            yield html.slice(start, i - start)
            start, size = i, 0
        size += length
    if start < len(html):
        yield html.slice(start)


def _tokenized(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Nodes go out a piece at a time: as Python lists those of a whole batch would take many times the memory of its pages."""
    for batch in batches:
        yield from map(_tokenize, _in_pieces(batch))


def parse_page(html: Column | str) -> Column:
    """Nodes and position lists of a page; the rest of the row never leaves the JVM."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        small_batches(spark)
    return F.arrow_udf(_tokenized, PAGE_TYPE)(col(html))


def page_nodes(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per node; ``node_id .. last_id`` spans its subtree, ``parent_id`` is null at the top."""
    return pages.select(page_id, F.explode(parse_page(html)["nodes"]).alias("n")).select(
        page_id,
        F.col("n.pos").alias("node_id"),
        F.col("n.last").alias("last_id"),
        F.col("n.parent").alias("parent_id"),
        "n.tag", "n.id", "n.classes", "n.attrs", "n.text",
    )


def nodes_of(page: Column, *keys: str) -> Column:
    """Nodes listed under the given index keys, key after key."""
    nodes = page["nodes"]
    return F.flatten(F.array(*[F.transform(_listed(page, F.lit(k)), lambda i: F.get(nodes, i)) for k in keys]))


def _listed(page: Column, key: Column) -> Column:
    return F.coalesce(F.try_element_at(page["index"], key), F.array().cast("array<int>"))


def selector_steps(selector: Column | str) -> Column:
    """A selector as steps, outermost first. Supported per step: tag, .class, #id, [attr], [attr='v']."""

    def step(part: Column) -> Column:
        bare = F.regexp_replace(part, r"\[[^\]]*\]", "")
        bracket = F.regexp_extract(part, r"\[([^\]]*)\]", 1)
        tag = F.lower(F.nullif(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9-]*)", 1), F.lit("")))
        ident = F.nullif(F.regexp_extract(bare, r"#([^.#\s]+)", 1), F.lit(""))
        first_class = F.nullif(F.regexp_extract(bare, r"\.([^.#\s]+)", 1), F.lit(""))
        return F.struct(
            F.coalesce(F.concat(F.lit("#"), ident), F.concat(F.lit("."), first_class), tag).alias("key"),
            tag.alias("tag"),
            ident.alias("id"),
            F.regexp_extract_all(bare, F.lit(r"\.([^.#\s]+)"), F.lit(1)).alias("classes"),
            F.lower(F.nullif(F.trim(F.substring_index(bracket, "=", 1)), F.lit(""))).alias("attr"),
            F.when(bracket.contains("="), F.regexp_replace(bracket, r"^[^=]*=\s*[\"']?|[\"']?\s*$", "")).alias("value"),
        )

    return F.transform(F.split(F.trim(col(selector)), r"\s+(?![^\[]*\])"), step)


def _matches(node: Column, step: Column) -> Column:
    return (
        ~node["tag"].startswith("#")
        & (step["tag"].isNull() | (step["tag"] == node["tag"]))
        & (step["id"].isNull() | F.coalesce(step["id"] == node["id"], F.lit(False)))
        & ((F.size(step["classes"]) == 0) | (F.size(F.array_except(step["classes"], node["classes"])) == 0))
        & (
            step["attr"].isNull()
            | (F.map_contains_key(node["attrs"], step["attr"])
               & (step["value"].isNull() | (F.try_element_at(node["attrs"], step["attr"]) == step["value"])))
        )
    )


RANGES = "array<struct<pos:int,last:int>>"


def select_all(page: Column, steps: Column) -> Column:
    """Subtree ranges of all nodes a selector matches, in document order."""
    nodes = page["nodes"]

    def candidates(step: Column) -> Column:
        listed = F.transform(_listed(page, step["key"]), lambda i: F.get(nodes, i))
        return F.when(step["key"].isNull(), nodes).otherwise(listed)

    return F.aggregate(
        steps,
        F.lit(None).cast(RANGES),
        lambda outer, step: F.transform(
            F.filter(
                candidates(step),
                lambda n: _matches(n, step)
                & (outer.isNull() | F.exists(outer, lambda a: (a["pos"] < n["pos"]) & (n["pos"] <= a["last"]))),
            ),
            lambda n: F.struct(n["pos"].alias("pos"), n["last"].alias("last")),
        ),
    )


def inside_any(pos: Column, ranges: Column) -> Column:
    return F.exists(ranges, lambda r: (r["pos"] <= pos) & (pos <= r["last"]))


def subtree(nodes: Column, hit: Column) -> Column:
    return F.slice(nodes, hit["pos"] + 1, hit["last"] - hit["pos"] + 1)


def element_text(nodes: Column, hit: Column, stripped: Column | None = None) -> Column:
    """Cleaned text of a subtree: its text nodes joined by a space, without stripped ranges."""

    def wanted(n: Column) -> Column:
        is_text = n["tag"] == TEXT
        return is_text if stripped is None else is_text & ~inside_any(n["pos"], stripped)

    pieces = F.transform(F.filter(subtree(nodes, hit), wanted), lambda n: n["text"])
    return clean_text(F.array_join(pieces, " "))


def first_or_null(array: Column) -> Column:
    return F.try_element_at(array, F.lit(1))


def node_at(nodes: Column, pos: Column) -> Column:
    return F.get(nodes, pos)


def page_links(page: Column) -> Column:
    """Every ``a[href]`` in document order: position, href, text and title attribute."""
    anchors = F.filter(nodes_of(page, "a"), lambda n: F.map_contains_key(n["attrs"], "href"))
    return F.transform(
        anchors,
        lambda n: F.struct(
            n["pos"].alias("pos"),
            F.try_element_at(n["attrs"], F.lit("href")).alias("href"),
            element_text(page["nodes"], n).alias("text"),
            clean_text(F.try_element_at(n["attrs"], F.lit("title"))).alias("title"),
        ),
    )
