"""HTML as an array of nodes, and the column expressions that query it.

One Arrow-batched helper turns a page into a flat pre-order array; finding cards, fields and texts in
it are ordinary higher-order functions, so a page never leaves its row and nothing is shuffled.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia.functions.text import TAG_TAIL, WHITESPACE, let, strip

# Helpers travel to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ``stop`` is one past the last descendant's position; text nodes have the tag ``#text``; ``cls``
# holds the class names with one blank around each, so that a name is found by a plain search.
# ``start``/``end`` are character offsets of the element in the page.
NODE_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("pos", T.IntegerType()),
            T.StructField("stop", T.IntegerType()),
            T.StructField("parent", T.IntegerType()),
            T.StructField("tag", T.StringType()),
            T.StructField("cls", T.StringType()),
            T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
            T.StructField("text", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)

_TOKEN = re.compile(rf"<!--.*?-->|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)({TAG_TAIL})>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}


#: Tags whose reading is remembered, and nodes that are held as Python objects at a time.
_REMEMBERED, _CHUNK = 4096, 20_000


def _attributes(tail: str) -> dict[str, str] | None:
    if not tail:
        return None
    return {
        k.lower(): unescape(v[1:-1] if v[:1] in ("'", '"') else v)
        for k, v in _ATTRIBUTE.findall(tail)
    }


#: What a token does: nothing (comments), end an element, open one, stand alone, or begin raw text.
_NONE, _END, _OPEN, _ALONE, _RAW = range(5)


def _token(closing: str | None, name: str | None, tail: str | None) -> tuple[int, str, dict[str, str] | None]:
    """What a token does, its tag and its attributes."""
    if not name:
        return _NONE, "", None
    name = name.lower()
    if closing:
        return _END, name, None
    alone = name in _VOID or tail.endswith("/")
    return _ALONE if alone else _RAW if name in _RAW_END else _OPEN, name, _attributes(tail)


def scan_html(html: str, remembered: dict | None = None) -> tuple[list, ...]:
    """Pre-order nodes of a page as parallel lists: stop, parent, tag, attrs, text, start, end.

    An end tag closes everything opened since its start tag and is ignored when there is none.
    ``remembered`` holds what tags of earlier pages said; pages of one make repeat most of them.
    """
    if remembered is None:
        remembered = {}
    stops, parents, tags, attributes, texts, starts, ends = lists = ([], [], [], [], [], [], [])
    stack: list[int] = []
    opened: dict[str, list[int]] = {}  # of each name, what is open; so an end tag costs no search
    known = remembered.get
    index, parent = 0, -1  # of the next node

    at, size = 0, len(html)
    skipped = True
    while skipped:
        skipped = False
        for token in _TOKEN.finditer(html, at):
            text_end, end = token.span()
            if text_end > at:
                text = html[at:text_end]
                stops.append(index + 1)
                parents.append(parent)
                tags.append("#text")
                attributes.append(None)
                texts.append(unescape(text) if "&" in text else text)
                starts.append(at)
                ends.append(text_end)
                index += 1
            at = end
            whole = token[0]
            said = known(whole)
            if said is None:
                said = _token(*token.groups())
                if len(remembered) >= _REMEMBERED:
                    remembered.clear()
                remembered[whole] = said
            kind, name, attrs = said
            if kind == _NONE:
                continue
            if kind == _END:
                if opened.get(name):
                    last = opened[name][-1]
                    while True:
                        top = stack.pop()
                        opened[tags[top]].pop()
                        stops[top] = index
                        ends[top] = at
                        if top == last:
                            break
                    parent = stack[-1] if stack else -1
                continue
            stops.append(index + 1)
            parents.append(parent)
            tags.append(name)
            attributes.append(attrs)
            texts.append(None)
            starts.append(text_end)
            ends.append(at)
            index += 1
            if kind == _OPEN:
                parent = index - 1
                stack.append(parent)
                if name in opened:
                    opened[name].append(parent)
                else:
                    opened[name] = [parent]
            elif kind == _RAW:
                ending = _RAW_END[name].search(html, at)
                texts[-1] = html[at : ending.start() if ending else size]
                at = ends[-1] = ending.end() if ending else size
                skipped = True  # what is inside holds no tags: they are looked for behind it
                break
    if at < size:
        text = html[at:]
        stops.append(index + 1)
        parents.append(parent)
        tags.append("#text")
        attributes.append(None)
        texts.append(unescape(text) if "&" in text else text)
        starts.append(at)
        ends.append(size)
        index += 1
    for left in stack:
        stops[left], ends[left] = index, size
    return lists


def _node_arrays(positions: list[int], row_ends: list[int], columns: tuple[list, ...]) -> pa.Array:
    """Arrow's lists of nodes, of the nodes of some pages."""
    stops, parents, tags, attributes, texts, starts, ends = columns
    keys, values, map_ends, classes = [], [], [0], []
    for attrs in attributes:
        if attrs:
            keys.extend(attrs)
            values.extend(attrs.values())
            names = attrs.get("class")
            classes.append(None if names is None else f" {' '.join(names.split())} ")
        else:
            classes.append(None)
        map_ends.append(len(keys))

    def numbers(items: list[int]) -> pa.Array:
        return pa.array(items, pa.int32())

    def words(items: list) -> pa.Array:
        return pa.array(items, pa.string())

    struct = pa.StructArray.from_arrays(
        [
            numbers(positions), numbers(stops), numbers(parents), words(tags), words(classes),
            pa.MapArray.from_arrays(numbers(map_ends), words(keys), words(values)),
            words(texts), numbers(starts), numbers(ends),
        ],
        names=["pos", "stop", "parent", "tag", "cls", "attrs", "text", "start", "end"],
    )
    return pa.ListArray.from_arrays(numbers(row_ends), struct)


@F.arrow_udf(NODE_TYPE)
def html_nodes(pages: pa.Array) -> pa.Array:
    """Nodes of each page, built column by column for Arrow.

    Some thousand nodes are Python objects at a time, whatever the number and length of the pages.
    """
    done: list[pa.Array] = []
    remembered: dict = {}
    columns, positions, row_ends = tuple([] for _ in range(7)), [], [0]
    for page in pages:
        page = page.as_py()
        if page:
            parts = scan_html(page, remembered)
            for column, part in zip(columns, parts):
                column.extend(part)
            positions.extend(range(len(parts[0])))
        row_ends.append(len(positions))
        if len(positions) >= _CHUNK:
            done.append(_node_arrays(positions, row_ends, columns))
            columns, positions, row_ends = tuple([] for _ in range(7)), [], [0]
    done.append(_node_arrays(positions, row_ends, columns))
    return pa.concat_arrays(done) if len(done) > 1 else done[0]


# ---- queries beside the node scan -------------------------------------------------------------

class Page:
    """Nodes of one page, for readers that ask for some fields of many pages.

    What a question returns is a node's number, or ``None``. They mean the same as the column expressions
    of their names below, which suit readers that need the nodes in Spark.
    """

    def __init__(self, html: str, remembered: dict | None = None) -> None:
        self.html = html
        self.stops, self.parents, self.tags, self.attrs, self.texts, self.starts, self.ends = scan_html(html, remembered)

    def whole(self) -> range:
        return range(len(self.tags))

    def inside(self, node: int | None) -> range:
        return range(0) if node is None else range(node + 1, self.stops[node])

    def following(self, node: int | None) -> range:
        return range(0) if node is None else range(node + 1, len(self.tags))

    def siblings_after(self, node: int | None) -> Iterator[int]:
        """Those that have the node's parent, one after another."""
        if node is not None:
            at, parent = self.stops[node], self.parents[node]
            while at < len(self.tags) and self.parents[at] == parent:
                yield at
                at = self.stops[at]

    def find_all(self, nodes: range, name: str, cls: str | None = None) -> Iterator[int]:
        """Nodes with a tag, and with one class name."""
        at, last = nodes.start, nodes.stop
        while (at := self._next(at, last, name, cls)) is not None:
            yield at
            at += 1

    def find(self, nodes: range, name: str, cls: str | None = None) -> int | None:
        return self._next(nodes.start, nodes.stop, name, cls)

    def _next(self, at: int, last: int, name: str, cls: str | None) -> int | None:
        index, attrs = self.tags.index, self.attrs
        try:
            while at < last:
                at = index(name, at, last)
                if cls is None:
                    return at
                said = attrs[at]
                names = said.get("class") if said else None
                if names and (names == cls or cls in names and cls in names.split()):
                    return at
                at += 1
        except ValueError:  # no such tag any more
            pass
        return None

    def first(self, nodes: Iterable[int], wanted: Callable[[int], bool], *names: str) -> int | None:
        """The first node that is wanted, of the tags named or of any."""
        tags, attrs = self.tags, self.attrs
        for n in nodes:
            if attrs[n] and (not names or tags[n] in names) and wanted(n):
                return n
        return None

    def having(self, nodes: Iterable[int], name: str, value: str, *names: str) -> int | None:
        """The first node with an attribute of a value, of the tags named or of any."""
        return self.first(nodes, lambda n: self.attrs[n].get(name) == value, *names)

    def class_like(self, nodes: Iterable[int], parts: tuple[str, ...], *names: str) -> int | None:
        """The first node whose class attribute contains one of the texts (lower-cased)."""
        def like(n: int) -> bool:
            said = self.classes(n).lower()
            return any(part in said for part in parts)

        return self.first(nodes, like, *names)

    def single_string(self, node: int) -> str | None:
        """Text of a node whose only content, at any depth, is one text."""
        last = self.stops[node] - 1
        if last == node or self.tags[last] != "#text":
            return None
        return self.texts[last] if all(self.parents[d] == d - 1 for d in range(node + 1, last + 1)) else None

    def attr(self, node: int | None, name: str) -> str | None:
        return (self.attrs[node] or {}).get(name) if node is not None else None

    def classes(self, node: int) -> str:
        """The class names with one blank between."""
        return " ".join((self.attr(node, "class") or "").split())

    def text(self, node: int | None, separator: str = "") -> str | None:
        if node is None:
            return None
        tags, texts = self.tags, self.texts
        pieces = [texts[n].strip(WHITESPACE) for n in range(node + 1, self.stops[node]) if tags[n] == "#text"]
        return separator.join([p for p in pieces if p])

    def outer_html(self, node: int | None) -> str | None:
        return None if node is None else self.html[self.starts[node] : self.ends[node]]


def page_records(read: Callable[[Page], Iterable[tuple]], **fields: str) -> Callable[[Column], Column]:
    """A column function: of each page, the array of records that ``read`` finds in it.

    ``fields`` are the names and types (``string`` or ``boolean``) of what a record holds, in order. The
    nodes of a page stay where it is scanned, and only what is asked for is handed to Spark.
    """
    kinds = {"string": pa.string(), "boolean": pa.bool_()}
    types = {"string": T.StringType(), "boolean": T.BooleanType()}
    record = T.StructType([T.StructField(name, types[kind]) for name, kind in fields.items()])

    @F.arrow_udf(T.ArrayType(record))
    def records(pages: pa.Array) -> pa.Array:
        remembered: dict = {}
        found, row_ends = [], [0]
        for page in pages:
            found.extend(read(Page(page.as_py() or "", remembered)))
            row_ends.append(len(found))
        columns = zip(*found) if found else [()] * len(fields)
        struct = pa.StructArray.from_arrays(
            [pa.array(column, kinds[kind]) for column, kind in zip(columns, fields.values())], names=list(fields)
        )
        return pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), struct)

    return records


# ---- queries over the node array --------------------------------------------------------------

Match = Callable[[Column], Column]


def tag(*names: str) -> Match:
    return (lambda n: n["tag"] == names[0]) if len(names) == 1 else lambda n: n["tag"].isin(*names)


def has_class(name: str) -> Match:
    """One of the class names, or the whole attribute when ``name`` has blanks."""
    padded = F.lit(f" {name} ")
    if " " in name:
        return lambda n: F.coalesce(n["cls"] == padded, F.lit(False))
    return lambda n: F.coalesce(F.contains(n["cls"], padded), F.lit(False))


def class_like(*parts: str) -> Match:
    """Class attribute contains one of the texts (lower-cased)."""
    return lambda n: F.coalesce(F.lower(n["cls"]).rlike("|".join(parts)), F.lit(False))


def attr(name: str, value: str | None = None) -> Match:
    if value is None:
        return lambda n: attr_of(n, name).isNotNull()
    return lambda n: F.coalesce(attr_of(n, name) == value, F.lit(False))


def attr_like(name: str, part: str) -> Match:
    return lambda n: F.coalesce(F.contains(F.lower(attr_of(n, name)), F.lit(part)), F.lit(False))


def both(*matches: Match) -> Match:
    def test(n: Column) -> Column:
        result = matches[0](n)
        for m in matches[1:]:
            result = result & m(n)
        return result

    return test


def attr_of(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))


def find_all(nodes: Column, match: Match) -> Column:
    return F.filter(nodes, match)


def find(nodes: Column, match: Match) -> Column:
    """First matching node, null when there is none."""
    return F.get(F.filter(nodes, match), F.lit(0))


# Nodes are passed as expressions, so each helper binds its node once: inside a lambda it would
# otherwise be searched again for every element.

def inside(nodes: Column, node: Column) -> Column:
    """Descendants of a node. Only valid on the full array of a page."""
    return let(node, lambda n: F.slice(nodes, n["pos"] + 2, n["stop"] - n["pos"] - 1))


def following(nodes: Column, node: Column) -> Column:
    """Everything after a node's start, descendants included."""
    return let(node, lambda n: F.slice(nodes, n["pos"] + 2, F.size(nodes)))


def siblings_after(nodes: Column, node: Column) -> Column:
    return let(
        node,
        lambda n: F.filter(
            F.slice(nodes, n["stop"] + 1, F.size(nodes)), lambda x: x["parent"] == n["parent"]
        ),
    )


def text_of(nodes: Column, node: Column, separator: str = "") -> Column:
    """Stripped text pieces below a node, joined; null for no node."""

    def joined(n: Column) -> Column:
        texts = F.filter(
            F.slice(nodes, n["pos"] + 2, n["stop"] - n["pos"] - 1), lambda x: x["tag"] == "#text"
        )
        pieces = F.transform(texts, lambda x: strip(x["text"]))
        return F.array_join(F.filter(pieces, lambda t: t != ""), separator)

    return let(node, joined)


def outer_html(html: Column, node: Column) -> Column:
    """Source text of a node."""
    return let(node, lambda n: F.substr(html, n["start"] + 1, n["end"] - n["start"]))


# ---- links and scripts, without the node array ------------------------------------------------

def visible_html(html: Column) -> Column:
    """A page without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "")


def page_links(html: Column) -> Column:
    """``array<struct<pos, href, text>>`` of a page's anchors, in order."""
    anchor = rf"(?is)<a(?=\s)({TAG_TAIL})>(.*?)(?:</a\s*>|(?=<a\s)|$)"
    target = r"(?is)(?:^|\s)href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"

    def links(page: Column) -> Column:
        pairs = F.arrays_zip(
            F.regexp_extract_all(page, F.lit(anchor), F.lit(1)).alias("head"),
            F.regexp_extract_all(page, F.lit(anchor), F.lit(2)).alias("body"),
        )

        def one(pair: Column, index: Column) -> Column:
            href = F.concat(*[F.regexp_extract(pair["head"], target, g) for g in (1, 2, 3)])
            body = F.regexp_replace(pair["body"], r"<[^>]*>", "")
            return F.struct(
                index.alias("pos"),
                strip(F.replace(href, F.lit("&amp;"), F.lit("&"))).alias("href"),
                strip(F.regexp_replace(body, r"(?U)\s+", " ")).alias("text"),
            )

        return F.filter(F.transform(pairs, one), lambda x: x["href"] != "")

    return let(visible_html(html), links)


def script_bodies(html: Column, kind: str) -> Column:
    """Bodies of the scripts of a type, in order."""
    kind = kind.replace("+", r"\+")
    return F.transform(
        F.regexp_extract_all(
            html,
            F.lit(rf"(?is)<script[^>]*type=[\"']{kind}[\"'][^>]*>(.*?)</script>"),
            F.lit(1),
        ),
        strip,
    )


def meta_content(html: Column, attribute: str, name: str, min_length: int) -> Column:
    """``content`` of a meta tag when it is long enough."""
    pattern = (
        rf"(?i)<meta[^>]+{attribute}=[\"']{name}[\"'][^>]+content=[\"']([^\"']{{{min_length},}})[\"']"
    )
    return strip(F.nullif(F.regexp_extract(html, pattern, 1), F.lit("")))
