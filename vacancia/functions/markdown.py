"""HTML to Markdown, as an Arrow-batched helper over the node scan."""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia.functions.markup import scan_html
from vacancia.functions.text import html_to_text, strip

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCKS = frozenset("p div article section h1 h2 h3 h4 h5 h6 ul ol li blockquote pre hr table tr "
                    "dl dd dt".split())
_MARKS = {"b": "**", "strong": "**", "em": "*", "i": "*", "del": "~~", "s": "~~", "code": "`",
          "kbd": "`", "samp": "`"}
_BULLETS = "*+-"
_BREAK, _BLANKS = re.compile(r"[\t \r\f\v]*\n[\s]*"), re.compile(r"[\t\r\f\v]+[\t \r\f\v]*| [\t \r\f\v]+")


def _join(pieces: list[str]) -> str:
    """Concatenate; where two pieces meet, their line breaks merge to at most two."""
    if len(pieces) < 2:
        return pieces[0] if pieces else ""
    out = ""
    for piece in pieces:
        body = piece.lstrip("\n")
        if out and body:
            kept = out.rstrip("\n")
            breaks = min(2, max(len(out) - len(kept), len(piece) - len(body)))
            out = kept + "\n" * breaks + body
        else:
            out += piece
    return out


def _wrap(mark: str, text: str) -> str:
    inner = text.strip()
    if not inner:
        return text if text.isspace() else ""
    lead = text[: len(text) - len(text.lstrip())] and " "
    tail = text[len(text.rstrip()):] and " "
    return f"{lead}{mark}{inner}{mark}{tail}"


def _indent(text: str, width: int) -> str:
    return re.sub(r"\n(?=[^\n])", "\n" + " " * width, text)


def to_markdown(html: str) -> str:
    """Headings, paragraphs, lists, links, emphasis, quotes, code, rules, images and tables."""
    nodes = list(zip(*scan_html(html)))
    children: list[list[str]] = [[] for _ in range(len(nodes) + 1)]
    ordinal, depth, fixed = {}, [0] * len(nodes), [False] * len(nodes)
    in_item = [False] * len(nodes)
    seen_items: dict[int, int] = {}
    for i, (_, parent, tag, *_rest) in enumerate(nodes):
        above = nodes[parent][2] if parent >= 0 else ""
        depth[i] = (depth[parent] if parent >= 0 else 0) + (tag == "ul")
        in_item[i] = parent >= 0 and (above == "li" or in_item[parent])
        fixed[i] = tag == "pre" or (parent >= 0 and fixed[parent])
        if tag == "li":
            seen_items[parent] = seen_items.get(parent, 0) + 1
            ordinal[i] = seen_items[parent] if above == "ol" else 0

    # Children come after their parents, so a backward walk has them ready.
    for i in range(len(nodes) - 1, -1, -1):
        _, parent, tag, attrs, text, *_rest = nodes[i]
        attrs = attrs or {}
        inner = _join(children[i][::-1])
        if tag == "#text":
            if not fixed[i]:
                if "\n" in text:
                    text = _BREAK.sub("\n", text)
                text = _BLANKS.sub(" ", text)
                text = text.replace("*", "\\*").replace("_", "\\_")
                if parent < 0 or nodes[parent][2] in _BLOCKS:
                    nxt = nodes[nodes[i][0]] if nodes[i][0] < len(nodes) else None
                    if i == parent + 1 or nodes[i - 1][2] in _BLOCKS:
                        text = text.lstrip()
                    if nxt is None or nxt[1] != parent or nxt[2] in _BLOCKS:
                        text = text.rstrip()
            out = text
        elif tag in ("script", "style"):
            out = ""
        elif tag == "br":
            out = "  \n"
        elif tag == "hr":
            out = "\n\n---\n\n"
        elif tag == "img":
            out = f"![{attrs.get('alt', '')}]({attrs.get('src', '')})"
        elif tag == "a":
            label, href = inner.strip(), attrs.get("href", "")
            if not label or not href:
                out = inner
            elif label.replace("\\_", "_") == href:
                out = f"<{href}>"
            else:
                out = f"[{label}]({href})"
        elif tag in ("h1", "h2"):
            label = " ".join(inner.split())
            out = f"\n\n{label}\n{('=' if tag == 'h1' else '-') * len(label)}\n\n" if label else ""
        elif tag in ("h3", "h4", "h5", "h6"):
            label = " ".join(inner.split())
            out = f"\n\n{'#' * int(tag[1])} {label}\n\n" if label else ""
        elif tag == "li":
            bullet = f"{ordinal[i]}." if ordinal[i] else _BULLETS[(depth[i] - 1) % 3]
            out = f"{bullet} {_indent(inner.strip(), len(bullet) + 1)}\n"
        elif tag in ("ul", "ol"):
            out = "\n" + inner.rstrip() if in_item[i] else f"\n\n{inner}\n"
        elif tag == "blockquote":
            quoted = "\n".join(f"> {line}".rstrip() for line in inner.strip().split("\n"))
            out = f"\n\n{quoted}\n\n" if inner.strip() else ""
        elif tag == "pre":
            out = f"\n\n```\n{inner}\n```\n\n" if inner else ""
        elif tag in ("td", "th"):
            out = f" {' '.join(inner.split())} |"
        elif tag == "tr":
            cells = [n for n in nodes[i + 1 : nodes[i][0]] if n[1] == i and n[2] in ("td", "th")]
            rule = any(n[2] == "th" for n in cells)
            line = "\n|" + " --- |" * len(cells) if rule else ""
            out = f"|{inner.strip(chr(10))}{line}\n"
        elif tag in _MARKS:
            out = inner if fixed[i] else _wrap(_MARKS[tag], inner)
        elif tag in _BLOCKS:
            out = f"\n\n{inner.strip()}\n\n" if inner.strip() else ""
        else:
            out = inner
        children[parent if parent >= 0 else len(nodes)].append(out)
    return _join(children[len(nodes)][::-1]).strip()


@F.arrow_udf(T.StringType())
def html_to_markdown(html: pa.Array) -> pa.Array:
    """Markdown of each document; null stays null."""
    return pa.array([None if h is None else to_markdown(h) for h in html.to_pylist()], pa.string())


def convert_if_html(text: Column) -> Column:
    """Markdown where the text holds markup, unchanged otherwise.

    The Python side only sees the texts with a ``<``: the others are passed as null.
    """
    marked = F.contains(text, F.lit("<"))
    return F.when(marked, html_to_markdown(F.when(marked, text))).otherwise(text)


def markdown(text: Column) -> Column:
    """Markdown of a description.

    Text without markup, references, escapes or line breaks only needs trimming; it stays in the JVM.
    """
    plain = ~text.rlike(r"[<&*_\n\r\t]|  ")
    return F.when(plain, strip(text)).otherwise(html_to_markdown(F.when(~plain, text)))


FORMATS = ("markdown", "html", "plain")


def formatted(text: Column, description_format: str) -> Column:
    """A description in the wanted format."""
    if description_format not in FORMATS:
        raise ValueError(f"unknown description format: {description_format}")
    if description_format == "markdown":
        return markdown(text)
    return html_to_text(text) if description_format == "plain" else text


@F.arrow_udf(T.ArrayType(T.StringType()))
def html_list_to_markdown(pieces: pa.Array) -> pa.Array:
    """Markdown of every text of an array."""
    return pa.array(
        [
            None if row is None else [None if h is None else to_markdown(h) for h in row]
            for row in pieces.to_pylist()
        ],
        pa.list_(pa.string()),
    )
