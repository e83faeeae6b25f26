"""Landed HTML to an array of nodes, and SQL expressions that search it.

Parsing is the one step Spark has no operator for; it runs as an Arrow UDF, which
takes a batch of pages in pieces and only emits the element structure. Selecting, fallbacks, texts
and ids are expressions on that array. They name columns, because a lambda would
evaluate any other outer expression anew for every element, and they are SQL
text, because a site has hundreds of them.
"""

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery import vocab

TEXT, RAW = "#text", "#raw"
BROKEN = "#broken"
#: Bytes of markup and pages that are parsed at once: their nodes take some fifty times as much in a worker.
PIECE, PIECE_PAGES = 1 << 18, 1024

NODE = T.StructType([
    T.StructField("i", T.IntegerType()),       # position in document order
    T.StructField("stop", T.IntegerType()),    # position of the last descendant
    T.StructField("tag", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType()),
])
BLOCK = T.StructType([
    T.StructField("tag", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW_BLOCK = pa.struct([
    ("tag", pa.string()), ("text", pa.string()), ("items", pa.list_(pa.string()))])
_BLOCKS = frozenset("h1 h2 h3 h4 p ul ol".split())
_BOILERPLATE = frozenset(vocab.BOILERPLATE_TAGS)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo cite code em font i kbd label mark q s small span "
                    "strike strong sub sup time tt u var".split())
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 "
                      "h5 h6 header hr main nav ol p pre section table ul".split())
# start tag -> (open elements it ends, elements the search does not leave)
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
}


class _Nodes(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.open = [], []

    def _add(self, tag, attrs=None, text=None):
        i = len(self.nodes)
        self.nodes.append({"i": i, "stop": i, "tag": tag, "attrs": attrs, "text": text})
        return i

    def _close_down_to(self, depth):
        last = len(self.nodes) - 1
        for i in self.open[depth:]:
            self.nodes[i]["stop"] = last
        del self.open[depth:]

    def _end_implied(self, tags, fence):
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.nodes[self.open[depth]]["tag"]
            if name in tags:
                return self._close_down_to(depth)
            if name in fence:
                return None

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES_P:
            self._end_implied({"p"}, {"td", "th", "button", "li"} - {tag})
        if tag in _IMPLIED:
            self._end_implied(*_IMPLIED[tag])
        i = self._add(tag, [(k, v if v is not None else "") for k, v in dict(attrs).items()])
        if tag not in _VOID:
            self.open.append(i)

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.nodes[self.open[depth]]["tag"]
            if name == tag:
                return self._close_down_to(depth)
            if tag in _INLINE and name not in _INLINE:
                return None

    def handle_data(self, data):
        text = data.strip()
        if text:
            parent = self.nodes[self.open[-1]]["tag"] if self.open else ""
            self._add(RAW if parent in ("script", "style") else TEXT, None, text)

    def finish(self):
        self.close()
        self._close_down_to(0)
        return self.nodes


def _nodes_of(html):
    """The page's nodes; for markup that the parser gives up on, one node with the reason."""
    if html is None:
        return None
    parser = _Nodes()
    try:
        parser.feed(html)
        return parser.finish()
    except Exception as e:  # the parser's own assertions, among others
        return [{"i": 0, "stop": 0, "tag": BROKEN, "attrs": None, "text": f"{type(e).__name__}: {e}"}]


def _without(nodes, tags):
    """Nodes outside the given elements; positions stay as they are."""
    kept, skip_to = [], -1
    for n in nodes:
        if n["i"] <= skip_to:
            continue
        if n["tag"] in tags:
            skip_to = n["stop"]
            continue
        kept.append(n)
    return kept


def _within(nodes, tags):
    """Nodes inside the first element of the first tag present, else all."""
    for tag in tags:
        for n in nodes:
            if n["tag"] == tag:
                return [m for m in nodes if n["i"] < m["i"] <= n["stop"]]
    return nodes


def _blocks_of(nodes):
    """Headings, paragraphs and lists in order. A list inside another list is
    not visited again: its items belong to the outer one."""
    at = [n["i"] for n in nodes]

    def inner(k):
        return nodes[k + 1:bisect_right(at, nodes[k]["stop"])]

    def text(k):
        return "".join(m["text"] for m in inner(k) if m["tag"] == TEXT)

    blocks, list_end = [], -1
    for k, n in enumerate(nodes):
        if n["tag"] not in _BLOCKS or (n["tag"] in ("ul", "ol") and n["i"] <= list_end):
            continue
        items = []
        if n["tag"] in ("ul", "ol"):
            list_end = n["stop"]
            items = [text(k + 1 + j) for j, m in enumerate(inner(k)) if m["tag"] == "li"]
        blocks.append({"tag": n["tag"], "text": text(k), "items": [t for t in items if t]})
    return blocks


def _columnar(pages):
    """Node lists as one Arrow array, built column by column."""
    offsets, flat, nulls = [0], [], []
    for nodes in pages:
        nulls.append(nodes is None)
        flat.extend(nodes or ())
        offsets.append(len(flat))
    at, keys, values = [0], [], []
    for n in flat:
        for k, v in n["attrs"] or ():
            keys.append(k)
            values.append(v)
        at.append(len(keys))
    attrs = pa.MapArray.from_arrays(
        pa.array(at, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))
    fields = [
        pa.array([n["i"] for n in flat], pa.int32()), pa.array([n["stop"] for n in flat], pa.int32()),
        pa.array([n["tag"] for n in flat], pa.string()), attrs,
        pa.array([n["text"] for n in flat], pa.string()),
    ]
    structs = pa.StructArray.from_arrays(fields, names=NODE.fieldNames())
    # A NULL page is a masked offset.
    starts = pa.array([None if m else o for o, m in zip(offsets, nulls)] + [offsets[-1]], pa.int32())
    return pa.ListArray.from_arrays(starts, structs)


def _pieces(batches):
    """Lists of pages of about PIECE bytes of markup, of one page at least, in order."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False).astype("i8"))
        first = 0
        while first < len(batch):
            done = int(ends[first - 1]) if first else 0
            end = max(first + 1, int(np.searchsorted(ends, done + PIECE, "right")))
            end = min(end, first + PIECE_PAGES)
            yield batch.slice(first, end - first).to_pylist()
            first = end


@F.arrow_udf(T.ArrayType(NODE))
def parse_nodes(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in _pieces(html):
        yield _columnar([_nodes_of(h) for h in pages])


@F.arrow_udf(T.ArrayType(NODE))
def parse_content(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Nodes outside boilerplate elements."""
    for pages in _pieces(html):
        parsed = (_nodes_of(h) for h in pages)
        yield _columnar([n and _without(n, _BOILERPLATE) for n in parsed])


@F.arrow_udf(T.ArrayType(BLOCK))
def parse_blocks(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Blocks of the main content, without boilerplate elements."""
    for pages in _pieces(html):
        found = []
        for h in pages:
            nodes = _nodes_of(h)
            found.append(nodes and _blocks_of(_within(_without(nodes, _BOILERPLATE), ("main", "article"))))
        yield pa.array(found, type=pa.list_(_ARROW_BLOCK))


def unreadable(nodes: str) -> str:
    """Condition that a page is missing or could not be parsed."""
    return f"({nodes} IS NULL OR coalesce(get({nodes}, 0).tag = '{BROKEN}', FALSE))"


# --- selecting -----------------------------------------------------------


def quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Sel:
    """One way to recognise an element. Patterns are searched, not anchored;
    `within` asks for an enclosing element."""

    tags: tuple[str, ...] = ()
    cls: str | None = None
    attrs: tuple[tuple[str, str], ...] = field(default=())
    within: "Sel | None" = None
    ignore_case: bool = True

    def test(self, n: str, nodes: str) -> str:
        """SQL condition on the node variable or column `n`."""
        flag = "(?i)" if self.ignore_case else ""
        names = ", ".join(quoted(t) for t in self.tags)
        conds = [f"{n}.tag IN ({names})" if self.tags else f"NOT startswith({n}.tag, '#')"]
        wanted = ([("class", self.cls)] if self.cls else []) + list(self.attrs)
        for name, pattern in wanted:
            conds.append(f"coalesce({n}.attrs[{quoted(name)}] RLIKE {quoted(flag + pattern)}, false)")
        if self.within is not None:
            outer = self.within.test(f"{n}_up", nodes)
            conds.append(f"exists({nodes}, {n}_up -> {n}_up.i < {n}.i AND {n}.i <= {n}_up.stop AND {outer})")
        return "(" + " AND ".join(conds) + ")"


def word(name: str) -> str:
    """Pattern for one whole class name."""
    return rf"(?:^|\s){name}(?:\s|$)"


def select(nodes: str, step) -> str:
    """Elements matching a step, a selector or a tuple of alternatives, in
    document order."""
    alternatives = step if isinstance(step, tuple) else (step,)
    return f"filter({nodes}, _n -> {' OR '.join(s.test('_n', nodes) for s in alternatives)})"


def first(nodes: str, steps: list) -> str:
    """First element of the first step that finds one."""
    return "coalesce(" + ", ".join(f"get({select(nodes, s)}, 0)" for s in steps) + ")"


def found(nodes: str, steps: list) -> str:
    """All elements of the first step that finds any; NULL if none does."""
    return "coalesce(" + ", ".join(
        f"CASE WHEN exists({nodes}, _n -> {' OR '.join(a.test('_n', nodes) for a in (s if isinstance(s, tuple) else (s,)))}) "
        f"THEN {select(nodes, s)} END" for s in steps) + ")"


def text_of(nodes: str, el: str) -> str:
    """Text nodes of an element joined without a separator; NULL without it."""
    own = f"filter({nodes}, _t -> _t.tag = '{TEXT}' AND _t.i > {el}.i AND _t.i <= {el}.stop)"
    return f"CASE WHEN {el} IS NOT NULL THEN array_join(transform({own}, _t -> _t.text), '') END"


def link_in(nodes: str, el: str) -> str:
    """The element itself if it is a link, else the first link inside it."""
    inner = f"get(filter({nodes}, _n -> _n.tag = 'a' AND _n.i > {el}.i AND _n.i <= {el}.stop), 0)"
    return f"CASE WHEN {el}.tag = 'a' THEN {el} ELSE {inner} END"


def around(nodes: str, el: str, tags: tuple[str, ...]) -> str:
    """Innermost of the given elements that holds a node."""
    names = ", ".join(quoted(t) for t in tags)
    return (f"try_element_at(filter({nodes}, _n -> _n.tag IN ({names}) AND _n.i < {el}.i "
            f"AND {el}.i <= _n.stop), -1)")


def text_node(nodes: str, pattern: str) -> str:
    """First text node matching a pattern."""
    return f"get(filter({nodes}, _n -> _n.tag = '{TEXT}' AND _n.text RLIKE {quoted(pattern)}), 0)"


def inside(nodes: str, el: str) -> str:
    """The nodes inside an element of a whole page, whose places are their positions; not for `parse_content`."""
    return f"slice({nodes}, {el}.i + 2, {el}.stop - {el}.i)"


def table_cells(nodes: str, table: str) -> str:
    """Rows of cell texts of one table of a whole page, header row included. A row and a
    cell look at their own nodes only."""
    rows = f"filter({inside(nodes, table)}, _r -> _r.tag = 'tr')"
    tds = f"filter({inside(nodes, '_r')}, _d -> _d.tag = 'td')"
    text = f"array_join(transform(filter({inside(nodes, '_d')}, _t -> _t.tag = '{TEXT}'), _t -> _t.text), '')"
    return f"transform({rows}, _r -> transform({tds}, _d -> {text}))"


def attr(el: Column, name: str) -> Column:
    return el["attrs"][name]
