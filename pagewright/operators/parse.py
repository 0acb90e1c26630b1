"""PRJ0: html -> node table, the single Python stage of the engine.

Each page is tokenised by the standard-library ``html.parser`` inside ``mapInArrow``; a small
tree builder applies the tag-soup rules below and emits one row per element with Grust-style
``pre``/``post`` ranks, so every later step (selection, links, blocks, tables, records) is a
native Catalyst plan over the node table. Element markup is *not* copied into the rows: each
node carries ``start_off``/``end_off`` into the page html so ``substring`` can recover the outer
html lazily when a query asks for it.

Tag-soup rules (fixed):
  * void elements never hold children;
  * a block-level start tag closes an open ``p`` even when inline elements are still open in it;
  * ``li`` closes an open ``li``; ``td``/``th`` close an open cell; ``tr`` closes an open row;
    ``dt``/``dd`` close an open ``dt``/``dd``; ``option`` closes an open ``option``;
  * an end tag closes up to the nearest matching open element, otherwise it is ignored;
  * ``script``/``style`` contents are never text; ``br`` contributes one space;
  * text is whitespace-collapsed; block-level boundaries separate words with a space.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame


# Element classes used by the tag-soup rules.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul li".split())
RAW_TEXT_TAGS = frozenset(["script", "style"])
# Elements whose boundaries separate words in the text of an ancestor.
SPACED_TAGS = CLOSES_P | frozenset(
    "br tr td th caption thead tbody tfoot dt dd figure figcaption title head body html option "
    "img button label select textarea".split())
# Elements that can form a text block; a *leaf* block has no block descendant.
BLOCK_TAGS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li pre blockquote td th dt dd caption figcaption div section article main "
    "header footer nav aside address form table ul ol dl figure tr body".split())
# Structural containers: with container_text=False their full text (the concatenation of
# everything below them) is not materialised when they hold block-level descendants.
STRUCTURAL_TAGS = frozenset(
    "html head body main article section div nav header footer aside form table thead tbody tfoot tr "
    "ul ol dl figure".split())
# A search for an element to close implicitly never crosses these.
SCOPE_STOP = frozenset("table td th caption html body button object template".split())

NODE_SCHEMA = (
    "page_id long, pre int, post int, parent int, depth int, ordinal int, tag string, "
    "attrs map<string,string>, own_text string, text string, start_off int, end_off int, "
    "leaf_block boolean, block_pre int")

_ARROW_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("pre", pa.int32()), ("post", pa.int32()), ("parent", pa.int32()),
    ("depth", pa.int32()), ("ordinal", pa.int32()), ("tag", pa.string()),
    ("attrs", pa.map_(pa.string(), pa.string())), ("own_text", pa.string()), ("text", pa.string()),
    ("start_off", pa.int32()), ("end_off", pa.int32()), ("leaf_block", pa.bool_()), ("block_pre", pa.int32()),
])

_WS = re.compile(r"[ \t\n\r\f\v]+")


def collapse(text: str) -> str:
    return _WS.sub(" ", text).strip()


class _Element:
    __slots__ = ("pre", "parent", "depth", "ordinal", "tag", "attrs", "start", "end", "own", "parts",
                 "post", "children", "block_desc")

    def __init__(self, pre, parent, depth, ordinal, tag, attrs, start):
        self.pre, self.parent, self.depth, self.ordinal = pre, parent, depth, ordinal
        self.tag, self.attrs, self.start = tag, attrs, start
        self.end = start
        self.own: list[str] = []
        self.parts: list[str] = []
        self.post = -1
        self.children = 0
        self.block_desc = False


class _TreeBuilder(HTMLParser):
    def __init__(self, src: str):
        super().__init__(convert_charrefs=True)
        self.src = src
        self.line_starts = [0]
        for m in re.finditer("\n", src):
            self.line_starts.append(m.end())
        self.done: list[_Element] = []
        self.stack: list[_Element] = []
        self.n_pre = 0
        self.n_post = 0
        self.top_children = 0

    # -- positions -------------------------------------------------------------------------
    def _offset(self) -> int:
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    # -- closing ---------------------------------------------------------------------------
    def _close_top(self, end: int) -> None:
        el = self.stack.pop()
        el.end = end
        el.post = self.n_post
        self.n_post += 1
        self.done.append(el)
        text = "".join(el.parts)
        if self.stack:
            parent = self.stack[-1]
            parent.parts.append(" " + text + " " if el.tag in SPACED_TAGS else text)
            if el.tag in BLOCK_TAGS or el.block_desc:
                parent.block_desc = True

    def _close_nearest(self, tags, stops, at: int) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i].tag
            if tag in tags:
                while len(self.stack) > i:
                    self._close_top(at)
                return
            if tag in stops:
                return

    # -- tokenizer callbacks -----------------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs, self_closing=False)

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs, self_closing=True)

    def _open(self, tag, attrs, self_closing):
        at = self._offset()
        if tag in CLOSES_P:
            self._close_nearest({"p"}, SCOPE_STOP, at)
        if tag == "li":
            self._close_nearest({"li"}, SCOPE_STOP | {"ul", "ol"}, at)
        elif tag in ("td", "th"):
            self._close_nearest({"td", "th"}, {"tr", "table"}, at)
        elif tag == "tr":
            self._close_nearest({"tr"}, {"table", "thead", "tbody", "tfoot"}, at)
        elif tag in ("dt", "dd"):
            self._close_nearest({"dt", "dd"}, SCOPE_STOP | {"dl"}, at)
        elif tag == "option":
            self._close_nearest({"option"}, SCOPE_STOP | {"select"}, at)
        amap = {}
        for k, v in attrs:
            if k not in amap:
                amap[k] = "" if v is None else v
        if self.stack:
            parent = self.stack[-1]
            parent.children += 1
            ordinal, parent_pre = parent.children, parent.pre
        else:
            self.top_children += 1
            ordinal, parent_pre = self.top_children, -1
        el = _Element(self.n_pre, parent_pre, len(self.stack), ordinal, tag, amap, at)
        self.n_pre += 1
        self.stack.append(el)
        raw = self.get_starttag_text() or ""
        if tag in VOID_TAGS or self_closing:
            self._close_top(at + len(raw))

    def handle_endtag(self, tag):
        at = self._offset()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                gt = self.src.find(">", at)
                end = len(self.src) if gt < 0 else gt + 1
                while len(self.stack) > i + 1:
                    self._close_top(at)
                self._close_top(end)
                return

    def handle_data(self, data):
        if not self.stack:
            return
        top = self.stack[-1]
        if top.tag in RAW_TEXT_TAGS:
            return
        top.own.append(data)
        top.parts.append(data)

    def parse_marked_section(self, i, report=1):
        """``<![...``: html has no marked sections, so it is a bogus comment up to the next ``>``."""
        end = self.rawdata.find(">", i + 3)
        return -1 if end < 0 else end + 1

    def finish(self) -> list[_Element]:
        self.close()
        while self.stack:
            self._close_top(len(self.src))
        return self.done


def parse_html(html: str | None) -> list[_Element]:
    """Tree-build one document; returns finished elements (any order; sort by ``pre``)."""
    if not html:
        return []
    builder = _TreeBuilder(html)
    builder.feed(html)
    return builder.finish()


def _emit(page_ids, htmls, container_text: bool = True):
    cols = {f: [] for f in _ARROW_SCHEMA.names}
    for pid, html in zip(page_ids, htmls):
        els = sorted(parse_html(html), key=lambda e: e.pre)
        # nearest block ancestor-or-self, and whether that block is a leaf
        near_block: list[int] = []
        for el in els:
            inherited = near_block[el.parent] if el.parent >= 0 else -1
            near_block.append(el.pre if el.tag in BLOCK_TAGS else inherited)
        for el in els:
            nb = near_block[el.pre]
            leaf = el.tag in BLOCK_TAGS and not el.block_desc
            cols["leaf_block"].append(leaf)
            cols["block_pre"].append(nb if nb >= 0 and not els[nb].block_desc else -1)
            cols["page_id"].append(pid)
            cols["pre"].append(el.pre)
            cols["post"].append(el.post)
            cols["parent"].append(el.parent)
            cols["depth"].append(el.depth)
            cols["ordinal"].append(el.ordinal)
            cols["tag"].append(el.tag)
            cols["attrs"].append(list(el.attrs.items()))
            cols["own_text"].append(collapse("".join(el.own)))
            if container_text or not (el.block_desc and el.tag in STRUCTURAL_TAGS):
                cols["text"].append(collapse("".join(el.parts)))
            else:
                cols["text"].append(None)
            cols["start_off"].append(el.start)
            cols["end_off"].append(el.end)
    return pa.RecordBatch.from_pydict(cols, schema=_ARROW_SCHEMA)


def _parse_batches(batches, container_text: bool = True):
    for batch in batches:
        ids = batch.column("page_id").to_pylist()
        htmls = batch.column("html").to_pylist()
        # Bound output batch size: a few pages at a time.
        step = 64
        for i in range(0, len(ids), step):
            yield _emit(ids[i:i + step], htmls[i:i + step], container_text)


def _parse_batches_lean(batches):
    return _parse_batches(batches, container_text=False)


def parsed_nodes(pages: DataFrame, page_id: str = "page_id", html: str = "html",
                 container_text: bool = True) -> DataFrame:
    """The node table written once to the shared checkpoint folder (parquet) and read back.

    Use when several branches of a plan consume the nodes: the Python parse then runs once,
    the result survives executor loss, and each branch reads only the columns it needs.
    """
    from pagewright.session import materialize
    return materialize(html_nodes(pages, page_id, html, container_text), "nodes")


def html_nodes(pages: DataFrame, page_id: str = "page_id", html: str = "html",
               container_text: bool = True) -> DataFrame:
    """Parse ``(page_id, html)`` rows into the node table (schema ``NODE_SCHEMA``).

    Only the two needed columns cross into Python; filter pages *before* calling this, since
    nothing is pushed through ``mapInArrow``.
    """
    src = pages.select(pages[page_id].cast("long").alias("page_id"), pages[html].alias("html"))
    # A row holds no ancestors (operators/structure.py finds them), so container_text=False keeps the
    # node table linear in the html size on deeply nested pages; a container's text repeats all
    # text below it: leave it out when no step reads it.
    return src.mapInArrow(_parse_batches if container_text else _parse_batches_lean, NODE_SCHEMA)
