"""Readable text of pages by element structure: one pass over the tags with a stack of open elements.

Patterns cannot see that a ``nav`` stands inside a ``nav`` or that a script never ends. Here the tags open and
close elements as HTML5 says, so what is dropped and what is main follows from where a text stands. A page
is parsed inside one Arrow batch of its task; nothing is regrouped.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .webpages import DROPPED_ELEMENTS, MAIN_ELEMENTS

# Fixed values of HTML5: elements without content, elements of the head, formatting elements, elements whose
# start ends an open paragraph, elements that an end tag does not look through, and what ends by a sibling.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
)
SCOPES = frozenset("applet caption html table td th marquee object template".split())
SPECIAL = BLOCKS | SCOPES | HEAD | frozenset("body button colgroup frameset iframe input select tbody textarea tfoot thead tr".split())
SIBLINGS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SIBLINGS |= dict.fromkeys(("tbody", "thead", "tfoot"), ("tbody", "thead", "tfoot", "tr", "td", "th"))
#: Where the search for an open sibling ends.
WALLS = frozenset("ul ol dl table select".split())


class PageText(HTMLParser):
    """Text nodes of the first ``main`` and ``article`` and of the body, outside dropped elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.node: list[str] = []
        self.found: dict[str, list[str]] = {}
        self.body = False

    def _flush(self) -> None:
        """The text since the last tag is one node of each part that it stands in."""
        if not self.node:
            return
        text, self.node = "".join(self.node), []
        if text.strip() and not any(e in HEAD for e in self.stack):
            self.body = True
        if not self.body or any(e in DROPPED_ELEMENTS or e == "template" for e in self.stack):
            return
        self.found.setdefault("body", []).append(text)
        for part, nodes in self.found.items():
            # A part is marked in the stack, as a second element of the kind is not the first one.
            if f"first {part}" in self.stack:
                nodes.append(text)

    def _pop(self, at: int) -> None:
        self._flush()
        del self.stack[at:]

    def _last(self, names: frozenset[str] | tuple[str, ...], walls: frozenset[str]) -> int | None:
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.stack[at].removeprefix("first ")
            if name in names:
                return at
            if name in walls:
                return None
        return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "body"):
            self.body = self.body or tag == "body"
            if tag == "body" and "head" in self.stack:
                self._pop(self.stack.index("head"))
            return
        self._flush()
        if tag not in HEAD and "head" in self.stack and not any(e in ("title", "template") for e in self.stack):
            self._pop(self.stack.index("head"))
            self.body = True
        if tag in BLOCKS and (at := self._last(("p",), SCOPES | {"button"})) is not None:
            self._pop(at)
        if tag in SIBLINGS and (at := self._last(SIBLINGS[tag], WALLS)) is not None:
            while at and self.stack[at - 1] in SIBLINGS[tag]:
                at -= 1
            self._pop(at)
        if tag in VOID:
            return
        dropped = any(e in DROPPED_ELEMENTS or e == "template" for e in self.stack)
        if tag in MAIN_ELEMENTS and not dropped and tag not in self.found:
            self.found[tag] = []
            tag = f"first {tag}"
        self.stack.append(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # A slash closes nothing in HTML.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._flush()
            return
        if tag in FORMATTING:
            if (at := self._last((tag,), SCOPES)) is not None:
                self._flush()
                del self.stack[at]
            return
        walls = SCOPES if tag in SPECIAL else SPECIAL
        if tag in SCOPES or tag in ("tr", "tbody", "thead", "tfoot"):
            walls = frozenset(("table",)) - {tag}
        if tag not in ("html", "body") and (at := self._last((tag,), walls - {tag})) is not None:
            self._pop(at)
        # An end tag without its element is no boundary.

    def handle_comment(self, data: str) -> None:
        self._flush()

    def handle_data(self, data: str) -> None:
        self.node.append(data)

    def lines(self) -> str:
        self._flush()
        nodes = next((self.found[e] for e in MAIN_ELEMENTS if e in self.found), [])
        lines = (line.strip() for line in "\n".join(nodes).splitlines())
        return "\n".join(line for line in lines if line)


def readable(html: str) -> str:
    page = PageText()
    page.feed(html)
    page.close()
    return page.lines()


def structured_texts(pages: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """All columns of ``pages`` but the HTML, with the readable text: one trimmed line per text node, empty
    lines dropped. Null stays null; a page without readable text gives an empty one. A column of the
    result's name gives way."""
    names = [c for c in pages.columns if c not in (html, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else readable(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "made"])

    rows = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(html).cast("string").alias("made"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    made = rows.mapInArrow(run, schema)
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("made").alias(out))
