"""A page as a tree of block elements with its text blocks as leaves."""

from __future__ import annotations

import re
from html.parser import HTMLParser

#: HTML elements without content, with content that is no page text, and that run inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template head title svg iframe select option datalist textarea".split())
#: Of these, those that a page may forget to end; the start of a block of page text ends them.
FORGOTTEN = frozenset("svg select datalist".split())
BLOCKS = frozenset("address article aside blockquote body center details div dl figure footer form h1 h2 h3 h4 h5 h6 header hr "
                   "li main menu nav ol p pre section table ul".split())
#: Elements that may stand in a head; the start of any other ends it.
IN_HEAD = frozenset("html head title meta link base style script noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img input button picture source output noscript object canvas audio video "
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup "
                   "msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd maction semantics "
                   "annotation annotation-xml".split())
#: Which open elements a start tag closes.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "body": ("head",)}
#: Elements beyond which an implied end doesn't reach.
WALLS = frozenset("table ul ol dl div section article aside nav main body html td th form".split())
#: Elements that tell little of their use.
LAYOUT = frozenset("div section main table tbody tr td body html root center span".split())
LISTS = frozenset(("ul", "ol", "dl"))
NAMES = re.compile(r"[a-z]+")
SENTENCE_END = (".", "!", "?", "…", "”", "\"", ":", "。")


class Node:
    """An element, or a text block if ``text`` is not None."""

    __slots__ = ("parent", "tag", "names", "text", "chars", "linked", "blocks", "long_blocks")

    def __init__(self, parent: int, tag: str, names: tuple[str, ...], text: str | None = None, linked: int = 0):
        self.parent, self.tag, self.names, self.text = parent, tag, names, text
        self.chars = len(text) if text is not None else 0
        self.linked = linked
        self.blocks = int(text is not None)
        self.long_blocks = int(text is not None and len(text) >= 80)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node(-1, "root", ())]
        self.open: list[tuple[str, int]] = [("root", 0)]  # tag, node of the nearest block element
        self.count: dict[str, int] = {}
        self.parts: list[tuple[str, bool]] = []
        self.skipping = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(t for t, _ in self.parts).split())
            if text:
                linked = sum(len(" ".join(t.split())) for t, in_link in self.parts if in_link)
                at = self.open[-1][1]
                self.nodes.append(Node(at, self.nodes[at].tag, (), text, min(linked, len(text))))
            self.parts = []

    def _pop(self) -> None:
        tag, _ = self.open[-1]
        if tag not in INLINE:
            self.flush()
        self.open.pop()
        self.count[tag] -= 1
        self.skipping -= tag in SKIPPED

    def _close(self, tags: tuple[str, ...]) -> None:
        """Ends the nearest open element of these, unless a wall stands before it."""
        if not any(self.count.get(t) for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in tags:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i][0] in WALLS:
                return

    def _end_head(self) -> None:
        """Ends an open head that was not ended, unless within its title, a style, a script or a template."""
        if self.count.get("head") and self.skipping == 1:
            while self.count["head"]:
                self._pop()

    def _end_forgotten(self) -> None:
        """Ends drawings and selections that are still open, unless HTML is embedded in the drawing."""
        if self.count.get("foreignobject") or not any(self.count.get(t) for t in FORGOTTEN):
            return
        first = next(i for i, (tag, _) in enumerate(self.open) if tag in FORGOTTEN)
        while len(self.open) > first:
            self._pop()

    def handle_starttag(self, tag, attrs):
        if tag == "head" and self.count.get("head"):
            return
        if tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCKS and self.skipping:
            self._end_forgotten()
        if tag in CLOSES:
            self._close(CLOSES[tag])
            if tag in ("tr", "tbody"):
                self._close(("tr",))
        if tag not in INLINE and tag not in VOID:
            self._close(("p",))
            if tag[0] == "h" and tag[1:].isdigit():
                self._close(("h1", "h2", "h3", "h4", "h5", "h6"))
        if tag == "body":
            while self.skipping and len(self.open) > 1:  # a head that was never ended
                self._pop()
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.parts.append((" ", False))
            return
        at = self.open[-1][1]
        if tag not in INLINE:
            self.flush()
            if not self.skipping and tag not in SKIPPED:
                words = " ".join(v.lower() for k, v in attrs if v and k in ("class", "id", "role", "aria-label", "itemprop"))
                hidden = any(k in ("hidden", "aria-hidden") and v != "false" or k == "style" and v and "display:none" in v.replace(" ", "")
                             for k, v in attrs)
                self.nodes.append(Node(at, tag, tuple(dict.fromkeys(NAMES.findall(words))) + (("_hidden",) if hidden else ())))
                at = len(self.nodes) - 1
        self.open.append((tag, at))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.skipping += tag in SKIPPED

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in SKIPPED:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.parts.append((" ", False))
        if not self.count.get(tag):
            return
        inline = tag in INLINE
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self._pop()
                return
            if inline and self.open[i][0] not in INLINE:
                return

    def handle_data(self, data):
        if data.strip():
            self._end_head()
        if not self.skipping:
            self.parts.append((data, self.count.get("a", 0) > 0))

    def unknown_decl(self, data):
        pass


def parse(html: str) -> list[Node]:
    """Nodes in page order, parents before children; the first is the root. Sums of a subtree are in its top."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    builder.flush()
    nodes = builder.nodes
    for node in reversed(nodes[1:]):
        top = nodes[node.parent]
        top.chars += node.chars
        top.linked += node.linked
        top.blocks += node.blocks
        top.long_blocks += node.long_blocks
    return nodes


def _step(x: int) -> int:
    return min(12, x.bit_length())


def features(nodes: list[Node]) -> list[list[str]]:
    """Names of what is told of each node by itself; its surroundings are the edges' business."""
    out = []
    for node in nodes:
        share = node.linked / node.chars if node.chars else 0.0
        link = "0" if share == 0 else "low" if share < 0.2 else "mid" if share < 0.6 else "high"
        if node.text is not None:
            text = node.text
            got = [f"text:{node.tag}", f"size:{_step(len(text))}", f"link:{link}",
                   f"end:{text[-1] in SENTENCE_END}", f"commas:{min(3, text.count(','))}"]
            if "©" in text[:3]:
                got.append("copyright")
        else:
            got = [f"tag:{node.tag}", *(f"name:{x}" for x in node.names)]
            if not node.names:
                got.append("unnamed")
                if node.blocks > 1 and (node.tag in LAYOUT or node.tag in LISTS):  # a single block tells of itself, other tags of their use
                    got += [f"links:{link}", f"long:{min(4, node.long_blocks)}"]
        out.append(got)
    return out
