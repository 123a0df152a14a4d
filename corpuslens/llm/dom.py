"""Small HTML reader: elements with their places in the page, and blocks of text."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe svg math xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
# A start tag on the left closes open elements on the right, up to the nearest of their containers.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "tr"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
SCOPE = {"table", "td", "th", "button", "object", "html"}


@dataclass
class Element:
    """One element of a page; ``node`` names its place in the tree of its site."""

    tag: str
    parent: int
    node: int
    names: tuple[str, ...]  # parts of class and id, and role
    hidden: bool
    whole: frozenset[str] = frozenset()  # classes and id as they stand
    role: frozenset[str] = frozenset()
    children: list[str] = field(default_factory=list)


def _attributes(rest: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(rest):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def node_of(parent: int, label: str) -> int:
    """Signed 64-bit name of a place: the labels on the way from the root."""
    digest = xxhash.xxh64_intdigest(label, parent & 0xFFFFFFFFFFFFFFFF)
    return digest - (1 << 64) if digest >> 63 else digest


class Page:
    """``elements`` in page order and ``blocks`` as ``(element, text)``; empty blocks are left out."""

    def __init__(self, source: str):
        self.elements = [Element("#root", -1, 0, (), False)]
        self.blocks: list[tuple[int, str]] = []
        self.open = [0]
        self.text: list[str] = []
        self._read(source)

    def _flush(self) -> None:
        if self.text:
            words = " ".join("".join(self.text).split())
            self.text = []
            if words:
                self.blocks.append((self._block_element(), words))

    def _block_element(self) -> int:
        for i in reversed(self.open):
            if self.elements[i].tag in BLOCK or i == 0:
                return i
        return 0

    def _close(self, depth: int) -> None:
        if any(self.elements[i].tag in BLOCK for i in self.open[depth:]):
            self._flush()
        del self.open[depth:]

    def _start(self, tag: str, rest: str) -> None:
        elements = self.elements
        if tag in BLOCK:
            for depth in range(len(self.open) - 1, 0, -1):
                above = elements[self.open[depth]].tag
                if above == "p":
                    self._close(depth)
                    break
                if above in BLOCK:
                    break
            if tag in CLOSES:
                ends, stops = CLOSES[tag]
                lowest = None
                for depth in range(len(self.open) - 1, 0, -1):
                    above = elements[self.open[depth]].tag
                    if above in stops:
                        break
                    if above in ends:
                        lowest = depth
                if lowest is not None:
                    self._close(lowest)
            self._flush()
        found = _attributes(rest) if "=" in rest or "hidden" in rest else {}
        names = " ".join(found.get(k, "") for k in ("class", "id", "role")).lower()
        parent = self.open[-1]
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
        label = f"{tag}.{found.get('class', '')}#{found.get('role', '')}" if found else tag
        whole = frozenset(f"{found.get('class', '')} {found.get('id', '')}".lower().replace("_", "-").split()) if names else frozenset()
        role = frozenset(found.get("role", "").lower().split()) if names else frozenset()
        elements.append(
            Element(tag, parent, node_of(elements[parent].node, label), tuple(re.findall("[a-z0-9]+", names)), hidden, whole, role)
        )
        elements[parent].children.append(tag)
        if tag not in VOID and not rest.endswith("/>"):
            self.open.append(len(elements) - 1)

    def _end(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            above = self.elements[self.open[depth]].tag
            if above == tag:
                self._close(depth)
                return
            if above in SCOPE and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                return

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            token = TOKEN.search(source, at)
            run = source[at : token.start() if token else size]
            if run:
                self.text.append(html.unescape(run) if "&" in run else run)
            if not token:
                break
            at = token.end()
            tag = token["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if token["end"]:
                self._end(tag)
            elif tag == "br":
                self.text.append(" ")
            elif tag in RAW:
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(source, at)
                at = close.start() if close else size
                done = TOKEN.match(source, at) if close else None
                at = done.end() if done else at
            else:
                self._start(tag, token["rest"])
        self._flush()

    def above(self, element: int, most: int | None = None) -> list[int]:
        """The element and what it lies in, innermost first, without the root; ``most`` levels."""
        out = []
        while element > 0 and (most is None or len(out) < most):
            out.append(element)
            element = self.elements[element].parent
        return out
