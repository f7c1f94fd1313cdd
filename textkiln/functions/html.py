"""HTML to Markdown without third-party parsers.

The tree is built leniently: an element stays open until its end tag or an enclosing one's, void
elements hold nothing, and an end tag closes up to its nearest open match or is ignored. Page chrome is
removed by rules, then one recursive pass emits Markdown. Adjacent pieces meet with the larger of the
line breaks they ask for, two at most.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser
from urllib.parse import urljoin

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())


class Node:
    """An element; children are nodes and strings."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self):
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def find(self, *tags: str) -> Node | None:
        return next((n for n in self.walk() if n is not self and n.tag in tags), None)

    def text(self) -> str:
        out: list[str] = []
        stack: list = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.children))
        return "".join(out)

    def strings(self) -> str:
        """Stripped pieces of text with single blanks between."""
        out: list[str] = []
        stack: list = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if s := n.strip():
                    out.append(s)
            else:
                stack.extend(reversed(n.children))
        return " ".join(out)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.top = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        values: dict[str, str] = {}
        for k, v in attrs:
            values.setdefault(k, v or "")
        n = Node(tag, values, self.top)
        self.top.children.append(n)
        if tag not in VOID:
            self.top = n

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        n = self.top
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.top = n.parent

    def handle_data(self, data):
        self.top.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def remove(root: Node, drop: Callable[[Node], bool]) -> None:
    """Takes out every element that ``drop`` names, with all it holds."""
    for n in list(root.walk()):
        n.children = [c for c in n.children if isinstance(c, str) or not drop(c)]


#: What counts as page chrome, by tag, role and part of a class or label.
CHROME_TAGS = frozenset("script style noscript nav header footer form button".split())
CHROME_ROLES = frozenset(("navigation", "search"))
CHROME_CLASSES = ("cookie", "share", "recommend", "search")


def is_chrome(n: Node) -> bool:
    cls = n.attrs.get("class", "").lower()
    if n.tag in CHROME_TAGS or n.attrs.get("role") in CHROME_ROLES or "cookie" in n.attrs.get("aria-label", "").lower():
        return True
    if any(c in cls for c in CHROME_CLASSES):
        return True
    if n.tag == "aside" and n.parent is not None:
        before = [c for c in n.parent.children if isinstance(c, Node)]
        at = before.index(n) if n in before else 0
        return at > 0 and "breadcrumbs" in before[at - 1].classes()
    return False


def _joined(parts: list[str]) -> str:
    out = ""
    for p in parts:
        if not p:
            continue
        left, right = out.rstrip("\n"), p.lstrip("\n")
        gap = max(len(out) - len(left), len(p) - len(right))
        out = left + "\n" * min(gap, 2) + right if out else p
    return out


def _escaped(text: str) -> str:
    return re.sub(r"([\\<>*_])", r"\\\1", text)


def _fence(n: Node) -> str:
    code = n.find("code")
    root = code or n
    rows = [x for x in root.walk() if "code" in x.classes() and x is not root and _inside(x, "ec-line", root)]
    if rows:
        raw = "\n".join(x.text() for x in rows)
    else:
        for x in root.walk():
            x.children = ["\n" if isinstance(c, Node) and c.tag == "br" else c for c in x.children]
        raw = root.text()
    language = next((c.split("-", 1)[1] for c in (code.classes() if code else []) if c.startswith(("language-", "lang-"))), "")
    return f"\n```{language}\n{raw.rstrip()}\n```\n"


def _inside(n: Node, cls: str, root: Node) -> bool:
    p = n.parent
    while p is not None and p is not root:
        if cls in p.classes():
            return True
        p = p.parent
    return False


def _wrapped(mark: str, text: str) -> str:
    body = text.strip()
    if not body:
        return text
    lead, tail = text[:len(text) - len(text.lstrip())], text[len(text.rstrip()):]
    return f"{lead and ' '}{mark}{body}{mark}{tail and ' '}"


def _indented(text: str, width: int) -> str:
    return "\n".join((" " * width + x) if x.strip() and i else x for i, x in enumerate(text.split("\n")))


class Emitter:
    """Markdown of a tree; subclass and override ``emit_<tag>`` to change an element."""

    def children(self, n: Node, inline: bool, pre: bool = False) -> str:
        parts = []
        kids = n.children
        for i, c in enumerate(kids):
            if isinstance(c, str):
                if pre:
                    parts.append(c)
                    continue
                t = re.sub(r"[ \t]+", " ", re.sub(r"[ \t]*[\r\n]\s*", "\n", c))
                before = kids[i - 1] if i else None
                after = kids[i + 1] if i + 1 < len(kids) else None
                edge = n.tag in BLOCK or not n.tag
                if (before is None and edge) or (isinstance(before, Node) and before.tag in BLOCK | {"br"}):
                    t = t.lstrip()
                if (after is None and edge) or (isinstance(after, Node) and after.tag in BLOCK):
                    t = t.rstrip()
                parts.append(_escaped(t))
            else:
                parts.append(self.element(c, inline))
        return _joined(parts)

    def element(self, n: Node, inline: bool) -> str:
        if m := re.fullmatch(r"h([1-6])", n.tag):
            text = re.sub(r"\s+", " ", self.children(n, True)).strip()
            if inline:
                return f" {text} "
            return f"\n\n{'#' * int(m[1])} {text}\n\n" if text else ""
        f = getattr(self, f"emit_{n.tag}", None)
        if f:
            return f(n, inline)
        text = self.children(n, inline)
        return f"\n\n{text.strip()}\n\n" if n.tag in BLOCK and not inline and text.strip() else text

    def emit_p(self, n, inline):
        text = self.children(n, inline).strip()
        if inline:
            return f" {text} "
        return f"\n\n{text}\n\n" if text else ""

    def emit_figure(self, n, inline):
        return self.children(n, inline)

    emit_figcaption = emit_summary = emit_details = emit_p

    def emit_br(self, n, inline):
        return " " if inline else "  \n"

    def emit_hr(self, n, inline):
        return "\n\n---\n\n"

    def emit_pre(self, n, inline):
        return _fence(n)

    def emit_code(self, n, inline):
        text = n.text()
        ticks = "`" * (max([0, *map(len, re.findall("`+", text))]) + 1)
        pad = " " if len(ticks) > 1 else ""
        return f"{ticks}{pad}{text.strip()}{pad}{ticks}" if text.strip() else text

    emit_kbd = emit_samp = emit_code

    def emit_strong(self, n, inline):
        return _wrapped("**", self.children(n, inline))

    emit_b = emit_strong

    def emit_em(self, n, inline):
        return _wrapped("*", self.children(n, inline))

    emit_i = emit_em

    def emit_del(self, n, inline):
        return _wrapped("~~", self.children(n, inline))

    emit_s = emit_del

    def emit_img(self, n, inline):
        title = f' "{n.attrs["title"]}"' if n.attrs.get("title") else ""
        return f"![{n.attrs.get('alt', '')}]({n.attrs.get('src', '')}{title})"

    def emit_a(self, n, inline):
        href = n.attrs.get("href")
        if not href:
            return self.children(n, inline)
        rich = n.find("pre", "table", "ul", "ol", "blockquote") or any("\n" in c.text() for c in n.walk() if c.tag in ("code", "kbd", "samp"))
        if rich:
            h = next((x for x in n.walk() if re.fullmatch("h[1-6]", x.tag)), None)
            label = h.strings() if h else n.attrs.get("aria-label") or n.attrs.get("title") or href
            return f"{self.children(n, inline).rstrip()}\n\n[{_escaped(label)}]({href})\n\n"
        text = self.children(n, True)
        body = re.sub(r"\s+", " ", text).strip()
        if not body:
            return ""
        title = f' "{n.attrs["title"]}"' if n.attrs.get("title") else ""
        return f"{' ' if text[:1].isspace() else ''}[{body}]({href}{title}){' ' if text[-1:].isspace() else ''}"

    def emit_blockquote(self, n, inline):
        text = self.children(n, inline).strip()
        return "\n\n" + "\n".join(f"> {x}" if x else ">" for x in text.split("\n")) + "\n\n" if text else ""

    def emit_div(self, n, inline):
        text = self.children(n, inline).strip()
        if re.search("callout|admonition|alert", " ".join(n.classes()), re.I):
            return "\n" + "\n".join(f"> {x}" if x else ">" for x in text.splitlines()) + "\n"
        if inline:
            return f" {text} "
        return f"\n\n{text}\n\n" if text else ""

    emit_section = emit_article = emit_main = emit_div

    def _list(self, n, ordered):
        number = int(n.attrs["start"]) if ordered and n.attrs.get("start", "").isdigit() else 1
        rows = []
        for c in n.children:
            if isinstance(c, Node) and c.tag == "li":
                mark = f"{number}. " if ordered else "- "
                rows.append(mark + _indented(self.children(c, False).strip(), len(mark)))
                number += 1
            elif isinstance(c, Node):
                rows.append(self.element(c, False).strip())
        text = "\n".join(r for r in rows if r)
        nested = n.parent is not None and n.parent.tag == "li"
        return f"\n{text}\n" if nested else f"\n\n{text}\n\n"

    def emit_ul(self, n, inline):
        return self._list(n, False)

    def emit_ol(self, n, inline):
        return self._list(n, True)

    def emit_table(self, n, inline):
        rows = [r for r in n.walk() if r.tag == "tr"]
        if not rows:
            return self.children(n, inline)
        cells = [[re.sub(r"\s*\n\s*", " ", self.children(c, True)).strip().replace("|", "\\|") for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] for r in rows]
        head = rows[0].parent is not None and rows[0].parent.tag == "thead" or all(c.tag == "th" for c in rows[0].children if isinstance(c, Node))
        width = max(map(len, cells))
        out = [] if head else [[""] * width]
        out += cells
        lines = [f"| {' | '.join(r)} |" for r in out]
        return "\n\n" + "\n".join([lines[0], f"| {' | '.join(['---'] * len(out[0]))} |", *lines[1:]]) + "\n\n"


def normalized(body: str) -> str:
    """Lines without blanks at their ends, no two empty ones in a row, none at either end, one final line feed."""
    out: list[str] = []
    for line in map(str.rstrip, body.splitlines()):
        if line or (out and out[-1]):
            out.append(line)
    return "\n".join(out).strip() + "\n"


def render(root: Node, base_url: str) -> tuple[str, list[dict[str, str]]]:
    """Markdown of a tree without chrome, and its images (url, placeholder, alt) in document order."""
    remove(root, is_chrome)
    assets: list[dict[str, str]] = []
    gone: set[int] = set()
    for i, n in enumerate(x for x in root.walk() if x.tag == "img"):
        src = n.attrs.get("src") or n.attrs.get("data-src") or ""
        if not src or src.startswith("data:") or n.attrs.get("role") == "presentation":
            gone.add(id(n))
            continue
        n.attrs["src"] = f"asset://{i:08d}"
        assets.append({"url": urljoin(base_url, src), "placeholder": n.attrs["src"], "alt": n.attrs.get("alt", "")})
    remove(root, lambda n: id(n) in gone)
    remove(root, lambda n: n.tag in ("head", "title"))
    for n in root.walk():
        if n.tag == "a" and n.attrs.get("href"):
            try:
                n.attrs["href"] = urljoin(base_url, n.attrs["href"])
            except ValueError:
                pass
    return normalized(Emitter().children(root, False)), assets


def container(root: Node) -> Node:
    """The main content: ``.api-info``, ``main`` or ``article``, else everything."""
    for want in (lambda n: "api-info" in n.classes(), lambda n: n.tag == "main", lambda n: n.tag == "article"):
        if found := next((n for n in root.walk() if want(n)), None):
            out = Node("", {}, None)
            out.children = [found]
            found.parent = out
            return out
    return root


def page_measures(root: Node) -> dict[str, int]:
    """What decides whether a page is only navigation: links, content elements, characters outside links."""
    links = [n for n in root.walk() if n.tag == "a" and n.attrs.get("href")]
    content = sum(n.tag in ("p", "ul", "ol", "table", "pre", "blockquote", "h2", "h3") for n in root.walk())
    text = root.strings()
    for n in links:
        if label := n.strings():
            text = text.replace(label, "")
    return {"links": len(links), "content": content, "free_chars": len(text.strip())}


#: In how many first characters a sign-in wall speaks, the longest page that can be a missing one, and where it says so.
WALL_CHARS, MISSING_PAGE_CHARS, MISSING_CHARS = 2000, 1200, 600


def classify(title: str, text: str, measures: dict[str, int]) -> str:
    """``auth_wall``, ``not_found``, ``navigation`` or ``content``."""
    head = text[:WALL_CHARS].lower()
    if re.search(r"sign in to continue|log in to (?:view|continue)|authentication required", head):
        return "auth_wall"
    if re.search(r"\b404\b|page not found", title.lower()) or (len(text) < MISSING_PAGE_CHARS and re.search(r"page (?:not found|does not exist)", text[:MISSING_CHARS].lower())):
        return "not_found"
    if measures["links"] >= 3 and measures["content"] < 5 and measures["free_chars"] < 300:
        return "navigation"
    return "content"


#: Classes and tags of decoration in forum posts, how a line of authors begins, and the largest side of an icon.
POST_CHROME = frozenset(("emoji", "mention", "avatar", "anchor"))
POST_TAGS = frozenset(("script", "style", "button", "form", "iframe"))
AUTHOR_LINE = r"^(?:co[ -]?authors?|authors?|written by|posted by)\s*:"
ICON_PIXELS = 32


def clean_post(root: Node) -> Node:
    """A forum post without decoration, author lines and small icons; lightbox links become their full image."""
    def decoration(n: Node) -> bool:
        if POST_CHROME & set(n.classes()) or n.tag in POST_TAGS or "data-user-id" in n.attrs:
            return True
        if n.tag == "img" and not n.attrs.get("alt"):
            sides = [n.attrs.get(side, "") for side in ("width", "height")]
            return all(x.isdigit() and int(x) <= ICON_PIXELS for x in sides)
        return n.tag == "p" and re.match(AUTHOR_LINE, n.strings(), re.I) is not None

    remove(root, decoration)
    for n in list(root.walk()):
        if n.tag == "a" and "lightbox" in n.classes() and n.attrs.get("href") and (image := n.find("img")):
            image.attrs["src"] = n.attrs["href"]
            n.tag, n.attrs = "span", {}
    return root


def image_urls(html: str, base_url: str) -> list[str]:
    """Sorted absolute URLs of a page's images."""
    found = {n.attrs.get("src") or n.attrs.get("data-src") for n in parse(html).walk() if n.tag == "img"}
    return sorted(urljoin(base_url, u) for u in found if u)


def cut_at_heading(root: Node, title: str) -> Node:
    """Everything from the heading with this text on goes, within the heading's parent."""
    for n in root.walk():
        if re.fullmatch("h[1-6]", n.tag) and n.strings().lower() == title.lower() and n.parent is not None:
            at = next(i for i, c in enumerate(n.parent.children) if c is n)
            n.parent.children = n.parent.children[:at]
            break
    return root
