"""Pages in pure Python: decoding, a lenient flat tree, a closed selector grammar, and the extraction rules on the tree.

A page is a list of elements and texts in document order; an element knows the place behind its last descendant, so what
lies below it is a range. Elements are listed by tag, class and id while the page is read, and a selector looks at those
lists only.

Recovery of bad markup is our own: void elements never nest, a block start closes an open `p`, `li`, `tr`, `td` and `th`
close their like, end tags without a start and marked sections are ignored.
"""

from __future__ import annotations

import codecs
import re
from bisect import bisect_left, bisect_right
from collections.abc import Container, Iterable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import chain, islice
from urllib.parse import urljoin

# Fixed values.
BLOCKS = (
    "p", "div", "section", "article", "main", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre",
    "table", "tr", "td", "th", "br", "hr", "figure", "figcaption",
)
SKIPPED = ("script", "style", "nav", "header", "footer", "template")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
TITLE_SELECTORS = ("h1", ".title", ".article-title", "title")
SITE_TITLE_SELECTORS = ("h1", ".title", ".article-title", "title", ".main-title")
CONTENT_SELECTORS = (
    "#rwb_zw", ".detail", ".left_zw", ".u-mainText", ".article-body", "#content", ".main-arti", ".TRS_Editor",
    "#articleText", ".content", ".article-content", ".article", ".text", "#Content", ".cnt_bd", "#UCAP-CONTENT",
    "#zoom", ".pages_content", ".news-content", "#ozoom", ".articleCont", ".con_txt", ".article-detail",
)
REMOVED = ("script", "style", "nav", ".footer", ".header", ".share", ".comment")
TIME_KEYS = ("pubdate", "publishdate", "article:published_time", "time", "date")
TIME_SELECTORS = (".time", ".date", ".info", ".source", "p.sou", "[class*='time']", "[class*='date']")
SOURCE_SELECTORS = (".source", "[class*='source']", "p.sou em", ".author", ".origin")
PUBLISH_TIME = re.compile(r"\d{4}[年\-/]\d{1,2}[月\-/]\d{1,2}(\s+\d{1,2}:\d{2}(:\d{2})?)?")
DOC_NUMBER = re.compile(r"〔\d{4}〕\d+号|〔\d{4}〕第\d+号|\d{4}第\d+号|[国省市县发办]\d{4}\d+号")
INDEX_LABEL = "索引号"
INDEX_VALUE = re.compile(r"[0-9A-Za-z][0-9A-Za-z._/-]{3,}")
SOURCE_LABEL = re.compile(r"^(来源|稿源|出处|作者)[:：\s]*")
TITLE_MARKS = ("_", "--", "-", "|")
BAD_PAGE_TITLES = ("404", "错误", "NotFound")
BAD_HEADINGS = ("导航", "菜单")
IMAGE_ENDS = (".gif", ".svg", "icon", "logo")
SELECTED_MIN, BODY_MIN, IMAGES_MAX, TITLE_MIN, SOURCE_END = 40, 30, 5, 4, 40
META_CHARSET = re.compile(rb"charset=[\"']?([\w-]+)")
FALLBACK_ENCODINGS = ("utf-8", "gb18030", "gbk", "gb2312")

#: Texts in these are no part of a page's text.
UNREAD = frozenset({"script", "style", "template"})
#: What a start tag closes, and what keeps it from looking further up.
P_ENDS = (frozenset({"p"}), frozenset({"li", "td", "th", "div", "section", "article", "main", "blockquote"}))
CLOSES = {
    **{tag: [P_ENDS] for tag in BLOCKS if tag != "br"},
    "li": [P_ENDS, (frozenset({"li"}), frozenset({"ul", "ol"}))],
    "tr": [P_ENDS, (frozenset({"tr"}), frozenset({"table"}))],
    "td": [P_ENDS, (frozenset({"td", "th"}), frozenset({"tr", "table"}))],
    "th": [P_ENDS, (frozenset({"td", "th"}), frozenset({"tr", "table"}))],
}
_BLOCKS, _SKIPPED, _VOID = frozenset(BLOCKS), frozenset(SKIPPED), frozenset(VOID)
_MARKS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))
_SPACE = re.compile(r"\s+")
#: Tokens that HTMLParser reads in one way only: a text before a tag, an end tag, a start tag, a comment, a document type.
_TOKEN = re.compile(
    r"""([^<]++)(?=<)|</([A-Z][A-Z0-9]*+)>|<([A-Z][A-Z0-9]*+)((?:[ ]++[A-Z][\w:.-]*+="[^"<>&]*+")*+)[ ]*+>|<!--[^<>-]*+-->|<!doctype[^<>"']*+>""",
    re.ASCII | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r'([^ =]+)="([^"]*)"')
#: What stands in these isn't read as markup; here it holds none.
_RAW = frozenset({"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"})
_NO_MARKUP = re.compile(r"[^<&]*+</([A-Za-z]++)>")
_TITLE_END = re.compile("|".join(map(re.escape, TITLE_MARKS)))

#: What one page may cost: characters of its text and items of its tree.
PAGE_CHARACTERS, PAGE_ITEMS = 64 << 20, 2_000_000


class OverLimit(ValueError):
    """A page above its budget."""


def encodings(data: bytes, preferred: str | None, declared: str | None) -> list[str]:
    """Names to try, in order: byte order mark, the page's own word, the site's, the server's, the usual ones."""
    own = META_CHARSET.search(data, 0, 8192)
    named = [name for mark, name in _MARKS if data.startswith(mark)]
    named += [own[1].decode("ascii", "ignore") if own else "", preferred or "", declared or "", *FALLBACK_ENCODINGS]
    return [n for n in dict.fromkeys(map(str.lower, named)) if n and "iso-8859" not in n]


def decode_page(data: bytes, preferred: str | None = None, declared: str | None = None) -> tuple[str, str]:
    """(text, encoding) by the first name that fits every byte; ValueError if none does."""
    for name in encodings(data, preferred, declared):
        try:
            return codecs.decode(data, name, "strict"), name
        except (LookupError, ValueError, AssertionError):  # unknown names, bad bytes, codecs that aren't for text
            continue
    raise ValueError("no encoding fits")


class Page(HTMLParser):
    """Items in document order. Of item i: `tags[i]` ("" for a text), `values[i]` (attributes or the text), `ups[i]` (its
    parent), `ends[i]` (the place behind its last descendant). Item 0 is the page itself."""

    def __init__(self, text: str = "", items: int = PAGE_ITEMS):
        super().__init__(convert_charrefs=True)
        self.most = items
        self.tags, self.values, self.ups, self.ends = ["#page"], [{}], [-1], [0]
        self.by_tag: dict[str, list[int]] = {}
        self.by_class: dict[str, list[int]] = {}
        self.by_id: dict[str, list[int]] = {}
        self.classed: list[int] = []
        self.holes: list[tuple[int, int]] = []
        self._open, self._fresh = [0], True
        self._read(text)
        self._leave(0)

    # Reading.

    def _read(self, text: str) -> None:
        """The common tokens; from the first other one on HTMLParser reads, which takes several times as long."""
        at = 0
        while found := _TOKEN.match(text, at):
            words, end, start, attributes = found.groups()
            if words:
                self.handle_data(unescape(words) if "&" in words else words)
            elif end:
                self.handle_endtag(end.lower())
            elif start:
                tag = start.lower()
                if tag in _RAW and (tag == "plaintext" or (inner := _NO_MARKUP.match(text, found.end())) is None or inner[1].lower() != tag):
                    break
                self.handle_starttag(tag, [(k.lower(), v) for k, v in _ATTRIBUTE.findall(attributes)] if attributes else ())
            else:
                self._break()
            at = found.end()
        if at < len(text):
            self.feed(text[at:])
            self.close()

    def _leave(self, depth: int) -> None:
        for i in self._open[depth:]:
            self.ends[i] = len(self.tags)
        del self._open[depth:]

    def _end(self, tags: Container[str], stops: Container[str] = ()) -> bool:
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag in stops:
                return False
            if tag in tags:
                self._leave(depth)
                return True
        return False

    def _add(self, tag: str, value) -> int:
        if len(self.tags) > self.most:
            raise OverLimit(f"more than {self.most} items")
        self.tags.append(tag)
        self.values.append(value)
        self.ups.append(self._open[-1])
        self.ends.append(len(self.tags))
        return len(self.tags) - 1

    def handle_starttag(self, tag, attrs):
        for tags, stops in CLOSES.get(tag, ()):
            self._end(tags, stops)
        own = {k: v or "" for k, v in reversed(attrs)}
        i = self._add(tag, own)
        self.by_tag.setdefault(tag, []).append(i)
        if "id" in own:
            self.by_id.setdefault(own["id"], []).append(i)
        if "class" in own:
            self.classed.append(i)
            for c in dict.fromkeys(own["class"].split()):
                self.by_class.setdefault(c, []).append(i)
        if tag not in _VOID:
            self._open.append(i)
        self._fresh = True

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._fresh = self._end((tag,)) or self._fresh

    def handle_data(self, data):
        if self._fresh:
            self._add("", [])
            self._fresh = False
        self.values[-1].append(data)

    def _break(self, *_):
        """A comment or a declaration ends a text."""
        self._fresh = True

    handle_comment = handle_decl = handle_pi = unknown_decl = _break

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    # Looking.

    def hidden(self, i: int) -> bool:
        at = bisect_right(self.holes, (i, len(self.tags) + 1)) - 1
        return at >= 0 and i < self.holes[at][1]

    def texts(self, i: int = 0, unread: frozenset = UNREAD) -> Iterator[str]:
        """The texts below item i that are read, in order."""
        k, end = i + 1, self.ends[i]
        while k < end:
            if self.holes and self.hidden(k) or self.tags[k] in unread:
                k = self.ends[k]
                continue
            if not self.tags[k]:
                yield "".join(self.values[k])
            k += 1

    def elements(self, compound: tuple) -> Iterable[int]:
        """The elements that a compound names, from the shortest of its lists."""
        if (single := _listed(compound)) is not None:
            return getattr(self, single[0]).get(single[1], ())
        return self._matching(compound)

    def _matching(self, compound: tuple) -> Iterator[int]:
        tag, classes, ids, inside = compound
        lists = [self.by_tag.get(tag, [])] * bool(tag) + [self.by_class.get(c, []) for c in classes] + [self.by_id.get(x, []) for x in ids] + [self.classed] * bool(inside)
        for k in min(lists, key=len, default=range(1, len(self.tags))):
            own = self.values[k]
            if not self.tags[k] or tag and self.tags[k] != tag:
                continue
            if classes and not set(classes).issubset(own.get("class", "").split()):
                continue
            if all(own.get("id") == x for x in ids) and all(x in own.get("class", "") for x in inside):
                yield k

    def select(self, selector: str, below: int = 0) -> list[int]:
        """Items below `below` for `tag`, `.class`, `#id`, `[class*='x']`, their compounds, descendants and lists."""
        found = set()
        for steps in _compiled(selector):
            ranges: list[tuple[int, int]] | None = None
            for compound in steps:
                hits = self.elements(compound)
                if len(steps) == 1:
                    last = hits
                    break
                if ranges is not None:
                    starts = [a for a, _ in ranges]
                    hits = (k for k in hits if (at := bisect_left(starts, k) - 1) >= 0 and k < ranges[at][1])
                last = list(hits)
                ranges = outermost((k, self.ends[k]) for k in last)
            found.update(k for k in last if below < k < self.ends[below] and not self.hidden(k))
        return sorted(found)

    def first(self, selector: str, below: int = 0) -> int | None:
        if (single := _single(selector)) is None:
            return next(iter(self.select(selector, below)), None)
        listed = getattr(self, single[0]).get(single[1])
        return listed and next((k for k in listed if below < k < self.ends[below] and not (self.holes and self.hidden(k))), None)

    def drop(self, items: Iterable[int]) -> None:
        """Take items with all below them out of the page."""
        self.holes = outermost(sorted(chain(self.holes, ((k, self.ends[k]) for k in items))))

    def joined(self, i: int | None) -> str:
        """H2: the stripped texts below item i, without a separator."""
        return "" if i is None else "".join(map(str.strip, self.texts(i)))

    def lines(self, i: int) -> str:
        """H1: the text below item i, one line for each run between block boundaries; white space becomes one blank.

        A line begins with a text that isn't blank, so blanks count only behind words.
        """
        done, line, blocks = [], [], []  # blocks: where the open ones end
        k, end = i + 1, self.ends[i]

        def cut() -> None:
            if line:
                done.append("".join(line))
                line.clear()

        while k < end:
            while blocks and blocks[-1] <= k:
                cut()
                blocks.pop()
            tag = self.tags[k]
            if tag in _SKIPPED or self.holes and self.hidden(k):
                k = self.ends[k]
                continue
            if tag in _BLOCKS:
                cut()
                blocks.append(self.ends[k])
            elif not tag and (text := _SPACE.sub(" ", "".join(self.values[k]))) and (line or not text.isspace()):
                line.append(text)
            k += 1
        cut()
        return "\n".join(done).strip()


def outermost(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without those that lie inside others."""
    out: list[tuple[int, int]] = []
    for a, b in ranges:
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


def parse(text: str) -> Page:
    return Page(text)


_SIMPLE = re.compile(r"([A-Za-z][\w-]*)?((?:[.#][\w-]+|\[class\*='[^']*'\])*)")
_PART = re.compile(r"\.([\w-]+)|#([\w-]+)|\[class\*='([^']*)'\]")


@lru_cache(maxsize=1024)
def _compiled(selector: str) -> tuple[tuple[tuple, ...], ...]:
    """For each alternative its compounds from left to right: (tag, classes, ids, parts of the class attribute)."""

    def compound(simple: str) -> tuple:
        found = _SIMPLE.fullmatch(simple)
        if not simple or found is None:
            raise ValueError(f"not a selector: {selector}")
        parts = _PART.findall(found[2])
        return (found[1] or "").lower(), tuple(c for c, _, _ in parts if c), tuple(i for _, i, _ in parts if i), tuple(k for _, _, k in parts if k)

    return tuple(tuple(compound(x) for x in part.split()) for part in selector.split(","))


@lru_cache(maxsize=1024)
def _listed(compound: tuple) -> tuple[str, str] | None:
    """The list that holds just what the compound names, and its key there; None where it has several parts."""
    tag, classes, ids, inside = compound
    if inside or bool(tag) + len(classes) + len(ids) != 1:
        return None
    return ("by_tag", tag) if tag else ("by_class", classes[0]) if classes else ("by_id", ids[0])


@lru_cache(maxsize=1024)
def _single(selector: str) -> tuple[str, str] | None:
    alternatives = _compiled(selector)
    return _listed(alternatives[0][0]) if len(alternatives) == len(alternatives[0]) == 1 else None


def _headings(page: Page, selectors: Iterable[str]) -> Iterator[tuple[str, tuple[str, ...]]]:
    """Texts that may be the title, best first, each with the words that it must not hold."""
    for selector in selectors:
        text = page.joined(page.first(selector))
        if selector == "title":
            yield _TITLE_END.split(text, maxsplit=1)[0].strip(), BAD_PAGE_TITLES
        else:
            yield text, BAD_HEADINGS
    yield page.joined(page.first("h1")), ()


def title_of(page: Page, selectors: Iterable[str] = TITLE_SELECTORS, title_min: int = TITLE_MIN) -> str | None:
    """H4"""
    return next((text for text, bad in _headings(page, selectors) if len(text) >= title_min and not any(map(text.__contains__, bad))), None)


def publish_time_of(page: Page) -> str | None:
    """H5: the first date of the meta elements by key, then of the elements that show one."""
    said: dict[tuple[str, str], str] = {}
    for k in page.by_tag.get("meta", ()):
        own = page.values[k]
        for name in {"name", "property"} & own.keys():
            said.setdefault((name, own[name]), own.get("content", ""))
    meta = (said.get(("name", key), said.get(("property", key), "")) for key in TIME_KEYS)
    shown = (page.joined(page.first(s)) for s in TIME_SELECTORS)
    found = next(filter(None, map(PUBLISH_TIME.search, chain(meta, shown))), None)
    return found and found[0].translate(str.maketrans("年月/", "---"))


def source_of(page: Page) -> str | None:
    """H6"""
    names = (SOURCE_LABEL.sub("", page.joined(page.first(s))).strip() for s in SOURCE_SELECTORS)
    return next((n for n in names if 0 < len(n) < SOURCE_END), None)


def doc_number_of(texts: Iterable[str]) -> str | None:
    """H7"""
    return next((m[0] for m in map(DOC_NUMBER.search, texts) if m), None)


def index_number_of(texts: Iterable[str]) -> str | None:
    """H8: the value behind the label in one text, or the whole of the next text if the label ends its own."""
    waits = False
    for text in texts:
        if waits and (found := INDEX_VALUE.fullmatch(_SPACE.sub("", text))):
            return found[0]
        waits = False
        if INDEX_LABEL[0] not in text:
            continue
        _, label, rest = _SPACE.sub("", text).partition(INDEX_LABEL)
        rest = rest.lstrip(":：")
        if label and rest and (found := INDEX_VALUE.match(rest)):
            return found[0]
        waits = bool(label) and not rest
    return None


def numbers_of(page: Page) -> tuple[str | None, str | None]:
    """H7 and H8: (docNumber, indexNumber)."""
    texts = [t for t in map(str.strip, page.texts()) if t]
    return doc_number_of(texts), index_number_of(texts)


def _whole(page: Page) -> str:
    """The body of a page that no selector helps with: its article, its main part, its paragraphs, all of it."""
    for tag in ("article", "main"):
        if (k := page.first(tag)) is not None:
            return page.lines(k)
    paragraphs = outermost((k, page.ends[k]) for k in page.select("p"))
    return "\n".join(page.lines(k) for k, _ in paragraphs) if paragraphs else page.lines(page.first("body") or 0)


def body_of(page: Page, selectors: Iterable[str] = CONTENT_SELECTORS) -> str:
    """H9. What is dropped from a box stays out for what follows."""

    def cleaned(selector: str) -> str:
        box = page.first(selector)
        if box is None:
            return ""
        page.drop(page.select(",".join(REMOVED), box))
        return page.lines(box)

    return next((text for text in map(cleaned, selectors) if len(text) >= SELECTED_MIN), None) or _whole(page)


_joined = lru_cache(maxsize=1024)(urljoin)


def absolute(base: str, reference: str) -> str | None:
    """None where either is no URL."""
    try:
        return (_joined if len(base) + len(reference) < 1000 else urljoin)(base, reference)
    except ValueError:
        return None


def images_of(page: Page, base: str) -> list[str]:
    """H11"""
    named = (page.values[k].get("src") or page.values[k].get("data-src") for k in page.select("img"))
    full = (absolute(base, src) for src in named if src)
    return list(islice((x for x in full if x and not x.lower().endswith(IMAGE_ENDS)), IMAGES_MAX))


def anchors_of(page: Page, base: str) -> list[tuple[int, str, str]]:
    """(place, absolute URL, text) of each link that leads somewhere (U11); what remains of H12 is native."""
    out = []
    for place, k in enumerate(page.by_tag.get("a", ())):
        href = page.values[k].get("href", "").strip()
        if href and not href.startswith(("javascript:", "#")) and (full := absolute(base, href)) is not None:
            out.append((place, full, page.joined(k)))
    return out


def within_budget(text: str, characters: int = PAGE_CHARACTERS, items: int = PAGE_ITEMS) -> Page:
    """The page of `text`; OverLimit if it is above its budget."""
    if len(text) > characters:
        raise OverLimit(f"more than {characters} characters")
    return Page(text, items)


def article_of(text: str, base: str, title_selectors: Iterable[str] = TITLE_SELECTORS, content_selectors: Iterable[str] = CONTENT_SELECTORS, characters: int = PAGE_CHARACTERS, items: int = PAGE_ITEMS, title_min: int = TITLE_MIN) -> dict:
    """The parts of an article; `reject` says why a page gives none."""
    page = within_budget(text, characters, items)
    doc, index = numbers_of(page)
    out = {"title": title_of(page, title_selectors, title_min), "publishTime": publish_time_of(page), "source": source_of(page), "docNumber": doc, "indexNumber": index}
    out["content"] = body_of(page, content_selectors)
    out["images"] = images_of(page, base)
    out["reject"] = "no title" if out["title"] is None else "short body" if len(out["content"]) < BODY_MIN else None
    return out
