"""Main text of web pages by template deduction from equivalence classes of tokens.

A page is a sequence of tokens: tags, told apart by name, class and id, and blocks of text outside
excluded elements, of any length, by their digest.
Tokens of a host that occur equally often on each of its pages, page by page, share their
occurrence vector and make one equivalence class. Classes of enough tokens on enough pages are
valid; their tokens are put in the order of their mean first place. Those that occur once a page are
the skeleton of the template, the others nest in its slots. What is left between template tokens are
the slots with the page's own text.

Vectors are never gathered: a grouped exclusive or of hashes of (page, count) stands for one, so the
pages of a hot host meet only in partial sums. The template of a host is one small row (tokens
that at least half of its pages have) and is joined back to its pages. Hosts of few
pages use the template of all hosts. A text of a valid class is template if ``TEXT_SHARE`` of the pages
have it; hosts of fewer than ``TEXT_PAGES`` pages, too few to tell, take the common texts of all hosts.
Pages without any token (null, empty) count nowhere.

A block whose text is part of the template is never main text, inside ``article`` and ``main``
either. What is left is judged by its slot: the skeleton tokens it lies between, the nested tag it
follows (the slots after one nested tag are one role) and the doubtful element around it. The tag
lists come second. Elements with the tag, the role or the whole class name of navigation, headers, footers,
sidebars, notices, adverts, forms, scripts, styles or comments are out. A listed word that is but a part
of a class name (``post-header``), or a ``header`` inside ``article`` or ``main``, is doubtful: its texts
that vary are kept unless their slot is mostly links; on hosts too small to tell, only inside
``article`` or ``main``. Pages with ``article`` or ``main`` give what is inside, the others what is not mostly links.

If all that an ``article`` or ``main`` holds is template, as on a host of copies of one page, it is kept.

Results for odd input: null and empty pages give empty text; unclosed elements end with the
element around them; a page without any tag is text; rows that repeat an id are rows of their own.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.shared import bounded_batches
from glyphmill.llm.urls import host_of
from glyphmill.session import materialize

#: What HTML calls void, raw or block-level, and what is no main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
MAIN = frozenset("article main".split())
ROOTS = frozenset("html body article main".split())
EXCLUDED_TAGS = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea input "
    "iframe svg math menu dialog object canvas audio video".split()
)
EXCLUDED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
EXCLUDED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice alert popup modal overlay newsletter "
    "subscribe social share sharing related recommended footer header masthead comment comments disqus respond "
    "widget toolbar pagination pager skip login signup search".split()
)
MIN_PAGES = 4  # of a host with a template of its own
TEXT_PAGES = 8  # of a host whose common texts count as template
MIN_CLASS = 3
TEXT_SHARE = 0.75  # of the pages of a host that have a text which is template

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_SPECIAL = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"([^\s=\"'/<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z0-9]+")


class Token:
    """A tag, or a piece of text between tags."""

    __slots__ = ("kind", "name", "key", "text", "excluded", "doubtful", "listed")

    def __init__(
        self, kind: str, name: str, key: str, text: str = "", excluded: bool = False, doubtful: str = "",
        listed: bool = False,
    ) -> None:
        self.kind, self.name, self.key, self.text, self.excluded = kind, name, key, text, excluded
        self.doubtful = doubtful  # key of the nearest element that only a part of its class name speaks against
        self.listed = listed  # excluded by its role or whole class name, not just its tag


class Block:
    """The text between two block-level tags, outside excluded elements."""

    __slots__ = ("text", "in_main", "doubtful", "chars", "linked")

    def __init__(self, text: str, in_main: bool, doubtful: str, chars: int, linked: int) -> None:
        self.text, self.in_main, self.doubtful, self.chars, self.linked = text, in_main, doubtful, chars, linked


def _opening(name: str, attrs: str) -> Token:
    found = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attrs)}
    marks = f"{found.get('class', '')} {found.get('id', '')}".split()
    listed = name not in ROOTS and (
        found.get("role") in EXCLUDED_ROLES or "hidden" in found or not EXCLUDED_WORDS.isdisjoint(marks)
    )
    key = f"<{name} {' '.join(sorted(set(marks)))}".rstrip() + ">"
    partly = name not in ROOTS and not EXCLUDED_WORDS.isdisjoint(_WORD.findall(" ".join(marks)))
    listed |= partly and name in INLINE  # no block of its own that a template could judge
    return Token("open", name, key, "", listed or name in EXCLUDED_TAGS, key if partly and not listed else "", listed)


class _Tags:
    """Finds where tags end, in time proportional to the page: what a search has found or missed is not looked for again."""

    def __init__(self, page: str) -> None:
        self.page, self.size = page, len(page)
        self._next_close = self._next_special = -1
        self._ends: dict[int, int] = {}  # by the place of a quote that opens a value

    def close(self, at: int) -> int:
        """The first ``>`` from ``at`` on, or the size of the page."""
        if self._next_close < at:
            found = self.page.find(">", at)
            self._next_close = self.size if found < 0 else found
        return self._next_close

    def end(self, at: int) -> int:
        """The ``>`` that ends a tag whose attributes begin at ``at``: the first one outside quotes, if all quotes close."""
        passed, end = [], self.size
        while True:
            if self._next_special < at:
                found = _SPECIAL.search(self.page, at)
                self._next_special = found.start() if found else self.size
            quote = self._next_special
            if quote == self.size:
                break
            if self.page[quote] == ">":
                end = quote
                break
            if quote in self._ends:
                end = self._ends[quote]
                break
            passed.append(quote)
            closing = self.page.find(self.page[quote], quote + 1)
            if closing < 0:
                break
            at = closing + 1
        self._ends.update(dict.fromkeys(passed, end))
        # Later searches may begin before the place where this one ended.
        self._next_special = -1 if passed else self._next_special
        return end


def tokens(page: str) -> Iterator[Token]:
    tags, begun, n = _Tags(page), 0, len(page)
    start = page.find("<")
    while start >= 0:
        name = attrs = None
        literal = ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = n if end < 0 else end + 3
        elif page.startswith("<![CDATA[", start):
            end = page.find("]]>", start + 9)
            literal, end = page[start + 9 : end if end >= 0 else n], n if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), start):
            end = tags.close(start + 2) + 1
        elif tags.close(start) < n and (name := _NAME.match(page, start)):
            close = tags.close(name.end())
            attrs = page[name.end() : close]
            if "'" in attrs or attrs.count('"') % 2:  # else all its quotes close before
                end = tags.end(name.end())
                close = close if end == n else end
                attrs = page[name.end() : close]
            end = close + 1
        else:
            end = n + 1
        if end > n:  # no tag, but text
            start = page.find("<", start + 1)
            continue
        if start > begun:
            text = page[begun:start]
            yield Token("text", "", " ".join(html.unescape(text).split()), text)
        begun = end
        if literal:
            yield Token("text", "", "", html.escape(literal))
        if name is not None:
            tag = name[1].lower()
            if page[start + 1] == "/":
                yield Token("close", tag, f"</{tag}>")
            else:
                yield _opening(tag, attrs or "")
                if tag in RAW:
                    end_tag = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, begun)
                    begun = min(tags.close(end_tag.end()) + 1, n) if end_tag else n
                    yield Token("close", tag, f"</{tag}>")
        start = page.find("<", begun)
    if begun < n:
        text = page[begun:]
        yield Token("text", "", " ".join(html.unescape(text).split()), text)


def digest(text: str) -> str:
    """The token of a block's text; tags begin otherwise."""
    return "#" + blake2b(text.encode(errors="surrogatepass"), digest_size=16).hexdigest()


def _token_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``page, host, token, n, place`` of each token of each page, and one row of an empty token for the page."""
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            rows: tuple[list, ...] = ([], [], [], [], [])
            for page, host, text in zip(*(c.to_pylist() for c in batch.columns)):
                seen: dict[str, list[int]] = {}
                for place, part in enumerate(layout(text)):
                    key = part.key if isinstance(part, Token) else digest(part.text)
                    seen.setdefault(key, [0, place])[0] += 1
                if seen:
                    seen[""] = [1, 0]
                for key, (n, place) in seen.items():
                    for column, value in zip(rows, (page, host, key, n, place)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string()),
                 pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64())],
                names=["page", "host", "token", "n", "place"],
            )


def _classes(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """The template of each group: its valid classes' tokens in order, with their class."""
    frequent = vectors.filter((F.col("pages") * 2 >= F.col("size")) & (F.col("pages") >= 2))
    # The tokens here are at most twice as many as a page has on average.
    classes = frequent.groupBy(*keys, "vector", "pages", "total", "size").agg(
        F.array_sort(F.collect_list(F.struct("place", "token"))).alias("members")
    )
    usual = F.col("pages") >= F.col("size") * TEXT_SHARE
    valid = classes.filter((F.size("members") >= MIN_CLASS) | usual & (F.col("size") >= MIN_CLASS))
    token = F.transform(
        "members",
        lambda m: F.struct(
            m["place"].alias("place"), m["token"].alias("token"),
            (F.col("pages") == F.col("total")).alias("once"),
            usual.alias("usual"),
        ),
    )
    return valid.groupBy(*keys, "size").agg(F.array_sort(F.flatten(F.collect_list(token))).alias("template"))


def templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``host, size, template`` of the hosts of ``page, host, html``, and the one of all hosts."""
    rows = pages.mapInArrow(_token_rows, "page long, host string, token string, n long, place long")
    vector = F.bit_xor(F.xxhash64("page", "n")).alias("vector")
    vectors = materialize(
        rows.groupBy("host", "token").agg(
            F.count(F.lit(1)).alias("pages"), F.sum("n").alias("total"), F.sum("place").alias("places"), vector
        ),
        "html-vectors",
    )
    sizes = materialize(vectors.filter("token = ''").select("host", F.col("pages").alias("size")), "host-sizes")
    by_host = vectors.filter("token <> ''")
    place = (F.col("places") / F.col("pages")).alias("place")
    own = _classes(
        by_host.select("host", "token", "pages", "total", "vector", place).join(
            sizes.filter(F.col("size") >= MIN_PAGES), "host"
        ),
        ["host"],
    )
    # The vector of a token over all pages is the exclusive or of its vectors by host.
    all_hosts = by_host.groupBy("token").agg(
        F.sum("pages").alias("pages"), F.sum("total").alias("total"), F.sum("places").alias("places"),
        F.bit_xor("vector").alias("vector"),
    )
    n = sizes.agg(F.sum("size")).first()[0] or 0
    general = _classes(all_hosts.select("token", "pages", "total", "vector", place, F.lit(n).alias("size")), [])
    return materialize(own, "templates"), materialize(general, "template")


def layout(page: str | None) -> Iterator[Token | Block]:
    """The tags of a page and its blocks, each block before the tag that ends it."""
    stack: list[Token] = []
    within: Counter[str] = Counter()  # names of the elements in the stack
    buffer: list[str] = []
    chars = linked = 0

    def in_main() -> bool:
        return any(within[name] for name in MAIN)

    def leave() -> str:
        name = stack.pop().name
        within[name] -= 1
        return name

    def block() -> Iterator[Block]:
        nonlocal chars, linked
        text = " ".join(html.unescape("".join(buffer)).split())
        if text:
            doubtful = stack[-1].doubtful if stack else ""
            yield Block(text, in_main(), doubtful, chars, linked)
        buffer.clear()
        chars = linked = 0

    for token in tokens(page or ""):
        if token.kind == "text":
            if not (stack and stack[-1].excluded):
                buffer.append(token.text)
                chars += len(token.key)
                linked += len(token.key) if within["a"] else 0
            continue
        if token.name not in INLINE:
            yield from block()
        if token.kind == "open":
            if token.name not in VOID:
                if token.name in SELF_CLOSING and stack and stack[-1].name == token.name:
                    leave()
                if token.name == "header" and not token.listed and in_main():
                    token.excluded, token.doubtful = False, token.key
                if stack:
                    token.excluded |= stack[-1].excluded  # what is inside is excluded with it
                    token.doubtful = token.doubtful or stack[-1].doubtful
                stack.append(token)
                within[token.name] += 1
        elif within[token.name]:
            while leave() != token.name:
                pass
        yield token
    yield from block()


class Slot:
    """How much text a slot of a page holds, and how much of it is links."""

    __slots__ = ("chars", "linked")

    def __init__(self) -> None:
        self.chars = self.linked = 0


class Template:
    """The tags that occur once a page, the repeated ones nested between them, the texts of the template."""

    __slots__ = ("skeleton", "nested", "common", "judged")

    def __init__(
        self, skeleton: frozenset[str] = frozenset(), nested: frozenset[str] = frozenset(),
        common: frozenset[str] = frozenset(), judged: bool = False,
    ) -> None:
        self.skeleton, self.nested, self.common = skeleton, nested, common
        self.judged = judged  # whether the host has pages enough to tell common texts


def main_text(page: str | None, template: Template) -> str:
    """The text of the main slots."""
    slots: dict[tuple[int, str, str], Slot] = {}
    blocks: list[tuple[Slot, Block]] = []
    has_main, place, inner = False, 0, ""
    for part in layout(page):
        if isinstance(part, Token):
            has_main |= part.kind == "open" and part.name in MAIN and not part.excluded
            if part.name not in INLINE:
                if part.key in template.skeleton:
                    place, inner = place + 1, ""
                elif part.key in template.nested:
                    inner = part.key
            continue
        slot = slots.setdefault((place, inner, part.doubtful), Slot())
        slot.chars += part.chars
        slot.linked += part.linked
        blocks.append((slot, part))

    def eligible(slot: Slot, block: Block) -> bool:
        mostly_links = slot.linked * 2 > slot.chars
        if block.doubtful and (mostly_links or not (block.in_main or template.judged)):
            return False
        return block.in_main if has_main else not mostly_links

    kept = [block.text for slot, block in blocks if eligible(slot, block)]
    own = [text for text in kept if not template.common or digest(text) not in template.common]
    return "\n".join(own if own or not has_main else kept)


def _extract(batches: Iterable[pa.RecordBatch], general: list[tuple[str, bool, bool]], pages: int):
    parts: dict[tuple, Template] = {}

    def template(size: int | None, found: list[tuple[str, bool, bool]]) -> Template:
        skeleton = frozenset(t for t, once, _ in found if once and t.startswith("<"))
        nested = frozenset(t for t, once, _ in found if not once and t.startswith("<"))
        judged = (size or 0) >= TEXT_PAGES
        texts = frozenset(t for t, _, usual in found if usual and not t.startswith("<"))
        return Template(skeleton, nested, texts if judged else shared_texts, judged)

    shared_texts: frozenset[str] = frozenset()
    fallback = template(pages, general)
    shared_texts = fallback.common  # of hosts of few pages
    fallback.judged = False  # the pages of the host itself are too few
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            texts = []
            for page, size, found in zip(*(batch.column(c).to_pylist() for c in ("html", "size", "template"))):
                if found is None:
                    own = fallback
                else:
                    tokens_found = tuple((x["token"], x["once"], x["usual"]) for x in found)
                    key = size >= TEXT_PAGES, tokens_found
                    if (own := parts.get(key)) is None:
                        if len(parts) > 1000:
                            parts.clear()
                        own = parts[key] = template(size, list(tokens_found))
                texts.append(main_text(page, own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"]
            )


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``id, url, text`` of every row: blocks joined by a line feed, white space inside them single."""
    bounded_batches(pages.sparkSession)
    narrow = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"),
    )
    page = F.xxhash64("id", "url", "html").alias("page")
    own, general = templates(narrow.select(page, "host", "html"))
    first = general.first()  # of bounded size, like every template
    shared = [(x["token"], x["once"], x["usual"]) for x in first["template"]] if first else []
    size = first["size"] if first else 0
    joined = narrow.join(own, "host", "left").select("id", "url", "html", "size", "template")
    return joined.mapInArrow(lambda batches: _extract(batches, shared, size), "id long, url string, text string")
