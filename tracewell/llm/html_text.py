"""Main text of HTML pages: flat text blocks, judged by a decision tree.

A page is read once, tag by tag, into a flat list of blocks in page order.  A block has its words, its link density
(share of its words that are link text), what it stands in, and the same words and densities of the blocks beside it.
A small decision tree, trained on the labelled blocks below, says which blocks are main text.

Reading is forgiving: unclosed and crossing tags, `<` in text, unterminated comments and character references without a
semicolon are read as a browser would read them, near enough.  Script, style, form controls and other unseen content
never becomes text.  White space inside a block, `<br>` included, becomes one space.

Defined cases: null html is the empty page, whose text is empty, and so is a page without main text.  Repeated rows
are read each by itself; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tracewell.llm import common
from tracewell.llm.registry import query

# A comment, declaration or instruction; or a tag, whose quoted attribute values may hold `>`.
TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"))
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE) for name in RAW}
UNSEEN = frozenset("head noscript template svg math object canvas select option button video audio map dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
MAIN = frozenset(("article", "main"))
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template noframes".split())  # all else ends a head
ASIDE = frozenset(("nav", "aside", "footer", "menu"))
FORMS = frozenset(("form", "fieldset"))
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar toolbar".split())
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
ASIDE_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright"
    " disqus footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination popup"
    " promo promoted related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar"
    " widget widgets".split()
)
# What may follow such a word in a name without changing its sense (`ad-container`, not `ad-free`), and what turns it round.
NEUTRAL = frozenset(
    "area bar block body bottom box col column container content group header holder icons inner item items large left link links list main menu"
    " message module outer panel popup primary region right row secondary section slot small tag title top unit wrap wrapper zone".split()
)
TURNING = frozenset("has no not non with without hide hides is".split())

LONG_BLOCK = 15  # words of a block that is no label of a form
# Whether an element stands aside: a form; by a name that a wrapper may have too; as comments or by its role; in any case.
NO, FORM, NAMED, REMARKS, ALWAYS = range(5)


@dataclass(slots=True)
class Block:
    text: str
    words: int = 0
    linked: int = 0
    aside: bool = False
    inside: bool = False
    heading: bool = False
    wraps: tuple[tuple[int, int, int], ...] = ()  # number, kind, and articles round it, of each form or named element round the block
    articles: int = 0
    article: int = 0

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _stands_aside(name: str, attributes: str) -> int:
    """Whether an element names itself as something beside the main text."""
    if name in ASIDE:
        return ALWAYS
    kind = FORM if name in FORMS else NO
    if name in ("html", "body") or name in MAIN or "=" not in attributes and "hidden" not in attributes:
        return kind
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id"):
            kind = max([kind, *map(_named, value.split())])
        if key == "role" and value.strip() == "form":
            kind = max(kind, FORM)
        if key == "role" and value.strip() in ASIDE_ROLES:
            kind = REMARKS
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return ALWAYS
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return ALWAYS
    return kind


def _named(name: str) -> int:
    """What one class or id says: a word of the list, and behind it only such as leave its sense."""
    parts = [x for x in re.split(r"[^a-z0-9]+", name) if x]
    at = max((i for i, x in enumerate(parts) if x in ASIDE_NAMES), default=None)
    if at is None or not TURNING.isdisjoint(parts) or not all(x in NEUTRAL or x.isdigit() for x in parts[at + 1 :]):
        return NO
    return NAMED if COMMENTS.isdisjoint(parts) else REMARKS


def _place(found: list[Block], holding: set[int]) -> None:
    """Say which blocks in forms and named elements stand aside.

    A form does not count if it holds an article (`holding`), or more words in long blocks than there are outside it.  Named
    elements do not count if they hold the article: one with more words than what stands free of such elements.  On a page
    without an article that stands free, they do not count if they hold more than half of the words in long blocks, and
    if no long block is free then, the one with the most such words does not count either, whatever it calls itself: what
    holds the page's text is a wrapper.
    """

    open_ = {0, *holding}  # none has the number 0
    held: dict[int, int] = {}
    text: dict[int, int] = {}
    total = 0
    for b in found:
        if b.aside or any(kind != FORM for _, kind, _ in b.wraps):
            continue
        total += b.words - b.linked
        for n, _, _ in b.wraps:
            held[n] = held.get(n, 0) + b.words - b.linked
            if b.words >= LONG_BLOCK and b.density < 0.5:
                text[n] = text.get(n, 0) + b.words - b.linked
    open_.update(n for n, words in text.items() if words > total - held[n])
    while open_:
        for b in found:
            b.wraps = tuple(x for x in b.wraps if x[0] not in open_)
        size: dict[int, int] = {}
        around: dict[int, set[int]] = {}
        for b in found:
            if b.wraps and not b.aside and all(at < b.articles and kind != REMARKS for _, kind, at in b.wraps):
                size[b.article] = size.get(b.article, 0) + b.words - b.linked
                around[b.article] = {n for n, _, _ in b.wraps}
        largest = max(size, key=size.__getitem__, default=0)
        elsewhere = sum(b.words - b.linked for b in found if not b.aside and not b.wraps)
        open_ = around[largest] if size and size[largest] > elsewhere else set()
    long = [b for b in found if not b.aside and b.words >= LONG_BLOCK and b.density < 0.5]
    if not any(b.inside and not b.wraps for b in long):
        named = {n for b in long for n, kind, _ in b.wraps if kind != REMARKS}
        half = sum(b.words - b.linked for b in long) / 2
        _open(found, {n for n in named if _inside(long, n) > half})
        while long and all(b.wraps for b in long):
            _open(found, {max((n for b in long for n, _, _ in b.wraps), key=lambda n: (_inside(long, n), -n))})
    for b in found:
        b.aside = b.aside or bool(b.wraps)


def _inside(found: list[Block], number: int) -> int:
    return sum(b.words - b.linked for b in found if any(n == number for n, _, _ in b.wraps))


def _open(found: list[Block], numbers: set[int]) -> None:
    for b in found:
        b.wraps = tuple(x for x in b.wraps if x[0] not in numbers)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, bool]] = []  # name, stands aside, main, a header
    wraps: list[tuple[int, int, int]] = []
    articles: list[int] = []
    holding: set[int] = set()  # forms with an article
    aside = header = links = unseen = number = 0
    heading = 0
    plain: list[str] = []
    linked: list[str] = []

    def close_block() -> None:
        if not plain:
            return
        words = "".join(plain).split()
        if words:
            beside = aside > 0 or (header > 0 and not (articles and heading))
            around = tuple(wraps), len(articles), articles[-1] if articles else 0
            out.append(Block(" ".join(words), len(words), len(" ".join(linked).split()), beside, bool(articles), heading > 0, *around))
        plain.clear()
        linked.clear()

    def add(text: str) -> None:
        if stack and stack[-1][0] == "head" and text and not text.isspace():
            leave()
        if unseen or not text:
            return
        text = references.unescape(text) if "&" in text else text
        plain.append(text)
        if links:
            linked.append(text)

    def leave() -> None:
        nonlocal aside, header, links, unseen, heading
        name, was_aside, was_main, was_header = stack.pop()
        aside -= was_aside == ALWAYS
        if was_aside in (FORM, NAMED, REMARKS):
            wraps.pop()
        if was_main:
            articles.pop()
        header -= was_header
        links -= name == "a"
        unseen -= name in UNSEEN
        heading -= name in HEADINGS

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in RAW:
            if not m[1]:
                stop = RAW_END[name].search(page, at)
                at = stop.end() if stop else end
            continue
        if name == "br":
            add(" ")
            continue
        if name in BLOCKS:
            close_block()
        if name in VOID:
            continue
        if m[1]:
            if any(x[0] == name for x in stack):
                while stack[-1][0] != name:
                    leave()
                leave()
            continue
        if stack and (name == "body" or (stack[-1][0] == "head" and name not in HEAD)) and any(x[0] == "head" for x in stack):
            while stack[-1][0] != "head":
                leave()
            leave()
        if name == "p" or name in HEADINGS or name == "li":  # such a tag ends what cannot hold it
            ends = HEADINGS | {"p", "a", "b", "i", "em", "strong", "u", "span", "font", "small"} | ({"li"} if name == "li" else set())
            k = len(stack)
            while k and stack[k - 1][0] in ends:
                k -= 1
            if any(x[0] in ends - {"a", "b", "i", "em", "strong", "u", "span", "font", "small"} for x in stack[k:]):
                while len(stack) > k:
                    leave()
        attributes = m[3] or ""
        if attributes.rstrip(">").endswith("/") and name not in BLOCKS:
            continue
        own = (name, _stands_aside(name, attributes), name in MAIN, name == "header")
        stack.append(own)
        number += 1
        aside += own[1] == ALWAYS
        if own[1] in (FORM, NAMED, REMARKS):
            wraps.append((number, own[1], len(articles)))
        if own[2]:
            articles.append(number)
            holding.update(n for n, kind, _ in wraps if kind == FORM)
        header += own[3]
        links += name == "a"
        unseen += name in UNSEEN
        heading += name in HEADINGS
    close_block()
    _place(out, holding)
    return out


NAMED_ASIDE, BESIDE, PAGE, INSIDE = range(4)  # in something beside the text; outside the article; page without one; in it
FEATURES = ("place", "heading", "words", "density", "words_before", "density_before", "words_after", "density_after")


def features(found: Sequence[Block]) -> list[tuple[float, ...]]:
    has_main = any(b.inside for b in found)
    edge = Block("")
    out = []
    for i, b in enumerate(found):
        before, after = found[i - 1] if i else edge, found[i + 1] if i + 1 < len(found) else edge
        place = NAMED_ASIDE if b.aside else INSIDE if b.inside else BESIDE if has_main else PAGE
        out.append((place, int(b.heading), b.words, b.density, before.words, before.density, after.words, after.density))
    return out


# Labelled blocks: the features in their order, and whether the block is main text.
LABELLED = (
    # in the article
    ((3, 1, 6, 0, 9, 0, 40, 0), 1), ((3, 1, 4, 0, 1, 1, 30, 0), 1), ((3, 0, 60, 0, 6, 0, 80, 0), 1),
    ((3, 0, 1, 0, 60, 0, 70, 0), 1), ((3, 0, 3, 0, 40, 0, 8, 0), 1), ((3, 0, 45, 0.1, 30, 0, 50, 0.05), 1),
    ((3, 0, 120, 0, 90, 0, 12, 0), 1), ((3, 0, 12, 0.3, 50, 0, 60, 0), 1), ((3, 0, 9, 0, 30, 0, 1, 1), 1),
    ((3, 0, 2, 0, 2, 0, 2, 0), 1), ((3, 0, 5, 0.9, 60, 0, 40, 0), 1), ((3, 0, 30, 0.5, 60, 0, 70, 0), 1),
    ((3, 0, 7, 0, 1, 1, 1, 1), 1), ((3, 0, 70, 0, 0, 0, 0, 0), 1),
    ((3, 0, 3, 0, 40, 0, 2, 1), 1), ((3, 0, 2, 0, 30, 0, 1, 1), 1), ((3, 0, 5, 0, 4, 0, 3, 1), 1), ((3, 0, 4, 1, 50, 0, 60, 0), 1),
    # lists of links in the article, paragraphs that are a link
    ((3, 0, 3, 1, 3, 1, 40, 0), 1), ((3, 0, 4, 1, 2, 1, 9, 0), 1), ((3, 0, 2, 1, 3, 1, 60, 0), 1),
    ((3, 0, 3, 1, 2, 1, 3, 1), 1), ((3, 0, 5, 1, 4, 1, 2, 1), 1), ((3, 0, 2, 1, 2, 1, 1, 1), 1), ((3, 0, 20, 1, 25, 1, 0, 0), 1),
    # beside the article
    ((1, 0, 8, 0, 1, 1, 6, 0), 0), ((1, 0, 30, 0, 50, 0, 0, 0), 0), ((1, 0, 60, 0, 1, 1, 7, 0), 0),
    ((1, 1, 4, 0, 3, 1, 8, 0), 0), ((1, 0, 2, 1, 2, 1, 2, 1), 0), ((1, 0, 15, 0.2, 40, 0, 12, 0), 0),
    # in something that names itself as no main text
    ((0, 0, 1, 1, 0, 0, 1, 1), 0), ((0, 0, 12, 0, 1, 1, 6, 0), 0), ((0, 0, 70, 0, 60, 0, 20, 0), 0),
    ((0, 0, 40, 0, 60, 0, 70, 0), 0), ((0, 1, 2, 0, 60, 0, 30, 0), 0), ((0, 0, 50, 0, 60, 0, 0, 0), 0),
    ((0, 0, 2, 1, 2, 1, 2, 1), 0), ((0, 0, 8, 0, 30, 0, 9, 0), 0), ((0, 1, 5, 0, 4, 0, 60, 0), 0),
    ((0, 0, 9, 0, 40, 0, 30, 0), 0), ((0, 0, 3, 0.5, 20, 0, 25, 0), 0),
    # pages without an article
    ((2, 0, 2, 1, 2, 1, 50, 0), 0), ((2, 0, 3, 1, 1, 1, 12, 0), 0), ((2, 0, 2, 1, 0, 0, 30, 0), 0), ((2, 1, 5, 0, 1, 1, 30, 0), 1),
    ((2, 0, 1, 1, 2, 1, 6, 0), 0), ((2, 0, 2, 1, 2, 0, 40, 0), 0), ((2, 0, 40, 0, 2, 1, 50, 0), 1), ((2, 0, 80, 0, 1, 1, 60, 0), 1),
    ((2, 0, 25, 0, 3, 1, 30, 0), 1),
    ((2, 1, 6, 0, 2, 1, 60, 0), 1), ((2, 0, 60, 0, 6, 0, 50, 0), 1), ((2, 0, 30, 0, 60, 0, 45, 0), 1),
    ((2, 0, 25, 0.1, 40, 0, 30, 0.1), 1), ((2, 0, 80, 0, 0, 0, 0, 0), 1), ((2, 0, 8, 0, 60, 0, 50, 0), 1),
    ((2, 0, 4, 0, 50, 0, 40, 0), 1), ((2, 0, 18, 0, 20, 0, 22, 0), 1), ((2, 0, 35, 0, 70, 0, 3, 1), 1),
    ((2, 0, 14, 0, 0, 0, 0, 0), 1), ((2, 0, 6, 0, 0, 0, 0, 0), 1), ((2, 0, 12, 0, 9, 0, 7, 0), 1),
    ((2, 0, 2, 1, 3, 1, 2, 1), 0), ((2, 0, 1, 1, 0, 0, 1, 1), 0), ((2, 0, 12, 0.9, 20, 0, 5, 1), 0),
    ((2, 0, 40, 0.8, 60, 0, 30, 0.7), 0), ((2, 0, 4, 0, 2, 1, 2, 1), 0), ((2, 0, 5, 0, 3, 1, 1, 1), 0),
    ((2, 0, 6, 0.7, 30, 0, 4, 1), 0), ((2, 0, 3, 0, 1, 1, 4, 1), 0),
)


def train(rows: Sequence[tuple[Sequence[float], int]] = LABELLED, depth: int = 6):
    """A decision tree by least Gini impurity: a label, or (feature, limit, tree up to the limit, tree above it)."""
    labels = [y for _, y in rows]
    ones = sum(labels)
    if depth == 0 or ones in (0, len(rows)):
        return int(2 * ones > len(rows))

    def impurity(ys: list[int]) -> float:
        return len(ys) * (1 - (sum(ys) / len(ys)) ** 2 - (1 - sum(ys) / len(ys)) ** 2)

    best = None
    for f in range(len(rows[0][0])):
        values = sorted({x[f] for x, _ in rows})
        for low, high in zip(values, values[1:]):
            limit = (low + high) / 2
            left, right = [y for x, y in rows if x[f] <= limit], [y for x, y in rows if x[f] > limit]
            score = impurity(left) + impurity(right)
            if best is None or score < best[0] - 1e-9:
                best = (score, f, limit)
    if best is None:
        return int(2 * ones > len(rows))
    _, f, limit = best
    return f, limit, train([r for r in rows if r[0][f] <= limit], depth - 1), train([r for r in rows if r[0][f] > limit], depth - 1)


def judge(tree, row: Sequence[float]) -> bool:
    while isinstance(tree, tuple):
        f, limit, low, high = tree
        tree = low if row[f] <= limit else high
    return bool(tree)


def main_text(page: str, tree) -> tuple[str, int, int]:
    """The main text, the number of blocks, and how many of them are main text."""
    found = blocks(page)
    kept = [b.text for b, row in zip(found, features(found), strict=True) if judge(tree, row)]
    return "\n".join(kept), len(found), len(kept)


def extract(pages: DataFrame, key: Sequence[str] = ("page_id", "url"), html: str = "html", tree=None) -> DataFrame:
    """key columns, text, n_chars, n_blocks, n_kept."""
    tree = train() if tree is None else tree
    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.pieces_of(whole, html):
                made = [main_text(page or "", tree) for page in batch.column(html).to_pylist()]
                text, n, kept = zip(*made, strict=True)
                chars = [len(t) for t in text]
                columns = [pa.array(text, pa.string()), *(pa.array(x, pa.int64()) for x in (chars, n, kept))]
                yield pa.record_batch([*(batch.column(k) for k in key), *columns], [*key, "text", "n_chars", "n_blocks", "n_kept"])

    return pages.select(*key, html).mapInArrow(run, f"{kinds}, text string, n_chars long, n_blocks long, n_kept long")


@query("op6_html_text")
def op6_html_text(spark, folder):
    return extract(common.read(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")
