"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides a block by its stop-word
density, length and link density, and by containers that never hold article text (menus,
headers, footers, sidebars, notices, adverts, forms, comments). Blocks too short or too mixed to
decide stay open; in the second pass an open block takes the label of the nearest decided
neighbours before and after it. A mark is a feature: blocks inside ``article`` or ``main`` stay open
at any stop-word density, and they and the others look for neighbours among their own; marks without any
decided block are kept whole if they hold no less text than is good outside. Text outside ``article`` is judged
as on a page without marks; only ``main``, of which a page shows one, excludes what is outside.

A class or id names such a container if each of its words does, or may stand beside one that does (``_BESIDE_NAME``):
``sidebar-left`` and ``post-comments``, but not ``has-sidebar``, ``notice-board`` or ``social-science``. Names and forms are
doubted: they say nothing of a container that holds most of the page's unlinked text together with its title or ``main``,
nor on a page that has no text outside of them.

Where no block of a page is long and dense enough to be decided, blocks of ``SHORT`` characters are decided by the highest
stop-word density the page offers; a page of shorter blocks alone has no text.

``STOP_WORDS`` are English, German, French and Spanish. Where no block of a page reaches ``STOP_HIGH``, they
say nothing about it (another language), and blocks of ``SHORT`` characters or more are text by length and link
density alone.

Character references are decoded, white space inside a block becomes one blank, and kept
blocks are joined by one line break in page order; nothing else is dropped or cut. Unclosed
comments, scripts, styles and titles reach to the end of the page. A null, empty or markup-only page
has an empty text, and an empty table gives no rows. Long pages are read in one pass over their tags. Repeated rows
give equal results; ties of distance go to the good neighbour; columns other than id, url and html are ignored,
whatever their names.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import map_slices

SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.15, 0.25
LINK_DENSITY = 0.33

STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he his i in is it not of on or that the their they this to was we "
    "were which who will with you "
    "als auch auf aus das dem den der des die ein eine einen er es für im ist mit nicht sich sie so und von wie zu zum "
    "au aux avec ce ces dans de des du elle en est et il la le les mais ne on ou par pas pour que qui sur un une "
    "al como con de del el en es las lo los más no para pero por que se su sus un una y".split())

_RAW = "script|style|textarea|iframe|title"  # to their end tag, or the end of the page
_OPAQUE = "noscript|template|svg|math|object|select"  # only with an end tag
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(?:svg|math)(?=[\s/])[^>]*/>"
    rf"|<({_OPAQUE})(?=[\s/>])[^>]*>.*?</\2\s*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[a-zA-Z/!?][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"(class|id|role|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frame frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
_CONTAINERS = _BREAKS - frozenset("p hr body html h1 h2 h3 h4 h5 h6".split())
_MARKS = {"article": 1, "main": 2}
_NEVER = frozenset("nav footer aside form menu dialog head button fieldset".split())
_NEVER_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_WITHOUT = frozenset("has hide no with without".split())  # before a name: about the page, not the container
_NEVER_NAME = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "hidden login menu modal nav navbar navigation newsletter notice pagination popup promo promotion related share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget".split())
# Words that may stand beside a name above; any other makes it the name of something else (a notice board, social science).
_BESIDE_NAME = frozenset(
    "a aside area article articles bar bars block body bottom box button buttons card cards class cloud col column columns container content "
    "count desktop drop dropdown element email fixed floating form global grid group head header holder horizontal icon icons id image "
    "img inner inline item items js label large layout left level link links list lists lower main media medium message mini mobile module "
    "more new off outer overlay page panel policy post posts primary reader readers region replies reply right row secondary section "
    "site slot small square stack sticky strip sub tab table tag tags text thread title toggle tools top unit upper user users vertical "
    "view views wide window wrap wrapper zone".split())


class Block:
    """Text of one block, how many of its characters are linked, and where it stands.

    ``article`` is as in ``_MARKS``. ``never`` says that a container around it holds no article text; ``doubted`` lists the
    containers that only a name or a form says so of.
    """

    __slots__ = ("text", "linked", "never", "article", "doubted", "title")

    def __init__(self, text: str, linked: int, never: bool, article: int, doubted: frozenset[int], title: bool):
        self.text, self.linked, self.never, self.article, self.doubted, self.title = text, linked, never, article, doubted, title


def _named(value: str) -> bool:
    """Whether a class or id names a container without article text; each name counts as a whole."""
    for part in value.lower().split():
        names = [n for n in re.split(r"[^a-z0-9]+", part) if n]
        known = [n in _NEVER_NAME for n in names]
        if not any(known) or not _WITHOUT.isdisjoint(names[:known.index(True)]):
            continue
        if all(k or n in _BESIDE_NAME or n.isdigit() for n, k in zip(names, known)):
            return True
    return False


def _never(tag: str, attrs: str, article: int) -> tuple[bool, bool]:
    """Whether a container holds no article text, and whether it may be so by its name or as a form."""
    sure, doubted = tag in _NEVER and tag != "form" or tag == "header" and not article, tag == "form"
    for name, *values in _ATTRIBUTE.findall(attrs):
        value, name = "".join(values), name.lower()
        if name == "style":
            sure = sure or _HIDDEN.search(value) is not None
        elif name == "role":
            sure = sure or value.strip().lower() in _NEVER_ROLE
        else:
            doubted = doubted or _named(value)
    return sure or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs) is not None, doubted


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order."""
    found: list[Block] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, int, frozenset[int]]] = []
    linked = at = places = 0
    in_link = own = title = False

    def flush() -> None:
        nonlocal linked, own, title
        text = " ".join("".join(parts).split())
        never, article, doubted = stack[-1][1:] if stack else (False, 0, frozenset())
        if text:
            found.append(Block(text, linked, never or own, article, doubted, title))
        parts.clear()
        linked, own, title = 0, False, False

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            parts.append(text)
            if in_link:
                linked += len(" ".join(text.split()))

    for token in _TOKEN.finditer(page):
        add(page[at:token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag == "a":
            in_link = not token["close"]
        elif tag == "br":
            parts.append(" ")
        elif tag in _BREAKS or tag == "button":
            flush()
            in_link = False
            never, article, doubted = stack[-1][1:] if stack else (False, 0, frozenset())
            if tag not in _CONTAINERS and tag != "button" or token["attrs"].rstrip().endswith("/"):
                own, title = not token["close"] and any(_never(tag, token["attrs"], article)), tag == "h1" and not token["close"]
            elif token["close"]:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == tag:
                        del stack[depth:]
                        break
            else:
                sure, doubt = _never(tag, token["attrs"], article)
                places += 1
                stack.append((tag, never or sure, max(article, _MARKS.get(tag, 0)), doubted | {places} if doubt else doubted))
    add(page[at:])
    flush()
    return found


def _wrappers(blocks: list[Block]) -> set[int]:
    """Doubted containers that are the page's frame: most of its unlinked text is inside, with its title or ``main``."""
    size = {i: 0 for b in blocks for i in b.doubted}
    framed = {i for b in blocks if b.title or b.article == 2 for i in b.doubted}
    total = 0
    for block in blocks:
        if not block.never:
            free = max(0, len(block.text) - block.linked)
            total += free
            for i in block.doubted:
                size[i] += free
    return {i for i in framed if 2 * size[i] > total}


def _stop_density(block: Block) -> float:
    words = re.findall(r"\w+", block.text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def _first_pass(blocks: list[Block], main: bool) -> list[bool | None]:
    """True: article text, False: not, None: open; ``main``: the page has text in ``main``."""
    out = [block.never or main and block.article < 2 or block.linked > LINK_DENSITY * len(block.text)
           or len(block.text) < LONG and "©" in block.text for block in blocks]
    stop = [0.0 if no or len(b.text) < SHORT else _stop_density(b) for b, no in zip(blocks, out)]
    foreign = max(stop, default=0.0) < STOP_HIGH
    labels: list[bool | None] = []
    for block, no, share in zip(blocks, out, stop):
        size = len(block.text)
        if no or size < SHORT:
            labels.append(False if no else None)
        elif foreign or size >= LONG and share >= STOP_HIGH:
            labels.append(True)
        else:
            labels.append(None if share >= STOP_LOW or block.article else False)
    if True not in labels:
        # A page of short paragraphs: those of the highest density there is stand for the long ones.
        for least in (STOP_HIGH, STOP_LOW):
            labels = [True if label is None and len(b.text) >= SHORT and share >= least else label for b, label, share in zip(blocks, labels, stop)]
            if True in labels:
                break
    return labels


def _second_pass(labels: list[bool | None], fallback: bool) -> list[bool]:
    """Open blocks take the label of their nearest decided neighbours; between two, the nearer, then the good one."""
    before, after = [], []
    for out, order in ((before, range(len(labels))), (after, range(len(labels) - 1, -1, -1))):
        label, gap = None, 0
        for i in order:
            label, gap = (labels[i], 0) if labels[i] is not None else (label, gap + 1)
            out.append((label, gap))
    after.reverse()
    final = []
    for own, (left, left_gap), (right, right_gap) in zip(labels, before, after):
        if own is not None:
            final.append(own)
        elif left is None or right is None:
            final.append(fallback if left is right else left if right is None else right)
        else:
            final.append(left if left == right or left_gap < right_gap else right if right_gap < left_gap else True)
    return final


def _kept(blocks: list[Block]) -> list[bool]:
    """Which blocks are article text."""
    main = any(b.article == 2 and not b.never for b in blocks)
    labels = _first_pass(blocks, main)
    inside = [b.article > 0 and not b.never and (b.article == 2 or not main) for b in blocks]
    marked = sum(len(b.text) for b, label, own in zip(blocks, labels, inside) if own and label is not False)
    good = sum(len(b.text) for b, label, own in zip(blocks, labels, inside) if label and not own)
    within = iter(_second_pass([x for x, own in zip(labels, inside) if own], fallback=marked >= good))
    beside = iter(_second_pass([x for x, own in zip(labels, inside) if not own], fallback=False))
    return [next(within if own else beside) for own in inside]


def main_text(page: str | None) -> str:
    """The article text of one page."""
    if not page:
        return ""
    blocks = blocks_of(page)
    sure, frame = [b.never for b in blocks], _wrappers(blocks)
    keep: list[bool] = []
    for doubts in (True, False):
        for block, never in zip(blocks, sure):
            block.never = never or doubts and not block.doubted <= frame
        keep = _kept(blocks)
        if any(keep):
            break
    return "\n".join(b.text for b, kept in zip(blocks, keep) if kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and its length in code points for every page."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_pydict({
            "page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64())})
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return map_slices(rows, work, "page_id bigint, url string, text string, n_chars bigint", "html")
