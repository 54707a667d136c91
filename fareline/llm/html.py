"""Main text of web pages by two passes over their blocks.

The page is cut into blocks at block-level tags. What stands in a menu, header, footer, sidebar,
notice, advert, form or comment container is never text. The first pass judges the other blocks by
link density, length and the density of stop words: good, bad, or ambiguous (short, or undecided).
In the second pass an ambiguous block takes the label of its nearest decided neighbours in its
region; where they differ, the nearer one, at equal distance the good one. A region is the article
(or main) element, if the page has one, or else the body. In an article, which the author has marked
as text, lists of links are left out but do not spoil their neighbours.
"""

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import arrow_map

# Frequent function words of the page languages.
STOP_WORDS = frozenset(
    "the of and to in a is that it for on was with as be by at this are or from an not have has he his they you we which but "
    "der die das und in den von zu mit ist im für auf des dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer "
    "le la les de des et un une du en que qui est dans pour par sur pas au plus avec ce il ne se sont ou son "
    "el los las y del se por con no su para al lo como más o pero sus este ha si porque esta son entre".split()
)

SKIP_TAGS = frozenset("nav header footer aside form script style noscript template iframe object svg math button select textarea head title dialog menu figure datalist canvas audio video".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SKIP_MARKS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login comment comments respond discussion disqus share sharing social related recommended pagination pager widget toolbar".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/]|$)", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_MARK = re.compile(r"[a-z]+")

MAX_LINK_DENSITY = 0.4
SHORT_CHARS = 70
GOOD_STOP_DENSITY = 0.25
BAD_STOP_DENSITY = 0.08


class Block:
    __slots__ = ("parts", "links", "region", "good")

    def __init__(self, region: int):
        self.parts, self.links, self.region, self.good = [], [], region, None

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _skipped(tag: str, attrs: str) -> bool:
    if tag in SKIP_TAGS:
        return True
    if tag in ("html", "body", "article", "main") or not attrs:
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in SKIP_ROLES or name in ("class", "id") and not SKIP_MARKS.isdisjoint(_MARK.findall(value)):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """Blocks outside skipped containers, in page order. region: 0 outside, n in the n-th article."""
    out, cur = [], None
    stack: list[tuple[str, bool, int]] = []
    skip = links = region = regions = at = 0

    def put(text: str) -> None:
        nonlocal cur
        if text and not skip:
            if cur is None:
                cur = Block(region)
            cur.parts.append(text)
            if links:
                cur.links.append(text)

    def end_block() -> None:
        nonlocal cur
        if cur is not None:
            out.append(cur)
            cur = None

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            put(rest[: re.search(r"<[a-zA-Z/!][^>]*\Z|\Z", rest).start()])
            break
        put(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCK_TAGS:
            end_block()
        if m[1]:
            if any(t == tag for t, _, _ in stack):
                while stack:
                    t, skipped, was = stack.pop()
                    skip -= skipped
                    links -= t == "a"
                    region = was
                    if t == tag:
                        break
            continue
        attrs = m[3] or ""
        if tag in RAW_TAGS:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag in VOID_TAGS or attrs.endswith("/"):
            continue
        if tag == "p":
            while stack and stack[-1][0] in ("p", "b", "i", "em", "strong", "span", "u", "a", "font", "small") and any(t == "p" for t, _, _ in stack):
                t, skipped, was = stack.pop()
                skip -= skipped
                links -= t == "a"
                region = was
        hidden = _skipped(tag, attrs)
        stack.append((tag, hidden, region))
        skip += hidden
        links += tag == "a"
        if tag in ("article", "main"):
            end_block()
            if not region:
                regions += 1
                region = regions
    end_block()
    return out


def first_pass(block: Block, text: str) -> bool | None:
    """True, False, or None where the block alone does not tell."""
    linked = len(" ".join(html.unescape("".join(block.links)).split()))
    if linked > MAX_LINK_DENSITY * len(text):
        return False
    if len(text) < SHORT_CHARS:
        return None
    words = _WORD.findall(text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= GOOD_STOP_DENSITY:
        return True
    return False if density < BAD_STOP_DENSITY and not block.region else None


def second_pass(labels: list[bool | None], in_article: bool) -> list[bool]:
    """Ambiguous blocks of one region take the label of the nearest decided neighbour."""
    n, before, after = len(labels), [], []
    last = None
    for i, x in enumerate(labels):
        last = (i, x) if x or x is False and not in_article else last
        before.append(last)
    last = None
    for i in range(n - 1, -1, -1):
        last = (i, labels[i]) if labels[i] or labels[i] is False and not in_article else last
        after.append(last)
    after.reverse()
    out = []
    for i, x in enumerate(labels):
        if x is None:
            near = [(abs(i - p[0]), not p[1], p[1]) for p in (before[i], after[i]) if p]
            x = min(near)[2] if near else in_article
        out.append(x)
    return out


def main_text(page: str | None) -> str:
    """Main text; blocks joined by a space, white space inside a block made one space."""
    if not page:
        return ""
    found = [(b, t) for b in blocks(page) if (t := b.text())]
    if any(b.region for b, _ in found):
        found = [(b, t) for b, t in found if b.region]
    labels: dict[int, list] = {}
    for b, t in found:
        labels.setdefault(b.region, []).append(first_pass(b, t))
    final = {r: iter(second_pass(x, r > 0)) for r, x in labels.items()}
    return " ".join(t for b, t in found if next(final[b.region]))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of `pages`; null or empty html gives an empty text.
    Broken markup is read as far as it goes; an unfinished tag or comment at the end is dropped."""

    def run(batch):
        texts = [main_text(x) for x in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return arrow_map(src, run, "page_id long, url string, text string, n_chars long")
