"""Main text of web pages by wrapper induction over pages of one host.

Every page is parsed to a DOM tree. A tree's skeleton keeps its elements (tag and class words) with runs of
alike siblings folded into one. The skeletons of a host are aligned with the host's reference skeleton,
the one most of its distinct pages have (ties: the smallest), by simple tree matching: the largest
number of node pairs that keep parents and order. Aligned text slots are compared over all pages of the host
with different content (copies, and near copies with the same longest slot, count once): where a slot holds the same
text on at least `constant` of its pages (and on `min_pages` of them), that text is template in it; all else is content.

A page's main text is that of its varying slots, without elements that are never article text: head, nav,
footers, asides, forms, scripts, styles and the like, headers outside an article, and elements whose class, id or
role names a menu, sidebar, notice, advert, share bar or comments. Class and id do not count on html, body, main and
article, nor on an element that holds nearly all text of the page. Where the page marks its article
(article, main or role=main) outside such elements, only slots inside it count. Pages whose host shows no template use the element
rules alone.

Text inside a block is one line with single spaces, trimmed; blocks follow each other by one line feed.

Nulls: a null or empty page gives the empty text; a null url, or one without host, is a host of its own ("").
Rows that repeat a page count once for the induction and are extracted each. Very long pages are parsed
whole; blocks nested deeper than DEPTH stand in the tree at that depth. Columns of pages besides page_id, url and html are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codesieve.llm.common import stored, whole

CONSTANT, MIN_PAGES = 0.8, 5
DEPTH = 64
# HTML element names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = "script|style|textarea|title|xmp|noscript|template|iframe"
NEVER = set("head nav footer aside form script style textarea title xmp noscript template iframe menu dialog button select option input svg canvas object embed audio video figure-ad".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# Words in class and id that name what is no article text.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|alerts?|"
    r"popup|modal|overlay|menu|nav|navbar|navigation|breadcrumbs?|sidebar|side-bar|widgets?|related|recommend(?:ed|ations)?|share|sharing|social|"
    r"newsletter|subscribe|signup|login|search|footer|masthead|site-header|page-header|comments?|commentlist|disqus|replies|respond)(?:$|[\s_-])",
    re.I,
)
_ATTRS = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<raw>{RAW})(?=[\s/>]){_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attr>{_ATTRS})>|<(?P<close2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<attr2>[^>]*)>",
    re.S | re.I,
)
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PLAIN = re.compile(r"[A-Za-z_-]+")
CLOSES = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
CLOSED_BY = {t: [o for o in CLOSES if t in CLOSES[o]] for t in set().union(*CLOSES.values())}
WHOLE = {"html", "body", "main", "article"}  # their class names tell of the page's state or kind, not of noise
OUTSIDE = 0.1
SCOPE = set("article aside body div footer form header li main nav ol section table td th ul".split())


@lru_cache(maxsize=4096)
def _names(attr: str) -> tuple[str, bool, bool, bool]:
    """(class words for the skeleton, class or id names noise, role names noise, marks the main part)."""
    found = {k.lower(): (a or b or c).lower() for k, a, b, c in ATTR.findall(attr)}
    words = f"{found.get('class', '')} {found.get('id', '')}"
    shown = ".".join(sorted(w for w in found.get("class", "").split() if PLAIN.fullmatch(w)))
    role = found.get("role", "")
    return shown, bool(NOISE.search(words)), role in ROLES, role in ("main", "article")


class Page:
    """One pass over the page: blocks of text with the element path (skeleton label per open element) they stand in."""

    def __init__(self, source: str):
        # path, text, never article text, inside the article, outermost element that only its class or id calls noise (0: none)
        self.blocks: list[tuple[tuple[str, ...], str, bool, bool, int]] = []
        stack: list[tuple[str, str, bool, bool, int]] = []  # tag, label, noise, article, named
        n_named = 0
        text: list[str] = []
        end = 0
        for m in TOKEN.finditer(source):
            if m.start() > end:
                text.append(source[end : m.start()])
            end = m.end()
            tag = (m["tag"] or m["tag2"] or "").lower()
            if not tag:
                continue
            if m["close"] or m["close2"]:
                self._close(tag, stack, text)
                continue
            if tag in BLOCKS or tag == "br":
                self._flush(stack, text, keep=tag == "br")
            if tag in VOID or tag == "br":
                continue
            for open_tag in CLOSED_BY.get(tag, ()):
                self._end_open(open_tag, stack)
            attr = m["attr"] or m["attr2"]
            shown, named, noise, main = _names(attr) if attr else ("", False, False, False)
            article = (stack[-1][3] if stack else False) or tag in ("article", "main") or main
            noise |= (stack[-1][2] if stack else False) or tag in NEVER or (tag == "header" and not article)
            place = stack[-1][4] if stack else 0
            if named and not place and not main and tag not in WHOLE:
                place = n_named = n_named + 1
            stack.append((tag, f"{tag}.{shown}" if shown else tag, noise, article, place))
        if end < len(source) and not source[end:].startswith("<"):
            text.append(source[end:])
        self._flush(stack, text)

    def content(self) -> list[tuple[tuple[str, ...], str]]:
        """(path, text) of the blocks that may be article text by the element rules.

        An element that only its class or id calls noise is kept if it holds the page's text: if what stands outside all
        such elements is less than OUTSIDE of its own.
        """
        rest = [b for b in self.blocks if not b[2]]
        sizes: dict[int, int] = {}
        for _, line, _, _, place in rest:
            sizes[place] = sizes.get(place, 0) + len(line)
        kept = {place for place, n in sizes.items() if not place or sizes.get(0, 0) < OUTSIDE * n}
        rest = [b for b in rest if b[4] in kept]
        has_article = any(b[3] for b in rest)
        return [(path, line) for path, line, _, article, _ in rest if article or not has_article]

    def _end_open(self, tag: str, stack: list) -> None:
        """An open element that the next one closes without an end tag, if no other container is between."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if stack[i][0] in SCOPE:
                return

    def _close(self, tag: str, stack: list, text: list[str]) -> None:
        if tag in BLOCKS:
            self._flush(stack, text)
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if stack[i][0] in SCOPE and tag not in SCOPE:
                return

    def _flush(self, stack: list, text: list[str], keep: bool = False) -> None:
        if keep:
            text.append(" ")
            return
        line = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if line:
            # Inline elements are not part of a block's place.
            path = tuple(islice((label for tag, label, *_ in stack if tag in BLOCKS), DEPTH))
            noise, article, place = stack[-1][2:] if stack else (False, False, 0)
            self.blocks.append((path, line, noise, article, place))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def skeleton(paths: Iterable[tuple[str, ...]]) -> str:
    """The folded tree of the paths in page order, as nested brackets."""
    return _write(_tree(paths))


def _tree(paths: Iterable[tuple[str, ...]]) -> list:
    """[label, children]; a path joins the latest child with its label, so runs of alike siblings fold into one."""
    root: list = ["", []]
    for path in paths:
        node = root
        for label in path:
            same = next((c for c in node[1] if c[0] == label), None)
            if same is None:
                same = [label, []]
                node[1].append(same)
            node = same
    return root


def _write(node: list) -> str:
    return f"{node[0]}({','.join(map(_write, node[1]))})" if node[1] else node[0]


def _read(text: str) -> list:
    root: list = ["", []]
    stack, label = [root], ""
    for c in text[1:-1] if text.startswith("(") else text:
        if c in "(,)":
            if label:
                stack[-1][1].append([label, []])
                label = ""
            if c == "(":
                stack.append(stack[-1][1][-1])
            elif c == ")":
                stack.pop()
        else:
            label += c
    if label:
        stack[-1][1].append([label, []])
    return root


def tree_match(a: list, b: list) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching: (size, pairs of children) of the best ordered matching of two trees with equal roots."""
    if a[0] != b[0]:
        return 0, []
    n, m = len(a[1]), len(b[1])
    best = [[0] * (m + 1) for _ in range(n + 1)]
    sub = [[tree_match(x, y) for y in b[1]] for x in a[1]]
    for i in range(n):
        for j in range(m):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + sub[i][j][0])
    pairs, i, j = [], n, m
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs = [(a[1][i], b[1][j]), *sub[i][j][1], *pairs]
    return best[n][m] + 1, pairs


@lru_cache(maxsize=20_000)
def aligned(own: str, reference: str) -> dict[tuple[str, ...], tuple[str, ...]]:
    """Path in the own skeleton to the path of its aligned node in the reference skeleton."""
    a, b = _read(own), _read(reference)
    _, pairs = tree_match(a, b)
    partner = {id(x): id(y) for x, y in pairs}
    names = dict(_paths(b))
    return {path: names[partner[i]] for i, path in _paths(a) if i in partner}


def _paths(node: list, path: tuple[str, ...] = ()) -> Iterator[tuple[int, tuple[str, ...]]]:
    for child in node[1]:
        yield id(child), (*path, child[0])
        yield from _paths(child, (*path, child[0]))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(whole(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def slots(pages: DataFrame) -> DataFrame:
    """(host, skeleton, page, near, slots): per text slot a hash of its texts; page and near are hashes of the content and its longest slot."""

    @F.pandas_udf("skeleton string, page long, near long, slots array<struct<slot: string, text: long>>")
    def read(pages: pd.Series) -> pd.DataFrame:
        out = []
        for source in pages:
            page = Page(source or "")
            texts: dict[str, list[str]] = {}
            for path, line in page.content():
                texts.setdefault(">".join(path), []).append(line)
            joined = {s: "\n".join(t) for s, t in texts.items()}
            longest = max(joined.values(), key=lambda t: (len(t), t), default="")
            found = [{"slot": s, "text": _hash(t)} for s, t in joined.items()]
            whole_page = _hash("\n".join(line for _, line in page.content()))
            out.append((skeleton(path for path, _ in page.content()), whole_page, _hash(longest), found))
        return pd.DataFrame(out, columns=["skeleton", "page", "near", "slots"])

    return pages.where("length(html) > 0").select(host(F.col("url")).alias("host"), read("html").alias("r")).select("host", "r.*")


def wrappers(pages: DataFrame, constant: float = CONSTANT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, reference, template): the reference skeleton, and the paths in it with the hash of their constant text (`place`)."""
    once = slots(pages).groupBy("host", "near").agg(F.min_by(F.struct("skeleton", "slots"), F.struct("page", "skeleton")).alias("r"))
    read = stored(once.select("host", "r.*"))
    shapes = read.groupBy("host", "skeleton").agg(F.count("*").alias("n"))
    reference = shapes.groupBy("host").agg(F.min_by("skeleton", F.struct(-F.col("n"), F.col("skeleton"))).alias("reference"))

    @F.pandas_udf("map<string, string>")
    def align(own: pd.Series, reference: pd.Series) -> pd.Series:
        return pd.Series([{">".join(a): ">".join(b) for a, b in aligned(x, y).items()} for x, y in zip(own, reference, strict=True)], dtype=object)

    places = shapes.join(reference, "host").select("host", "skeleton", align("skeleton", "reference").alias("places"))
    each = read.join(places, ["host", "skeleton"]).select("host", "places", F.explode("slots").alias("s"))
    each = each.select("host", F.element_at("places", F.col("s.slot")).alias("slot"), F.col("s.text").alias("text")).where("slot is not null")
    counts = each.groupBy("host", "slot", "text").agg(F.count("*").alias("n"))
    totals = counts.groupBy("host", "slot").agg(F.sum("n").alias("total"), F.max("n").alias("most"), F.max_by("text", "n").alias("text"))
    fixed = totals.where((F.col("most") >= min_pages) & (F.col("most") >= constant * F.col("total")))
    template = fixed.groupBy("host").agg(F.collect_set(F.concat_ws("=", "slot", "text")).alias("template"))
    return reference.join(template, "host", "left").select("host", "reference", F.coalesce("template", F.array().cast("array<string>")).alias("template"))


def main_text(source: str | None, reference: str | None, template: Iterable[str]) -> str:
    """The page's content by its host's wrapper."""
    content = Page(source or "").content()
    fixed = set(template)
    places = aligned(skeleton(path for path, _ in content), reference) if fixed and reference else {}
    texts: dict[tuple[str, ...], list[str]] = {}
    for path, line in content if places else ():
        texts.setdefault(path, []).append(line)
    gone = {path for path, lines in texts.items() if path in places and place(places[path], lines) in fixed}
    return "\n".join(line for path, line in content if path not in gone)


def place(path: tuple[str, ...], lines: list[str]) -> str:
    return f"{'>'.join(path)}={_hash(chr(10).join(lines))}"


def extract(pages: DataFrame, constant: float = CONSTANT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text) of every page."""
    pages = pages.select("page_id", "url", "html")
    # One small row per host, written so that Spark sees its size: it is broadcast if that is small and else
    # joined by a shuffle in which a host with many pages is split.
    known = stored(wrappers(pages, constant, min_pages)).select(F.col("host").alias("_host"), "reference", "template")

    @F.pandas_udf("string")
    def text(pages: pd.Series, references: pd.Series, templates: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, r, [] if t is None else t) for p, r, t in zip(pages, references, templates, strict=True)], dtype=object)

    joined = pages.join(known, host(F.col("url")) == F.col("_host"), "left")
    return joined.select("page_id", "url", text("html", "reference", "template").alias("text"))
