"""Main text of web pages with a site style tree.

A page is read into blocks under paths of element names and classes.  The pages of one
host are merged: for every path, the entropy of its child sequences (presentation) and of
its content over the host's pages, and what its names say beforehand, make its importance.
A branch of low importance is removed from each page, inside and outside `<article>`.

Names are a prior, no verdict of their own: elements called menu, advert, comments and the
like start far lower, an article's own paragraphs and headings somewhat higher.  Names of
`html`, `body`, headings, paragraphs and inline elements say nothing, and a branch that
is low by its name alone stays if it holds the page's text: more than half of it, with no
paragraph, heading or marked article outside.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import bounded, if_small, narrow, store

#: A path that weighs less than this is boilerplate.
MIN_WEIGHT = 0.2
#: Pages of full importance that every path has beside its own: a branch alike on all pages
#: of a host is boilerplate from five pages on, and less certain ones come later.
OTHER_PAGES = 1
#: What names add to importance: below the threshold whatever the entropy, or above it.
NOISE, OWN = -0.85, 0.3
#: Weight of presentation against content.
PRESENTATION = 0.1
#: Boilerplate paths travel by broadcast up to this many (about 30 bytes each).
BROADCAST_PATHS = 200_000

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|textarea|title|iframe"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
#: Elements without text for readers, and elements that are named for noise.
GONE = frozenset("head audio video map template svg math select option canvas object".split())
NAMED = frozenset("nav aside footer form dialog menu button fieldset".split())
#: Of these, whatever holds a page's whole text is still none of the article.
NEVER_MAIN = frozenset("nav aside footer dialog menu button".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "option": ("option", ("select", "datalist")), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
}
#: Words in a class, id or role that name what is not the article.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus replies share sharing "
    "social related recommended newsletter subscribe popup modal widget toolbar pagination pager copyright login signup "
    "contentinfo complementary search hidden".split()
)
#: The same for the page's header and footer, which an article may have too.
PAGE_WORDS = frozenset("header footer masthead topbar".split())
MAIN_WORDS = frozenset("article main post entry story".split())
#: Elements whose class, id and role say nothing about noise.
PLAIN = frozenset("html body main p h1 h2 h3 h4 h5 h6 blockquote pre td th tr caption".split())
#: Elements that carry an article's own text.
TEXTUAL = frozenset("article main p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr caption figcaption".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PART = re.compile(r"[a-z]+")


@lru_cache(200_000)
def _path(parent: bytes, label: str) -> bytes:
    """Eight bytes that name a path of labels."""
    return blake2b(parent + label.encode("utf-8", "surrogatepass"), digest_size=8).digest()


@lru_cache(50_000)
def _named(attributes: str) -> tuple[str, bool, bool, bool, bool]:
    """Label, and whether the attributes hide an element, name noise, a page's own frame, or the article."""
    words, hidden = [], False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif name in ("hidden", "aria-hidden"):
            hidden |= value != "false"
        else:
            words += _PART.findall(value)
    own = set(words)
    return ".".join(sorted(own)), hidden, bool(own & NOISE_WORDS), bool(own & PAGE_WORDS), bool(own & MAIN_WORDS)


class Element(NamedTuple):
    """An open element: `prior` is what its name adds to its path's importance."""

    tag: str
    path: bytes
    gone: bool
    marked: bool  # inside <article> or <main>
    classed: bool  # inside a class named for the article
    prior: float
    number: int


class Block(NamedTuple):
    """A run of text and the elements it stands in, outermost first."""

    text: str
    within: tuple[Element, ...]

    @property
    def gone(self) -> bool:
        return bool(self.within) and self.within[-1].gone

    @property
    def article(self) -> bool:
        """Whether it is text that articles are made of."""
        return any(e.marked or e.classed or e.tag in PLAIN and e.tag not in ("html", "body") for e in self.within)


def blocks(page: str) -> tuple[list[Block], list[tuple[bytes, str]]]:
    """The page's blocks in order, and (path of the parent, label of the child) of its elements in order."""
    out: list[Block] = []
    children: list[tuple[bytes, str]] = []
    stack = [Element("", b"", False, False, False, 0.0, 0)]
    text: list[str] = []

    def flush() -> None:
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if joined:
                out.append(Block(joined, tuple(stack[1:])))

    def close(names: frozenset[str] | set[str], stop: frozenset[str] | set[str]) -> None:
        """Close the innermost open element of `names`, unless one of `stop` lies between."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in stop:
                return

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[1] and m[1].lower() not in INLINE:
                text.append(" ")
            continue
        tag, attributes = tag.lower(), m[4]
        label, hidden, noise, frame, article = _named(attributes) if attributes and not m[2] else ("", False, False, False, False)
        if tag in INLINE and not hidden:
            if stack[-1].tag == tag and m[2]:
                flush()
                stack.pop()
            continue
        if tag == "br" or tag == "wbr":
            text.append(" " if tag == "br" else "")
            continue
        if tag in VOID and tag != "hr":
            continue
        flush()
        if m[2]:
            close({tag}, set() if tag in ("body", "html") else {"article", "main", "body"} - {tag} if tag == "p" else set())
            continue
        if tag in CLOSES_P:
            close({"p"}, {"article", "main", "section", "div", "table", "li", "td", "body", "button"})
        if tag in SIBLINGS:
            names, stop = SIBLINGS[tag]
            close(set(names.split()), set(stop))
        if tag == "body":
            close({"head"}, set())
        if tag == "hr":
            continue
        label = f"{tag}.{label}" if label else tag
        _, path, gone, marked, classed, _, _ = stack[-1]
        children.append((path, label))
        marked |= tag in ("article", "main")
        classed |= article
        noise &= tag not in PLAIN and not (tag == "article" and article)
        noise |= tag in NAMED or (frame and tag not in PLAIN or tag == "header") and not (marked or classed)
        prior = NOISE if noise else OWN if marked and tag in TEXTUAL else 0.0
        stack.append(Element(tag, _path(path, label), gone or hidden or tag in GONE, marked, classed, prior, len(children)))
    if at < len(page):
        text.append(page[at:])
    flush()
    return out, children


def main_text(page: str | None, boilerplate: frozenset[bytes] | set[bytes]) -> str:
    """The blocks outside of low branches, joined by line feeds.

    `boilerplate` are paths of low importance; elements that are low by name are known here.
    """
    found = [b for b in blocks(page or "")[0] if not b.gone]
    low = lambda b: any(e.path in boilerplate and e.prior >= 0 for e in b.within)
    important = [b for b in found if not low(b)] if boilerplate else found
    kept = _without_named(important)
    # A page whose every branch repeats all over its host is one text in many copies.
    return "\n".join(b.text for b in kept or _without_named(found))


def _without_named(found: list[Block]) -> list[Block]:
    """Blocks outside of elements named for noise, unless such an element holds the page's text."""
    total = sum(len(b.text) for b in found)
    size: dict[int, int] = {}
    for b in found:
        for e in b.within:
            if e.prior < 0:
                size[e.number] = size.get(e.number, 0) + len(b.text)
    plain = [b for b in found if all(e.prior >= 0 for e in b.within)]
    if not size:
        return plain
    outside = any(b.article for b in plain)

    def noise(e: Element) -> bool:
        return e.prior < 0 and (outside or e.tag in NEVER_MAIN or 2 * size[e.number] <= total)

    return [b for b in found if not any(noise(e) for e in b.within)]


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per page and path: what its name adds, its child sequence and its content, hashed."""
    for batch in batches:
        rows = []
        for host, page in zip(batch["host"], batch["html"]):
            found, children = blocks(page or "")
            style: dict[bytes, list[str]] = {}
            for path, label in children:
                seen = style.setdefault(path, [])
                if not seen or seen[-1] != label:  # a run of equal children is one
                    seen.append(label)
            content: dict[bytes, list[str]] = {}
            prior: dict[bytes, float] = {}
            for b in found:
                for e in b.within:
                    content.setdefault(e.path, []).append(b.text)
                    prior[e.path] = e.prior
            for path, texts in content.items():
                rows.append((host, path, prior[path], _hash(" ".join(style.get(path, []))), _hash("\n".join(texts))))
        if rows:
            yield pd.DataFrame(rows, columns=["host", "path", "prior", "style", "content"])


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def with_host(pages: DataFrame) -> DataFrame:
    one = narrow(pages, page_id="long", url="string", html="string")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return one.withColumn("host", host)


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, prior, pages, importance, weight) of all paths.

    Presentation is the entropy of child sequences, content the mean of one minus the
    entropy share of each page's content, both to the base of the host's pages: 0 where all
    pages are alike, 1 where no two are.  `weight` decides: importance with OTHER_PAGES
    beside the host's own, so that one page tells nothing and many tell all, and the prior.
    Counts combine before the shuffle, so a host with a third of all pages costs no more
    than its distinct features.
    """
    rows = bounded(with_host(pages).select("host", "html")).mapInPandas(
        _features, "host string, path binary, prior double, style long, content long"
    )
    key = ["host", "path", "prior"]
    seen = store(rows.groupBy(*key, "style", "content").agg(F.count(F.lit(1)).alias("n")), "style-tree")
    # -sum p log p = log m - sum n log n / m; the mean of 1 - log n / log m weighs each page alike
    weight = lambda by: F.sum(F.col("n") * F.log("n")).alias(by)
    contents = seen.groupBy(*key, "content").agg(F.sum("n").alias("n")).groupBy(*key)
    styles = seen.groupBy(*key, "style").agg(F.sum("n").alias("n")).groupBy(*key)
    both = contents.agg(F.sum("n").alias("pages"), weight("content")).join(styles.agg(weight("style")), key)
    share = lambda by: 1 - F.col(by) / (F.col("pages") * F.log("pages"))
    entropy = F.when(F.col("pages") > 1, PRESENTATION * share("style") + (1 - PRESENTATION) * share("content")).otherwise(1.0)
    smooth = (F.col("pages") * F.col("importance") + OTHER_PAGES) / (F.col("pages") + OTHER_PAGES)
    return both.select(*key, "pages", entropy.alias("importance")).withColumn("weight", smooth + F.col("prior"))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars (code points of text).

    Null and empty pages give an empty text, as do pages without any block that stays.
    Repeated rows are extracted alike; broken and cut-off markup is read as far as it goes.
    A page without a host is merged with others of its kind.  Other columns are not read;
    an empty table gives an empty result.
    """
    # Branches that are low by name are known from each page; the entropy's verdicts travel.
    low = style_tree(pages).where((F.col("prior") >= 0) & (F.col("weight") < MIN_WEIGHT))
    low = low.groupBy("host").agg(F.collect_set("path").alias("low"), F.count(F.lit(1)).alias("n"))
    low = store(low, "boilerplate")
    paths = low.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    low = if_small(low.drop("n"), BROADCAST_PATHS) if paths <= BROADCAST_PATHS else low.drop("n")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                main_text(page, frozenset() if paths is None else frozenset(map(bytes, paths)))
                for page, paths in zip(batch["html"], batch["low"])
            ]
            yield pd.DataFrame({
                "page_id": batch["page_id"].array, "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts],
            })

    joined = with_host(pages).join(low, "host", "left").select("page_id", "url", "html", "low")
    return bounded(joined).mapInPandas(run, "page_id long, url string, text string, n_chars long")
