"""HTML main text: the maximum-scoring contiguous run of words and tags, with weights from labelled pages.

A page is a sequence of words and tags. Words score by where they stand (kind of their element, inside or
outside an ``<article>``/``<main>`` if the page marks its main text so: such elements, outside what is never
main text, hold words and at least half of the page's plain words), tags score negative. The weights are log odds of
standing in the main text, counted on labelled pages: pages that mark their main text themselves with one
``<article>`` or ``<main>``. One linear scan per page finds the run with the greatest sum; within the run,
text of elements that are never main text (menus, asides, forms, adverts, comments..) is left out.

An element is taken for such a part by its name, or by a class, id or role that consists of such words and
generic ones only (``site-footer``, not ``has-sidebar`` or ``share-price``). A wrapper is spared, and all around
it: an element that holds the page's main ``<article>`` or ``<main>`` (one with at least as many plain words as
stand outside all such parts), or, comments, adverts, footers and the like apart, nearly all of its plain words.

Text: character references are decoded, white space inside a block is one space, blocks are trimmed and
joined by one ``\\n`` in page order; nothing else is dropped or capped. ``<br>`` is white space.

Training is bounded: ``TRAINING_PAGES`` labelled pages with the least hash of their content (a documented
sample); what goes to the driver are counts of a fixed set of features. Extraction reads each page alone.

Defined results: null or empty html, and pages without words, give empty text; unclosed elements end where
their parent does; an unclosed comment, script or style reaches to the end of the page; repeated rows are
extracted alike; without any labelled page the built-in weights hold.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

TRAINING_PAGES = 2000

#: Element names of the HTML standard, by what they do to text.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main "
                   "menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead "
                   "title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b cite code em i mark q s small span strong sub sup u".split())
#: Elements, and parts of class, id and role names, that mark what is never main text.
BOILERPLATE = frozenset("nav header footer aside form head title menu button select option dialog iframe object search".split())
HINTS = frozenset("ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs byline comment comments "
                  "contentinfo cookie cookies consent complementary copyright disclaimer disqus dropdown footer header masthead menu modal nav "
                  "navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommended related "
                  "replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
                  "subscription tagcloud toolbar topbar warning widget widgets alert gdpr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that group text blocks.
GROUPS = frozenset("article body center div fieldset html main section td th".split())
#: A page is marked if its articles and mains hold this share of its plain words.
MARKED_SHARE = 0.5
#: Score of a tag or word that is left out anyway, inside a content element of a page that isn't marked.
SKIPPED = -0.001

#: Words that say nothing about an element's part by themselves.
GENERIC = frozenset("area articles aside bar block body bottom box btn button buttons center col column container content default desktop "
                    "div element entry fixed floating form global google group holder icon icons id inner inline item items js left link links "
                    "list main mobile module outer page pages panel post posts primary reader region right root row secondary section "
                    "site slot small sticky stories text title top trail unit user users view wrap wrapper".split())
#: Parts that are left out however much of the page they hold.
ALWAYS_OUT = frozenset("footer aside title button select option dialog iframe object head ad ads adv advert advertisement advertising "
                       "comment comments replies reply respond disqus cookie cookies consent gdpr copyright newsletter related recommended "
                       "sponsor sponsored popup modal".split())
#: Least number of plain words, and how many times those outside, that spare a wrapper without article or main.
WRAPPED_WORDS, WRAPPED_TIMES = 20, 9

_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style noscript template textarea svg math".split()}
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def tokens(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """(text before, tag name, is a closing tag, attributes) of each tag; one more of the text after the last.

    Comments, declarations and raw elements (script, style ..) are left out. One forward pass: a quote that is never
    closed doesn't hide the ``>`` after it, and is met once; without a further ``>`` the rest is text.
    """
    at = begin = 0
    parts: list[str] = []
    while True:
        begin = page.find("<", begin)
        if begin < 0:
            break
        if page.startswith(("<!", "<?"), begin):
            comment = page.startswith("<!--", begin)
            end = page.find("-->" if comment else ">", begin + 4 if comment else begin)
            if end < 0 and not comment:
                break
            parts.append(page[at:begin])
            at = begin = len(page) if end < 0 else end + (3 if comment else 1)
            continue
        named = _NAME.match(page, begin + 1)
        if not named:
            begin += 1
            continue
        end = named.end()
        while True:
            stop = _STOP.search(page, end)
            if not stop or stop[0] == ">":
                break
            closed = page.find(stop[0], stop.end())
            end = closed + 1 if closed >= 0 else stop.end()
        if not stop:
            break
        parts.append(page[at:begin])
        name, inner = named[1].lower(), page[named.end(): stop.start()]
        closing = page[begin + 1] == "/"
        at = begin = stop.end()
        if name in _RAW and not closing:
            if not inner.endswith("/"):
                ended = _RAW[name].search(page, at)
                at = begin = ended.end() if ended else len(page)
            continue
        yield "".join(parts), name, closing, inner
        parts = []
    parts.append(page[at:])
    yield "".join(parts), "", False, ""


#: What an element is by name and attributes: main text possible, a part apart, one that is always out, or hidden.
OPEN, APART, OUT, HIDDEN = range(4)


def _kind(name: str, attributes: str) -> int:
    kind = (OUT if name in ALWAYS_OUT else APART) if name in BOILERPLATE else OPEN
    if name in ("html", "body"):
        return kind
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role"):
            for token in value.split():
                words = {w.lower() for w in _PART.findall(token)}
                known = words & HINTS
                if known and all(w in HINTS or w in GENERIC or len(w) == 1 for w in words):
                    kind = max(kind, OUT if known & ALWAYS_OUT else APART)
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            return HIDDEN
    return kind if name not in ("article", "main") or kind == OUT else OPEN


class Page:
    """Elements of a page in order of opening (0: the page), and its tags and texts with the element they stand in."""

    def __init__(self, page: str):
        self.names, self.parents, self.kinds = [""], [0], [OPEN]
        self.items: list[tuple[int, str, str, int]] = []  # element, tag name or empty, text, words
        stack = [0]
        for text, name, closing, attributes in tokens(page):
            if text:
                decoded = html.unescape(text)
                self.items.append((stack[-1], "", decoded, len(decoded.split())))
            if not name:
                continue
            if closing:
                self.items.append((stack[-1], name, name, 0))
                for depth in range(len(stack) - 1, 0, -1):
                    if self.names[stack[depth]] == name:
                        del stack[depth:]
                        break
                continue
            if name not in VOID and not attributes.endswith("/"):
                if name == "body":
                    stack = [e for e in stack if e == 0 or self.names[e] == "html"]
                elif name in BLOCKS:  # a new block ends open paragraphs; an item or cell the one before it
                    while len(stack) > 1:
                        last = self.names[stack[-1]]
                        if not (last == "p" or last in INLINE or last in HEADINGS or (
                                last == name and name in ("li", "td", "th", "tr", "dt", "dd", "option"))):
                            break
                        stack.pop()
                self.names.append(name)
                self.parents.append(stack[-1])
                self.kinds.append(_kind(name, attributes))
                stack.append(len(self.names) - 1)
            self.items.append((stack[-1], name, name, 0))

    def plain(self, e: int) -> bool:
        return self.names[e] not in HEADINGS and self.names[e] != "a"

    def never_main(self) -> list[bool]:
        """For each element whether it is, or stands in, what is never main text, wrappers spared."""
        n = len(self.names)
        host, words, inner, hidden = [-1] * n, [0] * n, [0] * n, [False] * n  # host: the next part apart around an element
        for e in range(1, n):
            host[e] = e if self.kinds[e] != OPEN else host[self.parents[e]]
            hidden[e] = hidden[self.parents[e]] or self.kinds[e] == HIDDEN
        outside = 0
        for e, tag, _, count in self.items:
            if not tag and self.plain(e):
                words[e] += count
                if host[e] >= 0:
                    inner[host[e]] += count
                else:
                    outside += count
        for e in range(n - 1, 0, -1):  # words of an element's host reach its own host only
            if host[e] != e:
                words[self.parents[e]] += words[e]
        marked = max((e for e in range(1, n) if self.names[e] in ("article", "main") and self.kinds[e] == OPEN and not hidden[e]),
                     key=lambda e: words[e], default=0)
        spared: set[int] = set()
        keep = -1
        if marked and host[marked] >= 0 and words[marked] > outside:
            keep = host[marked]
        else:
            best = max((e for e in range(1, n) if self.kinds[e] == APART and not hidden[e]), key=lambda e: inner[e], default=-1)
            if best >= 0 and inner[best] >= max(WRAPPED_WORDS, WRAPPED_TIMES * outside):
                keep = best
        while keep > 0:
            spared.add(keep)
            keep = host[self.parents[keep]]
        if any(self.kinds[e] != APART for e in spared):
            spared.clear()
        never = [False] * n
        for e in range(1, n):
            never[e] = never[self.parents[e]] or (self.kinds[e] != OPEN and e not in spared)
        return never


def events(page: str) -> tuple[list[tuple[str, bool, str, int, bool]], bool, int]:
    """((kind, inside marked main text, text or tag name, words, skipped) of each tag and piece of text, is main text marked,
    number of articles and mains outside never-main elements).

    Skipped is what stands in a never-main element inside a content element: one that holds at least half of the
    plain words under it itself, in text blocks, or in child groups without blocks of their own.
    """
    read = Page(page)
    names, parents, never = read.names, read.parents, read.never_main()
    inside, group = [False] * len(names), [0] * len(names)
    parent, own, parted = [0], [0], [True]  # of each group: the group around it, plain words, holds blocks
    marks = 0
    for e in range(1, len(names)):
        up, name = parents[e], names[e]
        inside[e], group[e] = inside[up], group[up]
        if name in ("article", "main") and not never[e]:
            inside[e] = True
            marks += 1
        if not never[e] and (name in BLOCKS or "-" in name):
            parted[group[up]] = True
            if name in GROUPS or "-" in name:
                parent.append(group[up])
                own.append(0)
                parted.append(False)
                group[e] = len(own) - 1
    out: list[tuple[str, bool, str, int]] = []
    hosts: list[int] = []  # of each event in a never-main element the group around that element, else -1
    for e, tag, piece, n in read.items:
        if tag:
            known = tag if tag in BLOCKS or tag in VOID or tag in INLINE else "other"
            out.append((f"tag {known}", inside[e], piece, 0))
        else:
            kind = "never" if never[e] else "heading" if names[e] in HEADINGS else "link" if names[e] == "a" else "plain"
            if kind == "plain":
                own[group[e]] += n
            out.append((f"word {kind}", inside[e], piece, n))
        hosts.append(group[e] if never[e] else -1)

    total, near = list(own), list(own)
    for g in range(len(own) - 1, 0, -1):
        total[parent[g]] += total[g]
        near[parent[g]] += 0 if parted[g] else own[g]
    filled = [0] * len(own)  # the next group around that has plain words
    for g in range(len(own)):
        filled[g] = g if total[g] or not g else filled[parent[g]]
    within = {g: 0 < total[filled[g]] <= 2 * near[filled[g]] for g in set(hosts) if g >= 0}
    share = [sum(n for kind, side, _, n in out if kind == "word plain" and side == wanted) for wanted in (False, True)]
    holds = any(n and side and kind.startswith("word") and kind != "word never" for kind, side, _, n in out)
    marked = holds and share[True] >= MARKED_SHARE * sum(share)
    return [(*e, within.get(g, False)) for e, g in zip(out, hosts)], marked, marks


def feature(kind: str, inside: bool, marked: bool) -> str:
    return f"{kind} {('in' if inside else 'out') if marked else 'none'}"


def default_weight(f: str) -> float:
    """Weight of a feature that labelled pages don't show."""
    kind, where = f.rsplit(" ", 1)
    if kind.startswith("tag"):
        return {"in": -0.1, "none": -0.2, "out": -1.0}[where]
    if kind == "word never":
        return {"in": -0.001, "none": -0.3, "out": -3.0}[where]
    return -2.0 if where == "out" else 0.3 if kind == "word link" else 1.0


def fitted_weights(inside: Mapping[str, int], outside: Mapping[str, int]) -> dict[str, float]:
    """Log odds of main text per feature, bounded; tags and never-main words stay negative.

    What is left out anyway, and tags inside marked main text, cost little: they don't split it.
    """
    out = {}
    n_in, n_out = sum(inside.values()) + 1, sum(outside.values()) + 1
    for f in set(inside) | set(outside):
        odds = math.log((inside.get(f, 0) + 1) / n_in) - math.log((outside.get(f, 0) + 1) / n_out)
        kind, where = f.rsplit(" ", 1)
        if kind == "word never":
            out[f] = {"in": -0.001, "none": -0.3, "out": -max(1.0, min(6.0, -odds))}[where]
        elif kind.startswith("tag"):
            out[f] = -0.1 if where == "in" else -max(0.1, min(1.0, -odds))
        else:
            out[f] = max(-6.0, min(3.0, odds))
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """[begin, end) of the run with the greatest positive sum, the first of equals; empty if there is none."""
    best, span, total, begin = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0.0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, span = total, (begin, i + 1)
    return span


def main_text(page: str, weights: Mapping[str, float]) -> str:
    seen, marked, _ = events(page)
    known: dict[tuple[str, bool], float] = {}
    scores = []
    for kind, inside, _, n, skipped in seen:
        if skipped and not marked:
            scores.append(SKIPPED * max(1, n))
            continue
        w = known.get((kind, inside))
        if w is None:
            f = feature(kind, inside, marked)
            w = known[kind, inside] = weights[f] if f in weights else default_weight(f)
        scores.append(w if kind.startswith("tag") else w * n)
    begin, end = best_run(scores)
    blocks: list[list[str]] = [[]]
    for kind, _, piece, _, _ in seen[begin:end]:
        if kind.startswith("tag"):
            if piece in BLOCKS:
                blocks.append([])
            elif piece == "br":
                blocks[-1].append(" ")
        elif kind != "word never":
            blocks[-1].append(piece)
    joined = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(b for b in joined if b)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    for batch in batches:
        for page in batch.column(0):
            seen, marked, marks = events(page.as_py())
            if not marked or marks != 1:
                continue
            for kind, within, _, n, _ in seen:
                main = within and kind != "word never"
                for f in (feature(kind, within, marked), feature(kind, within, False)):  # as if it weren't marked, too
                    (inside if main else outside)[f] += n if kind.startswith("word") else 1
    names = sorted(set(inside) | set(outside))
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([inside[f] for f in names], pa.int64()),
                                      pa.array([outside[f] for f in names], pa.int64())], names=["feature", "n_in", "n_out"])


def _labelled_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the pages that mark their main text with exactly one article or main element."""
    for batch in batches:
        parsed = (events(page.as_py())[1:] for page in batch.column(0))
        yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array([marked and marks == 1 for marked, marks in parsed], pa.bool_()))], names=["_o"])


def learn_weights(pages: DataFrame, *, content: str = "html", training_pages: int = TRAINING_PAGES) -> dict[str, float]:
    """Weights from pages that mark their main text with exactly one article or main: the ``training_pages`` of least hash."""
    ship_package(pages.sparkSession)
    page = F.col(content)
    may_be = pages.where(F.lower(page).rlike(r"<(article|main)\b")).select(page.cast("string").alias("html"), F.xxhash64(page).alias("_o"))

    def least(hashes: DataFrame, n: int):
        return hashes.orderBy("_o").limit(n).agg(F.max("_o").alias("last"), F.count("_o").alias("n")).first()

    # the hashes alone are sorted; pages at or below the last one of the sample are read again where they lie
    near = least(may_be.select("_o"), 2 * training_pages)
    last = least(may_be.where(F.col("_o") <= F.lit(near["last"])).mapInArrow(_labelled_batches, "_o long"), training_pages)
    if last["n"] < training_pages and near["n"] == 2 * training_pages:  # many false marks: all that may be
        last = least(may_be.mapInArrow(_labelled_batches, "_o long"), training_pages)
    sample = may_be.where(F.col("_o") <= F.lit(last["last"])).select("html")
    counts = sample.mapInArrow(_count_batches, "feature string, n_in long, n_out long").groupBy("feature").agg(
        F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")).collect()  # a row a feature, a fixed set
    return fitted_weights({r["feature"]: r["n_in"] for r in counts}, {r["feature"]: r["n_out"] for r in counts})


def extract_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", content: str = "html",
                 weights: Mapping[str, float] | None = None) -> DataFrame:
    """(key, url, text, n_chars) of every row of ``pages``."""
    ship_package(pages.sparkSession)
    weights = learn_weights(pages, content=content) if weights is None else dict(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", weights) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["_key", "_url", "text", "n_chars"])

    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(content).cast("string").alias("_html"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = rows.mapInArrow(run, f"_key {types['_key']}, _url {types['_url']}, text string, n_chars long")
    return out.select(F.col("_key").alias(key), F.col("_url").alias(url), "text", "n_chars")


def op7_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
