"""Main text of web pages: the maximum-scoring run of words and tags (operator 11).

A page is a sequence of words and tags.  A word scores positive unless it stands in something that is known
not to be content, a tag scores negative, and the run with the highest sum (one linear scan) is the content
region.  The weights are learned from labelled pages: those that mark their own main text with one ``article``
or ``main`` element.  Counting (cue, inside or outside) is one pass with partial sums; the
table of weights is as long as the fixed cue vocabulary below, so it may go to every task.

* A *cue* is a tag, a role, or a part of a class or id name of an element around a word.  Its weight is the
  log-odds that words under it are inside the labelled region; prior counts, which a name's kind gives, speak
  for names that no labelled page has.
* A tag's weight is the log-odds that such a tag is outside, ``TAG_COST`` at least: content tags cost little,
  menu tags much.

Inside the region's container (the innermost element around both its ends) all content blocks are taken, so
that a long run of comments in the middle of an article does not cost its second half; words under boilerplate
cues are left out wherever they are, but headings in an article's own header stay.  Script, style and the like
are never text.  Character references are decoded, white space (also a line break tag) inside a block becomes
one space, and blocks are joined by a line break.

Defined cases: a null, empty or tag-only page has an empty text; broken markup is read as browsers do (unclosed
elements end with their parent, an unclosed comment or tag takes the rest of the page); a page without labels
is scored by weights learned elsewhere, and without any labelled page by the prior counts; repeated rows come
back each; null ids and urls are kept; an empty table gives no rows; only page_id, url and html are read.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED values: names that HTML and common page templates use.
#: Elements whose text is not page text at all.
SILENT = frozenset("script style head title template noscript noframes iframe svg canvas object audio video map datalist".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr basefont frame keygen".split())
#: Elements whose content is plain text up to their end tag.
RAW = frozenset("script style textarea title iframe noframes xmp".split())
#: Elements that start and end a block.
BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul").split())
TABLE = frozenset("table caption thead tbody tfoot tr td th html body".split())
CELLS = frozenset(("td", "th", "caption"))
#: Cues that are weighed, but do not make words boilerplate by themselves.
LISTS = frozenset(("a", "li"))
#: Inline elements that a slash in their start tag does not end.
OPEN = frozenset("a b i em strong span".split())
INLINE = frozenset(("a", "b", "br", "i", "em", "span", "img"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that mark a page's main text.
MAIN = frozenset(("article", "main"))
#: Boilerplate elements, roles, and parts of class and id names.
BOILER_TAGS = frozenset("nav header footer aside form button select option textarea fieldset legend dialog menu search".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
BOILER_NAMES = frozenset((
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsors sponsored promo promos promotion banner "
    "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription "
    "signup login nav navbar navigation menu menus topbar breadcrumb breadcrumbs pagination pager header footer masthead sidebar sidebars "
    "aside widget widgets related recommended recommendations share sharing social comment comments commentlist reply replies respond "
    "disqus discussion feedback form search skip copyright legal disclaimer toolbar").split())
#: First parts of names that only say something about another element.
ABOUT = frozenset("has with without no is js".split())
#: Start tags that end an open paragraph, and those that end an open element of their own kind.
ENDS_P = BLOCK - frozenset("body html caption tbody td tfoot th thead tr option optgroup legend".split())
ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}, "p": {"p"}}
#: What an end tag or an implied end does not reach across.
FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"},
          "p": {"article", "section", "div", "td", "th", "li", "main", "body", "table", "blockquote", "form", "aside", "nav"}}

#: Prior counts (inside, outside) of a cue: boilerplate names, links and list items, anything else.
PRIOR = {"boiler": (1.0, 20.0), "list": (4.0, 5.0), "plain": (4.0, 1.0)}
#: A tag costs this at least.
TAG_COST = 0.1
#: A word under a boilerplate name costs this at least, whatever is learned.
BOILER_COST = 0.5
#: Words whose cues are below this are not content, in the region or not.
OUT = 0.0
LIMIT = 5.0

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
NAMES = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PARTS = re.compile(r"[^\W\d_]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
COUNTS = "kind string, name string, inside long, outside long"


class Element:
    """An open element: what it and those around it say, and the runs it holds (first, and last when it has ended)."""

    __slots__ = ("tag", "parent", "cues", "main", "heading", "first", "last")

    def __init__(self, tag: str, parent: Element | None, cues: frozenset, first: int):
        around = parent.cues if parent else frozenset()
        self.tag, self.parent, self.first, self.last = tag, parent, first, None
        within = parent is not None and parent.main
        self.main = within or tag in MAIN
        # a form around the whole page says nothing about its main text
        self.cues = (around - {"form"} if self.main and not within else around) | cues
        self.heading = tag in HEADINGS or (parent is not None and parent.heading)

    def holds(self, run: int) -> bool:
        return self.first <= run and (self.last is None or run < self.last)


class Run(NamedTuple):
    """A piece of text: its decoded words, its number, its block, and the innermost element around it."""

    text: str
    words: int
    number: int
    block: int
    element: Element

    @property
    def cues(self) -> frozenset:
        return self.element.cues

    @property
    def main(self) -> bool:
        return self.element.main

    @property
    def heading(self) -> bool:
        return self.element.heading


def _cues(tag: str, attributes: str) -> frozenset:
    """Cues of an element: its tag, and the known names among its role, class and id."""
    out = {tag} if tag in BOILER_TAGS or tag in ("a", "li") else set()
    if attributes and tag not in ("html", "body"):
        for kind, *values in NAMES.findall(attributes):
            value = next((v for v in values if v), "")
            if kind.lower() == "role":
                out.update(f"role={r}" for r in value.lower().split() if r in BOILER_ROLES)
                continue
            for name in value.split():
                parts = [x.lower() for x in PARTS.findall(CAMEL.sub(" ", name))]
                # "site-footer" and "ad-slot" name a thing, "content-sidebar-wrap" what is around it
                if parts and parts[0] not in ABOUT:
                    out.update(f".{x}" for x in (parts[0], parts[-1]) if x in BOILER_NAMES)
    return frozenset(out)


def tokens(page: str):
    """('tag', name, whether it is in a main text) and Run items of a page, in order; the text of SILENT elements is left out."""
    stack = [Element("", None, frozenset(), 0)]
    opened: Counter = Counter()
    runs = block = 0
    at, n, loose = 0, len(page), False

    def close(to: int):
        for e in stack[to:]:
            e.last = runs
            opened[e.tag] -= 1
        del stack[to:]

    def start(tag, cues):
        stack.append(Element(tag, stack[-1], cues, runs))
        opened[tag] += 1

    def silent():
        return any(opened[t] for t in SILENT)

    def end(tags, fence):
        """Close the innermost open element of the tags, unless a fence stands before it."""
        if any(opened[t] > 0 for t in tags):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in tags:
                    close(i)
                    return
                if stack[i].tag in fence:
                    return

    def run(text):
        nonlocal runs
        text = references.unescape(text) if "&" in text else text
        runs += 1
        return Run(text, len(text.split()), runs - 1, block, stack[-1])

    while at < n:
        lt = page.find("<", at)
        # a less-than sign that opens nothing is text
        while 0 <= lt < n - 1 and not (page[lt + 1].isascii() and page[lt + 1].isalpha()) and page[lt + 1] not in "/!?":
            lt = page.find("<", lt + 1)
        stop = n if lt < 0 or lt == n - 1 else lt
        if stop > at and not silent():
            yield run(page[at:stop])
        if stop == n:
            return
        at = lt
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            at = n if stop < 0 else stop + 3
            continue
        m = None if loose else TAG.match(page, at)
        if m is None and not loose and page[at + 1] not in "!?":
            # an open quotation: from here on a tag ends at the next bracket, so a page is read in linear time
            loose = True
        if m is None:
            stop = page.find(">", at)
            if stop < 0:
                return    # a tag that never ends
            m = LOOSE_TAG.match(page, at)
        if m is None:
            at = stop + 1
            continue
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            # an inline end tag ends nothing outside its block, and what is in a cell ends nothing outside it
            fence = BLOCK if tag not in BLOCK and tag not in SILENT else FENCES.get(tag, CELLS if tag not in TABLE else ())
            yield "tag", tag, stack[-1].main
            end((tag,), fence)
            if tag in BLOCK:
                block += 1
            continue
        if tag in ENDS_P:
            end(("p",), FENCES["p"])
        if tag in ENDS_OWN:
            end(ENDS_OWN[tag], FENCES.get(tag, ()))
        if tag in BLOCK:
            block += 1
            if opened["head"] > 0:
                end(("head",), ())    # the page's body starts
        yield "tag", tag, stack[-1].main or tag in MAIN
        if tag == "br" and not silent():
            yield run("\n")
        if tag in VOID or (m[3].endswith("/") and tag not in BLOCK and tag not in RAW and tag not in SILENT and tag not in OPEN):
            continue
        if tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            inner = page[at:stop.start() if stop else n]
            if tag in ("textarea", "xmp") and not silent() and inner:
                start(tag, _cues(tag, m[3]))
                yield run(inner)
                close(len(stack) - 1)
            at = n if stop is None else (page.find(">", stop.end()) + 1 or n)
            yield "tag", tag, stack[-1].main
            continue
        start(tag, _cues(tag, m[3]))


def _telling(cues: frozenset) -> frozenset:
    """Links and list items say nothing more about words that are in named boilerplate."""
    return cues - LISTS or cues


def _kind(cue: str) -> str:
    return "list" if cue in LISTS else "plain" if cue == "" else "boiler"


def counts(page: str) -> Counter | None:
    """(kind, name, inside) -> words or tags of a labelled page; None if it does not mark one main text."""
    out: Counter = Counter()
    main = seen = 0
    for token in tokens(page):
        if isinstance(token, Run):
            for cue in _telling(token.cues) or ("",):
                out["word", cue, token.main] += token.words
            main += token.words * token.main
        else:
            out["tag", token[1] if token[1] in BLOCK or token[1] in INLINE else "other", token[2]] += 1
            seen += token[1] in MAIN
    # one element is a start and an end tag, of which the end may be missing
    return out if main and seen <= 2 else None


def learn(pages: DataFrame) -> dict[tuple[str, str], float]:
    """Weights of ('word', cue) and ('tag', name), from all labelled pages."""

    def count(batches):
        total: dict = {}
        for batch in batches:
            for page in batch.column(0).to_pylist():
                if page and ("<article" in page or "<main" in page or "<ARTICLE" in page or "<MAIN" in page) and (own := counts(page)):
                    for (kind, name, inside), n in own.items():
                        total.setdefault((kind, name), [0, 0])[not inside] += n
        rows = [(k, n, i, o) for (k, n), (i, o) in sorted(total.items())]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                         ["kind", "name", "inside", "outside"])

    rows = pages.select("html").mapInArrow(count, COUNTS).groupBy("kind", "name").agg(F.sum("inside"), F.sum("outside")).collect()
    return weights({(kind, name): (i, o) for kind, name, i, o in rows})


def weights(found: dict[tuple[str, str], tuple[int, int]]) -> dict[tuple[str, str], float]:
    """Log-odds from counts and prior counts: of cues to be inside, of tags to be outside."""
    out = {}
    cues = {""} | {"a", "li"} | BOILER_TAGS | {f"role={r}" for r in BOILER_ROLES} | {f".{x}" for x in BOILER_NAMES}
    base = found.get(("word", ""), (0, 0))
    for cue in cues:
        i, o = found.get(("word", cue), (0, 0))
        p, q = PRIOR[_kind(cue)]
        # counts are taken at most as strong as a hundred words, so that one site's habit does not outweigh a name
        scale = min(1.0, 100 / max(1, i + o))
        weight = math.log((i * scale + p) / (o * scale + q))
        # comments and adverts are no main text even where pages put them inside the element that marks it
        out["word", cue] = max(-LIMIT, min(-BOILER_COST if _kind(cue) == "boiler" else LIMIT, weight))
    out["word", ""] = max(0.5, out["word", ""]) if sum(base) else math.log(4)
    for (kind, name), (i, o) in found.items():
        if kind == "tag":
            out["tag", name] = -max(TAG_COST, min(LIMIT, math.log((o + 1) / (i + 1))))
    return out


def _score(run: Run, table: dict) -> float:
    """The weight of a word: its worst cue's, or a plain word's."""
    if not run.cues or run.main and run.heading and run.cues <= {"header", ".header"}:
        return table["word", ""]
    return min(table["word", c] for c in _telling(run.cues))


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the highest sum, the first of equal ones; (0, 0) if none is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def main_text(page: str | None, table: dict) -> str:
    """The main text of a page."""
    items = list(tokens(page or ""))
    # a tag that no labelled page has costs as much as their other rare ones
    rare = table.get(("tag", "other"), -TAG_COST)
    words = [_score(x, table) if isinstance(x, Run) else 0.0 for x in items]
    start, end = best_run([w * x.words if isinstance(x, Run) else table.get(("tag", x[1]), rare) for x, w in zip(items, words, strict=True)])
    region = [x for x, w in zip(items[start:end], words[start:end], strict=True) if w > OUT and x.words]
    if not region:
        return ""
    first, last = region[0], region[-1]
    box = first.element
    while not box.holds(last.number):
        box = box.parent
    if first.block == last.block and box.parent is not None:
        box = box.parent    # one block: what is around it
    blocks: dict[int, list[str]] = {}
    for r in items:
        if isinstance(r, Run) and box.holds(r.number) and (not r.words or _taken(r, table)):
            blocks.setdefault(r.block, []).append(r.text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(x for x in lines if x)


def _taken(run: Run, table: dict) -> bool:
    """Whether a word in the container is content: links and list items are, boilerplate is not."""
    cues = run.cues - LISTS
    if run.main and run.heading and cues <= {"header", ".header"}:
        return True
    return not cues or min(table["word", c] for c in cues) > OUT


def extract(pages: DataFrame, table: dict) -> DataFrame:
    """(page_id, url, text) of every page."""

    def read(batches):
        for batch in batches:
            for k in range(0, len(batch), 500):
                part = batch.slice(k, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([main_text(x, table) for x in part.column(2).to_pylist()], pa.string())], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(read, "page_id long, url string, text string")


def op11_main_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, learn(pages)).withColumn("n_chars", F.char_length("text").cast("long"))
