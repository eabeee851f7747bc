"""Main text of web pages: the maximum-scoring run of tokens, words positive and tags negative."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, without

# Bound of the labelled sample the weights are learnt from, in pages; rarer features of it have no weight of their own.
LABELLED_PAGES = 1_000
LEAST_COUNT = 5

# HTML's elements that break a line of text, and those whose content is no text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe textarea title svg object select canvas audio video noembed noframes".split())
# Of these, the ones that go on to the end of the page if they are not closed, and that a slash does not close.
ENDLESS = frozenset("script style textarea title".split())
# Elements, and words in class or role (outside of the article also in id), that mark what stands around the main text.
AROUND = frozenset("nav footer aside form menu dialog button search".split())
AROUND_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidenav menu menubar nav navbar"
    " navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay"
    " newsletter subscribe subscription signup login comment comments disqus reply replies respond discussion feedback share sharing social related recommended"
    " widget widgets pagination pager skip contentinfo complementary commentlist commentform".split()
)
# Words that may stand beside these in one name without changing what it means.
PLAIN_WORDS = frozenset(
    "site page main primary secondary top bottom left right side bar box block area section list item items container wrapper inner outer"
    " wrap links link buttons button posts post entry articles article content header body user reader readers slot unit form text message global"
    " sticky fixed mobile desktop thread google js ui c m l".split()
)
TITLED = frozenset(["article", "content", "entry", "post", "story", "title"])
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words that are as well the names of an article's sections, so that an id says nothing by them; inside it only the others say something.
SECTIONS = frozenset("discussion feedback related social sharing share notice notices skip".split())
READERS = frozenset("comment comments commentlist commentform respond disqus".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*>|</?[a-zA-Z][^>]*>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

OPEN, CLOSE, TEXT = 0, 1, 2
OUTPUT = ("text", "n_chars")


def tokens(page: str) -> list[tuple[int, str, str]]:
    """The page as (kind, name, rest): tags with their attributes, and text as it is written; no comments or raw elements.

    A raw element that is not closed is a tag like others; but a script, style, textarea or title goes on to the end, as in a browser.
    """
    out, at = [], 0
    unclosed: set[str] = set()
    while m := TOKEN.search(page, at):
        if m.start() > at:
            out.append((TEXT, "", page[at : m.start()]))
        at = m.end()
        if not m["name"]:
            continue
        name, attrs = m["name"].lower(), m["attrs"]
        if m["close"]:
            out.append((CLOSE, name, attrs))
            continue
        if name in RAW and (name in ENDLESS or not attrs.endswith("/")) and name not in unclosed:
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            if end or name in ENDLESS:
                at = end.end() if end else len(page)
                out.append((OPEN, "#raw", ""))
                continue
            unclosed.add(name)  # nor will a later one be
        out.append((OPEN, name, attrs))
    if at < len(page):
        out.append((TEXT, "", page[at:]))
    return out


def attributes(attrs: str) -> dict[str, str]:
    """Attributes by name, without quotes; of one that stands twice the first counts."""
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(attrs):
        out.setdefault(name.lower(), value.strip("\"'") if value[:1] in ("'", '"') else value)
    return out


def words_of(value: str) -> list[str]:
    return [w.lower() for w in PART.findall(value)]


def marks(attrs: str) -> list[str]:
    """Words of class, id and role."""
    if "=" not in attrs:
        return []
    known = attributes(attrs)
    return [w for n in ("class", "id", "role") for w in words_of(known.get(n, ""))]


def hidden(known: dict[str, str]) -> bool:
    shut = "hidden" in known and known["hidden"].lower() != "false"
    return shut or known.get("aria-hidden", "").lower() == "true" or bool(NO_DISPLAY.search(known.get("style", "")))


def partners(stream: list[tuple[int, str, str]]) -> dict[int, int]:
    """Where each element ends; elements that are never closed are left out.

    A paragraph also ends before the next block, and with the element around it.
    """
    waiting: dict[str, list[int]] = {}
    out = {}
    for i, (kind, name, attrs) in enumerate(stream):
        if kind != TEXT and name in BLOCKS and waiting.get("p") and not (kind == CLOSE and name == "p"):
            out[waiting["p"].pop()] = i - 1
        if kind == OPEN and name not in VOID and not attrs.endswith("/"):
            waiting.setdefault(name, []).append(i)
        elif kind == CLOSE and waiting.get(name):
            out[waiting[name].pop()] = i
    return out


def grown(stream: list[tuple[int, str, str]], a: int, b: int) -> tuple[int, int]:
    """The run widened to the innermost elements for the main text that its first and last tokens lie in."""
    spans = [(i, j) for i, j in partners(stream).items() if stream[i][1] in MAIN]
    first = max((s for s in spans if s[0] <= a < s[1]), default=(a, b))
    last = max((s for s in spans if s[0] < b <= s[1]), default=(a, b))
    return min(a, first[0]), max(b, last[1])


def around(name: str, attrs: str, inside_main: bool) -> bool:
    """Whether an element is a menu, footer, advert, form, notice, comment section or the like.

    A class, role or id says so as a whole name: one of AROUND_WORDS, perhaps with PLAIN_WORDS (``comment-list``), but not with others
    (``related-work``).  Inside the main text headings, and ids but those of reader comments, say nothing, since their names come from the text.
    """
    if name in AROUND or name == "header" and not inside_main:
        return True
    if not attrs or name in ("html", "body") or name in MAIN:
        return False
    known = attributes(attrs)
    if hidden(known):
        return True
    if inside_main and name in HEADINGS:
        return False
    if not inside_main and "header" in marks(attrs) and not TITLED.intersection(marks(attrs)):
        return True
    own = AROUND_WORDS - {"discussion"} if inside_main else AROUND_WORDS
    names = [(own, n) for n in (*known.get("class", "").split(), known.get("role", ""))]
    if name not in HEADINGS:
        names.append((READERS if inside_main else AROUND_WORDS - SECTIONS, known.get("id", "")))
    for marked, whole in names:
        each = words_of(whole)
        if marked.intersection(each) and all(w in AROUND_WORDS or w in PLAIN_WORDS for w in each):
            return True
    return False


def features(kind: int, name: str, attrs: str) -> list[str]:
    if kind == CLOSE:
        return [f"/{name}"]
    return [f"{name}.{w}" for w in marks(attrs)] or [name]


def wrapping(stream: list[tuple[int, str, str]], ends: dict[int, int]) -> Callable[[int], bool]:
    """Whether the element that begins at a token has the page's text in it, whatever it is called.

    That is, the largest ``article`` or ``main`` element, or the one inside it with most of its words; on a page without these, most of the words.
    """
    words = [0]
    for kind, _, rest in stream:
        words.append(words[-1] + (len(rest.split()) if kind == TEXT else 0))
    inside = lambda i: words[ends[i]] - words[i]
    marked = sorted(i for i in ends if stream[i][1] in MAIN)
    if not marked:
        return lambda i: 2 * inside(i) > words[-1]
    target = max(marked, key=lambda i: (inside(i), -i))
    for i in marked:
        if target < i and ends[i] < ends[target] and 2 * inside(i) > inside(target):
            target = i
    return lambda i: i < target and ends[target] < ends[i]


def pruned(page: str) -> list[tuple[int, str, str]]:
    """The page's tokens without the elements around the main text; an element with that text in it stays, for the scan to decide."""
    stream = tokens(page)
    ends = partners(stream)
    wraps = wrapping(stream, ends)
    out, i, mains = [], 0, []
    while i < len(stream):
        kind, name, attrs = stream[i]
        if kind == OPEN:
            while mains and mains[-1] < i:
                mains.pop()
            if i in ends and around(name, attrs, bool(mains)) and not wraps(i):
                i = ends[i] + 1
                out.append((OPEN, "hr", ""))  # a break of the text
                continue
            if name in MAIN and i in ends:
                mains.append(ends[i])
        out.append(stream[i])
        i += 1
    return out


class Weights:
    """Scores of tokens: words from 0 to 1, tags below 0, by how often labelled pages have them inside the main text."""

    def __init__(self, inside: dict[str, float]):
        self.inside = inside

    def word(self, link: bool) -> float:
        return max(0.05, self.inside.get("#link" if link else "#word", 0.9))

    def tag(self, kind: int, name: str, attrs: str) -> float:
        odds = [self.inside[f] for f in features(kind, name, attrs) if f in self.inside]
        inside = min(odds) if odds else 0.8
        if not odds and kind == OPEN:
            # a name that no labelled page has: its words tell, but do not decide
            inside = 0.0 if around(name, attrs, False) else 0.4 if AROUND_WORDS.intersection(marks(attrs)) else 0.8
        return -0.05 - 4.0 * (1 - inside) ** 2


def counted(page: str) -> tuple[Counter, Counter]:
    """Features inside and outside the main text of a page that marks it by an element; nothing of other pages."""
    stream = tokens(page)
    ends = partners(stream)
    spans = [(i, ends[i]) for i, t in enumerate(stream) if t[0] == OPEN and t[1] in MAIN and i in ends]
    inside, outside = Counter(), Counter()
    if not spans:
        return inside, outside
    a, b = max(spans, key=lambda s: s[1] - s[0])
    links = 0
    for i, (kind, name, rest) in enumerate(stream):
        to = inside if a < i < b else outside
        if kind == TEXT:
            to["#link" if links > 0 else "#word"] += len(rest.split())
        elif name != "#raw":
            links += {OPEN: 1, CLOSE: -1}[kind] if name == "a" else 0
            to.update(features(kind, name, rest))
    return inside, outside


def learnt(pages: DataFrame, sample: int = LABELLED_PAGES) -> dict[str, float]:
    """Share of each feature's occurrences inside the main text, over pages that mark it, drawn by a hash of the page.

    Pages with an ``article`` or ``main`` element are the labelled ones.  About ``sample`` of them are read;
    the features that these have LEAST_COUNT times or more come to the driver.
    """
    labelled = pages.filter(F.col("html").rlike("(?i)<(article|main)\\b")).select("html", F.xxhash64("html").alias("print"))
    n = labelled.count()
    drawn = labelled.filter(F.pmod("print", F.lit(max(1, n))) < sample).select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                a, b = counted(page)
                inside.update(a)
                outside.update(b)
        names = sorted({*inside, *outside})
        yield pa.RecordBatch.from_pydict(
            {"feature": pa.array(names, pa.string()), "a": pa.array([inside[x] for x in names], pa.int64()), "b": pa.array([outside[x] for x in names], pa.int64())}
        )

    sums = drawn.mapInArrow(count, "feature string, a bigint, b bigint").groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    known = sums.filter(F.col("a") + F.col("b") >= LEAST_COUNT).collect()
    return {r["feature"]: (r["a"] + 1) / (r["a"] + r["b"] + 2) for r in known}


def main_text(page: str, weights: Weights) -> str:
    """The blocks of the best run, each with its white space made one space, joined by line feeds."""
    stream = pruned(page)
    word, link = weights.word(False), weights.word(True)
    best, total, start, region, links = 0.0, 0.0, 0, (0, 0), 0
    known: dict[tuple[int, str, str], float] = {}
    for i, token in enumerate(stream):
        kind, name, rest = token
        if kind == TEXT:
            score = len(rest.split()) * (link if links > 0 else word)
        else:
            if name == "a":
                links = max(0, links + (1 if kind == OPEN else -1))
            score = known.get(token)
            if score is None:
                score = known[token] = weights.tag(kind, name, rest)
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, region = total, (start, i + 1)
    blocks, block = [], []
    a, b = grown(stream, *region)
    for kind, name, rest in stream[a:b]:
        if kind == TEXT:
            block.append(html.unescape(rest))
        elif name in BLOCKS:
            blocks.append("".join(block))
            block = []
        elif name in ("br", "#raw"):
            block.append(" ")
    blocks.append("".join(block))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def extract(pages: DataFrame, inside: dict[str, float] | None = None) -> DataFrame:
    """The columns of ``pages`` but ``html``, and ``text`` and ``n_chars`` of its main text.

    Comments, scripts, styles and other raw elements go, and with them the elements that by name, class, id or role stand around
    the text: menus, footers, page headers, side bars, notices, adverts, forms and reader comments; not one that wraps the article or, on a page without, most of its words.  Over what is left one linear scan
    finds the contiguous run of tokens with the largest score; its weights (``inside``) are learnt from ``pages`` if not given.  If the run
    ends within an ``article`` or ``main`` element, it takes all of that.

    A null or empty page, and one without words, has the empty text.  An element that is never closed takes nothing with it, but for
    scripts, styles, text areas and titles, which take the rest as in a browser.  The
    earliest of equally good runs wins.  Repeated rows give equal texts; an empty table gives an empty table; columns of the input named as
    in ``OUTPUT`` are replaced.
    """
    inside = learnt(pages) if inside is None else inside
    rest = without(pages, *OUTPUT, "html").columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(inside)
        for batch in batches:
            texts = [main_text(page, weights) if page else "" for page in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*rest, *OUTPUT],
            )

    kept = pages.select(*quoted(rest), "html")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    return kept.mapInArrow(run, ", ".join([*fields, "text string", "n_chars bigint"]))
