"""Main text of pages: a recurrent labeller over the page's blocks.

A page becomes the sequence of its blocks of text. A bidirectional LSTM reads for each block hashed vectors of its tag
path (tags, classes and ids) and of its words and a few figures, and so judges a block by the whole page around it.

It learns from a bounded sample of pages, in which blocks below telling elements (an article, a menu, a footer, ...) are
labelled, and from composed pages with the furniture that the sample may lack. Only these labels come from lists of
names; the network reads hashed names. In a part of the examples most or all names are taken away, so that place, words
and link density have to do.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import lstm
from tidemark.llm.common import bounded_sample, query, slices, table

#: Bound on the pages that the labeller is fitted on.
SAMPLE_PAGES = 240
#: Sizes of the hashed path and word vectors.
PATH, WORDS = 128, 64
_FIGURES = 6

# Element kinds of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split())
_SILENT = frozenset("script style template noscript svg iframe object canvas textarea audio video title".split())
#: What can stand in a head; all else ends it.
_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: Elements that end without an end tag of their own.
_ENDLESS = frozenset("html body p li dt dd tr td th thead tbody tfoot caption option".split())
_RAW = {n: re.compile(rf"</{n}\b[^>]*>?", re.I) for n in ("script", "style", "textarea", "title", "iframe", "noscript", "template", "svg")}
_OPENS = {n: re.compile(rf"<{n}\b", re.I) for n in _RAW}
_CLOSES_P = _BLOCK - {"body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "legend", "button", "title"}
# Attributes as the standard reads them: a quote opens a value only where the value begins.
_VALUE = r"""(?>"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)"""
_PIECE = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE}?)?+)*+)(?:>|\Z)", re.S)
_RESUME = re.compile(r"</?(?:head|body|main|article)\b", re.I)
_MAY_TELL = re.compile(r"class|id|role|hidden|style", re.I)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>"'][^\s>]*))?)?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_PART = re.compile(r"[A-Za-z]+")

#: Words in element, class and id names that tell what a block is not, and what it is.
FURNITURE = frozenset(
    "nav navigation navbar menu header footer aside sidebar form login signup subscribe newsletter search button ad ads advert "
    "advertisement banner sponsor sponsored promo cookie cookies consent notice alert popup modal comment comments reply replies "
    "disqus respond share sharing social related recommended breadcrumb breadcrumbs pagination pager toolbar widget copyright "
    "dialog select".split())
CONTENT = frozenset("article main content post entry story body text".split())
_NAMES_OF_TAGS: dict[tuple[str, str], tuple] = {}


def _hides(held: dict[str, str]) -> bool:
    """Whether there is ``hidden`` (but not until it is found), a true ``aria-hidden``, or a style without display."""
    state = held.get("hidden", "until-found").strip().lower()
    return state != "until-found" or held.get("aria-hidden", "").strip().lower() == "true" or bool(_NO_DISPLAY.search(held.get("style", "")))


def _element(tag: str, attributes: str) -> tuple[tuple[str, ...], bool]:
    """Lower-case words of the tag, its classes, ids and role; whether it is hidden."""
    found = _NAMES_OF_TAGS.get((tag, attributes))
    if found is None:
        if len(_NAMES_OF_TAGS) > 50_000:
            _NAMES_OF_TAGS.clear()
        held: dict[str, str] = {}
        if _MAY_TELL.search(attributes):
            for m in _ATTRIBUTE.finditer(attributes):  # the first of a name holds
                held.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        words = [w.lower() for n in held if n in ("class", "id", "role") for w in _PART.findall(held[n])]
        found = (("<" + tag, *words), bool(held) and _hides(held))
        _NAMES_OF_TAGS[tag, attributes] = found
    return found


class Path:
    """The open elements of a place in a page. Places with the same elements are one object, which knows the one above.

    What a path tells is made from the path above it once, so that a page of any depth costs the same per element.
    """

    __slots__ = ("below", "vector", "article", "content", "furniture")

    def __init__(self, above: Path | None = None, names: tuple[str, ...] = ()):
        self.below: dict[tuple, Path] = {}
        if above is None:
            self.vector = np.zeros(PATH, np.float32)
            self.article = self.content = self.furniture = False
            return
        words = [w.lstrip("<") for w in names]
        found = FURNITURE.intersection(words)
        self.article = above.article or names[0] == "<article"
        self.content = above.content or any(w in CONTENT and w != "body" for w in words)
        # The header of an article holds its title.
        self.furniture = above.furniture or bool(found - {"header"} if self.article else found)
        cells = [_hash(w, PATH) for w in names]
        self.vector = above.vector
        if not self.vector[cells].all():  # else it is shared with the path above
            self.vector = self.vector.copy()
            self.vector[cells] = 1

    def then(self, names: tuple[str, ...]) -> Path:
        found = self.below.get(names)
        if found is None:
            global _PATHS_MADE
            _PATHS_MADE += 1
            self.below[names] = found = Path(self, names)
        return found


def _hash(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % size


_ROOT, _PATHS_MADE = Path(), 0


def root() -> Path:
    """The path of a page without an open element; known paths are dropped between pages when there are many."""
    global _ROOT, _PATHS_MADE
    if _PATHS_MADE > 50_000:
        _ROOT, _PATHS_MADE = Path(), 0
    return _ROOT


def path_of(names: tuple) -> Path:
    path = root()
    for n in names:
        path = path.then(n)
    return path


def blocks(page: str | None) -> list[tuple[str, Path, int]]:
    """(text, path, characters inside links) of every block, in page order; references decoded, white space folded.

    Scripts, styles, titles and hidden elements have no block,
    but for a silent element whose end tag is missing: nothing tells where it ends, so its content stays. A script or
    style without an end tag runs to the next tag of a head, body, main or article, or else to the end.
    """
    page = page or ""
    out: list = []
    top = root()
    stack: list[tuple[str, Path, tuple | None]] = []
    opened: Counter = Counter()
    links = heads = 0
    pieces: list[str] = []
    linked = 0

    def flush():
        nonlocal linked, pieces
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append((text, stack[-1][1] if stack else top, linked))
            pieces = []
        linked = 0

    def pop(ended=False):
        """Close the last element; a silent one that is really at its end takes back what it added."""
        nonlocal links, heads, linked, pieces
        tag, _, before = stack.pop()
        opened[tag] -= 1
        links -= tag == "a"
        heads -= tag == "head"
        if before and (ended or tag in _ENDLESS):
            size, pieces, length, linked = before
            del out[size:], pieces[length:]

    def end_head():
        flush()
        while heads:
            pop()

    at = 0
    ahead: dict[tuple[int, str], re.Match | None] = {}

    def following(kind: dict, tag: str):
        """The next match of the kind's pattern for the tag; looked for again only after it is passed."""
        name = id(kind), tag
        if name not in ahead or (ahead[name] and ahead[name].start() < at):
            ahead[name] = kind[tag].search(page, at)
        return ahead[name]

    while at < len(page):
        low = page.find("<", at)
        m = _PIECE.match(page, low) if low >= 0 else None
        while low >= 0 and not m:  # a lone '<' is text
            low = page.find("<", low + 1)
            m = _PIECE.match(page, low) if low >= 0 else None
        stop = low if low >= 0 else len(page)
        if stop > at:
            text = page[at:stop]
            if stack and stack[-1][0] == "head" and not text.isspace():
                end_head()
            pieces.append(text)
            if links:
                linked += len(text)
        if not m:
            break
        at = m.end()
        if m[1] is None:
            continue
        tag = m[1].lower()
        if page[m.start() + 1] == "/":
            if opened[tag]:
                last = None
                while last != tag:
                    last = stack[-1][0]
                    if last in _BLOCK:
                        flush()
                    pop(last == tag)
            continue
        if heads and tag not in _HEAD:
            end_head()
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _BLOCK:
            flush()
            if tag in _CLOSES_P and opened["p"]:
                while stack and stack[-1][0] != "p" and stack[-1][0] not in _BLOCK:
                    pop()
                if stack and stack[-1][0] == "p":
                    pop()
            elif tag in ("li", "tr", "td", "th", "option", "dt", "dd") and stack and stack[-1][0] == tag:
                pop()
        names, hidden = _element(tag, m[2])
        if m[2].endswith("/") and tag in ("svg", "path"):
            continue
        quiet = tag in _SILENT or hidden
        if tag in _RAW:
            end = following(_RAW, tag)
            if tag in ("script", "style"):
                resume = None if end else _RESUME.search(page, at)
                at = end.end() if end else resume.start() if resume else len(page)
                continue
            again = following(_OPENS, tag) if end else None
            if end and not (again and again.start() < end.start()):
                at = end.end()
                continue
        stack.append((tag, (stack[-1][1] if stack else top).then(names), (len(out), pieces, len(pieces), linked) if quiet else None))
        opened[tag] += 1
        links += tag == "a"
        heads += tag == "head"
    flush()
    return out


def weak_label(path: Path) -> int:
    """0 below furniture, 1 below an article or content element, -1 if nothing tells."""
    return 0 if path.furniture else 1 if path.content else -1


class _Buckets(dict):
    """Bucket of a word, kept for up to half a million words."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        self[word] = found = _hash(word, WORDS)
        return found


_BUCKETS = _Buckets()


def vectors(found: list) -> np.ndarray:
    """One row per block: path, words, figures."""
    n = len(found)
    x = np.zeros((n, PATH + WORDS + _FIGURES), np.float32)
    words = [text.split(" ") for text, _, _ in found]
    sizes = np.fromiter(map(len, words), np.int64, n)
    cells = np.fromiter((b for w in words for b in map(_BUCKETS.__getitem__, w)), np.int64, int(sizes.sum()))
    counts = np.bincount(cells + WORDS * np.repeat(np.arange(n), sizes), minlength=n * WORDS).reshape(n, WORDS)
    x[:, PATH:PATH + WORDS] = counts / sizes[:, None]
    x[:, PATH + WORDS] = np.log1p(sizes) / 5
    x[:, PATH + WORDS + 1] = [min(1.0, linked / len(text)) for text, _, linked in found]
    x[:, PATH + WORDS + 2] = [text[-1] in ".!?…\"'»" for text, _, _ in found]
    x[:, PATH + WORDS + 3], x[:, PATH + WORDS + 4] = np.arange(n) / n, (n - np.arange(n)) / n
    x[:, PATH + WORDS + 5] = ["©" in text for text, _, _ in found]
    for k, (_, path, _) in enumerate(found):
        x[k, :PATH] = path.vector
    return x


def _composed(rng: random.Random, texts: list[str]) -> tuple[list, list]:
    """A page of furniture around an article, with the true labels."""
    page: list = []
    line = lambda k: " ".join(rng.choice(texts).split()[:k]) or "text"
    frame = (("<html",), ("<body",))

    def put(label, names, count, low, high, inner=(), linked=False):
        for _ in range(count):
            text = line(rng.randint(low, high))
            page.append((text, path_of((*frame, *names, *inner)), len(text) if linked else 0, label))

    li = (("<ul",), ("<li",), ("<a",))
    before = [lambda: put(0, rng.choice([(("<nav",),), (("<div", "menu"),), (("<header",), ("<nav",)), (("<div", "navigation"),)]), rng.randint(2, 8), 1, 2, li, True),
              lambda: put(0, rng.choice([(("<header",),), (("<div", "header"),), (("<div", "banner"),)]), 1, 1, 6),
              lambda: put(0, rng.choice([(("<div", "cookie", "notice"),), (("<div", "notice"),), (("<div", "alert"),), (("<div", "consent"),)]), 1, 5, 20, (("<p",),)),
              lambda: put(0, rng.choice([(("<div", "ad"),), (("<div", "ads"),), (("<aside", "advert"),), (("<div", "sponsored"),)]), 1, 3, 20)]
    after = [lambda: put(0, rng.choice([(("<aside",),), (("<div", "sidebar"),), (("<div", "related"),), (("<div", "widget"),)]), rng.randint(1, 5), 2, 9, li, True),
             lambda: put(0, rng.choice([(("<form",),), (("<form", "newsletter"),), (("<div", "login"), ("<form",))]), rng.randint(1, 3), 1, 6, (("<label",),)),
             lambda: put(0, rng.choice([(("<section", "comments"),), (("<div", "comments"),), (("<div", "comment", "list"),), (("<article",), ("<section", "comments"))]),
                         rng.randint(1, 6), 3, 40, (("<div", "comment"), ("<p",))),
             lambda: put(0, rng.choice([(("<div", "share"),), (("<div", "social"),), (("<article",), ("<div", "share"))]), rng.randint(1, 3), 1, 2, li, True),
             lambda: put(0, rng.choice([(("<footer",),), (("<div", "footer"),)]), rng.randint(1, 2), 2, 14)]
    if rng.random() < 0.1:  # a fragment, nothing but text
        before, after, frame = [], [], rng.choice([frame, ()])
    for f in rng.sample(before, rng.randint(min(1, len(before)), len(before))):
        f()
    body = rng.choice([(("<article",),), (("<main",),), (("<main",), ("<article",)), (("<div", "content"),), (("<div", "post"),), (("<div", "entry", "content"),), (("<div",),), ()])
    put(1, body, 1, 2, 12, rng.choice([(("<h1",),), (("<header",), ("<h1",))]) if body and body[-1][0] == "<article" else (("<h1",),))
    for _ in range(rng.randint(1, 10)):
        kind = rng.random()
        if kind < 0.8:
            put(1, body, 1, 1, 120, (("<p",),))
        elif kind < 0.9:
            put(1, body, rng.randint(1, 4), 2, 20, (("<ul",), ("<li",)))
        else:
            put(1, body, 1, 1, 8, (("<h2",),))
    for f in rng.sample(after, rng.randint(min(1, len(after)), len(after))):
        f()
    return [p[:3] for p in page], [p[3] for p in page]


def fit_labeller(pages: list[str]) -> dict:
    """The network, from pages whose structure tells and from as many composed ones."""
    rng = random.Random(11)
    sequences, labels, texts = [], [], ["the first of all words in a page"]
    for page in pages:
        found = blocks(page)
        label = [weak_label(p) for _, p, _ in found]
        if found:
            sequences.append(vectors(found))
            labels.append(np.array(label, np.float32))
            texts += [t[:2000] for t, _, _ in found[:30]]
    for _ in range(SAMPLE_PAGES):
        found, label = _composed(rng, texts)
        sequences.append(vectors(found))
        labels.append(np.array(label, np.float32))
    noise = np.random.default_rng(5)
    for k in range(0, len(sequences), 5):  # a fifth also with few of the names, and without any
        for share in (0.3, 0):
            blind = sequences[k].copy()
            blind[:, :PATH] *= noise.random(PATH) < share
            sequences.append(blind)
            labels.append(labels[k])
    return lstm.fit(sequences, labels)


def learn_labeller(pages: DataFrame, text: str = "html", key: str = "page_id", rows: int = SAMPLE_PAGES) -> dict:
    ids = bounded_sample(pages.select(F.col(key).alias("sample_id")).dropna().distinct(), "sample_id", rows)
    chosen = pages.select(F.col(key).alias("id"), F.col(text).cast("string").alias("page")).dropna().join(
        F.broadcast(ids), F.col("id") == F.col("sample_id")).select("id", "page").collect()  # at most ``rows`` keys
    return fit_labeller([r["page"] for r in sorted(chosen, key=lambda r: (str(r["id"]), r["page"]))])


def main_texts(net: dict, pages: list) -> list[str]:
    found = [blocks(p) for p in pages]
    keep = lstm.probabilities(net, [vectors(f) if f else np.zeros((0, PATH + WORDS + _FIGURES), np.float32) for f in found])
    return ["\n".join(b[0] for b, p in zip(f, k, strict=True) if p >= 0.5) for f, k in zip(found, keep, strict=True)]


def _extract(net: dict):
    def run(batches):
        for batch in batches:
            for start, stop in slices(batch, "page", 2 << 20):
                part = batch.slice(start, stop - start)
                texts = main_texts(net, part.column("page").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), pa.array(texts), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return run


def extract_text(pages: DataFrame, net: dict, text: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``, whatever repeats.

    A null or empty page, and one without a block of main text, gives an empty text. Other columns are not looked at.
    """
    rows = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), F.col(text).cast("string").alias("page"))
    return rows.mapInArrow(_extract(net), f"page_id {dict(rows.dtypes)['id']}, url string, text string, n_chars long")


@query("op10_html_text")
def op10_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages, learn_labeller(pages))
