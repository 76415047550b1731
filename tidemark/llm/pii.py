"""Personal data: candidate spans, gradient-boosted trees, calibrated thresholds.

Generators with high recall propose overlapping spans. Trees read the format of a span and what stands around it, and
a threshold chosen on held-out examples selects spans. Spans that the base rules accept are always kept; the trees add
others: numbers of local format, spelled-out addresses, keys and tokens.

The trees learn from spans that the base rules accept in a bounded sample of documents, from rewritten forms of them
(a number without its country code, an address with ``[at]``) and, as the other class, from spans that the rules reject
and from broken forms of accepted ones (dates, amounts, versions, codes of words).
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Forest, calibrate, fit_forest
from tidemark.llm.common import bounded_sample, query, slices, table

#: Bound on the documents, and on the examples, that the trees are fitted on.
SAMPLE_DOCUMENTS, SAMPLE_SPANS = 4_000, 6_000
#: Least share of true spans among the held-out examples that a threshold selects.
PRECISION = 0.98
#: Order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "secret")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match starts where its run of digits does, and no match ends inside a run, so no place within one is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?[\[(](?:at|AT)[\])]\s?[A-Za-z0-9-]+(?:\s?(?:[\[(](?:dot|DOT)[\])]|\.)\s?[A-Za-z0-9-]+)+"),
    "phone": re.compile(r"(?<![0-9A-Za-z.+])\(?[0-9]{2,5}\)?(?:[\x20.-]\(?[0-9]{2,5}\)?){1,4}(?![0-9A-Za-z])"),
    "secret": re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}={0,2}"),
}
_NAMED = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|bearer|credential)[\"']?\s*[=:]?\s*[\"']?$")
_HINTS = [re.compile(p, re.I) for p in (r"\b(?:tel|phone|call|mobile|fax|cell)\b", r"\b(?:mail|contact|write)\b",
                                        r"\b(?:card|visa|payment)\b", r"\b(?:ip|host|server|address)\b",
                                        r"\b(?:version|release|chapter|section|page|order|invoice|date|isbn)\b")]


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def accepted(kind: str, text: str) -> bool:
    """Does a match of the kind's base pattern pass its check?"""
    if kind == "ip":
        return all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in text.split("."))
    if kind == "card":
        digits = _digits(text)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(text)) <= 15
    return True


def base_matches(text: str) -> list[tuple[str, int, int]]:
    """All matches of the base patterns, leftmost and without overlap in a kind, before the checks."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        # A match holds one '@' after its local part, so it starts where the run of local characters does.
        low = at
        while low > last and text[low - 1] in _LOCAL:
            low -= 1
        m = _DOMAIN.match(text, at) if low < at else None
        if m:
            found.append(("email", low, m.end()))
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD)):
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text)]
    return found


def candidates(text: str) -> tuple[list, list]:
    """Spans that the base rules accept, and the other proposed spans."""
    matches = base_matches(text)
    base = [x for x in matches if accepted(x[0], text[x[1]:x[2]])]
    kept = set(base)
    more = [x for x in matches if x not in kept and x[2] - x[1] >= 7]
    if "(at" in text or "[at" in text or "(AT" in text or "[AT" in text:
        more += [("email", *m.span()) for m in _LOOSE["email"].finditer(text)]
    if _DIGIT.search(text):
        more += [(kind, *m.span()) for kind in ("phone", "secret") for m in _LOOSE[kind].finditer(text) if m.end() - m.start() >= 7]
    return base, list(dict.fromkeys(more))


def features(kind: str, span: str, before: str, after: str) -> list[int]:
    """Format of the span and its context; ``before`` and ``after`` are up to 32 characters."""
    digits = _digits(span)
    groups = [len(x) for x in re.findall(r"[0-9]+", span)][:6]
    letters = [c for c in span if c.isalpha()]
    hexes = sum(c in "0123456789abcdefABCDEF" for c in span)
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:]))
    seen = len(set(span))
    near = before[-1:] or " "
    return [
        KINDS.index(kind), len(span), len(digits), len(letters), sum(c.isupper() for c in letters), seen, turns, hexes == len(span),
        span.count(" "), span.count("."), span.count("-"), span.count("("), span.count("/"), span.count("_"), len(groups),
        groups[0] if groups else 0, groups[1] if len(groups) > 1 else 0, groups[-1] if groups else 0, max(groups, default=0),
        "@" in span or "[" in span, span.startswith("+"), 13 <= len(digits) <= 19 and luhn(digits),
        all(int(g[:9]) <= 255 for g in re.findall(r"[0-9]+", span)), bool(digits) and 1800 <= int(digits[:4]) <= 2100,
        near.isspace(), near in "\"'=:", near.isalnum(), (after[:1] or " ").isalnum(), bool(_NAMED.search(before)),
        *[bool(h.search(before)) for h in _HINTS]]


def _pieces(text: str, span: tuple) -> tuple[str, str, str, str]:
    kind, a, b = span
    return kind, text[a:b], text[max(0, a - 32):a], text[b:b + 32]


def _generated(rng: random.Random, n: int) -> list[tuple[str, str, str, str, int]]:
    """Labelled spans of common formats, so that every kind is known whatever the sample holds."""
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    w = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8)))
    out = []
    for _ in range(n):
        card = d(15)
        card += next(c for c in "0123456789" if luhn(card + c))
        key = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((32, 40, 64))))
        mixed = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(rng.randint(24, 48)))
        before, after = f"{w()} {w()} ", f" {w()} {w()}"
        named = before + rng.choice(["token = \"", "api_key: ", "secret=", "password = '"])
        good = [("email", f"{w()} [at] {w()} [dot] com"), ("email", f"{w()}(at){w()}.org"), ("email", f"{w()}.{w()}@{w()}.com"),
                ("phone", f"({d(3)}) {d(3)}-{d(4)}"), ("phone", f"{rng.randint(2, 9)}{d(2)}-{d(3)}-{d(4)}"),
                ("phone", f"+{rng.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}"), ("ip", ".".join(str(rng.randint(0, 255)) for _ in range(4))),
                ("card", card), ("card", " ".join(card[i:i + 4] for i in range(0, 16, 4)))]
        bad = [("phone", f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"), ("phone", f"{d(2)} {d(2)} {d(2)}"),
               ("phone", f"{rng.randint(1900, 2030)}-{rng.randint(1900, 2030)}"), ("phone", f"{d(3)}.{d(3)}"), ("phone", f"{d(2)}.{d(2)}.{d(4)}"),
               ("phone", f"{d(3)} {d(3)} {d(3)} {d(3)}"), ("ip", f"{rng.randint(256, 999)}.{d(3)}.{d(1)}.{d(4)}"), ("card", d(rng.choice((8, 10, 12, 14, 16, 20)))),
               ("secret", f"{w()}-{w()}-{w()}-{w()}-{d(2)}"), ("secret", f"{w()}/{w()}/{w()}/{w()}{d(1)}"), ("secret", f"{w()}_{w()}_{w()}{w()}_{d(3)}"),
               ("secret", d(rng.randint(20, 30)))]
        bad = [x for x in bad if not (x[0] == "card" and accepted(*x))]
        out += [(k, s, before, after, 1) for k, s in good] + [(k, s, before, after, 0) for k, s in bad]
        # What the words before a number say about it, and paths and names that are no keys.
        call, number = before + rng.choice(["call ", "phone: ", "tel ", "Mobile "]), before + rng.choice(["order ", "invoice ", "Order no ", "ISBN ", "version "])
        groups = rng.choice([f"{d(3)} {d(3)} {d(4)}", f"{d(3)}-{d(4)}-{d(4)}", f"{d(4)} {d(6)}"[:11], f"{d(5)} {d(5)}"])
        isbn = f"97{rng.choice('89')}-{d(1)}-{d(2)}-{d(6)}-{d(1)}"
        path = "/" + "/".join(w() + rng.choice(["", "", d(1), d(2)]) for _ in range(rng.randint(3, 7))) + d(1)
        out += [("phone", groups, call, after, 1), ("phone", groups, number, after, 0), ("secret", path, before, after, 0)]
        out += [("card", isbn, rng.choice([before, number]), after, 0)] * (not accepted("card", isbn))
        out += [("secret", key, named, "\"", 1), ("secret", mixed + d(2), named, "", 1), ("secret", mixed + d(1), before, after, 1), ("secret", key, before, after, 1)]
    return out


def _variants(kind: str, span: str, before: str, after: str) -> list[tuple[str, str, str, str, int]]:
    out = [(kind, span, before, after, 1)]
    if kind == "email":
        out.append((kind, span.replace("@", " [at] "), before, after, 1))
    elif kind == "phone":
        local = re.sub(r"^\+[0-9]+[\x20-]?", "", span)
        if 9 <= len(_digits(local)):
            out.append((kind, local, before, after, 1))
    elif kind == "ip":
        out.append((kind, "999" + span[span.index("."):], before, after, 0))
    return out


def fit_selector(examples: list[tuple[str, str, str, str, int]], precision: float = PRECISION) -> tuple[Forest, dict[str, float]]:
    """Trees and a threshold for every kind; examples (kind, span, before, after, label) are split by a hash of their text.

    A threshold is the least one, from a half on, above which the held-out examples of the kind reach the precision. A
    kind that has none, or no held-out example of its own, is not added to the base spans.
    """
    x = np.array([features(*e[:4]) for e in examples], np.int64)
    y = np.array([e[4] for e in examples], float)
    part = np.array([hashlib.md5("|".join(e[:3]).encode("utf-8", "surrogatepass")).digest()[0] % 4 for e in examples])
    forest = fit_forest(x[part != 0], y[part != 0])
    calibrate(forest, x[part == 0], y[part == 0])
    p = forest.probability(x[part == 0])
    thresholds = {}
    for k, kind in enumerate(KINDS):
        own = x[part == 0][:, 0] == k
        order = np.flatnonzero(own)[np.argsort(-p[own], kind="stable")]
        share = np.cumsum(y[part == 0][order]) / np.arange(1, len(order) + 1)
        # Equal probabilities are selected together.
        last = np.append(p[order][1:] != p[order][:-1], True)[:len(order)]
        good = np.flatnonzero((share >= precision) & last)
        # Halfway to the next example below, or a half where there is none.
        thresholds[kind] = max(0.5, float(p[order][good[-1]:good[-1] + 2].mean())) if len(good) and good[-1] + 1 < len(order) else 0.5 if len(good) else 1.1
    return forest, thresholds


class Intervals:
    """Disjoint intervals in order; those that overlap an added one become one with it."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, a: int, b: int) -> bool:
        k = bisect.bisect_right(self.ends, a)
        return k == len(self.ends) or self.starts[k] >= b

    def add(self, a: int, b: int) -> None:
        low, high = bisect.bisect_right(self.ends, a), bisect.bisect_left(self.starts, b)
        if low < high:
            a, b = min(a, self.starts[low]), max(b, self.ends[high - 1])
        self.starts[low:high], self.ends[low:high] = [a], [b]


def select_spans(text: str | None, forest: Forest, thresholds: dict[str, float]) -> tuple[list, list]:
    """Base spans, and all spans: base ones and the selected others that overlap neither these nor a surer one."""
    base, more = candidates(text or "")
    taken = Intervals()
    for _, a, b in sorted(base, key=lambda s: s[1]):
        taken.add(a, b)
    # An address or a card that fails its check is none; what it holds may still be a number of another kind.
    more = [s for s in more if s[0] not in ("ip", "card") and taken.free(s[1], s[2])]
    chosen = []
    if more:
        p = forest.probability(np.array([features(*_pieces(text, s)) for s in more], np.int64))
        for k in sorted(range(len(more)), key=lambda k: (-p[k], more[k][1])):
            kind, a, b = more[k]
            if p[k] >= thresholds[kind] and taken.free(a, b):
                chosen.append(more[k])
                taken.add(a, b)
    order = lambda s: (KINDS.index(s[0]), s[1])
    return sorted(base, key=order), sorted(base + chosen, key=order)


def _example_rows(batches):
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            text = text.as_py()
            base, more = candidates(text)
            rows += [(*_pieces(text, s), 1) for s in base]
            # A rejected number is an example of the other class; spans of the loose patterns are left undecided.
            rows += [(*_pieces(text, s), 0) for s in more if s[0] in ("ip", "card")]
        cols = list(zip(*rows, strict=True)) or [[], [], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols[:4]] + [pa.array(cols[4], pa.int64())],
                                         ["kind", "span", "before", "after", "label"])


def learned(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[Forest, dict[str, float]]:
    ids = bounded_sample(docs.select(F.col(key).alias("sample_id")).dropna().distinct(), "sample_id", SAMPLE_DOCUMENTS)
    chosen = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).dropna().join(
        F.broadcast(ids), F.col("id") == F.col("sample_id")).select("text")  # at most SAMPLE_DOCUMENTS keys
    rows = chosen.mapInArrow(_example_rows, "kind string, span string, before string, after string, label long").orderBy(
        F.md5(F.concat("span", "before", "after")), "kind").limit(SAMPLE_SPANS).collect()
    examples = [v for r in rows for v in ([tuple(r)] if not r["label"] else _variants(*tuple(r)[:4]))]
    return fit_selector(examples + _generated(random.Random(7), 150))



def _listed(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str | None, spans: list) -> str | None:
    """The text with every span replaced by its kind in brackets; spans that touch or overlap become one."""
    if not spans:
        return text
    out, last, end = [], 0, -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a > end:
            out += [text[last:a], f"[{kind.upper()}]"]
        last = end = max(end, b)
    return "".join(out) + text[last:]


def _find(text: str, forest: Forest, thresholds: dict[str, float], clean: bool):
    def run(batches):
        for batch in batches:
            for start, stop in slices(batch, text):
                part = batch.slice(start, stop - start)
                cols: list[list] = [[] for _ in range(7)]
                for t in part.column(text):
                    t = t.as_py()
                    base, spans = select_spans(t, forest, thresholds)
                    for col, value in zip(cols, [*(sum(s[0] == k for s in base) for k in KINDS[:4]), hashlib.sha256(
                            _listed(base).encode()).hexdigest(), _listed(spans), redact(t, spans) if clean else None], strict=True):
                        col.append(value)
                arrays = [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(c, pa.string()) for c in cols[4:]]
                if clean:  # the text is replaced, all other columns pass
                    place = part.schema.get_field_index(text)
                    yield part.set_column(place, part.schema.field(place).with_type(pa.string()), arrays[-1])
                else:
                    yield pa.RecordBatch.from_arrays([part.column("id"), *arrays[:-1]], [
                        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return run


def find_pii(docs: DataFrame, text: str = "text", key: str = "doc_id", model: tuple | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row per row of ``docs``.

    Counts and the digest are of the base spans, ``spans`` lists all. A null text counts as empty. Rows without a key or
    with a repeated one are rows like others. Other columns are not looked at.
    """
    forest, thresholds = model or learned(docs, text, key)
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(_find("text", forest, thresholds, False), f"doc_id {kind}, n_email long, n_ip long, n_card long, "
                           "n_phone long, base_sha256 string, spans string")


def redacted(docs: DataFrame, text: str = "text", key: str = "doc_id", model: tuple | None = None) -> DataFrame:
    """``docs`` with every span in the text replaced by its kind in brackets; a null text stays null."""
    forest, thresholds = model or learned(docs, text, key)
    return docs.mapInArrow(_find(text, forest, thresholds, True), docs.schema)


@query("op5_pii")
def op5_pii(spark, sf_dir):
    return find_pii(table(spark, sf_dir, "documents"))


def pii_stage(spark, docs, sf_dir):
    """All documents, personal data replaced; ``n_chars`` follows the new text where the table has that column."""
    out = redacted(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out
