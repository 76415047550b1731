"""Exact copies, fill-in-the-middle and periodic runs against plain Python."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import exact_dups, fill_in_middle, periodic_runs
from tidemark.llm.queries import QUERIES

ODD = [None, "", " \t\n", "word", "Ünï cödé 日本語 x", "a" * 3000, "x. " * 4000, "\n\n\na\n", "a <P> b\nc", "<S", "S>\n<", "<M>"]
SCHEMA = "doc_id long, text string, digest string, Word string, key string, id long"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "d", "w", "k", 5) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_copies(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = collections.defaultdict(list)
    for k, t in enumerate(norm):
        groups[t].append(k)
    out = []
    for t, members in groups.items():
        first = min(members, key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
        out += [(rows[k][0], rows[first][0], len(members), k == first, sha(t)) for k in members]
    return collections.Counter(out)


@pytest.mark.parametrize("words", [exact_dups.MOST_WORDS, 1])
def test_exact_duplicates(spark, words):
    rng = random.Random(2)
    texts = [*ODD, "word ", " word", "a\tb", "a \r\n b", "a b", "\x0ba b"]
    rows = list(enumerate(texts))
    rows += [(rng.randrange(10**6), rng.choice(texts)) for _ in range(60)] + [(1000 + i, f"text {i}") for i in range(400)]
    rows += [(5, "a b"), (5, "a b"), (None, "a  b"), (None, "alone"), (None, "pair"), (None, "pair")]
    out = exact_dups.exact_duplicates(frame(spark, [t for _, t in rows], [i for i, _ in rows]), most_words=words)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(tuple(r) for r in out.collect()) == brute_copies(rows)
    assert exact_dups.exact_duplicates(frame(spark, [])).count() == 0


def test_exact_duplicates_of_a_hot_text(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i // 2}") for i in range(6000)]
    rng = random.Random(4)
    rng.shuffle(rows)
    out = exact_dups.exact_duplicates(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert collections.Counter(tuple(r) for r in out) == brute_copies(rows)


def test_what_is_grouped_without_need(spark):
    """Of different texts only a few pass for repeated ones, and no repeated one is overlooked."""
    docs = spark.range(20_000).selectExpr("id", "unhex(sha2(cast(least(id, 19000) as string), 256)) as digest", "id as row")
    places = exact_dups.placed(docs, exact_dups.filter_words(20_000))
    bits = {r["filter_word"]: r["twice"] for r in exact_dups.repeated_bits(places).collect()}
    maybe = [r["id"] for r in places.collect() if bits.get(r["word"], 0) & r["mask"] == r["mask"]]
    assert set(range(19000, 20000)) <= set(maybe) and len(maybe) - 1000 < 0.05 * 19_000


def test_plan_has_no_python(spark):
    out = exact_dups.exact_duplicates(frame(spark, ["a", "b", "a"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Arrow|Python|Pandas", plan)


def brute_middle(text, key):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "é", "\n", "<", ">", "<P", "S>", "M", "😀", "\r"]), max_size=40).map("".join), st.one_of(st.none(), st.integers(-5, 10**12)))
def test_fill_in_middle_of_any_text(text, key):
    made = fill_in_middle.transform(text.encode(), key)
    assert (*made[:4], made[4].decode()) == brute_middle(text, key)
    assert fill_in_middle.restore(made[4], made[1]) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60), st.integers(0, 60), st.integers(0, 60), st.integers(1, 7))
def test_rotation(data, a, b, step):
    low, middle = sorted((min(a, len(data)), min(b, len(data))))
    buffer, held = bytearray(data), fill_in_middle._STEP
    fill_in_middle._STEP = step
    try:
        fill_in_middle.rotate(buffer, low, middle, len(buffer))
    finally:
        fill_in_middle._STEP = held
    assert bytes(buffer) == data[:low] + data[middle:] + data[low:middle]


def test_fill_in_middle(spark):
    rng = random.Random(3)
    texts = [*ODD, *("\n".join("line é" * rng.randint(0, 9) for _ in range(rng.randint(1, 20))) for _ in range(60)), "é\n" * 200_000]
    ids = [*range(len(texts) - 2), None, 0]
    out = fill_in_middle.restored(fill_in_middle.fill_in_middle(frame(spark, texts, ids))).collect()
    want = [(i, *brute_middle(t or "", i), t or "") for i, t in zip(ids, texts, strict=True)]
    assert sorted((tuple(r) for r in out), key=str) == sorted(want, key=str)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    none = fill_in_middle.fill_in_middle(frame(spark, texts, ids), rate=0)
    assert {r["form"] for r in none.collect()} == {"plain"}
    assert fill_in_middle.restored(fill_in_middle.fill_in_middle(frame(spark, []))).count() == 0
    for form, broken in (("psm", b"<P>a<S>b"), ("spm", b"<P>a<S>b<M>c"), ("psm", b"x<P>a<S>b<M>c")):
        with pytest.raises(ValueError):
            fill_in_middle.restore(broken, form)


def brute_runs(w, exponent=4, least=6):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            k = i
            while k + q < len(w) and w[k] == w[k + q]:
                k += 1
            if k + q - i >= max(least, exponent * q):
                found.setdefault((i, k + q), q)
            i = k + 1
    return sorted(((i, j - i, q) for (i, j), q in found.items()), key=lambda r: (r[0], r[2]))


def runs_of(documents, **rule):
    ids, starts = periodic_runs.numbered(documents)
    i, j, q = periodic_runs.find_runs(ids, starts, **rule)
    edges = np.searchsorted(i, starts)
    return [[(int(i[x] - starts[k]), int(j[x] - i[x]), int(q[x])) for x in range(edges[k], edges[k + 1])] for k in range(len(documents))]


def planted(rng):
    words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 9, 99])) for _ in range(rng.choice([0, 1, 5, 20, 60, 120]))]
    for _ in range(rng.randint(0, 4)):
        if words:
            a, p = rng.randrange(len(words)), rng.randint(1, 9)
            words[a:a] = words[a:a + p] * rng.randint(1, 12)
    return words


def test_runs():
    rng = random.Random(5)
    documents = [planted(rng) for _ in range(1500)]
    assert runs_of(documents) == [brute_runs(w) for w in documents]
    assert runs_of(documents[:300], exponent=5, least=8) == [brute_runs(w, 5, 8) for w in documents[:300]]
    assert runs_of([]) == [] and runs_of([[], []]) == [[], []]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=70), max_size=4))
def test_runs_of_few_words(documents):
    assert runs_of(documents) == [brute_runs(w) for w in documents]


def test_grammar():
    rng = random.Random(6)
    documents = [planted(rng) for _ in range(200)]
    ids, starts = periodic_runs.numbered(documents)
    grammar = periodic_runs.Grammar(ids, starts)
    assert len(grammar.rule) == sum(max(0, len(w) - 1) for w in documents)  # one tree each
    expansions = {}
    for rule, b, m, e in zip(grammar.rule, grammar.begin, grammar.middle, grammar.end, strict=True):
        assert b < m < e and expansions.setdefault(int(rule), (ids[b:e].tolist(), m - b)) == (ids[b:e].tolist(), m - b)
        assert np.searchsorted(starts, b, "right") == np.searchsorted(starts, e - 1, "right")
    one = periodic_runs.Grammar(*periodic_runs.numbered([[b"a", b"b", b"c"] * 4096]))
    assert len(set(one.rule.tolist())) < 60  # repeated words share their rules


@pytest.mark.parametrize("words", [[b"a"] * 200_000, [b"%d" % (i % 997) for i in range(200_000)], [b"a" if i % 2 else b"%d" % (i * 7919 % 65537) for i in range(100_000)]])
def test_long_texts(words):
    found = runs_of([words])[0]
    q = next((q for q in (1, 997) if words[:-q] == words[q:]), None)
    assert found == ([(0, len(words), q)] if q else [])


def brute_row(key, text):
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    n, h = len(words), zlib.crc32(str(key).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + size for s, size, q in runs)]
    return (key, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(kept)))


def test_periodic_runs(spark):
    rng = random.Random(7)
    texts = [*ODD, *(b" ".join(planted(rng)).decode() + rng.choice(["", " ", "\n"]) for _ in range(200)), *ODD[:3]]
    rows = periodic_runs.periodic_runs(frame(spark, texts)).collect()
    for r in rows:
        words = [x for x in re.split(r"[\x20\x09-\x0D]+", texts[r["doc_id"]] or "") if x]
        assert r["n_words"] == len(words) and [tuple(x) for x in r["runs"]] == brute_runs([w.encode() for w in words])
    assert len(rows) == len(texts)
    assert periodic_runs.periodic_runs(frame(spark, [None, "b b b b b b b"], [None, None])).select("collapsed").collect()[1][0] == "b"
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def test_query_of_periodic_runs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    small = {r["doc_id"]: r["text"] for r in docs if len(r["text"] or "") < 20_000}
    out = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    assert len(out) == len(docs) and len(small) > 150
    assert all(out[i] == brute_row(i, t) for i, t in small.items())
    assert any(r[1] for r in out.values())
