"""The text operators against plain Python on small tables with nulls, empty texts, repeats and clashing columns."""

import collections
import hashlib
import math
import random
import re
import time
import unicodedata
import zlib

import numpy as np
import pytest
import xxhash

from tidemark.llm import decontamination, html_text, language, lstm, near_dups, packing, pii, quality, toxicity, warc
from tidemark.llm.common import fold_of
from tidemark.llm.crf import forward_backward
from tidemark.llm.token_counts import Counter, character_classes, count_tokens, odd_characters

ODD = [None, "", " \t\n", "word", "Ünïcödé ΟΔΥΣΣΕΥΣ 日本語", "<|endoftext|> it's 'really <|x|>", "a" * 3000, "x. " * 4000]
SCHEMA = "doc_id long, text string, words string, Key string, n_words long"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "k", None) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "ti", "es"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def test_token_counts(spark, library):
    texts = [*ODD, *ODD[3:5]]
    rows = count_tokens(frame(spark, texts), packing.default_tokenizer()).collect()
    assert [r["n_tokens"] for r in rows] == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert [r["n_bytes"] for r in rows] == [len((t or "").encode()) for t in texts]
    assert [r["over_limit"] for r in rows] == [r["n_tokens"] > 2048 for r in rows]
    assert count_tokens(frame(spark, []), packing.default_tokenizer()).count() == 0


def test_transducer_on_random_text(library):
    path = packing.default_tokenizer()
    counter = Counter(path, character_classes(path), odd_characters(path))
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABC'’.,-!? 0189éüßñжд日本\n\t<|>endoftext😀Ᲊ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(800)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.counts(texts).tolist() == [len(e) for e in expected]
    assert [ids.tolist() for ids, _ in counter.encode(texts)] == expected


def brute_marginals(emission, first, move, start):
    out = np.zeros_like(emission)
    bounds = [*np.flatnonzero(first), len(first)]
    for a, b in zip(bounds, bounds[1:], strict=False):
        n, total = b - a, 0.0
        for k in range(emission.shape[1] ** n):
            path = [(k // emission.shape[1] ** i) % emission.shape[1] for i in range(n)]
            w = math.exp(start[path[0]] + sum(emission[a + i, s] for i, s in enumerate(path)) + sum(move[p, q] for p, q in zip(path, path[1:], strict=False)))
            total += w
            for i, s in enumerate(path):
                out[a + i, s] += w
        out[a:b] /= total
    return out


def test_forward_backward():
    rng = np.random.default_rng(2)
    sizes = [1, 5, 3, 6, 2] * 8
    first = np.zeros(sum(sizes), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    emission, move, start = rng.normal(size=(len(first), 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    assert np.allclose(forward_backward(emission, first, move, start)[0], brute_marginals(emission, first, move, start))


def test_language(spark):
    rng = random.Random(1)
    pick = {"aa": ["katu", "lopi", "mura", "tiko"], "bb": ["schwenz", "grubeln", "strachten", "pflotz"]}
    rows = [(i, " ".join(rng.choice(pick[lang]) + rng.choice(["", "s"]) for _ in range(20)), lang) for i in range(120) for lang in [["aa", "bb"][i % 2]]]
    docs = spark.createDataFrame([*rows, (500, None, "aa"), (501, "12 !", "bb"), (None, "katu lopi", None)], "doc_id long, text string, lang string")
    chain = language.learn_languages(docs.where("doc_id < 400"))
    out = {r["doc_id"]: r for r in language.label_languages(docs, chain).collect()}
    assert all(out[i]["lang_pred"] == lang for i, _, lang in rows) and all(0 <= r["score"] <= 1 for r in out.values())
    assert out[500]["lang_pred"] == out[501]["lang_pred"] == "und" and out[None]["lang_pred"] == "aa" and out[None]["held_out"] is False
    assert all(out[i]["held_out"] == (fold_of(i, 4) == 2) for i, _, _ in rows)
    mixed = spark.createDataFrame([(1, "katu lopi mura tiko schwenz grubeln strachten")], "doc_id long, text string")
    assert language.label_languages(mixed, chain).first()["n_runs"] == 2
    assert language.learn_languages(docs.where("doc_id < 0")) is None
    assert language.label_languages(docs, None).where("lang_pred <> 'und'").count() == 0


def base_facts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    seen = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_rules(spark):
    rng = random.Random(3)
    good = [prose(rng, 80) for _ in range(40)]
    junk = [" ".join(f"{w}%%%" for w in prose(rng, 80).split()) for _ in range(10)]
    texts = [*ODD, *good, *junk, "ab cd ef " * 30, "same line of words\nsame line of words\n\n \n" * 20]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, 1) for i in range(8, 38)] + [(48, 0), (None, 1)], "doc_id long, quality int")
    facts, held = quality.quality_rules(docs, labels)
    rows = [(texts[r["doc_id"]], r[held]) for r in facts.collect()]
    grams = lambda w: [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]

    def signed(n):
        return n - 2**64 if n >= 2**63 else n

    def buckets(text):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
        pairs = []
        for a, b in zip(w, w[1:], strict=False):  # the hash of the first word is the seed of the second
            pairs.append(xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42)))
        return [signed(h) % quality.BUCKETS for h in [*grams(w), *pairs]]

    raw, target = collections.Counter(), collections.Counter()
    for i, t in enumerate(texts):
        raw.update(buckets(t))
        if 8 <= i < 38:
            target.update(buckets(t))
    n, m, mass = sum(raw.values()), sum(target.values()), quality.SMOOTHING * quality.BUCKETS
    weight = {b: math.log((target[b] + mass * c / n) / (m + mass) / (c / n)) for b, c in raw.items()}
    for text, f in rows:
        expected = base_facts(text)
        assert tuple(f[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == expected
        b = buckets(text)
        score = sum(weight[x] for x in b) / len(b) if b else 0.0
        assert abs(f["score"] - score) < 1e-9
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert f["base_failed"] == failed and f["kept"] == (not failed and score >= quality.THRESHOLD)
    none, held = quality.quality_rules(docs.limit(0), labels)
    assert none.count() == 0


def brute_components(rows):
    sets = {}
    for k, (i, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w and i is not None else set()
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    low = {}
    for k in sets:
        if rows[k][0] is not None:
            low[find(k)] = min(low.get(find(k), rows[k][0]), rows[k][0])
    return collections.Counter((rows[k][0], len(sets[k]) if rows[k][0] is not None else None, low.get(find(k)) if rows[k][0] is not None else None) for k in sets)


def test_near_duplicates(spark):
    rng = random.Random(9)
    texts = [*ODD[:6], "one two", "ONE two"]
    for _ in range(6):  # groups of variants around the threshold, one group large
        base = prose(rng, 120).split()
        for _ in range(rng.choice([3, 40])):
            v = list(base)
            for _ in range(rng.randint(0, 5)):
                v[rng.randrange(len(v))] = f"new{rng.random()}"
            texts.append(" ".join(v))
    texts += texts[10:14]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [*zip(ids, texts, strict=True), (None, texts[12]), (ids[20], texts[20])]
    out = near_dups.near_duplicates(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    got = collections.Counter((r["doc_id"], r["n_shingles"] if r["doc_id"] is not None else None, r["component_id"]) for r in out)
    assert got == brute_components(rows)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in out)
    staged = near_dups.near_duplicate_stage(spark, frame(spark, [t for _, t in rows], [i for i, _ in rows]), "").collect()
    kept = {r["doc_id"] for r in out if r["kept"]}
    assert collections.Counter(r["doc_id"] for r in staged) == collections.Counter(kept)


def test_near_duplicates_of_nothing(spark):
    assert near_dups.near_duplicates(frame(spark, [])).count() == 0
    assert near_dups.near_duplicates(frame(spark, [None, ""])).where("kept").count() == 2


def test_decontamination(spark):
    item = "Anna bought 12 apples for 30 euros and later sold 5 of them to Peter at the market near the river"
    other = item.replace("Anna", "Maria").replace("12", "40").replace("30", "75").replace("Peter", "Jonas")
    broken = "Anna bought 12 apples for 30 euros and 12 pears. " + other
    rng = random.Random(5)
    texts = [*ODD, prose(rng, 300), f"{prose(rng, 50)}. {item}. {prose(rng, 40)}", f"{prose(rng, 50)}. {other}.", broken, item.upper(), item + " " + item]
    bench = spark.createDataFrame([(7, item, 1), (7, item, 1), (8, None, 1), (9, "too short", 1), (None, prose(rng, 20), 1)], "item_id long, text string, doc_id long")
    out = {r["doc_id"]: r for r in decontamination.contaminated(frame(spark, texts), bench).collect()}
    assert {9, 10, 11, 13} <= set(out) and not set(out) & set(range(9)) and {r["item_id"] for r in out.values()} == {7}
    assert out[10]["n_slots"] >= 4 and out[9]["n_hits"] == out[9]["n_windows"]
    # One value of the item for two values of the document is no copy.
    mixed = "Anna bought 12 apples for 12 euros and later sold 12 of them to Peter at the market near the river"
    bench = spark.createDataFrame([(1, mixed)], "item_id long, text string")
    assert decontamination.contaminated(frame(spark, [item]), bench).count() == 0
    assert decontamination.contaminated(frame(spark, [mixed]), bench).count() == 1
    assert decontamination.contaminated(frame(spark, []), bench).count() == 0
    assert decontamination.contaminated(frame(spark, [item]), bench.limit(0)).count() == 0


def test_decontamination_of_items_without_windows(spark):
    items = ["What is 12 + 7 - 3 * 4?", "Compute 48 / 6 + 15 - 2 * 3.", "The Great Gatsby Was Written By Francis Scott Fitzgerald In Paris",
             "中国的首都是哪里", "Yes", "Who wrote the Great Gatsby"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rng = random.Random(15)
    around = lambda t: f"{prose(rng, 30)}. {t} {prose(rng, 20)}"
    cases = [(around(items[0]), {0}), (around(items[1]), {1}), (around(items[2]), {2}), (around(items[2].lower()), {2}), (f"请问{items[3]}呢", {3}), (items[3], {3}),
             ("no. Yes!", {4}), ("they said yes to it", set()), (f"Question - {items[5]}, so", {5}), (around("Question - What is 31 + 8 - 5 * 6?"), {0}),
             (around("Compute 7 / 6 + 15 - 7 * 3."), set()), (around("The Lord Of The Rings Was Made By New Zealand People Abroad"), set()), ("首都是北京", set())]
    found = collections.defaultdict(set)
    for r in decontamination.contaminated(frame(spark, [t for t, _ in cases]), bench).collect():
        found[r["doc_id"]].add(r["item_id"])
        assert 1 <= r["n_hits"] <= r["n_windows"]
    assert [found[k] for k in range(len(cases))] == [want for _, want in cases]


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def test_pii(spark):
    rng = random.Random(8)
    pieces = ["a.b@c.de", "@x", "a@b", "x@y.z.", "a@@b.c", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112",
              "+1 (017) 555-7713", "+49 30", "+", "1", "é", " ", "-", ".", "word", "token = \"ab8ca1b325bc4f85aa6a79e73fc4cbfc2098878e\"", "(617) 555-1234"]
    texts = [*ODD, *("".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(1, 25))) for _ in range(300))]
    rows = pii.find_pii(frame(spark, texts)).collect()
    for r in rows:
        text = texts[r["doc_id"]] or ""
        base = [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if pii.accepted(k, m.group())]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(b[0] == k for b in base) for k in PATTERNS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r["spans"].split(","))  | {""}
    clean = pii.redacted(spark.createDataFrame([(1, "mail a.b@c.de or (617) 555-1234 now"), (2, None)], "doc_id long, text string")).collect()
    assert clean[0]["text"] == "mail [EMAIL] or [PHONE] now" and clean[1]["text"] is None
    assert pii.find_pii(frame(spark, [])).count() == 0


def brute_cuts(at, fine, window):
    best = [0.0] + [math.inf] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            n = at[j] - at[i]
            if n <= window:
                pad = 0 if n >= 64 and n & (n - 1) == 0 else window - n
                best[j] = min(best[j], best[i] + pad + fine[j] + packing.OPEN)
    return best[-1]


def test_cuts_are_best():
    rng = np.random.default_rng(6)
    for _ in range(40):
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 90, 60))])
        fine = rng.choice([0.0, 4.0, 64.0], len(at))
        cuts = packing.choose_cuts(at, fine, 256)
        cost = sum((0 if n >= 64 and n & (n - 1) == 0 else 256 - n) + fine[b] + packing.OPEN for a, b in zip(cuts, cuts[1:], strict=False) for n in [at[b] - at[a]])
        assert cost == pytest.approx(brute_cuts(at, fine, 256)) and all(at[b] - at[a] <= 256 for a, b in zip(cuts, cuts[1:], strict=False))


def test_packing(spark, library):
    rng = random.Random(2)
    texts = [*ODD, *(". ".join(prose(rng, 12) for _ in range(rng.randint(1, 60))) for _ in range(60)), prose(rng, 9000)]
    rows = packing.pack(frame(spark, texts), packing.default_tokenizer()).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(pieces[i], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in own) == ids.tobytes() and {r["doc_tokens"] for r in own} == {len(ids)}
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]]
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]] and sum(r["length"] for r in own) <= 2048


def test_warc(spark, tmp_path, monkeypatch):
    big = "<p>" + "x y z " * 400
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, "small"), (4, "u\r\nX: y", "small"), (5, "u", None), (6, "u", ""), (None, "u", big), (2, "u", big), (7, "u", "é" * 90000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    files = warc.archive(pages, f"file://{tmp_path}/a", file_bytes=3000)
    out = collections.Counter(tuple(r) for r in warc.read_archive(files).collect())
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    expected = collections.Counter((i, len((t or "").encode()), digest(t), "revisit" if i == 1 else "response", 2 if i == 1 else None) for i, _, t in rows)
    assert out == expected
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)  # the lookup by a shuffle
    assert collections.Counter(tuple(r) for r in warc.read_archive(warc.archive(pages, f"file://{tmp_path}/c")).collect()) == expected
    assert warc.read_archive(warc.archive(pages.limit(0), f"file://{tmp_path}/b")).count() == 0
    name = files.orderBy("bytes", ascending=False).first()["path"]
    whole = open(name, "rb").read()
    assert whole[:4] == bytes.fromhex("5d2a4d18")
    with open(name, "wb") as f:
        f.write(whole[:-7])
    with pytest.raises(Exception, match="cut off|ZstdError|begins with|incomplete"):
        warc.read_archive(files).collect()


def test_toxicity(spark):
    rng = random.Random(12)
    rows = []
    for i in range(300):
        words = prose(rng, 60).split()
        if i % 3 == 0:
            for w in rng.sample(["zortak", "blugger", "frimsel"], 2):
                words.insert(rng.randrange(60), w)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "zortak"), (0, rows[0][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.learn_toxicity(docs.where("doc_id % 5 <> 0"), labels)
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert all(out[i]["predicted"] == (i % 3 == 0) == bool(out[i]["spans"]) for i in range(300))
    assert out[900]["predicted"] == out[901]["predicted"] == 0
    a, b = map(int, out[0]["spans"].split(",")[0].split(":"))
    assert rows[0][1][a:b] in ("zortak", "blugger", "frimsel")
    assert toxicity.learn_toxicity(docs, labels.limit(0)) is None
    assert toxicity.score_toxicity(docs, None).where("predicted = 1").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body><div class="cookie-notice">We use
cookies</div><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><!-- <p>no</p> --><article><h1>A &amp; B</h1><p>First   line<br>goes
on &lt;here&gt;.<p>Second <b>bold text<p>Third 1 < 2 too</p></article><section class="comments"><p>I agree with this!</p></section><footer>&copy; x</footer>"""


def test_html_text(spark):
    assert [b[0] for b in html_text.blocks(PAGE)][3:7] == ["A & B", "First line goes on <here>.", "Second bold text", "Third 1 < 2 too"]
    net = html_text.fit_labeller([PAGE] * 3)
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "u", "", "x"), (1, "u", "<", "x"), (5, "u", "<p" * 5000, "x")], "page_id long, url string, html string, text string")
    out = html_text.extract_text(pages, net).collect()
    assert out[0]["text"] == "A & B\nFirst line goes on <here>.\nSecond bold text\nThird 1 < 2 too" and out[0]["n_chars"] == len(out[0]["text"])
    assert [(r["page_id"], r["text"]) for r in out[1:3]] == [(2, ""), (None, "")] and len(out) == 5
    assert html_text.extract_text(pages.limit(0), net).count() == 0


@pytest.mark.parametrize("attributes", ['class="overflow-hidden"', 'class="hidden-print"', 'aria-hidden="false"', 'data-hidden="0"', 'title="a hidden thing"',
                                        'data-style="display:none"', "class=hidden", 'style="x-display:none"', 'href="/the-hidden-city"', "href=/a/hidden/b"])
def test_html_text_that_is_shown(attributes):
    assert [b[0] for b in html_text.blocks(f"<div {attributes}><p>one <a {attributes}>two</a> three</div>")] == ["one two three"]


@pytest.mark.parametrize("attributes", ["hidden", 'hidden=""', "class='a' HIDDEN", 'aria-hidden = "true"', "aria-hidden=true", 'style="color:red; display : none"',
                                        "style='display:none !important;'"])
def test_html_text_that_is_hidden(attributes):
    assert [b[0] for b in html_text.blocks(f"<p>one</p><div {attributes}><p>two</div><p>three <b {attributes}>four</b>five")] == ["one", "three five"]


@pytest.mark.parametrize("page, texts", [
    ("<html><head><title>T</title><meta x><body><p>one</p><p>two</p>", ["one", "two"]), ("<head><title>T</title><style>p{}</style><p>one<p>two", ["one", "two"]),
    ("<head><link x> one</p><p>two", ["one", "two"]), ("<head><title>T</title></head><p>one</p>", ["one"]),
    ("<article><p>one</p><object data=x><p>two</p></article><p>three", ["one", "two", "three"]),
    ("<div><p>one<video src=x></p><p>two</p></div><video>old browser</video><p>three", ["one", "two", "three"]),
    ("<div>one <canvas>none</canvas>two <video><p>a</p> b</video>three", ["one two three"]), ("<p>one <audio><object>x</audio> two", ["one two"]),
    ("<p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds", ["where x=2 holds"]), ("<div hidden>x</div><p>one<ul><li hidden>y<li>two</ul>", ["one", "two"]),
    ("<p>one<noscript><p>two</p>", ["one", "two"]), ("<p>one<svg><svg><text>x</text></svg><text>y</text></svg> two", ["one two"]),
    ("<p>one<script>var x='</p>'", ["one"]), ("<head><style>p{} <body><p>one", ["one"]), ("<p>one<div hidden><p>two</p>", ["one", "two"])])
def test_html_text_with_missing_ends(page, texts):
    assert [b[0] for b in html_text.blocks(page)] == texts


def test_long_runs_of_letters_are_read_to_their_end(spark):
    rng = random.Random(21)
    run = lambda n: "".join(rng.choice("aeiou") + rng.choice("bdfg") for _ in range(n))
    rows = [(i, " ".join(run(4) if i % 2 else "".join(rng.choice("kqxz") for _ in range(8)) for _ in range(30)), "ab" if i % 2 else "kq") for i in range(60)]
    chain = language.learn_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    long = run(32) + "".join(rng.choice("kqxz") for _ in range(64 * 9))
    out = language.label_languages(frame(spark, [run(32), long, long + " ?"]), chain).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in out] == ["ab", "kq", "kq"] and [r["n_runs"] for r in out] == [1, 2, 2]
    clean = [(i, prose(rng, 40), 0) for i in range(0, 200, 2)]
    toxic = [(i, " ".join([prose(rng, 20), "zortak", prose(rng, 20)]), 1) for i in range(1, 200, 2)]
    model = toxicity.fit_toxicity(clean + toxic)
    glued = "".join(prose(rng, 64).split())[:64] + "zortak"
    texts = ["word " + glued, glued[:64]]
    out = toxicity.score_toxicity(frame(spark, texts), model).orderBy("doc_id").collect()
    assert [r["spans"] for r in out] == ["69:75", ""] and out[0]["predicted"] == 1


def test_every_language_is_learned(spark):
    rng = random.Random(22)
    rows = [(i, prose(rng, 12), "en") for i in range(2000)] + [(5000 + i, " ".join("".join(rng.choice("kqxzw") for _ in range(6)) for _ in range(12)), f"l{i % 2}") for i in range(4)]
    docs = spark.createDataFrame([*rows, (6000, "x", None)], "doc_id long, text string, lang string")
    sample = language.labelled_sample(docs, docs, "lang", "text", "doc_id", 60, of_each=True)
    assert collections.Counter(r["sample_label"] for r in sample) == {"en": 30, "l0": 2, "l1": 2}
    assert language.learn_languages(docs, rows=60).labels == ["en", "l0", "l1"]


def test_transducer_is_bounded(library, monkeypatch):
    from tidemark.llm import token_counts

    path = packing.default_tokenizer()
    rng = random.Random(31)
    marks = ["\u0301", "\u0323", "\u1cd2", "\u0d3b", "\u05b0", "\u0f71"]
    texts = ["".join(rng.choice(marks) if rng.random() < 0.5 else rng.choice("aeo\uac00 ") for _ in range(9)) for _ in range(400)]
    texts += ["".join(rng.choice("abcdef0+/") for _ in range(300_000)), "a " + "x" * 64 + " b " + "y" * 65 + " c", prose(rng, 900)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for most in (token_counts.MOST_STATES, 400):
        monkeypatch.setattr(token_counts, "MOST_STATES", most)
        counter = Counter(path, character_classes(path), odd_characters(path))
        assert counter.counts(texts).tolist() == [len(e) for e in expected]
        assert [ids.tolist() for ids, _ in counter.encode(texts)] == expected
        assert len(counter.transducer.states) <= most


def test_ids_ask_for_each_word_once(library, monkeypatch):
    from tidemark.llm import token_counts

    path = packing.default_tokenizer()
    rng = random.Random(32)
    texts = [*(t or "" for t in ODD), *(prose(rng, 300) for _ in range(40)), "Ünïcödé. 日本語! é😀"]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for most in (token_counts.MOST_WORDS, 50):  # the second drops all words before each batch
        monkeypatch.setattr(token_counts, "MOST_WORDS", most)
        counter, asked = Counter(path, character_classes(path), odd_characters(path)), collections.Counter()
        model = counter.words.model
        counter.words.model = type("Model", (), {"tokenize": lambda self, w: asked.update([w]) or model.tokenize(w)})()  # noqa: B023
        for _ in range(2):
            assert [ids.tolist() for ids, _ in counter.encode(texts)] == expected
        assert set(asked.values()) == {1 if most > 50 else 2} and "transducer" not in vars(counter)


def test_blocks_confirm_and_report_what_was_sure(spark):
    sets = {1: range(100), 2: range(5, 105), 3: range(50, 150), 4: range(0, 100)}
    table = spark.createDataFrame([(k, np.array(v, np.uint64).tobytes()) for k, v in sets.items()], "cls long, shingles binary")
    found = spark.createDataFrame([(7, 0, 0, [1, 1, 2], [2, 3, 3], [True, True, False]), (7, 0, 1, [1], [4], [False])], near_dups._FOUND)
    got = {tuple(r) for r in near_dups.confirmed_blocks(found, table).collect()}
    assert got == {(1, 2, True), (1, 3, False), (1, 4, True)}


@pytest.mark.parametrize("page, texts", [
    ("<article><p title=it's>Hello world</p><p>Second part</p></article>", ["Hello world", "Second part"]),
    ("<p>a <a title=don't href=x>b</a> c's", ["a b c's"]), ("<p id='1'class=x>one<p a= 'x>y' b=\"'>\">two", ["one", "two"]), ("<p =\"x\">one<p a=/b/>two", ["one", "two"])])
def test_html_attributes_with_quotes(page, texts):
    assert [b[0] for b in html_text.blocks(page)] == texts


def test_html_of_any_depth_is_read_in_time():
    start = time.monotonic()
    found = html_text.blocks("".join(f"<div class=c{i % 700}>x" for i in range(40_000)))
    assert len(found) == 40_000 and html_text.vectors(found).shape[0] == 40_000
    assert len(html_text.blocks("<svg>x" * 40_000 + "</svg>" * 2 + "<p>y")) > 0
    assert time.monotonic() - start < 20  # paths by block were a quadratic number of names


def test_paths_tell_alike_however_they_are_made():
    for names, label in [((("<article",), ("<header",), ("<h1",)), 1), ((("<header",), ("<article",)), 0), ((("<div", "text"), ("<nav",)), 0), ((("<div", "post"),), 1),
                         ((("<article",), ("<section", "comments")), 0), ((("<body",), ("<p",)), -1)]:
        path = html_text.path_of((("<html",), *names))
        assert html_text.weak_label(path) == label and path is html_text.path_of((("<html",), *names))
        cells = {html_text._hash(w, html_text.PATH) for n in (("<html",), *names) for w in n}
        assert set(np.flatnonzero(path.vector)) == cells


def test_blocks_are_told_without_names(spark):
    """Held-out composed pages whose paths are taken away: place, words and link density have to do."""
    rng = random.Random(4)
    net = html_text.fit_labeller([PAGE] * 3)
    hits = wanted = found = 0
    for _ in range(120):
        page, label = html_text._composed(rng, [prose(rng, 30) + "." for _ in range(40)])
        x = html_text.vectors(page)
        x[:, :html_text.PATH] = 0
        keep, label = lstm.probabilities(net, [x])[0] >= 0.5, np.array(label) == 1
        hits, wanted, found = hits + (keep & label).sum(), wanted + label.sum(), found + keep.sum()
    assert 2 * hits / (wanted + found) > 0.8


def test_lstm_forward():
    """All steps of both directions written out, lanes of other lengths beside."""
    rng = np.random.default_rng(6)
    net = lstm.init(3, 2)
    for k in net:
        net[k] = rng.normal(size=net[k].shape).astype(np.float32)
    sequences = [rng.normal(size=(n, 3)).astype(np.float32) for n in (4, 1, 7, 0)]
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    for s, got in zip(sequences, lstm.probabilities(net, sequences), strict=True):
        score = s @ net["skip"] + net["bias"]
        for d, order, w in (("f", range(len(s)), net["out"][:2]), ("b", range(len(s))[::-1], net["out"][2:])):
            h, c = np.zeros(2), np.zeros(2)
            for t in order:
                f, i, o, g = np.split(s[t] @ net[f"x{d}"] + h @ net[f"h{d}"] + net[f"c{d}"], 4)
                c = sigmoid(f) * c + sigmoid(i) * np.tanh(g)
                h = sigmoid(o) * np.tanh(c)
                score[t] += h @ w
        assert np.allclose(got, sigmoid(score), atol=1e-5)


def test_lstm_learns_from_what_stands_far_off():
    """The label of a step is the first input of the sequence: only a gradient through all steps finds it."""
    rng = np.random.default_rng(9)
    sequences = [np.column_stack([[v, *[0] * 9], rng.normal(size=10)]).astype(np.float32) for v in rng.choice([-1.0, 1.0], 256)]
    labels = [np.full(10, s[0, 0] > 0, np.float32) for s in sequences]
    net = lstm.fit(sequences[:192], labels[:192], hidden=6, rounds=60)
    assert np.mean([((p >= 0.5) == y).mean() for p, y in zip(lstm.probabilities(net, sequences[192:]), labels[192:], strict=True)]) > 0.95


def test_pii_of_long_texts_and_of_numbers_that_are_none(spark):
    rng = random.Random(3)
    forest, thresholds = pii.fit_selector(pii._generated(random.Random(7), 150))
    assert set(thresholds) == set(pii.KINDS)
    text = " word ".join(rng.choice(["a@b.cd", "1.2.3.4", "555-123-4567", "999.1.1.1", "4111 1111 1111 1111", "(617) 555-1234"]) for _ in range(60_000)) + " " + "1" * 500_000
    start = time.monotonic()
    base, spans = pii.select_spans(text, forest, thresholds)
    assert time.monotonic() - start < 60  # pairs of spans, and all ends of a run of digits, took hours
    assert set(base) <= set(spans) and len(spans) > len(base) > 29_000
    for text in ["see /usr/share/lib64/python3/site-packages/x2 there", "our order 123-4567-8901 came", "by ISBN 978-3-16-148410-0 it is", "on 2021-03-04 and 12 12 12"]:
        assert pii.select_spans(text, forest, thresholds)[1] == []
    assert pii.select_spans("please call 555 123 4567 now", forest, thresholds)[1] == [("phone", 12, 24)]


@pytest.mark.parametrize("seed", range(20))
def test_intervals(seed):
    rng, held, tree = random.Random(seed), [], pii.Intervals()
    for _ in range(60):
        a = rng.randrange(100)
        b = a + rng.randint(1, 9)
        assert tree.free(a, b) == (not any(x < b and a < y for x, y in held))
        if rng.random() < 0.5:
            tree.add(a, b)
            held.append((a, b))
    assert tree.starts == sorted(tree.starts) and all(x <= y for x, y in zip(tree.ends, tree.starts[1:]))


def test_pii_added_spans_held_out():
    """Precision and recall of each kind on generated spans of another seed, in their contexts."""
    forest, thresholds = pii.fit_selector(pii._generated(random.Random(7), 150))
    planted = pii._generated(random.Random(99), 100)
    for kind in ("email", "phone", "secret"):  # the base rules alone decide on the others
        own = [(e, any(s[0] == kind for s in pii.select_spans(e[2] + e[1] + e[3], forest, thresholds)[1])) for e in planted if e[0] == kind]
        hits = sum(h and e[4] for e, h in own)
        assert hits >= 0.95 * sum(h for _, h in own) and hits >= 0.85 * sum(e[4] for e, _ in own)


def test_letters_are_those_of_unicode():
    """Words hold every letter of category L and nothing else, whatever the form of its numbers."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    found = set("".join(language.words_of(" ".join(every))))
    assert found == {x for c in every for x in c.lower() if unicodedata.category(x)[0] == "L"}
    assert language.words_of("½ ² ① Ⅷ 12") == [] and language.words_of("a½b x²") == ["a", "b", "x"]


def test_runs_of_languages(spark):
    """A stretch of another language is found, with its words; texts of several languages, of one and of none."""
    rng = random.Random(31)
    pick = {"aa": ["katu", "lopi", "mura", "tiko"], "bb": ["schwenz", "grubeln", "strachten", "pflotz"]}
    say = lambda lang, n: [rng.choice(pick[lang]) + rng.choice(["", "s"]) for _ in range(n)]
    rows = [(i, " ".join(say(["aa", "bb"][i % 2], 20)), ["aa", "bb"][i % 2]) for i in range(120)]
    chain = language.learn_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    right = total = 0
    texts, inner = [], []
    for i in range(200):
        n, first = rng.choice([1, 2, 3, 5, 10]), rng.randint(3, 15)
        texts.append(" ".join([*say("aa", first), *say("bb", n), *say("aa", 6)]))
        inner.append((first, n))
    out = {r["doc_id"]: r for r in language.label_languages(frame(spark, [*texts, None, "12", "katu lopi"]), chain).collect()}
    for i, (first, n) in enumerate(inner):
        runs = [(x.split(":")[0], *map(int, x.split(":")[1:])) for x in out[i]["runs"].split(",")]
        assert runs[0][1] == 0 and runs[-1][2] == first + n + 6 and all(a[2] == b[1] and a[0] != b[0] for a, b in zip(runs, runs[1:]))
        assert len(runs) == out[i]["n_runs"]
        said = [lang for lang, a, b in runs for _ in range(b - a)]
        right += sum(said[k] == "bb" for k in range(first, first + n))
        total += n
    assert right / total > 0.95
    assert [out[i]["runs"] for i in (200, 201, 202)] == ["", "", "aa:0:2"]


def brute_contaminated(texts, items):
    """Every window of every text against every window of every item; items with few windows are not covered."""
    read = lambda t: (*decontamination.template(t), *decontamination.windows(*decontamination.template(t)[:2]))
    out = set()
    held = {k: read(t) for k, t in items.items()}
    for key, text in enumerate(texts):
        h, slot, words, good, _ = read(text)
        for item, (ih, islot, iwords, igood, _) in held.items():
            lines = collections.defaultdict(lambda: (set(), set()))
            for p in good:
                for q in igood:
                    if (h[p:p + 5] == ih[q:q + 5]).all():
                        at, values = lines[p - q]
                        at.add(int(q))
                        values |= {(iwords[q + k].lower(), words[p + k].lower()) for k in range(5) if slot[p + k]}
            fair = [(at, v) for at, v in lines.values() if len({a for a, _ in v}) == len({b for _, b in v}) == len(v)]
            hits = len(set().union(*(at for at, _ in fair)))
            n = len(igood)
            if hits >= max(min(decontamination.LEAST_HITS, n), math.ceil(n * decontamination.SHARE)) or hits >= decontamination.SURE_HITS:
                out.add((key, item, n, hits, max(len(v) for _, v in fair)))
    return out


def test_decontamination_of_stock_phrases(spark, monkeypatch):
    """Many items share windows: the same rows as by comparing all, with and without putting those windows off."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "tu", "re"]) for _ in range(3))
    stock = ["what is the sum of 3 and 5 if we add", "please choose the best of the four answers below and explain why it holds"]
    items = {i: f"{word()} {word()} {rng.choice(stock)} {word()} {word()} {word()} {rng.choice(['12', '40'])} {word()} {word()} {word()} {word()}" for i in range(40)}
    items |= {40 + i: f"{stock[1]} {word()}" for i in range(5)}
    texts = []
    for i in range(40):
        base = items[rng.randrange(45)]
        texts.append(rng.choice([base, base.replace("12", "77"), " ".join(base.split()[:rng.randint(6, 14)]), stock[i % 2], f"{prose(rng, 12)} {base} {base}", prose(rng, 30)]))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = brute_contaminated(texts, items)
    for common in (1, 8, 10**9):
        monkeypatch.setattr(decontamination, "COMMON", common)
        assert {tuple(r) for r in decontamination.contaminated(frame(spark, texts), bench).collect()} == want
    assert len(want) > 40


def test_recall_of_reparameterised_items(spark):
    """Each planted copy has other numbers and names; every one is found, and no text without a copy is."""
    rng = random.Random(22)
    people, word = ["Anna", "Peter", "Maria", "Jonas", "Lena", "Felix"], lambda: "".join(rng.choice(["ka", "lo", "mi", "tu", "re"]) for _ in range(3))
    make = lambda w, a, b, x, y: f"Once {a} {w[0]} {x} {w[1]} to {b} and {w[2]} kept {y} {w[3]} in the {w[4]} of the {w[5]}, how many {w[1]} are left"
    bench, texts = [], []
    for i in range(60):
        w, (a, b, c, d) = [word() for _ in range(6)], rng.sample(people, 4)
        bench.append((i, make(w, a, b, rng.randint(10, 99), rng.randint(100, 999))))
        texts.append(f"{prose(rng, 30)}. {make(w, c, d, rng.randint(10, 99), rng.randint(100, 999))}. {prose(rng, 30)}")
    texts += [f"{prose(rng, 40)} {make([word() for _ in range(6)], 'Tom', 'Eva', 5, 77)}" for _ in range(60)]
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(frame(spark, texts), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert {(i, i) for i in range(60)} <= found and {d for d, _ in found} == set(range(60))


def test_quality_counts_every_trusted_document(spark, monkeypatch):
    docs = spark.range(20_500).selectExpr("id AS doc_id", "'one two' AS text")
    counts = {r["raw"]: r["target"] for r in quality.bucket_counts(docs, docs.where("doc_id < 20200")).collect()}
    assert counts == {20_500: 20_200}
    rng = random.Random(33)
    odd = frame(spark, [*ODD, *(prose(rng, 30) for _ in range(20))], [*range(20), 3, 3, 5, *[None] * 5])
    trusted = spark.createDataFrame([(3,), (3,), (4,), (19,), (None,), (99,)], "doc_id long")
    expected = sorted(map(tuple, quality.bucket_counts(odd, trusted).collect()))
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 0)  # by a shuffle of the texts
    assert sorted(map(tuple, quality.bucket_counts(odd, trusted).collect())) == expected and any(r[2] for r in expected)
