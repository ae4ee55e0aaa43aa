"""Periodic runs, license scans and cross-tokenizer alignment against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus_pipeline import tokenizer_path
from flowguard.llm import alignment, licenses, periodic, queries
from flowguard.llm.common import table
from test_text_ops import ODD, odd

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- Periodic runs -------------------------------------------------------------------------------

def plain_runs(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            x = w[s : i + q]
            if len(x) >= max(24, 3 * q) and not any(all(x[j] == x[j + d] for j in range(len(x) - d)) for d in range(1, q)):
                out.append((s, len(x), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_the_definition():
    rng, texts = random.Random(1), []
    for _ in range(1500):
        n, kinds = rng.randrange(160), rng.choice([1, 2, 3, 5, 40])
        w = [b"%d" % rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            if n > 30:
                a, p = rng.randrange(n - 25), rng.randrange(1, 20)
                for i in range(a, min(n, a + rng.randrange(20, 100))):
                    w[i] = w[a + (i - a) % p]
        texts.append(w)
    fibonacci = [b"a", b"b"]
    while len(fibonacci) < 300:
        fibonacci = fibonacci + [b"a" if x == b"b" else b"b" for x in fibonacci[::-1]]
    texts += [fibonacci, [b"a"] * 24, [b"a"] * 23, [b"a", b"b"] * 12, [], [b"x"]]
    found = periodic.runs_of(texts)
    assert sum(map(len, found)) > 500
    for w, runs in zip(texts, found):
        assert [tuple(r) for r in runs.tolist()] == plain_runs(w)


def test_splitting_keeps_every_run_and_little_else():
    rng = random.Random(2)
    w = [b"w%d" % rng.randrange(3000) for _ in range(5000)]
    w[1000:1100] = [b"p%d" % (i % 9) for i in range(100)]
    number = {}
    word = np.array([number.setdefault(x, len(number)) for x in w])
    at, _ = periodic.surviving(word, np.zeros(len(w), np.int64))
    assert set(range(1000, 1100)) <= set(at.tolist()) and len(at) < 140
    assert periodic.longest(np.array([[0, 30, 10], [5, 60, 20], [9, 24, 8]])) == (0, 30, 10)  # ties: the smallest start


def test_runs_query(spark):
    """Every row of the query from the contract's wording, word by word."""
    import zlib

    got = {r["doc_id"]: r for r in queries.op11_periodic(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs) and any(r["n_runs"] for r in got.values())
    for d in docs:
        w = WORD.findall(d["text"] or "")
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 3000 and h % 10:
            continue  # the plain version is quadratic; planted texts are all compared
        runs, r = plain_runs(w), got[d["doc_id"]]
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()


def test_runs_of_odd_rows(spark):
    rows = periodic.find_runs(odd(spark)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in ODD)
    long = next(r for r in rows if r["doc_id"] == 5)
    assert long["best"].asDict() == {"start": 0, "length": 150_000, "period": 1} and long["collapsed"] == "ü" and len(long["runs"]) == 1
    assert all(r["n_words"] == 0 and r["collapsed"] == "" and r["best"] is None for r in rows if r["doc_id"] in (1, 2, 3))
    assert periodic.find_runs(odd(spark).limit(0)).count() == 0
    assert queries.planted(None, [b"a"] * 50) == [b"a"] * 50


# --- License scans -------------------------------------------------------------------------------

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}


def lowered(text):
    return LICENSE_WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def places_of(words):
    return sorted((i, label) for label, p in PHRASES.items() for k in [p.split()] for i in range(len(words)) if words[i : i + len(k)] == k)


def test_license_phrases_are_all_found(spark):
    rng = random.Random(5)
    vocabulary = "gnu general public license apache cc by mit the GNU Mit LICENSE Kelvin K İ é".split()
    texts = ["".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "-", "\n"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r for r in licenses.scan(docs, licenses.document_frequency(docs)).collect()}
    for i, t in enumerate(texts):
        words, r = lowered(t), rows[i]
        places = places_of(words)
        assert r["n_words"] == len(words) and r["n_base"] == len(places)
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and (r["score"] == 1.0 or not places)


def test_notices_need_their_key_phrases(spark):
    notice = licenses.TEMPLATES[4].text
    other = notice.replace("free of charge", "for a charge")
    texts = ["Before. " + notice.capitalize() + ", after", other, notice.replace(" ", "\n * "), "mit", "permission " * 30, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan(docs, licenses.document_frequency(docs)).collect()}
    assert [rows[i]["labels"] for i in range(6)] == ["mit", "", "mit", "", "", ""]
    assert rows[0]["places"][0]["start"] == 1 and rows[0]["base_labels"] == "" and rows[5]["score"] == 0.0
    plan = licenses.scan(docs, licenses.document_frequency(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_license_of_odd_rows(spark):
    docs = odd(spark)
    rows = licenses.scan(docs, licenses.document_frequency(docs)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in ODD)
    assert {r["n_words"] for r in rows if r["doc_id"] == 5} == {150_000} and all(r["n_base"] == 0 for r in rows)
    empty = docs.limit(0)
    assert licenses.scan(empty, licenses.document_frequency(empty)).count() == 0


# --- Cross-tokenizer alignment -------------------------------------------------------------------

@pytest.fixture(scope="module")
def pair():
    with open(tokenizer_path(), "rb") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return alignment.Pair(a.read(), b.read())


def plain_alignment(pair, text):
    """(n_a, n_b, n_groups, groups, linked id pairs) by comparing all byte ranges."""
    text = text or ""
    a, b = pair.a.encode(f" {text}", add_special_tokens=False).ids, pair.b.encode(text)
    tokens = [[s[i].as_py() for i in x] for s, x in zip(pair.bytes, (a, b))]
    if not text or not b"".join(tokens[0]) == b" " + text.encode() == b"".join(tokens[1]):
        return 0, 0, 0, "", []
    spans = []
    for t in tokens:
        ends = np.cumsum([len(x) for x in t]).tolist()
        spans.append(list(zip([0, *ends], ends)))
    links = [(a[i], b[j]) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]
    groups, lo = [], 0
    for e in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
        groups.append("|".join(",".join(str(ids[i]) for i, x in enumerate(s) if lo < x[1] <= e) for ids, s in zip((a, b), spans)))
        lo = e
    return len(a), len(b), len(groups), ";".join(groups), links


def test_alignment_against_byte_ranges(spark, pair):
    rng = random.Random(1)
    pieces = ["a", "b", "  ", "\n\t", "é", "ñ", "漢", "😀", "'s", "’", "<s>", "<|endoftext|>", "the", " and", "1234", "́", "ing"]
    texts = [None, "", " ", "hello world", "  x  ", "▁ altered", "a ▁"] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(200)]
    texts += texts[20:30]
    docs = spark.createDataFrame([(i % 190, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_a int").repartition(5)
    want = Counter()
    plain = [plain_alignment(pair, t) for t in texts]
    count = Counter(p for x in plain for p in set(x[4]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    for i, (n_a, n_b, n_groups, groups, links) in enumerate(plain):
        want[i % 190, n_a, n_b, n_groups, len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), groups] += 1
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = alignment.align(docs, tokenizer_path(), path)
    assert Counter(map(tuple, got.collect())) == want
    hashed = Counter(r["groups_sha256"] for r in alignment.align(docs, tokenizer_path(), path, digests=True).collect())
    assert hashed == Counter(hashlib.sha256(x[3].encode()).hexdigest() if x[3] else "" for x in plain)


def test_ranks_give_the_library_s_tokens(pair):
    """Every code point, random letters, and words too long for ranks."""
    assert pair.ranked
    rng = random.Random(3)
    texts = [f"a{chr(c)}b1{chr(c)} {chr(c)}'s" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts += ["".join(rng.choice("etaoinshrdluetaoinbcfgABC'' 1\n") for _ in range(rng.randrange(1, 30))) for _ in range(20_000)]
    texts += ["x" * 30_000, " " * 30_000 + "y", "ab" * 20_000 + " c"]
    for lo in range(0, len(texts), 20_000):
        part = texts[lo : lo + 20_000]
        assert [pair.by_a(t) for t in part] == [e.ids for e in pair.a.encode_batch_fast([f" {t}" for t in part], add_special_tokens=False)]


def test_long_texts_in_parts(pair, monkeypatch):
    monkeypatch.setattr(alignment, "PART_CHARS", 50)
    rng = random.Random(2)
    text = "".join(rng.choice(["word", "s", " ", " ", "  ", "\n", ".", "é", "'ll", "<s>", "　"]) for _ in range(5000))
    parts = pair.parts(text)
    assert len(parts) > 20 and " ".join(parts) == text
    (a,), (b,) = pair.encode([text])
    assert a.tolist() == pair.a.encode(f" {text}", add_special_tokens=False).ids and b.tolist() == pair.b.encode(text)


def test_alignment_of_odd_rows(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = alignment.align(odd(spark), tokenizer_path(), path, digests=True).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in ODD)
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in rows if r["doc_id"] in (1, 2))
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in rows)
    assert alignment.align(odd(spark).limit(0), tokenizer_path(), path).count() == 0


def test_alignment_does_not_depend_on_chunks(spark, monkeypatch):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    one = Counter(map(tuple, alignment.align(docs, tokenizer_path(), path, digests=True).collect()))
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 20_000)
    many = alignment.align(docs.repartition(7), tokenizer_path(), path, digests=True)
    assert Counter(map(tuple, many.collect())) == one and len(one) > 100
