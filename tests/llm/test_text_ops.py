"""Operators on single texts: BPE, PII, toxicity, language ID, pseudo-likelihood; brute force or held-out accuracy."""

import gc
import hashlib
import pickle
import random
import re
import weakref

import numpy as np
import pytest
from corpus_pipeline import tokenizer_path
from flowguard.llm import bpe, decontam, langid, pii, pseudolm, toxicity
from flowguard.llm.common import held_out, plain_words, table, words
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
#: Nulls, empty and blank texts, a repeated row, a very long text, and columns named like results.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (None, "no id here, only words"), (5, "ü " * 150_000), (6, "0" * 100_000 + "@" + "." * 50_000)]


def odd(spark, schema="doc_id long, text string, score double, spans string, lang_pred string, n_tokens string, shard int, h int, n int, id int, label int"):
    return spark.createDataFrame([(i, t, 0.5, "x", "x", "x", 1, 1, 1, 1, 1) for i, t in ODD], schema)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").select("doc_id", "text", "lang").cache()


# --- BPE ---------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def coder():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return bpe.ByteBpe(f.read())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.no_padding()
    t.no_truncation()
    return t


def test_bpe_equals_the_library(coder, library):
    rng = random.Random(3)
    letters = list("ab's re'll \n\t\r\x0b\x1c\x85\xa0 　½Ⅷéß🎉<|endoftext|>!?.\x00") + ["<|endoftext|>", "  ", "\n\n", "the", "tion"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["a" * 5000, " " * 3000, "ab" * 4000]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == want, text
        assert coder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_bpe_merge_order(coder):
    """The queue gives what merging the lowest rank, leftmost, again and again gives."""
    def naive(ids):
        while True:
            pairs = [(coder.rank_of[a << 32 | b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in coder.rank_of]
            if not pairs:
                return ids
            rank, i = min(pairs)
            ids = [*ids[:i], coder.parts[rank][2], *ids[i + 2 :]]

    rng = random.Random(4)
    for _ in range(300):
        data = bytes(rng.choice(b"aabbthein") for _ in range(rng.randrange(30)))
        assert coder.merge(data) == naive([coder.byte_ids[b] for b in data])


def test_bpe_forgetting_changes_nothing(coder, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    text = "the cat sat on the mat and the dog sat on the log. " * 20
    assert bpe.ByteBpe(coder.source).encode(text) == coder.encode(text)


def test_bpe_remembers_a_word_once(coder, library, monkeypatch):
    """With a full stop or comma or without, and all that is remembered is bounded together."""
    copy = bpe.ByteBpe(coder.source)
    copy.encode("one, one. one")
    assert sorted(copy.remembered) == [" one", ",", ".", "one"]
    rng = random.Random(5)
    bits = ["the", " of", "Tion", ".", ",", "'s", "'", " ", "\n", "  ", "é", "1", "　", ".,", "?"]
    monkeypatch.setattr(bpe, "REMEMBERED", 60)
    copy = bpe.ByteBpe(coder.source)
    for _ in range(2000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert copy.encode(text) == library.encode(text, add_special_tokens=False).ids, text
        assert sum(len(held) for name, held in vars(copy).items() if name in ("tokens", "remembered", "older")) <= 61


def test_bpe_memory_goes_with_its_broadcast(coder):
    """A worker keeps a broadcast only while its tasks use it: no copy of the tokenizer may stay beside it."""
    copy, other = (pickle.loads(pickle.dumps(coder)) for _ in range(2))
    text = "a worker's copy, remembering"
    assert copy is not other and copy.encode(text) == coder.encode(text)
    gone = weakref.ref(copy)
    del copy
    gc.collect()
    assert gone() is None


def test_a_kept_text_is_sent_once(spark):
    rows = spark.createDataFrame([(1, "one two three four five six seven eight nine", "x"), (2, None, "y")], "doc_id long, text string, body string")
    items = spark.createDataFrame([(7, "two three four five six seven eight")], "item_id long, text string")
    held = langid.Profiles({"en": [int(c) for c in langid.ranked(*langid.grams("one two three"))]})
    for found in (langid.identify(rows, held), decontam.mark(rows, items)):
        assert "__text" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.select("text").collect() == rows.select("text").collect()
    assert [len(r["contained_items"]) for r in decontam.mark(rows, items).orderBy("doc_id").collect()] == [1, 0]
    other = decontam.mark(rows.drop("body").withColumnRenamed("text", "said").selectExpr("doc_id", "struct(said) AS in"), items, text="in.said")
    assert other.columns == ["doc_id", "in", "contained_items"]
    assert [len(r["contained_items"]) for r in other.orderBy("doc_id").collect()] == [1, 0]
    assert [r["lang_pred"] for r in langid.identify(rows, held).orderBy("doc_id").collect()] == ["en", "und"]


def test_bpe_frame(spark, docs, library):
    out = bpe.encode_decode(docs.limit(200), tokenizer_path(), digests=True).collect()
    for r in out:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    got = bpe.encode_decode(odd(spark), tokenizer_path())
    assert got.columns[-3:] == ["n_tokens", "token_ids", "decoded"] and got.count() == len(ODD)
    assert {(r["doc_id"], r["n_tokens"], r["decoded"]) for r in got.filter("doc_id <= 2").collect()} == {(1, 0, ""), (2, 0, "")}
    assert bpe.encode_decode(odd(spark).limit(0), tokenizer_path()).count() == 0


def test_bpe_ids_column(spark, library):
    """The ids as a column: of null, empty and odd texts, with and without the decoded text."""
    got = {r["doc_id"]: r for r in bpe.encode_decode(odd(spark), tokenizer_path(), keep=["doc_id", "text"]).collect()}
    for r in got.values():
        assert r["token_ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids and r["n_tokens"] == len(r["token_ids"])
        assert r["decoded"] == library.decode(r["token_ids"], skip_special_tokens=False)
    alone = bpe.encode_decode(odd(spark), tokenizer_path(), keep=["doc_id"], decoded=None)
    assert alone.columns == ["doc_id", "n_tokens", "token_ids"]
    assert {r["doc_id"]: r["token_ids"] for r in alone.collect()} == {i: r["token_ids"] for i, r in got.items()}


# --- PII ---------------------------------------------------------------------------------------

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    def fits(k, s):
        digits = [int(c) for c in s if c.isdigit()]
        if k == 1:
            return all(int(x) <= 255 for x in s.split("."))
        if k == 2:
            return 14 <= len(digits) <= 19 and sum(d if n % 2 == 0 else sum(divmod(2 * d, 10)) for n, d in enumerate(reversed(digits))) % 10 == 0
        return k == 0 or 10 <= len(digits) <= 15

    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if fits(k, m[0]))


def test_pii_base_spans():
    rng = random.Random(5)
    bits = ["@", ".", "a", "mail", "1", "255", "256", "0", "+1", " ", "-", "(743) ", "4111111111111111", "4111 1111 1111 1111", "com", "%", "1.2.3.4", "x@y.z", "555-3824", "ü"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == plain_base(text), text


def test_pii_frame(spark, docs):
    model = pii.learn(docs)
    assert all(0 < a < 1 and 0 < b < 1 for a, b in model.reliability.values())
    for r in pii.find(docs, model, mask="masked").collect():
        base = plain_base(r["text"])
        assert r["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        spans = [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert set(base) <= set(spans) and spans == sorted(spans)
        assert not plain_base(r["masked"])
        if not spans:
            assert r["masked"] == r["text"]
    keys = pii.find(spark.createDataFrame([(1, 'my token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ok')], "doc_id long, text string"), model).first()
    assert keys["spans"] == "secret:12:52"


def test_pii_estimates_follow_shares():
    """The same shares of vote patterns give the same model at any size, also beyond a million spans."""
    rng = random.Random(6)
    patterns = sorted({(kind, tuple(rng.choice((-1, 0, 1)) for _ in pii.LABELERS)) for kind in range(6) for _ in range(12)})
    counts = [rng.randrange(1, 500) for _ in patterns]
    small, large = (pii.estimate([(*p, n * by) for p, n in zip(patterns, counts)]) for by in (1, 10**6))
    assert np.allclose(small.weights, large.weights, atol=1e-6)


def test_pii_odd(spark):
    model = pii.learn(odd(spark).limit(0))
    assert pii.find(odd(spark).limit(0), model).count() == 0
    got = pii.find(odd(spark), pii.learn(odd(spark)), mask="text").collect()
    assert len(got) == len(ODD) and all(r["spans"] == "" for r in got if r["doc_id"] in (1, 2, 3, 4, 5))
    assert [r["text"] for r in got if r["doc_id"] == 1] == [None]


# --- Toxicity ----------------------------------------------------------------------------------

def plain_segments(scores):
    """Ruzzo and Tompa's definition: take the best-scoring span, then the same left and right of it."""
    best, where = 0.0, None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > best + 1e-12 or where and abs(total - best) <= 1e-12 and b - a < where[1] - where[0] - 1:
                best, where = max(total, best), (a, b + 1)
    if where is None:
        return []
    a, b = where
    return [*plain_segments(scores[:a]), (a, b, round(best, 6)), *[(b + x, b + y, s) for x, y, s in plain_segments(scores[b:])]]


def test_segments():
    rng = random.Random(6)
    for _ in range(500):
        scores = [rng.uniform(-2, 1.3) for _ in range(rng.randrange(25))]
        at = [i for i, s in enumerate(scores) if s > 0]
        gains, last = [], 0
        for i in at:
            gains.append((-sum(scores[last:i]), scores[i]))
            last = i + 1
        got = sorted((a, b, round(s, 6)) for a, b, s in toxicity.segments(gains, at))
        assert got == plain_segments(scores)


def test_segments_are_linear():
    n = 200_000
    assert len(toxicity.segments([(1.0, 0.5)] * n, list(range(0, 2 * n, 2)))) == n
    assert len(toxicity.segments([(0.1, 0.5)] * n, list(range(0, 2 * n, 2)))) == 1


def test_toxicity_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    labels = table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    out = toxicity.find_passages(docs.join(labels, "doc_id").filter(held_out(F.col("doc_id"))), model).toPandas()
    assert out.score.between(0, 1).all()
    assert (out.predicted == out.toxic).mean() > 0.97 and out.predicted[out.toxic == 0].mean() < 0.01
    assert (out.passages.map(len) > 0)[out.toxic == 1].mean() > 0.8


def test_toxicity_odd(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(4, 1), (5, 0), (2, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    for labels in (none, some):
        model = toxicity.fit(odd(spark), labels)
        got = toxicity.find_passages(odd(spark), model).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.find_passages(odd(spark).limit(0), model).count() == 0


# --- Language ID -------------------------------------------------------------------------------

def test_language_held_out(docs):
    test = held_out(F.col("doc_id"))
    out = langid.identify(docs.filter(test), langid.learn(docs.filter(~test))).toPandas()
    assert (out.lang_pred == out.lang).mean() > 0.98 and out.lang_score.between(0, 1).all()


def test_language_rank_order():
    """The distance is the out-of-place measure, computed here by dictionaries."""
    text = "Das ist der Hund, und der Hund ist groß."
    count = {}
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        for g in [*word, *(padded[i : i + 2] for i in range(len(padded) - 1)), *(padded[i : i + 3] for i in range(len(padded) - 2))]:
            count[g] = count.get(g, 0) + 1
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    order = sorted(map(code, count), key=lambda c: (-{code(g): n for g, n in count.items()}[c], c))
    assert langid.ranked(*langid.grams(text)).tolist() == order
    known = order[5:25] + [code("xyz")]
    away = sum(abs(known.index(c) - i) if c in known else 400 for i, c in enumerate(order))
    assert langid.Profiles({"de": known}).distances(text)[0] == pytest.approx(away / (400 * len(order)))


def test_language_odd(spark, docs):
    profiles = langid.learn(docs)
    got = {r["doc_id"]: r for r in langid.identify(odd(spark), profiles).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["lang_score"] == 0 for i in (1, 2, 3)) and got[4]["lang_pred"] != "und"
    assert sorted(r["doc_id"] or 0 for r in langid.keep_identified(odd(spark), profiles).collect()) == [0, 4, 4, 5]
    empty = langid.learn(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(odd(spark), empty).collect()} == {"und"}


# --- Pseudo-likelihood -------------------------------------------------------------------------

def test_examples_and_network():
    around, target = pseudolm.examples(np.array([7, 8, 9, 5], np.uint8), np.array([0, 3, 3, 4]))
    p = pseudolm.PAD
    assert around.tolist() == [[p, p, 8, 9], [p, 7, 9, p], [7, 8, p, p], [p, p, p, p]] and target.tolist() == [7, 8, 9, 5]
    rng = np.random.default_rng(1)
    net = pseudolm.Network(rng.normal(0, 0.5, pseudolm.Network.SIZE))
    context = np.tile(around[1], (pseudolm.SYMBOLS, 1))
    assert np.exp(net.log_probabilities(context, np.arange(pseudolm.SYMBOLS))).sum() == pytest.approx(1, abs=1e-5)


def test_gradient_and_score_by_plain_sums():
    """log P and its slopes by loops over one position after the other, in double precision."""
    rng = np.random.default_rng(5)
    net = pseudolm.Network(rng.normal(0, 0.5, pseudolm.Network.SIZE))
    symbols = rng.integers(0, pseudolm.SYMBOLS, 40).astype(np.uint8)
    around, target = pseudolm.examples(symbols, np.array([0, 25, 25, 40]))

    def plain(flat):
        at, parts = 0, []
        for s in net.SHAPES:
            parts.append(flat[at : at + int(np.prod(s))].reshape(s))
            at += int(np.prod(s))
        out = []
        for c, y in zip(around, target):
            h = np.tanh(sum(parts[0][k][c[k]] for k in range(2 * pseudolm.SIDE)) + parts[1])
            outer = h @ parts[2] + parts[3]
            inner = h @ parts[4][y // pseudolm.INNER] + parts[5][y // pseudolm.INNER]
            out.append(outer[y // pseudolm.INNER] - np.log(np.exp(outer).sum()) + inner[y % pseudolm.INNER] - np.log(np.exp(inner).sum()))
        return np.array(out)

    flat = net.flat.astype(float)
    assert np.allclose(net.log_probabilities(around, target), plain(flat), atol=1e-4)
    slope = net.gradient(around, target).flat
    for w in [*rng.integers(0, net.SIZE, 40), *np.argsort(-np.abs(slope))[:60]]:
        step = np.zeros(net.SIZE)
        step[w] = 1e-5
        assert slope[w] == pytest.approx(-(plain(flat + step).mean() - plain(flat - step).mean()) / 2e-5, abs=1e-4)


def test_training_learns_both_sides():
    """A symbol fixed by its left and right neighbours together is learned."""
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2, (2, 30_000))
    around = np.stack([np.zeros_like(a), a, b, np.zeros_like(a)], 1)
    target = 2 * a + b + 10
    net = pseudolm.Network.fresh(np.bincount(target, minlength=pseudolm.SYMBOLS))
    before = net.log_probabilities(around, target).mean()
    net.train(around, target, np.full(pseudolm.Network.SIZE, 1e-4, np.float32))
    after = net.log_probabilities(around, target).mean()
    assert before == pytest.approx(np.log(0.25), abs=0.1) and after > -0.1


def test_pseudolm_frame(spark, docs):
    rng = random.Random(7)
    rows = docs.filter("lang = 'en'").limit(150).collect()
    mixed = []
    for r in rows:
        w = r["text"].split()
        rng.shuffle(w)
        mixed.append((r["doc_id"] + 10**6, " ".join(w)))
    both = docs.select("doc_id", "text").unionAll(spark.createDataFrame(mixed, "doc_id long, text string")).unionAll(odd(spark).select(F.col("doc_id") - 100, "text"))
    out = pseudolm.score(both).toPandas()
    assert len(out) == docs.count() + 150 + len(ODD) and (out.log_likelihood <= 0).all()
    assert (out.per_token.isna() == (out.n_tokens == 0)).all() and (out.n_tokens == 0).sum() == 3
    per = out.set_index("doc_id").per_token
    gain = np.array([per[r["doc_id"]] - per[r["doc_id"] + 10**6] for r in rows])
    assert gain.mean() > 0  # the order of words counts
    assert pseudolm.score(docs.limit(0)).count() == 0


def test_training_takes_every_position(spark):
    """A symbol that stands at one position of 16 only is learned."""
    rng = np.random.default_rng(3)
    place = 3
    texts = rng.integers(0, 10, (8000, 16)).astype(np.uint8)
    texts[:, place] = 20 + texts[:, place - 1]
    net = pseudolm.train(spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "symbols binary").coalesce(1))
    around, target = pseudolm.examples(texts.ravel(), np.arange(0, texts.size + 1, 16), np.arange(place, texts.size, 16))
    assert net.log_probabilities(around, target).mean() > np.log(1 / 160) + 1


def test_rare_words_keep_their_counts(spark, docs, monkeypatch):
    """Scores don't depend on how many words are broadcast; a rarer word of the same length scores lower."""
    some = docs.select("doc_id", "text").limit(100).unionAll(odd(spark).select(F.col("doc_id") - 100, "text"))
    more = spark.createDataFrame([(10_000 + k, "qqzza") for k in range(9)] + [(20_000, "qqzzb")], "doc_id long, text string")
    rows = spark.createDataFrame(some.unionAll(more).collect(), "doc_id long, text string").coalesce(1)
    whole = pseudolm.score(rows).toPandas().sort_values(["doc_id", "n_tokens"], ignore_index=True)
    monkeypatch.setattr(pseudolm, "KNOWN_WORDS", 224)
    few = pseudolm.score(rows).toPandas().sort_values(["doc_id", "n_tokens"], ignore_index=True)
    assert np.allclose(whole.log_likelihood, few.log_likelihood, rtol=1e-6) and (whole.n_tokens == few.n_tokens).all()
    per = few.set_index("doc_id").per_token
    assert per[10_000] - per[20_000] == pytest.approx(np.log(9), abs=1e-4)


def test_word_hashes():
    texts = ["a b  a\tab", "", "é é b", None or "", "b"]
    w = words(texts)
    seen = {}
    for d, t in enumerate(texts):
        want = re.findall(r"[^\x20\x09-\x0D]+", t)
        got = w.hashes[w.first[d] : w.first[d + 1]].tolist()
        assert len(want) == len(got)
        for x, h in zip(want, got):
            assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)
    assert plain_words(["Ab, c-d"]).hashes.tolist() == plain_words(["ab c d"]).hashes.tolist()


def test_vocabulary_is_the_most_frequent(spark, monkeypatch):
    monkeypatch.setattr(pseudolm, "KNOWN_WORDS", 100)
    rows = [(h, h % 32, n) for h, n in enumerate(random.Random(8).choices(range(1, 400), k=5000))]
    got = pseudolm.learn_vocabulary(spark.createDataFrame(rows, "h long, shape int, n long"))
    want = sorted(rows, key=lambda r: (-r[2], r[0]))[:100]
    assert got.hashes.tolist() == sorted(h for h, _, _ in want)
    assert np.exp(got.inner).sum() <= 256 and (got.inner <= 1e-12).all() and (got.other < 0).all()
