"""Operators across rows: lattice, LSH forest, decontamination, substrings, sharding, pipeline; against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from flowguard.llm import decontam, lattice, lshforest, queries, sharding, substring
from flowguard.llm.common import components, sifted, table
from pyspark.sql import functions as F
from test_text_ops import ODD, SF, odd


def classes(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").cache()


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, i) for i in range(1001, 1300)]
    edges = chain + star + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    rng.shuffle(edges)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    want = classes({x for e in edges for x in e}, edges)
    assert got == {i: want[i] for e in edges if e[0] != e[1] for i in e}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# --- Lattice -----------------------------------------------------------------------------------

def test_e8_decoding():
    """No lattice point is nearer: each differs from the found one by shorter steps to all 240 neighbours."""
    x = np.random.default_rng(1).uniform(-3, 3, (2000, 8))
    p = lattice.decode(x)
    double = np.rint(p * 2)
    assert (p * 2 == double).all() and (p.sum(1) % 2 == 0).all() and ((double % 2 == 0).all(1) | (double % 2 == 1).all(1)).all()
    away = ((x - p) ** 2).sum(1)
    assert (away <= 1 + 1e-9).all()  # the covering radius of E8
    for v in lattice.shortest():
        assert (away <= ((x - p - v) ** 2).sum(1) + 1e-9).all()


def test_cover_property():
    assert {(a - b) % substring.PERIOD for a, b in itertools.product(substring.COVER, repeat=2)} == set(range(substring.PERIOD))


@pytest.mark.parametrize(("block", "tile"), [(4096, 512), (128, 50)])
def test_lattice_recall_and_counts(spark, block, tile):
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(rng.normal(size=(300, 64)))
    rows = [(b, k % 3) for k, b in enumerate(base)]
    for k in range(400):  # pairs at cosines about the threshold
        c = rng.uniform(0.9, 0.97)
        side = rng.normal(size=64)
        side = unit(side - (side @ base[k % 300]) * base[k % 300])
        rows.append((c * base[k % 300] + np.sqrt(1 - c * c) * side, k % 300 % 3))
    rows += [(unit(base[0] + rng.normal(0, 0.02, 64)), 0) for _ in range(700)]  # a hot group over several blocks
    rows += [(base[1] * 3, 1)] * 5 + [(base[1] * 3, 2), (base[2], None)]
    data = [(i, [float(np.float32(x)) for x in v], l) for i, (v, l) in enumerate(rows)]
    bad = [[0.0] * 64, None, [], [float("nan")] * 64, [None, 1.0], [float("inf"), 1.0], [1.0, 0.0]]
    data += [(10_000 + k, v, 0) for k, v in enumerate(bad)] + [(None, data[0][1], 0), data[7]]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumns({"id": F.lit(1), "n": F.lit("x"), "cell": F.lit(0)})
    got = {r["vec_id"]: r for r in lattice.near_duplicates(frame, lattice=lattice.Lattice(block=block, tile=tile)).collect()}
    assert len(got) == len(data) - 1
    x = unit(np.array([d[1] for d in data[: len(rows)]]))
    near = x @ x.T >= 0.93
    label = np.array([-1 - i if d[2] is None else d[2] for i, d in enumerate(data[: len(rows)])])
    near &= label[:, None] == label[None, :]
    np.fill_diagonal(near, False)
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.995 * near.sum()
    assert (found[700:1400] >= 690).all()
    whole = classes(range(len(rows)), [tuple(map(int, e)) for e in np.argwhere(np.triu(near))])
    assert sum(got[i]["component_id"] == whole[i] for i in range(len(rows))) >= 0.99 * len(rows)
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in range(len(rows)))
    assert all(got[10_000 + k]["n_links"] == 0 and got[10_000 + k]["component_id"] == 10_000 + k for k in range(len(bad)))
    assert got[None]["kept"] and lattice.near_duplicates(frame.limit(0)).count() == 0


def test_lattice_doubles(spark):
    """Components of any size, compared in double precision."""
    side = (1 - 0.93**2) ** 0.5
    rows = [(1, [1e300] * 4), (2, [1e300] * 4), (3, [1e-300] * 4), (4, [2e-300] * 4), (5, [1e300, 1.0, -1e300, 0.0]),
            (6, [1.0, 0.0, 0.0, 0.0]), (7, [0.93 + 1e-9, side, 0.0, 0.0]), (8, [0.93 - 1e-9, 0.0, side, 0.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_duplicates(frame).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (0, 8)}


# --- LSH forest --------------------------------------------------------------------------------

def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    k = min(5, len(w))
    return frozenset(" ".join(w[i : i + k]) for i in range(len(w) - k + 1)) if k else frozenset()


def near_pairs(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    out = []
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in having[x] if j > i).items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n) - 1e-9:
                out.append((i, j))
    return out


@pytest.mark.parametrize(("block", "tile", "node"), [(2048, 1024, 4096), (40, 7, 16)])
def test_forest_equals_brute_force(spark, docs, block, tile, node):
    rng = random.Random(8)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stem = [f"w{rng.randrange(900)}" for _ in range(150)]
    for k in range(120):  # a hot group of near copies with up to three changed words, some equal
        w = list(stem)
        for _ in range(k % 4):
            w[rng.randrange(150)] = f"x{rng.randrange(5)}"
        texts[20_000 + k] = " ".join(w)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in lshforest.near_duplicates(frame, forest=lshforest.Forest(block=block, tile=tile, node=node, shingles=block * 500)).collect()}
    links = near_pairs(texts)
    count, whole = Counter(i for e in links for i in e), classes(texts, links)
    assert len(got) == len(texts)
    assert sum(got[i]["n_links"] for i in texts) >= 0.999 * 2 * len(links)
    assert all(got[i]["n_links"] <= count[i] for i in texts)
    assert sum(got[i]["class_id"] != whole[i] for i in texts) <= 1


def test_forest_odd(spark):
    got = Counter((r["doc_id"], r["n_links"], r["class_id"], r["kept"]) for r in lshforest.near_duplicates(odd(spark)).collect())
    assert got == Counter((i, 0, i, True) for i in {i for i, _ in ODD})
    assert lshforest.near_duplicates(odd(spark).limit(0)).count() == 0
    assert lshforest.keep_one(odd(spark)).count() == len(ODD)
    two = spark.createDataFrame([(9, "a b c"), (4, "A  b\nc"), (5, "a b d"), (7, None), (8, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in lshforest.keep_one(two).collect()) == [4, 5, 7, 8]


def test_forest_recall_bound():
    f = lshforest.Forest()
    assert f.found(0.8, f.floor(0.8)) >= f.recall > f.found(0.8, f.floor(0.8) + 1)
    draws = np.random.default_rng(1).binomial(f.trees * f.depth, 0.8, 10**6)
    assert (draws < f.agreeing(0.8)).sum() <= 8 and (draws < f.agreeing(0.8) + 3).any()


def test_forest_finds_pairs_at_the_threshold_among_many_copies(spark):
    """Thousands of very similar pairs don't hide missed pairs at a similarity of 0.8."""
    rng = random.Random(4)
    texts = []
    for k in range(6200):
        n, cut = (104, 20) if k < 200 else (40, 1)
        w = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(w[: n - cut]))]
    got = lshforest.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).filter("n_links = 1")
    assert got.filter("doc_id >= 400").count() == 12_000 and got.filter("doc_id < 400").count() >= 398


def test_forest_rows_that_repeat_an_id(spark):
    """Texts of one id are judged apart: none is lost, no link is lost."""
    a, b = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    frame = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (2, a)], "doc_id long, text string")
    got = sorted(map(tuple, lshforest.near_duplicates(frame).select("doc_id", "n_links", "class_id", "kept").collect()))
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (2, 1, 2, True), (3, 1, 2, False)]
    kept = sorted(map(tuple, lshforest.keep_one(frame).collect()))
    assert kept == [(1, a), (2, b)]
    both = spark.createDataFrame([(1, a), (1, b), (2, b + " more")], "doc_id long, text string")
    assert sorted(map(tuple, lshforest.keep_one(both).collect())) == [(1, a), (1, b)]


def test_forest_template_makes_no_group(spark):
    """Texts that share a third of their shingles meet in the trees, but are no candidates."""
    rng = random.Random(12)
    stem = " ".join(f"s{k}" for k in range(100))
    texts = [(k, stem + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))) for k in range(600)]
    forest = lshforest.Forest()
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    signed = lshforest._signatures(rows, forest, forest.floor(0.8))
    kinds = signed.selectExpr("doc_id AS id", "nodes", "sketch")
    met = kinds.selectExpr("explode(nodes) AS node").groupBy("node").count().filter("count > 1")
    assert met.agg(F.sum("count")).first()[0] > 50  # one node a tree, of the template's shingles
    assert lshforest._candidates(kinds, 0.8, forest).count() == 0


def test_descent_joins_what_agrees():
    """The groups of a subtree are the components of all pairs that agree, in any order of the tries."""
    rng = np.random.default_rng(3)
    for case in range(40):
        base = rng.integers(0, 256, (5, 128)).astype(np.uint8)
        rows = base[rng.integers(0, 5, 150)].copy()
        change = rng.random(rows.shape) < rng.choice([0.05, 0.15, 0.3], (150, 1))
        rows[change] = rng.integers(0, 256, int(change.sum()))
        need = 80
        agree = (rows[:, None] == rows[None]).sum(2) >= need
        whole = classes(range(150), [tuple(map(int, e)) for e in np.argwhere(np.triu(agree, 1))])
        low = lshforest.descend(rows, range(4 + 8 * (case % 16), 8 + 8 * (case % 16)), need, rows=17)
        assert [whole[i] for i in range(150)] == low.tolist()


# --- Decontamination ---------------------------------------------------------------------------

def contained(texts, items, threshold=0.8):
    def sets(t):
        w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
        return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}

    having = defaultdict(set)
    need = {k: sets(t) for k, t in items.items()}
    for k, s in need.items():
        for x in s:
            having[x].add(k)
    out = {}
    for i, t in texts.items():
        for k, n in Counter(k for x in sets(t) for k in having.get(x, ())).items():
            if n >= threshold * len(need[k]):
                out[i, k] = n / len(need[k])
    return out


@pytest.mark.parametrize("bytes_", [decontam.BLOCK_BYTES, 3000])
def test_decontamination_equals_brute_force(spark, docs, monkeypatch, bytes_):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", bytes_)
    rng = random.Random(9)
    items = {r["item_id"]: r["text"] for r in table(spark, SF, "benchmark").collect()}
    word = lambda: f"q{rng.randrange(5000)}"
    items |= {500 + k: " ".join(word() for _ in range(n)) for k, n in enumerate([5, 6, 20, 21, 37, 200, 1500])} | {900: "too few words", 901: "", 902: None}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for k, n in items.items():
        if k >= 500 and n:
            for copy in range(4):  # inside long documents, some with changed words
                w = n.split()
                for _ in range(copy * len(w) // 60):
                    w[rng.randrange(len(w))] = "changed"
                texts[10_000 * copy + 50_000 + k] = " ".join([*(word() for _ in range(rng.randrange(20_000))), *w, *(word() for _ in range(rng.randrange(9000)))])
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([*items.items(), (None, "a b c d e f")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["containment"] for r in decontam.pairs(frame, bench).collect()}
    want = contained(texts, items)
    assert got == pytest.approx(want) and len(want) > 20
    assert decontam.keep_clean(frame, bench).count() == len(texts) - len({d for d, _ in want})


def test_short_items_are_never_missed():
    """Items of 1 to 7 shingles, whole or with as many missing as the threshold lets, inside long texts."""
    rng = random.Random(6)
    word = lambda: f"q{rng.randrange(10**6)}"
    rows = [(k, " ".join(word() for _ in range(5 + k % 7))) for k in range(280)]
    items = decontam.Items(rows, 0.8)
    texts = []
    for k, t in rows:
        w = t.split()
        w = w[: len(w) - (k % 7 >= 4)]  # of 5 to 7 shingles the last may be missing
        texts.append(" ".join([*(word() for _ in range(300)), *w, *(word() for _ in range(300))]))
    got = items.found(texts)
    assert [[i for i, _ in x] for x in got] == [[k] for k, _ in rows]
    assert all(x[0][1] == (1 if k % 7 < 4 else pytest.approx((k % 7) / (k % 7 + 1))) for k, x in enumerate(got))
    same = decontam.Items([(1, "a b c d e"), (2, "a b c d e f"), (3, "A, b c d e")], 0.8)
    assert same.found(["a b c d e f", "a b c d e", ""]) == [[(1, 1.0), (2, 1.0), (3, 1.0)], [(1, 1.0), (3, 1.0)], []]


def test_decontamination_odd(spark):
    bench = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    assert decontam.pairs(odd(spark), bench).count() == 0 and decontam.keep_clean(odd(spark), bench.limit(0)).count() == len(ODD)
    assert decontam.pairs(odd(spark).limit(0), bench).count() == 0
    twice = spark.createDataFrame([(3, "x ONE two, three four five y"), (3, "x ONE two, three four five y")], "doc_id long, text string")
    assert [tuple(r) for r in decontam.pairs(twice, bench).collect()] == [(3, 1, 1.0)]


# --- Substrings --------------------------------------------------------------------------------

def plain_removal(texts):
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(split):
        for k in range(len(split[i]) - 49):
            first.setdefault(tuple(split[i][k : k + 50]), i)
    out = {}
    for i, w in split.items():
        off = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                off.update(range(k, k + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in off)
        out[i] = (len(w), len(off), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substrings_equal_brute_force(spark, docs):
    rng = random.Random(10)
    texts = {r["doc_id"]: r["text"] for r in docs.limit(300).collect()}
    word = lambda: f"v{rng.randrange(40)}"
    shared = [word() for _ in range(300)]
    for k in range(150):  # passages of 45 to 120 words at any alignment, a hot one, periodic texts, exact copies
        a, n = rng.randrange(180), rng.randrange(45, 121)
        texts[5000 + k] = " ".join([*(word() for _ in range(rng.randrange(70))), *shared[a : a + n], *(word() for _ in range(rng.randrange(70)))])
    for k in range(12):
        texts[6000 + k] = "\n".join(["la li lu"] * (10 + 5 * k))
        texts[7000 + k] = texts[5000 + k]
    texts |= {8000: None, 8001: "", 8002: " ".join(shared[:49]), 8003: " ".join(shared[:50])}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumns({"h": F.lit(1), "whole": F.lit(2), "starts": F.lit("x")})
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.remove_repeats(frame, digest=True).collect()}
    assert got == plain_removal(texts)


def test_substrings_of_rows_that_repeat_an_id(spark):
    """What one text of an id loses is no loss of another."""
    a, b = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    frame = spark.createDataFrame([(1, a), (2, a), (2, b), (2, b + " x " + a)], "doc_id long, text string")
    got = sorted(map(tuple, substring.remove_repeats(frame).select("doc_id", "n_removed", "kept_text").collect()))
    assert got == sorted([(1, 0, a), (2, 60, ""), (2, 0, b), (2, 60, b + " x")])


def test_substrings_odd(spark):
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring.remove_repeats(odd(spark)).collect())
    assert got == Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), 0) for i, t in ODD)
    assert substring.remove_repeats(odd(spark).limit(0)).count() == 0


# --- Sharding ----------------------------------------------------------------------------------

def check_shards(out, texts, shards, spread):
    assert len(out) == len(texts)
    by_shard = defaultdict(list)
    for r in out:
        text = texts[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 8 and r["text_crc32"] == zlib.crc32(text.encode()) and r["law"] == "bytes" and r["grown_shard"] is None
        by_shard[r["shard"]].append(r)
    assert set(by_shard) <= set(range(shards))
    for rows in by_shard.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    share, largest = sum(r["size"] for r in out) / shards, max(r["size"] for r in out)
    assert all(abs(sum(r["size"] for r in rows) - share) <= spread * share + 2 * largest for rows in by_shard.values())


@pytest.mark.parametrize("how", [{}, {"range_rows": 20, "samples": 2}])
def test_sharding(spark, docs, how):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    texts |= {10_000 + k: "one hot text of a third of all rows, more or less " * 30 for k in range(600)} | {20_000: None, 20_001: ""}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumns({"shard": F.lit(1), "slot": F.lit("x"), "lang": F.lit("en")})
    out = sharding.assign_shards(frame, 24, keep=("shard", "lang"), **how)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "lang"]
    rows = out.collect()
    check_shards(rows, texts, 24, 0.03)
    places = defaultdict(set)
    for r in rows:
        places[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for s in places.values()) == 1  # only the hot text is divided


def test_sharding_subdivides_overfull_ranges(spark):
    rows = spark.range(4000).select(F.lpad(F.hex(F.xxhash64("id")), 16, "0").alias("__key"), F.col("id").alias("doc_id"), F.lit(10).cast("long").alias("size"))
    splitters, sums = sharding._ranges(rows, quota=400.0, total=40_000, samples=1, seed=1)
    assert sum(n for n, _, _ in sums.values()) == 4000 and max(b for _, b, _ in sums.values()) <= 800 and splitters == sorted(set(splitters))


def test_sharding_odd(spark):
    got = sharding.assign_shards(odd(spark), 3).collect()
    assert len(got) == len(ODD) and sum(r["doc_id"] is None for r in got) == 1 and {r["slot"] for r in got} <= set(range(len(ODD)))
    assert sharding.assign_shards(odd(spark).limit(0)).count() == 0
    assert sharding.assign_shards(odd(spark).limit(1), 24).count() == 1


def test_written_shards(spark, docs, tmp_path):
    out = sharding.assign_shards(docs, 5, keep=("text", "lang"))
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == docs.count() and set(back.columns) == set(out.columns)
    assert sorted(r["shard"] for r in back.select("shard").distinct().collect()) == list(range(5))


def test_sharding_is_native(spark):
    plan = queries.QUERIES["op9_sharding"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- Pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages(spark, docs):
    before = docs
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = {r["item_id"]: r["text"] for r in table(spark, SF, "benchmark").collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        if name == "language ID":
            assert ids == {i for i, t in texts.items() if re.search(r"[^\W\d_]", t or "")}
        elif name == "n-gram Jaccard join":
            whole = classes(texts, near_pairs(texts))
            assert ids == {i for i in texts if whole[i] == i}
        elif name == "benchmark decontamination":
            assert ids == set(texts) - {d for d, _ in contained(texts, items)}
        elif name == "PII":
            assert ids == set(texts) and all(r["n_chars"] == len(r["text"]) for r in after.collect())
            changed = {r["doc_id"] for r in after.collect() if r["text"] != texts[r["doc_id"]]}
            assert changed and len(changed) < len(ids) / 5
        else:
            digest = {r["doc_id"]: r["decoded_sha256"] for r in after.collect()}
            assert digest == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}
        if "text" in after.columns:
            texts = {r["doc_id"]: r["text"] for r in after.select("doc_id", "text").collect()}
        seen.append(len(ids))
        before = after
    assert seen[0] > seen[1] > seen[2] == seen[3] == seen[4]
    assert corpus_pipeline.run(spark, SF).count() == seen[-1]


def test_pipeline_odd(spark):
    before = odd(spark, "doc_id long, text string, n_chars double, lang string, source string, rep string, k1 int, paths int, whole int, copies int, n int").withColumn("lang", F.lit("en"))
    before = before.withColumn("n_chars", F.length("text").cast("long"))
    for rows in (before, before.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF)
        rows.count()


@pytest.mark.parametrize("bits", [27, 10])
def test_sifting_loses_no_match(spark, bits):
    rows = spark.range(20000).select(F.when(F.col("id") % 100 != 7, F.col("id")).alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 3).alias("mark"))
    wanted = spark.range(50, 20000, 400).select(F.col("id").alias("a"), F.concat(F.lit("t"), F.col("id") % 3).alias("b"))
    told = sifted(rows, [F.col("doc_id"), F.col("mark")], wanted, bits)
    assert told.columns == ["doc_id", "mark", "__may"]
    assert told.count() == 20000
    may = told.filter("__may").select("doc_id", "mark")
    assert wanted.exceptAll(may).count() == 0
    assert may.count() <= 20000 * (0.01 if bits == 27 else 0.25)
    assert sifted(rows, [F.col("doc_id"), F.col("mark")], wanted.limit(0), bits).filter("__may").count() == 0


def test_only_texts_with_candidates_are_shuffled(spark, monkeypatch):
    """Of texts without a near copy few reach the joins that shuffle texts, whatever may be broadcast."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda k: F.md5(
        F.concat_ws(":", F.greatest("id", F.lit(9)), k))), " ").alias("text"))  # 0 to 9 are copies
    passed = []

    def counted(rows, keys, wanted, **more):
        told = sifted(rows, keys, wanted, **more)
        passed.append(told.filter("__may").count())
        return told

    monkeypatch.setattr(lshforest, "sifted", counted)
    kept = lshforest.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(10, 3000)]
    assert len(passed) == 2 and max(passed) <= 60
