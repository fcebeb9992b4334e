"""Filter audit, whitening and MinHash against brute force, and on awkward tables."""

import os
import re
import subprocess
import sys
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tractweave.llm import components, filter_audit, linking, minhash, ngram_join, whitening
from tractweave.operators import scale

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"Word{i % 977}" for i in range(40_000))
COPY = " ".join(f"w{i}" for i in range(120))


def awkward_rows():
    texts = [None, "", " \n\t ", "one", COPY, COPY, COPY.replace("w7 ", "v7 "), COPY + " #", "A B C D " * 40, LONG, LONG + " end", "na " * 300, "ñé 漢字 " * 90]
    rows = [(i, t, ["en", "de", None, ""][i % 4], "s", 1) for i, t in enumerate(texts)]
    return [*rows, (4, COPY, "fr", "s", 1), (4, "one", "fr", "s", 1), (5, COPY, "en", None, None), (None, COPY, None, None, None), (None, None, None, None, None)]


LABELS = [(i, i % 2, int(i % 3 == 0)) for i in range(12)] + [(4, 1, None), (3, None, None), (None, 1, 1), (4, 0, 1)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def clashing(df, *names):
    for name in names:
        df = df.withColumn(name, F.lit("old"))
    return df


WORKERS = {
    "ngram_join": """
raw, offsets = packed.buffers(pa.array(["a b c d e f", "a b c d e f g", "x"]))
ids, schema = pa.array([1, 2, 3]), m._packet(pa.int64())
rows = m._packets(ids, ids, raw, offsets, 0, 3, m.JoinConfig()).to_pylist()
replies = [r for row in rows for r in m._merge_bucket(pa.Table.from_pylist([row], schema), 3, 64).to_pylist()]
assert len(m._assemble(pa.Table.from_pylist(replies, schema), 3)) == 3
""",
    "substring_dedup": """
own = dict(to=-1, slice=0, hashes=b"", extra=b"", many=b"", keys=[])
m._split(pa.Table.from_pylist([own], m._PACKET))
""",
}


@pytest.mark.parametrize("module", WORKERS)
def test_workers_import_what_they_use(module):
    """A worker loads a module alone; nothing else may have imported its helpers for it."""
    code = f"import pyarrow as pa\nfrom tractweave.llm import packed, {module} as m\n{WORKERS[module]}"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr


# 11
def brute_audit(rows, labels):
    good, toxic = defaultdict(int), defaultdict(int)
    for i, q, t in labels:
        if i is not None:
            good[i] |= q == 1
            toxic[i] |= t == 1
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, text, lang, *_ in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": i is not None and i > least[text],
        }
        docs.append((lang or "", {f for f, bad in fails.items() if bad}, int(good[i]), int(toxic[i])))
    out, by_filter = [], Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [d for d in own if f in d[1] and not d[1] & before]
                row = [part, "".join(order), step, sum(not d[1] & (before | {f}) for d in own), len(removed)]
                row += [sum(f in d[1] for d in own) - len(removed), sum(d[1] == {f} for d in own), sum(d[2] for d in removed), sum(d[3] for d in removed)]
                out.append(row)
                by_filter[part, f] += len(removed)
    return sorted(tuple([*r, by_filter[r[0], r[1][r[2] - 1]]]) for r in out)


def test_audit_against_brute_force(awkward, labels):
    docs = clashing(awkward, "mask", "name", "n", "part", "words", "salt", "good")
    got = sorted(map(tuple, filter_audit.audit_filters(docs, labels).collect()))
    assert got == brute_audit(awkward_rows(), LABELS) and len(got) == 600 * 4


def test_audit_of_no_rows_and_other_filters(spark, awkward, labels):
    assert filter_audit.audit_filters(spark.createDataFrame([], SCHEMA), labels).count() == 0
    own = {"S": lambda text, words: F.length(text) < 5}
    got = filter_audit.audit_filters(awkward, labels.limit(0), "source", own, "R").collect()
    assert {r.filter_order for r in got} == {"SR", "RS"} and {r.part for r in got} == {"s", ""}
    assert all(r.good_lost == r.toxic_lost == 0 for r in got)
    with pytest.raises(ValueError):
        filter_audit.audit_filters(awkward, labels, "lang", own, "S")


def test_gray_walk_visits_every_subset():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 9, (3, 32, 2))
    states = filter_audit.gray_walk(cells)
    for subset in range(32):
        passing = (np.arange(32) & subset) == 0
        assert (states[:, subset] == cells[:, passing].sum(axis=1)).all()


# 12
def brute_whitening(vectors):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors])
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(axis=0)
    centred = distinct - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s, strict=True)) for v in x]
    k = min(16, x.shape[1])
    values, axes = values[::-1], axes[:, ::-1]
    return n, deviation, (x - s / n) @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_whitening_against_numpy(spark, sf):
    table = clashing(spark.read.parquet(f"{sf}/embeddings.parquet"), "x", "h1", "n", "whitened", "part", "id")
    hot = table.limit(1).select(F.explode(F.expr("sequence(10000L, 12500L)")).alias("vec_id"), "embedding")
    odd = spark.createDataFrame(
        [(-1, None), (-2, [1.0, None] * 32), (-3, [float("nan")] * 64), (-4, [float("inf")] + [0.0] * 63), (-5, [1.0]), (-6, [])], "vec_id long, embedding array<float>"
    )
    every = table.select("vec_id", "embedding").unionByName(hot).unionByName(odd)
    kept = every.filter("vec_id >= 0").toPandas().sort_values("vec_id")
    n, deviation, want, explained = brute_whitening(kept.embedding.tolist())
    got = whitening.whitening_table(every).toPandas()
    assert len(got) == 16 * len(kept) and set(got.n) == {n}
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[kept.vec_id].to_numpy()
    signs = np.sign((wide * want).sum(axis=0))
    assert np.abs(wide - want * signs).max() < 1e-6
    assert got[got.component == 1].set_index("vec_id").loc[kept.vec_id].deviation.tolist() == deviation
    assert np.allclose(got[got.vec_id == 10_000].sort_values("component").explained, explained, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10
    assert whitening.whitening_table(table).count() == 16 * table.count()


def test_weights_count_copies(spark):
    rows = [(i, [float(i % 5), float(i % 3), float(i * i % 7)]) for i in range(60)] + [(100 + i, [9.0, 1.0, 2.0]) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out, fit, error = whitening.whiten(table, config=whitening.WhitenConfig(weights="count"))
    x = np.floor(64 * np.array([v for _, v in rows])) + 1_000_000
    assert fit.n == len(rows) and fit.sums == x.sum(axis=0).astype(int).tolist() and error < 1e-10
    assert np.allclose(fit.values, np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1])
    assert np.allclose(np.cov(np.array([r.whitened for r in out.collect()]).T, bias=True), np.eye(3), atol=1e-9)


def test_degenerate_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitening_table(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitening_table(spark.createDataFrame([(1, []), (2, None)], schema)).count() == 0
    same = whitening.whitening_table(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])], schema)).collect()
    assert len(same) == 8 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 for r in same)
    huge = whitening.whitening_table(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 0.0])], schema)).collect()
    assert len(huge) == 6 and any(r.deviation is None for r in huge)
    with pytest.raises(ValueError):
        whitening.whitening_table(spark.createDataFrame([(1, [0.0] * 9)], schema), whitening.WhitenConfig(max_dims=8))


# 13
def word_sets(rows, shingle):
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        yield {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set()


def brute_components(rows, shingle=4):
    sets = list(word_sets(rows, shingle))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        if i is not None and (least[find(k)] is None or i < least[find(k)]):
            least[find(k)] = i
    out = []
    for k, (i, _) in enumerate(rows):
        c = least[find(k)] if sets[k] else i
        out.append((i, len(sets[k]), c, i == c))
    return sorted(out, key=str)


@pytest.mark.parametrize("config", [minhash.MinHashConfig(), minhash.MinHashConfig(slice_bytes=30_000, block_sets=2)])
def test_minhash_against_brute_force(spark, sf, awkward, config):
    near = spark.read.parquet(f"{sf}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    docs = clashing(awkward.select("doc_id", "text").unionByName(near), "name", "sid", "n", "home", "docs", "buckets")
    want = brute_components([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = minhash.minhash_components(docs, config)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == want


def near_copies(n, edits, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [f"w{j}" for j in range(150)]
        for at in rng.integers(0, 150, rng.integers(0, edits)):
            words[at] = f"v{rng.integers(0, 400)}"
        rows.append((i, " ".join(words)))
    return rows


def test_minhash_in_large_buckets(spark, monkeypatch):
    rows = near_copies(250, 9)  # many pairs on both sides of the limit, buckets of several blocks
    monkeypatch.setattr(scale, "HOT_ROWS", 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.minhash_components(docs, minhash.MinHashConfig(block_sets=32)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)


def test_minhash_ids_of_text_and_no_rows(spark):
    schema = "doc_id string, text string"
    assert minhash.minhash_components(spark.createDataFrame([], schema)).count() == 0
    got = minhash.minhash_components(spark.createDataFrame([("b", COPY), ("a", COPY), ("c", None), (None, "x y")], schema)).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {("b", "a", False), ("a", "a", True), ("c", "c", True), (None, None, True)}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    config = minhash.MinHashConfig()
    shared, left, right = (rng.integers(0, 1 << 64, k, np.uint64) for k in (800, 100, 100))
    sets = [np.concatenate([shared, left]), np.concatenate([shared, right])]
    least = minhash.minima(np.concatenate(sets), np.array([0, 900]), *minhash.universal_hashes(config))
    assert abs((least[0] == least[1]).mean() - 0.8) < 0.15
    assert (minhash.band_values(least, config)[0] == minhash.band_values(least, config)[1]).any()


@pytest.mark.parametrize("hot", [1000, 3])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(scale, "HOT_ROWS", hot)
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(1000, 1000 + i) for i in range(1, 60)] + [(2000 + i, 2001 + i) for i in range(40)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for x in root if any(find(x) == find(y) for y in root if y != x)}
    got = components.connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == want


# 9: rows, not ids, and pairs, not groups
def test_near_duplicate_rows_with_repeated_ids(spark):
    other, third = " ".join(f"x{i}" for i in range(50)), " ".join(f"y{i}" for i in range(50))
    schema = "doc_id long, text string, name string"

    def left(rows):
        return sorted((r.doc_id, r.text) for r in ngram_join.drop_near_duplicates(spark.createDataFrame([(*r, "old") for r in rows], schema)).collect())

    assert left([(3, COPY), (5, COPY), (5, other)]) == [(3, COPY), (5, other)]
    assert left([(5, COPY), (5, other), (7, third)]) == sorted([(5, COPY), (5, other), (7, third)])
    assert left([(5, COPY), (5, COPY), (5, COPY + " end"), (6, None), (6, None)])[0][0] == 5
    assert len(left([(5, COPY), (5, COPY), (5, COPY + " end"), (6, ""), (6, "")])) == 3


def test_ngram_join_ids_of_text(spark):
    rows = [("b", COPY), ("a", COPY), ("c", None), (None, "x y")]
    got = ngram_join.near_duplicate_components(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {("b", "a"), ("a", "a"), ("c", "c"), (None, None)}


def test_templates_are_not_compared_all_with_all(spark):
    """Documents of 10 passages from 200 share entries in chains, but no two are linked."""
    rng = np.random.default_rng(11)
    passages = [" ".join(f"s{i}w{j}" for j in range(60)) for i in range(200)]
    rows = [(i, " ".join(passages[k] for k in rng.choice(200, 10, replace=False))) for i in range(800)]
    sets = ngram_join.ngram_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    names = linking.distinct_names(sets)
    members = linking.buckets(sets.filter("buckets IS NOT NULL").select("sid", "buckets"))
    entries = sets.filter("buckets IS NOT NULL").select(F.sum(F.size("buckets"))).first()[0]
    compared = linking.in_blocks(members.withColumn("root", F.col("sid")), linking.BLOCK_SETS).count()
    assert compared <= entries  # a row per set and shared entry, not per pair of sets
    assert ngram_join.set_roots(sets, names).isEmpty()


def test_links_beyond_the_best_pair(spark):
    """A set that two others alone share buckets with is linked with both."""
    base = [f"w{i}" for i in range(100)]
    one = [*base[:90], *[f"p{i}" for i in range(10)]]
    two = [*[f"q{i}" for i in range(10)], *base[10:]]
    rows = [(i, " ".join(x)) for i, x in enumerate([one, two, base])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for got in (minhash.minhash_components(docs), ngram_join.near_duplicate_components(docs)):
        assert {r.component_id for r in got.collect()} == {0}


def test_bitmaps_never_deny_a_link():
    rng = np.random.default_rng(3)
    for n in (1, 4, 5, 40, 900, 6000):
        for share in (0.79, 0.8, 0.85, 1.0):
            both = round(n * 2 * share / (1 + share))
            one, two = (np.concatenate([common, rng.integers(0, 1 << 63, n - both, np.uint64)]) for common in [rng.integers(0, 1 << 63, both, np.uint64)] for _ in "ab")
            linked = 100 * both >= 80 * (2 * n - both)
            sizes = [np.array([n])] * 2
            bits = [ngram_join.parity_bitmap(x)[None] for x in (one, two)]
            may = ngram_join.may_overlap(sizes[0], sizes[0], bits[0], sizes[1], sizes[1], bits[1])[0]
            assert may or not linked
    far = [ngram_join.parity_bitmap(rng.integers(0, 1 << 63, 300, np.uint64))[None] for _ in "ab"]
    assert not ngram_join.may_overlap(np.array([300]), np.array([300]), far[0], np.array([300]), np.array([300]), far[1])[0]
