"""Every operator against brute force or SQL, and on awkward tables: NULLs, empty and long texts, ties, clashing columns."""

import glob
import hashlib
import os
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tractweave.llm import (
    decontaminate,
    fm_index,
    licenses,
    line_dedup,
    mixing,
    ngram_join,
    quality_bayes,
    quality_rules,
    queries,
    sharding,
    substring_dedup,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"passage{i}" for i in range(60))
COPY = "\n".join(" ".join(f"line{i}word{j}" for j in range(12)) for i in range(9))


def awkward_rows():
    texts = [
        None,
        "",
        " \n\t ",
        "one",
        "Solo LINE",
        COPY,
        COPY,
        COPY.replace("line3word3", "other"),
        "start\n" + PASSAGE + "\nend one",
        "another start\n" + PASSAGE + "\nand more",
        "na " * 3000,
        "x" * 5000,
        "you are an idiot, you stupid LOSER!! " * 3,
        "ñandú größe çà été 漢字 " * 40,
        "a\r\nb\x0bc\x0cd",
    ]
    rows = [(i, t, ["en", "de", None][i % 3], f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, (5, COPY, "en", "src0", len(COPY)), (None, COPY, None, None, 3), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i == 12)) for i in range(15)] + [(3, None, None), (None, 1, 1), (4, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [("7", PASSAGE), ("8", "Solo line"), ("9", None), ("10", ""), (None, "one"), ("8", "never seen words")]
    return spark.createDataFrame(items, "item_id string, text string")


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(map(tuple, got.select(*columns).collect()))
    assert rows == sorted(tuple(r) for r in want.select(*columns).fetchall())


def test_empty_tables(spark, empty, labels, benchmark):
    assert decontaminate.decontamination_table(empty, benchmark).count() == 0
    assert toxicity.toxicity_table(empty, labels).count() == 0
    assert sharding.shard_table(empty).count() == 0
    assert quality_bayes.quality_table(empty, labels).count() == 0
    assert mixing.mix_table(empty, labels).count() == 0
    assert licenses.license_table(empty).count() == 0
    assert quality_rules.rules_table(empty).count() == 0
    assert substring_dedup.substring_table(empty).count() == 0
    assert ngram_join.near_duplicate_components(empty).count() == 0
    assert line_dedup.line_table(empty).count() == 0


def test_one_row_per_input_row(awkward, labels, benchmark):
    n = awkward.count()
    assert decontaminate.decontamination_table(awkward, benchmark).count() == n
    assert toxicity.toxicity_table(awkward, labels).filter("score BETWEEN 0 AND 1").count() == n
    assert quality_bayes.quality_table(awkward, labels).filter("score BETWEEN 0 AND 1").count() == n
    assert mixing.mix_table(awkward, labels).filter("rate >= 0").count() == n
    assert licenses.license_table(awkward).count() == n
    assert quality_rules.rules_table(awkward).count() == n
    assert line_dedup.line_table(awkward).count() == n


def test_clashing_columns_are_replaced(awkward, labels, benchmark):
    extra = awkward
    for name in ("score", "spans", "items", "n_words", "shard", "slot", "rate", "kept", "kept_text", "licenses", "note"):
        extra = extra.withColumn(name, F.lit("old"))
    assert {r.score for r in toxicity.score_toxicity(extra, toxicity.train_toxicity(awkward, labels)).collect()} != {"old"}
    assert decontaminate.find_passages(extra, benchmark).filter("note = 'old'").count() == awkward.count()
    sized = extra.withColumn("size", sharding.text_bytes())
    assert dict(sharding.assign_shards(sized, 3).dtypes)["shard"] == "int"
    assert dict(line_dedup.drop_repeated_lines(extra).dtypes)["n_lines"] == "bigint"
    assert dict(licenses.scan(extra).dtypes)["licenses"].startswith("array")


# 1
def test_fm_index_against_plain_search():
    rng = np.random.default_rng(3)
    text = np.concatenate([rng.integers(0, 5, 700), np.tile([1, 2, 3], 40), [0]])
    index = fm_index.FMIndex(text, 5)
    for length in (1, 2, 4, 9):
        at = rng.integers(0, len(text) - length, 60)
        patterns = np.unique(np.array([text[i : i + length] for i in at]), axis=0)
        patterns = patterns[(patterns > 0).all(1)]
        low, high = index.search(patterns)
        for p, a, b in zip(patterns, low, high, strict=True):
            want = [i for i in range(len(text) - length + 1) if (text[i : i + length] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_decontamination_blocks_and_cuts(awkward, benchmark):
    whole = decontaminate.find_passages(awkward, benchmark).collect()
    config = decontaminate.DecontaminationConfig(block_bytes=50, shard_bytes=100)
    assert sorted(map(str, decontaminate.find_passages(awkward, benchmark, config).collect())) == sorted(map(str, whole))
    by = {r.doc_id: r for r in whole if r.doc_id is not None}
    assert by[8].n_hit == 60 and by[8]["items"] == ["7"] and by[4]["items"] == ["8"] and by[3].n_hit == 0
    assert by[0].n_words == 0 and by[11].n_hit == 0
    left = {r.doc_id: r for r in decontaminate.remove_passages(awkward, benchmark).collect()}
    assert 4 not in left  # nothing but the item
    assert left[8].text == "start\n\n\nend one" and left[8].n_chars == len(left[8].text)
    assert left[5].text == COPY


# 2
def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.toxicity_table(documents(spark, sf), known).filter("held_out").join(known, "doc_id").toPandas()
    rank, bad = out.score.rank(), out.toxic == 1
    auc = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert auc > 0.93 and out.predicted[~bad].mean() < 0.03 and out.predicted[bad].mean() > 0.8


def test_isotonic_is_monotone():
    rng = np.random.default_rng(0)
    raw = rng.normal(size=500)
    points, levels = toxicity.isotonic(raw, (rng.random(500) < 1 / (1 + np.exp(-2 * raw))).astype(float))
    assert (np.diff(points) >= 0).all() and (np.diff(levels) >= 0).all() and 0 < levels[0] and levels[-1] < 1


# 3
def check_shards(rows, n_shards):
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    by = defaultdict(list)
    for r in ordered:
        by[r.shard].append(r)
    for members in by.values():
        assert [r.slot for r in members] == list(range(len(members)))
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    for s in range(n_shards):
        assert abs(sum(r.size for r in by[s]) - total / n_shards) <= largest
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)


def test_shards(spark, sf, awkward):
    docs = documents(spark, sf)
    rows = sharding.shard_table(docs).collect()
    check_shards(rows, 40)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 16 for r in rows)
    check_shards(sharding.shard_table(awkward, 3).collect(), 3)
    hot = docs.limit(1).select(F.lit(1).cast("long").alias("doc_id"), "text", F.explode(F.sequence(F.lit(1), F.lit(500))).alias("i"))
    sizes = Counter(r.shard for r in sharding.shard_table(hot).collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1  # one id in all rows is spread all the same


# 4
def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_bayes.quality_table(documents(spark, sf), known).filter("held_out").join(known, "doc_id").toPandas()
    assert ((out.score >= 0.5) == (out.quality == 1)).mean() > 0.97


def test_sparse_sites_are_drawn_to_the_whole(spark):
    rows = [("a", "p", 1.0, 1.0)] * 200 + [("b", "p", 1.0, 0.0)] * 200 + [("c", "p", 1.0, 1.0)] + [(None, None, 1.0, 0.0)]
    rates = {r._host: r.host_rate for r in quality_bayes.site_posteriors(spark.createDataFrame(rows, "_host string, _path string, w double, e double")).collect()}
    assert rates["a"] > 0.97 and rates["b"] < 0.03 and 0.5 < rates["c"] < rates["a"] and None in rates


# 5
def test_mixture_meets_its_targets(spark):
    sf = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{sf}/labels.parquet")
    for targets in (mixing.TARGETS, {**mixing.TARGETS, "en/1": 0.10, "de/1": 0.56}):
        out = mixing.mix_rates(documents(spark, sf).select("doc_id", "lang", "text"), known, mixing.MixConfig(targets=targets)).toPandas()
        tokens = np.array(out.posterior.tolist()).T @ (out.rate * out.n_tokens)
        wanted = np.array(list(targets.values())) / sum(targets.values())
        assert out.rate.min() >= 0 and np.abs(tokens / out.n_tokens.sum() - wanted).max() < 2e-3
    assert abs((out.copies * out.n_tokens).sum() / out.n_tokens.sum() - 1) < 0.1


# 6
def test_licenses(spark):
    texts = ["Licensed under the Apache License, Version 2.0.", "x\nreleased UNDER the mit license\ny", "the license", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.licenses for r in licenses.license_table(docs).collect()}
    assert found == {0: "Apache-2.0", 1: "MIT", 2: "", 3: ""}


# 7
def test_ablation_counts(awkward):
    book = quality_rules.ledger(awkward)
    bits = [r.failed_bits for r in book.collect()]
    for r in quality_rules.ablation(book, 2).collect():
        bit = quality_rules.mask_of([r.rule])
        assert r.n_failed == sum(1 for b in bits if b & bit)
        assert r.n_only == sum(1 for b in bits if b == bit)
        assert r.n_kept_without == sum(1 for b in bits if b & ~bit == 0)


# 8
def brute_substrings(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        edge = np.zeros(len(t) + 1, int)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                edge[p] += 1
                edge[p + length] -= 1
        gone = np.cumsum(edge)[: len(t)] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_bytes", [4 << 20, 20_000])
def test_substrings(spark, sf, awkward, slice_bytes):
    docs = awkward.select("doc_id", "text").unionByName(documents(spark, sf).select("doc_id", "text").filter("length(text) < 6000"))
    want = brute_substrings([tuple(r) for r in docs.collect()])
    got = substring_dedup.substring_table(docs, substring_dedup.SubstringConfig(slice_bytes=slice_bytes)).collect()
    assert sorted(map(tuple, got), key=str) == want


# 9
def brute_components(rows):
    sets = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        if i is not None and (least[find(k)] is None or i < least[find(k)]):
            least[find(k)] = i
    return sorted(((i, len(sets[k]), least[find(k)] if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("config", [ngram_join.JoinConfig(), ngram_join.JoinConfig(frequent=2, slice_bytes=30_000, block_sets=4)])
def test_ngram_join(spark, sf, awkward, config):
    docs = awkward.select("doc_id", "text").unionByName(documents(spark, sf).select((F.col("doc_id") + 100).alias("doc_id"), "text"))
    want = brute_components([tuple(r) for r in docs.collect()])
    assert sorted(map(tuple, ngram_join.near_duplicate_components(docs, config).collect()), key=str) == want


def test_hot_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 5)):
            words[at] = f"v{rng.integers(0, 400)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_duplicate_components(docs, ngram_join.JoinConfig(frequent=8, block_sets=64)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)


def test_near_duplicates_leave_one(awkward):
    kept = ngram_join.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[5] == 1 and ids[6] == 0 and ids[None] == 2 and all(n == 1 for i, n in ids.items() if i is not None)


# 10
def test_line_windows(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "q\nq\nq\nq\nq"), (4, "\n\n\n\n"), (5, "a\nb")]
    out = {r.doc_id: r for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.kept_text for i, r in out.items()} == {1: "a\nb\nc\nd", 2: "x\ny", 3: "q", 4: "\n\n\n\n", 5: "a\nb"}
    assert (out[2].n_removed, out[2].n_spans, out[3].n_removed) == (3, 1, 4)


# pipeline
def test_pipeline_stages(spark, sf):
    docs = documents(spark, sf)
    known, items = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)

    clean = corpus_pipeline.stage(stages["toxicity"](spark, docs, sf), "t")
    predicted = toxicity.toxicity_table(docs, known)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in predicted.filter("predicted = 0").collect()}

    single = corpus_pipeline.stage(stages["ngram_join"](spark, clean, sf), "t")
    want = brute_components([tuple(r) for r in clean.select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, _, c in want if i == c)

    cut = corpus_pipeline.stage(stages["decontamination"](spark, single, sf), "t")
    hit = {r.doc_id for r in decontaminate.decontamination_table(single, items).filter("contaminated").collect()}
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (single, cut))
    assert hit and all(after[i] == before[i] for i in before if i not in hit)
    assert all(i not in after or len(after[i]) < len(before[i]) for i in hit)

    mixed = corpus_pipeline.stage(stages["mixing"](spark, cut, sf), "t")
    copies = {r.doc_id: r.copies for r in mixing.mix_table(cut, known).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(copies)
    assert all(df.columns == docs.columns for df in (clean, single, cut, mixed))

    out = stages["sharding"](spark, mixed, sf)
    check_shards(out.collect(), 40)
