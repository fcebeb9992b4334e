"""What running tasks hold at once: Python passes over a text, and arrays that idle workers keep."""

import re

import numpy as np

from tractweave.llm import decontaminate, packed, toxicity

BENCHMARK = " ".join(f"item{i}" for i in range(10))


def passes(df):
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow ")


def test_passages_are_cut_in_the_pass_that_finds_them(spark):
    rows = [(1, f"head {BENCHMARK.upper()} tail", 5), (2, BENCHMARK, 5), (3, None, 5), (4, "other words", 5), (None, f"é {BENCHMARK}\n{BENCHMARK}", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_Words long")
    benchmark = spark.createDataFrame([(7, BENCHMARK), (8, None)], "item_id long, text string")
    cut = decontaminate.remove_passages(docs, benchmark)
    assert passes(cut) == 1
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert left == {1: "head \n tail", 3: None, 4: "other words", None: "é \n"}
    in_blocks = decontaminate.remove_passages(docs, benchmark.unionByName(benchmark), decontaminate.DecontaminationConfig(block_bytes=20))
    assert {r.doc_id: r.text for r in in_blocks.collect()} == left


def test_idle_workers_keep_no_powers():
    data = np.arange(3 << 20, dtype=np.uint64).astype(np.uint8)
    before = packed.prefix_hashes(data)
    packed.release()
    assert sum(x.nbytes for x in packed._powers.values()) < 100
    assert (packed.prefix_hashes(data) == before).all()


def test_scores_come_back_without_texts(spark):
    docs = spark.createDataFrame([(1, "you idiot", "en"), (2, None, "de"), (None, "fine words", "fr")], "doc_id long, text string, lang string")
    lexicon = toxicity.Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    trees = toxicity.Trees(0.0, np.zeros((1, 1), int), np.array([[0.1]]), np.array([[-1.0, 1.0]]), np.array([-1.0, 1.0]), np.array([0.2, 0.8]))
    model = toxicity.ToxicityModel(lexicon, trees)
    bare, whole = (toxicity.score_toxicity(docs, model, with_text) for with_text in (False, True))
    assert bare.columns == ["doc_id", "lang", "score"]
    assert sorted(map(str, bare.collect())) == sorted(map(str, whole.drop("text").collect()))
    many = spark.range(200).selectExpr("id AS doc_id", "concat('word', id) AS text")
    table = toxicity.toxicity_table(many, many.selectExpr("doc_id", "doc_id % 2 AS toxic"))
    plan = table._jdf.queryExecution().analyzed().toString()
    assert re.search(r"MapInArrow scored\(.*\[doc_id#\d+L?, score#\d+\]", plan)
