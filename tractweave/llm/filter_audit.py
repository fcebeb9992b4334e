"""Interaction of filters: what every step of every order of the filters removes, from one walk over the subsets of filters.

1. Every document gets a mask with one bit per filter it fails. Documents are counted by part and mask, so the rest of the
   work handles 2**k cells a part, however many documents there are.
2. The subsets of filters are visited in Gray-code order: one filter is toggled at a time. A counter per cell holds how many
   active filters it fails; cells whose counter leaves or reaches 0 leave or rejoin the running survivors. The survivors of
   all 2**k subsets (32 for five filters) are stored.
3. A step of an order is the difference of two stored states, so are the documents that a filter alone would remove.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tractweave.functions.local import small_table
from tractweave.operators.scale import stage

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
MAX_FILTERS = 7
"""Orders grow with the factorial of the number of filters."""

MEASURES = ("n", "good", "toxic")


def content_filters() -> dict[str, Callable[[Column, Column], Column]]:
    """Failure conditions of a text and its words."""
    return {
        "A": lambda text, words: F.size(words) < 100,
        "B": lambda text, words: F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": lambda text, words: F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * 10,
        "D": lambda text, words: text.rlike("[#$%&*|]"),
    }


def _masked(docs: DataFrame, part: str, filters: Mapping[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """``doc_id``, part, mask of the content filters and a name of the text, none of the text itself."""
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", WORD_BREAK), ""))
    bits = [F.when(fails(F.col("text"), F.col("words")), 1 << i).otherwise(0) for i, fails in enumerate(filters.values())]
    return rows.select("doc_id", "part", sum(bits, F.lit(0)).alias("mask"), F.unhex(F.sha2("text", 256)).alias("name"))


def filter_cells(
    docs: DataFrame,
    labels: DataFrame,
    part: str = "lang",
    filters: Mapping[str, Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and mask of failed filters. The highest bit is the filter on
    repeats: it fails a document whose text also stands under a smaller ``doc_id``, in any part.

    Copies are counted before they meet: what is shuffled by text has one row per text, part and label, so a text that a
    third of all rows hold is a handful of rows per task. Rows that repeat an id are rows of their own, equal ids are not
    smaller; a NULL id is neither smaller nor larger than another.
    """
    filters = content_filters() if filters is None else filters
    rows = _masked(docs, part, filters).groupBy("doc_id", "part", "mask", "name").agg(F.count("*").alias("n"))
    marks = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy("doc_id", F.lit(0).cast("long").alias("salt"))
        .agg(F.max((F.col("quality") == 1).cast("long")).alias("is_good"), F.max((F.col("toxic") == 1).cast("long")).alias("is_toxic"))
    )
    # NULL ids meet no label; spread, or the join would send them all to one task
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("name", "part"), F.lit(1 << 20))).otherwise(0)
    rows = rows.withColumn("salt", salt).join(marks, ["doc_id", "salt"], "left").na.fill(0, ["is_good", "is_toxic"])
    per_text = rows.groupBy("name", "part", "mask", "is_good", "is_toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("n_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
    )
    first = F.col("least") == F.min("least").over(Window.partitionBy("name"))
    counted = per_text.withColumn("n_first", F.col("n_null") + F.when(first, F.col("n_least")).otherwise(0))
    repeat = F.lit(1 << len(filters))
    cells = F.explode(
        F.array(
            F.struct(F.col("mask"), F.col("n_first").alias("n")),
            F.struct((F.col("mask") + repeat).alias("mask"), (F.col("n") - F.col("n_first")).alias("n")),
        )
    )
    return (
        counted.select("part", "is_good", "is_toxic", cells.alias("c"))
        .groupBy("part", "c.mask")
        .agg(
            F.sum("c.n").alias("n"),
            F.sum(F.col("c.n") * F.col("is_good")).alias("good"),
            F.sum(F.col("c.n") * F.col("is_toxic")).alias("toxic"),
        )
        .filter("n > 0")
    )


def gray_walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of active filters: ``(parts, subset, measure)`` from counts ``(parts, mask, measure)``."""
    size = cells.shape[1]
    masks = np.arange(size)
    failing = np.zeros(size, np.int64)  # active filters that a cell fails
    survivors = cells.sum(axis=1)
    states = np.empty_like(cells)
    states[:, 0] = survivors
    active = 0
    for i in range(1, size):
        toggled = (i & -i).bit_length() - 1  # neighbours in Gray code differ in the lowest set bit of their number
        hit = (masks >> toggled & 1).astype(bool)
        if active >> toggled & 1:
            failing[hit] -= 1
            survivors = survivors + cells[:, hit & (failing == 0)].sum(axis=1)
        else:
            survivors = survivors - cells[:, hit & (failing == 0)].sum(axis=1)
            failing[hit] += 1
        active ^= 1 << toggled
        states[:, active] = survivors
    return states


def subset_states(cells: DataFrame, n_filters: int) -> DataFrame:
    """Stored table ``(part, subset, n, good, toxic)``: documents that pass all filters of the subset, 2**k rows a part."""
    size = 1 << n_filters

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = np.zeros((len(frame), size, len(MEASURES)), np.int64)
            for i, rows in enumerate(frame["cells"]):
                for c in rows:
                    counts[i, c["mask"]] = [c[m] for m in MEASURES]
            states = gray_walk(counts).reshape(-1, len(MEASURES))
            yield pd.DataFrame(
                {"part": np.repeat(frame["part"].to_numpy(), size), "subset": np.tile(np.arange(size), len(frame))}
                | {m: states[:, j] for j, m in enumerate(MEASURES)}
            )

    gathered = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))
    return stage(gathered.mapInPandas(walk, "part string, subset int, n long, good long, toxic long"), "filter-states")


def _orders(spark, letters: str) -> DataFrame:
    """Every step of every order, with the filters active before it."""
    bit = {x: 1 << i for i, x in enumerate(letters)}
    columns = {"filter_order": [], "step": [], "bit": [], "before": []}
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            for name, value in zip(columns, ("".join(order), step, bit[letter], before), strict=True):
                columns[name].append(value)
            before |= bit[letter]
    return small_table(spark, columns, "filter_order string, step int, bit int, before int")


def audit_steps(states: DataFrame, letters: str) -> DataFrame:
    """One row per part, order and step, from differences of ``subset_states``."""
    full = (1 << len(letters)) - 1
    steps = _orders(states.sparkSession, letters)

    def state(name: str) -> DataFrame:
        return states.select("part", F.col("subset").alias(name), *[F.col(m).alias(f"{name}_{m}") for m in MEASURES])

    rows = state("before").join(steps, "before").withColumn("after", F.col("before") + F.col("bit"))
    rows = rows.join(state("after"), ["part", "after"])
    # a filter on its own against none, and all filters against all others
    alone = states.filter(F.expr("bit_count(subset)") == 1).select("part", F.col("subset").alias("bit"), F.col("n").alias("pass_alone"))
    others = states.filter(F.expr("bit_count(subset)") == len(letters) - 1).select("part", (F.lit(full) - F.col("subset")).alias("bit"), F.col("n").alias("pass_others"))
    ends = states.groupBy("part").agg(F.max("n").alias("pass_none"), F.min("n").alias("pass_all"))
    facts = alone.join(others, ["part", "bit"]).join(ends, "part")
    removed = F.col("before_n") - F.col("after_n")
    return rows.join(facts, ["part", "bit"]).select(
        "part",
        "filter_order",
        "step",
        F.col("after_n").alias("kept"),
        removed.alias("removed"),
        (F.col("pass_none") - F.col("pass_alone") - removed).alias("redundant"),
        (F.col("pass_others") - F.col("pass_all")).alias("unique_fails"),
        (F.col("before_good") - F.col("after_good")).alias("good_lost"),
        (F.col("before_toxic") - F.col("after_toxic")).alias("toxic_lost"),
        F.sum(removed).over(Window.partitionBy("part", "bit")).alias("shapley"),
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    part: str = "lang",
    filters: Mapping[str, Callable[[Column, Column], Column]] | None = None,
    repeats: str = "E",
) -> DataFrame:
    """What each step of every order of filters keeps, removes and loses, for every value of ``part``.

    ``filters`` maps a letter to a condition on a text and its words that a document fails; ``repeats`` is the letter of the
    filter on repeated texts. ``redundant``: failing the step's filter, but removed earlier; ``unique_fails``: failing this
    filter only; ``good_lost``, ``toxic_lost``: removed here and labelled so (an id with several labels has each that any of
    them says); ``shapley``: removed by the filter, summed over all orders.

    NULL text counts as empty, NULL part as the empty string, an id without label or with NULL labels as neither good nor
    toxic. Very long texts are measured whole. Other columns are not looked at, whatever their names. An empty table gives
    no rows.
    """
    filters = content_filters() if filters is None else filters
    letters = "".join([*filters, repeats])
    if len(letters) > MAX_FILTERS or len(set(letters)) < len(letters) or len(letters) != len(filters) + 1:
        raise ValueError(f"at most {MAX_FILTERS} filters, each with a letter of its own")
    return audit_steps(subset_states(filter_cells(docs, labels, part, filters), len(letters)), letters)


AUDIT_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marked AS (
  SELECT part, good, toxic,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM words LEFT JOIN (SELECT doc_id, max(cast(quality = 1 AS int)) AS good, max(cast(toxic = 1 AS int)) AS toxic FROM labels GROUP BY doc_id) USING (doc_id)),
cells AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM marked GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, cast(step AS int) AS step, substr(filter_order, step, 1) AS f, left(filter_order, step - 1) AS earlier FROM orders, range(1, 6) r(step)),
sums AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (translate(fails, earlier || f, '') = fails), 0) AS kept,
    coalesce(sum(n) FILTER (translate(fails, earlier, '') = fails AND contains(fails, f)), 0) AS removed,
    coalesce(sum(n) FILTER (translate(fails, earlier, '') <> fails AND contains(fails, f)), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
    coalesce(sum(good) FILTER (translate(fails, earlier, '') = fails AND contains(fails, f)), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (translate(fails, earlier, '') = fails AND contains(fails, f)), 0) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, cast(kept AS bigint) AS kept, cast(removed AS bigint) AS removed, cast(redundant AS bigint) AS redundant,
  cast(unique_fails AS bigint) AS unique_fails, cast(good_lost AS bigint) AS good_lost, cast(toxic_lost AS bigint) AS toxic_lost,
  cast(sum(removed) OVER (PARTITION BY part, f) AS bigint) AS shapley
FROM sums"""
