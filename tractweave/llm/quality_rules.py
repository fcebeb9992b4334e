"""Rule ledger: every rule is evaluated once and its failure kept as one bit; policies and ablations only read the bits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _doubled(hashes: str, step: int) -> Column:
    """Hash of each run of 2 * ``step`` words from the hashes of the runs of ``step``."""
    n = F.size(hashes) - step
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b))


def _covered_words(hashes: Column) -> Column:
    """Words inside windows whose hash stands in ``hashes`` more than once; overlaps count once."""
    ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.transform(
        F.array(ranked),
        lambda r: F.aggregate(
            F.array_sort(
                F.transform(
                    F.filter(
                        F.sequence(F.lit(0), F.size(r) - 1),
                        lambda k: (F.get(r, k)["h"] == F.get(r, k - 1)["h"]) | (F.get(r, k)["h"] == F.get(r, k + 1)["h"]),
                    ),
                    lambda k: F.get(r, k)["i"],
                )
            ),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda s, p: F.struct(
                (s["n"] + p + WINDOW - F.greatest(s["end"], p)).alias("n"),
                (p + WINDOW).alias("end"),
            ),
            lambda s: s["n"],
        ),
    )[0]


def measured(docs: DataFrame) -> DataFrame:
    """All measurements of the rules, each taken once from the whole text; NULL texts have no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.withColumn("_w", words_of(F.col("text")))
        .withColumn("_h", F.when(F.size("_w") > WINDOW, F.transform("_w", lambda w: F.xxhash64(w))))
        .withColumn("_h", _doubled("_h", 1))
        .withColumn("_h", _doubled("_h", 2))
        .withColumn("_h", _doubled("_h", 4))
        .withColumn("_l", F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn("n_words", F.size("_w").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"))
        .withColumn("n_upper", F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"))
        .withColumn("n_lines", F.size("_l").cast("long"))
        .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
        .withColumn(
            "n_repeat_words",
            F.when(F.size(F.array_distinct("_h")) < F.size("_h"), _covered_words(F.col("_h"))).otherwise(0).cast("long"),
        )
        .drop("_w", "_h", "_l")
    )


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str
    """SQL condition on the measurements; comparisons stay in whole numbers."""


RULES: Sequence[Rule] = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 40 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("capitals", "100 * n_upper > 50 * word_chars"),
)
"""A rule's bit is its place in this list. New rules are added at the end, so that stored bits keep their meaning."""

POLICIES: Mapping[int, Sequence[str]] = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "symbols", "word_length", "duplicate_lines", "capitals"),
}
"""Policy by version: the rules of which none may fail."""


def mask_of(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    places = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << places[n] for n in set(names))


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measurements and ``failed_bits`` of every row. The ledger can be stored: policies never look at the text again.

    Every text is read whole. A NULL or empty text has no words and fails ``few_words``. Columns named like a measurement
    are replaced, all others stay; repeated rows are judged alike, and no rows give no rows.
    """
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured(docs).withColumn("failed_bits", bits)


def kept_by(version: int, policies: Mapping[int, Sequence[str]] = POLICIES) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(mask_of(policies[version])).cast("long")) == 0


def ablation(ledgered: DataFrame, version: int, rules: Sequence[Rule] = RULES, policies=POLICIES) -> DataFrame:
    """One row for each rule of a policy: rows that fail it, rows that only it rejects, rows kept without it.

    One pass over the ledger counts each pattern of bits (there are at most 2 ** rules), the rest works on these counts.
    ``shared_bits``: rules that fail in every row that fails this one; ``any_bits``: those that fail in any such row.
    """
    mask = mask_of(policies[version], rules)
    patterns = (
        ledgered.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("b")).agg(F.count("*").alias("n"))
    )
    bits = [(i, r.name) for i, r in enumerate(rules) if mask >> i & 1]
    per_rule = patterns.select(
        "b", "n", F.explode(F.array(*[F.struct(F.lit(1 << i).cast("long").alias("bit"), F.lit(n).alias("rule")) for i, n in bits])).alias("r")
    ).select("b", "n", "r.*")
    fails = F.col("b").bitwiseAND(F.col("bit")) != 0
    return per_rule.groupBy("rule").agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("b") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("b").bitwiseAND(F.bitwise_not("bit")) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        F.bit_and(F.when(fails, F.col("b"))).alias("shared_bits"),
        F.bit_or(F.when(fails, F.col("b"))).alias("any_bits"),
    )


def rules_table(docs: DataFrame, version: int = 2) -> DataFrame:
    """The ledger of every document with the verdict of one policy."""
    return ledger(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~kept_by(1)).alias("base_failed"),
        kept_by(version).alias("kept"),
        "n_upper",
        "failed_bits",
    )


RULES_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
r AS (SELECT doc_id, i FROM p QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, i + unnest(range(0, 8)) AS j FROM r) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')))::BIGINT AS n_upper,
             len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 100 * n_symbols > 40 * n_words THEN 4 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 8 ELSE 0 END
             + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 16 ELSE 0 END
             + CASE WHEN 100 * n_upper > 50 * word_chars THEN 32 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed,
       failed_bits = 0 AS kept, n_upper, failed_bits FROM b
"""
