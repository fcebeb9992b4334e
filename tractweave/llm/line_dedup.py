"""Line-level deduplication over the whole corpus by overlapping windows of three consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def repeated_line_positions(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``_th`` (hash of the text) and ``_at``: the 0-based numbers, in order, of all lines to remove.

    Each window is reduced to two 64-bit hashes at once; the lines themselves are never shuffled. Counting and the
    choice of the first occurrence are partial aggregates, so a window that stands in most documents sends one row a task.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("_th"), _lines(F.col("text")).alias("_l"))
    occurrences = lines.filter(F.size("_l") >= window).select(
        "doc_id",
        "_th",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(1), F.size("_l") - (window - 1)),
                lambda i: F.struct(
                    F.xxhash64(F.lit(1), F.array_join(F.slice("_l", i, window), "\n")).alias("h1"),
                    F.xxhash64(F.lit(2), F.array_join(F.slice("_l", i, window), "\n")).alias("h2"),
                    (F.trim(F.array_join(F.slice("_l", i, window), "")) == "").alias("blank"),
                ),
            )
        ).alias("pos", "w"),
    ).filter("NOT w.blank").select("doc_id", "_th", "pos", "w.h1", "w.h2")
    place = F.struct("doc_id", "_th", "pos")
    firsts = occurrences.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = occurrences.join(firsts.drop("n"), ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first")))
    covered = F.array_sort(
        F.array_distinct(F.flatten(F.transform(F.collect_set("pos"), lambda p: F.sequence(p, p + window - 1))))
    )
    return later.groupBy("doc_id", "_th").agg(covered.alias("_at"))


def drop_repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` with ``kept_text``, ``n_lines``, ``n_removed`` and ``n_spans``; other columns stay.

    Lines are parted by a line feed. Windows of ``window`` consecutive lines that stand more than once in the corpus keep
    their first occurrence in the order of (doc_id, text hash, line), NULL ids first; the lines of all later ones are
    removed, overlaps once. Windows of blank lines alone count for nothing, and texts of fewer lines have no window.
    A NULL or empty text has no lines and an empty ``kept_text``. Rows that repeat both id and text are one document listed
    twice: each gets the same answer. Columns of the names above are replaced.
    """
    docs = docs.drop("kept_text", "n_lines", "n_removed", "n_spans").withColumn("_th", F.xxhash64("text"))
    removed = repeated_line_positions(docs, window).select(F.col("doc_id").alias("_id"), F.col("_th").alias("_h"), "_at")
    n, at = F.size("_l"), F.col("_at")
    m = F.size(at)
    edge = F.concat(F.array(F.lit(-1)), at, F.array(n))  # kept runs lie between neighbours that are not adjacent
    kept = F.flatten(
        F.transform(
            F.sequence(F.lit(1), m + 1),
            lambda i: F.slice("_l", F.get("_edge", i - 1) + 2, F.get("_edge", i) - F.get("_edge", i - 1) - 1),
        )
    )
    starts = F.filter(F.sequence(F.lit(1), m), lambda i: (i == 1) | (F.get("_edge", i) - F.get("_edge", i - 1) > 1))
    return (
        docs.join(
            removed.hint("shuffle_hash"),
            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_h")),
            "left",
        )
        .withColumn("_l", _lines(F.col("text")))
        .withColumn("_edge", F.when(at.isNotNull(), edge))
        .withColumn("kept_text", F.when(at.isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n")))
        .withColumn("n_lines", n.cast("long"))
        .withColumn("n_removed", F.when(at.isNull(), 0).otherwise(m).cast("long"))
        .withColumn("n_spans", F.when(at.isNull(), 0).otherwise(F.size(starts)).cast("long"))
        .drop("_th", "_id", "_h", "_at", "_l", "_edge")
    )


def line_table(docs: DataFrame) -> DataFrame:
    """Digest per document: numbers of lines, removed lines and removed runs, and the hash of what is left."""
    return drop_repeated_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", "n_spans", F.sha2("kept_text", 256).alias("kept_sha256")
    )


LINE_SQL = """
WITH d AS (SELECT doc_id, text, CASE WHEN text IS NULL OR text = '' THEN [] ELSE string_split(text, chr(10)) END AS l
           FROM documents),
o AS (SELECT doc_id, pos, array_to_string(l[pos:pos + 2], chr(10)) AS w
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS pos FROM d)),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS k
      FROM o WHERE replace(replace(w, chr(10), ''), ' ', '') <> ''),
c AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS i FROM r WHERE k > 1),
s AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (g) AS n_spans, list(i) AS a
      FROM (SELECT *, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) IS DISTINCT FROM 1 AS g FROM c) GROUP BY doc_id)
SELECT d.doc_id, len(l)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN a IS NULL THEN coalesce(text, '') ELSE
         array_to_string([x[1] FOR x IN list_zip(l, range(1, len(l) + 1)) IF NOT list_contains(a, x[2])], chr(10)) END) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""
