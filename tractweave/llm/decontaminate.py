"""Benchmark decontamination: an FM-index of each shard of training texts, searched for all windows of the benchmark."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractweave.llm import packed
from tractweave.llm.fm_index import FMIndex

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", SPANS),
        T.StructField("_hits", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class DecontaminationConfig:
    window: int = 10
    shard_bytes: int = 2 << 20
    """Text in one FM-index; a longer document has an index of its own."""
    block_bytes: int = 16 << 20
    """Benchmark text that is sent to the tasks at once. A larger benchmark is searched in blocks of about this size."""


class Phrases:
    """Windows of a block of benchmark items: symbols of their words, and which items have them."""

    def __init__(self, items: list[str], texts: list[str], window: int):
        self.items = items
        column = pa.array([t or "" for t in texts], pa.large_string())
        data, offsets = packed.buffers(column)
        data = packed.lowered(data)
        starts, ends, doc = packed.word_spans(data, offsets, packed.NON_WORD)
        hashes = packed.span_hashes(packed.prefix_hashes(data), starts, ends)
        self.vocabulary = np.unique(hashes)
        symbols = np.searchsorted(self.vocabulary, hashes) + 1
        counts = np.bincount(doc, minlength=len(items))
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self.groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        """Per length of windows: distinct windows, and pairs of window and item, ordered by window."""
        for length in range(1, window + 1):
            if length < window:
                owner = np.flatnonzero(counts == length)
                at = first[owner]
            else:
                inner = np.arange(len(hashes) - window + 1) if len(hashes) >= window else np.zeros(0, np.int64)
                at = inner[doc[inner] == doc[inner + window - 1]] if len(inner) else inner
                owner = doc[at]
            if not len(at):
                continue
            rows = symbols[at[:, None] + np.arange(length)]
            distinct, which = np.unique(rows, axis=0, return_inverse=True)
            pairs = np.unique(np.column_stack([which.reshape(-1), owner]), axis=0)
            self.groups.append((distinct, pairs[:, 0], pairs[:, 1]))
        self.shortest = min((g[0].shape[1] for g in self.groups), default=0)


@dataclass
class Shard:
    """Words of the documents of one slice; ``hit`` marks those inside an occurrence, ``found`` lists (document, item)."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hit: np.ndarray
    found: np.ndarray


def search_shard(raw: np.ndarray, offsets: np.ndarray, phrases: Phrases) -> Shard:
    data = packed.lowered(raw)
    starts, ends, doc = packed.word_spans(data, offsets, packed.NON_WORD)
    hit, none = np.zeros(len(starts), bool), np.zeros((0, 2), np.int64)
    if not phrases.groups or not len(starts):
        return Shard(starts, ends, doc, hit, none)
    hashes = packed.span_hashes(packed.prefix_hashes(data), starts, ends)
    at = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[at] == hashes
    # a match lies in a run of words of the benchmark's vocabulary; runs shorter than any window cannot hold one
    opens = known & np.concatenate([[True], ~known[:-1] | (doc[1:] != doc[:-1])])
    run = np.cumsum(opens) - 1
    length = np.bincount(run[known], minlength=int(opens.sum()))
    kept = known & (length[np.maximum(run, 0)] >= phrases.shortest) if len(length) else known
    word = np.flatnonzero(kept)
    if not len(word):
        return Shard(starts, ends, doc, hit, none)
    ends_run = np.concatenate([run[word][1:] != run[word][:-1], [True]])
    place = np.arange(len(word)) + np.concatenate([[0], np.cumsum(ends_run)[:-1]])  # a 0 follows each run
    symbols = np.zeros(len(word) + int(ends_run.sum()), np.int64)
    symbols[place] = at[word] + 1
    word_of = np.full(len(symbols), -1, np.int64)
    word_of[place] = word
    index = FMIndex(symbols, len(phrases.vocabulary) + 1)
    pairs = []
    cover = np.zeros(len(starts) + 1, np.int64)
    for windows, which, owner in phrases.groups:
        low, high = index.search(windows)
        many = high - low
        pattern = np.repeat(np.arange(len(windows)), many)
        if not len(pattern):
            continue
        rows = np.repeat(low, many) + np.arange(len(pattern)) - np.repeat(np.cumsum(many) - many, many)
        begin = word_of[index.locate(rows)]
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + windows.shape[1], -1)
        seen = np.unique(np.column_stack([doc[begin], pattern]), axis=0)
        left, right = np.searchsorted(which, seen[:, 1], "left"), np.searchsorted(which, seen[:, 1], "right")
        times = right - left
        item = owner[np.repeat(left, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
        pairs.append(np.column_stack([np.repeat(seen[:, 0], times), item]))
    hit = np.cumsum(cover)[:-1] > 0
    return Shard(starts, ends, doc, hit, np.unique(np.concatenate(pairs), axis=0) if pairs else none)


def _rows_of(shard: Shard, offsets: np.ndarray, phrases: Phrases, before: list[tuple[bytes, list[str]]]) -> Iterator[tuple]:
    """Per document: words, hit words, items, merged spans (bytes of the text), bits of the hit words."""
    n = len(offsets) - 1
    borders = np.searchsorted(shard.doc, np.arange(n + 1))
    of = np.searchsorted(shard.found[:, 0], np.arange(n + 1))
    for k in range(n):
        a, b = borders[k], borders[k + 1]
        hit = shard.hit[a:b]
        items = [phrases.items[i] for i in shard.found[of[k] : of[k + 1], 1]]
        bits, earlier = before[k]
        if bits:
            hit = hit | np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        items = sorted({*items, *earlier})
        spans = []
        if hit.any():
            edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
            opens, closes = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
            spans = [
                {"start": int(s), "end": int(e)}
                for s, e in zip(shard.starts[a + opens] - offsets[k], shard.ends[a + closes] - offsets[k], strict=True)
            ]
        yield b - a, int(hit.sum()), items, spans, np.packbits(hit).tobytes() if spans else b""


def _benchmark_blocks(benchmark: DataFrame, config: DecontaminationConfig) -> Iterator[tuple[Phrases, bool]]:
    """Items in blocks of bounded size, one at a time on the driver, and whether it is the last.

    NULL ids and texts without words have no windows.
    """
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // config.block_bytes))
    for k in range(blocks):
        block = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        rows = block.toArrow().sort_by("item_id")
        yield Phrases(rows["item_id"].to_pylist(), rows["text"].to_pylist(), config.window), k == blocks - 1


def find_passages(docs: DataFrame, benchmark: DataFrame, config: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside any occurrence), ``items`` (ids, sorted) and ``spans`` (bytes).

    Windows are ``window`` consecutive words of an item, or all its words if they are fewer. Texts are read whole and
    nothing is shuffled: a task indexes its rows shard by shard. NULL texts have no words; an empty benchmark hits nothing;
    item ids that repeat are one item with the windows of all its rows. Columns of these names are replaced.
    """
    return _searched(docs, benchmark, config).drop("_hits")


def _searched(
    docs: DataFrame,
    benchmark: DataFrame,
    config: DecontaminationConfig,
    finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
) -> DataFrame:
    """``docs`` with the columns of ``ADDED``. ``finish`` gets the batches of the last block in the same pass: a pass of its
    own would need another Python worker for every running task."""
    docs = docs.drop(*ADDED.names)
    schema = T.StructType([*docs.schema.fields, *ADDED.fields])
    width, text_at, columns = len(docs.columns), docs.columns.index("text"), docs.columns
    out = docs
    for block, last in _benchmark_blocks(benchmark, config):

        def searched(batches, phrases=block, then=finish if last else None):
            for batch in batches:
                raw, offsets = packed.buffers(batch.column(text_at))
                earlier = [(b"", [])] * batch.num_rows
                if batch.num_columns > width:
                    earlier = list(zip(batch.column(width + 4).to_pylist(), batch.column(width + 2).to_pylist(), strict=True))
                rows = []
                for i, j in packed.slices(offsets, config.shard_bytes):
                    part = offsets[i : j + 1] - offsets[i]
                    rows += _rows_of(search_shard(raw[offsets[i] : offsets[j]], part, phrases), part, phrases, earlier[i:j])
                added = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, _ARROW, strict=True)]
                found = pa.RecordBatch.from_arrays([*batch.columns[:width], *added], [*columns, *ADDED.names])
                yield then(found) if then else found
                packed.release()

        out = out.mapInArrow(searched, schema)
    return out


_ARROW = [
    pa.int64(),
    pa.int64(),
    pa.list_(pa.string()),
    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
    pa.binary(),
]


def remove_passages(docs: DataFrame, benchmark: DataFrame, config: DecontaminationConfig = DecontaminationConfig()) -> DataFrame:
    """``docs`` with the merged spans cut out of their texts, each replaced by a line feed; columns stay as they are.

    Texts without a hit stay as they are, byte for byte. A text with nothing but blanks and marks left is dropped with
    its row. ``n_chars``, if there is such a column, is counted anew for texts that were cut.
    """
    columns = docs.columns
    kept = docs.drop(*ADDED.names).columns
    text_at, spans_at = kept.index("text"), len(kept) + ADDED.names.index("spans")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = batch.column(spans_at)
        if not any(len(s) for s in spans):
            return batch
        texts = []
        for text, cuts in zip(batch.column(text_at).to_pylist(), spans.to_pylist(), strict=True):
            if cuts:
                raw, rest, at = text.encode(), [], 0
                for c in cuts:
                    rest.append(raw[at : c["start"]])
                    at = c["end"]
                text = b"\n".join([*rest, raw[at:]]).decode()
            texts.append(text)
        arrays = list(batch.columns)
        arrays[text_at] = pa.array(texts, arrays[text_at].type)
        return pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    changed = F.size("spans") > 0
    out = _searched(docs, benchmark, config, cut).filter(~changed | F.regexp_like("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*columns)


def decontamination_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_passages(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


DECONTAMINATION_SQL = r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
bw AS (SELECT item_id::VARCHAR AS item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM p),
dp AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, i, k, item_id FROM dp JOIN p USING (k, t)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, i + unnest(range(0, k)) AS j FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, list(DISTINCT item_id ORDER BY item_id) AS items FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
