"""Toxicity: gradient-boosted trees over dense measurements of the whole text, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractweave.llm import packed
from tractweave.operators.scale import stage

FEATURES = (
    "seed_density",  # words of the fixed list
    "learned_density",  # stems that labels showed to be toxic
    "learned_weight",  # sum of their log odds
    "top_weight",
    "near_you",  # hits near a word of the second person
    "you_density",
    "capitals",
    "shouted",  # words of capitals only
    "punctuation",
    "exclamation",
    "obfuscation",  # words with digits or marks between letters
    "obfuscated_hits",  # listed words found only after undoing that
    "log_words",
)

# Common insults, the second person, and characters that stand in for letters.
INSULTS = (
    "bastard clown coward creep cretin disgusting dumb dumbass fool freak garbage hate hateful idiot idiotic imbecile "
    "incompetent jerk kill lame liar loser moron moronic nasty pathetic pig psycho rat retard scum scumbag shut sick slime "
    "stupid suck sucks trash ugly useless vermin vile weirdo worthless"
).split()
SECOND_PERSON = "you your yours yourself youre u ur du dich dir dein deine sie ihr tu te toi vous ton ta tes usted ustedes tú ti".split()
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

SLICE_BYTES = 1 << 20
"""Text that is measured at once; a task's arrays take some 100 bytes for each of them."""

NEAR = 5
STEMS = (5, 8)
"""Letters of the stems of a word; words of fewer are their own stem."""


@dataclass(frozen=True)
class ToxicityConfig:
    max_rows: int = 20_000
    """Labelled rows to learn from at most, the first by a hash of the id; the driver holds these rows' features only."""
    fold: int = 5
    """Labels of rows whose crc32(doc_id) mod ``fold`` is 0 are never learned."""
    calibration_fold: int = 4
    """Of the learned rows, one in so many (by another hash) calibrates and grows no tree."""
    stems: int = 2_000
    """Stems in the learned lexicon at most, by log odds."""
    least_documents: int = 3
    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 64
    reject_at: float = 0.5


@dataclass(frozen=True)
class Lexicon:
    """Sorted hashes of stems with their log odds; a few thousand numbers, sent to every task."""

    stems: np.ndarray
    weights: np.ndarray


def _hash_all(words: list[str]) -> np.ndarray:
    texts = pa.array(words, pa.large_string())
    data, offsets = packed.buffers(texts)
    return np.sort(packed.span_hashes(packed.prefix_hashes(data), offsets[:-1], offsets[1:]))


def _among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


_SEPARATORS = bytes([*range(0x00, 0x21), *b"\"(),.:;?[]{}|~`<>/\\=+%&#*^_-", 0x7F])
"""Marks that part words here. Digits, @, $ and ! stay inside, where they may stand for letters."""


def _undone() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    for a, b in STAND_INS.items():
        table[ord(a)] = ord(b)
    return table


class TextSlice:
    """Words and stems of the documents of one slice, as hashes."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw, self.offsets = raw, offsets
        self.low = packed.lowered(raw)
        self.starts, self.ends, self.doc = packed.word_spans(self.low, offsets, _SEPARATORS)
        trailing = self.low[np.maximum(self.ends - 1, 0)] == ord("!")
        while trailing.any():  # marks at the end of a word belong to the sentence
            shorter = trailing & (self.ends - 1 > self.starts)
            self.ends = self.ends - shorter
            trailing = shorter & (self.low[np.maximum(self.ends - 1, 0)] == ord("!"))
        self.sums = packed.prefix_hashes(self.low)
        # a stem is cut at a letter: steps of bytes that begin a character
        self.char_no = np.concatenate([[0], np.cumsum((self.low & 0xC0) != 0x80)])
        self.char_at = np.append(np.flatnonzero((self.low & 0xC0) != 0x80), len(self.low))

    def stems(self, letters: int) -> np.ndarray:
        first = self.char_no[self.starts]
        cut = self.char_at[np.minimum(first + letters, len(self.char_at) - 1)]
        return packed.span_hashes(self.sums, self.starts, np.minimum(cut, self.ends))


def document_stems(raw: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Distinct stems of each document."""
    for i, j in packed.slices(offsets, SLICE_BYTES):
        part = TextSlice(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        stems = np.column_stack([part.stems(n) for n in STEMS])
        borders = np.searchsorted(part.doc, np.arange(j - i + 1))
        for k in range(j - i):
            yield np.unique(stems[borders[k] : borders[k + 1]])


def measure(raw: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Features of each document over its whole text, as document x feature."""
    return np.concatenate([_measure_slice(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lexicon) for i, j in packed.slices(offsets, SLICE_BYTES)] or [np.zeros((0, len(FEATURES)))])


def _measure_slice(raw: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    part = TextSlice(raw, offsets)
    n = len(offsets) - 1
    doc = part.doc

    def per_doc(weights: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights, n)

    def bytes_per_doc(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    def inside(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[part.ends] - total[part.starts]

    hashes = packed.span_hashes(part.sums, part.starts, part.ends)
    insults = _hash_all(INSULTS)
    seed = _among(hashes, insults)
    weight = np.zeros(len(hashes))
    if len(lexicon.stems):
        for letters in STEMS:
            stems = part.stems(letters)
            at = np.minimum(np.searchsorted(lexicon.stems, stems), len(lexicon.stems) - 1)
            weight = np.maximum(weight, np.where(lexicon.stems[at] == stems, lexicon.weights[at], 0.0))
    learned = weight > 0
    letters = ((part.low >= 97) & (part.low <= 122)) | (part.low >= 128)
    n_letters = inside(letters)
    length = part.ends - part.starts
    obfuscated = (n_letters > 0) & (n_letters < length)
    undone = packed.prefix_hashes(_undone()[part.low])
    undone_hits = obfuscated & _among(packed.span_hashes(undone, part.starts, part.ends), insults)
    hit = seed | undone_hits | (weight > 2.0)
    you = _among(hashes, _hash_all(SECOND_PERSON))
    near = _near(hit, you, doc)
    upper = (raw >= 65) & (raw <= 90)
    n_upper = inside(upper)
    n_words = per_doc(np.ones(len(doc)))
    words = np.maximum(n_words, 1)
    size = np.maximum(np.diff(offsets), 1)
    top = np.zeros(n)
    np.maximum.at(top, doc, weight)
    marks = (raw > 32) & (raw < 127) & ~letters & ~upper & ~((raw >= 48) & (raw <= 57))
    return np.column_stack(
        [
            per_doc(seed) / words,
            per_doc(learned) / words,
            per_doc(weight),
            top,
            per_doc(near),
            per_doc(you) / words,
            bytes_per_doc(upper) / size,
            per_doc((n_upper == length) & (length > 1)) / words,
            bytes_per_doc(marks) / size,
            bytes_per_doc(raw == ord("!")) / size,
            per_doc(obfuscated) / words,
            per_doc(undone_hits),
            np.log1p(n_words),
        ]
    )


def _near(hit: np.ndarray, you: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hits with a word of the second person at most ``NEAR`` words away in the same document."""
    places = np.flatnonzero(you)
    hits = np.flatnonzero(hit)
    out = np.zeros(len(hit))
    if len(places) and len(hits):
        after = np.searchsorted(places, hits)
        for k in (after - 1, after):
            other = places[np.clip(k, 0, len(places) - 1)]
            out[hits[(np.abs(other - hits) <= NEAR) & (doc[other] == doc[hits])]] = 1
    return out


@dataclass
class Trees:
    """Boosted trees of one depth in arrays: tree x node for feature and cut, tree x leaf for the value."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    points: np.ndarray = field(default_factory=lambda: np.zeros(0))
    levels: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = self.feature.shape[1].bit_length()
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), f[node]] > c[node])
            out += v[node - len(f)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability: isotonic steps, joined by straight lines."""
        return np.clip(np.interp(self.raw(x), self.points, self.levels), 0.0, 1.0) if len(x) else np.zeros(0)


def grow(x: np.ndarray, y: np.ndarray, config: ToxicityConfig) -> Trees:
    """Logistic boosting on histograms; splits by gain of second order, leaves shrunk by one unit of curvature."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, config.bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    mean = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), start)
    nodes, leaves = 2**config.depth - 1, 2**config.depth
    feature, cut, value = np.zeros((config.trees, nodes), int), np.full((config.trees, nodes), np.inf), np.zeros((config.trees, leaves))
    for t in range(config.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(config.depth):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-9)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                width = len(e) + 1
                cell = (node - first) * width + binned[:, f]
                gs = np.bincount(cell, g, count * width).reshape(count, width).cumsum(1)
                hs = np.bincount(cell, h, count * width).reshape(count, width).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                k = gain.argmax(1)
                top = gain[np.arange(count), k]
                better = top > best
                best[better] = top[better]
                feature[t, first : first + count][better] = f
                cut[t, first : first + count][better] = e[k[better]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[t, node]] > cut[t, node])
        leaf = node - nodes
        value[t] = config.rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1)
        margin += value[t][leaf]
    return Trees(start, feature, cut, value)


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators. Each block starts from one row of the overall rate, so no level is 0 or 1."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, first and last raw score
    for r, label in zip(raw[order], y[order], strict=True):
        if blocks and blocks[-1][3] == r:
            blocks[-1][0] += label
            blocks[-1][1] += 1
        else:
            blocks.append([float(label), 1.0, r, r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = last
    if not blocks:
        return np.zeros(1), np.full(1, 0.0)
    rate = y.mean()
    level = [(s + rate) / (n + 1) for s, n, _, _ in blocks]
    points = np.array([x for _, _, a, b in blocks for x in (a, b)])
    return points, np.maximum.accumulate(np.repeat(level, 2))


def learn_lexicon(stems: list[np.ndarray], y: np.ndarray, config: ToxicityConfig) -> Lexicon:
    """Stems by how much oftener toxic documents have them; each document counts a stem once."""
    if not len(y) or not y.any():
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    toxic = [s for s, label in zip(stems, y, strict=True) if label]
    clean = [s for s, label in zip(stems, y, strict=True) if not label]
    found, in_toxic = np.unique(np.concatenate(toxic), return_counts=True)
    enough = in_toxic >= config.least_documents
    found, in_toxic = found[enough], in_toxic[enough]
    if not len(found):
        return Lexicon(found, np.zeros(0))
    in_clean = np.zeros(len(found))
    for s in clean:
        at = np.searchsorted(found, s)
        at = at[(at < len(found)) & (found[np.minimum(at, len(found) - 1)] == s)]
        in_clean[at] += 1
    odds = np.log((in_toxic + 0.5) / (len(toxic) + 1)) - np.log((in_clean + 0.5) / (len(clean) + 1))
    pick = np.argsort(-odds, kind="stable")[: config.stems]
    pick = np.sort(pick[odds[pick] > 1.0])
    return Lexicon(found[pick], odds[pick])


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: Trees


def train_toxicity(docs: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    """Learn from a bounded number of labelled rows. Neither lang, source, doc_id nor labels are among the inputs.

    Rows without a label, with a NULL id or of the held-out fold are not used. Their distinct stems come to the driver, not
    their texts. Where a document's labels differ, any toxic one counts. Without toxic rows every score is near 0.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .filter(F.crc32(F.col("doc_id").cast("string")) % config.fold != 0)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(config.max_rows)
    )
    sample = stage(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]), "toxicity-sample")
    empty = Lexicon(np.zeros(0, np.uint64), np.zeros(0))

    def stems_of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [s.tobytes() for s in document_stems(*packed.buffers(part.column("text")))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array(found, pa.binary())], ["doc_id", "toxic", "stems"])
            packed.release()

    rows = sample.mapInArrow(stems_of, T.StructType([sample.schema["doc_id"], sample.schema["toxic"], T.StructField("stems", T.BinaryType())])).toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return ToxicityModel(empty, Trees(-5.0, np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2)), np.zeros(1), np.zeros(1)))
    ids = rows["doc_id"].to_numpy()
    y = (rows["toxic"].to_numpy() > 0).astype(float)
    stems = [np.frombuffer(s, np.uint64) for s in rows["stems"].to_pylist()]
    turn = packed.mixed(ids.astype(np.uint64)) % np.uint64(config.calibration_fold)
    grows = turn != 0
    # the lexicon is learned on one half and measured on the other, so that trees do not trust words seen once
    half = packed.mixed(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(2) == 0
    lexicon = learn_lexicon([s for s, g in zip(stems, grows & half, strict=True) if g], y[grows & half], config)
    x = _measured_sample(sample, lexicon, ids)
    trees = grow(x[grows & ~half], y[grows & ~half], config)
    check = ~grows
    trees.points, trees.levels = isotonic(trees.raw(x[check]), y[check])
    return ToxicityModel(lexicon, trees)


def _measured_sample(sample: DataFrame, lexicon: Lexicon, ids: np.ndarray) -> np.ndarray:
    def features_of(batches):
        for batch in batches:
            x = measure(*packed.buffers(batch.column("text")), lexicon)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "x"])
            packed.release()

    schema = T.StructType([sample.schema["doc_id"], T.StructField("x", T.ArrayType(T.DoubleType()))])
    rows = sample.mapInArrow(features_of, schema).toArrow().sort_by("doc_id")
    return np.array(rows["x"].to_pylist(), float).reshape(len(ids), len(FEATURES))


def score_toxicity(docs: DataFrame, model: ToxicityModel, with_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: likelier toxic). Every text is read whole; nothing is shuffled.

    NULL and empty texts are scored like a text without words. Other columns stay; a column named ``score`` is replaced.
    Repeated rows get one score, no rows give no rows. Unless ``with_text`` the texts do not come back from the workers.
    """
    docs = docs.drop("score")
    text_at = docs.columns.index("text")
    back = [k for k in range(len(docs.columns)) if with_text or k != text_at]
    schema = T.StructType([*(docs.schema.fields[k] for k in back), T.StructField("score", T.DoubleType())])

    def scored(batches):
        for batch in batches:
            x = measure(*packed.buffers(batch.column(text_at)), model.lexicon)
            arrays = [*(batch.column(k) for k in back), pa.array(model.trees.score(x))]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)
            packed.release()

    return docs.mapInArrow(scored, schema)


def toxicity_table(docs: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    model = train_toxicity(docs, labels, config)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % config.fold == 0, F.lit(False))
    return score_toxicity(docs.select("doc_id", "text"), model, with_text=False).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= config.reject_at).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, config: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """Rows of ``docs`` that are not rejected, with the columns they had."""
    columns = docs.columns
    return score_toxicity(docs, train_toxicity(docs, labels, config)).filter(F.col("score") < config.reject_at).select(*columns)
