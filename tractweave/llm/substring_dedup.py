"""Exact removal of bytes covered by a string of ``length`` bytes that starts anywhere else in the corpus.

Windows of ``length`` bytes are grouped by the least hash of their grams of half that length: equal windows have the same
least gram, and neighbouring windows share it for some fifty bytes. Such a run of windows is sent as one pair, its gram and the
hash of all its bytes:

- grams that stand once rule their windows out;
- where all runs of a gram are repeated as a whole, every window in them is repeated, and none has to be sent;
- only the windows of grams with some run of its own (the edges of repeats) are compared one by one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractweave.llm import exchange, packed
from tractweave.operators.scale import stage


@dataclass(frozen=True)
class SubstringConfig:
    length: int = 200
    slice_bytes: int = 4 << 20


_DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_PACKET = pa.schema(
    [
        ("to", pa.int64()),  # bucket, or below 0 for what a slice keeps for itself
        ("slice", pa.int64()),
        ("hashes", pa.binary()),
        ("extra", pa.binary()),
        ("many", pa.binary()),
        ("keys", pa.list_(pa.string())),
    ]
)
_PACKET_SQL = "to long, slice long, hashes binary, extra binary, many binary, keys array<string>"
_SLICE = pa.schema(
    [
        ("slice", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.binary())),
        ("marks", pa.list_(pa.binary())),
        ("doc_id", pa.int64()),  # the rest is filled, and the above NULL, for documents that are finished
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)
_SLICE_SQL = "slice long, ids array<long>, texts array<binary>, marks array<binary>, " + _DIGEST


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass
class Runs:
    """Runs of windows with one least gram: first and last window start, gram and hash of all bytes, owning document."""

    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray
    whole: np.ndarray
    doc: np.ndarray
    folds: np.ndarray
    """Whether the gram stands more than once in the run, so that the run's own windows may repeat."""
    sums: np.ndarray


def _gram_repeats(grams: np.ndarray, least: np.ndarray, valid: np.ndarray, first: np.ndarray, last: np.ndarray, reach: int) -> np.ndarray:
    """For each run whether its gram stands at several places of it."""
    edge = np.zeros(reach - 1, np.uint64)
    highest = ~_sliding_min(~np.concatenate([edge, np.where(valid, least, np.uint64(0)), edge]), reach)
    place = np.flatnonzero(highest[: len(grams)] == grams)  # grams that are the least of some window
    names, which = np.unique(grams[place], return_inverse=True)
    order = np.argsort(which, kind="stable")
    key = which[order] * np.int64(len(grams) + 1) + place[order]
    base = np.searchsorted(names, least[first]) * np.int64(len(grams) + 1)
    return np.searchsorted(key, base + last + reach) - np.searchsorted(key, base + first) > 1


def runs_of(raw: np.ndarray, offsets: np.ndarray, length: int) -> Runs:
    sums = packed.prefix_hashes(raw)
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return Runs(none, none, none.astype(np.uint64), none.astype(np.uint64), none, none.astype(bool), sums)
    half = length // 2
    at = np.arange(len(raw) - half + 1)
    grams = packed.span_hashes(sums, at, at + half)
    reach = length - half + 1
    least = _sliding_min(grams, reach)
    doc_end = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    valid = np.arange(len(least)) + length <= doc_end
    opens = valid & np.concatenate([[True], ~valid[:-1] | (least[1:] != least[:-1]) | (doc_end[1:] != doc_end[:-1])])
    closes = valid & np.concatenate([opens[1:] | ~valid[1:], [True]])
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    folds = _gram_repeats(grams, least, valid, first, last, reach)
    doc = np.searchsorted(offsets, first, "right") - 1
    return Runs(first, last, least[first], packed.span_hashes(sums, first, last + length), doc, folds, sums)


def _row(rows: dict, **values) -> None:
    for name in rows:
        rows[name].append(values.get(name))


def _send(rows: dict, number: int, bits: int, hashes: np.ndarray, extra: np.ndarray | None, many: np.ndarray) -> None:
    """One row for each bucket; ``hashes`` are in order."""
    for bucket, a, b in exchange.bucket_runs(hashes, bits):
        _row(
            rows,
            to=bucket,
            slice=number,
            hashes=hashes[a:b].tobytes(),
            extra=None if extra is None else extra[a:b].tobytes(),
            many=np.packbits(many[a:b]).tobytes(),
        )


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in the order of ``a``, and whether each stands more than once."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
    return a[fresh], b[fresh], np.diff(np.append(np.flatnonzero(fresh), len(a))) > 1


def _gram_packets(keys: list, raw: np.ndarray, offsets: np.ndarray, number: int, bits: int, length: int) -> pa.RecordBatch:
    runs = runs_of(raw, offsets, length)
    rows = {name: [] for name in _PACKET.names}
    # windows inside a run that folds may repeat: a second pair with the same fate keeps its gram from passing for single
    again = runs.folds
    gram, whole, many = _distinct_pairs(
        np.concatenate([runs.gram, runs.gram[again]]), np.concatenate([runs.whole, runs.whole[again] ^ np.uint64(1)])
    )
    _send(rows, number, bits, gram, whole, many)
    _row(
        rows,
        to=-1 - number,
        slice=number,
        hashes=runs.gram.tobytes(),
        extra=np.bincount(runs.doc, minlength=len(keys)).astype(np.uint32).tobytes(),
        keys=keys,
    )
    return pa.RecordBatch.from_pydict(rows, _PACKET)


def _bits_of(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _replies(packets: pa.Table, sent: list[np.ndarray], mark_of) -> pa.Table:
    """Send the marked hashes of every packet back to its slice."""
    rows = {name: [] for name in _PACKET.names}
    for number, to, hashes in zip(packets["slice"].to_pylist(), packets["to"].to_pylist(), sent, strict=True):
        mark = mark_of(hashes)
        some = mark > 0
        if some.any():
            _row(rows, to=to, slice=number, hashes=hashes[some].tobytes(), extra=mark[some].astype(np.uint8).tobytes())
    return pa.Table.from_pydict(rows, _PACKET)


def _merge_grams(packets: pa.Table) -> pa.Table:
    """1: all runs of the gram are repeated as a whole; 2: some are not; grams of one run are not sent back."""
    if packets["to"][0].as_py() < 0:
        return packets
    sent = [np.frombuffer(x, np.uint64) for x in packets["hashes"].to_pylist()]
    gram = np.concatenate(sent)
    whole = np.concatenate([np.frombuffer(x, np.uint64) for x in packets["extra"].to_pylist()])
    many = np.concatenate([_bits_of(x, len(s)) for x, s in zip(packets["many"].to_pylist(), sent, strict=True)])
    order = np.lexsort((whole, gram))
    g, w, m = gram[order], whole[order], many[order]
    fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
    pair = np.flatnonzero(fresh)
    again = (np.diff(np.append(pair, len(g))) > 1) | np.logical_or.reduceat(m, pair)
    names, first = np.unique(g[pair], return_index=True)
    pairs = np.diff(np.append(first, len(pair)))
    settled = np.logical_and.reduceat(again, first)
    mark = np.where(settled, 1, np.where(pairs > 1, 2, 0))
    return _replies(packets, sent, lambda h: mark[np.searchsorted(names, h)])


def _merge_windows(packets: pa.Table) -> pa.Table:
    """Windows that stand more than once in all."""
    sent = [np.frombuffer(x, np.uint64) for x in packets["hashes"].to_pylist()]
    many = [_bits_of(x, len(s)) for x, s in zip(packets["many"].to_pylist(), sent, strict=True)]
    names, which = np.unique(np.concatenate(sent), return_inverse=True)
    again = np.bincount(which, 1.0 + np.concatenate(many)) > 1
    return _replies(packets, sent, lambda h: again[np.searchsorted(names, h)].astype(np.uint8))


def _split(packets: pa.Table) -> tuple[dict, np.ndarray, np.ndarray]:
    """A slice's own row, and the replies to it in the order of their hashes."""
    own = packets.filter(pc.less(packets["to"], 0)).to_pylist()[0]
    return own, *_sorted_replies(packets.filter(pc.greater_equal(packets["to"], 0)))


def _sorted_replies(replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    hashed = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(x, np.uint64) for x in replies["hashes"].to_pylist()]])
    mark = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(x, np.uint8) for x in replies["extra"].to_pylist()]])
    order = np.argsort(hashed)
    return hashed[order], mark[order]


def _looked_up(values: np.ndarray, hashes: np.ndarray, marks: np.ndarray) -> np.ndarray:
    if not len(hashes):
        return np.zeros(len(values), np.uint8)
    at = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
    return np.where(hashes[at] == values, marks[at], 0)


def _mark_documents(packets: pa.Table) -> pa.Table:
    """Documents with marked grams: the grams, each followed by its mark."""
    own, hashes, marks = _split(packets)
    gram = np.frombuffer(own["hashes"], np.uint64)
    counts = np.frombuffer(own["extra"], np.uint32).astype(np.int64)
    mark = _looked_up(gram, hashes, marks)
    ends = np.cumsum(counts)
    keys, out = [], []
    for key, a, b in zip(own["keys"], ends - counts, ends, strict=True):
        some = mark[a:b] > 0
        if some.any():
            found, at = np.unique(gram[a:b][some], return_index=True)
            keys.append(key)
            out.append(np.column_stack([found, mark[a:b][some][at].astype(np.uint64)]).tobytes())
    return pa.table({"_k": pa.array(keys, pa.string()), "marks": pa.array(out, pa.binary())})


def _digest(doc_id, text: bytes, cover: np.ndarray) -> tuple:
    """``cover`` counts for every byte the repeated windows over it."""
    removed = cover > 0
    edge = np.diff(np.concatenate([[0], removed.astype(np.int8)]))
    kept = np.frombuffer(text, np.uint8)[~removed].tobytes()
    return doc_id, len(text), int(removed.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()


def _cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(total)[:n]


def _marked_runs(text: bytes, marks: bytes, length: int) -> tuple[Runs, np.ndarray]:
    raw = np.frombuffer(text, np.uint8)
    runs = runs_of(raw, np.array([0, len(raw)]), length)
    known = np.frombuffer(marks, np.uint64).reshape(-1, 2)
    return runs, _looked_up(runs.gram, known[:, 0], known[:, 1].astype(np.uint8))


def _windows_of(runs: Runs, mark: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of all windows in runs that are not settled."""
    open_runs = mark == 2
    first, count = runs.first[open_runs], (runs.last - runs.first + 1)[open_runs]
    starts = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return starts, packed.span_hashes(runs.sums, starts, starts + length)


def _settled_digest(doc_id, text: bytes, marks: bytes | None, length: int) -> tuple | None:
    """Digest of a document that needs no comparison of windows, else None."""
    if marks is None:
        return _digest(doc_id, text, np.zeros(len(text), np.int8))
    if (np.frombuffer(marks, np.uint64)[1::2] == 2).any():
        return None
    runs, mark = _marked_runs(text, marks, length)
    whole = mark == 1
    return _digest(doc_id, text, _cover(len(text), runs.first[whole], runs.last[whole] + length))


def _window_packets(texts: list, marks: list, number: int, bits: int, length: int) -> pa.RecordBatch:
    rows = {name: [] for name in _PACKET.names}
    every = np.sort(np.concatenate([_windows_of(*_marked_runs(t, m, length), length)[1] for t, m in zip(texts, marks, strict=True)]))
    fresh = np.concatenate([[True], every[1:] != every[:-1]]) if len(every) else np.zeros(0, bool)
    _send(rows, number, bits, every[fresh], None, np.diff(np.append(np.flatnonzero(fresh), len(every))) > 1)
    return pa.RecordBatch.from_pydict(rows, _PACKET)


def _finish(slices: pa.Table, replies: pa.Table, length: int) -> pa.Table:
    hashes, marks = _sorted_replies(replies)
    out = []
    for own in slices.to_pylist():
        for doc_id, text, mine in zip(own["ids"], own["texts"], own["marks"], strict=True):
            runs, mark = _marked_runs(text, mine, length)
            window, hashed = _windows_of(runs, mark, length)
            again = window[_looked_up(hashed, hashes, marks) > 0]
            whole = mark == 1
            starts = np.concatenate([runs.first[whole], again])
            ends = np.concatenate([runs.last[whole] + length, again + length])
            out.append(_digest(doc_id, text, _cover(len(text), starts, ends)))
    columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * len(_DIGEST_ARROW)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _DIGEST_ARROW.types, strict=True)], schema=_DIGEST_ARROW)


_DIGEST_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


def _key() -> Column:
    """Rows that repeat both id and text are one document listed twice."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.xxhash64("text").cast("string"))


def substring_table(docs: DataFrame, config: SubstringConfig = SubstringConfig()) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` for every row.

    Texts are read whole as UTF-8 bytes; NULL is empty. A byte goes if a string of ``length`` bytes over it also starts
    anywhere else, in the same text or another; strings are judged on the input. Rows that repeat an id and a text are
    rows of their own, so their strings repeat. No rows give no rows. Strings are compared by 64-bit hashes.
    """
    length = config.length
    bits = exchange.bucket_bits(docs, 40.0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _key().alias("_k"))

    def first_pass(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            raw, offsets = packed.buffers(batch.column("text"))
            keys = batch.column("_k").to_pylist()
            for i, j in packed.slices(offsets, config.slice_bytes):
                yield _gram_packets(keys[i:j], raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], number, bits, length)
                number += 1

    def sliced(batches):
        number = TaskContext.get().partitionId() << 32
        waiting, size = ([], [], []), 0

        def flush(rows):
            nonlocal waiting, size, number
            _row(rows, slice=number, ids=waiting[0], texts=waiting[1], marks=waiting[2])
            waiting, size, number = ([], [], []), 0, number + 1

        for batch in batches:
            rows = {name: [] for name in _SLICE.names}
            for doc_id, text, marks in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("marks"), strict=True):
                text, marks = (text.as_py() or "").encode(), marks.as_py()
                done = _settled_digest(doc_id, text, marks, length)
                if done:
                    _row(rows, **dict(zip(_DIGEST_ARROW.names, done, strict=True)))
                    continue
                for values, value in zip(waiting, (doc_id, text, marks), strict=True):
                    values.append(value)
                size += len(text)
                if size >= config.slice_bytes:
                    flush(rows)
            yield pa.RecordBatch.from_pydict(rows, _SLICE)
        if waiting[0]:
            rows = {name: [] for name in _SLICE.names}
            flush(rows)
            yield pa.RecordBatch.from_pydict(rows, _SLICE)

    def second_pass(batches):
        for batch in batches:
            for number, texts, marks in zip(batch.column("slice"), batch.column("texts"), batch.column("marks"), strict=True):
                yield _window_packets(texts.as_py(), marks.as_py(), number.as_py(), bits, length)

    grams = rows.select("_k", "text").mapInArrow(first_pass, _PACKET_SQL)
    replies = stage(grams.groupBy("to").applyInArrow(_merge_grams, _PACKET_SQL), "gram-replies")
    marked = replies.groupBy("slice").applyInArrow(_mark_documents, "_k string, marks binary")
    marked = marked.groupBy("_k").agg(F.first("marks").alias("marks"))
    # slices are cut once and stored, so that a task that is repeated later finds the same ones
    joined = rows.join(marked.hint("shuffle_hash"), "_k", "left").drop("_k")
    stored = stage(joined.mapInArrow(sliced, _SLICE_SQL), "marked-slices")
    slices = stored.filter("slice IS NOT NULL").select("slice", "ids", "texts", "marks")
    windows = slices.mapInArrow(second_pass, _PACKET_SQL)
    found = stage(windows.groupBy("to").applyInArrow(_merge_windows, _PACKET_SQL).select("slice", "hashes", "extra"), "window-replies")
    cut = slices.groupBy("slice").cogroup(found.groupBy("slice")).applyInArrow(lambda a, b: _finish(a, b, length), _DIGEST)
    return cut.unionByName(stored.filter("slice IS NULL").select(*_DIGEST_ARROW.names))
