"""Removal of word windows that an earlier document has.

Every window of 13 words gets a Rabin-Karp hash. Windows meet by ranges of the hash, and each hash
learns the smallest document it starts in; documents with a larger id lose the words under such
windows, overlapping windows merging into maximal intervals. A task first compares the windows of
its own documents, so of a passage that very many documents share only one window per task travels;
the others are settled at once and travel by document. Ids and hashes travel as packed arrays, so a
row holds many windows.

Two different windows share a 64-bit hash with a probability of about 5e-20 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import staged, text_or_empty
from tidewright.llm.windows import mixed, pack, unpack, window_hashes, word_slices, words_of

WIDTH = 13
#: Words that a task compares among themselves at a time, and windows that meet in a group on average.
SLICE_WORDS, GROUP_WINDOWS = 1_000_000, 1 << 18
#: Characters per word, for the number of groups only.
CHARS_PER_WORD = 6

PACKED = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("settled", pa.bool_()), ("hashes", pa.binary()), ("low", pa.int64()), ("docs", pa.binary())])
REMOVED = pa.schema([("id", pa.int64()), ("hashes", pa.binary())])


def _unique(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, doc) in order, and whether a smaller doc has the hash."""
    order = np.lexsort((docs, hashes))
    h, d = hashes[order], docs[order]
    if not len(h):
        return h, d, np.empty(0, bool)
    new_hash = np.concatenate(([True], h[1:] != h[:-1]))
    fresh = new_hash | np.concatenate(([True], d[1:] != d[:-1]))
    first = d[np.flatnonzero(new_hash)][np.cumsum(new_hash) - 1]
    return h[fresh], d[fresh], (d > first)[fresh]


def _by_bucket(h: np.ndarray, d: np.ndarray, buckets: np.ndarray, settled: bool) -> pa.RecordBatch:
    """One row per bucket with its hashes and docs; `buckets` is sorted."""
    starts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1]))) if len(h) else np.empty(0, int)
    rows: list[list] = [[] for _ in PACKED]
    for a, b in zip(starts, [*starts[1:], len(h)]):
        low = int(d[a:b].min())
        packed = (int(buckets[a]), int(b - a), settled, pack(h[a:b]), low, pack((d[a:b] - low).view(np.uint64)))
        for column, value in zip(rows, packed):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, PACKED)], schema=PACKED)


def _removed(h: np.ndarray, d: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(doc, its hashes), a row per doc."""
    order = np.argsort(d, kind="stable")
    h, d = h[order], d[order]
    starts = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1]))) if len(d) else np.empty(0, int)
    for a, b in zip(starts, [*starts[1:], len(d)]):
        yield int(d[a]), h[a:b].astype("<u8").tobytes()


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """`id`, `hashes`: of every document, the hashes of its windows that a document with a smaller id has.

    Several rows may belong to one document. Rows without id take no part.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(0, min(30, round(np.log2(max(1.0, chars / CHARS_PER_WORD / GROUP_WINDOWS)))))

    def bucket(values: np.ndarray) -> np.ndarray:
        return (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, texts in word_slices((t.as_py() for t in batch.column(1)), SLICE_WORDS):
                hashes, owner = window_hashes(texts, width)
                h, d, later = _unique(hashes, ids[start + owner])
                yield _by_bucket(h[~later], d[~later], bucket(h[~later]), settled=False)
                h, d = h[later], d[later]
                place = bucket(mixed(d.view(np.uint64)))
                order = np.argsort(place, kind="stable")
                yield _by_bucket(h[order], d[order], place[order], settled=True)

    def meet(group: pa.Table) -> pa.Table:
        open_h, open_d, ids, hashes = [], [], [], []
        for row in group.to_pylist():
            h = unpack(row["hashes"], row["n"])
            d = unpack(row["docs"], row["n"]).view(np.int64) + row["low"]
            if row["settled"]:
                for i, x in _removed(h, d):
                    ids.append(i)
                    hashes.append(x)
            else:
                open_h.append(h)
                open_d.append(d)
        if open_h:
            h, d, later = _unique(np.concatenate(open_h), np.concatenate(open_d))
            for i, x in _removed(h[later], d[later]):
                ids.append(i)
                hashes.append(x)
        return pa.table([pa.array(ids, pa.int64()), pa.array(hashes, pa.binary())], schema=REMOVED)

    packed = rows.mapInArrow(spread, "bucket int, n int, settled boolean, hashes binary, low long, docs binary")
    return packed.groupBy("bucket").applyInArrow(meet, "id long, hashes binary")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Per row of `docs`: `id_col`, n_words, `removed` (maximal intervals of word positions, ends
    exclusive), and `kept`, the remaining words joined by one space.

    A word goes if it lies in a window of `width` words that also starts in a document with a smaller
    id. Windows that repeat only within a document stay. Null texts have no words. Rows that share
    an id count as one document, each judged with its own words; rows without id lose and remove
    nothing. An empty table gives none.
    """
    gone = staged(repeated_windows(docs, id_col, text_col, width), "windows")
    gone = gone.groupBy("id").agg(F.collect_list("hashes").alias("hashes"))
    rows = docs.select(F.col(id_col).alias("own_id"), text_or_empty(text_col).alias("text"))
    both = rows.join(gone, F.col("own_id").cast("long") == F.col("id"), "left").select("own_id", "text", "hashes")
    kind = dict(rows.dtypes)["own_id"]
    interval = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, removed, kept = [], [], []
            for text, hashes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = words_of(text)
                n_words.append(len(own))
                spans: list[dict[str, int]] = []
                if hashes:
                    values, _ = window_hashes([own], width)
                    hit = np.flatnonzero(np.isin(values, np.frombuffer(b"".join(hashes), "<u8")))
                    breaks = np.flatnonzero(np.diff(hit) > width)
                    for first, last in zip(hit[np.concatenate(([0], breaks + 1))], hit[np.concatenate((breaks, [-1]))]) if len(hit) else ():
                        spans.append({"start": int(first), "end": int(last) + width})
                    left, at = [], 0
                    for s in spans:
                        left += own[at : s["start"]]
                        at = s["end"]
                    own = left + own[at:]
                removed.append(spans)
                kept.append(b" ".join(own).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(removed, interval), pa.array(kept, pa.string())],
                names=["id", "n_words", "removed", "kept"],
            )

    out = both.mapInArrow(cut, f"id {kind}, n_words long, removed array<struct<start:int,end:int>>, kept string")
    return out.withColumnRenamed("id", id_col)
