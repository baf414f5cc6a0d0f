"""Collocation mining by direct-address tiles.

Texts become chunks: the numbers of their words, with a gap between pieces. Words are numbered by falling
frequency, so pairs of frequent words lie close together: the pair (left, right) has an address made of a
tile, 1,024 numbers wide each way, and a cell in it. A tile that holds many pairs is counted as a dense array
with `bincount`, the others together as sorted addresses with counts. Pairs that are frequent are ranked
anew and become the left numbers of the next round, which counts triples in the same way.

A phrase is no more frequent than its parts, so words and pairs below the least count never get a number.
Chunks count for themselves first; what they send is dealt by tile and salted, and merged twice, so that
neither a frequent word nor the tile of the most frequent ones is one task's work.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import staged, text_or_empty
from tidewright.llm.jaccard_join import groups
from tidewright.llm.positions import numbered
from tidewright.llm.windows import mixed, pack, unpack

LEAST, TOP, MILLION = 10, 2000, 1_000_000
#: A phrase goes if a longer candidate around it has this share of its count, in percent.
INSIDE = 50
UNKNOWN = "und"
#: Numbers of a tile each way, in bits, and bits of a right number.
SIDE, RIGHT = 10, 28
CELLS = 1 << 2 * SIDE
#: Tiles with a larger share of used cells are counted dense; only the first tiles each way can be.
DENSE, FIRST = CELLS // 16, 256
#: Words of a chunk, characters split at a time, addresses merged at a time and of a bucket on average.
CHUNK_WORDS, SLICE_CHARS, MERGE, BUCKET = 2_000_000, 1 << 20, 4_000_000, 4_000_000

_CUT = re.compile(r"[ \t.,;:!?\n-\r]")
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"." * 10)


def word_runs(text: str, slice_chars: int) -> Iterator[list[bytes]]:
    """The lower-case words of a text in runs, with `.` between pieces; no word is cut."""
    start = 0
    while start < len(text):
        found = _CUT.search(text, start + slice_chars) if start + slice_chars < len(text) else None
        end = found.start() if found else len(text)
        yield text[start:end].encode().lower().translate(_PIECES).replace(b".", b" . ").split()
        start = end


class _Numbers(dict):
    """Numbers of words from 1 in the order in which they come; `.` is 0."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Open:
    """The chunk of a language that is being filled. Its first `context` numbers were counted before."""

    def __init__(self, before: Iterable[bytes] = ()):
        self.numbers, self.runs, self.size = _Numbers(), [], 0
        self.add(before)
        self.context = self.size

    def add(self, words: Iterable[bytes]) -> None:
        run = np.fromiter(map(self.numbers.__getitem__, words), np.int64)
        self.runs.append(run)
        self.size += len(run)

    def last(self) -> list[bytes]:
        """The last two words, for phrases that go on in the next chunk."""
        names = list(self.numbers)
        return [names[i] for i in np.concatenate(self.runs)[-2:]]

    def row(self) -> tuple[int, list[str], np.ndarray, bytes]:
        flat = np.concatenate(self.runs)
        counts = np.bincount(flat[self.context :], minlength=len(self.numbers))[1:]
        return self.context, [w.decode() for w in list(self.numbers)[1:]], counts, pack(flat.astype(np.uint64))


def chunks_of(batches: Iterator[pa.RecordBatch], chunk_words: int, slice_chars: int) -> Iterator[pa.RecordBatch]:
    """(lang, chunk, context, size, words, counts, numbers) from (lang, text)."""
    part, made, open_chunks = TaskContext.get().partitionId(), 0, {}
    total = 0

    def close(langs: list[str]) -> Iterator[pa.RecordBatch]:
        nonlocal made
        for lang in langs:
            chunk = open_chunks.pop(lang)
            context, words, counts, numbers = chunk.row()
            columns = [[lang], [(part << 32) + made], [context], [chunk.size], [words], [counts], [numbers]]
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["lang", "chunk", "context", "size", "words", "counts", "numbers"])
            made += 1

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang = lang.as_py()
            for words in word_runs(text.as_py(), slice_chars):
                chunk = open_chunks.setdefault(lang, _Open())
                chunk.add(words)
                total += len(words)
                if total >= chunk_words:
                    before = chunk.last()
                    yield from close(list(open_chunks))
                    open_chunks[lang], total = _Open(before), 0
            if lang in open_chunks:
                open_chunks[lang].add((b".",))
    yield from close(list(open_chunks))


def address(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Tile (left, then right) and cell of pairs of numbers, in one."""
    if len(left) and (int(left.max()) >= 1 << (63 - RIGHT) or int(right.max()) >= 1 << RIGHT):
        raise OverflowError("more different words or pairs than a tile address can hold")
    low = (1 << SIDE) - 1
    tile = ((left >> SIDE) << (RIGHT - SIDE)) | (right >> SIDE)
    return (tile << 2 * SIDE) | ((left & low) << SIDE) | (right & low)


def numbers_of(addresses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) of addresses."""
    low = (1 << SIDE) - 1
    tile, cell = addresses >> 2 * SIDE, addresses & (CELLS - 1)
    right = ((tile & ((1 << (RIGHT - SIDE)) - 1)) << SIDE) | (cell & low)
    return ((tile >> (RIGHT - SIDE)) << SIDE) | (cell >> SIDE), right


def tile_counts(addresses: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different addresses, ascending, and how often (with which weight together) each occurs."""
    if not len(addresses):
        return addresses, np.zeros(0, np.int64)
    tile = addresses >> 2 * SIDE
    left, right = tile >> (RIGHT - SIDE), tile & ((1 << (RIGHT - SIDE)) - 1)
    first = (left < FIRST) & (right < FIRST)
    filled = np.bincount(np.where(first, left * FIRST + right, FIRST * FIRST), minlength=FIRST * FIRST + 1)[:-1]
    found, counts, rest = [], [], np.ones(len(addresses), dtype=bool)
    for t in np.flatnonzero(filled >= DENSE):
        at = int(t // FIRST) << (RIGHT - SIDE) | int(t % FIRST)
        own = tile == at
        rest &= ~own
        cells = np.bincount(addresses[own] & (CELLS - 1), None if weights is None else weights[own], CELLS)
        used = np.flatnonzero(cells)
        found.append((at << 2 * SIDE) + used)
        counts.append(cells[used].astype(np.int64))
    addresses = addresses[rest]
    if len(addresses):
        if weights is None:
            names, sums = np.unique(addresses, return_counts=True)
        else:
            order = np.argsort(addresses, kind="stable")
            names = addresses[order]
            starts = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
            names, sums = names[starts], np.add.reduceat(weights[rest][order], starts)
        found.append(names)
        counts.append(sums.astype(np.int64))
    found, counts = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(found, kind="stable")
    return found[order], counts[order]


def _packed(addresses: np.ndarray) -> bytes:
    return pack(np.diff(addresses, prepend=0).astype(np.uint64))


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n).astype(np.int64))


def _by_bucket(key: list, addresses: np.ndarray, values: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows (key..., bucket, n, addresses, values); a tile is in one bucket."""
    bucket = (mixed((addresses >> 2 * SIDE).astype(np.uint64) + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, starts = np.unique(bucket[order], return_index=True)
    for name, a, b in zip(names.tolist(), starts, np.append(starts[1:], len(order))):
        own = order[a:b]
        yield _row(key, name, addresses[own], values[own])


def _row(key: list, bucket: int, addresses: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    made = [pa.array([v]) for v in key] + [pa.array([bucket], pa.int64()), pa.array([len(addresses)], pa.int64())]
    made += [pa.array([_packed(addresses)], pa.binary()), pa.array([pack(values.astype(np.uint64))], pa.binary())]
    return pa.RecordBatch.from_arrays(made, names=[*(f"k{i}" for i in range(len(key))), "bucket", "n", "addresses", "amounts"])


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """(key, rows) of runs of rows that agree in the first columns; rows are read one by one."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}

    stream = rows()
    row = next(stream, None)

    def run(key: tuple) -> Iterator[dict]:
        nonlocal row
        while row is not None and tuple(list(row.values())[:keys]) == key:
            yield row
            row = next(stream, None)

    while row is not None:
        key = tuple(list(row.values())[:keys])
        own = run(key)
        yield key, own
        for _ in own:
            pass


def _merged(rows: Iterable[dict], most: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of rows of addresses and counts; only about `most` addresses wait at a time."""
    names, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting, size = [], 0
    for row in rows:
        waiting.append((_unpacked(row["addresses"], row["n"]), unpack(row["amounts"], row["n"]).astype(np.int64)))
        size += row["n"]
        if size >= max(most, len(names)):
            names, sums = tile_counts(np.concatenate([names, *(a for a, _ in waiting)]), np.concatenate([sums, *(c for _, c in waiting)]))
            waiting, size = [], 0
    if waiting:
        names, sums = tile_counts(np.concatenate([names, *(a for a, _ in waiting)]), np.concatenate([sums, *(c for _, c in waiting)]))
    return names, sums


def _frequent(counted: DataFrame, chunks: int, least: int) -> DataFrame:
    """`lang`, `bucket`, `left`, `right`, `n` of the pairs with `least` or more, from the counts of chunks."""
    salts, most = max(1, math.isqrt(chunks // 4)), MERGE

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, bucket, _), rows in _grouped(batches, 3):
            yield _row([lang], bucket, *_merged(rows, most))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, bucket), rows in _grouped(batches, 2):
            names, sums = _merged(rows, most)
            keep = sums >= least
            left, right = numbers_of(names[keep])
            columns = [pa.array([lang] * len(left), pa.string()), pa.array([bucket] * len(left), pa.int64()), pa.array(left), pa.array(right), pa.array(sums[keep])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "left", "right", "n"])

    kind = "lang string, bucket long, n long, addresses binary, amounts binary"
    keys = ["lang", "bucket", "salt"]
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts))).select(*keys, "n", "addresses", "amounts")
    first = salted.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merge, kind)
    return first.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(select, "lang string, bucket long, left long, right long, n long")


def _pair_starts(numbers: np.ndarray) -> np.ndarray:
    """Places where two known words follow each other."""
    return np.flatnonzero((numbers[:-1] >= 0) & (numbers[1:] >= 0))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 a a / (left right)), exact while counts have 15 digits."""
    wide = lambda c: c.cast("decimal(15,0)")
    above = (wide(a) * wide(a)) * F.lit(MILLION).cast("decimal(7,0)")
    return F.call_function("div", above, wide(left) * wide(right))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    inside: int = INSIDE,
) -> DataFrame:
    """The `top` phrases of 2 and 3 words of each language: `lang`, `rank` (from 1), `phrase`, `a` (its count), `l`
    and `r` (counts of its parts at the cut with the lowest score), `n` (words of the language), `score`.

    A-Z count as a-z; phrases do not cross any of `.,;:!?` or a line end; words end at spaces and tabs. Phrases with
    fewer than `least` occurrences are left out, and those inside a longer one with `inside` percent of their
    count. Order: score and count descending, then the phrase. Null texts are empty, a null language is
    `und`, repeated rows count again. A language without such phrases, and an empty table, give no rows.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), text_or_empty(text_col).alias("text"))
    kind = "lang string, chunk long, context int, size long, words array<string>, counts array<long>, numbers binary"
    sizes = CHUNK_WORDS, SLICE_CHARS
    chunks = staged(rows.mapInArrow(lambda b: chunks_of(b, *sizes), kind), "chunks")
    n_chunks, n_words = chunks.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = 1 + n_words // BUCKET

    counted = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).groupBy("lang", F.col("x.words").alias("word"))
    counted = staged(counted.agg(F.sum("x.counts").alias("f")), "words")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    known = numbered(counted.where(F.col("f") >= least), "lang", [F.desc("f"), F.col("word")])
    known = staged(known.select("lang", "word", "f", F.col("pos").alias("id")), "known")

    # the numbers of the corpus for the words of each chunk
    local = chunks.select("lang", "chunk", F.posexplode("words").alias("at", "word")).join(known.select("lang", "word", "id"), ["lang", "word"])
    local = local.groupBy("chunk").agg(F.collect_list(F.struct("at", "id")).alias("known"))
    coded = chunks.select("chunk", "lang", "context", "size", "numbers").join(local, "chunk")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                size, table = batch.column(3)[i].as_py(), batch.column(5)[i].values
                at, ids = (table.field(j).to_numpy(zero_copy_only=False) for j in (0, 1))
                numbers = unpack(batch.column(4)[i].as_py(), size).astype(np.int64)
                new = np.zeros(int(max(numbers.max(initial=0), at.max(initial=0) + 1)) + 1, dtype=np.int64)
                new[at.astype(np.int64) + 1] = ids + 1
                packed = pa.array([pack(new[numbers].astype(np.uint64))], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(j).slice(i, 1) for j in range(4)), packed], names=["chunk", "lang", "context", "size", "numbers"])

    coded = staged(coded.mapInArrow(code, "chunk long, lang string, context int, size long, numbers binary"), "coded")

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, lang, context, size, numbers in zip(*(batch.column(j).to_pylist() for j in range(5))):
                numbers = unpack(numbers, size).astype(np.int64) - 1
                at = _pair_starts(numbers)
                pairs = address(numbers[at], numbers[at + 1])
                # a pair of the context counted before, but its number is needed for the triple it begins
                again = int((at + 1 < context).sum())
                names, counts = tile_counts(pairs[again:])
                lost = np.setdiff1d(pairs[:again], names)
                place = np.searchsorted(names, lost)
                yield from _by_bucket([chunk, lang], np.insert(names, place, lost), np.insert(counts, place, 0), buckets)

    sent = "chunk long, lang string, bucket long, n long, addresses binary, amounts binary"
    sent_pairs = staged(coded.mapInArrow(count_pairs, sent), "pairs")
    frequent = staged(_frequent(sent_pairs, n_chunks, least), "frequent")
    frequent = staged(numbered(frequent, "lang", [F.desc("n"), F.col("left"), F.col("right")]).select("lang", "bucket", "left", "right", "n", F.col("pos").alias("id")), "ranked")
    sent_triples = _triples(coded, sent_pairs, frequent, buckets, n_chunks)
    triples = staged(_frequent(sent_triples, n_chunks, least), "triples")
    return _ranked(known, frequent.drop("bucket"), triples, totals, top, inside)


def _triples(coded: DataFrame, sent_pairs: DataFrame, frequent: DataFrame, buckets: int, chunks: int) -> DataFrame:
    """The triples of each chunk by bucket, as (number of the first pair, number of the last word)."""
    salts = max(1, math.isqrt(chunks // 4))
    keys = ["lang", "bucket", "salt"]
    salt = F.pmod(F.xxhash64("chunk"), F.lit(salts))
    asked = sent_pairs.select("lang", "bucket", salt.alias("salt"), F.lit(1).alias("kind"), "chunk", "n", "addresses", F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"), F.lit(None).cast("long").alias("id"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    known = frequent.select("lang", "bucket", every.alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("addresses"), "left", "right", "id")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The frequent ones of the pairs that chunks have in a bucket, with their numbers."""
        key, parts, names, ids = None, [], None, None
        for batch in batches:
            codes = [batch.column(i).to_pylist() for i in range(4)]
            starts = [i for i in range(batch.num_rows) if i == 0 or any(c[i] != c[i - 1] for c in codes)]
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                own, here = tuple(c[a] for c in codes[:3]), batch.slice(a, b - a)
                if own != key:
                    key, parts, names = own, [], None
                if codes[3][a] == 0:
                    parts.append([here.column(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in (7, 8, 9)])
                    continue
                if not parts:
                    continue
                if names is None:
                    left, right, ids = (np.concatenate(x) for x in zip(*parts))
                    names = address(left, right)
                    order = np.argsort(names)
                    names, ids = names[order], ids[order]
                for chunk, n, packed in zip(*(here.column(j).to_pylist() for j in (4, 5, 6))):
                    there = _unpacked(packed, n)
                    at = np.minimum(np.searchsorted(names, there), len(names) - 1)
                    hit = names[at] == there
                    if hit.any():
                        row = _row([chunk], own[1], there[hit], ids[at[hit]])
                        yield row.select(["k0", "n", "addresses", "amounts"])

    met = known.unionByName(asked).repartition(*keys).sortWithinPartitions(*keys, "kind")
    answers = staged(met.mapInArrow(answer, "chunk long, n long, addresses binary, amounts binary"), "answers")
    empty = {"lang": "string", "context": "int", "numbers": "binary"}
    answers = answers.select("chunk", F.lit(1).alias("kind"), "n", "addresses", "amounts", *(F.lit(None).cast(t).alias(c) for c, t in empty.items()))
    whole = coded.select("chunk", F.lit(0).alias("kind"), F.col("size").alias("n"), F.lit(None).cast("binary").alias("addresses"), F.lit(None).cast("binary").alias("amounts"), *empty)
    met = whole.unionByName(answers).repartition("chunk").sortWithinPartitions("chunk", "kind")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk,), rows in _grouped(batches, 1):
            whole, found = next(rows), [(_unpacked(r["addresses"], r["n"]), unpack(r["amounts"], r["n"]).astype(np.int64)) for r in rows]
            if not found:
                continue
            names, ids = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(names)
            names, ids = names[order], ids[order]
            numbers = unpack(whole["numbers"], whole["n"]).astype(np.int64) - 1
            at = _pair_starts(numbers)
            own = address(numbers[at], numbers[at + 1])
            place = np.minimum(np.searchsorted(names, own), len(names) - 1)
            pair = np.full(len(numbers), -1, dtype=np.int64)
            pair[at] = np.where(names[place] == own, ids[place], -1)
            start = np.flatnonzero((pair[:-2] >= 0) & (pair[1:-1] >= 0))
            yield from _by_bucket([chunk, whole["lang"]], *tile_counts(address(pair[start], numbers[start + 2])), buckets)

    sent = "chunk long, lang string, bucket long, n long, addresses binary, amounts binary"
    return staged(met.mapInArrow(count, sent), "triples")


def _ranked(words: DataFrame, pairs: DataFrame, triples: DataFrame, totals: DataFrame, top: int, inside: int) -> DataFrame:
    """Scores, removal of what lies inside longer phrases, and the best of each language."""
    word = lambda i: words.select("lang", F.col("id").alias(f"i{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"))
    pair = lambda i, j: pairs.select("lang", F.col("left").alias(f"i{i}"), F.col("right").alias(f"i{j}"), F.col("n").alias(f"f{i}{j}"), F.col("id").alias(f"p{i}{j}"))
    three = triples.select("lang", F.col("left").alias("p12"), F.col("right").alias("i3"), F.col("n").alias("a"))
    three = staged(three.join(pair(1, 2), ["lang", "p12"]).join(pair(2, 3), ["lang", "i2", "i3"]), "three")
    around = three.select("lang", F.explode(F.array("p12", "p23")).alias("p12"), "a").groupBy("lang", "p12").agg(F.max("a").alias("longer"))
    two = pair(1, 2).join(around, ["lang", "p12"], "left").where(F.coalesce(100 * F.col("longer") < inside * F.col("f12"), F.lit(True)))
    two = two.join(word(1), ["lang", "i1"]).join(word(2), ["lang", "i2"])
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f12").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"))
    three = three.join(word(1), ["lang", "i1"]).join(word(2), ["lang", "i2"]).join(word(3), ["lang", "i3"])
    first, second = score(F.col("a"), F.col("f1"), F.col("f23")), score(F.col("a"), F.col("f12"), F.col("f3"))
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", (first <= second).alias("early"), "f1", "f23", "f12", "f3")
    three = three.select("lang", "phrase", "a", F.when(F.col("early"), F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(F.col("early"), F.col("f23")).otherwise(F.col("f3")).alias("r"))
    found = two.unionByName(three).withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(totals, "lang")
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
