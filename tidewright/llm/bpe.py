"""Byte-level BPE of whole texts with reuse of content-defined chunks.

A rolling hash cuts each text where its content says so, hence passages that documents share fall into
the same chunks, wherever they stand. A worker encodes each chunk once and keeps its ids. The ids
near a cut are wrong if the cut splits a word, so a chunk keeps only the ids between its first and
last safe point, and the text around each join, from the last safe point before it to the first one
after it, is encoded anew; a chunk without a safe point widens the join. At a safe point, a space
between two visible ASCII characters, the splitting rule of the tokenizer always starts a new word,
whatever stands around it, so the repaired ids agree exactly with those of the whole text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import text_or_empty
from tidewright.llm.windows import slices

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: A space between two visible ASCII characters.
SAFE = re.compile(r"(?<=[!-~]) (?=[!-~])")
#: Texts for which the reference coder is asked: beyond Latin letters, or with very long runs.
ODD = re.compile(r"[^\x00-\u024f]|\S{1000}|\s{1000}")
#: A cut is made where the hash of this many code points has all bits of the mask set: every 512 on average.
HASHED, MASK = 16, 511 << 20
#: Bytes of chunk texts and ids that a worker keeps; it starts afresh beyond, which only costs time.
KEPT_BYTES = 64 << 20


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in the vocabulary."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def cuts(text: str) -> list[int]:
    """Positions at which the rolling hash cuts the text, its end included."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(codes) <= HASHED:
        return [len(codes)] if len(codes) else []
    mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    rolled = np.zeros(len(codes) - HASHED + 1, dtype=np.uint64)
    for k in range(HASHED):
        rolled = rolled * np.uint64(0x100000001B3) + mixed[k : k + len(rolled)]
    rolled ^= rolled >> np.uint64(32)
    found = np.flatnonzero((rolled & np.uint64(MASK)) == MASK) + HASHED
    return [*(int(x) for x in found if x < len(codes)), len(codes)]


class Encoder:
    """Encodes and decodes texts; keeps the ids of chunks between texts."""

    def __init__(self, path: str = TOKENIZER, kept_bytes: int = KEPT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        size = max([*spec["model"]["vocab"].values(), *added]) + 1
        self.bytes_of = [b""] * size
        for token, i in spec["model"]["vocab"].items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        for i, token in added.items():
            self.bytes_of[i] = token
        self.added = [t.decode() for t in added.values()]
        self.coder = self._fast_coder(spec, alphabet)
        self.width = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.kept: dict[str, tuple[str, np.ndarray, str] | None] = {}
        self.kept_size, self.kept_bytes = 0, kept_bytes
        self.encoded_chars = 0

    @staticmethod
    def _fast_coder(spec: dict, alphabet: dict[str, int]):
        """The same vocabulary as merge ranks; None if the file asks for anything but plain byte-level BPE."""
        first = spec["pre_tokenizer"] or {}
        plain = first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
        if not plain or spec["normalizer"] or spec["post_processor"] or spec["model"].get("ignore_merges"):
            return None
        import tiktoken

        vocab = spec["model"]["vocab"]
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items()}
        return tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def reference(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts as the tokenizer gives them."""
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in made]

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        """The same ids, by the faster coder where its splitting rule is known to agree."""
        self.encoded_chars += sum(map(len, texts))
        if self.coder is None:
            return self.reference(texts)
        slow = [i for i, t in enumerate(texts) if ODD.search(t) or any(a in t for a in self.added)]
        by_place = dict(zip(slow, self.reference([texts[i] for i in slow])))
        return [
            by_place[i] if i in by_place else np.array(self.coder.encode_ordinary(t), dtype="<u4")
            for i, t in enumerate(texts)
        ]

    def _learn(self, chunks: list[str]) -> None:
        """For each new chunk: the text before its first safe point, the ids from there to its last
        one, the text after it; None without two safe points."""
        for chunk, ids in zip(chunks, self.plain(chunks)):
            places = [m.start() for m in SAFE.finditer(chunk)]
            if len(places) < 2:
                self.kept[chunk] = None
                self.kept_size += 4 * len(chunk)
                continue
            first, last = places[0], places[-1]
            ends = np.concatenate(([0], np.cumsum(self.width[ids])))
            low, high = np.searchsorted(ends, (len(chunk[:first].encode()), len(chunk[:last].encode())))
            self.kept[chunk] = (chunk[:first], ids[low:high].copy(), chunk[last:])
            self.kept_size += 4 * len(chunk) + 4 * int(high - low)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each whole text."""
        if self.kept_size > self.kept_bytes:
            self.kept.clear()
            self.kept_size = 0
        parts: list[list[str]] = []
        for text in texts:
            ends = cuts(text)
            parts.append([text[a:b] for a, b in zip([0, *ends], ends)])
        self._learn([*dict.fromkeys(c for chunks in parts for c in chunks if c not in self.kept)])
        # what has to be encoded anew around the joins, in order, between the ids that stay
        plans: list[list[str | np.ndarray]] = []
        for chunks in parts:
            plan: list[str | np.ndarray] = []
            pending: list[str] = []
            for chunk in chunks:
                known = self.kept[chunk]
                if known is None:
                    pending.append(chunk)
                    continue
                plan += ["".join([*pending, known[0]]), known[1]]
                pending = [known[2]]
            plan.append("".join(pending))
            plans.append(plan)
        joins = [*dict.fromkeys(x for plan in plans for x in plan if isinstance(x, str) and x)]
        joined = dict(zip(joins, self.plain(joins)))
        joined[""] = np.empty(0, dtype="<u4")
        return [
            np.concatenate([joined[x] if isinstance(x, str) else x for x in plan]) for plan in plans
        ]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker process, so that chunks are reused across its batches."""
    return Encoder(path)


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = TOKENIZER, with_ids: bool = True
) -> DataFrame:
    """Per row of `docs`: `id_col`, n_tokens, ids (array of int, if asked for), ids_sha256, decoded_sha256.

    Null texts count as empty and have no tokens. Texts are encoded whole, however long. Repeated
    rows and null ids come back as they are; an empty table gives none.
    """
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    ids_field = [("ids", "array<int>", pa.list_(pa.int32()))] if with_ids else []
    kind = dict(rows.dtypes)[id_col]
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join(f", {n} {k}" for n, k, _ in ids_field)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at, upto in slices(texts):
                made = own.encode(texts[at:upto])
                columns = [
                    batch.column(0).slice(at, upto - at),
                    pa.array([len(x) for x in made], pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in made], pa.string()),
                    pa.array([hashlib.sha256(own.decode(x).encode()).hexdigest() for x in made], pa.string()),
                ]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in made], pa.list_(pa.int32())))
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *(n for n, _, _ in ids_field)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(work, schema).withColumnRenamed("id", id_col)
