"""Secrets in texts: known patterns, and strings in a sensitive place that do not compress.

A candidate is a string that follows a sensitive word closely. Its novelty is its marginal size: the
bytes that zstandard needs for the surrounding text with the candidate, less those without it, the
compressor being primed with a dictionary of the code identifiers and long words of the corpus. It is
compared with what random strings of the same alphabet and length cost after the same dictionary, so
that neither a small alphabet nor the length hides a key. Names, paths and words that occur elsewhere,
whole or in parts, compress well; keys do not.
"""

from __future__ import annotations

import bisect
import random
import re
import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import text_or_empty

#: The base patterns. Kind, pattern, and the least length of the last group or the match.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the same as runs of any length, short ones dropped
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase|code)|pwd|secret|token|credential|auth|bearer|signature|(?:api|access|private|encryption)[\x20_-]?key",
    re.IGNORECASE | re.ASCII,
)
LEAST_CHARS = 12
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=~$!@%^&*-]{{{LEAST_CHARS},}}")
#: Code identifiers, and words that are long enough to share parts with others.
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,63}(?=\x20*[=(:])|[A-Za-z][A-Za-z0-9]*_[A-Za-z0-9_]{1,48}|(?<![A-Za-z])[a-z]{5,24}(?![A-Za-z])")
#: Alphabets of keys, the smaller first.
_LETTERS = string.ascii_letters + string.digits
ALPHABETS = (
    string.digits, string.digits + "abcdef", string.digits + "ABCDEF", string.ascii_lowercase, string.ascii_uppercase,
    string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits,
    string.ascii_letters, _LETTERS, _LETTERS + "+/=", _LETTERS + "-_=", _LETTERS + "+/_=~$!@%^&*-",
)

SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])
)
COUNTS = pa.schema([("identifier", pa.string()), ("n", pa.int64())])

#: Most identifiers in the dictionary; with at most 64 bytes each this bounds what is sent to the tasks.
IDENTIFIERS = 4000
#: Characters of surrounding text on either side, and how far a candidate may be from the sensitive word.
AROUND, REACH = 400, 40
#: Least share of the bytes that random strings need for a report, how many of them are measured, and the
#: characters up to which their length is that of the candidate; beyond, lengths are rounded to 1/8.
NOVELTY, RANDOM, EXACT = 0.9, 5, 64


def count_identifiers(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """How many times each code identifier occurs in the texts: `identifier`, `n`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for text in batch.column("text").to_pylist():
                found.update(IDENTIFIER.findall(text))
            yield pa.RecordBatch.from_pydict({"identifier": [*found], "n": [*found.values()]}, schema=COUNTS)

    texts = docs.select(text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(count, "identifier string, n long").groupBy("identifier").agg(F.sum("n").alias("n"))


def identifier_dictionary(docs: DataFrame, text_col: str = "text", most: int = IDENTIFIERS) -> bytes:
    """The most frequent identifiers, the commonest last, where zstandard reaches them most cheaply."""
    top = count_identifiers(docs, text_col).orderBy(F.desc("n"), "identifier").limit(most).collect()
    return "\n".join(r["identifier"] for r in reversed(top)).encode()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the known patterns, by start, then kind."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


class Novelty:
    """Marginal compressed size of strings, given a dictionary."""

    def __init__(self, dictionary: bytes):
        self.dictionary = dictionary
        self.expected: dict[tuple[int, int], float] = {}

    def marginal(self, before: str, candidate: str, after: str) -> int:
        """Bytes that `candidate` adds when its surroundings and the dictionary are known."""
        primer = b"\n".join((self.dictionary, after.encode("utf-8", "replace"), before.encode("utf-8", "replace")))
        known = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(level=12, dict_data=known, write_content_size=False, write_checksum=False)
        nothing = len(compressor.compress(b"\n"))
        return len(compressor.compress(candidate.encode("utf-8", "replace") + b"\n")) - nothing

    def random_bytes(self, candidate: str) -> float:
        """Bytes that a random string of the smallest alphabet around the candidate and of its length adds."""
        own, n = set(candidate), len(candidate)
        kind = next((i for i, a in enumerate(ALPHABETS) if own <= set(a)), len(ALPHABETS) - 1)
        step = 1 if n <= EXACT else 1 << (n.bit_length() - 4)
        length = n // step * step
        if (kind, length) not in self.expected:
            rng = random.Random(kind * 1_000_003 + length)
            made = ("".join(rng.choices(ALPHABETS[kind], k=length)) for _ in range(RANDOM))
            self.expected[kind, length] = sum(self.marginal("", x, "") for x in made) / RANDOM
        return self.expected[kind, length] * n / length

    def spans(self, text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Novel candidates near a sensitive word that overlap no span of `taken`; each is measured once."""
        out: list[tuple[int, int, str]] = []
        # spans of `taken` that start before the end of a candidate but do not end before it starts overlap it
        starts, ends, seen = sorted(s for s, _, _ in taken), sorted(e for _, e, _ in taken), 0
        for word in SENSITIVE.finditer(text):
            at = max(word.end(), seen)
            while near := CANDIDATE.search(text, at, word.end() + REACH + LEAST_CHARS):
                start, end = CANDIDATE.match(text, near.start()).span()
                at = seen = end
                if bisect.bisect_left(starts, end) != bisect.bisect_right(ends, start):
                    continue
                own = text[start:end]
                new = self.marginal(text[max(0, start - AROUND) : start], own, text[end : end + AROUND])
                if new >= NOVELTY * self.random_bytes(own):
                    out.append((start, end, "novel"))
        return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col` and `spans`, array of (kind, start, end, value), for every row of `docs`.

    Positions are code points, ends exclusive. A null or empty text has no spans; repeated rows and
    null ids come back as they are; an empty table gives none. Long texts and candidates are read once.
    Other columns are not read. Only the identifier dictionary, of bounded size, goes through the driver.
    """
    dictionary = identifier_dictionary(docs, text_col)
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for batch in batches:
            spans = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                every = sorted(base + novelty.spans(text, base), key=lambda s: (s[0], KINDS.index(s[2])))
                spans.append([{"kind": k, "start": s, "end": e, "value": text[s:e]} for s, e, k in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPANS)], names=["id", "spans"])

    out = rows.mapInArrow(scan, f"id {dict(rows.dtypes)[id_col]}, spans array<struct<kind:string,start:int,end:int,value:string>>")
    return out.withColumnRenamed("id", id_col)


def span_text(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
