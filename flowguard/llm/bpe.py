"""Byte-level BPE encoding and decoding (operator 10).

A text is cut into pre-tokens; the bytes of a pre-token are a doubly linked list of symbols, and
a priority queue holds the mergeable neighbours by merge rank, then position. An entry whose
symbols have been merged since is stale and skipped. Decoding concatenates vocabulary strings.

The vocabulary file is a parameter: the driver reads it once and broadcasts it, after a check
of its size against ``MAX_VOCABULARY_BYTES``.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import small_batches, texts_of, with_columns

MAX_VOCABULARY_BYTES = 64 << 20
#: Pieces and pre-tokens, together, whose ids are remembered per Python worker; results don't depend on it.
REMEMBERED = 400_000

_WS = "\t-\r \x85\xa0  -     　"  # Unicode White_Space
#: A piece is white space and the run of other characters after it. No pre-token crosses pieces. Plain words and the full stop
#: or comma after them are pieces of their own (each is a pre-token), so that a word is remembered once.
PIECE = re.compile(f" ?[A-Za-z]+(?=[.,]?(?:[{_WS}]|\\Z))|[.,](?=[{_WS}]|\\Z)|[{_WS}]*[^{_WS}]+|[{_WS}]+")
#: Fixed value: the published pre-token pattern of this vocabulary.
PRETOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class ByteBpe:
    """Vocabulary and merges of a byte-level BPE file in the tokenizers library's JSON format."""

    def __init__(self, source: str):
        self.source = source
        spec = json.loads(source)
        model = spec["model"]
        vocabulary: dict[str, int] = model["vocab"]
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.strings: dict[int, bytes] = {i: bytes(byte_of[c] for c in s) for s, i in vocabulary.items() if all(c in byte_of for c in s)}
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens") or []}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.byte_ids = [vocabulary[c] for c in byte_characters()]
        self.rank_of: dict[int, int] = {}
        self.after: dict[int, dict[int, int]] = dict.fromkeys(vocabulary.values(), {})  # by left symbol: rank by right symbol
        self.parts: list[tuple[int, int, int]] = []  # by rank: left, right and merged symbol
        for rank, m in enumerate(model["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            self.parts.append((vocabulary[left], vocabulary[right], vocabulary[left + right]))
            self.rank_of[vocabulary[left] << 32 | vocabulary[right]] = rank
            self.after[vocabulary[left]] = self.after[vocabulary[left]] or {}
            self.after[vocabulary[left]][vocabulary[right]] = rank
        self.decimal = [str(i) for i in range(max(self.strings) + 1)]
        self.byte_ranks = [self.rank_of.get(a << 32 | b) for a in self.byte_ids for b in self.byte_ids]  # by both bytes
        self.remembered: dict[str, bytes] = {}  # ids as 32-bit integers
        self.older: dict[str, bytes] = {}

    def __reduce__(self):
        return ByteBpe, (self.source,)  # a worker's copy and what it remembers go with its broadcast, not with the process

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        n = len(data)
        byte_ranks, ranks, parts = self.byte_ranks, self.after, self.parts
        # rank and position of the left symbol in one integer (a small one, if it can be): lowest rank first, then leftmost
        bits = 14 if n <= 1 << 14 else 32
        place = (1 << bits) - 1
        queue = [rank << bits | i for i, (a, b) in enumerate(zip(data, data[1:])) if (rank := byte_ranks[a << 8 | b]) is not None]
        ids = list(map(self.byte_ids.__getitem__, data))
        if not queue:
            return ids
        heapify(queue)
        ids.append(-1)  # follows the last symbol
        before, after = [*range(-1, n)], [*range(1, n + 2)]
        while queue:
            entry = heappop(queue)
            i = entry & place
            left, right, new = parts[entry >> bits]
            if ids[i] != left:
                continue  # stale: the left symbol has gone
            j = after[i]
            if ids[j] != right:
                continue  # stale: the right symbol has gone
            ids[i] = new
            ids[j] = -1
            k = after[i] = after[j]
            before[k] = i
            rank = ranks[new].get(ids[k])
            if rank is not None:
                heappush(queue, rank << bits | i)
            h = before[i]
            if h >= 0:
                rank = ranks[ids[h]].get(new)
                if rank is not None:
                    heappush(queue, rank << bits | h)
        return [x for x in ids if x >= 0]

    def piece(self, text: str, whole: bool = False) -> bytes:
        """Ids of a piece; it is one pre-token if ``whole``."""
        found = self.remembered.get(text)
        if found is not None:
            return found
        found = self.older.pop(text, None)
        if found is None:
            if whole or (text[1:] if text[0] == " " else text).isalpha():  # letters only: one pre-token
                found = array("i", self.merge(text.encode("utf-8", "surrogatepass"))).tobytes()
            else:
                found = b"".join([self.piece(t, True) for t in PRETOKEN.findall(text)])
        if len(text) <= 64:
            if len(self.remembered) >= REMEMBERED // 2:
                self.older, self.remembered = self.remembered, {}
            self.remembered[text] = found
        return found

    def _plain(self, text: str) -> bytes:
        pieces = PIECE.findall(text)
        found = list(map(self.remembered.get, pieces))
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            found[at] = self.piece(pieces[at])
        return b"".join(found)

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers. A special token's string becomes its id, as the tokenizers library does."""
        if not self.special_pattern or "<" not in text:
            return self._plain(text)
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += self._plain(text[at : m.start()]), array("i", [self.special[m[0]]]).tobytes()
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary strings of ``ids``, joined; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(1)
def coder(source: str) -> ByteBpe:
    """The driver's tokenizer of a file's content."""
    return ByteBpe(source)


def load(spark, path: str) -> ByteBpe:
    """The tokenizer file at ``path`` (any file system Spark reads, or a file of the driver)."""
    try:
        with open(path, "rb") as f:
            data = f.read(MAX_VOCABULARY_BYTES + 1)
    except FileNotFoundError:
        row = spark.read.format("binaryFile").load(path).filter(F.col("length") <= MAX_VOCABULARY_BYTES).first()
        if row is None:
            raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes") from None
        data = bytes(row["content"])
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return coder(data.decode())


def encode_decode(docs: DataFrame, path: str, text: str = "text", ids: str | None = "token_ids", decoded: str | None = "decoded",
                  keep: list[str] | None = None, digests: bool = False) -> DataFrame:
    """``keep`` columns (default: all) with n_tokens, the ids and the decoded text of each row.

    Null and empty texts have no ids and decode to the empty text. ``digests`` replaces the two
    by ids_sha256 (of the decimal ids joined by commas) and decoded_sha256. Columns of the input
    that have the name of a new column are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load(spark, path))
    new = {"n_tokens": "long"} | ({"ids_sha256": "string", "decoded_sha256": "string"} if digests else
                                  {k: t for k, t in ((ids, "array<int>"), (decoded, "string")) if k})
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    frame = docs.select(F.col(text).alias("__text"), *keep)
    schema = with_columns(frame, keep, new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for batch in small_batches(batches, 0):
            count, first, second = [], [], []
            for text in texts_of(batch.column(0)):
                coded = bpe.packed(text)
                count.append(len(coded) // 4)
                if digests:
                    found = array("i", coded).tolist()
                    first.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, found)).encode()).hexdigest())
                    second.append(hashlib.sha256(bpe.decode(found).encode()).hexdigest())
                else:
                    first.append(coded if ids else b"")
                    second.append(bpe.decode(array("i", coded)) if decoded else None)
            values = [pa.array(count, pa.int64())]
            if digests:
                values += [pa.array(first, pa.string()), pa.array(second, pa.string())]
            else:
                if ids:
                    flat = pa.Array.from_buffers(pa.int32(), sum(count), [None, pa.py_buffer(b"".join(first))])
                    values.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *count]), pa.int32()), flat))
                values += [pa.array(second, pa.string())] * bool(decoded)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *values], names=[*batch.schema.names[1:], *new])

    return frame.mapInArrow(run, schema)
