"""Cross-tokenizer alignment (operator 13): two tokenizers' tokens of each text, lined up by their bytes.

Tokenizer A (byte-level BPE in the tokenizers library's format) reads a space and the text, tokenizer B (BPE with
byte fallback, sentencepiece) the text, to which it adds that space. The Arrow columns of a chunk of documents go through these steps:
token lists are flattened, and their parent indices kept; a cumulative sum of the token lengths
less its value at the parent's start is the byte at which a token ends in its document; a full
outer hash join of A and B on document and end gives a row per cut, sorted, with nulls where only
one side ends. Filled backward, a row is a link: the A and the B token that share the bytes before
the cut. Rows where both end close a group.

Document counts of linked pairs: each chunk counts its own by ``Table.group_by``; Spark sums them.
The chunk's documents are a written row that holds places in the chunk's list of pairs, so a pair
goes through the shuffles once per chunk, however many documents have it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.bpe import byte_characters
from flowguard.llm.common import file_bytes, small_batches, with_columns, write_table

MAX_MODEL_BYTES = 64 << 20
#: Text bytes of a chunk (a longer text is alone), and of the parts in which a long text is encoded.
CHUNK_BYTES, PART_CHARS = 2 << 20, 1 << 16
_END = 1 << 40  # document-end key: document * _END + end


def read_model(spark: SparkSession, path: str) -> bytes:
    """A tokenizer file at ``path`` (any file system Spark reads, or a file of the driver), up to ``MAX_MODEL_BYTES``."""
    return file_bytes(spark, path, MAX_MODEL_BYTES)


#: Fixed value: the published pre-token pattern of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: tiktoken's time grows with the square of a pre-token's length: parts with a longer word or gap go to the tokenizers library.
LONG_WORD = 1000
_GAP = re.compile(rf"\s{{{LONG_WORD}}}")


def ranked(source: bytes) -> tiktoken.Encoding | None:
    """The same tokenizer as ranks (three times as fast), if the file is byte-level BPE whose ids are in the order of its merges."""
    spec = json.loads(source)
    pre, vocabulary = spec.get("pre_tokenizer") or {}, spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ids = [vocabulary[a + b] for a, b in merges]
    characters = byte_characters()
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
    model = spec["model"]
    if not plain or any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
        return None
    if any(x >= y for x, y in zip(ids, ids[1:])) or max(vocabulary[c] for c in characters) > min(ids, default=1 << 30):
        return None
    byte_of = {c: k for k, c in enumerate(characters)}
    known = {x["content"] for x in spec.get("added_tokens") or []}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in known}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Pair:
    """The two tokenizers, and per id the token's bytes and decimal number as Arrow columns."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.ranked = ranked(a)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        byte_of = {c: k for k, c in enumerate(byte_characters())}
        size = self.a.get_vocab_size(with_added_tokens=True)
        strings = [self.a.id_to_token(i) or "" for i in range(size)]
        bytes_a = [bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode() for s in strings]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        special = [self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i) for i in range(len(pieces))]
        bytes_b = [b"" if special[i] else bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = [pa.array(x, pa.large_binary()) for x in (bytes_a, bytes_b)]
        self.decimal = pa.array([str(i) for i in range(max(size, len(pieces)))])
        #: No piece has a space after another character, so that none crosses the cuts of ``parts``.
        self.divisible = not any("▁" in p.lstrip("▁") for p in pieces)

    def parts(self, text: str) -> list[str]:
        """A long text cut at single spaces (left out) between characters that are no white space: no token crosses them."""
        out, at = [], 0
        while self.divisible and len(text) - at > 2 * PART_CHARS:
            cut = text.find(" ", at + PART_CHARS)
            while 0 <= cut < len(text) - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
                cut = text.find(" ", cut + 1)
            if not 0 <= cut < len(text) - 1:
                break
            out.append(text[at:cut])
            at = cut + 1
        return [*out, text[at:]]

    def by_a(self, part: str) -> list[int]:
        if self.ranked and (len(part) < LONG_WORD or max(map(len, part.split()), default=0) < LONG_WORD and not _GAP.search(part)):
            return self.ranked.encode_ordinary(f" {part}")
        return self.a.encode(f" {part}", add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[list[np.ndarray]]:
        """The ids of each text by A and by B (none of an empty text)."""
        cut = [self.parts(t) if t else [] for t in texts]
        flat = [p for parts in cut for p in parts]
        found_a = [self.by_a(p) for p in flat]
        found_b = self.b.encode(flat, num_threads=1) if flat else []
        out = []
        for found in (found_a, found_b):
            rest = iter(found)
            out.append([np.concatenate([np.array(next(rest), np.int32) for _ in parts]) if parts else np.zeros(0, np.int32) for parts in cut])
        return out

    def __reduce__(self):
        raise TypeError("send the files, not the tokenizers")


@lru_cache(1)
def tokenizer_pair(a: bytes, b: bytes) -> Pair:
    """The tokenizers of two files' content: one pair per process."""
    return Pair(a, b)


def _lists(rows: list[np.ndarray]) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(r) for r in rows])]), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))


def _joined(tokens: pa.LargeListArray, strings: pa.Array) -> list[bytes]:
    """Per document the bytes of its tokens."""
    flat = pc.take(strings, tokens.flatten())
    if not len(flat):
        return [b""] * len(tokens)
    _, ends, data = flat.buffers()  # the taken strings lie end to end
    at = np.frombuffer(ends, np.int64)[flat.offset + tokens.offsets.to_numpy()]
    data = memoryview(data)
    return [bytes(data[lo:hi]) for lo, hi in zip(at[:-1], at[1:])]


def _ends(tokens: pa.LargeListArray, strings: pa.Array, name: str) -> pa.Table:
    """(key, ``name``): document and end of each token, and its id. The sums begin anew in each document."""
    ids, parent = tokens.flatten(), pc.list_parent_indices(tokens)
    length = pc.cast(pc.binary_length(pc.take(strings, ids)), pa.int64())
    total = pc.cumulative_sum(length)
    before = pc.subtract(total, length)  # where a token starts, over all documents
    start = pc.take(before, pc.cast(pc.take(tokens.offsets, parent), pa.int64()))
    end = pc.subtract(total, start)
    return pa.table({"key": pc.add(pc.multiply(parent, pa.scalar(_END, pa.int64())), end), name: ids})


def _sums(flags: pa.ChunkedArray) -> np.ndarray:
    return pc.cumulative_sum(pc.cast(flags, pa.int64())).to_numpy()


def align_chunk(pair: Pair, texts: list[str], ids: list[list[np.ndarray]] | None = None) -> tuple[dict[str, np.ndarray], list[str], pa.Table, np.ndarray]:
    """(counts, groups, pairs, kinds) of some documents.

    counts: n_a, n_b, n_groups and n_links of each; groups: ``a1,a2|b1;...`` ('' without tokens);
    pairs: (doc, pair, times), a row for each document and linked pair, by document; kinds: the id
    pairs (A's id * 2^32 + B's) that ``pair`` numbers.
    """
    a, b = ids or pair.encode(texts)
    joined = [_joined(_lists(x), s) for x, s in zip((a, b), pair.bytes)]
    none = np.zeros(0, np.int32)
    for d, t in enumerate(texts):
        whole = b" " + t.encode()
        if len(a[d]) and not joined[0][d] == whole == joined[1][d]:
            a[d] = b[d] = none  # a tokenizer changed the text
    del joined
    a, b = _lists(a), _lists(b)
    cuts = _ends(a, pair.bytes[0], "a").join(_ends(b, pair.bytes[1], "b"), "key", join_type="full outer", use_threads=False).sort_by("key")
    doc = pc.divide(cuts["key"], pa.scalar(_END, pa.int64()))
    ends = [pc.is_valid(cuts[c]) for c in ("a", "b")]
    both = pc.and_(*ends)
    per_doc = lambda mask: np.bincount(doc.filter(mask).to_numpy() if mask is not None else doc.to_numpy(), minlength=len(texts))
    counts = {"n_a": per_doc(ends[0]), "n_b": per_doc(ends[1]), "n_groups": per_doc(both), "n_links": per_doc(None)}

    sides = []
    for c, end in zip(("a", "b"), ends):
        token = pc.take(pair.decimal, cuts[c].drop_null().combine_chunks())
        first = np.r_[0, _sums(end)[both.to_numpy()]] if cuts.num_rows else np.zeros(1, np.int64)
        sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), token), ","))
    group = pc.binary_join_element_wise(*sides, "|")
    groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts["n_groups"])].astype(np.int32)), group), ";").to_pylist()

    filled = [pc.cast(pc.fill_null_backward(cuts[c]), pa.int64()) for c in ("a", "b")]
    linked = pc.add(pc.multiply(filled[0], pa.scalar(1 << 32, pa.int64())), filled[1]).combine_chunks().dictionary_encode()
    links = pa.table({"doc": doc, "pair": linked.indices})
    pairs = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "times"]).sort_by([("doc", "ascending"), ("pair", "ascending")])
    return counts, groups, pairs, linked.dictionary.to_numpy()


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    groups holds the decimal ids as ``a1,a2|b1;a3|b2,b3``; ``digests`` replaces it by groups_sha256.
    n_best: links whose pair occurs in no fewer documents than any other pair with the same A id;
    count_sum: the sum over links of their pair's number of documents. Null and empty texts, and
    texts that a tokenizer alters, have no tokens: zeros and ''. A repeated row is a document of
    its own in the counts, an id may be null, other columns are left out, and an empty table gives
    none. A long text is encoded part by part, with the same tokens.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast((read_model(spark, path_a), read_model(spark, path_b)))
    last = "groups_sha256" if digests else "groups"
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    # one row per chunk: documents, the places of their pairs in a and b, and per pair the chunk's documents that have it
    row = {"chunk": "long", "doc_id": f"array<{kind}>"} | {c: "array<long>" for c in numbers} | {
        last: "array<string>", "first": "array<int>", "pair": "array<int>", "times": "array<int>", "a": "array<int>", "b": "array<int>", "docs": "array<int>"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(*files.value)
        number = TaskContext.get().partitionId() << 32
        held: list = []

        def chunk() -> pa.RecordBatch:
            nonlocal number
            texts = [t for _, part, _, _ in held for t in part]
            ids = [[x for h in held for x in h[side]] for side in (2, 3)]
            counts, groups, pairs, kinds = align_chunk(pair, texts, ids)
            doc, place = pairs["doc"].to_numpy(), pairs["pair"].to_numpy()
            if digests:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            of = pa.concat_arrays([h[0] for h in held])
            values = [of, *[pa.array(counts[c].astype(np.int64)) for c in numbers], pa.array(groups, pa.string()),
                      pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(pairs["times"].to_numpy().astype(np.int32)),
                      pa.array((kinds >> 32).astype(np.int32)), pa.array((kinds & 0xFFFFFFFF).astype(np.int32)), pa.array(np.bincount(place, minlength=len(kinds)).astype(np.int32))]
            held.clear()
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values]], names=list(row))

        size = 0
        for batch in small_batches(batches, 1, CHUNK_BYTES // 4):
            more = pc.sum(pc.binary_length(batch.column(1))).as_py() or 0
            if held and size + more > CHUNK_BYTES:
                yield chunk()
                size = 0
            texts = [t or "" for t in batch.column(1).to_pylist()]
            held.append((batch.column(0), texts, *pair.encode(texts)))
            size += more
        if held:
            yield chunk()

    chunks = write_table(rows.mapInArrow(run, ", ".join(f"{k} {t}" for k, t in row.items())), "aligned-chunks")
    counts = write_table(chunks.select(F.inline(F.arrays_zip("a", "b", "docs"))).groupBy("a", "b").agg(F.sum("docs").alias("n")), "pair-counts")
    most = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))  # a row per id of A's vocabulary at most, whose file is bounded
    known = counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    places = chunks.select(F.col("chunk").alias("of"), F.posexplode(F.arrays_zip("a", "b"))).select("of", "pos", "col.a", "col.b")
    places = places.join(known, ["a", "b"]).select("of", "pos", "n", "best")

    def summed(chunk: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        for k in range(chunk.num_rows):
            part = {c: chunk[c].combine_chunks()[k].values for c in chunk.column_names if c != "chunk"}
            links = pa.table({"doc": np.repeat(np.arange(len(part["n_a"])), np.diff(part["first"].to_numpy())), "pos": part["pair"], "times": part["times"]})
            links = links.join(known.select(["pos", "n", "best"]), "pos", use_threads=False)
            times = links["times"].to_numpy().astype(np.int64)
            doc, sums = links["doc"].to_numpy(), {}
            for name, each in (("n_best", links["best"].to_numpy().astype(np.int64)), ("count_sum", links["n"].to_numpy())):
                sums[name] = np.zeros(len(part["n_a"]), np.int64)
                np.add.at(sums[name], doc, times * each)
            out.append(pa.table([part["doc_id"], *[part[c] for c in numbers], *map(pa.array, sums.values()), part[last]], names=["doc_id", *numbers, *sums, last]))
        return pa.concat_tables(out)

    schema = with_columns(rows, ["doc_id"], {c: "long" for c in (*numbers, "n_best", "count_sum")} | {last: "string"})
    kept = chunks.select("chunk", "doc_id", *numbers, last, "first", "pair", "times")
    return kept.groupBy("chunk").cogroup(places.groupBy("of")).applyInArrow(summed, schema)
