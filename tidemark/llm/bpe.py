"""BPE encoding and decoding over a distinct-word table.

Texts are cut into words at ASCII white space, which no token of this vocabulary crosses.
A task numbers the distinct words of each block of rows. The words go to buckets by hash,
where every distinct word is encoded once; the ids go back to the blocks that asked, and
each text is put together from its word numbers by position. Decoding looks the ids up in
the table of pieces, whose size is the vocabulary's.

Two kinds of rows are shuffled: packed words per block and bucket, and packed word numbers
per block. Both passes over the texts cut the same blocks; the answers carry a digest of the
words that were asked for, in their order, and a block with other words stops the job. Within one block two words count as one if their 64-bit hashes are
equal.

Rows: a null text is encoded as an empty one, to no ids. Repeated rows are encoded each,
null ids included. An empty table gives an empty result. Other columns are ignored.
"""
from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.taskcontext import TaskContext

from tidemark.llm.blocks import blocks
from tidemark.llm.words import WORD_VALUE, chunks, mix, segment_hashes, words

ENCODED = "doc_id bigint, ids array<int>, decoded string"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
ASKED = "bucket int, block bigint, mark bigint, words binary"
ANSWERED = "block bigint, bucket int, mark bigint, lengths binary, ids binary"
PACKED = "block bigint, doc_ids array<bigint>, n_words binary, numbers binary, mark bigint"
ENCODE_AT_ONCE = 2048
WORDS_AT_ONCE = 1 << 19


@lru_cache(maxsize=2)
def tokenizer(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=2)
def pieces(spec: str) -> list[bytes]:
    """Piece of every id."""
    read = json.loads(spec)
    table = {i: p for p, i in read["model"]["vocab"].items()}
    table |= {t["id"]: t["content"] for t in read["added_tokens"]}
    return [table.get(i, "").encode() for i in range(max(table) + 1)]


def packed(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=kind)


class Numbered:
    """Word numbers of a block; distinct words are ordered by bucket, then by first place."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray, buckets: int):
        starts, ends, hashes, per_row = [], [], [], []
        for i, j in chunks(offsets):
            lo = offsets[i]
            part = body[lo:offsets[j]]
            s, e, bounds = words(part, offsets[i:j + 1] - lo)
            hashes.append(segment_hashes(part, s, WORD_VALUE))
            starts.append(s + lo)
            ends.append(e + lo)
            per_row.append(np.diff(bounds))
        self.body = body
        self.n_words = np.concatenate(per_row).astype("<u4")
        codes, distinct = pd.factorize(np.concatenate(hashes))
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        bucket = ((distinct >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.numbers = rank[codes].astype("<u4") if len(codes) else np.zeros(0, "<u4")
        self.bucket = bucket[order]
        step = np.arange(len(order), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.mark = int(np.bitwise_xor.reduce(mix(distinct[order] ^ step)).view(np.int64)) if len(order) else 0
        at = first[order]
        self.starts, self.ends = np.concatenate(starts)[at], np.concatenate(ends)[at]

    def asked(self) -> Iterator[tuple[int, bytes]]:
        """Bucket and packed words, for each bucket that has words of this block."""
        raw = self.body.tobytes()
        squeeze = zstandard.ZstdCompressor(level=1)
        edges = np.flatnonzero(np.diff(self.bucket)) + 1
        for lo, hi in zip(np.append(0, edges).tolist(), np.append(edges, len(self.bucket)).tolist()):
            if hi > lo:
                mine = zip(self.starts[lo:hi].tolist(), self.ends[lo:hi].tolist())
                yield int(self.bucket[lo]), squeeze.compress(b"\n".join([raw[s:e] for s, e in mine]))


def numbered(batches: Iterator[pa.RecordBatch], buckets: int
             ) -> Iterator[tuple[int, pa.Array, Numbered]]:
    task = TaskContext.get()
    base = (task.partitionId() if task else 0) << 24
    for k, (ids, body, offsets) in enumerate(blocks(batches)):
        yield base + k, ids, Numbered(body, offsets, buckets)


def encode_words(spec: str, asked: pa.Table) -> pa.Table:
    """Every distinct word of a bucket once; then the answers for each block, in its order."""
    place: dict[bytes, int] = {}
    wanted = []
    for blob in asked.column("words").to_pylist():
        split = zstandard.ZstdDecompressor().decompress(blob).split(b"\n")
        wanted.append(np.fromiter((place.setdefault(w, len(place)) for w in split), np.int64,
                                  len(split)))
    t, table, lengths = tokenizer(spec), list(place), np.zeros(len(place), np.int64)
    encode = getattr(t, "encode_batch_fast", t.encode_batch)
    found = []
    for i in range(0, len(table), ENCODE_AT_ONCE):
        part = encode([w.decode() for w in table[i:i + ENCODE_AT_ONCE]], add_special_tokens=False)
        ids = [e.ids for e in part]
        lengths[i:i + len(ids)] = [len(x) for x in ids]
        found.append(np.array([x for one in ids for x in one], dtype=np.uint32))
    flat = np.concatenate(found)
    at = np.concatenate([[0], np.cumsum(lengths)])
    rows = []
    for want in wanted:
        size = lengths[want]
        rows.append((packed(size.astype("<u4")), packed(gather(flat, at[want], size).astype("<u4"))))
    return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"),
                     "mark": asked.column("mark"), "lengths": pa.array([r[0] for r in rows], pa.binary()),
                     "ids": pa.array([r[1] for r in rows], pa.binary())})


def gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that start at ``at``, one after the other."""
    before = np.cumsum(size) - size
    return flat[np.repeat(at - before, size) + np.arange(int(size.sum()))]


def assembled(spec: str, block: pa.Table, answers: pa.Table
              ) -> Iterator[tuple[int | None, np.ndarray, bytes]]:
    """Id, token ids and decoded text of each row of a block."""
    answers = answers.sort_by("bucket")
    lengths = [unpacked(b, "<u4") for b in answers.column("lengths").to_pylist()]
    ids = [unpacked(b, "<u4") for b in answers.column("ids").to_pylist()]
    lengths = np.concatenate([np.zeros(0, "<u4"), *lengths]).astype(np.int64)
    flat = np.concatenate([np.zeros(0, "<u4"), *ids])
    at = np.concatenate([[0], np.cumsum(lengths)])
    name = pieces(spec)
    listed, edges = flat.tolist(), at.tolist()
    spoken = [b" ".join([name[t] for t in listed[lo:hi]]) if hi > lo else None
              for lo, hi in zip(edges, edges[1:])]
    told = set(answers.column("mark").to_pylist())
    for doc_ids, n_words, numbers, mark in zip(*(block.column(c).to_pylist() for c in (
            "doc_ids", "n_words", "numbers", "mark"))):
        if told != ({mark} if mark else set()):
            raise RuntimeError("the two passes cut different blocks: the input is not repeatable")
        per_row, number = unpacked(n_words, "<u4").astype(np.int64), unpacked(numbers, "<u4")
        bounds = np.concatenate([[0], np.cumsum(per_row)])
        for i, j in chunks(bounds, WORDS_AT_ONCE):
            mine = number[bounds[i]:bounds[j]]
            out = gather(flat, at[mine], lengths[mine])
            ends = np.concatenate([[0], np.cumsum(lengths[mine])])[bounds[i:j + 1] - bounds[i]]
            said = [spoken[k] for k in mine.tolist()]
            cut = (bounds[i:j + 1] - bounds[i]).tolist()
            for row in range(i, j):
                k = row - i
                text = b" ".join([s for s in said[cut[k]:cut[k + 1]] if s is not None])
                yield doc_ids[row], out[ends[k]:ends[k + 1]], text


def whole_rows(rows: Iterator[tuple[int | None, np.ndarray, bytes]]) -> pa.Table:
    got = list(rows)
    return pa.table({"doc_id": pa.array([r[0] for r in got], pa.int64()),
                     "ids": pa.array([r[1].astype(np.int32) for r in got], pa.list_(pa.int32())),
                     "decoded": pa.array([r[2].decode() for r in got], pa.string())})


def digest_rows(rows: Iterator[tuple[int | None, np.ndarray, bytes]]) -> pa.Table:
    got = [(i, len(ids), sha256(ids.astype("<u4").tobytes()).hexdigest(), sha256(text).hexdigest())
           for i, ids, text in rows]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    return pa.table({n: pa.array([r[k] for r in got], t)
                     for k, (n, t) in enumerate(zip(names, kinds))})


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text", finish: Callable = whole_rows, schema: str = ENCODED,
                  buckets: int | None = None) -> DataFrame:
    """Token ids of every text and the text that they decode to.

    ``finish`` turns the rows of a block into an Arrow table of ``schema``; the default gives
    ``doc_id``, ``ids`` and ``decoded``, :func:`digest_rows` their digests. ``buckets`` spreads
    the distinct words, four for each shuffle partition unless given.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    if buckets is None:
        buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))

    def ask(batches):
        for block, _, n in numbered(batches, buckets):
            rows = list(n.asked())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([block] * len(rows), pa.int64()), pa.array([n.mark] * len(rows), pa.int64()),
                 pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "block", "mark", "words"])

    def pack(batches):
        for block, ids, n in numbered(batches, buckets):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                 pa.array([packed(n.n_words)], pa.binary()),
                 pa.array([packed(n.numbers)], pa.binary()),
                 pa.array([n.mark], pa.int64())],
                names=["block", "doc_ids", "n_words", "numbers", "mark"])

    def answer(asked: pa.Table) -> pa.Table:
        return encode_words(spec, asked)

    def assemble(block: pa.Table, answers: pa.Table) -> pa.Table:
        return finish(assembled(spec, block, answers))

    answers = read.mapInArrow(ask, ASKED).groupBy("bucket").applyInArrow(answer, ANSWERED)
    return (read.mapInArrow(pack, PACKED).groupBy("block")
            .cogroup(answers.groupBy("block")).applyInArrow(assemble, schema))
