"""Packing of tokenized documents into sequences of fixed length.

A Python worker encodes every distinct word it meets once and cuts the ids of every document
into pieces. The pieces are written with their place among the pieces of equal length
in their task. How many pieces there are of each length, at most ``capacity`` numbers, is all
that the packing itself needs: :mod:`tidemark.llm.completion` turns the counts into runs of
equal fillings. The rank of a piece among all of its length, its place plus the counts of
earlier tasks, then names its sequence and offset. No piece is moved to be packed but for the
join with those counts.

Rows: a null or empty text has no ids and makes one piece of the end mark alone. Repeated rows
and rows without id are packed each. A text of more tokens than a sequence holds is cut into
full pieces and a last one. An empty table gives an empty result; other columns are ignored.
Words that a worker meets count as one if their 64-bit hashes are equal. A text may not be longer
than an Arrow batch can hold (2 GiB).
"""
from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.taskcontext import TaskContext

from tidemark.llm.blocks import blocks
from tidemark.llm.bpe import ENCODE_AT_ONCE, WORDS_AT_ONCE, gather, tokenizer
from tidemark.llm.completion import STEPS, Run, pack
from tidemark.llm.words import WORD_VALUE, chunks, segment_hashes, words
from tidemark.session import written

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PIECE_FIELDS = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                ("length", pa.int64()), ("ids_crc32", pa.int64())]
BLOCK = 8 << 20
KNOWN = 1 << 20


@lru_cache(maxsize=2)
def word_ends(spec: str) -> np.ndarray | None:
    """True for the ids that close a word; None if the vocabulary has no such ids."""
    model = json.loads(spec)["model"]
    suffix = model.get("end_of_word_suffix")
    if not suffix:
        return None
    flags = np.zeros(max(model["vocab"].values()) + 1, bool)
    flags[[i for piece, i in model["vocab"].items() if piece.endswith(suffix)]] = True
    return flags


#: Words that the vocabulary's pattern cuts into one piece, or into two at a closing mark.
PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+([.,;:!?]?)")


def encoded(spec: str, words: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The words in another order, their ids one after the other, and how many each has.

    Plain words are encoded as one text, which is twice as fast: a piece ends with an id that
    closes a word. If the pieces are not as many as there must be, as for any other word, each
    word is encoded by itself.
    """
    encode, ends = getattr(tokenizer(spec), "encode_batch_fast", tokenizer(spec).encode_batch), word_ends(spec)
    matched = [PLAIN.fullmatch(w) for w in words] if ends is not None else [None] * len(words)
    plain = [k for k, m in enumerate(matched) if m]
    rest = [k for k, m in enumerate(matched) if not m]
    flat, size = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    if plain:
        ids = np.array(encode([" ".join([words[k] for k in plain])], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(ends[ids]) + 1
        pieces_ = np.cumsum([1 + bool(matched[k][1]) for k in plain])
        if len(cuts) == pieces_[-1] and cuts[-1] == len(ids):
            flat, size = ids, np.diff(cuts[pieces_ - 1], prepend=0)
        else:
            plain, rest = [], list(range(len(words)))
    one_by_one = [e.ids for e in encode([words[k] for k in rest], add_special_tokens=False)]
    return (plain + rest, np.concatenate([flat, np.fromiter(chain.from_iterable(one_by_one), np.uint32)]),
            np.concatenate([size, np.array([len(x) for x in one_by_one], np.int64)]))


class KnownWords:
    """Ids of the words that a Python worker has met, by hash, across its tasks.

    Past ``KNOWN`` words it starts again with those of the block at hand.
    """

    def __init__(self, spec: str):
        self.spec = spec
        self.clear()

    def clear(self) -> None:
        self.hashes, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        return at, (self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool))

    def look_up(self, hashes: np.ndarray, word: Callable[[int], str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word start in ``flat``, and how many there are."""
        at, known = self.find(hashes)
        if not known.all():
            if len(self.hashes) + np.count_nonzero(~known) > KNOWN:
                self.clear()
                known[:] = False
            self.learn(hashes, np.flatnonzero(~known).tolist(), word)
            at, _ = self.find(hashes)
        return self.start[at], self.size[at]

    def learn(self, hashes: np.ndarray, new: list[int], word: Callable[[int], str]) -> None:
        flats, sizes, named = [self.flat], [], []
        for i in range(0, len(new), ENCODE_AT_ONCE):
            some = new[i:i + ENCODE_AT_ONCE]
            order, flat, size = encoded(self.spec, [word(k) for k in some])
            named += [some[k] for k in order]
            flats.append(flat)
            sizes.append(size)
        size = np.concatenate(sizes)
        start = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate(flats)
        every = np.concatenate([self.hashes, hashes[named]])
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.start = np.concatenate([self.start, start])[order]
        self.size = np.concatenate([self.size, size])[order]


known_words = lru_cache(maxsize=2)(KnownWords)


def document_ids(spec: str, batches: Iterator[pa.RecordBatch], end_id: int
                 ) -> Iterator[tuple[int | None, np.ndarray]]:
    """Id and token ids, end mark included, of every row."""
    end = np.array([end_id], "<u4")
    known = known_words(spec)
    for doc_ids, body, offsets in blocks(batches, BLOCK):
        names, raw = doc_ids.to_pylist(), body.tobytes()
        for i, j in chunks(offsets):
            shift = int(offsets[i])
            part = body[shift:offsets[j]]
            starts, ends, bounds = words(part, offsets[i:j + 1] - shift)
            codes, distinct = pd.factorize(segment_hashes(part, starts, WORD_VALUE))
            first = np.empty(len(distinct), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            low, high = (starts[first] + shift).tolist(), (ends[first] + shift).tolist()
            at, size = known.look_up(distinct, lambda k: raw[low[k]:high[k]].decode())
            out = gather(known.flat, at[codes], size[codes]).astype("<u4")
            last = np.concatenate([[0], np.cumsum(size[codes])])[bounds].tolist()
            for row in range(i, j):
                yield names[row], np.concatenate([out[last[row - i]:last[row - i + 1]], end])


def piece_rows(spec: str, capacity: int, end_id: int, with_ids: bool):
    def cut(batches):
        rows, held = [], 0
        for doc_id, ids in document_ids(spec, batches, end_id):
            for k, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start:start + capacity]
                rows.append((doc_id, k, start, len(part), crc32(part.tobytes()),
                             part.astype(np.int32) if with_ids else None))
                held += len(part)
            if held > WORDS_AT_ONCE:
                yield batch_of(rows, with_ids)
                rows, held = [], 0
        if rows:
            yield batch_of(rows, with_ids)
    return cut


def batch_of(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    fields = PIECE_FIELDS + [("ids", pa.list_(pa.int32()))] * with_ids
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind)
                                       for c, (_, kind) in enumerate(fields)], schema=pa.schema(fields))


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """The ids of every document and the end mark, cut where a sequence would be full."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(piece_rows(spec, capacity, end_id, with_ids),
                           PIECES + ", ids array<int>" * with_ids)


def numbered(batches):
    """Adds the task and the place among the task's pieces of the same length."""
    task = TaskContext.get().partitionId()
    seen: Counter = Counter()
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        order = np.argsort(lengths, kind="stable")
        sorted_ = lengths[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(
            order) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(order)))
        base = np.array([seen[n] for n in sorted_[first].tolist()], np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.repeat(base - first, size) + np.arange(len(order))
        seen.update(dict(zip(sorted_[first].tolist(), size.tolist())))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(order), task, np.int32)), pa.array(place)],
            names=[*batch.schema.names, "task", "place"])


class Slots:
    """Where the pieces of each length go: stretches of ranks and the sequences that take them."""

    def __init__(self, runs: list[Run]):
        rows, begin, sequence = [], Counter(), 0
        for filling, times in runs:
            base = 0
            for length, use in filling:
                rows.append((length, begin[length], sequence, use, base))
                begin[length] += use * times
                base += length * use
            sequence += times
        rows.sort()
        lengths = sorted(begin)
        self.lengths = np.array(lengths, np.int64)
        self.before = np.concatenate([[0], np.cumsum([begin[n] for n in lengths])]).astype(np.int64)
        length, first, self.sequence, self.use, self.base = np.array(rows, np.int64).reshape(-1, 5).T
        self.first = first + self.before[np.searchsorted(self.lengths, length)]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and ranks among their length."""
        rank = rank + self.before[np.searchsorted(self.lengths, length)]
        at = np.searchsorted(self.first, rank, side="right") - 1
        over = rank - self.first[at]
        return self.sequence[at] + over // self.use[at], self.base[at] + over % self.use[at] * length


def packed(pieces: DataFrame, capacity: int = CAPACITY, steps: int = STEPS) -> DataFrame:
    """``sequence_id`` and ``offset`` for rows of ``length`` 1 to ``capacity``; other columns stay."""
    columns = pieces.columns
    kept = written(pieces.mapInArrow(numbered, T.StructType(pieces.schema.fields + T.StructType.fromDDL(
        "task int, place bigint").fields)), "pieces")
    counts = kept.groupBy("length", "task").agg(F.count("*").alias("n"))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if total and not 0 < min(total) <= max(total) <= capacity:
        raise ValueError(f"a piece must hold 1 to {capacity} tokens")
    slots = Slots(pack(total, capacity, steps))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = kept.join(before, ["length", "task"]).select(
        *columns, (F.col("before") + F.col("place")).alias("rank"))

    def place(batches):
        for batch in batches:
            sequence, offset = slots.place(batch.column("length").to_numpy(),
                                           batch.column("rank").to_numpy())
            keep = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)],
                                             names=[*columns, "sequence_id", "offset"])

    return ranked.mapInArrow(place, T.StructType(pieces.schema.fields + T.StructType.fromDDL(
        "sequence_id bigint, offset bigint").fields))
