"""Removal of byte strings that earlier documents hold, exactly, from 50 bytes on.

Sorting every suffix moves several times the text, so suffixes are only compared where a
repeat is possible. In each window of 50 bytes the smallest of its 31 hashed 20-byte strings
is its anchor: equal windows have equal anchors, so a window whose anchor stands in one
document only is no repeat. A first exchange finds the anchors that several documents hold. In
a second one every run of windows around such an anchor goes, as its bytes, at most 80, to the bucket of
the anchor, where the windows are compared. Both exchange packed rows: a task asks for
each block of rows, a bucket answers with a bit for each anchor or window. README says why this
stands in place of external induced sorting.

Windows of different blocks are equal if their bytes are; within a block, runs count as one if
their 64-bit hashes are equal. Both passes over the texts cut the same blocks; an
answer carries a digest of what was asked, and a block that asks for something else stops the job.

Rows: a null text is empty. Nothing is removed from a text of less than 50 bytes. A row
without id is left whole and removes nothing; rows of equal id do not remove from each
other. An empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.taskcontext import TaskContext

from tidemark.llm.blocks import blocks
from tidemark.llm.words import BYTE_VALUE, chunks, mix, powers

WINDOW = 50
GRAM = 20
CHUNK = 1 << 20
BLOCK = 8 << 20
PACKED = "block bigint, doc_ids array<bigint>, sizes binary, body binary"
ASKED = "bucket int, block bigint, mark bigint, keys binary, docs binary, many binary"
RUNS = "bucket int, block bigint, mark bigint, docs binary, sizes binary, body binary"
ANSWERED = "round int, bucket int, block bigint, mark bigint, bits binary"
VERIFIED = 1 << 17
CUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
DIGESTS = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def packed(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def unpacked(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=kind)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks of that length."""
    n = len(a) - width + 1
    full = -(-len(a) // width) * width
    grid = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    grid[:len(a)] = a
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


class Windows:
    """The windows of some rows of bytes, in runs that share an anchor."""

    def __init__(self, part: np.ndarray, rows: np.ndarray):
        n = len(part)
        self.first = self.last = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        if n < WINDOW:
            return
        up, down = powers(max(n, CHUNK))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[part] * up[:n], out=self.sums[1:])
        self.down = down
        gram = self.hashes(np.arange(n - GRAM + 1), GRAM)
        mask = np.uint64((1 << n.bit_length()) - 1)
        key = (gram & ~mask) | np.arange(len(gram), dtype=np.uint64)
        at = (sliding_min(key, WINDOW - GRAM + 1) & mask).astype(np.int64)
        crossing = np.zeros(n + 1, np.int32)
        ends = rows[1:-1]
        np.add.at(crossing, np.maximum(ends - WINDOW + 1, 0), 1)
        np.add.at(crossing, ends, -1)
        start = np.flatnonzero(np.cumsum(crossing)[:len(at)] == 0)
        if len(start) == 0:
            return
        at = at[start]
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
        head = np.flatnonzero(new)
        self.first = start[head]
        self.last = start[np.append(head[1:], len(start)) - 1]
        self.anchor = gram[at[head]]

    def hashes(self, start: np.ndarray, length: int = WINDOW) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.down[start])


class Block:
    """Rows of a block: one of each distinct text is looked at, that of the smallest id."""

    def __init__(self, ids: list, body: np.ndarray, offsets: np.ndarray):
        self.ids, self.body, self.offsets = ids, body, offsets
        raw, at = body.tobytes(), offsets.tolist()
        self.raw = raw
        best: dict[bytes, int] = {}
        self.of: list[int | None] = []
        names = []
        for row, doc in enumerate(ids):
            name = blake2b(raw[at[row]:at[row + 1]], digest_size=16).digest()
            names.append(name)
            if doc is not None and (name not in best or doc < ids[best[name]]):
                best[name] = row
        self.of = [best[n] if d is not None else None for n, d in zip(names, ids)]
        self.rows = sorted(best.values())
        sizes = np.array([at[r + 1] - at[r] for r in self.rows], dtype=np.int64)
        self.edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.docs = np.array([ids[r] for r in self.rows], dtype=np.int64)
        self.joined = np.frombuffer(b"".join([raw[at[r]:at[r + 1]] for r in self.rows]), np.uint8)

    def runs(self) -> Iterator[tuple[int, Windows, np.ndarray]]:
        """Shift of each chunk, its windows, and the document of every run."""
        for i, j in chunks(self.edges, CHUNK):
            lo = self.edges[i]
            rows = self.edges[i:j + 1] - lo
            w = Windows(self.joined[lo:self.edges[j]], rows)
            owner = np.searchsorted(rows, w.first, side="right") - 1 + i
            yield lo, w, self.docs[owner]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        got = [(w.anchor, docs) for _, w, docs in self.runs()]
        return (np.concatenate([np.zeros(0, np.uint64), *(g[0] for g in got)]),
                np.concatenate([np.zeros(0, np.int64), *(g[1] for g in got)]))

    def around(self, shared: np.ndarray, buckets: int) -> Runs:
        """The runs of windows around shared anchors (sorted)."""
        parts = []
        for lo, w, owner in self.runs():
            live = member(w.anchor, shared) if len(w.first) else np.zeros(0, bool)
            first, size = w.first[live], w.last[live] - w.first[live] + 1
            whole = w.hashes(first, size + WINDOW - 1) if len(first) else np.zeros(0, np.uint64)
            parts.append((w.anchor[live], owner[live], first + lo, size, whole))
        return Runs(self.joined, buckets, *(np.concatenate(p) for p in zip(*parts))) if parts else Runs(
            self.joined, buckets, np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64))


class Runs:
    """Runs of windows of a block, ordered by bucket; of equal ones that of the smallest document is asked."""

    def __init__(self, body: np.ndarray, buckets: int, key: np.ndarray, doc: np.ndarray, start: np.ndarray,
                 size: np.ndarray, whole: np.ndarray):
        bucket = bucket_of(key, buckets)
        order = np.lexsort((doc, whole, size, key, bucket))
        bucket, key, whole = bucket[order], key[order], whole[order]
        self.doc, self.start, self.size = doc[order], start[order], size[order]
        head = np.ones(len(key), bool)
        head[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1]) | (self.size[1:] != self.size[:-1])
        self.group = np.cumsum(head) - 1
        self.first = np.flatnonzero(head)
        self.bucket, self.key, self.body = bucket[self.first], key[self.first] ^ whole[self.first], body

    def asked(self) -> Iterator[tuple[int, int, int, int]]:
        """Bucket, mark, and the range of asked runs of each bucket."""
        for lo, hi in edges_of(self.bucket):
            yield int(self.bucket[lo]), mark_of(self.key[lo:hi]), lo, hi

    def questions(self, block: int) -> pa.Table:
        rows = []
        for bucket, mark, lo, hi in self.asked():
            at = self.first[lo:hi]
            length = self.size[at] + WINDOW - 1
            rows.append((bucket, block, mark, packed(self.doc[at]), packed(self.size[at].astype(np.uint8)),
                         packed(self.body[spread(self.start[at], length)])))
        return table_of(rows, RUNS)

    def hits(self, replies: dict[int, dict]) -> np.ndarray:
        """Starts of the windows that a smaller document holds."""
        found = []
        for bucket, mark, lo, hi in self.asked():
            size = self.size[self.first[lo:hi]]
            found.append(bits_of(replies.pop(bucket, None), mark, int(size.sum())))
        seen = np.concatenate([np.zeros(0, bool), *found])
        asked_size = self.size[self.first]
        at = (np.cumsum(asked_size) - asked_size)[self.group]
        mine = seen[spread(at, self.size)]
        smaller = self.doc[self.first][self.group] < self.doc
        return spread(self.start, self.size)[mine | np.repeat(smaller, self.size)]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each stretch of a size, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def edges_of(sorted_: np.ndarray) -> Iterator[tuple[int, int]]:
    cut = np.flatnonzero(np.diff(sorted_)) + 1
    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(sorted_)]):
        if hi > lo:
            yield lo, hi


def mark_of(keys: np.ndarray) -> int:
    """A digest of keys in their order."""
    step = np.arange(len(keys), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return int(np.bitwise_xor.reduce(mix(keys ^ step)).view(np.int64))


def bits_of(row: dict | None, mark: int, count: int) -> np.ndarray:
    if row is None or row["mark"] != mark or len(row["bits"]) != -(-count // 8):
        raise RuntimeError("the passes cut different blocks: the input is not repeatable")
    return np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=count).astype(bool)


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[k] for r in rows], kinds[kind]) for k, (name, kind) in enumerate(fields)})


def member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if len(table) == 0:
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def distinct(keys: np.ndarray, docs: np.ndarray, buckets: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, key, smallest document and whether several documents hold the key, by bucket."""
    bucket = bucket_of(keys, buckets)
    order = np.lexsort((docs, keys, bucket))
    bucket, keys, docs = bucket[order], keys[order], docs[order]
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(keys)) - 1 if len(first) else first
    return bucket[first], keys[first], docs[first], docs[first] != docs[last]


def questions(block: int, keys: np.ndarray, docs: np.ndarray, buckets: int) -> pa.Table:
    bucket, keys, docs, many = distinct(keys, docs, buckets)
    return table_of([(int(bucket[lo]), block, mark_of(keys[lo:hi]), packed(np.diff(keys[lo:hi], prepend=np.uint64(0))),
                      packed(docs[lo:hi]), np.packbits(many[lo:hi]).tobytes())
                     for lo, hi in edges_of(bucket)], ASKED)


def answers(asked: pa.Table) -> pa.Table:
    """For each block's anchors of a bucket: which several documents hold."""
    keys, docs, many = [], [], []
    for k, d, m in zip(*(asked.column(c).to_pylist() for c in ("keys", "docs", "many"))):
        keys.append(np.cumsum(unpacked(k, np.uint64), dtype=np.uint64))
        docs.append(unpacked(d, np.int64))
        many.append(np.unpackbits(np.frombuffer(m, np.uint8), count=len(keys[-1])).astype(bool))
    key, doc, flag = np.concatenate(keys), np.concatenate(docs), np.concatenate(many)
    order = np.lexsort((doc, key))
    key, doc, flag = key[order], doc[order], flag[order]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(key)) - 1
    shared = (doc[first] != doc[last]) | (np.add.reduceat(flag.astype(np.int64), first) > 0)
    name = key[first]
    return replied(1, asked, [np.packbits(shared[np.searchsorted(name, k)]).tobytes() for k in keys])


def replied(turn: int, asked: pa.Table, bits: list[bytes]) -> pa.Table:
    return pa.table({"round": pa.array([turn] * len(bits), pa.int32()), "bucket": asked.column("bucket"),
                     "block": asked.column("block"), "mark": asked.column("mark"),
                     "bits": pa.array(bits, pa.binary())})


def compared(asked: pa.Table) -> pa.Table:
    """For each block's runs of a bucket: a bit for each window that a smaller document holds."""
    docs, sizes, bodies = ([unpacked(x, kind) for x in asked.column(c).to_pylist()] for c, kind in (
        ("docs", np.int64), ("sizes", np.uint8), ("body", np.uint8)))
    size = np.concatenate(sizes).astype(np.int64)
    body = np.concatenate(bodies)
    doc = np.repeat(np.concatenate(docs), size)
    length = size + WINDOW - 1
    edges = np.concatenate([[0], np.cumsum(length)])
    start = spread(edges[:-1], size)
    hashes = np.concatenate([np.zeros(0, np.uint64), *(
        window_hashes(body[edges[i]:edges[j]], spread(edges[i:j] - edges[i], size[i:j]))
        for i, j in chunks(edges, CHUNK))])
    order = np.lexsort((doc, hashes))
    groups = equal_windows(body, start, hashes, order)
    least = np.full(int(groups.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, groups, doc)
    held = least[groups] < doc
    cuts = np.cumsum([0, *(int(s.sum()) for s in sizes)])
    return replied(2, asked, [np.packbits(held[i:j]).tobytes() for i, j in zip(cuts[:-1], cuts[1:])])


def window_hashes(part: np.ndarray, start: np.ndarray) -> np.ndarray:
    up, down = powers(max(len(part), CHUNK))
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[part] * up[:len(part)], out=sums[1:])
    return mix((sums[start + WINDOW] - sums[start]) * down[start])


def equal_windows(body: np.ndarray, start: np.ndarray, hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Group of each window; windows of one hash are held against their bytes."""
    head = np.ones(len(order), bool)
    head[1:] = hashes[order][1:] != hashes[order][:-1]
    run = np.cumsum(head) - 1
    groups = np.empty(len(order), np.int64)
    groups[order] = run
    if not len(order):
        return groups
    windows = np.lib.stride_tricks.sliding_window_view(body, WINDOW)
    first = start[order[np.flatnonzero(head)]]
    for i in range(0, len(order), VERIFIED):
        mine = order[i:i + VERIFIED]
        if not np.array_equal(windows[start[mine]], windows[first[run[i:i + VERIFIED]]]):
            names: dict[bytes, int] = {}
            return np.array([names.setdefault(windows[s].tobytes(), len(names)) for s in start.tolist()], np.int64)
    return groups


def by_bucket(turn: int, replies: pa.Table) -> dict[int, dict]:
    return {r["bucket"]: r for r in replies.to_pylist() if r["round"] == turn}


def shared_anchors(block: Block, replies: pa.Table, buckets: int) -> np.ndarray:
    """The anchors of a block that several documents hold, sorted."""
    bucket, keys, _, _ = distinct(*block.anchors(), buckets)
    rows = by_bucket(1, replies)
    found = [keys[lo:hi][bits_of(rows.get(int(bucket[lo])), mark_of(keys[lo:hi]), hi - lo)]
             for lo, hi in edges_of(bucket)]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *found]))


def loaded(row: pa.Table) -> Block:
    sizes = unpacked(row.column("sizes")[0].as_py(), np.int64)
    return Block(row.column("doc_ids")[0].as_py(), unpacked(row.column("body")[0].as_py(), np.uint8),
                 np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def removed(block: Block, replies: pa.Table, buckets: int) -> Iterator[tuple]:
    """Id, bytes, bytes removed, spans and the rest of every row of a block."""
    hit = block.around(shared_anchors(block, replies, buckets), buckets).hits(by_bucket(2, replies))
    cover = np.zeros(len(block.joined) + 1, np.int32)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    gone = np.cumsum(cover)[:-1] > 0
    done: dict[int, tuple] = {}
    for k, row in enumerate(block.rows):
        mine = gone[block.edges[k]:block.edges[k + 1]]
        opens = int(mine[:1].sum()) + int((mine[1:] & ~mine[:-1]).sum())
        done[row] = (int(mine.sum()), opens,
                     block.joined[block.edges[k]:block.edges[k + 1]][~mine].tobytes())
    at = block.offsets.tolist()
    for row, doc in enumerate(block.ids):
        size, of = at[row + 1] - at[row], block.of[row]
        if of is None:
            yield doc, size, 0, 0, block.raw[at[row]:at[row + 1]]
        elif block.ids[of] < doc and size >= WINDOW:
            yield doc, size, size, 1, b""
        else:
            yield doc, size, *done[of]


def cut_rows(rows: Iterator[tuple]) -> pa.Table:
    return _table(list(rows), "kept", pa.binary())


def digest_rows(rows: Iterator[tuple]) -> pa.Table:
    return _table([(*r[:4], sha256(r[4]).hexdigest()) for r in rows], "kept_sha256", pa.string())


def _table(rows: list[tuple], last: str, kind: pa.DataType) -> pa.Table:
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", last)
    return pa.table({n: pa.array([r[k] for r in rows], kind if n == last else pa.int64())
                     for k, n in enumerate(names)})


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    finish: Callable = cut_rows, schema: str = CUT, buckets: int | None = None
                    ) -> DataFrame:
    """Each row with the bytes removed, their spans and the bytes that stay.

    ``finish`` turns the rows of a block into an Arrow table of ``schema``.
    """
    if buckets is None:
        buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))

    def numbered(batches):
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 24
        for k, (ids, body, offsets) in enumerate(blocks(batches, BLOCK)):
            yield base + k, ids, body, offsets

    def ask(batches):
        for name, ids, body, offsets in numbered(batches):
            yield from questions(name, *Block(ids.to_pylist(), body, offsets).anchors(),
                                 buckets).to_batches()

    def pack(batches):
        for name, ids, body, offsets in numbered(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                 pa.array([packed(np.diff(offsets))], pa.binary()),
                 pa.array([packed(body)], pa.binary())],
                names=["block", "doc_ids", "sizes", "body"])

    def ask_windows(row: pa.Table, replies: pa.Table) -> pa.Table:
        block = loaded(row)
        return block.around(shared_anchors(block, replies, buckets), buckets).questions(
            row.column("block")[0].as_py())

    def finished(row: pa.Table, replies: pa.Table) -> pa.Table:
        return finish(removed(loaded(row), replies, buckets))

    bodies = read.mapInArrow(pack, PACKED)
    first = read.mapInArrow(ask, ASKED).groupBy("bucket").applyInArrow(answers, ANSWERED)
    second = bodies.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(
        ask_windows, RUNS).groupBy("bucket").applyInArrow(compared, ANSWERED)
    return bodies.groupBy("block").cogroup(first.unionByName(second).groupBy("block")).applyInArrow(
        finished, schema)
