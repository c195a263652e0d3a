"""Exact deduplication over a bucketed cuckoo-filter index of live digests.

A live digest is one whose row stays. Digests are dealt to buckets by prefix; a bucket keeps
its keys (digest, row that stays, rows seen) and a cuckoo filter over them with four 16-bit
fingerprints a slot row. A hit of the filter is verified against the bucket's keys; a newer
row of equal text deletes the live entry and is inserted for it. When an insertion runs out
of moves the filter doubles and is filled again from the stored keys. The index is a table:
:func:`index_table` builds or extends it, :func:`remove` takes digests out.

Texts are equal when their SHA-256 after lower-casing A-Z agree.

Rows: a null text is an empty one. A null id sorts before all ids. Of rows with the same id
and text exactly one stays. An empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import LOWER_TABLE, text_bytes
from tidemark.session import written

KEYS_PER_BUCKET = 20_000
SLOT = 4
MOVES = 200
ROWS = "doc_id bigint, digest binary, row bigint, mark bigint"
ENTRIES = "bucket bigint, digest binary, newest bigint, newest_row bigint, n bigint"
INDEX = "bucket bigint, slots int, filter binary, digest binary, newest bigint, newest_row bigint, n bigint"


class CuckooFilter:
    """Fingerprints of keys held elsewhere; supports insertion, deletion and growth."""

    def __init__(self, expected: int = 16):
        self.rows = 1 << max(2, int(np.ceil(np.log2(max(expected, 1) / (SLOT * 0.9) + 1))))
        self.slots: list[list[int]] = [[] for _ in range(self.rows)]
        self._turn = 0

    @staticmethod
    def print_of(digest: bytes) -> int:
        return (digest[16] << 8 | digest[17]) or 1

    def places(self, digest: bytes) -> tuple[int, int, int]:
        mark = self.print_of(digest)
        first = int.from_bytes(digest[8:16], "little") & (self.rows - 1)
        return mark, first, self.other(first, mark)

    def other(self, row: int, mark: int) -> int:
        return row ^ (mark * 0x5BD1E995 >> 7 & (self.rows - 1))

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self.places(digest)
        return mark in self.slots[a] or mark in self.slots[b]

    def insert(self, digest: bytes) -> bool:
        """False when no place was found; the filter must then be rebuilt larger."""
        mark, a, b = self.places(digest)
        for row in (a, b):
            if len(self.slots[row]) < SLOT:
                self.slots[row].append(mark)
                return True
        row = b
        for _ in range(MOVES):
            self._turn = (self._turn + 1) % SLOT
            mark, self.slots[row][self._turn] = self.slots[row][self._turn], mark
            row = self.other(row, mark)
            if len(self.slots[row]) < SLOT:
                self.slots[row].append(mark)
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        """Takes out one fingerprint of a digest that was inserted before."""
        mark, a, b = self.places(digest)
        for row in (a, b):
            if mark in self.slots[row]:
                self.slots[row].remove(mark)
                return True
        return False

    def packed(self) -> bytes:
        out = np.zeros((self.rows, SLOT), dtype="<u2")
        for i, marks in enumerate(self.slots):
            out[i, :len(marks)] = marks
        return out.tobytes()

    @classmethod
    def unpacked(cls, rows: int, blob: bytes) -> CuckooFilter:
        self = cls()
        self.rows = rows
        self.slots = [[m for m in marks if m] for marks in
                      np.frombuffer(blob, dtype="<u2").reshape(rows, SLOT).tolist()]
        return self


class Bucket:
    """Live digests of one bucket: the filter, and the keys it was filled from."""

    def __init__(self, expected: int = 16):
        self.filter = CuckooFilter(expected)
        self.keys: dict[bytes, tuple] = {}

    def insert(self, digest: bytes, entry: tuple) -> None:
        self.keys[digest] = entry
        if not self.filter.insert(digest):
            self.grow()

    def grow(self) -> None:
        size = self.filter.rows * SLOT * 2
        while True:
            self.filter = CuckooFilter(size)
            if all(self.filter.insert(d) for d in self.keys):
                return
            size *= 2

    def find(self, digest: bytes) -> tuple | None:
        return self.keys.get(digest) if digest in self.filter else None

    def delete(self, digest: bytes) -> bool:
        if self.find(digest) is None:
            return False
        del self.keys[digest]
        return self.filter.delete(digest)

    def arrive(self, digest: bytes, newest: int | None, row: int, n: int) -> None:
        """A row, or ``n`` rows of which it is the newest: the newer of two equal texts lives."""
        live = self.find(digest)
        if live is None:
            self.insert(digest, (newest, row, n))
            return
        total = live[2] + n
        if rank(newest, row) > rank(*live[:2]):
            self.delete(digest)
            self.insert(digest, (newest, row, total))
        else:
            self.keys[digest] = (*live[:2], total)

    def table(self, bucket: int) -> pa.Table:
        """One row for each key; the first also carries the filter."""
        keys = list(self.keys)
        n, blob = len(keys), self.filter.packed()
        at = [self.keys[k] for k in keys]
        return pa.table({
            "bucket": pa.array([bucket] * n, pa.int64()),
            "slots": pa.array([self.filter.rows] * n, pa.int32()),
            "filter": pa.array([blob if i == 0 else None for i in range(n)], pa.binary()),
            "digest": pa.array(keys, pa.binary()),
            "newest": pa.array([a[0] for a in at], pa.int64()),
            "newest_row": pa.array([a[1] for a in at], pa.int64()),
            "n": pa.array([a[2] for a in at], pa.int64())})

    @classmethod
    def loaded(cls, rows: list[dict]) -> Bucket:
        self = cls()
        self.keys = {r["digest"]: (r["newest"], r["newest_row"], r["n"]) for r in rows}
        held = next((r for r in rows if r["filter"] is not None), None)
        if held:
            self.filter = CuckooFilter.unpacked(held["slots"], held["filter"])
        else:
            self.grow()
        return self


def rank(newest: int | None, row: int) -> tuple:
    return (newest is not None, newest or 0, row)


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the digest of the normalised text, a row number and a hash of the text."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text_bytes(batch.column(1))
            raw, at = body.tobytes(), offsets.tolist()
            found = [sha256(raw[i:j].translate(LOWER_TABLE)).digest() for i, j in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary()), *batch.columns[2:]],
                names=["doc_id", "digest", "row", "mark"])

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"),
                       F.monotonically_increasing_id(), F.xxhash64(F.col(text_col).cast("string"))
                       ).mapInArrow(digest, ROWS)


def entries(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of equal digest combined within each task, with their bucket."""
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for batch in batches:
            for i, d, r in zip(*(c.to_pylist() for c in batch.columns)):
                old = seen.get(d)
                seen[d] = (i, r, 1) if old is None else (
                    *max(((i, r), old[:2]), key=lambda x: rank(*x)), old[2] + 1)
        keys = list(seen)
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int.from_bytes(k[:7], "big") % buckets for k in keys], pa.int64()),
                 pa.array(keys, pa.binary())]
                + [pa.array([seen[k][c] for k in keys], pa.int64()) for c in range(3)],
                names=["bucket", "digest", "newest", "newest_row", "n"])

    return rows.select("doc_id", "digest", "row").mapInArrow(combine, ENTRIES)


def index_table(new: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The index with the entries added; an earlier index must have the same bucket count."""
    def build(arrived: pa.Table) -> pa.Table:
        order = arrived.sort_by([("newest", "ascending"), ("newest_row", "ascending")])
        bucket = Bucket(arrived.num_rows)
        for row in order.to_pylist():
            bucket.arrive(row["digest"], row["newest"], row["newest_row"], row["n"])
        return bucket.table(arrived.column("bucket")[0].as_py())

    def extend(arrived: pa.Table, held: pa.Table) -> pa.Table:
        bucket = Bucket.loaded(held.to_pylist())
        for row in arrived.to_pylist():
            bucket.arrive(row["digest"], row["newest"], row["newest_row"], row["n"])
        name = (arrived if arrived.num_rows else held).column("bucket")[0].as_py()
        return bucket.table(name)

    if index is None:
        return new.groupBy("bucket").applyInArrow(build, INDEX)
    return new.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(extend, INDEX)


def remove(index: DataFrame, gone: DataFrame) -> DataFrame:
    """The index without the digests of ``gone`` (``bucket``, ``digest``)."""
    def take(held: pa.Table, out: pa.Table) -> pa.Table:
        bucket = Bucket.loaded(held.to_pylist())
        for digest in out.column("digest").to_pylist():
            bucket.delete(digest)
        name = (held if held.num_rows else out).column("bucket")[0].as_py()
        return bucket.table(name)

    return index.groupBy("bucket").cogroup(gone.groupBy("bucket")).applyInArrow(take, INDEX)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keys_per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """Every row with the id that stays for its text, the size of its group and its fate.

    ``mark`` is a hash of the text as it stands.
    """
    rows = written(digest_rows(docs, id_col, text_col), "digests")
    buckets = max(16, -(-rows.count() // keys_per_bucket))
    index = index_table(entries(rows, buckets)).select("digest", "newest", "newest_row", "n")
    return rows.join(index, "digest").select(
        "doc_id", F.col("newest").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("newest_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "mark")


DEDUP_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, text_sha256 FROM d WINDOW w AS (PARTITION BY text_sha256)"""
