"""Token counts by the whole-token shortcut.

Offline, the vocabulary settles two facts. Two bytes that stand side by side in no piece are
never merged, so a text falls apart between any such two characters into chunks that are
merged on their own; the start of a run of spaces is always such a place. And some pieces
come back as themselves when encoded alone: a chunk that is such a piece is one token.
Chunks of a block are counted by hash; proven ones count 1, and only the other distinct
chunks are merged, once per worker.

Rows: a null or empty text has 0 tokens. Repeated rows are counted each. An empty table
gives an empty result. Other columns of the input are ignored. A text that holds U+2581,
which the model reads as a space, is merged whole.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.blocks import blocks
from tidemark.llm.words import BYTE_VALUE, chunks, row_flags, segment_hashes

META = "▁"
META_BYTES = META.encode()
CACHE_CHUNKS = 1_000_000
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint"


class Proven:
    """A loaded model with what is known of its vocabulary."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = [i for i in range(self.model.vocab_size())
               if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        pieces = [self.model.id_to_piece(i) for i in ids]
        if any(META in p.lstrip(META) for p in pieces):
            raise ValueError("a piece crosses the start of a word: texts can't be cut at spaces")
        if META not in pieces or any("\n" in p for p in pieces):
            raise ValueError("lone spaces need a piece, and line ends must have none")
        raw = [p.replace(META, " ").encode() for p in pieces]
        self.joins = np.zeros((256, 256), dtype=bool)
        for r in raw:
            for a, b in zip(r, r[1:]):
                self.joins[a, b] = True
        self.joins[:, 0x80:0xC0] = True
        self.joins = self.joins.ravel()
        self.whole: set[bytes] = set()
        self.merged: dict[bytes, int] = {}
        self.whole = {r for r, n in zip(raw, self.lengths(raw)) if n == 1}
        self.merged.clear()

    def lengths(self, keys: list[bytes]) -> np.ndarray:
        """Tokens of each chunk alone.

        A leading space is left to the model, which puts one before every text. Other chunks
        follow a line end, which is in no piece: that start costs two tokens.
        """
        if len(self.merged) > CACHE_CHUNKS:
            self.merged.clear()
        known, whole = self.merged, self.whole
        rest = list({k for k in keys if k not in whole and k not in known})
        for i in range(0, len(rest), 4096):
            part = rest[i:i + 4096]
            texts = [k[1:].decode() if k[:1] == b" " else "\n" + k.decode() for k in part]
            for k, ids in zip(part, self.model.encode(texts, num_threads=1)):
                known[k] = 1 if k == b" " else len(ids) - 2 * (k[:1] != b" ")
        return np.fromiter((1 if k in whole else known[k] for k in keys), np.int64, len(keys))


@lru_cache(maxsize=2)
def proven(model: bytes) -> Proven:
    return Proven(model)


def block_counts(known: Proven, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of every row of a block."""
    hashes, keys_at = [], []
    for i, j in chunks(offsets):
        lo = offsets[i]
        part, rows = body[lo:offsets[j]], offsets[i:j + 1] - lo
        if len(part) == 0:
            continue
        first = row_flags(rows, len(part))
        opens = first.copy()
        opens[1:] |= ~known.joins[part[:-1].astype(np.uint16) << 8 | part[1:]]
        starts = np.flatnonzero(opens)
        h = segment_hashes(part, starts, BYTE_VALUE)
        h[first[starts]] ^= np.uint64(0x5851F42D4C957F2D)
        hashes.append(h)
        keys_at.append(starts + lo)
    if not hashes:
        return np.zeros(len(offsets) - 1, np.int64)
    starts = np.concatenate(keys_at)
    codes, distinct = pd.factorize(np.concatenate(hashes))
    shown = np.empty(len(distinct), np.int64)
    shown[codes[::-1]] = np.arange(len(codes))[::-1]
    ends = np.append(starts[1:], len(body))
    is_first = np.isin(starts, offsets[:-1])
    raw = body.tobytes()
    keys = [b" " + raw[starts[k]:ends[k]] if is_first[k] else raw[starts[k]:ends[k]]
            for k in shown.tolist()]
    cut = [k for k in range(len(keys)) if META_BYTES in keys[k]]
    safe = [b" " if META_BYTES in k else k for k in keys] if cut else keys
    running = np.concatenate([[0], np.cumsum(known.lengths(safe)[codes])])
    bounds = np.searchsorted(starts, offsets)
    counts = running[bounds[1:]] - running[bounds[:-1]]
    if cut:
        odd = np.flatnonzero(np.isin(codes, cut))
        for row in np.unique(np.searchsorted(offsets, starts[odd], side="right") - 1):
            text = raw[offsets[row]:offsets[row + 1]].decode()
            counts[row] = len(known.model.encode(text))
    return counts


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row, without begin or end tokens.

    The model file is read on the driver and travels with the tasks. There is no shuffle.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = proven(model)
        for ids, body, offsets in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(offsets)), pa.array(block_counts(known, body, offsets))],
                names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(
        count, SCHEMA)
