"""Blocks of rows inside a task: bounded pieces of a text column to work on at once."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.words import text_bytes

BLOCK_BYTES = 16 << 20


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES
           ) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, text bytes and offsets of consecutive rows, about ``limit`` bytes at a time.

    Batches hold the id in column 0 and the text in column 1. A row is never split.
    """
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        _, offsets = text_bytes(batch.column(1))
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit - size, side="right")) - 1
            end = min(max(end, at + (not kept)), batch.num_rows)
            if end > at:
                kept.append(batch.slice(at, end - at))
                size += int(offsets[end] - offsets[at])
                at = end
            if at < batch.num_rows or size >= limit:
                yield joined(kept)
                kept, size = [], 0
    if kept:
        yield joined(kept)


def joined(parts: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    ids = pa.concat_arrays([p.column(0) for p in parts])
    views = [text_bytes(p.column(1)) for p in parts]
    shift = np.cumsum([0] + [len(body) for body, _ in views])
    offsets = np.concatenate([o[:-1] + s for (_, o), s in zip(views, shift)] + [shift[-1:]])
    return ids, np.concatenate([body for body, _ in views]), offsets
