"""Bin completion against exhaustive search; packed sequences against the tokenizer itself."""
import random
from collections import Counter, defaultdict
from functools import lru_cache
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import completion, packing
from tidemark.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
TEXTS = ["the cat sat", "", None, "\t \n", "x" * 3000, "ÉCOLE été 日本 ½ <|endoftext|>", "a b c d e f g",
         "It's 12,5 o'clock " * 40]


def fewest(items, capacity):
    """Fewest bins by trying every bin for every item."""
    items = sorted(items, reverse=True)

    @lru_cache(None)
    def fits(k, rooms):
        if k == len(items):
            return True
        return any(fits(k + 1, tuple(sorted(rooms[:i] + (r - items[k],) + rooms[i + 1:])))
                   for i, r in enumerate(rooms) if r >= items[k] and r not in rooms[:i])
    n = -(-sum(items) // capacity)
    while not fits(0, (capacity,) * n):
        n += 1
    return n


def check_runs(counts, runs, capacity):
    left = Counter(counts)
    for filling, times in runs:
        assert times > 0 and sum(n * u for n, u in filling) <= capacity
        assert len({n for n, _ in filling}) == len(filling)
        left.subtract({n: u * times for n, u in filling})
    assert not any(left.values())


@pytest.mark.parametrize("seed", range(60))
def test_fewest_bins(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 50, 100])
    low, high = sorted(rng.sample(range(1, capacity + 1), 2))
    items = [rng.randint(low, high) for _ in range(rng.randint(1, 13))]
    counts = Counter(items)
    runs = completion.pack(counts, capacity)
    check_runs(counts, runs, capacity)
    check_runs(counts, completion.best_fit(counts, capacity), capacity)
    want = fewest(items, capacity)
    assert completion.least_bins(counts, capacity) <= want == completion.bins(runs)


def test_search_beats_best_fit():
    rng, items = random.Random(1), []
    for _ in range(300):
        a, b, c = sorted(rng.sample(range(1, 1000), 3))
        items += [a, b - a, c - b, 1000 - c]
    counts = Counter(items)
    runs = completion.pack(counts, 1000)
    check_runs(counts, runs, 1000)
    assert completion.bins(runs) == 300 < completion.bins(completion.best_fit(counts, 1000))


def test_nothing_to_pack():
    assert completion.pack({}, 10) == [] and completion.least_bins({}, 10) == 0


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def check_packing(rows, docs, library, capacity):
    want = Counter()
    for doc_id, text in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[doc_id, k, at, len(part), crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_odd_rows(spark, library):
    docs = list(enumerate(TEXTS)) + [(0, TEXTS[0]), (0, TEXTS[0]), (None, TEXTS[6]), (9, TEXTS[7])]
    df = spark.createDataFrame([(i, t, 5, 6, "x") for i, t in docs],
                               "doc_id long, text string, length int, task int, place string").repartition(3)
    cut = packing.pieces(df, vocabulary("word_bpe_49k.json"), capacity=16)
    rows = packing.packed(cut, 16).collect()
    used = check_packing(rows, docs, library, 16)
    assert used == completion.bins(completion.pack(Counter(r["length"] for r in rows), 16))
    assert all(crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert not packing.packed(packing.pieces(df.limit(0), vocabulary("word_bpe_49k.json"))).collect()
    with pytest.raises(ValueError):
        packing.packed(cut, 15)


def test_whole_table(spark, library):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op13_packing"](spark, SF).collect()
    used = check_packing(rows, docs, library, 4096)
    assert used <= completion.least_bins(Counter(r["length"] for r in rows), 4096) + 1


def test_known_words_over_blocks(spark, library, monkeypatch):
    rng = random.Random(5)
    letters = "abcXYZéßñİ9.,'-!?日"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(400)]
    docs = [(i, " ".join(rng.choice(made) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    monkeypatch.setattr(packing, "KNOWN", 150)
    monkeypatch.setattr(packing, "BLOCK", 2000)
    import pyarrow as pa

    with open(vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    packing.known_words.cache_clear()
    batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs])],
                                       names=["doc_id", "text"])
    for _ in range(2):
        got = [(i, ids.tolist()) for i, ids in packing.document_ids(spec, iter([batch]), 1)]
        assert got == [(i, library.encode(t, add_special_tokens=False).ids + [1]) for i, t in docs]
    packing.known_words.cache_clear()
