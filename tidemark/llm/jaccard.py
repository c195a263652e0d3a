"""N-gram Jaccard join with prefix filters under several global token orders.

A document is the set of its distinct word n-grams, as 64-bit hashes. Two sets whose Jaccard
similarity reaches the threshold share a token among the first few of each, whatever global
order the tokens stand in. So prefixes are taken under several orders, candidates are the
pairs that share a prefix token under every one of them, and these are verified on the whole
sets. A place is kept with its rank in the order: tokens before the first common one belong
to one of the two sets alone, and too many of them rule the pair out. In all orders the tokens that are frequent come last; the rest is shuffled differently
in each. Which tokens count as frequent only changes the work, never the result.

Documents with equal sets form a class, which is joined once. Classes that meet under a
token are first tried against one hub, the smallest of them of like size. What a set has
less or more than its hub is kept: the overlap of two sets of one hub follows from these
differences alone, so the sets around a hub are compared in blocks of bounded size. Pairs
that have no hub in common go through the filters. So every linked pair of classes is found
and stands once in the links, while a block gives one list of partners a set: no group of
near copies around a hub takes a row a pair.

The passes over the texts keep their tokens packed per block and bucket: a bucket only
returns the tokens that meet in several documents.

Rows: a null or empty text has no n-grams and is linked with nothing. A text with fewer
words than n is one n-gram of all its words. Repeated rows are one class. A row without id
is a component of its own, without id, and takes no part in links. An id names one text:
rows of different texts need different ids, or keys in their place. An empty table gives an
empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.blocks import blocks
from tidemark.llm.components import components
from tidemark.llm.words import (
    LOWER, WORD_VALUE, chunks, mix, segment_hashes, text_bytes, words)
from tidemark.session import collect_garbage, discard, written

ORDERS = 3
#: Counters, by hash, of the sets that hold a token; a token is frequent if its counter stands
#: out from what chance puts there. The table is of this size for any input.
BLOCK = 4 << 20
COUNTERS = 1 << 23
SLICES = 16
#: Ranks within a prefix are kept in so many steps.
STEPS = 16
#: Sets around one hub that are compared at once. A set is among them from half the similarity
#: asked for; less similar ones differ from the hub in too much to be worth describing so.
AROUND = 2048
TRIED = "a bigint, b bigint, linked boolean, n_a int, n_b int, less int, differs array<bigint>"
LINKS = "class bigint, n_links bigint, partners array<bigint>, joins array<bigint>"
SETS = ("doc_id bigint, mark bigint, n_shingles bigint, set_a bigint, set_b bigint, "
        "slice int, counts binary")
PREFIXES = ("ord int, bucket int, tokens binary, places binary, steps binary, doc_ids binary, "
            "sizes binary, token bigint, doc_id bigint")
MET = "ord int, token bigint, doc_id bigint"
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
               dtype=np.uint64)


def shingle_sets(body: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-grams of each row."""
    out: list[np.ndarray] = []
    for i, j in chunks(offsets):
        lo = offsets[i]
        part = LOWER[body[lo:offsets[j]]]
        starts, _, bounds = words(part, offsets[i:j + 1] - lo)
        h = segment_hashes(part, starts, WORD_VALUE)
        m = len(h) - n + 1
        grams = np.zeros(max(m, 0), np.uint64)
        for k in range(n):
            grams += h[k:k + len(grams)] * ODD[k]
        grams = mix(grams)
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if e - s >= n:
                out.append(np.unique(grams[s:e - n + 1]))
            elif e > s:
                with np.errstate(over="ignore"):
                    one = (h[s:e] * ODD[:e - s]).sum(dtype=np.uint64) + ODD[7] * np.uint64(e - s)
                out.append(mix(np.array([one], dtype=np.uint64)))
            else:
                out.append(grams[:0])
    return out


def set_digest(tokens: np.ndarray) -> tuple[int, int]:
    d = blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def read_sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Size and digest of each row's set; and counts of the tokens of the distinct sets."""
    squeeze = zstandard.ZstdCompressor(level=1)
    marks: list[pa.Array] = []

    def kept():
        for b in batches:
            marks.append(b.column(2))
            yield b

    at, counts = 0, None
    for ids, body, offsets in blocks(kept(), BLOCK):
        sets = shingle_sets(body, offsets, n)
        digests = [set_digest(s) for s in sets]
        rows = len(ids)
        mark = pa.concat_arrays(marks)
        yield pa.RecordBatch.from_arrays(
            [ids, mark.slice(at, rows), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([d[0] for d in digests], pa.int64()),
             pa.array([d[1] for d in digests], pa.int64()), pa.nulls(rows, pa.int32()),
             pa.nulls(rows, pa.binary())],
            names=["doc_id", "mark", "n_shingles", "set_a", "set_b", "slice", "counts"])
        marks, at = [mark.slice(at + rows)], 0
        single = {d: s for d, s in zip(digests, sets)}.values()
        tokens = np.concatenate([np.zeros(0, np.uint64), *single])
        counts = np.zeros(COUNTERS, np.uint32) if counts is None else counts
        place, times = np.unique(counter(tokens), return_counts=True)
        counts[place] += times.astype(np.uint32)
    if counts is not None:
        none = pa.nulls(SLICES, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, none, pa.array(range(SLICES), pa.int32()),
             pa.array([squeeze.compress(c.astype("<u4").tobytes()) for c in np.split(counts, SLICES)])],
            names=["doc_id", "mark", "n_shingles", "set_a", "set_b", "slice", "counts"])


def counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(COUNTERS - 1)).astype(np.int64)


def add_counts(group: pa.Table) -> pa.Table:
    unzip = zstandard.ZstdDecompressor()
    total = np.zeros(COUNTERS // SLICES, np.int64)
    for blob in group.column("counts").to_pylist():
        total += np.frombuffer(unzip.decompress(blob), "<u4")
    return pa.table({"slice": group.column("slice").slice(0, 1), "counts": pa.array(
        [zstandard.ZstdCompressor().compress(np.minimum(total, 2**32 - 1).astype("<u4").tobytes())],
        pa.binary())})


def token_levels(counted: DataFrame) -> np.ndarray:
    """Level of every counter: 0, or its count if it stands out. Counts are first added per part."""
    out = "slice int, counts binary"
    rows = counted.withColumn("part", F.spark_partition_id() % 64)
    rows = rows.groupBy("slice", "part").applyInArrow(add_counts, out).groupBy(
        "slice").applyInArrow(add_counts, out).collect()
    levels = np.zeros(COUNTERS, np.uint32)
    size = COUNTERS // SLICES
    for r in rows:
        levels[r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(
            zstandard.ZstdDecompressor().decompress(r["counts"]), "<u4")
    usual = float(np.median(levels))
    levels[levels <= usual + 6 * np.sqrt(usual) + 8] = 0
    return levels


def prefix_length(n: int, percent: int) -> int:
    """Tokens to look at, so that no pair of the similarity can miss each other."""
    return n - -(-percent * n // 100) + 1


def prefixes(batches: Iterator[pa.RecordBatch], n: int, percent: int, buckets: int,
             levels: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Prefix tokens of a block's distinct sets under each order, packed by bucket.

    Frequent tokens are given as plain rows: the documents that share one may be many.
    """
    squeeze = zstandard.ZstdCompressor(level=1)
    turns = mix(ODD[:ORDERS])
    for ids, body, offsets in blocks(batches, BLOCK):
        sets = shingle_sets(body, offsets, n)
        ids = ids.to_pylist()
        single: dict[tuple[int, int], int] = {}
        for row, s in enumerate(sets):
            if len(s) and ids[row] is not None:
                d = set_digest(s)
                if d not in single or ids[row] < ids[single[d]]:
                    single[d] = row
        mine = list(single.values())
        doc_ids = np.array([ids[r] for r in mine], dtype=np.int64)
        every = np.concatenate([np.zeros(0, np.uint64), *(sets[r] for r in mine)])
        edges = np.concatenate([[0], np.cumsum([len(sets[r]) for r in mine])]).astype(np.int64)
        sizes = np.diff(edges).astype("<u4")
        level = levels[counter(every)]
        crowded = np.add.reduceat(level > 0, edges[:-1]) > 0 if len(mine) else []
        for o in range(ORDERS):
            turned = mix(every ^ turns[o])
            picks = []
            for k, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                p = prefix_length(hi - lo, percent)
                if crowded[k]:
                    picks.append(lo + np.lexsort((turned[lo:hi], level[lo:hi]))[:p])
                else:
                    first = np.argpartition(turned[lo:hi], p - 1)[:p]
                    picks.append(lo + first[np.argsort(turned[lo:hi][first])])
            pick = np.concatenate([np.zeros(0, np.int64), *picks]).astype(np.int64)
            owner = np.repeat(np.arange(len(mine)), [len(x) for x in picks]).astype(np.uint32)
            step = np.concatenate([np.zeros(0, np.uint8), *(
                (np.arange(len(x)) * STEPS // len(x)).astype(np.uint8) for x in picks)])
            plain = level[pick] > 0
            yield prefix_rows(o, tokens=every[pick[plain]], docs=doc_ids[owner[plain]])
            token, owner, step = every[pick[~plain]], owner[~plain], step[~plain]
            bucket = (token >> np.uint64(24)) % np.uint64(buckets)
            order = np.lexsort((token, bucket))
            token, owner, step, bucket = token[order], owner[order], step[order], bucket[order]
            cut = np.flatnonzero(np.diff(bucket)) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(bucket)]):
                if hi > lo:
                    used, local = np.unique(owner[lo:hi], return_inverse=True)
                    yield prefix_rows(o, int(bucket[lo]), squeeze.compress(
                        np.diff(token[lo:hi], prepend=np.uint64(0)).tobytes()), squeeze.compress(
                        local.astype("<u4").tobytes()), squeeze.compress(step[lo:hi].tobytes()),
                        squeeze.compress(doc_ids[used].tobytes()),
                        squeeze.compress(sizes[used].tobytes()))


def prefix_rows(order: int, bucket: int | None = None, tokens=b"", places: bytes = b"",
                steps: bytes = b"", doc_ids: bytes = b"", sizes: bytes = b"",
                docs: np.ndarray | None = None) -> pa.RecordBatch:
    n = 1 if docs is None else len(docs)
    blob = [None] * n if docs is not None else None
    return pa.RecordBatch.from_arrays(
        [pa.array([order] * n, pa.int32()), pa.array([bucket] * n, pa.int32()),
         pa.array(blob or [tokens] * n, pa.binary()), pa.array(blob or [places] * n, pa.binary()),
         pa.array(blob or [steps] * n, pa.binary()), pa.array(blob or [doc_ids] * n, pa.binary()),
         pa.array(blob or [sizes] * n, pa.binary()),
         pa.nulls(1, pa.int64()) if docs is None else pa.array(tokens.view(np.int64)),
         pa.nulls(1, pa.int64()) if docs is None else pa.array(docs)],
        names=["ord", "bucket", "tokens", "places", "steps", "doc_ids", "sizes", "token", "doc_id"])


def meetings(percent: int, group: pa.Table) -> pa.Table:
    """Tokens of a bucket that stand in the prefixes of two rows of like size or more.

    If a token is the first common one of two linked sets of n and m tokens, at most
    (n + m) * (1 - t) / (1 + t) tokens stand before it in both together, with t the
    similarity asked for. So a row stays where its own excess over its share of that, plus
    the least excess of another row, is not above zero.
    """
    tokens, docs, sizes, steps = [], [], [], []
    unzip = zstandard.ZstdDecompressor()
    for t, p, s, d, n in zip(*(group.column(c).to_pylist()
                               for c in ("tokens", "places", "steps", "doc_ids", "sizes"))):
        place = np.frombuffer(unzip.decompress(p), "<u4")
        tokens.append(np.cumsum(np.frombuffer(unzip.decompress(t), np.uint64), dtype=np.uint64))
        docs.append(np.frombuffer(unzip.decompress(d), np.int64)[place])
        sizes.append(np.frombuffer(unzip.decompress(n), "<u4")[place].astype(np.int64))
        steps.append(np.frombuffer(unzip.decompress(s), np.uint8))
    token, doc, size, step = (np.concatenate(x) for x in (tokens, docs, sizes, steps))
    order = np.lexsort((size, token))
    token, doc, size = token[order], doc[order], size[order]
    least_rank = step[order].astype(np.int64) * prefix_length(size, percent) // STEPS
    excess = (100 + percent) * least_rank - (100 - percent) * size
    near = (token[1:] == token[:-1]) & (size[:-1] * 100 >= size[1:] * percent)
    shared = np.zeros(len(token), bool)
    shared[1:] |= near
    shared[:-1] |= near
    shared &= excess + least_of_others(token, excess) <= 0
    n = int(shared.sum())
    return pa.table({"ord": pa.array(np.full(n, group.column("ord")[0].as_py(), np.int32)),
                     "token": pa.array(token[shared].view(np.int64)), "doc_id": doc[shared]})


def least_of_others(token: np.ndarray, excess: np.ndarray) -> np.ndarray:
    """For each row the least excess among the other rows of its token, which is sorted."""
    none = np.int64(2**62)
    start = np.ones(len(token), bool)
    start[1:] = token[1:] != token[:-1]
    run = np.cumsum(start) - 1
    order = np.lexsort((excess, run))
    first = order[start]
    least = excess[first]
    second = np.full(len(least), none)
    several = np.flatnonzero(start)[np.diff(np.append(np.flatnonzero(start), len(token))) > 1]
    second[run[several]] = excess[order[several + 1]]
    out = least[run]
    out[first] = second
    return out


def compared(pairs: DataFrame, docs: DataFrame, n: int, percent: int, label: str) -> DataFrame:
    """The pairs ``a``, ``b`` at least half as similar as asked, and in what their sets differ, stored."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for c in (2, 3):
                body, offsets = text_bytes(batch.column(c))
                sets.append(shingle_sets(body, offsets, n))
            rows = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in (0, 1)), *sets):
                differs = np.setxor1d(x, y, assume_unique=True)
                both = (len(x) + len(y) - len(differs)) // 2
                alike = 100 * both >= percent * (both + len(differs)) and both > 0
                if alike or 200 * both >= percent * (both + len(differs)):
                    rows.append((a, b, alike, len(x), len(y), len(x) - both, differs.view(np.int64)))
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(),
                     pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                names=["a", "b", "linked", "n_a", "n_b", "less", "differs"])

    pairs = written(pairs, "pairs")
    asked = written(pairs.select(F.col("a").alias("doc_id")).unionByName(
        pairs.select(F.col("b").alias("doc_id"))).distinct(), "asked")
    texts = docs.where("text IS NOT NULL").join(asked, "doc_id", "left_semi")
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    out = written(pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b").mapInArrow(
        check, TRIED), label)
    discard(pairs, asked)
    return out


def around_hub(percent: int, listed: bool, mine: pa.Table, others: pa.Table) -> pa.Table:
    """All links between sets of one hub: each of ``mine`` against each of ``others``.

    With d the differences to the hub h, two sets x and y share |h| - less(x) - less(y) plus
    the number of common differences. A link stands once among the partners, in a block that
    meets itself under the smaller set, and counts at both its ends. Of the partners, those
    that join parts not joined before are given again in ``joins``. Partners are given if ``listed``.
    """
    rows: list[tuple[int, int, list[int], list[int]]] = []
    if mine.num_rows and others.num_rows:
        alone = mine.column("part")[0].as_py() == mine.column("other")[0].as_py()
        hub = int(others.column("n_a")[0].as_py())
        ids, n, less, members = (others.column(c).to_numpy().astype(np.int64)
                                 for c in ("b", "n_b", "less", "members"))
        lists = others.column("differs").combine_chunks()
        owner = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
        token = lists.flatten().to_numpy()
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        nodes = np.unique(np.concatenate([ids, mine.column("b").to_numpy()]))
        place = np.searchsorted(nodes, ids)
        label = np.arange(len(nodes))
        for side in (mine, others):
            at_hub = np.searchsorted(nodes, side.column("b").to_numpy()[
                np.asarray(side.column("linked").to_pylist(), dtype=bool)])
            label[at_hub] = -1
        counts = np.zeros(len(ids), np.int64)
        theirs = mine.select(["b", "n_b", "less", "differs", "members"])
        for b, n_b, l_b, d, m_b in zip(*(theirs.column(c).to_pylist()
                                         for c in theirs.column_names)):
            lo, hi = np.searchsorted(token, d), np.searchsorted(token, d, side="right")
            hits = [owner[i:j] for i, j in zip(lo.tolist(), hi.tolist()) if j > i]
            common = np.bincount(np.concatenate(hits), minlength=len(ids)) if hits else 0
            both = hub - l_b - less + common
            good = (100 * both >= percent * (n_b + n - both)) & (ids != b) & (both > 0)
            if not good.any():
                continue
            links = int(members[good].sum())
            counts[good] += m_b
            if alone:
                good &= ids > b
            own = label[np.searchsorted(nodes, b)]
            parts, first = np.unique(label[place[good]], return_index=True)
            new = parts != own
            joins = ids[good][first[new]]
            if len(joins):
                label[np.isin(label, parts)] = own
            rows.append((b, links, ids[good].tolist() if listed else [], joins.tolist()))
        if not alone:
            met = np.flatnonzero(counts)
            rows += [(b, c, [], []) for b, c in zip(ids[met].tolist(), counts[met].tolist())]
    kinds = {"class": pa.int64(), "n_links": pa.int64(), "partners": pa.list_(pa.int64()),
             "joins": pa.list_(pa.int64())}
    return pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(kinds.items())})


def hub_links(tried: DataFrame, percent: int, listed: bool) -> DataFrame:
    """Links among the sets around each hub, in blocks of about ``AROUND`` sets."""
    sizes = tried.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / AROUND).cast("int").alias("parts"))
    rows = tried.join(sizes, "a").withColumn(
        "part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    mine = rows.withColumn("other", F.explode(F.sequence(F.col("part"), F.col("parts") - 1)))
    others = rows.select(*(F.col(c).alias("other" if c == "part" else c) for c in rows.columns)
                         ).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("other"))))
    keys = ["a", "part", "other"]
    return mine.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInArrow(
        lambda x, y: around_hub(percent, listed, x, y), LINKS)


def pair_links(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` in the form of ``LINKS``."""
    sized = pairs.join(members.toDF("a", "m_a"), "a").join(members.toDF("b", "m_b"), "b")
    ids = "array<bigint>"
    return sized.select(
        F.col("a").alias("class"), F.col("m_b").alias("n_links"), F.array("b").alias("partners"),
        F.array("b").alias("joins")).unionByName(sized.groupBy(F.col("b").alias("class")).agg(
            F.sum("m_a").alias("n_links")).select(
            "*", F.array().cast(ids).alias("partners"), F.array().cast(ids).alias("joins")))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), ``n_shingles``, ``component_id`` and ``n_links``.

    ``n_links`` counts the other documents linked with a row's document, those of equal sets
    included. ``percent`` is the least Jaccard similarity of linked documents, in percent.
    """
    return joined(docs, n, percent, id_col, text_col, buckets, listed=False)[0]


def class_pairs(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """All linked pairs ``a`` < ``b`` of classes; a class goes by its smallest id."""
    links = joined(docs, n, percent, id_col, text_col, buckets, listed=True)[1]
    pairs = links.select("class", F.explode("partners").alias("to"))
    return pairs.select(F.least("class", "to").alias("a"), F.greatest("class", "to").alias("b"))


def joined(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str,
           buckets: int | None, listed: bool) -> tuple[DataFrame, DataFrame]:
    """The rows of ``near_duplicates``, and the links of all classes in the form of ``LINKS``.

    A table is deleted as soon as what was made from it is written.
    """
    spark = docs.sparkSession
    if buckets is None:
        buckets = max(4, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    found = written(docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(
        lambda b: read_sets(b, n), SETS), "sets")
    sets = found.where("n_shingles IS NOT NULL").drop("slice", "counts")
    levels = zstandard.ZstdCompressor().compress(token_levels(
        found.where("slice IS NOT NULL").select("slice", "counts")).tobytes())
    packed = written(docs.mapInArrow(lambda b: prefixes(b, n, percent, buckets, np.frombuffer(
        zstandard.ZstdDecompressor().decompress(levels), np.uint32)), PREFIXES), "prefixes")
    classes = sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(
        "set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("class"),
                                            F.countDistinct("doc_id").alias("members"))
    classes = written(classes, "classes")
    members = classes.select("class", "members")
    member = sets.where("doc_id IS NOT NULL").join(
        classes, ["set_a", "set_b", "n_shingles"]).select("doc_id", "class", "n_shingles").distinct()
    every = []
    for o in range(ORDERS):      # the groups of one order are gone from the disks before the next are dealt
        mine = packed.where(F.col("ord") == o)
        met = mine.where("bucket IS NOT NULL").groupBy("ord", "bucket").applyInArrow(
            lambda group: meetings(percent, group), MET)
        met = met.unionByName(mine.where("bucket IS NULL").select("ord", "token", "doc_id"))
        every.append(written(met.join(member, "doc_id").select(
            "ord", "token", F.col("class").alias("doc_id"), F.col("n_shingles").alias("n")).distinct(), "met-one"))
        del mine, met
        collect_garbage(spark)
    met = reduce(DataFrame.unionByName, every)
    discard(packed)
    whole = met.groupBy("doc_id").agg(F.countDistinct("ord").alias("orders")).where(
        F.col("orders") == ORDERS).select("doc_id")
    met = written(met.join(whole, "doc_id", "left_semi"), "met")
    discard(*every)

    step = float(np.log(100 / percent))
    like = met.withColumn("band", F.floor(F.log("n") / F.lit(step)).cast("int"))
    least = F.min(F.struct(F.col("doc_id").alias("hub"), F.col("n").alias("hub_n"))).alias("h")
    fits = (F.col("h.hub") < F.col("doc_id")) & (F.col("n") * 100 >= F.col("h.hub_n") * percent) & (
        F.col("h.hub_n") * 100 >= F.col("n") * percent)
    hubs = like.groupBy("ord", "token", "band").agg(least).groupBy("ord", "token").agg(
        F.collect_list(F.struct("band", "h")).alias("hubs"))
    mine = F.filter("hubs", lambda x: x["band"] == F.col("band"))
    choice = like.join(hubs, ["ord", "token"]).select("ord", "doc_id", "n", F.explode(F.array_distinct(
        F.array(F.array_min(F.transform("hubs", lambda x: x["h"])),
                F.element_at(mine, 1)["h"]))).alias("h")).where(fits).select(
        "ord", "doc_id", "h.hub")
    tried = choice.groupBy("doc_id", "hub").agg(F.countDistinct("ord").alias("orders")).where(
        F.col("orders") == ORDERS).groupBy(F.col("doc_id").alias("b")).agg(F.min("hub").alias("a"))
    tried = compared(tried, docs, n, percent, "tried")
    star = tried.select(F.col("b").alias("doc_id"), F.col("a").alias("hub"))
    around = hub_links(tried.join(members.withColumnRenamed("class", "b"), "b"), percent, listed)

    apart = met.join(star, "doc_id", "left").select(
        "ord", "token", "doc_id", "n", F.coalesce("hub", "doc_id").alias("hub"))
    several = apart.groupBy("ord", "token").agg(F.min("hub").alias("u"), F.max("hub").alias("v")
                                                ).where("u < v").select("ord", "token")
    apart = apart.join(several, ["ord", "token"])
    a, b = apart.alias("a"), apart.alias("b")
    near = (F.col("a.n") * 100 >= F.col("b.n") * percent) & (
        F.col("b.n") * 100 >= F.col("a.n") * percent)
    new = (F.col("a.hub") != F.col("b.hub")) & (F.col("a.doc_id") != F.col("b.hub")) & (
        F.col("b.doc_id") != F.col("a.hub"))
    pairs = a.join(b, (F.col("a.ord") == F.col("b.ord")) & (F.col("a.token") == F.col("b.token"))
                   & (F.col("a.doc_id") < F.col("b.doc_id")) & new & near)
    pairs = pairs.groupBy(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b")).agg(
        F.countDistinct("a.ord").alias("orders")).where(F.col("orders") == ORDERS).select("a", "b")
    rest = compared(pairs, docs, n, percent, "rest")
    found_links = tried.where("linked").select("a", "b").unionByName(rest.where("linked").select("a", "b"))
    links = written(pair_links(found_links, members).unionByName(around), "links")
    discard(met, tried, rest)
    labels = components(links.select(F.col("class").alias("a"), F.explode("joins").alias("b")))
    counts = links.groupBy("class").agg(F.sum("n_links").alias("n_links"))

    same = sets.join(classes, ["set_a", "set_b", "n_shingles"], "left").join(
        labels.withColumnRenamed("node", "class"), "class", "left").join(counts, "class", "left")
    n_links = F.coalesce("n_links", F.lit(0)) + F.col("members") - 1
    named = F.col("doc_id").isNotNull()
    return same.select(
        "doc_id", "mark", "n_shingles",
        F.when(named, F.coalesce("label", "class", "doc_id")).alias("component_id"),
        F.when(named, F.coalesce(n_links, F.lit(0))).otherwise(0).alias("n_links")), links


JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) END AS s FROM d),
t AS (SELECT doc_id, unnest(s) AS x FROM g),
c AS (SELECT x FROM t GROUP BY x HAVING count(*) BETWEEN 2 AND 100000000),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM t a JOIN c USING (x) JOIN t b USING (x)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN g u ON u.doc_id = a JOIN g v ON v.doc_id = b
  WHERE 100 * n >= 90 * (len(u.s) + len(v.s) - n)),
e AS (SELECT a AS u, b AS v FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reach) AS (SELECT u, u FROM e UNION SELECT r.doc_id, e.v FROM r JOIN e ON e.u = r.reach),
m AS (SELECT doc_id, min(reach) AS low FROM r GROUP BY doc_id)
SELECT g.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(low, g.doc_id) AS component_id
FROM g LEFT JOIN m USING (doc_id)"""
