"""Prefix trie of conversations that borrow the head of another one.

No rebuilt conversation is ever put together. A turn has a digest of its role and text, and the
first d turns of a stored conversation have a product in a monoid: the sum of digest_i * B**i in
four prime fields (:mod:`tidemark.llm.scans` computes it for conversations of any length). What a
rebuilt conversation begins with is composed from two such products: that of the base's head,
and the own suffix, which is the difference of two own products moved by a power of B. Rows
that agree in depth and product form a node. Its members are held to be equal only if they agree
in the digest of their last stored turn and in the product of their parent; digests in turn are
checked against the texts of all stored turns. A disagreement, which takes a collision of more
than 100 bits, stops the job.

Sums over subtrees need no walk. A node belongs to its smallest member, and the nodes of an
owner end its path; so the sum below a node is what all its members own, less what its own owner
has above it, a running sum along that path. A leaf is counted at its owner likewise. The
digest of the members that end at a node is fed from sorted chunks of ids.

Rows: null roles and texts are empty. Rows without a conv_id belong to no conversation. Turns of
one number, repeated rows included, are all kept and stand in the order of their digests.
A negative id has the base id nearer to zero. An empty table has no node, not even a root. Other
columns are ignored.
"""
from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.columns import count_between
from tidemark.llm.scans import SUM, running
from tidemark.session import discard, written

PRIMES = [2147483647, 2147483629, 2147483587, 2147483579]
BASES = [1103515245, 1640531527, 362436069, 521288629]
LANES = list(zip(PRIMES, BASES))
FAMILY, HEADS = 20, 4
SPACE = r"[\x20\x09-\x0D]+"
NODE = ["depth", "fp_0", "fp_1"]
CHUNKS = "depth bigint, fp_0 bigint, fp_1 bigint, first bigint, ids string"
DIGESTS = "depth bigint, fp_0 bigint, fp_1 bigint, ends_sha256 string"
NO_IDS = sha256(b"").hexdigest()


def pair(lanes: list[Column]) -> list[Column]:
    """Four lanes of 31 bits as two longs."""
    return [F.shiftleft(lanes[k], 31).bitwiseOR(lanes[k + 1]) for k in (0, 2)]


def agreed(ok: Column, value: Column, what: str) -> Column:
    """``value``, or an error that stops the job."""
    return F.when(ok, value).otherwise(F.raise_error(F.lit(f"{what} collide: give another seed")))


def stored_turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str,
                 text_col: str, seed: int) -> DataFrame:
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.xxhash64(F.lit(seed), role, text).alias("c_0"),
        F.xxhash64(F.lit(~seed), text, role).alias("c_1"),
        role.alias("role"), text.alias("text"))


def check_digests(turns: DataFrame) -> None:
    """Stops if two different turns share a digest. Each different text is shuffled once a task."""
    shared = turns.select("c_0", "c_1", "role", "text").distinct().groupBy("c_0", "c_1").count()
    if not shared.where("count > 1").isEmpty():
        raise ArithmeticError("digests of turns collide: give another seed")


def rebuilt(places: DataFrame) -> DataFrame:
    """How each conversation is rebuilt: base, turns taken from it, own turns left out, and products."""
    at = lambda i, c: F.max(F.when(F.col("place") == i, F.col(c)))
    names = ["c_0", "c_1", "words", *(f"upto_{k}" for k in range(4))]
    convs = places.groupBy("conv").agg(F.max("place").alias("turns"), *(
        at(i, c).alias(f"{c}_{i}") for i in range(1, HEADS) for c in names))
    own = convs.select(
        "conv", "turns", (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("skip"),
        *(F.array(*(F.col(f"upto_{k}_{i}") for i in range(1, HEADS))).alias(f"own_{k}")
          for k in range(4)))
    base = convs.select(F.col("conv").alias("base"), F.col("turns").alias("base_turns"), *(
        F.array(*(F.col(f"{c}_{i}") for i in range(1, HEADS))).alias(f"head_{c}") for c in names))
    taken = F.least("skip", F.coalesce("base_turns", F.lit(0))).cast("int")
    left = F.greatest(F.col("turns") - F.col("skip"), F.lit(0))
    none = F.lit(0).cast("bigint")

    def value(array: Column, n: Column) -> Column:
        """Product of the first ``n`` turns; that of none is 0."""
        return F.when(n > 0, F.get(array, (n - 1).cast("int"))).otherwise(none)

    return own.join(base, "base", "left").withColumn("taken", taken).select(
        "conv", "skip", "taken", (F.col("taken") + left).alias("ends_at"),
        *(f"head_{c}" for c in names),
        *(value(F.col(f"head_upto_{k}"), F.col("taken")).alias(f"start_{k}") for k in range(4)),
        *(value(F.col(f"own_{k}"), F.least("skip", "turns")).alias(f"cut_{k}") for k in range(4)))


def path_rows(places: DataFrame, plans: DataFrame) -> DataFrame:
    """One row for each conversation and depth from 0 on: products of the prefix and of its parent."""
    none = F.lit(None).cast("bigint")
    root = plans.select("conv", F.lit(0).cast("bigint").alias("depth"), "ends_at",
                        F.lit(0).cast("bigint").alias("fp_0"), F.lit(0).cast("bigint").alias("fp_1"),
                        none.alias("up_0"), none.alias("up_1"), none.alias("c_0"), none.alias("c_1"),
                        F.lit(0).cast("bigint").alias("words"))
    depth = F.explode(F.sequence(F.lit(1), F.col("taken")))
    head = plans.where("taken > 0").withColumn("depth", depth)
    nth = lambda c, d: F.get(F.col(f"head_{c}"), (d - 1).cast("int"))
    upto = [nth(f"upto_{k}", F.col("depth")) for k in range(4)]
    up = [F.coalesce(nth(f"upto_{k}", F.greatest(F.col("depth") - 1, F.lit(1))), F.lit(0)) *
          (F.col("depth") > 1).cast("bigint") for k in range(4)]
    head = head.select("conv", F.col("depth").cast("bigint"), "ends_at", *named(pair(upto), "fp"),
                       *named(pair(up), "up"), nth("c_0", F.col("depth")).alias("c_0"),
                       nth("c_1", F.col("depth")).alias("c_1"),
                       nth("words", F.col("depth")).alias("words"))

    def moved(name: str) -> list[Column]:
        """Own products after the turns left out, behind the head."""
        out = []
        for k, (prime, base) in enumerate(LANES):
            back = F.get(F.array(*(F.lit(pow(base, -s, prime)).cast("bigint") for s in range(HEADS))),
                         (F.col("skip") - F.col("taken")).cast("int"))
            rest = (F.col(f"{name}_{k}") - F.col(f"cut_{k}") + prime) % prime
            out.append((F.col(f"start_{k}") + rest * back) % prime)
        return out

    own = places.join(plans.drop(*(c for c in plans.columns if c.startswith("head_"))), "conv").where(
        F.col("place") > F.col("skip")).select(
        "conv", (F.col("taken") + F.col("place") - F.col("skip")).alias("depth"), "ends_at",
        *named(pair(moved("upto")), "fp"), *named(pair(moved("before")), "up"), "c_0", "c_1", "words")
    return root.unionByName(head).unionByName(own)


def named(columns: list[Column], name: str) -> list[Column]:
    return [c.alias(f"{name}_{k}") for k, c in enumerate(columns)]


def verified_nodes(rows: DataFrame) -> DataFrame:
    """Nodes with their members counted, after all members were found to agree."""
    same = ["up_0", "up_1", "c_0", "c_1", "words"]
    found = rows.groupBy(*NODE).agg(
        F.count("*").alias("n"), F.min("conv").alias("owner"), F.max("ends_at").alias("deepest"),
        *(F.min(c).alias(c) for c in same), *(F.max(c).alias(f"also_{c}") for c in same))
    ok = F.lit(True)
    for c in same:
        ok = ok & F.col(c).eqNullSafe(F.col(f"also_{c}"))
    return found.select(*NODE, "up_0", "up_1", "owner", agreed(ok, F.col("n"), "prefixes").alias("n"),
                        (F.col("deepest") == F.col("depth")).cast("bigint").alias("leaf"),
                        ((F.col("n") - 1) * F.col("words")).alias("saved"))


def id_chunks(batches):
    """Ids of one node that follow each other in a batch, joined."""
    for batch in batches:
        rows = batch.to_pydict()
        keys = list(zip(rows["depth"], rows["fp_0"], rows["fp_1"]))
        out, at = [], 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[at]:
                mine = rows["conv"][at:i]
                out.append((*keys[at], mine[0], ",".join(map(str, mine))))
                at = i
        yield table_of(out, ["depth", "fp_0", "fp_1", "first", "ids"])


def id_digests(batches):
    """One digest a node; its chunks come in the order of their ids."""
    key, state = None, None
    for batch in batches:
        rows, out = batch.to_pydict(), []
        for one, ids in zip(zip(rows["depth"], rows["fp_0"], rows["fp_1"]), rows["ids"]):
            if one == key:
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = one, sha256()
            state.update(ids.encode())
        yield table_of(out, ["depth", "fp_0", "fp_1", "ends_sha256"])
    if key is not None:
        yield table_of([(*key, state.hexdigest())], ["depth", "fp_0", "fp_1", "ends_sha256"])


def table_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if n in ("ids", "ends_sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)],
                                      names=names)


def end_digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of the sorted ids of the conversations that end at each node, comma-joined."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = rows.where("depth = ends_at").select("conv", *NODE)
    chunks = ends.repartitionByRange(parts, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(
        id_chunks, CHUNKS)
    return chunks.repartition(parts, *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        id_digests, DIGESTS)


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text", seed: int = 12) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations, with its subtree's sums."""
    turns = stored_turns(conversations, id_col, turn_col, role_col, text_col, seed)
    check_digests(turns)
    digests = turns.select("conv", "turn", "c_0", "c_1", count_between(F.col("text"), SPACE).alias("words"), *(
        F.pmod(F.col(f"c_{k // 2}"), F.lit(p)).cast("bigint").alias(f"v_{k}")
        for k, p in enumerate(PRIMES)))
    places, first = running(digests, "conv", ["turn", "c_0", "c_1"], [f"v_{k}" for k in range(4)],
                            LANES, "turn-products")
    plans = written(rebuilt(places), "conversation-plans")
    rows = written(path_rows(places, plans), "paths")
    discard(first, plans)

    nodes, second = running(verified_nodes(rows), "owner", ["depth"], ["saved"], [SUM], "nodes")
    nodes = nodes.withColumnRenamed("before_0", "above")
    owned = nodes.groupBy("owner").agg(F.sum("saved").alias("owned"), F.sum("leaf").alias("leaves"))
    below = rows.select("conv", *NODE).join(owned, F.col("conv") == F.col("owner")).groupBy(*NODE).agg(
        F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves"))
    parent = [(F.col("depth") - 1).alias("depth"), F.col("up_0").alias("fp_0"), F.col("up_1").alias("fp_1")]
    children = nodes.where("depth > 0").select(*parent).groupBy(*NODE).agg(F.count("*").alias("children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fp_0").alias("up_0"),
                           F.col("fp_1").alias("up_1"), F.col("owner").alias("parent"))
    whole = (nodes.join(below, NODE).join(children, NODE, "left").join(end_digests(rows), NODE, "left")
             .join(parents, ["depth", "up_0", "up_1"], "left"))
    return whole.select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.coalesce("children", F.lit(0)).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("owned") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))


TRIE_SQL = r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, count(*) AS n, c - c % 20 AS b, xor(4294967295, list_reduce(list_prepend(
    4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(CAST(c AS VARCHAR), '')]),
    lambda crc, y: list_reduce(list_prepend(xor(crc, y), range(8)::BIGINT[]),
      lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))) % 4 AS h FROM t GROUP BY c),
p AS (SELECT k.c, k.b, k.h, least(k.h, coalesce(o.n, 0)) AS g FROM k LEFT JOIN k o ON o.c = k.b),
r AS (SELECT p.c, t.i AS d, t.role, t.text FROM p JOIN t ON t.c = p.b AND t.i <= p.g
  UNION ALL SELECT p.c, p.g + t.i - p.h, t.role, t.text FROM p JOIN t ON t.c = p.c AND t.i > p.h),
x AS (SELECT c, d, list({'r': role, 't': text}) OVER (PARTITION BY c ORDER BY d) AS path, text FROM r
  UNION ALL SELECT c, 0, [], '' FROM k),
l AS (SELECT c, max(d) AS ends FROM x GROUP BY c),
n AS (SELECT d, path, min(c) AS owner, count(*) AS n, max(ends) = d AS leaf,
    (count(*) - 1) * coalesce(len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')), 0) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends = d), '')) AS ends_sha256
  FROM x JOIN l USING (c) GROUP BY d, path),
s AS (SELECT x.d, x.path, sum(n.saved) AS saved, sum(CAST(n.leaf AS INTEGER)) AS leaves
  FROM n JOIN x ON x.c = n.owner AND x.d <= n.d GROUP BY x.d, x.path),
u AS (SELECT d - 1 AS d, list_slice(path, 1, d - 1) AS path, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL)
SELECT n.owner AS conv_id, CAST(n.d AS BIGINT) AS depth, o.owner AS parent_conv_id,
  CAST(n.n AS BIGINT) AS n_convs, CAST(coalesce(u.children, 0) AS BIGINT) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.d = n.d AND s.path = n.path
LEFT JOIN u ON u.d = n.d AND u.path = n.path
LEFT JOIN n o ON o.d = n.d - 1 AND o.path = list_slice(n.path, 1, n.d - 1) AND n.d > 0"""
