"""The prefix trie of conversations, as succinct level-order tries of shards.

Conversations are rebuilt from their own turns and those of the first of their block of
five.  Every distinct sequence of first turns is a node, named by a chain of hashes.  Nodes
that more than a threshold of conversations pass are heavy; the threshold grows with the
turns so that at most ``MOST_HEAVY`` nodes are.  What hangs below the heavy nodes falls into
prefix shards, one for each light node whose parent is heavy, and many shards into a bucket.

A bucket is one task's trie: numpy puts its nodes in level order as a LOUDS bitvector (for
each node a one a child, then a zero) and label arrays, takes parents from the bitvector by
rank and select, and adds subtree sums level by level in reverse.  The heavy upper levels
are merged separately: each heavy node gets the summed totals of the shards below it, and
one more trie, of bounded size, rolls them up.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import table, text_batches

#: Conversations of a block; turns that a conversation takes of its block's first are below this.
BLOCK, TAKEN = 5, 9
#: Bound of heavy nodes; a node that fewer conversations pass is never heavy.
MOST_HEAVY, LEAST_HEAVY = 1 << 16, 4096
#: Nodes that a bucket of shards has, about.
BUCKET_NODES = 200_000
#: Characters of ids that are handed on at once for a node that more than one task sees.
CHUNK = 1 << 16
ROOT = bytes(16)


def chained(parent: bytes, label: bytes) -> bytes:
    """The name of the node that a turn leads to."""
    return hashlib.blake2b(parent + label, digest_size=16).digest()


def taken_of_first(conv_id: int) -> int:
    """How many turns a conversation takes of the first of its block."""
    return zlib.crc32(str(conv_id).encode()) % TAKEN


class Louds:
    """A trie in level order, its roots below a super-root. Nodes are numbered from 1, the super-root is 0.

    bits: for each node from the super-root on a one for each child, then a zero; label:
    the nodes' names, those of siblings ascending.
    """

    def __init__(self, bits: np.ndarray, label: np.ndarray) -> None:
        self.bits, self.label = bits, label
        self.ones, self.zeros = np.flatnonzero(bits), np.flatnonzero(bits == 0)
        #: Parent of each node: the zeros before the one that stands for it.
        self.parent = np.concatenate([[0], self.ones - np.arange(len(self.ones))])

    @classmethod
    def of(cls, key: np.ndarray, parent: np.ndarray) -> tuple[Louds, np.ndarray, list[int]]:
        """The trie of nodes named key below nodes named parent, each node's place in key, and ends of levels.

        A node whose parent is none of key hangs at the super-root.
        """
        by_key = np.argsort(key, kind="stable")
        at = np.minimum(np.searchsorted(key[by_key], parent), max(len(key) - 1, 0))
        owner = np.where(key[by_key][at] == parent, by_key[at], -1) if len(key) else np.zeros(0, np.int64)
        children = np.lexsort((key, owner))  # grouped by parent, names ascending
        degree = np.bincount(owner[owner >= 0], minlength=len(key))
        roots = int((owner < 0).sum())
        first = roots + np.cumsum(degree) - degree
        level, places, degrees, ends = children[:roots], [], [np.array([roots], np.int64)], [0]
        while len(level):
            places.append(level)
            n = degree[level]
            degrees.append(n)
            ends.append(ends[-1] + len(level))
            level = children[np.repeat(first[level] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        place, n = np.concatenate([np.zeros(0, np.int64), *places]), np.concatenate(degrees)
        bits = np.ones(len(place) + len(n), np.uint8)
        bits[np.cumsum(n + 1) - 1] = 0
        return cls(bits, key[place]), place, ends

    def children(self, node: int) -> range:
        """The children's numbers."""
        before = self.zeros[node - 1] + 1 if node else 0
        first = int(before) - node + 1
        return range(first, first + int(self.zeros[node] - before))

    def find(self, keys: list[bytes]) -> int | None:
        """The node that a path of names leads to from the super-root."""
        node = 0
        for key in keys:
            own = self.children(node)
            at = int(np.searchsorted(self.label[own.start - 1 : own.stop - 1], np.bytes_(key))) if len(own) else 0
            if at == len(own) or self.label[own.start - 1 + at] != np.bytes_(key):
                return None
            node = own.start + at
        return node

    def rolled_up(self, values: np.ndarray, ends: list[int]) -> np.ndarray:
        """Sums of values over subtrees, by level in reverse; values and sums are in level order."""
        total = np.concatenate([[0], values])
        for start, end in reversed(list(zip(ends, ends[1:]))):
            own = np.arange(start + 1, end + 1)
            np.add.at(total, self.parent[own], total[own])
        return total[1:]


_VISIT = "conv_id long, depth long, key binary, parent binary, n_bytes long, shard binary, last boolean"


def _visits(labelled: DataFrame, heavy: frozenset[bytes] | None) -> DataFrame:
    """A row for each rebuilt conversation and each of its nodes, the root included.

    last: it ends there.  shard: the first node on its path that is not heavy, null at and
    above heavy nodes.  Blocks are streamed in order: what is held is the first turns of a
    block and the node that the conversation is at.
    """
    shared = labelled.sparkSession.sparkContext.broadcast(heavy or frozenset())

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = shared.value
        out: list[list] = []
        block, conv, seen, own_from = None, None, 0, 0
        first: list[tuple[bytes, int]] = []
        node: list = []  # the visit that the conversation is at: as it may be its last, it waits

        def step(label: bytes, n_bytes: int) -> None:
            nonlocal node
            key = chained(node[2], label)
            shard = node[5] if node[5] is not None else None if key in upper else key
            out.append([*node, False])
            node = [node[0], node[1] + 1, key, node[2], n_bytes, shard]

        for pdf in batches:
            for b, c, label, n in zip(pdf["block"].tolist(), pdf["conv_id"].tolist(), pdf["label"], pdf["n_bytes"].tolist()):
                if b != block:
                    block, first = b, []
                if c != conv:
                    if node:
                        out.append([*node, True])
                    conv, seen, own_from = c, 0, 0 if c == b else taken_of_first(c)
                    node = [c, 0, ROOT, None, 0, None]
                    for had in first[:own_from] if c != b else []:
                        step(*had)
                if c == b and len(first) < TAKEN - 1:
                    first.append((bytes(label), n))
                if seen >= own_from:
                    step(bytes(label), n)
                seen += 1
            yield pd.DataFrame(out, columns=["conv_id", "depth", "key", "parent", "n_bytes", "shard", "last"])
            out.clear()
        if node:
            yield pd.DataFrame([[*node, True]], columns=["conv_id", "depth", "key", "parent", "n_bytes", "shard", "last"])

    order = ["block", "conv_id", F.col("turn").asc_nulls_first(), "label"]
    return labelled.repartition("block").sortWithinPartitions(*order).select("block", "conv_id", "label", "n_bytes").mapInPandas(walked, _VISIT)


def labelled_turns(turns: DataFrame) -> DataFrame:
    """block, conv_id, turn, label, n_bytes of every turn that has a conversation, as a written table; label is a hash of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    label = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    conv = F.col("conv_id").cast("long")
    rows = turns.select((conv - F.pmod(conv, F.lit(BLOCK))).alias("block"), conv.alias("conv_id"), "turn", label.alias("label"), F.octet_length(text).cast("long").alias("n_bytes"))
    return table(rows.where("conv_id IS NOT NULL"), "turn-labels")


def heavy_nodes(labelled: DataFrame, most: int = MOST_HEAVY, least: int = LEAST_HEAVY) -> frozenset[bytes]:
    """Names of the nodes that more than a threshold of conversations pass, and of the root; at most ``most`` and one.

    Conversations have at most TAKEN + 1 visits for each turn of theirs, and nodes above
    the threshold have more visits than that each.
    """
    over = max(least, -(-labelled.count() * (TAKEN + 1) // most))
    found = _visits(labelled, None).groupBy("key").count().where(F.col("count") > over).select("key").collect()
    return frozenset(bytes(r["key"]) for r in found) | {ROOT}


_NODE = "key binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def rolled_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows of _NODE of the nodes of one trie.

    pdf: key, parent, depth, n_bytes, n_convs, conv_id, and below_children, below_leaves,
    below_saved: what hangs at a node in other tries.  A node whose parent is in another
    trie has a null parent_conv_id.
    """
    key = np.array(pdf["key"].tolist(), "S16")
    parent = np.array([ROOT if p is None else p for p in pdf["parent"]], "S16")
    parent = np.where(pdf["depth"].to_numpy() > 0, parent, b"none")  # no name has 4 bytes
    trie, place, ends = Louds.of(key, parent)
    of = lambda c: pdf[c].to_numpy(np.int64)[place]
    children = np.array([len(trie.children(i + 1)) for i in range(len(place))], np.int64) if len(place) < 2 else np.diff(trie.zeros)[: len(place)] - 1
    children = children + of("below_children")
    leaves = trie.rolled_up(of("below_leaves") + (children == 0), ends)
    saved = trie.rolled_up(of("below_saved") + (of("n_convs") - 1) * of("n_bytes"), ends)
    least = of("conv_id")
    above = pd.array(np.concatenate([[0], least])[trie.parent[1:]], "Int64")
    above[trie.parent[1:] == 0] = pd.NA
    some = pdf.iloc[place]
    return pd.DataFrame({
        "key": some["key"].tolist(), "parent": some["parent"].tolist(), "conv_id": least, "depth": of("depth"), "parent_conv_id": above,
        "n_convs": of("n_convs"), "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
    })


def end_digests(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: the digest of each node's ids (conv_id), ascending, comma-joined.

    Ids are range-partitioned by node and id.  A node that lies within a task is hashed
    there; of others each task hands on its joined ids in chunks, and a last task hashes
    the chunks as they come, as SHA-256 is sequential.
    """

    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        seq = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        key, held, size, whole = None, [], 0, False  # the first node may begin in another task

        def chunk() -> None:
            nonlocal seq, held, size
            out.append((key, None, seq, ",".join(held)))
            seq, held, size = seq + 1, [], 0

        for pdf in batches:
            for k, c in zip(map(bytes, pdf["key"]), pdf["conv_id"].tolist()):
                if k != key:
                    if key is not None and whole:
                        out.append((key, hashlib.sha256(",".join(held).encode()).hexdigest(), None, None))
                        held, size = [], 0
                    elif held:
                        chunk()
                    whole, key = key is not None, k
                held.append(str(c))
                size += len(held[-1]) + 1
                if size >= CHUNK:
                    chunk()
                    whole = False
            yield pd.DataFrame(out, columns=["key", "sha", "seq", "chunk"]).astype({"seq": "Int64"})
            out.clear()
        if held:  # the last node may go on in another task
            chunk()
            yield pd.DataFrame(out, columns=["key", "sha", "seq", "chunk"]).astype({"seq": "Int64"})

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, running = None, hashlib.sha256()
        for pdf in batches:
            out = []
            for k, chunk in zip(map(bytes, pdf["key"]), pdf["chunk"]):
                if k != key:
                    if key is not None:
                        out.append((key, running.hexdigest()))
                    key, running = k, hashlib.sha256(chunk.encode())
                else:
                    running.update(b"," + chunk.encode())
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, running.hexdigest())], columns=["key", "ends_sha256"])

    text_batches(ends.sparkSession)
    parts = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInPandas(digested, "key binary, sha string, seq long, chunk string")
    parts = table(parts, "trie-ends")
    pieces = parts.where("chunk IS NOT NULL").select("key", "seq", "chunk").repartition("key").sortWithinPartitions("key", "seq")
    return parts.where("sha IS NOT NULL").select("key", F.col("sha").alias("ends_sha256")).unionByName(pieces.select("key", "chunk").mapInPandas(streamed, "key binary, ends_sha256 string"))


def _nodes(turns: DataFrame, most_heavy: int, least_heavy: int) -> tuple[DataFrame, DataFrame]:
    """Written tables of visits and of distinct nodes."""
    labelled = labelled_turns(turns)
    visits = table(_visits(labelled, heavy_nodes(labelled, most_heavy, least_heavy)), "trie-visits")
    own = visits.groupBy("key").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("n_bytes").alias("n_bytes"), F.first("shard").alias("shard"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    return visits, table(own, "trie-nodes")


def _buckets(nodes: DataFrame, bucket_nodes: int) -> DataFrame:
    light = nodes.where("shard IS NOT NULL")
    buckets = max(1, -(-light.count() // bucket_nodes))
    return light.withColumn("bucket", F.pmod(F.xxhash64("shard"), F.lit(buckets)).cast("int"))


def shard_tries(turns: DataFrame, most_heavy: int = MOST_HEAVY, least_heavy: int = LEAST_HEAVY, bucket_nodes: int = BUCKET_NODES) -> DataFrame:
    """bucket, louds, labels, n_convs: each bucket's trie in packed bits, with names and members of its nodes in level order."""

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        trie, place, _ = Louds.of(np.array(pdf["key"].tolist(), "S16"), np.array(pdf["parent"].tolist(), "S16"))
        row = [int(pdf["bucket"].iloc[0]), np.packbits(trie.bits).tobytes(), b"".join(pdf["key"].iloc[place]), pdf["n_convs"].to_numpy(np.int64)[place]]
        return pd.DataFrame([row], columns=["bucket", "louds", "labels", "n_convs"])

    buckets = _buckets(_nodes(turns, most_heavy, least_heavy)[1], bucket_nodes)
    return buckets.groupBy("bucket").applyInPandas(packed, "bucket int, louds binary, labels binary, n_convs array<long>")


def prefix_trie(turns: DataFrame, most_heavy: int = MOST_HEAVY, least_heavy: int = LEAST_HEAVY, bucket_nodes: int = BUCKET_NODES) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    turns: conv_id, turn, role, text; other columns are not read.  Turns are ordered by
    turn, nulls first, and equal ones by a hash of role and text; repeated rows are turns
    as often as they are there.  Null roles and texts are empty.  Rows without conv_id
    belong to no conversation.  A block goes down to the next multiple of five, also below
    zero.  A text is hashed whole, however long.  An empty table has no nodes.
    """
    visits, nodes = _nodes(turns, most_heavy, least_heavy)
    none = [F.lit(0).cast("long").alias(c) for c in ("below_children", "below_leaves", "below_saved")]
    cols = ["key", "parent", "depth", "n_bytes", "n_convs", "conv_id"]
    light = table(_buckets(nodes, bucket_nodes).select("bucket", *cols, *none).groupBy("bucket").applyInPandas(rolled_up, _NODE), "trie-shards")
    tops = light.where("parent_conv_id IS NULL")
    below = tops.groupBy("parent").agg(F.count("*").alias("below_children"), F.sum("n_leaves").alias("below_leaves"), F.sum("saved_tokens").alias("below_saved"))
    upper = nodes.where("shard IS NULL").select(*cols).join(below.withColumnRenamed("parent", "key"), "key", "left").na.fill(0, ["below_children", "below_leaves", "below_saved"])
    upper = table(upper.groupBy(F.lit(0).alias("one")).applyInPandas(lambda pdf: rolled_up(pdf.drop(columns="one", errors="ignore")), _NODE), "trie-top")  # at most most_heavy rows
    names = upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("top_conv_id"))
    light = light.join(F.broadcast(names), "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top_conv_id")).drop("top_conv_id")
    digests = end_digests(visits.where("last"))
    out = light.unionByName(upper).join(digests, "key", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


#: DuckDB SQL for the rows of prefix_trie.
SQL = r"""
WITH RECURSIVE steps AS (
    SELECT range AS i, 0 AS k, range AS v FROM range(256)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8
), crc AS (
    SELECT list(v ORDER BY i) AS entry FROM steps WHERE k = 8
), convs AS (
    SELECT conv_id, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS code FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
), taken AS (
    SELECT conv_id, xor(list_reduce(list_concat([4294967295], code), lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h FROM convs, crc
), named AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
    SELECT *, md5(strlen(role) || ':' || role || text) AS label, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS p FROM named
), rebuilt AS (
    SELECT taken.conv_id, p, label, strlen(text) AS n_bytes FROM taken JOIN turns ON turns.conv_id = taken.conv_id - ((taken.conv_id % 5) + 5) % 5 AND p <= h
    UNION ALL
    SELECT taken.conv_id, p, label, strlen(text) FROM taken JOIN turns ON turns.conv_id = taken.conv_id AND p > h
), placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS depth, n_bytes, md5(string_agg(label, '') OVER (PARTITION BY conv_id ORDER BY p)) AS key FROM rebuilt
), visits AS (
    SELECT conv_id, 0 AS depth, '' AS key, CAST(NULL AS VARCHAR) AS parent, 0 AS n_bytes FROM taken
    UNION ALL
    SELECT conv_id, depth, key, lag(key, 1, '') OVER (PARTITION BY conv_id ORDER BY depth), n_bytes FROM placed
), nodes AS (
    SELECT key, any_value(depth) AS depth, any_value(parent) AS parent, any_value(n_bytes) AS n_bytes, min(conv_id) AS conv_id, count(*) AS n_convs FROM visits GROUP BY key
), children AS (
    SELECT parent AS key, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), sums AS (
    SELECT v.key, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.n_bytes) AS saved
    FROM nodes n LEFT JOIN children c ON c.key = n.key JOIN visits v ON v.conv_id = n.conv_id AND v.depth <= n.depth GROUP BY v.key
), lasts AS (
    SELECT conv_id, arg_max(key, depth) AS key FROM visits GROUP BY conv_id
), ends AS (
    SELECT key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha FROM lasts GROUP BY key
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.key = n.parent LEFT JOIN children c ON c.key = n.key JOIN sums s ON s.key = n.key LEFT JOIN ends e ON e.key = n.key
"""
