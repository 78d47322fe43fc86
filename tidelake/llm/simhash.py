"""SimHash near-duplicates by a pigeonring index.

A 64-bit fingerprint is a ring of eight 8-bit segments.  If two fingerprints differ
in at most d bits, the pigeonring principle gives a segment from which every chain of
l consecutive segments differs in at most ``l * d // 8`` bits.  For d = 3 the budgets
are 0, 0, 1, 1, 1, 2, 2, 3: the first two segments of the chain are equal, and of the
next three at least two are.  Each fingerprint is therefore indexed under 8 starts
times 3 choices of two of those three segments, 32 exact bits a key.  Pairs that share
a key go through the rest of the chain budgets and only then through the full Hamming
check.

Exact copies share a fingerprint and are folded before anything else, so a group of
copies of any size is one node.  Buckets are compared whole while they hold at most
``bucket_limit`` different fingerprints; fingerprints of larger buckets are linked
exactly through shared neighbours (see ``_links_of_crowded``), whose rows grow with
the number of fingerprints and not with its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import drop_path, give_back, scratch, table, text_batches, unused

SEGMENTS = 8
CHAIN = 5
_BLOCK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles; no words: 0."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    left = n
    while left:
        k = min(left, _BLOCK)
        h = np.fromiter((digest(s, seed) for s, _ in zip(shingles, range(k))), np.uint64, k)
        ones += np.unpackbits(h.view(np.uint8).reshape(k, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        left -= k
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp, text_hash: fp is the fingerprint as a signed long."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.fromiter((fingerprint_of(t, shingle, seed) for t in texts), np.uint64, len(texts)).view(np.int64))
        give_back()

    return docs.select(F.col(id_col).alias("doc_id"), fp(F.col(text_col)).alias("fp"), F.xxhash64(text_col).alias("text_hash"))


def _keys(fp) -> list:
    """The 24 index keys of a fingerprint column."""
    out = []
    for start in range(SEGMENTS):
        seg = [F.shiftrightunsigned(fp, 8 * ((start + i) % SEGMENTS)).bitwiseAND(255) for i in range(CHAIN)]
        for which, (a, b) in enumerate(((2, 3), (2, 4), (3, 4))):
            tag = F.lit((start * 3 + which) << 32)
            out.append(reduce(lambda x, y: x.bitwiseOR(y), (tag, F.shiftleft(seg[0], 24), F.shiftleft(seg[1], 16), F.shiftleft(seg[a], 8), seg[b])))
    return out


def chain_links(values: np.ndarray, start: int, distance: int = 3) -> list[tuple[int, int]]:
    """Links (value, root) that join the values of a bucket within ``distance`` bits.

    Breadth-first over the values: each step compares one value with those not reached
    yet, first on the chain's budgets from ``start``, then on all 64 bits.
    """
    spans = []
    for length in range(1, SEGMENTS):
        mask = 0
        for i in range(length):
            mask |= 255 << (8 * ((start + i) % SEGMENTS))
        spans.append((np.uint64(mask), length * distance // SEGMENTS))
    spans = [s for s, after in zip(spans, [*spans[1:], None]) if after is None or after[1] != s[1]]
    left = np.sort(values.astype(np.uint64))
    links = []
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            diff = left ^ queue.pop()
            live = np.flatnonzero(np.bitwise_count(diff & spans[0][0]) <= spans[0][1])
            for mask, budget in spans[1:]:
                live = live[np.bitwise_count(diff[live] & mask) <= budget]
            live = live[np.bitwise_count(diff[live]) <= distance]
            if len(live):
                found = left[live]
                links += [(int(v), int(root)) for v in found]
                queue += list(found)
                left = np.delete(left, live)
    return links


def _links_of_buckets(entries: DataFrame, distance: int) -> DataFrame:
    """Links within buckets whose number of fingerprints is bounded."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = [], []
            for key, fps in zip(pdf["key"], pdf["fps"]):
                for v, root in chain_links(np.asarray(fps, np.int64).view(np.uint64), (int(key) >> 32) // 3, distance):
                    a.append(v)
                    b.append(root)
            yield pd.DataFrame({"a": np.array(a, np.uint64).view(np.int64), "b": np.array(b, np.uint64).view(np.int64)})

    return entries.groupBy("key").agg(F.collect_list("fp").alias("fps")).mapInPandas(pairs, "a long, b long")


def _flips(fp, most: int):
    """Array of fp with every choice of at most ``most`` (1 or 2) bits flipped."""
    masks = [0] + [1 << i for i in range(64)]
    if most > 1:
        masks += [(1 << i) | (1 << j) for i in range(64) for j in range(i)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.transform(F.lit(signed).cast("array<bigint>"), lambda m: fp.bitwiseXOR(m))


def _links_of_crowded(fps: DataFrame) -> DataFrame:
    """Exact links within 3 bits, in rows linear in the number of fingerprints.

    Two fingerprints are within 3 bits if and only if some centre is within 1 bit of
    one and 2 bits of the other.  All that are within 1 bit of a centre are within 2
    bits of each other, so one of them can stand for the rest.
    """
    near = fps.select("fp", F.explode(_flips(F.col("fp"), 1)).alias("centre"))
    hub = near.groupBy("centre").agg(F.min("fp").alias("hub"))
    far = fps.select("fp", F.explode(_flips(F.col("fp"), 2)).alias("centre"))
    return far.join(hub, "centre").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()


def links(fps: DataFrame, distance: int = 3, bucket_limit: int = 8192) -> DataFrame:
    """(a, b) links whose connected components are those of all pairs within ``distance``.

    fps: one row for each different fingerprint, in column fp.
    """
    if distance != 3:
        raise ValueError("the index is laid out for a distance of 3")
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # fingerprints are small, their 24 entries are not
    entries = fps.repartition(spread, F.xxhash64("fp")).select("fp", F.explode(F.array(*_keys(F.col("fp")))).alias("key"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = entries.join(sizes, "key")
    found = _links_of_buckets(shared.where(F.col("n") <= bucket_limit), distance)
    crowded = shared.where(F.col("n") > bucket_limit).select("fp").distinct()
    if crowded.isEmpty():
        return found
    return found.unionByName(_links_of_crowded(crowded))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node in an edge, by alternating large and small stars.

    edges: columns a, b.  Neighbourhoods are reduced to their least node before any
    join, and each round is written to the shared folder.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = scratch(spark, name)
        df.write.parquet(path)
        back = spark.read.schema("a long, b long").parquet(path)
        state = back.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return back, path, tuple(state)

    low = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, path, state = written(low(edges))
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("m < a").select("a", F.col("m").alias("b")))
        large = low(large)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(down.select("a", F.col("m").alias("b")))
        after, path_after, state_after = written(low(small))
        drop_path(spark, path)
        done = state_after == state
        now, path, state = after, path_after, state_after
        if done:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, bucket_limit: int = 8192) -> DataFrame:
    """doc_id, fp, text_hash, root, component_id for every row; root is a component's own fingerprint."""
    prints = table(with_fingerprint(docs, id_col, text_col, shingle), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(table(links(least.select("fp"), distance, bucket_limit), "links"))
    nodes = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(nodes.join(names, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, bucket_limit: int = 8192) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of docs.

    Rows with no words (null, empty or blank text) have fingerprint 0 and link like any
    other; long texts are hashed whole, a block of shingles at a time.  Repeated rows are each returned.  A row with a null id takes part in links;
    ids of a component ignore nulls, and a component without any id has a null one.  An
    empty table gives an empty result.  Columns other than the id and text are not read.
    """
    rows = grouped(docs, id_col, text_col, shingle, distance, bucket_limit)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each near-duplicate component: one of its smallest id.

    Rows that share that id are told apart by a hash of their text, and of equal rows one
    stays.  A component without ids keeps one of its rows.
    """
    return one_of_each(docs, grouped(docs, id_col, text_col), id_col, text_col)


def one_of_each(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of docs for each root of groups (doc_id, text_hash, root, component_id), as keep_one says."""
    named = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rows = table(named.select("doc_id", "text_hash", "root"), "kept-rows")
    own, kept_id, kept_hash = unused(docs, "own_hash"), unused(docs, "kept_id"), unused(docs, "kept_hash")
    kept = rows.groupBy("root").agg(F.min(F.struct("text_hash", "doc_id")).alias("k")).select(F.col("k.doc_id").alias(kept_id), F.col("k.text_hash").alias(kept_hash))
    hashed = docs.withColumn(own, F.xxhash64(text_col))
    found = hashed.join(kept, F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_hash)), "left_semi")
    if not rows.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():  # texts are shuffled again only for repeated rows
        found = found.dropDuplicates([id_col, own])
    return found.drop(own)
