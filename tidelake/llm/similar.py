"""Near-duplicates by SimHash and, where 64 bits do not reach, MinHash; both held to the exact similarity.

Two texts are near copies if the Jaccard similarity of their sets of word shingles is at
least ``percent`` of a hundred.  Texts of one set are folded first.  Candidates are in one
component of the SimHash operator (``simhash``: fingerprints of the same shingles, the
pigeonring index, components), or share a band of minima: texts of similarity 0.8 differ in
about 10 of 64 bits, which no exact index of fingerprints finds.  25 bands of 5 minima each
make a pair of similarity 0.8 a candidate with probability 1 - (1 - 0.8 ** 5) ** 25 =
0.99995, and a more similar one more surely.  A component and a band are buckets alike: all
pairs of a bucket's texts are held to the exact similarity, so no false link is made.

A bucket is compared whole, as a breadth-first search that emits one link a member.  One
of more than two blocks' shingles is cut into blocks ``ROUNDS`` times, by other hashes each
time, and compared block by block: near copies come together through the texts that they
meet in one round or another.  Only where a bucket then still holds several components are
all but its largest held to all its texts, in blocks, so no link between different
components is lost.  Rows grow with a bucket's texts, and with its square only for texts
that share a bucket without being near copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import give_back, table, text_batches
from tidelake.llm.simhash import components, fingerprint_of, one_of_each
from tidelake.llm.simhash import links as fingerprint_links

BANDS, ROWS = 25, 5
#: Times that a crowded bucket is cut into blocks.
ROUNDS = 3
_CHUNK = 1 << 12
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = np.random.default_rng(43).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles_of(text: str | None, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted different hashes of a text's word shingles; a text of fewer words is one shingle."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = max(1, len(words) - shingle + 1)
    found = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if n > 1 else [b" ".join(words)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in found), np.uint64, n))


def bands_of(hashes: np.ndarray) -> np.ndarray:
    """One key a band of the minima of a set."""
    import xxhash

    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), _CHUNK):
        least = np.minimum(least, (hashes[i : i + _CHUNK] * _FACTORS[:, None] + _OFFSETS[:, None]).min(axis=1))
    return np.fromiter((xxhash.xxh64_intdigest(r.tobytes(), band) for band, r in enumerate(least.reshape(BANDS, ROWS))), np.uint64, BANDS)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _node(hashes: np.ndarray) -> int:
    import xxhash

    node = xxhash.xxh64_intdigest(hashes.tobytes(), 1)
    return node - (1 << 64) if node >> 63 else node


def with_bands(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, text_hash, the text's fingerprint, and of its set: node (its hash), size and band keys."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("fp long, node long, size long, bands array<long>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingles_of(t, shingle) for t in texts]
            fps = np.fromiter((fingerprint_of(t, shingle) for t in texts), np.uint64, len(texts))
            yield pd.DataFrame({"fp": _signed(fps), "node": [_node(s) for s in sets], "size": [len(s) for s in sets], "bands": [_signed(bands_of(s)) for s in sets]})
        give_back()

    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), sketch(F.col(text_col)).alias("s")).select("doc_id", "text_hash", "s.*")


def set_links(nodes: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (node, root) that join the sets of a bucket whose similarity is at least ``percent``."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)[np.argsort(ids, kind="stable")]
    held = np.bincount(ids)
    ends, first = np.cumsum(held), np.cumsum(size) - size
    left = np.ones(len(sets), bool)
    links = []
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue and left.any():
            i = queue.pop()
            own = ids[first[i] : first[i] + size[i]]
            n = held[own]
            at = np.repeat(ends[own] - np.cumsum(n), n) + np.arange(n.sum())  # places of all owners of own's shingles
            shared = np.bincount(owner[at], minlength=len(sets))
            found = np.flatnonzero(left & (shared * (100 + percent) >= percent * (size + size[i])))
            links += [(int(nodes[k]), int(nodes[root])) for k in found]
            queue += found.tolist()
            left[found] = False
    return links


def buckets(prints: DataFrame) -> DataFrame:
    """node, size, key: the sets of each SimHash component and of each band of minima."""
    roots = components(table(fingerprint_links(prints.select("fp").distinct()), "fingerprint-links"))
    near = prints.join(roots, prints.fp == roots.node, "left").select(prints.node, "size", F.xxhash64(F.lit("fp"), F.coalesce("root", "fp")).alias("key"))
    return near.distinct().unionByName(prints.groupBy("node").agg(F.any_value("size").alias("size"), F.any_value("bands").alias("bands")).select("node", "size", F.explode("bands").alias("key")))


def links(docs: DataFrame, prints: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, block: int) -> DataFrame:
    """(a, b) links whose components are those of all candidates within ``percent``.

    prints: with_bands of docs.  Shingles are taken only of one text for each set that shares a bucket.
    """
    sets = prints.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("of"))
    entries = buckets(prints)
    members = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"m{seed}") for seed in (0, 1)]
    sizes = entries.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("total"), *members).where("n > 1")
    sizes = sizes.groupBy("n", "total", "m0", "m1").agg(F.min("key").alias("key"))  # buckets of the same sets are compared once
    shared = table(entries.join(sizes.select("key", "total"), "key"), "shared-bands")
    wanted = shared.select("node").distinct().join(sets.select("node", "of.*"), "node")
    wanted = wanted.select("doc_id", "text_hash").distinct().select(F.col("doc_id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash"))

    @F.pandas_udf("node long, shingles array<long>")
    def taken(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [shingles_of(t, shingle) for t in texts]
            yield pd.DataFrame({"node": [_node(s) for s in found], "shingles": [_signed(s) for s in found]})
        give_back()

    some = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    some = some.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("h") == F.col("wanted_hash")), "left_semi")
    arrays = table(some.select(taken("text").alias("s")).select("s.*").dropDuplicates(["node"]), "shingles")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for found in pdf["sets"]:
                out += set_links(np.array([s["node"] for s in found], np.int64), [np.asarray(s["shingles"], np.int64) for s in found], percent)
            yield pd.DataFrame(np.array(out, np.int64).reshape(-1, 2), columns=["a", "b"])
        give_back()

    def links_of(tiles: DataFrame) -> DataFrame:
        met = tiles.join(arrays, "node").groupBy(*(c for c in tiles.columns if c != "node")).agg(F.collect_list(F.struct("node", "shingles")).alias("sets"))
        return met.select("sets").mapInPandas(compared, "a long, b long")

    first = table(links_of(tiles_of(shared, block)), "links-in-blocks")
    crowded = shared.where(F.col("total") > 2 * block)
    if crowded.isEmpty():
        return first
    left = tiles_across(crowded, components(first), block)
    return first if left.isEmpty() else first.unionByName(links_of(left))


def tiles_of(members: DataFrame, block: int) -> DataFrame:
    """node, key, round, i: each bucket's blocks; a bucket of up to two blocks' shingles is one, in one round.

    members: node, key and the bucket's total of shingles.
    """
    blocks = F.when(F.col("total") <= 2 * block, 1).otherwise(F.ceil(F.col("total") / block)).cast("int")
    rounds = F.explode(F.sequence(F.lit(0), F.when(F.col("total") <= 2 * block, 0).otherwise(ROUNDS - 1))).alias("round")
    cut = members.select("node", "key", blocks.alias("blocks"), rounds)
    return cut.select("node", "key", "round", F.pmod(F.xxhash64("node", "key", "round"), "blocks").cast("int").alias("i"))


def tiles_across(members: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """node, key, i, j: blocks i of a bucket's texts, each with block j of those outside its largest component.

    members: node, key, size, total.  roots: node, root of the links found so far.  A
    bucket of one component has no tiles.
    """
    rooted = table(members.join(roots, "node", "left").withColumn("root", F.coalesce("root", F.col("node"))), "crowded-buckets")
    sums = rooted.groupBy("key", "root").agg(F.sum("size").alias("held"))
    top = sums.groupBy("key").agg(F.max_by("root", F.struct("held", "root")).alias("top"), (F.sum("held") - F.max("held")).alias("outside")).where("outside > 0")
    blocks = lambda c: F.ceil(F.col(c) / block).cast("int")
    both = rooted.join(top, "key").withColumns({"n": blocks("total"), "m": blocks("outside")})
    place = lambda of, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(of)).cast("int")
    every = both.select("node", "key", place("n", 5).alias("i"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"))
    outside = both.where("root <> top").select("node", "key", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"), place("m", 6).alias("j"))
    return every.unionByName(outside).distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, block: int = 1 << 19) -> DataFrame:
    """One row of docs for each component of near copies, the one that simhash.keep_one would keep of it.

    That is the row of the smallest id; rows with that id are told apart by a hash of their
    text, and of equal rows one stays.  A component without ids keeps one of its rows.  Null,
    empty and blank texts have no words and are copies of each other.  A text is taken
    whole, however long.  Columns keep their names and values, whatever they are called.
    An empty table gives an empty one.
    """
    prints = table(with_bands(docs, id_col, text_col, shingle), "bands")
    roots = components(table(links(docs, prints, id_col, text_col, shingle, percent, block), "links"))
    rooted = prints.join(roots, prints.node == roots.node, "left").select("doc_id", "text_hash", F.coalesce("root", prints.node).alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return one_of_each(docs, rooted.join(least, "root"), id_col, text_col)
