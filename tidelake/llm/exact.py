"""Exact duplicates of whole texts by progressive refinement.

Texts are compared with runs of ASCII white space as one space.  The first scan takes each
text's length and the hash of a short prefix.  Lengths that several rows have survive; of
those, prefixes that several rows have do.  Only texts of surviving groups are read again
for their full hash, and rows with equal hashes are the groups.

A text never moves.  The second scan learns which groups survived from a bitmap with one
bit for each slot that a (length, prefix) falls into, of at most ``MOST_BITS`` bits (16 MB).
A bit is set for every surviving group, so none is missed; a slot shared with one only
means that a unique text is hashed as well.

Groups are counted by partial aggregates.  Those of more than a ``MOST_HOT``-th of all
rows, of which there are fewer than that, go back to their rows by a broadcast, all
others by a shuffle in which no key has more rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import table, unused

#: Characters of the prefix that is hashed.
PREFIX = 64
#: Bits of the survivors' bitmap for each survivor, and at most; bits of one of its rows.
BITS_EACH, MOST_BITS, ROW_BITS = 16, 1 << 27, 1 << 15
#: A group of more than this part of all rows is hot.
MOST_HOT = 4096


def normalised(text: Column) -> Column:
    """A text with every run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _slot(bits: int) -> Column:
    return F.pmod(F.xxhash64("length", "prefix"), F.lit(bits))


def surviving(sizes: DataFrame) -> DataFrame:
    """(length, prefix) of the groups that several rows are in. sizes: length, prefix, rows."""
    lengths = sizes.groupBy("length").agg(F.sum("rows").alias("n")).where("n > 1").select("length")
    return sizes.join(lengths, "length", "left_semi").where("rows > 1").select("length", "prefix")


def bitmap_of(groups: DataFrame, bits: int) -> DataFrame:
    """Rows (part, map) with a bit set for the slot of each group; at most bits / ROW_BITS rows of 4 KB."""
    slots = groups.select(_slot(bits).alias("slot"))
    return slots.groupBy((F.floor(F.col("slot") / ROW_BITS)).cast("long").alias("part")).agg(F.bitmap_construct_agg((F.col("slot") % ROW_BITS)).alias("map"))


def _bit(at: Column) -> Column:
    """Whether bit ``at`` of column map is set; a missing map has none."""
    octet = F.conv(F.hex(F.substring("map", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (at % 8 + 1).cast("int"))
    return F.coalesce(octet, F.lit(0)).bitwiseAND(mask) > 0


def refined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every_digest: bool = False) -> DataFrame:
    """row, doc_id, length, prefix, digest for every row of docs, as a written table.

    digest is the SHA-256 of the normalised text in surviving groups and null for texts
    whose length or prefix no other has; with every_digest those are hashed too, for their
    own sake.  row tells equal rows apart.
    """
    clean = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("clean"))
    measured = clean.select("doc_id", "clean", F.octet_length("clean").cast("long").alias("length"), F.xxhash64(F.substring("clean", 1, PREFIX)).alias("prefix"))
    sizes = table(measured.groupBy("length", "prefix").agg(F.count("*").alias("rows")), "exact-sizes")
    groups = table(surviving(sizes), "exact-survivors")
    bits = ROW_BITS
    while bits < min(MOST_BITS, groups.count() * BITS_EACH):
        bits *= 2
    part, at = F.floor(_slot(bits) / ROW_BITS).cast("long"), _slot(bits) % ROW_BITS
    seen = measured.withColumn("part", part).join(F.broadcast(bitmap_of(groups, bits)), "part", "left")
    again = F.lit(True) if every_digest else _bit(at)
    rows = seen.select(F.monotonically_increasing_id().alias("row"), "doc_id", "length", "prefix", _bit(at).alias("again"), F.when(again, F.sha2("clean", 256)).alias("digest"))
    return table(rows, "exact-rows")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every_digest: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest for every row of docs.

    Of equal texts the row with the smallest id stays, and keep_id is its id; null ids come
    last, and of rows with that id one stays.  A null text is an empty one, which equals
    every other empty one and no blank one.  A text is read whole, however long.  digest is
    as refined says.  Columns other than the id and text are not read.  An empty table
    gives no rows.
    """
    rows = refined(docs, id_col, text_col, every_digest)
    alone = rows.where("NOT again").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    met = rows.where("again")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("first")
    groups = met.groupBy("length", "prefix", "digest").agg(F.count("*").alias("group_size"), first)
    groups = table(groups.select("digest", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")), "exact-groups")
    hot = F.col("group_size") * MOST_HOT > rows.count()
    few = groups.where(hot)
    joined = met.join(F.broadcast(few), "digest").unionByName(met.join(F.broadcast(few.select("digest")), "digest", "left_anti").join(groups.where(~hot), "digest"))
    return alone.unionByName(joined.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_groups keeps, with all their columns.

    Rows to drop are known by id and digest; of rows that agree in both, any one stays.
    Texts are shuffled only for such repeated rows.
    """
    own, gone_id, gone_digest = unused(docs, "own_digest"), unused(docs, "gone_id"), unused(docs, "gone_digest")
    groups = table(exact_groups(docs, id_col, text_col).where("group_size > 1").select("doc_id", "keep_id", "kept", "digest"), "exact-judged")
    gone = groups.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_digest)).distinct()
    hashed = docs.withColumn(own, F.sha2(normalised(F.col(text_col)), 256))
    left = hashed.join(gone, F.col(id_col).eqNullSafe(F.col(gone_id)) & (F.col(own) == F.col(gone_digest)), "left_anti")
    if not groups.where(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).isEmpty():
        left = left.dropDuplicates([id_col, own])
    return left.drop(own)


#: DuckDB SQL for the digest query's rows.
SQL = r"""
WITH clean AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS clean FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, sha256(clean) AS text_sha256
FROM clean WINDOW same AS (PARTITION BY clean)
"""
