"""Benchmark decontamination with an FM-index per shard of training texts.

A test phrase is 13 consecutive words of a benchmark item (a shorter item is one
phrase).  Each task cuts its texts into shards of a bounded number of words, indexes a
shard's words with a suffix-ordered, wavelet-backed FM-index, searches all phrases
backwards, locates the occurrences by sampled suffix positions and merges them to
removal spans.  Words outside the benchmark's vocabulary can be in no occurrence: they
share one symbol that no phrase holds, and a run of them is indexed as one.

Results depend on a text alone, so equal texts of a shard are indexed once, and nothing
is shuffled.  The phrases are sent to the tasks packed, in blocks of at most
``block_bytes`` of benchmark text.  A benchmark of several blocks takes one written pass
over the documents for each, with one block in the driver and the workers at a time;
the passes' spans are merged by row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.fm_index import FmIndex
from tidelake.llm.shared import give_back, table, text_batches
from tidelake.llm.words import words

WINDOW = 13
SHARD_WORDS = 400_000
BLOCK_BYTES = 8 << 20
#: Words of a benchmark item that stay together; a longer one goes in pieces that overlap.
PIECE_WORDS = 1 << 20
_LOCATE = 1 << 20
_SEARCH = 1 << 18
_OTHER = 1
RESULT = "n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"


@dataclass
class Phrases:
    """Test phrases, packed: places in a sequence of symbols of the benchmark's vocabulary.

    Symbol i + 2 is the i-th line of ``vocabulary``.  ``starts`` has the places of the
    different phrases of each length; phrase j of a length belongs to the items
    ``owners[length][ends[length][j] : ends[length][j + 1]]``, numbers into ``names``.
    """

    vocabulary: bytes
    sequence: np.ndarray
    starts: dict[int, np.ndarray]
    ends: dict[int, np.ndarray]
    owners: dict[int, np.ndarray]
    names: list[str]

    @cached_property
    def symbols(self) -> dict[bytes, int]:
        """Words to symbols, unpacked once in each worker."""
        return {w: i + 2 for i, w in enumerate(self.vocabulary.split(b"\n") if self.vocabulary else [])}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "symbols"}

    def items(self, length: int, phrases: np.ndarray) -> np.ndarray:
        """Numbers of the items that phrases of a length belong to."""
        lo, n = self.ends[length][phrases], self.ends[length][phrases + 1] - self.ends[length][phrases]
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.unique(self.owners[length][at])


def phrases_of(items: Iterable[tuple[str, str | None]], window: int = WINDOW) -> Phrases:
    """Phrases of (item id, text) pairs; items without words have none."""
    symbols: dict[bytes, int] = {}
    number: dict[str, int] = {}
    parts: list[np.ndarray] = []
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0
    for item, text in items:
        own = words(text)
        if not own:
            continue
        parts.append(np.fromiter((symbols.setdefault(w, len(symbols) + 2) for w in own), np.int32, len(own)))
        k = min(window, len(own))
        n = len(own) - k + 1
        found.setdefault(k, []).append((np.arange(size, size + n), np.full(n, number.setdefault(item, len(number)))))
        size += len(own)
    sequence = np.concatenate([*parts, np.array([], np.int32)])
    starts, ends, owners = {}, {}, {}
    for k, some in found.items():
        at, who = (np.concatenate(x) for x in zip(*some))
        phrase = np.lib.stride_tricks.sliding_window_view(sequence, k)[at]
        keys = np.ascontiguousarray(phrase).view(f"V{4 * k}").ravel()
        _, first, same = np.unique(keys, return_index=True, return_inverse=True)
        pairs = np.unique(same.astype(np.int64) * (len(number) + 1) + who)
        which = pairs // (len(number) + 1)
        starts[k] = at[first].astype(np.int64)
        ends[k] = np.searchsorted(which, np.arange(len(first) + 1))
        owners[k] = (pairs % (len(number) + 1)).astype(np.int32)
    return Phrases(b"\n".join(symbols), sequence, starts, ends, owners, list(number))


def occurrences(parts: list[np.ndarray], known: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """(part, start, length, phrase) of every phrase in the symbol sequences of one shard."""
    gap = np.array([_OTHER], np.int32)
    text = np.concatenate([x for p in parts for x in (p, gap)])
    starts = np.cumsum([0] + [len(p) + 1 for p in parts])
    kept = np.flatnonzero((text != _OTHER) | np.append(True, text[:-1] != _OTHER))
    if not (text[kept] != _OTHER).any():
        return
    index = FmIndex(text[kept])
    for length, places in known.starts.items():
        for block in range(0, len(places), _SEARCH):
            lo, hi = index.search_at(known.sequence, places[block : block + _SEARCH], length)
            n = hi - lo
            live = np.flatnonzero(n)
            done = 0
            while done < len(live):  # as many phrases at a time as have about _LOCATE places
                some = live[done : done + max(1, int(np.searchsorted(np.cumsum(n[live[done:]]), _LOCATE)))]
                rows = np.repeat(lo[some], n[some]) + np.arange(n[some].sum()) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
                at = kept[index.locate(rows)]
                part = np.searchsorted(starts, at, "right") - 1
                yield part, at - starts[part], length, np.repeat(some + block, n[some])
                done += len(some)


def judge(texts: list[str | None], known: Phrases, shard_words: int = SHARD_WORDS) -> list[tuple[int, int, list[str], list[tuple[int, int]]]]:
    """For each text: words, hit words, items with an occurring phrase, merged spans."""
    longest = max(known.starts, default=1)
    slot: dict[str, int] = {}
    which = [slot.setdefault(t or "", len(slot)) for t in texts]
    lengths, hits = [], [[] for _ in slot]
    shard: list[tuple[int, int, np.ndarray]] = []
    held = 0

    def search() -> None:
        owner, offset = np.array([s for s, _, _ in shard]), np.array([o for _, o, _ in shard])
        for part, start, length, phrase in occurrences([p for _, _, p in shard], known):
            order = np.argsort(owner[part], kind="stable")
            who, begin, phrase = owner[part][order], (start + offset[part])[order], phrase[order]
            cuts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(who))):
                hits[who[a]].append((begin[a:b], length, known.items(length, np.unique(phrase[a:b]))))
        shard.clear()

    get = known.symbols.get
    for text, i in slot.items():
        own = words(text)
        symbols = np.fromiter((get(w, _OTHER) for w in own), np.int32, len(own))
        lengths.append(len(own))
        for offset in range(0, len(own), shard_words):  # a longer text goes in pieces that overlap
            piece = symbols[offset : offset + shard_words + longest - 1]
            shard.append((i, offset, piece))
            held += len(piece)
            if held >= shard_words:
                search()
                held = 0
    if shard:
        search()
    found = []
    for n, own in zip(lengths, hits):
        if not own:
            found.append((n, 0, [], []))
            continue
        begin = np.concatenate([b for b, _, _ in own])
        end = np.concatenate([b + k for b, k, _ in own])
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], np.maximum.accumulate(end[order])
        cut = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
        begin, end = begin[cut], np.append(end[cut[1:] - 1], end[-1])
        items = sorted(known.names[x] for x in np.unique(np.concatenate([x for _, _, x in own])))
        found.append((n, int((end - begin).sum()), items, list(zip(begin.tolist(), end.tolist()))))
    return [found[i] for i in which]


def _judged(text: str, sent, shard_words: int):
    @F.pandas_udf(RESULT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = judge(list(texts), sent.value, shard_words)
            spans = [[{"start": a, "end": b} for a, b in r[3]] for r in rows]
            yield pd.DataFrame({"n_words": [r[0] for r in rows], "n_hit": [r[1] for r in rows], "items": [r[2] for r in rows], "spans": spans})
        give_back()

    return judged(F.col(text))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items of at most ``block_bytes`` of text at a time, or one piece of an item; rows that repeat count once.

    Items reach the driver partition by partition, and a partition has about a block.
    """
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")).where("text IS NOT NULL").distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if total > block_bytes:
        rows = rows.repartition(-(-total // block_bytes), F.xxhash64("item", "text"))
    held, size = [], 0
    for r in rows.toLocalIterator():
        for text in _pieces(r["text"]):
            n = len(text.encode("utf-8", "surrogatepass"))
            if held and size + n > block_bytes:
                yield held
                held, size = [], 0
            held.append((r["item"], text))
            size += n
    if held:
        yield held


def _pieces(text: str) -> Iterator[str]:
    own = words(text) if len(text) > PIECE_WORDS else ()
    if len(own) <= PIECE_WORDS:
        yield text
        return
    for a in range(0, len(own) - WINDOW + 1, PIECE_WORDS):
        yield b" ".join(own[a : a + PIECE_WORDS + WINDOW - 1]).decode("utf-8", "surrogatepass")


def _merged(column: str):
    """Overlapping and touching spans of a column made one."""

    @F.pandas_udf("array<struct<start: long, end: long>>")
    def merged(lists: pd.Series) -> pd.Series:
        out = []
        for spans in lists:
            joined: list[dict[str, int]] = []
            for a, b in sorted((s["start"], s["end"]) for s in spans):
                if joined and a <= joined[-1]["end"]:
                    joined[-1]["end"] = max(b, joined[-1]["end"])
                else:
                    joined.append({"start": a, "end": b})
            out.append(joined)
        return pd.Series(out)

    return merged(F.col(column))


def _in_passes(docs: DataFrame, text_col: str, name: str, shard_words: int, blocks: Iterator[list[tuple[str, str]]], spark: SparkSession) -> DataFrame:
    """One written pass for each block over rows that have got a number; then their merged results."""
    numbered = table(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("n")), "contamination-rows")
    found = None
    for k, block in enumerate(blocks):
        sent = spark.sparkContext.broadcast(phrases_of(block))
        c = numbered.select("n", _judged("text", sent, shard_words).alias("c"))
        part = table((c if k == 0 else c.where("c.n_hit > 0")).select("n", "c.*"), "contamination-pass")  # the first has every row
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    sums = found.groupBy("n").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans")
    )
    sums = sums.withColumn("spans", F.when(F.size("spans") > 0, _merged("spans")).otherwise(F.col("spans")))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return numbered.join(sums.select("n", F.struct("n_words", length.alias("n_hit"), "items", "spans").alias(name)), "n").select("row.*", name)


def with_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", benchmark_text_col: str = "text", name: str = "contamination", shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with a struct column ``name``: n_words, n_hit, items, spans (word positions, end open).

    Null texts have no words; null and repeated item ids are allowed (null counts as the
    empty id).  A very long text is indexed in overlapping pieces of ``shard_words``.
    Repeated rows are each judged, and a column of docs that is called ``name`` is
    replaced.  An empty benchmark hits nothing; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text_batches(spark)
    blocks = _blocks(benchmark, item_col, benchmark_text_col, block_bytes)
    first = next(blocks, [])
    second = next(blocks, None)
    if second is None:
        return docs.withColumn(name, _judged(text_col, spark.sparkContext.broadcast(phrases_of(first)), shard_words))
    return _in_passes(docs.drop(name) if name != text_col else docs, text_col, name, shard_words, (b for some in ([first, second], blocks) for b in some), spark)


def is_contaminated(n_hit, n_words):
    """At least a twentieth of the words, and at least one, are inside a phrase."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs.

    Other columns are not read; nulls, repeats, long texts and empty tables are as
    with_contamination says.
    """
    found = with_contamination(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark)
    c = F.col("contamination")
    return found.select(
        "doc_id", c.n_words.alias("n_words"), c.n_hit.alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), is_contaminated(c.n_hit, c.n_words).alias("contaminated"),
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs that are not contaminated, with their own columns alone."""
    packed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    c = F.col("contamination")
    return with_contamination(packed, benchmark).where(~is_contaminated(c.n_hit, c.n_words)).select("row.*")


#: DuckDB SQL for the rows of contamination().
SQL = r"""
WITH item AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), phrase AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS p
    FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM item WHERE len(w) > 0)
), doc AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w FROM documents
), placed AS (
    SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS p
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM phrase) AS ks WHERE len(w) >= k)
), hit AS (
    SELECT doc_id, i, phrase.k AS k, item_id FROM placed JOIN phrase ON placed.p = phrase.p AND placed.k = phrase.k
), counted AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN counted ON doc.doc_id = counted.doc_id LEFT JOIN named ON doc.doc_id = named.doc_id
"""
