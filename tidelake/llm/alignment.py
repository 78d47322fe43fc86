"""Alignment of two tokenizers' ids by union-find over overlapping tokens.

Tokens of both tokenizers are nodes; an A token and a B token whose byte ranges overlap are
an edge.  The graph's connected components are exactly the minimal groups: the spans between
byte offsets at which tokens of both end.  Within a component, members whose ranges end
together are linked, and links are counted over the corpus for each pair of ids.

A task aligns a block of texts (an Arrow batch, so bounded by bytes) and writes one row for
it: its documents, its different pairs with their counts, and which documents hold which.
Only a block's different pairs are shuffled, so a pair that is in every document is there
once a block.  Corpus counts come back to a block as its own pairs' counts.

Both tokenizers cut a text before a space between two words, so a word is tokenized and
aligned once and remembered; texts with other white space beside a space are aligned whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import CACHES, give_back, table, text_batches
from tidelake.llm.tokens import TOGETHER, Tokenizer

#: Words remembered by a worker; characters of text aligned at a time.
MEMO = 500_000
SLICE = 1 << 20
_LOW = (1 << 32) - 1


def union_find(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node of each node's component in a graph of n nodes and edges (u, v).

    All edges are taken at once: roots hook to the least root they meet, paths are halved
    until flat, and edges within a component are left out of the next round.
    """
    parent = np.arange(n)
    while len(u):
        a, b = parent[u], parent[v]
        live = a != b
        u, v, a, b = u[live], v[live], a[live], b[live]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (A token, B token) between two cuts of one byte string; at most as many as tokens."""
    starts = np.concatenate([[0], a_ends[:-1]])
    first, last = np.searchsorted(b_ends, starts, "right"), np.searchsorted(b_ends, a_ends, "left")
    n = last - first + 1
    return np.repeat(np.arange(len(a_ends)), n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def components(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number, from 0 in byte order, of each A token and of each B token."""
    u, v = overlaps(a_ends, b_ends)
    root = union_find(len(a_ends) + len(b_ends), u, v + len(a_ends))
    _, number = np.unique(root, return_inverse=True)  # a component's least node is its first A token
    return number[: len(a_ends)], number[len(a_ends) :]


def links(a_ends: np.ndarray, b_ends: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of the members of each component whose ranges end together."""
    at = np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1) if len(b_ends) else np.zeros(0, np.int64)
    found = np.flatnonzero((b_ends[at] == a_ends) & (b_group[at] == a_group))
    return found, at[found]


def byte_level_alphabet() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write bytes as."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Aligned words and texts of two tokenizers, with a bounded memo of words.

    An entry is the text of the groups (``a1,a2|b1;a3|b2``) and 64-bit numbers as bytes:
    one below zero that holds both token counts, then a pair of ids for each link.
    """

    def __init__(self, a_path: str, b_path: str, memo: int = MEMO) -> None:
        import sentencepiece

        self.a, self.b, self.most = Tokenizer(a_path, plain=True), sentencepiece.SentencePieceProcessor(model_file=b_path), memo
        codes = byte_level_alphabet()
        self.a_bytes = [b""] * self.a.size
        for token, i in self.a.library.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(codes[c] for c in token) if all(c in codes for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in xs], np.int64) for xs in (self.a_bytes, self.b_bytes))
        self.b_spaced = np.array([p.startswith("▁") for p in pieces])
        # words are cut apart only if no piece goes on over a space
        self.by_word = self.a.byte_level and not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_names = [[f"{i}{mark}" for mark in ",|;"] for i in range(len(self.a_bytes))]
        self.b_names = [[f"{i}{mark}" for mark in ",|;"] for i in range(len(self.b_bytes))]
        self.known: dict[str, tuple[str, bytes]] = {}
        self.before: dict[str, tuple[str, bytes]] = {}

    def _aligned(self, texts: list[str], a_ids: list[np.ndarray], b_ids: list[np.ndarray]) -> list[tuple[str, bytes] | None]:
        """Entries of texts, which begin with a space; None where a tokenizer does not give a text's bytes back."""
        a_of, b_of = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        a_all, b_all = np.concatenate(a_ids) if a_ids else np.zeros(0, np.int64), np.concatenate(b_ids) if b_ids else np.zeros(0, np.int64)
        whole = "".join(texts).encode("utf-8", "surrogatepass")
        if b"".join(map(a_of, a_all.tolist())) != whole or b"".join(map(b_of, b_all.tolist())) != whole:
            if len(texts) == 1:
                return [None]
            return [self._aligned([t], [x], [y])[0] for t, x, y in zip(texts, a_ids, b_ids)]
        a_ends, b_ends = np.cumsum(self.a_size[a_all]), np.cumsum(self.b_size[b_all])
        a_group, b_group = components(a_ends, b_ends)
        a_link, b_link = links(a_ends, b_ends, a_group, b_group)
        a_cut, b_cut = np.cumsum([0, *map(len, a_ids)]), np.cumsum([0, *map(len, b_ids)])
        # a group's A tokens, a bar, its B tokens; marks follow their token
        order = np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")
        a_mark = np.concatenate([a_group[1:] != a_group[:-1], [True]]).astype(int)
        b_mark = np.concatenate([b_group[1:] != b_group[:-1], [True]]).astype(int) * 2
        names = [self.a_names[i][m] for i, m in zip(a_all.tolist(), a_mark.tolist())] + [self.b_names[i][m] for i, m in zip(b_all.tolist(), b_mark.tolist())]
        names = [names[i] for i in order.tolist()]
        pairs = (a_all[a_link].astype(np.int64) << 32) | b_all[b_link]
        pair_cut = np.searchsorted(a_link, a_cut).tolist()
        heads = ~((np.diff(a_cut) << 32) | np.diff(b_cut))
        cut = (a_cut + b_cut).tolist()
        return [("".join(names[cut[i] : cut[i + 1]])[:-1], heads[i].tobytes() + pairs[pair_cut[i] : pair_cut[i + 1]].tobytes()) for i in range(len(texts))]

    def _ids_of_words(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [np.frombuffer(x, self.a.kind).astype(np.int64) for x in self.a.words(words)]
        b: list[np.ndarray] = []
        for i in range(0, len(words), TOGETHER):
            some = words[i : i + TOGETHER]
            ids = np.array(self.b.encode(" ".join(some), num_threads=1), np.int64)
            at = np.flatnonzero(self.b_spaced[ids])
            b += np.split(ids, at[1:]) if len(at) == len(some) else [np.array(self.b.encode(w, num_threads=1), np.int64) for w in some]
        return a, b

    def _whole(self, text: str) -> tuple[str, bytes] | None:
        a = np.array(self.a.library.encode(" " + text, add_special_tokens=False).ids, np.int64)
        return self._aligned([" " + text], [a], [np.array(self.b.encode(text, num_threads=1), np.int64)])[0]

    def texts(self, texts: list[str]) -> Iterator[tuple[str, np.ndarray] | None]:
        """Groups and numbers of each text; None for one that is empty or not given back by a tokenizer."""
        if len(self.known) > self.most // 2:
            self.before, self.known = self.known, {}
        known = self.known
        cut = [t.split(" ") if self.by_word and t and t == t.strip() else None for t in texts]
        odd = {i for i, words in enumerate(cut) if words is None or any(not w or w.strip() != w or "▁" in w for w in words if w not in known)}
        fresh = []
        for w in {w for i, words in enumerate(cut) if i not in odd for w in words if w not in known}:
            if w in self.before:
                known[w] = self.before[w]
            else:
                fresh.append(w)
        wrong = set()
        for i in range(0, len(fresh), 20_000):
            some = fresh[i : i + 20_000]
            for w, entry in zip(some, self._aligned([" " + w for w in some], *self._ids_of_words(some))):
                if entry is None:
                    wrong.add(w)
                else:
                    known[w] = entry
        for i, t in enumerate(texts):
            if not t:
                yield None
            elif i in odd or (wrong and not wrong.isdisjoint(cut[i])):
                entry = self._whole(t)
                yield entry and (entry[0], np.frombuffer(entry[1], np.int64))
            else:
                groups, numbers = zip(*map(known.__getitem__, cut[i]))
                yield ";".join(groups), np.frombuffer(b"".join(numbers), np.int64)


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner for each worker process and pair of files; other operators' tasks drop it."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Aligner(a_path, b_path)
    return _loaded[a_path, b_path]


CACHES.append(_loaded.clear)


def _slices(texts: list[str]) -> Iterator[list[str]]:
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= SLICE:
            yield texts[start : i + 1]
            start, held = i + 1, 0
    yield texts[start:]


_BLOCK = """block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, sha array<string>,
    size array<int>, pair array<int>, times array<int>, a array<int>, b array<int>, n array<long>"""


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table with a row for each block of documents, as the module says.

    size: different pairs of each document; pair: their places in a, b and n, and times:
    how often the document links them, for one document after the other.
    """
    text_batches(docs.sparkSession)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        made, part = aligner(a_path, b_path), TaskContext.get().partitionId()
        for number, pdf in enumerate(batches):
            n_a, n_b, n_groups, shas, pairs, times = [], [], [], [], [], []
            for some in _slices(pdf["text"].tolist()):
                for found in made.texts(some):
                    groups, numbers = found or ("", np.zeros(0, np.int64))
                    heads = ~numbers[numbers < 0]
                    n_a.append(int((heads >> 32).sum()))
                    n_b.append(int((heads & _LOW).sum()))
                    n_groups.append(groups.count("|"))
                    shas.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                    pair, n = np.unique(numbers[numbers >= 0], return_counts=True)
                    pairs.append(pair)
                    times.append(n)
            size = np.array([len(p) for p in pairs], np.int32)
            every, n = np.concatenate([np.zeros(0, np.int64), *pairs]), np.concatenate([np.zeros(0, np.int64), *times])
            own, place = np.unique(every, return_inverse=True)
            total = np.zeros(len(own), np.int64)
            np.add.at(total, place, n)
            ids = [None if d is None else int(d) for d in pdf["doc_id"]]
            row = [(part << 33) + number, ids, n_a, n_b, n_groups, shas, size, place.astype(np.int32), n.astype(np.int32), (own >> 32).astype(np.int32), (own & _LOW).astype(np.int32), total]
            yield pd.DataFrame([row], columns=["block", "doc_id", "n_a", "n_b", "n_groups", "sha", "size", "pair", "times", "a", "b", "n"])
        give_back(keep_caches=True)

    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return table(rows.mapInPandas(blocks, _BLOCK), "aligned-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """a, b, count of every linked pair of ids in the corpus, and whether no other A id is linked to the B id more often."""
    own = blocks.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    counts = table(own.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))  # a row for each B id at most
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of docs.

    A text that is null or empty, or whose bytes a tokenizer does not give back, has no
    tokens: zeros and an empty digest.  Special tokens' strings are plain text.  A text is
    aligned whole, however long.  Repeated rows, and null ids, are each returned and
    counted.  Of pairs that tie for a B id's highest count each is best.  Other columns are
    not read.  An empty table gives no rows.
    """
    blocks = aligned_blocks(docs, a_path, b_path, id_col, text_col)
    own = blocks.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("block", "at", "p.a", "p.b")
    resolved = own.join(pair_counts(blocks), ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("found"))
    met = blocks.drop("a", "b", "n").join(resolved, "block", "left")

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                found = row.found if row.found is not None else []
                count, best = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
                at = np.fromiter((f["at"] for f in found), np.int64, len(found))
                count[at] = np.fromiter((f["count"] for f in found), np.int64, len(found))
                best[at] = np.fromiter((f["best"] for f in found), np.int64, len(found))
                times, pair = np.asarray(row.times, np.int64), np.asarray(row.pair, np.int64)
                ends = np.concatenate([[0], np.cumsum(np.asarray(row.size, np.int64))])
                sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[ends]) for x in (times, times * best[pair], times * count[pair])]
                ids = pd.array([None if d is None or d != d else int(d) for d in row.doc_id], "Int64")
                yield pd.DataFrame({"doc_id": ids, "n_a": row.n_a, "n_b": row.n_b, "n_groups": row.n_groups, "n_links": sums[0], "n_best": sums[1], "count_sum": sums[2], "groups_sha256": row.sha})
        give_back()

    return met.mapInPandas(judged, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
