"""Token-id files: ids of whole texts in ascending id order, entropy-coded for parallel reading.

Documents are range-partitioned and sorted by id.  A task tokenizes its range and writes
files of at most about ``FILE_BYTES``, made of segments of about ``SEGMENT`` ids.  A
segment holds its documents' ids and lengths, one frequency table over all its token ids,
and independent rANS blocks of ``BLOCK`` ids that share it, each with checkpoints and
checksums.  The manifest names units of about ``UNIT`` ids: a segment's place in its file
and consecutive documents of it.  Units are read by different tasks, each from the last
checkpoint before its first id.  Files are named for the attempt that wrote them; only
those of successful attempts are in the manifest.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm import rans
from tidelake.llm.shared import CACHES, give_back, make_dir, open_fs, product, table, text_batches

#: Ids, and documents, of a segment; ids of a block and of a unit of reading; bytes of a file.
SEGMENT, SEGMENT_DOCS = 1 << 22, 1 << 17
BLOCK = 1 << 20
UNIT = 1 << 21
FILE_BYTES = 256 << 20
#: Most tasks that units are dealt to.
MOST_TASKS = 20_000
MEMO = 1_200_000
BATCH_BYTES = 2 << 20
#: Words encoded in one call of the library.
TOGETHER = 200
#: Bytes of the longest piece that is remembered.
LONGEST = 256
_HEAD = struct.Struct("<4sQQQQQQ")
_MAGIC = b"TOKS"


#: Classes of bytes: letters, digits, other ASCII punctuation, apostrophes, spaces, other white space, parts of
#: characters beyond ASCII.  0, control characters, is next to no cut.
_LETTER, _DIGIT, _SIGN, _QUOTE, _SPACE, _BREAK, _WIDE = range(1, 8)
#: What is done between two bytes: a cut; or a cut after no white space, after a letter, or after a single break.
_CUT, _UNLESS_SPACE, _IF_LETTER, _IF_SINGLE = range(1, 5)


def _class_of(byte: int) -> int:
    if byte >= 0x80:
        return _WIDE
    c = chr(byte)
    if c.isalnum():
        return _LETTER if c.isalpha() else _DIGIT
    return _SPACE if c == " " else _BREAK if c in "\t\n\r" else _QUOTE if c == "'" else _SIGN if c.isprintable() else 0


def _between(a: int, b: int) -> int:
    """What is done between bytes of two classes, where the pattern of byte-level tokenizers ends a match whatever is around."""
    if not a or not b:
        return 0
    if a == _WIDE:
        return _UNLESS_SPACE if b in (_SPACE, _BREAK) else _IF_LETTER if b in (_DIGIT, _SIGN, _QUOTE) else 0
    if b in (_SPACE, _BREAK):
        return 0 if a in (_SPACE, _BREAK) else _CUT
    if a == _BREAK:
        return 0 if b == _WIDE else _IF_SINGLE
    if a in (_LETTER, _DIGIT):
        return 0 if b in (a, _WIDE) else _CUT
    return _CUT if a == _SIGN and b in (_LETTER, _DIGIT) else 0


_CLASS = bytes(map(_class_of, range(256)))
_ACTION = bytes(_between(i >> 3, i & 7) if i < 64 else 0 for i in range(256))
#: White space beyond ASCII, in UTF-8, and the first bytes of two-byte characters that are letters but for two.
_SPACES = np.array([int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])
_LETTERS, _NO_LETTERS = np.array([0xC3, 0xC4, 0xC5, 0xD0, 0xD1]), np.array([0xC397, 0xC3B7])


def _pieces(data: np.ndarray, starts: np.ndarray, whole: list[tuple[int, int]]) -> np.ndarray:
    """Where pieces of some joined texts begin: at starts, and wherever a byte-level tokenizer is sure to cut.

    A piece alone has the ids that it has in its text.  A run of white space stays with what follows it, as
    the pattern looks ahead there; only a single break is a piece.  Spans in whole are not cut.
    """
    kind = np.frombuffer(data.tobytes().translate(_CLASS), np.uint8)
    act = np.frombuffer(bytearray(((kind[:-1] << 3) | kind[1:]).tobytes().translate(_ACTION)), np.uint8)
    for a, b in whole:
        act[a : b - 1] = 0
    act[starts[(starts > 0) & (starts < len(data))] - 1] = _CUT
    at = np.flatnonzero(act) + 1
    todo = act[at - 1]
    keep = todo == _CUT
    some = np.flatnonzero((todo == _UNLESS_SPACE) | (todo == _IF_LETTER))
    two = (data[at[some] - 2].astype(np.int64) << 8) | data[at[some] - 1]
    three = (data[at[some] - 3].astype(np.int64) << 16) | two
    letter = np.isin(two >> 8, _LETTERS) & ~np.isin(two, _NO_LETTERS)
    keep[some] = np.where(todo[some] == _IF_LETTER, letter, ~(np.isin(two, _SPACES) | np.isin(three, _SPACES)))
    some = np.flatnonzero(todo == _IF_SINGLE)
    before = kind[np.maximum(at[some] - 2, 0)]
    keep[some] = (at[some] > 1) & (before >= _LETTER) & (before <= _QUOTE)
    return np.concatenate(([0], at[keep]))


def _gather(ids: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids of given places and lengths, joined, and where each begins, with the end."""
    ends = np.zeros(len(n) + 1, np.int32)
    np.cumsum(n, out=ends[1:])
    place = np.repeat(start - ends[:-1], n)
    place += np.arange(len(place), dtype=np.int32)
    return ids[place], ends


class _Memo:
    """Ids of pieces: an index of names, and where their ids lie in one array."""

    def __init__(self, kind: np.dtype) -> None:
        self.index: dict[bytes, int] = {}
        self.ids, self.start, self.size = np.zeros(0, kind), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def find(self, names: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.get, names, repeat(-1)), np.int32, len(names))

    def add(self, names: list[bytes], ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        self.index.update(zip(names, range(len(self.start), len(self.start) + len(names))))
        self.start = np.concatenate([self.start, (start + len(self.ids)).astype(np.int32)])
        self.size = np.concatenate([self.size, size.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])


class Tokenizer:
    """Ids of whole texts by the tokenizers library, with a bounded memo of pieces.

    A byte-level BPE without normalizer cuts a text by its pattern and encodes what lies between
    alone.  Texts are cut in many of these places (``_pieces``), as words meet different signs and line breaks;
    a batch's different pieces are found by Arrow, encoded by the library once and remembered.
    Other tokenizers, texts with an added token's string and very long pieces are
    encoded whole.  With plain, special tokens' strings are ordinary text.
    """

    def __init__(self, path: str, memo: int = MEMO, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library, self.most = Library.from_file(path), memo
        self.library.encode_special_tokens = plain
        made = json.loads(self.library.to_str())
        split = made.get("pre_tokenizer") or {}
        self.byte_level = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not made.get("normalizer") and not made.get("post_processor")
        self.added = [t["content"] for t in made.get("added_tokens") or [] if not (plain and t["special"])]
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.known, self.before = _Memo(self.kind), _Memo(self.kind)
        self.spaced, self.broken = np.zeros(self.size, bool), np.zeros(self.size, bool)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            self.spaced[i], self.broken[i] = token.startswith("Ġ"), token == "Ċ"

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learned(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of some different pieces, and each one's place and number among them.

        Many are encoded at a time: those that begin with a space are told apart by it, those
        without white space by line breaks that are put between them.
        """
        spaced, solid, odd = [], [], []
        for i, p in enumerate(pieces):
            if p[0] == " " and len(p) > 1 and not p[1].isspace() and not p[-1].isspace():
                spaced.append(i)
            else:
                (solid if p.split() == [p] else odd).append(i)
        start, size, found, held = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), [], 0
        for own, between, marks, first in ((spaced, "", self.spaced, 0), (solid, "\n", self.broken, 1)):
            groups = [own[a : a + TOGETHER] for a in range(0, len(own), TOGETHER)]
            for group, ids in zip(groups, self._whole([between.join([pieces[i] for i in g]) for g in groups])):
                at = np.flatnonzero(marks[ids])
                if len(at) != len(group) - first:
                    odd += group
                    continue
                begin = np.concatenate(([0], at + 1)) if first else at
                start[group], size[group] = held + begin, np.append(at[1 - first :], len(ids)) - begin
                found.append(ids)
                held += len(ids)
        for i, ids in zip(odd, self._whole([pieces[i] for i in odd])):
            start[i], size[i] = held, len(ids)
            found.append(ids)
            held += len(ids)
        return np.concatenate([np.zeros(0, self.kind), *found]), start, size

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each of some different words after a space, not remembered; they have no white space at their ends."""
        ids, start, size = self._learned([" " + w for w in words])
        return [ids[a : a + n].tobytes() for a, n in zip(start.tolist(), size.tolist())]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, little-endian."""
        if not self.byte_level:
            return [ids.tobytes() for ids in self._whole(texts.to_pylist() if isinstance(texts, pa.Array) else texts)]
        if len(self.known.index) > self.most // 2:  # pieces that the next generation doesn't meet go
            self.before, self.known = self.known, _Memo(self.kind)
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if not len(texts) or at[0] == at[-1]:
            return [b""] * len(texts)
        data, at = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]
        marked = np.zeros(len(texts), bool)
        for token in self.added:
            marked |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        marked = np.flatnonzero(marked)
        cuts = _pieces(data, at[:-1], list(zip(at[marked].tolist(), at[marked + 1].tolist())))
        first = np.searchsorted(cuts, at)
        # each different piece is looked up once; its ids are then gathered for all places
        pieces = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(data))), pa.py_buffer(data)]).dictionary_encode()
        code, names = pieces.indices.to_numpy(), pieces.dictionary
        alone = pc.greater(pc.binary_length(names), LONGEST).to_numpy(zero_copy_only=False).copy()
        alone[code[first[marked]]] = True
        ids, start, size = self._remembered(names.to_pylist(), alone)
        ids, ends = _gather(ids, start, size)
        ids, ends = _gather(ids, ends[code], size[code])
        return [ids[a:b].tobytes() for a, b in pairwise(ends[first].tolist())]

    def _remembered(self, names: list[bytes], alone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids that hold those of different pieces, and their places and numbers; what is not known is learned, what is alone not kept."""
        known = self.known
        at = known.find(names)
        gaps = np.flatnonzero((at < 0) & ~alone)
        missing = [names[i] for i in gaps.tolist()]
        old = self.before.find(missing)
        again = old[old >= 0]
        ids, ends = _gather(self.before.ids, self.before.start[again], self.before.size[again])
        known.add([missing[i] for i in np.flatnonzero(old >= 0).tolist()], ids, ends[:-1], self.before.size[again])
        new = [missing[i] for i in np.flatnonzero(old < 0).tolist()]
        known.add(new, *self._learned([w.decode() for w in new]))
        at[gaps] = known.find(missing)
        if not alone.any():
            return known.ids, known.start[at], known.size[at]
        start, size = np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
        start[~alone], size[~alone] = known.start[at[~alone]], known.size[at[~alone]]
        whole = self._whole([names[i].decode() for i in np.flatnonzero(alone).tolist()])
        size[alone] = list(map(len, whole))
        start[alone] = len(known.ids) + np.cumsum(size[alone]) - size[alone]
        return np.concatenate([known.ids, *whole]), start, size


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer for each worker process and file; other operators' tasks drop it."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


CACHES.append(_loaded.clear)


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, size: int) -> bytes:
    """A segment: head; packed ids, null flags and lengths; frequency table; block sizes; blocks."""
    freq = rans.Frequencies.of_counts(np.bincount(ids, minlength=size))
    blocks = [rans.encode(ids[a : a + BLOCK], freq) for a in range(0, len(ids), BLOCK)]
    null = np.array([d is None for d in doc_ids], np.uint8)
    docs = zlib.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + null.tobytes())
    lens = zlib.compress(np.array(lengths, "<u8").tobytes())
    freqs = zlib.compress(freq.freq.astype("<u4").tobytes())
    sizes = np.array([len(b) for b in blocks], "<u8").tobytes()
    head = _HEAD.pack(_MAGIC, len(doc_ids), len(ids), len(docs), len(lens), len(freqs), len(blocks))
    return b"".join([head, docs, lens, freqs, sizes, *blocks])


def _read_head(stream) -> tuple[list[int | None], np.ndarray, rans.Frequencies, list[int]] | None:
    """Doc ids, lengths, frequencies and block sizes of the segment a stream stands at; None at the end."""
    head = stream.read(_HEAD.size)
    if not head:
        return None
    magic, n, _, a, b, c, blocks = _HEAD.unpack(head)
    if magic != _MAGIC:
        raise ValueError("not a token file")
    docs, lens, freqs = zlib.decompress(stream.read(a)), zlib.decompress(stream.read(b)), zlib.decompress(stream.read(c))
    ids, null = np.frombuffer(docs, "<i8", n), np.frombuffer(docs, np.uint8, n, 8 * n)
    sizes = np.frombuffer(stream.read(8 * blocks), "<u8").tolist()
    return [None if x else d for d, x in zip(ids.tolist(), null)], np.frombuffer(lens, "<u8").astype(np.int64), rans.Frequencies(np.frombuffer(freqs, "<u4")), sizes


def read_segments(stream) -> Iterator[tuple[list[int | None], np.ndarray, Iterator[np.ndarray]]]:
    """(doc ids, lengths, decoded blocks) of each segment; blocks must be taken before the next."""
    while found := _read_head(stream):
        docs, lengths, freq, sizes = found
        yield docs, lengths, (rans.decode(stream.read(s), freq) for s in sizes)


def read_unit(stream, offset: int, first: int, last: int) -> tuple[list[int | None], np.ndarray, Iterator[np.ndarray]]:
    """(doc ids, lengths, decoded ids in pieces) of documents first to last (end open) of the segment at an offset."""
    stream.seek(offset)
    docs, lengths, freq, sizes = _read_head(stream)
    ends = np.cumsum(lengths)
    a, b = int(ends[first] - lengths[first]), int(ends[last - 1])
    base = stream.tell()
    places = np.cumsum([0, *sizes])

    def pieces() -> Iterator[np.ndarray]:
        for k in range(a // BLOCK, -(-b // BLOCK)):
            stream.seek(base + int(places[k]))
            yield rans.decode_span(stream.read(sizes[k]), freq, max(a - k * BLOCK, 0), min(b - k * BLOCK, BLOCK))

    return docs[first:last], lengths[first:last], pieces()


def units_of(lengths: list[int], size: int) -> list[tuple[int, int, int]]:
    """(first document, last document (end open), ids) of consecutive runs of about ``size`` ids."""
    ends = np.cumsum(lengths)
    cuts = np.flatnonzero(np.diff((ends - 1) // size)) + 1
    edges = [0, *cuts.tolist(), len(lengths)]
    return [(a, b, int(ends[b - 1] - (ends[a - 1] if a else 0))) for a, b in pairwise(edges)]


def _slices(rows: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``size`` bytes of text."""
    ends = np.cumsum(pc.binary_length(rows["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        held = int(ends[start - 1]) if start else 0
        stop = min(int(np.searchsorted(ends, held + size)) + 1, len(ends))
        yield rows.slice(start, stop - start)
        start = stop


def _in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text range-partitioned by id and sorted.

    Rows of an id are in the order of a hash of their texts, and equal ones of their places
    in docs, along which ranges are cut too: no id and no group of equal rows is one task's.
    """
    keyed = docs.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    return keyed.repartitionByRange("doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash", "row").drop("hash", "row")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = BATCH_BYTES) -> DataFrame:
    """Writes the files below path and returns their manifest: part, unit, file, offset, first, last, n_tokens.

    Ids must be integers; nulls come first.  Rows with equal ids are in the order of a hash
    of their texts; equal rows are written as often as they are there.  Null texts are
    empty.  A very long text is tokenized whole.  Parts, and units of a part, follow the
    order of ids.  An empty table gives no files.
    """
    make_dir(docs.sparkSession, path)
    text_batches(docs.sparkSession)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok = tokenizer(tokenizer_path)
        end = np.array([end_id], tok.kind).tobytes()
        part = TaskContext.get().partitionId()
        fs, where = open_fs(path)
        out, name = None, ""
        doc_ids, lengths, held, n = [], [], [], 0
        units = []

        def flush() -> None:
            nonlocal out, name
            if out is not None and out.tell() >= FILE_BYTES:
                out.close()
                out = None
            if out is None:
                name = f"part-{part:06d}-{uuid.uuid4().hex}.tok"
                out = fs.open_output_stream(f"{where}/{name}")
            ids = np.frombuffer(b"".join(held), tok.kind).astype(np.uint32)
            held.clear()
            units.extend((part, len(units) + i, name, out.tell(), a, b, m) for i, (a, b, m) in enumerate(units_of(lengths, UNIT)))
            out.write(pack_segment(doc_ids, lengths, ids, tok.size))
            doc_ids.clear()
            lengths.clear()

        try:
            for rows in batches:
                for some in _slices(rows, slice_bytes):
                    for d, ids in zip(some["doc_id"].to_pylist(), tok.encode(some["text"])):
                        ids += end
                        doc_ids.append(d)
                        lengths.append(len(ids) // tok.kind.itemsize)
                        held.append(ids)
                        n += lengths[-1]
                        if n >= SEGMENT or len(lengths) >= SEGMENT_DOCS:
                            flush()
                            n = 0
            if doc_ids:
                flush()
        finally:
            if out is not None:
                out.close()
        give_back(keep_caches=True)
        names = ["part", "unit", "file", "offset", "first", "last", "n_tokens"]
        if units:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*units)], names)

    rows = _in_order(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    return table(rows.mapInArrow(written, "part long, unit long, file string, offset long, first long, last long, n_tokens long"), "tokens-manifest")


def _starts(manifest: DataFrame) -> DataFrame:
    """manifest with start, the ids before each unit: within its part, and of the parts before, a row a part."""
    past = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    parts = parts.select("part", past(Window.orderBy("part")).alias("before"))
    own = manifest.withColumn("within", past(Window.partitionBy("part").orderBy("unit")))
    return own.join(parts, "part").withColumn("start", F.col("before") + F.col("within"))


def _crcs(lengths: np.ndarray, pieces: Iterator[np.ndarray]) -> np.ndarray:
    """CRC-32 of each document's ids as little-endian 32-bit integers."""
    crcs = np.zeros(len(lengths), np.int64)
    i, left, crc = 0, int(lengths[0]), 0
    for piece in pieces:
        data, at = np.ascontiguousarray(piece, "<u4").data.cast("B"), 0
        while at < len(data):
            take = min(left * 4, len(data) - at)
            crc = zlib.crc32(data[at : at + take], crc)
            at += take
            left -= take // 4
            if not left:
                crcs[i], crc = crc, 0
                i += 1
                left = int(lengths[i]) if i < len(lengths) else 0
    return crcs


def read_tokens(manifest: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files.

    Units are dealt to tasks evenly, so several tasks read one file; a block at a time is
    in memory.
    """
    placed = _starts(manifest).select("part", "unit", "file", "offset", "first", "last", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, where = open_fs(path)
        for pdf in batches:
            for name, offset, first, last, start in zip(pdf["file"], pdf["offset"], pdf["first"], pdf["last"], pdf["start"]):
                with fs.open_input_file(f"{where}/{name}") as stream:
                    doc_ids, lengths, pieces = read_unit(stream, offset, first, last)
                    crcs = _crcs(lengths, pieces)
                ends = start + np.cumsum(lengths)
                yield pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "start": ends - lengths, "n_tokens": lengths, "ids_crc32": crcs})
        give_back(keep_caches=True)

    tasks = min(MOST_TASKS, max(1, manifest.count()))
    return placed.repartition(tasks, "part", "unit").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, slice_bytes: int = BATCH_BYTES) -> DataFrame:
    """Token files of all docs below path, and what is read back from them: doc_id, start, n_tokens, ids_crc32.

    path: the files' folder, which stays; a fresh one in the shared folder if not given.
    slice_bytes: bytes of text that are cut and looked up at once; more take less time
    and more memory of a worker.
    Nulls, repeated rows and long texts are as write_tokens says; other columns of docs are
    not returned.  An empty table gives no files and no rows.
    """
    path = path or product(docs.sparkSession, "token-files")
    return read_tokens(write_tokens(docs, path, tokenizer_path, end_id, id_col, text_col, slice_bytes), path)
