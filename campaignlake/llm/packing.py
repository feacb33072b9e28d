"""Packing by concatenate-and-cut.

Documents are tokenised once into a table that keeps, for every document, its
partition and its first position inside the partition.  A prefix sum over the
partition totals turns this into a global position; fixed windows over the
global positions are the sequences.  A document's pieces follow from its own
position alone, so the second pass needs no shuffle.  Whole sequences are put
together where their tokens lie; only fragments at the edges of a task's rows
(boundary records) are shuffled.

Order: partitions in their numbering, rows in their order inside a partition.
Defined cases: null text is empty (one token, the end mark); a document of any
length is cut at every window edge; repeated rows are packed as often as they
occur; an empty table gives no piece; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MAX_ONE_ROW_PER_PARTITION, bounded_broadcast, written

LENGTH = 2048
END_ID = 1
CACHED_WORDS = 400_000
CACHED_LENGTH = 40
BATCH_BYTES = 16 << 20
ENCODED_BYTES = 16 << 20  # of texts encoded at once

# A space is an edge of the tokenizer's word pattern when neither neighbour is
# white space; a text without a space beside other white space is split plainly.
_UNEVEN = ("  | \n|\n |[\t\r\x0b\x0c\x1c-\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
           "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
_EDGE = re.compile(r"(?<=\S) (?=\S)")
_MARKS = ".,;:!?%&#$*|"


def byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte: printable
    Latin-1 stands for itself, the others follow from 256 on in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordEncoder(dict):
    """Token ids of a text as bytes.  Keeps the ids of " " + word by word: two
    generations of at most ``CACHED_WORDS`` short words; the older goes when the
    newer is full, words used meanwhile having moved on."""

    def __init__(self, path: str, dtype: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.dtype, self.code = dtype, {"<u2": "H", "<u4": "I"}[dtype]  # tasks run on little-endian machines
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # a word of letters is one piece for a plain byte-level tokenizer: its merges alone are needed
        self.model = self.tokenizer.model if "ByteLevel" in str(self.tokenizer.pre_tokenizer) and not (
            self.tokenizer.normalizer) and type(self.tokenizer.model).__name__ == "BPE" else None
        self.letters = byte_letters()

    def ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters_only(self, word: str) -> bytes:
        written = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        return array(self.code, [t.id for t in self.model.tokenize(self.letters[32] + written)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            out = self.letters_only(word) if self.model and word.isalpha() else self.ids(" " + word)
        return self.keep(word, out)

    def keep(self, key: str, out: bytes) -> bytes:
        if len(key) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[key] = out
        return out

    def marks(self, text: str) -> bytes:
        key = " " + text  # words hold no space
        out = dict.get(self, key)
        return self.keep(key, self.ids(text)) if out is None else out

    def words(self, words: pa.Array) -> list[bytes]:
        """Ids of " " + word for distinct words.  Letters followed by marks: the
        word pattern cuts between the two, so the letters are encoded once."""
        if self.model is None:
            return [self[w] for w in listed(words)]
        cut = pc.utf8_rtrim(words, _MARKS).dictionary_encode()
        letters = [w if w.isalpha() else None for w in listed(cut.dictionary)]
        found = [w and self[w] for w in letters]
        return [self[w] if found[k] is None else found[k] if len(letters[k]) == len(w) else found[k] + self.marks(w[len(letters[k]):])
                for w, k in zip(listed(words), listed(cut.indices), strict=True)]

    def texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls) in one array, each text's followed by
        ``end_id``, and the places where texts begin (and the last one ends).

        Words are told apart by a dictionary of the batch: every distinct word
        is encoded once, then ids are gathered by word number."""
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        words = pc.split_pattern(texts, " ")
        if pc.any(uneven).as_py():
            split = pa.array([_EDGE.split(t) for t in texts.filter(uneven).to_pylist()], words.type)
            at = np.cumsum(uneven.to_numpy(zero_copy_only=False)) - 1 + len(texts)
            words = pa.concat_arrays([words, split]).take(pc.if_else(uneven, pa.array(at), pa.array(np.arange(len(texts)))))
        edges = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))]).astype(np.int64)
        flat = words.flatten()
        known, first = flat.dictionary_encode(), flat.take(pa.array(edges[:-1])).dictionary_encode()
        # a text's first word has no space before it; the last number is the end mark
        parts = [*self.words(known.dictionary), *map(self.ids, listed(first.dictionary)),
                 np.array([end_id], self.dtype).tobytes()]
        codes = known.indices.to_numpy().astype(np.int64)
        codes[edges[:-1]] = first.indices.to_numpy().astype(np.int64) + len(known.dictionary)
        codes = np.insert(codes, edges[1:], len(parts) - 1)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(self.dtype).itemsize
        n = sizes[codes]
        upto = np.concatenate([[0], np.cumsum(n)])
        kind = np.int32 if upto[-1] < 1 << 31 else np.int64
        place = np.repeat(((np.cumsum(sizes) - sizes)[codes] - upto[:-1]).astype(kind), n)
        place += np.arange(upto[-1], dtype=kind)
        ids = np.frombuffer(b"".join(parts), self.dtype)[place]
        return ids, upto[edges + np.arange(len(edges))]

    def text(self, text: str) -> bytes:
        """Ids of one text, without an end mark."""
        return self.texts(pa.array([text]), 0)[0][:-1].tobytes()


def listed(a: pa.Array) -> list:
    """``a.to_pylist()`` without a scalar object per value (no nulls)."""
    return a.to_numpy(zero_copy_only=False).tolist()


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Stretches (first, past the last) of about ``most`` bytes, one text at least."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, part, start_in_part, doc_tokens, ids): the first pass, written.
    ``ids`` holds little-endian integers of two bytes, or of four where the
    vocabulary needs them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        wide = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) > 1 << 16
        encoder = WordEncoder(tokenizer_path, "<u4" if wide else "<u2")
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for lo, hi in slices(texts, ENCODED_BYTES):
                ids, edges = encoder.texts(texts.slice(lo, hi - lo), end_id)
                raw, width = ids.tobytes(), ids.itemsize
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.full(hi - lo, part, np.int32)), pa.array(at + edges[:-1]),
                     pa.array(np.diff(edges)),
                     pa.array([raw[s * width:e * width] for s, e in itertools.pairwise(edges.tolist())], pa.binary())],
                    ["doc_id", "part", "start_in_part", "doc_tokens", "ids"])
                at += int(edges[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, part int, start_in_part long, doc_tokens long, ids binary")
    return written(out, "tokens")


def pack(tokens: DataFrame, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """Pieces of ``tokens`` (see ``tokenize``): doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset and, unless ``with_ids`` is
    false, the piece's ids (two- or four-byte, as stored)."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    # one row per partition of the first pass
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = (tokens.join(bounded_broadcast(written(bases, "bases"), MAX_ONE_ROW_PER_PARTITION), "part")
              .select("doc_id", (F.col("base") + F.col("start_in_part")).alias("at"), "doc_tokens", "ids"))
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, raw, held = [], [], 0
            for k in range(batch.num_rows):
                at, n, ids = (batch.column(c)[k].as_py() for c in (1, 2, 3))
                held += len(ids)
                width = len(ids) // n
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4", copy=False)
                s = 0
                while s < n:
                    offset = (at + s) % length
                    e = min(n, s + length - offset)
                    rows.append((k, s, e - s, zlib.crc32(wide[s:e].data), n, (at + s) // length, offset))
                    if with_ids:
                        raw.append(ids[s * width:e * width])
                    s = e
                if held >= BATCH_BYTES or k + 1 == batch.num_rows:
                    cols = np.array(rows, np.int64).T
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(cols[0])), *(pa.array(c) for c in cols[1:]),
                         *([pa.array(raw, pa.binary())] if with_ids else [])], names)
                    rows, raw, held = [], [], 0

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + ", ids binary" * with_ids)
    return placed.mapInArrow(run, schema)


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences, ids as two- or
    four-byte integers.  All but the last are full; that one is padded with
    ``pad_id`` to ``length``, unless its size is a power of two.

    Rows of a task that follow one another are joined in place; fragments at
    the edges of a task's rows are grouped by sequence (at most ``length``
    tokens each)."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, size, held = None, 0, 0, []
        for batch in batches:
            out = []
            for seq, offset, n, ids in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if key == seq and offset == first + size:
                    size += n
                    held.append(ids)
                else:
                    if held:
                        out.append((key, first, size, b"".join(held)))
                    key, first, size, held = seq, offset, n, [ids]
            yield record(out)
        if held:
            yield record([(key, first, size, b"".join(held))])

    def record(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
            ["sequence_id", "offset", "length", "ids"])

    found = written(pieces.select("sequence_id", "offset", "length", "ids")
                    .mapInArrow(local, "sequence_id long, offset long, length long, ids binary"), "fragments")
    whole = found.where(F.col("length") == length).select("sequence_id", F.col("length").alias("n_tokens"), "ids")
    edges = (found.where(F.col("length") < length).groupBy("sequence_id")
             .agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("f"))
             .select("sequence_id", F.aggregate("f", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"),
                     F.aggregate("f", F.lit(b""), lambda b, x: F.concat(b, x["ids"])).alias("ids")))
    width = (F.octet_length("ids") / F.col("n_tokens")).cast("int")
    pad = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(length - F.col("n_tokens")).cast("int")
    one = F.when(width == 4, F.lit(int(pad_id).to_bytes(4, "little"))).otherwise(
        F.lit(int(pad_id).to_bytes(4, "little")[:2]))
    fill = F.unhex(F.repeat(F.hex(one), pad))
    return whole.union(edges.select("sequence_id", "n_tokens", F.concat("ids", fill).alias("ids")))
