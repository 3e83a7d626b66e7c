"""Operator 6: harmonic packing of documents into token sequences.

A piece of r tokens belongs to class k = capacity // r: k such pieces fit one sequence, r lies
in (capacity / (k + 1), capacity / k].  Every worker fills the bins of each class on its own,
exactly k pieces a bin, so no shuffle and no common state is needed and the open bins are
bounded by the number of classes.  Documents may be cut: a piece that would leave more than
`slack` of its class's slot empty first gives off a piece that fills a slot of the next class
exactly.  Full sequences' worth of a document become sequences of their own.

At the end of its rows a worker joins the pieces of its unfilled bins and cuts that row of
tokens at the capacity; the last stretch is cut at powers of two, whose sequences need no
padding.

A document is its token ids (null or empty text: none) and the separator id, so it always has
one token at least.  Repeated rows are packed one by one.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quaylake.llm.pretokens import byte_of_character

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
CAPACITY = 4096
_ID = "<u4"
_ID_BYTES = 4
_FLUSH = 20_000
_SLICE = 16 << 20               # bytes of texts encoded at once (a longer text: alone)
#: A word of letters and the ASCII marks that close it; the apostrophe opens contractions and
#: is no closing mark.
_WORD_AND_MARKS = (r"^(?P<word>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}]+)"
                   "(?P<marks>[" + re.escape("".join(c for c in string.punctuation if c != "'")) + r"]*)\z")


class WordEncoder:
    """Ids of whole texts by the tokenizers library, a slice of texts at a time.

    Holds for byte-level tokenizers that drop white space, split at it and between letters and
    other marks, and lower-case (checked on loading): then a chunk between white space has the
    ids it has alone.  A slice's texts are cut into chunks and each distinct one is encoded
    once.  A chunk of letters up to U+017F (without U+0130, whose lower case has two
    characters) and closing marks is a lower-cased word, given to the library's merges
    directly, and its marks; there normal forms change nothing.  Any other chunk, and every
    distinct run of marks, is given to the library as it stands."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # tasks run side by side
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.characters = {byte: character for character, byte in byte_of_character().items()}
        probes = ["a b", "a\n b", "don't, x9 <|endoftext|> 'll", "", " É ",
                  "Été, Straße;\t(ÑANDÚ) ĲŒ... #a#!", "İ ª ŉ ſ İstanbul, a.b. x"]
        for probe, ids in zip(probes, self.encoded(pa.array(probes))):
            if ids.tolist() != self.tokenizer.encode(probe, add_special_tokens=False).ids:
                raise ValueError("chunks between white space are not independent")

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, _ID) for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of lower-cased words one after the other, and how many each has."""
        ids, lengths = array("I"), []
        for word in words:
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(self.characters)
            found = self.merges(word)
            ids.extend([token.id for token in found])
            lengths.append(len(found))
        return np.array(ids, _ID), np.array(lengths, np.int64)

    def encoded(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (no nulls) as little-endian unsigned 32-bit integers."""
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        parts = pc.extract_regex(chunks.dictionary, _WORD_AND_MARKS)
        plain = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        words = pc.utf8_lower(parts.field(0).filter(plain)).dictionary_encode()
        marks = parts.field(1).filter(plain).dictionary_encode()
        others = chunks.dictionary.filter(~plain).to_pylist()
        word_ids, word_lengths = self._words(words.dictionary.to_pylist())
        rest = self._library([*others, *marks.dictionary.to_pylist()])
        # Entries: the words, the other chunks, the runs of marks, and the empty one.
        ids = np.concatenate([word_ids, *rest])
        lengths = np.concatenate([word_lengths, [len(r) for r in rest], [0]]).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        n_words, n_others = len(words.dictionary), len(others)
        of_chunk = np.full((len(plain), 2), len(lengths) - 1)
        of_chunk[plain, 0] = words.indices.to_numpy()
        of_chunk[plain, 1] = marks.indices.to_numpy() + n_words + n_others
        of_chunk[~plain, 0] = n_words + np.arange(n_others)
        # The entries of the texts in order, and from them the ids.
        entries = of_chunk[chunks.indices.to_numpy()]
        taken = lengths[entries]
        first = np.concatenate([[0], np.cumsum(taken.sum(axis=1))])
        at = np.cumsum(taken.ravel()) - taken.ravel()
        flat = ids[np.repeat(starts[entries.ravel()] - at, taken.ravel()) + np.arange(first[-1])]
        edges = first[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [flat[a:b] for a, b in zip(edges[:-1], edges[1:])]


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def slices(batch: pa.RecordBatch, size: int = _SLICE) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows whose texts (column 1) hold `size` bytes, or one row that holds more."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def cut_lengths(tokens: int, capacity: int, slack: float) -> list[tuple[int, int]]:
    """(class, length) of the pieces of a document, in order; the lengths add up to `tokens`."""
    pieces = [(1, capacity)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = capacity // rest
        slot = capacity // k
        if slot - rest <= slack * slot:
            pieces.append((k, rest))
            break
        pieces.append((k + 1, capacity // (k + 1)))
        rest -= capacity // (k + 1)
    return pieces


class Packer:
    """One worker's bins.  Rows: doc_id, start, length, crc, doc_tokens, sequence, offset."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, slack: float = 0.02):
        self.sequence, self.capacity, self.slack = first_sequence, capacity, slack
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            length = len(ids) // _ID_BYTES
            self.rows.append((doc_id, start, length, zlib.crc32(ids), doc_tokens,
                              self.sequence, offset))
            offset += length
        self.sequence += 1

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, start = len(ids) // _ID_BYTES, 0
        for k, length in cut_lengths(total, self.capacity, self.slack):
            piece = ids[start * _ID_BYTES:(start + length) * _ID_BYTES]
            bin_ = self.open[k]
            bin_.append((doc_id, start, piece, total))
            start += length
            if len(bin_) == k:
                self._close(self.open.pop(k))

    def finish(self) -> None:
        """Pack what the unfilled bins hold without gaps."""
        left = [piece for k in sorted(self.open) for piece in self.open[k]]
        self.open.clear()
        remaining = sum(len(ids) for _, _, ids, _ in left) // _ID_BYTES
        sequence: list[tuple] = []
        room = 0
        for doc_id, start, ids, total in left:
            while ids:
                if not room:
                    if sequence:
                        self._close(sequence)
                    sequence = []
                    room = (self.capacity if remaining >= self.capacity
                            else 1 << (remaining.bit_length() - 1))
                take = min(room, len(ids) // _ID_BYTES)
                sequence.append((doc_id, start, ids[:take * _ID_BYTES], total))
                ids, start = ids[take * _ID_BYTES:], start + take
                room -= take
                remaining -= take
        if sequence:
            self._close(sequence)

    def take_rows(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * 7
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            names=[c.split()[0] for c in SCHEMA.split(", ")])


def pack(df: DataFrame, path: str, separator: int = 2, capacity: int = CAPACITY,
         slack: float = 0.02, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    Sequence ids are unique; a worker counts up from its partition number times 2^32."""
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = separator.to_bytes(_ID_BYTES, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = packer = None
        for batch in batches:
            if encoder is None and batch.num_rows:
                encoder = word_encoder(path)
                packer = Packer(TaskContext.get().partitionId() << 32, capacity, slack)
            for part in slices(batch):
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encoded(part.column(1))):
                    packer.add(doc_id, ids.tobytes() + end)
                    if len(packer.rows) >= _FLUSH:
                        yield packer.take_rows()
        if packer is not None:
            packer.finish()
            yield packer.take_rows()

    return texts.mapInArrow(run, SCHEMA)
