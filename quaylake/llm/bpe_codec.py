"""Operator 1: byte-level BPE encoding and decoding by automaton and backtracking.

The vocabulary's byte strings, read as Latin-1, form one Aho-Corasick automaton, which finds
all tokens starting at every byte of a pre-token in one pass.  The encoder then walks from
left to right: it takes the longest token that starts here and is *compatible* with the token
before it, and steps back to the next shorter one where the walk gets stuck.

Two adjacent tokens are compatible when merging their joined bytes by rank gives exactly these
two tokens.  A sequence whose neighbours are all compatible is the result of the merges: the
first merge over an edge would have to happen in the pair alone as well.  The converse holds
for the same reason, so the walk finds exactly the library's encoding.  Each prefix has one
encoding, so a byte position that failed once is never tried again, and the time is linear in
the text.  Compatibility is memoised by the pair of token ids.

Empty or null text: no tokens.  Bytes decode by joining the tokens' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import PieceCache, map_batches
from quaylake.llm.pretokens import compiled, cut, uncut

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_WINDOW = 4096
_MEMO_LIMIT = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())}


class Codec:
    """Encoder and decoder of one vocabulary; `pattern` cuts a text into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_limit: int = _MEMO_LIMIT):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.length = [0] * (max(self.token) + 1)
        for rank, token in self.token.items():
            self.length[rank] = len(token)
        self.longest = max(self.length)
        self.pattern = compiled(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.memo: dict[tuple[int, int], bool] = {}
        self.memo_limit = memo_limit
        self.by_cut = PieceCache(self._pack_cuts)
        self.by_pretoken = PieceCache(lambda pieces: [self._packed(p.encode()) for p in pieces])

    def merge(self, data: bytes) -> list[int]:
        """Reference merges of a short byte string: lowest rank first, leftmost on ties."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave an edge between the two tokens (left -1: none)."""
        known = self.memo.get((left, right))
        if known is None:
            if left < 0:
                known = self.merge(self.token[right]) == [right]
            else:
                known = self.merge(self.token[left] + self.token[right]) == [left, right]
            if len(self.memo) >= self.memo_limit:
                self.memo.clear()
            self.memo[left, right] = known
        return known

    def _starting(self, text: str) -> list[list[int]]:
        """For each position the tokens that start there, shortest first."""
        found: list[list[int]] = [[] for _ in text]
        length = self.length
        for end, rank in self.automaton.iter(text):
            found[end - length[rank] + 1].append(rank)
        return found

    def encode_pretoken(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None or not data:
            return [] if whole is None else [whole]
        text, size, length = data.decode("latin-1"), len(data), self.length
        starts = self._starting(text) if size <= _WINDOW else _Windows(self, text)
        known = self.memo
        out: list[int] = []
        tried: list[int] = []       # for each token of out, its place among those starting there
        stuck: set[int] = set()
        at, before = 0, -1
        options = starts[0]
        choice = len(options)
        while at < size:
            while choice:
                choice -= 1
                token = options[choice]
                after = at + length[token]
                if after not in stuck:
                    fits = known.get((before, token))
                    if fits or fits is None and self.compatible(before, token):
                        out.append(token)
                        tried.append(choice)
                        at, before = after, token
                        options = starts[at] if at < size else ()
                        choice = len(options)
                        break
            else:
                stuck.add(at)
                at -= length[out.pop()]
                choice = tried.pop()
                before = out[-1] if out else -1
                options = starts[at]
        return out

    def _packed(self, data: bytes) -> bytes:
        ids = self.encode_pretoken(data)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _pack_cuts(self, pieces: list[str]) -> list[bytes]:
        split = [self.pattern.findall(uncut(p)) for p in pieces]
        packed = self.by_pretoken.table({p for pretokens in split for p in pretokens})
        return [b"".join([packed[p] for p in pretokens]) for pretokens in split]

    def encode_packed(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        pieces, cache = cut(text), self.by_cut
        if pieces is None:
            pieces, cache = self.pattern.findall(text), self.by_pretoken
        return b"".join(map(cache.table(pieces).__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Windows:
    """What `_starting` gives, for a long pre-token: found window by window, the last few kept."""

    def __init__(self, codec: Codec, text: str):
        self.codec, self.text = codec, text
        self.windows: dict[int, list[list[int]]] = {}

    def __getitem__(self, at: int) -> list[int]:
        number, place = divmod(at, _WINDOW)
        window = self.windows.get(number)
        if window is None:
            first = number * _WINDOW
            window = self.codec._starting(self.text[first:first + _WINDOW + self.codec.longest])
            if len(self.windows) > 2:
                del self.windows[min(self.windows)]
            self.windows[number] = window
        return window[place]


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, built once in a worker process."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(load_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode_documents(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text (null: no ids)."""
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def make():
        coder = codec(path, pattern)
        return lambda batch: {"doc_id": batch.column(0),
                              "ids": [np.frombuffer(coder.encode_packed(t), "<u4").astype("i4")
                                      for t in batch.column(1).to_pylist()]}

    return map_batches(texts, "doc_id long, ids array<int>", make)


def round_trip_digests(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Per document: the number of ids, the digest of the ids, and that of the bytes which
    decoding the ids gives."""
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def make():
        coder = codec(path, pattern)

        def step(batch):
            counts, ids_digests, text_digests = [], [], []
            for text in batch.column(1):
                packed = coder.encode_packed(text.as_py())
                decoded = coder.decode(np.frombuffer(packed, "<u4").tolist())
                counts.append(len(packed) // 4)
                ids_digests.append(hashlib.sha256(packed).hexdigest())
                text_digests.append(hashlib.sha256(decoded).hexdigest())
            return {"doc_id": batch.column(0), "n_tokens": counts,
                    "ids_sha256": ids_digests, "decoded_sha256": text_digests}

        return step

    return map_batches(texts, SCHEMA, make)
