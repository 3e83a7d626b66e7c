"""Operator 5: token counts by the whole-token shortcut.

Once for a vocabulary (offline, per worker) every vocabulary string that is one pre-token is
encoded alone; those that come back as exactly one token form the whole-token set.  A text's
pre-tokens found in the set count one without any merging; only the rest is given to the
merges.  Counts of repeated pieces of text are memoised.  The added special token is found in
a text as the library does by default: it is cut out first and counts one.

Empty or null text: no tokens, no bytes.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from quaylake.llm.common import PieceCache, map_batches
from quaylake.llm.pretokens import byte_of_character, compiled, cut, uncut

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Counter:
    """Counts the tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # tasks run side by side
        self.tokenizer = Tokenizer.from_file(path)
        if (self.tokenizer.normalizer is not None
                or not isinstance(self.tokenizer.pre_tokenizer, ByteLevel)):
            raise ValueError("the whole-token shortcut needs a plain byte-level BPE")
        self.pattern = compiled(pattern)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.whole = self._whole_tokens(set(added))
        self.by_cut = PieceCache(self._count_cuts)
        self.by_pretoken = PieceCache(self._merged)

    def _whole_tokens(self, added: set[str]) -> frozenset[str]:
        """Vocabulary strings proven to encode alone, as one pre-token, as one token."""
        to_byte, strings = byte_of_character(), []
        for token in self.tokenizer.get_vocab(with_added_tokens=False):
            if token not in added and all(c in to_byte for c in token):
                try:
                    strings.append(bytes(to_byte[c] for c in token).decode())
                except UnicodeDecodeError:
                    continue        # part of a character: never a whole pre-token
        strings = [s for s in strings if self.pattern.findall(s) == [s]]
        encoded = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return frozenset(s for s, e in zip(strings, encoded) if len(e.ids) == 1)

    def _merged(self, pretokens: list[str]) -> list[int]:
        """Token counts of pre-tokens: one for whole tokens, the merges' for the rest."""
        counts = {p: 1 for p in pretokens if p in self.whole}
        rest = [p for p in pretokens if p not in counts]
        counts.update(zip(rest, (len(e.ids) for e in self.tokenizer.encode_batch_fast(
            rest, add_special_tokens=False))))
        return [counts[p] for p in pretokens]

    def _count_cuts(self, pieces: list[str]) -> list[int]:
        split = [self.pattern.findall(uncut(p)) for p in pieces]
        rest = list({p for pretokens in split for p in pretokens if p not in self.whole})
        merged = dict(zip(rest, self._merged(rest)))
        return [sum(merged.get(p, 1) for p in pretokens) for pretokens in split]

    def _plain(self, text: str) -> int:
        pieces, cache = cut(text), self.by_cut
        if pieces is None:
            pieces, cache = self.pattern.findall(text), self.by_pretoken
        return sum(map(cache.table(pieces).__getitem__, pieces))

    def count(self, text: str) -> int:
        if self.added is None:
            return self._plain(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


_COUNTERS: dict[tuple[str, str], Counter] = {}


def counter(path: str, pattern: str) -> Counter:
    if (path, pattern) not in _COUNTERS:
        _COUNTERS[path, pattern] = Counter(path, pattern)
    return _COUNTERS[path, pattern]


def token_counts(df: DataFrame, path: str, pattern: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: UTF-8 bytes, tokens, and whether the tokens exceed `limit`."""
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    texts = texts.withColumn("n_bytes", F.octet_length("text").cast("long"))

    def make():
        count = counter(path, pattern).count

        def step(batch):
            tokens = [count(t.as_py()) for t in batch.column(1)]
            return {"doc_id": batch.column(0), "n_bytes": batch.column(2), "n_tokens": tokens,
                    "over_limit": [n > limit for n in tokens]}

        return step

    return map_batches(texts, SCHEMA, make)
