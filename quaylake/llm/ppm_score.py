"""Operator 2: language-model scores by prediction by partial matching (PPM).

A text is a sequence of lines of words and one end; other white space is given, and without
`layout` the lines' number and numbers of words are, too.  The model predicts from the deepest context that knows what follows and escapes to shorter ones:

* a whole line: among the training lines (without `layout`, those of as many words).  What escapes is spelled:
* a word after the two words before it (`words_before`), also across lines: as often as the
  run of words occurs in training, among the runs without the last word.  What escapes is
  predicted after one word before, then none:
* a word by itself, byte by byte and closed by a terminator, first from the whole beginning of the word
  (up to `depth` bytes), a node of the byte trie of all training words, weighted by how often
  they occur.  A byte never seen there escapes
* to the last three bytes, then two, one and none, and at last to all symbols alike; there
  each edge of the trie counts once.  Symbols that a deeper context could have coded are
  excluded from the shorter ones.

Escapes are estimated from the training texts by leaving each event out once: lines by their
number of words, trie nodes by their numbers of occurrences and of symbols; short contexts use
t / 2n for n occurrences of t symbols.  The model is trained before, on all training texts, and
the code length of a document is the sum over its lines and its end.  A line's probability is
that of the line as known plus that of the escape and its words, so both ways count; a word's
adds the shorter contexts in the same way, with escapes by the count of the words before.

At scale: counts of words and lines are aggregated before the shuffle.  The vocabulary is
sorted and dealt in ranges, so the trie's nodes lie within one range, but for those on the path
to a range's first or last word: their counts (a path's length of nodes for each range) are
summed over the ranges and sent to all.  The short contexts are hashed to 2^15 nodes for each
order, which bounds what is sent by nodes times symbols.  Documents are written once in blocks
of neighbouring rows, bounded by rows and bytes whatever their ids; a block asks for each of
its distinct words and lines once, so a word or line in every document is asked once for each
block.  Questions go by ranges of hashes, one value for a block and range; the counts return in
the same order without the words.  Runs of words travel as sorted 64-bit hashes, each distinct
one once for a block.  Each step's answers are stored and its shuffles removed before the next,
and the longer runs are asked for after the shorter ones, so that what lies on disk at a time is
one step's messages beside the stored texts, words and answers.

Words are longest runs without ASCII white space, lower-cased A-Z; lines are parted by line
feeds and known by a 64-bit hash of their words.  Null or empty text: the end alone.  A null id
is in no held-out fold.  Without training texts every token is new: the base is log10(1) for
each, and PPM gives all symbols alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.llm import common

SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
TERMINATOR, END, START = 256, 257, 258
_SYMBOLS = 257                  # what can follow inside a word: bytes and the terminator
_HASHED = 1 << 15
_KEY = 512
_ESCAPES = 1 << 40              # keys from here on count escape events
ORDERS = 3
_SMOOTH = 0.1
_CLASSES = 128
_LN10 = float(np.log(10))


class Lines:
    """The words of all lines of some texts.  `word_line` and `line_text` number, for each word
    its line and for each line its text; lines without words are left out of `used`.  The
    distinct words (`dictionary`, of which `ids` has the words' places) are found when asked for."""

    def __init__(self, texts: pa.Array):
        # Lower-cased first: Arrow's cast of a slice keeps offsets that ascii_lower misreads.
        split = pc.split_pattern(pc.ascii_lower(texts).cast(pa.large_string()), "\n")
        sizes = split.value_lengths().to_numpy(zero_copy_only=False)
        self.line_text = np.repeat(np.arange(len(texts)), sizes)
        words = pc.ascii_split_whitespace(split.flatten())
        line = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy(zero_copy_only=False))
        flat = words.flatten()
        some = pc.greater(pc.binary_length(flat), 0)
        self.word_line = line[some.to_numpy(zero_copy_only=False)]
        self.words = flat.filter(some)
        self.word_text = self.line_text[self.word_line]
        self.length = np.bincount(self.word_line, minlength=len(self.line_text))
        self.used = np.flatnonzero(self.length)


    @cached_property
    def _coded(self) -> pa.DictionaryArray:
        return self.words.dictionary_encode()

    @property
    def dictionary(self) -> pa.Array:
        return self._coded.dictionary

    @cached_property
    def ids(self) -> np.ndarray:
        return self._coded.indices.to_numpy(zero_copy_only=False)

    @cached_property
    def word_hashes(self) -> np.ndarray:
        """Of every word, in their order."""
        return hashed(self.dictionary)[self.ids] if "_coded" in self.__dict__ else hashed(self.words)

    def runs(self, words_before: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 0 to `words_before` words: the places of the words that have so many before them
        in their text, across lines, and the hashes of the runs of words that end there."""
        run = own = self.word_hashes
        for before in range(words_before + 1):
            if before:
                run = np.concatenate([run[:1], run[:-1]]) * np.uint64(0x9E3779B97F4A7C15) + own
            run = (run ^ (run >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            run ^= run >> np.uint64(32)
            at = np.arange(before, len(own))
            at = at[self.word_text[at] == self.word_text[at - before]]
            yield at, run[at]

    def hashes(self) -> np.ndarray:
        """Of the used lines: the sum of their words' hashes, each stirred with its place."""
        if not len(self.used):
            return np.empty(0, np.uint64)
        begin = np.cumsum(self.length[self.used]) - self.length[self.used]
        place = (np.arange(len(self.words)) - np.repeat(begin, self.length[self.used])).astype(np.uint64)
        mixed = self.word_hashes + (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return np.add.reduceat(mixed, begin)

    def line_class(self) -> np.ndarray:
        """Of the used lines: their number of words, by powers of two from 64 on."""
        n = self.length[self.used]
        return np.where(n < 64, n, 58 + np.log2(np.maximum(n, 1)).astype(np.int64))


def line_key(line_hash: int, line_class: int) -> str:
    """A line's place in the table of words and lines; no word holds a line feed."""
    return f"\n{line_hash:016x}{line_class}"


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and each word's first byte and length."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8),
            offsets[:-1], np.diff(offsets))


_HASHED_BYTES = 64


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hashes, eight bytes of all words at a time; longer words than 64 bytes by xxHash."""
    data, first, length = _bytes_of(words)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))      # from each byte on
    found = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, min(int(length.max(initial=0)), _HASHED_BYTES), 8):
        some = np.flatnonzero(length > at)
        over = np.maximum(8 - (length[some] - at), 0).astype(np.uint64)
        part = (found[some] ^ (eight[first[some] + at] << (over * np.uint64(8)))) * np.uint64(0xFF51AFD7ED558CCD)
        part = (part ^ (part >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
        found[some] = part ^ (part >> np.uint64(29))
    for row in np.flatnonzero(length > _HASHED_BYTES).tolist():
        found[row] = xxhash.xxh64_intdigest(data[first[row]:first[row] + length[row]].tobytes())
    return found


def _sorted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes' first places in the order that sorts them all, and that order.  Plain
    numbers sort much faster than places: the place is put into the lowest bits, and where two
    hashes differ in no other bits the places are sorted."""
    bits = np.uint64(max(1, int(len(hashes) - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)) & low).astype(np.int64)
    found = hashes[order]
    if (found[1:] < found[:-1]).any():
        order = np.argsort(hashes, kind="stable")
        found = hashes[order]
    return np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])[:len(found)]), order


def _places(hashes: np.ndarray) -> np.ndarray:
    """The place of each hash among the sorted distinct ones."""
    first, order = _sorted(hashes)
    fresh, places = np.zeros(len(hashes), np.int64), np.empty(len(hashes), np.int64)
    fresh[first[1:]] = 1
    places[order] = np.cumsum(fresh)
    return places


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The range, of so many, that a hash lies in."""
    return ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


# --- short contexts -------------------------------------------------------------------------

def _nodes(one, two, three):
    """Nodes of the contexts of orders 0 to 3; the arguments are the last symbols, last first."""
    pair = (two * 0x9E37 + one * 0x85EB + 0x27D4)
    triple = (three * 0xC2B3 + two * 0x68E3 + one * 0x1B57 + 0x5BD1)
    return (0 * one, 1 + one, 1 + START + 1 + (pair ^ pair >> 9) % _HASHED,
            1 + START + 1 + _HASHED + (triple ^ triple >> 11) % _HASHED)


def context_counts(words: pa.Array, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, count) of the contexts' symbols: key = node * 512 + symbol.

    The words are sorted; of each, the edges from place `shared` on are new, so each edge of the
    trie counts once: as usual in PPM, a shorter context learns of a symbol only where the
    deeper one had not seen it."""
    data, first, length = _bytes_of(words)
    size = length + 2                                    # start, bytes, terminator
    begin = np.cumsum(size) - size
    symbols = np.empty(int(size.sum()), np.int64)
    symbols[begin] = START
    symbols[begin + size - 1] = TERMINATOR
    inside = np.ones(len(symbols), bool)
    inside[begin] = inside[begin + size - 1] = False
    taken = np.arange(int(length.sum())) + np.repeat(first - (np.cumsum(length) - length), length)
    symbols[inside] = data[taken]
    place = np.arange(len(symbols)) - np.repeat(begin, size)
    keys = []
    at = np.flatnonzero(place > np.repeat(shared, size))
    nodes = _nodes(symbols[at - 1], symbols[at - 2], symbols[at - 3])
    for order, node in enumerate(nodes):
        there = place[at] >= order
        keys.append((node * _KEY + symbols[at])[there])
    return np.unique(np.concatenate(keys), return_counts=True)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, where = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(where, weights, len(distinct)).astype(np.int64)


class ShortContexts:
    """The PPM model of orders 3 to 0."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.seen: dict[int, dict[int, int]] = {}
        for key, count in zip(keys.tolist(), counts.tolist()):
            self.seen.setdefault(key // _KEY, {})[key % _KEY] = count
        self.memo: dict[tuple[int, int, int, int], float] = {}

    def probability(self, before: list[int], symbol: int, excluded: set[int]) -> float:
        """Of a symbol after the symbols `before` (which begin with START)."""
        one, two, three = before[-1], before[-2] if len(before) > 1 else 0, (
            before[-3] if len(before) > 2 else 0)
        nodes = _nodes(one, two, three)
        p, out = 1.0, set(excluded)
        for order in range(min(ORDERS, len(before)), -1, -1):
            node = self.seen.get(nodes[order])
            if node is None:
                continue
            live = {s: c for s, c in node.items() if s not in out}
            if not live:
                continue
            total = sum(live.values())
            if symbol in live:
                return p * (2 * live[symbol] - 1) / (2 * total)
            p *= len(live) / (2 * total)
            out.update(live)
        return p / max(1, _SYMBOLS - len(out - {END}))

    def log_rest(self, word: bytes, at: int) -> float:
        """log10 of the word's symbols from place `at` on, without exclusions from the trie."""
        symbols = [START, *word, TERMINATOR]
        total = 0.0
        for place in range(at + 1, len(symbols)):
            before = symbols[max(0, place - ORDERS):place]
            key = (*before, symbols[place])
            found = self.memo.get(key)
            if found is None:
                if len(self.memo) > 400_000:
                    self.memo.clear()
                found = self.memo[key] = float(np.log10(self.probability(before, symbols[place], set())))
            total += found
        return total


# --- the trie of word beginnings ------------------------------------------------------------

_T_STATES, _N_STATES = 12, 48
_STATES = _T_STATES * _N_STATES


def _state(n: np.ndarray, t: np.ndarray) -> np.ndarray:
    """A node's class by its number of symbols and, in half powers of two, of occurrences."""
    n_class = np.floor(2 * np.log2(np.maximum(n, 1))).astype(np.int64)
    t_class = np.where(t <= 6, t, 5 + np.floor(np.log2(np.maximum(t, 1))).astype(np.int64) - 1)
    return (np.clip(t_class, 0, _T_STATES - 1).astype(np.int64) * _N_STATES
            + np.clip(n_class, 0, _N_STATES - 1))


def _events(seen: np.ndarray, n: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Escape events of symbols seen so often in nodes of n occurrences of t symbols."""
    once, more = (seen == 1) & (n > 1), seen > 1
    return np.stack([np.bincount(_state(n[more] - 1, t[more]), seen[more], _STATES),
                     np.bincount(_state(n[once] - 1, t[once] - 1), minlength=_STATES)], 1)


def learned_on_border(border: dict[bytes, dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `SortedTrie.learned`, of the nodes that ranges share, from their summed counts."""
    keys, events = [], np.zeros((_STATES, 2))
    for beginning, symbols in border.items():
        seen = np.array(list(symbols.values()), float)
        events += _events(seen, np.full(len(seen), seen.sum()), np.full(len(seen), len(seen)))
        before = [START, *beginning][-ORDERS:]
        nodes = _nodes(before[-1], before[-2] if len(before) > 1 else 0,
                       before[-3] if len(before) > 2 else 0)
        keys += [node * _KEY + symbol for node in nodes[:len(before) + 1] for symbol in symbols]
    return *np.unique(np.array(keys, np.int64), return_counts=True), events


def escape_table(events: np.ndarray) -> np.ndarray:
    """Escape probability by state: the share of new symbols, drawn towards t / 2n while the
    state was met seldom."""
    states = np.arange(_STATES)
    n, t = 2 ** (states % _N_STATES / 2), np.maximum(states // _N_STATES, 1)
    prior = np.clip(t / (2 * n), 1e-9, 0.5)
    return np.clip((events[:, 1] + 4 * prior) / (events.sum(1) + 4), 1e-9, 0.95)


class SortedTrie:
    """The trie of sorted words as runs of rows: at depth d the rows that share d bytes."""

    def __init__(self, words: pa.Array, counts: np.ndarray, depth: int):
        data, first, self.length = _bytes_of(words)
        self.words, self.counts, self.depth = words, counts, depth
        rows = len(counts)
        self.symbols = np.full((rows, depth), -1, np.int16)      # beyond the word: -1
        self.shared = np.zeros(rows, np.int64)                   # bytes shared with the row before
        same = np.arange(rows) > 0
        for d in range(depth):
            has = self.length > d
            self.symbols[has, d] = data[first[has] + d]
            self.symbols[self.length == d, d] = TERMINATOR
            same = same & has & np.concatenate([[False], has[:-1]])
            same[1:] &= self.symbols[1:, d] == self.symbols[:-1, d]
            self.shared += same

    def level(self, d: int):
        """Rows with a symbol at depth d; for each its node and its edge; both counted from 0."""
        rows = np.flatnonzero(self.length >= d)
        if d == 0:
            node = np.zeros(len(rows), np.int64)
        else:
            # Shorter words in between never part a node's rows: words that share d bytes are
            # neighbours, and the first of them is where the shared bytes fall below d.
            node = np.cumsum(self.shared[rows] < d) - 1
        fresh = self.shared[rows] < d + 1
        fresh[:1] = True
        return rows, node, np.cumsum(fresh) - 1

    def on_border(self) -> np.ndarray:
        """For each word the depth of its last node that lies on the way to the first or the
        last word, which other ranges may share."""
        deepest = np.zeros(len(self.counts), np.int64)
        for end in (0, len(self.counts) - 1):
            length = min(int(self.length[end]), self.depth - 1)
            same = self.symbols[:, :length] == self.symbols[end, :length]
            deepest = np.maximum(deepest, np.cumprod(same, axis=1).sum(1))
        return deepest

    def learned(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the nodes within this range: (key, count) of the short contexts, and the escape
        events by state.

        An escape event is a symbol of a node that is left out once: it was seen otherwise, or
        not, in the state of the node without it.  Rows: states; columns: old, new."""
        train, border = self.counts > 0, self.on_border()
        # A word's new edges: beyond what it shares with the training word before it.
        shared, rows = np.full(len(self.counts), self.depth), np.flatnonzero(train)
        if len(rows):
            shared[rows] = np.minimum.reduceat(self.shared[:rows[-1] + 1],
                                               np.concatenate([[0], rows[:-1] + 1]))
        keys, counts = context_counts(self.words.filter(pa.array(train)),
                                      np.maximum(shared, border + 1)[rows])
        events = np.zeros((_STATES, 2))
        for d in range(self.depth):
            rows, node, edge = self.level(d)
            if not len(rows):
                break
            seen = np.bincount(edge, self.counts[rows], edge[-1] + 1)
            edge_node, inside = np.zeros(edge[-1] + 1, np.int64), np.zeros(edge[-1] + 1, bool)
            edge_node[edge], inside[edge] = node, border[rows] < d
            n = np.bincount(edge_node, seen, node[-1] + 1)[edge_node]
            t = np.bincount(edge_node, seen > 0, node[-1] + 1)[edge_node]
            events += _events(seen[inside], n[inside], t[inside])
        return keys, counts, events

    def border(self) -> list[tuple[bytes, int, int]]:
        """(beginning, symbol, count) for all nodes on the way to the first and the last word."""
        found = {}
        for d in range(self.depth):
            rows, node, _ = self.level(d)
            for end in (0, len(self.counts) - 1):
                if self.length[end] < d:
                    continue
                beginning = bytes(self.symbols[end, :d].astype(np.uint8))
                members = rows[node == node[np.searchsorted(rows, end)]]
                sums = np.bincount(self.symbols[members, d], self.counts[members], TERMINATOR + 1)
                for symbol in np.flatnonzero(sums).tolist():
                    found[beginning, symbol] = int(sums[symbol])
        return [(b, s, n) for (b, s), n in found.items()]

    def scores(self, border: dict[bytes, dict[int, int]], escapes: np.ndarray,
               short: ShortContexts) -> np.ndarray:
        """log10 probability of every word."""
        total = np.zeros(len(self.counts))
        alive = np.ones(len(self.counts), bool)          # still on a path seen in training
        left: list[tuple[int, int, float, dict]] = []    # where a word left the trie
        for d in range(self.depth):
            rows, node, edge = self.level(d)
            if not len(rows):
                break
            edge_node = np.zeros(edge[-1] + 1, np.int64)
            edge_node[edge] = node
            edge_symbol = np.zeros(edge[-1] + 1, np.int64)
            edge_symbol[edge] = self.symbols[rows, d]
            seen = np.bincount(edge, self.counts[rows], edge[-1] + 1)
            extra_n = np.zeros(node[-1] + 1)
            extra_t = np.zeros(node[-1] + 1, np.int64)
            shared: dict[int, dict[int, int]] = {}
            for end in (0, len(self.counts) - 1):
                if self.length[end] >= d:
                    which = int(node[np.searchsorted(rows, end)])
                    known = border.get(bytes(self.symbols[end, :d].astype(np.uint8)), {})
                    shared[which] = known
                    mine = np.flatnonzero(edge_node == which)
                    seen[mine] = [known.get(s, 0) for s in edge_symbol[mine].tolist()]
                    here = set(edge_symbol[mine].tolist())
                    away = [c for s, c in known.items() if s not in here]
                    extra_n[which], extra_t[which] = sum(away), len(away)
            n = np.bincount(edge_node, seen, node[-1] + 1) + extra_n
            t = np.bincount(edge_node, seen > 0, node[-1] + 1) + extra_t
            of_edge = seen[edge]
            going = alive[rows]
            on = going & (of_edge > 0)
            escape = np.where(n > 0, escapes[_state(n, t)], 1.0)
            total[rows[on]] += np.log10((1 - escape[node[on]]) * of_edge[on] / n[node[on]])
            off = going & (of_edge == 0)
            if off.any():
                starts = np.searchsorted(edge_node, np.arange(node[-1] + 2))
                for row, which in zip(rows[off].tolist(), node[off].tolist()):
                    part = slice(starts[which], starts[which + 1])
                    excluded = set(shared[which]) if which in shared else {
                        s for s, c in zip(edge_symbol[part].tolist(), seen[part].tolist()) if c}
                    left.append((row, d, escape[which], excluded))
                alive[rows[off]] = False
        for row, d, escape, excluded in left:
            word = self.words[row].as_py()
            word = word.encode() if isinstance(word, str) else word
            before = [START, *word[:d]][-ORDERS:]
            symbol = word[d] if d < len(word) else TERMINATOR
            total[row] += np.log10(escape * short.probability(before, symbol, excluded))
            if symbol != TERMINATOR:
                total[row] += short.log_rest(word, d + 1)
        for row in np.flatnonzero(alive & (self.length >= self.depth)).tolist():
            word = self.words[row].as_py()
            total[row] += short.log_rest(word.encode() if isinstance(word, str) else word, self.depth)
        return total


# --- words before ---------------------------------------------------------------------------

_N_CLASSES = 96


def _n_class(n: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(2 * np.log2(np.maximum(n, 1))), 0, _N_CLASSES - 1).astype(np.int64)


class SeenRuns:
    """How often the runs of words of some texts occur in training, by number of words before:
    `after` has the places, the run's count and that of the run without its last word."""

    def __init__(self, lines: Lines, words_before: int, answers: pa.Table):
        counts: dict[int, np.ndarray] = {}
        answers = answers.sort_by([("before", "ascending"), ("part", "ascending")])
        for before, size, got in zip(*(answers[c].to_pylist() for c in ("before", "size", "seen"))):
            counts.setdefault(before, []).append(_unpacked(got, size))
        self.after, last = [], None
        for before, (at, run) in enumerate(lines.runs(words_before)):
            seen = np.zeros(len(lines.words), np.int64)
            if len(at):
                seen[at] = np.concatenate(counts[before])[_places(run)]
            if before:
                self.after.append((at, seen[at], last[at - 1]))
            last = seen

    def events(self, train: np.ndarray) -> np.ndarray:
        """Of the words marked in `train`, each left out once: whether its run was seen
        otherwise (old) or not (new), by words before and class of the shorter run's count."""
        found = np.zeros((len(self.after), _N_CLASSES, 2))
        for k, (at, c, n) in enumerate(self.after):
            some = train[at] & (n > 1)
            for new in (0, 1):
                these = some & ((c == 1) == bool(new))
                found[k, :, new] = np.bincount(_n_class(n[these] - 1), minlength=_N_CLASSES)
        return found

    def mixed(self, logp: np.ndarray, escapes: np.ndarray) -> np.ndarray:
        """log10 probability of every word from its own: after each more word before, the share
        of the words seen there, and the escape's part of what the shorter context says."""
        logp = logp * _LN10
        for k, (at, c, n) in enumerate(self.after):
            known = n > 0
            at, c, n = at[known], c[known], n[known]
            escape = escapes[k, _n_class(n)]
            with np.errstate(divide="ignore"):
                logp[at] = np.logaddexp(np.log((1 - escape) * c / n), np.log(escape) + logp[at])
        return logp / _LN10


def run_escapes(events: np.ndarray) -> np.ndarray:
    """Escape probability by words before and class, drawn towards 1 / (1 + sqrt(n)) while the
    class was met seldom."""
    prior = 1 / (1 + 2 ** (np.arange(_N_CLASSES) / 4))
    return np.clip((events[..., 1] + 4 * prior) / (events.sum(-1) + 4), 1e-9, 0.999)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes each as the largest needs, compressed; `_unpacked` knows
    how many there are."""
    width = int(np.min_scalar_type(int(numbers.max(initial=0))).itemsize)
    return bytes([width]) + pa.compress(numbers.astype(f"<u{width}").tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, count: int) -> np.ndarray:
    width = packed[0]
    return np.frombuffer(pa.decompress(packed[1:], width * count, "zstd"), f"<u{width}").astype(np.int64)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct hashes: the gaps between them, one plane of bytes after the other, without
    the planes above the largest gap."""
    gaps = keys[1:] - keys[:-1]
    used = (int(gaps.max(initial=0)).bit_length() + 7) // 8
    return keys[:1].astype("<u8").tobytes() + b"".join(
        (gaps >> np.uint64(8 * i)).astype(np.uint8).tobytes() for i in range(used))


def _unpacked_keys(packed: bytes, count: int) -> np.ndarray:
    planes = np.zeros((8, count - 1), np.uint8)
    got = np.frombuffer(packed, np.uint8, offset=8)
    if len(got):
        planes[:len(got) // (count - 1)] = got.reshape(-1, count - 1)
    gaps = np.ascontiguousarray(planes.T).reshape(-1).view("<u8")
    return np.cumsum(np.concatenate([np.frombuffer(packed, "<u8", 1), gaps]), dtype=np.uint64)


def counted_runs(blocks: DataFrame, words_before: int, parts: int, least: int = 0) -> DataFrame:
    """(block, before, part, size, seen): for each block and number of words before, from `least`
    to `words_before`, the training counts of its distinct runs, in the order of their hashes,
    cut into parts by hash.

    A block sends each distinct run once; a part holds the runs of a range of hashes, so no
    single word or context gathers in one task."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("texts")):
                texts = rows_of(packed.as_py())
                lines = Lines(_one(texts["text"]))
                train = ~texts["held_out"].to_numpy().astype(bool)[lines.word_text]
                for before, (at, run) in enumerate(lines.runs(words_before)):
                    if before < least:
                        continue
                    if not len(run):
                        continue
                    distinct, order = _sorted(run)
                    keys = run[order[distinct]]
                    n = np.add.reduceat(train[at][order].astype(np.int64), distinct)
                    part = _part(keys, parts)
                    first = np.flatnonzero(np.diff(part, prepend=-1))
                    cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(keys)]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(cuts), block, np.int64)),
                         pa.array(np.full(len(cuts), before, np.int32)),
                         pa.array(part[first].astype(np.int32)),
                         pa.array([b - a for a, b in cuts], pa.int32()),
                         pa.array([_packed_keys(keys[a:b]) for a, b in cuts], pa.binary()),
                         pa.array([_packed(n[a:b]) for a, b in cuts], pa.binary())],
                        names=["block", "before", "part", "size", "keys", "n"])

    def count(group: pa.Table) -> pa.Table:
        sizes = group["size"].to_pylist()
        keys = [_unpacked_keys(k, size) for k, size in zip(group["keys"].to_pylist(), sizes)]
        n = np.concatenate([_unpacked(k, size) for k, size in zip(group["n"].to_pylist(), sizes)])
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        seen = np.bincount(which, n, len(distinct)).astype(np.int64)[which]
        ends = np.cumsum(sizes).tolist()
        return pa.table({"block": group["block"], "before": group["before"], "part": group["part"],
                         "size": group["size"],
                         "seen": pa.array([_packed(seen[a:b]) for a, b in zip([0, *ends], ends)],
                                          pa.binary())})

    asked = blocks.mapInArrow(ask, "block long, before int, part int, size int, keys binary, n binary")
    return asked.groupBy("before", "part").applyInArrow(
        count, "block long, before int, part int, size int, seen binary")


def asked_runs(blocks: DataFrame, words_before: int, parts: int) -> DataFrame:
    """`counted_runs`, stored: words and those after one word first, then each longer run by
    itself."""
    found = None
    for most in range(1, words_before + 1):
        runs = stored(counted_runs(blocks, most, parts, most if most > 1 else 0), "ppm-runs")
        found = runs if found is None else found.unionAll(runs)
    return found


def run_events(blocks: DataFrame, runs: DataFrame, words_before: int) -> DataFrame:
    """(kinds, n) of each block: its training texts' escape events after words before, by
    `run_escapes`' classes, from its answers of `counted_runs`."""

    def events(texts: pa.Table, answers: pa.Table) -> pa.Table:
        rows = rows_of(texts["texts"][0].as_py())
        lines = Lines(_one(rows["text"]))
        train = ~rows["held_out"].to_numpy().astype(bool)[lines.word_text]
        found = SeenRuns(lines, words_before, answers).events(train).ravel()
        some = np.flatnonzero(found)
        return pa.table({"kinds": pa.array([some.tolist()], pa.list_(pa.int64())),
                         "n": pa.array([found[some].astype(np.int64).tolist()], pa.list_(pa.int64()))})

    return blocks.groupBy("block").cogroup(runs.groupBy("block")).applyInArrow(
        events, "kinds array<long>, n array<long>")


def learned_runs(events: DataFrame, words_before: int) -> np.ndarray:
    """Escapes after words before, from the events of all training texts."""
    total = np.zeros(words_before * _N_CLASSES * 2)
    with shuffles_removed(events.sparkSession):
        for r in (events.select(F.explode(F.arrays_zip("kinds", "n")).alias("e"))
                  .groupBy("e.kinds").agg(F.sum("e.n").alias("n")).collect()):   # as many rows as classes
            total[r["kinds"]] = r["n"]
    return run_escapes(total.reshape(words_before, _N_CLASSES, 2))


# --- words and lines of a block -------------------------------------------------------------

class Asked:
    """The distinct words of some texts, then their distinct lines (as `line_key`), and how they
    are asked for: `order` sorts them by part, `cuts` has (part, begin, end) in that order."""

    def __init__(self, lines: Lines, parts: int):
        known = lines.dictionary.cast(pa.string())
        hashes, first, self.line = np.unique(lines.hashes(), return_index=True, return_inverse=True)
        keys = list(map(line_key, hashes.tolist(), lines.line_class()[first].tolist()))
        self.words = pa.concat_arrays([known, pa.array(keys, pa.string())])
        part = _part(hashed(self.words), parts)
        self.order = np.argsort(part, kind="stable")
        part = part[self.order]
        begin = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        self.cuts = list(zip(part[begin].tolist(), begin, [*begin[1:], len(part)]))

    def answered(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """The counts and log10 probabilities of the words and lines, from `looked_up`."""
        answers = answers.sort_by("part")
        c, logp = np.zeros(len(self.words), np.int64), np.zeros(len(self.words))
        if len(self.words):
            c[self.order] = np.concatenate([_unpacked(x, size) for x, size in zip(
                answers["seen"].to_pylist(), answers["size"].to_pylist())])
            logp[self.order] = np.frombuffer(b"".join(answers["logp"].to_pylist()), "<f8")
        return c, logp


_LEXICON = "part int, word string, c long, logp double"


def with_part(words: pa.Table, parts: int) -> pa.Table:
    """Rows of the lexicon with the range of hashes that their words are asked in."""
    part = _part(hashed(_one(words["word"])), parts).astype(np.int32)
    return words.select(["word", "c", "logp"]).add_column(0, "part", pa.array(part))


def looked_up(blocks: DataFrame, lexicon: DataFrame, parts: int) -> DataFrame:
    """(block, part, size, seen, logp): counts and log10 probabilities of each block's words and
    lines in the order they are asked; a line that training lacks has count 0."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("texts")):
                asked = Asked(Lines(_one(rows_of(packed.as_py())["text"])), parts)
                words = asked.words.take(pa.array(asked.order))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(asked.cuts), block, np.int64)),
                     pa.array([p for p, _, _ in asked.cuts], pa.int32()),
                     pa.array([b - a for _, a, b in asked.cuts], pa.int32()),
                     pa.array([_written_rows(pa.table({"word": words[a:b]})) for _, a, b in asked.cuts],
                              pa.binary())], names=["block", "part", "size", "words"])

    def look(asked: pa.Table, known: pa.Table) -> pa.Table:
        words, c, logp = _one(known["word"]), known["c"].to_numpy(), known["logp"].to_numpy()
        seen, found = [], []
        for packed in asked["words"]:
            wanted = _one(pa.ipc.open_stream(packed.as_py()).read_all()["word"])
            place = pc.fill_null(pc.index_in(wanted, value_set=words), -1).to_numpy()
            seen.append(_packed(np.where(place < 0, 0, c[place]) if len(c) else 0 * place))
            found.append((logp[place] if len(c) else 0.0 * place).astype("<f8").tobytes())
        return pa.table({"block": asked["block"], "part": asked["part"], "size": asked["size"],
                         "seen": pa.array(seen, pa.binary()), "logp": pa.array(found, pa.binary())})

    asked = blocks.select("block", "texts").mapInArrow(ask, "block long, part int, size int, words binary")
    return asked.groupBy("part").cogroup(lexicon.groupBy("part")).applyInArrow(
        look, "block long, part int, size int, seen binary, logp binary")


# --- on Spark -------------------------------------------------------------------------------

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs within removes its shuffle files when it ends."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`common.stored`, without the shuffles that led to it."""
    with shuffles_removed(df.sparkSession):
        return common.stored(df, name)


def blocked(docs: DataFrame, docs_per_block: int, bytes_per_block: int) -> DataFrame:
    """(block, texts) of (doc_id, held_out, text), for `rows_of`: neighbouring rows of a task go
    into one block, as many as stay within both bounds, whatever their ids.  Only a single text
    may be longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, kept, rows, size = TaskContext.get().partitionId(), 0, [], 0, 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([task << 33 | made], pa.int64()),
                                               pa.array([_written_rows(pa.Table.from_batches(kept))], pa.binary())],
                                              names=["block", "texts"])

        for batch in batches:
            first, sizes = 0, pc.binary_length(batch.column("text")).to_pylist()
            for row, length in enumerate(sizes):
                if rows and (rows == docs_per_block or size + length > bytes_per_block):
                    kept.append(batch.slice(first, row - first))
                    yield block()
                    first, made, kept, rows, size = row, made + 1, [], 0, 0
                rows, size = rows + 1, size + length
            kept.append(batch.slice(first))
        if rows:
            yield block()

    return stored(docs.mapInArrow(run, "block long, texts binary"), "ppm-blocks")


def _written_rows(table: pa.Table) -> bytes:
    """Rows as one value, for `rows_of`."""
    sink, table = pa.BufferOutputStream(), table.combine_chunks()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def rows_of(texts: bytes) -> pa.Table:
    """(doc_id, held_out, text) of a block."""
    pa.default_memory_pool().release_unused()       # what the block before took
    return pa.ipc.open_stream(texts).read_all()


def _texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The texts of one block after another."""
    for batch in batches:
        for texts in batch.column("texts"):
            yield rows_of(texts.as_py())


def counted(blocks: DataFrame) -> DataFrame:
    """(word, c): all words and (as `line_key`) lines of all texts, counted in the training
    texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts_of(batches):
            lines = Lines(_one(texts["text"]))
            train = ~texts["held_out"].to_numpy().astype(bool)
            n = np.bincount(lines.ids, train[lines.word_text], len(lines.dictionary))
            hashes, first, which = np.unique(lines.hashes(), return_index=True, return_inverse=True)
            line_n = np.bincount(which, train[lines.line_text[lines.used]], len(hashes))
            some = line_n > 0
            keys = list(map(line_key, hashes[some].tolist(), lines.line_class()[first[some]].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([lines.dictionary.cast(pa.string()), pa.array(keys, pa.string())]),
                 pa.array(np.concatenate([n, line_n[some]]).astype(np.int64))], names=["word", "n"])

    return stored(blocks.mapInArrow(count, "word string, n long")
                  .groupBy("word").agg(F.sum("n").alias("c")), "ppm-counts")


def ranged(words: DataFrame, words_per_range: int = 400_000) -> DataFrame:
    """(part, word, c): the words with the number of their range in sorted order."""
    spark = words.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 -(-words.count() // words_per_range))
    return stored(words.repartitionByRange(ranges, "word")
                  .select(F.spark_partition_id().alias("part"), "word", "c"), "ppm-vocabulary")


def known_lines(lines: DataFrame, layout: bool) -> tuple[DataFrame, np.ndarray, int]:
    """(word, c, logp) of the training lines, log10 of the escape probability by class, and the
    number of training lines.

    With `layout`, lines are a share of all training lines, whatever their length, and the
    escape codes the new line's number of words: its class, as often as among lines seen once,
    and its place in the class."""
    lines = lines.select("word", "c", F.substring("word", 18, 9).cast("int").alias("k"))
    size, once = np.zeros(_CLASSES), np.zeros(_CLASSES)
    for r in lines.groupBy("k").agg(F.sum("c").alias("n"), F.count_if(F.col("c") == 1).alias("once")).collect():
        size[r["k"]], once[r["k"]] = r["n"], r["once"]
    met = np.flatnonzero(size)
    if not len(met):
        escape = np.ones(_CLASSES)
    elif layout:
        escape = np.full(_CLASSES, (once.sum() + 2.0) / (size.sum() + 4.0))
    else:
        escape = np.where(size > 0, (once + 2.0) / (size + 4.0), 1.0)
    among = np.full(_CLASSES, size.sum()) if layout else size
    logp = F.lit(0.0)
    if len(met):
        share = F.create_map(*[F.lit(x) for k in met.tolist() for x in (k, float((1 - escape[k]) / among[k]))])
        logp = F.log10(share[F.col("k")] * F.col("c"))
    log_escape = np.log10(escape)
    if layout:
        log_escape += np.log10((once + 1 / _CLASSES) / (once.sum() + 1))
        log_escape[64:] -= np.log10(2) * (np.arange(64, _CLASSES) - 58)
    return lines.select("word", "c", logp.alias("logp")), log_escape, int(size.sum())


def _one(column: pa.ChunkedArray) -> pa.Array:
    """A column in one piece."""
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _trie(group: pa.Table, depth: int) -> tuple[pa.Table, SortedTrie]:
    group = group.take(pc.sort_indices(group["word"].cast(pa.large_binary()))).combine_chunks()
    return group, SortedTrie(_one(group["word"]), group["c"].to_numpy(), depth)


def trained(words: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """From the ranges of words: (key, n) of the short contexts and of the escapes' events, at
    most nodes times symbols rows; (beginning, symbol, n) of the nodes that ranges may share."""
    def contexts(group: pa.Table) -> pa.Table:
        _, trie = _trie(group, depth)
        keys, n, events = trie.learned()
        states = np.flatnonzero(events.sum(1))
        # Escape states follow the context keys: twice the state, and one for the new symbols.
        more = _ESCAPES + 2 * np.concatenate([states, states]) + np.repeat([0, 1], len(states))
        return pa.table({"key": pa.array(np.concatenate([keys, more]), pa.int64()),
                         "n": pa.array(np.concatenate([n, events[states, 0], events[states, 1]])
                                       .astype(np.int64))})

    def border(group: pa.Table) -> pa.Table:
        _, trie = _trie(group, depth)
        found = trie.border()
        return pa.table({"beginning": pa.array([b for b, _, _ in found], pa.binary()),
                         "symbol": pa.array([s for _, s, _ in found], pa.int32()),
                         "n": pa.array([c for _, _, c in found], pa.int64())})

    sums = (words.groupBy("part").applyInArrow(contexts, "key long, n long")
            .groupBy("key").agg(F.sum("n").alias("n")))
    borders = (words.groupBy("part").applyInArrow(border, "beginning binary, symbol int, n long")
               .groupBy("beginning", "symbol").agg(F.sum("n").alias("n")))
    return sums, borders


_SHORT: dict[str, ShortContexts] = {}


def _short_contexts(run: str, table) -> ShortContexts:
    """The run's model, built once in a worker process."""
    if run not in _SHORT:
        _SHORT.clear()
        _SHORT[run] = ShortContexts(*table.value)
    return _SHORT[run]


def score(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          depth: int = 32, docs_per_block: int = 10_000, bytes_per_block: int = 1 << 22,
          layout: bool = False, words_before: int = 0) -> DataFrame:
    """Scores of all rows, learned from those where `held_out` (over the id column) is false.

    `layout`: code the number of lines and their numbers of words, too, so that probabilities
    over all sequences of lines of words add up to one (at most).  `words_before`: how many
    words before, across lines, a word's probability depends on; their escapes are learned from
    all training texts."""
    spark = df.sparkSession
    sc = spark.sparkContext
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(held_out, F.lit(False)).alias("held_out"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = blocked(docs, docs_per_block, bytes_per_block)
    table = counted(dealt)
    is_line = F.col("word").startswith("\n")
    words = ranged(table.filter(~is_line))
    lines, line_escape, n_lines = known_lines(table.filter(is_line), layout)
    sizes = docs.agg(F.count(F.lit(1)).alias("n"),
                     F.count_if(~F.col("held_out")).alias("train"),
                     F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    totals = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
                       F.count_if(F.col("c") > 0).alias("v")).first()
    ends = sizes["train"]
    parts = min(1 << 24, max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                             -(-sizes["bytes"] // (1 << 23))))
    runs = run_escape = None
    if words_before:
        runs = asked_runs(dealt, words_before, parts)
        run_escape = learned_runs(run_events(dealt, runs, words_before), words_before)
    n, v = totals["n"] + ends, totals["v"] + (ends > 0)

    sums, borders = trained(words, depth)
    sums = sums.toArrow().sort_by("key")
    keys, counts = sums["key"].to_numpy(), sums["n"].to_numpy()
    events = np.zeros((_STATES, 2))
    late = keys >= _ESCAPES
    events.reshape(-1)[keys[late] - _ESCAPES] = counts[late]
    border: dict[bytes, dict[int, int]] = {}
    for r in borders.collect():
        border.setdefault(bytes(r["beginning"]), {})[r["symbol"]] = r["n"]
    shared_keys, shared_n, shared_events = learned_on_border(border)
    escapes = escape_table(events + shared_events)
    keys, counts = _summed(np.concatenate([keys[~late], shared_keys]),
                           np.concatenate([counts[~late], shared_n]))
    short = sc.broadcast((keys, counts))
    line_score = 0.0                        # of each line: that the text goes on with one
    if layout:
        end_share = (ends + 0.5) / (ends + n_lines + 1)
        end_score, line_score = float(np.log10(end_share)), float(np.log1p(-end_share)) / _LN10
    elif ends:
        root = border.setdefault(b"", {})
        root[END] = ends
        occurrences = float(sum(root.values()))
        escape = escapes[_state(np.array([occurrences]), np.array([len(root)]))[0]]
        end_score = float(np.log10((1 - escape) * ends / occurrences))
    else:
        end_score = -float(np.log10(_SYMBOLS + 1))
    paths, run = sc.broadcast(border), uuid.uuid4().hex

    def scored(group: pa.Table) -> pa.Table:
        group, trie = _trie(group, depth)
        logp = pa.array(trie.scores(paths.value, escapes, _short_contexts(run, short)))
        return with_part(group.append_column("logp", logp), parts)

    def dealt_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from with_part(pa.Table.from_batches([batch]), parts).to_batches()

    lexicon = words.groupBy("part").applyInArrow(scored, _LEXICON).unionAll(lines.mapInArrow(dealt_lines, _LEXICON))
    answers = stored(looked_up(dealt, lexicon, parts), "ppm-answers").withColumn("before", F.lit(-1))
    if words_before:
        answers = answers.unionByName(runs, allowMissingColumns=True)

    def total(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts = rows_of(texts["texts"][0].as_py())
        rows = texts.num_rows
        lines = Lines(_one(texts["text"]))
        asked = Asked(lines, parts)
        c, logp = asked.answered(answers.filter(pc.equal(answers["before"], -1)))
        line_c, line_logp = c[len(lines.dictionary):][asked.line], logp[len(lines.dictionary):][asked.line]
        place = lines.ids
        base = np.log10((c + _SMOOTH) / (n + _SMOOTH * (v + 1)))
        of_text = lambda x: np.bincount(lines.word_text, x, rows)
        # Lines: as known ones, or escaped and spelled.
        of_word = logp[place]
        if words_before:
            of_runs = answers.filter(pc.greater_equal(answers["before"], 0))
            of_word = SeenRuns(lines, words_before, of_runs).mixed(of_word, run_escape)
        spelled = np.bincount(lines.word_line, of_word, len(lines.line_text))[lines.used]
        classes = lines.line_class()
        whole = np.where(line_c > 0, line_logp, -np.inf)
        escaped = line_escape[classes] + spelled
        each = np.logaddexp(whole * _LN10, escaped * _LN10) / _LN10 + line_score
        end_base = np.log10((ends + _SMOOTH) / (n + _SMOOTH * (v + 1)))
        return pa.table({
            "doc_id": texts["doc_id"], "held_out": texts["held_out"],
            "n_tokens": pa.array(of_text(None) + 1, pa.int64()),
            "n_known": pa.array(of_text((c > 0)[place].astype(float)).astype(np.int64) + int(ends > 0)),
            "train_tokens": pa.array(np.full(rows, n), pa.int64()),
            "base_score": pa.array(of_text(base[place]) + end_base, pa.float64()),
            "score": pa.array(np.bincount(lines.line_text[lines.used], each, rows)
                              + end_score, pa.float64())})

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(total, SCHEMA)
