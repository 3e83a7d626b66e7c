"""Operator 4: SimHash near-duplicates by bit-sliced comparison.

A document's fingerprint has a bit set where more than half of its shingles' hashes have it.
Documents whose fingerprints differ in at most `radius` = 2 bits are linked, and connected
documents form a group.

Only distinct fingerprints are compared.  Two that differ in at most two bits agree on at
least two of any four parts of the 64 bits, so each fingerprint goes into six buckets, one for
each pair of 16-bit parts.  A bucket of more than `bucket_rows` fingerprints is split the same
way over the bits that it leaves open: again six buckets, with 48 bits fixed, then 56.  At
that depth a bucket has at most 256 distinct fingerprints, so no bucket grows with the data
and no link is lost.

The buckets of a task lie one after another.  Their fingerprints are stored as 64 vertical bit
planes, 64 rows in a machine word; a row is compared with the one `s` places on, for all rows
at once: the planes are combined with themselves moved by s, and the distances counted by
carry-save bitwise counters.  Blocks of words whose distances all exceed the radius are left
out as soon as that shows.  What a bucket links comes out as a spanning forest, not as pairs.

Groups are found by the alternating star operations on the forest's edges.

Words are longest runs without ASCII white space, lower-cased A-Z; a text of fewer than three
words is one shingle; a null or empty text, or one without words, has fingerprint zero and is
linked like any other.  Equal rows are rows of one group.  A group's id is the smallest
non-null document id in it (null if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import map_batches, stored

BITS = 64
SEED = 42
_SHINGLES_AT_ONCE = 1 << 16


# --- fingerprints ---------------------------------------------------------------------------

def fingerprint(text: str, words_per_shingle: int = 3) -> int:
    """SimHash of a whole text, unsigned."""
    words = text.encode().lower().split()        # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    width = min(words_per_shingle, len(words))
    pairs = list(zip(starts, ends[width - 1:].tolist()))
    ones = np.zeros(BITS, np.int64)
    for first in range(0, len(pairs), _SHINGLES_AT_ONCE):
        part = pairs[first:first + _SHINGLES_AT_ONCE]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in part],
                                 repeat(SEED)), np.uint64, len(part))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(pairs), bitorder="little").tobytes(), "little")


def with_fingerprint(df: DataFrame, text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """(row, fp): every row's columns as a struct, and its fingerprint as a signed long."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, fp long"

    def make():
        def step(batch):
            found = np.array([fingerprint(t.as_py() or "", words_per_shingle)
                              for t in batch.column(0).field(text_col)], np.uint64)
            return {"row": batch.column(0), "fp": found.view(np.int64)}
        return step

    return map_batches(rows, schema, make)


# --- buckets --------------------------------------------------------------------------------

def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def finer(mask: int) -> list[int]:
    """The six masks that also fix two of the four parts of the bits that `mask` leaves open."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    size = len(free) // 4
    parts = [sum(1 << b for b in free[i * size:(i + 1) * size]) for i in range(4)]
    return [mask | a | b for a, b in combinations(parts, 2)]


def _refined(rows: DataFrame, masks: list[int]) -> DataFrame:
    """(mask, fp) to the rows of the finer buckets, with each bucket's size; single rows go."""
    next_masks = F.create_map(*[x for m in masks for x in (
        F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in finer(m)]))])
    split = (rows.select(F.explode(next_masks[F.col("mask")]).alias("mask"), "fp")
             .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))
    if masks != [0]:
        split = split.distinct()        # several buckets may share a finer one
    sizes = split.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return split.join(sizes, ["mask", "key"])


def buckets(distinct: DataFrame, bucket_rows: int = 256) -> DataFrame:
    """(mask, key, fp): buckets of at most 256 (`bucket_rows`) fingerprints that together hold
    every pair of fingerprints differing in two bits or fewer."""
    rows, masks, parts = distinct.select(F.lit(0).cast("long").alias("mask"), "fp"), [0], []
    for level in range(3):
        rows = stored(_refined(rows, masks), f"simhash-buckets-{level}")
        fits = F.col("n") <= bucket_rows
        parts.append((rows.filter(fits) if level < 2 else rows).select("mask", "key", "fp"))
        rows = rows.filter(~fits).select("mask", "fp")
        masks = sorted({f for m in masks for f in finer(m)})
        if rows.isEmpty():
            break
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


# --- bit-sliced comparison ------------------------------------------------------------------

def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 planes of a row of unsigned values: bit r % 64 of word r // 64 belongs to row r."""
    rows = -(-len(values) // BITS) * BITS
    padded = np.zeros(rows, "<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(rows, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def near_rows(planes: np.ndarray, partner: np.ndarray, places: int, radius: int) -> np.ndarray:
    """Rows r, of those marked in `partner`, that differ from row r + places in at most
    `radius` (up to 3) bits."""
    words = np.flatnonzero(partner)
    alive = partner[words]
    ones, twos = np.zeros_like(alive), np.zeros_like(alive)
    whole, part = divmod(places, BITS)
    last = planes.shape[1] - 1
    for first in range(0, BITS, 8):
        for plane in planes[first:first + 8]:
            there = words + whole
            other = np.where(there <= last, plane[np.minimum(there, last)], 0)
            if part:
                beyond = np.where(there < last, plane[np.minimum(there + 1, last)], 0)
                other = (other >> np.uint64(part)) | (beyond << np.uint64(BITS - part))
            differ = plane[words] ^ other
            carry = ones & differ                     # carry-save: two-bit counters
            ones ^= differ
            alive &= ~(twos & carry)                  # a fourth difference
            twos ^= carry
            if radius < 3:
                over = {0: ones | twos, 1: twos, 2: ones & twos}[radius]
                alive &= ~over
        keep = alive != 0                             # abandon blocks beyond the radius
        if not keep.all():
            words, alive, ones, twos = words[keep], alive[keep], ones[keep], twos[keep]
            if not len(words):
                return np.empty(0, np.int64)
    rows = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")
    word, bit = np.nonzero(rows)
    return words[word] * BITS + bit


def forest(values: np.ndarray, sizes: np.ndarray, radius: int = 2) -> list[tuple[int, int]]:
    """Edges (places) of a spanning forest of the links within buckets that lie one after
    another, `sizes` rows each."""
    planes = bit_planes(values)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(values)) - 1   # rows after this
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for places in range(1, int(sizes.max(initial=0))):
        marks = np.zeros(planes.shape[1] * BITS, np.uint8)
        marks[:len(values)] = left >= places
        partner = np.packbits(marks, bitorder="little").view("<u8")
        for row in near_rows(planes, partner, places, radius).tolist():
            a, b = root(row), root(row + places)
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((row, row + places))
    return edges


def links(in_buckets: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): edges of a spanning forest of each bucket."""
    ready = (in_buckets.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
             .select("mask", "key", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None            # the last bucket may go on in the next batch

        def compare(rows: np.ndarray) -> pa.RecordBatch:
            new = np.flatnonzero(np.any(rows[1:, :2] != rows[:-1, :2], axis=1)) + 1
            edges = [0, *new.tolist(), len(rows)]
            found = np.array(forest(rows[:, 2].view(np.uint64), np.diff(edges), radius),
                             np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(rows[found[:, 0], 2]),
                                               pa.array(rows[found[:, 1], 2])], names=["a", "b"])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            rows = rows if kept is None else np.concatenate([kept, rows])
            if not len(rows):
                continue
            same = np.all(rows[:, :2] == rows[-1, :2], axis=1)
            first = len(rows) - int(same[::-1].cumprod().sum())
            if first:
                yield compare(np.ascontiguousarray(rows[:first]))
            kept = rows[first:]
        if kept is not None and len(kept):
            yield compare(np.ascontiguousarray(kept))

    return ready.mapInArrow(run, "a long, b long")


# --- groups ---------------------------------------------------------------------------------

def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the component's smallest node.

    Alternating large-star and small-star; each round is written to the shared folder."""

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        return (both.filter("b > a").join(least, "a")
                .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"),
                                                             F.col("m").alias("b"))
        return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(),
                 "components-0")
    seen, turn = mark(now), 0
    while True:
        turn += 1
        now = stored(small_star(large_star(now)), f"components-{turn}")
        if (new := mark(now)) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = new


def grouped(rows: DataFrame, id_col: str, radius: int = 2) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of `rows` (id, fp)."""
    distinct = stored(rows.groupBy("fp").agg(F.min(id_col).alias("first_id")), "simhash-distinct")
    member = connected(links(buckets(distinct.select("fp")), radius))
    rooted = (distinct.join(member, distinct["fp"] == member["node"], "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id")


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(with_fingerprint(picked, "text").select(F.col("row.doc_id").alias("doc_id"), "fp"),
                  "simhash-fingerprints")
    return rows.join(grouped(rows, "doc_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` with one row for each group: that of the smallest id (rows without an
    id come last, equal ids in no particular order)."""
    rows = stored(with_fingerprint(df, text_col).withColumn("uid", F.monotonically_increasing_id()),
                  "simhash-rows")
    slim = rows.select(F.col(f"row.`{id_col}`").alias("doc_id"), "fp", "uid")
    first = (slim.join(grouped(slim, "doc_id"), "fp").groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))
                  .alias("first")).select(F.col("first.uid").alias("uid")))
    return rows.join(first, "uid", "left_semi").select("row.*")
