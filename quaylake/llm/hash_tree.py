"""Operator 7: sharding by a hierarchical weighted hash tree.

A topology is regions of racks of shards, each shard with a weight; a rack or region weighs
what its shards weigh together.  A key descends the tree: at each level every child draws
-ln(u) / weight with u a hash of key and child's name, and the smallest draw wins.  A child
wins with a probability in proportion to its weight, and a changed weight leaves the draws of
all other children as they are: keys move only into a child that grew or out of one that
shrank, and only where the path to it changed.

The law kept is `key`: the id and the number of shards decide, and for every number one more
shard takes keys only into itself.  The first BASE shards are the leaves of one fixed tree;
each further one opens a region of its own.  With fewer shards than BASE every key still
descends the fixed tree first, and a key whose leaf is not there yet draws among the shards
that are; when the leaf comes, just these keys leave for it.

Slots count up from 0 in every shard.  They are found from counts by (shard, cell), where a
cell is a hash of the id and of the row's number, so no task sorts a whole shard, however many
rows share an id.  A null id is a key like any other; rows of equal ids fall into one shard
and get slots of their own; null texts have size 1 and the checksum of no bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import stored

Topology = dict[str, dict[str, dict[int, float]]]


#: Shards of the fixed tree that every number of shards grows from: a whole number of regions.
BASE = 16


def topology(shards: int, racks: int = 2, per_rack: int = 2, base: int = BASE) -> Topology:
    """`base` shards of weight 1 in regions of `racks` times `per_rack`, whatever the number of
    shards; each of those beyond opens a region of its own, as `grown` does."""
    tree: Topology = {}
    size = racks * per_rack
    for shard in range(base):
        region, place = divmod(shard, size)
        tree.setdefault(f"region{region}", {}).setdefault(
            f"rack{region}.{place // per_rack}", {})[shard] = 1.0
    for shard in range(base, shards):
        tree = grown(tree, shard)
    return tree


def grown(tree: Topology, shard: int, weight: float = 1.0) -> Topology:
    """The tree with one more shard, in a region of its own: it takes keys only into itself."""
    return {**tree, f"region+{shard}": {f"rack+{shard}": {shard: weight}}}


def _children(parents: dict[str, dict[str, float]]) -> Column:
    """A map from each parent to its children of positive weight, as (name, weight)."""
    entries = []
    for parent, children in sorted(parents.items()):
        alive = [F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"))
                 for name, weight in sorted(children.items()) if weight > 0]
        if alive:
            entries += [F.lit(parent), F.array(*alive)]
    if not entries:
        raise ValueError("the topology has no shard of positive weight")
    return F.create_map(*entries)


def _winner(key: Column, children: Column) -> Column:
    """The name of the child with the smallest draw (ties: the first by name)."""

    def draw(child: Column) -> Column:
        # 53 bits of the hash as a number in (0, 1)
        bits = F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11)
        draw = -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / child["weight"]
        return F.struct(draw.alias("draw"), child["name"].alias("name"))

    return F.array_min(F.transform(children, draw))["name"]


def descend(df: DataFrame, key: str, tree: Topology, out: str) -> DataFrame:
    """`df` with the shard that each key descends to, one level after the other."""
    shards = {rack: {str(s): w for s, w in leaves.items()}
              for inner in tree.values() for rack, leaves in inner.items()}
    racks = {region: {rack: sum(shards[rack].values()) for rack in inner}
             for region, inner in tree.items()}
    regions = {"root": {region: sum(inner.values()) for region, inner in racks.items()}}
    at = f"{out}_at"
    df = df.withColumn(at, F.lit("root"))
    for level in (regions, racks, shards):
        df = df.withColumn(at, _winner(F.col(key), _children(level)[F.col(at)]))
    return df.withColumn(out, F.col(at).cast("int")).drop(at)


def place(df: DataFrame, key: str, shards: int, out: str) -> DataFrame:
    """`df` with the shard (0 to shards - 1) that each key falls into."""
    if shards < 1:
        raise ValueError("there must be a shard")
    df = descend(df, key, topology(shards), out)
    if shards >= BASE:
        return df
    lone: Topology = {}
    for shard in range(shards):
        lone = grown(lone, shard)
    again = f"{out}_again"
    df = descend(df, key, lone, again)
    return df.withColumn(out, F.when(F.col(out) < shards, F.col(out)).otherwise(F.col(again))).drop(again)


def assign(df: DataFrame, shards: int, rows_per_cell: int = 20_000, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row: size, checksum, shard, slot in the shard, and the shard after growing by one."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"))
    placed = place(place(keyed, "key", shards, "shard"), "key", shards + 1, "grown_shard").drop("key")
    placed = stored(placed, "placed-rows")      # row numbers stay; the texts are read once
    rows = placed.count()
    cells = max(1, -(-rows // (rows_per_cell * shards)),
                -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards) * 4)
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id", "row", F.lit("cell")),
                                              F.lit(cells)).cast("int"))
    # Rows before each cell of its shard: a table of shards times cells rows.
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = (Window.partitionBy("shard").orderBy("cell")
              .rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("shard", "cell",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "row")
    return (placed.withColumn("place", F.row_number().over(within) - 1)
            .join(firsts, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("first") + F.col("place")).cast("long").alias("slot"), "grown_shard"))
