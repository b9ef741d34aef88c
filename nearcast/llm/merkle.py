"""Merkle manifest of a table: digests of all rows, a root, and a proof for every row by pointer jumping.

Every row is a leaf; the leaves of a group, in the order of a key, form a binary
tree, and the groups' roots, in the order of the group, form one more above
them. A run's last node without a neighbour is hashed alone, so every level
halves.

*Building.* A leaf's number comes from a range sort and the row counts of its
partitions. The tree grows ten levels at a time: a block of 1,024 consecutive
nodes is one group, whose levels are arrays, so 10^10 rows take four shuffles.

*Proofs.* Every node starts with the segment to its parent: its one sibling, or
none. A self-join appends to a node's segment that of the node it leads to,
which doubles the distance, until every leaf's segment ends at the root. After
the join to distance d only levels divisible by d are needed again, so all
rounds together hold few more rows than leaves. An ancestor that many leaves
share is one of few, so that side is small where keys are hot; Spark broadcasts
or splits it by its measured size.

Defined cases: null values count as ``-``; null groups are one group and come
first; null keys come first; rows with one key are ordered by digest, and rows
that are alike altogether get one place each, in any order; an empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearcast.session import materialize

#: Levels that one shuffle builds; a block has 2 to this power nodes.
LEVELS = 10
#: Number of the tree above the groups' roots.
TOP = -1
NODE = ("tree", "level", "place")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts after one another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon and the value; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def height(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0).cast("int")


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``place``: the row's number, from 0, in its group in the given order.

    One range sort; offsets come from counts per partition and group, so a
    group that holds most rows is still many tasks.
    """
    keys = [*group, *order]
    spread = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}))
    held = spread.groupBy("__part", *group).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(F.col("__part").alias("__of"), *[F.col(g).alias(f"__of_{g}") for g in group],
                         (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"))
    same = F.col("__part") == F.col("__of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__of_{g}"))
    return spread.join(starts, same).select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("place"))


def parents(level: Column) -> Column:
    """The level above an array of digests."""
    def pair(i: Column) -> Column:
        return digest(F.get(level, i * 2), F.coalesce(F.get(level, i * 2 + 1), F.lit("")))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")), pair)


def siblings(digests: Column, level: int, first: Column) -> Column:
    """level, place, sibling, right of every node of a block's level, whose first place is ``first``."""
    def step(_: Column, p: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), (first + p).alias("place"),
                        F.unhex(F.get(digests, p.bitwiseXOR(F.lit(1)))).alias("sibling"), (p % 2 == 0).alias("right"))
    return F.transform(digests, step)


def grown(leaves: DataFrame, tallest: int) -> tuple[DataFrame, DataFrame]:
    """Steps (tree, height, level, place, sibling, right) of every node below a root, and roots (tree, height, digest).

    ``leaves`` has tree, height, place, digest; ``tallest`` is the greatest height.
    """
    now, steps, roots = leaves, [], []
    for base in range(0, max(tallest, 1), LEVELS):
        block = now.groupBy("tree", "height", F.shiftright("place", LEVELS).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("nodes"))
        block = block.select("tree", "height", "block", F.col("nodes.digest").alias("l0"))
        for j in range(LEVELS):
            block = block.withColumn(f"l{j + 1}", parents(F.col(f"l{j}")))
        block = materialize(block)
        flat = F.flatten(F.array(*[siblings(F.col(f"l{j}"), base + j, F.shiftleft("block", LEVELS - j)) for j in range(LEVELS)]))
        steps.append(block.select("tree", "height", F.explode(flat).alias("s")).select("tree", "height", "s.*").where("level < height"))
        tops = F.array(*[F.get(f"l{j}", F.lit(0)) for j in range(LEVELS + 1)])
        done = F.col("height") <= base + LEVELS
        roots.append(block.where(done).select("tree", "height", F.get(tops, F.col("height") - base).alias("digest")))
        now = block.where(~done).select("tree", "height", F.col("block").alias("place"), F.get(f"l{LEVELS}", F.lit(0)).alias("digest"))
    return _union(steps), _union(roots)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def to_root(steps: DataFrame, depth: int) -> DataFrame:
    """Segments (tree, level, place, up, siblings) of all leaves and top nodes: ``siblings`` ends at the root.

    ``steps`` leads each node to its parent ``up``; ``depth`` is the longest way to the root.
    """
    held, d = materialize(steps), 1
    at_top = F.col("tree") == TOP
    while d < depth:
        left = held.where(at_top | (F.col("level") % (2 * d) == 0))
        right = held.where(at_top | (F.col("level") % (2 * d) == d)).select(
            F.struct(*NODE).alias("__node"), F.col("up").alias("__up"), F.col("siblings").alias("__more"))
        met = left.join(right, F.col("up") == F.col("__node"), "left")
        held = materialize(met.select(*NODE, F.coalesce("__up", "up").alias("up"), F.when(
            F.col("__more").isNull(), F.col("siblings")).otherwise(F.concat("siblings", "__more")).alias("siblings")))
        d *= 2
    return held


def node(tree: Column, level: Column, place: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), place.cast("long").alias("place"))


def manifest(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``subroot``, ``root`` and ``siblings`` (array of sibling, right) to rows that have a ``leaf`` (hex).

    ``siblings`` has an element per level below the root: the other node's
    digest (null if there is none) and whether it stands to the right.
    """
    placed = materialize(numbered(rows, [group], order))
    groups = placed.groupBy(group).agg(F.count("*").alias("__n"))
    trees = materialize(numbered(groups, [], [group]).select(
        F.col(group).alias("__group"), F.col("place").alias("tree"), height(F.col("__n")).alias("height")))
    bounds = trees.agg(F.coalesce(F.max("height"), F.lit(0)).alias("tallest"), F.count("*").alias("n")).select(
        "tallest", "n", height(F.col("n")).alias("top")).first()
    # the tree's number and height join the leaves of one group; the group table is one row per group
    leaves = placed.join(trees, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
    steps, roots = grown(leaves.select("tree", "height", "place", F.col("leaf").alias("digest")), bounds["tallest"])
    roots = materialize(roots.select("tree", "height", "digest"))
    above, root = grown(roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(bounds["top"]).alias("height"),
                                     F.col("tree").alias("place"), "digest"), bounds["top"])
    segment = F.array(F.struct("sibling", "right")).alias("siblings")
    top = F.lit(TOP)
    ways = steps.select(F.col("tree").cast("long").alias("tree"), F.col("level").cast("int").alias("level"), F.col("place").cast("long").alias("place"), F.when(
        F.col("level") + 1 == F.col("height"), node(top, F.lit(0), F.col("tree"))).otherwise(
        node(F.col("tree"), F.col("level") + 1, F.shiftright("place", 1))).alias("up"), segment)
    ways = ways.unionByName(above.select(F.col("tree").cast("long").alias("tree"), F.col("level").cast("int").alias("level"), F.col("place").cast("long").alias("place"),
                                         node(top, F.col("level") + 1, F.shiftright("place", 1)).alias("up"), segment))
    proofs = to_root(ways, bounds["tallest"] + bounds["top"]).where("level = 0").select(
        F.col("tree").alias("__tree"), F.col("place").alias("__place"), "siblings")
    # the only leaf of a group is itself a node of the top tree
    alone = F.col("height") == 0
    own = leaves.withColumns({"__t": F.when(alone, top).otherwise(F.col("tree")).cast("long"),
                              "__p": F.when(alone, F.col("tree")).otherwise(F.col("place"))})
    out = own.join(proofs, (F.col("__t") == F.col("__tree")) & (F.col("__p") == F.col("__place")), "left")
    ends = roots.select(F.col("tree").alias("__r"), F.col("digest").alias("subroot"))
    out = out.join(ends, F.col("tree") == F.col("__r")).crossJoin(F.broadcast(root.select(F.col("digest").alias("root"))))
    none = F.expr("cast(array() as array<struct<sibling: binary, right: boolean>>)")
    return out.select(*rows.columns, "subroot", "root", F.coalesce("siblings", none).alias("siblings"))


def folded(start: Column, siblings: Column) -> Column:
    """The root that a leaf digest and a proof lead to."""
    def step(now: Column, s: Column) -> Column:
        other = F.lower(F.hex(s["sibling"]))
        return F.when(other.isNull(), digest(now)).when(s["right"], digest(now, other)).otherwise(digest(other, now))
    return F.aggregate(siblings, start, step)


def proof_digest(siblings: Column) -> Column:
    """Digest of all siblings of a proof, in order."""
    present = F.filter(siblings, lambda s: s["sibling"].isNotNull())
    return F.sha2(F.array_join(F.transform(present, lambda s: F.lower(F.hex(s["sibling"]))), ""), 256)


def audited(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document.

    The documents whose id's CRC-32 is divisible by 7 are tampered with (1 more
    in ``n_chars``), and every proof is checked from what the tampered table
    holds. A null id is never tampered with, nor is a null ``n_chars``.
    """
    def of(n_chars: Column) -> Column:
        return leaf(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    changed = F.when(tampered, of(F.col("n_chars") + 1))  # only these are hashed twice
    rows = materialize(docs.select("doc_id", "lang", of(F.col("n_chars")).alias("leaf"), changed.alias("changed"))
                       .withColumn("uid", F.monotonically_increasing_id()))
    proven = manifest(rows, "lang", ["doc_id", "leaf", "uid"])
    out = proven.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("siblings")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("siblings")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
