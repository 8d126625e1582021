"""A hash tree over all rows: subtrees per language, one root, and a proof per row found by pointer jumping.

Rows become leaves, leaves are numbered within their language by position in (doc_id, leaf) order, and every ``FAN`` neighbours
become one node, level after level; the subtrees' tops make a last tree in the same way. A node then holds the siblings on the
way to its parent and a pointer to it. Joining the nodes with themselves on that pointer appends the ancestor's way to their own and
doubles the distance, so a tree of h levels needs about log2(h) joins. The inner nodes, a seventh of the rows, are written after each doubling;
leaves go through the same joins in one lazy chain, each at most once through a shuffle per doubling.

Siblings are kept as raw digests: those to the left and those to the right of the way, level by level. At distance d up to ``FAN ** d``
nodes share an ancestor; beyond four levels the ancestor's row is repeated so that no more than ``FAN ** 4`` of them meet.

Defined cases: NULL columns hash as ``-``; rows without doc_id come first, those without lang are a tree of their own, before all
others and apart from the empty lang; rows repeated in all five columns are equal leaves next to each other, other rows of one doc_id stand in
the order of their leaves. A lone leaf is its subtree's top, a lone top the root. An empty table gives no rows. Further columns
are not part of a leaf.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

#: Nodes that become one node of the next level.
FAN = 8

#: Columns of a leaf, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

#: Name of the tree over the subtrees' tops; languages are ``b`` and their value, ``a`` where NULL, so that names sort as they must.
TOP = "c"


def digest(*hex_parts: Column) -> Column:
    """SHA-256 over hexadecimal digests written one after the other, as raw bytes."""
    return F.unhex(F.sha2(F.concat(*hex_parts), 256))


def hexed(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def leaf(df: DataFrame, changed: dict[str, Column] | None = None) -> Column:
    """Digest of a row: byte count, colon and value of every field, ``-`` where NULL."""
    cells = []
    for c in FIELDS:
        v = (changed or {}).get(c, F.col(c)).cast("string")
        cells.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*cells), 256))


def lowered(c: str = "text") -> Column:
    """The text with A-Z in lower case and nothing else changed."""
    return F.translate(F.col(c), string.ascii_uppercase, string.ascii_lowercase)


def numbered(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Attach ``pos``, the 0-based position of a row within its tree, and ``size``, the rows of that tree.

    Rows are sorted over range partitions; the rows of lower partitions are counted per tree, one number for each tree and partition. The
    ranged rows are written first, so that both reads see the same partitions. ``order`` must be total but for rows equal in all columns.
    """
    marked = stored(df.withColumn("spare", F.monotonically_increasing_id()), "merkle-marked")
    ranged = marked.repartitionByRange(*[F.col(c) for c in (tree, *order, "spare")]).sortWithinPartitions(tree, *order, "spare").drop("spare")
    ranged = stored(ranged.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")), "merkle-ranged")
    each = ranged.groupBy(tree, "range").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("first"))
    lower = W.partitionBy(tree).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    shifts = each.select(tree, "range", "first", F.coalesce(F.sum("here").over(lower), F.lit(0)).alias("below"), F.sum("here").over(W.partitionBy(tree)).alias("size"))
    return ranged.join(shifts, [tree, "range"]).withColumn("pos", F.col("at") - F.col("first") + F.col("below")).drop("range", "at", "first", "below")


def _runs(level: DataFrame) -> DataFrame:
    """Neighbours that share a parent, as one row: tree, up (the parent's position), size of this level, kids in order."""
    up = F.floor(F.col("pos") / F.lit(FAN)).cast("long").alias("up")
    kid = F.struct("pos", "digest", "payload")
    return level.where("size > 1").groupBy("tree", up).agg(F.first("size").alias("size"), F.array_sort(F.collect_list(kid)).alias("kids"))


def _parents(runs: DataFrame) -> DataFrame:
    joined = F.array_join(F.transform("kids", lambda k: hexed(k["digest"])), "")
    return runs.select("tree", F.col("up").alias("pos"), F.ceil(F.col("size") / F.lit(FAN)).cast("long").alias("size"), digest(joined).alias("digest"), F.lit(None).alias("payload"))


def _with_siblings(runs: DataFrame, level: int) -> DataFrame:
    """Every kid with its siblings and the pointer to its parent."""
    raw = lambda kids: F.aggregate(kids, F.unhex(F.lit("")), lambda acc, k: F.concat(acc, k["digest"]))
    kids = runs.select("tree", "up", "kids", F.posexplode("kids").alias("i", "kid"))
    way = F.struct(
        raw(F.slice("kids", F.lit(1), F.col("i"))).alias("left"), raw(F.slice("kids", F.col("i") + 2, F.greatest(F.size("kids") - F.col("i") - 1, F.lit(0)))).alias("right")
    )
    return kids.select(
        "tree", F.lit(level).alias("level"), F.col("kid.pos").alias("pos"), F.col("kid.digest").alias("digest"), F.col("kid.payload").alias("payload"),
        F.array(way).alias("way"), F.struct(F.col("tree"), F.lit(level + 1).alias("level"), F.col("up").alias("pos")).alias("to"),
    )


class Forest:
    """Levels of all trees: ``runs`` per level and ``tops``, one row per tree."""

    def __init__(self, leaves: DataFrame, name: str):
        """``leaves`` has tree, pos, size, digest and payload."""
        self.runs: list[DataFrame] = []
        tops = []
        level = leaves
        # one number: the leaves of the largest tree
        largest = leaves.agg(F.max("size")).first()[0] or 0
        while True:
            tops.append(level.where("size = 1").withColumn("level", F.lit(len(self.runs))))
            if largest <= 1:
                break
            runs = stored(_runs(level), f"merkle-{name}-{len(self.runs)}")
            self.runs.append(runs)
            kind = runs.schema["kids"].dataType.elementType["payload"].dataType
            level = _parents(runs).withColumn("payload", F.col("payload").cast(kind))
            largest = -(-largest // FAN)
        out = tops[0]
        for t in tops[1:]:
            out = out.unionByName(t)
        self.tops = stored(out, f"merkle-{name}-tops")

    def nodes(self, level: int) -> DataFrame:
        return _with_siblings(self.runs[level], level)


def _jump(nodes: DataFrame, ancestors: DataFrame, distance: int) -> DataFrame:
    """Append the way of the node each pointer names, and take over that node's pointer."""
    copies = FAN ** max(0, distance - 4)
    salt = F.pmod(F.floor(F.col("pos") / F.lit(FAN**4)), F.lit(copies)).cast("int")
    far = ancestors.select(
        F.col("tree").alias("a_tree"), F.col("level").alias("a_level"), F.col("pos").alias("a_pos"), F.col("way").alias("a_way"), F.col("to").alias("a_to"), F.col("sub").alias("a_sub"),
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("a_salt"),
    )
    here = nodes.where(F.col("to").isNotNull()).withColumn("salt", salt)
    met = here.join(far, (F.col("to.tree") == F.col("a_tree")) & (F.col("to.level") == F.col("a_level")) & (F.col("to.pos") == F.col("a_pos")) & (F.col("salt") == F.col("a_salt")))
    moved = met.withColumns({"way": F.concat("way", "a_way"), "to": F.col("a_to"), "sub": F.coalesce("sub", "a_sub")}).select(*nodes.columns)
    return moved.unionByName(nodes.where(F.col("to").isNull()))


def proofs(leaves: DataFrame) -> tuple[DataFrame, str | None]:
    """(digest, payload, way, sub) of every leaf, and the root in hexadecimal digits.

    ``leaves`` has tree, order columns ``doc_id`` and ``digest``, and a payload. ``way`` lists the siblings from the leaf to the
    root, ``sub`` is the digest of the leaf's subtree.
    """
    forest = Forest(numbered(leaves, "tree", ["doc_id", "digest"]).select("tree", "pos", "size", "digest", "payload"), "sub")
    kind = forest.tops.schema["payload"].dataType
    # the tops of the subtrees, in the order of the trees' names, are the leaves of the last tree
    listed = forest.tops.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), F.col("level").alias("height"), "digest", "payload")
    ranked = numbered(listed, "tree", ["name"])
    named = F.struct("name", "height", "payload")
    last = Forest(ranked.select("tree", "pos", "size", "digest", named.alias("payload")), "top")
    root = last.tops.select(hexed(F.col("digest"))).first()

    columns = ["tree", "level", "pos", "digest", "payload", "way", "to", "sub"]
    none = lambda c: c.cast("binary")
    inner = [forest.nodes(i).withColumn("sub", none(F.lit(None))) for i in range(len(forest.runs))]
    bottom = inner[0] if inner else None
    parts = inner[1:]
    crowns = []
    for i in range(len(last.runs)):
        here = last.nodes(i)
        if i == 0:
            # these rows are the tops of the subtrees: they keep the names their children point to
            here = here.select(F.col("payload.name").alias("tree"), F.col("payload.height").alias("level"), F.lit(0).cast("long").alias("pos"), "digest", F.col("payload.payload").alias("payload"), "way", "to", F.col("digest").alias("sub"))
            crowns.append(here)
        else:
            here = here.withColumns({"sub": none(F.lit(None)), "payload": F.lit(None).cast(kind)})
            parts.append(here.select(*columns))
    # the root ends all ways; with a single tree it is that tree's top
    way, to = F.array().cast("array<struct<left: binary, right: binary>>"), F.lit(None).cast("struct<tree: string, level: int, pos: bigint>")
    end = last.tops.select("tree", "level", "pos", "digest", "payload").withColumns({"way": way, "to": to})
    lone = end.where("level = 0").select(F.col("payload.name").alias("tree"), F.col("payload.height").alias("level"), F.lit(0).cast("long").alias("pos"), "digest", F.col("payload.payload").alias("payload"), "way", "to", F.col("digest").alias("sub"))
    crowns.append(lone)
    parts.append(end.where("level > 0").withColumns({"payload": F.lit(None).cast(kind), "sub": none(F.lit(None))}).select(*columns))
    tops = crowns[0]
    for c in crowns[1:]:
        tops = tops.unionByName(c)
    parts.append(tops.where("level > 0"))
    state = parts[0].select(*columns)
    for p in parts[1:]:
        state = state.unionByName(p.select(*columns))
    out = tops.where("level = 0").select(*columns)
    if bottom is not None:
        out = out.unionByName(bottom.select(*columns))
    # every leaf reaches the end after as many steps as there are levels
    steps = len(forest.runs) + len(last.runs)
    distance = 1
    state = stored(state, "merkle-nodes-1")
    while distance <= steps:
        reachable = state.where((F.col("level") >= distance) | (F.col("tree") == TOP))
        out = _jump(out, reachable, distance)
        if 2 * distance <= steps:
            state = stored(_jump(state, reachable, distance), f"merkle-nodes-{2 * distance}")
        distance *= 2
    return out.select("digest", "payload", "way", "sub"), root[0] if root else None


def fold(start: Column, way: Column) -> Column:
    """Root that a leaf's digits and its siblings lead to."""
    return F.aggregate(way, start, lambda acc, s: F.sha2(F.concat(hexed(s["left"]), acc, hexed(s["right"])), 256))


def leaves_of(docs: DataFrame, tamper: Column | None = None, changed: dict[str, Column] | None = None) -> DataFrame:
    """tree, doc_id, digest and payload (doc_id and the digest of the changed row, NULL where it is the same)."""
    tree = F.coalesce(F.concat(F.lit("b"), F.col("lang").cast("string")), F.lit("a"))
    other = F.lit(None).cast("binary") if tamper is None else F.when(tamper, leaf(docs, changed))
    made = docs.select(tree.alias("tree"), "doc_id", leaf(docs).alias("digest"), other.alias("other"))
    return made.select("tree", "doc_id", "digest", F.struct("doc_id", F.when(F.col("other") != F.col("digest"), F.col("other")).alias("other")).alias("payload"))


def manifest(docs: DataFrame, tamper: Column | None = None, changed: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and the number of levels a proof has.

    Rows for which ``tamper`` holds are folded from a leaf with the ``changed`` columns, with the siblings of the untouched tree.
    """
    found, root = proofs(leaves_of(docs, tamper, changed))
    proof = F.sha2(F.array_join(F.transform("way", lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), ""), 256)
    folded = fold(hexed(F.coalesce("payload.other", "digest")), F.col("way"))
    out = found.select(
        F.col("payload.doc_id").alias("doc_id"), hexed(F.col("digest")).alias("leaf"), hexed(F.col("sub")).alias("subroot"), F.lit(root).cast("string").alias("root"),
        proof.alias("proof_sha256"), folded.alias("folded_root"), F.size("way").alias("n_levels"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(docs: DataFrame) -> DataFrame:
    """The manifest in which texts are lower-cased where 3 divides the CRC-32 of doc_id."""
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return manifest(docs, third, {"text": lowered()})
