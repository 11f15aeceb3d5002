"""A Merkle manifest of a table, and proofs folded from copied hash states.

Every row is a leaf. The leaves of a part (such as a source) ascend by their key and are
joined in runs of three, level by level, to the part's root; the parts' roots, in order of
the parts, give the root of all. A parent keeps a copy of its hash state before each
child's slot. A leaf that is replaced is folded by resuming those states: that of its
slot, the replacement, the digests to its right, and so on to the root; what lies to the
left is never hashed again.

Trees are built in blocks of ``BLOCK`` nodes, one group of a shuffle each, and the roots of
the blocks are the nodes of the next pass, so a pass takes 6 levels and no group grows
with the table, however large one part is.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiledger.llm.common import cut
from entiledger.operators.joins import lookup_join

#: Children of a parent, levels of a block, and the nodes that they join to one.
RUN = 3
LEVELS = 6
BLOCK = RUN**LEVELS

#: A proof: on each level the slot, and the digests in the other slots.
PROOF = "array<struct<slot:int,others:array<string>>>"
_PROOF = pa.list_(pa.struct([("slot", pa.int32()), ("others", pa.list_(pa.string()))]))
_NODE = "tree long, pos long, size long, digest string"


def digest(columns: Sequence[Column]) -> Column:
    """sha256 over the values, each `-` if null, else its UTF-8 bytes' count, `:`, value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class Parent:
    """A parent's digest, with its hash state before each child's slot."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: Sequence[str]):
        state = sha256()
        self.children, self.states = children, []
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def replaced(self, slot: int, child: str) -> str:
        """Digest with another child in a slot: only what follows is hashed."""
        state = self.states[slot].copy()
        state.update(child.encode())
        for right in self.children[slot + 1 :]:
            state.update(right.encode())
        return state.hexdigest()

    def others(self, slot: int) -> list[str]:
        """The slot's siblings, left to right."""
        return [c for i, c in enumerate(self.children) if i != slot]


def tree(leaves: Sequence[str], levels: int | None = None) -> list[list[Parent]]:
    """Parents level by level, until one is left or for a number of levels."""
    out, nodes = [], list(leaves)
    while len(out) < levels if levels is not None else len(nodes) > 1:
        out.append([Parent(nodes[i : i + RUN]) for i in range(0, len(nodes), RUN)])
        nodes = [p.digest for p in out[-1]]
    return out


def path(levels: Sequence[Sequence[Parent]], place: int) -> Iterator[tuple[Parent, int]]:
    """(parent, slot) of a leaf on every level."""
    for parents in levels:
        place, slot = divmod(place, RUN)
        yield parents[place], slot


def resumed(steps: Sequence[tuple[int, list[str]]]) -> list[tuple[Parent, int]]:
    """Parents above a block, from the slot and the siblings on each level.

    Their states before the slot hold all that lies to its left; the child in the slot
    itself is left open.
    """
    return [(Parent([*s[:slot], "", *s[slot:]]), slot) for slot, s in steps]


def ordered(df: DataFrame, by: Sequence[str], into: str) -> DataFrame:
    """df with each row's place from 0 in the order of columns, written to the checkpoints.

    Rows that are equal in all of them come in any order, but must agree in all else that
    is used. Ranges of the order, not keys, are dealt out, so a column with one value in
    very many rows is no matter as long as the columns together differ. Only one number
    for each range meets in one task.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = 33  # of monotonically_increasing_id: its low bits count the rows of a task
    sorted_ = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    rows = cut(sorted_.withColumn("_at", F.monotonically_increasing_id()))
    task, row = F.shiftright("_at", bits), F.col("_at").bitwiseAND((1 << bits) - 1)
    sizes = rows.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"))
    # At most one row for each shuffle partition.
    placed = rows.withColumn("_task", task).join(F.broadcast(ahead), "_task")
    return placed.withColumn(into, F.col("_n") + row).drop("_task", "_n", "_at")


def _built(digests: Sequence[str], size: int) -> list[list[Parent]]:
    """Parents of a block: all its levels if its tree has more blocks, else up to one."""
    return tree(digests, LEVELS if size > BLOCK else None)


def _block(nodes: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("pos")
    digests = nodes.column("digest").to_pylist()
    name, pos, size = (nodes.column(c)[0].as_py() for c in ("tree", "pos", "size"))
    levels = _built(digests, size)
    top = levels[-1][0].digest if levels else digests[0]
    return pa.table(
        {
            "tree": pa.array([name], pa.int64()),
            "pos": pa.array([pos // BLOCK], pa.int64()),
            "size": pa.array([-(-size // BLOCK)], pa.int64()),
            "digest": pa.array([top], pa.string()),
        }
    )


def _by_block(nodes: DataFrame):
    place = F.expr(f"pos div {BLOCK}").alias("_block")
    return nodes.groupBy("tree", place)


def _passes(nodes: DataFrame) -> list[DataFrame]:
    """Nodes (tree, pos, size, digest), their blocks, and so on to one node a tree.

    ``size`` is the number of nodes that the tree has in that pass.
    """
    out = [nodes]
    while out[-1].agg(F.max("size")).first()[0] > 1:
        blocks = _by_block(out[-1].select("tree", "pos", "size", "digest"))
        out.append(cut(blocks.applyInArrow(_block, _NODE)))
    return out


def _steps(levels: Sequence[Sequence[Parent]], place: int) -> list[dict]:
    return [
        {"slot": slot, "others": parent.others(slot)} for parent, slot in path(levels, place)
    ]


def _extended(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """The proofs of a block's nodes, from the proof of the block."""
    nodes = nodes.sort_by("pos")
    digests = nodes.column("digest").to_pylist()
    levels = _built(digests, nodes.column("size")[0].as_py())
    rest, subroot = (above.column(c)[0].as_py() for c in ("proof", "subroot"))
    proofs = [_steps(levels, place) + rest for place in range(len(digests))]
    kept = nodes.select(["tree", "pos"])
    kept = kept.append_column("proof", pa.array(proofs, _PROOF))
    return kept.append_column("subroot", pa.array([subroot] * len(proofs), pa.string()))


def _folded(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Proofs of a block's leaves, and the root that each leaf's replacement leads to."""
    nodes = nodes.sort_by("pos")
    digests = nodes.column("digest").to_pylist()
    levels = _built(digests, nodes.column("size")[0].as_py())
    rest, subroot = (above.column(c)[0].as_py() for c in ("proof", "subroot"))
    higher = resumed([(s["slot"], s["others"]) for s in rest])
    proofs, roots = [], []
    for place, fresh in enumerate(nodes.column("fresh").to_pylist()):
        value = digests[place] if fresh is None else fresh
        for parent, slot in [*path(levels, place), *higher]:
            value = parent.replaced(slot, value)
        roots.append(value)
        proofs.append(_steps(levels, place) + rest)
    kept = nodes.select(["key", "part", "digest"]).rename_columns(["key", "part", "leaf"])
    kept = kept.append_column("subroot", pa.array([subroot] * len(roots), pa.string()))
    kept = kept.append_column("proof", pa.array(proofs, _PROOF))
    return kept.append_column("folded_root", pa.array(roots, pa.string()))


def _proved(passes: Sequence[DataFrame], top: DataFrame) -> DataFrame:
    """(tree, pos, proof, subroot) of the nodes of the first pass, from the last one's."""
    above = top
    for nodes in reversed(passes[:-1]):
        both = _by_block(nodes).cogroup(above.groupBy("tree", "pos"))
        kind = f"tree long, pos long, proof {PROOF}, subroot string"
        above = both.applyInArrow(_extended, kind)
    return above


def _tops(parts: DataFrame, subroots: DataFrame) -> tuple[DataFrame, str]:
    """(tree, pos, proof, subroot) of the parts in the tree of their roots, and its root."""
    spark = parts.sparkSession
    ranked = ordered(parts.select("tree"), ["tree"], "pos").join(subroots, "tree")
    names = cut(ranked.select(F.col("tree").alias("part_tree"), "pos", "subroot"))
    nodes = names.select(
        F.lit(0).cast("long").alias("tree"),
        "pos",
        F.lit(parts.count()).cast("long").alias("size"),
        F.col("subroot").alias("digest"),
    )
    passes = _passes(nodes)
    # The one node of the last pass.
    root = passes[-1].first()["digest"]
    kind = f"tree long, pos long, proof {PROOF}, subroot string"
    proofs = _proved(passes, spark.createDataFrame([(0, 0, [], None)], kind))
    top = proofs.select("pos", "proof").join(names, "pos")
    place = F.lit(0).cast("long").alias("pos")
    return top.select(F.col("part_tree").alias("tree"), place, "proof", "subroot"), root


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    by: str = "source",
    key: str = "doc_id",
    changed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(key, part, leaf, subroot, root, proof, folded_root) for each row of docs.

    A leaf is the digest of ``columns``. Leaves of equal ``by`` (a null is a part of its
    own, the first) ascend by ``key``, nulls first, and by digest where keys repeat.
    ``proof`` has the slot and the siblings on each level, of the part's tree and of that
    of the parts. ``folded_root`` is what the proof gives with the ``changed`` columns in
    the row, the root itself where that changes nothing. Other columns of docs are left
    out; no rows give none.
    """
    others = [(changed or {}).get(c, F.col(c)) for c in columns]
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(by).alias("part"),
        digest([F.col(c) for c in columns]).alias("digest"),
        digest(others).alias("fresh"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written before it is dealt out: texts are read once, rows keep their numbers.
    rows = cut(rows.withColumn("fresh", F.expr("nullif(fresh, digest)")))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    result = (
        f"key {kinds['key']}, part {kinds['part']}, leaf string, subroot string, "
        f"proof {PROOF}, folded_root string"
    )
    if rows.isEmpty():
        none = docs.sparkSession.createDataFrame([], result)
        return none.withColumn("root", F.lit(None).cast("string"))
    rows = ordered(rows, ["part", "key", "digest", "row"], "place").withColumn(
        "name", F.coalesce(F.concat(F.lit("="), F.col("part").cast("string")), F.lit("-"))
    )
    parts = cut(
        rows.groupBy("name").agg(
            F.min("place").alias("tree"), F.count(F.lit(1)).alias("size")
        )
    )
    leaves = cut(
        lookup_join(rows, parts, "name", "inner", ["row"]).select(
            "key", "part", "tree", (F.col("place") - F.col("tree")).alias("pos"),
            "size", "digest", "fresh",
        )
    )
    passes = _passes(leaves)
    subroots = passes[-1].select("tree", F.col("digest").alias("subroot"))
    top, root = _tops(parts, subroots)
    above = _proved(passes[1:], top)
    both = _by_block(leaves).cogroup(above.groupBy("tree", "pos"))
    return both.applyInArrow(_folded, result).withColumn("root", F.lit(root))
