"""A Merkle manifest of a dataset: a 16-ary hash tree of each source's rows, a tree over the sources, and a witness
of every row.

Witnesses grow while a tree is appended to. A node that is appended joins the open run of its level and holds no
witness yet; when its run completes, it gets its siblings and its place, and the run's digest is appended one level
up, where its own siblings follow once they are there. So a leaf's witness is the chain of its ancestors' parts, each
attached once to an open subtree and shared by everything below.

A tree is cut into aligned blocks of 16^3 nodes. A task appends the nodes of one block; the roots of blocks are
appended as the nodes of the next, much smaller tree, however many there are, and so are the roots of the sources.
Going back down, each block is appended again and its witnesses are extended by the one of its root. No tree, source
or list of nodes is held by one task or by the driver.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import written
from tallybook.operators.ordering import global_row_number

ARITY = 16
#: Levels of a block; a task holds 16 to this power nodes.
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_HEX = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CARRIED = "at array<int>, others array<string>, subroot string, root string"


def _field(value: Column) -> Column:
    """Its UTF-8 length, a colon and the value, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(_field, (doc_id, source, lang, n_chars, text))), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


class Node:
    __slots__ = ("digest", "at", "others", "parent")

    def __init__(self, digest: bytes):
        self.digest, self.at, self.others, self.parent = digest, 0, b"", None


class Appender:
    """An aligned block that nodes are appended to, one after the other."""

    def __init__(self) -> None:
        self.open: list[list[Node]] = [[]]

    def append(self, digest: bytes) -> Node:
        node = Node(digest)
        self._push(node, 0)
        return node

    def _push(self, node: Node, level: int) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [node.digest for node in run]
        parent = Node(sha256(b"".join(digests)).hexdigest().encode())
        for k, node in enumerate(run):  # whatever hangs on the node has its witness extended by this
            node.at, node.others, node.parent = k, b"".join(digests[:k] + digests[k + 1 :]), parent
        self._push(parent, level + 1)

    def close(self, levels: int) -> Node:
        """Complete the runs that are still open, up to ``levels``, and return the block's root."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        (root,) = self.open[levels]
        return root


def tree_levels(n: int) -> int:
    """Levels above the nodes of a tree of n."""
    levels = 0
    while ARITY**levels < n:
        levels += 1
    return levels


def _appended(digests: list[str], n: int, block_levels: int) -> tuple[list[Node], Node]:
    """A block's nodes with their witnesses within it, and its root; n is the size of the whole tree."""
    block = Appender()
    nodes = [block.append(x.encode()) for x in digests]
    return nodes, block.close(min(tree_levels(n), block_levels))


def _chain(node: Node) -> tuple[list[int], list[str]]:
    at, others = [], []
    while node.parent is not None:
        at.append(node.at)
        others.append(node.others.decode())
        node = node.parent
    return at, others


def _blocks(nodes: DataFrame, block_levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {ARITY**block_levels}"))


def block_roots(nodes: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``tree, n, place, digest`` of the roots of all blocks of such rows: the nodes of the next tree.

    ``n`` is the number of a tree's nodes and ``place`` a node's, from 0 on.
    """
    size = ARITY**block_levels

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n = table.column("n")[0].as_py()
        _, root = _appended(table.column("digest").to_pylist(), n, block_levels)
        return pa.table({
            "tree": table.column("tree").slice(0, 1),
            "n": pa.array([-(-n // size)], pa.int64()),
            "place": table.column("block").slice(0, 1),
            "digest": pa.array([root.digest.decode()]),
        })

    narrow = _blocks(nodes.select("tree", "n", "place", "digest"), block_levels)
    return narrow.groupBy("tree", "block").applyInArrow(work, "tree long, n long, place long, digest string")


def phases(nodes: DataFrame, label: str, block_levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """The nodes, the roots of their blocks, the roots of those, and so on to one root for each tree.

    Only the size of the largest tree reaches the driver.
    """
    most = nodes.agg(F.max("n")).first()[0] or 1
    out = [nodes]
    while most > 1:
        out.append(written(block_roots(out[-1], block_levels), label))
        most = -(-most // ARITY**block_levels)
    return out


def extended(nodes: DataFrame, above: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``tree, place`` of each node, its witness (``at`` and ``others``, level by level), and ``subroot, root``.

    ``above`` has the same for the root of each block, as the node of its own tree. ``at`` is the place within the
    run, ``others`` the digests of the run's other nodes.
    """

    def work(table: pa.Table, carried: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n = table.column("n")[0].as_py()
        held, _ = _appended(table.column("digest").to_pylist(), n, block_levels)
        top_at, top_others = carried.column("at")[0].as_py(), carried.column("others")[0].as_py()
        at, others = [], []
        for node in held:
            a, o = _chain(node)
            at.append(a + top_at)
            others.append(o + top_others)
        same = lambda name: pa.array([carried.column(name)[0].as_py()] * len(held), pa.string())
        return pa.table({
            "tree": table.column("tree"),
            "place": table.column("place"),
            "at": pa.array(at, pa.list_(pa.int32())),
            "others": pa.array(others, pa.list_(pa.string())),
            "subroot": same("subroot"),
            "root": same("root"),
        })

    left = _blocks(nodes.select("tree", "n", "place", "digest"), block_levels).groupBy("tree", "block")
    right = above.withColumnRenamed("place", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInArrow(work, f"tree long, place long, {_CARRIED}")


def _down(held: list[DataFrame], above: DataFrame, label: str, block_levels: int) -> DataFrame:
    """The witnesses of the blocks of the first phase, from those of the trees' roots on."""
    for nodes in reversed(held[1:-1]):
        above = written(extended(nodes, above, block_levels), label)
    return above


def leaves(documents: DataFrame) -> DataFrame:
    """``source, doc_id, leaf, altered`` of every row.

    ``altered`` is the leaf of a row that was tampered with (lower-cased text), for every fifth checksum of an id.
    """
    doc_id, n_chars = F.col("doc_id").cast("long"), F.col("n_chars").cast("long")
    source, lang, text = (F.col(name).cast("string") for name in ("source", "lang", "text"))
    struck = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    return documents.select(
        source.alias("source"),
        doc_id.alias("doc_id"),
        leaf_digest(doc_id, source, lang, n_chars, text).alias("leaf"),
        F.when(struck, leaf_digest(doc_id, source, lang, n_chars, lower_ascii(text))).alias("altered"),
    )


def witnesses(documents: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """``doc_id, leaf, altered, subroot, root, at, others`` of every row: its leaf and the witness up to the root.

    Reads ``doc_id, source, lang, n_chars, text`` only. Rows of one source are ordered by doc_id (null first), those
    of one id by their leaf; rows without a source form a source of their own, which comes first. Repeated rows are
    leaves each. A null field counts as a dash; a tampered row without text keeps its leaf. An empty table has no
    leaf and no root.
    """
    spark = documents.sparkSession
    rows = written(leaves(documents), "leaves")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    numbered = written(global_row_number(rows, order, "number"), "leaves-in-order")
    trees = numbered.groupBy("source").agg(F.min("number").alias("tree"), F.count("*").alias("n"))
    trees = written(trees.withColumnRenamed("source", "of"), "sources")
    placed = numbered.join(trees, F.col("source").eqNullSafe(F.col("of")))
    placed = placed.select(
        "tree", "n", (F.col("number") - F.col("tree")).alias("place"), F.col("leaf").alias("digest"), "doc_id", "altered"
    )
    own = phases(placed, "source-blocks", block_levels)

    # the sources' roots, in the order of the sources, as the nodes of one more tree
    subroots = own[-1].select("tree", F.col("digest").alias("subroot"))
    ranked = written(global_row_number(subroots, ["tree"], "rank"), "subroots")
    number = ranked.count()
    top = phases(
        ranked.select(
            F.lit(-1).cast("long").alias("tree"), F.lit(number).cast("long").alias("n"), F.col("rank").alias("place"),
            F.col("subroot").alias("digest"),
        ),
        "top-blocks",
        block_levels,
    )
    none = lambda kind: F.array().cast(f"array<{kind}>")
    root = top[-1].select(
        "tree", "place", none("int").alias("at"), none("string").alias("others"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    over = extended(top[0], _down(top, root, "top-witnesses", block_levels), block_levels)
    over = over.drop("subroot").join(ranked.withColumnRenamed("tree", "source_tree"), F.col("place") == F.col("rank"))
    over = over.select(
        F.col("source_tree").alias("tree"), F.lit(0).cast("long").alias("place"), "at", "others", "subroot", "root"
    )
    over = _down(own, written(over, "source-witnesses"), "block-witnesses", block_levels)
    return _leaf_witnesses(placed, over, block_levels)


def _leaf_witnesses(placed: DataFrame, above: DataFrame, block_levels: int) -> DataFrame:
    def work(table: pa.Table, carried: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n = table.column("n")[0].as_py()
        held, _ = _appended(table.column("digest").to_pylist(), n, block_levels)
        top_at, top_others = carried.column("at")[0].as_py(), carried.column("others")[0].as_py()
        chains = [_chain(node) for node in held]
        same = lambda name: pa.array([carried.column(name)[0].as_py()] * len(held), pa.string())
        return pa.table({
            "doc_id": table.column("doc_id"),
            "leaf": table.column("digest"),
            "altered": table.column("altered"),
            "subroot": same("subroot"),
            "root": same("root"),
            "at": pa.array([a + top_at for a, _ in chains], pa.list_(pa.int32())),
            "others": pa.array([o + top_others for _, o in chains], pa.list_(pa.string())),
        })

    left = _blocks(placed, block_levels).groupBy("tree", "block")
    right = above.withColumnRenamed("place", "block").groupBy("tree", "block")
    schema = "doc_id long, leaf string, altered string, subroot string, root string, at array<int>, others array<string>"
    return left.cogroup(right).applyInArrow(work, schema)


def folded(digest: Column, at: Column, others: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    steps = F.arrays_zip(at.alias("at"), others.alias("others"))

    def up(own: Column, step: Column) -> Column:
        ahead = step["at"] * _HEX
        rest = F.substring(step["others"], ahead + 1, F.length(step["others"]))
        return F.sha2(F.concat(F.substring(step["others"], F.lit(1), ahead), own, rest), 256)

    return F.aggregate(steps, digest, up)


def proof_digest(others: Column) -> Column:
    """One digest of all the siblings of a witness, level by level."""
    return F.sha2(F.concat_ws("", others), 256)
