"""Merkle manifest of a dataset with a membership witness per row (operator 12).

Rows become leaves, digests of their columns. Per group the leaves stand in
order; every two consecutive nodes become their digest until one is left, the
group's subroot; subroots, ordered by group, give the root the same way. A
node that stands alone on its level, while the level has others, becomes the
digest of itself.

Witnesses are built incrementally. Leaves are dealt into aligned blocks of
``SPAN`` places. A task appends the leaves of a block one by one to a frontier
of open subtrees; a completed sibling extends the partial witness of every
leaf under the subtree that waited for it, and closing the block settles what
is still open. Block roots are appended in the same way a level of blocks
higher, until a group has one block; the steps found there extend the
witnesses of all leaves of the block. So no task ever sees more than ``SPAN``
nodes, however large the group, and one number a round reaches the driver.

A witness is an array of steps from the leaf to the root: ``L`` or ``R`` (the
side on which the sibling stands) and the sibling's digest, or ``N`` where a
node stands alone.

Defined cases: a null group is a group of its own, first in order; a null
doc_id comes first in its group; rows with the same doc_id are ordered by
their leaf; repeated rows are leaves each; a null column is ``-`` in the leaf,
an empty text ``0:``; texts of any length are digested whole, as one value;
other columns, also those named like the ones used here, are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm.common import written

#: log2 of the leaves in a block; a block is what one task holds at a time.
SPAN_BITS = 10
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7
_AT_BITS = 33  # monotonically_increasing_id: partition << 33 | place


def digest(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf_of(*columns: Column) -> Column:
    """The digest of a row: each value with its length, ``-`` for null."""
    as_text = [c.cast("string") for c in columns]
    return digest(
        F.concat(
            *[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in as_text]
        )
    )


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Frontier:
    """Appends nodes in order; ``steps`` has the witness of each so far."""

    def __init__(self) -> None:
        self.steps: list[list[str]] = []
        self.open: list[tuple[int, str, int, int]] = []  # level, root, first leaf, past the last

    def append(self, node: str) -> None:
        at = len(self.steps)
        self.steps.append([])
        self._settle(0, node, at, at + 1)

    def _settle(self, level: int, root: str, first: int, past: int) -> None:
        """A subtree is complete: it meets its left sibling or waits for its right one."""
        while self.open and self.open[-1][0] == level:
            _, left, start, _ = self.open.pop()
            for steps in self.steps[start:first]:
                steps.append("R" + root)
            for steps in self.steps[first:past]:
                steps.append("L" + left)
            root, first, level = _h(left + root), start, level + 1
        self.open.append((level, root, first, past))

    def close(self, height: int) -> str:
        """No more nodes: the root at ``height``."""
        while True:
            level, root, first, past = self.open.pop()
            if level == height:
                return root
            for steps in self.steps[first:past]:
                steps.append("N")
            self._settle(level + 1, _h(root), first, past)


def grown(block: pa.Table, bits: int) -> pa.Table:
    """The nodes of one block with their steps and the block's root. A group
    that fits one block ends at its own height, else every block at ``bits``."""
    block = block.sort_by("pos")
    n = block.column("n")[0].as_py()
    frontier = Frontier()
    for node in block.column("node").to_pylist():
        frontier.append(node)
    top = frontier.close(bits if n > 1 << bits else (n - 1).bit_length())
    return block.append_column("steps", pa.array(frontier.steps, pa.list_(pa.string()))).append_column(
        "top", pa.array([top] * block.num_rows, pa.string())
    )


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``pos``, the place within column ``g`` by ``order``, and
    ``n``, the number of rows of that group.

    Rows are range-sorted by group and order over all tasks, so a large group
    is many tasks. A row's place is its place in its sorted partition plus the
    rows of its group in earlier ones; those counts are one row per group and
    partition. A number per row breaks ties, so repeated rows split as well.
    """
    tied = written(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    key = ("g", *order, "tie")
    placed = written(
        tied.repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << _AT_BITS) - 1)),
        "ranked",
    )
    runs = placed.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("run"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    runs = written(
        runs.select(
            "g", "part",
            (F.coalesce(F.sum("run").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("run").over(whole).alias("n"),
        ),
        "runs",
    )
    return placed.join(runs, ["g", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop(
        "part", "at", "shift", "tie"
    )


def witnesses(nodes: DataFrame, bits: int = SPAN_BITS) -> DataFrame:
    """``nodes`` (``g, pos, n, node`` and more) with ``steps`` up to ``root``,
    the root of its group. See the module's text."""
    block = F.shiftright("pos", bits)
    steps = F.lit(None).cast("array<string>").alias("steps")
    schema = nodes.select("*", block.alias("block"), steps, F.lit(None).cast("string").alias("top")).schema
    low = written(
        nodes.withColumn("block", block)
        .groupBy("g", "block")
        .applyInArrow(lambda table: grown(table, bits), schema),
        "witnesses",
    )
    upper = low.where(F.col("pos") == F.shiftleft("block", bits)).where(F.col("n") > 1 << bits)
    upper = upper.select(
        "g", F.col("block").alias("pos"), F.expr(f"(n + {(1 << bits) - 1}) div {1 << bits}").alias("n"),
        F.col("top").alias("node"),
    )
    if upper.isEmpty():
        return low.drop("block").withColumnRenamed("top", "root")
    upper = witnesses(upper, bits).select("g", F.col("pos").alias("block"), F.col("steps").alias("more"), "root")
    steps = F.concat("steps", F.coalesce("more", F.array().cast("array<string>")))
    return (
        low.join(upper, ["g", "block"], "left")
        .withColumn("steps", steps)
        .withColumn("root", F.coalesce("root", "top"))
        .drop("block", "more", "top")
    )


def manifest(leaves: DataFrame, *keep: str, group: str, order: str, leaf: str, bits: int = SPAN_BITS) -> DataFrame:
    """``keep``, ``leaf, steps, subroot, root`` for every row of ``leaves``."""
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # bytewise, null first
    rows = leaves.select(
        g.alias("g"), F.col(order).alias("key"), F.col(leaf).alias("node"), F.struct(*keep).alias("row")
    )
    inner = witnesses(ranked(rows, "key", "node"), bits)
    subroots = written(
        inner.where("pos = 0").select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("root").alias("node")),
        "subroots",
    )
    outer = witnesses(ranked(subroots, "key"), bits).select(
        F.col("key").alias("g"), F.col("steps").alias("more"), F.col("root").alias("whole")
    )
    return inner.join(outer, "g").select(
        "row.*",
        F.col("node").alias("leaf"),
        F.concat("steps", "more").alias("steps"),
        F.col("root").alias("subroot"),
        F.col("whole").alias("root"),
    )


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    side, sibling = (lambda s: F.substr(s, F.lit(1), F.lit(1))), (lambda s: F.substr(s, F.lit(2)))
    return F.aggregate(
        steps,
        leaf,
        lambda node, s: digest(
            F.when(side(s) == "L", F.concat(sibling(s), node))
            .when(side(s) == "R", F.concat(node, sibling(s)))
            .otherwise(node)
        ),
    )


def proof_digest(steps: Column) -> Column:
    """The digest of the siblings of a witness, from the leaf's to the root's."""
    return digest(F.array_join(F.transform(steps, lambda s: F.substr(s, F.lit(2))), ""))


def tamper_check(docs: DataFrame, bits: int = SPAN_BITS) -> DataFrame:
    """The manifest of ``documents`` and the check of each row against it,
    where every seventh row by crc32 of its id claims one character more."""
    cell = {c: F.col(c) for c in LEAF_COLUMNS}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    claim = leaf_of(*(cell | {"n_chars": F.col("n_chars") + 1}).values())
    leaves = docs.select(
        "doc_id", "lang", leaf_of(*cell.values()).alias("leaf"), F.when(tampered, claim).alias("claim")
    )
    found = manifest(leaves, "doc_id", "claim", group="lang", order="doc_id", leaf="leaf", bits=bits)
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        proof_digest(F.col("steps")).alias("proof_sha256"),
        folded(F.coalesce("claim", "leaf"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
