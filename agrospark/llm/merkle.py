"""Merkle manifest: every row a leaf, a tree of runs of eight per group, a tree over the groups' roots.

Nodes are appended to a stream in order. A node that is appended opens a witness, the list of what it will be hashed
with. When the run it stands in is complete, the witnesses of all leaves below the run's members are extended by the
other members, and the run's digest is appended one level higher, to a subtree that is still open. A stream covers an
aligned block of `ARITY ** LEVELS` nodes; the roots of blocks are rows of a table and appended in the same way, by
other tasks, until one root is left per group. So no task sees more than a block, however large a group is, and the
witness of a leaf is what its block, its block's block and so on have written, joined on the block's number.

Digests are kept as bytes; hashed are their lowercase hexadecimal forms. A witness has one entry per level: the node's
place in its run (one byte), then the other members' digests from left to right. A run may have one member only, whose
entry holds none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from agrospark.llm import common
from agrospark.sources.files import store

ARITY = 8
LEVELS = 4  # of a block: 4096 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


class Stream:
    """An append-only tree; `witnesses[i]` belongs to the i-th node that was appended."""

    def __init__(self) -> None:
        self.witnesses: list[list[bytes]] = []
        self.open: list[list[tuple[bytes, int, int]]] = [[]]  # per level: digest, first and last+1 of the leaves below

    def append(self, node: bytes) -> None:
        n = len(self.witnesses)
        self.witnesses.append([])
        self.open[0].append((node, n, n + 1))
        level = 0
        while len(self.open[level]) == ARITY:
            self._complete(level)
            level += 1

    def _complete(self, level: int) -> None:
        """Close the run at a level, whole or not, and append its digest above."""
        run = self.open[level]
        digests = [d for d, _, _ in run]
        for place, (_, first, end) in enumerate(run):
            entry = bytes([place]) + b"".join(digests[:place] + digests[place + 1:])
            for witness in self.witnesses[first:end]:
                witness.append(entry)
        if level + 1 == len(self.open):
            self.open.append([])
        self.open[level + 1].append((digest(digests), run[0][1], run[-1][2]))
        self.open[level] = []

    def finish(self, levels: int | None = None) -> bytes:
        """The root: after `levels` levels, or without a number where a single node remains."""
        level = 0
        while level < levels if levels is not None else len(self.open[level]) != 1 or any(self.open[level + 1:]):
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0][0]


def fold(node: bytes, witness: Sequence[bytes]) -> bytes:
    """The root that a node and its witness give."""
    for entry in witness:
        place = 1 + 32 * entry[0]
        node = digest((entry[1:place], node, entry[place:]))
    return node


def record(text: Column | None = None, fields: Sequence[str] = FIELDS) -> Column:
    """A row's content: each field as byte count, colon and value, `-` if null; `text` in place of that field."""
    def written(name: str) -> Column:
        value = text if text is not None and name == "text" else F.col(name).cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.concat(*map(written, fields))


def _sha(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def in_order(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds `at`, the row's number in its group from 0 on, and `total`, the group's rows.

    Rows are placed by ranges of (group, order) and stored; per range and group only a count is left, and the counts
    before a range are summed. A group with most of the rows is in many ranges.
    """
    cut = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order) \
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    cut = store(cut, "merkle-order")
    parts = cut.groupBy("part", group).agg(F.count("*").alias("n"), F.min("row").alias("first"))
    ahead = Window.partitionBy(group).orderBy("part")
    parts = parts.select("part", group, "first", (F.sum("n").over(ahead) - F.col("n")).alias("before"),
                         F.sum("n").over(Window.partitionBy(group)).alias("total"))
    return cut.join(parts, ["part", group]).withColumn("at", F.col("row") - F.col("first") + F.col("before")) \
        .drop("part", "row", "first", "before")


def grow(nodes: DataFrame, above=None) -> DataFrame:
    """Adds `witness` (up to the root) and `root` to rows of (g, at, total, node, ...).

    `above` continues at the groups' roots, (g, node), and returns (g, subroot, witness, root) for them.
    """
    size = ARITY ** LEVELS
    names = [f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields]
    schema = ", ".join([*names, "block bigint", "witness array<binary>", "top binary"])

    def close(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        stream = Stream()
        for node in table.column("node").to_pylist():
            stream.append(node)
        top = stream.finish(LEVELS if table.column("total")[0].as_py() > size else None)
        return table.append_column("witness", pa.array(stream.witnesses, pa.list_(pa.binary()))) \
            .append_column("top", pa.array([top] * len(table), pa.binary()))

    common.ship(nodes.sparkSession)
    placed = nodes.withColumn("block", F.expr(f"at div {size}"))
    closed = store(placed.groupBy("g", "block").applyInArrow(
        lambda t: close(t).select([s.split()[0] for s in schema.split(", ")]), schema), "merkle-blocks")
    tops = closed.groupBy("g", "block").agg(F.min("top").alias("node"), F.max("total").alias("total"))
    if (closed.agg(F.max("total")).first()[0] or 0) > size:
        # Roots of blocks are further appends; a group of one block goes on as a single node.
        rest = grow(tops.select("g", F.col("block").alias("at"), F.ceil(F.col("total") / size).cast("bigint").alias("total"), "node"), above)
        rest = rest.withColumnRenamed("at", "block").drop("total", "node")
        keys = ["g", "block"]
    elif above is not None:
        rest, keys = above(tops.select("g", "node")), ["g"]
    else:
        return closed.withColumnRenamed("top", "root").drop("block")
    rest = rest.withColumnRenamed("witness", "further")
    return closed.join(rest, keys).withColumn("witness", F.concat("witness", "further")).drop("block", "top", "further")


def manifest(docs: DataFrame, group: str = "lang", claimed: Column | None = None, fields: Sequence[str] = FIELDS) -> DataFrame:
    """One row per row of docs: doc_id, leaf, witness, subroot, root and the digest of what is `claimed` to be the row.

    Within a group, leaves ascend by doc_id (null first), then by digest, so that repeated ids have a defined place.
    Groups ascend by their UTF-8 bytes, null first; the empty string is a group of its own. An empty table has no
    rows. Only the fields and the group are read from docs.
    """
    known = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaf = _sha(record(fields=fields))
    rows = store(docs.select(known.alias("g"), F.col("doc_id").cast("bigint").alias("doc_id"), leaf.alias("node"),
                             (leaf if claimed is None else F.coalesce(_sha(claimed), leaf)).alias("claimed")), "merkle-leaves")

    def roots(tops: DataFrame) -> DataFrame:
        one = in_order(tops.select(F.lit(0).alias("all"), F.col("g").alias("name"), "node"), "all", "name")
        return grow(one.select(F.lit("").alias("g"), "name", "at", "total", "node")) \
            .select(F.col("name").alias("g"), F.col("node").alias("subroot"), "witness", "root")

    tree = grow(in_order(rows, "g", "doc_id", "node", "claimed"), roots)
    return tree.select("doc_id", F.col("node").alias("leaf"), "claimed", "witness", "subroot", "root")


def check(tree: DataFrame) -> DataFrame:
    """Folds what is claimed along the witnesses: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    out = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
           "verified boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ARITY ** LEVELS):
                batch = whole.slice(start, ARITY ** LEVELS)
                witnesses = batch.column("witness").to_pylist()
                folded = [fold(c, w) for c, w in zip(batch.column("claimed").to_pylist(), witnesses)]
                proofs = [digest([e[1:] for e in w]).hex() for w in witnesses]
                root = batch.column("root").to_pylist()
                text = lambda c: [v.hex() for v in batch.column(c).to_pylist()]  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(text("leaf")), pa.array(text("subroot")), pa.array([r.hex() for r in root]),
                    pa.array(proofs), pa.array([f.hex() for f in folded]),
                    pa.array(np.fromiter((f == r for f, r in zip(folded, root)), bool, len(root))),
                ], names=[f.split()[0] for f in out.split(", ")])

    common.ship(tree.sparkSession)
    return tree.mapInArrow(run, out)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id's checksum is divisible by three are tampered with: A-Z of their texts become lower case."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    docs = common.table(spark, sf_dir, "documents")
    return check(manifest(docs, claimed=F.when(tampered, record(lower))))
