"""Near-duplicate documents: universal hash minima, banding, verification, and connected components.

1. A document is the set of its word shingles. `BANDS * ROWS` universal hashes give its signature, one minimum each.
   Documents with equal sets are one class from here on.
2. Each band of the signature is a bucket key. The members of a bucket are compared with its least member first, by
   signature, then on the full sets, for each member the most similar candidates before all others; what is linked
   is contracted to components, and pairs inside a component are not compared again.
3. Buckets that still hold several components are joined exactly. A member stays if it shares enough shingles with
   other components to be linked to one; buckets connect those that stay to families; a family's members outside its
   largest component are compared with all of it, block by block, from the full sets.
4. Components are found by alternating large-star and small-star steps until the edges no longer change.

No bucket or family is gathered in one task, and none of their pairs are formed as rows. A link is missed if two sets of the wanted
similarity share no band; for five rows in 28 bands at 0.8 that is one in 60 000.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from agrospark.llm import common
from agrospark.sources.files import store

BANDS, ROWS = 28, 5
BLOCK = 400  # sets of a block, when the members of a family are compared
MARGIN = 0.15  # how far a signature's estimate may be below the similarity; over four standard deviations

SIGNATURE = "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, sketch binary, bands array<bigint>"


def _factors(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    n = BANDS * ROWS
    return rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, n, dtype=np.uint64)


def shingles(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first shingle of each text and the end, hashes): each text's distinct shingles, ascending.

    A text with fewer words than a shingle is one shingle of all its words; one without words has none.
    """
    bounds, codes, distinct = common.split_words(pc.ascii_lower(text))
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.cast(pa.large_binary()).to_pylist()), np.uint64, len(distinct))
    word = known[codes]
    n_words = np.diff(bounds)
    n_shingles = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    first = common.gather(bounds[:-1], n_shingles)
    doc = np.repeat(np.arange(len(n_words)), n_shingles)
    hashes = np.zeros(len(first), dtype=np.uint64)
    for k in range(size):
        inside = first + k < bounds[doc + 1]
        hashes *= np.uint64(0x9E3779B97F4A7C15)
        hashes ^= np.where(inside, word[np.minimum(first + k, max(len(word) - 1, 0))], np.uint64(k)) if len(word) else hashes
        hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    return np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(n_words))))), hashes


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """One row per document: the size and a hash of its set, its sketch (16 bits a minimum) and its band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _factors()
        for batch in (piece for batch in batches for piece in common.slices(batch, size=2 << 20)):
            bounds, hashes = shingles(batch.column("text"), size)
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            minima = np.zeros((len(sizes), len(a)), dtype=np.uint32)
            for k in range(len(a)) if len(some) else ():
                minima[some, k] = np.minimum.reduceat(((hashes * a[k] + b[k]) >> np.uint64(32)).astype(np.uint32),
                                                      bounds[some])
            raw = memoryview(hashes).cast("B") if len(hashes) else b""
            content = b"".join(xxhash.xxh3_128_digest(raw[8 * i:8 * j]) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            content = np.frombuffer(content, "<i8").reshape(-1, 2)
            keys = np.zeros((len(sizes), BANDS), dtype=np.uint64)
            for k in range(BANDS):
                key = np.full(len(sizes), k + 1, dtype=np.uint64)
                for r in range(ROWS):
                    key = (key ^ minima[:, k * ROWS + r]) * np.uint64(0xD6E8FEB86659FD93)
                    key ^= key >> np.uint64(32)
                keys[:, k] = key
            sketch = minima.astype("<u2")
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(content[:, 0].copy()),
                pa.array(content[:, 1].copy()), pa.array([row.tobytes() for row in sketch], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()),
                                         pa.array(keys.reshape(-1).view(np.int64))),
            ], names=[f.split()[0] for f in SIGNATURE.split(", ")])

    return docs.mapInArrow(run, SIGNATURE)


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """The full shingle sets of some documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for batch in batches for piece in common.slices(batch)):
            bounds, hashes = shingles(batch.column("text"), size)
            rows = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], names=["node", "shingles"])

    found = docs.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    return found.mapInArrow(run, "node bigint, shingles binary").dropDuplicates(["node"])


def _alike(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose signatures agree in at least the share `least`, with that share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1)
                           for c in ("left", "right"))
            share = (left == right).mean(axis=1)
            keep = pa.array(np.flatnonzero(share >= least))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(keep), batch.column("b").take(keep), pa.array(share).take(keep)], names=["a", "b", "share"])

    with_a = pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("left")), "a")
    both = with_a.join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint, share double")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have at least `percent` of their union in common."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(rows), batch.column("b").take(rows)], names=["a", "b"])

    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    return both.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of edges (a, b); the component is its least node.

    Large-star hangs every larger neighbour of a node on the least neighbour, small-star every smaller one and the
    node itself. Each step is a minimum per node and a join, so no neighbourhood is gathered.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = store(small, "stars")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    stars = edges.groupBy("u").agg(F.min("v").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return store(stars.select(F.col("u").alias("node"), "component").unionByName(roots), "components")


class _Linker:
    """The components found so far, and the comparisons that extend them."""

    def __init__(self, classes: DataFrame, sets: DataFrame, percent: int):
        self.sketches, self.sets, self.percent = classes.select("node", "sketch"), sets, percent
        self.found: DataFrame | None = None

    def component(self, rows: DataFrame, node: str, name: str) -> DataFrame:
        if self.found is None:
            return rows.withColumn(name, F.col(node))
        found = self.found.select(F.col("node").alias(node), F.col("component").alias("_c"))
        return rows.join(found, node, "left").withColumn(name, F.coalesce("_c", node)).drop("_c")

    def between(self, pairs: DataFrame) -> DataFrame:
        """The pairs of different components."""
        return self.component(self.component(pairs, "a", "ca"), "b", "cb").where("ca != cb").drop("ca", "cb")

    def compare(self, pairs: DataFrame) -> None:
        """Links all of the pairs (a, b) that are similar enough."""
        by_share = Window.partitionBy("b").orderBy(F.desc("share"), "a")
        alike = _alike(pairs, self.sketches, self.percent / 100 - MARGIN)
        ranked = store(alike.withColumn("first", F.row_number().over(by_share) == 1), "candidates")
        # Most documents are linked by their most similar candidate; after that few pairs lie between components.
        if self.link(ranked.where("first")):
            self.link(self.between(ranked.where("not first")))
        else:
            self.link(ranked.where("not first"))

    def link(self, pairs: DataFrame) -> bool:
        """Compares the full sets of the pairs (a, b); joins the components of those that are linked, if any are."""
        return self.join(store(_linked(pairs.select("a", "b"), self.sets, self.percent), "links"))

    def join(self, links: DataFrame) -> bool:
        if links.isEmpty():
            return False
        if self.found is not None:
            links = links.unionByName(self.found.select(F.col("component").alias("a"), F.col("node").alias("b")))
        self.found = connected_components(links)
        return True

    def tokens(self, members: DataFrame) -> DataFrame:
        """node, c, size and token of every shingle of the members (node, c)."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                    sets = [np.frombuffer(x, np.int64) for x in part.column("shingles").to_pylist()]
                    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
                    of = pa.array(np.repeat(np.arange(len(sets)), sizes))
                    yield pa.RecordBatch.from_arrays([
                        part.column("node").take(of), part.column("c").take(of), pa.array(np.repeat(sizes, sizes)),
                        pa.array(np.concatenate(sets))], names=["node", "c", "size", "token"])

        rows = self.sets.join(members, "node").select("node", "c", "shingles")
        return rows.mapInArrow(run, "node bigint, c bigint, size bigint, token bigint")

    def possible(self, members: DataFrame) -> DataFrame:
        """The members (node, c) that may still be linked to another component.

        Two sets of the wanted similarity share at least `need` shingles, which follows from their sizes. A shingle
        that only one component has is shared by no pair of components. So a member is out that has fewer others than
        it needs with the smallest set that has one of them.
        """
        rows = self.tokens(members)
        seen = rows.groupBy("token").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.min("size").alias("low"))
        shared = store(seen.where("c1 != c2").select("token", "low"), "shared-shingles")
        others = rows.join(shared, "token").groupBy("node", "c", "size").agg(F.count("*").alias("n"), F.min("low").alias("low"))
        percent, smallest = F.lit(self.percent), F.greatest(F.col("low"), F.ceil(F.lit(self.percent) * F.col("size") / 100))
        need = F.ceil(percent * (F.col("size") + smallest) / (100 + self.percent))
        return store(others.where(F.col("n") >= need).select("node", "c"), "possible-members")

    def link_families(self, members: DataFrame, buckets: DataFrame) -> None:
        """Links the members (node, c) of different components that are similar enough, and in one family.

        A family is what buckets (key, node) connect. Members outside its largest component are compared with all of
        it, in pairs of blocks: what a task holds is two blocks of sets, and what it returns are the links.
        """
        rows = buckets.join(members.select("node"), "node", "left_semi")
        hubs = rows.groupBy("key").agg(F.min("node").alias("a"))
        families = connected_components(rows.join(hubs, "key").select("a", F.col("node").alias("b"))).withColumnRenamed("component", "family")
        known = store(members.join(families, "node"), "families")
        parts = known.groupBy("family", "c").agg(F.count("*").alias("m")).groupBy("family").agg(
            F.sum("m").alias("all"), F.max(F.struct("m", "c")).alias("most"))
        parts = parts.where(F.col("all") > F.col("most.m")).select(
            "family", F.col("most.c").alias("most"), F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"),
            F.ceil((F.col("all") - F.col("most.m")) / BLOCK).cast("int").alias("asking"))
        placed = known.join(store(parts, "family-sizes"), "family").join(self.sets, "node")
        block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        told = ("family", "node", "c", "shingles")
        ask = placed.where("c != most").select(*told, block("asking").alias("x"), every("blocks").alias("y"))
        # Other names, since both come from one table.
        all_of = placed.select(*[F.col(c).alias(f"{c}_of") for c in told], block("blocks").alias("y_of"), every("asking").alias("x_of"))
        percent = self.percent

        def compare(asking: pa.Table, others: pa.Table) -> pa.Table:
            return _links_between(asking, others.rename_columns([c.removesuffix("_of") for c in others.column_names]), percent)

        links = ask.groupBy("family", "x", "y").cogroup(all_of.groupBy("family_of", "x_of", "y_of")) \
            .applyInArrow(compare, "a bigint, b bigint")
        self.join(store(links, "links"))


def _links_between(asking: pa.Table, others: pa.Table, percent: int) -> pa.Table:
    """The pairs of different components that are similar enough: all overlaps by one product of membership tables."""
    sides = [[np.frombuffer(x, np.int64) for x in t["shingles"].to_pylist()] for t in (asking, others)]
    sizes = [np.fromiter(map(len, sets), np.int64, len(sets)) for sets in sides]
    flat = [np.concatenate(sets) if sets else np.zeros(0, np.int64) for sets in sides]
    both = np.intersect1d(*flat)
    overlap = np.zeros((len(sides[0]), len(sides[1])), dtype=np.float32)
    rows = [np.repeat(np.arange(len(s)), s) for s in sizes]
    at = [np.searchsorted(both, f) for f in flat]
    held = [(p < len(both)) & (both[np.minimum(p, max(len(both) - 1, 0))] == f) if len(both) else np.zeros(len(f), bool)
            for p, f in zip(at, flat)]
    for low in range(0, len(both), 4096):
        tables = []
        for r, p, h, s in zip(rows, at, held, sizes):
            inside = h & (p >= low) & (p < low + 4096)
            table = np.zeros((len(s), 4096), dtype=np.float32)
            table[r[inside], p[inside] - low] = 1
            tables.append(table)
        overlap += tables[0] @ tables[1].T
    overlap = overlap.astype(np.int64)
    c = [np.asarray(t["c"]) for t in (asking, others)]
    union = sizes[0][:, None] + sizes[1][None, :] - overlap
    x, y = np.nonzero((100 * overlap >= percent * union) & (c[0][:, None] != c[1][None, :]))
    a, b = np.asarray(asking["node"])[x], np.asarray(others["node"])[y]
    return pa.table([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])


def components(docs: DataFrame, size: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(signatures of (doc_id, text), (node, component) of the documents that are linked to a different text)."""
    common.ship(docs.sparkSession)
    signed = store(signatures(docs, size), "signatures")
    classes = store(signed.where("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("node"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "classes")
    rows = classes.select("node", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    rows = store(rows.join(buckets.select("key", "a"), "key"), "buckets")
    sets = store(_sets(docs, rows.select("node").distinct(), size), "shingle-sets")
    linker = _Linker(classes, sets, percent)
    linker.compare(rows.where("node != a").select("a", F.col("node").alias("b")).distinct())
    named = linker.component(rows, "node", "c")
    mixed = named.groupBy("key").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 != c2").select("key")
    members = store(named.join(mixed, "key").select("node", "c").distinct(), "mixed-members")
    linker.link_families(linker.possible(members), rows.select("key", "node"))
    nodes = classes.select("s1", "s2", "node")
    return signed.join(nodes, ["s1", "s2"], "left"), linker.component(nodes.select("node"), "node", "component")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row for each row of docs.

    Two documents are linked if their sets of `size`-word shingles share at least `percent` of their union; a
    component is named by its least doc_id, which is kept. A null or empty text has no shingle and is linked with
    nothing; nor is a row without doc_id, which is kept. Repeated rows are one document.
    """
    rows = common.texts(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    signed, found = components(rows, size, percent)
    done = signed.join(found, "node", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    return done.select("doc_id", "n_shingles", component.alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose document is kept, with their columns."""
    gone = near_duplicates(docs, size, percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), size=3, percent=85)
