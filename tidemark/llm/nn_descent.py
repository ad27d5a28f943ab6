"""Embedding near-duplicates by NN-descent over a neighbour graph.

Vectors are compared only within a group (same label, same number of components). Equal vectors are one node with a
number of copies. The graph starts from several orders by the signs of random projections, in which every node meets
the nodes around it; then each round joins neighbours of neighbours: around every centre its forward and reverse neighbours
are compared with each other, and each node keeps its ``neighbours`` nearest. All pairs at or above the
threshold that are met on the way are kept as links, reduced per block to a spanning forest. Rounds end when one
finds no link between nodes that were not yet connected. Links give components. A list that is full of links is
saturated: it is enlarged to the node's whole component, which is compared block by block in double precision, so
that the numbers of links are exact within components.

``audit_recall`` compares the links of every vector whose id is divisible by ``every`` with all other vectors, in blocks.

Defined results: vectors that are null, zero, or hold null or non-finite components, and vectors without a label, link with nothing
and are their own component; rows that repeat id and vector are vectors of their own. Cosines at the threshold link. Only the three
columns named are read. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import connected_components, key_runs, merge_labels, quoted, run_starts
from tidemark.session import pin

ORDERS = 10
SIGNS = 48
BLOCK = 64  # nodes compared with each other at a time in the search
TILE = 512  # members of a component compared at a time


def unit_rows(vectors: pa.Array) -> np.ndarray:
    """Rows of a binary column of doubles, scaled to length one."""
    data = np.frombuffer(b"".join(vectors.to_pylist()), dtype="<f8").reshape(len(vectors), -1)
    return data / np.linalg.norm(data, axis=1, keepdims=True)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, list) to (id, label, width, vector): usable vectors as the bytes of doubles, others as null."""
    for batch in batches:
        out, width = [], []
        for value in batch.column(2).to_pylist():
            good = value is not None and None not in value
            array = np.array(value if good else [], dtype="<f8")
            good = good and len(array) > 0 and bool(np.isfinite(array).all()) and bool(array.any())
            if good:
                array = array / np.abs(array).max()  # the cosine is the same, and squares can't overflow
            out.append(array.tobytes() if good else None)
            width.append(len(array) if good else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(width, pa.int32()), pa.array(out, pa.binary())],
            names=["id", "label", "width", "vector"],
        )


def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, node, vector) to one row per order: (order, group, code, node, vector)."""
    planes: dict[int, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.array([len(v) for v in batch.column(2).to_pylist()])
        for length in np.unique(lengths):
            part = batch.filter(pa.array(lengths == length))
            width = int(length) // 8
            if width not in planes:
                planes[width] = np.random.default_rng(width).standard_normal((width, ORDERS * SIGNS))
            signs = unit_rows(part.column(2)) @ planes[width] > 0
            weight = np.int64(1) << np.arange(SIGNS, dtype=np.int64)[::-1]
            codes = signs.reshape(-1, ORDERS, SIGNS) @ weight
            for order in range(ORDERS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(part.num_rows, order)), part.column(0), pa.array(codes[:, order]), part.column(1), part.column(2)],
                    names=["order", "group", "code", "node", "vector"],
                )


def found_pairs(
    nodes: np.ndarray, vectors: np.ndarray, neighbours: int, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, cosine) of each node's nearest in the block, and of a spanning forest of the links (both ways round)."""
    cosine = vectors @ vectors.T
    cosine[nodes[:, None] == nodes[None, :]] = -2.0
    n = len(nodes)
    keep = min(neighbours, n - 1)
    near = np.argpartition(-cosine, keep - 1, axis=1)[:, :keep] if keep else np.zeros((n, 0), int)
    u, v = np.repeat(np.arange(n), keep), near.ravel()
    a, b = np.nonzero(np.triu(cosine >= threshold, 1))
    if len(a):
        labels = merge_labels(n, a, b)
        first = np.flatnonzero(labels[a] == a)  # links to the smallest member, and one more link for each other member
        _, one = np.unique(b, return_index=True)
        some = np.union1d(first, one)
        u, v = np.concatenate([u, a[some], b[some]]), np.concatenate([v, b[some], a[some]])
    good = cosine[u, v] > -2.0
    u, v = u[good], v[good]
    return nodes[u], nodes[v], cosine[u, v]


EDGE_SCHEMA = "a bigint, b bigint, cosine double"


def edge_batch(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=["a", "b", "cosine"])


def windowed(keys: int, neighbours: int, threshold: float):
    """Compare every node with those around it in rows sorted by key (the last two columns are node and vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in key_runs(batches, keys, 8 * BLOCK * BLOCK):
            starts = run_starts(batch, keys)
            nodes, out = batch.column(batch.num_columns - 2).to_numpy(), []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                if b - a < 2:
                    continue
                vectors = unit_rows(batch.column(batch.num_columns - 1).slice(a, b - a))
                for at in range(0, max(1, b - a - BLOCK // 2), BLOCK // 2):
                    part = slice(at, at + BLOCK)
                    out.append(found_pairs(nodes[a:b][part], vectors[part], neighbours, threshold))
            if out:
                yield edge_batch(out)

    return run


def nearest(edges: DataFrame, neighbours: int) -> DataFrame:
    """Each node's nearest neighbours among all edges."""
    best = edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))
    return best.withColumn("place", place).where(F.col("place") <= neighbours).drop("place")


def local_join(graph: DataFrame, nodes: DataFrame, neighbours: int, threshold: float, width: int) -> DataFrame:
    """Compare the forward and reverse neighbours of every node; long reverse lists are cut into blocks, each joined
    with all forward neighbours."""
    forward = graph.select(F.col("a").alias("centre"), F.col("b").alias("member"))
    reverse = graph.select(F.col("b").alias("centre"), F.col("a").alias("member"))
    degree = pin(reverse.groupBy("centre").count().where(F.col("count") > BLOCK).select(
        F.col("centre").alias("hub"), F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")
    ))
    spread = F.coalesce(F.pmod(F.xxhash64("member"), F.col("parts")).cast("bigint"), F.lit(0).cast("bigint"))
    reverse = reverse.join(degree, F.col("centre") == F.col("hub"), "left").select("centre", spread.alias("part"), "member")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("parts").cast("bigint"), F.lit(1).cast("bigint")) - 1))
    forward = forward.join(degree, F.col("centre") == F.col("hub"), "left").select("centre", every.alias("part"), "member")
    around = forward.unionByName(reverse).distinct()
    with_vectors = around.join(nodes.select("node", "vector"), F.col("member") == F.col("node"))
    rows = with_vectors.select("centre", "part", "node", "vector").repartition(width, "centre", "part")
    return rows.sortWithinPartitions("centre", "part").mapInArrow(windowed(2, neighbours, threshold), EDGE_SCHEMA)


def link_counts(members: DataFrame, threshold: float, width: int) -> DataFrame:
    """(node, links): number of other vectors at or above the threshold inside the component, copies included.

    ``members`` holds root, node, copies and vector. Large components are cut into tiles; each pair of tiles is compared by itself.
    """
    sizes = pin(members.groupBy(F.col("root").alias("of_root")).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles")))
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda t: (F.least(t, own) * F.col("tiles") + F.greatest(t, own)).cast("bigint"),
    )
    rows = members.join(sizes, F.col("root") == F.col("of_root")).select(
        "root", F.explode(pairs).alias("pair"), own.alias("tile"), "tiles", "node", "copies", "vector"
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in key_runs(batches, 2):
            starts = run_starts(batch, 2)
            found, links = [], []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                part = batch.slice(a, b - a)
                vectors, tile = unit_rows(part.column(6)), part.column(2).to_numpy()
                pair, tiles = part.column(1)[0].as_py(), part.column(3)[0].as_py()
                linked = vectors @ vectors.T >= threshold
                np.fill_diagonal(linked, False)
                if pair // tiles != pair % tiles:  # two tiles: only what lies between them
                    linked &= tile[:, None] != tile[None, :]
                found.append(part.column(4).to_numpy())
                links.append(linked @ part.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found)), pa.array(np.concatenate(links))], names=["node", "links"]
            )

    sorted_rows = rows.repartition(width, "root", "pair").sortWithinPartitions("root", "pair")
    return sorted_rows.mapInArrow(counted, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = 0.98, neighbours: int = 8, max_rounds: int = 4,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    width = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = embeddings.select(quoted(id_col).alias("id"), quoted(label_col).alias("label"), quoted(vector_col).alias("list"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    rows = rows.mapInArrow(packed, f"id {kinds['id']}, label {kinds['label']}, width int, vector binary")
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.col("id").isNotNull()
    key = F.when(usable, F.xxhash64("label", "width", "vector"))
    rows = pin(rows.select("id", key.alias("node"), F.xxhash64("label", "width").alias("group"), "vector"))
    nodes = pin(
        rows.where("node is not null").groupBy("node", "group", "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"))
    )
    by_code = nodes.select("group", "node", "vector").mapInArrow(
        ordered, "order bigint, group bigint, code bigint, node bigint, vector binary"
    )
    sorted_rows = by_code.repartitionByRange(width, "order", "group", "code", "node").sortWithinPartitions("order", "group", "code")
    met = pin(sorted_rows.mapInArrow(windowed(2, neighbours, threshold), EDGE_SCHEMA))
    links = pin(met.where(F.col("cosine") >= threshold).select("a", "b").distinct())
    roots = pin(connected_components(links, "a", "b"))
    graph = pin(nearest(met, neighbours))
    for _ in range(max_rounds):
        met = pin(local_join(graph, nodes, neighbours, threshold, width))
        more = joins_components(met.where(F.col("cosine") >= threshold).select("a", "b"), roots)
        if more.isEmpty():
            break
        links = pin(links.unionByName(more).distinct())
        roots = pin(connected_components(links, "a", "b"))
        graph = pin(nearest(graph.unionByName(met), neighbours))
    members = nodes.join(roots.withColumnRenamed("node", "own_node"), F.col("node") == F.col("own_node"))
    counts = link_counts(members.select("root", "node", "copies", "vector"), threshold, width)
    placed = nodes.join(roots.withColumnRenamed("node", "own_node"), F.col("node") == F.col("own_node"), "left").select(
        "node", "copies", "first_id", F.coalesce("root", "node").alias("root")
    )
    placed = pin(placed)
    smallest = pin(placed.groupBy(F.col("root").alias("of_root")).agg(F.min("first_id").alias("component_id")))
    facts = placed.join(smallest, F.col("root") == F.col("of_root")).join(
        pin(counts).withColumnRenamed("node", "counted"), F.col("node") == F.col("counted"), "left"
    )
    facts = pin(facts.select(
        F.col("node").alias("own_node"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    ))
    out = rows.select("id", "node").join(facts, F.col("node") == F.col("own_node"), "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def joins_components(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The links whose ends are not yet in one component."""
    of = lambda side: roots.select(F.col("node").alias(f"{side}_node"), F.col("root").alias(f"{side}_root"))
    placed = pairs.distinct().join(of("a"), F.col("a") == F.col("a_node"), "left").join(of("b"), F.col("b") == F.col("b_node"), "left")
    return placed.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")


def audit_recall(
    embeddings: DataFrame, result: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", threshold: float = 0.98, every: int = 50, block: int = 2_000,
) -> tuple[int, int]:
    """(links found, links there are) of the vectors whose id is divisible by ``every``, against all vectors.

    The queries go to the tasks in blocks of bounded size.
    """
    rows = embeddings.select(quoted(id_col).alias("id"), quoted(label_col).alias("label"), quoted(vector_col).alias("list"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    rows = rows.mapInArrow(packed, f"id {kinds['id']}, label {kinds['label']}, width int, vector binary")
    rows = pin(rows.where("label is not null and vector is not null and id is not null"))
    asked = rows.where(F.col("id") % every == 0)
    blocks = max(1, -(-asked.count() // block))
    wanted = there = 0
    for number in range(blocks):
        queries = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toPandas()
        sent = embeddings.sparkSession.sparkContext.broadcast([tuple(q) for q in queries.itertuples(index=False)])

        def compare(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, counts = [], []
                label, size, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "width", "id"))
                for q_id, q_label, q_width, q_vector in sent.value:
                    mask = (label == q_label) & (size == q_width) & (own != q_id)
                    if mask.any():
                        query = np.frombuffer(q_vector, "<f8")
                        others = unit_rows(batch.column("vector").filter(pa.array(mask)))
                        ids.append(int(q_id))
                        counts.append(int((others @ (query / np.linalg.norm(query)) >= threshold).sum()))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64())], names=["q", "n"])

        exact = rows.mapInArrow(compare, "q bigint, n bigint").groupBy("q").agg(F.sum("n").alias("n"))
        both = exact.join(result, F.col("q") == quoted(id_col)).agg(F.sum("n_links"), F.sum("n")).first()
        wanted, there = wanted + (both[0] or 0), there + (both[1] or 0)
    return wanted, there
