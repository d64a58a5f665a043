"""Near-duplicate embeddings by HNSW graphs per shard.

Equal vectors are one row from the start. Each shard of the distinct vectors gets a graph;
every vector is searched in every shard. A beam is doubled while most of it lies above the
threshold, and for all queries of a task until an audit against the whole shard passes;
where no beam is wide enough, the task compares with the whole shard. Cosines are verified
in double precision. A task reduces its links to counts and to a star per component. A graph
travels as a row per vector, and a task reads its queries as a stream: no row, batch or array of
pairs grows with the table, the shard's vectors and neighbours are all that a task holds.

Defined results
    vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing; so do vectors of different lengths.
    null ids are the largest: a component is named by them only if it has no other.
    repeated rows count as other vectors; an empty table gives an empty result; other
    columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekiln.functions.batches import release_memory, small_batches
from lorekiln.llm.hnsw import Graph
from lorekiln.llm.stars import spanning_stars
from lorekiln.operators.graph import connected_components
from lorekiln.sources.shared import Workspace

THRESHOLD = 0.95
#: Bytes of a shard's vectors and graph at most, as every task holds one; shards at least; queries
#: of a task at least and at most, and how many tasks share a shard's size of queries.
SHARD_BYTES, LEAST_SHARDS = 80 << 20, 4
LEAST_QUERIES, MOST_QUERIES, SHARING = 8192, 200_000, 2
#: First width of a beam; queries with few links that an audit wants, queries it looks at for
#: them at most, and the share of a query's links that has to be found in the mean.
WIDTH, AUDITED, MOST_AUDITED, RECALL = 16, 64, 8192, 0.99
#: Queries searched at a time, similarities and pairs held at a time, components of pairs verified at
#: a time, and how far single precision errs: at least, and by component. Pairs further from the
#: threshold than that need no second look.
SEARCHED, HELD, PAIRED, VERIFIED, ERROR, DIM_ERROR = 1024, 1 << 20, 100_000, 1 << 20, 1e-5, 1.2e-7

#: Bytes of a vector's neighbours and numbers, beside its components in double and single precision.
ROW_BYTES = 200
KEYS = ["dim", "shard", "block"]


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """In the column's own precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _unit(raw: np.ndarray) -> np.ndarray:
    unit = np.empty(raw.shape, np.float32)
    for at in range(0, len(raw), SEARCHED):
        some = raw[at : at + SEARCHED].astype(np.float64)
        some /= np.abs(some).max(1, keepdims=True)
        unit[at : at + SEARCHED] = some / np.linalg.norm(some, axis=1, keepdims=True)
    return unit


def _build(table: pa.Table) -> pa.Table:
    """The shard's vectors with their places and neighbours in its graph."""
    parts = Graph.build(_unit(_matrix(table["embedding"], table["dim"][0].as_py()))).parts()
    table = table.append_column("node", pa.array(np.arange(len(parts)), pa.int64())).append_column("links", pa.array(parts, pa.binary()))
    release_memory()
    return table


def _error(dim: int) -> float:
    return max(ERROR, DIM_ERROR * dim)


def _pairs(graph: Graph, queries: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(query, node, similarity) of pairs that may reach the threshold, and the queries compared
    with the shard, some at a time."""
    rows, least, n = np.arange(len(queries)), THRESHOLD - _error(queries.shape[1]), len(graph.vectors)
    while len(rows) and 2 * width < n:
        wide = []
        each = max(1, HELD // width)
        for at in range(0, len(rows), each):
            some = rows[at : at + each]
            ids, sims = graph.search(queries[some], width)
            above = sims >= least
            full = above.sum(1) * 2 > width
            q, k = np.nonzero(above & ~full[:, None])
            yield some[q], ids[q, k], sims[q, k], some[:0]
            wide.append(some[full])
        rows, width = np.concatenate(wide), width * 2
    each = max(1, HELD // n)
    for at in range(0, len(rows), each):  # no beam is narrower than the shard
        some = rows[at : at + each]
        product = queries[some] @ graph.vectors.T
        q, node = np.nonzero(product >= least)
        yield some[q], node, product[q, node], some


def _candidates(graph: Graph, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    q, node = zip(*((q, node) for q, node, _, _ in _pairs(graph, queries, width)), strict=True)
    return np.concatenate(q), np.concatenate(node)


def _linked(sims: np.ndarray) -> np.ndarray:
    """Links of the audit, without self matches."""
    return (sims >= THRESHOLD) & (sims < 1 - ERROR)


def _audit_sample(graph: Graph, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors with links, number of their links). It grows until enough of them have few links,
    or ``MOST_AUDITED`` vectors were looked at."""
    rng = np.random.default_rng(len(queries))
    pool = np.concatenate([x[rng.permutation(len(x))[: MOST_AUDITED // 2]] for x in (queries, graph.vectors)])
    pool = rng.permutation(pool)
    kept, counts, few, each = [], [], 0, max(1, HELD // len(graph.vectors))
    for at in range(0, len(pool), 4 * AUDITED):
        block = pool[at : at + 4 * AUDITED]
        count = np.concatenate([_linked(block[k : k + each] @ graph.vectors.T).sum(1) for k in range(0, len(block), each)])
        kept.append(block[count > 0])
        counts.append(count[count > 0])
        few += int((2 * counts[-1] <= WIDTH).sum())
        if few >= AUDITED:
            break
    return np.concatenate(kept), np.concatenate(counts)


def audited_width(graph: Graph, queries: np.ndarray) -> int:
    """The first beam width at which a sample of ``queries`` finds its links in the shard.

    Recall is a mean over queries, apart for those with few links and those with many, so that
    no hot cluster outweighs the rest; queries compared with the whole shard don't count.
    """
    width, n = WIDTH, len(graph.vectors)
    if 2 * width >= n:
        return width
    sample, counts = _audit_sample(graph, queries)
    few = 2 * counts <= WIDTH
    while 2 * width < n and len(sample):
        hits, ordinary = np.zeros(len(sample), np.int64), np.ones(len(sample), bool)
        for q, _, sims, whole in _pairs(graph, sample, width):
            hits += np.bincount(q[_linked(sims)], minlength=len(sample))
            ordinary[whole] = False
        groups = [g & ordinary for g in (few, ~few)]
        if all((np.minimum(hits[g], counts[g]) / counts[g]).mean() >= RECALL for g in groups if g.any()):
            break
        width *= 2
    return width


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def _result(rep: np.ndarray, links: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    columns = {"rep": rep, "links": links, "other": other}
    return pa.RecordBatch.from_pydict({k: pa.array(v.astype(np.int64), pa.int64()) for k, v in columns.items()})


class _Shard:
    """One shard and the queries of one task, which come after all of its vectors."""

    def __init__(self, dim: int):
        self.dim, self.held, self.waiting, self.graph = dim, [], [], None
        self.stars: list[tuple[np.ndarray, np.ndarray]] = []

    def take(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Rows in order: vectors of the shard, then queries."""
        asks = int(np.count_nonzero(part["asks"].to_numpy()))
        own, queries = part.slice(0, len(part) - asks), part.slice(len(part) - asks)
        if len(own):
            self.held.append((own["rep"].to_numpy(), own["copies"].to_numpy(), _matrix(own["embedding"], self.dim), own["links"].to_pylist()))
        if len(queries) and self.held:
            self.waiting.append((queries["rep"].to_numpy(), _matrix(queries["embedding"], self.dim)))
            # Queries come in the order of a hash, so that the first ones are a sample for the audit.
            if self.graph is not None or sum(len(rep) for rep, _ in self.waiting) >= MOST_AUDITED // 2:
                yield from self._searched()

    def close(self) -> Iterator[pa.RecordBatch]:
        """What is left: the last queries and a star per component."""
        if self.waiting:
            yield from self._searched()
        self._fold()
        for member, least in self.stars:
            yield _result(member, np.zeros(len(member)), least)

    def _searched(self) -> Iterator[pa.RecordBatch]:
        asked, own = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        unit, self.waiting = _unit(own), []
        if self.graph is None:
            self.reps, self.copies, self.raw = (np.concatenate(x) for x in list(zip(*self.held, strict=True))[:3])
            parts = [p for x in self.held for p in x[3]]
            self.held = [()]
            self.graph = Graph.of_parts(_unit(self.raw), parts)
            self.width = audited_width(self.graph, unit)
        for at in range(0, len(asked), SEARCHED):
            end = at + SEARCHED
            links = self._links(asked[at:end], own[at:end], unit[at:end])
            linked = np.flatnonzero(links)
            if len(linked):
                yield _result(asked[at:end][linked], links[linked], np.full(len(linked), -1))

    def _links(self, asked: np.ndarray, own: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """How many vectors each query is linked with here."""
        links, error, each = np.zeros(len(asked), np.int64), _error(self.dim), max(1, VERIFIED // self.dim)
        for q, node, sims, _ in _pairs(self.graph, unit, self.width):
            close = np.flatnonzero(np.abs(sims - THRESHOLD) <= 2 * error)
            real = sims >= THRESHOLD
            for at in range(0, len(close), each):
                some = close[at : at + each]
                real[some] = _cosines(own[q[some]], self.raw[node[some]]) >= THRESHOLD
            real &= asked[q] != self.reps[node]
            q, node = q[real], node[real]
            for at in range(0, len(q), PAIRED):
                some, nodes = q[at : at + PAIRED], node[at : at + PAIRED]
                links += np.bincount(some, self.copies[nodes], len(asked)).astype(np.int64)
                self.stars.append(spanning_stars(asked[some], self.reps[nodes]))
                if len(self.stars) > 1 and sum(len(member) for member, _ in self.stars[1:]) > HELD:
                    self._fold()
        return links

    def _fold(self) -> None:
        """A star per component of all stars so far: no more rows than vectors here."""
        if self.stars:
            self.stars = [spanning_stars(*(np.concatenate(s) for s in zip(*self.stars, strict=True)))]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rep, links) with the linked vectors of a query here, and rows (rep, other). Batches are
    in order of shard and block, vectors before queries."""
    now, shard = None, None
    for batch in batches:
        keys = np.stack([batch[k].to_numpy() for k in KEYS], axis=1)
        begins = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(batch)]
        for begin, end in zip(begins, begins[1:], strict=False):
            if end > begin and now != (now := tuple(keys[begin].tolist())):
                if shard:
                    yield from shard.close()
                shard = _Shard(now[0])
                release_memory()
            if end > begin:
                yield from shard.take(batch.slice(begin, end - begin))
    if shard:
        yield from shard.close()
        del shard
        release_memory()


def link_vectors(distinct: DataFrame, work: Workspace) -> DataFrame:
    """(rep, links, other) over distinct vectors (rep, dim, copies, embedding)."""
    small_batches(distinct.sparkSession)
    sizes = distinct.groupBy("dim").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("shards", F.greatest(F.lit(LEAST_SHARDS), F.ceil(F.col("n") * (12 * F.col("dim") + ROW_BYTES) / SHARD_BYTES)).cast("int"))
    # Shards go to all their tasks, so these have a share of the vectors in a shard as queries.
    queries_each = F.greatest(F.lit(LEAST_QUERIES), F.least(F.lit(MOST_QUERIES), F.ceil(F.col("n") / (F.col("shards") * SHARING))))
    sizes = work.keep(sizes.select("dim", "shards", F.ceil(F.col("n") / queries_each).cast("int").alias("blocks")), "sizes")
    placed = distinct.join(sizes, "dim")
    shard = F.pmod(F.xxhash64("rep", F.lit("shard")), F.col("shards")).cast("int")
    kind = distinct.schema["embedding"].dataType.simpleString()
    index = placed.withColumn("shard", shard).select("dim", "shard", "rep", "copies", "embedding").groupBy("dim", "shard")
    index = work.keep(index.applyInArrow(_build, f"dim int, shard int, rep bigint, copies bigint, embedding {kind}, node bigint, links binary"), "index")
    index = index.join(sizes, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    block = F.pmod(F.xxhash64("rep", F.lit("block")), F.col("blocks")).cast("int")
    queries = placed.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    index = index.select(*KEYS, F.lit(0).alias("asks"), F.col("node").alias("place"), "rep", "copies", "embedding", "links")
    queries = queries.select(*KEYS, F.lit(1).alias("asks"), F.xxhash64("rep", F.lit("order")).alias("place"), "rep", "copies", "embedding", F.lit(None).cast("binary").alias("links"))
    both = index.unionByName(queries).repartition(*KEYS).sortWithinPartitions(*KEYS, "asks", "place")
    return both.mapInArrow(_search, "rep bigint, links bigint, other bigint")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per vector: its id, n_links, component_id and kept."""
    spark = vectors.sparkSession
    work = Workspace(spark, "embedding-dedup")
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"), F.monotonically_increasing_id().alias("row"))
    rows = work.keep(rows.withColumn("usable", usable), "rows")
    linked = rows.filter("usable")
    distinct = linked.groupBy("embedding").agg(F.min("row").alias("rep"), F.count("*").alias("copies"), F.min("id").alias("least"))
    distinct = work.keep(distinct.withColumn("dim", F.size("embedding")), "distinct")
    found = work.keep(link_vectors(distinct, work), "found")
    labels = connected_components(found.filter("other >= 0").select(F.col("rep").alias("src"), F.col("other").alias("dst")), Workspace(spark, "embedding-components"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = distinct.join(counts, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select(
        "embedding", "least", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    named = work.keep(named, "named")
    least = work.keep(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    named = work.keep(named.join(least, "component").select("embedding", "n_links", "component_id"), "classes")
    alone = rows.filter(~F.col("usable")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.join(named, "embedding").select("id", "n_links", "component_id").union(alone)
    return every.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
