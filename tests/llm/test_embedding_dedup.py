from __future__ import annotations

import numpy as np
import pyarrow as pa

from lorekiln.llm import embedding_dedup
from lorekiln.llm.hnsw import Graph
from lorekiln.llm.stars import spanning_stars

SCHEMA = "vec_id long, embedding array<float>, rep string"


def brute_force(rows):
    good = {}
    for k, (_, e, _) in enumerate(rows):
        if e and all(x is not None and np.isfinite(np.float32(x)) for x in e) and any(e):
            v = np.array(e, np.float32).astype(np.float64)
            good[k] = v
    link = {k: [j for j in good if j != k and len(good[j]) == len(v) and good[j] @ v / np.linalg.norm(v) / np.linalg.norm(good[j]) >= 0.95] for k, v in good.items()}
    out = []
    for k, (vec_id, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in link.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((vec_id, len(link.get(k, [])), least, vec_id == least))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def rows_of(rng, n):
    centres = rng.normal(size=(6, 16))
    rows = []
    for k in range(n):
        v = centres[k % 6] + rng.normal(size=16) * (0.12 if k % 3 else 1.5)
        rows.append((k, [float(np.float32(x)) for x in v], "x"))
    return rows


def test_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = rows_of(rng, 400)
    same = rows[5][1]
    rows += [(1000 + k, same, "x") for k in range(50)] + [(1000, same, "x"), (None, same, "x")]
    rows += [(2000, None, "x"), (2001, [], "x"), (2002, [0.0] * 16, "x"), (2003, [float("nan")] * 16, "x"), (2004, [None] + [1.0] * 15, "x"), (2005, [float("inf")] + [1.0] * 15, "x")]
    rows += [(2006, [1.0, 2.0], "x"), (2007, [2.0, 4.0], "x"), (2008, [1e-30] * 16, "x"), (2009, [1e30] * 16, "x")]
    assert found(embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_narrow_beams_are_widened_until_the_audit_passes():
    rng = np.random.default_rng(8)
    centre = rng.normal(size=24)
    v = np.concatenate([centre + rng.normal(size=(300, 24)) * 0.08, rng.normal(size=(1500, 24))]).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph = Graph.load(Graph.build(v).dump())
    width = embedding_dedup.audited_width(graph, v)
    q, node = embedding_dedup._candidates(graph, v, width)
    exact = {(a, b) for a, b in zip(*np.nonzero(v @ v.T >= embedding_dedup.THRESHOLD), strict=True)}
    assert len(exact & set(zip(q.tolist(), node.tolist(), strict=True))) >= 0.99 * len(exact)


def test_hot_cluster_does_not_hide_sparse_pairs(monkeypatch):
    rng = np.random.default_rng(9)
    centre, pairs = rng.normal(size=32), rng.normal(size=(600, 32))
    v = np.concatenate([centre + rng.normal(size=(900, 32)) * 0.03, pairs, pairs + rng.normal(size=pairs.shape) * 0.05]).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph, search = Graph.load(Graph.build(v).dump()), Graph.search

    def poor(self, queries, width):  # a graph in which narrow beams find no neighbour of an ordinary vector
        ids, sims = search(self, queries, width)
        ordinary = (sims >= embedding_dedup.THRESHOLD).sum(1) < 8
        if width < 64:
            sims = np.where(ordinary[:, None] & (sims < 1 - embedding_dedup.ERROR), 0, sims)
        return ids, sims

    monkeypatch.setattr(Graph, "search", poor)
    assert embedding_dedup.audited_width(graph, v) >= 64


def test_small_graphs():
    for n in (1, 2, 3, 70):
        v = np.random.default_rng(n).normal(size=(n, 12)).astype(np.float32)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        ids, sims = Graph.build(v).search(v, 16)
        assert ids[:, 0].tolist() == list(range(n)) and np.allclose(sims[:, 0], 1)


def test_spanning_stars():
    a, b = np.array([5, 7, 9, 1]), np.array([7, 9, 11, 1])
    member, least = spanning_stars(a, b)
    assert dict(zip(member.tolist(), least.tolist(), strict=True)) == {7: 5, 9: 5, 11: 5}


def test_empty_table(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def unit(rng, n, dim=16):
    v = rng.normal(size=(n, dim)).astype(np.float32)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_a_shard_is_a_row_per_vector_and_the_same_graph():
    v = unit(np.random.default_rng(3), 3000)
    table = pa.table({"dim": [16] * 3000, "shard": [0] * 3000, "rep": range(3000), "copies": [1] * 3000, "embedding": v.tolist()})
    built = embedding_dedup._build(table)
    assert built["rep"].to_pylist() == list(range(3000)) and max(map(len, built["links"].to_pylist())) < 500
    graph, again = Graph.build(v), Graph.of_parts(v, built["links"].to_pylist())
    assert [n.tolist() for n, _ in graph.layers] == [n.tolist() for n, _ in again.layers]
    assert all((a == b).all() for a, b in zip(graph.search(v[:200], 16), again.search(v[:200], 16), strict=True))


def test_pairs_of_a_hot_cluster_are_held_a_few_at_a_time(monkeypatch):
    monkeypatch.setattr(embedding_dedup, "HELD", 4000)
    rng = np.random.default_rng(6)
    v = np.concatenate([unit(rng, 1)[[0] * 1200] + rng.normal(size=(1200, 16)) * 0.02, unit(rng, 800)]).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph, found = Graph.build(v), set()
    for q, node, _, _ in embedding_dedup._pairs(graph, v, 16):
        assert len(q) <= 4000
        found.update(zip(q.tolist(), node.tolist(), strict=True))
    exact = {(a, b) for a, b in zip(*np.nonzero(v @ v.T >= embedding_dedup.THRESHOLD), strict=True)}
    assert len(exact & found) >= 0.99 * len(exact)
    shard = embedding_dedup._Shard(16)
    for part, asks in ((Graph.build(v).parts(), 0), ([None] * 2000, 1)):
        columns = {"asks": [asks] * 2000, "rep": range(2000), "copies": [1] * 2000, "embedding": pa.array(v.tolist(), pa.list_(pa.float32())), "links": pa.array(part, pa.binary())}
        assert list(shard.take(pa.RecordBatch.from_pydict(columns))) == []  # waits for more queries
    rows = [r for batch in shard.close() for r in batch.to_pylist()]
    assert sum(len(member) for member, _ in shard.stars) < 2000
    links = {r["rep"]: r["links"] for r in rows if r["other"] < 0}
    assert min(links.get(k, 0) for k in range(1200)) >= 1190


def test_many_tasks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAST_QUERIES", 40)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        rows = rows_of(np.random.default_rng(12), 500) + [(600 + k, [1.0, 0.1 * k], "x") for k in range(9)]
        assert found(embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
