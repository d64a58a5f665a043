"""Groups of members with repeated rows, against a look at each group."""

from __future__ import annotations

import random

from lorekiln.operators import links


def test_group_edges_are_those_of_each_group(spark):
    rng = random.Random(5)
    nodes = [(n, rng.choice(["a", "b", "c", None]), rng.choice(["t", "u", "v", None])) for n in range(12)]
    members = [(rng.randrange(60), rng.randrange(13)) for _ in range(150)] * 3 + [(99, 1)] * 50 + [(100, None)]
    found = links.group_edges(
        spark.createDataFrame(members, "grp long, node long"), spark.createDataFrame(nodes, "node long, cluster string, kind string"), "grp", "node", "cluster", "kind"
    )
    known, groups = {n: (c, k) for n, c, k in nodes}, {}
    for group, node in members:
        groups.setdefault(group, set()).add(node)
    wanted = {}
    for group, own in groups.items():
        placed = [known[n] for n in own if n in known]
        clusters, kinds = {c for c, _ in placed} - {None}, {k for _, k in placed} - {None}
        verdict = "unknown_node" if len(placed) < len(own) else "unknown_cluster" if any(c is None for c, _ in placed) else "cross_type" if len(kinds) > 1 else "no_edge" if len(clusters) < 2 else "edge"
        wanted[group] = (len(clusters), min(clusters, default=None), max(clusters, default=None), verdict)
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == wanted and len(set(wanted.values())) > 5
    assert found.schema["clusters_count"].dataType.simpleString() == "bigint"
    # Two distinct counts made each row three, held by a task at once.
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
