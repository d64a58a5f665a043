"""A hierarchical navigable small-world graph in NumPy, searched for many queries at once.

A search keeps a beam of the best nodes of each query and widens all beams together, a few
nodes per round. Layers are built from the top; the nodes of a layer are inserted in batches
that grow with it, and meet both the graph so far and each other.
"""

from __future__ import annotations

import io

import numpy as np

#: Neighbours on the lowest and on other layers, and the beam that finds them.
LOW_DEGREE, DEGREE, BUILD_BEAM = 16, 12, 32
#: Nodes of a beam that are expanded in a round; beam on the upper layers.
EXPANDED, UPPER_BEAM = 8, 8
TOP_NODES = 64
#: Marks of visited nodes that a search holds at a time.
MARKS = 1 << 21


def _beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, similarities) of the ``width`` best nodes that are found, best first; -1: none."""
    n, count = len(vectors), len(queries)
    rows = max(1, min(count, MARKS // max(1, n)))
    if count > rows:
        parts = [_beam(vectors, links, queries[a : a + rows], entry[a : a + rows], width) for a in range(0, count, rows)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))
    seen = np.zeros((count, n), bool)
    ids = np.full((count, width), -1, np.int64)
    sims = np.full((count, width), -np.inf, np.float32)
    done = np.zeros((count, width), bool)
    active, found = np.arange(count), entry
    while len(active):
        found = np.sort(found, axis=1)
        fresh = found >= 0
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        fresh &= ~seen[active[:, None], np.maximum(found, 0)]
        r, c = np.nonzero(fresh)
        nodes = found[r, c]
        seen[active[r], nodes] = True
        new = np.full(found.shape, -np.inf, np.float32)
        new[r, c] = np.einsum("ij,ij->i", queries[active[r]], vectors[nodes])
        all_ids = np.concatenate([ids[active], np.where(fresh, found, -1)], 1)
        all_sims = np.concatenate([sims[active], new], 1)
        all_done = np.concatenate([done[active], np.zeros(found.shape, bool)], 1)
        if all_sims.shape[1] > 3 * width:
            part = np.argpartition(-all_sims, width, axis=1)[:, :width]
            order = np.take_along_axis(part, np.argsort(-np.take_along_axis(all_sims, part, 1), axis=1), 1)
        else:
            order = np.argsort(-all_sims, axis=1)[:, :width]
        ids[active], sims[active] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_sims, order, 1)
        all_done = np.take_along_axis(all_done, order, 1)
        open_ = ~all_done & (ids[active] >= 0)
        first = np.argsort(~open_, axis=1, kind="stable")[:, :EXPANDED]
        valid = np.take_along_axis(open_, first, 1)
        np.put_along_axis(all_done, first, True, 1)
        done[active] = all_done
        going = valid.any(1)
        active = active[going]
        if not len(active):
            break
        at = np.take_along_axis(ids[active], first[going], 1)
        found = np.where(valid[going][:, :, None], links[np.maximum(at, 0)], -1).reshape(len(active), -1)
    return ids, sims


def _spread(vectors: np.ndarray, candidates: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """For each row, ``degree`` of its candidates: first those that are nearer to the row than
    to any chosen so far, then the nearest of the others."""
    order = np.argsort(-sims, axis=1)
    candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
    real = np.isfinite(sims) & (candidates >= 0)
    near = vectors[np.maximum(candidates, 0)]
    mutual = near @ near.transpose(0, 2, 1)
    chosen = np.zeros(candidates.shape, bool)
    for k in range(candidates.shape[1]):
        closer = (chosen & (mutual[:, :, k] >= sims[:, k : k + 1])).any(1)
        chosen[:, k] = real[:, k] & ~closer & (chosen.sum(1) < degree)
    rank = np.argsort(np.where(chosen, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :degree]
    kept = np.where(np.take_along_axis(real, rank, 1), np.take_along_axis(candidates, rank, 1), -1)
    if kept.shape[1] < degree:
        kept = np.concatenate([kept, np.full((len(kept), degree - kept.shape[1]), -1)], 1)
    return kept


class Graph:
    """``layers[0]`` is the lowest. A layer has its nodes and, by node, their neighbours."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors, self.layers = vectors, layers

    @staticmethod
    def _heights(n: int, seed: int) -> np.ndarray:
        return np.floor(-np.log(np.random.default_rng(seed).random(n)) / np.log(DEGREE)).astype(int)

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 7) -> Graph:
        """Over unit vectors."""
        n = len(vectors)
        heights = cls._heights(n, seed)
        top = 0
        while (heights > top).sum() > TOP_NODES // 4 and (heights >= top).sum() > TOP_NODES:
            top += 1
        graph = cls(vectors, [])
        for level in range(top, -1, -1):
            nodes = np.flatnonzero(heights >= level)
            nodes = nodes[np.argsort(-heights[nodes], kind="stable")]
            graph._add_layer(nodes, LOW_DEGREE if level == 0 else DEGREE)
        return graph

    def _add_layer(self, nodes: np.ndarray, degree: int) -> None:
        links = np.full((len(self.vectors), degree), -1, np.int64)
        upper = self.layers[0][0] if self.layers else nodes[:TOP_NODES]
        placed, size = 0, min(len(nodes), TOP_NODES)
        while placed < len(nodes):
            batch = nodes[placed : placed + size]
            own = self.vectors[batch]
            among = own @ own.T
            np.fill_diagonal(among, -np.inf)
            take = min(degree, len(batch) - 1)
            best = np.argpartition(-among, take - 1, axis=1)[:, :take] if take > 0 else np.zeros((len(batch), 0), int)
            candidates, sims = batch[best], np.take_along_axis(among, best, 1)
            if placed:
                entry = self._entry(own) if self.layers else np.tile(upper, (len(batch), 1))
                entry = np.where(np.isin(entry, nodes[:placed]), entry, -1)
                entry = np.concatenate([entry, np.full((len(batch), 1), nodes[0])], 1)
                ids, near = _beam(self.vectors, links, own, entry, BUILD_BEAM)
                candidates, sims = np.concatenate([candidates, ids], 1), np.concatenate([sims, near], 1)
            links[batch] = _spread(self.vectors, candidates, sims, degree)
            self._link_back(links, batch, degree)
            placed += size
            size = min(1024, max(TOP_NODES, placed // 2))
        self.layers.insert(0, (nodes, self._with_orphans(links, nodes)))

    def _with_orphans(self, links: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """One more column: nodes that no neighbour kept get a place at one of theirs."""
        led_to = np.bincount(links[links >= 0], minlength=len(self.vectors)) > 0
        orphans, extra = nodes[~led_to[nodes]], np.full(len(self.vectors), -1, np.int64)
        for k in range(links.shape[1]):
            at = links[orphans, k]
            free = (at >= 0) & (extra[np.maximum(at, 0)] < 0)
            extra[at[free]] = orphans[free]
            orphans = orphans[extra[np.maximum(at, 0)] != orphans]
        return np.concatenate([links, extra[:, None]], 1)

    def _link_back(self, links: np.ndarray, batch: np.ndarray, degree: int) -> None:
        source = np.repeat(batch, degree)
        target = links[batch].reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        sims = np.einsum("ij,ij->i", self.vectors[source], self.vectors[target])
        order = np.lexsort((-sims, target))
        source, target, sims = source[order], target[order], sims[order]
        begins = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.zeros(0, int)
        rank = np.arange(len(target)) - np.repeat(begins, np.diff(np.concatenate([begins, [len(target)]])))
        source, target, rank = source[rank < degree], target[rank < degree], rank[rank < degree]
        touched = np.unique(target)
        for at in range(0, len(touched), 2048):
            some = touched[at : at + 2048]
            mine = (target >= some[0]) & (target <= some[-1])
            new = np.full((len(some), degree), -1)
            new[np.searchsorted(some, target[mine]), rank[mine]] = source[mine]
            old = links[some]
            new[(new[:, :, None] == old[:, None, :]).any(2)] = -1
            every = np.concatenate([old, new], 1)
            near = np.einsum("ij,ikj->ik", self.vectors[some], self.vectors[np.maximum(every, 0)])
            links[some] = _spread(self.vectors, every, np.where(every >= 0, near, -np.inf), degree)

    def _entry(self, queries: np.ndarray) -> np.ndarray:
        """Where a search of the layer below the built ones begins."""
        entry = np.tile(self.layers[-1][0][:TOP_NODES], (len(queries), 1))
        for _, links in reversed(self.layers):
            entry, _ = _beam(self.vectors, links, queries, entry, UPPER_BEAM)
        return entry

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the nearest ``width`` nodes that are found, best first."""
        entry = np.tile(self.layers[-1][0][:TOP_NODES], (len(queries), 1))
        for _, links in reversed(self.layers[1:]):
            entry, _ = _beam(self.vectors, links, queries, entry, UPPER_BEAM)
        return _beam(self.vectors, self.layers[0][1], queries, entry, width)

    def dump(self) -> bytes:
        out = io.BytesIO()
        layers = {f"{part}{k}": a.astype(np.int32) for k, (nodes, links) in enumerate(self.layers) for part, a in (("n", nodes), ("l", links[nodes]))}
        np.savez(out, vectors=self.vectors, **layers)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Graph:
        held = np.load(io.BytesIO(data))
        vectors, layers, k = held["vectors"], [], 0
        while f"n{k}" in held:
            nodes, own = held[f"n{k}"].astype(np.int64), held[f"l{k}"]
            links = np.full((len(vectors), own.shape[1]), -1, np.int64)
            links[nodes] = own
            layers.append((nodes, links))
            k += 1
        return cls(vectors, layers)

    def parts(self) -> list[bytes]:
        """The neighbours of each node, layer after layer from the lowest on."""
        out = [b""] * len(self.vectors)
        for nodes, links in self.layers:
            for node, own in zip(nodes.tolist(), links[nodes].astype(np.int32), strict=True):
                out[node] += own.tobytes()
        return out

    @classmethod
    def of_parts(cls, vectors: np.ndarray, parts: list[bytes], seed: int = 7) -> Graph:
        """The graph that was built over ``vectors`` in this order and taken to pieces by :func:`parts`."""
        heights, sizes = cls._heights(len(vectors), seed), np.array([len(p) for p in parts])
        layers, begin, degree = [], 0, LOW_DEGREE
        while begin < sizes.max():
            end = begin + 4 * (degree + 1)
            nodes = np.flatnonzero(sizes >= end)
            nodes = nodes[np.argsort(-heights[nodes], kind="stable")]
            links = np.full((len(vectors), degree + 1), -1, np.int32)
            links[nodes] = np.frombuffer(b"".join(parts[k][begin:end] for k in nodes.tolist()), np.int32).reshape(-1, degree + 1)
            layers.append((nodes, links))
            begin, degree = end, DEGREE
        return cls(vectors, layers)
