"""Links reduced to stars inside a task."""

from __future__ import annotations

import numpy as np


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of the links a-b as (member, least member), without the least itself."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def spanning_forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray, whole: int) -> np.ndarray:
    """Indexes of the links a-b that are passed on: all of a component with at most ``whole``
    links, and of a larger one the links of a spanning tree of least weight."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    order = np.argsort(weight, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    label, chosen = np.arange(len(nodes)), np.zeros(len(a), bool)
    while True:  # each component takes its lightest link to another one
        apart = np.flatnonzero(label[left] != label[right])
        if not len(apart):
            break
        best = np.full(len(nodes), len(order))
        np.minimum.at(best, label[left[apart]], rank[apart])
        np.minimum.at(best, label[right[apart]], rank[apart])
        fresh = order[np.unique(best[best < len(order)])]
        chosen[fresh] = True
        member, least = spanning_stars(label[left[fresh]], label[right[fresh]])
        move = np.arange(len(nodes))
        move[member] = least
        label = move[label]
    small = np.bincount(label[left], minlength=len(nodes)) <= whole
    return np.flatnonzero(chosen | small[label[left]])
