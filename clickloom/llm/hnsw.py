"""A hierarchical navigable small-world graph in flat arrays, built and searched a batch at a time.

Points are ordered by level, highest first, so each layer holds a prefix of them and its neighbour lists are one array
(-1 where a list is short). A layer starts with the links of the layer above and takes the rest of its points in
batches: a beam search finds candidates among the points already there, those of the batch are compared directly, and
links go to near points in different directions. Largest inner products become smallest distances by one more
coordinate, which lifts all points to the length of the longest, here 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LINKS, BASE_LINKS, BEAM, BATCH, SPREAD = 16, 32, 80, 256, 16
#: points that a beam visits in one step
AT_ONCE = 4


@dataclass
class Graph:
    points: np.ndarray  # n x (d + 1), float32
    layers: list[np.ndarray]  # from the base up: size x links, int32

    def search(self, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest points of each query row (numbers and squared distances; -1 where there are fewer)."""
        entries = np.zeros((len(queries), 1), np.int64)
        for layer in self.layers[:0:-1]:
            entries, _ = beam_search(self.points, layer, queries, entries, 8)
        found, far = beam_search(self.points, self.layers[0], queries, entries, max(beam, k))
        return found[:, :k], far[:, :k]

    def pack(self) -> dict[str, bytes | list[int]]:
        return {"points": self.points.tobytes(), "sizes": [v for a in self.layers for v in a.shape],
                "links": b"".join(a.tobytes() for a in self.layers)}

    @staticmethod
    def unpack(points: bytes, sizes: list[int], links: bytes) -> Graph:
        flat, layers, at = np.frombuffer(links, np.int32), [], 0
        for rows, width in zip(sizes[::2], sizes[1::2]):
            layers.append(flat[at:at + rows * width].reshape(rows, width))
            at += rows * width
        return Graph(np.frombuffer(points, np.float32).reshape(sizes[0], -1), layers)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1, whatever finite length they have; in double precision."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True, initial=np.finfo(float).tiny)
    return vectors / np.maximum(np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), np.finfo(float).tiny)[:, None]


def lift(vectors: np.ndarray) -> np.ndarray:
    """Points of length 1, whose distances to ``(query, 0)`` order like inner products from the largest.

    Precise for vectors whose lengths differ by a small factor.
    """
    vectors = np.asarray(vectors, np.float64) / np.abs(vectors).max(initial=np.finfo(float).tiny)
    squares = np.einsum("ij,ij->i", vectors, vectors)
    longest = squares.max(initial=np.finfo(float).tiny)
    extra = np.sqrt(np.maximum(longest - squares, 0))
    return (np.column_stack([vectors, extra]) / np.sqrt(longest)).astype(np.float32)


def _distances(points: np.ndarray, which: np.ndarray, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    off = points[which] - queries[rows]
    return np.einsum("ij,ij->i", off, off)


def beam_search(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest points found from the entries (queries x some, -1 for none), nearest first."""
    n, size = len(queries), len(links)
    beam = min(beam, size)
    ids, far, open_ = np.full((n, beam), -1, np.int64), np.full((n, beam), np.inf, np.float32), np.zeros((n, beam), bool)
    seen = np.zeros((n, size), bool)
    rows, fresh = np.nonzero(entries >= 0)[0], entries[entries >= 0]
    while len(rows):
        keys = np.unique(rows * size + fresh)
        keys = keys[~seen.reshape(-1)[keys]]
        seen.reshape(-1)[keys] = True
        rows, fresh = keys // size, keys % size
        new = _distances(points, fresh, queries, rows)
        # into one padded row for each query that goes on, then the best of old and new
        some, first, counts = np.unique(rows, return_index=True, return_counts=True)
        place = np.arange(len(rows)) - np.repeat(first, counts)
        width, at = int(counts.max(initial=0)), np.repeat(np.arange(len(some)), counts)
        more_ids, more_far = np.full((len(some), width), -1, np.int64), np.full((len(some), width), np.inf, np.float32)
        more_ids[at, place], more_far[at, place] = fresh, new
        all_ids, all_far = np.concatenate([ids[some], more_ids], 1), np.concatenate([far[some], more_far], 1)
        all_open = np.concatenate([open_[some], more_ids >= 0], 1)
        order = np.argsort(all_far, 1, kind="stable")[:, :beam]
        ids[some], far[some], open_[some] = (np.take_along_axis(a, order, 1) for a in (all_ids, all_far, all_open))
        # visit the nearest points not yet visited
        rank = np.cumsum(open_, 1)
        rows, columns = np.nonzero(open_ & (rank <= AT_ONCE))
        open_[rows, columns] = False
        around = links[ids[rows, columns]]
        rows, fresh = np.repeat(rows, around.shape[1]), around.reshape(-1).astype(np.int64)
        rows, fresh = rows[fresh >= 0], fresh[fresh >= 0]
    return ids, far


def _diverse(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's candidates (sorted, -1 for none): first those nearer to the point than to any chosen
    one, then the nearest of the rest."""
    near = points[np.maximum(candidates, 0)]
    squares = np.einsum("bij,bij->bi", near, near)
    between = squares[:, :, None] + squares[:, None, :] - 2 * near @ near.transpose(0, 2, 1)
    good = (candidates >= 0) & (candidates != own[:, None])
    chosen, count = np.zeros_like(good), np.zeros(len(own), np.int64)
    for j in range(candidates.shape[1]):
        take = good[:, j] & (count < most) & ~(chosen & (between[:, j] < far[:, j, None])).any(1)
        chosen[:, j] = take
        count += take
    order = np.argsort(np.where(chosen, 0, np.where(good, 1, 2)), 1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(good, order, 1), np.take_along_axis(candidates, order, 1), -1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1).astype(np.int32)


def _link_back(points: np.ndarray, links: np.ndarray, new: np.ndarray) -> None:
    """Links from the neighbours of new points to these; lists that overflow are chosen anew."""
    targets, sources = links[new].reshape(-1).astype(np.int64), np.repeat(new, links.shape[1])
    targets, sources = targets[targets >= 0], sources[targets >= 0]
    if not len(targets):
        return
    off = points[targets] - points[sources]
    order = np.lexsort((np.einsum("ij,ij->i", off, off), targets))
    targets, sources = targets[order], sources[order]
    some, first, counts = np.unique(targets, return_index=True, return_counts=True)
    place, at = np.arange(len(targets)) - np.repeat(first, counts), np.repeat(np.arange(len(some)), counts)
    fits = place < links.shape[1]
    added = np.full((len(some), min(int(counts.max()), links.shape[1])), -1, np.int64)
    added[at[fits], place[fits]] = sources[fits]
    both = np.concatenate([links[some].astype(np.int64), added], 1)
    off = points[np.maximum(both, 0)] - points[some][:, None]
    far = np.where(both >= 0, np.einsum("bij,bij->bi", off, off), np.inf)
    order = np.argsort(far, 1, kind="stable")
    both, far = np.take_along_axis(both, order, 1), np.take_along_axis(far, order, 1)
    # a link that was there and comes again counts once
    again = np.zeros_like(both, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] >= 0)
    both[again] = -1
    links[some] = _diverse(points, some, both, far, links.shape[1])


def build(points: np.ndarray, seed: int) -> tuple[Graph, np.ndarray]:
    """The graph and the order in which it holds the points."""
    rng = np.random.default_rng(seed)
    levels = np.floor(-np.log(1 - rng.random(len(points))) / np.log(SPREAD)).astype(int)
    order = np.argsort(-levels, kind="stable")
    points, levels = np.ascontiguousarray(points[order]), levels[order]
    above: list[np.ndarray] = []  # from the top down
    for level in range(int(levels.max(initial=0)), -1, -1):
        size = int((levels >= level).sum())
        links = np.full((size, BASE_LINKS if level == 0 else LINKS), -1, np.int32)
        have = 0
        if above:
            have = len(above[-1])
            links[:have, :above[-1].shape[1]] = above[-1][:, :links.shape[1]]
        have = max(have, 1)
        while have < size:
            new = np.arange(have, min(size, have + min(max(have // 2, 8), BATCH)))
            queries = points[new]
            entries = np.zeros((len(new), 1), np.int64)
            for layer in above:
                entries, _ = beam_search(points, layer, queries, entries, 4)
            found, far = beam_search(points, links[:have], queries, entries, BEAM)
            squares = np.einsum("ij,ij->i", queries, queries)
            inside = np.maximum(squares[:, None] + squares - 2 * queries @ queries.T, 0)
            np.fill_diagonal(inside, np.inf)
            near = np.argsort(inside, 1, kind="stable")[:, :links.shape[1]]
            both = np.concatenate([found, new[near]], 1)
            far = np.concatenate([far, np.take_along_axis(inside, near, 1)], 1)
            best = np.argsort(far, 1, kind="stable")[:, :BEAM]
            links[new] = _diverse(points, new, np.take_along_axis(both, best, 1), np.take_along_axis(far, best, 1), links.shape[1])
            have += len(new)
            _link_back(points, links, new)
        above.append(links)
    return Graph(points, above[::-1] or [np.full((0, BASE_LINKS), -1, np.int32)]), order
