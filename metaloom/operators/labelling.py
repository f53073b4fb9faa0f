"""Labels for the unnamed nodes of one connected component: the helper of `quads.compare_releases`.

Nodes are numbers, links are (from, property, to). Cells of an ordered partition are known by their first place, so the order of cells
does not depend on how the nodes were numbered.
"""

from __future__ import annotations

import hashlib
import sys
from collections import defaultdict, deque

from metaloom.shipping import ship_by_value

Links = list[tuple[int, str, int]]


def digest(*parts: object) -> str:
    return hashlib.sha1(repr(parts).encode()).hexdigest()


class Cells:
    """An ordered partition of nodes, first by colour."""

    def __init__(self, colours: list[str]) -> None:
        self.order = sorted(range(len(colours)), key=colours.__getitem__)
        self.place = [0] * len(colours)
        self.start, self.size = [0] * len(colours), {}
        first = 0
        for i, node in enumerate(self.order):
            if colours[node] != colours[self.order[first]]:
                first = i
            self.place[node], self.start[node] = i, first
            self.size[first] = i - first + 1

    def copy(self) -> Cells:
        out = Cells.__new__(Cells)
        out.order, out.place, out.start, out.size = self.order[:], self.place[:], self.start[:], dict(self.size)
        return out

    def _move(self, node: int, to: int) -> None:
        other, at = self.order[to], self.place[node]
        self.order[at], self.place[other] = other, at
        self.order[to], self.place[node] = node, to

    def single_out(self, node: int) -> int:
        """Put `node` into a cell of its own before the rest of its cell; the place of the new cell."""
        first = self.start[node]
        self._move(node, first)
        for other in self.order[first + 1 : first + self.size[first]]:
            self.start[other] = first + 1
        self.size[first + 1], self.size[first] = self.size[first] - 1, 1
        return first

    def split(self, first: int, counts: list[tuple[int, int]]) -> list[int]:
        """Part a cell by how often its nodes were met (count, node; the others never): places of the parts."""
        end = first + self.size[first]
        parts, at = [], end
        counts.sort(key=lambda c: -c[0])
        for i, (count, node) in enumerate(counts):
            at -= 1
            self._move(node, at)
            if i + 1 == len(counts) or counts[i + 1][0] != count:
                parts.append(at)
        if at > first:
            parts.append(first)
        for part, stop in zip(parts, [end, *parts]):
            self.size[part] = stop - part
            if part == first:
                # What stays in front keeps its place: a long cell is not walked for each node that leaves it.
                continue
            for node in self.order[part:stop]:
                self.start[node] = part
        return parts

    def refine(self, meets: list[list[tuple[str, int]]], cells: list[int]) -> None:
        """Part cells until all nodes of a cell are linked alike with every cell; n log n of the links."""
        queue, waiting = deque(cells), set(cells)
        while queue:
            cell = queue.popleft()
            waiting.discard(cell)
            met: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))
            for node in self.order[cell : cell + self.size[cell]]:
                for kind, other in meets[node]:
                    met[kind][other] += 1
            for kind in sorted(met):
                by_cell = defaultdict(list)
                for node, count in met[kind].items():
                    by_cell[self.start[node]].append((count, node))
                for first in sorted(by_cell):
                    counts = by_cell[first]
                    if len(counts) == self.size[first] and len({c for c, _ in counts}) == 1:
                        continue
                    parts = self.split(first, counts)
                    if first not in waiting:
                        parts.remove(max(parts, key=lambda p: (self.size[p], -p)))
                    for part in sorted(parts):
                        if part not in waiting:
                            waiting.add(part)
                            queue.append(part)


def _meets(n: int, links: Links) -> list[list[tuple[str, int]]]:
    out: list[list[tuple[str, int]]] = [[] for _ in range(n)]
    for a, p, b in links:
        out[b].append(("<" + p, a))
        out[a].append((">" + p, b))
    return out


def stable_cells(colours: list[str], links: Links) -> Cells:
    cells = Cells(colours)
    cells.refine(_meets(len(colours), links), sorted(cells.size))
    return cells


def _rings(n: int, links: Links) -> list[list[int]]:
    """Strongly connected parts, each after those that it leads to."""
    onward: list[list[int]] = [[] for _ in range(n)]
    for a, _, b in links:
        onward[a].append(b)
    found, low, on_stack = [0] * n, [0] * n, [False] * n
    stack, parts, clock = [], [], 0
    for root in range(n):
        if found[root]:
            continue
        work = [(root, iter(onward[root]))]
        clock += 1
        found[root] = low[root] = clock
        stack.append(root)
        on_stack[root] = True
        while work:
            node, rest = work[-1]
            for other in rest:
                if not found[other]:
                    clock += 1
                    found[other] = low[other] = clock
                    stack.append(other)
                    on_stack[other] = True
                    work.append((other, iter(onward[other])))
                    break
                if on_stack[other]:
                    low[node] = min(low[node], found[other])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == found[node]:
                    part = []
                    while not part or part[-1] != node:
                        part.append(stack.pop())
                        on_stack[part[-1]] = False
                    parts.append(part)
    return parts


def settled(colours: list[str], links: Links) -> tuple[list[str], list[bool]]:
    """For each node a hash of all that it leads to, and whether it lies on a ring."""
    n = len(colours)
    hashes, ring = [""] * n, [False] * n
    out: list[list[tuple[str, int]]] = [[] for _ in range(n)]
    for a, p, b in links:
        out[a].append((p, b))
    for part in _rings(n, links):
        inside = {node: i for i, node in enumerate(part)}
        if len(part) == 1 and all(b != part[0] for _, b in out[part[0]]):
            (node,) = part
            hashes[node] = digest(colours[node], sorted((p, hashes[b]) for p, b in out[node]))
            continue
        own = [digest(colours[a], sorted((p, hashes[b]) for p, b in out[a] if b not in inside)) for a in part]
        inner = [(inside[a], p, inside[b]) for a in part for p, b in out[a] if b in inside]
        cells = stable_cells(own, inner)
        # All nodes of a cell are linked alike, so one of each tells what the part is like.
        by_node = defaultdict(list)
        for a, p, b in inner:
            by_node[a].append((p, cells.start[b]))
        kinds = [(first, size, own[cells.order[first]], sorted(by_node[cells.order[first]])) for first, size in sorted(cells.size.items())]
        code = digest(kinds)
        for node, i in inside.items():
            hashes[node], ring[node] = digest(code, cells.start[i]), True
    return hashes, ring


class _Search:
    """Individualisation and refinement, with the symmetries found on the way to leave out equal branches."""

    def __init__(self, colours: list[str], links: Links) -> None:
        self.links, self.meets = links, _meets(len(colours), links)
        self.root = stable_cells(colours, links)
        self.first = self.best = None
        self.symmetries: list[list[int]] = []
        self.colours = colours

    def code(self) -> str:
        old = sys.getrecursionlimit()
        sys.setrecursionlimit(max(old, 3 * len(self.colours) + 1000))
        try:
            self._below(self.root, [])
        finally:
            sys.setrecursionlimit(old)
        form, order, _ = self.best
        return digest([self.colours[node] for node in order], form)

    def _leaf(self, cells: Cells, path: list[int]) -> int:
        place = cells.place
        leaf = (sorted((place[a], p, place[b]) for a, p, b in self.links), cells.order, path)
        if self.first is None:
            self.first = self.best = leaf
            return len(path)
        for known in (self.first, self.best):
            if known[0] == leaf[0]:
                symmetry = [0] * len(place)
                for one, other in zip(known[1], cells.order):
                    symmetry[one] = other
                self.symmetries.append(symmetry)
                return next(i for i, (a, b) in enumerate(zip(known[2], path)) if a != b)
        if leaf[0] < self.best[0]:
            self.best = leaf
        return len(path)

    def _below(self, cells: Cells, path: list[int]) -> int:
        """Search below a partition; the depth at which to go on."""
        open_cells = [(size, first) for first, size in cells.size.items() if size > 1]
        if not open_cells:
            return self._leaf(cells, path)
        size, first = min(open_cells)
        parent = {node: node for node in cells.order[first : first + size]}
        read = 0

        def root(node: int) -> int:
            while parent[node] != node:
                parent[node] = parent[parent[node]]
                node = parent[node]
            return node

        tried: list[int] = []
        for node in cells.order[first : first + size]:
            for symmetry in self.symmetries[read:]:
                if all(symmetry[x] == x for x in path):
                    for x in parent:
                        parent[root(symmetry[x])] = root(x)
            read = len(self.symmetries)
            if any(root(node) == root(other) for other in tried):
                continue
            child = cells.copy()
            child.refine(self.meets, [child.single_out(node)])
            depth = self._below(child, [*path, node])
            tried.append(node)
            if depth < len(path):
                return depth
        return len(path)


def _folded(colours: list[str], links: Links) -> tuple[list[str], list[bool], list[tuple[int, int, str]]]:
    """Fold what needs no search: nodes on a single link, layer by layer, and nodes alike with the same neighbours.

    Gives the colours of the nodes that are left, which are left, and in order who was folded into whom, by which kind of link
    (empty: it is the other's twin).
    """
    colours, meets = colours[:], _meets(len(colours), links)
    degree, left = [len(m) for m in meets], [True] * len(colours)
    steps: list[tuple[int, int, str]] = []

    def near(node: int) -> list[tuple[str, int]]:
        return [(kind, other) for kind, other in meets[node] if left[other]]

    again = True
    while again:
        layer = [node for node in range(len(colours)) if left[node] and degree[node] == 1]
        while layer:
            under: dict[int, list[tuple[str, str]]] = defaultdict(list)
            for node in layer:
                ((kind, other),) = near(node)
                if degree[other] > 1:
                    under[other].append((kind, colours[node]))
                    steps.append((node, other, kind))
            for node, _, _ in steps[len(steps) - sum(map(len, under.values())) :]:
                left[node] = False
            layer = []
            for other, below in under.items():
                colours[other] = digest("with", colours[other], sorted(below))
                degree[other] -= len(below)
                if degree[other] == 1:
                    layer.append(other)
        alike = defaultdict(list)
        for node in range(len(colours)):
            if left[node]:
                alike[colours[node], tuple(sorted(near(node)))].append(node)
        again = False
        for (_, around), nodes in alike.items():
            if len(nodes) > 1 and around:
                again = True
                colours[nodes[0]] = digest("times", colours[nodes[0]], len(nodes))
                for node in nodes[1:]:
                    left[node] = False
                    steps.append((node, nodes[0], ""))
                    for _, other in around:
                        degree[other] -= 1
    return colours, left, steps


def labels(colours: list[str], links: Links) -> list[str]:
    """A label for each node: equal for nodes that correspond in components of equal form, and for no others.

    Nodes of one component that a symmetry exchanges have equal labels.
    """
    folded, left, steps = _folded(colours, links)
    nodes = [node for node in range(len(colours)) if left[node]]
    number = {node: i for i, node in enumerate(nodes)}
    inner = [(number[a], p, number[b]) for a, p, b in links if left[a] and left[b]]
    search = _Search([folded[node] for node in nodes], inner)
    code = search.code()
    out = [""] * len(colours)
    for node, i in number.items():
        out[node] = digest(code, search.root.start[i])
    for node, other, kind in reversed(steps):
        out[node] = digest("under", out[other], kind, folded[node]) if kind else out[other]
    return out


ship_by_value(__name__)
