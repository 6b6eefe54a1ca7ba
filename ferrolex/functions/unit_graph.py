"""Conversions between units as a graph whose edges are affine functions.

An edge (a, b, factor, offset) says: a value x in a is factor * x + offset in b. The graph composes shortest paths
once, checks that cycles agree, and gives a small table (source, target, factor, offset) to join on.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class Affine:
    """x -> factor * x + offset."""

    factor: float
    offset: float = 0.0

    def then(self, other: "Affine") -> "Affine":
        return Affine(other.factor * self.factor, other.factor * self.offset + other.offset)

    def inverse(self) -> "Affine":
        if self.factor == 0:
            raise ValueError("a conversion by factor 0 has no inverse")
        return Affine(1 / self.factor, -self.offset / self.factor)

    def agrees(self, other: "Affine", tolerance: float = 1e-9) -> bool:
        return math.isclose(self.factor, other.factor, rel_tol=tolerance) and math.isclose(
            self.offset, other.offset, rel_tol=tolerance, abs_tol=tolerance
        )


class UnitGraph:
    """Units as nodes, conversions as edges in both directions."""

    def __init__(self, edges: Iterable[tuple[str, str, float, float]] = ()):
        self.edges: dict[str, dict[str, Affine]] = {}
        for a, b, factor, offset in edges:
            self.add(a, b, Affine(factor, offset))

    def add(self, a: str, b: str, step: Affine) -> None:
        """Add a conversion; one that contradicts an edge already there raises."""
        for x, y, f in ((a, b, step), (b, a, step.inverse())):
            there = self.edges.setdefault(x, {}).get(y)
            if there is not None and not there.agrees(f):
                raise ValueError(f"two different conversions from {x} to {y}")
            self.edges[x][y] = f

    def paths(self, target: str) -> dict[str, Affine]:
        """The shortest composition from each unit that reaches the target. A cycle that does not agree raises."""
        if target not in self.edges:
            return {target: Affine(1.0)}
        found = {target: Affine(1.0)}
        queue = deque([target])
        while queue:
            b = queue.popleft()
            for a in self.edges[b]:
                f = self.edges[a][b].then(found[b])
                if a not in found:
                    found[a] = f
                    queue.append(a)
                elif not found[a].agrees(f):
                    raise ValueError(f"conversions from {a} to {target} disagree on a cycle over {b}")
        return found

    def table(self, targets: Iterable[str]) -> list[tuple[str, str, float, float]]:
        """(source, target, factor, offset) for all units that reach one of the targets."""
        return [(a, t, f.factor, f.offset) for t in targets for a, f in sorted(self.paths(t).items())]
