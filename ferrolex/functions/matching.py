"""Bipartite matching of largest total weight, for small sides such as the columns of two file versions."""

from __future__ import annotations


def best_matching(weights: list[list[float]]) -> list[tuple[int, int]]:
    """Pairs (row, column) of a matching with the largest total weight; pairs of weight 0 or less are left out.

    Shortest augmenting paths on costs of the padded square matrix. Of equal matchings the first found is given.
    """
    n = max(len(weights), max((len(r) for r in weights), default=0))
    if n == 0:
        return []
    cost = [[-weights[i][j] if i < len(weights) and j < len(weights[i]) and weights[i][j] > 0 else 0.0 for j in range(n)] for i in range(n)]
    big = float("inf")
    row_of = [-1] * n
    u, v = [0.0] * n, [0.0] * n
    for start in range(n):
        least, from_column, done = [big] * n, [-1] * n, [False] * n
        column, i = -1, start
        while True:
            step, after = big, -1
            for j in range(n):
                if done[j]:
                    continue
                reduced = cost[i][j] - u[i] - v[j]
                if reduced < least[j]:
                    least[j], from_column[j] = reduced, column
                if least[j] < step:
                    step, after = least[j], j
            u[start] += step
            for j in range(n):
                if done[j]:
                    u[row_of[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            done[after] = True
            column = after
            if row_of[column] < 0:
                break
            i = row_of[column]
        while column >= 0:
            before = from_column[column]
            row_of[column] = start if before < 0 else row_of[before]
            column = before
    return sorted((i, j) for j, i in enumerate(row_of) if i < len(weights) and j < len(weights[i]) and weights[i][j] > 0)
