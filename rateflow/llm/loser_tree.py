"""Merging sorted, front-coded runs of byte strings with a loser tree that
never compares a prefix it already knows to be common."""

from __future__ import annotations

from collections.abc import Iterator

# A run yields (string, common prefix with the run's string before, payload).
Run = Iterator[tuple[bytes, int, object]]


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    low, step = known, 8
    while a[low:low + step] == b[low:low + step]:
        low += step
        step *= 2
    high = min(low + step, end)
    while high - low > 1:                      # a and b differ in [low, high)
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def merged(runs: list[Run]) -> Iterator[tuple[bytes, int, object]]:
    """All strings in order, each with its common prefix with the one before."""
    size = 1
    while size < len(runs):
        size *= 2
    heads: list = [next(r, None) for r in runs] + [None] * (size - len(runs))
    losers, prefix = [0] * size, [0] * size    # inner nodes: the loser and its prefix with the winner

    def play(a: int, ha: int, b: int, hb: int) -> tuple[int, int, int, int]:
        """Winner, its prefix with the last output; loser, its prefix with the
        winner.  ``ha`` and ``hb`` are prefixes with the last output, -1 if a
        run has ended."""
        if ha != hb:
            return (a, ha, b, hb) if ha > hb else (b, hb, a, ha)
        if ha < 0:
            return a, ha, b, hb
        x, y = heads[a][0], heads[b][0]
        n = common_prefix(x, y, ha)
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            return a, ha, b, n
        return b, hb, a, n

    def build(node: int) -> tuple[int, int]:
        if node >= size:
            return node - size, 0 if heads[node - size] else -1
        (a, ha), (b, hb) = build(2 * node), build(2 * node + 1)
        a, ha, losers[node], prefix[node] = play(a, ha, b, hb)
        return a, ha

    winner, h = build(1)
    while h >= 0:
        string, _, payload = heads[winner]
        yield string, h, payload
        head = next(runs[winner], None)
        heads[winner] = head
        h = head[1] if head else -1
        node = (winner + size) // 2
        while node:
            winner, h, losers[node], prefix[node] = play(winner, h, losers[node], prefix[node])
            node //= 2
