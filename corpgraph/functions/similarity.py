"""String similarity on a 0-100 scale, from the public definitions: indel ratio, token-set ratio, weighted ratio."""

from __future__ import annotations

import functools


@functools.lru_cache(maxsize=100_000)
def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    if len(a) < len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for ch in b:
        u = s & masks.get(ch, 0)
        s = (s + u | s - u) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * common_subsequence(a, b) / (len(a) + len(b))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    gap = 1 if both else 0
    n, m = len(both) + gap + len(left), len(both) + gap + len(right)
    best = 100 - 100 * (len(left) + len(right) - 2 * common_subsequence(left, right)) / (n + m)
    if both:
        best = max(best, *(100 - 100 * (gap + len(rest)) / (len(both) + size) for rest, size in ((left, n), (right, m))))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string to any stretch of the longer one of its length, ends included."""
    a, b = sorted((a, b), key=len)
    if not a:
        return 0.0 if b else 100.0
    return max(ratio(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    length = max(len(a), len(b)) / min(len(a), len(b))
    if length < 1.5:
        return max(ratio(a, b), 0.95 * token_sort_ratio(a, b), 0.95 * token_set_ratio(a, b))
    scale = 0.9 if length <= 8 else 0.6
    x, y = set(a.split()), set(b.split())
    tokens = 100.0 if x & y else partial_ratio(" ".join(sorted(x)), " ".join(sorted(y)))
    tokens = max(tokens, partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))
    return max(ratio(a, b), scale * partial_ratio(a, b), 0.95 * scale * tokens)


SCORERS = {"token_set": token_set_ratio, "weighted": weighted_ratio, "ratio": ratio}
