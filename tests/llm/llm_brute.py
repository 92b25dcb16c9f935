"""Brute-force versions that several test modules use."""

from fractions import Fraction


def brute_targets(sizes):
    """Targets by repeated sharing: what stops at twice its source is full, the rest shares what is left."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = Fraction(3 * sum(sizes.values()), 2), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        for s in over or open_:
            target[s] = Fraction(2 * sizes[s]) if over else left * weight[s] / total
        if not over:
            return target
        left -= sum(target[s] for s in over)
        open_ -= over
    return target
