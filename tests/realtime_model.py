"""The real-time rules for one user at a time, in plain Python, as the tests' measure."""

from __future__ import annotations

import math


def newest(ratings, k=20):
    """``ratings`` are (mid, score, timestamp)."""
    return sorted(ratings, key=lambda r: (r[2], r[0], r[1]), reverse=True)[:k]


def recommend(trigger, recent, rated, sim, k=20, relevance=0.7):
    """``recent`` are (mid, score), ``sim`` maps (mid, mid) to a similarity; returns (mid, score) best first."""
    listed = sorted((-s, b) for (a, b), s in sim.items() if a == trigger and b not in rated)[:k]
    scored = []
    for _, candidate in listed:
        close = [(sim[candidate, mid], score) for mid, score in recent if sim.get((candidate, mid), 0.0) > relevance]
        if close:
            likes = sum(score > 3 for _, score in close)
            mean = sum(s * score for s, score in close) / len(close)
            scored.append((candidate, mean + math.log10(max(1, likes)) - math.log10(max(1, len(close) - likes))))
    return sorted(scored, key=lambda x: (-x[1], x[0]))
