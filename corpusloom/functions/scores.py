"""Composite scores as expressions.

Rounding is ``floor(x * 10**n + 0.5) / 10**n``: the same arithmetic in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flags that void a judgement.
HARD_FLAGS = ["prompt_injection", "cmd_injection", "unsafe_exec", "auth_bypass", "csam_risk"]


def half_up(x: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / scale


def piecewise(n: Column, points: list[tuple[float, float]], steps: bool = False) -> Column:
    """Linear (or stepwise) interpolation through ``(n, value)`` points; 0 outside."""
    out = F.when(n < points[0][0], 0.0)
    for (x0, y0), (x1, y1) in zip(points[:-1], points[1:]):
        out = out.when(n < x1, F.lit(y0) if steps else y0 + (n - x0) / (x1 - x0) * (y1 - y0))
    return out.when(n <= points[-1][0], points[-1][1]).otherwise(0.0)


def body_length_score(n: Column) -> Column:
    return F.when((n >= 300) & (n < 1000), 0.3 + (n - 300) / 700 * 0.4).otherwise(piecewise(n, [(1000, 1.0), (10000, 1.0), (30000, 0.6), (50000, 0.3)]))


def description_length_score(n: Column) -> Column:
    return F.when(n < 20, 0.0).when(n < 60, 0.5).when(n <= 1024, 1.0).otherwise(0.8)


def judged_content(utility: Column, robustness: Column, safety: Column, flags: Column) -> Column:
    """Content score 0-10 of a judgement's three scores and flags."""
    s = safety / 10.0
    content = 0.5 * (utility / 10.0) + 0.35 * (robustness / 10.0) + 0.15 * s
    content = F.when(s < 0.7, content * (0.5 + 0.5 * ((s - 0.3) / 0.4))).otherwise(content)
    void = (safety < 3) | F.coalesce(F.arrays_overlap(flags, F.array(*[F.lit(f) for f in HARD_FLAGS])), F.lit(False))
    return F.when(void, 0.0).otherwise(half_up(F.greatest(F.lit(0.0), content) * 10.0, 2))


def composite(content: Column, prior: Column, scripts: Column, references: Column) -> Column:
    """Content and source prior, with small additions for scripts and references, in 0-1."""
    bonus = F.when(scripts, 0.05).otherwise(0.0) + F.when(references, 0.02).otherwise(0.0)
    return half_up(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.85 * content + 0.15 * prior + bonus)), 3)


def front_matter_richness(fields: Column) -> Column:
    """Share of the four meaningful fields that count as a full front matter."""
    return F.least(F.lit(1.0), fields / 4)


def structural_content(body_len: Column, description_len: Column, richness: Column) -> Column:
    return 0.5 + 0.1 * body_length_score(body_len) + 0.05 * description_length_score(description_len) + 0.05 * richness


def pass_at_k(n: Column, c: Column, k: Column) -> Column:
    """Chance that at least one of k draws without replacement from n runs, c of them right, is right."""
    misses = F.aggregate(F.sequence(F.lit(0), k - 1), F.lit(1.0), lambda acc, i: acc * (n - c - i) / (n - i))
    return F.when(n < k, F.lit(None).cast("double")).when(n - c < k, 1.0).otherwise(1.0 - misses)


def pass_hat_k(n: Column, c: Column, k: Column) -> Column:
    """Chance that all of k draws without replacement are right."""
    hits = F.aggregate(F.sequence(F.lit(0), k - 1), F.lit(1.0), lambda acc, i: acc * (c - i) / (n - i))
    return F.when(n < k, F.lit(None).cast("double")).when(c < k, 0.0).otherwise(hits)
