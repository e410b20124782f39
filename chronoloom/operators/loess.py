"""Local linear smoothing of blocks: numpy kernels for the tasks.

Away from the ends of a series the q nearest periods lie alike around every
period, so the five sums of a weighted line are convolutions with fixed weight
vectors.  Long vectors go through a Fourier transform: a block of n periods
costs O(n log n) whatever the span.  The q periods at each end of a series
share one window and get their own weights.
"""

from __future__ import annotations

import numpy as np

#: Longest weight vector that is convolved term by term.
DIRECT = 64
#: Numbers in one matrix of explicit weights.
CELLS = 1 << 20


def sliding(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """sum_j kernel[j] * x[i + j] for every i at which the kernel fits."""
    if len(kernel) <= DIRECT:
        return np.correlate(x, kernel, "valid")
    size = 1 << int(len(x) + len(kernel) - 1).bit_length()
    both = np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(kernel[::-1], size), size)
    return both[len(kernel) - 1:len(x)]


def tricube(r: np.ndarray) -> np.ndarray:
    return np.where(r > 0.999, 0.0, np.where(r <= 0.001, 1.0, (1.0 - np.minimum(r, 1.0) ** 3) ** 3))


def line_at_zero(s0, s1, s2, t0, t1, unit) -> np.ndarray:
    """Value at distance 0 of weighted lines, from sums over distances in units of ``unit``."""
    det = s0 * s2 - s1 * s1
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(det * unit * unit > 1e-6 * s0 * s0, (s2 * t0 - s1 * t1) / det, np.where(s0 > 0, t0 / s0, np.nan))


def padded(x: np.ndarray, start: int, first: int, last: int) -> np.ndarray:
    """Positions first..last of an array that begins at ``start``; 0 outside."""
    out = np.zeros(last - first + 1)
    a, b = max(first, start), min(last, start + len(x) - 1)
    if a <= b:
        out[a - first:b - first + 1] = x[a - start:b - start + 1]
    return out


def _explicit(v, w, start, at, left, right, reach) -> np.ndarray:
    """Lines at the positions ``at``, each with its own window and reach."""
    out = np.empty(len(at))
    width = int((right - left).max()) + 1 if len(at) else 1
    step = max(1, CELLS // width)
    for i in range(0, len(at), step):
        x, l, r, h = (a[i:i + step, None] for a in (at, left, right, np.maximum(reach, 1e-9)))
        pos = l + np.arange(width)
        seen = (pos <= r) & (pos >= start) & (pos < start + len(v))
        idx = np.clip(pos - start, 0, len(v) - 1)
        d = (pos - x) / h
        k = np.where(seen, w[idx] * tricube(np.abs(d)), 0.0)
        kv = k * v[idx]
        out[i:i + step] = line_at_zero(k.sum(1), (k * d).sum(1), (k * d * d).sum(1), kv.sum(1), (kv * d).sum(1), h[:, 0])
    return out


def local_lines(v: np.ndarray, w: np.ndarray, start: int, lo: int, hi: int, q: int, first: int, last: int) -> np.ndarray:
    """Local linear values at the positions first..last.

    ``v`` and weights ``w`` lie at start, start + 1, ...; the whole series spans
    lo..hi, of which the arrays may be a part.  The q nearest positions of lo..hi
    count, with tricube weights times ``w``; a value that is not finite weighs
    nothing.  NaN where no weight is left.
    """
    at = np.arange(first, last + 1)
    if not len(at):
        return np.empty(0)
    known = np.isfinite(v)
    w = np.where(known, w, 0.0)
    total = w.sum()
    level = float((w * np.where(known, v, 0.0)).sum() / total) if total > 0 else 0.0
    v = np.where(known, v - level, 0.0)
    n, half = hi - lo + 1, q // 2
    if n <= q:
        left, right = np.full(len(at), lo), np.full(len(at), hi)
        own = np.ones(len(at), bool)
    else:
        left = np.clip(at - half, lo, hi - q + 1)
        right = left + q - 1
        own = left != at - half
    reach = np.maximum(at - left, right - at) + max((q - n) // 2, 0)
    out = np.empty(len(at))
    inner = np.flatnonzero(~own)
    if len(inner):  # one run of positions
        a, b = int(at[inner[0]]), int(at[inner[-1]])
        off = np.arange(-half, q - half)
        unit = float(max(half, q - 1 - half, 1e-9))
        k = tricube(np.abs(off) / unit)
        d = off / unit
        ww = padded(w, start, a - half, b + q - 1 - half)
        wv = padded(w * v, start, a - half, b + q - 1 - half)
        s0, s1, s2 = sliding(ww, k), sliding(ww, k * d), sliding(ww, k * d * d)
        out[inner] = line_at_zero(s0, s1, s2, sliding(wv, k), sliding(wv, k * d), unit)
        # hardly any weight left: rounding of the transform would count
        own[inner[s0 < 1e-4 * k.sum()]] = True
    idx = np.flatnonzero(own)
    if len(idx):
        out[idx] = _explicit(v, w, start, at[idx], left[idx], right[idx], reach[idx])
    return out + level


def box_weights(m: int) -> np.ndarray:
    """Moving averages of m, m and 3 periods in one vector."""
    return np.convolve(np.convolve(np.full(m, 1.0 / m), np.full(m, 1.0 / m)), np.full(3, 1.0 / 3))


def stl_block(a: int, y, w, trend, lo: int, hi: int, m: int, s_window: int | None, l_window: int, t_window: int, means=None):
    """One inner pass over consecutive periods a, a + 1, ...: new season and trend.

    ``s_window`` is None for a constant season, whose value at each period is ``means``.
    """
    b = a + len(y) - 1
    # smoothed cycles reach one cycle beyond both ends of the series
    e0, e1 = (lo - m if a == lo else a), (hi + m if b == hi else b)
    cycle = np.full(e1 - e0 + 1, np.nan)
    detrended = y - trend
    for p in range(min(m, e1 - e0 + 1)):
        here = (p - a) % m  # first period of this position in view
        if here >= len(y):
            continue
        to = (p - e0) % m
        if s_window is None:
            cycle[to::m] = means[here]
            continue
        t0 = a + here
        phase = t0 % m
        c0 = (t0 - phase) // m
        first = (e0 + to - phase) // m
        last = first + (e1 - e0 - to) // m
        cycle[to::m] = local_lines(detrended[here::m], w[here::m], c0, -((phase - lo) // m), (hi - phase) // m, s_window, first, last)
    low = np.full(len(y), np.nan)
    gone = ~np.isfinite(cycle)
    if len(cycle) > 2 * m:
        flat = sliding(np.where(gone, 0.0, cycle), box_weights(m))
        if gone.any():
            flat[sliding(gone.astype(float), np.ones(2 * m + 1)) > 0.5] = np.nan
        low[e0 + m - a:e1 - m - a + 1] = flat
    season = cycle[a - e0:a - e0 + len(y)] - local_lines(low, np.ones(len(y)), a, lo, hi, l_window, a, b)
    return season, local_lines(y - season, w, a, lo, hi, t_window, a, b)
