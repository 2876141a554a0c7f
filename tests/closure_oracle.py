"""Row-by-row closure status in plain Python, written from the method's description."""

import math


def closure_means(rows, stored=None):
    """``rows``: dicts with fcd, mm, q0, q1 in time order; ``stored``: the row before, or None.

    Returns (mean, zeros, low, k) per row.
    """
    mean, k = 0.5, 0.025
    zeros = low = 0
    prev = None
    if stored is not None:
        mean, prev = stored["mean"], stored
    out = []
    for row in rows:
        c, mm = row["fcd"], row["mm"]
        zeros = zeros + 1 if c == 0 else 0
        low = low + 1 if c in (0, 1) else 0
        here = {"zeros": zeros, "low": low, "q0": row["q0"], "q1": row["q1"]}
        if prev is not None and c is not None:
            use_zeros = mm is not None and mm < 3
            cur = zeros if use_zeros else low
            before = prev["zeros"] if use_zeros else prev["low"]
            limit = prev["q0"] if use_zeros else prev["q1"]
            limit = 60 if limit is None else max(limit, 5)
            weighted = lambda p, r, w, x: (p * r + w * x) / (p + w)
            drop = mm is not None and mm - c > 8
            if limit > 54 and cur > limit:
                pass
            elif cur == 0 and before < limit:
                mean = weighted(limit, mean, c, before / (2 * limit))
            elif cur != 0:
                half = cur / (2 * limit)
                mean = weighted(limit, mean, max(1, half**2), max(mean, min(1, half)))
            elif drop:
                mean = weighted(5, mean, 10, 1)
            elif c > 6:
                mean = weighted(5, mean, c, 0)
            if c < 6 and mm is not None and mm - c <= 8:
                span = 0.5 * max(5, prev["q1"] if prev["q1"] is not None else 5)
                if c == 0:
                    k = 0.025
                elif low == 0 and prev["low"] <= span:
                    k = min(10, 2 * k)
                mean *= math.exp(-k * max(0, (span - low) / span))
        out.append((mean, zeros, low, k))
        prev = here
    return out
