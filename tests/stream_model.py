"""Reference model of append-mode windowed counting with a watermark.

Batch n evicts with W_n = max(W_{n-1}, M - delay), M = max event time of all
batches before n; a row of batch n is dropped iff its window ends at or before
W_{n-1}; windows ending at or before W_n are emitted after batch n. A final
no-data batch runs when the watermark would move.
"""

from __future__ import annotations

from collections import defaultdict


def run_model(batches, size, delay, w_start=0, m_start=None):
    """batches: list of lists of (t_seconds, repo, type). Returns (emitted, W, M)
    where emitted is a list of (window_start, repo, count, sorted types)."""
    state = defaultdict(lambda: [0, set()])
    out = []
    w_late, m = w_start, m_start

    def emit(bound):
        for key in sorted(state, key=lambda k: (k[0], str(k[1]))):
            if key[0] + size <= bound:
                cnt, types = state.pop(key)
                out.append((key[0], key[1], cnt, tuple(sorted(types))))

    for rows in batches:
        w_cur = max(w_late, m - delay) if m is not None else w_late
        for t, repo, typ in rows:
            ws = t - t % size
            if ws + size <= w_late:
                continue
            s = state[(ws, repo)]
            s[0] += 1
            if typ is not None:
                s[1].add(typ)
        emit(w_cur)
        if rows:
            bm = max(t for t, _, _ in rows)
            m = bm if m is None else max(m, bm)
        w_late = w_cur
    if m is not None and m - delay > w_late:
        w_late = m - delay
        emit(w_late)
    return out, w_late, m
