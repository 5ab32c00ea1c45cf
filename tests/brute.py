"""Plain sequential implementations of the bin rules, used as test oracles."""
import math

import numpy as np


def bins_1d(sizes, n):
    sizes = sorted(sizes)
    share = sum(sizes) / n
    out, tot = [], 0.0
    for s in sizes:
        if tot > share:
            out.append(s)
            tot = 0.0
        tot += s
    return out


def bins_2d(durs, toks, n, m, thr=4.0, legacy=False):
    pairs = sorted(zip(durs, toks))
    d = np.array([p[0] for p in pairs], dtype=float)
    t = np.array([p[1] for p in pairs], dtype=float)
    share = d.sum() / n
    bins, caps = [], []
    start, tot = 0, 0.0

    def sub(lo, hi, maxdur):
        tt, dd = t[lo:hi], d[lo:hi]
        tps = tt / dd
        sd = tps.std()
        keep = np.ones(len(tps), bool) if sd == 0 else (tps - tps.mean()) / sd <= thr
        tk, dk = tt[keep], dd[keep]
        cap = (tk / dk).max()
        order = sorted(zip(tk, dk))
        sh = tk.sum() / m
        acc = 0
        for x, _ in order:
            if acc > sh:
                bins.append((maxdur, int(x)))
                caps.append(cap)
                acc = 0
            acc += x
        bins.append((maxdur, int(order[-1][0])))
        caps.append(cap)

    for i, s in enumerate(d):
        if tot > share:
            sub(start, i, s)
            start = i
            tot = 0.0
        tot += s
    sub(start, len(d) - 1 if legacy else len(d), d[-1])
    return bins, caps


def edit_distance(s, t):
    if not s:
        return len(t)
    if not t:
        return len(s)
    prev = list(range(len(t) + 1))
    for i in range(1, len(s) + 1):
        cur = [i] + [0] * len(t)
        for j in range(1, len(t) + 1):
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (s[i - 1] != t[j - 1]))
        prev = cur
    return prev[-1]
