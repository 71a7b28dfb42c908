"""Plain versions of the operators on documents, over lists of (id, text); an id may be None."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SPACE = b" \t\n\x0b\x0c\r"


def order(doc_id):
    return (1 << 63) - 1 if doc_id is None else doc_id


def words(text) -> list[bytes]:
    return WORD.findall((text or "").encode())


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lines(docs, least_chars=20, least_docs=3):
    """id, lines before, lines dropped, text left."""
    keys = lambda text: [x.strip(SPACE).lower() for x in (text or "").encode().split(b"\n")]
    holders = defaultdict(list)
    for doc_id, text in docs:
        for key in set(keys(text)):
            if len(key.decode()) >= least_chars:
                holders[key].append(-1 if doc_id is None else doc_id)
    out = []
    for doc_id, text in docs:
        own = (text or "").encode().split(b"\n")
        kept = [x for x, k in zip(own, keys(text)) if len(holders.get(k, ())) < least_docs or max(holders[k]) == doc_id]
        out.append((doc_id, len(own), len(own) - len(kept), b"\n".join(kept).decode()))
    return out


def passages(docs, size=50):
    """id, words, words removed, words left."""
    first = {}
    for doc_id, text in docs:
        own = words(text)
        for i in range(len(own) - size + 1):
            key = tuple(own[i : i + size])
            first[key] = min(order(doc_id), first.get(key, order(doc_id)))
    out = []
    for doc_id, text in docs:
        own = words(text)
        gone = set()
        for i in range(len(own) - size + 1):
            if first[tuple(own[i : i + size])] < order(doc_id):
                gone.update(range(i, i + size))
        out.append((doc_id, len(own), len(gone), " ".join(w.decode() for i, w in enumerate(own) if i not in gone)))
    return out


def shingle_set(text, size=5):
    own = [w.lower() for w in words(text)]
    if not own:
        return set()
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))}


def groups(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    return [find(i) for i in range(n)]


def near(docs, percent=85):
    """id, set size, smallest id of the component, kept."""
    sets = [shingle_set(t) for _, t in docs]
    alike = lambda i, j: (
        bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    )
    root = groups(len(docs), alike)
    least = {r: min(order(d) for (d, _), q in zip(docs, root) if q == r) for r in set(root)}
    out = []
    for (doc_id, _), own, r in zip(docs, sets, root):
        smallest = None if least[r] == order(None) else least[r]
        out.append((doc_id, len(own), smallest, order(doc_id) == least[r]))
    return out


def statistics(text):
    own = words(text)
    decoded = (text or "")
    full = [x for x in decoded.split("\n") if words(x)]
    places = defaultdict(list)
    for i in range(len(own) - 7):
        places[tuple(own[i : i + 8])].append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
    n = len(own)
    base = (n, sum(len(w.decode()) for w in own), len(re.findall(r"[#*$%&|<>]", decoded)), len(full) - len(set(full)), len(covered))
    return (*base, n < 20 or 100 * len(covered) > 30 * n)


# Outliers: the whole verdict with numpy, group by group ---------------------------


def upto_share(values, share, number):
    """Largest value of the class up to which the share of values lies."""
    order = sorted((math.floor(number(v)), v) for v in values)
    wanted = order[math.ceil(share * len(order) - 1e-9) - 1][0]
    return max(v for c, v in order if c == wanted)


def distances(x, centre, cov):
    d = x - centre
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


def least_determinant(x, q):
    """Centre and covariance of a group's vectors: all starts to their ends, the least determinant, then reweighted.

    ``q``: the module with the constants.
    """
    floor = np.diag(np.array(list(q.PARTS.values())) ** 2)
    at = lambda v, s: upto_share(v, s, lambda y: y / q.CLASS)
    middle = np.array([at(v, 0.5) for v in x.T])
    spread = np.array([(at(v, 0.84) - at(v, 0.16)) / 2 for v in x.T])
    z = (x - middle) / np.sqrt(spread**2 + np.diag(floor))
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    ends = []
    for number, y in enumerate((None, np.tanh(z), np.divide(z, norm, out=np.zeros_like(z), where=norm > 0))):
        corr = np.eye(4)
        if y is not None:
            c = np.cov(y.T, bias=True)
            root = np.sqrt(np.outer(np.diag(c), np.diag(c)))
            corr = np.divide(c, root, out=np.zeros_like(c), where=root > 0)
            np.fill_diagonal(corr, 1)
        centre, cov = middle, corr * np.outer(spread, spread)
        least, steps = math.inf, 0
        for step in range(1, q.MOST_STEPS + 1):
            d2 = distances(x, centre, cov + floor)
            near = x[d2 <= upto_share(d2, q.SHARE, lambda y: math.log2(max(y, 1e-12)) * 64)]
            new = near.mean(0), q.CONSISTENCY * np.cov(near.T, bias=True)
            det = np.linalg.slogdet(new[1] + floor)[1]
            if step > 1 and not det < least - 1e-9:
                break
            (centre, cov), least, steps = new, det, step
        ends.append((least, number, centre, cov, steps))
    _, _, centre, cov, _ = min(ends, key=lambda e: e[:2])
    near = x[distances(x, centre, cov + floor) <= q.REWEIGHT]
    if len(near):
        return near.mean(0), np.cov(near.T, bias=True), len(near), ends
    return centre, cov, round(q.SHARE * len(x)), ends


def verdicts(docs, q):
    """docs: id, text, language, source. Squared distance and verdict of each that passes the base limits."""
    rows = [(i, statistics(t), (lang, source)) for i, t, lang, source in docs]
    good = [(i, np.array(s[:5], dtype=float), cell) for i, s, cell in rows if not s[5]]
    log_length = lambda s: math.log(max(s[1], 1) / s[0])
    middle = lambda own: upto_share([log_length(s) for _, s, _ in own], 0.5, lambda y: y / q.CLASS)
    found = {}
    for lang in {cell[0] for _, _, cell in good}:
        whole = [r for r in good if r[2][0] == lang]
        cells = {cell: [r for r in whole if r[2] == cell] for _, _, cell in whole}
        wide = middle(whole)

        def vectors(own, centre):
            out = []
            for _, s, _ in own:
                n, shrink = s[0], math.sqrt(s[0] / (s[0] + 60))
                out.append(((log_length(s) - centre) * shrink, math.log1p(s[2] / n), math.log1p(s[3] * 10 / n) * shrink, s[4] / n))
            return np.array(out)

        m, c, n, _ = least_determinant(vectors(whole, wide), q)
        for own in cells.values():
            centre = (len(own) * middle(own) + q.PRIOR_ROWS * wide) / (len(own) + q.PRIOR_ROWS)
            x = vectors(own, centre)
            own_m, own_c, own_n, _ = least_determinant(x, q)
            share = own_n / (own_n + q.PRIOR_ROWS)
            theirs = m + np.array([wide - centre, 0, 0, 0])
            d2 = distances(x, share * own_m + (1 - share) * theirs, share * own_c + (1 - share) * c + np.diag(np.array(list(q.PARTS.values())) ** 2))
            for (i, _, _), d in zip(own, d2, strict=True):
                half = max(n - 4, 0) / 2
                y = 1 / (1 + d * n / max(n * n - 1, 1))
                kept = half * math.log(y) + math.log1p(half * (1 - y)) >= math.log1p(q.CUT / 2) - q.CUT / 2
                found[i] = d, kept
    return found
