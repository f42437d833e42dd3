"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(nodes, links):
    """Smallest node that each node reaches."""
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def fingerprint(text, words=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = WORD.findall(lower)
    parts = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def repeats(rows, width=50):
    """Per row of (id, text): bytes, removed, spans and what is left, in the order of the rows."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        if doc_id is not None:
            for i in range(len(data) - width + 1):
                s = data[i : i + width]
                first[s] = min(first.get(s, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        lost = bytearray(len(data))
        if doc_id is not None:
            for i in range(len(data) - width + 1):
                if first[data[i : i + width]] < doc_id:
                    lost[i : i + width] = b"\1" * width
        rest = bytes(c for c, gone in zip(data, lost) if not gone)
        spans = sum(1 for i, gone in enumerate(lost) if gone and (i == 0 or not lost[i - 1]))
        out.append((doc_id, len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out


def vector_links(rows, cosine=0.98):
    """Links and smallest reachable id per row of (id, vector, label)."""
    good = {}
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None for x in vector):
            continue
        v = np.asarray(vector, np.float64)
        if len(v) and np.isfinite(v).all() and v.any():
            v = v / np.abs(v).max()
            good[vec_id] = (v / np.sqrt(v @ v), label)
    links = [
        (a, b) for a in good for b in good
        if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] >= cosine
    ]
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    top = roots([r[0] for r in rows], links)
    return {r[0]: (count[r[0]], top[r[0]]) for r in rows}


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def mix_targets(sizes, share=1.5, most=2):
    """Targets of sources (name or None -> size), sharing the excess again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(sizes, 0.0)
    left, open_ = share * sum(sizes.values()), {s for s in sizes if sizes[s]}
    while left > 1e-9 and open_:
        total, excess = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += left * weight[s] / total
            if target[s] >= most * sizes[s]:
                excess += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
        left = excess
    return target
