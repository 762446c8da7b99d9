"""Plain versions of the operators that SQL can't express, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

from tidewater.llm import license_scan


def near_duplicates(rows):
    """{doc_id: (n_shingles, component_id, kept)} from all pairs that share a shingle."""
    sets, parent = {}, {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))) if words else frozenset()

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, shingles in sets.items():
        for j, both in Counter(j for s in shingles for j in holders[s]).items():
            if 100 * both >= 75 * (len(shingles) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in shingles:
            holders[s].append(i)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def without_repeats(rows, length=100):
    """[(doc_id, n_bytes, n_removed, n_spans, kept_sha256)] by a set of all strings met so far."""
    met, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in met:
                gone[k : k + length] = b"\1" * length
            met.add(window)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def licenses(text):
    """(n_words, n_base, first_word, last_word, base_labels, labels, score), every rule tried on the whole text."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text) if w]
    base = sorted((i, label) for p, label in license_scan.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    found = set()
    if re.search(license_scan.GATE, text):
        norm = f" {' '.join(words)} "
        for rule in license_scan.rules():
            if rule.keyword in norm:
                found |= {(m.start(), -m.end(), rule.priority, rule.label) for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", norm)}
    left = [d for d in found if not any(o < d and o[0] <= d[0] and o[1] <= d[1] and o[2] <= d[2] for o in found)]
    labels = {label for _, label in base} | {d[3] for d in left}
    level = 0 if base else min((d[2] for d in left), default=None)
    score = 0.0 if level is None else license_scan.STRENGTHS[level]
    first, last = (base[0][0], base[-1][0]) if base else (None, None)
    return len(words), len(base), first, last, ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), score


def repeated_words(words):
    """How many words lie in three-word windows that are found twice or more."""
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    return len({p for i, w in enumerate(windows) if counts[w] > 1 for p in (i, i + 1, i + 2)})


def shards(rows, shards=16, bundles=4096):
    """{doc_id: (size, text_crc32, shard)} by packing groups and bundles one after the other; no group may exceed a shard."""
    loads, digests = defaultdict(lambda: [0, 0, 0]), {}
    for i, text in rows:
        data = (text or "").encode()
        digests[i] = hashlib.sha256(data).hexdigest().upper()
        for k, n in enumerate((len(data) + 1, len(data.split()), 1)):
            loads[digests[i]][k] += n
    whole = [sum(load[k] for load in loads.values()) for k in range(3)]
    name, units = {}, defaultdict(lambda: [0, 0, 0])
    for digest, load in loads.items():
        shares = [Fraction(n, w) if w else 0 for n, w in zip(load, whole)]
        assert max(shares) <= Fraction(1, shards)
        name[digest] = f"{digest}:0" if max(shares) > Fraction(1, bundles) else str(int(digest[:8], 16) % bundles)
        for k, n in enumerate(load):
            units[name[digest]][k] += n
    parts = {u: [n * 2**30 // w if w else 0 for n, w in zip(load, whole)] for u, load in units.items()}
    left, found = [[2**30 // shards] * 3 for _ in range(shards)], {}
    for u in sorted(parts, key=lambda u: (-max(parts[u]), u)):
        part = parts[u]
        everywhere = range(shards)
        whole_fit = [s for s in everywhere if all(a >= b for a, b in zip(left[s], part))]
        among = whole_fit or [s for s in everywhere if left[s][0] >= part[0]]
        if among:
            found[u] = max(among, key=lambda s: (sum(a * b for a, b in zip(left[s], part)), -s))
        else:
            found[u] = max(everywhere, key=lambda s: (left[s][0], -s))
        left[found[u]] = [a - b for a, b in zip(left[found[u]], part)]
    return {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), found[name[digests[i]]]) for i, t in rows}
