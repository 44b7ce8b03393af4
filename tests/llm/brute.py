"""Plain restatements of the operators, for small tables only."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def roots(nodes, near) -> dict:
    """Smallest node reachable over pairs for which near holds."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    nodes = sorted(nodes)
    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if near(a, b):
                low, high = sorted((top(a), top(b)))
                up[high] = low
    return {n: top(n) for n in nodes}


def simhash(text: str | None, words: int = 3) -> int:
    tokens = WORD.findall((text or "").translate(LOWER))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[k : k + words]) for k in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows) -> dict:
    """{doc_id: (hex fingerprint, component)} of (doc_id, text) rows with distinct ids."""
    prints = {d: simhash(t) for d, t in rows}
    found = roots(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    return {d: (f"{prints[d]:016x}", found[d]) for d in prints}


def repeats(rows, width: int = 13) -> list:
    """(doc_id, n_words, n_removed, sha256 of the kept words) of every row."""
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for k in range(len(w) - width + 1 if d is not None else 0):
            window = tuple(w[k : k + width])
            first[window] = min(d, first.get(window, d))
    out = []
    for d, w in words:
        gone = set()
        for k in range(len(w) - width + 1 if d is not None else 0):
            if first[tuple(w[k : k + width])] < d:
                gone.update(range(k, k + width))
        out.append((str(d), len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out)


def token_rows(rows, tokenizer, end: int = 2) -> dict:
    """{doc_id: (start, n_tokens, crc32)} by encoding every text on its own."""
    out, start = {}, 0
    for d, text in sorted(rows):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        out[d] = (start, len(ids), zlib.crc32(b"".join(k.to_bytes(4, "little") for k in ids)))
        start += len(ids)
    return out


def best_path(text: str, table: dict, byte_ids, byte_score: float) -> list[int]:
    """Ids of the best-scoring pieces of a text, over a plain dictionary of pieces."""
    data = (" " + text).encode()
    best, back = [0.0] + [float("-inf")] * len(data), [None] * (len(data) + 1)
    for end in range(1, len(data) + 1):
        for size in range(min(end, 64), 0, -1):
            hit = table.get(data[end - size : end])
            if hit and best[end - size] + hit[1] > best[end]:
                best[end], back[end] = best[end - size] + hit[1], (size, hit[0])
        if best[end - 1] + byte_score > best[end]:
            best[end], back[end] = best[end - 1] + byte_score, (1, int(byte_ids[data[end - 1]]))
    ids, at = [], len(data)
    while at:
        ids.append(back[at][1])
        at -= back[at][0]
    return ids[::-1]


def byte_repeats(rows, width: int = 50) -> list:
    """(doc_id, bytes, spans that go, bytes kept) of (doc_id, text) rows."""
    data = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in data:
        for k in range(len(b) - width + 1 if d is not None else 0):
            window = b[k : k + width]
            first[window] = min(d, first.get(window, d))
    out = []
    for d, b in data:
        goes = bytearray(len(b))
        for k in range(len(b) - width + 1 if d is not None else 0):
            if first[b[k : k + width]] < d:
                goes[k : k + width] = b"\1" * width
        edges = [k for k in range(len(b) + 1) if (goes[k - 1] if k else 0) != (goes[k] if k < len(b) else 0)]
        spans = tuple((x, y - x) for x, y in zip(edges[::2], edges[1::2]))
        out.append((str(d), len(b), spans, bytes(c for c, g in zip(b, goes) if not g)))
    return sorted(out)


WRAP = (1 << 64) - 1
SPREAD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def spread(x: int) -> int:
    x = ((x ^ x >> 30) * SPREAD[1]) & WRAP
    x = ((x ^ x >> 27) * SPREAD[2]) & WRAP
    return x ^ x >> 31


def toss(a: int, b: int) -> int:
    """Twice the lowest bit in which a differs from b, plus a's bit there."""
    low = ((a ^ b) & -(a ^ b)).bit_length() - 1
    return 0 if a == b else 2 * low + (a >> low & 1)


def phrase_names(symbols: list[int]) -> list[int]:
    """Names of the phrases of one text's symbols."""
    heads = []
    for s in symbols:
        if heads and heads[-1][0] == s:
            heads[-1][1] += 1
        else:
            heads.append([s, 1])
    labels = [h for h, _ in heads]
    for _ in range(3):
        labels = [0] + [toss(a, b) for b, a in zip(labels, labels[1:])]
    starts = [k for k in range(len(labels)) if k == 0 or k + 1 < len(labels) and labels[k] > max(labels[k - 1], labels[k + 1])]
    return [
        spread(sum(spread((h + n * SPREAD[0] + k * SPREAD[1]) & WRAP) for k, (h, n) in enumerate(heads[a:b])) & WRAP)
        for a, b in zip(starts, starts[1:] + [len(heads)])
    ]


def phrase_sketch(text: str, shares=(8, 16, 64)) -> list[set]:
    symbols, out = list(text.encode()), []
    for level, most in enumerate(shares):
        symbols = phrase_names(symbols)
        out.append(set(sorted({spread((s + level) & WRAP) >> 34 for s in symbols})[:most]))
    return out


def phrase_likeness(a: list[set], b: list[set], shares=(8, 16, 64)) -> float:
    if not a[0] or not b[0]:
        return float(not a[0] and not b[0])
    both = seen = 0
    for x, y, most in zip(a, b, shares):
        union = sorted(x | y)
        if most in (len(x), len(y)):
            union = union[:most]
        both, seen = both + len(x & y & set(union)), seen + len(union)
    return 2 * both / (both + seen)
