"""Brute-force versions that the tests compare with: plain Python over whole rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return WORD.findall((text or "").encode().lower())


def contamination(docs, benchmark, window=13):
    """{row number: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)}"""
    phrases = {}
    for item, text in benchmark:
        w = item_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            phrases.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(p) for p in phrases}
    out = []
    for doc, text in docs:
        w = item_words(text)
        hit, items = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = phrases.get(tuple(w[i : i + n]))
                if found:
                    items |= found
                    hit.update(range(i, i + n))
        names = ",".join(sorted(str(x) for x in items if x is not None))
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def base_counts(text):
    """The contract's base counts and base_failed, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    n, r = len(words), len(inside)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, r, n < 10 or 100 * r > 20 * n


def repeated_bytes(docs, length=50):
    """The contract's removal: {doc_id: (n_bytes, n_removed, n_spans, kept_sha256)} for docs with distinct ids."""
    first = {}
    for doc, text in sorted(docs):
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], doc)
    out = {}
    for doc, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 0.0
