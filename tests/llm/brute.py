"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

ASCII_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = spaced_words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if spaced_words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)
    }
    n, repeat = len(words), len(covered)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, dup, repeat, n < 10 or 100 * repeat > 20 * n


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def decontaminate(text, items):
    """n_words, n_hit, n_items, items_sha256, contaminated; items are (id, text)."""
    words, hit, seen = bench_words(text), set(), set()
    for item, item_text in items:
        own = bench_words(item_text)
        for s in range(max(1, len(own) - 9) if own else 0):
            window = own[s : s + 10]
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    if item is not None:
                        seen.add(str(item))
    digest = hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest()
    return len(words), len(hit), len(seen), digest, bool(hit)


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base_secrets(text):
    """n_assign, n_access, n_hex, base_sha256."""
    text = text or ""
    kinds = [
        [m.span() for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6],
        [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
        [m.span() for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24],
    ]
    names = ("assign", "access", "hex")
    spans = sorted((s, k, e) for k, found in enumerate(kinds) for s, e in found)
    joined = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
    return *map(len, kinds), hashlib.sha256(joined.encode()).hexdigest()


def fold(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def lower_words(text):
    return spaced_words((text or "").translate(ASCII_LOWER))


def base_lm(rows):
    """doc_id -> (n_tokens, n_known, train_tokens, base_score); rows are (id, text)."""
    docs = [(i, [*lower_words(t), None]) for i, t in rows]
    c = Counter(w for i, ws in docs if fold(i, 10) for w in ws)
    total, types = sum(c.values()), len(c)
    return {
        i: (
            len(ws),
            sum(c[w] > 0 for w in ws),
            total,
            float(sum(np.log10((c[w] + 0.1) / (total + 0.1 * (types + 1))) for w in ws)),
        )
        for i, ws in docs
    }


def simhash(text):
    words = lower_words(text)
    if not words:
        return 0
    shingles = [words[i : i + 4] for i in range(len(words) - 3)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, most=4):
    """The smallest place reachable from each place over links of at most ``most`` bits."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    array = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= most):
            a, b = sorted((root(i), root(int(j))))
            label[b] = a
    return [root(i) for i in range(len(prints))]
