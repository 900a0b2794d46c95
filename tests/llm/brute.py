"""Plain Python versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash
from tokenizers import Tokenizer

from tickwise.llm.queries import TOKENIZER

UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(UPPER)


class Sets:
    """Union-find that keeps the smallest member as the root."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows):
    """(doc_id, fingerprint, component_id) of each (doc_id, text)."""
    prints = [fingerprint(t) for _, t in rows]
    sets = Sets(range(len(rows)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                sets.join(i, j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[sets.root(i)].append(d)
    return [(d, f"{prints[i]:016x}", min(low[sets.root(i)], default=None)) for i, (d, _) in enumerate(rows)]


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(rows, items):
    """(doc_id, n_words, n_hit, item ids) of each (doc_id, text)."""
    windows = defaultdict(set)
    for item, text in items:
        words = benchmark_words(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i:i + 10])].add("" if item is None else str(item))
    out, sizes = [], {len(w) for w in windows}
    for d, text in rows:
        words, hit, found = benchmark_words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[w]
        out.append((d, len(words), len(hit), sorted(found)))
    return out


def visible(line):
    return any(ord(c) > 32 for c in line)


def dedup_lines(rows, chars=7, similarity=0.8):
    """The text of each (key, text) without its dropped lines; rows in key order."""
    first = {}
    for k, (_, text) in enumerate(rows):
        for at, line in enumerate((text or "").split("\n")):
            if visible(line):
                first.setdefault(line, (k, at))
    lines = list(first)
    shingles = [set(x[i:i + chars] for i in range(max(1, len(x) - chars + 1))) for x in lines]
    holders = defaultdict(list)
    sets = Sets(range(len(lines)))
    for n, own in enumerate(shingles):
        for m, k in Counter(m for s in own for m in holders[s]).items():
            if k >= similarity * (len(own) + len(shingles[m]) - k):
                sets.join(n, m)
        for s in own:
            holders[s].append(n)
    keep = {}
    for n, line in enumerate(lines):
        root = sets.root(n)
        keep[root] = min(keep.get(root, first[line]), first[line])
    place = {line: keep[sets.root(n)] for n, line in enumerate(lines)}
    return [None if text is None else "\n".join(
        x for at, x in enumerate(text.split("\n")) if not visible(x) or place[x] == (k, at))
        for k, (_, text) in enumerate(rows)]


def library():
    t = Tokenizer.from_file(TOKENIZER)
    t.no_padding()
    t.no_truncation()
    return t


def bpe(rows):
    """(doc_id, n_tokens, digests) of each (doc_id, text) by the tokenizers library."""
    t, out = library(), []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((d, len(ids), hashlib.sha256(raw).hexdigest(),
                    hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


def rebuilt(rows):
    """conv -> [(role, text)] of each (conv, turn, role, text): openings shared within a hundred ids."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    return out


def trie(convs):
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, ends) of every node of conv -> turns."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k)).encode()).hexdigest())
                  for k, m in members.items())


def filter_audit(docs, labels):
    """Every row of the audit, from (doc_id, text, lang) and (doc_id, quality, toxic)."""
    first, flags = {}, []
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        flags.append((part or "", {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and first[t] < d},
            any(x == d and q == 1 for x, q, _ in labels if d is not None),
            any(x == d and v == 1 for x, _, v in labels if d is not None)))
    out = []
    for part in {p for p, *_ in flags}:
        rows, total, one = [f for f in flags if f[0] == part], Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order):
                fails = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                total[x] += len(fails)
                one.append((part, "".join(order), step + 1, len(left), len(fails),
                            sum(r[1][x] for r in rows) - len(fails),
                            sum(r[1][x] and sum(r[1].values()) == 1 for r in rows),
                            sum(r[2] for r in fails), sum(r[3] for r in fails)))
        out += [(*r, total[r[1][r[2] - 1]]) for r in one]
    return sorted(out)
