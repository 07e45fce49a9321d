"""Plain versions of the operators over lists of rows, by the wording of their contracts."""

from __future__ import annotations

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: word.findall((t or "").translate(LOWER))
    windows = collections.defaultdict(lambda: collections.defaultdict(set))
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[n][tuple(w[s : s + n])].add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n, table in windows.items():
            for s in range(len(w) - n + 1):
                if owners := table.get(tuple(w[s : s + n])):
                    hit.update(range(s, s + n))
                    found |= owners
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def quality_measures(docs):
    out = []
    for d, t in docs:
        t = t or ""
        w = BLANK_WORD.findall(t)
        threes = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        count = collections.Counter(threes)
        covered = {i + j for i, g in enumerate(threes) if count[g] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if BLANK_WORD.search(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out.append((d, len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed))
    return out


def token_files(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def near_duplicates(docs, width):
    sets = {}
    for d, t in docs:
        w = BLANK_WORD.findall((t or "").translate(LOWER))
        sets[d] = frozenset([tuple(w)] if 0 < len(w) < width else [tuple(w[i : i + width]) for i in range(len(w) - width + 1)])
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [(d, len(sets[d]), root(d), root(d) == d) for d in ids]


def encodings(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for d, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        out.append((d, len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    return out


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _valid(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def _digest(spans) -> str:
    return sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)))


def personal_data(docs):
    out = []
    for d, t in docs:
        spans = [(m.start(), i, k, m.end()) for i, (k, r) in enumerate(PII) for m in re.finditer(r, t or "") if _valid(k, m[0])]
        count = collections.Counter(s[2] for s in spans)
        out.append((d, *(count[k] for k, _ in PII), _digest(spans)))
    return out


def secrets(docs):
    assign = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = []
    for d, t in docs:
        t = t or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        count = collections.Counter(s[2] for s in spans)
        out.append((d, count["assign"], count["access"], count["hex"], _digest(spans)))
    return out


def archives(pages):
    first = {}
    for i, h in pages:
        first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, h in pages:
        data, own = (h or "").encode(), first[h or ""] == i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if own else "revisit", None if own else first[h or ""]))
    return out
