"""Plain Python versions of what the corpus queries must return."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import xxhash


def crc(s) -> int:
    return zlib.crc32(s if isinstance(s, bytes) else str(s).encode())


def simhash(text, shingle=3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words)] if len(words) <= shingle else [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)]
    hs = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


class Union:
    def __init__(self):
        self.p = {}

    def find(self, x):
        self.p.setdefault(x, x)
        while self.p[x] != x:
            self.p[x] = self.p[self.p[x]]
            x = self.p[x]
        return x

    def link(self, a, b):
        self.p[self.find(a)] = self.find(b)


def simhash_components(rows, bits=2, shingle=3):
    """{doc_id: (fingerprint, smallest doc_id reachable)}"""
    fp = [(d, simhash(t, shingle)) for d, t in rows]
    codes = sorted({f for _, f in fp})
    u = Union()
    for i, a in enumerate(codes):
        u.find(a)
        for b in codes[:i]:
            if (a ^ b).bit_count() <= bits:
                u.link(a, b)
    low = {}
    for d, f in fp:
        r = u.find(f)
        low[r] = min(low.get(r, d), d)
    return {d: (f"{f:016x}", low[u.find(f)]) for d, f in fp}


def line_removals(rows, num=4, den=5):
    """{doc_id: removed line numbers}, every pair of lines compared."""
    lines = []
    for d, t in sorted(rows, key=lambda r: r[0]):
        for i, x in enumerate((t or "").lower().split("\n")):
            w = frozenset(x.split())
            if w:
                lines.append(((d, i), w))
    by = defaultdict(list)
    out = defaultdict(list)
    seen = {}
    for k, (at, w) in enumerate(lines):
        gone = w in seen
        if not gone:
            both = Counter(j for x in w for j in by[x])
            gone = any(n * den >= (len(w) + len(lines[j][1]) - n) * num for j, n in both.items())
        if w not in seen:
            seen[w] = at
            for x in w:
                by[x].append(k)
        if gone:
            out[at[0]].append(at[1])
    return dict(out)


def kept_text(text, removed):
    if text is None or not removed:
        return text
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in set(removed))


def sha1_base32(b: bytes) -> str:
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def warc_rows(rows):
    """{page_id: (bytes, digest, type, refers_to)}"""
    top = {}
    for p, html in rows:
        b = (html or "").encode()
        top[b] = max(top.get(b, p), p)
    return {p: (len(b := (html or "").encode()), sha1_base32(b), "response" if top[b] == p else "revisit", None if top[b] == p else top[b]) for p, html in rows}


def minimax(sizes, shards) -> int:
    """Smallest capacity at which greedy filling of the ordered sizes needs
    no more than ``shards``."""
    def fits(cap):
        n, room = 1, cap
        for s in sizes:
            if s > cap:
                return False
            if s > room:
                n, room = n + 1, cap
            room -= s
        return n <= shards
    lo, hi = 0, sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid + 1, hi)
    return lo


WHITE = " \t\n\x0b\x0c\r"


def damaged_turns(rows):
    """(conv_id, turn, role, text) after the damage of the contract."""
    out = []
    for c, t, role, text in rows:
        d = crc(f"{' ' if c is None else c}:{' ' if t is None else t}") % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 1:
            text = ""
        if d == 2:
            text = "".join(x for x in text if x not in ".!?")
        if d == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def cheapest_repair(rows):
    """(cost, audit, lines) for (role, text, fault) in order, all audits of
    every state held: the least (cost, audit) is taken."""
    grammar = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    name = {"u": "user", "a": "assistant"}

    def inserted(at):
        for _ in range(3):          # further inserts only come back
            for s, (cost, audit, lines) in list(at.items()):
                for x in "ua":
                    if x in grammar[s]:
                        got = (cost + 2, audit + "I", lines + [name[x] + ":"])
                        z = grammar[s][x]
                        if z not in at or got < at[z]:
                            at[z] = got
        return at

    at = {"": (0, "", [])}
    for role, text, fault in rows:
        nxt = {}

        def put(s, *v):
            if s not in nxt or v < nxt[s]:
                nxt[s] = v
        for s, (cost, audit, lines) in inserted(at).items():
            put(s, cost + 3, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            if role[:1] in grammar[s]:
                put(grammar[s][role[:1]], cost + extra, audit + "K", lines + [f"{role}:{text}"])
            for x in "ua":
                if x in grammar[s]:
                    put(grammar[s][x], cost + 2 + extra, audit + "R", lines + [f"{name[x]}:{text}"])
        at = nxt
    at = inserted(at)
    return min(at[s] for s in ("", "a") if s in at)


def conversation_rows(rows, every):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)}"""
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role, hashlib.sha256(text.encode()).digest(), text))
    out = {}
    for c in set(every) | set(by):
        seen, told, faults = set(), [], Counter()
        for _, _, role, _, text in sorted(by[c]):
            solid = text.strip(WHITE)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            told.append((role, text, fault))
        turns = [t for has, t, *_ in by[c] if has]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
        cost, audit, lines = cheapest_repair(told)
        out[c] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out
