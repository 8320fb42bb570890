"""SentencePiece encoding and decoding by sampling without replacement.

The pieces of a vocabulary that a text can be cut into form a lattice; a
segmentation's probability is the product of its pieces' weights, normalised over the
lattice.  ``k`` distinct segmentations are drawn by the Gumbel top-k trick:  each
segmentation has its log probability plus Gumbel noise as key and the k largest keys win.
The search is A-star with an exact bound: the log mass of all ways to go on from a
lattice position (backward sums) says how a subtree's largest key is distributed, so
subtrees are opened best first, and one that is never opened costs one number.

A lattice falls apart at places that no piece spans (before a word's space mark, around
characters that no longer piece holds); equal parts of a batch share one lattice, and
the walks of all texts of a batch go on side by side in numpy.

Random numbers are hashes of (seed, row key, path, part, step): a row's samples do not
depend on its partition or batch.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import id_and_text, sub_batches

SPACE = "▁"
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
#: -log(E) of an exponential drawn from 53 bits is never above this
_NOISE_MOST = 38.0
#: distance from a part's end up to which backward sums are kept as plain numbers
LINEAR = 24
SCHEMA = ("doc_id long, sample int, ids binary, pieces long, log_prob double, perturbed double, log_inclusion double, decoded string")


def _values(cp: np.ndarray) -> np.ndarray:
    return tn.mix((cp.astype(_U) + _U(1)) * _GOLD)


class Vocabulary:
    """Pieces of a SentencePiece model.  ``rank`` scores (BPE models: minus
    the merge's rank) become log weights by Zipf's law, -alpha*ln(1+rank);
    ``log`` scores (unigram models) are log weights times alpha."""

    def __init__(self, path: str, alpha: float = 1.0, scores: str = "rank"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.size = n
        self.bytes = np.full(256, -1, np.int64)
        self.raw: list[bytes] = [b""] * n
        pieces, ids = [], []
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
                self.raw[i] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.raw[i] = p.replace(SPACE, " ").encode()
                pieces.append(p)
                ids.append(i)
        if (self.bytes < 0).any():
            raise ValueError("the model has no pieces for bytes")
        s = np.array([sp.get_score(i) for i in range(n)], float)
        self.weight = alpha * (-np.log1p(np.abs(s)) if scores == "rank" else s)
        self.unknown = float(self.weight[ids].min())       # of a character without piece
        self.longest = max(map(len, pieces))
        self.odds = np.exp(np.concatenate([self.weight, [self.unknown, -np.inf]]))   # of an id; unknown; none (-1)
        cps = [np.frombuffer(p.encode("utf-32-le"), "<u4") for p in pieces]
        ends = np.cumsum([len(c) for c in cps])
        pre = tn.prefix_hash(_values(np.concatenate(cps)))
        keys = tn.span_hash(pre, ends - [len(c) for c in cps], ends)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(ids, np.int32)[order]
        slot = (self.keys >> _U(44)).astype(np.int64)       # keys with equal first 20 bits are neighbours
        self.many = np.bincount(slot, minlength=1 << 20).astype(np.uint8)
        self.at = np.searchsorted(slot, np.arange(1 << 20)).astype(np.int32)
        self.odds_list = self.odds.tolist()
        self.inner = np.zeros(0x110000, bool)               # characters of pieces of two or more
        for c in cps:
            if len(c) > 1:
                self.inner[c] = True
        self.cut_spaces = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece id for each hash, -1 for none."""
        out = np.full(len(h), -1, np.int32)
        slot = (h >> _U(44)).astype(np.int64)
        left = np.flatnonzero(self.many[slot])
        r = 0
        while len(left):
            i = self.at[slot[left]] + r
            hit = self.keys[i] == h[left]
            out[left[hit]] = self.ids[i[hit]]
            r += 1
            left = left[~hit]
            left = left[self.many[slot[left]] > r]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids (one space before the first word, which
        encoding adds, is taken away)."""
        b = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return (b[1:] if b[:1] == b" " else b).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, alpha: float, scores: str) -> Vocabulary:
    return Vocabulary(path, alpha, scores)


class _Lattices:
    """Lattices of all distinct parts of a batch, side by side.  A part of
    n characters has n+1 slots, the last is its end."""

    def __init__(self, vocab: Vocabulary, cp: np.ndarray, starts: np.ndarray, lens: np.ndarray):
        self.vocab = vocab
        n = int(lens.sum() + len(lens))
        self.first = np.concatenate([[0], np.cumsum(lens + 1)])[:-1]
        part = np.repeat(np.arange(len(lens)), lens + 1)
        off = np.arange(n) - self.first[part]
        rem = lens[part] - off
        chars = np.where(rem > 0, cp[np.minimum(starts[part] + off, len(cp) - 1)], 0)
        pre = tn.prefix_hash(_values(chars))
        width = max(1, min(vocab.longest, int(lens.max()) if len(lens) else 1))
        ids = np.full((width, n), -1, np.int32)             # by size, then slot: long runs to work on
        at = np.flatnonzero(rem >= 1)
        for size in range(1, width + 1):
            at = at[rem[at] >= size]
            got = vocab.find(tn.span_hash(pre, at, at + size))
            if size == 1:                                   # a character without piece is written as bytes
                got = np.where(got < 0, vocab.size + chars[at], got)
            ids[size - 1, at] = got
        self.ids = ids.T
        self.end = rem == 0
        self.beta = np.zeros(n)
        cdf = np.full((width, n), 2.0, np.float32)
        order = np.argsort(rem, kind="stable")
        edge = np.concatenate([[0], np.cumsum(np.bincount(rem))])
        mass = np.ones(n)
        for r in range(1, len(edge) - 1):                   # by distance from the end
            a = order[edge[r]:edge[r + 1]]
            w = min(r, width)
            e = [ids[j][a] for j in range(w)]
            if r <= LINEAR:
                p = [vocab.odds[np.minimum(e[j], vocab.size)] * mass[a + j + 1] for j in range(w)]
            else:                                           # long parts: relative to the best way on
                lp = [np.log(vocab.odds[np.minimum(e[j], vocab.size)], where=e[j] >= 0, out=np.full(len(a), -np.inf)) + self.beta[a + j + 1] for j in range(w)]
                most = np.max(lp, axis=0)
                p = [np.exp(x - most) for x in lp]
            total, last = np.zeros(len(a)), np.zeros(len(a), np.int64)
            sums = []
            for j in range(w):
                total = total + p[j]
                sums.append(total)
                last[e[j] >= 0] = j
            scale = 1.0 / total
            for j in range(w - 1):
                cdf[j][a] = np.where(j < last, sums[j] * scale, 2.0)        # the last edge takes what rounding leaves
            if r <= LINEAR:
                mass[a] = total
                self.beta[a] = np.log(total)
            else:
                self.beta[a] = most + np.log(total)
        self.cdf = np.ascontiguousarray(cdf.T)

    def _weight(self, ids: np.ndarray) -> np.ndarray:
        w = self.vocab.weight[np.minimum(ids, self.vocab.size - 1)]
        return np.where(ids >= self.vocab.size, self.vocab.unknown, w)

    def edge_logp(self, node: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Log probability of an edge given its start."""
        return self._weight(self.ids[node, size - 1]) + self.beta[node + size] - self.beta[node]

    def edges(self, node: int) -> tuple[list[int], list[float]]:
        """Sizes and probabilities of the edges of one slot."""
        base, odds, size = float(self.beta[node]), self.vocab.odds_list, self.vocab.size
        ids = self.ids[node].tolist()
        on = self.beta[node + 1:node + 1 + len(ids)].tolist()
        sizes = [j + 1 for j, i in enumerate(ids) if i >= 0]
        return sizes, [min(1.0, odds[min(ids[j - 1], size)] * math.exp(on[j - 1] - base)) for j in sizes]


_MASK = 2**64 - 1


def _chance(seed: int, *numbers: int) -> float:
    """``_uniform`` for plain integers."""
    h = seed
    for x in numbers:
        h = ((h + x * 0x9E3779B97F4A7C15) & _MASK) ^ 0xD1B54A32D192ED03
        h ^= h >> 33
        h = h * 0xFF51AFD7ED558CCD & _MASK
        h ^= h >> 33
        h = h * 0xC4CEB9FE1A85EC53 & _MASK
        h ^= h >> 33
    return ((h >> 11) + 0.5) * 2.0 ** -53


def _uniform(seed, *numbers) -> np.ndarray:
    """Uniform numbers inside (0, 1) from a seed and counters."""
    h = np.atleast_1d(seed)
    for x in numbers:
        h = tn.mix((h + np.atleast_1d(x).astype(_U) * _GOLD) ^ _U(0xD1B54A32D192ED03))
    return ((h >> _U(11)).astype(float) + 0.5) * 2.0 ** -53


def _walk(lat: _Lattices, part: np.ndarray, node: np.ndarray, seed: np.ndarray, path: int, number: np.ndarray):
    """Walks through parts from given nodes to the end of each, by the
    conditional probabilities: (entry, step in it, node, size) by entry, step."""
    live = np.arange(len(part))
    out_e, out_n, out_s = [], [], []
    # a generator of its own for each part: a hashed start, then a linear congruence
    state = tn.mix(tn.mix(seed + _U((path + 1) * int(_GOLD) % 2**64)) + number.astype(_U) * _U(0xA0761D6478BD642F))
    steps = np.zeros(len(part), np.int64)
    flat, wide = lat.cdf.ravel(), lat.cdf.shape[1]
    at = node
    while len(live):
        state = state * _U(6364136223846793005) + _U(1442695040888963407)
        u = (state >> _U(40)).astype(np.float32) * np.float32(2.0 ** -24)
        size = np.ones(len(at), np.int64)
        pend, slot, left = None, at * wide, u
        while True:                                         # short pieces first, on through those that are passed
            go = flat[slot] <= left
            pend = np.flatnonzero(go) if pend is None else pend[go]
            if not len(pend):
                break
            size[pend] += 1
            slot, left = slot[go] + 1, left[go]
        out_e.append(live)
        out_n.append(at)
        out_s.append(size)
        steps[live] += 1
        at = at + size
        go = ~lat.end[at]
        live, at, state = live[go], at[go], state[go]
    first = np.concatenate([[0], np.cumsum(steps)])
    nodes, sizes = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    for t, (e, a, s) in enumerate(zip(out_e, out_n, out_s)):
        nodes[first[e] + t] = a
        sizes[first[e] + t] = s
    return first, nodes, sizes


def _truncated(phi, limit, u):
    """Gumbel noise at ``phi`` given that it is at most ``limit``."""
    return -np.logaddexp(-limit, np.log(-np.log(u)) - phi)


def _branches(heaps, plan, seeds, path, ptr, logp, sizes, need):
    """Push the untaken alternatives of the new steps of all paths: of each
    step the largest key that its alternatives hold.  Only the best ``need`` of a text can ever
    be taken; a path is followed until no further step can be among them.

    plan: (text, first step, log mass before it, key of the path) each; ptr,
    logp, sizes: the new steps of each path."""
    row = np.arange(len(plan))
    step = np.array([p[1] for p in plan])
    phi = np.array([p[2] for p in plan], float)
    top = np.array([p[3] for p in plan], float)
    who = np.array([p[0] for p in plan])
    at, end = ptr[:-1].copy(), ptr[1:]
    best_key = np.full((len(plan), need), -np.inf)
    best_at = np.zeros((len(plan), need), np.int64)
    best_phi = np.zeros((len(plan), need))
    span = 64
    while len(row):
        cols = at[row, None] + np.arange(span)
        there = cols < end[row, None]
        lp = np.where(there, np.minimum(logp[np.minimum(cols, len(logp) - 1)], 0.0), 0.0)
        done = phi[row, None] + np.cumsum(lp, axis=1)
        before = np.concatenate([phi[row, None], done[:, :-1]], axis=1)
        rest = -np.expm1(lp)
        use = there & (rest > 1e-12)
        r, c = np.nonzero(use)
        key = np.full(use.shape, -np.inf)
        u = _uniform(seeds[who[row[r]]], path, 1 << 40, step[row[r]] + cols[r, c] - ptr[row[r]])
        key[r, c] = _truncated(before[r, c] + np.log(rest[r, c]), top[row[r]], u)
        key = np.concatenate([best_key[row], key], axis=1)
        where = np.concatenate([best_at[row], cols], axis=1)
        mass = np.concatenate([best_phi[row], before], axis=1)
        pick = np.argpartition(-key, need - 1, axis=1)[:, :need]
        best_key[row], best_at[row], best_phi[row] = (np.take_along_axis(x, pick, axis=1) for x in (key, where, mass))
        phi[row] = done[:, -1]
        at[row] += span
        row = row[(at[row] < end[row]) & (phi[row] + _NOISE_MOST >= best_key[row].min(axis=1))]
        span = min(span * 2, 4096)
    for (d, first, _, _), a, keys, where, mass in zip(plan, ptr.tolist(), best_key.tolist(), best_at.tolist(), best_phi.tolist()):
        for v, i, f in zip(keys, where, mass):
            if v > -math.inf:
                heapq.heappush(heaps[d], (-v, path, first + i - a, f, (int(sizes[i]),)))


def sample_batch(vocab: Vocabulary, texts: Sequence[str], keys: Sequence[int], k: int, seed: int = 0) -> list[list[tuple]]:
    """For each text its samples, best key first: (ids, log probability,
    key, log inclusion probability)."""
    marked = [np.frombuffer((SPACE + t.replace(" ", SPACE)).encode("utf-32-le", "surrogatepass") if t else b"", "<u4") for t in texts]
    doc_len = np.array([len(m) for m in marked])
    cp = np.concatenate(marked).astype(np.int64) if marked else np.zeros(0, np.int64)
    doc_at = np.concatenate([[0], np.cumsum(doc_len)])
    seeds = tn.mix(np.array([(x or 0) & (2**64 - 1) for x in keys], _U) * _GOLD + _U(seed * 2 + 1))
    if len(cp):
        cut = np.zeros(len(cp), bool)
        alone = ~vocab.inner[cp]
        cut[alone] = True
        cut[1:] |= alone[:-1]
        if vocab.cut_spaces:
            sp = cp == ord(SPACE)
            cut[1:] |= sp[1:] & ~sp[:-1]
        cut[doc_at[:-1][doc_len > 0]] = True
        starts = np.flatnonzero(cut)
        lens = np.diff(np.append(starts, len(cp)))
        h = tn.span_hash(tn.prefix_hash(_values(cp)), starts, starts + lens)
        _, one, kind = np.unique(h, return_index=True, return_inverse=True)
        lat = _Lattices(vocab, cp, starts[one], lens[one])
        doc = np.searchsorted(doc_at, starts, "right") - 1
    else:
        lat, kind, doc = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
    part_at = np.searchsorted(doc, np.arange(len(texts) + 1))
    n_docs = len(texts)
    heaps: list[list] = [[] for _ in range(n_docs)]
    paths: list[list[tuple]] = [[] for _ in range(n_docs)]    # (nodes, sizes, part of each step)
    samples: list[list[tuple]] = [[] for _ in range(n_docs)]
    plan = []                                                  # (doc, prefix nodes, sizes, parts, next part, next node, top, phi0, first step)
    tops = (-np.log(-np.log(_uniform(seeds, 1 << 41)))).tolist() if n_docs else []
    plain = seeds.tolist()
    for d, top in enumerate(tops):
        if doc_len[d]:
            plan.append((d, None, 0, int(part_at[d]), -1, top, 0.0))
        else:
            samples[d].append((None, 0.0, top))
    for r in range(k):
        if not plan:
            break
        take, node, owner = [], [], []
        for d, _, _, part, at, _, _ in plan:
            take.append(np.arange(part, part_at[d + 1]))
        many = np.array([len(x) for x in take])
        take = np.concatenate(take)
        owner = np.repeat(np.arange(len(plan)), many)
        node = lat.first[kind[take]].copy()
        first_of = np.concatenate([[0], np.cumsum(many)])
        for i, p in enumerate(plan):
            if p[4] >= 0:
                node[first_of[i]] = p[4]
        who = np.array([p[0] for p in plan])
        ptr, nodes, sizes = _walk(lat, kind[take], node, seeds[who][owner], r, take - part_at[who][owner])
        parts = np.repeat(take, np.diff(ptr))
        edge_lp = lat.edge_logp(nodes, sizes)
        new = ptr[first_of]                                    # where each text's new steps begin
        total = np.concatenate([[0.0], np.cumsum(edge_lp)])
        for i, (d, head, step, _, _, top, phi) in enumerate(plan):
            a, z = new[i], new[i + 1]
            full = (nodes[a:z], sizes[a:z], parts[a:z])
            if head is not None:
                full = tuple(np.concatenate(x) for x in zip(head, full))
            paths[d].append(full)
            samples[d].append((full, float(phi + total[z] - total[a]), top))
        _branches(heaps, [(p[0], p[2], p[6], p[5]) for p in plan], seeds, r, new, edge_lp, sizes, k - r)
        plan = []
        if r + 1 == k:
            break
        for d in range(n_docs):
            if not heaps[d] or len(samples[d]) != r + 1:
                continue
            key, path, step, phi, taken = heapq.heappop(heaps[d])
            n0, s0, p0 = paths[d][path]
            here = int(n0[step])
            free = [(x, p) for x, p in zip(*lat.edges(here)) if x not in taken]
            mass = sum(p for _, p in free)
            if mass <= 0:
                continue
            u = _chance(plain[d], r, 1 << 42, step) * mass
            for go, prob in free:                             # the last one takes what rounding leaves
                u -= prob
                if u < 0:
                    break
            if len(free) > 1 and mass - prob > 1e-12:         # the alternatives that are still untaken here
                noise = math.log(-math.log(_chance(plain[d], r, 1 << 43, step))) - (phi + math.log(mass - prob))
                v = -float(np.logaddexp(key, noise))
                heapq.heappush(heaps[d], (-v, path, step, phi, taken + (go,)))
            head = (np.append(n0[:step], here), np.append(s0[:step], go), np.append(p0[:step], p0[step]))
            ended = bool(lat.end[here + go])
            part = int(p0[step]) + ended
            plan.append((d, head, step + 1, part, -1 if ended else here + go, -key, phi + math.log(prob)))
    out = []
    for d in range(n_docs):
        kappa = -heaps[d][0][0] if heaps[d] else -math.inf
        rows = []
        for steps, logp, key in samples[d]:
            ids = lat.ids[steps[0], steps[1] - 1] if steps is not None else np.zeros(0, "<u4")
            x = logp - kappa                                   # P(included) = 1 - exp(-exp(x))
            inc = 0.0 if x > 3.6 else (x if x < -20 else math.log(-math.expm1(-math.exp(x))))
            rows.append((_expand(vocab, ids), logp, key, inc))
        out.append(rows)
    return out


def _expand(vocab: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Characters without piece (vocabulary size + code point) as byte pieces."""
    odd = np.flatnonzero(ids >= vocab.size)
    if not len(odd):
        return ids.astype("<u4")
    raw = [chr(int(c) - vocab.size).encode("utf-8", "surrogatepass") for c in ids[odd]]
    many = np.ones(len(ids), np.int64)
    many[odd] = [len(x) for x in raw]
    out = np.repeat(ids.astype(np.int64), many)
    out[out >= vocab.size] = vocab.bytes[np.frombuffer(b"".join(raw), np.uint8)]
    return out.astype("<u4")


def default_model() -> str:
    import public_tokenizers as P
    return P.path("piece_bpe_32k.model")


def sampled_segmentations(docs: DataFrame, k: int = 2, alpha: float = 1.0, seed: int = 0, model: str | None = None, scores: str = "rank",
                          id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 1 << 20) -> DataFrame:
    """``k`` distinct segmentations of every whole text, drawn without
    replacement: doc_id, sample (from 1, largest key first), ids (little-endian unsigned
    32-bit piece ids), pieces, log_prob, perturbed (the key), log_inclusion (log of
    the probability to be drawn, given the key of the best one left out) and decoded
    (the text of the ids).

    A text with fewer segmentations gives fewer rows.  Null and empty texts
    give one empty segmentation.  Rows with equal ids (or none) and equal texts give
    equal samples.  An empty table gives an empty result."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, alpha, scores)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.string()]
        for b in batches:
            keys, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for x, z in sub_batches(texts, batch_chars):
                cols: list[list] = [[] for _ in names]
                for key, rows in zip(keys[x:z], sample_batch(vocab, texts[x:z], keys[x:z], k, seed)):
                    for i, (ids, logp, pert, inc) in enumerate(rows):
                        for c, v in zip(cols, (key, i + 1, ids.tobytes(), len(ids), logp, pert, inc, vocab.decode(ids))):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
