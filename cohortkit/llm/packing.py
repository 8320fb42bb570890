"""Token sequences and vector best-fit packing.

A document becomes token ids and an end id; only documents longer than a
sequence are cut, into full pieces (the first piece may be shorter).  Pieces
are dealt at random into groups of bounded size; each group is packed by
vector best fit, largest pieces first:  a bin has residual capacities for
tokens, documents and attention cost (sum of squared lengths), and a piece goes
to the bin with the best score among those that satisfy every capacity.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, id_and_text, stored, unused

END_ID = 2
END_OF_TEXT = {"<|endoftext|>": 50256}     # the vocabulary's added token, told apart in texts
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"
PACKED_SCHEMA = "row long, sequence_id long, offset long"


@functools.lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=END_OF_TEXT)


def token_ids(enc, text: str | None) -> list[int]:
    """Ids of a text as the tokenizers file gives them: the added token is
    one id wherever it stands, and the text between is encoded by itself."""
    return enc.encode(text or "", allowed_special="all")


@functools.lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def default_tokenizer() -> tuple[str, str, str]:
    """(rank file, split pattern, tokenizers file) of the byte-level BPE
    vocabulary of 50k ids.  The rank file holds the same vocabulary as the other
    and gives the same ids (tests compare the two); it is several times faster."""
    import public_tokenizers as P
    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("byte_bpe_50k.json")


def piece_lengths(n: int, limit: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens."""
    if n <= limit:
        return [n]
    return ([n % limit] if n % limit else []) + [limit] * (n // limit)


def token_pieces(docs: DataFrame, limit: int = 1024, tokenizer: tuple[str, str, str] | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, piece (from 0), start (the document's ids
    before it), length, ids (little-endian unsigned 32-bit).

    ``<|endoftext|>`` in a text is its one id.  Null texts count as empty: one piece with the end id alone.  Rows without id and repeated
    rows give pieces like any other."""
    path, pattern, library = tokenizer or default_tokenizer()

    def ids_of(enc, text: str | None) -> list[int]:
        try:
            return token_ids(enc, text)
        except ValueError:      # its matcher refuses white space of a million characters
            return _library(library).encode(text, add_special_tokens=False).ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, pattern)
        names = ["doc_id", "piece", "start", "length", "ids"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            cols, held = [[] for _ in names], 0
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array(ids_of(enc, t.as_py()) + [END_ID], "<u4")
                at = 0
                for k, n in enumerate(piece_lengths(len(ids), limit)):
                    for c, v in zip(cols, (d, k, at, n, ids[at:at + n].tobytes())):
                        c.append(v)
                    at += n
                held += len(ids)
                if held > 1 << 20:  # a few MB a batch, whatever the texts' lengths
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
                    cols, held = [[] for _ in names], 0
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, PIECE_SCHEMA)


def vector_best_fit(lengths: np.ndarray, limit: int, max_docs: int, max_cost: float,
                    score: str = "norm", weights: Sequence[float] = (1.0, 0.05, 0.05)) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece.  Pieces are taken longest first.  Among
    the bins that satisfy every capacity ``norm`` takes the one with the
    smallest weighted norm of what is left after placing, ``dot`` the one with
    the largest weighted dot product of the piece's and the bin's vectors
    (both as shares of capacity; ties: the oldest bin).  A piece that no empty bin
    can take gets a bin of its own."""
    if score not in ("norm", "dot"):
        raise ValueError("score must be 'norm' or 'dot'")
    n = len(lengths)
    cap = np.array([limit, max_docs, max_cost], float)
    w = np.asarray(weights, float)
    bins, offs = np.empty(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    left = np.empty((n, 3))     # residual capacities of the open bins
    which = np.empty(n, np.int64)
    opened, live = 0, 0
    smallest = lengths.min() if n else 0
    for i in order:
        length = int(lengths[i])
        need = np.array([length, 1.0, float(length) * length])
        pick = -1
        if live:
            room = left[:live] - need
            ok = np.flatnonzero((room >= 0).all(axis=1))
            if len(ok):
                if score == "norm":
                    s = ((room[ok] / cap) ** 2 * w).sum(axis=1)
                else:
                    s = -(left[ok] / cap * (need / cap) * w).sum(axis=1)
                pick = int(ok[np.argmin(s)])
        if pick < 0:
            pick, which[live] = live, opened
            left[live] = cap
            opened += 1
            live += 1
        bins[i] = which[pick]
        offs[i] = int(cap[0] - left[pick, 0])
        left[pick] -= need
        r = left[pick]
        if r[0] < smallest or r[1] < 1 or r[2] < float(smallest) * smallest:  # full: close it
            left[pick:live - 1] = left[pick + 1:live].copy()
            which[pick:live - 1] = which[pick + 1:live].copy()
            live -= 1
    return bins, offs


def pack(pieces: DataFrame, limit: int = 1024, max_docs: int = 1024, max_cost: float | None = None,
         score: str = "norm", weights: Sequence[float] = (1.0, 0.05, 0.05), group_rows: int = 16384) -> DataFrame:
    """``pieces`` (any columns, with a long ``length``) with sequence_id and
    offset.  ``pieces`` should be a stored table: it is read to count its
    rows.  Pieces are dealt by a hash of the row and its place there into groups of about
    ``group_rows`` (equal rows go to many), each packed by itself (a group leaves about
    one sequence half empty).  ``max_cost``
    defaults to the square of ``limit``, which one full document reaches."""
    cost = float(limit) ** 2 if max_cost is None else float(max_cost)
    groups = blocks_for(pieces.count(), group_rows)
    rest = [c for c in pieces.columns]
    order, group = unused(pieces, "spread"), unused(pieces, "group")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([order], kind="stable")
        g = int(pdf[group].iloc[0])
        bins, offs = vector_best_fit(pdf["length"].to_numpy(), limit, max_docs, cost, score, weights)
        return pdf[rest].assign(sequence_id=bins + (g << 32), offset=offs)

    spread = F.xxhash64(*[F.col(c) for c in rest], F.monotonically_increasing_id())
    dealt = pieces.withColumn(order, spread).withColumn(group, F.pmod(order, F.lit(groups)).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy(group).applyInPandas(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Pieces of all documents, packed: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.  The token ids themselves are in
    ``token_pieces``; an empty table gives an empty result."""
    p = token_pieces(docs, limit, id_col=id_col, text_col=text_col)
    p = p.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(stored(p, "pieces"), limit, **options)
