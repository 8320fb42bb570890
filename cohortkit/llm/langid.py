"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Counts of hashed n-grams for each language are summed by Spark over a bounded
training sample; the log-probability matrix (buckets by languages) is broadcast, and
documents are scored in batches by gathering its rows for the n-grams they
hold.  The score is the posterior probability of the predicted language.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, small_batches

BITS = 16
ORDERS = (1, 2, 3)
UNKNOWN = "und"
_U = np.uint64


@dataclass
class NaiveBayes:
    languages: list[str]
    prior: np.ndarray       # log prior by language
    log_prob: np.ndarray    # (buckets, languages), float32


def ngrams(chars: np.ndarray) -> np.ndarray:
    """Bucket of every n-gram of an array of code points."""
    c = chars.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(0x632BE59BD9B4E019)
    out, h = [], np.zeros(len(c), _U)
    for k in range(max(ORDERS)):
        n = len(c) - k
        if n <= 0:
            break
        h = (h[:n] * _U(0x100000001B3)) ^ c[k:]
        if k + 1 in ORDERS:
            m = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
            out.append((m >> _U(64 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def _chars(text: str) -> np.ndarray:
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), "<u4")


def fit(docs: DataFrame, per_language: int = 1500, fold: tuple[int, int] = (3, 1), smoothing: float = 0.5,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> NaiveBayes | None:
    """Fit on about ``per_language`` whole documents of each language
    outside the fold ``crc32(id) mod fold[0] = fold[1]`` (all, where there
    are fewer), picked by a hash of the id.  Only text and language are used; null
    languages and texts are left out.  None if nothing is left."""
    use = (docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__t"),
                       F.col(lang_col).cast("string").alias("__l"))
           .where("__l is not null and __t is not null and __id is not null").where(~held_out("__id", *fold)))
    size = {r["__l"]: r["n"] for r in use.groupBy("__l").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not size:
        return None
    draw = F.pmod(F.xxhash64("__id", F.lit("langid")), F.lit(1 << 30))
    keep = F.lit(False)
    for lang, n in sorted(size.items()):
        keep = keep | ((F.col("__l") == F.lit(lang)) & (draw < F.lit(int(min(1.0, per_language / n) * (1 << 30)))))
    langs = sorted(size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for t, lang in zip(b["__t"], b["__l"]):
                got = np.bincount(ngrams(_chars(t)), minlength=1 << BITS)
                total[lang] = total[lang] + got if lang in total else got
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": c[at]})

    rows = (use.where(keep).mapInPandas(run, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())  # languages x buckets at most
    counts = np.zeros((1 << BITS, len(langs)))
    col = {lang: i for i, lang in enumerate(langs)}
    for r in rows:
        counts[r["bucket"], col[r["lang"]]] = r["n"]
    seen = counts.sum(axis=0) > 0
    if not seen.any():
        return None
    langs, counts = [x for x, s in zip(langs, seen) if s], counts[:, seen]
    prob = (counts + smoothing) / (counts.sum(axis=0) + smoothing * (1 << BITS))
    n = np.array([size[x] for x in langs], float)
    return NaiveBayes(langs, np.log(n / n.sum()), np.log(prob).astype(np.float32))


def predict_texts(model: NaiveBayes | None, texts: Sequence[str | None], lettered: Sequence[bool]) -> tuple[list[str], np.ndarray]:
    """(language, posterior) for each text; texts that are null or have no
    letter (``lettered``) get the unknown language with score 0."""
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model is None:
        return lang, score
    at = [i for i, (t, ok) in enumerate(zip(texts, lettered)) if ok and t]
    lo = 0
    while lo < len(at):
        hi, size, grams = lo, 0, []
        while hi < len(at) and (hi == lo or size < 1 << 19):
            grams.append(ngrams(_chars(texts[at[hi]])))
            size += len(grams[-1])
            hi += 1
        ptr = np.concatenate([[0], np.cumsum([len(g) for g in grams])])[:-1]
        flat = np.concatenate(grams)
        total = np.stack([np.add.reduceat(model.log_prob[:, j][flat].astype(float), ptr) for j in range(len(model.languages))], axis=1)
        total += model.prior
        best = total.argmax(axis=1)
        post = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for k, i in enumerate(at[lo:hi]):
            lang[i], score[i] = model.languages[best[k]], post[k]
        lo = hi
    return lang, score


def predict(docs: DataFrame, model: NaiveBayes | None, lang_out: str, score_out: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the predicted language and its posterior for every row.
    Null texts and texts without a letter have language ``und`` and score 0;
    so has every row if there is no model."""
    small_batches(docs.sparkSession)
    if model is not None:
        model = NaiveBayes(model.languages, model.prior, np.asfortranarray(model.log_prob))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS x languages floats

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        nb = sent.value
        for texts, lettered in batches:
            lang, score = predict_texts(nb, texts.tolist(), lettered.tolist())
            yield pd.DataFrame({"lang": lang, "score": score})

    text = F.col(text_col).cast("string")
    got = docs.withColumn("__langid", run(text, F.coalesce(text.rlike(r"\p{L}"), F.lit(False))))
    return got.withColumns({lang_out: F.col("__langid.lang"), score_out: F.col("__langid.score")}).drop("__langid")
