"""Language of whole texts: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log-probabilities (buckets by languages) that is learned
on a bounded sample, counted on the executors, and broadcast. A text is the
multiset of the buckets of all its 1- to 3-grams; a batch of texts is scored at
once as a sparse matrix in compressed rows.

Defined results: a null text, and one without any letter, is ``und`` with score
0; so is every text if nothing could be learned. Rows with null labels or texts
teach nothing; rows without a key teach like others; rows that repeat key and text
teach once. Repeated rows are each predicted; ties go to the first language in
order of its name. An empty table teaches nothing and gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import mapped, quoted
from .storage import Workspace, slices

UNDETERMINED = "und"
ORDERS, BUCKET_BITS, SMOOTHING = (1, 2, 3), 14, 0.5
#: Texts that a language learns from at most; more languages than this fail ``fit`` (16 MB of matrix).
SAMPLE, MOST_LANGUAGES = 1_000, 256
#: Characters handled at once.
CHARS = 1 << 18
_ODD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(1)
def _lower() -> np.ndarray:
    out = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of the texts, each with a space before and after
    it; and where each begins."""
    text = " " + "  ".join(texts) + " "
    points = _lower()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    return points, np.concatenate([[0], np.cumsum(lengths)])


def _buckets(points: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each point."""
    h = points[: len(points) - n + 1] * np.uint32(_ODD[0]) + np.uint32(n)
    for k in range(1, n):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(_ODD[k]) + points[k : len(points) - n + 1 + k]
    h = (h ^ (h >> np.uint32(16))) * np.uint32(_ODD[1])
    return (h >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(texts, points, where each text begins) in groups of bounded size; a long
    text comes in several, each with the two characters before its seam, so that
    no n-gram is lost (the few around a seam count twice)."""
    for i, j in slices(texts, [len(t) for t in texts], CHARS):
        long = j == i + 1 and len(texts[i]) > CHARS
        step = CHARS if long else 1
        for at in range(0, len(texts[i]) if long else 1, step):
            group = [texts[i][max(0, at - 2) : at + step]] if long else texts[i:j]
            points, begins = _points(group)
            yield np.arange(i, j), points, begins


def counts(texts: list[str]) -> np.ndarray:
    """How often each bucket occurs in the texts together."""
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for _, points, begins in _grams(texts):
        for n in ORDERS:
            inside = np.ones(len(points), bool)
            for k in range(1, n):
                inside[begins[1:] - k] = False
            got = _buckets(points, n)
            total += np.bincount(got[inside[: len(got)]], minlength=len(total))
    return total


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # (buckets + 1, languages); the last row is zeros

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each text in each language; whether it has a letter."""
        out = np.zeros((len(texts), len(self.languages)))
        letters = np.zeros(len(texts), bool)
        nothing = len(self.log_p) - 1
        for which, points, begins in _grams(texts):
            letters[which] |= np.logical_or.reduceat(_letters()[points], begins[:-1])
            for n in ORDERS:
                got = _buckets(points, n)
                got = np.concatenate([got, np.full(len(points) - len(got), nothing, np.int32)])
                for k in range(1, n):
                    got[begins[1:] - k] = nothing
                for c in range(len(self.languages)):
                    out[which, c] += np.add.reduceat(self.log_p[:, c].take(got), begins[:-1], dtype=np.float64)
        return out, letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its posterior under equal priors."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        logs, letters = self.scores([t or "" for t in texts])
        best = logs.argmax(1)
        with np.errstate(under="ignore"):
            p = 1.0 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)]
        return names, np.where(letters, p, 0.0)


def fit(df: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", where: Column | None = None, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` distinct (key, text) a language, those with the
    smallest hash; a null key is a key like others. What comes to the driver is one
    count a language, its share's bound, and one count a bucket and language."""
    rows = df.where(quoted(label).isNotNull() & quoted(text).isNotNull() & (quoted(label) != UNDETERMINED))
    rows = rows.where(where) if where is not None else rows
    rows = rows.select(quoted(label).alias("label"), F.shiftrightunsigned(F.xxhash64(quoted(key), quoted(text)), 1).alias("h"), quoted(text).alias("text"))
    sizes = rows.groupBy("label").agg(F.approx_count_distinct("h", 0.02).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: their matrix would not be small enough to broadcast")
    # A share that holds the sample with certainty for all purposes, whatever a language's size.
    share = {r["label"]: min(1.0, (2.0 * sample + 100) / max(r["n"], 1)) for r in sizes}
    work = Workspace(df.sparkSession, "language")
    if not share:
        return Model([], np.zeros(((1 << BUCKET_BITS) + 1, 0), np.float32))
    bound = F.create_map(*(F.lit(x) for lang, part in share.items() for x in (lang, min(int(part * 2.0**63), (1 << 63) - 1))))
    some = work.write(rows.where(F.col("h") <= bound[F.col("label")]).groupBy("label", "h").agg(F.first("text").alias("text")), "sample")
    order = Window.partitionBy("label").orderBy("h")
    last = some.select("label", "h").withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).groupBy("label").agg(F.max("h").alias("last"))
    bound = F.create_map(*(F.lit(x) for r in last.collect() for x in (r["label"], r["last"])))
    texts = some.where(F.col("h") <= bound[F.col("label")]).select("label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(t)
            for lang, group in by.items():
                held[lang] = held.get(lang, 0) + counts(group)
        for lang, c in held.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())], names=["label", "bucket", "n"])

    found = texts.mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    work.drop(some)
    languages = sorted(set(found["label"].to_pylist()))
    total = np.full((1 << BUCKET_BITS, len(languages)), SMOOTHING)
    column = {lang: i for i, lang in enumerate(languages)}
    np.add.at(total, (found["bucket"].to_numpy(), [column[x] for x in found["label"].to_pylist()]), found["n"].to_numpy())
    log_p = np.log(total / total.sum(0)) if languages else total
    return Model(languages, np.asfortranarray(np.vstack([log_p, np.zeros((1, len(languages)))]), np.float32))


def predict(df: DataFrame, model: Model, text: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``df`` with the language and its score in the columns ``out``; columns of
    these names are replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        for (texts,), rest in batches:
            names, score = shared.value.predict(texts.to_pylist())
            yield [pa.array(names, pa.string()), pa.array(score, pa.float64())], rest

    return mapped(df, [quoted(text)], run, [(out[0], "string"), (out[1], "double")])
