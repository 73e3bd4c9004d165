"""Language ID by nearest centroid.

A text becomes counts of its letter bigrams and trigrams, hashed into a fixed number of features, weighted by
1 + log(count) and inverse document frequency, and scaled to length one. Each language has several centroids, found by
spherical k-means. A text gets the language of the centroid with the largest cosine; it is rejected if that centroid is
farther than its language's rejection distance, which is widened for texts of few n-grams.

Edge cases: null text, empty text and text without any letter are `und` with score 0 and rejected. Very long texts are
read in blocks, whole. Repeated rows get equal answers. Ties go to the language that sorts first. An empty training
table gives a model that answers `und` everywhere. Other columns of the input are carried along untouched; the columns
that the operator adds replace columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelespan.llm._common import table

FEATURES = 8192
#: Bound on the labelled rows that the model is fitted on: of each language in turn the distinct texts with the smallest hashes.
FIT_ROWS = 2000
CENTROIDS = 4
#: Characters that are held as arrays at once.
BLOCK = 1 << 20
#: Rejected: cosine under this share of the smallest cosine (lowest thousandth) of the language's training texts with their centroids.
REJECT_SHARE = 0.5
#: A text of fewer n-grams says less about its distance: its limit shrinks in proportion.
EVIDENCE = 100


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point its lower-case code point if it is a letter, else 0."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            out[c] = ord(s.lower()[0])
    return out


def _hashed(code: np.ndarray, new: int = 0) -> np.ndarray:
    """Features of the bigrams and trigrams of lower-case code points, 0 where there is no letter; runs of zeros are one. Only
    those that reach the last `new` of the code points, if given: the others belong to the block before."""
    keep = np.concatenate(([True], (code[1:] != 0) | (code[:-1] != 0)))
    old = int(keep[: len(code) - new].sum()) if new else 0
    c = code[keep].astype(np.uint32)
    if len(c) < 2:
        return np.zeros(0, dtype=np.int64)
    two = c[:-1] * np.uint32(2654435761) + c[1:] * np.uint32(2246822519)
    three = two[:-1] * np.uint32(3266489917) + c[2:] * np.uint32(668265263)
    two, three = two[max(0, old - 1) :], three[max(0, old - 2) :]
    mixed = np.concatenate((two ^ (two >> np.uint32(15)), three ^ (three >> np.uint32(13))))
    return ((mixed * np.uint32(374761393)) >> np.uint32(19)).astype(np.int64) % FEATURES


def _counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A row of counts for each text, and whether it has a letter. A text stands between two marks (0); a block is read with the
    two marks or letters before it and counts the n-grams that end in it."""
    letters, out, has = _letters(), np.zeros((len(texts), FEATURES), dtype=np.float32), np.zeros(len(texts), dtype=bool)
    for i, text in enumerate(texts):
        before = np.zeros(1, np.uint32)
        for at in range(0, len(text or ""), BLOCK):
            code = letters[np.frombuffer(text[at : at + BLOCK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
            has[i] |= bool(code.any())
            if at + BLOCK >= len(text):
                code = np.append(code, np.uint32(0))
            code = code[np.concatenate(([bool(before[-1]) or bool(code[0])], (code[1:] != 0) | (code[:-1] != 0)))]
            if len(code):
                both = np.concatenate((before, code))
                out[i] += np.bincount(_hashed(both, len(code)), minlength=FEATURES)
                before = both[-2:]
        if not has[i]:
            out[i] = 0
    return out, has


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    have = counts > 0
    w = np.log(counts, out=np.zeros_like(counts), where=have)
    w += have
    w *= idf
    w /= np.maximum(np.sqrt(np.einsum("ij,ij->i", w, w)), 1e-12)[:, None]
    return w


def _clusters(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; starts from the mean's nearest row, then from rows farthest from all centroids so far."""
    at = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(at) < min(k, len(x)):
        at.append(int(np.argmin((x @ x[at].T).max(axis=1))))
    c = x[at].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].mean(axis=0)
                c[j] = m / max(float(np.linalg.norm(m)), 1e-12)
    return c


class Model:
    def __init__(self, langs: list[str], centroids: np.ndarray, least: np.ndarray, idf: np.ndarray):
        self.langs, self.centroids, self.least, self.idf = langs, centroids, least, idf

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection for each text."""
        lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        for a in range(0, len(texts) if self.langs else 0, 64):
            counts, has = _counts(texts[a : a + 64])
            cos = _weighted(counts, self.idf) @ self.centroids.T
            sure = np.minimum(1.0, counts.sum(axis=1) / EVIDENCE)
            best = cos.argmax(axis=1)
            for i in np.flatnonzero(has):
                j = best[i]
                lang[a + i], score[a + i], rejected[a + i] = self.langs[j], min(1.0, max(0.0, float(cos[i, j]))), cos[i, j] < self.least[j] * sure[i]
        return lang, score, rejected


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS) -> Model:
    """labelled: text and language; rows with a null in either are not used. Counts of at most fit_rows rows, in at most
    FEATURES numbers each, come to the driver; no text does."""
    rows = labelled.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t IS NOT NULL AND l IS NOT NULL").withColumn("h", F.xxhash64("t", "l"))
    place = F.row_number().over(Window.partitionBy("l").orderBy("h"))  # at most fit_rows of a language leave a task
    chosen = rows.select("l", "h").distinct().withColumn("place", place).where(F.col("place") <= fit_rows).orderBy("place", "l").limit(fit_rows).select("h").collect()

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # copies count once; no more than fit_rows hashes come here
        for pdf in batches:
            pdf = pdf[~pdf["h"].duplicated() & ~pdf["h"].isin(seen)]
            seen.update(pdf["h"].tolist())
            for a in range(0, len(pdf), 64):
                part = pdf.iloc[a : a + 64]
                counts, has = _counts(part["t"].tolist())
                at = [np.flatnonzero(c) for c in counts]
                yield pd.DataFrame({"h": part["h"].tolist(), "l": part["l"].tolist(), "f": at, "n": [c[i] for c, i in zip(counts, at)]})[has]

    got = []
    if chosen:
        asked = F.broadcast(labelled.sparkSession.createDataFrame([(r.h,) for r in chosen], "h long"))
        got = rows.join(asked, "h", "left_semi").select("h", "l", "t").mapInPandas(features, "h long, l string, f array<int>, n array<float>").dropDuplicates(["h"]).drop("h").collect()
    if not got:
        return Model([], np.zeros((0, FEATURES), np.float32), np.zeros(0), np.zeros(FEATURES, np.float32))
    got.sort(key=lambda r: (r["l"], r["f"], r["n"]))
    counts = np.zeros((len(got), FEATURES), dtype=np.float32)
    names = np.array([r["l"] for r in got])
    for i, r in enumerate(got):
        counts[i, r["f"]], got[i] = r["n"], None
    idf = (np.log((1 + len(got)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x = _weighted(counts, idf)
    del counts
    langs: list[str] = []
    parts = []
    for name in sorted(set(names)):
        c = _clusters(x[names == name], centroids)
        langs += [str(name)] * len(c)
        parts.append(c)
    c = np.concatenate(parts)
    cos = x @ c.T
    own = np.where(np.array(langs)[None, :] == names[:, None], cos, -1).max(axis=1)
    least = np.array([REJECT_SHARE * float(np.quantile(own[names == name], 0.001)) for name in langs])
    return Model(langs, c.astype(np.float32), least, idf)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, lang_score (0 to 1) and lang_rejected."""
    added = ("lang_pred", "lang_score", "lang_rejected")
    df = df.drop(*added)
    schema = T.StructType([*df.schema.fields, T.StructField(added[0], T.StringType()), T.StructField(added[1], T.DoubleType()), T.StructField(added[2], T.BooleanType())])

    names, at = [f.name for f in schema], df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # Arrow, not pandas: other columns pass as they are, with their nulls and whole numbers
            lang, score, rejected = model.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=names)

    return df.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def trained(docs: DataFrame) -> Model:
    """Learns from the labelled documents outside the held-out quarter."""
    return fit(docs.where(~F.coalesce(held_out(), F.lit(False))))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs.select("doc_id", "text"), trained(docs))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the rejected ones go."""
    return predict(docs, trained(docs)).where("NOT lang_rejected").select(docs.columns)
