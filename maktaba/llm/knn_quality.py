"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A document's terms are its byte trigrams, and the shapes of its words and of pairs of words in a row: a shape is the kinds
of characters in a word, and whether the word is the one before it again. Both are hashed into TERMS cells and weighed
alike: sublinear weights times inverse document frequencies, of unit length, go through a truncated singular value
decomposition that is learnt from at most `sample` labelled rows (those with the least hash of their id). Their vectors, labels and the
projection are broadcast: at most sample * rank + TERMS * rank floats, whatever the corpus. Each document is compared
with every labelled vector by exact cosine products, a block of documents at a time, and the labels of the `neighbours`
nearest count by their similarity.

Cases: a null or empty text has no vector and gets the share of label 1 in the sample; ties of similarity go to the
neighbour that comes first by id; repeated rows get equal scores; rows with a null id or label don't teach; without
labels the score is 0.5; an empty table gives an empty result; other columns are not read, and `keep` passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RangeHash, mix

TERMS = 2048
#: Cells of word shapes among the terms; the others are for trigrams.
SHAPES = 512
#: Kinds of bytes: other, capital, letter (all beyond ASCII too), digit, punctuation, symbol.
_KINDS = np.full(256, 5, np.int64)
_KINDS[65:91], _KINDS[97:123], _KINDS[128:], _KINDS[48:58], _KINDS[[46, 44, 59, 58, 33, 63, 39, 34, 45, 40, 41]] = 1, 2, 2, 3, 4
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Changes of kind that a shape tells apart.
RUNS = 6
BLOCK = 512
#: Rounds of subspace iteration.
ROUNDS = 8


@dataclass(frozen=True)
class Model:
    idf: np.ndarray  # (TERMS,)
    project: np.ndarray  # (TERMS, rank)
    vectors: np.ndarray  # (labelled rows, rank), unit length
    labels: np.ndarray  # (labelled rows,)
    prior: float


def terms(text: str | None) -> np.ndarray:
    """The weights of a text's terms, before the inverse document frequencies."""
    out = np.zeros(TERMS, np.float32)
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return out
    padded = np.concatenate([data, np.full(2, 32, np.uint8)]).astype(np.uint64)
    code = padded[:-2] * np.uint64(65536) + padded[1:-1] * np.uint64(256) + padded[2:]
    cells = TERMS - SHAPES
    out[:cells] = np.log1p(np.bincount((mix(code) % np.uint64(cells)).astype(np.int64), minlength=cells))
    code = _shapes(data)
    if len(code):
        both = np.concatenate([code, code[:-1] * np.uint64(1_000_003) + code[1:] + np.uint64(7)])
        out[cells:] = np.log1p(np.bincount((mix(both) % np.uint64(SHAPES)).astype(np.int64), minlength=SHAPES))
    return out


def _shapes(data: np.ndarray) -> np.ndarray:
    """A number for the shape of each word: the kinds of its first RUNS runs of characters, and whether it repeats the word before."""
    inside = ~_WHITE[data]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    if not len(starts):
        return np.zeros(0, np.uint64)
    kinds = np.where(inside, _KINDS[data], -1)
    runs = np.flatnonzero(inside & np.concatenate([[True], kinds[1:] != kinds[:-1]]))
    word = np.searchsorted(starts, runs, side="right") - 1
    nth = np.arange(len(runs)) - np.searchsorted(runs, starts)[word]
    runs, word, nth = runs[nth < RUNS], word[nth < RUNS], nth[nth < RUNS]
    code = np.bincount(word, (kinds[runs] + 1) * 7.0**nth, len(starts)).astype(np.uint64)
    known = RangeHash(data)(starts, ends)
    return code * np.uint64(2) + np.concatenate([[False], known[1:] == known[:-1]]).astype(np.uint64)


def _weigh(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(x * idf)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(x: np.ndarray, y: np.ndarray, *, rank: int = 48) -> Model:
    """The model of term weights x and labels y: right singular vectors by subspace iteration, which holds little beside x."""
    if not len(x):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, rank), np.float32), np.zeros((0, rank), np.float32), np.zeros(0), 0.5)
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    weighed = _weigh(x, idf)
    basis = np.random.default_rng(0).standard_normal((TERMS, rank + 16)).astype(np.float32)
    for _ in range(ROUNDS):
        basis = np.linalg.qr(weighed.T @ (weighed @ basis))[0]
    turn = np.linalg.svd(weighed @ basis, full_matrices=False)[2]
    project = np.ascontiguousarray((basis @ turn.T)[:, :rank])
    return Model(idf, project, _unit(weighed @ project), y.astype(np.float64), float(y.mean()))


def score(model: Model, x: np.ndarray, *, neighbours: int = 24) -> np.ndarray:
    """The share of label 1 among the nearest labelled vectors, weighted by similarity, for each row of term weights."""
    if not len(model.labels):
        return np.full(len(x), model.prior)
    k = min(neighbours, len(model.labels))
    near = _unit(_weigh(x, model.idf) @ model.project) @ model.vectors.T
    # Equal similarities: the lower row of the model counts. The cut value alone decides who is in, ties by position.
    cut = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k, None]
    rows, cols = np.nonzero(near >= cut)
    values = near[rows, cols].astype(np.float64)
    order = np.lexsort((cols, -values, rows))
    rows, cols, values = rows[order], cols[order], values[order]
    first = np.searchsorted(rows, np.arange(len(x)))
    inside = np.arange(len(rows)) - first[rows] < k
    rows, cols, weight = rows[inside], cols[inside], np.maximum(values[inside], 0) ** 4 + 1e-9
    votes = np.bincount(rows, weight * model.labels[cols], len(x)) / np.bincount(rows, weight, len(x))
    votes[~(x > 0).any(1)] = model.prior
    return np.clip(votes, 0, 1)


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0. Such rows never teach. A null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, *, target: str = "quality", id_column: str = "doc_id", text_column: str = "text", sample: int = 5_000, rank: int = 48) -> Model:
    """The model of at most `sample` labelled rows that aren't held out: those whose id has the least hash."""
    known = labels.select(F.col(id_column).alias("_id"), F.col(target).cast("int").alias("_y")).dropna().filter(~is_held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)

    @F.pandas_udf("binary")
    def weights(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = []
            for t in texts:
                x = terms(t)
                at = np.flatnonzero(x)
                found.append(at.astype("<u2").tobytes() + x[at].astype("<f4").tobytes())
            yield pd.Series(found, dtype=object)

    rows = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text")).join(F.broadcast(known), "_id")
    rows = rows.select("_id", "_y", weights("_text").alias("_w")).toPandas()
    rows = rows.assign(_w=rows["_w"].map(bytes)).sort_values(["_id", "_w"], kind="stable")
    x = np.zeros((len(rows), TERMS), np.float32)
    for i, w in enumerate(rows["_w"]):
        n = len(w) // 6
        x[i, np.frombuffer(w, "<u2", n)] = np.frombuffer(w, "<f4", n, 2 * n)
    return fit(x, rows["_y"].to_numpy(np.float64), rank=rank)


def score_column(spark, text: Column, model: Model, *, neighbours: int = 24) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = list(texts)
            blocks = [score(shared.value, np.stack([terms(t) for t in texts[i : i + BLOCK]]), neighbours=neighbours) for i in range(0, len(texts), BLOCK)]
            yield pd.Series(np.concatenate(blocks) if blocks else np.zeros(0))

    return vote(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.3, neighbours: int = 24) -> DataFrame:
    """One row per document: its id, held_out, score and predicted."""
    found = docs.select(F.col(id_column), is_held_out(F.col(id_column)).alias("held_out"), score_column(docs.sparkSession, F.col(text_column), model, neighbours=neighbours).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, model: Model, *, text_column: str = "text", threshold: float = 0.3, neighbours: int = 24) -> DataFrame:
    """The rows of docs whose score reaches the threshold, all columns unchanged."""
    found = docs.select(F.struct(*docs.columns).alias("_d"), score_column(docs.sparkSession, F.col(text_column), model, neighbours=neighbours).alias("_s"))
    return found.filter(F.col("_s") >= threshold).select(*[F.col(f"_d.{c}") for c in docs.columns])
