"""Quality by nearest-neighbour voting in a latent semantic space."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import Features, Sample, TokenFeatures, describe, labelled_sample
from tidemark.llm.text import map_rows

CHUNK = 256


@dataclass(frozen=True)
class KnnSpec:
    """``per_label`` bounds the labelled documents of each label that are kept as neighbours (the
    bounded training sample), ``rank`` the latent dimensions, ``neighbours`` the least number of votes."""

    per_label: int = 2500
    rank: int = 48
    neighbours: int = 25
    sharpness: float = 8.0
    word_weight: float = 0.5
    features: Features = Features()


@dataclass
class LatentSpace:
    """Projection of word rows, and the unit vectors and labels of the neighbours."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def _basis(sample: Sample, idf: np.ndarray, n_words: int, rank: int) -> np.ndarray:
    """Leading right singular vectors (n_words x rank) by randomised subspace iteration over row chunks."""
    n = len(sample.ids)
    rank = max(1, min(rank, n))
    q = np.random.default_rng(11).standard_normal((n_words, rank + 8)).astype(np.float32)
    for _ in range(4):
        out = np.zeros_like(q)
        for lo in range(0, n, CHUNK):
            a = sample.rows(lo, min(n, lo + CHUNK), n_words, idf)
            out += a.T @ (a @ q)
        q, _ = np.linalg.qr(out)
    small = np.zeros((q.shape[1], q.shape[1]))
    for lo in range(0, n, CHUNK):
        p = sample.rows(lo, min(n, lo + CHUNK), n_words, idf) @ q
        small += p.T @ p
    _, vectors = np.linalg.eigh(small)
    return (q @ vectors[:, ::-1][:, :rank].astype(np.float32)).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _vectors(words: np.ndarray, dense: np.ndarray, weight: float) -> np.ndarray:
    """Unit latent word part (times ``weight``) next to the unit shape and style part."""
    return _unit(np.hstack([weight * _unit(words), _unit(dense)])).astype(np.float32)


def fit_space(docs: DataFrame, labels: DataFrame, label: str = "quality", spec: KnnSpec | None = None) -> LatentSpace | None:
    """Latent space and neighbours from labelled documents; None if there is none.

    Conflicting labels of one id count as one neighbour each.
    """
    spec = spec or KnnSpec()
    sample = labelled_sample(docs, labels, label, spec.per_label, [0, 1], spec.features)
    n, n_words = len(sample.ids), spec.features.n_words
    if not n:
        return None
    idf = (np.log((n + 1) / (np.bincount(sample.buckets, minlength=n_words) + 1)) + 1).astype(np.float32)
    basis = _basis(sample, idf, n_words, spec.rank)
    words = np.vstack([sample.rows(lo, min(n, lo + CHUNK), n_words, idf) @ basis for lo in range(0, n, CHUNK)])
    prior = labels.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return LatentSpace(idf, basis, _vectors(words, sample.dense, spec.word_weight), sample.labels.astype(np.float32), float(prior))


def vote(vectors: np.ndarray, space: LatentSpace, k: int, sharpness: float) -> np.ndarray:
    """Similarity-weighted label mean of the ``k`` nearest neighbours, all that tie with the k-th included."""
    sims = vectors @ space.vectors.T
    k = min(k, sims.shape[1])
    least = np.partition(sims, -k, axis=1)[:, -k][:, None]
    weight = np.where(sims >= least, np.maximum(sims, 0.0) ** sharpness, 0.0)
    total = weight.sum(1)
    return np.where(total > 1e-12, (weight @ space.labels) / np.maximum(total, 1e-12), space.prior)


def score(docs: DataFrame, space: LatentSpace | None, spec: KnnSpec | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, score), one row per input row and no shuffle.

    Null and empty texts get the share of good labels (0.5 without any labelled document).  Only
    the text enters a score; repeated rows and null ids give a row each.
    """
    spec = spec or KnnSpec()
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def make():
        tokens, model = TokenFeatures(spec.features), shared.value

        def work(columns):
            texts = columns["text"].to_pylist()
            if model is None:
                return {"id": columns["id"], "score": [0.5] * len(texts)}
            out = np.empty(len(texts))
            for lo in range(0, len(texts), CHUNK):
                got = [describe(t, tokens) for t in texts[lo : lo + CHUNK]]
                words = np.zeros((len(got), model.basis.shape[1]), np.float32)
                for i, (_, bucket, value, _) in enumerate(got):
                    if len(bucket):
                        row = value * model.idf[bucket]
                        words[i] = (row / np.linalg.norm(row)) @ model.basis[bucket]
                some = np.array([g[0] > 0 for g in got])
                marks = vote(_vectors(words, np.stack([g[3] for g in got]), spec.word_weight), model, spec.neighbours, spec.sharpness)
                out[lo : lo + len(got)] = np.where(some, marks, model.prior)
            return {"id": columns["id"], "score": np.clip(out, 0.0, 1.0)}

        return work

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_rows(picked, f"id {kind}, score double", make).withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1
