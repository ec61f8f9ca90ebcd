"""Mixing documents to target domain weights with soft memberships.

A softmax classifier trained on labelled documents gives every document domain posteriors.
Nonnegative rates per document are then fitted by accelerated projected gradient steps so that
the expected tokens of the domains meet their targets while rates stay near 1:

    min over r >= 0:   1/2 (sum_i w_i p_i r_i - t)' M (sum_i w_i p_i r_i - t) + mu/2 sum_i w_i (r_i - 1)^2

with ``w_i`` the document's share of all tokens, ``p_i`` its posteriors, ``t`` the target shares
and ``M`` the inverse of ``sum_i w_i p_i p_i'``, so that a domain with few tokens is fitted as
closely and in as few steps as one with many.  A step needs one vector of as many numbers as there are domains from all documents;
each task computes the current rates of its documents again from the vectors so far.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import N_SHAPES, N_STYLE, Features, Sample, TokenFeatures, describe, labelled_sample
from tidemark.llm.text import map_rows, pieces, saved, without


@dataclass(frozen=True)
class MixSpec:
    """``per_label`` bounds the labelled documents of each domain the classifier is fitted on.

    ``target`` maps each domain to its share of the expected tokens, ``budget`` times all tokens.
    ``mu`` weighs the pull towards rate 1.  The fit ends when all domain totals are within
    ``tolerance`` (a share of the budget) of their targets and have settled, or when they no longer
    move; what is then left, for targets out of reach or after ``steps``, is reported as ``unmet``.
    ``floor`` bounds the inverse for domains that hardly any document belongs to; without
    ``whiten`` M is the unit matrix.
    """

    target: dict = field(default_factory=lambda: {"good": 0.85, "low": 0.1, "toxic": 0.05})
    budget: float = 1.0
    per_label: int = 2000
    mu: float = 1e-4
    steps: int = 100
    tolerance: float = 5e-4
    floor: float = 1e-6
    whiten: bool = True
    features: Features = Features()

    @property
    def domains(self) -> list[str]:
        return sorted(self.target)


@dataclass
class DomainModel:
    domains: list[str]
    words: np.ndarray
    dense: np.ndarray
    bias: np.ndarray

    def posteriors(self, bucket: np.ndarray, value: np.ndarray, dense: np.ndarray) -> np.ndarray:
        row = value / max(float(np.linalg.norm(value)), 1e-9)
        z = row @ self.words[bucket] + dense @ self.dense + self.bias
        e = np.exp(z - z.max())
        return e / e.sum()


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _train(sample: Sample, y: np.ndarray, prior: np.ndarray, n_words: int, steps: int = 80) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multinomial regression by full-batch Adagrad; classes weigh as in ``prior``, not as sampled."""
    n, k = len(y), len(prior)
    row = np.repeat(np.arange(n), np.diff(sample.starts))
    norm = np.sqrt(np.bincount(row, sample.values**2, n))
    x = (sample.values / np.maximum(norm, 1e-9)[row]).astype(np.float32)
    weight = prior[y] / np.maximum(np.bincount(y, minlength=k), 1)[y]
    hot = np.eye(k)[y]
    w, d, b = np.zeros((n_words, k)), np.zeros((sample.dense.shape[1], k)), np.log(np.maximum(prior, 1e-6))
    gw, gd, gb = np.full_like(w, 1e-9), np.full_like(d, 1e-9), np.full_like(b, 1e-9)
    for _ in range(steps):
        z = sample.dense @ d + b
        for c in range(k):
            z[:, c] += np.bincount(row, x * w[sample.buckets, c], n)
        e = (_softmax(z) - hot) * weight[:, None]
        down = [np.stack([np.bincount(sample.buckets, x * e[row, c], n_words) for c in range(k)], 1) + 1e-6 * w, sample.dense.T @ e + 1e-6 * d, e.sum(0)]
        for p, g, s in zip((w, d, b), down, (gw, gd, gb)):
            s += g * g
            p -= 0.5 * g / np.sqrt(s)
    return w.astype(np.float32), d.astype(np.float32), b


def domain_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from a table of quality and toxic marks; rows without both marks are left out."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("low")
    return labels.where("quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", domain.alias("domain"))


def fit_domains(docs: DataFrame, labelled: DataFrame, spec: MixSpec) -> DomainModel:
    """Domain classifier from ``labelled`` (doc_id, domain) rows; domains outside the target are ignored.

    Without labelled documents every document belongs to all domains alike.
    """
    domains = spec.domains
    sample = labelled_sample(docs, labelled, "domain", spec.per_label, domains, spec.features)
    k, n_words = len(domains), spec.features.n_words
    if not len(sample.ids):
        return DomainModel(domains, np.zeros((n_words, k), np.float32), np.zeros((N_SHAPES + N_STYLE, k), np.float32), np.zeros(k))
    counts = {r.domain: r["count"] for r in labelled.groupBy("domain").count().collect() if r.domain in domains}
    prior = np.array([float(counts.get(d, 0)) for d in domains])
    y = np.array([domains.index(v) for v in sample.labels])
    return DomainModel(domains, *_train(sample, y, prior / prior.sum(), n_words))


def memberships(docs: DataFrame, model: DomainModel, spec: MixSpec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_tokens, posteriors): words and domain posteriors of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        tokens, m = TokenFeatures(spec.features), shared.value

        def work(columns):
            got = [describe(t, tokens) for t in columns["text"].to_pylist()]
            return {"id": columns["id"], "n_tokens": [g[0] for g in got], "posteriors": [m.posteriors(*g[1:]).round(6) for g in got]}

        return work

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_rows(picked, f"id {kind}, n_tokens long, posteriors array<double>", make).withColumnRenamed("id", id_col)


def rates(p: np.ndarray, residuals: Sequence[np.ndarray], mu: float) -> tuple[np.ndarray, np.ndarray]:
    """(rates, extrapolated point) of documents with posteriors ``p`` after the given gradient steps."""
    step = 1.0 / (1.0 + mu)
    r = y = np.ones(len(p))
    t = 1.0
    for rho in residuals:
        new = np.maximum(0.0, y - step * (p @ rho + mu * (y - 1.0)))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - r)
        r, t = new, t_new
    return r, y


@dataclass(frozen=True)
class RateFit:
    """Gradient steps (scaled residuals), the domain totals they lead to, and the largest distance from a target."""

    steps: list[list[float]]
    totals: list[float]
    unmet: float


def _summed(rows: DataFrame, total: float, k: int, size: int, vector) -> np.ndarray:
    """Sum over all documents of ``vector(token shares, posteriors)``, an array of ``size`` numbers."""

    def part(batches):
        out = np.zeros(size)
        for batch in pieces(batches, 1 << 16):
            if batch.num_rows:
                w = batch.column(0).to_numpy(zero_copy_only=False) / total
                out += vector(w, batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k))
        yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], names=["m"])

    parts = rows.mapInArrow(part, "m array<double>").select(*[F.col("m")[c].alias(f"m{c}") for c in range(size)])
    return np.array(parts.agg(*[F.sum(c).alias(c) for c in parts.columns]).first(), float)


def fit_rates(members: DataFrame, spec: MixSpec) -> RateFit:
    """Projected gradient steps over all documents; no steps when there are no tokens at all."""
    total = members.agg(F.sum("n_tokens")).first()[0]
    target = np.array([spec.target[d] for d in spec.domains]) * spec.budget
    k = len(target)
    if not total:
        return RateFit([], [0.0] * k, float(np.abs(target).max()))
    rows = members.select("n_tokens", "posteriors")
    scale = np.eye(k)
    if spec.whiten:
        gram = _summed(rows, total, k, k * k, lambda w, p: ((w[:, None] * p).T @ p).ravel()).reshape(k, k)
        scale = np.linalg.inv(gram + spec.floor * np.eye(k))
    near = spec.tolerance * spec.budget
    steps: list[np.ndarray] = []
    before = None
    while True:

        def totals(w, p, done=tuple(steps)):
            r, y = rates(p, done, spec.mu)
            return np.concatenate([(w * y) @ p, (w * r) @ p])

        now = _summed(rows, total, k, 2 * k, totals)
        unmet = float(np.abs(now[k:] - target).max())
        moved = np.inf if before is None else np.abs(now[k:] - before).max()
        if unmet <= near and moved <= near or moved <= 1e-2 * near or len(steps) == spec.steps:
            return RateFit([v.tolist() for v in steps], now[k:].tolist(), unmet)
        before = now[k:]
        steps.append(scale @ (now[:k] - target))


def mix(docs: DataFrame, labelled: DataFrame, spec: MixSpec | None = None, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """(``id_col``, n_tokens, p_<domain> ..., rate, copies, unmet), one row per input row.

    ``rate`` is the fitted sampling rate, ``copies`` rounds it up or down by a hash of id and text
    with the fraction as its chance, so that it is the same on every run and copies of one text are
    rounded each for itself.  ``unmet`` is the same in every row: how far, in shares of all tokens,
    the domain total farthest from its target stays away from it.  Null and empty texts have no tokens, the posteriors of an empty row, and a rate like any other.  Repeated
    rows get equal rates; null ids pass.  With ``keep`` the columns of ``docs`` come along (columns
    of these names are replaced).  Without any tokens all rates are 1.
    """
    spec = spec or MixSpec()
    model = fit_domains(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), labelled, spec)
    bare = docs.select(id_col, text_col, F.xxhash64(text_col).alias("_h"))
    members = saved(memberships(bare.withColumn("_k", F.struct(id_col, "_h")), model, spec, "_k", text_col), "members")
    fit = fit_rates(members, spec)

    if not keep:
        return _finished(_rated(members, fit, spec), fit, spec, id_col).select(F.col(f"_k.{id_col}").alias(id_col), *_columns(spec))
    rest = without(docs, *_columns(spec))
    rows = rated_beside(rest, model, fit, spec, text_col)
    keyed = rows.withColumn("_k", F.struct(id_col, F.xxhash64(text_col).alias("_h")))
    return _finished(keyed, fit, spec, id_col).drop("_k", "posteriors")


def rated_beside(docs: DataFrame, model: DomainModel, fit: RateFit, spec: MixSpec, text_col: str) -> DataFrame:
    """``docs`` with n_tokens, posteriors and rates computed in the same pass, so that no id is needed.

    One pass, because each Python function of a stage holds a worker of its own in every running
    task, and executors keep the workers for what comes after.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, residuals = docs.columns.index(text_col), [np.array(s) for s in fit.steps]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + ["n_tokens long", "posteriors array<double>", "rate double"])

    def run(batches):
        tokens = TokenFeatures(spec.features)
        for batch in pieces(batches):
            got = [describe(t, tokens) for t in batch.column(at).to_pylist()]
            p = [shared.value.posteriors(*g[1:]).round(6) for g in got]
            more = [pa.array([g[0] for g in got], pa.int64()), pa.array(p, pa.list_(pa.float64())), pa.array(rates(np.stack(p), residuals, spec.mu)[0])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "n_tokens", "posteriors", "rate"])

    return docs.mapInArrow(run, schema)


def _columns(spec: MixSpec) -> list[str]:
    return ["n_tokens", *[f"p_{d}" for d in spec.domains], "rate", "copies", "unmet"]


def _rated(rows: DataFrame, fit: RateFit, spec: MixSpec) -> DataFrame:
    """Add the rates to rows with posteriors."""
    residuals = [np.array(s) for s in fit.steps]

    @F.pandas_udf("double")
    def rate(p):
        return p.__class__(rates(np.stack(p.to_numpy()), residuals, spec.mu)[0]) if len(p) else p.astype(float)

    return rows.withColumn("rate", rate("posteriors") if residuals else F.lit(1.0))


def _finished(rows: DataFrame, fit: RateFit, spec: MixSpec, id_col: str) -> DataFrame:
    """Add p_<domain>, copies and unmet to rows with posteriors, rates and a key ``_k`` of the id and ``_h``."""
    chance = F.pmod(F.xxhash64(F.lit("copies"), F.col("_k._h"), F.col("_k")[id_col]), F.lit(1 << 30)) / float(1 << 30)
    out = rows.withColumn("rate", F.round("rate", 6))
    out = out.withColumns({f"p_{d}": F.col("posteriors")[k] for k, d in enumerate(spec.domains)})
    out = out.withColumn("unmet", F.lit(round(fit.unmet, 9)))
    return out.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("long"))
