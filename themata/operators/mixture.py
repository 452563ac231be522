"""One Gaussian mixture per class."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from themata.cluster import materialise
from themata.functions.blocks import CHUNK_ROWS, as_vector, best_class, matrix, width_of
from themata.operators.centroids import features_of


REG_COVAR = 1e-6

#: Columns up to which a task holds a full matrix for each class and component.
MAX_FULL_WIDTH = 1024


def _log_normal(x: np.ndarray, mean: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Log density under covariance S, ``half`` = L with S^-1 = L L^T."""
    centred = (x - mean) @ half
    return np.log(np.abs(np.diag(half))).sum() - 0.5 * (len(mean) * np.log(2 * np.pi) + (centred**2).sum(1))


def _log_diag(x: np.ndarray, mean: np.ndarray, var: np.ndarray) -> np.ndarray:
    return -0.5 * (np.log(2 * np.pi * var).sum() + ((x - mean) ** 2 / var).sum(1))


@dataclass
class MixtureModel:
    """``parts[label]`` lists (weight, mean, spread): spread is L (full) or the variances (diag)."""

    kind: str
    parts: dict
    width: int
    history: list = field(default_factory=list)

    def scorer(self, score: str = "components"):
        """Function from a block of rows to rows x classes. ``components``: sum over components of the log density,
        without weights or priors; ``mixture``: weighted log-sum-exp."""
        if score not in ("components", "mixture"):
            raise ValueError(f"no such score: {score}")
        labels = sorted(self.parts)
        parts, density = self.parts, _log_normal if self.kind == "full" else _log_diag

        def scores(x: np.ndarray) -> np.ndarray:
            out = []
            for label in labels:
                logs = np.stack([density(x, m, s) for _, m, s in parts[label]], axis=1)
                if score == "components":
                    out.append(logs.sum(1))
                else:
                    out.append(np.logaddexp.reduce(logs + np.log([w for w, _, _ in parts[label]]), axis=1))
            return np.stack(out, axis=1)

        return scores

    def predict(self, df: DataFrame, column: str = "features", score: str = "components") -> DataFrame:
        """Add ``prediction``, the class of the largest score."""
        return df.withColumn("prediction", best_class(features_of(df, column), self.width, self.scorer(score), sorted(self.parts)))


def _inverse_root(covariance_: np.ndarray, reg_covar: float = REG_COVAR) -> np.ndarray:
    """Triangular L with (S + reg_covar I)^-1 = L L^T, also where S is singular up to rounding."""
    values, axes = np.linalg.eigh(covariance_)
    return np.linalg.qr((axes / np.sqrt(np.maximum(values, 0.0) + reg_covar)).T, mode="r").T


def _labels(df: DataFrame, label: str) -> list:
    return sorted(r[0] for r in df.select(label).distinct().collect())


def fit_gmm_full(
    df: DataFrame, n_components: int = 5, max_iter: int = 100, tol: float = 1e-3, reg_covar: float = REG_COVAR,
    seed: int = 0, column: str = "features", label: str = "label",
) -> MixtureModel:
    """Full covariances by EM. ``reg_covar`` on their diagonals keeps them regular where a component has fewer
    rows than dimensions, at which ``pyspark.ml``'s mixtures fail."""
    return _fit("full", df, n_components, max_iter, tol, reg_covar, seed, column, label)


def fit_gmm_diag(
    df: DataFrame, n_components: int = 5, max_iter: int = 100, tol: float = 1e-3, reg_covar: float = REG_COVAR,
    seed: int = 0, column: str = "features", label: str = "label",
) -> MixtureModel:
    """Diagonal covariances by EM (Spark itself has full only)."""
    return _fit("diag", df, n_components, max_iter, tol, reg_covar, seed, column, label)


def fit_path(
    kind: str, df: DataFrame, sizes: list[int], max_iter: int = 100, tol: float = 1e-3, reg_covar: float = REG_COVAR,
    seed: int = 0, column: str = "features", label: str = "label",
) -> dict[int, MixtureModel]:
    """Mixtures of several sizes over one stage table. The smallest starts from k-means, each further one from the one
    before, of which the heaviest components are split along their longest axis until there are enough."""
    data = _staged(df, column, label)
    width = _checked_width(kind, data)
    blocks = _packed(data, width)
    out: dict[int, MixtureModel] = {}
    for size in sorted(set(sizes)):
        if out:
            parts = {name: grown(kind, part, size) for name, part in out[max(out)].parts.items()}
        else:
            parts = _start(data, size, width, seed)
        out[size] = _improve(kind, blocks, width, parts, max_iter, tol, reg_covar)
    return out


def grown(kind: str, parts: list, size: int) -> list:
    """``parts`` with the heaviest components halved until there are ``size``."""
    parts = list(parts)
    while len(parts) < size:
        weight, mean, spread = parts.pop(max(range(len(parts)), key=lambda i: parts[i][0]))
        if kind == "full":
            values, axes = np.linalg.eigh(spread @ spread.T)  # of the inverse, so the longest axis comes first
            off = axes[:, 0] / np.sqrt(values[0])
        else:
            off = np.where(np.arange(len(mean)) == np.argmax(spread), np.sqrt(spread), 0.0)
        parts += [(weight / 2, mean - off / 2, spread), (weight / 2, mean + off / 2, spread)]
    return parts


def _fit(kind: str, df: DataFrame, n_components: int, max_iter: int, tol: float, reg_covar: float, seed: int,
         column: str, label: str) -> MixtureModel:
    """EM from k-means."""
    data = _staged(df, column, label)
    width = _checked_width(kind, data)
    return _improve(kind, _packed(data, width), width, _start(data, n_components, width, seed), max_iter, tol, reg_covar)


def _staged(df: DataFrame, column: str, label: str) -> DataFrame:
    return materialise(df.select(F.col(label).alias("label"), features_of(df, column).alias("x")))


def _packed(data: DataFrame, width: int) -> DataFrame:
    """Rows of a class in blocks of at most ``CHUNK_ROWS``, their cells as bytes, which steps read without unpacking lists."""

    def pack(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(begin, CHUNK_ROWS)
                names, block = np.array(part.column(0).to_pylist()), matrix(part.column(1), width)
                found = list(dict.fromkeys(names.tolist()))
                blocks = [block[names == name].tobytes() for name in found]
                yield pa.RecordBatch.from_arrays([pa.array(found, part.schema.field(0).type), pa.array(blocks, pa.binary())], ["label", "x"])

    kind = data.schema["label"].dataType.simpleString()
    return materialise(data.select("label", "x").mapInArrow(pack, f"label {kind}, x binary"))


def _checked_width(kind: str, data: DataFrame) -> int:
    width = width_of(data, "x")
    if kind == "full" and width > MAX_FULL_WIDTH:
        raise ValueError(f"full covariances wider than {MAX_FULL_WIDTH} columns: select or reduce terms first")
    return width


def _start(data: DataFrame, n_components: int, width: int, seed: int) -> dict:
    """Centres by k-means for each class."""
    start = data.select("label", as_vector(data, "x").alias("v"))
    parts = {}
    for name in _labels(data, "label"):
        if n_components == 1:  # k-means starts at two; the first step then takes the class mean
            parts[name] = ("hard", np.zeros((1, width)))
            continue
        fitted = KMeans(k=n_components, featuresCol="v", seed=seed, maxIter=20).fit(start.where(F.col("label") == name))
        parts[name] = ("hard", np.array(fitted.clusterCenters()))
    return parts


def _improve(kind: str, blocks: DataFrame, width: int, parts: dict, max_iter: int, tol: float, reg_covar: float) -> MixtureModel:
    """EM, all classes in one job per step.

    A step broadcasts the parameters, each task sums responsibilities over bounded blocks, and a
    shuffle adds up the partial sums. Every step reads the same stage table of blocks, so no lineage grows.
    """
    history, previous = [], -np.inf
    for _ in range(max_iter + 1):
        sums, log_likelihood, rows = _expect(blocks, width, parts, kind)
        old, parts = parts, {}
        for name, (r, rx, rxx) in sums.items():
            alive = np.flatnonzero(r > 1e-12)
            mean = rx[alive] / r[alive, None]
            if kind == "full":  # the sums are of differences from the step's centres
                centres = _centres(old[name])[alive]
                spread = [_inverse_root(rxx[c] / r[c] - np.outer(m, m), reg_covar) for c, m in zip(alive, mean)]
                mean = mean + centres
            else:
                spread = np.maximum(rxx[alive] / r[alive, None] - mean**2, 0.0) + reg_covar
            parts[name] = list(zip(r[alive] / r.sum(), mean, spread))
        if log_likelihood is not None:
            history.append(log_likelihood / rows)
            if abs(history[-1] - previous) < tol:
                break
            previous = history[-1]
    return MixtureModel(kind, parts, width, history)


def _centres(part) -> np.ndarray:
    return part[1] if part[0] == "hard" else np.array([m for _, m, _ in part])


def _expect(blocks: DataFrame, width: int, parts: dict, kind: str):
    """Sums of r, r x, r x^2 per class and component, the log likelihood and the row count. For full covariances
    x is taken from the component's centre and x^2 is the outer product."""
    order = sorted(parts)
    full, density = kind == "full", _log_normal if kind == "full" else _log_diag
    shape = (width, width) if full else (width,)

    def partial(batches):
        sums, totals = {}, [0.0, 0]
        for batch in batches:
            for name, cells_ in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(cells_.as_buffer()).reshape(-1, width)
                centres = _centres(parts[name])
                if parts[name][0] == "hard":
                    near = np.stack([((x - c) ** 2).sum(1) for c in centres], axis=1).argmin(1)
                    share = np.eye(len(centres))[near]
                else:
                    logs = np.stack([np.log(w) + density(x, m, s) for w, m, s in parts[name]], axis=1)
                    norm = np.logaddexp.reduce(logs, axis=1)
                    share = np.exp(logs - norm[:, None])
                    totals[0] += norm.sum()
                totals[1] += len(x)
                if full:
                    off = [x - c for c in centres]
                    new = (
                        share.sum(0), np.stack([r @ y for r, y in zip(share.T, off)]),
                        np.stack([(y * r[:, None]).T @ y for r, y in zip(share.T, off)]),
                    )
                else:
                    new = (share.sum(0), share.T @ x, share.T @ (x * x))
                old = sums.get(name)
                sums[name] = new if old is None else tuple(a + b for a, b in zip(old, new))
        out = [(-1, -1, np.array([totals[0], float(totals[1])]))] if totals[1] else []
        for name, (r, rx, rxx) in sums.items():
            out += [(order.index(name), c, np.concatenate(([r[c]], rx[c], rxx[c].ravel()))) for c in range(len(r))]
        for k, c, values in out:  # one component's sums at a time
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([c], pa.int32()), pa.array([values], pa.list_(pa.float64()))], ["k", "c", "s"]
            )

    cells = blocks.mapInArrow(partial, "k int, c int, s array<double>")
    summed = cells.groupBy("k", "c").agg(Summarizer.sum(array_to_vector("s")).alias("s"))
    counts = {n: len(_centres(parts[n])) for n in order}
    out = {n: (np.zeros(counts[n]), np.zeros((counts[n], width)), np.zeros((counts[n], *shape))) for n in order}
    log_likelihood, rows = 0.0, 0
    for row in summed.toLocalIterator():  # classes x components rows
        values = row["s"].toArray()
        if row["k"] < 0:
            log_likelihood, rows = values
            continue
        r, rx, rxx = out[order[row["k"]]]
        r[row["c"]], rx[row["c"]] = values[0], values[1 : width + 1]
        rxx[row["c"]] = values[width + 1 :].reshape(shape)
    hard = any(p[0] == "hard" for p in parts.values())
    return out, None if hard else log_likelihood, rows
