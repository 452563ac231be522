"""K-fold runs of the whole chain from additive statistics.

What a fold's training part needs are sums over documents: counts of terms by class, outer products, moments. Each is
gathered once for every fold's own documents, and a training part's is the total minus its own. So the text is counted
once, turned into term counts once, and no job is repeated for each fold except the outer products, which read a
fold's own documents each.

1. Counts of all terms by class and fold give every fold's selected terms, document frequencies and IDF.
2. Documents become counts of the terms that any fold selected, stored by fold.
3. Binary weights do not depend on the fold but for which columns it has: outer products over all these columns are
   added up per fold, and each fold's PCA comes from the total minus its own. Other weights, and more columns than fit
   a matrix, are reduced fold by fold from the stored counts.
4. One pass projects every document into the space of each fold that trains on it and adds up moments by class;
   nearest means, naive Bayes and mixtures of one component are functions of them.
5. One pass scores every document with the models of its own fold.

Models that need the rows themselves (neighbours, forests, support vectors, networks) run in
``experiments.compare_models``, which gives the same numbers for those that do not.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from themata.cluster import materialise, shared_folder, spread
from themata.functions.blocks import lists, matrix
from themata.operators import centroids, dictionary as D, mixture
from themata.operators.neighbours import METRICS
from themata.operators.reduce import MATRIX_WIDTH, Projection, fit_pca, pca_of_moments
from themata.operators.weights import TRANSFORMS
from themata.operators.wide import summed
from themata.plans.experiments import GRID_SCHEMA, shown

#: Rows that are dense at once.
ROWS = 256

#: Parts of a fold's terms that are ranked on their own first.
PARTS = 64


def fold_terms(tokens: DataFrame, fold: Column, k: int, n_dims: int, label: str = "label") -> DataFrame:
    """``(fold, rank, term, var, df, idf)``: the terms that each fold's training part selects, best first.

    ``fold`` numbers each document's fold from 0; a document trains in all others. Rows with a null label or fold are
    left out.
    """
    used = tokens.withColumn("__fold", fold).where(F.col(label).isNotNull() & F.col("__fold").isNotNull())
    return _fold_terms(spread(materialise(used.select("__fold", F.col(label).alias("label"), "tokens"))), k, n_dims)


def _sizes(used: DataFrame, k: int) -> dict:
    """Documents of each label in each fold."""
    rows = used.groupBy("label", "__fold").agg(F.count(F.lit(1)).alias("n")).collect()  # classes x folds
    out = {name: np.zeros(k, int) for name in sorted({r["label"] for r in rows})}
    for r in rows:
        out[r["label"]][r["__fold"]] = r["n"]
    return out


def _fold_terms(used: DataFrame, k: int, n_dims: int) -> DataFrame:
    keyed = D.label_terms(used.withColumn("__key", F.struct("label", "__fold")), "__key")
    own = lambda c: F.array(*[F.sum(F.when(F.col("label.__fold") == f, F.col(c)).otherwise(0)) for f in range(k)])
    counts = materialise(keyed.groupBy(F.col("label.label").alias("label"), "term").agg(own("n").alias("n"), own("df").alias("df")))
    whole = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    rest = F.transform("n", lambda x, i: F.struct((whole("n") - x).alias("n"), (whole("df") - F.get("df", i)).alias("df")))
    training = counts.select("label", "term", F.posexplode(rest).alias("fold", "s")).select("label", "term", "fold", "s.n", "s.df").where("n > 0")

    docs = sum(_sizes(used, k).values(), np.zeros(k, int))
    present = np.array([(n.sum() - n) > 0 for n in _sizes(used, k).values()]).reshape(-1, k).sum(0)
    sums = counts.groupBy("label").agg(F.array(*[F.sum(F.get("n", F.lit(f))) for f in range(k)]).alias("n")).collect()
    totals = [(r["label"], f, sum(r["n"]) - r["n"][f], float(present[f]), int(docs.sum() - docs[f])) for r in sums for f in range(k)]
    totals = used.sparkSession.createDataFrame(totals, f"label {used.schema['label'].dataType.simpleString()}, fold int, total long, classes double, docs long")

    shares = training.join(F.broadcast(totals), ["label", "fold"]).withColumn("tf", F.col("n") / F.col("total"))  # classes x folds rows
    variance = D.population_variance_with_zeros(F.col("tf"), F.col("classes"))
    stats = shares.groupBy("fold", "term", "classes", "docs").agg(variance.alias("var"), F.sum("df").alias("df"))
    ranked, order = D.by_variance(stats.select("fold", "term", "var", "df", "docs"))
    for keys in (["fold", F.pmod(F.xxhash64("term"), F.lit(PARTS))], ["fold"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n_dims)
    return materialise(ranked.select("fold", "rank", "term", "var", "df", D.idf(F.col("df"), F.col("docs")).alias("idf")))


@dataclass
class FoldFeatures:
    """Counts of the terms of all folds to the weights of one: its columns, best first, and their IDF."""

    columns: np.ndarray
    idf: np.ndarray
    method: str
    entropy: np.ndarray | None = None

    def tfidf(self, counts: np.ndarray) -> np.ndarray:
        own = counts[:, self.columns]
        total = own.sum(1, keepdims=True)
        return own / np.where(total == 0, 1.0, total) * self.idf

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        w = self.tfidf(counts)
        if self.method == "binary":
            return (w > 0).astype(float)
        if self.method == "none":
            return w
        return np.log1p(w) * (1.0 if self.entropy is None else self.entropy)


@dataclass
class FoldChain:
    """Stored counts ``(doc_id, label, counts, fold)`` and what each fold's training part makes of them."""

    rows: DataFrame
    width: int
    labels: list
    sizes: dict
    features: list[FoldFeatures]
    projections: list[Projection | None]

    def __getstate__(self):
        return {**self.__dict__, "rows": None}  # tasks get the parameters, not the table

    def reduced(self, fold: int, counts: np.ndarray) -> np.ndarray:
        x, p = self.features[fold](counts), self.projections[fold]
        return x if p is None else (x - p.mean) @ p.components

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Folds, class numbers and dense counts of a bounded number of rows."""
        place = {name: i for i, name in enumerate(self.labels)}
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                own = np.array([place[name] for name in part.column(0).to_pylist()])
                yield part.column(1).to_numpy(zero_copy_only=False), own, matrix(part.column(2), self.width)


def fit_chain(tokens: DataFrame, fold: Column, k: int, n_dims: int = 3000, method: str = "binary", components: int | None = 70, label: str = "label") -> FoldChain:
    """Terms, weights and PCA (none if ``components`` is None) of every fold's training part."""
    if method not in TRANSFORMS:
        raise ValueError(f"no such transform: {method}")
    used = tokens.withColumn("__fold", fold.cast("int")).where(F.col(label).isNotNull() & F.col("__fold").isNotNull())
    used = spread(materialise(used.select("doc_id", F.col(label).alias("label"), "__fold", "tokens")))
    sizes = _sizes(used, k)
    selected = _fold_terms(used, k, n_dims).orderBy("fold", "rank").collect()  # at most k x n_dims
    if not selected:
        raise RuntimeError("no terms to train on")
    terms = sorted({r["term"] for r in selected})
    place = {t: i for i, t in enumerate(terms)}
    features = []
    for f in range(k):
        own = [r for r in selected if r["fold"] == f]
        features.append(FoldFeatures(np.array([place[r["term"]] for r in own], int), np.array([r["idf"] for r in own]), method))
    counted = CountVectorizerModel.from_vocabulary(terms, inputCol="tokens", outputCol="counts").transform(used)
    path = f"{shared_folder(tokens.sparkSession)}/themata/{uuid.uuid4().hex}"
    stored = counted.select("doc_id", "label", "counts", F.col("__fold").alias("fold"))
    stored.write.partitionBy("fold").parquet(path)
    rows = spread(tokens.sparkSession.read.schema(stored.schema).parquet(path))
    chain = FoldChain(rows, len(terms), list(sizes), sizes, features, [None] * k)
    if method == "entropy":
        _fit_entropy(chain, k)
    if components is not None:
        chain.projections = _fit_projections(chain, k, components)
    return chain


def _given(chain: FoldChain) -> DataFrame:
    return chain.rows.select("label", "fold", "counts")


def _fit_entropy(chain: FoldChain, k: int) -> None:
    """Column sums of w and of w ln w by fold, over the documents that train in it, in one pass."""
    docs = sum(chain.sizes.values())
    longest = max(len(f.columns) for f in chain.features)

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((2 * k, longest))
        for folds, _, counts in chain.blocks(batches):
            for f, own in enumerate(chain.features):
                w = own.tfidf(counts[folds != f])
                total[2 * f, : w.shape[1]] += w.sum(0)
                total[2 * f + 1, : w.shape[1]] += (w * np.log(np.where(w > 0, w, 1.0))).sum(0)
        return total

    sums = summed(_given(chain), partial, (2 * k, longest))
    for f, own in enumerate(chain.features):
        s, wlw = sums[2 * f, : len(own.columns)], sums[2 * f + 1, : len(own.columns)]
        n = int(docs.sum() - docs[f])
        safe = np.where(s > 0, s, 1.0)
        own.entropy = 1.0 + (np.where(s > 0, wlw / safe - np.log(safe), 0.0) / math.log(n) if n > 1 else 0.0)


def _fit_projections(chain: FoldChain, k: int, components: int) -> list[Projection]:
    docs = sum(chain.sizes.values())
    if chain.features[0].method != "binary" or chain.width > MATRIX_WIDTH:
        return [_fit_projection(chain, f, components) for f in range(k)]

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((chain.width + 1, chain.width))  # the last row is the sum
        for _, _, counts in chain.blocks(batches):
            x = (counts > 0).astype(np.float64)
            total[:-1] += x.T @ x
            total[-1] += x.sum(0)
        return total

    own = [summed(_given(chain).where(F.col("fold") == f), products, (chain.width + 1, chain.width)) for f in range(k)]
    whole = sum(own)
    out = []
    for f, features in enumerate(chain.features):
        rest, weighed = whole - own[f], features.idf > 0  # a term of every document has no weight
        columns = features.columns
        sums, cells = rest[-1, columns] * weighed, rest[np.ix_(columns, columns)] * np.outer(weighed, weighed)
        out.append(pca_of_moments(int(docs.sum() - docs[f]), sums, cells, components))
    return out


def _fit_projection(chain: FoldChain, fold: int, components: int) -> Projection:
    """PCA of one fold's training rows, made anew from the stored counts."""
    features, width = chain.features[fold], chain.width

    @F.arrow_udf("array<double>")
    def weigh(column: pa.Array) -> pa.Array:
        return pa.concat_arrays([lists(features(matrix(column.slice(i, ROWS), width))) for i in range(0, len(column), ROWS)] or [pa.array([], pa.list_(pa.float64()))])

    training = chain.rows.where(F.col("fold") != fold).select(weigh("counts").alias("features"))
    return fit_pca(materialise(training), components)


@dataclass
class Moments:
    """Sums by fold and class over the rows that train in the fold: rows, positive cells, x, x^2 and, if asked, x x^T."""

    counts: np.ndarray
    positive: np.ndarray
    sums: np.ndarray
    squares: np.ndarray
    products: np.ndarray | None

    def present(self, fold: int) -> np.ndarray:
        return np.flatnonzero(self.counts[fold])

    def means(self, fold: int) -> np.ndarray:
        c = self.present(fold)
        return self.sums[fold, c] / self.counts[fold, c, None]

    def covariance(self, fold: int) -> np.ndarray:
        """Of all the fold's training rows, n - 1 denominator."""
        n, total = self.counts[fold].sum(), self.sums[fold].sum(0)
        return (self.products[fold].sum(0) - np.outer(total, total) / n) / (n - 1)


def fold_moments(chain: FoldChain, products: bool) -> Moments:
    k, classes = len(chain.features), len(chain.labels)
    widths = [len(f.columns) if p is None else p.components.shape[1] for f, p in zip(chain.features, chain.projections)]
    width = max(widths)
    if products and width > mixture.MAX_FULL_WIDTH:
        raise ValueError(f"full covariances wider than {mixture.MAX_FULL_WIDTH} columns: give a number of components")
    length = 2 + 2 * width + (width * width if products else 0)

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((k * classes, length))
        for folds, own, counts in chain.blocks(batches):
            for f in range(k):
                train = folds != f
                x, y = chain.reduced(f, counts[train]), own[train]
                if x.shape[1] < width:
                    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
                for c in np.unique(y):
                    z = x[y == c]
                    parts = [[len(z), (z > 0).sum()], z.sum(0), (z * z).sum(0)] + ([(z.T @ z).ravel()] if products else [])
                    total[f * classes + c] += np.concatenate(parts)
        return total

    found = summed(_given(chain), partial, (k * classes, length)).reshape(k, classes, length)
    outer = found[:, :, 2 + 2 * width :].reshape(k, classes, width, width) if products else None
    return Moments(found[:, :, 0], found[:, :, 1], found[:, :, 2 : 2 + width], found[:, :, 2 + width : 2 + 2 * width], outer)


def needs_products(params: dict) -> bool:
    full = params["method"] == "GMM" and params.get("covariance_type", "full") == "full"
    return full or params.get("metric") == "mahalanobis"


def fold_model(chain: FoldChain, moments: Moments, fold: int, params: dict):
    """The classifier of one fold from its moments."""
    method, rest = params["method"], {name: v for name, v in params.items() if name != "method"}
    present = moments.present(fold)
    labels, n, means = [chain.labels[c] for c in present], moments.counts[fold, present], moments.means(fold)
    variances = np.maximum(moments.squares[fold, present] / n[:, None] - means**2, 0.0)
    if method == "MEAN" and rest.get("V") is None and rest.get("metric", "cosine") in METRICS:
        metric = rest.get("metric", "cosine")
        return centroids.CentroidModel(labels, means, metric, moments.covariance(fold) if metric == "mahalanobis" else None)
    if method == "NB":
        shares = n if rest.get("prior", "rows") == "rows" else moments.positive[fold, present]
        return centroids.gnb_model(labels, means, variances, shares / n.sum())
    if method == "GMM" and rest.get("n_components") == 1:
        reg, kind = rest.get("reg_covar", mixture.REG_COVAR), rest.get("covariance_type", "full")
        if kind == "diag":
            return mixture.MixtureModel(kind, {name: [(1.0, m, v + reg)] for name, m, v in zip(labels, means, variances)}, means.shape[1])
        if kind == "full":
            spread = [mixture._inverse_root(moments.products[fold, c] / moments.counts[fold, c] - np.outer(m, m), reg) for c, m in zip(present, means)]
            return mixture.MixtureModel(kind, {name: [(1.0, m, s)] for name, m, s in zip(labels, means, spread)}, means.shape[1])
    raise ValueError(f"not a function of moments, use compare_models: {shown(params)}")


def fold_scores(chain: FoldChain, models: list[dict]) -> DataFrame:
    """``(fold, run_id, method, params, accuracy)`` of every model on every fold's own documents; the parameter sets
    as for ``parameter_grid``. Folds without documents give no rows."""
    moments = fold_moments(chain, any(map(needs_products, models)))
    k = len(chain.features)
    fitted = [[fold_model(chain, moments, f, params) for params in models] for f in range(k)]
    place = {name: i for i, name in enumerate(chain.labels)}

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((k, 1 + len(models)))
        for folds, own, counts in chain.blocks(batches):
            for f in np.unique(folds):
                mine = folds == f
                x, y = chain.reduced(f, counts[mine]), own[mine]
                total[f, 0] += len(y)
                for i, model in enumerate(fitted[f]):
                    names = sorted(model.parts) if isinstance(model, mixture.MixtureModel) else model.labels
                    codes = np.array([place[name] for name in names])
                    total[f, 1 + i] += (codes[model.scorer()(x).argmax(1)] == y).sum()
        return total

    found = summed(_given(chain), partial, (k, 1 + len(models)))
    out = []
    for f in range(k):
        for i, params in enumerate(models if found[f, 0] else []):
            arguments = {name: v for name, v in params.items() if name != "method"}
            out.append((f, i, params["method"], shown(arguments), float(found[f, 1 + i] / found[f, 0])))
    return chain.rows.sparkSession.createDataFrame(out, f"fold int, {GRID_SCHEMA}")
