"""Toxicity by a classifier chain of linear models.

The categories are label columns, in chain order. Each has a logistic model over
hashed words and word beginnings that are present in a text, and over the
probabilities of the categories before it. A later model is trained on out-of-fold
probabilities of the earlier ones (each fold predicted by a model that did not see
it), so that it meets in training what it meets in use. The decision threshold is the
one of the best F1 on out-of-fold probabilities of the last category.

Models are fitted on a bounded sample of the labelled documents: those with the
smallest hashes, about CLASS_ROWS of each combination of labels. A sampled row weighs as
many rows of its combination as it stands for, in the features' likelihood ratios, the
models' loss and the F1 of the threshold. Features are counted
in Spark, and at most FEATURES of each category, those with the largest likelihood ratio, stay;
the rows that reach the driver hold only those. Scoring covers every whole text.

Nulls, empties, ties, repeats: a null text is empty and gets the models' base rates; a
document with a null label teaches the other categories only; of repeated labels of a
document the largest counts; each repeated document is scored; without labels
every probability is 0 and nothing is toxic; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import materialise, prepare
from aerolake.llm.textops import chunks, word_features

#: Label columns of the chain, in order; the last one decides.
CATEGORIES = ("quality", "toxic")
#: Bytes of word beginnings that are features.
PREFIXES = (4, 5, 6, 7, 8)
#: Labelled documents of each combination of labels, and features of each category.
CLASS_ROWS, FEATURES = 4000, 1024
FOLDS, RIDGE, STEPS, SOLVER_STEPS = 5, 0.3, 12, 40
#: Fewest labelled documents that hold a feature, and its least log-likelihood ratio.
LEAST_ROWS, LEAST_RATIO = 3, 8.0


@dataclass
class Link:
    """The model of one category."""

    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    earlier: np.ndarray  # weights of the earlier categories' log-odds
    bias: float


@dataclass
class Chain:
    links: list[Link]
    features: np.ndarray  # all hashes, sorted
    threshold: float

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """(texts, categories)."""
        place, owner = present(texts, self.features)
        return self.predict(place, owner, len(texts))

    def predict(self, place: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, len(self.links)))
        for j, link in enumerate(self.links):
            weights = np.zeros(len(self.features))
            weights[np.searchsorted(self.features, link.features)] = link.weights
            z = link.bias + np.bincount(owner, weights=weights[place], minlength=n)
            if j:
                z += _odds(out[:, :j]) @ link.earlier
            out[:, j] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def present(texts: list[str | None], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``features``, text) of each feature that a text has, once."""
    bits = np.uint64(44)  # the leading 20 bits
    mask = np.zeros(1 << 20, dtype=bool)
    mask[features >> bits] = True
    places, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in chunks(texts):
        h, owner = word_features(texts[a:b], PREFIXES)
        k = np.flatnonzero(mask[h >> bits])
        h, owner = h[k], owner[k]
        at = np.searchsorted(features, h)
        at[at == len(features)] = 0
        k = np.flatnonzero(features[at] == h) if len(features) else np.zeros(0, np.int64)
        pairs = np.unique((owner[k] + a) * len(features) + at[k])
        places.append(pairs % max(1, len(features)))
        owners.append(pairs // max(1, len(features)))
    return np.concatenate(places), np.concatenate(owners)


def fit_logistic(place, owner, extra, y, n_features: int,
                 weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Ridge logistic regression on present features and dense extra columns.

    Newton steps, each solved by conjugate gradients and halved until the loss falls.
    ``weight``: rows that a row counts for, 1 if not given.
    """
    n = len(y)
    weight = np.ones(n) if weight is None else weight
    every, ones = weight.sum(), weight @ y
    ridge = np.full(n_features + extra.shape[1] + 1, RIDGE)
    ridge[-1] = 1e-6

    def times(w):  # X w
        return (w[-1] + np.bincount(owner, weights=w[place], minlength=n)
                + extra @ w[n_features:-1])

    def turned(r):  # X' r
        return np.concatenate([np.bincount(place, weights=r[owner], minlength=n_features),
                               extra.T @ r, [r.sum()]])

    def loss(w, z):
        return weight @ (np.logaddexp(0, z) - y * z) + (ridge * w) @ w / 2

    w = np.zeros(len(ridge))
    w[-1] = np.log((ones + 0.5) / (every - ones + 0.5))
    z = times(w)
    now = loss(w, z)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        gradient = turned(weight * (p - y)) + ridge * w
        size = np.sqrt(gradient @ gradient)
        if size < 1e-6 * every:
            break
        curve, step, rest = weight * p * (1 - p), np.zeros_like(w), -gradient
        way, square = rest.copy(), gradient @ gradient
        for _ in range(SOLVER_STEPS):
            bent = turned(curve * times(way)) + ridge * way
            far = square / (way @ bent)
            step, rest = step + far * way, rest - far * bent
            square, old = rest @ rest, square
            if square < 1e-4 * size ** 2:
                break
            way = rest + square / old * way
        moved, factor = times(step), 1.0
        while factor > 1e-4 and loss(w + factor * step, z + factor * moved) > now:
            factor /= 2
        w, z = w + factor * step, z + factor * moved
        now = loss(w, z)
    return w[:n_features], w[n_features:-1], float(w[-1])


def sample_labelled(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """text, fold, labels (array of 0, 1 or null) and weight of the bounded sample.

    Weights are rounded to multiples of 1/1024, of which sums are exact in any order.
    """
    known = labels.groupBy("doc_id").agg(
        *(F.max(F.col(c).cast("int")).alias(c) for c in categories))
    known = known.where(F.col("doc_id").isNotNull())
    known = materialise(known.select(
        "doc_id", F.xxhash64(F.lit("toxicity"), "doc_id").alias("order"),
        F.array(*categories).alias("labels"),
        F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in categories))
        .alias("combination")), "labels")
    sizes = known.groupBy("combination").agg(F.count("*").alias("n"))
    chosen = (known.join(F.broadcast(sizes), "combination")  # a row for each combination
              .where(F.expr("pmod(order, 1000003) / 1000003.0") <= CLASS_ROWS / F.col("n"))
              .select("doc_id", (F.expr("pmod(order, 1000033)") % FOLDS).cast("int").alias("fold"),
                      "labels", "combination", "n"))
    taken = chosen.groupBy("combination").agg(F.count("*").alias("taken"))
    chosen = chosen.join(F.broadcast(taken), "combination").select(
        "doc_id", "fold", "labels",
        (F.round(F.col("n") / F.col("taken") * 1024) / 1024).alias("weight"))
    # About CLASS_ROWS ids of each combination of labels, of which there are 3 to the power of
    # the number of categories at most: a bound that does not depend on the tables.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text", "fold", "labels", "weight")


def count_features(sample: DataFrame, n_categories: int) -> DataFrame:
    """feature, for each category its sampled rows with a known label, and the weight of
    those without and with it."""
    names = [f"{kind}{j}" for j in range(n_categories) for kind in ("rows", "no", "yes")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts, labels = batch.column("text").to_pylist(), batch.column("labels").to_pylist()
            weight = batch.column("weight").to_numpy()
            for a, b in chunks(texts, 1 << 20):
                h, owner = word_features(texts[a:b], PREFIXES)
                order = np.lexsort((owner, h))
                h, owner = h[order], owner[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                h, owner = h[new], owner[new]
                at = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint64(1)))
                cols = [pa.array(h[at].view(np.int64))]
                for j in range(n_categories):
                    label = np.array([np.nan if row[j] is None else row[j] for row in labels[a:b]])
                    for each in (~np.isnan(label) * 1.0, (label == 0) * weight[a:b],
                                 (label == 1) * weight[a:b]):
                        cols.append(pa.array(np.add.reduceat(each[owner], at) if len(at)
                                             else np.zeros(0)))
                yield pa.RecordBatch.from_arrays(cols, names=["feature", *names])

    schema = "feature long, " + ", ".join(f"{n} double" for n in names)
    return (sample.select("text", "labels", "weight").mapInArrow(run, schema).groupBy("feature")
            .agg(*(F.sum(n).alias(n) for n in names)))


def choose_features(counts: DataFrame, sizes: list[tuple[float, float]],
                    sampled: list[int]) -> list[np.ndarray]:
    """For each category the features of the largest likelihood ratio, sorted by hash.

    ``sizes``: weights of the rows without and with the label; ``sampled``: those rows. The
    least ratio is asked of as much evidence as was sampled, not of what it stands for.
    """
    def part(k, n, total, share):
        return F.when(k > 0, k * F.log(k / (n * (total / share)))).otherwise(0.0)

    out = []
    for j, (no, yes) in enumerate(sizes):
        if not no or not yes:
            out.append(np.zeros(0, dtype=np.uint64))
            continue
        a, b = F.col(f"yes{j}"), F.col(f"no{j}")
        n, every = a + b, no + yes
        ratio = (part(a, n, yes, every) + part(b, n, no, every)
                 + part(yes - a, F.lit(every) - n, yes, every)
                 + part(no - b, F.lit(every) - n, no, every))
        best = (counts.where(F.col(f"rows{j}") >= LEAST_ROWS).select("feature", ratio.alias("ratio"))
                .where(F.col("ratio") * (sampled[j] / every) >= LEAST_RATIO)
                .orderBy(F.desc("ratio"), "feature").limit(FEATURES).collect())
        out.append(np.sort(np.array([r["feature"] for r in best], dtype=np.int64).view(np.uint64)))
    return out


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> Chain | None:
    """Fit the chain on ``docs`` (doc_id, text) and ``labels`` (doc_id, categories)."""
    prepare(docs.sparkSession)
    sample = materialise(sample_labelled(docs, labels, categories), "labelled")
    n = len(categories)
    label = [F.col("labels")[j] for j in range(n)]
    totals = sample.agg(
        *(F.sum(F.when(label[j] == v, F.col("weight")).otherwise(0.0)).alias(f"{j}_{v}")
          for j in range(n) for v in (0, 1)),
        *(F.count(label[j]).alias(f"rows{j}") for j in range(n))).first()
    sizes = [(totals[f"{j}_0"], totals[f"{j}_1"]) for j in range(n)]
    if not any(no and yes for no, yes in sizes):
        return None
    chosen = choose_features(materialise(count_features(sample, n), "feature-counts"), sizes,
                             [totals[f"rows{j}"] for j in range(n)])
    union = np.unique(np.concatenate(chosen))

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            place, owner = present(batch.column("text").to_pylist(), union)
            order = np.argsort(owner, kind="stable")
            ends = np.searchsorted(owner[order], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends), pa.array(place[order].astype(np.int32))),
                 batch.column("fold"), batch.column("labels"), batch.column("weight")],
                names=["place", "fold", "labels", "weight"])

    # At most CLASS_ROWS rows of each combination of labels, and FEATURES numbers a category.
    data = (sample.mapInArrow(rows, "place array<int>, fold int, labels array<int>, weight double")
            .orderBy("fold", F.hash("place", "labels")).toArrow())
    counts = np.array([len(p) for p in data.column("place")])
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.concatenate([np.zeros(0, np.int64), *(np.asarray(p.values) for p in data.column("place"))])
    fold, weight = data.column("fold").to_numpy(), data.column("weight").to_numpy()
    y = np.array([[np.nan if v is None else v for v in row] for row in
                  data.column("labels").to_pylist()], dtype=float).reshape(-1, n)
    links: list[Link] = []
    held = np.zeros((len(y), n))
    for j in range(n):
        features = chosen[j]
        local = np.searchsorted(features, union)
        local[local == len(features)] = 0
        mine = (features[local] == union if len(features) else np.zeros(len(union), bool))[place]
        p_all, o_all = local[place[mine]], owner[mine]
        extra = _odds(held[:, :j])
        known = ~np.isnan(y[:, j])
        rate = np.average(y[known, j], weights=weight[known]) if known.any() else 0.0

        def train(use):
            at = np.cumsum(use) - 1
            rows_ = use[o_all]
            return fit_logistic(p_all[rows_], at[o_all[rows_]], extra[use], y[use, j], len(features),
                                weight[use])

        if sizes[j][0] and sizes[j][1]:
            for f in range(FOLDS):
                w, e, b = train(known & (fold != f))
                z = b + np.bincount(o_all, weights=w[p_all], minlength=len(y)) + extra @ e
                held[fold == f, j] = (1 / (1 + np.exp(-np.clip(z, -30, 30))))[fold == f]
            w, e, b = train(known)
        else:
            held[:, j] = rate
            w, e, b = np.zeros(len(features)), np.zeros(j), float(_odds(np.array(rate)))
        links.append(Link(features, w, e, b))
    return Chain(links, union, best_threshold(held[:, -1], y[:, -1], weight))


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> float:
    """The middle of the gap below the last probability of the best F1."""
    known = ~np.isnan(y)
    weight = np.ones(len(p)) if weight is None else weight
    p, y, weight = p[known], y[known], weight[known]
    if not y.sum():
        return 1.0
    order = np.argsort(-p, kind="stable")
    p, y, weight = p[order], y[order], weight[order]
    hits = np.cumsum(weight * y)
    f1 = 2 * hits / (np.cumsum(weight) + hits[-1])
    f1[:-1][p[:-1] == p[1:]] = 0  # equal probabilities go together
    k = int(np.argmax(f1))
    return float((p[k] + (p[k + 1] if k + 1 < len(p) else 0.0)) / 2)


def score(docs: DataFrame, chain: Chain | None, categories: tuple[str, ...] = CATEGORIES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a probability p_<category> for each category, and whether toxic."""
    spark = docs.sparkSession
    prepare(spark)
    shared, n = spark.sparkContext.broadcast(chain), len(categories)
    names = ["doc_id", *(f"p_{c}" for c in categories), "toxic"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        chain = shared.value
        for batch in batches:
            if chain is None:
                p, toxic = np.zeros((batch.num_rows, n)), np.zeros(batch.num_rows, dtype=bool)
            else:
                p = chain.probabilities(batch.column("text").to_pylist())
                toxic = p[:, -1] >= chain.threshold
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(p[:, j]) for j in range(n)), pa.array(toxic)],
                names=names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, " + "".join(
        f"p_{c} double, " for c in categories) + "toxic boolean")


def classify(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES,
             id_col: str = "doc_id", text_col: str = "text",
             label_id_col: str = "doc_id") -> DataFrame:
    """Fit on the labelled documents and score all of them."""
    chain = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                labels.select(F.col(label_id_col).alias("doc_id"), *categories), categories)
    return score(docs, chain, categories, id_col, text_col)
