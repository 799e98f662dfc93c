"""Quality by hierarchical empirical Bayes: a document classifier, and what its site and path are like.

The classifier is a logistic regression on shape features of the whole text (shares of letters, capitals,
digits and signs, word lengths, repetition), fitted on a sample of at most ``SAMPLE`` labelled documents, those of smallest hash (of a
repeated id one row, that of the least features, so that the driver gets no more than these). Its
probabilities are summed per path in one grouped aggregation and per site and globally from there. A site's
mean is shrunk toward the global mean, a path's toward its site's, each with as much weight as the spread between sites
(paths) warrants: the pseudo-counts are fitted by moments, so sparse sites stay near the prior. The posterior log
odds of a document are its own plus the log odds of its path over the global ones.

Null and empty texts have all features 0 and are scored like any other. A null site or path is the site or path
named by the empty string. Without labels of both kinds every document keeps probability 1: there is nothing to
reject by. Repeated rows count each, and give a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.text import schema_of, slices, text_bytes, words
from ledgerloom.sinks import stage

SAMPLE = 20_000
RIDGE = 1.0

_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"#$%&*|@^~=<>{}[]\\/+_!")] = True
_CLASSES = np.zeros((5, 256), bool)
_CLASSES[0, list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_CLASSES[1, 65:91] = True
_CLASSES[2, 48:58] = True
_CLASSES[3] = _SIGNS
_CLASSES[4, list(b".,;:!?")] = True


def _per(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return np.diff(total[places]).astype(float)


def features(column: pa.Array) -> np.ndarray:
    """A row of features for each text."""
    raw, offsets = text_bytes(column, lower=False)
    w = words(column)
    size, count = np.maximum(1, np.diff(offsets)), np.diff(w.first)
    n = np.maximum(1, count)
    letters, capitals, digits, signs, stops = (_per(c[raw], offsets) for c in _CLASSES)
    last = raw[w.ends - 1] if len(w.ends) else np.zeros(0, np.uint8)
    long = (w.ends - w.starts).astype(float)
    same = np.concatenate(([False], w.hashes[1:] == w.hashes[:-1])) if len(w.hashes) else np.zeros(0, bool)
    distinct, top = np.zeros(len(n)), np.zeros(len(n))
    for d in np.flatnonzero(count):
        _, times = np.unique(w.hashes[w.first[d] : w.first[d + 1]], return_counts=True)
        distinct[d], top[d] = len(times) / count[d], times.max() / count[d]
    return np.column_stack(
        [
            np.log1p(count),
            letters / size,
            capitals / np.maximum(1, letters),
            digits / size,
            signs / size,
            stops / size,
            _per(_SIGNS[last], w.first) / n,
            np.diff(np.concatenate(([0.0], np.cumsum(long)))[w.first]) / n / 10,
            _per(same, w.first) / n,
            distinct,
            distinct * np.log1p(count),
            top,
        ]
    )


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, scales, weights with the constant first) of a ridge logistic regression, by Newton's method."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)])
    weights = np.zeros(z.shape[1])
    penalty = np.full(len(weights), ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        gradient = z.T @ (y - p) - penalty * weights
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), gradient)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, weights


def logits(column: pa.Array, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    mean, scale, weights = model
    z = np.clip((features(column) - mean) / scale, -8, 8)
    return np.clip(weights[0] + z @ weights[1:], -30, 30)


def train(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE):
    """The classifier, or None where the labels are not of both kinds."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("__label"))
    chosen = known.orderBy(F.xxhash64(key), key).limit(sample)  # the sample's bound is a parameter: fit to broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                x = features(part.column(text))
                yield pa.RecordBatch.from_arrays([part.column("__key"), pa.array(list(x), pa.list_(pa.float64())), part.column("__label")], ["key", "x", "y"])

    shape = T.StructType([T.StructField("key", documents.schema[key].dataType), *T.StructType.fromDDL("x array<double>, y double")])
    rows = (
        documents.select(key, text).join(F.broadcast(chosen), key).select(F.col(key).alias("__key"), text, F.col("__label").cast("double"))
        .mapInArrow(run, shape).groupBy("key", "y").agg(F.min("x").alias("x")).orderBy(F.xxhash64("key"), "key").toPandas()
    )
    y = rows["y"].to_numpy()
    if len(set(y)) < 2:
        return None
    return fit(np.array(rows["x"].tolist()), y)


def with_logit(documents: DataFrame, model, text: str, out: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the classifier's log odds."""
    columns = list(dict.fromkeys([*keep, text]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = pa.array(logits(part.column(text), model), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [found], [*keep, out])

    return documents.select(*columns).mapInArrow(run, schema_of(documents, keep, f"`{out}` double"))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _pseudo(mean: float, spread: float | None, noise: float | None) -> float:
    """The weight of a prior, in documents, by moments: between-group variance over what sampling explains."""
    between = max((spread or 0.0) - (noise or 0.0), 1e-9)
    return float(min(max(mean * (1 - mean) / between - 1, 2.0), 1e6))


def posteriors(scored: DataFrame, site: str, path: str, logit: str) -> tuple[DataFrame, float]:
    """Shrunk log odds of each (site, path) over the global ones, and the global mean. Written once: the sums are read several times."""
    p = 1 / (1 + F.exp(-F.col(logit)))
    paths = stage(
        scored.groupBy(F.coalesce(F.col(site).cast("string"), F.lit("")).alias("__site"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("__path"))
        .agg(F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(p * (1 - p)).alias("v")),
        "quality-paths",
    )
    sites = paths.groupBy("__site").agg(F.sum("n").alias("site_n"), F.sum("s").alias("site_s"), F.sum("v").alias("site_v"))
    whole = sites.agg(F.sum("site_n").alias("n"), F.sum("site_s").alias("s")).first()
    mean = min(max(whole["s"] / whole["n"], 1e-6), 1 - 1e-6) if whole["n"] else 0.5

    def moments(groups: DataFrame, n: str, s: str, center: Column | float) -> tuple[float | None, float | None]:
        m = F.col(s) / F.col(n)
        x = groups.agg(
            (F.sum(F.col(n) * (m - center) * (m - center)) / F.sum(n)).alias("spread"),
            (F.count("*") * mean * (1 - mean) / F.sum(n)).alias("noise"),
        ).first()
        return x["spread"], x["noise"]

    k_site = _pseudo(mean, *moments(sites, "site_n", "site_s", F.lit(mean)))
    joined = paths.join(sites, "__site")
    k_path = _pseudo(mean, *moments(joined, "n", "s", F.col("site_s") / F.col("site_n")))
    of_site = (F.col("site_s") + k_site * mean) / (F.col("site_n") + k_site)
    of_path = (F.col("s") + k_path * of_site) / (F.col("n") + k_path)
    return joined.select("__site", "__path", (_logit(of_path) - _logit(F.lit(mean))).alias("__shift")), mean


def score(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    site: str = "source", path: str = "lang", out: str = "quality_score", keep: list[str] | None = None, sample: int = SAMPLE,
) -> DataFrame:
    """The columns ``keep`` of ``documents`` (all, unless given) with the probability of good quality in ``out``.
    The text is read twice: for the sums per path, and for the result."""
    keep = [c for c in (keep if keep is not None else documents.columns) if c != out]
    model = train(documents, labels, key, text, label, sample)
    if model is None:
        return documents.select(*keep).withColumn(out, F.lit(1.0))
    shifts, _ = posteriors(with_logit(documents, model, text, "__logit", [site, path]), site, path, "__logit")
    need = list(dict.fromkeys([*keep, site, path]))
    own = with_logit(documents, model, text, "__logit", need)
    found = own.withColumns({"__site": F.coalesce(F.col(site).cast("string"), F.lit("")), "__path": F.coalesce(F.col(path).cast("string"), F.lit(""))}).join(
        shifts, ["__site", "__path"], "left"
    )
    odds = F.col("__logit") + F.coalesce("__shift", F.lit(0.0))
    return found.select(*keep, (1 / (1 + F.exp(-odds))).alias(out))
