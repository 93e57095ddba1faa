"""Toxicity by cumulative-link ordinal regression on sparse words.

Grades are ordered; one weight per word is shared by all thresholds:
``P(grade >= k) = sigmoid(w . x - t_k)``, with ``t_1 < t_2 < ...``.  A text's
score is its expected grade, the sum of these probabilities.

The model is fitted on at most ``max_rows`` labelled documents.  Where there
are more, every language and grade gives as many as it has up to one common
number (those with the least hash of their id), and a row of a stratum that is
not whole weighs as many rows as it stands for.  Near copies count once
together: a row weighs one over the number of rows with its least word-shingle
hash.  Features are the words and word beginnings (of 5 and 7 letters) whose
rate of graded rows departs from that of their language, within one language
or over all of them, by at least ``min_z`` standard errors; that gate is low,
and the penalty of the fit weighs what passes it.  A feature's value is its
damped frequency, ``SCALE * count / (words + DAMP)``, so that long texts do
not become severe by containing everything once.

Grade 2 stands for "toxic and of low quality" where it comes from ``grades``:
the labels say no more about severity, so the upper threshold separates these
two kinds of labels and no finer degrees.

Defined results: a null text is empty; a text without known features has the
base severity; labels without a grade are not used; of several labels of a
document the highest holds; with no usable labels every severity is 0; a null
language, or documents without that column, are one language; repeated rows
are rated each; an empty table gives no rows; extra columns are ignored by
``rate_documents`` and kept by ``keep_civil``, whatever their names.  A very
long text is rated whole; its words are held as a list.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.llm._shared import by_bytes, cut, free_name, frugal, local_table

#: Letters of the word beginnings that are features beside whole words.
BEGINNINGS = (5, 7)
SCALE, DAMP = 200.0, 100.0
#: Words whose weight a worker remembers before it starts afresh.
REMEMBERED = 100_000

_words = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _words.findall(text.lower())


def features(word: str) -> list[str]:
    """The word, and its beginnings marked by a star."""
    return [word, *[word[:k] + "*" for k in BEGINNINGS if len(word) >= k]]


class _WordWeights(dict):
    """Sum of the weights of each word's features, worked out once."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = sum(self.weights.get(x, 0.0) for x in features(word))
        return value


@dataclass
class OrdinalModel:
    """Weights of features, and thresholds in ascending order."""

    weights: dict[str, float]
    thresholds: list[float]

    def scores(self, texts: Iterable[str]) -> list[float]:
        """Expected grade of each text."""
        known, out = _WordWeights(self.weights), []
        for text in texts:
            found = words(text)
            x = SCALE * math.fsum(map(known.__getitem__, found)) / (len(found) + DAMP) if self.weights else 0.0
            out.append(sum(1 / (1 + math.exp(-max(-500.0, min(500.0, x - t)))) for t in self.thresholds))
        return out


def grades(toxic: Column, quality: Column) -> Column:
    """0: not toxic; 1: toxic; 2: toxic and of low quality.  Null where toxic is null."""
    return F.when(toxic == 0, 0).when((toxic == 1) & (F.coalesce(quality, F.lit(1)) == 0), 2).when(toxic == 1, 1)


def fit_links(rows: list[list[tuple[int, float]]], y: np.ndarray, weight: np.ndarray, n_features: int, n_grades: int, penalty: float = 0.02, steps: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """Weighted maximum likelihood with a quadratic penalty, by full-batch Adam steps from a fixed start."""
    lengths = [len(r) for r in rows]
    at = np.repeat(np.arange(len(rows)), lengths)
    column = np.array([c for r in rows for c, _ in r], np.int64)
    value = np.array([v for r in rows for _, v in r])
    total = weight.sum()
    above = [np.clip((weight * (y >= k)).sum() / total, 1e-4, 1 - 1e-4) for k in range(1, n_grades)]
    t = [-math.log(p / (1 - p)) for p in above]
    # Thresholds are a first one and logarithms of gaps, so they stay in order.
    z = np.concatenate((np.zeros(n_features), t[:1], [math.log(max(b - a, 1e-2)) for a, b in zip(t, t[1:], strict=False)]))
    m, v = np.zeros_like(z), np.zeros_like(z)
    sigmoid = lambda a: 1 / (1 + np.exp(-np.clip(a, -500, 500)))
    for step in range(1, steps + 1):
        w, gaps = z[:n_features], np.exp(z[n_features + 1 :])
        theta = z[n_features] + np.concatenate(([0.0], np.cumsum(gaps)))
        x = np.bincount(at, w[column] * value, minlength=len(rows))
        p = np.concatenate((np.ones((len(rows), 1)), sigmoid(x[:, None] - theta), np.zeros((len(rows), 1))), axis=1)
        slope = p * (1 - p)
        mass = np.maximum(p[np.arange(len(rows)), y] - p[np.arange(len(rows)), y + 1], 1e-12)
        dx = -weight * (slope[np.arange(len(rows)), y] - slope[np.arange(len(rows)), y + 1]) / mass
        dt = np.zeros(len(theta))
        for k in range(len(theta)):
            own, below = y == k + 1, y == k
            dt[k] = (weight * slope[:, k + 1] / mass * (own.astype(float) - below)).sum()
        gradient = np.concatenate((np.bincount(column, dx[at] * value, minlength=n_features) + penalty * w, [dt.sum()], [dt[k + 1 :].sum() * g for k, g in enumerate(gaps)]))
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        z = z - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return z[:n_features], z[n_features] + np.concatenate(([0.0], np.cumsum(np.exp(z[n_features + 1 :]))))


_SAMPLED = "grade int, lang string, share double, bucket long, features array<string>, amounts array<double>"


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for whole in batches:
        for batch in by_bytes(whole, 3, 500_000):  # the features of a text take many times its bytes
            out: list[list] = [[], [], []]
            for text in batch.column(3).to_pylist():
                found = words(text)
                shingles = (" ".join(found[k : k + 5]) for k in range(max(1, len(found) - 4)))
                counts: Counter[str] = Counter()
                for word, n in Counter(found).items():
                    for feature in features(word):
                        counts[feature] += n
                amounts = [SCALE * n / (len(found) + DAMP) for n in counts.values()]
                for column, x in zip(out, (min(map(xxhash.xxh64_intdigest, shingles)) >> 1, list(counts), amounts), strict=True):
                    column.append(x)
            kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))], ["grade", "lang", "share", "bucket", "features", "amounts"])


def level(sizes: Iterable[int], max_rows: int) -> float:
    """The number of rows of each stratum, where it has so many, that makes ``max_rows`` rows in all."""
    left = float(max_rows)
    ordered = sorted(sizes)
    for k, size in enumerate(ordered):
        if size * (len(ordered) - k) > left:
            return left / (len(ordered) - k)
        left -= size
    return math.inf


def sample(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str = "doc_id", grade_col: str = "grade", lang_col: str = "lang") -> DataFrame:
    """``id, grade, lang, share`` of at most ``max_rows`` labelled documents; ``share`` is the part of its language and grade that is taken."""
    graded = labels.select(F.col(id_col).cast("long").alias("id"), F.col(grade_col).cast("int").alias("grade")).where("id IS NOT NULL AND grade IS NOT NULL")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    langs = docs.select(F.col(id_col).cast("long").alias("id"), lang.alias("lang")).groupBy("id").agg(F.min("lang").alias("lang"))
    found = graded.groupBy("id").agg(F.max("grade").alias("grade")).join(langs, "id")
    strata = found.groupBy("grade", "lang").count().collect()
    most = level((r["count"] for r in strata), max_rows)
    shares = local_table(found.sparkSession, [(r.grade, r.lang, min(1.0, most / r["count"])) for r in strata], "grade int, lang string, share double")
    found = found.join(F.broadcast(shares), ["grade", "lang"]).select("id", "grade", "lang", "share")
    place = F.xxhash64("id") / F.lit(2.0**64) + 0.5
    return found.orderBy(F.when(F.col("share") < 1, place / F.col("share")).otherwise(-1.0), "id").limit(max_rows)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_features: int = 32_768, min_rows: float = 3, min_z: float = 3, penalty: float = 0.2, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", lang_col: str = "lang") -> OrdinalModel:
    """Fit on the labelled rows of ``labels`` (id, grade); at most ``max_rows`` rows and ``max_features`` features reach the driver."""
    spark = docs.sparkSession
    chosen = sample(docs, labels, max_rows, id_col, grade_col, lang_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("grade", "lang", "share", "text").mapInArrow(frugal(_sampled), _SAMPLED)  # max_rows bounds what is broadcast
    rows = cut(rows, "toxicity-sample")
    sizes = rows.groupBy("bucket").agg((1 / F.count("*")).alias("weight"))
    rows = rows.join(F.broadcast(sizes), "bucket")  # max_rows bounds these as well
    hit = F.when(F.col("grade") > 0, F.col("weight")).otherwise(0.0)
    totals = rows.groupBy("lang").agg(F.sum("weight").alias("n"), F.sum(hit).alias("k"), F.max("grade").alias("most")).collect()
    if not sum(r.k for r in totals):
        return OrdinalModel({}, [])
    rates = local_table(spark, [(r.lang, min(max(r.k / r.n, 1e-4), 1 - 1e-4)) for r in totals], "lang string, rate double")
    stats = rows.select("lang", F.explode("features").alias("feature"), "weight", hit.alias("hit")).groupBy("feature", "lang").agg(F.sum("weight").alias("n"), F.sum("hit").alias("k"))
    stats = stats.join(F.broadcast(rates), "lang").withColumn("excess", F.col("k") - F.col("n") * F.col("rate")).withColumn("spread", F.col("n") * F.col("rate") * (1 - F.col("rate")))
    enough = F.col("n") >= min_rows - 1e-9
    stats = stats.groupBy("feature").agg(
        F.max(F.when(enough, F.abs("excess") / F.sqrt("spread"))).alias("own"),
        F.when(F.sum("n") >= min_rows - 1e-9, F.abs(F.sum("excess")) / F.sqrt(F.sum("spread"))).alias("over_all"),
    )
    best = stats.select("feature", F.greatest("own", "over_all").alias("z")).where(F.col("z") >= min_z).orderBy(F.desc("z"), "feature").limit(max_features).collect()
    vocabulary = {r.feature: i for i, r in enumerate(best)}

    sent = spark.sparkContext.broadcast(vocabulary)  # max_features bounds it

    def known(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                batch = whole.slice(at, 100)
                pairs = [[(numbers[f], v) for f, v in zip(*x, strict=True) if f in numbers] for x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
                columns = (pa.array([[c for c, _ in p] for p in pairs], pa.list_(pa.int32())), pa.array([[v for _, v in p] for p in pairs], pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["grade", "weight", "columns", "amounts"])

    data = rows.select("grade", F.col("weight") / F.col("share"), "features", "amounts").mapInArrow(frugal(known), "grade int, weight double, columns array<int>, amounts array<double>").toArrow().to_pydict()
    order = sorted(range(len(data["grade"])), key=lambda k: (data["grade"][k], data["weight"][k], data["columns"][k], data["amounts"][k]))
    matrix = [list(zip(data["columns"][k], data["amounts"][k], strict=True)) for k in order]
    y, weight = (np.array([data[c][k] for k in order]) for c in ("grade", "weight"))
    w, t = fit_links(matrix, y, weight, len(vocabulary), max(r.most for r in totals) + 1, penalty)
    return OrdinalModel({x: float(w[i]) for x, i in vocabulary.items()}, t.tolist())


def severity(model: OrdinalModel, text: Column) -> Column:
    """Expected grade of a text column."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from frugal(lambda found: (pd.Series(model.scores(texts), dtype="float64") for texts in found))(batches)

    return score(F.coalesce(text, F.lit("")))


def rate_documents(docs: DataFrame, model: OrdinalModel, reject_at: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, expected_severity, rejected`` of every row."""
    rated = docs.select(F.col(id_col).alias("doc_id"), severity(model, F.col(text_col)).alias("expected_severity"))
    return rated.withColumn("rejected", F.col("expected_severity") >= reject_at)


def keep_civil(docs: DataFrame, model: OrdinalModel, reject_at: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose expected severity stays below ``reject_at``, columns unchanged."""
    rated = free_name(docs.columns, "severity")
    return docs.withColumn(rated, severity(model, F.col(text_col))).where(F.col(rated) < reject_at).drop(rated)
