"""Quality classifier from positives and unlabelled text.

Trusted positives are rows labelled 1; labels 0 are not used at all.  A linear
scorer minimises the non-negative unbiased risk

    prior * risk(positives as 1) + max(0, risk(unlabelled as 0) - prior * risk(positives as 0))

where the share of positives among unlabelled documents (the class prior) is
estimated first: a scorer of positives against unlabelled text is trained on one
half of each sample, and on the other half of the positives and on all other
documents the smallest ratio of the two shares that pass a threshold, with an
allowance for sampling error, bounds the prior.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapscope.llm.common import free_name, held_out, importable, learning_labels, quoted, release, without

#: Bounds of the samples that the scorer is fitted on (the corpus may be of any size).
POSITIVES, UNLABELLED = 3000, 6000
BUCKETS = 1024
N_SHAPE = 12
#: How much a step away from the sample's scorer costs, by its square.
HELD = 0.1
#: Added to the number of trigrams, so that those of very short texts weigh little.
SHRINK = 300
_GAPS = " \t\n\v\f\r"


def features(text: str | None) -> np.ndarray:
    """Root shares of hashed byte trigrams of the whole text, then its shape; all 0 for null and empty."""
    out = np.zeros(BUCKETS + N_SHAPE, np.float32)
    if not text:
        return out
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    byte = np.bincount(data, minlength=256)
    if len(data) > 2:
        wide = data.astype(np.uint32)
        gram = ((wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(2654435761)) >> np.uint32(22)
        out[:BUCKETS] = np.sqrt(np.bincount(gram, minlength=BUCKETS) / (len(gram) + SHRINK))
    words = text.split()
    n, distinct = max(1, len(words)), len(set(words))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    share = lambda chars: sum(byte[ord(c)] for c in chars) / len(data)
    out[BUCKETS:] = (
        distinct / np.sqrt(n), sum(map(str.__eq__, words, words[1:])) / n, 1 - len(set(lines)) / max(1, len(lines)),
        share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("#*$%&<>@^~=+"), share("|_\\/{}[]"), share("!?"), share(".,;:"),
        share("0123456789"), np.minimum(20, len(data) / n), np.log1p(n), len(lines) / n)
    return out


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, gradient, steps: int = 500, rate: float = 0.02, tilt=None,
        start: tuple[np.ndarray, float] | None = None) -> tuple[np.ndarray, float]:
    """Adam over all rows at once; ``gradient(margins)`` gives the risk's derivative by each row's margin.

    The fewer the rows, the more large weights cost.  ``tilt(margins, at)`` is added
    to the derivative by the weights and the bias, which are ``at``.
    """
    ridge = 10 / max(1, len(x)) * max(1, 3000 / max(1, len(x)))
    w, b = start or (np.zeros(x.shape[1]), 0.0)
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, steps + 1):
        z = (x @ w.astype(x.dtype)).astype(np.float64) + b
        d = gradient(z)
        g = np.append(d.astype(x.dtype) @ x + ridge * w, d.sum())
        g = g if tilt is None else g + tilt(z, np.append(w, b))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def prior_cuts(positive: np.ndarray) -> np.ndarray:
    return np.unique(np.quantile(positive, np.linspace(0.005, 0.95, 190)))


def prior_bound(positive: np.ndarray, cuts: np.ndarray, passed: np.ndarray, n: int, delta: float = 0.1) -> float:
    """Share of positives among ``n`` unlabelled rows, of which ``passed`` reach each cut, from held-back margins of positives.

    At a high enough threshold all that passes is positive, and the ratio of the
    shares that pass is the prior.  Every threshold's ratio bounds it from above,
    with half an allowance for sampling error; the smallest bound is taken, so that
    small samples rather call a good document good than a bad one bad.
    """
    q_p = np.array([(positive >= c).mean() for c in cuts])
    slack = np.sqrt(np.log(4 / delta) / 2) * (len(positive) ** -0.5 + n ** -0.5)
    return float(np.clip(((passed / n + 0.5 * slack) / q_p).min(), 0.02, 0.995))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """``prior_bound`` from the margins of unlabelled rows."""
    cuts = prior_cuts(positive)
    return prior_bound(positive, cuts, reaching(unlabelled, cuts), len(unlabelled), delta)


def reaching(margins: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """By cut, how many margins reach it."""
    return np.array([(margins >= c).sum() for c in cuts])


@dataclass
class Corpus:
    """Features of sampled unlabelled rows, and what goes over all unlabelled rows: how many reach each cut, and how many
    there are; and by scorer the mean, over all, of what calling them 1 costs where they count as 0, with the first scorer's
    derivatives."""

    sample: np.ndarray
    reaching: Callable[[Scorer, np.ndarray], tuple[np.ndarray, int]]
    costs: Callable[[list[Scorer]], tuple[np.ndarray, np.ndarray]] | None = None

    def __len__(self) -> int:
        return len(self.sample)


def train(positive: np.ndarray, unlabelled: np.ndarray | Corpus) -> tuple[Scorer, float]:
    """The scorer of least non-negative risk, and the estimated prior. Without positives or unlabelled rows: all margins are 0.

    The prior of a ``Corpus`` is estimated from all its rows but those that the first scorer is trained on.
    """
    dim = BUCKETS + N_SHAPE
    corpus = unlabelled if isinstance(unlabelled, Corpus) else None
    unlabelled = unlabelled if corpus is None else corpus.sample
    if not len(positive) or not len(unlabelled):
        return Scorer(np.zeros(dim), 0.0, np.zeros(dim), np.ones(dim)), 0.5
    x = np.concatenate([positive, unlabelled], dtype=np.float32)  # standardised in place: the only copy
    mean, scale = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64) + 1e-3
    scale[:BUCKETS] = x[:, :BUCKETS].std(dtype=np.float64) + 1e-3  # rare trigrams stay small
    x -= mean.astype(np.float32)
    x /= scale.astype(np.float32)
    is_p = np.arange(len(x)) < len(positive)
    n_p, n_u = is_p.sum(), (~is_p).sum()

    half = np.arange(len(x)) % 2 == 0
    target = is_p[half]
    weight = np.where(target, 0.5 / max(1, target.sum()), 0.5 / max(1, (~target).sum()))
    w, b = fit(x[half], lambda z: weight * (_sigmoid(z) - target), steps=150)
    rest = x[~half] @ w + b
    p_rest, u_rest = rest[is_p[~half]], rest[~is_p[~half]]
    prior = 0.5
    if len(p_rest) and len(u_rest):
        cuts = prior_cuts(p_rest)
        passed, n = reaching(u_rest, cuts), len(u_rest)
        if corpus is not None:
            trained = x[half & ~is_p] @ w + b
            everywhere, rows = corpus.reaching(Scorer(w, b, mean, scale), cuts)
            passed, n = np.maximum(everywhere - reaching(trained, cuts), 0), max(1, rows - len(trained))
        prior = prior_bound(p_rest, cuts, passed, n)

    excess = np.zeros(dim + 2)  # of all unlabelled rows over the sampled ones: mean cost, then its derivatives

    def risk_gradient(z: np.ndarray) -> np.ndarray:
        up = _sigmoid(z)  # derivative of the loss log(1 + exp(z)) of calling a row 1 where it counts as 0
        as_zero = np.where(is_p, -prior / n_p, 1 / n_u)
        if not negative(z):
            return as_zero * up + np.where(is_p, prior / n_p * (up - 1), 0)
        return -as_zero * up  # the part that may not be negative is: step back on it alone

    def negative(z: np.ndarray) -> bool:
        return (np.where(is_p, -prior / n_p, 1 / n_u) * np.logaddexp(0, z)).sum() + excess[0] < 0

    w, b = fit(x, risk_gradient)
    if corpus is not None and corpus.costs is not None:
        # from there, the sample's risk tilted so that its derivative is that of all unlabelled rows, and held back; of the
        # steps towards its least the one of least risk over all rows is taken
        costs, slope = corpus.costs([Scorer(w, b, mean, scale)])
        own = x[~is_p]
        z = (own @ w.astype(x.dtype)).astype(np.float64) + b
        up = _sigmoid(z) / n_u
        excess = np.concatenate([[costs[0] - np.logaddexp(0, z).mean()], slope - np.append(up.astype(x.dtype) @ own, up.sum())])
        from_here = np.append(w, b)
        there = np.append(*fit(x, risk_gradient, steps=100, rate=0.002, start=(w, b),
                               tilt=lambda z, at: (-excess[1:] if negative(z) else excess[1:]) + HELD * (at - from_here)))
        steps = [Scorer(v[:-1], float(v[-1]), mean, scale) for v in (from_here + t * (there - from_here) for t in (0, 1 / 16, 1 / 4, 1 / 2, 1))]
        costs, _ = corpus.costs(steps)
        as_one = [np.logaddexp(0, -(x[is_p].astype(np.float64) @ s.weights + s.bias)).mean() for s in steps]
        as_zero = [np.logaddexp(0, x[is_p].astype(np.float64) @ s.weights + s.bias).mean() for s in steps]
        return steps[int(np.argmin(prior * np.array(as_one) + np.maximum(0, costs - prior * np.array(as_zero))))], prior
    return Scorer(w, b, mean, scale), prior


def vectors(df: DataFrame, text: str) -> DataFrame:
    """``df`` (id columns and ``text``) with the text replaced by its features, as float32 bytes."""
    importable(df.sparkSession)

    @F.pandas_udf("binary")
    def vector(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield part.map(lambda t: features(t).tobytes())

    return df.withColumn(text, vector(F.col(quoted(text))))


def count_reaching(df: DataFrame, text: str, scorer: Scorer, cuts: np.ndarray) -> tuple[np.ndarray, int]:
    """By cut (in rising order), how many rows of ``df`` have a margin that reaches it; and how many rows there are."""
    importable(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast((scorer, cuts))

    @F.pandas_udf("int")
    def level(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            out = []
            for at in range(0, len(part), 1000):
                x = np.array([features(t) for t in part.iloc[at:at + 1000]]).reshape(-1, BUCKETS + N_SHAPE)
                out.append(np.searchsorted(model.value[1], model.value[0].margin(x), side="right"))
            yield pd.Series(np.concatenate(out) if out else [], dtype="int32")
        release()

    count = np.zeros(len(cuts) + 1, np.int64)
    for r in df.select(level(F.col(quoted(text))).alias("level")).groupBy("level").agg(F.count("*").alias("n")).collect():
        count[r["level"]] = r["n"]
    return count[::-1].cumsum()[::-1][1:], int(count.sum())


def mean_costs(df: DataFrame, text: str, scorers: list[Scorer]) -> tuple[np.ndarray, np.ndarray]:
    """By scorer the mean over the rows of ``df`` of log(1 + exp(margin)), and the first one's derivatives by the weights and
    the bias, in one pass.

    Sums are whole multiples of ``unit``, so they do not depend on the order in which tasks' sums meet.
    """
    spark = df.sparkSession
    importable(spark)
    model, unit, dim = spark.sparkContext.broadcast(scorers), 2.0 ** -20, BUCKETS + N_SHAPE
    width = 1 + len(scorers) + dim + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                texts = whole.column(0).slice(at, 1000).to_pylist()
                x = (np.array([features(t) for t in texts]).reshape(-1, dim) - model.value[0].mean) / model.value[0].scale
                margins = [x @ s.weights + s.bias for s in model.value]
                up = _sigmoid(margins[0])
                sums += np.concatenate([[len(x)], [np.logaddexp(0, z).sum() for z in margins], up @ x, [up.sum()]])
        release()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(np.rint(sums / unit).astype(np.int64))],
                                         names=["place", "total"])

    found = df.select(F.col(quoted(text))).mapInArrow(task, "place int, total long").groupBy("place").agg(F.sum("total").alias("total"))
    total = np.zeros(width)
    for r in found.collect():  # one row for each feature
        total[r["place"]] = r["total"] * unit
    total[1:] /= max(1.0, total[0])
    return total[1:1 + len(scorers)], total[1 + len(scorers):]


def learn(docs: DataFrame, labels: DataFrame, column: str = "quality", text: str = "text", doc_id: str = "doc_id",
          positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[Scorer, float]:
    """Fits on at most ``positives`` rows labelled 1 and the documents outside the held-out fold.

    Both samples are the ids of smallest hash; of an id that rows repeat, the least
    text stands for it, so no more rows come to the driver than there are ids.  The
    class prior is estimated from all documents outside the held-out fold, and
    the risk's unlabelled part is theirs in value and slope: ``unlabelled`` of them
    give its shape only, and the last step is the one of least risk over all of them.
    """
    wanted = learning_labels(labels.where(F.col(column) == 1), column, positives).select(
        F.col("doc_id").alias("_id"), F.lit(True).alias("_trusted"))
    learned_from = docs.select(F.col(quoted(doc_id)).alias("_id"), F.col(quoted(text)).alias("_text")).where(
        F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    free = learned_from.select("_id").distinct().orderBy(F.xxhash64("_id", F.lit(3)), "_id").limit(unlabelled).select(
        "_id", F.lit(False).alias("_trusted"))
    sample = F.broadcast(wanted.unionByName(free))  # at most positives + unlabelled rows of two fields
    rows = docs.select(F.col(quoted(doc_id)).alias("_id"), F.col(quoted(text)).alias("_text")).join(sample, "_id")
    rows = rows.groupBy("_id", "_trusted").agg(F.min("_text").alias("_text"))
    found = vectors(rows, "_text").select("_id", "_trusted", "_text").collect()
    found.sort(key=lambda r: (r["_id"], r["_trusted"]))
    matrix = lambda trusted: np.array([np.frombuffer(r["_text"], np.float32) for r in found if r["_trusted"] == trusted])
    return train(matrix(True), Corpus(matrix(False), lambda scorer, cuts: count_reaching(learned_from, "_text", scorer, cuts),
                                      lambda scorers: mean_costs(learned_from, "_text", scorers)))


def score_quality(df: DataFrame, scorer: Scorer, text: str = "text", name: str = "score") -> DataFrame:
    """Adds ``name`` (0 to 1, higher: better) to every row, from the whole text alone.

    Null and empty texts get the score of a text without features; repeated
    rows are scored alike; an input column of that name is replaced.
    """
    importable(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            out = []
            for at in range(0, len(part), 1000):
                x = np.array([features(t) for t in part.iloc[at:at + 1000]]).reshape(-1, BUCKETS + N_SHAPE)
                out.append(_sigmoid(model.value.margin(x)))
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")
        release()

    return without(df, *([name] if name != text else [])).withColumn(name, score(F.col(quoted(text))))


def keep_good(df: DataFrame, scorer: Scorer, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score at least ``threshold``, with the columns of ``df``."""
    name = free_name(df, "pu_score")
    return score_quality(df, scorer, text, name).where(F.col(name) >= threshold).drop(name)
