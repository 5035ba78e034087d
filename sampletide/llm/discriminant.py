"""Quality of documents by a regularised quadratic discriminant.

Every text becomes a vector of transformed statistics: logarithms of sizes, arcsine roots of shares. Labelled documents
give each class a mean and a covariance, which is drawn towards the pooled one (LAMBDAS) and then towards the identity of
the standardised scale (GAMMAS, or the oracle-approximating shrinkage of the sample if that is more). A document's evidence
is the difference of the two log densities, by Mahalanobis distances from Cholesky factors computed once and carried to
the tasks. A logistic curve turns it into a score.

All learnable labels are used, however many: what is gathered are sums per class, and counts per bin of evidence.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import crc32_fold, mapped, travels
from sampletide.llm.quality import repeated_words

travels(__name__)

FOLDS, THRESHOLD = 5, 0.3
# Shares of the pooled covariance and of the identity that are tried; the fold CHOOSING decides.
LAMBDAS, GAMMAS, CHOOSING = (0.0, 0.3, 0.6), (0.02, 0.1, 0.3), 4
# Standardised statistics are cut off here when a document is compared, so one odd statistic does not decide alone.
FARTHEST = 6.0
BINS = 400

STATISTICS = ("words", "word_size", "words_a_line", "richness", "symbols", "bangs", "stops", "digits", "upper", "marks", "breaks",
              "wide", "repeated", "top_word", "same_again", "dup_lines", "ends")
SIZE = len(STATISTICS)


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_SYMBOLS, _BANGS, _STOPS, _DIGITS = map(_table, ("#*$%&|<>~^\\", "!?", ".,;:", "0123456789"))
_UPPER, _MARKS, _BREAKS = map(_table, ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "\"'()+-/=@[]_`{}", "\n"))
_KINDS = np.stack([_SYMBOLS, _BANGS, _STOPS, _DIGITS, _UPPER, _MARKS, _BREAKS, np.arange(256) >= 128]).astype(np.int64)
_LETTER = bytes(int(i >= 128 or chr(i).isalpha()) for i in range(256))


def _share(part, whole) -> float:
    return float(np.arcsin(np.sqrt(min(part / whole, 1.0)))) if whole else 0.0


def statistics(text: str | None) -> list[float]:
    """One number per name of STATISTICS; all 0 for a text without words."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * SIZE
    kinds = _KINDS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = sum(map(len, words))
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    lines = [x for x in data.split(b"\n") if x.strip()]
    again = int((ids[1:] == ids[:-1]).sum())
    ends = n - sum(_LETTER[w[-1]] for w in words)
    return [float(np.log1p(n)), float(np.log(chars / n)), float(np.log(n / len(lines))),
            float(np.log(len(number)) / np.log(n)) if n > 1 else 1.0, *(_share(k, chars) for k in kinds.tolist()),
            _share(repeated_words(ids), n), _share(int(np.bincount(ids).max()) - 1, n), _share(again, n),
            _share(len(lines) - len(set(lines)), len(lines)), _share(ends, n)]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of every row's whole text."""
    def task(columns):
        return {"doc_id": columns["doc_id"], "x": [statistics(t) for t in columns["text"].to_pylist()]}
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), task, "doc_id long, x array<double>")


def learnable(labels: DataFrame) -> DataFrame:
    """doc_id, good (0 if any label says so), choosing; held-out ids, null ids and null labels are left out."""
    fold = crc32_fold(F.col("doc_id"), FOLDS)
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good"))
            .where("doc_id is not null and good in (0, 1)").groupBy("doc_id").agg(F.min("good").alias("good"))
            .where(fold != 0).withColumn("choosing", (fold == CHOOSING).cast("int")))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)


def sums(sample: DataFrame) -> dict:
    """(choosing, good) -> (count, sums, sums of products) over all rows of `sample` (x, good, choosing)."""
    def task(columns):
        x, good, choosing = _matrix(columns["x"]), columns["good"].to_numpy(), columns["choosing"].to_numpy()
        rows = []
        for c in (0, 1):
            for g in (0, 1):
                own = x[(choosing == c) & (good == g)]
                if len(own):
                    made = np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
                    rows += [(c, g, place, v) for place, v in enumerate(made.tolist())]
        return {n: [r[i] for r in rows] for i, n in enumerate(("choosing", "good", "place", "value"))}
    partial = mapped(sample.select("x", "good", "choosing"), task, "choosing int, good int, place int, value double")
    out = {(c, g): np.zeros(1 + SIZE + SIZE * SIZE) for c in (0, 1) for g in (0, 1)}
    # At most four times 1 + SIZE + SIZE * SIZE rows, whatever the number of labels.
    for r in partial.groupBy("choosing", "good", "place").agg(F.sum("value").alias("value")).collect():
        out[r["choosing"], r["good"]][r["place"]] = r["value"]
    return out


def shrinkage(covariance: np.ndarray, n: float) -> float:
    """Oracle-approximating share of the scaled identity (Chen, Wiesel, Eldar and Hero 2010)."""
    p, trace, square = len(covariance), float(np.trace(covariance)), float((covariance ** 2).sum())
    below = (n + 1 - 2 / p) * (square - trace ** 2 / p)
    return min(1.0, ((1 - 2 / p) * square + trace ** 2) / below) if below > 0 else 1.0


class Discriminant:
    """Two Gaussian densities over standardised statistics, as means, whitening factors and log determinants."""

    def __init__(self, low: np.ndarray, high: np.ndarray, pull: float, ridge: float):
        """`low`, `high`: count, sums and sums of products of the classes 0 and 1, each with two rows at least."""
        both = low + high
        self.centre = both[1:1 + SIZE] / both[0]
        spread = np.diag(both[1 + SIZE:].reshape(SIZE, SIZE)) / both[0] - self.centre ** 2
        self.scale = np.sqrt(np.where(spread > 1e-9, spread, 1.0))
        means, scatters, counts = [], [], []
        for own in (low, high):
            mean = own[1:1 + SIZE] / own[0]
            scatter = own[1 + SIZE:].reshape(SIZE, SIZE) - own[0] * np.outer(mean, mean)
            means.append((mean - self.centre) / self.scale)
            scatters.append(scatter / np.outer(self.scale, self.scale))
            counts.append(own[0])
        pooled = (scatters[0] + scatters[1]) / max(sum(counts) - 2, 1)
        self.means, self.factors, self.constants = np.array(means), [], []
        for scatter, n in zip(scatters, counts, strict=True):
            covariance = (1 - pull) * scatter / max(n - 1, 1) + pull * pooled
            share = max(ridge, shrinkage(covariance, n))
            covariance = (1 - share) * covariance + share * np.eye(SIZE)
            lower = np.linalg.cholesky(covariance)
            # The inverse of the Cholesky factor is kept: a distance is then one product.
            self.factors.append(np.linalg.solve(lower, np.eye(SIZE)))
            self.constants.append(float(np.log(np.diag(lower)).sum()))
        self.prior = float(np.log(counts[1] / counts[0]))

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0, with the log ratio of the classes, drawn together like a logarithm."""
        z = np.clip((x - self.centre) / self.scale, -FARTHEST, FARTHEST)
        logs = [-0.5 * (((z - m) @ f.T) ** 2).sum(1) - c for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        difference = logs[1] - logs[0] + self.prior
        return np.sign(difference) * np.log1p(np.abs(difference))


def binned(sample: DataFrame, models: list[Discriminant]) -> np.ndarray:
    """models x 2 x BINS: labelled rows of `sample` (x, good) per class and bin of evidence."""
    def task(columns):
        x, good = _matrix(columns["x"]), columns["good"].to_numpy()
        rows: list = []
        for i, model in enumerate(models):
            at = np.clip(((model.evidence(x) + 10) * (BINS / 20)).astype(np.int64), 0, BINS - 1)
            counts = np.bincount(good * BINS + at, minlength=2 * BINS)
            rows += [(i, int(p), int(counts[p])) for p in np.flatnonzero(counts)]
        return {"model": [r[0] for r in rows], "place": [r[1] for r in rows], "n": [r[2] for r in rows]}
    made = mapped(sample.select("x", "good"), task, "model int, place int, n long").groupBy("model", "place").agg(F.sum("n").alias("n"))
    out = np.zeros((len(models), 2 * BINS))
    # At most models x 2 x BINS rows.
    for r in made.collect():
        out[r["model"], r["place"]] = r["n"]
    return out.reshape(len(models), 2, BINS)


def fitted_curve(counts: np.ndarray) -> tuple[float, float, float]:
    """Offset and slope of the logistic curve of class 1 over the middles of the bins, and its log loss. The targets are
    Platt's, one pseudo-count off 0 and 1, so that separable classes give a finite slope."""
    t = (np.arange(BINS) + 0.5) * (20 / BINS) - 10
    low, high = counts
    n0, n1 = low.sum(), high.sum()
    targets = (1 / (n0 + 2), (n1 + 1) / (n1 + 2))
    weight, goal = low + high, low * targets[0] + high * targets[1]
    w = np.array([0.0, 1.0])
    design = np.stack([np.ones(BINS), t])

    def loss(w):
        m = w @ design
        return float((weight * np.logaddexp(0, m) - goal * m).sum() + 1e-3 * (w ** 2).sum())
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -40, 40)))
        gradient = design @ (weight * p - goal) + 2e-3 * w
        hessian = (design * (weight * p * (1 - p))) @ design.T + 2e-3 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(w[0]), max(float(w[1]), 1e-3), loss(w) / max(n0 + n1, 1)


class Judge:
    """A discriminant with its curve; without two labelled rows of each class, one score for all."""

    def __init__(self, model: Discriminant | None, offset: float, slope: float, chosen: tuple | None = None):
        self.model, self.offset, self.slope, self.chosen = model, offset, slope, chosen

    def scores(self, x: np.ndarray) -> np.ndarray:
        t = self.model.evidence(x) if self.model else np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * t, -36, 36)))


def learn(table: DataFrame, labels: DataFrame, written) -> Judge:
    """From a table of statistics (doc_id, x) and labels (doc_id, quality).

    Shrinkage is chosen where a model of the other folds gives the least log loss on the fold CHOOSING; the curve is the one found
    there; the densities are then learned from all learnable rows.
    """
    sample = written(table.join(learnable(labels), "doc_id"), "discriminant-sample")
    held = sums(sample)
    every = [held[0, g] + held[1, g] for g in (0, 1)]
    if min(every[0][0], every[1][0]) < 2:
        return Judge(None, float(np.log((every[1][0] + 1) / (every[0][0] + 1))), 1.0)
    pairs = [(pull, ridge) for pull in LAMBDAS for ridge in GAMMAS]
    apart = min(held[0, 0][0], held[0, 1][0]) >= 2 and min(held[1, 0][0], held[1, 1][0]) >= 1
    fitting = [held[0, g] for g in (0, 1)] if apart else every
    judged = sample.where("choosing = 1") if apart else sample
    curves = [fitted_curve(c) for c in binned(judged, [Discriminant(*fitting, *p) for p in pairs])]
    best = min(range(len(pairs)), key=lambda i: (round(curves[i][2], 9), i))
    return Judge(Discriminant(*every, *pairs[best]), curves[best][0], curves[best][1], pairs[best])


def score(docs: DataFrame, labels: DataFrame, written) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per row of `docs`.

    Only text is measured. Null, empty and blank texts have the vector of zeros and are scored like any other. Null ids are
    not held out and never learned from; ids may repeat, each row is scored, and each row of a labelled id is learned from. A
    document with several labels is good only if all say so. With fewer than two labelled rows of a class every row has the
    score of the labels' share. Empty tables give no rows; other columns are not read.
    """
    table = written(measured(docs), "discriminant-statistics")
    judge = learn(table, labels, written)

    def task(columns):
        return {"doc_id": columns["doc_id"], "score": judge.scores(_matrix(columns["x"]))}
    made = mapped(table, task, "doc_id long, score double")
    return made.select("doc_id", F.coalesce(crc32_fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
