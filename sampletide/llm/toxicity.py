"""Toxic documents by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary labelled documents, are compared word by word. Pairs of neighbouring words are
counted as they occur and discounted; the mass that the discount frees goes to the class's words, which are counted by the
different words they follow and discounted too; and that mass goes by shared counts of the words of all documents, in which
the classes agree. An expression whose counts do not exceed the discount in either class is thus wholly smoothed by the
shared counts and says the same in both; it needs no entry in the model, which is why the model is small, but nothing is
left out of it. A document's evidence weighs its length-normalised ratio, that of its strongest word, and the most that a
word's neighbour adds: toxic wording is local, and one word in hundreds hardly moves the ratio of a whole text. The weights
and the logistic curve that makes a score are set on labelled documents outside the language models' share.

The labelled sample is bounded: CLASS_DOCS documents per class, those with the smallest hash of their id. The shared
counts cover every word of every document and lie in a table, which the model's words are joined with.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import crc32_fold, mapped, travels

travels(__name__)

FOLDS, CLASS_DOCS = 5, 6000
# Discounts of pair counts and of the numbers of words that a word follows.
PAIR_DISCOUNT, WORD_DISCOUNT = 3.0, 3.0
# Different words or pairs a task counts before it hands them on.
HELD_WORDS = 100_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def learnable(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (1 if any label says so) of the rows that may be learned from."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .where(crc32_fold(F.col("doc_id"), FOLDS) != 0))


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id, toxic, calibrates: at most CLASS_DOCS learnable rows of each class, a quarter of them for the curve."""
    one = learnable(labels).withColumn("draw", F.xxhash64("doc_id", F.lit(7)))
    classes = [one.where(F.col("toxic") == c).orderBy("draw", "doc_id").limit(CLASS_DOCS) for c in (0, 1)]
    return classes[0].unionByName(classes[1]).select("doc_id", "toxic", (F.pmod("draw", F.lit(4)) == 0).alias("calibrates"))


def chosen_of(labels: DataFrame) -> tuple[int, int]:
    """Learnable rows of each class."""
    found = {r["toxic"]: r["count"] for r in learnable(labels).groupBy("toxic").count().collect()}
    return found.get(0, 0), found.get(1, 0)


def class_counts(sample: DataFrame) -> DataFrame:
    """left, right, c0, c1: how often two words are neighbours in each class."""
    import pyarrow as pa

    def run(batches):
        met: tuple = Counter(), Counter()

        def handed():
            for c in (0, 1):
                keys, n = list(met[c]), pa.array(list(met[c].values()), pa.int64())
                none = pa.array(np.zeros(len(keys), np.int64))
                met[c].clear()
                yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.string()) for i in (0, 1)] + ([none, n] if c else [n, none]), names=["left", "right", "c0", "c1"])
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    found = words_of(text)
                    met[toxic].update(zip(found, found[1:]))
                if len(met[0]) + len(met[1]) > HELD_WORDS:
                    yield from handed()
        yield from handed()
    made = sample.select("text", "toxic").mapInArrow(run, "left string, right string, c0 long, c1 long")
    return made.groupBy("left", "right").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def shared_counts(docs: DataFrame) -> DataFrame:
    """word, n: occurrences of every word of all documents."""
    import pyarrow as pa

    def run(batches):
        met: Counter = Counter()

        def handed():
            return pa.RecordBatch.from_arrays([pa.array(list(met), pa.string()), pa.array(list(met.values()), pa.int64())], names=["word", "n"])
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for text in batch.column(0).slice(at, 64).to_pylist():
                    met.update(words_of(text))
                if len(met) > HELD_WORDS:
                    yield handed()
                    met.clear()
        yield handed()
    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Words with class counts, numbered from 1; 0 is any other word."""

    def __init__(self, words: list[str]):
        self.number = {w: i + 1 for i, w in enumerate(words)}

    def ids(self, text) -> np.ndarray:
        found = words_of(text)
        get = self.number.get
        return np.fromiter((get(w, 0) for w in found), np.int64, len(found))


class Model:
    """Log-likelihood ratios of the two class models over numbered words; 0 is any word without an entry."""

    def __init__(self, vocabulary: Vocabulary, words: np.ndarray, pairs: np.ndarray, shared: np.ndarray, lefts: np.ndarray, totals, freed):
        """words: per number the continuation counts of both classes; pairs: rows of left, right, c0, c1 that exceed the discount
        in a class; shared: probability of each word in all documents; lefts: occurrences as a left word in both classes;
        totals: all different pairs of each class; freed: the share of words' mass that the discount frees in each class."""
        self.vocabulary, self.size = vocabulary, len(words)
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(keys)
        self.keys, rows = keys[order], pairs[order]
        word, back, full = np.zeros((self.size, 2)), np.ones((self.size, 2)), []
        for c in (0, 1):
            word[:, c] = np.maximum(words[:, c] - WORD_DISCOUNT, 0) / max(float(totals[c]), 1.0) + freed[c] * shared
            kept = np.maximum(rows[:, 2 + c] - PAIR_DISCOUNT, 0) / np.maximum(lefts[rows[:, 0], c], 1)
            back[:, c] -= np.bincount(rows[:, 0], kept, self.size)
            full.append(kept + back[rows[:, 0], c] * word[rows[:, 1], c])
        self.pair = np.log(full[1]) - np.log(full[0])
        self.word = np.log(word[:, 1]) - np.log(word[:, 0])
        # The shared probability of a word without class counts is the same in both.
        self.word[0] = np.log(freed[1]) - np.log(freed[0])
        self.back = np.log(back[:, 1]) - np.log(back[:, 0])
        self.weights, self.curve = np.ones(3), np.array([0.0, 0.0])

    def ratios(self, ids: np.ndarray) -> np.ndarray:
        """Toxic minus ordinary log-likelihood of every word given the one before it."""
        out = self.word[ids]
        if len(ids) > 1:
            out[1:] += self.back[ids[:-1]]
        if len(ids) > 1 and len(self.keys):
            keys = ids[:-1] * self.size + ids[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == keys)
            out[1 + hit] = self.pair[at[hit]]
        return out

    def signs(self, text) -> tuple[float, float, float]:
        """Mean ratio of the text's words, the highest ratio of a word by itself, and the most that a word's neighbour adds."""
        ids = self.vocabulary.ids(text)
        if not len(ids):
            return 0.0, 0.0, 0.0
        full, alone = self.ratios(ids), self.word[ids]
        return float(full.mean()), float(alone.max()), float((full - alone).max())

    def evidence(self, text) -> float:
        return float(self.weights @ self.signs(text))

    def score(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] + self.curve[1] * evidence, -40, 40))))


def fitted_weights(signs: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the signs by a ridge logistic regression, none below 0: a sign that speaks against toxicity is left out."""
    active = list(range(signs.shape[1])) if 0 < toxic.sum() < len(toxic) else []
    spread = np.maximum(signs.std(0), 1e-6) if active else None
    while active:
        x = np.column_stack([np.ones(len(signs)), (signs[:, active] - signs[:, active].mean(0)) / spread[active]])
        w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2 * weight.sum()] * len(active))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - toxic)) + ridge @ w)
        if (w[1:] >= 0).all():
            out = np.zeros(signs.shape[1])
            out[active] = w[1:] / spread[active]
            return out
        active = [a for a, v in zip(active, w[1:], strict=True) if v > 0]
    return np.ones(signs.shape[1])


def fitted_curve(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Curve that is 0.5 where the weighted errors are fewest, in the middle of the widest such gap: labels that
    contradict a text move it little. Its steepness is the inverse spread below. Without both classes: never toxic."""
    if len(set(toxic.tolist())) < 2:
        return np.array([-5.0, 0.0])
    order = np.argsort(evidence, kind="stable")
    e, y, w = evidence[order], toxic[order], weight[order]
    # Errors of a cut after the i-th smallest: toxic at or below it, others above.
    errors = np.concatenate([[0.0], np.cumsum(w * y)]) + np.concatenate([np.cumsum((w * (1 - y))[::-1])[::-1], [0.0]])
    gap = np.concatenate([[0.0], np.diff(e), [0.1 * (e[-1] - e[0]) + 1e-6]])
    best = max(range(1, len(e) + 1), key=lambda i: (-errors[i], gap[i]))
    if gap[best] <= 0:
        best = min((i for i in range(1, len(e) + 1) if gap[i] > 0), key=lambda i: errors[i])
    cut = e[best - 1] + gap[best] / 2
    steep = 2.0 / max(float(np.std(e[y == 0])), 1e-3)
    return np.array([-steep * cut, steep])


def learn(docs: DataFrame, labels: DataFrame, written) -> Model:
    """Model and curve. The driver holds at most CLASS_DOCS labels per class, and the entries that exceed a discount in
    their texts."""
    chosen = labelled(labels)
    sample = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id"), "toxicity-sample")
    pairs = written(class_counts(sample.where("not calibrates")), "toxicity-pairs")
    kinds = [F.count(F.when(F.col(f"c{c}") > 0, 1)).alias(f"c{c}") for c in (0, 1)]
    totals = pairs.agg(*kinds).first()
    follows = written(pairs.groupBy(F.col("right").alias("word")).agg(*kinds), "toxicity-words")
    over = [F.greatest(F.col(f"c{c}") - WORD_DISCOUNT, F.lit(0.0)) for c in (0, 1)]
    kept_mass = follows.agg(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in over]).first()
    freed = [1 - kept_mass[c] / max(totals[c], 1) for c in (0, 1)]
    double = pairs.where(f"c0 > {PAIR_DISCOUNT} or c1 > {PAIR_DISCOUNT}").toArrow()
    named = pairs.where(f"c0 > {PAIR_DISCOUNT} or c1 > {PAIR_DISCOUNT}").select(F.explode(F.array("left", "right")).alias("word"))
    entries = named.unionByName(follows.where(f"c0 > {WORD_DISCOUNT} or c1 > {WORD_DISCOUNT}").select("word")).distinct()
    counts = written(shared_counts(docs), "toxicity-shared")
    everything = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    lead = pairs.groupBy(F.col("left").alias("word")).agg(F.sum("c0").alias("l0"), F.sum("c1").alias("l1"))
    single = written(entries.join(follows, "word", "left").join(lead, "word", "left").join(counts, "word", "left").na.fill(0), "toxicity-entries").toArrow()
    vocabulary = Vocabulary(single["word"].to_pylist())
    number = vocabulary.number
    column = lambda *names: np.vstack([np.zeros((1, len(names))), np.stack([single[n].to_numpy().astype(float) for n in names], 1)])
    shared = (column("n")[:, 0] + 1) / (everything[0] + everything[1] + 1)
    kept = np.array([(number[a], number[b], c, d) for a, b, c, d in zip(*(double[n].to_pylist() for n in ("left", "right", "c0", "c1")), strict=True)], np.int64)
    model = Model(vocabulary, column("c0", "c1"), kept.reshape(-1, 4), shared, column("l0", "l1"), totals, freed)
    held = model_signs(sample.where("calibrates").select("text", "toxic"), model).toPandas()
    toxic, signs = held["toxic"].to_numpy(float), held[["mean", "word", "pair"]].to_numpy(float)
    # Classes weigh what they do among all learnable labels.
    share = chosen_of(labels)
    weight = np.where(toxic == 1, share[1] / max((toxic == 1).sum(), 1), share[0] / max((toxic == 0).sum(), 1))
    model.weights = fitted_weights(signs, toxic, weight)
    model.curve = fitted_curve(signs @ model.weights, toxic, weight)
    return model


def model_signs(sample: DataFrame, model) -> DataFrame:
    def task(columns):
        rows = [model.signs(t) for t in columns["text"].to_pylist()]
        return {"toxic": columns["toxic"]} | {n: [r[i] for r in rows] for i, n in enumerate(("mean", "word", "pair"))}
    return mapped(sample, task, "toxic int, mean double, word double, pair double")


def model_evidence(docs: DataFrame, model) -> DataFrame:
    def task(columns):
        return {"doc_id": columns["doc_id"], "evidence": [model.evidence(t) for t in columns["text"].to_pylist()]}
    return mapped(docs, task, "doc_id long, evidence double")


def score(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] + self.curve[1] * evidence, -40, 40))))


def fitted_weights(signs: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the signs by a ridge logistic regression, none below 0: a sign that speaks against toxicity is left out."""
    active = list(range(signs.shape[1])) if 0 < toxic.sum() < len(toxic) else []
    spread = np.maximum(signs.std(0), 1e-6) if active else None
    while active:
        x = np.column_stack([np.ones(len(signs)), (signs[:, active] - signs[:, active].mean(0)) / spread[active]])
        w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2 * weight.sum()] * len(active))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - toxic)) + ridge @ w)
        if (w[1:] >= 0).all():
            out = np.zeros(signs.shape[1])
            out[active] = w[1:] / spread[active]
            return out
        active = [a for a, v in zip(active, w[1:], strict=True) if v > 0]
    return np.ones(signs.shape[1])


def fitted_curve(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Curve that is 0.5 where the weighted errors are fewest, in the middle of the widest such gap: labels that
    contradict a text move it little. Its steepness is the inverse spread below. Without both classes: never toxic."""
    if len(set(toxic.tolist())) < 2:
        return np.array([-5.0, 0.0])
    order = np.argsort(evidence, kind="stable")
    e, y, w = evidence[order], toxic[order], weight[order]
    # Errors of a cut after the i-th smallest: toxic at or below it, others above.
    errors = np.concatenate([[0.0], np.cumsum(w * y)]) + np.concatenate([np.cumsum((w * (1 - y))[::-1])[::-1], [0.0]])
    gap = np.concatenate([[0.0], np.diff(e), [0.1 * (e[-1] - e[0]) + 1e-6]])
    best = max(range(1, len(e) + 1), key=lambda i: (-errors[i], gap[i]))
    if gap[best] <= 0:
        best = min((i for i in range(1, len(e) + 1) if gap[i] > 0), key=lambda i: errors[i])
    cut = e[best - 1] + gap[best] / 2
    steep = 2.0 / max(float(np.std(e[y == 0])), 1e-3)
    return np.array([-steep * cut, steep])


def learn(docs: DataFrame, labels: DataFrame, written) -> Model:
    """Model and curve. The driver holds at most CLASS_DOCS labels per class, and the entries that exceed a discount in
    their texts."""
    chosen = labelled(labels)
    sample = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id"), "toxicity-sample")
    pairs = written(class_counts(sample.where("not calibrates")), "toxicity-pairs")
    kinds = [F.count(F.when(F.col(f"c{c}") > 0, 1)).alias(f"c{c}") for c in (0, 1)]
    totals = pairs.agg(*kinds).first()
    follows = written(pairs.groupBy(F.col("right").alias("word")).agg(*kinds), "toxicity-words")
    over = [F.greatest(F.col(f"c{c}") - WORD_DISCOUNT, F.lit(0.0)) for c in (0, 1)]
    kept_mass = follows.agg(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in over]).first()
    freed = [1 - kept_mass[c] / max(totals[c], 1) for c in (0, 1)]
    double = pairs.where(f"c0 > {PAIR_DISCOUNT} or c1 > {PAIR_DISCOUNT}").toArrow()
    named = pairs.where(f"c0 > {PAIR_DISCOUNT} or c1 > {PAIR_DISCOUNT}").select(F.explode(F.array("left", "right")).alias("word"))
    entries = named.unionByName(follows.where(f"c0 > {WORD_DISCOUNT} or c1 > {WORD_DISCOUNT}").select("word")).distinct()
    counts = written(shared_counts(docs), "toxicity-shared")
    everything = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    lead = pairs.groupBy(F.col("left").alias("word")).agg(F.sum("c0").alias("l0"), F.sum("c1").alias("l1"))
    single = written(entries.join(follows, "word", "left").join(lead, "word", "left").join(counts, "word", "left").na.fill(0), "toxicity-entries").toArrow()
    vocabulary = Vocabulary(single["word"].to_pylist())
    number = vocabulary.number
    column = lambda *names: np.vstack([np.zeros((1, len(names))), np.stack([single[n].to_numpy().astype(float) for n in names], 1)])
    shared = (column("n")[:, 0] + 1) / (everything[0] + everything[1] + 1)
    kept = np.array([(number[a], number[b], c, d) for a, b, c, d in zip(*(double[n].to_pylist() for n in ("left", "right", "c0", "c1")), strict=True)], np.int64)
    model = Model(vocabulary, column("c0", "c1"), kept.reshape(-1, 4), shared, column("l0", "l1"), totals, freed)
    held = model_signs(sample.where("calibrates").select("text", "toxic"), model).toPandas()
    toxic, signs = held["toxic"].to_numpy(float), held[["mean", "word", "pair"]].to_numpy(float)
    # Classes weigh what they do among all learnable labels.
    share = chosen_of(labels)
    weight = np.where(toxic == 1, share[1] / max((toxic == 1).sum(), 1), share[0] / max((toxic == 0).sum(), 1))
    model.weights = fitted_weights(signs, toxic, weight)
    model.curve = fitted_curve(signs @ model.weights, toxic, weight)
    return model


def model_evidence(docs: DataFrame, model, *more: str) -> DataFrame:
    def task(columns):
        return {"doc_id": columns["doc_id"], "evidence": [model.evidence(t) for t in columns["text"].to_pylist()]} | {c: columns[c] for c in more}
    return mapped(docs, task, "doc_id long, evidence double" + "".join(f", {c} int" for c in more))


def score(docs: DataFrame, labels: DataFrame, written) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence; one row per row of `docs`.

    Only text is scored. Null and empty texts have no evidence and get the curve's value at 0. Null ids are not held
    out; ids may repeat. Without labels of both classes nothing is predicted toxic. Other columns are not read.
    """
    model = learn(docs, labels, written)
    made = model_evidence(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    value = 1 / (1 + F.exp(-(F.lit(float(model.curve[0])) + F.lit(float(model.curve[1])) * F.col("evidence"))))
    return (made.withColumn("held_out", F.coalesce(crc32_fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)))
            .withColumn("score", value).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .select("doc_id", "held_out", "score", "predicted", "evidence"))


def without_toxic(docs: DataFrame, labels: DataFrame, written) -> DataFrame:
    """The rows of `docs` that are not predicted toxic; all columns stay."""
    model = learn(docs, labels, written)
    place = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            keep = [model.score(model.evidence(t)) < 0.5 for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
