"""Quality rules whose cutoffs are chosen with a guarantee on false rejections.

Rules reject a document when a signal lies beyond a cutoff. Cutoffs come from labelled holdouts: per stratum (language),
the cutoffs of all rules are tightened along one fixed PATH of moves (rule, step). Each move is a test of "more than the
allowed share of good documents is rejected by any rule", done with the exact binomial (Clopper-Pearson) bound; the last
move before the first failure is taken, so the fixed order needs no correction inside a stratum, and the error level is
divided by the number of strata only (Bonferroni). Strata with too few labels to certify anything by themselves (fewer than
log(delta / strata) / log(1 - risk), 437 with four strata) are pooled and judged as one stratum; the bound then holds for the
pool as a whole. While the pool has too few, the smallest stratum that stands alone joins it. Whether a stratum is pooled
depends on how many labels it has, not on what they say. With fewer than 299 labels in all nothing is rejected.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import SPACE, mapped, travels, words

travels(__name__)

SYMBOLS = "#*$%&|<>"
# name -> steps from mild to strict; a document fails a step if its signal is at or above it.
STEPS = tuple(round(1.0 - i / 40, 4) for i in range(40))
RULES = ("symbols", "dup_lines", "repeat_words", "long_words", "upper", "few_distinct")
RISK, DELTA = 0.01, 0.05
# Moves as places in RULES and STEPS: the milder half of the steps for all rules in turn, then the rest rule by rule.
_MILD = len(STEPS) // 2
PATH = [(r, s) for s in range(_MILD) for r in range(len(RULES))] + [(r, s) for r in range(len(RULES)) for s in range(_MILD, len(STEPS))]


def repeated_words(ids: np.ndarray) -> int:
    """Words that lie in a 3-word window which the text holds twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    span = int(ids.max()) + 1
    if span < 2_000_000:
        keys = (ids[:-2] * span + ids[1:-1]) * span + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * span + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * span + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def measured(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then one value from 0 to 1 per rule of RULES."""
    if not text:
        return (0, 0, 0, 0, 0, *[0.0] * len(RULES))
    found = words(text)
    n = len(found)
    chars = len(text) - sum(text.count(c) for c in SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    dup = len(lines) - len(set(lines))
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, n)
    repeat = repeated_words(ids)
    if not n:
        return (0, chars, symbols, dup, 0, *[0.0] * len(RULES))
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    return (n, chars, symbols, dup, repeat,
            min(1.0, symbols / n), dup / max(len(lines), 1), repeat / n, min(1.0, chars / n / 40),
            upper / max(chars, 1), 1.0 - len(number) / n if n >= 50 else 0.0)


def signals(docs: DataFrame) -> DataFrame:
    """doc_id, stratum (lang), the counts of the contract and the rule signals; one row per row of `docs`."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *RULES)

    def task(columns):
        rows = [measured(t) for t in columns["text"].to_pylist()]
        return {"doc_id": columns["doc_id"], "stratum": columns["stratum"]} | {
            n: [r[i] for r in rows] for i, n in enumerate(names)}
    schema = ("doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, " + ", ".join(f"{r} double" for r in RULES))
    made = mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.coalesce("lang", F.lit("")).cast("string").alias("stratum"), "text"), task, schema)
    return made.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def upper_bound(k: int, n: int, delta: float) -> float:
    """Largest rate p with P(Binomial(n, p) <= k) >= delta: the one-sided exact (Clopper-Pearson) bound."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        a, b = math.log(p) if p else -math.inf, math.log1p(-p) if p < 1 else -math.inf
        terms = [c + i * a + (n - i) * b for i, c in enumerate(logs)]
        top = max(terms)
        tail = math.exp(top) * sum(math.exp(t - top) for t in terms) if top > -700 else 0.0
        low, high = (p, high) if tail >= delta else (low, p)
    return high


def needed(delta: float, risk: float) -> int:
    """Fewest good labels with which a cutoff that rejects none of them is certified."""
    return math.ceil(math.log(delta) / math.log(1 - risk))


def standing(large: dict[str, int], others: int, risk: float, delta: float) -> tuple[set[str], float]:
    """Strata that are judged by themselves, and the error level of every judged stratum, the pool included. `others` are the
    labels of strata not in `large`. Strata with too few labels go to the pool; while it has too few, the smallest one joins it."""
    alone, pool = dict(large), others
    while True:
        level = delta / max(len(alone) + (pool > 0), 1)
        short = {s for s, n in alone.items() if n < needed(level, risk)}
        if not short and alone and 0 < pool < needed(level, risk):
            short = {min(alone, key=lambda s: (alone[s], s))}
        if not short:
            return set(alone), level
        pool += sum(alone.pop(s) for s in short)


def strictest(rejected: list[int], n: int, risk: float, delta: float, steps=STEPS) -> float | None:
    """The last step, from mild to strict, before the first whose bound on false rejections exceeds the risk."""
    chosen = None
    for step, k in zip(steps, rejected, strict=True):
        if k / max(n, 1) > risk or n == 0 or upper_bound(k, n, delta) > risk:
            break
        chosen = step
    return chosen


def cutoffs(measured_: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, then one cutoff per rule (null: the rule rejects nothing). `risk` holds for all rules of a stratum together, and
    for small strata in the pool of them.

    Good documents are those whose labels all say 1. Documents that fail the base are not the rules' to judge.
    Counts per (stratum, move) are aggregated first, so one stratum is a few hundred rows.
    """
    good = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
            .where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
            .where("q = 1").select("doc_id"))
    held = measured_.where("not base_failed").join(good, "doc_id", "left_semi")
    # Number of the mildest step that a value reaches (step i is 1 - i/40), and with it the first move that rejects it.
    def first(place: int, name: str):
        moves = [PATH.index((place, i)) for i in range(len(STEPS))] + [len(PATH)]
        step = F.least(F.ceil(F.round((1 - F.col(name)) * 40, 9)).cast("int"), F.lit(len(STEPS)))
        return F.array(*map(F.lit, moves))[F.greatest(step, F.lit(0))]
    counted = (held.select("stratum", F.least(*[first(i, n) for i, n in enumerate(RULES)]).alias("move"))
               .groupBy("stratum", "move").agg(F.count("*").alias("n")))
    # Strata that could stand alone, of which there are fewer than labels over `needed(delta)`.
    sizes = counted.groupBy("stratum").agg(F.sum("n").alias("n"))
    large = {r["stratum"]: r["n"] for r in sizes.where(F.col("n") >= needed(delta, risk)).collect()}
    alone, level = standing(large, (sizes.agg(F.sum("n")).first()[0] or 0) - sum(large.values()), risk, delta)
    pooled = F.when(F.col("stratum").isin(sorted(alone)), F.col("stratum")) if alone else F.lit(None).cast("string")

    def choose(frame):
        import pandas as pd
        counts = np.zeros(len(PATH) + 1, np.int64)
        np.add.at(counts, frame["move"].to_numpy(), frame["n"].to_numpy())
        last = strictest(np.cumsum(counts)[:-1].tolist(), int(counts.sum()), risk, level, range(len(PATH)))
        cut: dict = dict.fromkeys(RULES)
        for rule, step in PATH[:0 if last is None else last + 1]:
            cut[RULES[rule]] = STEPS[step]
        out = {"pool": [frame["pool"].iloc[0]]} | {f"cut_{n}": [v] for n, v in cut.items()}
        return pd.DataFrame(out).astype({f"cut_{n}": "float64" for n in RULES})
    cut = ", ".join(f"cut_{r} double" for r in RULES)
    judged = (counted.withColumn("pool", F.coalesce(F.concat(F.lit("="), pooled), F.lit(""))).groupBy("pool", "move").agg(F.sum("n").alias("n"))
              .groupBy("pool").applyInPandas(choose, f"pool string, {cut}"))
    # A language without a label is in no pool: nothing is known of it.
    every = sizes.select("stratum").withColumn("pool", F.coalesce(F.concat(F.lit("="), pooled), F.lit("")))
    return every.join(judged, "pool").select("stratum", *[f"cut_{r}" for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, written, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_rules.

    One row per row of `docs`. Null and empty texts count nothing and fail the base; a null language is a stratum of
    its own; ids may be null or repeat; labels may be empty (then only the base rejects). Other columns are not read.
    """
    table = written(signals(docs), "quality-signals")
    cuts = written(cutoffs(table, labels, risk, delta), "quality-cutoffs")
    failed = F.filter(F.array(*[F.when(F.col(r) >= F.col(f"cut_{r}") - 1e-12, F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    return (table.join(cuts, "stratum", "left").withColumn("failed_rules", F.array_join(failed, ","))
            .withColumn("kept", F.expr("not base_failed and failed_rules = ''"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    "failed_rules"))
