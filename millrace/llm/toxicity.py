"""Toxicity by two class-conditional Kneser-Ney bigram models.

Both models back off from bigrams of their own class, over continuation counts of their own class, to continuation
counts that the classes share. Expressions in few training texts, or in about as many of either class, have no counts
of their own: a word backs off to its longest stem (its first letters, ``STEMS``) that has some; failing that, both models
take it from the shared counts, so that topic and language take no side. A text's score is a logistic function, fitted on training texts that gave no counts, of the difference of its two log-likelihoods per word.

The training rows are a bounded sample (``max_rows`` a class, those with the smallest hash of their id); what it gives
is bounded by ``max_ngrams``. Scoring is one pass over the texts with the model broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, text_of, worker_state

WORDS = re.compile(r"\w+").findall
START = "\x02"
#: Margins below this, in nats per word, count about in proportion.
LINEAR = 0.02
STEMS = range(4, 9)


@dataclass
class Model:
    """ids: word -> row of the tables, 0 for all others. Column 0 of a table is the ordinary class, 1 the toxic one."""

    ids: dict[str, int]
    word: np.ndarray  # log P(word), a row per word
    back: np.ndarray  # log of the weight that a context leaves to single words
    keys: np.ndarray  # sorted context * rows + word
    pair: np.ndarray  # log P(word | context) of these
    slope: float = 1.0
    shift: float = 0.0
    seen: dict[str, int] = field(default_factory=dict)  # a cache

    def row(self, word: str) -> int:
        """Of the word itself or its longest stem that has counts."""
        found = self.seen.get(word)
        if found is None:
            found = self.ids.get(word, 0)
            for n in reversed(STEMS):
                if found or n >= len(word):
                    continue
                found = self.ids.get(word[:n] + "*", 0)
            if len(self.seen) >= 100_000:
                self.seen.clear()
            self.seen[word] = found
        return found

    def likelihoods(self, text: str) -> tuple[float, float, int]:
        """Log-likelihoods (ordinary, toxic) and words of a text."""
        words = WORDS(text.lower())
        if not words:
            return 0.0, 0.0, 0
        ids = np.fromiter(map(self.row, words), np.int64, len(words))
        before = np.concatenate(([self.ids.get(START, 0)], ids[:-1]))
        found = self.back[before] + self.word[ids]
        if len(self.keys):
            keys = before * len(self.word) + ids
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            found[hit] = self.pair[at[hit]]
        total = found.sum(axis=0)
        return float(total[0]), float(total[1]), len(words)

    def margin(self, text: str) -> float:
        """Toxic minus ordinary log-likelihood per word, on a scale that is logarithmic away from 0; 0 without words."""
        plain, toxic, n = self.likelihoods(text)
        return math.asinh((toxic - plain) / n / LINEAR) if n else 0.0

    def score(self, text: str) -> float:
        z = self.slope * self.margin(text) + self.shift
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def learned(doc_id: Column) -> Column:
    """Whether labels of this id may be used: crc32 of the id as text is not divisible by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def _grams(batches):
    """Per thirty texts: occurrences and texts by class of bigrams and, without a context, of words and stems."""
    for frame in (f.iloc[i : i + 30] for f in batches for i in range(0, len(f), 30)):
        n, texts = Counter(), Counter()
        for text, y in zip(frame["text"], frame["y"]):
            words = WORDS(text.lower())
            pairs = list(zip([START, *words], words))
            n.update((h, w, y) for h, w in pairs)
            stems = [("", w[:k] + "*") for w in words for k in STEMS if k < len(w)]
            n.update((h, w, y) for h, w in stems)
            texts.update((h, w, y) for h, w in {*pairs, *stems, *(("", w) for w in words)})
        rows = [(h, w, n[h, w, y] * (1 - y), n[h, w, y] * y, c * (1 - y), c * y) for (h, w, y), c in texts.items()]
        yield pd.DataFrame(rows, columns=["h", "w", "n0", "n1", "d0", "d1"])


def _tables(grams: DataFrame, texts: tuple[int, int], least_texts: int, max_ngrams: int, discount: float, sigmas: float = 2.5, ratio: float = 4.0) -> Model:
    """The two models from counts and numbers of texts by class (h, w, n0, n1, d0, d1); h is empty for single words.

    Counts of its own: an expression in ``least_texts`` texts whose rates differ by ``sigmas`` deviations and ``ratio``-fold.
    """
    rate = [(F.col(f"d{y}") + F.lit(0.5)) / F.lit(float(texts[y])) for y in (0, 1)]
    pooled = (F.col("d0") + F.col("d1")) / F.lit(float(sum(texts)))
    apart = F.abs(rate[0] - rate[1]) >= sigmas * F.sqrt(pooled * F.lit(1 / texts[0] + 1 / texts[1]))
    kept = grams.where((F.col("d0") + F.col("d1") >= least_texts) & apart & (F.greatest(*rate) >= ratio * F.least(*rate)))
    first = [(F.col("d0") + F.col("d1")).desc(), "h", "w"]
    pairs_kept = kept.where("h <> ''").orderBy(*first).limit(max_ngrams).collect()
    alone = kept.where("h = ''").orderBy(*first).limit(max_ngrams).collect()
    own = {r["w"] for r in alone}
    words = sorted({*own, *(r["w"] for r in pairs_kept), *(r["h"] for r in pairs_kept)})
    ids = {w: i + 1 for i, w in enumerate(words)}
    pairs = grams.where("h <> ''")
    seen = [F.count_if(F.col(c) > 0).alias(a) for c, a in (("n0", "t0"), ("n1", "t1"))]
    spark = grams.sparkSession
    small = spark.createDataFrame([(w,) for w in words], "w string")  # at most 3 * max_ngrams words
    cont = pairs.groupBy("w").agg(*seen)
    after = pairs.groupBy("h").agg(F.sum("n0").alias("c0"), F.sum("n1").alias("c1"), *seen)
    rows = len(ids) + 1
    types, total = np.zeros((rows, 2)), np.array(tuple(cont.agg(F.sum("t0"), F.sum("t1")).first()), float)
    for r in cont.join(small, "w").collect():
        types[ids[r["w"]]] = r["t0"], r["t1"]
    for r in alone:
        if r["w"].endswith("*"):  # stems count by occurrences
            types[ids[r["w"]]] = r["n0"], r["n1"]
    shared = (types / total).mean(axis=1)
    shared[0] = max(1e-12, 1 - shared[[0, *(ids[w] for w in words if not w.endswith('*'))]].sum())
    shared = np.maximum(shared, 1e-12)
    mine = np.array([False, *(w in own for w in words)])
    left = np.maximum(discount * (types[mine] > 0).sum(axis=0) / total, 1e-6)
    p = np.where(mine[:, None], np.maximum(types - discount, 0) / total + left * shared[:, None], shared[:, None])
    back, count = np.ones((rows, 2)), np.zeros((rows, 2))
    for r in after.join(small.withColumnRenamed("w", "h"), "h").collect():
        c, t = np.array((r["c0"], r["c1"]), float), np.array((r["t0"], r["t1"]), float)
        count[ids[r["h"]]] = c
        back[ids[r["h"]]] = np.where(c > 0, discount * t / np.maximum(c, 1), 1.0)
    # Contexts: what a class has not seen after a context is shared out evenly, so that a context alone takes no side.
    back[:] = back.mean(axis=1, keepdims=True)
    keys, values = [], []
    for r in pairs_kept:
        h, w = ids[r["h"]], ids[r["w"]]
        n = np.array((r["n0"], r["n1"]), float)
        keys.append(h * rows + w)
        values.append(np.maximum(n - discount, 0) / np.maximum(count[h], 1) + back[h] * p[w])
    order = np.argsort(keys) if keys else np.zeros(0, np.int64)
    pair = np.log(np.array(values).reshape(-1, 2)[order]) if keys else np.zeros((0, 2))
    return Model(ids, np.log(p), np.log(back), np.array(keys, np.int64)[order], pair)


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, with a weak pull to 0 on the slope."""
    scale = float(np.std(x)) or 1.0
    a = np.column_stack((x / scale, np.ones(len(x))))
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        g = a.T @ (weight * (y - p)) - np.array((1e-2 * b[0], 1e-6 * b[1]))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag((1e-2, 1e-6))
        step = np.linalg.solve(h, g)
        b += np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return float(b[0] / scale), float(b[1])


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 5000, max_ngrams: int = 200_000, discount: float = 0.75
) -> Model | None:
    """The model from labelled rows that aren't held out; None if either class has none.

    Labels without an id or a value are left out; an id with both labels counts as toxic; texts that are equal count
    once. A third of the sample only fits the logistic curve, weighted to the share of the classes in all labels.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learned(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y"))
    share = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not share.get(0) or not share.get(1):
        return None
    rows = min(max_rows, *share.values())  # as many of either class: continuation counts depend on the amount of text
    some = [marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    chosen = F.broadcast(some[0].union(some[1]))  # at most 2 * max_rows ids
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).join(chosen, "doc_id")
    sample = cut(texts.groupBy("text").agg(F.max("y").alias("y")).withColumn("fold", F.pmod(F.xxhash64("text", F.lit(5)), F.lit(3))))
    n = {r["y"]: r["n"] for r in sample.where("fold <> 0").groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    partial = sample.where("fold <> 0").select("text", "y").mapInPandas(_grams, "h string, w string, n0 long, n1 long, d0 long, d1 long")
    grams = cut(partial.groupBy("h", "w").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "d0", "d1")]))
    model = _tables(grams, (n[0], n[1]), max(5, math.ceil(0.01 * n[1])), max_ngrams, discount)

    @F.pandas_udf(T.DoubleType())
    def margin(texts: pd.Series) -> pd.Series:
        return texts.map(model.margin).astype("float64")

    known = sample.where("fold = 0").select("y", margin("text").alias("x")).toPandas()  # at most 2 * max_rows rows
    if known["y"].nunique() < 2:
        known = sample.select("y", margin("text").alias("x")).toPandas()
    y = known["y"].to_numpy(float)
    weight = np.where(y == 1, share[1] / max(1, y.sum()), share[0] / max(1, (1 - y).sum())) * len(y) / (share[0] + share[1])
    model.slope, model.shift = _fit(known["x"].to_numpy(float), y, weight)
    return model


def score_column(docs: DataFrame, model: Model | None, text_col: str = "text") -> Column:
    """The score of each text, 0 to 1. Without a model nothing is known and every score is 0."""
    if model is None:
        return F.lit(0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        worker_state("toxicity")
        return texts.map(shared.value.score).astype("float64")

    return score(text_of(text_col))


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= 0.5).

    Null and empty texts get the score of a text without words. A null id is never held out. Repeated rows stay. If
    either class lacks training rows (or tables are empty) every score is 0. Only id and text of ``docs`` are read.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    held = F.coalesce(~learned(F.col(id_col)), F.lit(False))
    scored = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), score_column(docs, model, text_col).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
