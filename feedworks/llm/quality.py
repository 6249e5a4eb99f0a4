"""Quality classifier: Naive Bayes support vectors.

Indicators of word n-grams and of token-shape n-grams are scaled by the log ratio of
their smoothed class counts; a linear hinge-loss model over them is fitted by dual
coordinate descent (Hsieh et al. 2008, Wang and Manning 2012).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, pack_texts, ship, span_hashes, stored, text_slices, word_bounds

#: Byte classes of token shapes: lower, upper, digit, beyond ASCII; every other byte is its own.
_CLASS = np.arange(256, dtype=np.uint64) + np.uint64(16)
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[128:] = 4
#: Slices of the sample, taken or left whole.
SLICES = 256


def feature_pairs(texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) pairs, ordered by text.

    Features are hashed to ``bits`` bits: words, pairs of words, and runs of one to
    three token shapes.  A shape has the classes of the token's first, second and
    last byte, and whether the token repeats the one before it.  A null or empty
    text has none.
    """
    b, offsets = pack_texts(texts)
    starts, ends = word_bounds(b)
    h = span_hashes(b, starts, ends)
    doc = np.searchsorted(offsets, starts, "right") - 1
    same = np.zeros(len(h), np.uint64)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    second = b[np.minimum(starts + 1, ends - 1)]
    shape = ((_CLASS[b[starts]] << np.uint64(40)) | (_CLASS[second] << np.uint64(24))
             | (_CLASS[b[ends - 1]] << np.uint64(8)) | same)
    odd, seed = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x51ED270B0A1F39C1)
    found = [(doc, h)]
    for back, values in ((1, h), (0, shape), (1, shape), (2, shape)):
        n = len(doc) - back
        if n <= 0:
            continue
        grown = values[back:].copy()
        for k in range(back):
            grown = grown * odd + values[k:k + n] + np.uint64(k + 1)
        if values is shape:
            grown = grown + seed * np.uint64(back + 1)
        inside = doc[:n] == doc[back:]
        found.append((doc[back:][inside], mix64(grown[inside])))
    keys = np.concatenate([(d.astype(np.uint64) << np.uint64(bits)) | (f >> np.uint64(64 - bits))
                           for d, f in found])
    keys = np.unique(keys)
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64((1 << bits) - 1)).astype(np.int32)


def fit_hinge(docs: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float,
              epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for min 1/2 |w|^2 + cost * sum of hinge losses.

    Row i has the values ``ratio`` at its features, scaled to length one, and a
    constant one for the bias.  Returns w already multiplied by ``ratio``, and the bias.
    """
    rng = np.random.default_rng(seed)
    rows = []
    for f in docs:
        v = ratio[f]
        f, v = f[v != 0], v[v != 0]
        rows.append((f, v / max(np.sqrt((v * v).sum()), 1e-12)))
    w, bias = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([float((v * v).sum()) + 1.0 for _, v in rows])
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            f, v = rows[i]
            g = y[i] * (float(w[f] @ v) + bias) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), cost)
            if (step := (new - alpha[i]) * y[i]) != 0.0:
                worst = max(worst, abs(step))
                alpha[i] = new
                w[f] += step * v
                bias += step
        if worst < 1e-3 * cost:
            break
    return w * ratio, bias


@dataclass
class QualityModel:
    """Fitted weights by hashed feature; ``score`` makes a column of them."""

    bits: int
    features: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    scale: float = 4.0

    def margins(self, texts) -> np.ndarray:
        ratio, weight = np.zeros(1 << self.bits, np.float32), np.zeros(1 << self.bits, np.float32)
        ratio[self.features], weight[self.features] = self.ratios, self.weights
        out = np.full(len(texts), self.bias)
        for lo, hi in text_slices(texts):
            doc, f = feature_pairs(texts[lo:hi], self.bits)
            dot = np.bincount(doc, weight[f].astype(float), hi - lo)
            norm = np.sqrt(np.bincount(doc, ratio[f].astype(float) ** 2, hi - lo))
            out[lo:hi] += dot / np.maximum(norm, 1e-12)
        return out

    def score(self, spark, text: Column) -> Column:
        """Probability-like score in 0 to 1 of a text; one half lies on the margin."""
        held = spark.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def scored(s: pd.Series) -> pd.Series:
            model = held.value
            return pd.Series(1.0 / (1.0 + np.exp(-np.clip(model.scale * model.margins(s.tolist()), -500, 500))))

        return scored(text)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = 16000, max_bytes: int = 256 << 20, bits: int = 18,
        min_docs: int = 3, cost: float = 1.0, epochs: int = 30, seed: int = 7) -> QualityModel:
    """Fit on the labelled ``docs``.

    ``max_rows`` bounds the labelled rows learnt from (the documented bound): where
    there are more, rows are taken by a hash of their id with that expected number.
    ``max_bytes`` bounds their features (four bytes each, 2**bits at most in one text): the
    sample is cut by a hash of the id into ``SLICES`` slices, and one that doesn't fit into what
    the slices before it left is not learnt from.  So neither very long texts nor an id on
    very many rows fill the one task that fits.
    A document with several labels has their majority (a tie counts as 0); null ids
    and null labels are ignored.  With one class or no labels at all the model is the
    constant that fits.  Label counts and the sample's features are all that is
    gathered: at most ``max_bytes`` in one task, 2**bits weights on the driver.
    """
    given = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__y"))
             .where("__id IS NOT NULL AND __y IS NOT NULL").groupBy("__id")
             .agg((F.avg("__y") > 0.5).cast("int").alias("__y")))
    ship(docs.sparkSession)
    n = given.count()
    share = min(1.0, max_rows / max(n, 1))
    picked = given.where(F.pmod(F.xxhash64("__id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # the sample has at most about max_rows ids, 12 bytes each
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t"))
            .join(F.broadcast(picked), "__id"))

    def features(batches):
        for batch in batches:
            texts = batch["__t"].tolist()
            out: list[bytes] = []
            for lo, hi in text_slices(texts):
                doc, f = feature_pairs(texts[lo:hi], bits)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                out += [f[cut[i]:cut[i + 1]].tobytes() for i in range(hi - lo)]
            yield pd.DataFrame({"g": 0, "id": batch["__id"], "y": batch["__y"], "f": out})

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        docs_, y = [np.frombuffer(x, np.int32) for x in pdf["f"]], pdf["y"].to_numpy() * 2.0 - 1.0
        size = 1 << bits
        count = {s: np.zeros(size) for s in (-1.0, 1.0)}
        for f, s in zip(docs_, y):
            count[s][f] += 1
        p, q = count[1.0] + 1.0, count[-1.0] + 1.0
        ratio = np.log((p / p.sum()) / (q / q.sum()))
        ratio[count[1.0] + count[-1.0] < min_docs] = 0.0
        w, bias = fit_hinge(docs_, y, ratio, cost, epochs, seed)
        at = np.flatnonzero(ratio).astype(np.int32)
        return pd.DataFrame({"at": [at.tobytes()], "r": [ratio[at].astype(np.float32).tobytes()],
                             "w": [w[at].astype(np.float32).tobytes()], "bias": [float(bias)]})

    sample = stored(rows.mapInPandas(features, "g int, id long, y int, f binary"), "quality-sample")
    part = F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(SLICES))
    taken, total = [], 0
    for r in sample.groupBy(part.alias("part")).agg(F.sum(F.length("f")).alias("n")).orderBy("part").collect():  # SLICES rows at most
        if total + r["n"] <= max_bytes:
            taken.append(r["part"])
            total += r["n"]
    got = (sample.where(part.isin(taken)).groupBy("g")
           .applyInPandas(learn, "at binary, r binary, w binary, bias double").collect())
    if not got:
        none = np.zeros(0, np.float32)
        return QualityModel(bits, np.zeros(0, np.int32), none, none, 0.0)
    r = got[0]
    return QualityModel(bits, np.frombuffer(r["at"], np.int32), np.frombuffer(r["r"], np.float32),
                        np.frombuffer(r["w"], np.float32), r["bias"])


def held_out(id_col: str, folds: int) -> Column:
    """Rows whose crc32 of the id as text is divisible by ``folds`` (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, *, folds: int = 5, threshold: float = 0.3,
                  **fit_args) -> DataFrame:
    """doc_id, held_out, score, predicted of every document (op1's contract).

    Null texts score like empty ones; repeated rows score alike, each in its own row;
    empty tables give no rows.  Other columns of ``docs`` are not read.
    """
    model = fit(docs.where(~held_out("doc_id", folds)), labels, **fit_args)
    scored = docs.select("doc_id", held_out("doc_id", folds).alias("held_out"),
                         model.score(docs.sparkSession, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, *, folds: int = 5, threshold: float = 0.3, **fit_args) -> DataFrame:
    """The rows of ``docs``, all their columns, whose text scores ``threshold`` or more."""
    model = fit(docs.where(~held_out("doc_id", folds)), labels, **fit_args)
    return docs.where(model.score(docs.sparkSession, F.col("text")) >= threshold)
