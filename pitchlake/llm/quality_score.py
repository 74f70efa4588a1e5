"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

1. A pass over the texts turns each document into ``STATS`` (shape of words,
   lines and repeats; never the label, language, source or id).
2. The statistics are standardised with means and deviations over all
   documents, and mapped to random Fourier features, which approximate a
   Gaussian kernel: ``sqrt(2 / n) * cos(x W + b)``, seeded.
3. Each partition of labelled training rows sums its normal equations per
   fold (``Z'Z``, ``Z'y``), the sums are added in two levels, and the driver
   solves ridge systems of ``n_features + 1`` unknowns: one for all folds, and
   one without each fold.
4. Scores of a fold by the model without it give honest pairs (score, label).
   They are summed in ``BINS`` equal bins and pooled to a rising step curve
   (isotonic calibration), which maps raw scores into 0 to 1.

Memory: a task holds one Arrow batch and a few (n_features + 2)^2 sums; the
driver holds ``SUM_GROUPS`` such sums and ``BINS`` bins, whatever the input.

Edge cases: null and empty texts have the statistics of no words, and get a
score like any other row.  Rows with equal texts get equal scores.  Labels
that are null, or of ids that are no document, are not used; a repeated label
counts each time.  Without a usable label every score is ``NO_LABEL_SCORE``
(nothing is rejected on no evidence).  An empty table gives an empty result.
Columns of ``docs`` beside doc_id and text are passed through unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from pitchlake.llm.common import id_crc, staged

N_FEATURES = 160
#: Width of the Gaussian kernel, in standard deviations of a statistic.
WIDTH = 4.0
RIDGE = 1e-3
BINS = 512
SUM_GROUPS = 8
SEED = 20
THRESHOLD = 0.3
NO_LABEL_SCORE = 1.0

#: Fixed by the result contract: the remainder 0 of 5 is held out.
FOLDS = 5
HELD_OUT = 0

STATS = ("log_words", "word_length", "symbols", "digits", "upper", "punctuation", "pipes", "distinct_words",
         "top_word", "runs", "dup_lines", "words_per_line", "symbol_words", "repeated_pairs", "longest_word",
         "short_words")

_SYMBOLS = frozenset("#*$%&|<>~^_=+{}[]\\@")
_SYMBOL = re.compile("[" + re.escape("".join(sorted(_SYMBOLS))) + "]")
_PUNCT = re.compile(r"[.,;:!?]")
_DIGIT = re.compile(r"[0-9]")


def text_stats(text: str | None) -> list[float]:
    """The statistics of a text, each in a range of about 0 to 10."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATS)
    n_chars = max(1, len(text))
    lengths = np.fromiter(map(len, words), np.int32, n)
    codes: dict[str, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(codes) + ids[1:]
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    symbols = len(_SYMBOL.findall(text))
    upper = sum(map(str.isupper, words))
    ends = sum(1 for w in words if w[-1] in _SYMBOLS)
    return [np.log1p(n), lengths.mean() / 2, 10.0 * symbols / n_chars, 10.0 * len(_DIGIT.findall(text)) / n_chars,
            3.0 * upper / n, 10.0 * len(_PUNCT.findall(text)) / n_chars, 5.0 * words.count("|") / n,
            3.0 * len(codes) / n, 5.0 * int(np.bincount(ids).max()) / n, 5.0 * float((ids[1:] == ids[:-1]).sum()) / n,
            5.0 * (1 - len(set(lines)) / max(1, len(lines))), np.log1p(n / max(1, len(lines))), 3.0 * ends / n,
            5.0 * (1 - len(np.unique(pairs)) / max(1, len(pairs))), np.log1p(lengths.max()),
            3.0 * float((lengths <= 3).mean())]


@F.pandas_udf(ArrayType(FloatType()))
def stats_column(texts: pd.Series) -> pd.Series:
    return texts.map(text_stats)


def with_stats(docs: DataFrame, name: str = "_stats") -> DataFrame:
    return docs.withColumn(name, stats_column("text"))


@dataclass
class QualityModel:
    """Bounded by its parameters: a few thousand numbers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None      # None: no labels
    bins: np.ndarray | None = None         # raw score of each bin's middle
    curve: np.ndarray | None = None

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return features(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), NO_LABEL_SCORE)
        return np.interp(self.raw(stats), self.bins, self.curve)


def features(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray, n: int = N_FEATURES,
             width: float = WIDTH) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(size=(stats.shape[1], n)) / width
    b = rng.uniform(0, 2 * np.pi, n)
    x = np.clip((stats - mean) / scale, -8, 8)
    z = np.cos(x @ w + b) * np.sqrt(2.0 / n)
    return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def _blob(a: np.ndarray) -> bytes:
    return a.astype("<f8").tobytes()


def normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Per fold the sum of ``[Z y]' [Z y]`` over the training rows (_stats, _y, _fold)."""
    size = N_FEATURES + 2

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            if not len(pdf):
                continue
            z = features(np.stack(pdf["_stats"].to_numpy()).astype(float), mean, scale)
            zy = np.concatenate([z, pdf["_y"].to_numpy(float)[:, None]], axis=1)
            fold = pdf["_fold"].to_numpy()
            for f in np.unique(fold):
                sums[int(f)] = sums.get(int(f), 0) + zy[fold == f].T @ zy[fold == f]
        if sums:
            group = TaskContext.get().partitionId() % SUM_GROUPS
            yield pd.DataFrame({"group": [group] * len(sums), "fold": list(sums),
                                "sums": [_blob(x) for x in sums.values()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<f8") for x in pdf["sums"])
        return pd.DataFrame({"fold": [pdf["fold"].iloc[0]], "sums": [_blob(total)]})

    parts = rows.select("_stats", "_y", "_fold").mapInPandas(part, "group int, fold int, sums binary")
    out: dict[int, np.ndarray] = {}
    for r in parts.groupBy("group", "fold").applyInPandas(add, "fold int, sums binary").collect():
        out[r["fold"]] = out.get(r["fold"], 0) + np.frombuffer(r["sums"], "<f8").reshape(size, size)
    return out


def ridge(sums: np.ndarray, strength: float = RIDGE) -> np.ndarray:
    """Solve the penalised normal equations (the constant is not penalised)."""
    a, y = sums[:-1, :-1], sums[:-1, -1]
    n = max(1.0, a[-1, -1])
    penalty = np.full(len(a), strength * n + 1e-6)
    penalty[-1] = 1e-9
    return np.linalg.solve(a + np.diag(penalty), y)


def isotonic(n: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the rising step values of bins with n rows and sum y."""
    blocks: list[list[float]] = []
    for weight, total in zip(n, y, strict=True):
        blocks.append([weight, total, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w, t, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + t, blocks[-1][2] + k]
    return np.concatenate([np.full(k, t / w) for w, t, k in blocks])


def calibrate(rows: DataFrame, model: QualityModel, without: dict[int, np.ndarray],
              low: float = -0.5, high: float = 1.5) -> QualityModel:
    """Fit the rising curve on scores by the models that did not see the row's fold."""
    mean, scale = model.mean, model.scale

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, y = np.zeros(BINS), np.zeros(BINS)
        for pdf in batches:
            if not len(pdf):
                continue
            z = features(np.stack(pdf["_stats"].to_numpy()).astype(float), mean, scale)
            fold = pdf["_fold"].to_numpy()
            raw = np.zeros(len(pdf))
            for f in np.unique(fold):
                raw[fold == f] = z[fold == f] @ without[int(f)]
            at = np.clip(((raw - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
            n += np.bincount(at, minlength=BINS)
            y += np.bincount(at, weights=pdf["_y"].to_numpy(float), minlength=BINS)
        some = np.flatnonzero(n)
        yield pd.DataFrame({"bin": some, "n": n[some], "y": y[some]})

    bins = (rows.select("_stats", "_y", "_fold").mapInPandas(part, "bin int, n double, y double")
            .groupBy("bin").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).toPandas().sort_values("bin"))
    model.bins = low + (bins["bin"].to_numpy() + 0.5) * (high - low) / BINS
    model.curve = np.clip(isotonic(bins["n"].to_numpy(), bins["y"].to_numpy()), 0.0, 1.0)
    return model


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """``stats``: doc_id, _stats of every document; ``labels``: doc_id, quality."""
    n = len(STATS)
    moments = stats.select(*[F.struct(F.avg(F.get("_stats", F.lit(i)).cast("double")).alias("m"),
                                      F.stddev_pop(F.get("_stats", F.lit(i)).cast("double")).alias("s")).alias(f"c{i}")
                             for i in range(n)]).first()
    mean = np.array([x["m"] or 0.0 for x in moments])
    model = QualityModel(mean, np.maximum(np.array([x["s"] or 0.0 for x in moments]), 1e-3))
    known = (labels.select("doc_id", F.col("quality").cast("int").alias("_y"))
             .filter("_y IN (0, 1)").withColumn("_fold", (id_crc(F.col("doc_id")) % FOLDS).cast("int"))
             .filter(F.col("_fold") != HELD_OUT))
    rows = staged(stats.select("doc_id", "_stats").join(known, "doc_id"), "quality-rows")
    sums = normal_equations(rows, mean, model.scale)
    if not sums:
        return model
    total = sum(sums.values())
    model.weights = ridge(total)
    without = {f: ridge(total - x) if len(sums) > 1 else model.weights for f, x in sums.items()}
    return calibrate(rows, model, without)


def score_column(spark: SparkSession, model: QualityModel):
    """A column function of ``_stats``; the model is a few thousand numbers."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def score(stats: pd.Series) -> pd.Series:
        if not len(stats):
            return pd.Series([], dtype="float64")
        return pd.Series(sent.value.score(np.stack(stats.to_numpy()).astype(float)))
    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    stats = staged(with_stats(docs.select("doc_id", "text")).drop("text"), "quality-stats")
    score = score_column(docs.sparkSession, fit(stats, labels))
    return (stats.withColumn("score", score("_stats"))
            .select("doc_id", (id_crc(F.col("doc_id")) % FOLDS == HELD_OUT).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with the columns of ``docs``.

    The second pass derives the statistics again from the text beside the
    other columns, so texts are never shuffled.
    """
    names = docs.columns
    stats = staged(with_stats(docs.select("doc_id", "text")).drop("text"), "quality-stats")
    score = score_column(docs.sparkSession, fit(stats, labels))
    return docs.filter(score(stats_column("text")) >= THRESHOLD).select(*names)
