"""Quality classifier: Bradley-Terry ranking of documents by their text features.

A pair of a label-1 and a label-0 document is a game that the former wins; the logistic loss
of the difference of two documents' scores is minimised over the weights of a linear score of
their features. The score at the quantile that label 0 fills becomes the threshold, and scores
are shown as the probability to beat a document there, shifted so that the threshold reads 0.3.

Every labelled document that is not held out is learnt from, whole. Their features are written
once, dealt by hash into groups; games are played inside a group, and a label with few documents
lends them to several groups. A step of Newton's method is one pass that sums groups, in whole
numbers, so that reruns agree; only sums, of the features' number squared, come to the driver.

Features are ratios of whole texts: byte classes, word and line lengths, repeats. Null
and empty texts have the features of an empty text and get a score like others. Without
labels of both kinds the score is the share of label 1 (0.5 without any). Repeated
rows each get their score; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import staged
from stationlake.llm.labelled import held_out

#: Games of each label-0 document, and the penalty of a weight.
GAMES, PENALTY = 20, 1.0
THRESHOLD = 0.3
#: Documents of a group, the fewest of a label in it (lent ones included), and groups of a file.
GROUP, FEWEST, PER_FILE = 2048, 64, 8
#: Parts of one in which sums over groups are counted, and bins or values that a step to a quantile collects.
PARTS, BINS = 1 << 20, 4096
_EPS = 1e-3


def features(text: str | None) -> np.ndarray:
    raw = (text or "").encode()
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, chars = max(1, len(words)), max(1, len(raw))
    lengths = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1, np.int32)
    pairs = list(zip(words, words[1:]))
    low, high, digit = count[97:123].sum(), count[65:91].sum(), count[48:58].sum()
    end = count[33] + count[46] + count[63]
    mark = count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()
    ratios = np.array([
        low / chars, high / chars, digit / chars, mark / chars, (mark - end - count[44]) / n, end / n, count[33] / n,
        count[124] / n, count[128:].sum() / chars, high / max(1, low + high), lengths.mean() / 10, lengths.std() / 10,
        len(set(words)) / n, len(set(pairs)) / max(1, len(pairs)), sum(a == b for a, b in pairs) / n,
        len(set(lines)) / max(1, len(lines)), len(lines) / n, (lengths <= 3).sum() / n, (lengths >= 15).sum() / n,
    ])
    return np.concatenate([ratios, np.log(ratios + _EPS), [np.log1p(len(words)), 1.0 * (len(words) < 20)],
                           np.sqrt(count[32:127] / chars)])


@dataclass
class Ranking:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights
        return 1 / (1 + np.exp(-np.clip(raw - self.threshold + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


def _constant(good: int, n: int, d: int) -> Ranking:
    """The score of every text where labels of both kinds are missing."""
    share = min(max(good / n if n else 0.5, 1e-6), 1 - 1e-6)
    return Ranking(np.zeros(d), np.ones(d), np.zeros(d), np.log(THRESHOLD / (1 - THRESHOLD)) - np.log(share / (1 - share)))


def _games(label: np.ndarray, own: np.ndarray, games: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Losers and winners: every own label-0 row plays ``games`` label-1 rows, every own label-1 row one of label 0."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    own_good, own_bad = good[own[good]], bad[own[bad]]
    if not len(good) or not len(bad):
        return good[:0], good[:0]
    rng = np.random.default_rng(seed)
    losers = np.concatenate([np.repeat(own_bad, games), rng.choice(bad, len(own_good))])
    winners = np.concatenate([rng.choice(good, len(own_bad) * games), own_good])
    return losers, winners


def _slopes(z: np.ndarray, losers: np.ndarray, winners: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the games' logistic loss at ``w``."""
    grad, hess = np.zeros(len(w)), np.zeros((len(w), len(w)))
    for at in range(0, len(losers), 8192):
        diff = z[winners[at:at + 8192]] - z[losers[at:at + 8192]]
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # that the loser would have won
        grad -= diff.T @ p
        hess += (diff * (p * (1 - p))[:, None]).T @ diff
    return grad, hess


def _newton(d: int, slopes: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], penalty: float, rounds: int) -> np.ndarray:
    w = np.zeros(d)
    for _ in range(rounds):
        grad, hess = slopes(w)
        step = np.linalg.solve(hess + penalty * np.eye(d), grad + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(x: np.ndarray, label: np.ndarray, games: int = GAMES, penalty: float = PENALTY, rounds: int = 25) -> Ranking:
    """Newton's method on the games' logistic loss of rows at hand; each label-0 row plays ``games`` label-1 rows."""
    d, n_bad = x.shape[1], int((label == 0).sum())
    if not n_bad or not (label == 1).any():
        return _constant(int((label == 1).sum()), len(label), d)
    centre, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - centre) / scale, -8, 8)
    losers, winners = _games(label, np.ones(len(label), bool), games, 11)
    w = _newton(d, lambda w: _slopes(z, losers, winners, w), penalty, rounds)
    # where the rows' scores, ordered, pass from label 0's share to label 1's: between the two
    raw = np.sort(z @ w)
    return Ranking(centre, scale, w, float((raw[n_bad - 1] + raw[min(n_bad, len(raw) - 1)]) / 2))


def learnable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, label and features (doubles as bytes) of every labelled document that is not held out, one row of an id:
    of several rows the text with the smallest hash counts, of several labels the smallest. Labels of other values and
    ids without a document are left out. Texts are not moved, only their features."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    known = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[["doc_id", "_none", "_h"]].assign(x=[features(t).tobytes() for t in f["text"]])

    kind = known.schema["doc_id"].dataType.simpleString()
    found = known.select("doc_id", F.col("text").isNull().alias("_none"), F.xxhash64("text").alias("_h"), "text") \
        .mapInPandas(measured, f"doc_id {kind}, _none boolean, _h long, x binary")
    one = found.groupBy("doc_id").agg(F.min_by("x", F.struct("_none", "_h")).alias("x"))
    return one.join(marked, "doc_id").select("doc_id", "label", "x")


def dealt(rows: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """``rows`` in groups with documents of both labels, written so that a group lies in one file and row group. Where a
    label has few documents each is lent to further groups; ``own`` is true once for each document."""
    groups = max(1, -(-(n_good + n_bad) // GROUP))
    lent = {label: min(groups, -(-FEWEST * groups // n)) for label, n in ((1, n_good), (0, n_bad))}
    times = F.when(F.col("label") == 1, lent[1]).otherwise(lent[0])
    draw = F.xxhash64("doc_id")
    spread = rows.select("label", "x", draw.alias("draw"), "doc_id", F.explode(F.sequence(F.lit(0), times - 1)).alias("_j"))
    spread = spread.select(F.pmod(F.pmod("draw", F.lit(groups)) + F.col("_j"), F.lit(groups)).cast("int").alias("group"),
                           (F.col("_j") == 0).alias("own"), "label", "x", "draw", "doc_id")
    files = -(-groups // PER_FILE)
    return staged(spread.repartition(files, "group").sortWithinPartitions("group", "draw", "doc_id", "own"), "quality-groups")


def _per_group(rows: DataFrame, body: Callable, schema: str) -> DataFrame:
    """``body(group, label, own, x)`` of every group of dealt rows; its frames."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def done() -> pd.DataFrame:
            f = pd.concat(held, ignore_index=True)
            x = np.frombuffer(b"".join(f["x"]), np.float64).reshape(len(f), -1)
            return body(int(f["group"].iloc[0]), f["label"].to_numpy(int), f["own"].to_numpy(bool), x)

        for frame in frames:
            for _, f in frame.groupby("group", sort=True):
                if held and held[0]["group"].iloc[0] != f["group"].iloc[0]:
                    yield done()
                    held = []
                held.append(f)
        if held:
            yield done()

    return rows.select("group", "label", "own", "x").mapInPandas(run, schema)


def _sums(rows: DataFrame, of: Callable) -> np.ndarray:
    """The sum over all groups of what ``of`` gives for each, an array; one row a group comes to the driver, added up exactly."""
    found = _per_group(rows, lambda g, label, own, x: pd.DataFrame({"s": [of(x[own]).tobytes()]}), "s binary").collect()
    parts = [np.frombuffer(r["s"], np.float64) for r in found]
    return np.array([math.fsum(c) for c in zip(*parts)])


def value_at(raw: DataFrame, n: int, k: int) -> float:
    """The value with ``k`` of the ``n`` values of column ``raw`` before it, in order; found by counting bins."""
    low, high = raw.agg(F.min("raw"), F.max("raw")).first()
    rest = raw
    while n > BINS and low < high:
        bin_ = F.least(F.floor((F.col("raw") - low) / (high - low) * BINS), F.lit(BINS - 1))
        for r in rest.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high")).orderBy("b").collect():
            if k < r["n"]:
                break
            k -= r["n"]
        n, low, high = r["n"], r["low"], r["high"]
        rest = raw.where(F.col("raw").between(low, high))
    return low if low == high else sorted(r["raw"] for r in rest.collect())[k]


def train(docs: DataFrame, labels: DataFrame, games: int = GAMES, penalty: float = PENALTY, rounds: int = 25) -> Ranking:
    """The ranking learnt from every labelled document that is not held out."""
    d = len(features(""))
    rows = staged(learnable(docs, labels), "quality-features")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_good, n_bad = counts.get(1, 0), counts.get(0, 0)
    n = n_good + n_bad
    if not n_good or not n_bad:
        return _constant(n_good, n, d)
    rows = dealt(rows, n_good, n_bad)
    centre = _sums(rows, lambda x: x.sum(0)) / n
    scale = np.sqrt(_sums(rows, lambda x: ((x - centre) ** 2).sum(0)) / n) + 1e-6
    upper = np.triu_indices(d)

    def slopes(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def of(group, label, own, x):
            z = np.clip((x - centre) / scale, -8, 8)
            grad, hess = _slopes(z, *_games(label, own, games, 11 + group), w)
            whole = np.rint(np.concatenate([grad, hess[upper]]) * PARTS).astype(np.int64)
            return pd.DataFrame({"i": np.arange(len(whole)), "v": whole})

        found = _per_group(rows, of, "i long, v long").groupBy("i").agg(F.sum("v").alias("v")).toPandas().sort_values("i")
        total = found["v"].to_numpy(np.float64) / PARTS
        hess = np.zeros((d, d))
        hess[upper] = total[d:]
        return total[:d], hess + np.triu(hess, 1).T

    w = _newton(d, slopes, penalty, rounds)
    raw = staged(_per_group(rows, lambda g, label, own, x: pd.DataFrame({"raw": np.clip((x[own] - centre) / scale, -8, 8) @ w}), "raw double"), "quality-raw")
    # where the scores, ordered, pass from label 0's share to label 1's: between the two
    return Ranking(centre, scale, w, (value_at(raw, n, n_bad - 1) + value_at(raw, n, min(n_bad, n - 1))) / 2)


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; one pass, no shuffle."""

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = np.array([features(t) for t in f["text"]])
            yield pd.DataFrame({"doc_id": f["doc_id"], "score": model.score(x) if len(f) else np.zeros(0)})

    out = docs.select(docs["doc_id"].cast("string").alias("doc_id"), docs["text"]).mapInPandas(scored, "doc_id string, score double") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), "score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
