"""Toxicity severity by cumulative-link (proportional odds) regression on sparse word features.

Grades 0 < 1 < ... < K share one weight vector w; thresholds t_1 < ... < t_K cut the scale:

    P(grade >= k) = sigmoid(w x - t_k),   expected severity = sum over k of P(grade >= k).

Features are words present in a text (lower case, ASCII marks cut off) and their first 4 to 8 bytes, so
that endings do not hide a stem; both are hashed to BUCKETS.  Of the buckets in
a bounded sample of labelled rows, those that tell grade 0 from the rest best by a likelihood
ratio are kept.  Weights and thresholds are fitted by gradient steps with a ridge penalty;
thresholds are kept in order by learning the logarithms of their distances.

Where labels only say toxic or not, ``graded`` makes grades: 0 for clean rows, and for toxic ones
1 to 3 by terciles of the number of words that toxic rows hold far more often than clean ones.

The fit takes at most SAMPLE labelled rows, half of them toxic, those of least hash of their doc_id; each
counts as many times as rows of its kind were left out, so probabilities are those of all labelled
rows.  Scoring runs over all rows, by whole texts, in Arrow batches.

Cases: a null text is scored as an empty one; rows with a null label or doc_id are not learned from;
without both kinds of labels the expected severity is the labels' mean grade (0 without any);
repeated rows are scored alike and all returned; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillwarden.llm import wordhash
from tillwarden.llm.shared import texts

BUCKETS = 1 << 20
SAMPLE = 8_000
PREFIXES = (4, 5, 6, 7, 8)
FEATURES = 2_000
STEPS = 400
RIDGE = 1e-3
LEAST_RATIO = 10.0  # likelihood ratio statistic of a feature that is kept
STRONG = 20.0  # a word of severity is this much more frequent in toxic rows

# ASCII marks become blanks, so that "word," and "word" are one feature
_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_BLANKED = bytes.maketrans(_MARKS, b" " * len(_MARKS))


def word_buckets(batch: list[bytes]) -> Iterator[np.ndarray]:
    """The buckets of all words of each text and of their beginnings, with repeats."""
    blanked = [t.translate(_BLANKED) for t in batch]
    for first, last, hashes, offsets in wordhash.word_batches(blanked, lower=True, prefixes=PREFIXES):
        buckets = (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
        for i in range(last - first):
            yield buckets[:, offsets[i] : offsets[i + 1]].ravel()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class OrdinalModel:
    buckets: np.ndarray  # sorted
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def at_least(self, values: np.ndarray) -> np.ndarray:
        """(rows, K): probability of grade k or more, from w x."""
        return _sigmoid(values[:, None] - self.thresholds[None, :])


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, weights: np.ndarray | None = None) -> OrdinalModel:
    """Fit on the distinct buckets, the grade (0 to K) and the weight of each row."""
    top = int(grades.max(initial=0))
    n, toxic = len(rows), int((grades > 0).sum())
    counts = np.ones(n) if weights is None else weights * (n / max(weights.sum(), 1e-9))

    def reaching(k: int) -> float:
        return float(((grades >= k) * counts).sum() / n)

    if top == 0 or toxic == n:
        share = np.array([reaching(k) if n else 0.0 for k in range(1, max(top, 1) + 1)])
        share = np.clip(share, 1e-9, 1 - 1e-9)
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), -np.log(share / (1 - share)))
    sets = [np.unique(r) for r in rows]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    buckets, index = np.unique(flat, return_inverse=True)
    held = np.bincount(index, minlength=len(buckets))
    held_toxic = np.bincount(index, weights=(grades > 0)[owner].astype(float), minlength=len(buckets))

    def cell(o: np.ndarray, e: np.ndarray) -> np.ndarray:
        return np.where(o > 0, o * np.log(np.maximum(o, 1e-12) / e), 0.0)

    p, expected = toxic / n, held * toxic / n
    ratio = cell(held_toxic, expected) + cell(held - held_toxic, held * (1 - p))
    ratio = 2 * (ratio + cell(toxic - held_toxic, toxic - expected + 1e-12)
                 + cell(n - held - toxic + held_toxic, (n - held) * (1 - p) + 1e-12))
    best = np.lexsort((buckets, -ratio))[:FEATURES]
    chosen = np.sort(best[ratio[best] >= LEAST_RATIO])
    place = np.full(len(buckets), -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[index] >= 0
    col, row = place[index[keep]], owner[keep]

    # thresholds: first one and the logarithms of the steps up
    shares = np.clip([reaching(k) for k in range(1, top + 1)], 1e-6, 1 - 1e-6)
    start = -np.log(shares / (1 - shares))
    free = np.concatenate(([start[0]], np.log(np.maximum(np.diff(start), 1e-2))))
    w = np.zeros(len(chosen))
    moment, square = np.zeros(len(w) + top), np.zeros(len(w) + top)
    sits = np.arange(n)
    for step in range(1, STEPS + 1):
        cuts = free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))
        values = np.bincount(row, weights=w[col], minlength=n)
        reach = np.hstack([np.ones((n, 1)), _sigmoid(values[:, None] - cuts[None, :]), np.zeros((n, 1))])
        here = np.maximum(reach[sits, grades] - reach[sits, grades + 1], 1e-9)
        slope = reach * (1 - reach)
        # of minus the log likelihood: by the value, and by the cuts below and above the grade
        share = counts / here / n
        by_value = -(slope[sits, grades] - slope[sits, grades + 1]) * share
        by_cut = np.zeros(top)
        low, high = grades > 0, grades < top
        np.add.at(by_cut, grades[low] - 1, (slope[sits, grades] * share)[low])
        np.add.at(by_cut, grades[high], -(slope[sits, grades + 1] * share)[high])
        by_free = np.concatenate(([by_cut.sum()], np.exp(free[1:]) * np.cumsum(by_cut[::-1])[::-1][1:]))
        gradient = np.concatenate([np.bincount(col, weights=by_value[row], minlength=len(w)) + RIDGE * w, by_free])
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = 0.05 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w -= move[: len(w)]
        free -= move[len(w) :]
    cuts = free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))
    return OrdinalModel(buckets[chosen], w, cuts)


def graded(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grades 0 to 3 from toxic or not, by how many strongly toxic words a row has."""
    if not toxic.any() or toxic.all():
        return toxic.astype(np.int64)
    sets = [np.unique(r) for r in rows]
    buckets, index = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(s) for s in sets])
    held = np.bincount(index, minlength=len(buckets))
    inside = np.bincount(index, weights=toxic[owner].astype(float), minlength=len(buckets))
    lift = (inside / toxic.sum()) / ((held - inside + 0.5) / (~toxic).sum())
    strong = buckets[(lift >= STRONG) & (inside >= np.maximum(5, 0.02 * toxic.sum()))]
    hits = np.array([np.isin(r, strong).sum() for r in rows])
    cuts = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    return np.where(toxic, 1 + (hits > cuts[0]) + (hits > cuts[1]), 0)


def sample_rows(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Word buckets, labels and weights of at most SAMPLE labelled rows, on the driver."""
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("label_id is not null and label is not null").filter(learn)
    kinds = [known.filter("label > 0"), known.filter("label <= 0")]
    totals = known.agg(F.count_if(F.col("label") > 0), F.count_if(F.col("label") <= 0)).first()
    drawn = [k.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(SAMPLE // 2) for k in kinds]
    chosen = drawn[0].union(drawn[1])
    source = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(b, return_counts=True) for b in word_buckets(batch.column(1).to_pylist())]
            # a word counts up to three times, which is all that grading looks at
            rows = [np.repeat(b, np.minimum(c, 3)).astype(np.int32) for b, c in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["label", "words"])

    featurised = source.select("label", F.col("text").cast("binary")).mapInArrow(featurise, "label int, words array<int>")
    got = featurised.limit(2 * SAMPLE).toArrow()  # repeated doc_ids may add rows
    found = got.column(0).to_numpy().astype(np.int64)
    weights = np.where(found > 0, totals[0] / min(max(totals[0], 1), SAMPLE // 2), totals[1] / min(max(totals[1], 1), SAMPLE // 2))
    return [np.asarray(x.values) for x in got.column(1)], found, weights


def scored(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic (grade 1 or more) and grade (the likeliest)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(BUCKETS)
        weight[model.buckets] = model.weights
        chosen = np.zeros(BUCKETS, dtype=bool)
        chosen[model.buckets] = True
        for batch in batches:
            values = []
            for words in word_buckets(batch.column(1).to_pylist()):
                values.append(weight[np.unique(words[chosen[words]])].sum())
            reach = model.at_least(np.array(values, dtype=np.float64))
            edge = np.hstack([np.ones((len(reach), 1)), reach, np.zeros((len(reach), 1))])
            grade = (edge[:, :-1] - edge[:, 1:]).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(reach.sum(axis=1)), pa.array(reach[:, 0]), pa.array(grade)],
                ["doc_id", "severity", "p_toxic", "grade"],
            )

    return (
        texts(docs)
        .select("doc_id", F.col("text").cast("binary"))
        .mapInArrow(score, "doc_id long, severity double, p_toxic double, grade int")
    )
