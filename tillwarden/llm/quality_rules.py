"""Quality scores by a sparse ensemble of rules over text statistics.

1. Statistics: a dozen figures of a text as column expressions.
2. Rules: shallow trees are grown on random halves of the labelled rows, each split over a random third of
   the figures; every path from a root to a node becomes a conjunction of thresholds.
3. Weights: a logistic model with a lasso penalty over the rules, by accelerated proximal steps;
   most weights become zero.
4. Scoring: rules that are left are compiled into one column expression over the statistics, so that
   scoring is a scan and a projection.

The fit takes at most SAMPLE labelled rows, those of least hash of their doc_id: their ids are broadcast,
their dozen figures come to the driver.  Everything else runs over all rows.

Cases: a null text is scored as an empty one; rows with a null label or doc_id are not learned from;
without labels, or with one kind only, every score is the labels' mean (0.5 without any);
repeated rows are scored alike and all returned; of rows with one id the one of least figures is learned from; an
empty table gives no rows; further columns of any name are kept.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 20_000
TREES = 60
DEPTH = 3
THRESHOLDS = 64  # quantiles of a figure that a split may use
LEAST_ROWS = 10  # in a node
LASSO = 0.001
STEPS = 500
FIT_ROWS = 2048  # rows of a block of the fit

# Fixed list: marks that prose hardly uses.
ODD_MARKS = "#$%&*@^~|<>{}[]"
END_MARKS = ".!?"

Bound = tuple[str, str, float]  # statistic, "<=" or ">", threshold


def statistics(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """The figures of a text; shares are of characters, words or lines."""
    chars = F.length(text)

    def share(n: Column, of: Column) -> Column:
        return n.cast("double") / F.greatest(of, F.lit(1))

    def marks(chosen: str) -> Column:
        return F.regexp_count(text, F.lit("[" + re.sub(r"([^0-9A-Za-z-])", r"\\\1", chosen) + "]"))

    return {
        "chars": chars.cast("double"),
        "words": F.size(words).cast("double"),
        "word_length": share(chars, F.size(words)),
        "distinct_words": share(F.size(F.array_distinct(words)), F.size(words)),
        "lines": F.size(lines).cast("double"),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_length": share(chars, F.size(lines)),
        "odd_marks": share(marks(ODD_MARKS), chars),
        "digits": share(marks("0-9"), chars),
        "end_marks": share(marks(END_MARKS), F.size(words)),
        "exclamations": share(marks("!"), F.size(words)),
        "capitals": share(marks("A-Z"), chars),
    }


STATISTICS = (
    "chars", "words", "word_length", "distinct_words", "lines", "distinct_lines", "line_length",
    "odd_marks", "digits", "end_marks", "exclamations", "capitals",
)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (text, and columns of other names than those made here) with a column ``__stat_<name>`` per statistic.

    Words, lines and figures are columns of their own in steps of their own: each is used
    several times, and the optimiser does not copy what is dear into its users.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    parts = docs.withColumns(
        {
            "__words": F.array_remove(F.split(F.lower(text), r"\s+"), ""),
            "__lines": F.array_remove(F.split(text, "\n"), ""),
        }
    )
    figures = statistics(text, F.col("__words"), F.col("__lines"))
    return parts.withColumns({f"__stat_{n}": c for n, c in figures.items()}).drop("__words", "__lines")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: a fifth of all, by a checksum of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def grow(bins: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rng: np.random.Generator) -> list[tuple[Bound, ...]]:
    """The paths from the root to each other node of a tree.

    ``bins`` has, per row and figure, how many of the figure's cuts lie below the value.
    """
    found: list[tuple[Bound, ...]] = []

    def split(rows: np.ndarray, path: tuple[Bound, ...]) -> None:
        best = None
        n, positive = len(rows), y[rows].sum()
        if len(path) < DEPTH and 0 < positive < n:
            for f in rng.choice(len(cuts), size=max(1, len(cuts) // 3), replace=False):
                size = np.cumsum(np.bincount(bins[rows, f], minlength=len(cuts[f]) + 1))[:-1]
                ones = np.cumsum(np.bincount(bins[rows, f], weights=y[rows], minlength=len(cuts[f]) + 1))[:-1]
                fits = (size >= LEAST_ROWS) & (n - size >= LEAST_ROWS)
                if not fits.any():
                    continue
                left, right = np.maximum(size, 1), np.maximum(n - size, 1)
                # larger is purer: the sum over both sides of the squares of either class over the size
                other, more = positive - ones, size - ones
                pure = (ones**2 + more**2) / left + (other**2 + (n - size - other) ** 2) / right
                pure = np.where(fits, pure, -1)
                at = int(pure.argmax())
                if best is None or pure[at] > best[0]:
                    best = (pure[at], f, at)
        if best is None or best[0] <= (positive**2 + (n - positive) ** 2) / n + 1e-9:
            return
        _, f, at = best
        low = bins[rows, f] <= at
        for side, part in (("<=", rows[low]), (">", rows[~low])):
            longer = (*path, (STATISTICS[f], side, float(cuts[f][at])))
            found.append(longer)
            split(part, longer)

    split(rng.choice(len(y), size=max(1, len(y) // 2), replace=False), ())
    return found


def lasso_logistic(hits: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """Intercept and weights of the columns of ``hits`` (0 or 1, as bytes); the intercept is not penalised.

    Rows count by their ``weights``.  Products go by blocks of rows, so that only a block is ever held as numbers
    of full size.
    """
    n, k = hits.shape
    each = np.ones(n) if weights is None else weights.astype(float)
    total = each.sum()
    blocks = [slice(at, at + FIT_ROWS) for at in range(0, n, FIT_ROWS)]

    def forward(v: np.ndarray) -> np.ndarray:
        return np.concatenate([hits[b].astype(float) @ v[1:] for b in blocks]) + v[0]

    def backward(r: np.ndarray) -> np.ndarray:
        out = np.zeros(k + 1)
        for b in blocks:
            out[1:] += r[b] @ hits[b].astype(float)
        out[0] = r.sum()
        return out

    v = np.ones(k + 1)
    for _ in range(30):
        v = backward(each * forward(v))
        v /= np.linalg.norm(v)
    step = 4 * total / max(float(v @ backward(each * forward(v))), 1e-9)
    shrink = np.concatenate(([0.0], np.full(k, LASSO * step)))
    w = ahead = np.zeros(k + 1)
    t = 1.0
    for _ in range(STEPS):
        slope = backward(each * (1 / (1 + np.exp(-np.clip(forward(ahead), -40, 40))) - y)) / total
        moved = ahead - step * slope
        new = np.sign(moved) * np.maximum(np.abs(moved) - shrink, 0)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


def simplified(rule: tuple[Bound, ...]) -> tuple[Bound, ...]:
    """The tightest bound of each statistic and side, in a fixed order."""
    tight: dict[tuple[str, str], float] = {}
    for name, side, value in rule:
        old = tight.get((name, side))
        tight[name, side] = value if old is None else (min if side == "<=" else max)(old, value)
    return tuple(sorted((name, side, value) for (name, side), value in tight.items()))


def _holds(rule: tuple[Bound, ...]) -> Column:
    tests = [
        F.col(f"__stat_{name}") <= value if side == "<=" else F.col(f"__stat_{name}") > value
        for name, side, value in rule
    ]
    return reduce(lambda a, b: a & b, tests)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[tuple[Bound, ...], float], ...]

    def score(self) -> Column:
        """Probability of label 1, over rows from ``with_statistics``."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(_holds(rule), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _constant(p: float) -> RuleModel:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return RuleModel(math.log(p / (1 - p)), ())


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column | None = None) -> RuleModel:
    """Learn from rows of ``labels`` (doc_id and the label column) that meet ``learn``."""
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label).cast("double").alias("label"))
    known = known.filter("label_id is not null and label in (0.0, 1.0)").filter(
        ~held_out(F.col("label_id")) if learn is None else learn
    )
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(SAMPLE)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = with_statistics(texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")))
    # one row an id, whatever number of rows or labels it has: at most SAMPLE, and the same ones each time
    least = rows.groupBy("label_id").agg(F.min(F.struct("label", *(f"__stat_{s}" for s in STATISTICS))).alias("row"))
    got = least.select("row.*").toPandas().to_numpy(dtype=float)
    y, x = got[:, 0], got[:, 1:]
    if not len(y) or y.min() == y.max():
        return _constant(float(y.mean()) if len(y) else 0.5)
    # in a fixed order, so that the fit does not depend on which task came first
    order = np.lexsort(got.T)
    y, x = y[order], x[order]
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, THRESHOLDS + 2)[1:-1], method="lower")) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    rng = np.random.default_rng(6)
    rules = sorted({simplified(p) for _ in range(TREES) for p in grow(bins, y, cuts, rng)})
    if not rules:
        return _constant(float(y.mean()))
    value = {name: x[:, i] for i, name in enumerate(STATISTICS)}
    hits = np.empty((len(y), len(rules)), dtype=np.uint8)
    for i, rule in enumerate(rules):
        hits[:, i] = reduce(np.logical_and, [value[n] <= t if side == "<=" else value[n] > t for n, side, t in rule])
    # most rows of one label meet the same rules as others: each such kind is one row with its number
    packed = np.concatenate([np.packbits(hits, axis=1), y[:, None].astype(np.uint8)], axis=1)
    _, first, times = np.unique(packed, axis=0, return_index=True, return_counts=True)
    hits, y = hits[first], y[first]
    intercept, weights = lasso_logistic(hits, y, times)
    return RuleModel(intercept, tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if w))


def scored(docs: DataFrame, model: RuleModel, score: str = "score") -> DataFrame:
    """The rows with their score; a column of that name is replaced."""
    # the row goes along as a struct, so that its columns may have any names
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != score]).alias("row")
    figures = with_statistics(docs.select(row, F.col("text").cast("string").alias("text")))
    # exploded: a filter on a plain column would be worked into its rules, each with the figures' expressions in full
    return figures.select("row", F.explode(F.array(model.score())).alias("score")).select(
        "row.*", F.col("score").alias(score)
    )
