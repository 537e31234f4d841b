"""Quality of documents by regularised quadratic discriminant analysis of text statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import texts

#: What ``statistics`` returns, in order.
STATISTICS = (
    "log_words", "word_bytes", "distinct_words", "stalled_words", "symbol_bytes", "upper_letters", "digit_bytes",
    "marked_words", "bare_marks", "repeated_lines", "line_words", "byte_entropy")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WORDY = _LETTER | _DIGIT
_WORDY[128:] = True  # bytes of letters beyond ASCII, mostly
_SYMBOL = ~_WORDY
_SYMBOL[[0, 9, 10, 11, 12, 13, 32, 44, 46]] = False  # blanks, comma, full stop


def _distinct(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many different values each of the runs has."""
    return np.array([len(np.unique(h[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.float64)


def _logit(share: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Log-odds of a share of so many things, drawn in for few of them."""
    hits = share * of
    return np.log((hits + 0.5) / (of - hits + 0.5))


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``STATISTICS`` per text; shares are log-odds, counts are logarithms. An empty text
    has the values that no counts give."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)

    def total(mask: np.ndarray, cut: np.ndarray = offsets) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[cut]).astype(np.float64)

    starts, ends, at = texts.words(raw, offsets)
    words = np.diff(at).astype(np.float64)
    sums = texts.prefix_hash(raw)
    h = texts.span_hash(sums, starts, ends)
    some = np.maximum(words, 1)
    stalled = np.zeros(len(h), bool)
    if len(h):
        stalled[1:] = h[1:] == h[:-1]
        stalled[at[:-1][at[:-1] < len(h)]] = False
    wordy = _WORDY[raw]
    symbol = _SYMBOL[raw]
    if len(starts):
        plain = np.concatenate([[0], np.cumsum(wordy)])
        odd = np.concatenate([[0], np.cumsum(symbol)])
        bare = plain[ends] == plain[starts]
        marked = (odd[ends] > odd[starts]) & ~bare
    else:
        bare = marked = np.zeros(0, bool)
    newline = raw == 10
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    line_ends = np.flatnonzero(newline | cut[1:])
    line_starts = np.concatenate([[0], line_ends[:-1] + 1]) if len(line_ends) else line_ends
    line_hash = texts.span_hash(sums, line_starts, line_ends + ~newline[line_ends]) if len(line_ends) else h[:0]
    line_at = np.searchsorted(line_ends, offsets)
    lines = np.diff(line_at).astype(np.float64)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(owner * 256 + raw, minlength=n * 256).reshape(n, 256) if len(raw) else np.zeros((n, 256))
    share = kinds / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    letters, upper = total(_LETTER[raw]), total(_UPPER[raw])
    return np.stack([
        np.log1p(words),
        np.log((total(~texts.is_space(raw)) + 1) / (words + 1)),
        np.log((_distinct(h, at) + 1) / (some + 1) ** 0.8),
        _logit(total(stalled, at) / some, words),
        _logit(total(symbol) / np.maximum(size, 1), size),
        _logit(upper / np.maximum(letters, 1), letters),
        _logit(total(_DIGIT[raw]) / np.maximum(size, 1), size),
        _logit(total(marked, at) / some, words),
        _logit(total(bare, at) / some, words),
        _logit((lines - _distinct(line_hash, line_at)) / np.maximum(lines, 1), lines),
        np.log((words + 1) / (lines + 1)),
        entropy,
    ], axis=1) if n else np.zeros((0, len(STATISTICS)))


@dataclass(frozen=True)
class Discriminant:
    """Per class: log prior, mean and the Cholesky factor of the shrunk covariance."""

    log_prior: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constant: float | None = None

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1, from the difference of the classes' log densities."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = []
        for prior, mean, factor in zip(self.log_prior, self.means, self.factors, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)  # |z|^2 is the Mahalanobis distance
            density.append(prior - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(0))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        to_pooled: float = 0.1, to_diagonal: float = 0.05) -> Discriminant:
    """The discriminant of the labelled documents, all of them.

    ``labels`` has ``key`` and ``label`` (0 or 1; others, and null keys, count for nothing; a key
    labelled twice counts twice). Each class covariance is drawn by ``to_pooled`` to the pooled one,
    then by ``to_diagonal`` to its diagonal. With one class only the probability is that class;
    with none it is 0.5. Tasks send sums of values and products, so the driver gets a table whose
    size is the number of statistics squared.
    """
    width = len(STATISTICS)
    wanted = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where("id is not null and y in (0, 1)")
    # Statistics before the join: what is shuffled is a few numbers per text.
    known = docs.select(F.col(f"`{key}`").alias("id"), _statistics(F.col(f"`{text}`").cast("string")).alias("x")).join(wanted, "id")

    x = [F.col("x")[i] for i in range(width)]
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    sums = known.groupBy("y").agg(F.count(F.lit(1)).alias("count"), F.array(*(F.sum(c) for c in x)).alias("first"),
                                  F.array(*(F.sum(x[i] * x[j]) for i, j in pairs)).alias("second"))
    values = np.zeros((2, 1 + width + width * width))
    for row in sums.collect():
        square = np.zeros((width, width))
        for (i, j), value in zip(pairs, row["second"], strict=True):
            square[i, j] = square[j, i] = value
        values[row["y"]] = np.concatenate([[row["count"]], row["first"], square.ravel()])
    counts = values[:, 0]
    if (counts == 0).any():
        constant = 0.5 if not counts.any() else float(counts[1] > 0)
        return Discriminant(np.zeros(2), np.zeros((2, width)), np.zeros((2, width, width)), constant)
    means = values[:, 1:1 + width] / counts[:, None]
    scatter = values[:, 1 + width:].reshape(2, width, width) - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(0) / counts.sum()
    factors = []
    for c in (0, 1):
        own = (1 - to_pooled) * scatter[c] / counts[c] + to_pooled * pooled
        own = (1 - to_diagonal) * own + to_diagonal * np.diag(np.diag(own))
        factors.append(np.linalg.cholesky(own + 1e-6 * np.eye(width)))
    return Discriminant(np.log(counts / counts.sum()), means, np.stack(factors))


def _statistics(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def compute(column: pa.Array) -> pa.Array:
        width = len(STATISTICS)
        found = [statistics(raw, offsets) for _, _, raw, offsets in texts.chunks(column)]
        values = np.concatenate(found) if found else np.zeros((0, width))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * width), pa.array(values.ravel()))

    return compute(text)


def score(model: Discriminant, text: Column) -> Column:
    """Probability (0 to 1) that the text is of class 1; a null text counts as empty."""
    @F.arrow_udf("double")
    def compute(column: pa.Array) -> pa.Array:
        found = [model.probability(statistics(raw, offsets)) for _, _, raw, offsets in texts.chunks(column)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return compute(text.cast("string"))
