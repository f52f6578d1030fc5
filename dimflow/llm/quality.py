"""Quality rules: fixed measures of a text and a learned verdict.

The verdict is a logistic regression over hashed word n-grams (1 and 2 words)
and hashed character n-grams (2 to 4 characters), trained on labelled rows, with its
output calibrated to a probability on rows it was not trained on (Platt's
method). Texts are scored in Arrow batches against a fixed threshold.

The features of a text are the shares of the buckets within each family, so a
text's score is the mean weight of its n-grams: no count table per text, and
long texts cost no more per byte than short ones.

Training takes a bounded sample: the ``MAX_LABELLED`` labelled rows of smallest
id hash. Everything else covers all rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import bound_batches, ship_package, text_of
from dimflow.llm.hashing import LOWERED, PART_BYTES, characters, hash_spans, rolling, slices, text_bytes, words

MAX_LABELLED = 4000
BUCKETS = 1 << 18
WORD_GRAMS, CHAR_GRAMS = (1, 2), (2, 3, 4)
SCALE = 20.0
EPOCHS = 40
TRAIN_BYTES = 1 << 19  # text whose entries are counted together in training
KEEP_PROBABILITY = 0.3

# The base rules.
SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\r\x0b\x0c"
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of words in repeated windows
WINDOW = 5

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SCORED = MEASURES + ", base_failed boolean, probability double, kept boolean"


def repeated_words(tokens: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more, the first one included."""
    if len(tokens) <= width:
        return 0
    windows = list(zip(*[tokens[i:] for i in range(width)]))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, reach = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + width - max(i, reach)
            reach = i + width
    return covered


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    tokens = text.encode().split()  # bytes.split() parts at ASCII white space alone
    seen: set[str] = set()
    duplicates = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                duplicates += 1
            elif line.strip(SEPARATORS):
                seen.add(line)
    return (len(tokens), len(text) - sum(map(text.count, SEPARATORS)), sum(map(text.count, SYMBOLS)), duplicates,
            repeated_words(tokens))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def _families(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family of n-grams: the bucket of every n-gram and the index of each text's first (with the end)."""
    data, at = text_bytes(texts)
    data_lower = LOWERED[data]
    starts, ends, first = words(data_lower, at)
    hashes = hash_spans(data_lower, starts, ends)
    for salt, (values, edges, sizes) in enumerate(((hashes, first, WORD_GRAMS),
                                                   (*characters(data, at), CHAR_GRAMS))):
        for size in sizes:
            grams = rolling(values + np.uint64(1000 * salt + size), size)
            buckets = (grams % np.uint64(BUCKETS)).astype(np.int64)
            # n-grams that reach into the next text belong to none
            last = np.maximum(edges[1:] - size + 1, edges[:-1])
            inside = np.zeros(len(buckets) + 1, np.int32)
            np.add.at(inside, np.minimum(edges[:-1], len(buckets)), 1)
            np.add.at(inside, np.minimum(last, len(buckets)), -1)
            buckets = buckets[np.cumsum(inside[:-1]) > 0]
            yield buckets, np.concatenate([[0], np.cumsum(last - edges[:-1])])


def logits(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """The model's score of each text: the mean weight of its n-grams, family by family."""
    out = np.full(len(texts), bias)
    for buckets, first in _families(texts):
        sums = np.concatenate([[0.0], np.cumsum(weights[buckets], dtype=np.float64)])
        out += SCALE * (sums[first[1:]] - sums[first[:-1]]) / np.maximum(1, np.diff(first))
    return out


def _features(texts: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """The same as sparse rows, some texts at a time: which texts, and row, bucket and value of every entry."""
    first = 0
    for part in slices(pa.RecordBatch.from_arrays([texts], names=["t"]), 0, TRAIN_BYTES):
        rows, columns, values = [], [], []
        for buckets, starts in _families(part.column(0)):
            sizes = np.diff(starts)
            key, count = np.unique(np.repeat(np.arange(len(part)), sizes) * BUCKETS + buckets, return_counts=True)
            rows.append((key // BUCKETS).astype(np.int32))
            columns.append((key % BUCKETS).astype(np.int32))
            values.append((SCALE * count / sizes[rows[-1]]).astype(np.float32))
        yield (slice(first, first + len(part)), np.concatenate(rows), np.concatenate(columns), np.concatenate(values))
        first += len(part)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(texts: pa.Array, good: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """Weights, bias and the two numbers of the calibration, by gradient steps with a step size for each weight.

    Every fourth row is held out for the calibration. Both classes are weighted
    alike while training; the calibration restores their true shares.
    """
    blocks = list(_features(texts))  # twelve bytes an entry; all that is computed from them goes block by block
    held = np.arange(len(good)) % 4 == 3
    share = np.where(good, 1 / max(1, (good & ~held).sum()), 1 / max(1, (~good & ~held).sum())) * ~held / 2
    weights, bias, seen, seen_bias = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-8), 1e-8
    score = np.zeros(len(good))

    def rate() -> None:
        for at, row, column, value in blocks:
            score[at] = np.bincount(row, weights[column] * value, at.stop - at.start) + bias

    for _ in range(EPOCHS):
        rate()
        error = (_sigmoid(score) - good) * share
        slope = 1e-6 * weights
        for at, row, column, value in blocks:
            slope += np.bincount(column, error[at][row] * value, BUCKETS)
        seen += slope ** 2
        seen_bias += error.sum() ** 2
        weights -= 0.1 * slope / np.sqrt(seen)
        bias -= 0.1 * error.sum() / np.sqrt(seen_bias)
    rate()
    score = score[held]
    n_good, n_bad = good[held].sum(), (~good[held]).sum()
    goal = np.where(good[held], (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps on the two numbers, kept short by a small ridge
        p = _sigmoid(a * score + b)
        d, w = p - goal, p * (1 - p) + 1e-6
        slope = np.array([(d * score).sum() + 1e-3 * (a - 1), d.sum() + 1e-3 * b])
        curve = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(curve, slope)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
        if abs(step).max() < 1e-6:
            break
    return weights.astype(np.float32), float(bias), a, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> tuple | None:
    """The model from the bounded labelled sample (one task trains it); None if a class has no rows.

    Rows without an id or label are left out, of rows that repeat an id the
    largest label counts.
    """
    ship_package(docs.sparkSession)
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("__id")).agg((F.max(label_col) > 0).alias("__good"))
              .orderBy(F.xxhash64("__id"), "__id").limit(max_labelled))
    sample = (docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("text"))
              .join(F.broadcast(marked), "__id").orderBy(F.xxhash64("__id"), "__id", "text").limit(max_labelled)
              .select("text", "__good").coalesce(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = list(batches)  # the bounded sample
        texts = pa.concat_arrays([b.column(0) for b in table]) if table else pa.array([], pa.string())
        good = np.array([g for b in table for g in b.column(1).to_pylist()], bool)
        if good.any() and not good.all():
            weights, *numbers = fit(texts, good)
            yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([numbers])],
                                             names=["weights", "numbers"])

    found = sample.mapInArrow(run, "weights binary, numbers array<double>").collect()  # one row of a fixed size
    return (bytes(found[0][0]), *found[0][1]) if found else None


def score(docs: DataFrame, model: tuple | None, text_col: str = "text",
          keep_probability: float = KEEP_PROBABILITY) -> DataFrame:
    """``docs`` plus a struct ``__quality`` (``SCORED``): the measures, the base rules, the probability, the verdict.

    A null text counts as one without words, which fails the base rules. Without
    a model the probability is null and the base rules decide alone. Only the
    text goes through Python.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a fixed number of weights

    @F.arrow_udf(f"struct<{re.sub(r'(\w+) (\w+)', r'\1:\2', SCORED)}>")
    def rate(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        if fitted:
            weights, bias, a, b = np.frombuffer(fitted[0], np.float32), *fitted[1:]
        for texts in parts:
            texts = texts.fill_null("")
            columns: list[list] = [[] for _ in range(8)]
            for part in slices(pa.RecordBatch.from_arrays([texts], names=["t"]), 0, PART_BYTES):
                odds = a * logits(part.column(0), weights, bias) + b if fitted else [None] * len(part)
                for text, x in zip(part.column(0), odds):
                    measures = measure(text.as_py())
                    failed = base_failed(measures[0], measures[4])
                    p = None if x is None else float(_sigmoid(np.float64(x)))
                    verdict = not failed and (p is None or p >= keep_probability)
                    for column, value in zip(columns, (*measures, failed, p, verdict)):
                        column.append(value)
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            names = [field.split()[0] for field in SCORED.split(", ")]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.withColumn("__quality", rate(F.col(f"`{text_col}`")))
