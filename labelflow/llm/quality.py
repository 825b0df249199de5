"""Quality rules: counts over whole texts and a calibrated n-gram classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.llm.common import by_bytes, text_batches, text_or_empty
from labelflow.llm.textbytes import BASE, TextBytes, mix

#: Hashed features, of all families together.
FEATURES = 1 << 17
#: Most labelled rows that the classifier is fitted on (those of the smallest
#: hashed ids). The only sample in this module; counts and scores cover all rows.
TRAIN_ROWS = 2_000
#: Passes of the optimizer over the sample, its step, and the weights' decay.
PASSES, STEP, DECAY = 120, 0.15, 1e-4
#: Relative frequencies are small; this brings logits to a usual range.
SCALE = 20.0
#: A text passes with at least this probability of being of good quality.
KEEP_AT = 0.5
#: Base rules.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Bytes of text whose features are computed at once (or one longer text).
TEXT_BYTES = 1 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


class Texts(TextBytes):
    """Counts and hashed n-grams of some texts, all at once over their bytes."""

    def __init__(self, texts: list[bytes]):
        super().__init__(texts)
        self.words = self.hashes(self.starts, self.ends)

    def _per_text(self, flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.end] - sums[self.begin]

    def counts(self) -> dict[str, np.ndarray]:
        first_byte = (self.data & 0xC0) != 0x80
        return {
            "n_words": np.bincount(self.owner, minlength=self.n),
            "word_chars": self._per_text(first_byte & ~self.space),
            "n_symbols": self._per_text(_SYMBOL[self.data]),
            "n_dup_lines": self._repeated_lines(),
            "n_repeat_words": self._repeated_words(),
        }

    def _repeated_lines(self) -> np.ndarray:
        end = np.flatnonzero(self.data == 10)
        start = np.concatenate([[0], end[:-1] + 1])
        words = np.searchsorted(self.starts, end) - np.searchsorted(self.starts, start)
        start, end = start[words > 0], end[words > 0]
        owner = np.searchsorted(self.end, start)
        value = self.hashes(start, end)
        order = np.lexsort((value, owner))
        same = (np.diff(owner[order]) == 0) & (np.diff(value[order]) == 0)
        return np.bincount(owner[order][1:][same], minlength=self.n)

    def _repeated_words(self) -> np.ndarray:
        if len(self.words) < 3:
            return np.zeros(self.n, np.int64)
        w = self.words
        at = np.flatnonzero(self.owner[:-2] == self.owner[2:])
        value = mix(mix(w[at] * np.uint64(3) + w[at + 1]) * np.uint64(5) + w[at + 2])
        value = mix(value + self.owner[at].astype(np.uint64) * np.uint64(BASE))
        order = np.argsort(value)
        same = np.diff(value[order]) == 0
        often = np.zeros(len(value), bool)
        often[order[1:][same]] = True
        often[order[:-1][same]] = True
        marked = np.zeros(len(w), bool)
        for k in range(3):
            marked[at[often] + k] = True
        return np.bincount(self.owner[marked], minlength=self.n)

    def features(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(feature, text) of every n-gram, by family: words, pairs of words,
        and four characters in a row."""
        last = np.uint64(FEATURES - 1)
        pair = np.flatnonzero(self.owner[:-1] == self.owner[1:])
        two = mix(self.words[pair] * np.uint64(7) + self.words[pair + 1])
        # Where characters begin; between two texts stands a line end of its own.
        first = np.flatnonzero((self.data & 0xC0) != 0x80)
        owner = np.searchsorted(self.end, first)
        at = np.arange(max(0, len(first) - 4))
        at = at[(owner[at] == owner[at + 3]) & (first[at + 3] < self.end[owner[at]])]
        quad = self.hashes(first[at], first[at + 4])
        owner = owner[at]
        return [
            ((self.words & last).astype(np.int64), self.owner),
            ((two & last).astype(np.int64), self.owner[pair]),
            ((mix(quad + np.uint64(BASE)) & last).astype(np.int64), owner),
        ]

    def logits(self, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(self.n)
        for feature, text in self.features():
            sums = np.bincount(text, weights[feature], self.n)
            total += SCALE * sums / np.maximum(np.bincount(text, minlength=self.n), 1)
        return total

    def rows(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's features and their values, for fitting."""
        sums = []
        for feature, text in self.features():
            code, count = np.unique(text * FEATURES + feature, return_counts=True)
            owner = code // FEATURES
            size = np.bincount(text, minlength=self.n)[owner]
            sums.append((code, SCALE * count / size))
        code = np.concatenate([c for c, _ in sums])
        value = np.concatenate([v for _, v in sums])
        order = np.argsort(code, kind="stable")
        code, value = code[order], value[order]
        cut = np.searchsorted(code, np.arange(self.n + 1) * FEATURES)
        return [
            ((code[a:b] % FEATURES).astype(np.int32), value[a:b].astype(np.float32))
            for a, b in zip(cut, cut[1:])
        ]


@dataclass(frozen=True)
class Model:
    """Weights of the hashed features; slope and shift of the calibration."""

    weights: np.ndarray
    slope: float
    shift: float

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -50, 50)))


def _fit_weights(rows, good: np.ndarray) -> np.ndarray:
    """Logistic regression with balanced classes by full-batch Adam."""
    feature = np.concatenate([f for f, _ in rows])
    value = np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    share = good.mean()
    balance = np.where(good, 0.5 / share, 0.5 / (1 - share)) / len(good)
    w, bias = np.zeros(FEATURES), 0.0
    m, v, mb, vb = np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0
    for t in range(1, PASSES + 1):
        logit = np.bincount(row, value * w[feature], len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - good) * balance
        grad = np.bincount(feature, value * error[row], FEATURES) + DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.999 * vb + 0.001 * error.sum() ** 2
        fix1, fix2 = 1 - 0.9**t, 1 - 0.999**t
        w -= STEP * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)
        bias -= STEP * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8)
    return w


def _calibrate(logits: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Platt's scaling, with his smoothed targets."""
    up, down = good.sum(), (~good).sum()
    target = np.where(good, (up + 1) / (up + 2), 1 / (down + 2))
    slope, shift = 1.0, float(-np.median(logits))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * logits + shift, -50, 50)))
        d, r = p - target, p * (1 - p) + 1e-9
        g = np.array([(d * logits).sum() + 1e-3 * (slope - 1), d.sum()])
        h = np.array(
            [
                [(r * logits * logits).sum() + 1e-3, (r * logits).sum()],
                [(r * logits).sum(), r.sum() + 1e-6],
            ]
        )
        step = np.linalg.solve(h, g)
        size = max(1.0, float(np.abs(step).max()))
        slope, shift = slope - step[0] / size, shift - step[1] / size
    return max(float(slope), 1e-3), float(shift)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """Fit on a sample of at most TRAIN_ROWS labelled documents.

    A doc_id with several labels has the least of them, one with several texts
    that of the least hash; null ids and labels are left out. Three quarters, by hashed id, fit the weights, the rest the calibration. Their
    features, at most FEATURES numbers a row, are computed in tasks. None if
    there are not two rows of each class in both parts.
    """
    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_ROWS)
        .select(F.col("doc_id").alias("_id"), "_label")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", TEXT_BYTES):
            rows = Texts(batch.column("text").cast(pa.binary()).to_pylist()).rows()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([f.tobytes() for f, _ in rows], pa.binary()),
                    pa.array([v.tobytes() for _, v in rows], pa.binary()),
                ],
                names=["id", "label", "features", "values"],
            )

    chosen = (
        text_batches(docs)
        .select(F.col("doc_id").cast("long").alias("id"), text_or_empty("text").alias("text"))
        .join(F.broadcast(sample), F.col("id") == F.col("_id"))
        .groupBy("id", F.col("_label").cast("int").alias("label"))
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    rows = chosen.mapInArrow(run, "id long, label int, features binary, values binary").toArrow()
    rows = rows.take(pa.compute.sort_indices(rows.select(["id"]), [("id", "ascending")]))
    good = rows.column("label").to_numpy() > 0
    grams = [
        (np.frombuffer(f, np.int32), np.frombuffer(v, np.float32))
        for f, v in zip(rows.column("features").to_pylist(), rows.column("values").to_pylist())
    ]
    held = mix(rows.column("id").to_numpy().astype(np.uint64)) % np.uint64(4) == 3
    for part in (good[held], good[~held]):
        if min(part.sum(), (~part).sum()) < 2:
            return None
    weights = _fit_weights([g for g, h in zip(grams, held) if not h], good[~held])
    logits = np.array([(weights[f] * v).sum() for (f, v), h in zip(grams, held) if h])
    return Model(weights.astype(np.float32), *_calibrate(logits, good[held]))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _verdicts(texts: Texts, model: Model | None):
    """The counts, whether the base rules fail, the probability, and kept."""
    counts = texts.counts()
    words = counts["n_words"]
    failed = (words < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * words)
    if model is None:
        chance = np.ones(texts.n)
    else:
        chance = model.probability(texts.logits(model.weights))
    return counts, failed, chance, ~failed & (chance >= KEEP_AT)


def judge(docs: DataFrame, keys: list[str], text: str, model: Model | None) -> DataFrame:
    """``keys``, the five counts, base_failed, probability and kept per row.

    Words are runs without space or \\t to \\r; n_repeat_words counts the words
    in windows of three that occur twice or more in the text. base_failed: under
    LEAST_WORDS words, or over MOST_REPEATED % of them in such windows. kept:
    not base_failed and a probability of at least KEEP_AT (without a model, of
    1). Map-only. A null or empty text has no words, so it fails. Nulls in keys,
    repeated rows and an empty table need no care; other columns are not read.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    schema = T.StructType(
        [
            *[T.StructField(n, docs.schema[k].dataType) for n, k in zip(names, keys)],
            *[T.StructField(n, T.LongType()) for n in COUNTS],
            T.StructField("base_failed", T.BooleanType()),
            T.StructField("probability", T.DoubleType()),
            T.StructField("kept", T.BooleanType()),
        ]
    )
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text", TEXT_BYTES):
            texts = Texts(batch.column("_text").cast(pa.binary()).to_pylist())
            counts, failed, chance, keep = _verdicts(texts, model)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    *[pa.array(counts[n].astype(np.int64)) for n in COUNTS],
                    pa.array(failed),
                    pa.array(chance),
                    pa.array(keep),
                ],
                names=schema.names,
            )

    judged = text_batches(docs).select(
        *[F.col(k).alias(n) for n, k in zip(names, keys)], text_or_empty(text).alias("_text")
    ).mapInArrow(run, schema)
    return judged.withColumnsRenamed(dict(zip(names, keys)))


def keep_good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Rows go through the task that judges them, so nothing is shuffled.
    """
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", TEXT_BYTES):
            column = pa.compute.fill_null(batch.column(text_at).cast(pa.string()), "")
            texts = Texts(column.cast(pa.binary()).to_pylist())
            yield batch.filter(pa.array(_verdicts(texts, model)[3]))

    return text_batches(docs).mapInArrow(run, docs.schema)
