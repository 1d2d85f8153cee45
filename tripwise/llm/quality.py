"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

One pass turns every text into a fixed vector of statistics.  Random Fourier features
approximate a Gaussian kernel over the standardised vectors; every partition sums its
part of the normal equations, whose solution is the ridge score.  An isotonic fit on
labelled rows maps the score to the share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwise.llm.common import Words, calibrated, gram_hashes, isotonic, mix64, text_slices, written

#: Labelled rows the model is fitted on, at most (a sample by hash of the id).
MAX_FIT_ROWS = 100_000
#: Fourier features, ridge penalty, seed, partitions whose sums meet on the driver, bins of the calibration.
FEATURES, RIDGE, SEED, FIT_PARTITIONS, BINS = 384, 1e-3, 17, 32, 512
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3

_CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "other_mark", "high")
STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "distinct_words", "top_word", "top_two", "same_as_last",
    "repeated_grams", "repeated_lines", "line_bytes", "marked_words", "upper_words", "digit_words", "short_words",
    "long_words", "pipes", "shouts", "worst_marks", "worst_upper", "worst_repeat",
) + tuple(f"share_{c}" for c in _CLASSES)


def _byte_classes() -> np.ndarray:
    t = np.full(256, _CLASSES.index("other_mark"), np.uint8)
    for name, chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
                        ("space", (32, 9, 13)), ("newline", (10,)), ("stop", b".,;:?'\"-"), ("high", range(128, 256))):
        t[list(chars)] = _CLASSES.index(name)
    return t


_BYTE_CLASS = _byte_classes()


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether an equal value came before in the same text, how many values of its text equal it)."""
    # the factor keeps hashes of small numbers apart from those of the texts' numbers
    key = hashes * np.uint64(0x9E3779B97F4A7C15) ^ mix64(doc.astype(np.uint64) + np.uint64(11))
    _, first, place, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    before = np.ones(len(key), bool)
    before[first] = False
    return before, n[place]


def statistics(texts: pa.Array) -> np.ndarray:
    """(texts, len(STATISTICS)); an empty text has all shares and counts 0."""
    n = len(texts)
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[starts[0]:starts[-1]]
    ends = starts - starts[0]
    size = np.diff(ends).astype(np.float64)
    per_byte = np.maximum(size, 1)
    kinds = _BYTE_CLASS[raw]
    shares = [_sums(kinds == c, ends) / per_byte for c in range(len(_CLASSES))]
    pipes, shouts = _sums(raw == ord("|"), ends) / per_byte, _sums(raw == ord("!"), ends) / per_byte

    tokens = pc.utf8_split_whitespace(texts)
    offsets = np.asarray(tokens.offsets, np.int64)
    offsets = offsets - offsets[0]
    enc = tokens.flatten().dictionary_encode()
    vocabulary, codes = enc.dictionary, np.asarray(enc.indices, np.int64)
    if len(vocabulary):  # white space alone gives empty tokens
        full = np.asarray(pc.binary_length(vocabulary), np.int64) > 0
        keep = full[codes]
        offsets, codes = np.concatenate([[0], np.cumsum(keep)])[offsets], codes[keep]
    words = np.diff(offsets)
    per_word = np.maximum(words, 1)
    doc = np.repeat(np.arange(n), words)
    lengths = np.asarray(pc.binary_length(vocabulary), np.float64)[codes] if len(codes) else np.zeros(0)

    def flag(mask) -> np.ndarray:
        return np.asarray(mask, dtype=bool)[codes] if len(codes) else np.zeros(0, bool)

    marked = flag(pc.match_substring_regex(vocabulary, r"[^\p{L}\p{N}\s.,;:?'\"-]"))
    upper = flag(pc.and_(pc.equal(vocabulary, pc.utf8_upper(vocabulary)),
                         pc.match_substring_regex(vocabulary, r"\p{L}\p{L}")))
    digit = flag(pc.match_substring_regex(vocabulary, r"\p{N}"))
    hashes = mix64(codes.astype(np.uint64) + np.uint64(3))
    seen, times = _repeats(hashes, doc) if len(codes) else (np.zeros(0, bool), np.zeros(0))
    top, second = np.zeros(n), np.zeros(n)
    if len(codes):
        full_docs = np.flatnonzero(words)
        top[full_docs] = np.maximum.reduceat(times, offsets[:-1][full_docs])
        rest = np.where(times == np.repeat(top, words), 0, times)
        second[full_docs] = np.maximum.reduceat(rest, offsets[:-1][full_docs])
    same = np.zeros(len(codes), bool)
    if len(codes):
        same[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    grams = gram_hashes(hashes, 5)
    inside = doc[4:] == doc[:len(grams)] if len(grams) else np.zeros(0, bool)
    grams, gram_doc = grams[inside], doc[:len(inside)][inside]
    again = _repeats(grams, gram_doc)[0] if len(grams) else np.zeros(0, bool)
    n_grams = np.bincount(gram_doc, minlength=n)
    repeated = np.bincount(gram_doc, weights=again, minlength=n) / np.maximum(n_grams, 1)
    # the worst window of 32 words
    worst = [np.zeros(n) for _ in range(3)]
    if len(codes):
        full_docs = np.flatnonzero(words)
        index = np.arange(len(codes))
        begin = np.maximum(index - 31, np.repeat(offsets[:-1], words))
        span = index - begin + 1
        for out, mask in zip(worst, (marked, upper, same), strict=True):
            total = np.concatenate([[0], np.cumsum(mask)])
            rate = (total[index + 1] - total[begin]) / np.maximum(span, 8)
            out[full_docs] = np.maximum.reduceat(rate, offsets[:-1][full_docs])

    lines = pc.split_pattern(texts, "\n")
    line_offsets = np.asarray(lines.offsets, np.int64)
    line_offsets = line_offsets - line_offsets[0]
    line_enc = lines.flatten().dictionary_encode()
    n_lines = np.diff(line_offsets)
    line_doc = np.repeat(np.arange(n), n_lines)
    line_codes = np.asarray(line_enc.indices, np.int64)
    twice = (_repeats(mix64(line_codes.astype(np.uint64) + np.uint64(5)), line_doc)[0] if len(line_codes)
             else np.zeros(0, bool))

    columns = [
        np.log1p(size), np.log1p(words), np.log1p(n_lines), _sums(lengths, offsets) / per_word,
        (words - _sums(seen, offsets)) / per_word, top / per_word, (top + second) / per_word,
        _sums(same, offsets) / per_word, repeated, _sums(twice, line_offsets) / np.maximum(n_lines, 1),
        np.log1p(size / np.maximum(n_lines, 1)), _sums(marked, offsets) / per_word, _sums(upper, offsets) / per_word,
        _sums(digit, offsets) / per_word, _sums(lengths <= 2, offsets) / per_word,
        _sums(lengths >= 14, offsets) / per_word, pipes, shouts, *worst, *shares,
    ]
    return np.column_stack(columns) if n else np.zeros((0, len(STATISTICS)))


def document_statistics(docs: DataFrame) -> DataFrame:
    """(y, calibrate, stats) of rows (text, y, calibrate); null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            s = statistics(texts)
            lists = pa.ListArray.from_arrays(np.arange(0, s.size + 1, s.shape[1], dtype=np.int32), s.ravel())
            yield pa.RecordBatch.from_arrays([lists, rows.column(1), rows.column(2)], names=["stats", "y", "calibrate"])

    return docs.select("text", "y", "calibrate").mapInArrow(run, "stats array<double>, y int, calibrate boolean")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, len(STATISTICS)))


@dataclass
class QualityModel:
    """Standardisation, Fourier frequencies and phases, ridge weights, calibration."""

    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        wave = np.sqrt(2.0 / len(self.phase)) * np.cos(z @ self.freq + self.phase)
        return np.column_stack([np.ones(len(x)), wave])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return calibrated(self.edges, self.values, self.raw(x)) if len(x) else np.zeros(0)


def bounded_labels(labels: DataFrame, label: str, train, limit: int) -> DataFrame:
    """(doc_id, y) of the labelled rows that may be learned from, at most about ``limit`` (by hash of the id).

    Null ids and labels are left out; an id labelled more than once has the mean, rounded.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & train)
    one = known.groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))
    n = one.count()
    part = min(1.0, limit / max(n, 1))
    return one.filter(F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(1_000_000)) < int(part * 1_000_000))


def fit(docs: DataFrame, labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE,
        seed: int = SEED) -> QualityModel:
    """Fit on the texts of the ids in ``labelled`` (doc_id, y), a bounded set.

    Every fourth id (by hash) is left to the calibration.  Without rows of both
    labels the score is the constant share of label 1 (one half without any).
    """
    # the labelled sample has at most its documented bound of rows
    known = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(labelled), "doc_id")
    known = known.withColumn("calibrate", F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(4)) == 0)
    rows = written(document_statistics(known), "quality-fit")
    d = len(STATISTICS)
    sums = rows.agg(F.count("*").alias("n"), F.sum("y").alias("ones"),
                    *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(d)],
                    *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(d)]).first()
    rng = np.random.default_rng(seed)
    # frequencies of two kernel widths over the standardised statistics
    widths = np.where(np.arange(features) % 2, 1.0, 2.5) * np.sqrt(d)
    freq, phase = rng.normal(size=(d, features)) / widths, rng.uniform(0, 2 * np.pi, features)
    mean = np.array([sums[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.maximum(np.array([sums[f"s{i}"] or 0.0 for i in range(d)]), 1e-6)
    model = QualityModel(mean, scale, freq, phase, np.zeros(features + 1), np.zeros(1), np.array([0.5]))
    if not sums["n"] or not 0 < sums["ones"] < sums["n"]:
        model.values = np.array([float(sums["ones"] / sums["n"]) if sums["n"] else 0.5])
        return model
    share = sums["ones"] / sums["n"]
    weight = (0.5 / (1 - share), 0.5 / share)  # both labels weigh the same

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                y = np.asarray(batch.column(1), np.float64)
                w = np.where(y > 0.5, weight[1], weight[0]) * ~np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool)
                phi = model.features(_matrix(batch.column(0)))
                a += phi.T @ (phi * w[:, None])
                b += phi.T @ (w * (2 * y - 1))
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([a.ravel(), b]).tobytes()], pa.binary())], names=["sums"])

    # one sum a partition, at most FIT_PARTITIONS of fixed size
    total = np.zeros((features + 1) ** 2 + features + 1)
    for r in rows.coalesce(FIT_PARTITIONS).mapInArrow(partial, "sums binary").toLocalIterator():
        total += np.frombuffer(r["sums"], np.float64)
    a, b = total[:(features + 1) ** 2].reshape(features + 1, -1), total[(features + 1) ** 2:]
    model.weights = np.linalg.solve(a + ridge * np.trace(a) / len(a) * np.eye(len(a)), b)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0)))
            bins = np.clip(np.floor((raw + 2) / 4 * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1).cast(pa.int64())], names=["bin", "y"])

    # fixed bins of the score: at most BINS rows reach the driver
    cal = (rows.filter("calibrate").select("stats", "y").mapInArrow(binned, "bin long, y long")
           .groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("ones")).orderBy("bin").collect())
    if cal:
        x = np.array([(r["bin"] + 1) / BINS * 4 - 2 for r in cal])
        n = np.array([float(r["n"]) for r in cal])
        # half a row of the mean keeps the share off 0 and 1
        y = (np.array([float(r["ones"]) for r in cal]) + 0.5 * share) / (n + 0.5)
        model.edges, model.values = isotonic(x, y, n)
    else:
        model.edges, model.values = np.linspace(-1, 1, 21), np.linspace(0, 1, 21)
    return model


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (text and any columns) with score and predicted; columns so named are replaced."""
    own = docs.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            s = np.clip(model.score(statistics(texts)), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                names=[*rows.schema.names, "score", "predicted"])

    schema = T.StructType([*own.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return own.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, train, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any columns) with score and predicted.

    ``train`` is the condition on ``labels`` under which a row may be learned from.
    Only the text enters a score.  Null texts count as empty, an empty text has a
    score as any other, repeated rows score alike, an empty table gives no rows.
    """
    return score(docs, fit(docs, bounded_labels(labels, "quality", train, max_fit_rows)))


def keep_good(docs: DataFrame, labels: DataFrame, train) -> DataFrame:
    """The rows of ``docs`` that are predicted to be of label 1."""
    scored = classify(docs.withColumnsRenamed({c: f"_{c}" for c in ("score", "predicted") if c in docs.columns}),
                      labels, train)
    kept = scored.filter("predicted = 1")
    return kept.select(*[F.col(f"_{c}" if c in ("score", "predicted") else c).alias(c) for c in docs.columns])
