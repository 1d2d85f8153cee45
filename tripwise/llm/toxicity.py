"""Toxic passages by maximum-scoring segments over token log-odds.

A token's score is the log-odds of its best unit (the word or its first three, four
or five letters) between toxic and clean texts, under an informative Dirichlet prior
from the counts over all texts.  Tokens outside the model cost a fixed negative
amount.  One linear scan finds all maximal segments of a text; the extreme-value law
of such segments turns their scores into significance, and the evidence of a text's
significant segments is calibrated to the share of toxic texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import Words, calibrated, isotonic, text_slices, written
from tripwise.llm.quality import bounded_labels

#: Labelled rows the model is fitted on, at most (a sample by hash of the id).
MAX_FIT_ROWS = 60_000
#: Toxic texts a unit must be in (a number and a share of them), its least z-score and log-odds, the prior's
#: weight in texts.  The share keeps words of a few texts and their copies out.
MIN_TEXTS, MIN_SHARE, MIN_Z, MIN_LOG_ODDS, PRIOR = 4, 0.02, 4.0, 4.0, 10.0
#: Share of toxic tokens in a passage that sets the cost of other tokens.
DENSITY = 0.15
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Expected number of segments by chance below which one is significant.
E_VALUE = 0.05


def units(word: str) -> list[str]:
    """The word and its first three, four and five letters (marked with ~)."""
    return [word] + [word[:n] + "~" for n in (3, 4, 5) if len(word) > n]


def unit_hash(unit: str) -> int:
    return xxhash.xxh3_64_intdigest(unit) - (1 << 63)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time (Ruzzo and Tompa).

    Each positive run enters a list; it merges with the last earlier segment whose
    left sum is smaller as long as its right sum is larger.
    """
    found: list[list[float]] = []  # start, end, left sum, right sum
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        seg = [i, i + 1, total, total + s]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= seg[2]:
                j -= 1
            if j < 0 or found[j][3] >= seg[3]:
                found.append(seg)
                break
            seg = [found[j][0], seg[1], found[j][2], seg[3]]
            del found[j:]
    return [(int(a), int(b), r - left) for a, b, left, r in found]


def sparse_segments(at: np.ndarray, gain: np.ndarray, cost: float) -> list[tuple[int, int, float]]:
    """``segments`` of a text whose tokens all cost ``cost`` but for those at places ``at``."""
    if not len(at):
        return []
    gaps = np.diff(at) - 1
    dense = np.empty(2 * len(at) - 1)
    dense[::2], dense[1::2] = gain, -cost * gaps
    return [(int(at[a // 2]), int(at[(b - 1) // 2]) + 1, s) for a, b, s in segments(dense)]


@dataclass
class ToxicModel:
    """Unit hashes (sorted) with their log-odds, the cost of other tokens, lambda and K, calibration."""

    hashes: np.ndarray
    odds: np.ndarray
    cost: float
    lam: float
    k: float
    edges: np.ndarray
    values: np.ndarray

    def word_scores(self, forms: list[str]) -> np.ndarray:
        """The best log-odds of each word's units, 0 for words outside the model."""
        out = np.zeros(len(forms))
        if not len(self.hashes) or not forms:
            return out
        for take in (None, 3, 4, 5):
            chosen = forms if take is None else [w[:take] + "~" if len(w) > take else "" for w in forms]
            h = np.fromiter((unit_hash(u) for u in chosen), np.int64, len(forms))
            place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            np.maximum(out, np.where(self.hashes[place] == h, self.odds[place], 0), out=out)
        return out

    def passages(self, w: Words) -> Iterator[tuple[float, list[tuple[int, int, float]]]]:
        """(evidence, significant segments) of each text."""
        token = self.word_scores(w.forms)[w.codes] if len(w.codes) else np.zeros(0)
        hits = np.flatnonzero(token > 0)
        bounds = np.searchsorted(hits, w.offsets)
        for d in range(len(w.offsets) - 1):
            own = hits[bounds[d]:bounds[d + 1]]
            if not len(own):
                yield 0.0, []
                continue
            first, n = int(w.offsets[d]), int(w.offsets[d + 1] - w.offsets[d])
            found = sparse_segments(own - first, token[own], self.cost)
            # Karlin-Altschul: E = K n exp(-lambda s) segments of score s by chance in n tokens
            kept, evidence = [], 0.0
            for a, b, s in found:
                bits = self.lam * s - math.log(self.k * max(n, 1))
                if bits > -math.log(E_VALUE):
                    kept.append((a, b, s))
                evidence += max(0.0, bits)
            yield evidence, kept


def unit_counts(docs: DataFrame, labelled: dict[int, int] | None, wanted: np.ndarray | None) -> DataFrame:
    """(unit, n0, n1) sums over texts: texts with the unit, by label.

    With ``labelled`` only those texts count, by their label; else all texts count as
    label 0 and only the ``wanted`` unit hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            if labelled is not None:
                ids = rows.column(0).to_pylist()
                label = np.array([labelled.get(i, -1) for i in ids])
                take = np.flatnonzero(label >= 0)
                if not len(take):
                    continue
                texts, label = texts.take(pa.array(take)), label[take]
            else:
                label = np.zeros(len(texts), np.int64)
            w = Words(texts)
            of: list[list[int]] = [[unit_hash(u) for u in units(f)] for f in w.forms]
            if wanted is not None:
                sizes = np.array([len(x) for x in of], np.int64)
                flat = np.array([h for x in of for h in x], np.int64)
                place = np.minimum(np.searchsorted(wanted, flat), max(len(wanted) - 1, 0))
                known = wanted[place] == flat if len(wanted) and len(flat) else np.zeros(len(flat), bool)
                owner = np.repeat(np.arange(len(of)), sizes)[known]
                flat = flat[known]
            else:
                owner = np.repeat(np.arange(len(of)), [len(x) for x in of])
                flat = np.array([h for x in of for h in x], np.int64)
            if not len(flat):
                continue
            # (text, word) pairs once each, then (text, unit) pairs once each
            names, unit_no = np.unique(flat, return_inverse=True)
            first = np.searchsorted(owner, np.arange(len(of) + 1))
            has = np.diff(first)[w.codes] > 0
            doc = np.repeat(np.arange(len(texts)), w.counts)[has]
            pair = np.unique(doc * len(of) + w.codes[has])
            d, c = pair // len(of), pair % len(of)
            reps = np.diff(first)[c]
            spread = np.repeat(first[c] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
            both = np.unique(np.repeat(d, reps) * len(names) + unit_no[spread])
            u, lab = both % len(names), label[both // len(names)]
            n0, n1 = np.bincount(u[lab == 0], minlength=len(names)), np.bincount(u[lab == 1], minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n0, pa.int64()), pa.array(n1, pa.int64())],
                                             names=["unit", "n0", "n1"])

    parts = docs.select("doc_id", "text").mapInArrow(run, "unit long, n0 long, n1 long")
    return parts.groupBy("unit").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _lambda(scores: np.ndarray, shares: np.ndarray, cost: float) -> float:
    """The positive root of sum p exp(lambda s) = 1 (the rest of the tokens score -cost)."""
    rest = max(1e-9, 1 - shares.sum())

    def f(x: float) -> float:
        return float((shares * np.exp(np.minimum(x * scores, 700))).sum() + rest * math.exp(-x * cost) - 1)

    low, high = 1e-3, 1e-2
    while f(high) < 0 and high < 50:
        low, high = high, high * 1.5
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return (low + high) / 2


def fit(docs: DataFrame, labelled: DataFrame) -> ToxicModel:
    """Fit on the texts of the ids in ``labelled`` (doc_id, y), a bounded set; the prior counts all of ``docs``.

    Units that pass the thresholds are bounded by the labelled sample, and so is what
    the driver holds.  Without rows of both labels no unit is toxic and the score is
    the share of label 1 (0 without any).
    """
    labels = {r["doc_id"]: r["y"] for r in labelled.collect()}  # at most the sample's bound
    n1 = sum(labels.values())
    n0 = len(labels) - n1
    empty = ToxicModel(np.zeros(0, np.int64), np.zeros(0), 1.0, 1.0, 1.0, np.zeros(1),
                       np.array([n1 / len(labels) if labels else 0.0]))
    if not n0 or not n1:
        return empty
    counts = unit_counts(docs, labels, None)
    # only units that may pass: seen in toxic texts, at raw odds of more than e to a unit clean text
    near = counts.filter((F.col("n1") >= max(MIN_TEXTS, MIN_SHARE * n1)) & (F.col("n1") / n1 > math.e * F.col("n0") / n0)).toPandas()
    near = near.sort_values("unit")
    wanted = near["unit"].to_numpy(np.int64)
    every = unit_counts(docs, None, wanted).toPandas() if len(wanted) else near.head(0)
    background = dict(zip(every["unit"], every["n0"], strict=True))
    total = max(1, docs.count())
    prior = np.array([background.get(u, 0) for u in wanted]) / total * PRIOR + 1e-3
    y1, y0 = near["n1"].to_numpy(float), near["n0"].to_numpy(float)
    odds = (np.log((y1 + prior) / (n1 + PRIOR - y1 + 1e-3)) - np.log((y0 + prior) / (n0 + PRIOR - y0 - prior + 1e-3)))
    z = odds / np.sqrt(1 / (y1 + prior) + 1 / (y0 + prior + 0.5))
    keep = (odds >= MIN_LOG_ODDS) & (z >= MIN_Z / 2) & (y1 * np.log((y1 / n1) / ((y0 + 0.5) / n0)) >= MIN_Z ** 2 / 2)
    model = empty
    model.hashes, model.odds = wanted[keep], np.minimum(odds[keep], 8.0)
    if not keep.any():
        return model
    # a passage has DENSITY toxic tokens, clean text a share of them as counted (at least half a text's worth)
    clean_share = (y0[keep] + 0.5) / n0 / 300
    rho = min(DENSITY / 2, float(clean_share.sum()))
    model.cost = -math.log((1 - DENSITY) / (1 - rho))
    shares = clean_share / max(1.0, clean_share.sum() / rho)
    model.lam = _lambda(model.odds, shares, model.cost)
    model.k = max(1e-6, float(shares.sum()))  # a segment begins at a toxic token
    evidence = text_evidence(docs, model, labels)
    bins = (evidence.groupBy(F.least(F.floor(F.col("evidence") * 8), F.lit(512)).alias("bin"))
            .agg(F.count("*").alias("n"), F.sum("y").alias("ones")).orderBy("bin").collect())
    x = np.array([(r["bin"] + 1) / 8 for r in bins])
    n = np.array([float(r["n"]) for r in bins])
    y = (np.array([float(r["ones"]) for r in bins]) + 0.5 * n1 / (n0 + n1)) / (n + 0.5)
    model.edges, model.values = isotonic(x, y, n)
    return model


def text_evidence(docs: DataFrame, model: ToxicModel, labels: dict[int, int]) -> DataFrame:
    """(evidence, y) of the labelled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            y = np.array([labels.get(i, -1) for i in rows.column(0).to_pylist()])
            take = np.flatnonzero(y >= 0)
            if len(take):
                found = [e for e, _ in model.passages(Words(texts.take(pa.array(take))))]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), pa.array(y[take], pa.int64())],
                                                 names=["evidence", "y"])

    return docs.select("doc_id", "text").mapInArrow(run, "evidence double, y long")


def score(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted, evidence, passages) of every row; passages are the significant
    segments (start and end word, score), in order."""
    passages = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            evidence, found = [], []
            for e, kept in model.passages(Words(texts)):
                evidence.append(e)
                found.append([{"start": a, "end": b, "score": s} for a, b, s in kept])
            # the calibration's bins end where the next begins
            upper = np.minimum(np.floor(np.array(evidence) * 8), 512) / 8 + 1 / 8
            s = np.clip(calibrated(model.edges, model.values, upper), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32)),
                 pa.array(evidence, pa.float64()), pa.array(found, passages)],
                names=["doc_id", "score", "predicted", "evidence", "passages"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, predicted int, evidence double, "
             "passages array<struct<start:long,end:long,score:double>>")


def detect(docs: DataFrame, labels: DataFrame, train, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """Scores and passages of every row of ``docs``; ``train`` tells which labels may be learned from.

    Only the text enters a score.  Null and empty texts have no token, so no evidence
    and the lowest score; repeated rows score alike; an empty table gives no rows.
    """
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return score(own, fit(own, bounded_labels(labels, "toxic", train, max_fit_rows)))
