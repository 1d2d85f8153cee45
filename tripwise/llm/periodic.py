"""Runs of repeated words: difference-cover common extensions and a harmonic grid.

Only the suffixes whose place is in a difference cover modulo 13 are sorted, by their
first 13 words and then by doubling.  Any two places have a shift below 13 that brings
both into the cover, so their longest common extension is at most 12 compared words and
one range minimum over the sorted samples' common prefixes (a sparse table).

A run of period q and length 4 q or more has equal words q apart on a stretch of at
least 3 q places, which holds a multiple of 3 q.  Extensions at those places, for all
periods (n/3 + n/6 + n/9 ... of them), find every run; a binary search of extensions
finds where it begins.  All texts of a slice share one index, as extensions stop at
their ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import ranges, text_slices

#: A difference cover: every remainder modulo 13 is the difference of two of these (fixed values).
MODULUS, COVER = 13, (0, 1, 3, 9)
#: A run has so many words at least, and so many times its period.
MIN_WORDS, MIN_EXPONENT = 6, 4
#: Bytes of text that are indexed together, and grid places that are looked up together.
SLICE_BYTES, GRID_PLACES = 3 << 20, 1 << 20


def _shifts() -> np.ndarray:
    """(MODULUS, MODULUS): the shift that brings places of these two remainders into the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    both = np.arange(MODULUS)
    return np.array([[next(d for d in range(MODULUS) if inside[(i + d) % MODULUS] and inside[(j + d) % MODULUS])
                      for j in both] for i in both], np.int64)


_SHIFT = _shifts()


class Extensions:
    """Longest common extensions of places in ``codes``; they end at the ends of the texts (``offsets``)."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray):
        n = len(codes)
        counts = np.diff(offsets)
        self.n = n
        # what follows a text is no word: a code of its own for each text (and padding), so no extension passes it
        at = np.arange(n) + np.repeat(np.arange(len(counts)), counts)
        total = n + len(counts)
        words = np.empty(total + 2 * MODULUS, np.int64)
        words[:] = -1 - np.arange(len(words))
        words[at] = codes
        self._words, self._at = words, at
        place = np.arange(total)
        place = place[np.isin(place % MODULUS, COVER)]
        self._slot = np.full(total + 2 * MODULUS, -1, np.int64)
        self._slot[place] = np.arange(len(place))
        self._place = place
        self._sort()

    def _first_rank(self) -> np.ndarray:
        """Ranks of the samples by their first MODULUS words."""
        columns = [self._words[self._place + t] for t in range(MODULUS)]
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(order), bool)
        for c in columns:
            sorted_c = c[order]
            new[1:] |= sorted_c[1:] != sorted_c[:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _sort(self) -> None:
        place, m = self._place, len(self._place)
        levels, step = [self._first_rank()] if m else [], MODULUS
        while m and levels[-1].max() < m - 1:
            rank = levels[-1]
            later = place + step
            # places a multiple of MODULUS apart are both samples, or beyond the end
            inside = later < len(self._slot)
            follow = np.full(m, -1, np.int64)
            slots = self._slot[later[inside]]
            follow[inside] = np.where(slots >= 0, rank[np.maximum(slots, 0)], -1)
            key = rank * (m + 1) + follow + 1
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            after = np.empty(m, np.int64)
            after[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
            levels.append(after)
            step *= 2
        self._rank = levels[-1] if m else np.zeros(0, np.int64)
        order = np.empty(m, np.int64)
        order[self._rank] = np.arange(m)
        # common prefixes of neighbours in the sorted order, from the ranks of all lengths
        a, b = place[order[:-1]], place[order[1:]]
        common = np.zeros(max(0, m - 1), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            i, j = a + common, b + common
            inside = np.maximum(i, j) < len(self._slot)
            si, sj = self._slot[i[inside]], self._slot[j[inside]]
            same = np.zeros(len(common), bool)
            same[inside] = (si >= 0) & (sj >= 0) & (levels[k][np.maximum(si, 0)] == levels[k][np.maximum(sj, 0)])
            common[same] += MODULUS << k
        common += self._direct(a + common, b + common, np.full(len(common), MODULUS))
        self._table = [common.astype(np.int32)]
        while (width := 1 << len(self._table)) <= len(common):
            low = self._table[-1]
            self._table.append(np.minimum(low[:-(width >> 1)], low[width >> 1:]))

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most ``most`` (inner places)."""
        out = np.zeros(len(i), np.int64)
        open_ = np.flatnonzero(most > 0)
        t = 0
        while len(open_):
            open_ = open_[self._words[i[open_] + t] == self._words[j[open_] + t]]
            t += 1
            out[open_] = t
            open_ = open_[most[open_] > t]
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from the places i and j (different places of one text) on."""
        i, j = self._at[i], self._at[j]
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        out = self._direct(i, j, shift)
        rest = np.flatnonzero(out == shift)
        if len(rest):
            a = self._rank[self._slot[i[rest] + shift[rest]]]
            b = self._rank[self._slot[j[rest] + shift[rest]]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            extra = np.empty(len(rest), np.int64)
            for k in np.unique(level):
                own = np.flatnonzero(level == k)
                table = self._table[k]
                extra[own] = np.minimum(table[low[own]], table[high[own] - (1 << int(k))])
            out[rest] += extra
        return out


def _grid(counts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place in it, period) of all grid places, about ``most`` at a time."""
    if not len(counts):
        return
    order = np.argsort(-counts, kind="stable")
    sizes = counts[order]
    texts, places, periods, held = [], [], [], 0
    for q in range(1, int(sizes[0]) // MIN_EXPONENT + 1):
        # texts long enough for the period come first
        m = int(np.searchsorted(-sizes, -max(MIN_WORDS, MIN_EXPONENT * q), side="right"))
        if not m:
            break
        # places i = 0, 3 q, ... with i + q inside the text
        each = -(-(sizes[:m] - q) // ((MIN_EXPONENT - 1) * q))
        texts.append(np.repeat(order[:m], each))
        places.append(ranges(np.zeros(m, np.int64), each) * ((MIN_EXPONENT - 1) * q))
        periods.append(np.full(len(places[-1]), q, np.int64))
        held += len(places[-1])
        if held >= most:
            yield np.concatenate(texts), np.concatenate(places), np.concatenate(periods)
            texts, places, periods, held = [], [], [], 0
    if held:
        yield np.concatenate(texts), np.concatenate(places), np.concatenate(periods)


def runs_of(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, start, length, period) rows of every run of every text, by text, start and period."""
    counts = np.diff(offsets)
    none = np.zeros((0, 4), np.int64)
    if not len(codes):
        return none
    index = Extensions(codes, offsets)
    found = []
    for text, place, q in _grid(counts, GRID_PLACES):
        i = offsets[text] + place
        some = np.flatnonzero(codes[i] == codes[i + q])
        text, place, q, i = text[some], place[some], q[some], i[some]
        need = np.maximum(MIN_WORDS, MIN_EXPONENT * q) - q
        ahead = index.lce(i, i + q)
        # the words still needed must stand before the place
        back = np.maximum(need - ahead, 0)
        ok = np.flatnonzero(back <= place)
        ok = ok[(back[ok] == 0) | (index.lce(i[ok] - back[ok], i[ok] + q[ok] - back[ok]) >= back[ok])]
        # a stretch is taken at its first grid place
        step = (MIN_EXPONENT - 1) * q[ok]
        earlier = np.flatnonzero(place[ok] >= step)
        before = i[ok][earlier] - step[earlier]
        seen = np.zeros(len(ok), bool)
        seen[earlier] = index.lce(before, before + q[ok][earlier]) >= step[earlier]
        ok = ok[~seen]
        text, place, q, i, ahead, back = text[ok], place[ok], q[ok], i[ok], ahead[ok], back[ok]
        # how many words before the place still continue the period: between back and least(place, 3 q - 1)
        low, high = back, np.minimum(place, (MIN_EXPONENT - 1) * q - 1)
        while len(low) and (low < high).any():
            middle = (low + high + 1) // 2
            holds = np.ones(len(low), bool)
            ask = np.flatnonzero(low < high)
            holds[ask] = index.lce(i[ask] - middle[ask], i[ask] - middle[ask] + q[ask]) >= middle[ask]
            low, high = np.where(holds, middle, low), np.where(holds, high, middle - 1)
        found.append(np.stack([text, place - low, low + ahead + q, q], axis=1))
    every = np.concatenate([none, *found])
    # of equal stretches the smallest period is the run's; multiples of it are none
    every = every[np.lexsort((every[:, 3], every[:, 2], every[:, 1], every[:, 0]))]
    first = np.ones(len(every), bool)
    first[1:] = (every[1:, :3] != every[:-1, :3]).any(1)
    every = every[first]
    return every[np.lexsort((every[:, 3], every[:, 1], every[:, 0]))]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words, offsets of each text's words): split at ASCII white space."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    words = lists.flatten()
    offsets = offsets - offsets[0]
    real = np.asarray(pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False), bool)
    if not real.all():  # white space at either end leaves empty words
        before = np.concatenate([[0], np.cumsum(real)])
        offsets, words = before[offsets], words.filter(pa.array(real))
    return words, offsets


def collapsed(words: pa.Array, offsets: np.ndarray, runs: np.ndarray) -> pa.Array:
    """Each text's words joined by a space, without what a run repeats after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, offsets[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
    np.add.at(change, offsets[runs[:, 0]] + runs[:, 1] + runs[:, 2], -1)
    keep = np.cumsum(change[:-1]) == 0
    if not keep.all():
        before = np.concatenate([[0], np.cumsum(keep)])
        offsets, words = before[offsets], words.filter(pa.array(keep))
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), words)
    return pc.binary_join(lists, pa.scalar(" ", words.type))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words long, runs array<struct<start, length, period>>, best struct, collapsed string) of every row.

    Words are separated by ASCII white space and numbered from 0.  A run is a stretch of
    words with smallest period q (words q apart are equal) of at least max(6, 4 q) words
    that no neighbouring word extends; runs are ordered by start, then period.  best is
    the run of greatest length / period (ties: smallest start, then period; null without
    runs).  collapsed is the text without the words that any run holds after its first
    period.  Null and empty texts have no words and an empty collapsed text; null ids and
    repeated rows are returned like others; other columns play no part.  A text is
    indexed whole, in one task.
    """
    run_type = "struct<start: bigint, length: bigint, period: bigint>"
    fields = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches, limit=SLICE_BYTES):
            words, offsets = split_words(texts)
            codes = np.asarray(words.dictionary_encode().indices, dtype=np.int64)
            found = runs_of(codes, offsets)
            structs = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], fields=list(fields))
            ends = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
            # doubles tell all quotients of numbers below 2^26 apart
            order = np.lexsort((found[:, 3], found[:, 1], -found[:, 2] / found[:, 3], found[:, 0]))
            has = np.flatnonzero(np.diff(ends))
            top = np.full(len(texts), -1, np.int64)
            top[has] = order[ends[has]]
            best = structs.take(pa.array(top, mask=top < 0))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(offsets)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs), best,
                 collapsed(words, offsets, found).cast(pa.string())],
                names=[id_col, "n_words", "runs", "best", "collapsed"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"{id_col} {kind}, n_words bigint, runs array<{run_type}>, best {run_type}, collapsed string")
