"""Near-duplicate detection with Order MinHash and banded alignment.

Each sketch takes the three smallest occurrence-labelled two-word shingles of a text
under its own hash and keeps their order in the text, so it depends on edit
similarity and not only on the set of shingles.  Shingles are that short because edits of every
fifth word, which a similarity of 0.8 allows, leave longer ones too rarely whole (of three words
a fourth of those of both texts, of two 0.43).  Scattered edits leave short texts few
whole shingles: texts of up to 50 words are sketched by four single words, and those of
up to nine words, of which one may differ, also have a key for each word left out,
which finds all their pairs.  Texts that agree in a key are candidates unless lengths or
word histograms already show that they are not near; a banded alignment of their words accepts those of edit similarity
1 - distance / longer length >= 0.8.  Classes are the connected components.

Equal texts are one node from the start.  A text is first aligned with the smallest
leader of its buckets (texts of equal sketch), so a group of copies costs one alignment a
text; then with its other leaders that are in other components.  Buckets whose texts
are then still in different components align those with each other in cells of bounded
size, which only links leave, so no link between components is lost and no pair of a
bucket becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import ROW, Words, gram_hashes, mix64, ranges, text_slices, whole_row, written

#: Words of a shingle, shingles of a sketch, sketches of a text, and least similarity.
SHINGLE, PICKS, SKETCHES, SIMILARITY = 2, 3, 40, 0.8
#: Least words of a text with shingle sketches; least and most words of one with sketches of
#: single words, and words of such a sketch; most words of a text with keys of words left out.
#: Near texts have lengths within SIMILARITY, so each near pair has all its keys of one kind.
LONG_WORDS, SHORT_WORDS, SHORT_PICKS, TINY_WORDS = 41, (8, 50), 4, 9
_SEEDS = mix64(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PLACE_BITS = np.uint64(26)
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Keys of a text: shingle sketches, word sketches, words left out (all of one band); those it lacks are _ABSENT.
_TINY_BAND, _KEYS = 2 * SKETCHES, 2 * SKETCHES + TINY_WORDS + 1
_ABSENT = -1


def occurrence_hashes(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that also tell the first, second, ... occurrence in a text apart."""
    key = hashes ^ mix64(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, bool)
    begins = np.flatnonzero(first)
    nth = np.arange(len(ordered)) - np.repeat(begins, np.diff(np.append(begins, len(ordered))))
    out = np.empty_like(hashes)
    out[order] = mix64(hashes[order] + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out


def sketches(words: np.ndarray, offsets: np.ndarray, n_sketches: int = SKETCHES, shingle: int = SHINGLE,
             n_picks: int = PICKS) -> np.ndarray:
    """(texts, sketches) keys; a text of fewer words than a shingle has one shingle, of no word none (keys 0)."""
    n_docs = len(offsets) - 1
    counts = np.diff(offsets)
    grams = gram_hashes(words, shingle)
    n_grams = np.maximum(counts - shingle + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    sizes = n_grams.copy()
    sizes[short] = 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(n_docs), sizes)
    flat = np.empty(starts[-1], np.uint64)
    long_docs = np.flatnonzero(n_grams)
    if len(long_docs):
        at = np.repeat(offsets[long_docs] - starts[long_docs], n_grams[long_docs])
        where = np.flatnonzero(np.repeat(n_grams > 0, sizes))
        flat[where] = grams[where + at]
    for d in short:
        flat[starts[d]] = gram_hashes(words[offsets[d]:offsets[d + 1]], int(counts[d]))[0]
    keys = np.zeros((n_docs, n_sketches), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return keys
    labelled, heads = occurrence_hashes(flat, doc), starts[full]
    place = np.arange(len(flat), dtype=np.uint64) - np.repeat(starts[:-1], sizes).astype(np.uint64)
    low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    rows = np.arange(len(full))
    for s in range(n_sketches):
        v = labelled * _SEEDS[s]
        v ^= v >> np.uint64(29)
        v = (v & ~low) | (place & low)
        picks = np.full((len(full), n_picks), len(flat), np.int64)
        for j in range(n_picks):
            least = np.minimum.reduceat(v, heads)
            found = least != _MAX
            at = heads[found] + (least[found] & low).astype(np.int64)
            picks[rows[found], j] = at
            v[at] = _MAX
        picks.sort(axis=1)
        chosen = np.append(labelled, np.uint64(0))[picks]
        key = np.full(len(full), s + 1, np.uint64)
        for j in range(n_picks):
            key = mix64(key * np.uint64(31) + chosen[:, j])
        keys[full, s] = key
    return keys


def tiny_keys(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, TINY_WORDS + 1) keys of a text and of it without each one of its words.

    Two texts within one edit have such a key in common; of fewer than five words only
    equal words are near, or five that hold them.
    """
    counts = np.diff(offsets)
    keys = np.full((len(counts), TINY_WORDS + 1), _MAX)
    for n in range(1, TINY_WORDS + 1):
        own = np.flatnonzero(counts == n)
        if not len(own):
            continue
        w = words[offsets[own][:, None] + np.arange(n)]
        for out in range(n + 1 if n >= 5 else 1):  # 0: none
            key = np.full(len(own), 7, np.uint64)
            for j in range(n):
                if j + 1 != out:
                    key = mix64(key * np.uint64(31) + w[:, j])
            keys[own, out] = key
    keys.sort(axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = _MAX
    return keys


def text_keys(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, _KEYS) keys of each text."""
    counts = np.diff(offsets)
    keys = np.full((len(counts), _KEYS), _MAX)
    for at, low, high, shingle, n_picks in ((0, LONG_WORDS, None, SHINGLE, PICKS), (SKETCHES, *SHORT_WORDS, 1, SHORT_PICKS)):
        own = np.flatnonzero((counts >= low) & (counts <= (high or counts.max(initial=0))))
        if len(own):
            flat = words[ranges(offsets[own], counts[own])]
            ends = np.concatenate([[0], np.cumsum(counts[own])])
            keys[own, at:at + SKETCHES] = sketches(flat, ends, SKETCHES, shingle, n_picks)
    keys[:, _TINY_BAND:] = tiny_keys(words, offsets)
    return keys


def texts_of(docs: DataFrame) -> DataFrame:
    """(node, text) of each row: node is the md5 of the text (null: empty), equal for equal texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.unhex(F.md5(text)).alias("node"), text.alias("text"))


def sketched(nodes: DataFrame) -> DataFrame:
    """(doc_id, node, n_words, keys) of (doc_id, node, text) rows, one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            w = Words(texts)
            keys = text_keys(w.hashes(), w.offsets).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, _KEYS, dtype=np.int32), keys.ravel())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(w.counts, pa.int32()), lists],
                                             names=["doc_id", "node", "n_words", "keys"])

    return nodes.select("doc_id", "node", "text").mapInArrow(
        run, f"doc_id {dict(nodes.dtypes)['doc_id']}, node binary, n_words int, keys array<long>")


def edit_distances(left: list[np.ndarray], right: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """Cost of an alignment of each pair that shows the similarity, -1 if there is none.

    A pair is near if its word edit distance is at most (1 - similarity) * longer
    length.  Any alignment within a band around the diagonal that costs no more
    proves it; a pair is rejected once the band is as wide as that limit, so both
    answers are exact.  Common ends are cut off, and pairs whose lengths or word
    multisets already differ too much are rejected without alignment.
    """
    n = len(left)
    out = np.full(n, -1, np.int64)
    sizes = np.array([(len(a), len(b)) for a, b in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
    limit = np.floor((1 - similarity) * sizes.max(1, initial=0) + 1e-9).astype(np.int64)
    todo: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i in range(n):
        a, b = left[i], right[i]
        if abs(len(a) - len(b)) > limit[i]:
            continue
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        head = int(differ[0]) if len(differ) else m
        a, b = a[head:], b[head:]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[len(a) - m:] != b[len(b) - m:])
        tail = m - 1 - int(differ[-1]) if len(differ) else m
        a, b = a[:len(a) - tail], b[:len(b) - tail]
        if max(len(a), len(b)) <= limit[i]:
            out[i] = max(len(a), len(b))
            continue
        both, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        diff = (np.bincount(place[:len(a)], minlength=len(both)) - np.bincount(place[len(a):], minlength=len(both)))
        if max(diff[diff > 0].sum(), -diff[diff < 0].sum()) <= limit[i]:
            todo[i] = (a, b)
    for i, x in _coarse_costs(todo).items():
        if x <= limit[i]:
            out[i] = x
            del todo[i]
    band = 8
    while todo:
        order = sorted(todo, key=lambda i: max(map(len, todo[i])))
        at = 0
        while at < len(order):
            longest, upto = max(map(len, todo[order[at]])), at + 1
            while (upto < len(order) and (upto - at) * band < 40_000
                   and max(map(len, todo[order[upto]])) <= 1.3 * longest + 8):
                upto += 1
            group = order[at:upto]
            at = upto
            cost = _banded([todo[i][0] for i in group], [todo[i][1] for i in group], band, limit[group])
            for i, x in zip(group, cost, strict=True):
                if x <= limit[i]:
                    out[i] = x
                if x <= limit[i] or band >= limit[i]:
                    del todo[i]
        band *= 4
    return out


# the coarse alignment changes its diagonal only every so many words, by at most the same number
_BLOCK, _SHIFT = 16, 8


def _coarse_costs(pairs: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, int]:
    """Cost of the best alignment that keeps to a diagonal within each block of words.

    The blocks' mismatches on every diagonal within ``_SHIFT`` are counted at once; a
    step per block then finds the cheapest path, a change of diagonal costing the
    words it skips.  Never less than the edit distance, and far cheaper to find.
    """
    out: dict[int, int] = {}
    order = sorted(pairs, key=lambda i: max(map(len, pairs[i])))
    ramp = np.arange(2 * _SHIFT + 1, dtype=np.int32)
    at = 0
    while at < len(order):
        longest, upto = max(map(len, pairs[order[at]])), at + 1
        while (upto < len(order) and (upto - at) * longest < 200_000
               and max(map(len, pairs[order[upto]])) <= 1.3 * longest + 8):
            upto += 1
        group, at = order[at:upto], upto
        la = np.array([len(pairs[i][0]) for i in group])
        lb = np.array([len(pairs[i][1]) for i in group])
        blocks = -(-int(max(la.max(), 1)) // _BLOCK)
        width = blocks * _BLOCK
        a = np.zeros((len(group), width), np.uint64)
        b = np.ones((len(group), width + 2 * _SHIFT), np.uint64)  # no word, and never equal to what pads a
        for k, i in enumerate(group):
            a[k, :la[k]] = pairs[i][0]
            m = min(lb[k], width + _SHIFT)
            b[k, _SHIFT:_SHIFT + m] = pairs[i][1][:m]
        real = np.arange(width)[None, :] < la[:, None]
        miss = np.stack([((b[:, o:o + width] != a) & real).reshape(len(group), blocks, _BLOCK).sum(2, dtype=np.int32)
                         for o in range(2 * _SHIFT + 1)], axis=2)
        cost = np.broadcast_to(np.abs(ramp - _SHIFT), (len(group), len(ramp))).astype(np.int32)
        result = np.zeros(len(group), np.int64)
        last = -(-la // _BLOCK)
        unread = np.maximum(lb[:, None] - la[:, None] - (ramp - _SHIFT)[None, :], 0)
        for j in range(blocks + 1):
            done = last == j
            if done.any():
                result[done] = (cost[done] + unread[done]).min(1)
            if j == blocks:
                break
            low = np.minimum.accumulate(cost - ramp, axis=1) + ramp
            high = np.minimum.accumulate((cost + ramp)[:, ::-1], axis=1)[:, ::-1] - ramp
            cost = np.minimum(low, high) + miss[:, j]
        out |= dict(zip(group, result.tolist(), strict=True))
    return out


def _banded(left: list[np.ndarray], right: list[np.ndarray], band: int, limits: np.ndarray) -> np.ndarray:
    """Edit distances of the pairs along paths at most ``band`` off the diagonal (large if there is none).

    A pair whose cheapest path already costs more than its limit is given up (large, too).
    """
    n, width = len(left), 2 * band + 1
    la, lb = np.array([len(a) for a in left]), np.array([len(b) for b in right])
    rows = int(la.max())
    a = np.zeros((rows, n), np.uint64)
    b = np.zeros((n, rows + width + 1), np.uint64)  # column c of row i is word i + c - band of the right text
    for k in range(n):
        a[:la[k], k] = left[k]
        m = min(lb[k], rows + width - band)
        b[k, band:band + m] = right[k][:m]
    big = np.int32(1 << 28)
    ramp = np.arange(width, dtype=np.int32)
    cur = np.broadcast_to(np.abs(ramp - band), (n, width)).astype(np.int32).copy()
    cur[:, :band] = big  # before the right text's begin
    cur[:, band:][(ramp[band:] - band)[None, :] > lb[:, None]] = big
    result = np.where(la == 0, lb, big).astype(np.int32)
    last = lb - la + band  # the column that ends the pair in its last row
    of = np.arange(n)  # the pairs that are still aligned
    for i in range(rows):
        j = ramp + (i + 1 - band)  # words of the right text consumed
        same = b[:, i:i + width] == a[i][:, None]
        step = cur + np.where(same, 0, 1).astype(np.int32)
        # column c consumes right word j - 1, which is b[:, band + j - 1] = b[:, i + c]
        step[:, :-1] = np.minimum(step[:, :-1], cur[:, 1:] + 1)
        if band > i:  # j == 0: only deletions
            step[:, band - i - 1] = i + 1
        step[:, j < 0] = big
        step[j[None, :] > lb[:, None]] = big
        step = np.minimum.accumulate(step - ramp, axis=1) + ramp
        step[:, j < 0] = big
        cur = np.minimum(step, big)
        for k in np.flatnonzero(la == i + 1):
            if 0 <= last[k] < width:
                result[of[k]] = cur[k, last[k]]
        if i % 8 == 7:
            alive = (cur.min(1) <= limits) & (la > i + 1)
            if not alive.any():
                break
            if alive.sum() < 0.8 * len(of):
                a, b, cur, la, lb, last, of, limits = a[:, alive], b[alive], cur[alive], la[alive], lb[alive], last[alive], of[alive], limits[alive]
    return result


#: Bins of a text's word histogram, and rows and words that are compared at once.
_BINS, CELL_ROWS, CELL_WORDS = 256, 1024, 1 << 20


def histograms(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, bins) counts of words by hash, at most 255 each."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    flat = np.bincount(doc * _BINS + (mix64(words) % np.uint64(_BINS)).astype(np.int64), minlength=(len(offsets) - 1) * _BINS)
    return np.minimum(flat, 255).astype(np.uint8).reshape(-1, _BINS)


def possible_pairs(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray,
                   similarity: float) -> np.ndarray:
    """(left, right) matrix: whether lengths and histograms allow the similarity.

    An edit adds or removes at most one word of a bin, so what one histogram has
    beyond the other is a lower bound of the distance.
    """
    limit = (1 - similarity) * np.maximum(n_left[:, None], n_right[None, :]) + 1e-9
    ok = np.zeros((len(left), len(right)), bool)
    order = np.argsort(n_right, kind="stable")
    lengths, right16 = n_right[order], right[order].astype(np.int16)
    begin = np.searchsorted(lengths, similarity * n_left - 1e-6, side="left")
    end = np.searchsorted(lengths, n_left / similarity + 1e-6, side="right")
    for i, row in enumerate(left.astype(np.int16)):
        diff = right16[begin[i]:end[i]] - row
        more = np.maximum(diff, 0).sum(1)
        at = order[begin[i]:end[i]]
        ok[i, at] = np.maximum(more, more - diff.sum(1)) <= limit[i, at]
    return ok


#: Pairs that are aligned at once in a cell, at first and at most.
FIRST_PAIRS, MORE_PAIRS = 256, 4096


def linked(pairs: tuple[np.ndarray, np.ndarray], comp: np.ndarray, words: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """The links that join components (numbers ``comp``) among the pairs of places: a spanning forest of them.

    Pairs of components that have met are left out; the first pair of every two components
    comes before their second.
    """
    i, j = pairs
    root = np.arange(int(comp.max(initial=-1)) + 1)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    key = np.minimum(comp[i], comp[j]) * len(root) + np.maximum(comp[i], comp[j])
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(order) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    nth = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    order = order[np.argsort(nth, kind="stable")]
    i, j = i[order], j[order]
    links, at, take = [], 0, FIRST_PAIRS
    while at < len(i):
        some = [k for k in range(at, min(at + take, len(i))) if find(comp[i[k]]) != find(comp[j[k]])]
        at, take = at + take, min(2 * take, MORE_PAIRS)
        if some:
            near = edit_distances([words[i[k]] for k in some], [words[j[k]] for k in some], similarity)
            for k in np.array(some)[near >= 0]:
                x, y = find(comp[i[k]]), find(comp[j[k]])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    links.append((int(i[k]), int(j[k])))
    return links


def links_across(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links that join the components of one bucket's near texts.

    members: (bucket, band, node, comp, n_words, keys, words).  A bucket's rows are dealt
    over chunks of about ``CELL_ROWS`` rows and ``CELL_WORDS`` words; each pair of chunks
    is one group, so no group grows with a bucket, and its pairs are aligned there: only
    links leave it, fewer than its components.  A pair is aligned in the first bucket
    that both texts share (or in those of words left out).
    """
    sizes = members.groupBy("bucket").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(CELL_ROWS)), F.ceil(F.sum("n_words") / F.lit(CELL_WORDS))).cast("int").alias("chunks"))
    dealt = members.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    cells = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .withColumns({"row": F.least("own", "other"), "col": F.greatest("own", "other")}))

    def compare(group: pa.Table) -> pa.Table:
        own, row, col = (group[c].to_numpy() for c in ("own", "row", "col"))
        node = group["node"].combine_chunks()
        comp = np.unique(np.array(group["comp"].to_pylist(), dtype=object), return_inverse=True)[1]
        lists = group["words"].combine_chunks()
        flat = np.asarray(lists.flatten(), dtype=np.int64).view(np.uint64)
        n = group["n_words"].to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(n)])
        hist, n = histograms(flat, ends), n.astype(np.float64)
        left, right = np.flatnonzero(own == row), np.flatnonzero(own == col)
        ok = possible_pairs(hist[left], hist[right], n[left], n[right], similarity)
        ok &= comp[left][:, None] != comp[right][None, :]
        i, j = np.nonzero(ok)
        i, j = left[i], right[j]
        if len(row) and row[0] == col[0]:
            i, j = i[i < j], j[i < j]
        keys = np.asarray(group["keys"].combine_chunks().flatten(), np.int64).reshape(len(own), -1)
        band, first = group["band"].to_numpy(), np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 16):
            a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            same = (keys[a] == keys[b]) & (keys[a] != _ABSENT)
            first[at:at + (1 << 16)] = (same.argmax(1) == band[a]) | (band[a] == _TINY_BAND)
        words = [flat[ends[k]:ends[k + 1]] for k in range(len(own))]
        found = np.array(linked((i[first], j[first]), comp, words, similarity), np.int64).reshape(-1, 2)
        return pa.table({"a": node.take(pa.array(found[:, 0])), "b": node.take(pa.array(found[:, 1]))})

    found = (cells.select("bucket", "band", "row", "col", "own", "node", "comp", "n_words", "keys", "words")
             .groupBy("bucket", "row", "col").applyInArrow(compare, "a binary, b binary"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def possible(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Those (a, b) node pairs whose word histograms allow the similarity; words: (node, hist, n_words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, _BINS).astype(np.int16)
                           for c in (2, 3))
            limit = (1 - similarity) * np.maximum(b.column(4).to_numpy(), b.column(5).to_numpy()) + 1e-9
            diff = right - left
            more = np.maximum(diff, 0).sum(1)
            keep = pa.array(np.flatnonzero(np.maximum(more, more - diff.sum(1)) <= limit))
            yield pa.RecordBatch.from_arrays([b.column(0).take(keep), b.column(1).take(keep)], names=["a", "b"])

    both = (pairs.join(words.select(F.col("node").alias("a"), F.col("hist").alias("ha"), F.col("n_words").alias("na")), "a")
            .join(words.select(F.col("node").alias("b"), F.col("hist").alias("hb"), F.col("n_words").alias("nb")), "b"))
    return both.select("a", "b", "ha", "hb", "na", "nb").mapInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Those (a, b) node pairs whose texts have the similarity; words: (node, words array<long>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sides = []
                for c in (2, 3):
                    col = batch.column(c)
                    flat = np.asarray(col.flatten(), dtype=np.int64).view(np.uint64)
                    ends = np.cumsum([0] + [len(x) for x in col])
                    sides.append([flat[ends[i]:ends[i + 1]] for i in range(len(col))])
                d = edit_distances(sides[0], sides[1], similarity)
                keep = np.flatnonzero(d >= 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)),
                                                  batch.column(1).take(pa.array(keep))], names=["a", "b"])

    both = (pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a")
            .join(words.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b"))
    return both.select("a", "b", "wa", "wb").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node in ``links`` (a, b): comp is the smallest node of its component.

    Every round each node takes the least label of its neighbours and then its label's
    label; rounds are cut by written tables and go on until nothing changes.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                   "near-edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        near = labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.least("comp", "m").alias("near"), F.col("comp").alias("was"))
        jump = labels.select(F.col("node").alias("near"), F.col("comp").alias("far"))
        after = written(near.join(jump, "near").select("node", F.least("near", "far").alias("comp"), "was"), "labels")
        labels = after.select("node", "comp")
        if after.filter("comp <> was").isEmpty():
            return labels


def joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` (node, comp) after further links (a, b): only the components that these touch are merged."""
    ends = (links.join(comp.withColumnsRenamed({"node": "a", "comp": "ca"}), "a", "left")
            .join(comp.withColumnsRenamed({"node": "b", "comp": "cb"}), "b", "left")
            .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")))
    ends = written(ends, "near-ends")
    merged = components(ends.filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    new = (ends.select(F.col("a").alias("node"), F.col("ca").alias("comp"))
           .unionByName(ends.select(F.col("b").alias("node"), F.col("cb").alias("comp"))))
    every = comp.unionByName(new).distinct()
    return written(every.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("into")), "comp", "left")
                   .select("node", F.coalesce("into", "comp").alias("comp")), "near-components")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, node, n_words, comp, class_id) of every row of ``docs`` (doc_id, text).

    class_id is the smallest doc_id of the row's class (null only if the class has no
    other id); node is the hash of the text and comp the smallest node of the class.
    Null texts are empty; all empty texts are one class; texts that differ only in
    case, white space or outer punctuation of words are near.  Repeated rows are all
    returned.  Columns other than doc_id and text play no part.
    """
    base = texts_of(docs)
    sk = written(sketched(base), "near-sketches")
    nodes = sk.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
                                   F.first("keys").alias("keys"))
    members = (nodes.filter("n_words > 0")
               .select("node", "n_words", "doc_id", F.posexplode("keys").alias("pos", "key"))
               .filter(F.col("key") != _ABSENT).withColumn("band", F.least("pos", F.lit(_TINY_BAND)))
               .select("node", "n_words", "doc_id", "band", F.xxhash64("band", "key").alias("bucket")))
    members = written(members, "near-members")
    leaders = members.groupBy("bucket").agg(F.min(F.struct("node", "n_words")).alias("l"), F.max("node").alias("other"))
    leaders = leaders.select("bucket", F.col("l.node").alias("leader"), F.col("l.n_words").alias("leader_words"), "other")
    # buckets of one text have no pair
    shared = written(members.join(leaders.filter("leader < other").drop("other"), "bucket"), "near-buckets")
    near_length = F.least("n_words", "leader_words") >= similarity * F.greatest("n_words", "leader_words") - 1e-6
    star = shared.filter("node > leader").filter(near_length).select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    # the words of candidate texts only: one row of documents for each
    wanted = shared.groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            w = Words(texts)
            lists = pa.ListArray.from_arrays(w.offsets.astype(np.int32), w.hashes().view(np.int64))
            hist = pa.array([h.tobytes() for h in histograms(w.hashes(), w.offsets)], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column(0), lists, hist, pa.array(w.counts, pa.int32())],
                                             names=["node", "words", "hist", "n_words"])

    one = (base.join(wanted.withColumnRenamed("doc_id", "first_id").withColumnRenamed("node", "n"),
                     (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
           .select("node", "text"))
    words = written(one.mapInArrow(worded, "node binary, words array<long>, hist binary, n_words int").dropDuplicates(["node"]), "near-words")
    star = written(star, "near-star")
    smallest = star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    comp = written(components(verified(possible(smallest, words, similarity), words, similarity)), "near-components")
    ca, cb = comp.withColumnsRenamed({"node": "a", "comp": "ca"}), comp.withColumnsRenamed({"node": "b", "comp": "cb"})
    apart = (star.join(smallest, ["a", "b"], "left_anti").join(ca, "a", "left").join(cb, "b", "left")
             .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
    comp = joined(comp, verified(possible(apart, words, similarity), words, similarity))
    # buckets that still hold several components: pairs between their components
    of = shared.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # (all have met their leader, so between the others)
    mixed = of.filter("node > leader").groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1")
    open_members = written(of.join(mixed.select("bucket"), "bucket"), "near-open")
    rest = (open_members.filter("node > leader").select("bucket", "band", "node", "comp", "n_words")
            .join(words.select("node", "words"), "node").join(nodes.select("node", "keys"), "node"))
    comp = joined(comp, links_across(rest, similarity))
    ids = nodes.select("node", "doc_id")
    heads = comp.join(ids, "node").groupBy("comp").agg(F.min("doc_id").alias("class_id"))
    linked = comp.join(heads, "comp").select("node", "comp", "class_id")
    # texts without links are their own class
    whole = written(ids.join(linked, "node", "left").select(
        "node", F.coalesce("comp", "node").alias("comp"),
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")), "near-classes")
    return sk.select("doc_id", "node", "n_words").join(whole, "node")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, n_words): one row for each row of ``docs``."""
    return near_duplicates(docs, similarity).select("doc_id", "class_id", "n_words")


def representatives(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without all but one row of every class: that of the smallest doc_id (nulls last),
    then of the smallest text hash; of fully repeated (doc_id, text) rows any one."""
    found = near_duplicates(docs, similarity)
    kept = found.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "node")).alias("k"))
    keep = written(kept.select(F.col("k.doc_id").alias("keep_id"), F.col("k.node").alias("keep_node")), "near-kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.select("doc_id", F.unhex(F.md5(text)).alias("near_node"), whole_row(docs))
    one = marked.join(keep, (F.col("near_node") == F.col("keep_node")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # rows that repeat a kept id and text: their number first, so the texts move only where there are any
    again = one.groupBy("doc_id", "near_node").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "near_node")
    if not again.isEmpty():
        one = one.dropDuplicates(["doc_id", "near_node"])
    return one.select(f"{ROW}.*")
