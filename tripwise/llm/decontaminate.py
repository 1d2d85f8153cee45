"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Seeds are word n-grams of the test items that few items hold.  At a place where the
n-gram is a stock phrase of many items, one of twice the words takes its turn, and so on,
so a place of a document meets a bounded number of items.  A pass over the documents
keeps the regions around places that may hold a seed (a Bloom filter of bounded size
tells).  Any n equal words in a row lead to an alignment unless they are a stock phrase.
Regions and items that share a seed are aligned word by word unless they have too few
words in common for a leak; the local alignment's score decides, so edited and
paraphrased copies count as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import Words, gram_hashes, ranges, text_slices, written

#: Least words of a seed, and of an item (fewer tell no leak: such items match nothing).
SEED_WORDS = 4
#: A gram that more items hold is no seed; a longer one is.
MAX_ITEMS = 32
#: An item is leaked if its alignment scores this share of its words, or so many words.
MIN_SHARE, MIN_SCORE = 0.5, 40
MATCH, MISMATCH, GAP = 1, -1, -1
#: Bits of the Bloom filter for each seed, and in all.
BITS_EACH, MAX_BITS = 64, 1 << 26


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_no, words array<long>) of the items with words; item_no tells repeated ids apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_slices(batches):
            w = Words(texts)
            lists = pa.ListArray.from_arrays(w.offsets.astype(np.int32), w.hashes().view(np.int64))
            yield pa.RecordBatch.from_arrays([rows.column(0), lists], names=["item_id", "words"])

    own = benchmark.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    words = own.mapInArrow(run, f"item_id {dict(own.dtypes)['item_id']}, words array<long>")
    return written(words.filter(F.size("words") > 0).withColumn("item_no", F.monotonically_increasing_id()), "leak-items")


def item_grams(items: DataFrame, n: int = SEED_WORDS) -> DataFrame:
    """(item_no, pos, size, gram): at every place of an item its grams of n, 2 n, 4 n ... words.

    Where a gram would pass the item's end it is the item's last one of that size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for no, words in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w, size = np.array(words.values, np.int64).view(np.uint64), n
                places = len(w) - n + 1
                while size <= len(w):
                    g = gram_hashes(w, size).view(np.int64)
                    g = g[np.minimum(np.arange(places), len(g) - 1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([no] * places, pa.int64()), pa.array(np.arange(places), pa.int32()),
                         pa.array([size] * places, pa.int32()), pa.array(g)], names=["item_no", "pos", "size", "gram"])
                    size *= 2

    return items.select("item_no", "words").mapInArrow(run, "item_no long, pos int, size int, gram long")


def rare_seeds(items: DataFrame, n: int = SEED_WORDS, max_items: int = MAX_ITEMS) -> DataFrame:
    """(item_no, size, gram): at every place of an item its shortest gram that at most ``max_items`` items hold.

    Where even the longest is held by more (items that are copies of each other), the longest.
    """
    grams = item_grams(items, n)
    held = grams.groupBy("size", "gram").agg(F.count_distinct("item_no").alias("held"))
    known = grams.join(held, ["size", "gram"])
    # rare ones by size, then common ones from the longest on
    order = F.when(F.col("held") <= max_items, F.col("size")).otherwise((1 << 30) - F.col("size"))
    best = known.groupBy("item_no", "pos").agg(F.min_by(F.struct("size", "gram"), order).alias("s"))
    return best.select("item_no", "s.size", "s.gram").distinct()


def _probes(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    g = grams.view(np.uint64)
    return ((g & np.uint64(bits - 1)).astype(np.int64),
            ((g >> np.uint64(32)) * np.uint64(0x9E3779B1) & np.uint64(bits - 1)).astype(np.int64))


def bloom_filter(grams: DataFrame, count: int) -> np.ndarray:
    """A bit array of at most MAX_BITS bits with every gram's two bits set (made in 8 tasks)."""
    bits = 1 << 16
    while bits < min(MAX_BITS, BITS_EACH * count):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits, bool)
        for b in batches:
            for p in _probes(np.asarray(b.column(0), np.int64), bits):
                seen[p] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(seen).tobytes()], pa.binary())], names=["b"])

    whole = np.zeros(bits // 8, np.uint8)
    for r in grams.select("gram").coalesce(8).mapInArrow(run, "b binary").toLocalIterator():
        whole |= np.frombuffer(r["b"], np.uint8)
    return np.unpackbits(whole).view(bool)


def regions(docs: DataFrame, bloom: np.ndarray, sizes: list[int], reach: int) -> DataFrame:
    """(doc_id, start, words, grams) of the stretches of each text around places that may hold a seed.

    A stretch reaches ``reach`` words to either side of such a place; stretches that meet
    are one.  grams are the possible seeds in it; ``sizes`` are the seeds' words.
    """
    packed, bits = np.packbits(bloom).tobytes(), len(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)[:bits]
        for rows, texts in text_slices(batches):
            w = Words(texts)
            words = w.hashes()
            if not len(words):
                continue
            doc = np.repeat(np.arange(len(texts)), w.counts)
            where, found = [], []
            for n in sizes:
                g = gram_hashes(words, n)
                one, two = _probes(g, bits)
                hit = np.flatnonzero(there[one] & there[two])
                hit = hit[doc[hit] == doc[hit + n - 1]]
                where.append(hit)
                found.append(g[hit])
            at, grams = np.concatenate(where), np.concatenate(found)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, grams = at[order], grams[order]
            d = doc[at]
            low = np.maximum(at - reach, w.offsets[d])
            high = np.minimum(at + reach + max(sizes), w.offsets[d + 1])
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (low[1:] > high[:-1])])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(at)) - 1
            start, end = low[head], high[tail]
            flat = words[ranges(start, end - start)].view(np.int64)
            word_lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32), flat)
            gram_lists = pa.ListArray.from_arrays(np.append(head, len(at)).astype(np.int32), grams.view(np.int64))
            own = d[head]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(own)), pa.array(start - w.offsets[own], pa.int32()), word_lists, gram_lists],
                names=["doc_id", "start", "words", "grams"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, start int, words array<long>, grams array<long>")


def align(texts: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(score, end in the text) of each pair's best local alignment (match 1, mismatch and gap -1).

    One row of the score matrix of all pairs at a time: gaps along the row are a running maximum.
    """
    n, width = len(texts), max(len(t) for t in texts)
    t = np.zeros((n, width), np.uint64)
    lengths = np.array([len(x) for x in items])
    rows = int(lengths.max())
    q = np.ones((rows, n), np.uint64)
    for i, (a, b) in enumerate(zip(texts, items, strict=True)):
        t[i, :len(a)] = a
        q[:len(b), i] = b
    ramp = np.arange(width, dtype=np.int32)
    last = np.zeros((n, width), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for r in range(rows):
        step = np.where(t == q[r][:, None], MATCH, MISMATCH).astype(np.int32)
        step[:, 1:] += last[:, :-1]
        np.maximum(step, last + GAP, out=step)
        np.maximum(step, 0, out=step)
        step = np.maximum.accumulate(step - GAP * ramp, axis=1) + GAP * ramp
        np.maximum(step, 0, out=step)
        step[r >= lengths] = 0
        top = step.argmax(1)
        value = step[np.arange(n), top]
        better = value > best
        best[better], end[better] = value[better], top[better] + 1
        last = step
    return best, end


def alignments(pairs: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, item_words, start_word, end_word) of rows (doc_id, start, words, item_id, item)."""
    types = dict(pairs.dtypes)

    def side(column: pa.Array) -> list[np.ndarray]:
        flat = np.asarray(column.flatten(), np.int64).view(np.uint64)
        ends = np.cumsum([0] + [len(x) for x in column])
        return [flat[ends[i]:ends[i + 1]] for i in range(len(column))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                texts, items = side(b.column(2)), side(b.column(4))
                score, first, end = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                order = sorted(range(len(texts)), key=lambda i: (len(texts[i]), len(items[i])))
                group: list[int] = []
                for i in [*order, -1]:
                    if group and (i < 0 or (len(group) + 1) * len(texts[i]) > 400_000
                                  or len(texts[i]) > 2 * len(texts[group[0]]) + 32):
                        s, e = align([texts[j] for j in group], [items[j] for j in group])
                        # the same alignment backwards ends where it begins
                        cut = [texts[j][:x][::-1] for j, x in zip(group, e, strict=True)]
                        _, back = align([c if len(c) else np.zeros(1, np.uint64) for c in cut],
                                        [items[j][::-1] for j in group])
                        score[group], end[group], first[group] = s, e, e - back
                        group = []
                    if i >= 0:
                        group.append(i)
                start = np.asarray(b.column(1), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(3), pa.array(score, pa.int32()), pa.array([len(x) for x in items], pa.int32()),
                     pa.array(start + first, pa.int32()), pa.array(start + end, pa.int32())],
                    names=["doc_id", "item_id", "score", "item_words", "start_word", "end_word"])

    return pairs.select("doc_id", "start", "words", "item_id", "item").mapInArrow(
        run, f"doc_id {types['doc_id']}, item_id {types['item_id']}, score int, item_words int, start_word int, end_word int")


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_share: float = MIN_SHARE,
               min_score: int = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, item_words, start_word, end_word): every test item a document holds.

    A row is the best alignment of that document and item, among those of a score of at
    least min_share of the item's words or min_score.  Words are lower-case without
    outer punctuation; items of fewer than SEED_WORDS words match nothing; repeated rows
    and ids give one row; null ids are ids like others.  Other columns play no part.
    """
    items = item_words(benchmark).filter(F.size("words") >= SEED_WORDS)
    seeds = written(rare_seeds(items), "leak-seeds")
    reach = 2 * (items.agg(F.max(F.size("words"))).first()[0] or 0)
    # sizes are doublings, so there are few
    sizes = sorted(r["size"] for r in seeds.select("size").distinct().collect())
    bloom = bloom_filter(seeds, max(1, seeds.count()))
    found = regions(docs, bloom, sizes or [SEED_WORDS], reach)
    found = written(found.withColumn("region", F.monotonically_increasing_id()), "leak-regions")
    places = found.select("region", F.explode(F.array_distinct("grams")).alias("gram"))
    pairs = places.join(seeds.select("item_no", "gram"), "gram").select("region", "item_no").distinct()
    both = (pairs.join(found.select("region", "doc_id", "start", "words"), "region")
            .join(items.select("item_no", "item_id", F.col("words").alias("item")), "item_no"))
    # an alignment scores at most one for each word of the item that the region holds
    shared = F.size(F.filter("item", lambda x: F.array_contains("words", x)))
    both = both.filter((shared >= F.lit(min_share) * F.size("item")) | (shared >= min_score))
    hits = alignments(both).filter((F.col("score") >= F.lit(min_share) * F.col("item_words")) | (F.col("score") >= min_score))
    best = F.max(F.struct("score", "item_words", F.col("start_word"), F.col("end_word")))
    return hits.groupBy("doc_id", "item_id").agg(best.alias("m")).select("doc_id", "item_id", "m.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id holds no test item (null ids: whose equals do not)."""
    leaked = find_leaks(docs, benchmark).select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(leaked, docs["doc_id"].eqNullSafe(leaked["leaked_id"]), "left_anti")
