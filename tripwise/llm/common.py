"""Helpers the operators share: written intermediate tables, words in Arrow batches, hashes.

Intermediate tables go to the folder named by ``spark.checkpoint.dir`` as Parquet
(Spark's commit protocol, so a lost executor only repeats its tasks).
"""

from __future__ import annotations

import tempfile
import unicodedata
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tripwise
from tripwise.session import checkpoint_dir

#: Texts are handled in slices of about so many characters, which bounds a task's memory.
SLICE_BYTES = 6 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, wherever they run (once a session)."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(tripwise.__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="tripwise-ship-")) / "tripwise-package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f"{root.name}/{f.relative_to(root)}")
        sc.addPyFile(str(archive))
        _SHIPPED.add(sc.applicationId)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again (cuts the lineage)."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Name of the column of ``whole_row``.
ROW = "whole_row"


def whole_row(df: DataFrame):
    """All columns of ``df`` as one struct, so that an operator's own names never meet them; ``select("whole_row.*")`` unpacks."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(rows, texts) slices of the batches; texts is a large_string array, null texts are empty.

    A slice ends before ``limit`` bytes are passed; one longer text is a slice of its own.
    """
    for batch in batches:
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
        at = 0
        while at < len(texts):
            base = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, upto - at), texts.slice(at, upto - at)
            at = upto


def word_form(raw: str) -> str:
    """A token as the operators compare it: no marks at either end, NFC ('' if nothing is left)."""
    a, b = 0, len(raw)
    while a < b and unicodedata.category(raw[a])[0] not in "LN":
        a += 1
    while b > a and unicodedata.category(raw[b - 1])[0] not in "LNM":
        b -= 1
    return unicodedata.normalize("NFC", raw[a:b])


def _word_forms(raw: pa.Array) -> pa.Array:
    """``word_form`` of many tokens; only tokens with combining marks need the normal form."""
    bare = pc.replace_substring_regex(raw, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}\p{M}]+$", "")
    marked = pc.match_substring_regex(bare, r"\p{M}")
    if not pc.any(marked).as_py():
        return bare
    normal = [unicodedata.normalize("NFC", x) for x in bare.filter(marked).to_pylist()]
    return pc.replace_with_mask(bare, marked, pa.array(normal, bare.type))


class Words:
    """The words of a slice of texts: codes into ``forms``, and where each text's words begin.

    Texts are lower-cased and split at white space; ``forms`` are the distinct word forms.
    """

    def __init__(self, texts: pa.Array):
        lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
        # a list array's offsets, whatever slice of its child it shows
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        offsets = offsets - offsets[0]
        tokens = lists.flatten().dictionary_encode()
        shaped = _word_forms(tokens.dictionary).dictionary_encode()
        to_form = np.asarray(shaped.indices, dtype=np.int64)
        codes = to_form[np.asarray(tokens.indices, dtype=np.int64)] if len(to_form) else np.zeros(0, np.int64)
        empty = pc.index(shaped.dictionary, pa.scalar("", shaped.dictionary.type)).as_py()
        if empty >= 0:
            keep = codes != empty
            before = np.concatenate([[0], np.cumsum(keep)])
            offsets, codes = before[offsets], codes[keep]
        self.codes, self.offsets, self.forms = codes, offsets, shaped.dictionary.to_pylist()

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        of = np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in self.forms), np.uint64, len(self.forms))
        return of[self.codes] if len(of) else np.zeros(0, np.uint64)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix64(x: np.ndarray) -> np.ndarray:
    """The usual 64-bit finaliser (xor-shift, multiply), vectorised."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that begin at each place (the last n - 1 places have none)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    for j in range(n):
        out = out * odd + words[j:j + m]
    return mix64(out + np.uint64(n))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] of them), then those of starts[1], ..."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted least-squares non-decreasing fit (pool adjacent violators) of y over sorted x.

    Returns the block's last x and its value; look up with ``calibrated``.
    """
    blocks: list[list[float]] = []  # last x, mean, weight
    for xi, yi, wi in zip(x, y, w, strict=True):
        blocks.append([xi, yi, wi])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            a, b = blocks[-2], blocks.pop()
            blocks[-1] = [b[0], (a[1] * a[2] + b[1] * b[2]) / (a[2] + b[2]), a[2] + b[2]]
    return np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])


def calibrated(edges: np.ndarray, values: np.ndarray, x: np.ndarray) -> np.ndarray:
    return values[np.minimum(np.searchsorted(edges, x, side="left"), len(values) - 1)]


def crc_fold(column: str, folds: int):
    """crc32 of the id's text, modulo ``folds`` (null id: the crc32 of an empty text, 0)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(folds)
