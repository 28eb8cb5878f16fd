"""Importance resampling: documents drawn as if from the distribution of a target corpus.

Words and runs of up to three words are hashed into buckets, counted over all documents and over
the target. A bucket's gain is the logarithm of how much more frequent it is in the target; a
document's weight is the sum of its features' gains, and the highest weights plus Gumbel noise
are a draw without replacement. The noise is a hash of the identifier, so that reruns agree.

Features by batch concatenation: the texts of a block are joined with a separator, one pass of
a regular expression finds all words and separators, the separators' places are the documents'
offsets, and a binary search of the features' places in them masks runs that cross documents
before their buckets are counted. The checksum of a run comes from those of its words by a
table, as that of a joined text does from its parts.

Counting gives one row of ``BUCKETS`` numbers per task, scoring is a second pass over the texts
with the gains; only scores are sorted, over all tasks, and a rank is the place in a part of the
order plus the sizes of the parts before it.

Defined results: a null or empty text has no features, weight 0 and a score, and is not drawn,
as are those below ``min_words``; very long texts are whole (memory in proportion to the text);
ties go to the smaller identifier, null last; repeated rows are drawn by themselves; a null
identifier has the noise of an empty one; an empty target gives gains from its zero counts; an
empty table has no rows; further columns are kept, but those named like a result.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm import arrays
from maskwright.llm.common import number, numbered, restored, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
#: Row numbers (8 bytes each) that may be broadcast.
BROADCAST_ROWS = 1_000_000
RESULTS = ("n_words", "n_features", "weight", "score", "rank")
#: A byte that no UTF-8 text holds.
SEPARATOR = b"\xff"
_WORDS = re.compile(rb"[0-9a-z\x80-\xfe]+|\xff")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Word lengths with a table of their own; longer ones (plus a blank) take several steps.
_LENGTHS = 64


def _advance_tables() -> np.ndarray:
    """[n, i, byte] -> the checksum register ``byte << 8 i`` after n zero bytes; by linearity the
    four entries of a register's bytes together are the register after n zero bytes."""
    one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)
    register = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    tables = [register]
    for _ in range(_LENGTHS):
        last = tables[-1]
        tables.append(one[last & np.uint32(255)] ^ (last >> np.uint32(8)))
    return np.stack(tables)


_tables: list[np.ndarray] = []


def _advanced(register: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each register after its number of zero bytes."""
    if not _tables:
        _tables.append(_advance_tables())
    table = _tables[0].reshape(_LENGTHS + 1, 4 * 256)
    left = n
    while True:
        step = np.minimum(left, _LENGTHS)
        row = table.reshape(-1)
        base = step * 1024
        out = row[base + (register & np.uint32(255))]
        out = out ^ row[base + 256 + ((register >> np.uint32(8)) & np.uint32(255))]
        out ^= row[base + 512 + ((register >> np.uint32(16)) & np.uint32(255))]
        out ^= row[base + 768 + (register >> np.uint32(24))]
        left = left - step
        if not left.any():
            return out
        register = out


def features(texts: bytes, longest: int = LONGEST_RUN) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of lower-cased texts, each followed by the separator: for runs of 1, 2, ... words the
    document of each run and its bucketless checksum."""
    found = _WORDS.findall(texts)
    size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    word = np.fromiter(map(zlib.crc32, found), dtype=np.uint32, count=len(found))
    offsets = np.flatnonzero((size == 1) & (word == np.uint32(zlib.crc32(SEPARATOR))))
    # A word after a blank: the blank's checksum moved on by the word, and the word's.
    after = _advanced(np.full(len(word), zlib.crc32(b" "), dtype=np.uint32), size) ^ word
    run = word
    for k in range(1, longest + 1):
        if k > 1:
            run = _advanced(run[:-1], size[k - 1 :] + 1) ^ after[k - 1 :] if len(run) > 1 else run[:0]
        document = np.searchsorted(offsets, np.arange(len(run)))
        end = np.searchsorted(offsets, np.arange(len(run)) + k - 1)
        inside = document == end
        # A separator itself ends its document: no run holds one.
        last = offsets[np.minimum(end, len(offsets) - 1)] if len(offsets) else end
        inside &= np.arange(len(run)) + k - 1 < last
        yield document[inside], run[inside]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    offsets, data = arrays.buffers(batch.column("text"))
    for lo, hi in arrays.blocks(offsets):
        raw = data[offsets[lo] : offsets[hi]].tobytes().translate(_LOWER)
        cut = (offsets[lo : hi + 1] - offsets[lo]).tolist()
        joined = SEPARATOR.join(raw[a:b] for a, b in zip(cut, cut[1:])) + SEPARATOR
        yield lo, hi, joined


def _counting(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, joined in _blocks(batch):
                for _, checksum in features(joined):
                    total += np.bincount(checksum % np.uint32(buckets), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], names=["bucket", "n"])

    return run


def counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The features of all texts in each bucket. A task sends at most a row per bucket, and the
    driver gets as many."""
    parts = df.select(F.col(text).cast("string").alias("text")).mapInArrow(_counting(buckets), "bucket int, n long")
    found = np.zeros(buckets, dtype=np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[r["bucket"]] = r["n"]
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln of its smoothed frequency in the target over that in the source)."""
    s, t, b = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log(float(y + 1) * float(s + b) / (float(x + 1) * float(t + b))))
        for x, y in zip(source.tolist(), target.tolist())
    ], dtype=np.int64)


def noise(seed: str, identifier: object) -> int:
    """Gumbel noise in thousandths, from a hash of the identifier."""
    name = "" if identifier is None else str(identifier)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weighing(gain: np.ndarray, seed: str) -> Callable:
    buckets = np.uint32(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            n_words, n_features, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for lo, hi, joined in _blocks(batch):
                for k, (document, checksum) in enumerate(features(joined)):
                    each = np.bincount(document, minlength=hi - lo)
                    if k == 0:
                        n_words[lo:hi] = each
                    n_features[lo:hi] += each
                    edges = np.append(0, np.cumsum(each))
                    total = np.append(0, np.cumsum(gain[checksum % buckets]))
                    weight[lo:hi] += total[edges[1:]] - total[edges[:-1]]
            drift = np.array([noise(seed, i) for i in batch.column("id").to_pylist()], dtype=np.int64)
            new = dict(zip(RESULTS, (n_words, n_features, weight, weight + drift)))
            kept = [name for name in batch.schema.names if name not in ("text", *new)]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), *map(pa.array, new.values())], names=[*kept, *new]
            )

    return run


def _weighed(docs: DataFrame, target: DataFrame, target_text: str, seed: str) -> DataFrame:
    """Rows (id, text, ...) -> written rows (id, ..., n_words, n_features, weight, score)."""
    gain = gains(counts(docs), counts(target, target_text))
    kept = [f for f in docs.schema if f.name != "text"]
    schema = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in RESULTS[:-1]]])
    return written(docs.mapInArrow(_weighing(gain, seed), schema), "weights")


def _ranked(weighed: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``weighed`` with ``rank``: the place in the order of scores of those drawn, else null."""
    able = weighed.where(F.col("n_words") >= min_words)
    n = percent * able.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("id")]
    # The number of a row is that of its part of the order, then its place there.
    placed = written(able.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "order")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))  # a row per task
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.withColumn("part", part).join(F.broadcast(sizes), "part")
    ranked = ranked.select(*weighed.columns, F.when(rank <= n, rank).alias("rank"))
    short = weighed.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(short)


def resampled(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
              percent: int = 5, min_words: int = MIN_WORDS, seed: str = "42") -> DataFrame:
    """Per row of ``df``: its ``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and, if it is
    among the ``percent`` of the documents of at least ``min_words`` that are drawn, its ``rank``."""
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return _ranked(_weighed(docs, target, target_text, seed), percent, min_words).withColumnRenamed("id", key)


def drawn(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
          percent: int = 5, min_words: int = MIN_WORDS, seed: str = "42") -> DataFrame:
    """The rows of ``df`` that are drawn, with their columns. ``df`` is written once, so that its
    rows can be told apart."""
    rows, names = numbered(df)
    held = written(rows.withColumn("tag", F.monotonically_increasing_id()), "rows")
    docs = held.select(F.col(number(names, key)).alias("id"), F.col(number(names, text)).alias("text"), "tag")
    ranked = _ranked(_weighed(docs, target, target_text, seed), percent, min_words)
    tags = written(ranked.where(F.col("rank").isNotNull()).select("tag"), "drawn")
    tags = F.broadcast(tags) if tags.count() <= BROADCAST_ROWS else tags
    return restored(held.join(tags, "tag", "left_semi"), names)
