"""Benchmark decontamination with suffix arrays over the training text.

Each task cuts its documents into shards of some megabytes and sorts their suffixes.
Every suffix of a benchmark item that can start a window is searched in that array by
bisection; the range found gives all places of the window, and windows chained at
neighbouring places give longer verbatim matches. Suffixes are of words, and only
those words are suffixes that lie in a stretch of benchmark words as long as the
shortest window, as no other can match.

The benchmark is the stated query set. It is streamed to the workers in blocks of
bounded size; documents pass through one task per block and are never shuffled, so that
neither a hot document nor a hot passage gathers anywhere.

Defined results: null and empty texts have no words and no hits; null benchmark texts
have no windows, a null item id is the item ''; items of one id are one item; repeated
rows are judged alike; an empty benchmark hits nothing; very long texts are one shard;
a carried column with the name of a result is replaced by it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm import arrays

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
#: Bytes of benchmark text per broadcast: the bound on what each worker holds of it.
BLOCK_BYTES = 32 << 20
#: Bytes of documents per suffix array.
SHARD_BYTES = 2 << 20

_ARROW = {
    "_spans": pa.list_(pa.int64()), "_items": pa.list_(pa.string()),
    "n_words": pa.int64(), "longest_match": pa.int64(),
}
_SPARK = {
    "_spans": T.ArrayType(T.LongType()), "_items": T.ArrayType(T.StringType()),
    "n_words": T.LongType(), "longest_match": T.LongType(),
}
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "longest_match", "contaminated")


def _padded(ids: np.ndarray, starts: np.ndarray, length: int, depth: int, fill: int) -> np.ndarray:
    """Sortable keys of the ``length`` ids from each start, filled up to ``depth``."""
    grid = np.full((len(starts), depth), fill, dtype=">u4")
    for k in range(length):
        grid[:, k] = ids[starts + k]
    return np.frombuffer(grid.tobytes(), dtype=f"S{4 * depth}")


def prepared(ids: Sequence[str], texts: Sequence[str | None], window: int = WINDOW) -> dict:
    """A block of the benchmark: its vocabulary, its distinct windows, their items."""
    hashes, first = arrays.words(*arrays.buffers(pa.array(texts, pa.string())), arrays.ALPHANUMERIC)
    vocabulary, coded = np.unique(hashes, return_inverse=True)
    coded = np.append(coded + 1, np.zeros(window, dtype=np.int64)).astype(np.uint32)
    count = first[1:] - first[:-1]
    item = np.repeat(np.arange(len(count)), np.where(count >= window, count - window + 1, np.minimum(count, 1)))
    starts = np.concatenate([
        np.arange(a, a + (n - window + 1 if n >= window else min(n, 1))) for a, n in zip(first, count)
    ] or [np.zeros(0, dtype=np.int64)]).astype(np.int64)
    length = np.minimum(count, window)[item] if len(item) else np.zeros(0, dtype=np.int64)
    groups, follows = [], set()
    for n in np.unique(length).tolist():
        own = length == n
        keys = _padded(coded, starts[own], n, window, 0)
        distinct, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        ends = np.searchsorted(inverse[order], np.arange(len(distinct) + 1))
        if n == window:
            both = np.stack([inverse[:-1], inverse[1:]], 1)[(starts[own][1:] - starts[own][:-1] == 1) & (item[own][1:] == item[own][:-1])]
            follows = np.unique(both[:, 0].astype(np.int64) << 32 | both[:, 1])
        groups.append({
            "n": n, "low": distinct, "high": _padded(coded, starts[own][at], n, window, 0xFFFFFFFF),
            "first": coded[starts[own][at]], "items": item[own][order], "ends": ends,
        })
    return {"vocabulary": vocabulary, "groups": groups, "ids": list(ids), "window": window,
            "follows": follows if len(follows) else np.zeros(0, dtype=np.int64)}


class _Shard:
    """Documents of one shard: the suffix array of their stretches of benchmark words."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, block: dict):
        hashes, self.first = arrays.words(offsets, data, arrays.ALPHANUMERIC)
        vocabulary, depth = block["vocabulary"], block["window"]
        self.n = len(hashes)
        if not len(vocabulary) or not self.n:
            self.places = self.suffixes = np.zeros(0, dtype=np.int64)
            return
        at = np.searchsorted(vocabulary, hashes)
        at[at == len(vocabulary)] = 0
        ids = np.where(vocabulary[at] == hashes, at + 1, 0).astype(np.uint32)
        # Stretches: runs of benchmark words within a document.
        breaks = np.zeros(self.n + 1, dtype=bool)
        breaks[self.first] = True
        known = ids > 0
        begins = np.flatnonzero(known & (~np.append(False, known[:-1]) | breaks[:-1]))
        ends = np.flatnonzero(known & (~np.append(known[1:], False) | breaks[1:])) + 1
        shortest = block["groups"][0]["n"]
        long = ends - begins >= shortest
        begins, ends = begins[long], ends[long]
        size = ends - begins
        inside = np.repeat(begins - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        # The same stretches behind one another, a 0 after each.
        moved = np.arange(len(inside)) + np.repeat(np.arange(len(size)), size)
        line = np.zeros(len(inside) + len(size) + depth, dtype=np.uint32)
        line[moved] = ids[inside]
        keys = _padded(line, moved, depth, depth, 0)
        # Behind the end of a stretch all is 0: what follows there is another stretch.
        left = np.repeat(ends, size) - inside
        if len(keys) and int(left.min()) < depth:
            grid = np.frombuffer(keys.tobytes(), dtype=">u4").reshape(-1, depth).copy()
            grid[np.arange(depth)[None, :] >= left[:, None]] = 0
            keys = np.frombuffer(grid.tobytes(), dtype=keys.dtype)
        order = np.argsort(keys, kind="stable")
        self.places, self.suffixes = inside[order], keys[order]

    def search(self, block: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray, dict]]:
        """Per window length: places in the shard and the window found at each."""
        if not len(self.places):
            return
        for group in block["groups"]:
            lo = np.searchsorted(self.suffixes, group["low"], side="left")
            hi = np.searchsorted(self.suffixes, group["high"], side="right")
            found = np.flatnonzero(hi > lo)
            size = (hi - lo)[found]
            rows = np.repeat(lo[found] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            yield group["n"], self.places[rows], np.repeat(found, size), group


def _hits(offsets: np.ndarray, data: np.ndarray, block: dict):
    """Per document of a shard: words, hit spans, items, longest chained match."""
    shard = _Shard(offsets, data, block)
    n_docs = len(offsets) - 1
    delta = np.zeros(shard.n + 1, dtype=np.int64)
    owner = arrays.owners(shard.first)
    pairs, longest = [], np.zeros(n_docs, dtype=np.int64)
    for n, places, window, group in shard.search(block):
        np.add.at(delta, places, 1)
        np.add.at(delta, places + n, -1)
        docs = owner[places]
        both = np.unique(docs.astype(np.int64) << 32 | window)
        d, w = both >> 32, both & 0xFFFFFFFF
        size = group["ends"][w + 1] - group["ends"][w]
        at = np.repeat(group["ends"][w] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        pairs.append(np.unique(np.repeat(d, size) << 32 | group["items"][at]))
        order = np.argsort(places, kind="stable")
        places, window, docs = places[order], window[order], docs[order]
        chained = np.zeros(len(places), dtype=bool)
        if n == block["window"] and len(places) > 1:
            step = window[:-1].astype(np.int64) << 32 | window[1:]
            chained[1:] = (places[1:] - places[:-1] == 1) & (docs[1:] == docs[:-1]) & np.isin(step, block["follows"])
        index = np.arange(len(places))
        since = index - np.maximum.accumulate(np.where(chained, 0, index))
        np.maximum.at(longest, docs, n + since)
    covered = np.cumsum(delta[:-1]) > 0
    items = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, dtype=np.int64)
    return shard.first, covered, items, longest


def _spans(covered: np.ndarray) -> list[int]:
    """Begins and ends, alternating, of the covered stretches."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return edges.tolist()


def _joined(a: list[int], b: list[int]) -> list[int]:
    """Two lists of stretches as one."""
    out: list[int] = []
    for begin, end in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def _task(block, carried: Sequence[str], text: str) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        for batch in batches:
            offsets, data = arrays.buffers(batch.column(text))
            spans, items, n_words, longest = [], [], [], []
            for lo, hi in arrays.blocks(offsets, SHARD_BYTES):
                part = offsets[lo : hi + 1]
                first, covered, pairs, most = _hits(part - part[0], data[part[0] : part[-1]], own)
                ends = np.searchsorted(pairs, np.arange(hi - lo + 1) << 32)
                for d in range(hi - lo):
                    a, b = first[d], first[d + 1]
                    spans.append(_spans(covered[a:b]) if ends[d + 1] > ends[d] else [])
                    items.append([own["ids"][i] for i in (pairs[ends[d] : ends[d + 1]] & 0xFFFFFFFF).tolist()])
                n_words.append(first[1:] - first[:-1])
                longest.append(most)
            columns = {c: batch.column(c) for c in carried}
            if "_spans" in batch.schema.names:  # what earlier blocks of the benchmark found
                before = batch.column("_spans").to_pylist(), batch.column("_items").to_pylist()
                spans = [_joined(a, b) for a, b in zip(before[0], spans)]
                items = [a + b for a, b in zip(before[1], items)]
                longest.append(np.zeros(0, dtype=np.int64))
            most = np.concatenate(longest) if longest else np.zeros(0, dtype=np.int64)
            if "_spans" in batch.schema.names:
                most = np.maximum(most, batch.column("longest_match").to_numpy())
            counted = np.concatenate(n_words) if n_words else np.zeros(0, dtype=np.int64)
            found = {"_spans": spans, "_items": items, "n_words": counted, "longest_match": most}
            columns |= {name: pa.array(value, _ARROW[name]) for name, value in found.items()}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return search


def benchmark_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES):
    """The benchmark in prepared blocks of bounded size, streamed through the driver."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")), F.col(text)).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len((row[1] or "").encode())
        if size >= block_bytes:
            yield prepared(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield prepared(ids, texts)


def matched(df: DataFrame, benchmark: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``df``: the columns of ``carry`` and what of the benchmark stands in it."""
    spark = df.sparkSession
    carry = [c for c in carry if c not in RESULTS and c not in _ARROW]
    own = list(dict.fromkeys([*carry, text]))
    blocks = list(map(spark.sparkContext.broadcast, benchmark_blocks(benchmark, block_bytes=block_bytes)))
    blocks = blocks or [spark.sparkContext.broadcast(prepared([], []))]
    df = df.select(*own)
    for i, block in enumerate(blocks):
        passed = carry if i == len(blocks) - 1 else own
        fields = [df.schema[c] for c in passed] + [T.StructField(n, t) for n, t in _SPARK.items()]
        df = df.mapInArrow(_task(block, passed, text), T.StructType(fields))
    n_hit = F.expr("aggregate(sequence(1, greatest(size(_spans), 1), 2), 0L, (n, i) -> n + "
                   "if(size(_spans) = 0, 0L, get(_spans, i) - get(_spans, i - 1)))")
    df = df.withColumn("n_hit", n_hit).withColumn("_ids", F.sort_array(F.array_distinct("_items")))
    df = df.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    return df.select(
        *carry, "n_words", "n_hit", F.size("_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("_ids", ","), 256).alias("items_sha256"), "longest_match", "contaminated",
        F.col("_spans").alias("hit_spans"),
    )


def decontaminated(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the rule does not call contaminated."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    found = matched(plain, benchmark, plain.columns[df.columns.index(text)], plain.columns)
    return found.where(~F.col("contaminated")).select(*plain.columns).toDF(*df.columns)
