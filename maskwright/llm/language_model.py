"""Scoring texts with an interpolated modified Kneser-Ney bigram model.

Counting is Spark's: words and word pairs are counted per task, shuffled and summed. The
result is stored in the shared folder as sorted arrays: the words' hashes in shards by
their leading bits, a word's number being its place; the pairs as number << 32 | number
in parts, a frequent first word's pairs spread over several. Workers map these files into
memory and look words and pairs up by bisection, so a model larger than memory works, and
nothing of it passes through the driver, which sees one row per shard.

Defined results: null and empty texts are the end token alone; a word unknown to training
gets the uniform share only; a first word unknown as a context leaves the second to the
unigrams; a null id is the text ''; repeated rows count and score as often as they occur;
without training texts every token is unknown; very long texts are scored whole; further
columns play no part. More than 2^32 distinct words are an error.
"""

from __future__ import annotations

import os
import shutil
import sys
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm import arrays
from maskwright.llm.common import shared_path, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS, HELD_OUT = 7, 2
#: Entries a task holds before it counts them and hands them on: some eight arrays of as
#: many numbers, beside a JVM and as many other workers as an executor has cores.
COUNTED = 1 << 20
#: Entries whose parts are looked up at a time.
LOOKED_UP = 1 << 17
#: Tokens for each part of the pairs, and words for each shard, at most about: one task holds one.
PART_TOKENS = 1 << 21
SHARD_WORDS = 1 << 20
#: A first word is spread over so many parts per part's fair share of all pairs.
SPREAD = 4
_START, _END = np.uint64(0x6A09E667F3BCC909), np.uint64(0xBB67AE8584CAA73B)
_open: dict[str, np.ndarray] = {}


def is_held_out(key: str) -> Column:
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return crc % FOLDS == HELD_OUT


def tokens(column) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of texts: tokens with an end after each text, their predecessors (a start
    before each text), and each text's first token."""
    offsets, data = arrays.buffers(column)
    for lo, hi in arrays.blocks(offsets):
        part = offsets[lo : hi + 1]
        hashes, first = arrays.words(part - part[0], data[part[0] : part[-1]], arrays.BETWEEN_SPACES)
        n = hi - lo
        ends = first[1:] + np.arange(n)
        out = np.full(len(hashes) + n, _END, dtype=np.uint64)
        out[np.arange(len(hashes)) + arrays.owners(first)] = hashes
        begins = first[:-1] + np.arange(n)
        before = np.empty_like(out)
        before[1:] = out[:-1]
        before[begins] = _START
        assert len(ends) == n
        yield out, before, begins


def _firsts(value: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, dtype=np.int64)


def _summed(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and their counts; empties the lists, whose arrays may be large."""
    value, count = np.concatenate(values), np.concatenate(counts)
    values.clear()
    counts.clear()
    order = np.argsort(value, kind="stable")
    value, count = value[order], count[order]
    firsts = _firsts(value)
    return value[firsts], np.add.reduceat(count, firsts) if len(firsts) else count


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    values: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    held = 0

    def rows(value, count):
        return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count.astype(np.int64))], names=["word", "n"])

    for batch in batches:
        for token, _, _ in tokens(batch.column(0)):
            value, count = np.unique(token, return_counts=True)
            values.append(value)
            counts.append(count)
            held += len(value)
            if held >= COUNTED:
                value, count = _summed(values, counts)
                held = len(value)
                if held > COUNTED // 2:
                    yield rows(value, count)
                    held = 0
                else:  # the same words again and again
                    values.append(value)
                    counts.append(count)
    if values:
        yield rows(*_summed(values, counts))


# Files of the shared folder.


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def store(uri: str, values: np.ndarray) -> None:
    """Writes an array; a task that runs again writes the same, and nobody sees half of it."""
    system, path = _filesystem(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"  # of no other host or attempt
    with system.open_output_stream(part) as out:
        out.write(np.ascontiguousarray(values).data if len(values) else b"")
    system.move(part, path)


def mapped(uri: str, kind: str) -> np.ndarray:
    """A stored array, mapped into memory; from a remote store a worker fetches it once."""
    if uri not in _open:
        system, path = _filesystem(uri)
        if not isinstance(system, fs.LocalFileSystem):
            local = os.path.join(tempfile.gettempdir(), f"model-{uuid.uuid4().hex}")
            with system.open_input_stream(path) as source, open(local, "wb") as target:
                shutil.copyfileobj(source, target)
            path = local
        _open[uri] = np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, dtype=kind)
    return _open[uri]


@dataclass
class Model:
    """Where the arrays are, and the few numbers that all of them share."""

    path: str
    bits: int
    parts: int
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))  # number of each shard's first word
    n: int = 0
    v: int = 0
    pairs: int = 0
    pair_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_kinds: tuple[int, int, int] = (0, 0, 0)

    def shard(self, s: int, what: str, kind: str) -> np.ndarray:
        return mapped(f"{self.path}/{what}-{s}", kind)

    def numbers(self, distinct: np.ndarray) -> np.ndarray:
        """The numbers of sorted distinct words; -1 for a word that training lacks."""
        out = np.full(len(distinct), -1, dtype=np.int64)
        bounds = (np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)) if self.bits else np.zeros(1, dtype=np.uint64)
        cuts = np.append(np.searchsorted(distinct, bounds), len(distinct))
        for s in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            own = distinct[cuts[s] : cuts[s + 1]]
            known = self.shard(s, "words", "<u8")
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            out[cuts[s] : cuts[s + 1]] = np.where(known[at] == own, at + self.first[s], -1)
        return out

    def looked_up(self, numbers: np.ndarray, what: str, kind: str, width: int = 1) -> np.ndarray:
        """The stored values of sorted numbers; 0 for -1."""
        out = np.zeros((len(numbers), width), dtype=np.dtype(kind))
        cuts = np.searchsorted(numbers, self.first)
        for s in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            own = numbers[cuts[s] : cuts[s + 1]] - self.first[s]
            out[cuts[s] : cuts[s + 1]] = self.shard(s, what, kind).reshape(-1, width)[own]
        return out[:, 0] if width == 1 else out

    def part_of(self, left: np.ndarray, right: np.ndarray, left_count: np.ndarray) -> np.ndarray:
        """The part that holds each pair; pairs of a frequent first word are spread."""
        fair = max(1, self.n // (SPREAD * self.parts))
        ways = np.minimum(1 + left_count // fair, self.parts).astype(np.uint64)
        base = arrays.mix(left.astype(np.uint64)) % np.uint64(self.parts)
        other = arrays.mix(right.astype(np.uint64) + np.uint64(1)) % ways
        return ((base + other) % np.uint64(self.parts)).astype(np.int64)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each key, of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and held[-1].column(key)[-1].as_py() != keys[lo]:
                yield held[-1].column(key)[-1].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield held[-1].column(key)[-1].as_py(), pa.Table.from_batches(held)


def _store_words(path: str):
    def run(batches):
        for s, rows in _runs(batches, "shard"):
            word = rows.column("word").to_numpy().view(np.uint64)
            order = np.argsort(word)
            store(f"{path}/words-{s}", word[order].astype("<u8"))
            store(f"{path}/counts-{s}", rows.column("n").to_numpy()[order].astype("<i8"))
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([len(word)], pa.int64())], names=["shard", "n"])

    return run


def _coded(token: np.ndarray, before: np.ndarray, model: Model):
    """Distinct words of a block, their numbers, and each token's place among them."""
    distinct, at = np.unique(np.append(token, _START), return_inverse=True)
    numbers = model.numbers(distinct)
    place = at[:-1]
    previous = np.searchsorted(distinct, before)
    return distinct, numbers, place, previous


def _parts(value: np.ndarray, model: Model) -> np.ndarray:
    """The part of each pair, of pairs in order."""
    out = np.empty(len(value), dtype=np.int32)
    for lo in range(0, len(value), LOOKED_UP):
        left, right = value[lo : lo + LOOKED_UP] >> 32, value[lo : lo + LOOKED_UP] & 0xFFFFFFFF
        heads, at = np.unique(left, return_inverse=True)
        out[lo : lo + LOOKED_UP] = model.part_of(left, right, model.looked_up(heads, "counts", "<i8")[at])
    return out


def _blobs(codes: np.ndarray, model: Model) -> pa.RecordBatch:
    """Counts pairs, which it sorts in place -> a row per part."""
    codes.sort()
    firsts = _firsts(codes)
    value, count = codes[firsts], np.diff(firsts, append=len(codes)).astype("<u4")
    del firsts
    part = _parts(value, model)
    order = np.argsort(part, kind="stable")  # values stay sorted within a part
    sizes = np.bincount(part, minlength=model.parts)
    cuts = np.append(0, np.cumsum(sizes))
    rows, blobs = np.flatnonzero(sizes), [[], [], []]
    for p in rows.tolist():
        own = order[cuts[p] : cuts[p + 1]]
        left, right = value[own] >> 32, value[own] & 0xFFFFFFFF
        step = np.append(left[:1], left[1:] - left[:-1])
        for column, numbers in zip(blobs, (step.astype("<u4"), right.astype("<u4"), count[own].astype("<u8"))):
            column.append(pa.compress(numbers.tobytes(), codec="zstd", asbytes=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int64()), pa.array(sizes[rows], pa.int64()), *[pa.array(b, pa.binary()) for b in blobs]],
        names=["part", "size", "step", "right", "n"],
    )


def _pair_counts(model: Model):
    def run(batches):
        held, n = np.empty(COUNTED, dtype=np.int64), 0
        for batch in batches:
            for token, before, _ in tokens(batch.column(0)):
                _, numbers, place, previous = _coded(token, before, model)
                codes = numbers[previous] << 32 | numbers[place]
                while len(codes):
                    taken, codes = codes[: COUNTED - n], codes[COUNTED - n :]
                    held[n : n + len(taken)] = taken
                    n += len(taken)
                    if n == COUNTED:
                        yield _blobs(held, model)
                        n = 0
        if n:
            yield _blobs(held[:n], model)

    return run


def _store_pairs(model: Model):
    def run(batches):
        for p, rows in _runs(batches, "part"):
            values, counts = [], []
            for row in rows.to_pylist():
                step, right, n = (
                    np.frombuffer(pa.decompress(row[c], width * row["size"], codec="zstd"), dtype=f"<u{width}").astype(np.int64)
                    for c, width in (("step", 4), ("right", 4), ("n", 8))
                )
                values.append(np.cumsum(step) << 32 | right)
                counts.append(n)
            value, count = _summed(values, counts)
            store(f"{model.path}/pairs-{p}", value.astype("<i8", copy=False))
            store(f"{model.path}/pair-counts-{p}", count.astype("<i8", copy=False))
            left = value >> 32
            firsts = _firsts(left)
            heads = left[firsts]
            tails, cont = np.unique(value & 0xFFFFFFFF, return_counts=True)
            four = np.bincount(np.minimum(count, 5), minlength=6)[1:5]
            number = np.concatenate([heads, tails, [-1]])
            table = np.zeros((5, len(number)), dtype=np.int64)
            table[0, : len(heads)] = np.add.reduceat(count, firsts)
            for k in (1, 2, 3):  # how many are 1, 2 and more
                table[k, : len(heads)] = np.add.reduceat(np.minimum(count, 3) == k, firsts, dtype=np.int64)
            table[4, len(heads) : -1] = cont
            table[:4, -1] = four
            shard = np.where(number < 0, -1, np.searchsorted(model.first, np.maximum(number, 0), side="right") - 1)
            columns = [shard, number, *table]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=_STATS)

    return run


_STATS = ["shard", "number", "total", "ones", "twos", "more", "before"]


def _store_stats(model: Model):
    def run(batches):
        for s, rows in _runs(batches, "shard"):
            size = int(model.first[s + 1] - model.first[s])
            table = np.zeros((size, 5), dtype="<i8")
            at = rows.column("number").to_numpy() - model.first[s]
            for k, c in enumerate(_STATS[2:]):
                table[at, k] = rows.column(c).to_numpy()
            store(f"{model.path}/stats-{s}", table.reshape(-1))
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64())], names=["shard"])

    return run


def discounts(one: int, two: int, three: int, four: int) -> tuple[float, float, float]:
    """The three discounts from the numbers of things seen once, twice, ...; where these are
    too few to tell, three quarters."""
    if not (one and two and three and four):
        return 0.75, 0.75, 0.75
    y = one / (one + 2 * two)
    found = 1 - 2 * y * two / one, 2 - 3 * y * three / two, 3 - 4 * y * four / three
    return tuple(d if 0 < d < k else 0.75 for k, d in enumerate(found, 1))  # type: ignore[return-value]


def trained(texts: DataFrame) -> Model:
    """Counts a one-column DataFrame of texts and stores the model in the shared folder."""
    spark = texts.sparkSession
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = texts.mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = written(words, "words")
    row = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    v, n = int(row[0]), int(row[1])
    if v >= 1 << 32:
        raise ValueError("more than 2^32 distinct words")
    bits = max(width - 1, v // SHARD_WORDS).bit_length()
    model = Model(shared_path(spark, "model"), bits, max(2 * width, -(-n // PART_TOKENS)), v=v, n=n)
    start = spark.createDataFrame([(int(_START.view(np.int64)), 0)], words.schema)
    shard = F.shiftrightunsigned("word", 64 - bits) if bits else F.lit(0).cast("long")
    sharded = words.unionByName(start).select(shard.alias("shard"), "word", "n")
    stored = sharded.repartition("shard").sortWithinPartitions("shard").mapInArrow(_store_words(model.path), "shard long, n long")
    sizes = np.zeros(1 << bits, dtype=np.int64)
    for s, n in stored.collect():
        sizes[s] = n
    model.first = np.append(0, np.cumsum(sizes))
    empty = np.zeros(0, dtype=np.int64)
    for s in np.flatnonzero(sizes == 0).tolist():
        store(f"{model.path}/words-{s}", empty)
    blobs = texts.mapInArrow(_pair_counts(model), "part long, size long, step binary, right binary, n binary")
    stats = written(
        blobs.repartition(model.parts, "part").sortWithinPartitions("part").mapInArrow(_store_pairs(model), ", ".join(f"{c} long" for c in _STATS)),
        "pair-stats",
    )
    four = stats.where("number < 0").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in _STATS[2:6]]).first()
    model.pair_discounts = discounts(*map(int, four))
    each = written(stats.where("number >= 0").groupBy("shard", "number").agg(*[F.sum(c).alias(c) for c in _STATS[2:]]), "word-stats")
    each.repartition("shard").sortWithinPartitions("shard").mapInArrow(_store_stats(model), "shard long").collect()
    kinds = each.where("before > 0").agg(
        *[F.coalesce(F.sum((F.col("before") == k).cast("long")), F.lit(0)) for k in (1, 2, 3, 4)],
        F.coalesce(F.sum("before"), F.lit(0)), F.count("*"),
    ).first()
    model.word_discounts = discounts(*map(int, kinds[:4]))
    model.pairs = int(kinds[4])
    model.word_kinds = int(kinds[0]), int(kinds[1]), int(kinds[5] - kinds[0] - kinds[1])
    parts = {r[0] for r in blobs_parts(model, spark)}
    for p in set(range(model.parts)) - parts:
        store(f"{model.path}/pairs-{p}", empty)
        store(f"{model.path}/pair-counts-{p}", empty)
    return model


def blobs_parts(model: Model, spark) -> list[tuple[int]]:
    """The parts that have pairs."""
    system, path = _filesystem(model.path)
    found = system.get_file_info(fs.FileSelector(path))
    return [(int(f.base_name[6:]),) for f in found if f.base_name.startswith("pairs-") and f.base_name[6:].isdigit()]


def _less(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *by])[np.minimum(counts, 3)], 0.0)


def _probabilities(token: np.ndarray, before: np.ndarray, model: Model):
    """Each token's training count, unigram base logarithm and model logarithm."""
    distinct, numbers, place, previous = _coded(token, before, model)
    order = np.argsort(numbers, kind="stable")
    count = np.zeros(len(distinct), dtype=np.int64)
    stats = np.zeros((len(distinct), 5), dtype=np.int64)
    if model.n:
        count[order] = model.looked_up(numbers[order], "counts", "<i8")
        stats[order] = model.looked_up(numbers[order], "stats", "<i8", 5)
    base = np.log10((count + 1) / (model.n + model.v + 1))
    if not model.pairs:
        return count[place], base[place], np.full(len(token), -np.log10(model.v + 1))
    spare = float(np.dot(model.word_kinds, model.word_discounts)) / model.pairs
    unigram = _less(stats[:, 4], model.word_discounts) / model.pairs + spare / (model.v + 1)
    total = np.maximum(stats[:, 0], 1)
    left_over = np.where(stats[:, 0] > 0, stats[:, 1:4] @ np.array(model.pair_discounts) / total, 1.0)
    left, right = numbers[previous], numbers[place]
    both = np.where((left >= 0) & (right >= 0), left << 32 | right, -1)
    codes, at = np.unique(both, return_inverse=True)
    seen = np.zeros(len(codes), dtype=np.int64)
    heads, head_at = np.unique(codes >> 32, return_inverse=True)
    head_counts = model.looked_up(heads, "counts", "<i8")[head_at]
    part = np.where(codes >= 0, model.part_of(codes >> 32, codes & 0xFFFFFFFF, head_counts), -1)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(model.parts + 1))
    for p in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        own = order[cuts[p] : cuts[p + 1]]
        known = mapped(f"{model.path}/pairs-{p}", "<i8")
        if len(known):
            found = np.minimum(np.searchsorted(known, codes[own]), len(known) - 1)
            n = mapped(f"{model.path}/pair-counts-{p}", "<i8")
            seen[own] = np.where(known[found] == codes[own], n[found], 0)
    pair = _less(seen, model.pair_discounts)[at] / total[previous]
    return count[place], base[place], np.log10(pair + left_over[previous] * unigram[place])


_SCORES = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}


def _scored(model: Model):
    def run(batches):
        for batch in batches:
            parts: list[list[np.ndarray]] = [[], [], [], []]
            for token, before, begins in tokens(batch.column("text")):
                count, base, score = _probabilities(token, before, model)
                ends = np.append(begins[1:], len(token))
                for out, value in zip(parts, (ends - begins, *(np.add.reduceat(x, begins) for x in ((count > 0).astype(np.int64), base, score)))):
                    out.append(value)
            columns = [batch.column("doc_id"), batch.column("held_out")]
            columns += [pa.array(np.concatenate(p) if p else [], kind) for p, kind in zip(parts, _SCORES.values())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", *_SCORES])

    return run


def scored(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: scores under a model of the rows that are not held out."""
    rows = df.select(F.col(key).alias("doc_id"), is_held_out(key).alias("held_out"), F.col(text).alias("text"))
    model = trained(rows.where(~F.col("held_out")).select("text"))
    fields = [rows.schema["doc_id"], T.StructField("held_out", T.BooleanType())]
    fields += [T.StructField(c, T.LongType() if k == pa.int64() else T.DoubleType()) for c, k in _SCORES.items()]
    found = rows.mapInArrow(_scored(model), T.StructType(fields))
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return found.withColumn("train_tokens", F.lit(model.n).cast("long")).withColumn("perplexity", perplexity)
