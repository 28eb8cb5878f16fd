"""Repeated byte strings of documents, by suffix order over the text that can repeat.

A string of ``LENGTH`` bytes that stands at two places has, at both, the same smallest
hash among its ``GRAM``-byte pieces. So every window of that length belongs to the run of
windows with its smallest piece, and equal windows lie in runs of the same piece
(``runs``; about one run in 120 bytes of text, each with the hash of its whole stretch).
Pieces that occur once in the corpus end there. Where all stretches of a piece are equal,
or a stretch occurs twice, it repeats as a whole. What is left, stretches that share a
piece but differ somewhere, meets at the piece, where their suffixes are sorted to the
depth of ``LENGTH`` by prefix doubling; the neighbours of a suffix of the same class are
its previous and next smaller positions: an earlier match, which makes it a later copy,
and a later one. A window with either repeats. A piece with more stretches than a task should
sort (a passage in many surroundings) has the hashes of their windows counted instead, which
is spread over all tasks however common the piece is.

``spans`` keeps both kinds, ``removed`` cuts them all. Repeats are judged on the input.

Defined results: null and empty texts have no bytes; texts shorter than ``LENGTH`` repeat
nothing; very long texts are handled whole (memory in proportion to the text); repeated
rows repeat each other; rows are told apart by id and text, so that equal rows have equal
results; an empty table has no rows; further columns play no part.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm import arrays
from maskwright.llm.common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 400
GRAM = 160
#: Bytes of stretches sorted together; a piece with more has its windows counted instead.
SORT_BYTES = 2 << 20
#: Bytes of stretches that one task sorts, one part after the other.
TASK_BYTES = 4 * SORT_BYTES
#: Bytes of text searched for runs at a time.
RUN_BYTES = 1 << 20
#: Stretches or spans that may be broadcast to the documents; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
_BASE = 0xA24BAED4963EE407
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours (van Herk's two running minima)."""
    n = len(a)
    if n < width:
        return a[:0]
    blocks = -(-n // width)
    grid = np.full(blocks * width, _TOP, dtype=np.uint64)
    grid[:n] = a
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def runs(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """The runs of windows of a block of texts: text, smallest piece, stretch and its hash,
    and whether the piece recurs so near that windows of one run may be equal."""
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < LENGTH:
        return {"text": none, "piece": none, "stretch": none, "lo": none, "hi": none, "near": none.astype(bool)}
    up, down = arrays.powers(_BASE, n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    piece = arrays.mix((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1])
    width = LENGTH - GRAM + 1
    least = sliding_min(piece, width)
    text = np.repeat(np.arange(len(offsets) - 1), offsets[1:] - offsets[:-1])
    inside = text[: n - LENGTH + 1] == text[LENGTH - 1 :]
    least = np.where(inside, least, np.uint64(0))
    changes = np.flatnonzero(least[1:] != least[:-1]) + 1
    parts = text[: len(least)]
    changes = np.union1d(changes, np.flatnonzero(parts[1:] != parts[:-1]) + 1)
    begins = np.concatenate([[0], changes]).astype(np.int64)
    ends = np.append(begins[1:], len(least))
    real = least[begins] > 0
    begins, ends = begins[real], ends[real]
    value = least[begins]
    # Places of chosen pieces: those that are the minimum of some window around them.
    around = np.full(n - GRAM + 1 + width - 1, np.uint64(0))
    around[width - 1 : width - 1 + len(least)] = least
    chosen = np.flatnonzero(~sliding_min(~around, width) == piece)
    order = np.argsort(piece[chosen], kind="stable")
    place = chosen[order]
    close = (piece[place[1:]] == piece[place[:-1]]) & (place[1:] - place[:-1] < LENGTH)
    near = np.isin(value, piece[place[1:]][close])
    hi = ends - 1 + LENGTH
    stretch = arrays.mix(((total[hi] - total[begins]) * down[begins]) ^ (hi - begins).astype(np.uint64))
    start = offsets[text[begins]]
    return {"text": text[begins], "piece": value.view(np.int64), "stretch": stretch.view(np.int64),
            "lo": begins - start, "hi": hi - start, "near": near}


_RUN_TYPES = {"piece": pa.int64(), "stretch": pa.int64(), "lo": pa.int64(), "hi": pa.int64(), "near": pa.bool_()}


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = arrays.buffers(batch.column("text"))
        for lo, hi in arrays.blocks(offsets, RUN_BYTES):
            part = offsets[lo : hi + 1]
            found = runs(part - part[0], data[part[0] : part[-1]])
            rows = pa.array(found["text"] + lo, pa.int64())
            columns = {c: batch.column(c).take(rows) for c in ("doc_id", "version")}
            columns |= {c: pa.array(found[c], kind) for c, kind in _RUN_TYPES.items()}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def suffix_classes(data: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes in the order of their first ``depth`` bytes; ``left`` is the
    number of bytes from each place to the end of its text, behind which all is 0."""
    n = len(data)
    index = np.arange(n)
    have, byte = 7, data.astype(np.uint64) + np.uint64(1)
    rank = np.zeros(n, dtype=np.uint64)
    for k in range(have):  # the first bytes as one number, nine bits each
        rank = (rank << np.uint64(9)) | np.where(left > k, byte[np.minimum(index + k, n - 1)], np.uint64(0))
    _, rank = np.unique(rank, return_inverse=True)
    rank = rank.astype(np.uint64) + np.uint64(1)
    while have < depth:
        step = min(have, depth - have)
        follow = np.where(left > step, rank[np.minimum(index + step, n - 1)], np.uint64(0))
        _, rank = np.unique((rank << np.uint64(32)) | follow, return_inverse=True)
        rank = rank.astype(np.uint64) + np.uint64(1)
        have += step
    return rank


def matches(rank: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the places whether an earlier and whether a later one has the same rank:
    in suffix order, its previous and its next smaller position of full depth."""
    order = np.argsort(rank[places], kind="stable")  # equal ranks stay in order of position
    same = rank[places][order][1:] == rank[places][order][:-1]
    earlier, later = np.zeros(len(places), dtype=bool), np.zeros(len(places), dtype=bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, version, text, wanted) -> the bytes of each wanted stretch."""
    for batch in batches:
        offsets, data = arrays.buffers(batch.column("text"))
        rows, out = [], [[], [], [], []]
        for i, wanted in enumerate(batch.column("wanted").to_pylist()):
            for w in wanted:
                rows.append(i)
                for column, value in zip(out, (w["piece"], w["lo"], w["single"], data[offsets[i] + w["lo"] : offsets[i] + w["hi"]].tobytes())):
                    column.append(value)
        rows = pa.array(rows, pa.int64())
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(rows), batch.column("version").take(rows), *map(pa.array, out, kinds)],
            names=["doc_id", "version", "piece", "lo", "single", "bytes"],
        )


def _sorted_matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by piece -> spans of repeated windows of those not yet known."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        pieces = batch.column("piece").to_numpy()
        if held and sum(b.column("bytes").nbytes for b in held) >= SORT_BYTES:
            # Go on to the next piece, then sort what is held.
            last = held[-1].column("piece")[-1].as_py()
            cut = int(np.argmax(pieces != last)) if (pieces != last).any() else len(pieces)
            held.append(batch.slice(0, cut))
            if cut < len(pieces):
                yield from _repeats(held)
                held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield from _repeats(held)


def _repeats(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts stretches in parts of about ``SORT_BYTES``; a piece, which has no more, is never divided."""
    whole = pa.Table.from_batches(batches).combine_chunks()
    piece = whole.column("piece").to_numpy()
    size = pa.compute.binary_length(whole.column("bytes")).to_numpy().astype(np.int64)
    firsts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
    before = (np.cumsum(size) - size)[firsts]
    cuts = firsts[np.flatnonzero(np.append(True, before[1:] // SORT_BYTES != before[:-1] // SORT_BYTES))]
    for lo, hi in zip(cuts, np.append(cuts[1:], len(piece))):
        part = whole.slice(lo, hi - lo)
        raw = np.frombuffer(b"".join(part.column("bytes").to_pylist()), dtype=np.uint8)
        length = size[lo:hi]
        ends = np.cumsum(length)
        owner = np.repeat(np.arange(hi - lo), length)
        left = ends[owner] - np.arange(len(raw))
        rank = suffix_classes(raw, left, LENGTH)
        places = np.flatnonzero(left >= LENGTH)
        earlier, later = matches(rank, places)
        known = ~part.column("single").to_numpy(zero_copy_only=False)
        hit = (earlier | later) & ~known[owner[places]]
        places = places[hit]
        if not len(places):
            continue
        fresh = np.append(True, (places[1:] - places[:-1] > 1) | (owner[places[1:]] != owner[places[:-1]]))
        begin = places[fresh]
        end = np.append(places[np.flatnonzero(fresh)[1:] - 1], places[-1]) + LENGTH
        rows = owner[begin]
        base = part.column("lo").to_numpy()[rows] - (ends - length)[rows]
        taken = part.select(["doc_id", "version"]).combine_chunks().take(pa.array(rows))
        yield from (
            taken.append_column("lo", pa.array(begin + base, pa.int64()))
            .append_column("hi", pa.array(end + base, pa.int64())).combine_chunks().to_batches()
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches -> the hash of each of their windows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("bytes").cast(pa.large_binary())  # a stretch can begin or end within a character
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
        for lo, hi in arrays.blocks(offsets, RUN_BYTES):
            part = offsets[lo : hi + 1] - offsets[lo]
            raw = data[offsets[lo] : offsets[hi]]
            up, down = arrays.powers(_BASE, len(raw))
            total = np.zeros(len(raw) + 1, dtype=np.uint64)
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
            value = arrays.mix((total[LENGTH:] - total[:-LENGTH]) * down[: len(raw) - LENGTH + 1])
            number = part[1:] - part[:-1] - LENGTH + 1
            first = np.append(0, np.cumsum(number))
            place = np.arange(first[-1]) - np.repeat(first[:-1] - part[:-1], number)
            hashes = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(value[place].view(np.int64)))
            own = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([own.column(c) for c in _KEPT] + [hashes], names=[*_KEPT, "hashes"])


_KEPT = ["doc_id", "version", "lo", "single"]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, version, lo) of repeated windows -> their spans, rows in sequence as one."""
    for batch in batches:
        lo, version = batch.column("lo").to_numpy(), batch.column("version").to_numpy()
        ids = batch.column("doc_id")
        same = pa.compute.equal(ids[1:], ids[:-1]).fill_null(False).to_numpy(zero_copy_only=False)
        follows = same & (version[1:] == version[:-1]) & (lo[1:] == lo[:-1] + 1)
        begin = np.flatnonzero(np.append(True, ~follows)[: len(lo)])
        end = np.append(begin[1:], len(lo))[: len(begin)] - 1
        taken = [batch.column(c).take(pa.array(begin)) for c in ("doc_id", "version")]
        yield pa.RecordBatch.from_arrays([*taken, pa.array(lo[begin]), pa.array(lo[end] + LENGTH)], names=["doc_id", "version", "lo", "hi"])


def _counted_matches(cut: DataFrame, span: T.StructType) -> DataFrame:
    """Stretches of pieces too common to be sorted -> spans of repeated windows of those not
    yet known. Windows are counted by hash, first within tasks, so none of them is hot."""
    hashes = T.StructField("hashes", T.ArrayType(T.LongType()))
    windows = cut.mapInArrow(_windows, T.StructType([*[cut.schema[c] for c in _KEPT], hashes]))
    counts = windows.select(F.explode("hashes").alias("hash")).groupBy("hash").count()
    repeated = written(counts.where("count > 1").select("hash"), "repeated-windows")
    repeated = F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated
    each = windows.where("single").select("doc_id", "version", "lo", F.posexplode("hashes").alias("at", "hash"))
    each = each.join(repeated, "hash", "left_semi").select("doc_id", "version", (F.col("lo") + F.col("at")).alias("lo"))
    return each.mapInArrow(_joined, span)


def _versioned(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text"))


def _onto(docs: DataFrame, lists: DataFrame, rows: int, how: str) -> DataFrame:
    """Documents with what ``lists`` has for them; the documents move only if that is large."""
    right = lists.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), lists.columns[-1])
    right = F.broadcast(right) if rows <= BROADCAST_ROWS else right.hint("shuffle_hash")
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
    return docs.join(right, on, how).drop("_id", "_version")


def spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Written rows (doc_id, version, lo, hi): the maximal byte ranges covered by repeated
    strings; ``version`` is Spark's xxhash64 of the text."""
    docs = _versioned(df, key, text)
    schema = T.StructType([*docs.schema.fields[:2], *[T.StructField(c, T.BooleanType() if c == "near" else T.LongType()) for c in _RUN_TYPES]])
    every = written(docs.mapInArrow(_run_rows, schema), "runs")
    pieces = every.groupBy("piece").agg(
        F.count("*").alias("n"), F.min("stretch").alias("a"), F.max("stretch").alias("b"), F.max("near").alias("any_near")
    ).where("n > 1 or any_near")
    again = written(
        every.join(pieces.select("piece", "n", (F.col("a") == F.col("b")).alias("alike"), "any_near"), "piece"), "repeated-pieces"
    )
    whole = again.where("n > 1 and alike").select("doc_id", "version", "lo", "hi")
    # A recurring piece within one stretch needs the sort even if its stretches are alike once.
    rest = again.where("not alike or n = 1")
    kinds = rest.groupBy("piece", "stretch").agg(
        F.count("*").alias("m"), *[F.first(c).alias(c) for c in ("doc_id", "version", "lo", "hi")]
    )
    kinds = written(kinds, "stretches")
    twice = kinds.where("m > 1").select("piece", "stretch")
    twins = rest.join(twice, ["piece", "stretch"], "left_semi").select("doc_id", "version", "lo", "hi")
    size = kinds.agg(F.count("*").alias("rows"), F.sum(F.col("hi") - F.col("lo")).alias("bytes")).first()
    rows = size["rows"]
    fields = [*docs.schema.fields[:2], T.StructField("piece", T.LongType()), T.StructField("lo", T.LongType()),
              T.StructField("single", T.BooleanType()), T.StructField("bytes", T.BinaryType())]
    span = T.StructType([*docs.schema.fields[:2], T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])

    def cut(kinds: DataFrame) -> DataFrame:
        wanted = kinds.groupBy("doc_id", "version").agg(
            F.collect_list(F.struct("piece", "lo", "hi", (F.col("m") == 1).alias("single"))).alias("wanted")
        )
        return _onto(docs, wanted, rows, "inner").mapInArrow(_stretches, T.StructType(fields))

    hot = written(kinds.groupBy("piece").agg(F.sum(F.col("hi") - F.col("lo")).alias("n")).where(F.col("n") > SORT_BYTES).select("piece"), "hot-pieces")
    n = hot.count()
    hot = F.broadcast(hot) if n <= BROADCAST_ROWS else hot
    # Numbered by bytes, as parts that are small to move are long to sort.
    parts = -(-(size["bytes"] or 1) // TASK_BYTES)
    met = cut(kinds.join(hot, "piece", "left_anti") if n else kinds).repartition(parts, "piece").sortWithinPartitions("piece")
    found = met.mapInArrow(_sorted_matches, span)
    if n:
        found = found.unionByName(_counted_matches(cut(kinds.join(hot, "piece", "left_semi")), span))
    return written(_merged(whole.unionByName(twins).unionByName(found)), "spans")


def _merged(found: DataFrame) -> DataFrame:
    """Ranges of a document that overlap or touch, as one."""
    rows = Window.partitionBy("doc_id", "version").orderBy("lo", "hi")
    reach = F.max("hi").over(rows.rowsBetween(Window.unboundedPreceding, -1))
    fresh = found.withColumn("_new", F.when(F.col("lo") <= reach, 0).otherwise(1))
    part = fresh.withColumn("_part", F.sum("_new").over(rows.rowsBetween(Window.unboundedPreceding, 0)))
    return part.groupBy("doc_id", "version", "_part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_part")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = arrays.buffers(batch.column("text"))
        out: list[list] = [[], [], [], [], [], []]
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            raw = data[offsets[i] : offsets[i + 1]].tobytes()
            kept, at, removed, n = [], 0, 0, 0
            for span in sorted(spans or (), key=lambda span: span["lo"]):
                kept.append(raw[at : span["lo"]])
                removed += span["hi"] - span["lo"]
                at = span["hi"]
                n += 1
            kept.append(raw[at:])
            rest = b"".join(kept)
            shown = rest.decode("utf-8", "ignore")
            for column, value in zip(out, (len(raw), removed, n, hashlib.sha256(rest).hexdigest(), rest, shown)):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string())
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "text"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out, kinds)], names=names)


def removed(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: ``doc_id``, bytes, bytes and spans removed, the digest of what is kept,
    the kept bytes, and as ``text`` all of its characters that no cut falls into."""
    found = spans(df, key, text)
    rows = found.count()
    lists = found.groupBy("doc_id", "version").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    docs = _onto(_versioned(df, key, text), lists, rows, "left")
    fields = [docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]]
    fields += [T.StructField(c, k) for c, k in (("kept_sha256", T.StringType()), ("kept", T.BinaryType()), ("text", T.StringType()))]
    return docs.select("doc_id", "text", "spans").mapInArrow(_cut, T.StructType(fields))
