"""Exact duplicates: compressed radix tries own the texts of each length and content hash.

Texts are equal when their bytes are after lower-casing A-Z. ``owners`` counts rows per
partition (length in bytes, hash of the lower-cased text) without moving a text; a text alone
in its partition has no copy. The others are inserted as full byte strings into Patricia tries,
below the sixteen bytes of their partition: first one trie per task, then one per partition
over what the tasks' tries hold, so that a task sends a text once however often it has it. A
terminal node stores the smallest identifier in the order of preference, the number of rows
and how many of them have that identifier. Only the tries decide what is equal; the hash may
be coarse.

Spill by subtree: a task's trie that holds more than ``SPILL_BYTES`` gives its heaviest
subtree away as rows, which the second tries join with what comes later. There, rows come
sorted by partition and a partition's subtree leaves when the next begins. A partition of
which tasks send more than ``HOT_BYTES`` is first joined in salted parts.

Defined results: null texts are empty, and all empty texts are equal; very long texts are
inserted whole; a null identifier yields to every other; of rows that repeat one text and one
identifier one stays; an empty table has no rows; further columns play no part in ``owners``
and are kept by ``deduplicated``, under any names.
"""

from __future__ import annotations

import hashlib
import struct
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm import arrays
from maskwright.llm.common import number, numbered, restored, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Label bytes a task's trie may hold before it gives subtrees away.
SPILL_BYTES = 32 << 20
#: Bytes of one partition's texts that one task may read in the second tries.
HOT_BYTES = 256 << 20
#: Bytes of rows emitted at a time.
OUT_BYTES = 4 << 20
#: Rows of fixed width (at most KEY_BYTES each) that may be broadcast.
BROADCAST_BYTES = 32 << 20
KEY_BYTES = 80
#: A group with at least one in HOT_SHARE of all rows is hot; there are at most so many.
HOT_SHARE = 1000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PARTITION = ["content", "n_bytes"]
_GROUP = [*_PARTITION, "sha"]


class _Node:
    __slots__ = ("label", "children", "below", "value")

    def __init__(self, label: bytes, below: int = 0):
        self.label, self.children, self.below, self.value = label, {}, below, None


def _common(label: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``label`` stand in ``key`` from ``at``: halving, not byte by byte."""
    if key.startswith(label, at):
        return len(label)
    lo, hi = 0, len(label)  # the first lo are common, the first hi are not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if key.startswith(label[lo:mid], at + lo):
            lo = mid
        else:
            hi = mid
    return lo


class Trie:
    """Byte strings by shared prefixes; edges without branches are one label.

    A value is [identifier, rows, rows with the identifier]; ``before(a, b)`` says whether
    identifier a is preferred. Every node knows the label bytes of its subtree.
    """

    def __init__(self, before: Callable[[object, object], bool]):
        self.before, self.root = before, _Node(b"")

    @property
    def bytes(self) -> int:
        return self.root.below

    def add(self, key: bytes, identifier: object, n: int, same: int) -> None:
        node, at, path, gained = self.root, 0, [self.root], 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                gained = len(key) - at
                at = len(key)
            else:
                common = _common(child.label, key, at)
                if common < len(child.label):
                    upper = _Node(child.label[:common], child.below)
                    child.label, child.below = child.label[common:], child.below - common
                    upper.children[child.label[0]] = child
                    child = node.children[key[at]] = upper
                at += common
            node = child
            path.append(node)
        if gained:
            for passed in path:
                passed.below += gained
        value = node.value
        if value is None:
            node.value = [identifier, n, same]
            return
        value[1] += n
        if value[0] == identifier:
            value[2] += same
        elif self.before(identifier, value[0]):
            value[0], value[2] = identifier, same

    def spilled(self) -> list[tuple[bytes, list]]:
        """Takes the heaviest subtree of at most half the trie (or one text) out of it."""
        def heaviest(node: _Node) -> _Node:
            return max(node.children.values(), key=lambda child: child.below)

        path, prefix, node = [self.root], b"", heaviest(self.root)
        while 2 * node.below > self.root.below and node.children:
            path.append(node)
            prefix += node.label
            node = heaviest(node)
        del path[-1].children[node.label[0]]
        for passed in path:
            passed.below -= node.below
        return list(_terminals(node, prefix))

    def drained(self) -> Iterator[tuple[bytes, list]]:
        node, self.root = self.root, _Node(b"")
        return _terminals(node, b"")


def _terminals(node: _Node, prefix: bytes) -> Iterator[tuple[bytes, list]]:
    todo = [(node, prefix)]
    while todo:
        node, prefix = todo.pop()
        key = prefix + node.label
        if node.value is not None:
            yield key, node.value
        todo.extend((child, key) for child in node.children.values())


def _smaller(a: object, b: object) -> bool:
    return a is not None and (b is None or a < b)


def _larger(a: object, b: object) -> bool:
    return a is not None and (b is None or a > b)


#: Which of equal texts stays -> the order in which its identifier is the smallest.
PREFERENCES = {"first": _smaller, "last": _larger}


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    """The lower-cased bytes of each text, in blocks."""
    offsets, data = arrays.buffers(batch.column("text"))
    for lo, hi in arrays.blocks(offsets):
        raw = data[offsets[lo] : offsets[hi]].tobytes().translate(_LOWER)
        part = (offsets[lo : hi + 1] - offsets[lo]).tolist()
        for i in range(lo, hi):
            yield i, raw[part[i - lo] : part[i - lo + 1]]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their texts -> with the SHA-256 of the lower-cased text."""
    for batch in batches:
        sha = pa.array([hashlib.sha256(text).digest() for _, text in _texts(batch)], pa.binary())
        kept = [batch.column(c) for c in ("id", "tag", *_PARTITION)]
        yield pa.RecordBatch.from_arrays([*kept, sha], names=["id", "tag", *_PARTITION, "sha"])


_KEY, _KEY_SIZE = ">qq", 16
_NAMES = ["id", "n", "same", *_GROUP, "bytes"]


def _rows(found: Iterable[tuple[bytes, list]], kind: pa.DataType, whole: bool) -> Iterator[pa.RecordBatch]:
    """Terminal nodes as rows; without ``whole`` the bytes are left out."""
    kinds = (kind, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    names = _NAMES if whole else _NAMES[:-1]

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds[: len(names)])], names=names)

    out, size = [], 0
    for key, value in found:
        text = key[_KEY_SIZE :]
        row = (*value, *struct.unpack_from(_KEY, key), hashlib.sha256(text).digest())
        out.append((*row, text) if whole else row)
        size += KEY_BYTES + len(text)
        if size >= OUT_BYTES:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def _first_tries(before: Callable, budget: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, kind = Trie(before), None
        for batch in batches:
            kind = batch.schema.field("id").type
            identifiers = batch.column("id").to_pylist()
            content, length = (batch.column(c).to_numpy().tolist() for c in _PARTITION)
            for i, text in _texts(batch):
                trie.add(struct.pack(_KEY, content[i], length[i]) + text, identifiers[i], 1, 1)
                while trie.bytes > budget:
                    yield from _rows(trie.spilled(), kind, True)
        if kind is not None:
            yield from _rows(trie.drained(), kind, True)

    return run


def _second_tries(before: Callable, whole: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last, kind, done = Trie(before), None, None, []
        for batch in batches:
            kind = batch.schema.field("id").type
            content, length, n, same = (batch.column(c).to_numpy().tolist() for c in (*_PARTITION, "n", "same"))
            identifiers, texts = batch.column("id").to_pylist(), batch.column("bytes")
            for i in range(batch.num_rows):
                partition = struct.pack(_KEY, content[i], length[i])
                if partition != last:
                    done.extend(trie.drained())
                    last = partition
                trie.add(partition + texts[i].as_py(), identifiers[i], n[i], same[i])
            yield from _rows(done, kind, whole)
            done = []
        if kind is not None:
            yield from _rows(trie.drained(), kind, whole)

    return run


def content_hash(text: Column) -> Column:
    """Equal for equal texts. Lower-casing all letters makes it coarser than needed, which the
    tries put right; it is much cheaper in the JVM than lower-casing A-Z only."""
    return F.xxhash64(F.lower(text))


def _small(rows: int) -> bool:
    return rows * KEY_BYTES <= BROADCAST_BYTES


def _combined(rows: DataFrame, before: Callable, schema: T.StructType, whole: bool, *by: Column) -> DataFrame:
    dealt = rows.repartition(*by).sortWithinPartitions(*_PARTITION)
    return dealt.mapInArrow(_second_tries(before, whole), schema if whole else T.StructType(schema.fields[:-1]))


def groups(docs: DataFrame, thin: DataFrame, before: Callable) -> DataFrame:
    """Written rows (id, n, same, content, n_bytes, sha) of every text that two rows or more have."""
    shared = written(thin.groupBy(*_PARTITION).count().where("count > 1").select(*_PARTITION), "shared-hashes")
    rows = shared.count()
    met = docs.join(F.broadcast(shared) if _small(rows) else shared, _PARTITION, "left_semi")
    long, binary = T.LongType(), T.BinaryType()
    schema = T.StructType([
        T.StructField("id", docs.schema["id"].dataType), *[T.StructField(c, long) for c in ("n", "same", *_PARTITION)],
        T.StructField("sha", binary), T.StructField("bytes", binary),
    ])
    sent = written(met.select("id", "text", *_PARTITION).mapInArrow(_first_tries(before, SPILL_BYTES), schema), "tries")
    load = F.col("m") * F.col("n_bytes") / HOT_BYTES
    hot = sent.groupBy(*_PARTITION).agg(F.count("*").alias("m")).where(load > 1)
    hot = written(hot.select(*_PARTITION, F.ceil(load).alias("parts")), "hot-hashes")
    rows = hot.count()
    if rows:
        side = F.broadcast(hot) if _small(rows) else hot
        salted = sent.join(side, _PARTITION)
        salt = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.col("parts"))
        salted = written(salted.withColumn("salt", salt), "salted")
        part = _combined(salted.select(*_NAMES, "salt"), before, schema, True, *map(F.col, _PARTITION), F.col("salt"))
        sent = sent.join(side, _PARTITION, "left_anti").select(*_NAMES).unionByName(part)
    return written(_combined(sent, before, schema, False, *map(F.col, _PARTITION)).where("n > 1"), "groups")


def _joined(thin: DataFrame, found: DataFrame, rows: int) -> DataFrame:
    """Every row with its group, if it has one. Groups with a large share of all rows are few and
    are broadcast, so that what is left has no hot key."""
    if _small(rows):
        return thin.join(F.broadcast(found), _GROUP, "left")
    limit = F.lit(thin.count() / HOT_SHARE)
    hot = F.broadcast(found.where(F.col("n") >= limit))
    cold = found.where(F.col("n") < limit)
    rest = thin.join(hot, _GROUP, "left_anti").join(cold.hint("shuffle_hash"), _GROUP, "left")
    return thin.join(hot, _GROUP).unionByName(rest)


def _owned(df: DataFrame, key: str, text: str, keep: str) -> DataFrame:
    """Rows (id, tag, content, n_bytes, sha, keep_id, group_size, kept)."""
    before = PREFERENCES[keep]
    text = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(
        F.col(key).alias("id"), F.col("tag") if "tag" in df.columns else F.monotonically_increasing_id().alias("tag"),
        content_hash(text).alias("content"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"),
    )
    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("sha", T.BinaryType())])
    thin = written(docs.mapInArrow(_digests, schema), "digests")
    found = groups(docs, thin, before)
    rows = found.count()
    named = found.select(*_GROUP, F.col("id").alias("owner"), "n", "same")
    both = _joined(thin, named, rows)
    owner = F.col("n").isNull() | F.col("id").eqNullSafe(F.col("owner"))
    first = F.lit(True)
    if not found.where("same > 1").isEmpty():
        # Rows that repeat text and identifier: the one that was read first stays.
        ties = both.where(owner & (F.col("same") > 1)).groupBy(*_GROUP).agg(F.min("tag").alias("first"))
        ties = written(ties, "ties")
        ties = F.broadcast(ties) if _small(ties.count()) else ties.hint("shuffle_hash")
        both = both.join(ties, _GROUP, "left")
        first = F.col("first").isNull() | (F.col("first") == F.col("tag"))
    return both.select(
        "id", "tag", *_GROUP, F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("owner")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (owner & first).alias("kept"),
    )


def owners(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "last") -> DataFrame:
    """Per row of ``df``: its ``key``, ``keep_id`` (that of the row that stays of equal texts),
    ``group_size``, ``kept``, ``n_bytes`` and ``text_sha256`` of the lower-cased text.

    ``keep`` is "first" for the smallest identifier, "last" for the largest.
    """
    found = _owned(df, key, text, keep)
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    return found.select(F.col("id").alias(key), "keep_id", "group_size", "kept", "n_bytes", sha)


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "last") -> DataFrame:
    """The rows of ``df`` that stay, with their columns. ``df`` is written once, so that its rows
    can be told apart."""
    rows, names = numbered(df)
    held = written(rows.withColumn("tag", F.monotonically_increasing_id()), "rows")
    gone = written(_owned(held, number(names, key), number(names, text), keep).where("not kept").select("tag"), "dropped")
    gone = F.broadcast(gone) if _small(gone.count()) else gone
    return restored(held.join(gone, "tag", "left_anti"), names)
