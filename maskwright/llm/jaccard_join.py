"""Near duplicates: the exact Jaccard join of word n-gram sets, as classes.

Sets are sorted, frequent shingles last; two sets of similarity t share a shingle within
their first (1 - t) parts, so inverted lists of those prefixes hold every pair. (Which
shingles count as frequent never changes the result: any order serves that is the same
for all sets.) What keeps the lists from being multiplied out are set relations:

* Equal sets are one class, joined once.
* List level: positions and sizes bound the overlap of two entries; whole blocks of a list
  whose bounds cannot meet are skipped.
* Answer level: every entry is first compared with its list's representative only (the
  entry of the fewest rarer shingles). What is found similar to it takes its answers from it: a pair
  within one component needs no comparison. Only entries that are still apart after that
  are compared with each other. So a group of near copies costs its size, not its square,
  and yet no link between components can be missed.

Defined results: null, empty and wordless texts have an empty set, linked with nothing; a
text of fewer words than ``N`` has its whole sequence as its one shingle; very long texts
are one set; repeated rows are equal sets; rows of one id but different texts are sets of
their own; an id that is null counts for no component's name, which is null where there is
no other; an empty table has no rows; further columns play no part.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm import arrays
from maskwright.llm.common import number, numbered, restored, written
from maskwright.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

N = 5
#: Similarity as a fraction: linked if DEN * common >= NUM * union.
NUM, DEN = 4, 5
#: Shingles known as frequent, at most (some megabytes on each worker), and from what count.
FREQUENT, LEAST_LEVEL = 1 << 19, 3
#: A set is counted whole if one in so many of its smallest shingles is frequent; and shingles
#: that a task counts at a time.
CHANGED, COUNTED = 64, 1 << 20
#: Pairs of one representative verified in one place, and entries of a list in one block.
GROUP, BLOCK = 2_000, 8_192
#: Texts whose sets a task holds at a time.
TEXTS = 256
#: Rows that a side may have to be broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def shingle_sets(column, n: int = N) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text of an Arrow string column."""
    offsets, data = arrays.buffers(column)
    for lo, hi in arrays.blocks(offsets):
        part = offsets[lo : hi + 1]
        hashes, first = arrays.words(part - part[0], data[part[0] : part[-1]], arrays.BETWEEN_SPACES)
        whole = arrays.windows(hashes, n)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= n:
                yield np.unique(whole[a : b - n + 1].view(np.int64))
            elif b > a:
                yield arrays.mix(arrays.windows(hashes[a:b], b - a) + np.uint64(b - a)).view(np.int64)
            else:
                yield np.zeros(0, dtype=np.int64)


def class_of(shingles: np.ndarray) -> int | None:
    """64 bits of a set; equal for equal sets."""
    if not len(shingles):
        return None
    total = np.sum(arrays.mix(shingles.view(np.uint64)), keepdims=True, dtype=np.uint64)
    return int(arrays.mix(total ^ np.uint64(len(shingles))).view(np.int64)[0])


def prefix_size(n: int) -> int:
    return n + (-NUM * n // DEN) + 1


def _token_counts(common=None):
    """How often each shingle is among the smallest of a set, counted part by part; with known
    frequent shingles: how often each is in a set with many of them among its smallest."""

    def counted(found):
        token, n = np.unique(np.concatenate(found) if found else np.zeros(0, dtype=np.int64), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(n.astype(np.int64))], names=["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if common is None else common.value[0]
        seen: set[int] = set()
        found, held = [], 0
        for batch in batches:
            for s in shingle_sets(batch.column(0)):
                c = class_of(s)
                if c is None or c in seen:
                    continue
                seen.add(c)
                first = s[: prefix_size(len(s))]
                if known is not None:
                    hits = known[np.minimum(np.searchsorted(known, first), len(known) - 1)] == first
                    if CHANGED * np.count_nonzero(hits) < len(first):
                        continue
                found.append(first if known is None else s)
                held += len(found[-1])
                if held >= COUNTED:
                    yield counted(found)
                    found, held = [], 0
        yield counted(found)

    return run


def frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, at most ``FREQUENT`` of them, and their levels (binary logarithms of
    their counts), counted over all texts.

    First among the smallest shingles of every set; then among all shingles of those sets
    that have many of these, as their prefixes are what is going to change. So a passage or
    a group of near copies is known by all its shingles, while other texts add none.
    """
    first = _most_frequent(texts.mapInArrow(_token_counts(), "token long, n long"))
    if not len(first[0]):
        return first
    common = texts.sparkSession.sparkContext.broadcast(first)
    return _most_frequent(texts.mapInArrow(_token_counts(common), "token long, n long"))


def _most_frequent(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    counts = counted.groupBy("token").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n")).cast("int")
    many = written(counts.where(F.col("n") >= 2**LEAST_LEVEL).select("token", level.alias("level")), "frequent")
    sizes = dict(map(tuple, many.groupBy("level").count().collect()))
    least, total = max(sizes, default=0) + 1, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > FREQUENT:
            break
        least = at
    rows = many.where(F.col("level") >= least).toArrow()
    token, levels = rows.column("token").to_numpy(), rows.column("level").to_numpy().astype(np.int8)
    order = np.argsort(token)
    return token[order], levels[order]


def _prefixes(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, level = common.value
        seen: set[int] = set()  # copies within a task send their prefix once
        for batch in batches:
            size, kind, prefix = [], [], []
            for s in shingle_sets(batch.column(1)):
                c = class_of(s)
                size.append(len(s))
                kind.append(c)
                if c is None or c in seen:
                    prefix.append(None)
                    continue
                seen.add(c)
                if len(token):
                    at = np.minimum(np.searchsorted(token, s), len(token) - 1)
                    s = s[np.argsort(np.where(token[at] == s, level[at], 0), kind="stable")]
                prefix.append(s[: prefix_size(len(s))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(kind, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "class", "prefix"],
            )

    return run


def _may_link(size_a, place_a, size_b, place_b):
    """Whether sets meeting first at these places can be similar enough; works on columns
    and on arrays alike."""
    return ((NUM + DEN) * (_least(size_a - place_a, size_b - place_b)) >= NUM * (size_a + size_b))


def _least(a, b):
    return F.least(a, b) if isinstance(a, Column) else np.minimum(a, b)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by (token, place, class) -> entries but the first of each list, with the
    first. The first has the fewest rare shingles before the list's: of near copies it is the
    one nearest to what they have in common."""
    names = ("token", "class", "size", "place")
    last = np.full((4, 1), -1, dtype=np.int64)  # the row before, and its list's first row
    rep, started = last.copy(), False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
        known = np.concatenate([last, rows], axis=1)
        fresh = known[0, 1:] != known[0, :-1]
        if not started:
            fresh[0], started = True, True
        same = ~fresh & (known[1, 1:] == known[1, :-1])
        begins = np.where(fresh, np.arange(len(fresh)), -1)
        at = np.maximum.accumulate(begins)
        own = np.where(at >= 0, rows[:, np.maximum(at, 0)], rep)
        out = ~fresh & ~same & (rows[1] != own[1])
        last, rep = rows[:, -1:], own[:, -1:]
        columns = [rows[i][out] for i in range(4)] + [own[i][out] for i in range(1, 4)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[*names, "rep", "rep_size", "rep_place"])


_LISTED = "token long, class long, size long, place long, rep long, rep_size long, rep_place long"


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc text, class, uses) -> the class's set once per use."""
    for batch in (whole.slice(at, TEXTS) for whole in batches for at in range(0, whole.num_rows, TEXTS)):
        text, kind, uses = batch.column("text"), batch.column("class").to_pylist(), batch.column("uses").to_pylist()
        out: list[list] = [[], [], [], [], []]
        for s, c, use in zip(shingle_sets(text), kind, uses, strict=True):
            if class_of(s) != c:  # another text under the same id
                continue
            raw = s.tobytes()
            for u in use:
                for column, value in zip(out, (u["rep"], u["part"], u["member"], c, raw)):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=["rep", "part", "member", "class", "set"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (rep, part, member) -> links; only the representative is held."""
    rep, held = None, np.zeros(0, dtype=np.int64)
    for batch in batches:
        a, b = [], []
        columns = [batch.column(c).to_pylist() for c in ("rep", "member", "class")]
        for i, (r, member, c) in enumerate(zip(*columns)):
            own = np.frombuffer(batch.column("set")[i].as_buffer(), dtype=np.int64)
            if not member:
                rep, held = r, own.copy()
            elif r == rep:
                at = np.searchsorted(held, own)
                at[at == len(held)] = 0
                common = int(np.count_nonzero(held[at] == own))
                if (NUM + DEN) * common >= NUM * (len(held) + len(own)):
                    a.append(r)
                    b.append(c)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame, df: DataFrame, key: str, text: str) -> DataFrame:
    """Those of the class pairs (a, b) that are links. Texts are read again for the classes
    in pairs only, and travel as sets to where their representative is."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    members = pairs.join(parts, "a").select(
        F.col("b").alias("class"), F.col("a").alias("rep"),
        F.expr("pmod(xxhash64(b), parts)").alias("part"), F.lit(1).alias("member"),
    )
    reps = parts.select(
        F.col("a").alias("class"), F.col("a").alias("rep"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"),
    )
    uses = members.unionByName(reps).groupBy("class").agg(F.collect_list(F.struct("rep", "part", "member")).alias("uses"))
    where = sets.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("_id"))
    wanted = written(uses.join(where, "class"), "wanted-sets")
    right = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    texts = df.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(right, F.col("_key").eqNullSafe(F.col("_id")))
    used = texts.select("text", "class", "uses").mapInArrow(_expanded, "rep long, part long, member int, class long, set binary")
    met = used.repartition("rep", "part").sortWithinPartitions("rep", "part", "member")
    return written(met.mapInArrow(_compared, "a long, b long").distinct(), "links")


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by (token, i, j) -> candidate pairs of different components."""
    names = ("token", "i", "j", "own", "class", "size", "place", "label")
    held, at = [], None

    def flush():
        rows = np.concatenate(held, axis=1)
        i, j = rows[1, 0], rows[2, 0]
        left = rows[:, rows[3] == i]
        right = left if i == j else rows[:, rows[3] == j]
        yield from _block_pairs(left, right)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
        cuts = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1
        for part in np.split(rows, cuts, axis=1):
            now = tuple(part[:3, 0].tolist())
            if now != at and held:
                yield from flush()
                held = []
            at = now
            held.append(part)
    if held:
        yield from flush()


def _block_pairs(left: np.ndarray, right: np.ndarray, block: int = 512) -> Iterator[pa.RecordBatch]:
    left, right = (x[:, np.argsort(x[5], kind="stable")] for x in (left, right))
    for lo in range(0, left.shape[1], block):
        a = left[:, lo : lo + block]
        # Skip what is too small or too large for the whole block.
        first = np.searchsorted(right[5] * DEN, a[5, 0] * NUM, side="left")
        end = np.searchsorted(right[5] * NUM, a[5, -1] * DEN, side="right")
        for k in range(first, end, block):
            b = right[:, k : min(k + block, end)]
            best = min((a[5] - a[6]).max(), (b[5] - b[6]).max())
            if (NUM + DEN) * best < NUM * (a[5, 0] + b[5, 0]):
                continue
            if a[7].min() == a[7].max() == b[7].min() == b[7].max():
                continue
            fits = (a[7][:, None] != b[7][None, :]) & _may_link(a[5][:, None], a[6][:, None], b[5][None, :], b[6][None, :])
            x, y = np.nonzero(fits)
            pairs = np.sort(np.stack([a[4][x], b[4][y]], 1), axis=1)
            pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["a", "b"])


def joined(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The written sets (doc_id, n_shingles, class, prefix) and the components (node, root) of
    their classes; a class that is no node is linked with no other class."""
    schema = df.select(F.col(key).alias("doc_id")).schema.add("n_shingles", "long").add("class", "long").add("prefix", T.ArrayType(T.LongType()))
    common = df.sparkSession.sparkContext.broadcast(frequent(df.select(text)))
    sets = written(df.select(key, text).mapInArrow(_prefixes(common), schema), "sets")
    entries = sets.where(F.col("prefix").isNotNull()).select(
        F.col("class"), F.col("n_shingles").cast("int").alias("size"), F.posexplode("prefix").alias("place", "token")
    )
    lists = written(
        entries.repartition("token").sortWithinPartitions("token", "place", "class")
        .select("token", "class", "size", "place").mapInArrow(_listed, _LISTED),
        "lists",
    )
    size, place, rep_size, rep_place = map(F.col, ("size", "place", "rep_size", "rep_place"))
    stars = written(
        lists.where(_may_link(size, place, rep_size, rep_place)).select(F.col("rep").alias("a"), F.col("class").alias("b")).distinct(),
        "pairs",
    )
    links = verified(stars, sets, df, key, text)
    found = written(components(links), "components")
    label = F.coalesce("root", "class").alias("label")
    labelled = written(
        lists.select("token", "class", "size", "place").join(found.withColumnRenamed("node", "class"), "class", "left")
        .select("token", "class", "size", "place", label), "labelled",
    )
    mixed = labelled.groupBy("token").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = mixed.where(F.col("lo") < F.col("hi")).select("token", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    spread = labelled.join(mixed, "token").withColumn("own", F.expr("pmod(xxhash64(class), blocks)"))
    spread = spread.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    spread = spread.select("token", F.least("own", "_other").alias("i"), F.greatest("own", "_other").alias("j"), "own", "class", "size", "place", "label")
    apart = spread.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(_apart, "a long, b long").distinct()
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = written(apart.join(tried, ["a", "b"], "left_anti"), "pairs")
    if rest.isEmpty():
        return sets, found
    more = verified(rest, sets, df, key, text)
    return sets, written(components(links.unionByName(more)), "components")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``n_shingles`` and ``component_id``."""
    sets, found = joined(df, key, text)
    classes = sets.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("_least"))
    classes = classes.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    names = classes.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = classes.select("class", "root").join(names, "root").select("class", "component_id")
    rows = sets.select("doc_id", "n_shingles", "class").join(named, "class", "left")
    return rows.select("doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one document of each component, the one of the smallest id.

    Rows without an id stay, as nothing tells them apart; rows that repeat id and text
    become one. The texts meet only the ids that go.
    """
    rows, names = numbered(df)
    key, text = number(names, key), number(names, text)
    found = written(near_duplicates(rows, key, text), "near-duplicates")
    going = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone"))
    staying = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_gone"))
    going = written(going.distinct().join(staying.distinct(), "_gone", "left_anti"), "going")
    right = F.broadcast(going) if going.count() <= BROADCAST_ROWS else going
    kept = rows.join(right, F.col(key) == F.col("_gone"), "left_anti")
    again = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1")
    again = written(again.select(F.col("doc_id").alias("_gone")), "repeated")
    if again.isEmpty():
        return restored(kept, names)
    repeated = kept.join(again, F.col(key) == F.col("_gone"), "left_semi").dropDuplicates([key, text])
    return restored(kept.join(again, F.col(key) == F.col("_gone"), "left_anti").unionByName(repeated), names)
