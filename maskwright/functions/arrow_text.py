"""Text replacement on Arrow batches: the same result as the column expression.

Replacing long texts run by run inside Spark's lambda functions costs over a
microsecond per character.  These two functions do that one step on whole Arrow
batches with numpy.  Character classes and seeds still come from Spark, so no key
and no definition of a letter lives here: the input is text in which ``A``, ``a``
and ``0`` stand for the characters to replace, and the seed to replace them with.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

# Executors get these functions with the job, whether or not they have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds of bytes: kept, upper case, lower case, digit.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[ord("A")], _KIND[ord("a")], _KIND[ord("0")] = 1, 2, 3
_LONGEST = np.array([1 << 62, 11, 10, 11], dtype=np.int64)
_BASE = np.array([1, 26, 26, 10], dtype=np.int64)
_FIRST = np.array([0, ord("A"), ord("a"), ord("0")], dtype=np.int64)
_POWER = np.array([[base**e for e in range(12)] for base in (1, 26, 26, 10)], dtype=np.int64)

# Bytes of text worked on at a time; bounds the size of the temporary arrays.
_SLICE_BYTES = 1 << 20


def _words(seeds: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """The 60-bit words of all blocks, block 0 of each value being its seed."""
    first = np.cumsum(n_blocks) - n_blocks
    raw = np.empty((int(n_blocks.sum()), 32), dtype=np.uint8)
    used = n_blocks > 0
    seed_bytes = np.frombuffer(bytes.fromhex(seeds[used].tobytes().decode()), dtype=np.uint8)
    raw[first[used]] = seed_bytes.reshape(-1, 32)
    more = np.ones(len(raw), dtype=bool)
    more[first[used]] = False
    digests = []
    for v in np.flatnonzero(n_blocks > 1):
        prefix = seeds[v].tobytes() + b"|"
        digests.extend(hashlib.sha256(prefix + b"%d" % b).digest() for b in range(1, n_blocks[v]))
    if digests:
        raw[more] = np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 32)
    return (raw.reshape(-1).view(">u8").astype(np.uint64) >> np.uint64(4)).astype(np.int64)


def _replace(data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Replace the marks in the concatenated values ``data``."""
    total = len(data)
    if total == 0:
        return data
    kind = _KIND[data]
    place = np.arange(total)
    value_start = np.zeros(total, dtype=bool)
    value_start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    run_start = value_start.copy()
    run_start[1:] |= kind[1:] != kind[:-1]
    in_run = place - np.maximum.accumulate(np.where(run_start, place, 0))
    start = run_start | (in_run % _LONGEST[kind] == 0)
    # A single capital belongs to the lower-case run behind it.
    lower_run = np.flatnonzero(run_start & ~value_start & (kind == 2))
    start[lower_run[(kind[lower_run - 1] == 1) & start[lower_run - 1]]] = False

    starts = np.flatnonzero(start)
    lengths = np.diff(np.append(starts, total))
    value = np.searchsorted(offsets, starts, side="right") - 1
    n_pieces = np.bincount(value, minlength=len(offsets) - 1)
    n_blocks = (n_pieces + 3) // 4
    in_value = np.arange(len(starts)) - (np.cumsum(n_pieces) - n_pieces)[value]
    first_word = 4 * (np.cumsum(n_blocks) - n_blocks)
    word = _words(seeds, n_blocks)[first_word[value] + in_value]

    replaced = np.flatnonzero(kind)
    piece = (np.cumsum(start) - 1)[replaced]
    kinds = kind[replaced]
    exponent = lengths[piece] - 1 - (replaced - starts[piece])
    digit = word[piece] // _POWER[kinds, exponent] % _BASE[kinds]
    out = data.copy()
    out[replaced] = (_FIRST[kinds] + digit).astype(np.uint8)
    return out


def _bytes_and_offsets(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the value offsets of a string array without nulls."""
    _, offset_buffer, data_buffer = strings.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int32)
    offsets = offsets[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    if data_buffer is None:
        return np.empty(0, dtype=np.uint8), offsets
    data = np.frombuffer(data_buffer, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def replace_marks(classes: pa.Array, seeds: pa.Array) -> pa.Array:
    """Replace the marks of each value of a string array by means of its seed."""
    n = len(classes)
    if n == 0:
        return pa.array([], type=pa.string())
    valid = classes.is_valid()
    data, offsets = _bytes_and_offsets(classes.cast(pa.string()).fill_null(""))
    seed_data, _ = _bytes_and_offsets(seeds.cast(pa.string()).fill_null("0" * 64))
    seed_rows = seed_data.reshape(n, 64)
    parts = []
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + _SLICE_BYTES, side="right")) - 1
        end = min(max(end, begin + 1), n)
        part = data[offsets[begin] : offsets[end]]
        parts.append(_replace(part, offsets[begin : end + 1] - offsets[begin], seed_rows[begin:end]))
        begin = end
    out = np.concatenate(parts)
    masked = pa.StringArray.from_buffers(
        n, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)
    )
    return masked if classes.null_count == 0 else pc.if_else(valid, masked, pa.scalar(None, pa.string()))


@arrow_udf(T.StringType())
def replace_text(classes: pa.Array, seeds: pa.Array) -> pa.Array:
    return replace_marks(classes, seeds)


@arrow_udf(T.ArrayType(T.StringType()))
def replace_pieces(classes: pa.Array, seeds: pa.Array) -> pa.Array:
    """The same for arrays of texts."""
    values = replace_marks(classes.flatten(), seeds.flatten())
    lengths = pc.list_value_length(classes).fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=classes.is_null())
