"""Masks that cannot collide: a keyed permutation of all values of one shape.

A value's shape is its text with capitals as ``A``, small letters as ``a`` and digits as ``0``;
everything else, letters beyond ASCII included, stays. The letters and digits, in order, are cut
into two halves, and ten Feistel rounds add to one half a stream of numbers drawn from the other:

    key      = sha256(tag | round | shape | other half)        64 hex digits
    block 0  = key,   block b = sha256(key | b)                b >= 1
    character i of the half moves on by number i of the blocks (four hex digits each),
    within its capitals, small letters or digits; even rounds change the first half

That maps the values of a shape one to one onto themselves. Some of them cannot stand in a
column: 042 is not an integer's text, and a number of ten digits may exceed 32 bits. So a value
walks along its cycle until it meets one of its own kind (``kind``): canonical integers of
16, 32 or 64 bits, or everything else. The text ``null`` is never masked, and no mask. A permutation
restricted in this way is one again. Parents and children agree across integer and text columns.

Two engines with equal results: column expressions, and Arrow batches, where each distinct
value of a batch is computed once.
"""

from __future__ import annotations

import hashlib
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from maskwright.functions.generator import LOWER, UPPER, bind

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGITS = "0123456789"
ROUNDS = 10
#: Characters per block: four hex digits each.
BLOCK = 16
#: Steps along a cycle that column expressions take at first, and at most. The fewest of a kind
#: in a shape are the integers of ten digits and 32 bits, one in nine; more steps than the second
#: number have a chance below 1e-25 and are an error, never a collision.
FIRST_STEPS, MOST_STEPS = 6, 512

_SHAPE = str.maketrans(UPPER + LOWER + DIGITS, "A" * 26 + "a" * 26 + "0" * 10)
_FIRST = {"A": 65, "a": 97, "0": 48}
_INTEGER = re.compile("-?0{1,19}")


# ------------------------------------------------------------------ on batches


def kind(text: str) -> int:
    """-1 for the text ``null``, the bits of a canonical integer, 0 for everything else."""
    if text == "null":
        return -1
    digits = text.removeprefix("-")
    if not (0 < len(digits) <= 19 and digits.isascii() and digits.isdigit()) or (digits[0] == "0" and text != "0"):
        return 0
    number = int(text)
    return next((bits for bits in (16, 32, 64) if -(1 << bits - 1) <= number < 1 << bits - 1), 0)


def _numbers(other: np.ndarray, width: int, prefix: bytes) -> np.ndarray:
    """For each row of characters the first ``width`` numbers of its blocks."""
    raw, size = other.tobytes(), other.shape[1]
    keys = [hashlib.sha256(prefix + raw[i : i + size]) for i in range(0, len(raw), size)] if size else (
        [hashlib.sha256(prefix)] * len(other))
    if width <= BLOCK:
        blocks = b"".join(key.digest() for key in keys)
    else:
        later = [b"|%d" % b for b in range(1, -(-width // BLOCK))]
        texts = [key.hexdigest().encode() for key in keys]
        blocks = b"".join(
            b"".join((key.digest(), *(hashlib.sha256(text + b).digest() for b in later))) for key, text in zip(keys, texts)
        )
    return np.frombuffer(blocks, dtype=">u2").reshape(len(other), -1)[:, :width].astype(np.int64)


def _mixed(symbols: np.ndarray, first: np.ndarray, radix: np.ndarray, shape: bytes, tag: str) -> np.ndarray:
    """The rounds for the characters of many values of one shape, a row each."""
    cut = (symbols.shape[1] + 1) // 2
    halves = [slice(0, cut), slice(cut, symbols.shape[1])]
    out = symbols.copy()
    for r in range(ROUNDS):
        half, other = halves[r % 2], halves[1 - r % 2]
        width = half.stop - half.start
        if width:
            number = _numbers(np.ascontiguousarray(out[:, other]), width, f"{tag}|{r}|".encode() + shape + b"|")
            moved = (out[:, half].astype(np.int64) - first[half] + number) % radix[half] + first[half]
            out[:, half] = moved.astype(np.uint8)
    return out


def permuted(texts: list[str], tag: str) -> list[str]:
    """The values' masks; values of one shape are worked on together."""
    shapes: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        if text not in (None, "null"):
            shapes.setdefault(text.translate(_SHAPE), []).append(i)
    out = list(texts)
    for shape, rows in shapes.items():
        places = [i for i, c in enumerate(shape) if c in _FIRST]
        if not places:
            continue
        first = np.array([_FIRST[shape[i]] for i in places])
        radix = np.where(first == _FIRST["0"], 10, 26)
        chars = np.frombuffer("".join(texts[i] for i in rows).encode("utf-32-le"), dtype="<u4").reshape(len(rows), len(shape)).copy()
        symbols = chars[:, places].astype(np.uint8)
        # Only these shapes hold values of more than one kind.
        walks = shape == "aaaa" or _INTEGER.fullmatch(shape) is not None
        own = np.array([kind(texts[i]) for i in rows]) if walks else None
        todo = np.arange(len(rows))
        while len(todo):
            symbols[todo] = _mixed(symbols[todo], first, radix, shape.encode(), tag)
            chars[np.ix_(todo, places)] = symbols[todo]
            masked = chars[todo].tobytes().decode("utf-32-le")
            size = len(shape)
            done = [masked[i * size : (i + 1) * size] for i in range(len(todo))]
            for i, text in zip(todo, done):
                out[rows[i]] = text
            todo = todo[np.array([kind(text) for text in done]) != own[todo]] if walks else todo[:0]
    return out


@arrow_udf(T.StringType())
def permute_batch(texts: pa.Array, tags: pa.Array) -> pa.Array:
    coded = texts.dictionary_encode()
    tag = tags[0].as_py() if len(tags) else ""
    return pa.array(permuted(coded.dictionary.to_pylist(), tag), pa.string()).take(coded.indices)


# ------------------------------------------------------------------ as columns


def _kind(text: Column) -> Column:
    number = text.try_cast("bigint")
    canonical = number.cast("string") == text
    bits = F.when(number.between(-(1 << 15), (1 << 15) - 1), 16).when(number.between(-(1 << 31), (1 << 31) - 1), 32).otherwise(64)
    return F.when(text == "null", -1).when(F.coalesce(canonical, F.lit(False)), bits).otherwise(0)


def _moved_column(half: Column, other: Column, turn: Column, shape: Column, tag: str) -> Column:
    def stream(key: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.length(half) - 1) / BLOCK).cast("int"))
        text = F.transform(blocks, lambda b: F.when(b == 0, key).otherwise(F.sha2(F.concat(key, F.lit("|"), b.cast("string")), 256)))
        return bind(F.array_join(text, ""), moved)

    def moved(numbers: Column) -> Column:
        def character(i: Column) -> Column:
            code = F.ascii(F.substr(half, i, F.lit(1)))
            first = F.when(code >= 97, 97).when(code >= 65, 65).otherwise(48)
            radix = F.when(code >= 65, 26).otherwise(10)
            number = F.conv(F.substr(numbers, 4 * i - 3, F.lit(4)), 16, 10).cast("int")
            return F.char((first + (code - first + number) % radix).cast("bigint"))

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), character), "")

    key = F.sha2(F.concat(F.lit(f"{tag}|"), turn.cast("string"), F.lit("|"), shape, F.lit("|"), other), 256)
    return F.when(F.length(half) > 0, bind(key, stream)).otherwise(F.lit(""))


def permute_column(text: Column, tag: str) -> Column:
    """The value's mask as one expression."""
    shape = F.translate(text, UPPER + LOWER + DIGITS, "A" * 26 + "a" * 26 + "0" * 10)

    def once(value: Column) -> Column:
        symbols = F.regexp_replace(value, "[^A-Za-z0-9]", "")

        def halves(symbols: Column) -> Column:
            cut = F.floor((F.length(symbols) + 1) / 2).cast("int")
            start = F.struct(F.substr(symbols, F.lit(1), cut).alias("l"), F.substr(symbols, cut + 1, F.length(symbols)).alias("r"))

            def turn(state: Column, r: Column) -> Column:
                left = F.when(r % 2 == 0, _moved_column(state["l"], state["r"], r, shape, tag)).otherwise(state["l"])
                right = F.when(r % 2 == 1, _moved_column(state["r"], state["l"], r, shape, tag)).otherwise(state["r"])
                return F.struct(left.alias("l"), right.alias("r"))

            return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))

        def placed(new: Column) -> Column:
            runs = F.regexp_extract_all(value, F.lit("[A-Za-z0-9]+|[^A-Za-z0-9]+"), F.lit(0))
            start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

            def run(state: Column, r: Column) -> Column:
                own = r.rlike("^[A-Za-z0-9]")
                part = F.when(own, F.substr(new, state["at"], F.length(r))).otherwise(r)
                at = state["at"] + F.when(own, F.length(r)).otherwise(0)
                return F.struct(at.alias("at"), F.concat(state["out"], part).alias("out"))

            return F.aggregate(runs, start, run, lambda s: s["out"])

        return bind(bind(symbols, halves), placed)

    def walk(start: Column, steps: int, own: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(steps)), start, lambda v, _: F.when(_kind(v) == own, v).otherwise(once(v))
        )

    def masked(first: Column) -> Column:
        own = _kind(text)
        lost = F.raise_error(F.lit("a value's cycle is too long")).cast("string")
        more = bind(walk(first, MOST_STEPS, own), lambda v: F.when(_kind(v) == own, v).otherwise(lost))
        return F.when(_kind(first) == own, first).otherwise(more)

    found = bind(bind(once(text), lambda v: walk(v, FIRST_STEPS, _kind(text))), masked)
    return F.when(text == "null", text).when(text.isNotNull(), found)
