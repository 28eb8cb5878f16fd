"""Keyed, deterministic replacement values as Spark column expressions.

A mask must not depend on which task computes it, how often it is retried, or
what else is in the partition, so nothing here is random.  Every replacement is
a function of the secret key, a scope and the original value:

    tag      = first 32 hex digits of sha256(key | scope)
    seed     = sha256(tag | value)                        64 hex digits
    block 0  = seed,   block b = sha256(seed | b)         b >= 1

Equal originals in one scope get equal masks in every column, table and run;
another scope (for instance a run id) gives unrelated masks.  Hashing the value
once and chaining the further blocks from the seed keeps the work linear in the
length of the text.

Only the tag reaches the plan.  The key itself never does, but the tag is as
good as the key within its scope, so plans still deserve
``spark.sql.redaction.string.regex``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# The digits conv() writes in base 26.
BASE26 = "0123456789ABCDEFGHIJKLMNOP"

# Characters that count as digits without being decimal digits
# (Unicode Numeric_Type=Digit), such as superscripts and circled digits.
OTHER_DIGITS = (
    r"\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}"
    r"\x{24EA}\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}"
    r"\x{278A}-\x{2792}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}"
    r"\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
# mask() knows the classes of all characters Java holds in one unit; these are the
# characters it leaves over.
_BEYOND_ASCII = r"&&[^\x00-\x7F]]"
LEFT_OVER = (
    (r"[\p{IsUppercase}" + _BEYOND_ASCII, "A"),
    (r"[\p{IsLowercase}" + _BEYOND_ASCII, "a"),
    (r"[\p{Nd}" + OTHER_DIGITS + _BEYOND_ASCII, "0"),
)

# A value is replaced run by run: one 60-bit word covers at most 11 letters (lower
# case with or without a capital, or all capitals) or 11 digits; the rest is kept.
LONGEST_RUN = 11
RUNS = "A?a{1,10}|A{1,11}|0{1,11}|[^Aa0]+"


@dataclass(frozen=True)
class MaskContext:
    """Who masks, and how far equal values stay equal.

    ``key`` is the secret.  ``project`` names the lasting scope (referential
    integrity ``Y``), ``run_id`` the scope of a single run of it (``N``); without a run
    id such rules are refused, as their masks would be the same in all runs.
    ``text_engine`` says how text is replaced: on Arrow batches (``arrow``), or
    by column expressions only (``columns``).  Results are the same.
    """

    key: str = field(repr=False)
    project: str = "default"
    run_id: str | None = None
    text_engine: str = "arrow"

    def __post_init__(self) -> None:
        if not self.key:
            raise ValueError("a masking key is required")
        if self.text_engine not in ("arrow", "columns"):
            raise ValueError(f"unknown text engine {self.text_engine!r}")

    def scope(self, ref_integrity: str = "Y") -> str:
        if ref_integrity == "Y":
            return f"project:{self.project}"
        if ref_integrity == "N":
            if not self.run_id:
                raise ValueError("a rule of a single run needs a run id")
            return f"run:{self.project}/{self.run_id}"
        raise ValueError(f"Ref Integrity must be Y or N, not {ref_integrity!r}")

    def tag(self, scope: str) -> str:
        return hashlib.sha256(f"{self.key}|{scope}".encode()).hexdigest()[:32]


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Inside lambda functions Spark does not share common subexpressions; a
    one-element transform does.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def seed_of(value: Column, tag: str) -> Column:
    return F.sha2(F.concat(F.lit(tag + "|"), value), 256)


def seed_number(seed: Column, start: int, digits: int) -> Column:
    """Hex digits ``start`` (from 1) .. of the seed as a long."""
    return F.conv(F.substring(seed, start, digits), 16, 10).cast("long")


def character_classes(value: Column) -> Column:
    """Upper case as ``A``, lower case as ``a``, digits as ``0``, rest kept."""
    marked = F.mask(value, F.lit("A"), F.lit("a"), F.lit("0"))
    complete = marked
    for pattern, mark in LEFT_OVER:
        complete = F.regexp_replace(complete, pattern, mark)
    return F.when(F.length(value) == F.octet_length(value), marked).otherwise(complete)


def _word(block: Column, place: Column | int) -> Column:
    """Word 0..3 of a block: 15 hex digits out of 16."""
    start = F.lit(place * 16 + 1) if isinstance(place, int) else place * 16 + 1
    return F.substr(block, start, F.lit(15))


def _number_text(word: Column, base: int, length: Column) -> Column:
    """The last ``length`` digits of a word written in some base.

    Not right(): that reads its argument twice, and so would compute it twice.
    """
    padded = F.concat(F.lit("0" * LONGEST_RUN), F.conv(word, 16, base))
    return F.substr(padded, -length, length)


def _replacement(run: Column, word: Column) -> Column:
    first = F.substr(run, F.lit(1), F.lit(1))
    length = F.length(run)
    lower = F.translate(_number_text(word, 26, length), BASE26, LOWER)
    upper = F.translate(_number_text(word, 26, length), BASE26, UPPER)
    return (
        F.when(first == "a", lower)
        .when(first == "0", _number_text(word, 10, length))
        .when(first == "A", F.when(run.endswith("a"), F.initcap(lower)).otherwise(upper))
        .otherwise(run)
    )


def mask_text(value: Column, seed: Column) -> Column:
    """Replace letters by letters and digits by digits; keep everything else.

    Same length, same pattern of upper case, lower case and digits.  ``seed`` is
    the seed of ``value``.
    """

    def with_seed(seed: Column) -> Column:
        def with_runs(runs: Column) -> Column:
            last_block = F.shiftright(F.greatest(F.size(runs) - 1, F.lit(0)), 2)
            blocks = F.transform(
                F.sequence(F.lit(0), last_block),
                lambda b: F.when(b == 0, seed).otherwise(
                    F.sha2(F.concat(seed, F.lit("|"), b.cast("string")), 256)
                ),
            )
            return bind(
                blocks,
                lambda bs: F.array_join(
                    F.transform(
                        runs,
                        lambda run, i: _replacement(
                            run, _word(F.get(bs, F.shiftright(i, 2)), i.bitwiseAND(3))
                        ),
                    ),
                    "",
                ),
            )

        runs = F.regexp_extract_all(character_classes(value), F.lit(RUNS), F.lit(0))
        return bind(runs, with_runs)

    return F.when(value.isNotNull(), bind(seed, with_seed))


# ---------------------------------------------------------------- typed values

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)
STRINGS = (T.StringType, T.CharType, T.VarcharType)


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, STRINGS)


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, INTEGERS + FLOATS + (T.DecimalType,))


def canonical_text(value: Column, dtype: T.DataType) -> Column:
    """The text under which a value is hashed, masked and looked up.

    Integers and strings holding the same digits agree, so a key that is a
    number in one table and text in another is masked alike.  Very small and very
    large floating-point values have an exponent: ``1.25E-7``.
    """
    return value if is_text(dtype) else value.cast("string")


def not_a_number(value: Column, dtype: T.DataType) -> Column | None:
    """Condition for NaN and the infinities, which have no digits to replace."""
    if not isinstance(dtype, FLOATS):
        return None
    return F.isnan(value) | (F.abs(value) == float("inf"))


def mask_number_text(text: Column, seed: Column) -> Column:
    """``mask_text`` for numbers: ``-``, digits, ``.``, digits; an exponent is kept.

    Such a text has at most five runs, so the common case needs no lambda and
    compiles.  Same result as ``mask_text`` of the part before the exponent.
    """
    exponent = F.regexp_extract(text, "E-?\\d+$", 0)
    mantissa = F.substring_index(text, "E", 1)
    return F.concat(_mantissa(mantissa, seed), exponent)


def _mantissa(text: Column, seed: Column) -> Column:
    negative = text.startswith("-")
    point = F.instr(text, ".")
    whole_length = F.when(point > 0, point - 1).otherwise(F.length(text)) - negative.cast("int")
    part_length = F.when(point > 0, F.length(text) - point).otherwise(0)
    whole_word = F.when(negative, _word(seed, 1)).otherwise(_word(seed, 0))
    part_word = F.when(negative, _word(seed, 3)).otherwise(_word(seed, 2))
    # Digits beyond one run: the fourth word, or the first one of the next block.
    rest_word = F.when(negative, _word(F.sha2(F.concat(seed, F.lit("|1")), 256), 0)).otherwise(_word(seed, 3))
    whole = _number_text(whole_word, 10, whole_length)
    part = _number_text(part_word, 10, F.least(part_length, F.lit(LONGEST_RUN)))
    rest = _number_text(rest_word, 10, part_length - LONGEST_RUN)
    return F.when(
        whole_length.between(1, LONGEST_RUN) & (part_length <= 2 * LONGEST_RUN),
        F.concat(
            F.when(negative, F.lit("-")).otherwise(F.lit("")),
            whole,
            F.when(point > 0, F.lit(".")).otherwise(F.lit("")),
            F.when(part_length > 0, part).otherwise(F.lit("")),
            F.when(part_length > LONGEST_RUN, rest).otherwise(F.lit("")),
        ),
    ).otherwise(mask_text(text, seed))


def too_wide(dtype: T.DataType) -> Column:
    """The error for a masked value its column cannot hold; names no value."""
    name = dtype.simpleString()
    return F.raise_error(F.lit(f"a masked value does not fit {name}")).cast(name)


def restore_type(masked: Column, dtype: T.DataType) -> Column:
    """Cast masked text back to the column's type; what cannot fit is an error.

    An integer that overflows gets the largest leading digits that always fit.
    """
    if is_text(dtype):
        return masked
    name = dtype.simpleString()
    number = masked.try_cast(name)
    if isinstance(dtype, INTEGERS):
        head = "10" if isinstance(dtype, T.ByteType) else "1"
        sign = F.when(masked.startswith("-"), F.lit("-")).otherwise(F.lit(""))
        digits = F.ltrim(masked, F.lit("-"))
        fitting = F.concat(sign, F.lit(head), F.substring(digits, len(head) + 1, 40))
        return F.coalesce(number, fitting.try_cast(name), too_wide(dtype))
    if isinstance(dtype, T.DecimalType) and dtype.precision == dtype.scale:
        # No digit is allowed before the point, so the leading zero stays.
        number = F.regexp_replace(masked, r"^(-?)\d\.", "$10.").try_cast(name)
    if isinstance(dtype, FLOATS):
        number = F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))
    return F.coalesce(number, too_wide(dtype))
