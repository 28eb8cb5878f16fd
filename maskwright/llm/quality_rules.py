"""Quality rules as a bitmask ledger: measured once, judged by versioned policies.

``ledger`` measures every text and evaluates every rule once; a failed rule sets its
bit in ``fail_bits``. A policy is a set of rules, so that another policy or the removal
of one rule is a bitwise operation on the stored ledger and never reads a text again.
Everything is DataFrame expressions within the row: no shuffle.

Defined results: a null or empty text has no words and fails ``few_words``; very long
texts are handled whole in their row (some 200 bytes of memory a word); repeated rows
and ties are judged row by row; an empty table gives an empty ledger; further columns
are kept unless they carry the name of a ledger column, which then replaces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import SPACES, bound, number, numbered, plain_words, restored

SYMBOL = "[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
BASE_RULES = ("few_words", "repeated_words")
#: Rule -> condition on the measures under which a text fails. Integers only, so that
#: every engine decides alike.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
    "duplicate_lines": "10 * n_dup_lines > 4 * n_lines",
}
#: Version -> rules it enforces.
POLICIES = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "symbols", "duplicate_lines"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def policy_bits(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def _measured(df: DataFrame, text: str) -> DataFrame:
    """Adds the measures. Windows of three words are sorted as (hash, position) in one long;
    neighbours of equal hash are compared word by word before they count. What repeated
    windows cover is summed over their sorted starts, each as far as the next.

    Arrays as long as the text are dropped as soon as the next step has what it needs, so that
    a text of n words holds a few times n numbers at once and no object per window and word."""
    blank = F.lit(SPACES)
    whole = F.coalesce(F.col(text), F.lit(""))
    df = bound(df, "_lines", F.filter(F.split(whole, "\n", -1), lambda x: F.btrim(x, blank) != ""))
    df = df.withColumns({
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOL)),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
    }).drop("_lines")
    df = bound(df, "_words", plain_words(F.col(text)))
    df = df.withColumns({"n_words": F.size("_words"), "word_chars": F.length(F.concat_ws("", "_words"))})
    # In SQL, shifts take columns.
    df = df.withColumn("_bits", F.length(F.bin(F.col("n_words").cast("long"))))
    packed = F.expr(
        "sort_array(transform(sequence(0, n_words - 3), i -> shiftleft(shiftright("
        "xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2)), _bits), _bits) | i))"
    )
    df = bound(df, "_sorted", F.when(F.col("n_words") >= 4, packed).otherwise(F.array().cast("array<bigint>")))

    def place(j: str) -> str:
        return f"cast(get(_sorted, {j}) & (shiftleft(1L, _bits) - 1) as int)"

    def twins(j: str) -> str:
        """Whether windows j - 1 and j are equal; null at either end."""
        words = " and ".join(f"get(_words, {place(j)} + {k}) = get(_words, {place(f'{j} - 1')} + {k})" for k in range(3))
        return f"(shiftrightunsigned(get(_sorted, {j}) ^ get(_sorted, {j} - 1), _bits) = 0 and {words})"

    starts = F.expr(
        f"sort_array(transform(filter(sequence(0, size(_sorted) - 1), j -> {twins('j')} or {twins('j + 1')}), j -> {place('j')}))"
    )
    df = bound(df, "_starts", F.when(F.size("_sorted") > 0, starts).otherwise(F.array().cast("array<int>")))
    df = df.drop("_words", "_sorted", "_bits")
    covered = F.expr(
        "aggregate(sequence(1, size(_starts)), 0L, (n, j) -> n + least(3, coalesce(get(_starts, j) - get(_starts, j - 1), 3)))"
    )
    df = df.withColumn("n_repeat_words", F.when(F.size("_starts") > 0, covered).otherwise(0)).drop("_starts")
    return df.withColumns({name: F.col(name).cast("long") for name in MEASURES})


def _judged_rows(df: DataFrame, names: list[str], text: str, policy: str) -> DataFrame:
    df = _measured(df, number(names, text))
    bits = F.expr(" | ".join(f"if({rule}, {bit(name)}L, 0L)" for name, rule in RULES.items()))
    df = df.withColumn("fail_bits", bits)
    df = df.withColumn("base_failed", F.col("fail_bits").bitwiseAND(F.lit(policy_bits("base"))) != 0)
    return df.withColumn("kept", judged(F.col("fail_bits"), policy))


def ledger(df: DataFrame, text: str = "text", policy: str = CURRENT) -> DataFrame:
    """``df`` with measures, ``fail_bits``, ``base_failed`` and ``kept`` under ``policy``."""
    rows, names = numbered(df)
    return restored(_judged_rows(rows, names, text, policy), names, *MEASURES, "fail_bits", "base_failed", "kept")


def passing(df: DataFrame, text: str = "text", policy: str = CURRENT) -> DataFrame:
    """The rows of ``df`` that pass ``policy``, with their own columns."""
    rows, names = numbered(df)
    return restored(_judged_rows(rows, names, text, policy).where("kept"), names)


def judged(fail_bits: Column, policy: str) -> Column:
    """Whether a stored row passes ``policy``; the base rules always hold."""
    return fail_bits.bitwiseAND(F.lit(policy_bits(policy) | policy_bits("base"))) == 0


def ablations(stored: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of ``policy``: texts that fail it, and texts kept if only it were dropped.

    Rows are first counted per bit pattern, of which there are at most 2^rules.
    """
    mask = policy_bits(policy)
    patterns = stored.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit")) for r in POLICIES[policy]])
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept"),
    )
