"""Masks that cannot collide: permutations of the values of one shape, alike in both engines."""

from __future__ import annotations

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maskwright import ColumnRule, MaskContext, mask, mask_column
from maskwright.functions.key_permutation import kind, permuted
from maskwright.operators import audit
from maskwright.operators import dictionary as dic

RULE = "Standard - Unique"


def column(spark, values, context, type_="string", flag="Y"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r["v"] for r in mask_column(df, "v", RULE, context, flag).orderBy("i").collect()]


@pytest.mark.parametrize("values", [
    [str(i) for i in range(10, 100)], [str(i) for i in range(10_000)], [str(-i) for i in range(1, 100)],
    [f"{i:03d}" for i in range(100)], ["".join(p) for p in itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=2)],
    [f"{a}-{b}é" for a in "XYZABCDEFGHIJKLMNOPQRSTUVW" for b in range(10)], ["-0"], ["", "-", "é"],
])
def test_every_value_is_the_mask_of_one(values):
    for tag in ("one", "two"):
        assert sorted(permuted(values, tag)) == sorted(values)
    assert len(values) < 10 or permuted(values, "one") != permuted(values, "two")


def test_null_is_no_mask():
    shape = ["".join(p) for p in itertools.product("nul", repeat=4)]
    found = permuted(shape, "t")
    assert dict(zip(shape, found))["null"] == "null" and found.count("null") == 1 and len(set(found)) == len(shape)


def test_kinds():
    assert [kind(t) for t in ("null", "0", "-0", "007", "32767", "32768", "-32768", "2147483648", str(1 << 63), "1.5", "٣")] == [
        -1, 16, 0, 0, 16, 32, 16, 64, 0, 0, 0]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F, exclude_characters="\x00"), max_size=50), min_size=1, max_size=20))
def test_both_engines_agree_and_keep_the_shape(spark, values):
    results = [column(spark, values, MaskContext("k", project="p", text_engine=e)) for e in ("arrow", "columns")]
    assert results[0] == results[1]
    for before, after in zip(values, results[0]):
        assert len(before) == len(after) and kind(before) == kind(after)
        for b, a in zip(before, after):
            same = next((s for s in (str.isupper, str.islower, str.isdigit) if b.isascii() and s(b)), None)
            assert same(a) if same else a == b


def test_engines_agree_on_keys_of_all_types(spark):
    numbers = [0, 7, -7, 42, 127, 128, 32767, -32768, 40000, 99999, 1_234_567_890, 2_147_483_647, None]
    big = [*numbers, 3_000_000_000, (1 << 63) - 1, -(1 << 63)]
    texts = ["Customer#000000001", "a" * 70 + "B9", "10.0.0.1", "null", "NULL", "007", None]
    engines = [MaskContext("k", project="p", text_engine=e) for e in ("arrow", "columns")]
    for type_, values in (("int", numbers), ("bigint", big), ("string", texts), ("string", [None if v is None else str(v) for v in big])):
        one, other = (column(spark, values, c, type_) for c in engines)
        assert one == other
    whole = column(spark, big, engines[0], "bigint")
    assert column(spark, numbers, engines[0], "int") == whole[: len(numbers)]
    assert column(spark, [None if v is None else str(v) for v in big], engines[0]) == [None if v is None else str(v) for v in whole]


def test_scopes_differ(spark):
    context = MaskContext("k", project="p", run_id="r")
    values = [f"key-{i}" for i in range(50)]
    lasting, single = column(spark, values, context), column(spark, values, context, flag="N")
    assert lasting != single and lasting != column(spark, values, MaskContext("other", project="p"))


def test_no_collisions_and_joins_stay(spark, context):
    parent = spark.range(1000).select(F.col("id").alias("k"))
    child = spark.range(9000).select((F.col("id") % 1000).cast("int").alias("k"), F.col("id").alias("v"))
    assert audit.collisions(parent, "k", RULE, context).count() == 0
    a, b = (mask_column(d, "k", RULE, context) for d in (parent, child))
    assert sorted(r["k"] for r in a.collect()) == list(range(1000))  # shapes are mapped onto themselves
    assert a.join(b, "k").count() == 9000


def test_unsupported_types_are_rejected(spark, context):
    for type_ in ("tinyint", "double", "decimal(9,2)", "date"):
        df = spark.createDataFrame([], f"v {type_}")
        with pytest.raises(ValueError, match="does not support"):
            mask(df, [ColumnRule("v", RULE)], context)


def test_keys_have_their_own_dictionary_entries(spark, context):
    df = spark.createDataFrame([("ab12", "ab12")], "k string, v string")
    rules = [ColumnRule("k", RULE), ColumnRule("v", "Standard")]
    found = dic.new_entries([(df, rules)], context, dic.empty_dictionary(spark))
    assert {r["scope"] for r in found.collect()} == {"project:p", "project:p/key"}
    assert dic.new_entries([(df, rules)], context, found).count() == 0
