from __future__ import annotations

import datetime
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maskwright import ColumnRule, MaskContext, RuleContext, mask, mask_column, mask_where, register_rule, rule
from tests.plain import replaced, seed, standard

WORDS = ["Ana Lopez", "Anne-Marie O'Neil", "", "x", "Ünïcödé 漢字 Ⅷ²", "A", "aB1-éÉ漢²", "ABCDEFGHIJKLM",
         "a" * 40, "A" * 12 + "b" * 23, "0" * 30, "line\nbreak\ttab", "𝐀𝐛𝟗 z", "AAa AAAb Aa0Aa"]


def column(spark, values, rule_name, context, type_="string", flag="Y"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    rows = mask_column(df, "v", rule_name, context, flag).orderBy("i").collect()
    return [r["v"] for r in rows]


def test_standard_follows_the_definition(spark, context):
    assert column(spark, WORDS, "Standard", context) == [standard(w) for w in WORDS]


def test_golden_values(spark, context):
    assert column(spark, ["Customer#000000001", "Ana"], "Standard", context) == [
        standard("Customer#000000001"), standard("Ana"),
    ]
    assert standard("Ana") == "Scq"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F, exclude_characters="\x00"), max_size=60), min_size=1, max_size=40))
def test_both_engines_agree_and_keep_the_shape(spark, values):
    results = [
        column(spark, values, "Standard", MaskContext("test-key", project="p", text_engine=engine))
        for engine in ("arrow", "columns")
    ]
    assert results[0] == results[1]
    for before, after in zip(values, results[0]):
        if before == "null":
            assert after == before
            continue
        assert len(before) == len(after)
        for b, a in zip(before, after):
            if b.isupper():
                assert a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
            elif b.islower():
                assert a in "abcdefghijklmnopqrstuvwxyz"
            elif b.isdigit():
                assert a in "0123456789"
            else:
                assert a == b


def test_long_and_many_texts_cross_slices(spark, context):
    values = ["Word%d and More " % i * 3000 for i in range(40)] + ["", None, "tail"]
    result = column(spark, values, "Standard", context)
    assert result == [None if v is None else standard(v) for v in values]


def test_nulls_and_the_text_null_pass(spark, context):
    for name in ("Standard", "Email", "Email - Retain Domain", "Full Name", "Physical Address",
                 "IP Address", "IP Address - Ignore 10.", "Credit Card", "Age"):
        assert column(spark, [None, "null"], name, context) == [None, "null"]


def test_email(spark, context):
    values = ["user1@a.example.com", "no-at", "a@b@c", "@x", "y@"]
    assert column(spark, values, "Email", context) == [
        f"{standard('user1')}@{standard('a.example.com')}", standard("no-at"), standard("a@b@c"),
        f"@{standard('x')}", f"{standard('y')}@",
    ]
    assert column(spark, values, "Email - Retain Domain", context) == [
        f"{standard('user1')}@a.example.com", standard("no-at"), standard("a@b@c"), "@x",
        f"{standard('y')}@",
    ]


def test_full_name_agrees_with_its_parts(spark, context):
    whole = column(spark, ["Anne-Marie O'Neil", "Ana  Lopez", "Ⓐna"], "Full Name", context)
    assert whole[0] == f"{standard('Anne')}-{standard('Marie')} {standard('O')}'{standard('Neil')}"
    assert whole[1] == f"{standard('Ana')}  {standard('Lopez')}"
    assert "Ⓐ" not in whole[2]


def test_ip_address(spark, context):
    values = ["10.1.2.3", "100.1.2.3", "192.168.0.1"]
    assert column(spark, values, "IP Address", context) == [standard(v) for v in values]
    assert column(spark, values, "IP Address - Ignore 10.", context) == [
        "10.1.2.3", standard("100.1.2.3"), standard("192.168.0.1"),
    ]


def test_credit_card_is_valid(spark, context):
    cards = column(spark, [f"4{i:015d}" for i in range(300)], "Credit Card", context)
    assert len(set(cards)) == 300
    for card in cards:
        digits = [int(c) for c in card]
        assert re.fullmatch(r"4\d{15}", card)
        doubled = [d * 2 - 9 * (d > 4) for d in digits[0::2]]
        assert (sum(doubled) + sum(digits[1::2])) % 10 == 0


def test_address_looks_like_one(spark, context):
    for text in column(spark, [f"{i} Test Street" for i in range(50)], "Physical Address", context):
        assert re.fullmatch(r"\d{1,4} \w+ \w+\n\w+, [A-Z]{2} \d{5}", text)


def test_age(spark, context):
    ages = column(spark, list(range(200)), "Age", context, "int")
    assert all(18 <= a <= 100 for a in ages) and len(set(ages)) > 50
    assert ages[:3] == [18 + int(seed(str(i), "project:p/age")[:8], 16) % 83 for i in range(3)]
    texts = column(spark, ["7", "x"], "Age", context)
    assert texts[0] == str(ages[7])
    assert column(spark, [7.5, float("nan")], "Age", context, "double")[1] >= 18


def test_custom_rule_only_outside_ten(spark, context):
    rows = [(1, "Ana Lopez", "10.0.0.1"), (2, "Ana Lopez", "11.0.0.1"), (3, "Ana Lopez", None)]
    df = spark.createDataFrame(rows, "i int, name string, `IP Address v4` string")
    got = {r["i"]: r["name"] for r in mask_column(df, "name", "Custom Rule #1", context).collect()}
    hidden = f"{standard('Ana')} {standard('Lopez')}"
    assert got == {1: "Ana Lopez", 2: hidden, 3: hidden}


def test_rule_of_ones_own(spark, context):
    register_rule(mask_where("Adults", rule("Standard"), lambda: F.col("age") >= 18, ("age",)))
    df = spark.createDataFrame([("Ana", 30), ("Bo", 3), ("Cy", None)], "name string, age int")
    assert [r["name"] for r in mask_column(df, "name", "Adults", context).collect()] == [
        standard("Ana"), "Bo", standard("Cy"),
    ]


NUMBERS = [
    ("tinyint", [0, 7, -5, 127, -128, 100]),
    ("smallint", [0, 32767, -32768, 123]),
    ("int", [0, 2147483647, -2147483648, 90, 1234567890]),
    ("bigint", [0, 9223372036854775807, -9223372036854775808, 123456789012, 5]),
]


@pytest.mark.parametrize("type_,values", NUMBERS)
def test_integers_keep_type_and_fit(spark, context, type_, values):
    got = column(spark, values, "Standard", context, type_)
    for before, after in zip(values, got):
        masked = standard(str(before))
        if int(masked) == after:
            continue
        # The digits in front were replaced so that the number fits.
        assert str(after).lstrip("-").startswith("10" if type_ == "tinyint" else "1")
        assert masked.endswith(str(after)[-1])
        assert (after < 0) == (before < 0)


def test_integer_and_text_keys_agree(spark, context):
    numbers = column(spark, list(range(500)), "Standard", context, "bigint")
    texts = column(spark, [str(i) for i in range(500)], "Standard", context)
    assert numbers == [int(t) for t in texts]


def test_doubles(spark, context):
    plain = [0.0, 12.5, -3.25, 9999.99, 0.015, 1234567.891]
    got = column(spark, plain, "Standard", context, "double")
    assert got == [float(standard(repr(v))) for v in plain]
    strange = column(spark, [float("nan"), float("inf"), None], "Standard", context, "double")
    assert strange[0] != strange[0] and strange[1:] == [float("inf"), None]


def test_doubles_with_an_exponent_keep_it(spark, context):
    texts = ["1.0E-7", "2.0E-7", "3.0E-9", "-1.234567890123456E-5", "1.234567890123456E-5", "1.5E20", "-2.0E7", "1.0E300"]
    got = column(spark, [float(t) for t in texts], "Standard", context, "double")
    assert len(set(got)) == len(texts)
    scope = context.scope("Y")
    for text, value in zip(texts, got):
        mantissa, exponent = text.split("E")
        assert value == float(f"{replaced(mantissa, seed(text, scope))}E{exponent}")


def test_a_double_too_large_to_hold_is_an_error(spark, context):
    with pytest.raises(Exception, match="does not fit double"):
        column(spark, [1.0e308 + i * 1e306 for i in range(20)], "Standard", context, "double")


def test_decimals(spark, context):
    values = [Decimal("12.34"), Decimal("-0.50"), Decimal("99999999.99")]
    got = column(spark, values, "Standard", context, "decimal(10,2)")
    assert got == [Decimal(standard(str(v))) for v in values]
    fraction = column(spark, [Decimal("0.500"), Decimal("-0.123")], "Standard", context, "decimal(3,3)")
    assert all(abs(f) < 1 for f in fraction) and fraction[1] < 0


def test_unsupported_types_are_refused(spark, context):
    df = spark.createDataFrame(
        [(datetime.datetime(2024, 1, 1), True, [1], b"x", 5)],
        "t timestamp, b boolean, a array<int>, y binary, n int",
    )
    for name in "tbay":
        with pytest.raises(ValueError, match="does not support"):
            mask_column(df, name, "Standard", context)
    for name in ("Full Name", "Credit Card", "Physical Address", "IP Address"):
        with pytest.raises(ValueError, match="does not support"):
            mask_column(df, "n", name, context)


def test_two_rules_for_a_column_are_refused(spark, context):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(ValueError, match="more than one rule"):
        mask(df, [ColumnRule("v", "Standard"), ColumnRule("v", "Email")], context)


def test_other_columns_and_order_stay(spark, context):
    df = spark.createDataFrame([(1, "x", "a.b", 2.5)], "k int, `odd name` string, `d.o.t` string, z double")
    result = mask(df, [ColumnRule("d.o.t", "Standard")], context)
    assert result.columns == df.columns
    assert tuple(result.first()) == (1, "x", standard("a.b"), 2.5)


def test_scopes(spark, context):
    lasting = column(spark, ["Ana Lopez"], "Standard", context)
    once = column(spark, ["Ana Lopez"], "Standard", context, flag="N")
    again = MaskContext("test-key", "p", "r2", context.text_engine)
    assert lasting == [standard("Ana Lopez")]
    assert once == [standard("Ana Lopez", "run:p/r1")]
    assert column(spark, ["Ana Lopez"], "Standard", again, flag="N") == [standard("Ana Lopez", "run:p/r2")]
    other_key = MaskContext("another", "p", "r1", context.text_engine)
    assert column(spark, ["Ana Lopez"], "Standard", other_key) == [standard("Ana Lopez", key="another")]


def test_the_key_is_required_and_not_shown():
    with pytest.raises(ValueError):
        MaskContext("")
    assert "secret" not in repr(MaskContext("secret"))


def test_expression_form_equals_staged_form(spark, context):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("Ana", 12.5), (None, -1.0)], "s string, d double")
    one = df.select(
        rule("Standard")("s", RuleContext(context)).alias("s"),
        rule("Standard")("d", RuleContext(context, T.DoubleType())).alias("d"),
    )
    two = mask(df, [ColumnRule("s", "Standard"), ColumnRule("d", "Standard")], context)
    assert one.collect() == two.collect()


def test_the_same_masks_on_a_stream(spark, context, tmp_path):
    """Nothing in a rule needs more than its row, so streams are masked alike."""
    df = spark.createDataFrame([("Ana Lopez", 12.5, 40), (None, -1.0, 7)], "s string, d double, a int")
    df.write.parquet(str(tmp_path / "in"))
    rules = [ColumnRule("s", "Full Name"), ColumnRule("d", "Standard"), ColumnRule("a", "Age")]
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        mask(source, rules, context).writeStream.trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .format("parquet").start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, mask(df, rules, context).collect()))
