from __future__ import annotations

from decimal import ROUND_DOWN, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybook.functions import decimals, keys, text, times


def one(spark, expression, **values):
    rows = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in values))
    return rows.selectExpr(f"{expression} as x").first()["x"]


@pytest.mark.parametrize(
    ("given_text", "kept"),
    [
        ("1.123456789", "1.12345678"),
        ("-1.123456789", "-1.12345678"),
        ("-0.000000009", "0"),
        ("15", "15"),
        ("15.", "15"),
        ("1.26e-7", "0.00000012"),
        ("15E-9", "0.00000001"),
        ("0.99999999999999999999999999999", "0.99999999"),
        ("9.9999999999999999999e-1", "0.99999999"),
        ("-12345678901234567890.5e-12", "-12345678.90123456"),
        (" 1.5 ", "1.5"),
        (".5", "0.5"),
        ("+5e0", "5"),
        ("0e999", "0"),
        ("123e-99999999999", "0"),
        ("1.5e+3", "1500"),
    ],
)
def test_surplus_digits_are_dropped(spark, given_text, kept):
    assert one(spark, decimals.money("t"), t=given_text) == Decimal(kept)


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(-(10**12), 10**12), st.integers(0, 14), st.sampled_from(["", "e-2", "E+1"])),
        min_size=20,
        max_size=40,
    )
)
def test_text_is_cut_like_exact_arithmetic(spark, numbers):
    texts = [f"{Decimal(n).scaleb(-s):f}{e}" for n, s, e in numbers]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.x for r in rows.selectExpr("t", f"{decimals.from_text('t', 38, 8)} as x").collect()}
    for t in texts:
        assert found[t] == Decimal(t).quantize(Decimal("1e-8"), rounding=ROUND_DOWN), t


@settings(max_examples=4, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(-(10**9), 10**9), st.integers(0, 14), st.sampled_from(["", "e-2", "x", "BTC", ".1", " 1", "e", "E+", "-"])
        ),
        min_size=20,
        max_size=40,
    )
)
def test_malformed_tails_give_null(spark, numbers):
    texts = [f"{Decimal(n).scaleb(-s):f}" + tail for n, s, tail in numbers]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.x for r in rows.selectExpr("t", f"{decimals.from_text('t', 38, 8, 'null')} as x").collect()}
    for t in texts:
        try:
            expected = Decimal(t).quantize(Decimal("1e-8"), rounding=ROUND_DOWN)
        except ArithmeticError:
            expected = None
        assert found[t] == expected, t


def test_rate_is_cut_to_four_digits(spark):
    assert one(spark, decimals.rate("cast(t as decimal(18,8))"), t="0.90019999") == Decimal("0.9001")


def test_quotient_is_cut(spark):
    assert one(spark, decimals.quotient("t", "3"), t="2") == Decimal("0.66666666")
    assert one(spark, decimals.quotient("t", "3"), t="-2") == Decimal("-0.66666666")


@pytest.mark.parametrize(
    "malformed",
    ["", "n/a", "1,234", "none", "0.12345678BTC", "0.1234567BTC", "0.12345678.9.9", "1.23456789 1", "1e", "e5", "1e5x"]
    + ["1.2.3e4", ".", "+", "1.123456789e1.5", "--1"],
)
def test_malformed_number_raises_or_is_null(spark, malformed):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        one(spark, decimals.money("t"), t=malformed)
    assert one(spark, decimals.money("t", on_error="null"), t=malformed) is None


def test_null_number_stays_null(spark):
    assert one(spark, decimals.money("nullif(t, 'x')"), t="x") is None


@pytest.mark.parametrize(
    ("amount", "digits", "strict", "coin"),
    [
        ("0.0010BTC", "0.0010", "0.0010", "BTC"),
        ("10BTC", "", "10", "BTC"),
        ("100BTC", "100", "100", "BTC"),
        ("1,234.5BTC", "1,234", "1", "BTC"),
        ("2.51INCH", "2.51", "2.51", "INCH"),
        ("", "", "", ""),
    ],
)
def test_amount_text(spark, amount, digits, strict, coin):
    assert one(spark, text.amount_text("t"), t=amount) == digits
    assert one(spark, text.amount_text("t", strict=True), t=amount) == strict
    assert one(spark, text.coin_text("t"), t=amount) == coin


@pytest.mark.parametrize("amount", ["10BTC", "1,234.5BTC"])
def test_amount_without_a_plain_number_raises(spark, amount):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, decimals.money(text.amount_text("t")), t=amount)


def test_amount_of_null_is_null(spark):
    assert one(spark, decimals.money(text.amount_text("nullif(t, 'x')")), t="x") is None


def test_key_is_null_with_a_null_part(spark):
    assert one(spark, keys.key_text("'a'", "t", "7"), t="b") == "a_b_7"
    assert one(spark, keys.key_text("'a'", "nullif(t, 'b')"), t="b") is None


def test_hash_is_lower_case_md5(spark):
    assert one(spark, keys.hashed("t"), t="abc") == "900150983cd24fb0d6963f7d28e17f72"


def test_times(spark):
    def shown(expression, value):
        return one(spark, f"cast({expression} as string)", t=value)

    assert shown(times.second_from_millis("t"), "1704067200999") == "2024-01-01 00:00:00"
    assert shown(times.from_millis("t"), "1704067200999") == "2024-01-01 00:00:00.999"
    assert shown(times.from_iso("t"), "2024-01-01T00:00:00.123456Z") == "2024-01-01 00:00:00.123"
    assert shown(times.from_iso_or_null("t"), "2024-01-01T00:00:00.123456Z") == "2024-01-01 00:00:00.123456"
    assert shown(times.from_iso_or_null("t"), "n/a") is None
    assert shown(times.berlin("cast(t as timestamp)"), "2024-07-01 00:00:00") == "2024-07-01 02:00:00"
    # The minute is one of UTC also around the change to summer time in Berlin.
    assert shown(times.minute("cast(t as timestamp)"), "2024-03-31 01:30:59") == "2024-03-31 01:30:00"
