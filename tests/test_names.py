import pytest

from creditloom.functions.names import (
    find_target,
    rename_all,
    snake_case,
    standardise_columns,
    warehouse_name,
)
from creditloom.vocabulary import TARGET


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("LIMIT_BAL", "limit_bal"),
        ("PAY-0", "pay_0"),
        ("default payment next month", TARGET),
        ("default.payment.next.month", TARGET),
        ("  Bill  Amt1 ", "bill_amt1"),
        ("a__b", "a_b"),
    ],
)
def test_snake_case(raw, expected):
    assert snake_case(raw) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("LIMIT_BAL (NT$)", "limit_bal_nt"), ("_x  y_", "x_y"), ("PAY--0", "pay_0")],
)
def test_warehouse_name(raw, expected):
    assert warehouse_name(raw) == expected


def test_target_is_canonical_for_every_spelling(spark):
    for spelling in ("default.payment.next.month", "Y", "default payment next month"):
        df = spark.createDataFrame([(1, 0)], ["LIMIT_BAL", spelling])
        assert standardise_columns(df).columns == ["limit_bal", TARGET]


def test_find_target():
    assert find_target(["ID", "default payment next month"]) == "default payment next month"
    assert find_target(["ID", "Y"]) == "Y"
    assert find_target(["ID", "is_defaulted"]) == "is_defaulted"
    with pytest.raises(KeyError):
        find_target(["ID", "age"])


def test_merging_names_is_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["a-b", "a b"])
    with pytest.raises(ValueError, match="a_b"):
        rename_all(df, snake_case)
