import datetime as dt
from decimal import Decimal

from conftest import run
from feedworks import functions as fx


def test_safe_int_edges(spark):
    vals = [" 5 ", "+5", "-7", "12.9", "-12.9", "1e3", "1.0e3", "3000000000",
            "3000000000.0", ".", "n/a", "", None, "\t42\n", "12.", "-3000000000.5", "NaN.",
            "+", "1.5d"]
    exp = [5, 5, -7, 12, -12, None, 1000, None, 2147483647, None, None, None, None, 42, 12,
           -2147483648, None, None, 1]
    assert run(spark, vals, fx.safe_int) == exp


def test_safe_str_edges(spark):
    vals = [" a ", "\ta\t", "NULL", "Null", "x" * 201, "   ", None, "a😀b"]
    exp = ["a", "a", None, None, "x" * 200, None, None, "a😀b"]
    assert run(spark, vals, fx.safe_str) == exp


def test_safe_double_and_rounding(spark):
    vals = ["170.9", "0.5", "1.5", "2.5", "1e3", "x", "NaN", "nan", "inf", " 3.25 "]
    assert run(spark, vals, lambda c: fx.to_int_half_even(fx.safe_double(c))) == \
        [171, 0, 2, 2, 1000, None, None, None, None, 3]
    assert run(spark, vals, fx.safe_double)[:5] == [170.9, 0.5, 1.5, 2.5, 1000.0]


def test_decimal_3_1(spark):
    out = run(spark, ["4.25", "4.35", "123.4", "0", "-0.05"], lambda c: fx.to_decimal(fx.safe_double(c)))
    assert out == [Decimal("4.3"), Decimal("4.4"), None, Decimal("0.0"), Decimal("-0.1")]


def test_int_or_zero_and_str_or_empty(spark):
    assert run(spark, [" 7", "7.5", None, "x"], fx.int_or_zero) == [7, 0, 0, 0]
    assert run(spark, [" a ", "NULL", None], fx.str_or_empty) == ["a", "", ""]


def test_instant_and_date(spark):
    vals = ["1999-08-09T21:46:00Z", "1999-08-09T21:46:00+08:00", "1999-08-09",
            " 1999-08-09T21:46:00Z", "1999-08-09T21:46Z", "2019-02-30T00:00:00Z", None, "",
            "1999-08-09T01:00:00.123456789+03:00"]
    out = run(spark, vals, fx.parse_date)
    assert out == [dt.date(1999, 8, 9), dt.date(1999, 8, 9), None, None, None, None, None, None,
                   dt.date(1999, 8, 8)]


def test_normalize_list(spark):
    vals = ['c("a, b", "c ")', None, "c()", '"x",,  "y"', "plain"]
    assert run(spark, vals, fx.normalize_list) == [["a", "b", "c"], [], [], ["x", "y"], ["plain"]]
    assert run(spark, vals, fx.normalize_list_text) == ['["a","b","c"]', "[]", "[]", '["x","y"]',
                                                        '["plain"]']


def test_parse_ids(spark):
    vals = ["1, 2,x,,2", "NULL", "c(1,2,3)", "[1,2,3]", None, "  ", "12.0, 7"]
    assert run(spark, vals, fx.parse_ids) == [[1, 2, 2], [], [1, 2, 3], [1, 2, 3], [], [], [12, 7]]
    assert run(spark, vals, lambda c: fx.parse_ids(c, compat=True)) == \
        [[1, 2, 2], [], [2], [2], [], [], [12, 7]]


def test_split_quoted_compat(spark):
    vals = ['a,"b,c",d', "don't, stop", 'a\\",b', '"unclosed, still, one', " , ,", None]
    out = run(spark, vals, lambda c: fx.split_quoted(c, compat=True))
    assert out == [["a", '"b,c"', "d"], ["don't, stop"], ['a\\"', "b"],
                   ['"unclosed, still, one'], [], []]


def test_split_quoted_repaired(spark):
    out = run(spark, ["don't, stop", 'a,"b,c",d'], lambda c: fx.split_quoted(c, compat=False))
    assert out == [["don't", "stop"], ["a", '"b,c"', "d"]]


def test_parse_strs_modes(spark):
    vals = ['c("x", "y")', 'c("Dessert", "Low, fat")', 'c("x", null)', "c()", "[]", "NULL",
            '["a","b"]', "single", 'c("only")']
    rep = run(spark, vals, fx.parse_strs)
    assert rep == [["x", "y"], ["Dessert", "Low, fat"], ["x"], [], [], [], ["a", "b"], ["single"],
                   ["only"]]
    comp = run(spark, vals, lambda c: fx.parse_strs(c, compat=True))
    assert comp[0] == ['c("x"', '"y")']
    assert comp[3] == [""]          # a lone c() item keeps its empty content
    assert comp[5] == []
    assert comp[8] == ['"only"']


def test_parse_strs_cuts_items(spark):
    out = run(spark, ["y" * 300 + ", b"], fx.parse_strs)
    assert out == [["y" * 200, "b"]]


def test_decade(spark):
    assert run(spark, [0, 9, 10, 27, -15, None], fx.decade, "int") == [0, 0, 10, 20, -10, None]
    assert run(spark, [27], fx.decade_label, "int") == ["20-29"]


def test_safe_double_java_forms(spark):
    vals = ["0x1.8p1", "-Infinity", "inf", "INFINITY", "1e400", "+NaN", "nan", "1.0f", "", " 2 "]
    out = run(spark, vals, fx.safe_double)
    assert out[0] == 3.0 and out[1] == float("-inf") and out[2] is None and out[3] is None
    assert out[4] == float("inf") and out[5] != out[5] and out[6] is None
    assert out[7:] == [1.0, None, 2.0]
