"""Property test of the quote-aware splitter (C7): items are made first, joined with commas, and
must come back."""

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import one_col
from feedworks import functions as fx

PLAIN = st.text(alphabet="abc \t\n", min_size=1, max_size=6)
INNER = st.text(alphabet="abc ,\t", max_size=6)


def both_ways(items):
    """(the cell, its items without blanks around them and without empty ones)"""
    blank = "".join(map(chr, range(33)))
    return ",".join(items), [i.strip(blank) for i in items if i.strip(blank)]


# each: an item that a comma inside quotes, or a quote after a backslash, must not end
COMPAT_ITEM = st.one_of(
    PLAIN,
    INNER.map(lambda t: f'"{t}"'), INNER.map(lambda t: f"'{t}'"),
    st.tuples(PLAIN, INNER, PLAIN).map(lambda t: f'{t[0]}"{t[1]}"{t[2]}'),
    st.tuples(INNER, INNER).map(lambda t: f"\"{t[0]}'{t[1]}\""),        # the other quote inside
    st.tuples(INNER, INNER).map(lambda t: f'"{t[0]}\\"{t[1]}"'),         # an escaped quote inside
    PLAIN.map(lambda t: t + '\\"'), PLAIN.map(lambda t: "\\'" + t))    # one outside opens nothing
REPAIRED_ITEM = st.one_of(
    PLAIN, INNER.map(lambda t: f'"{t}"'), PLAIN.map(lambda t: f"don't {t}"),
    st.tuples(INNER, INNER).map(lambda t: f'"{t[0]}\\"{t[1]}"'),
    PLAIN.map(lambda t: t + "\\,x"),                                     # an escaped comma ends nothing
    PLAIN.map(lambda t: t + '\\"'))
OPEN = st.tuples(st.sampled_from(["", "a"]), INNER).map(lambda t: f'{t[0]}"{t[1]}')  # runs to the end


def cells(item):
    whole = st.lists(item, max_size=5)
    return st.tuples(whole, st.one_of(st.none(), OPEN)).map(lambda t: both_ways([*t[0], *([t[1]] if t[1] else [])]))


@settings(max_examples=1, deadline=None)
@given(st.lists(cells(COMPAT_ITEM), min_size=150, max_size=150), st.lists(cells(REPAIRED_ITEM), min_size=150, max_size=150))
def test_items_come_back(spark, compat, repaired):
    for made, mode in ((compat, True), (repaired, False)):
        df = one_col(spark, [text for text, _ in made])
        assert [r[0] for r in df.select(fx.split_quoted("v", compat=mode)).collect()] == [items for _, items in made]


def test_known_cells(spark):
    texts = ["a,\"b,c\",d", "don't, stop", "a\\\",b", "'x,y", "\\", "\"\\\"\",z", ",, ,", ""]
    df = one_col(spark, texts)
    assert [r[0] for r in df.select(fx.split_quoted("v", compat=True)).collect()] == [
        ["a", '"b,c"', "d"], ["don't, stop"], ['a\\"', "b"], ["'x,y"], ["\\"], ['"\\""', "z"], [], []]
    assert [r[0] for r in df.select(fx.split_quoted("v", compat=False)).collect()] == [
        ["a", '"b,c"', "d"], ["don't", "stop"], ['a\\"', "b"], ["'x", "y"], ["\\"], ['"\\""', "z"], [], []]
