from memberlens.operators import hotwords as HW


def test_java_split_semantics(spark):
    lines = spark.createDataFrame([("a\tb\tc\td",), ("a\tb\t",), ("a\tb\t\td",), ("",), ("\t\t\t",),
                                   ("x\ty\tc",)], "value string")
    counts = {r.word: r.searchCount for r in HW.word_counts(lines).collect()}
    assert counts == {"c": 2, "null": 3, "": 1}
    top = HW.hot_words(lines, k=2).collect()
    assert [(r.word, r.searchCount) for r in top] == [("null", 3), ("c", 2)]
    assert HW.hot_words_malformed(lines).count() == 3


def test_ties_broken_by_word(spark):
    lines = spark.createDataFrame([("t\tu\tb",), ("t\tu\ta",)], "value string")
    assert [r.word for r in HW.hot_words(lines, k=1).collect()] == ["a"]


def _java_split_tab(s):
    """Java String.split("\\t"): trailing empty strings removed; "" -> [""]."""
    if s == "":
        return [""]
    parts = s.split("\t")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_word_counts_match_java_split_model(spark):
    from collections import Counter

    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=10, deadline=None)
    @given(st.lists(st.text(alphabet="ab\t", max_size=7), min_size=1, max_size=30))
    def check(lines):
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        model = Counter((p[2] if len(p) > 2 else "null") for p in map(_java_split_tab, lines))
        got = {r.word: r.searchCount for r in HW.word_counts(df).collect()}
        assert got == dict(model)
        malformed = sorted(x for x in lines if len(_java_split_tab(x)) <= 2)
        assert sorted(r.line for r in HW.hot_words_malformed(df).collect()) == malformed

    check()


def test_fields_end_at_the_text_not_at_a_line_end(spark):
    """As Java's split: only empty fields at the very end go."""
    lines = spark.createDataFrame([("a\tb\t\r",), ("a\tb\t\u2028",), ("a\tb\t\t",)], "value string")
    from memberlens.operators import hotwords as HW
    assert {r.word for r in HW.word_counts(lines).collect()} == {"\r", "\u2028", "null"}
