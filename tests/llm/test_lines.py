import random

from roadflow.llm import lines
from tests.llm.conftest import documents


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_variable_fields_and_first_document(shipped):
    same = "user 17 logged in from host alpha at noon"
    rows = [
        (2, "own words of the second one here\nuser 4 logged in from host alpha at noon\nshort"),
        (1, f"first text that nobody else has\n{same}\nshort"),
        (3, "user 99 logged in from host alpha at noon"),
    ]
    got = texts(lines.drop_recurring_lines(documents(shipped, rows)))
    assert got == {1: rows[1][1], 2: "own words of the second one here\nshort", 3: ""}


def test_words_that_differ_are_a_field(shipped):
    rows = [(i, f"the server said hello to {name} in a very polite way today") for i, name in enumerate(["ann", "bob", "cleo"])]
    got = texts(lines.drop_recurring_lines(documents(shipped, rows)))
    assert got == {0: rows[0][1], 1: "", 2: ""}


def test_unlike_lines_of_one_leaf_stay(shipped):
    rows = [(1, "a b c one two three four five"), (2, "a b c six seven eight nine ten")]
    assert texts(lines.drop_recurring_lines(documents(shipped, rows))) == dict(rows)


def test_repeats_inside_one_document_stay(shipped):
    rows = [(1, "\n".join(["again and again the same line"] * 3))]
    assert texts(lines.drop_recurring_lines(documents(shipped, rows))) == dict(rows)


def test_odd_rows(odd, none):
    out = lines.drop_recurring_lines(odd)
    assert {"lang", "source", "n_chars", "words", "rep"} <= set(out.columns)
    rows = out.collect()
    assert len(rows) == odd.count()
    # The row without an id counts as the first document and keeps the shared line.
    shared = [(r.doc_id, r.text, r.n_dropped) for r in rows if r.doc_id in (None, 1, 5)]
    assert sorted(shared, key=str) == sorted([(None, "one two three four five six seven", 0), (1, "", 1), (5, "", 1), (5, "", 1)], key=str)
    assert [(r.text, r.n_lines, r.n_dropped) for r in rows if r.doc_id == 2] == [(None, 0, 0)]
    assert lines.drop_recurring_lines(none).count() == 0


def test_fields_whose_values_recur_stay_fields(shipped):
    """Each pair of 20 names and 20 days once: all lines but the first go, however many there are."""
    line = "the shop closes early today because {} has to leave town before {} at noon"
    pairs = [(f"name{chr(97 + a)}", f"day{chr(97 + b)}") for a in range(20) for b in range(20)]
    for n in (20, 100, 400):
        rows = [(i, line.format(*pair)) for i, pair in enumerate(random.Random(n).sample(pairs, n))]
        got = texts(lines.drop_recurring_lines(documents(shipped, rows)))
        assert got == {0: rows[0][1]} | {i: "" for i in range(1, n)}


def test_exact_repeats_go_beside_many_other_lines(shipped):
    rows = [(i, "a b c " + " ".join(f"w{chr(97 + i)}{chr(97 + k)}" for k in range(6))) for i in range(20)]
    again = [(100 + i, t) for i, t in rows[:5]]
    got = texts(lines.drop_recurring_lines(documents(shipped, rows + again)))
    assert got == dict(rows) | {i: "" for i, _ in again}


def test_white_space_short_and_unspaced_lines(shipped):
    tabbed, unspaced = "one\ttwo\tthree\tfour\tfive\tsix", "\u4e00\u4e8c\u4e09" * 9
    rows = [(i, f"And so.\n{tabbed}\r\n{unspaced}\nrare{chr(97 + i)}\n\n  ") for i in range(25)]
    rows += [(50 + i, "Not often.") for i in range(19)]
    got = texts(lines.drop_recurring_lines(documents(shipped, rows)))
    assert got[0] == rows[0][1] and all(got[i] == f"rare{chr(97 + i)}\n\n  " for i in range(1, 25))
    assert all(got[50 + i] == "Not often." for i in range(19))


def test_columns_named_like_helpers(shipped):
    same = "a line that two documents have in common"
    df = documents(shipped, [(1, same), (2, same)]).selectExpr("*", "7 as _row", "8 as _gone", "9 as _doc", "1 as leaf", "2 as short")
    got = {r.doc_id: (r.text, r._row, r._gone) for r in lines.drop_recurring_lines(df).collect()}
    assert got == {1: (same, 7, 8), 2: ("", 7, 8)}
