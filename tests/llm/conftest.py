import pytest

from roadflow.session import ship_package

D = "/root/testdata/sf0.001"

#: Nulls, empty and long texts, ties and repeated rows, beside columns whose names the operators use.
ODD = [
    (1, "one two three four five six seven", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "   \n\n \t ", "de", "b", 3),
    (5, "one two three four five six seven", "en", "a", 1),
    (5, "one two three four five six seven", "en", "a", 1),
    (None, "one two three four five six seven", "en", None, 2),
    (6, "12 34 !!", "fr", "b", 4),
    (7, "word " * 60_000, "en", "c", 5),
    (8, "été où ça \U0001f600 Ünï İ ΣΣ 中文字", "fr", "c", 6),
]


@pytest.fixture(scope="session")
def shipped(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def odd(shipped):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return shipped.createDataFrame(ODD, schema).selectExpr("*", "1 as n_lines", "2.5D as score", "'x' as words", "7 as rep", "'k' as bits")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")
