import pytest

SF = "/root/testdata/sf0.001"
ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, "
              "n_words long, digest string, key long, `a.b` string, vector string, dropped long, host string, counts long")


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    copy = "The same words stand here in both of these texts, one after the other, and they go on for a while."
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(40_000)) + "x" * 100_000
    rows = [(1, copy), (2, copy), (2, copy), (3, copy + " More."), (4, None), (5, ""), (6, "   \n\t "), (7, "one"), (8, "one two"),
            (9, long), (None, copy), (None, None), (10, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich 𐍈 ▁ ok"),
            (11, "\\### User: </turn> <|endoftext|> <s>"), (12, "a\x00b\x85c d"), (13, "Licensed under CC BY-SA 4.0.\nAll rights reserved."),
            (14, "spam " * 60), (15, "ONE TWO!! " * 8 + "\nline\nline\nline")]
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 2}", k, 0.5, k % 2 == 0, 7, "d", 1, "x", "v", 1, "h", 2) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
