import pytest

SF001 = "/root/testdata/sf0.001"


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and an extra column named like an operator's own."""
    line = "this passage of boilerplate is long enough to be a line key"
    rows = [(1, None), (2, ""), (3, "a\n\n b"), (4, "Ünïcode " * 3), (5, " ".join(f"w{i}" for i in range(5000))),
            (6, "x" * 20000), (7, "tie"), (7, "tie"), (7, "other"), (None, "no id"), (None, None), (8, "\n" * 50)]
    rows += [(100 + i, f"{line}\nown {i}\n  {line.upper()}  ") for i in range(8)]
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, 2) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars int, pos int, doc int")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
