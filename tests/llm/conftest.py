import pytest

MESSY = [
    (0, "Alpha beta gamma, delta. It's 12,5 don't\nNext  line\twith tabs \n\n end"),
    (1, None), (2, ""), (3, "日本語のテキスト ﬁ straße İstanbul <|endoftext|> tail"), (4, "a" * 5000 + " " + "ab " * 3000),
    (5, "To " * 400 + "lyndin " * 90), (None, "an id that is null"), (7, "repeated row"), (7, "repeated row"),
    (9, "été où ça, ñandú. Él\nß Ä"), (12, " leading and trailing "), (13, "\n\n\n"), (14, "x\x1cy z w"),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, repeated rows, extra columns whose names clash with the operators' own."""
    rows = [(d, t, "en", "src", 1, 2.0, "k") for d, t in MESSY]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, start int, score double, shard string")


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def sample(spark):
    """The given documents at the smallest scale, as rows and as a table."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()]
