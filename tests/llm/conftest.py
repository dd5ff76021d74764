import pytest

CORPUS = "/root/testdata/sf0.001"

EDGE = [
    (1, None),
    (2, ""),
    (3, "   \t \n "),
    (4, "one"),
    (5, "a b c d e f g"),
    (6, "a  b\tc d\ne f g"),
    (7, "a b c d e f g"),
    (None, "a b c d e f g"),
    (None, None),
    (8, "Ünïcödé – 漢字 🙂 wörds.\nAnd a line | with | bars | only\n*** ### ***"),
    (9, "word " * 30_000),
    (9, "word " * 30_000),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with clashing names."""
    rows = [(d, t, "en", None if d in (4, None) else f"src{d % 2}", 0, "x", 1, "y", 2) for d, t in EDGE]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, "
        "row_key string, quality int, `words.x` string, part int"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{CORPUS}/documents.parquet")


@pytest.fixture(scope="session")
def plain(corpus):
    return [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
