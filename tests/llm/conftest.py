import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside, as columns of the input.
CLASHING = ["_row", "w", "kept", "score", "h", "fp", "root", "node", "spans", "base", "_k1", "ids", "sequence_id"]

TEXTS = [
    None,
    "",
    " ",
    "\n\t \x0b",
    "one",
    "One TWO three four five. One TWO three four five.\nOne TWO three four five.",
    "Ünïcode wörds straße 日本語 é😀 ñandú  double   triple spaces ",
    "123 456 !!! ###",
    " ".join(f"word{i}" for i in range(300)),
    "token=abcdefgh password: abcd user=alice https://example.org/x AKIA" + "A1B2" * 4,
    "x" * 5000,
]


def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "src", len(t or "")) for i, t in enumerate(TEXTS)]
    long = " ".join(f"w{i % 977} q{i % 13}" for i in range(60_000))
    rows += [(100, long, "en", "src", len(long)), (None, "no id here at all", None, None, None), (None, None, None, None, None)]
    return rows + rows[4:7] + [(8, TEXTS[8], None, None, None), (200, TEXTS[8], "de", "src", 1)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(2)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def clashing_docs(spark, odd_docs):
    from pyspark.sql import functions as F

    return odd_docs.withColumns({c: F.lit(7) for c in CLASHING})


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
