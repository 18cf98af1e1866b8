import pytest
from pyspark.sql import functions as F

ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "word",
    "Ünïcödé tëxt ist schön, 東京 🙂 и привет\r\nzweite Zeile\n\n",
    "repeat " * 3000,
    "x" * 40_000,
    "line one here\nline two here\nline one here\nline two here\n",
    "a\x00b \x1c\x85\xa0c",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, long and repeated texts and ids, in a table with columns named like those that are added."""
    rows = [(i, t, "en", "s") for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "word", "en", "s"), (3, "other", None, None), (None, "no id here", "de", "s"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(3)
    added = "found print n_words kept size key sources taken n_lines n_removed id part extra a b n_chars label places"
    for name in added.split():
        df = df.withColumn(name, F.lit(7))
    return df


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("doc_id < 0")
