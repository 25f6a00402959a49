import public_tokenizers
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # names that operators could use for columns of their own
        StructField("row", LongType()),
        StructField("value", StringType()),
        StructField("size", LongType()),
    ]
)
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` rows, with columns of clashing names."""

    def make(rows):
        full = []
        for doc_id, text, *more in rows:
            lang, source = more or ("en", f"src{(doc_id or 0) % 5}")
            full.append((doc_id, text, lang, source, len(text) if text is not None else None, 1, "v", 2))
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"word{k % 977} other{k % 31}" for k in range(30_000))
    return [(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (None, None), (4, long_text), (5, "same text"), (5, "same text"), (6, "same text"), (-7, "é 中 ñ")]


