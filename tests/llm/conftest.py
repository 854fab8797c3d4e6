import pytest
from pyspark.sql import functions as F

HEX40 = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
LONG = " ".join(f"word{i % 977} thing{i % 1013}," for i in range(30_000))
PROSE = "The old harbour master walked slowly along the quay and counted every boat that had come home before the storm broke over the bay"

#: Texts by id: nulls, empty and blank ones, one very long, repeats, ties.
TEXTS = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "two words"), (6, PROSE), (7, PROSE), (8, PROSE + " today"),
    (9, PROSE.upper()), (10, LONG), (11, "### $$$ &&& ***"), (12, "a b c d e f g h " * 6), (13, "line\nline\n\nline \nline"),
    (14, f'token = "{HEX40}"'), (15, "AKIA" + "A1B2C3D4E5F6G7H8"), (16, "pässword: ñandú çà et là où"), (17, "日本語 テスト \U0001f600 one two three"),
    (18, "<|endoftext|>x<|startoftext|>"), (19, "it's they'll WE'RE ''s 12 ¾ x²"), (20, "\x00\x1c\x85\xa0 nul"),
    (None, PROSE), (None, None), (6, PROSE), (21, "12345 67890"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """The texts, with further columns whose names operators use inside."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    extra = ["w", "x", "fp", "key", "hash", "len", "cell", "label", "shard", "spans", "rep", "hit_id", "known_id", "of", "s", "e"]
    return df.withColumns({c: F.lit("other") for c in extra}).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.limit(0)


def rows(df, *cols):
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
