"""Small tables with everything that goes wrong: nulls, blanks, very long texts, ties, repeated rows, clashing names."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators might use themselves
    T.StructField("size", T.StringType()), T.StructField("part", T.StringType()), T.StructField("before", T.StringType()), T.StructField("kept", T.StringType()),
])
SENTENCE = "the quick brown fox jumps over the lazy dog and runs to the river for a drink of cold water "
LONG = " ".join(f"word{i % 997}x{i % 31} of the river" for i in range(12_000))


def rows():
    texts = [
        None, "", "   \n\t", "a", "one two three", SENTENCE * 3, SENTENCE * 3, SENTENCE * 3 + "once more", LONG, LONG + " end",
        "A shared line of text\nown line number one\nA shared line of text  ", "own words here\n  a SHARED line of text\n\n", "a shared line of text", "short\nshort\nshort",
        "É a line with accents É\nxx", "é a line with accents é\nxx", " words joined by no-break spaces", "don't we'll '' 's 12 34 \U0001f600\U0001f600", "x" * 3000, "#*$%&|<> " * 30,
    ]
    out = [(i, t, ("en", "de", None, " ")[i % 4], ("a", "b", None, "é", "Z")[i % 5], 0, "s", "p", "b", "k") for i, t in enumerate(texts)]
    out += [out[5], out[8], (None, SENTENCE * 2, None, None, None, "s", "p", "b", "k"), (3, "another text under a used id, " + SENTENCE, "en", "a", 0, "s", "p", "b", "k")]
    return out


def table(spark, which="all"):
    data = rows() if which == "all" else []
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def fixture_docs(spark, n=None):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return d if n is None else d.limit(n)
