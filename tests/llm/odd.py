"""Documents with what real tables have: nulls, empty and long texts, ties, repeated rows, columns with clashing names."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside or return.
CLASHING = ("block", "row", "keys", "key", "n", "count", "shard", "slot", "size", "arc", "kept", "n_words", "mix_slot", "_source", "_lines", "_k1", "_rank", "bucket", "first", "code", "cls", "value", "label")

PROSE = " ".join(f"word{i % 97}x{i % 13}" for i in range(120))


def rows():
    long = "\n".join(f"line {i} of a very long text that goes on with number {i * i}" for i in range(20_000))
    two = "a first line that repeats\nand a second line that does\nand a third one here"
    out = [(1, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (3, PROSE + " and more", None, None, None), (4, None, None, None, None), (5, "", "en", "b", 0)]
    out += [(None, PROSE, "en", "b", 1), (None, None, None, None, None), (6, long, "en", "b", len(long)), (7, two, "en", "a", 9), (8, two + "\nan end", "en", "a", 9), (9, " \t\n", "en", "c", 3), (10, "é 日本 \U0001f600 x", "fr", "c", 9)]
    return out + [(20 + i, f"tie {i % 2}", "en", "d", 5) for i in range(6)]


def documents(spark, extra=True):
    df = spark.createDataFrame(rows(), SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}) if extra else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
