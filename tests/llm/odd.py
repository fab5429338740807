"""Documents with everything that an operator has to stand: null ids and texts, empty and very
long texts, repeated rows, ties, and extra columns with the operators' own names."""

from pyspark.sql import functions as F

CLASHING = [
    "kept", "key", "row", "size", "shard", "slot", "all", "chunks", "n_removed", "n_lines", "host", "path", "evidence",
    "places", "win", "start", "bits", "digest", "root", "kept_id", "dirty_id", "gone_id", "ids", "n", "text_crc32", "score",
]
LINE = "the quick brown fox jumps over the lazy dog and runs away from the farm"
PASSAGE = "\n".join(f"{LINE} number {i} with some other words at its end" for i in range(14))
LONG = " ".join(f"word{i % 997} of{i % 13} many{i}" for i in range(60_000))
BENCH = "one two three four five six seven eight nine ten eleven twelve"

ROWS = [
    (0, f"A first line that stands alone here\n{PASSAGE}\nan end of its own"),
    (1, f"Quite another start of a text\nwith a second line\n{PASSAGE}"),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, f"before {BENCH.upper()} after"),
    (6, "  \n\t \n"),
    (7, "Été à Noël: 日本 😀 <|endoftext|> don't"),
    (8, LONG),
    (8, LONG),
    (9, "tie tie tie tie tie tie tie tie tie tie"),
    (10, "tie tie tie tie tie tie tie tie tie tie"),
    (None, "a row without an id, and some words to fill a line of fifty bytes or more"),
    (None, None),
    (11, "a row without an id, and some words to fill a line of fifty bytes or more"),
    (12, "12345 67890 !!!"),
]


def odd_documents(spark):
    docs = spark.createDataFrame(
        [(i, t, None if t is None else "en", "src0", None if t is None else len(t)) for i, t in ROWS],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    return docs.withColumns({c: F.lit(f"their {c}") for c in CLASHING})


def no_documents(spark):
    return odd_documents(spark).limit(0)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
