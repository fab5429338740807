import datetime
import math
import random
import re
import unicodedata

from pyspark.sql import functions as F

from prodseries.functions import text


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in df.select("i", fn(F.col("s"))).orderBy("i").collect()]


def random_texts(alphabet, n=400, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def fold(s):
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()


def test_clean_text_collapses_unicode_space(spark):
    values = random_texts("ab \t\n\x1c\x1f  　 é")
    assert apply(spark, text.clean_text, values) == [re.sub(r"\s+", " ", v.strip()) for v in values]


def test_mojibake_is_repaired_before_leftovers_are_dropped(spark):
    got = apply(spark, text.normalize_text, ["Producci�n  seg�n", "x�y", " Jun�n ", None])
    assert got == ["Producción según", "xy", "Junín", None]


def test_strip_accents_equals_compatibility_decomposition(spark):
    single, _, several = text._ascii_folding()
    # Every character with a decomposition to ASCII, each on its own and in mixed texts.
    values = [*single, *several, *random_texts("aé—漢ﬁ½Ⅷ㎏ñ\U0001d400…" + "xyz", 300)]
    assert apply(spark, text.strip_accents, values) == [fold(v) for v in values]


def test_parse_period(spark):
    got = apply(spark, text.parse_period, ["Abr24", " dic00 ", "Set24", "2024-04", "ABR24", "Abr2024", None, ""])
    d = datetime.date
    assert got == [d(2024, 4, 1), d(2000, 12, 1), None, None, d(2024, 4, 1), None, None, None]


def test_parse_series_metadata(spark):
    got = apply(
        spark,
        text.parse_series_metadata,
        ["Produccion - Cobre - Jun�n (TM.F)", "P - A - B - C (u)", "no separators", "P - A - B", None],
    )
    assert [tuple(r) for r in got] == [
        ("Cobre", "Junín", "tm.f"),
        ("A", "B - C", "u"),
        (None, None, None),
        (None, None, None),
        (None, None, None),
    ]


def test_parse_numeric_cases(spark):
    cases = {
        "1,234": (1234.0, False, False),
        "1,5": (15.0, False, False),
        "1_000": (1000.0, False, False),
        "1__0": (None, False, True),
        "12f": (None, False, True),
        "0x10": (None, False, True),
        "abc": (None, False, True),
        " 1e3 ": (1000.0, False, False),
        ".5": (0.5, False, False),
        "5.": (5.0, False, False),
        "-inf": (-math.inf, False, False),
        "N.D.": (None, True, False),
        "—": (None, True, False),
        "nan": (None, True, False),
        "+nan": (None, False, False),
        "": (None, True, False),
        ", 5": (5.0, False, False),
        "5 ,": (5.0, False, False),
    }
    got = apply(spark, text.parse_numeric, [*cases, None])
    assert [tuple(r) for r in got] == [*cases.values(), (None, True, False)]


def test_parse_numeric_agrees_with_python_float(spark):
    values = random_texts("01.,_eE+-f ", 600)

    def expected(raw):
        token = raw.strip().lower()
        if token == "":
            return None, True, False
        try:
            return float(token.replace(",", "")), False, False
        except ValueError:
            return None, False, True

    normalized = [re.sub(r"\s+", " ", v.strip()) for v in values]
    assert [tuple(r) for r in apply(spark, text.parse_numeric, values)] == [expected(v) for v in normalized]


def test_small_helpers(spark):
    assert apply(spark, text.optional_text, [" a ", "  ", None]) == ["a", None, None]
    assert apply(spark, text.text_to_bool, ["True", " true", "FALSE", "yes", None]) == [True, True, False, False, False]
