import pytest
from pyspark.sql import functions as F

EN = "the river runs past the old mill and into the quiet sea while gulls turn above the harbor wall"
FR = "le vieux moulin dort au bord de la riviere et les enfants jouent dans le grand jardin du village"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, ties, repeated rows, and columns whose names clash."""
    long_text = " ".join(f"w{i % 997} x{i}" for i in range(20_000))
    rows = [(i, f"{EN} number {i} stands here alone with {i * 7} others", "en", "a.site") for i in range(10)]
    rows += [(10 + i, f"{FR} numero {i} avec {i * 3} autres", "fr", "b.site") for i in range(10)]
    rows += [(20, None, None, None), (21, "", "en", "a.site"), (22, " \t\n", "fr", None), (23, long_text, "en", "a.site"),
             (24, rows[0][1], "en", None), (24, rows[0][1], "en", None), (25, "12 34 !!", "en", "b.site"), (None, "no id at all here", "en", "a.site")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit(1) for c in ("size", "hash", "id", "row", "pos", "component", "target", "n_chars", "language")})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
