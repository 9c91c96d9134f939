import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with everything that may be odd about them, and further columns with clashing names."""
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [
        (1, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", "s", 51),
        (2, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", "s", 51),
        (2, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", "s", 51),
        (3, None, None, None, None),
        (4, "", "en", "", 0),
        (5, " \n\t \n", "en", "s", 5),
        (6, long, "en", "t", len(long)),
        (7, long + " end", "en", "t", len(long) + 4),
        (None, "no id here", "en", "t", 10),
        (8, "Two words", "en", "t", 9),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = {n: "x" for n in ("n_words", "kept", "length", "piece", "id", "version", "spans", "sequence_id", "row")}
    from pyspark.sql import functions as F

    return frame.withColumns({n: F.lit(v) for n, v in extra.items()})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
