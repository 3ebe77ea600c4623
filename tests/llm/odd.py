"""A small table with everything that is unusual about documents, and its variants."""

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use for results or for themselves
CLASHES = "row size key n tag rank node component rows language score kept_text at says use sha256 target taken lines out".split()

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
BLANK = " \t\n\x0b\x0c\r "


def rows():
    return [
        (1, "Der Hund\nDer Hund\nschläft", "de", "a", 1),
        (2, "DerHund Der Hund schläft", "de", None, None),
        (3, None, "de", "a", 0),
        (4, "", None, None, 0),
        (5, BLANK, "en", "b", 7),
        (6, LONG, "en", "b", len(LONG)),
        (7, LONG + " and more", "en", "b", len(LONG)),
        (8, "the cat sat on the mat and looked at the dog", "en", "c", 44),
        (8, "the cat sat on the mat and looked at the dog", "en", "c", 44),
        (None, "the cat sat on the mat and looked at the dog", "en", "c", 44),
        (None, None, None, None, None),
        (9, "12345 !!! ???", "en", "\U0001f600", 13),
        (10, "é é ẞ İ ΣΣ \U0001f600 日本語", "xx", "z", 20),
    ]


def frame(spark):
    return spark.createDataFrame(rows(), COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def clashing(spark):
    """The same rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    return frame(spark).withColumns({c: F.lit(f"kept {c}") for c in CLASHES})
