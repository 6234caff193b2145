"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew potent coffee near old stone bridges".split()


def sentence(start: int, n: int) -> str:
    return " ".join(WORDS[(start + 3 * i + i * i // 7) % len(WORDS)] + ("," if i % 9 == 8 else "") for i in range(n))


TEXTS = [
    (1, sentence(0, 80)),
    (2, sentence(0, 80)),
    (3, None),
    (4, ""),
    (5, "  \n\t "),
    (6, "Ärger, été! ñandú <|endoftext|> 日本語 ümlaut"),
    (7, "line one\nline one\n\nline two"),
    (8, sentence(5, 30_000)),
    (9, "x" * 50_000),
    (None, "a text without a name, which is long enough to be kept"),
    (10, sentence(3, 40)),
    (10, sentence(3, 40)),
    (-11, "AKIA" + "Z" * 16 + " password = hunter2hunter2 " + "0123456789abcdef" * 3),
]

#: Names that operators use for themselves.
CLASHING = ("id", "row", "class", "n", "component", "kept", "spans", "stratum", "slot", "dropped_row")


def frame(spark, rows=None):
    """Documents with the columns of the table and others whose names might clash."""
    rows = TEXTS if rows is None else rows
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{name}` string" for name in CLASHING
    )
    return spark.createDataFrame([(*row, "en", "s", 1, *["?"] * len(CLASHING)) for row in rows], schema)
