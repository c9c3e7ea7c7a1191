"""Small tables with every odd case: nulls, empty and long texts, repeated rows, columns whose names clash."""

LONG = "lorem ipsum dolor sit amet " * 400
ODD_TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs away from the old house.",
    "",
    None,
    "The quick brown fox jumps over the lazy dog and runs away from the old house.",
    LONG,
    " \n\t ",
    "Ünïcödé wörds; 中文 字 — and 12 numbers\n\n, \x00 too",
    "x",
    "The quick brown fox jumps over the lazy dog and runs away from the old barn.",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, row long, _row long, fp long, size string, spans string"


def frame(spark, rows, langs=()):
    """``documents`` with (doc_id, text) and further columns under names that operators use themselves."""
    lang = dict(langs)
    return spark.createDataFrame([(d, t, lang.get(d), None, None, 1, 2, 3, 4, "s", "p") for d, t in rows], SCHEMA)
