"""A small documents table with every awkward case: nulls in any column, empty and
very long texts, repeated rows and ids, and extra columns with clashing names."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, `__id` string, `__text` string, "
          "`__row1` string, score double, n int, slot string, start long")


def row(i, text, lang="en", source="s0"):
    return (i, text, lang, source, len(text or ""), "x", "y", "z", 0.5, 1, "q", 7)


LONG = ("lorem ipsum dolor sit amet " * 9000).strip()


def awkward():
    base = [row(1, "A first plain text, of some words."), row(2, None), row(3, ""), row(4, " \n\t "), row(5, LONG),
            row(None, "no id here", None, None), row(7, "tie"), row(7, "other text, same id"), row(8, "repeated row"), row(8, "repeated row"),
            row(9, "naïve ñandú 日本 text\nsecond line"), row(10, "nulls", None, "s1")]
    return base + [(11, "all null", None, None, None, None, None, None, None, None, None, None)]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def ids(df):
    return sorted((-1 if r.doc_id is None else r.doc_id) for r in df.select("doc_id").collect())
