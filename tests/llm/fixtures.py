"""Small hostile document tables: nulls, empty and long texts, ties, repeats, clashing names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i % 700}" for i in range(6000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))

ROWS = [
    (0, "Alpha beta gamma delta.\nA line that repeats itself here\nshort\n", "en", "a", 1),
    (1, "a LINE that repeats itself here  \nother text of its own\n\n", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \t\n\x0b\f\r ", "en", "b", 0),
    (5, LONG, "en", "a", 1),
    (6, LONG, "en", "a", 1),
    (7, "one two " + PASSAGE + " three four", "en", "c", 1),
    (8, "five " + PASSAGE + " six", "de", None, 1),
    (9, PASSAGE + " " + PASSAGE, "de", "a", 1),
    (10, "Straße naïve 😀 café x  don't <|endoftext|> 'S\n 　y\x1cz", "de", "c", 1),
    (11, "x" * 5000, "fr", "b", 1),
    (12, "\n\n\n", "fr", "b", 1),
    (13, "A line that repeats itself here\nA line that repeats itself here", "fr", "a", 1),
    (14, " 1 2  3   4\t5 \n6 . , ;", None, "d", 1),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(docs):
    """The table with columns named like what operators use inside or return."""
    from pyspark.sql import functions as F

    names = ["size", "key", "line", "batch", "start", "length", "h1", "component_id", "score", "n_words", "first"]
    return docs.select("*", *[F.lit("x").alias(n) for n in names])


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
