"""Small tables with everything that may go wrong, and brute-force twins."""

import random

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return; a table may bring columns of the same names.
CLASHES = ("key", "text_hash", "shard", "slot", "size", "label", "kept", "spans", "n_words", "blob", "score", "start", "print")
#: Names like those that helpers once had.
CLASHES += ("__blob", "__spans", "__secrets", "__text_hash", "__key", "__hash", "__0", "__2", "___1")


def documents(spark, rows, clashes=False):
    """Rows ``(doc_id, text)`` as documents; ``clashes`` adds NULL-able columns of troublesome names."""
    full = [(i, t, None if i is None or i % 5 == 0 else "en", None, None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOCUMENT)
    if clashes:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    return df


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def odd_rows():
    """NULL and empty texts, NULL ids, ties, repeated rows, blanks of all kinds, a very long text."""
    long = prose(1, 30000, 100000)
    return [
        (1, "The cat sat. Token = abcdefgh12"), (2, None), (3, ""), (None, "no id here at all"), (4, " \t\n\x0b\x0c\r "),
        (5, "same text"), (5, "same text"), (6, "same text"), (5, "another text under the same id"), (7, long), (8, long),
        (None, None), (9, "naïve Ärger   x\x1cy 東京 🙂"), (10, "x"),
    ]
