"""Small tables for the tests of the training-data operators."""


def documents(spark, rows):
    """``(doc_id, text)`` rows as a documents table."""
    return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
