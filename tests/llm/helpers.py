"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing extra columns."""

DOCS = "doc_id long, text string, digest string, n string, members string"


def documents(spark, texts):
    """doc_id 0, 1, ...; the extra columns bear names that operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], DOCS)


AWKWARD = [None, "", "   \n\t ", "one", "one two", "The Cat sat on the mat, the cat sat on the hat.", "The Cat sat on the mat, the cat sat on the hat.", "über 日本語 \x1c\xa0 x́", "long word " * 3000]
