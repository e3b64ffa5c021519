DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    """Texts with ids from 0, and columns whose names the operators use inside."""
    rows = [(i, t, None, sources[i] if sources else None, None, "x", 1.5, -1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC + ", fp string, score double, size int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
