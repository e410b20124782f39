import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents table, with clashing extra columns, from texts or (id, text, source) rows."""
    def make(rows, extra=True):
        full = []
        for i, r in enumerate(rows):
            doc, text, source = r if isinstance(r, tuple) else (i, r, "a")
            full.append((doc, text, "en", source, len(text or "")))
        df = spark.createDataFrame(full, DOC)
        if extra:
            from pyspark.sql import functions as F
            for name in ("n", "digest", "copies", "score", "id", "_id", "key", "rank", "size", "start"):
                df = df.withColumn(name, F.lit("clash"))
        return df.repartition(3)
    return make
