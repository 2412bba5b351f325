import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows (id, text[, lang]) as a documents table, with columns that operators might take for their own."""
    def build(*rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("score", "kept", "row", "digest", "rep", "measures", "stratum", "toxicity_score", "batch"):
                df = df.withColumn(name, F.lit("own"))
        return df

    return build


@pytest.fixture
def labelled(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return build


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
