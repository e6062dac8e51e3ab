import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Written intermediates of these tests go to a folder that pytest owns."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows, with extra columns of awkward names."""

    def make(rows, **extra):
        full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC)
        from pyspark.sql import functions as F

        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return make
