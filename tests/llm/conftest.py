import pytest


@pytest.fixture()
def make_documents(spark, tmp_path):
    """Write rows (doc_id, text, lang, source) as a documents table; its folder."""
    def make(rows, name="documents", schema="doc_id long, text string, lang string, source string"):
        spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return make
