"""The extractor plug-in over files, and its pages as chunks."""
from docweave.operators import ingest, pagechunks
from docweave.sources import files


def test_read_pages_quarantines_files_that_fail(spark, tmp_path):
    for name, content in (("a.txt", b"first page\fsecond page"), ("b.txt", b"\xff\xfe"), ("empty.txt", b"")):
        (tmp_path / name).write_bytes(content)

    def extractor(path, content):
        return content.decode("utf-8").split("\f") if content else []

    listed = spark.read.format("binaryFile").load(str(tmp_path))
    pages = files.read_pages(spark, listed, extractor)
    got = sorted(((r.path.rsplit("/", 1)[-1], r.page_no, r.text, r.status) for r in pages.collect()), key=str)
    assert got == [("a.txt", 1, "first page", "ok"), ("a.txt", 2, "second page", "ok"), ("b.txt", None, None, "error")]
    assert "UnicodeDecodeError" in pages.where("status = 'error'").first().error
    fine = pages.where("status = 'ok'")
    chunks = {(r.path.rsplit("/", 1)[-1], r.chunk_id): r.chunk_text for r in pagechunks.chunk_pages(fine, 2, "path").collect()}
    glued = ingest.ingest_chunks(ingest.assemble_documents(fine, "path"), 2, "path")
    assert chunks == {(r.path.rsplit("/", 1)[-1], r.chunk_id): r.chunk_text for r in glued.collect()} and len(chunks) == 2
