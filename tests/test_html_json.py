import json

import pytest
from pyspark.sql import functions as F

from docweave import schemas
from docweave.functions import html as H
from docweave.sources import json_io

VIEWER_SHELL = """<!DOCTYPE html><html><head><meta charset="utf-8">
<title>XBRL Viewer</title><script src="x.js"></script><link rel="stylesheet" href="a.css"></head>
<body><div id="app"></div><noscript>enable scripts</noscript></body></html>"""

PAGE = ('<html><head><title> A &amp; B </title><style>p{margin:0}</style>'
        '<script>var t="</p>";</script></head><body><nav><a href="/x">x</a></nav><!-- <p>ad</p> -->'
        '<article><h1>Head &quot;line&quot;</h1><p><b>first</b> para<br><p>second &middot; one</p>'
        '<P class="c">  third  </P><h2></h2><h3>sub</h3></article>'
        '<footer>&copy; foot</footer></body></html>')


def _run(spark, html):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(H.title("html").alias("t"), H.sections("html").alias("s")).first()


def test_viewer_shell_has_title_and_no_sections(spark):
    r = _run(spark, VIEWER_SHELL)
    assert r.t == "XBRL Viewer" and r.s == []


def test_sections_order_unclosed_paragraph_and_entities(spark):
    r = _run(spark, PAGE)
    assert r.t == " A & B "                     # title not stripped
    assert [(s.type, s.content) for s in r.s] == [
        ("h1", 'Head "line"'), ("p", "first para"), ("p", "second · one"),
        ("p", "third"), ("h2", ""), ("h3", "sub")]


def test_no_title_gives_empty_string(spark):
    assert _run(spark, "<p>x</p>").t == ""


def test_json_roundtrip_object_and_list(spark, tmp_path):
    obj = {"id": "f.pdf_chunk_0", "values": [0.5, 0.25],
           "metadata": {"filename": "f.pdf", "file_size": 10, "num_pages": 1, "chunk_id": 0, "chunk_text": "x"}}
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.json").write_text(json.dumps(obj))
    (tmp_path / "many").mkdir()
    (tmp_path / "many" / "b.json").write_text(json.dumps([obj, dict(obj, id="f.pdf_chunk_1")], indent=2))
    one = json_io.read_vectors_json(spark, str(tmp_path / "one"), multiline=True).collect()
    many = json_io.read_vectors_json(spark, str(tmp_path / "many"), multiline=True).collect()
    assert one[0].id == "f.pdf_chunk_0" and one[0].metadata.author is None
    assert sorted(r.id for r in many) == ["f.pdf_chunk_0", "f.pdf_chunk_1"]


def test_strict_read_of_non_json_fails(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "page.json").write_text("<!DOCTYPE html><html><title>x</title></html>")
    with pytest.raises(Exception):
        json_io.read_vectors_json(spark, str(tmp_path / "bad"), multiline=True).collect()


def test_permissive_parse_of_unbalanced_json_gives_nulls(spark):
    text = '{"surf": [{"beach": "A", "conditions": "x"} {"beach": "B", "conditions": "y"}]}'
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(F.from_json("t", "surf array<struct<beach:string,conditions:string>>",
                              {"mode": "PERMISSIVE"}).alias("j")).first()
    assert r.j is None or r.j.surf is None


def test_sectioned_page_json_schema(spark):
    df = spark.createDataFrame([(PAGE,)], "html string")
    js = df.select(F.to_json(F.struct(H.title("html").alias("title"),
                                      H.sections("html").alias("sections"))).alias("j")).first().j
    back = json.loads(js)
    assert back["title"] == " A & B " and back["sections"][0] == {"type": "h1", "content": 'Head "line"'}
    assert schemas.SECTIONED_PAGE.names == ["title", "sections"]


def test_title_ignores_comments_and_values_are_not_expanded_again(spark):
    from docweave.functions import templates
    html = "<!-- <title>no</title> --><script>var t='<title>no</title>'</script><title>yes</title>"
    df = spark.createDataFrame([(html, "see {concept}", "X")], "h string, c string, k string")
    from docweave.functions import html as hx
    filled = templates.fill(F.lit("{context}: {concept} {{}}"), {"context": F.col("c"), "concept": F.col("k")})
    assert tuple(df.select(hx.title("h"), filled).first()) == ("yes", "see {concept}: X {}")


def test_character_references(spark):
    cases = [("a &lt;b&gt; &#233;&#xE9; &eacute; &amp;lt; &nosuch; & &#0; &#x110000; x&;", "a <b> éé é &lt; &nosuch; & \ufffd \ufffd x&;"),
             ("plain", "plain"), ("", ""), (None, None), ("&copy;", "©"), ("&#128512;&", "😀&")]
    df = spark.createDataFrame(cases, "t string, want string")
    for r in df.select("t", "want", H.decode_entities(F.col("t")).alias("got")).collect():
        assert r.got == r.want, r.t


def test_pieces_of_a_template_are_filled_and_values_stay_as_they_are(spark):
    from docweave.functions import templates
    df = spark.createDataFrame([("a{concept}", "x\u0003y\u0004", None)], "context string, concept string, question string")
    values = {c: F.col(c) for c in df.columns}
    text = "{{{question}|{concept} {other} {context} }} {concept}\n{"
    row = df.select(templates.fill_pieces(templates.pieces(F.lit(text)), values).alias("p"), templates.fill(F.lit(None).cast("string"), values).alias("n")).first()
    assert row.p == "{|x\u0003y\u0004 {other} a{concept} } x\u0003y\u0004\n{" and row.n is None
