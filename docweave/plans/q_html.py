"""Registered HTML page queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import html as H
from docweave.functions.text import WS_CLASS
from docweave.plans.registry import register
from docweave.plans.sqlgen import q


# The character references that occur in `pages`, "&amp;" decoded after them.
_REFERENCES = (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"))


def _sql_decode(e: str) -> str:
    for ent, ch in _REFERENCES:
        e = f"replace({e}, {q(ent)}, {q(ch)})"
    return f"replace({e}, '&amp;', '&')"


_NON_CONTENT = H.NON_CONTENT
_BLOCK = H.BLOCK_TAG
_SECTIONS_CTE = f"""
hb AS (SELECT page_id, regexp_replace(html, {q(_NON_CONTENT)}, '', 'g') AS body FROM pages),
hm AS (SELECT page_id, regexp_replace(regexp_replace(body, {q(H.SECTION_OPEN)}, chr(1) || '\\1' || chr(2), 'g'),
                                      {q(_BLOCK)}, chr(1), 'g') AS marked FROM hb),
hp AS (SELECT page_id, list_filter(string_split(marked, chr(1)),
                                   lambda x: regexp_matches(x, '(?i)^(h1|h2|h3|p)' || chr(2))) AS pieces FROM hm),
hs AS (SELECT page_id, unnest(generate_series(0, len(pieces) - 1)) AS seq, unnest(pieces) AS piece FROM hp),
sec AS (SELECT page_id, seq, lower(split_part(piece, chr(2), 1)) AS type,
               regexp_replace({_sql_decode("regexp_replace(substring(piece, instr(piece, chr(2)) + 1), '<[^>]*>', '', 'g')")},
                              '^[{WS_CLASS}]+|[{WS_CLASS}]+$', '', 'g') AS content FROM hs)
"""

_TITLE_SQL = _sql_decode(f"regexp_extract(html, {q(H.TITLE)}, 2)")


@register("html_sections", f"""
WITH {_SECTIONS_CTE}
SELECT page_id, seq::BIGINT AS seq, type, content FROM sec
""")
def html_sections(t):
    """Ordered h1/h2/h3/p sections of every page (flat form)."""
    p = t.pages.select("page_id", F.posexplode(H.sections("html")).alias("seq", "s"))
    return p.select("page_id", F.col("seq").cast("bigint").alias("seq"), "s.type", "s.content")


@register("html_title", f"""
SELECT page_id, {_TITLE_SQL} AS title FROM pages
""")
def html_title(t):
    """page title, entities decoded, not stripped, '' when absent."""
    return t.pages.select("page_id", H.title("html").alias("title"))


@register("html_page_json", f"""
WITH {_SECTIONS_CTE},
agg AS (SELECT page_id, list(struct_pack(type := type, content := content) ORDER BY seq) AS sections
        FROM sec GROUP BY page_id)
SELECT p.page_id, {_TITLE_SQL.replace('html', 'p.html')} AS title,
       coalesce(len(a.sections), 0)::BIGINT AS n_sections,
       coalesce(list_aggregate(list_transform(a.sections, lambda s: length(s.content)), 'sum'), 0)::BIGINT AS content_chars
FROM pages p LEFT JOIN agg a USING (page_id)
""")
def html_page_json(t):
    """One JSON document per page {title, sections:[{type, content}]};
    checked by title, section count and content length of the parsed-back JSON."""
    from docweave import schemas
    doc = t.pages.select("page_id", F.to_json(F.struct(H.title("html").alias("title"),
                                                       H.sections("html").alias("sections"))).alias("json"))
    back = doc.select("page_id", F.from_json("json", schemas.SECTIONED_PAGE).alias("d"))
    return back.select("page_id", F.col("d.title").alias("title"),
                       F.size("d.sections").cast("bigint").alias("n_sections"),
                       F.coalesce(F.aggregate(F.transform("d.sections", lambda s: F.length(s["content"])),
                                              F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint")
                       .alias("content_chars"))
