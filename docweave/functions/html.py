"""HTML page -> title + ordered h1/h2/h3/p sections, as Column expressions.

Method (all regexp_replace/split, no parser):
1. drop <script>, <style> and comments first (pages embed "</p>" inside
   scripts);
2. every opening h1/h2/h3/p tag becomes START + name + SEP, every other
   block-level tag (opening or closing, including </p>) becomes START - so a
   paragraph ends at the next block tag even when it was never closed;
3. split on START, keep the pieces that begin with a section name, drop the
   remaining inline tags, decode entities, strip.
"""

from __future__ import annotations

import json
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.text import WS_CLASS

START = "\u0001"
SEP = "\u0002"

NON_CONTENT = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
SECTION_OPEN = r"(?i)<(h1|h2|h3|p)(\s[^>]*)?>"
BLOCK_TAG = (r"(?i)</?(h[1-6]|p|div|article|section|header|footer|nav|ul|ol|li|table|tr|td|th|"
             r"body|html|head|main|aside|form|blockquote|pre|title|dl|dt|dd|figure)(\s[^>]*)?/?>")
ANY_TAG = r"<[^>]*>"
TITLE = r"(?is)<title(\s[^>]*)?>(.*?)</title\s*>"

def _c(col):
    return F.col(col) if isinstance(col, str) else col


def _references() -> Column:
    """map<name, text> of all named references, from Python's table of them."""
    named = {n[:-1]: text for n, text in entities.html5.items() if n.endswith(";")}
    return F.from_json(F.lit(json.dumps(named)), "map<string,string>")


def _code_point(n: Column) -> Column:
    """The character of a code point; U+FFFD where there is none."""
    valid = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(F.when(valid, n).otherwise(F.lit(0xFFFD))), 8, "0"))
    return F.decode(utf32, "UTF-32")


def decode_entities(col: Column) -> Column:
    """Named (``&name;``), decimal and hexadecimal references replaced once, from
    left to right, so "&amp;lt;" stays "&lt;"; an unknown name stays as it is."""
    def decoded(piece):
        ref = F.regexp_extract(piece, r"^(#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,7}|[A-Za-z][A-Za-z0-9]*);", 1)
        digits = F.regexp_extract(ref, r"^#[xX]?([0-9A-Fa-f]+)$", 1)
        number = F.when(ref.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        char = F.when(ref.startswith("#"), _code_point(number)).otherwise(F.try_element_at(_references(), ref))
        rest = F.substring(piece, F.length(ref) + 2, F.length(piece))
        return F.when(ref == "", F.concat(F.lit("&"), piece)).otherwise(
            F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece)))

    pieces = F.split(col, "&", -1)
    later = F.transform(F.slice(pieces, 2, F.size(pieces)), decoded)
    return F.when(F.instr(col, "&") == 0, col).otherwise(F.concat(pieces[0], F.array_join(later, "")))


def strip_non_content(html: Column | str) -> Column:
    return F.regexp_replace(_c(html), NON_CONTENT, "")


def title(html: Column | str) -> Column:
    """Title text outside scripts, styles and comments, entities decoded, not
    stripped; '' when absent."""
    raw = F.regexp_extract(strip_non_content(html), TITLE, 2)
    return decode_entities(raw)


def section_pieces(html: Column | str) -> Column:
    """Array of "name SEP raw-content" strings in document order."""
    body = strip_non_content(html)
    marked = F.regexp_replace(body, SECTION_OPEN, START + "$1" + SEP)
    marked = F.regexp_replace(marked, BLOCK_TAG, START)
    pieces = F.split(marked, START)
    return F.filter(pieces, lambda p: p.rlike("(?i)^(h1|h2|h3|p)" + SEP))


def sections(html: Column | str) -> Column:
    """array<struct<type, content>>: ordered h1/h2/h3/p sections."""
    def to_section(p):
        typ = F.lower(F.substring_index(p, SEP, 1))
        raw = F.substring(p, F.instr(p, SEP) + 1, 1 << 30)
        text = decode_entities(F.regexp_replace(raw, ANY_TAG, ""))
        content = F.regexp_replace(text, f"^[{WS_CLASS}]+|[{WS_CLASS}]+$", "")
        return F.struct(typ.alias("type"), content.alias("content"))
    return F.transform(section_pieces(html), to_section)
