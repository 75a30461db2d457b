"""Text Column functions: cleaning, tokenising, stop words, chunking.

All of these are plain Catalyst expressions (regexp_replace, split, filter,
transform, slice, substring) so they run inside whole-stage codegen or the
JVM lambda evaluator, never in a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's ``str.isspace`` sees it; Java's ``\s`` alone misses
# the vertical tab, the information separators and the Unicode spaces.
WS_CLASS = (r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# What cleaning keeps: Unicode letters, digits, underscore, whitespace.
KEEP_CLASS = r"\p{L}\p{N}_" + WS_CLASS

# Spark's default English stop-word list
# (pyspark.ml.feature.StopWordsRemover.loadDefaultStopWords("english")), in its order.
STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few
more most other some such no nor not only own same so than too very s t can
will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
could here's how's let's ought that's there's what's when's where's who's
why's would
""".split())

# Contractions the word tokenizer splits in two (after
# punctuation removal only these apostrophe-free forms can still occur).
CONTRACTION_SPLITS = (
    ("cannot", ("can", "not")),
    ("gimme", ("gim", "me")),
    ("gonna", ("gon", "na")),
    ("gotta", ("got", "ta")),
    ("lemme", ("lem", "me")),
    ("wanna", ("wan", "na")),
)


def clean_text(col: Column | str) -> Column:
    """Delete punctuation (keep letters, digits, underscore), collapse
    whitespace runs to one space, trim, lower-case."""
    c = F.col(col) if isinstance(col, str) else col
    no_punct = F.regexp_replace(c, f"[^{KEEP_CLASS}]", "")
    collapsed = F.regexp_replace(no_punct, f"[{WS_CLASS}]+", " ")
    return F.lower(F.trim(collapsed))


def _split_contraction(t: Column) -> Column:
    expr = None
    for word, parts in CONTRACTION_SPLITS:
        cond = t == F.lit(word)
        val = F.array(*[F.lit(p) for p in parts])
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.array(t))


def tokenize(cleaned: Column | str) -> Column:
    """Split cleaned text on single spaces; empty text gives an empty array."""
    c = F.col(cleaned) if isinstance(cleaned, str) else cleaned
    toks = F.filter(F.split(c, " "), lambda t: t != F.lit(""))
    return F.flatten(F.transform(toks, _split_contraction))


def remove_stopwords(tokens: Column | str, stop_words=STOP_WORDS) -> Column:
    """Drop stop words; ``isin`` over literals becomes a hash set (InSet)."""
    c = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(c, lambda t: ~t.isin(list(stop_words)))


def token_chunks(tokens: Column | str, size: int) -> Column:
    """Array of chunk strings: consecutive slices of ``size`` tokens joined by
    one space. Built as one array per document so the token array is never
    copied per chunk row."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    n = F.size(t)
    last = F.floor((n - 1) / size).cast("int")
    idx = F.when(n > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.array_join(F.slice(t, i * size + 1, F.lit(size)), " "))


def char_chunks(text: Column | str, size: int = 1000, overlap: int = 200) -> Column:
    """Array of character windows of ``size`` starting every ``size-overlap``
    characters, the last one ending at the end of the text."""
    if size <= 0 or not (0 <= overlap < size):
        raise ValueError("need size > 0 and 0 <= overlap < size")
    t = F.col(text) if isinstance(text, str) else text
    step = size - overlap
    n = F.length(t)
    last = F.when(n <= size, F.lit(0)).otherwise(F.ceil((n - size) / step).cast("int"))
    idx = F.when(n > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda k: F.substring(t, k * step + 1, size))


def char_chunk_count(length: int, size: int = 1000, overlap: int = 200) -> int:
    """Closed-form chunk count (used by tests and docs)."""
    if length <= 0:
        return 0
    if length <= size:
        return 1
    step = size - overlap
    return 1 + -(-(length - size) // step)


def truncate_chars(col: Column | str, n: int = 1000) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, 1, n)


def basename(path: Column | str) -> Column:
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(c, r"[^/]+$", 0)


def iso_time(ts: Column | str) -> Column:
    """Timestamp to ISO-8601 text with microseconds (session zone is UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def trim_ws(col: Column | str) -> Column:
    """Strip Python-whitespace at both ends."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, f"^[{WS_CLASS}]+|[{WS_CLASS}]+$", "")
