"""Quality rules: a threshold table compiled into one projection.

``measures`` turns every text into counts by built-in functions only, and
``verdict`` compiles the rows of ``RULES`` into one boolean expression over
them. No shuffle, no user function; the plan is one scan and projections.

Defined cases: null or blank text has no words, all its counts are 0 and it
fails the base rule (fewer than 50 words). Repeated rows are judged each on
its own and alike. Very long texts cost n log n in their words: windows are
hashed (64 bit), sorted inside the row and compared with their neighbours.
Extra columns are carried along; input columns named like an output column
are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import BLANKS, table, words

# Frequent function words of the corpus languages.
STOP_WORDS = (
    "the of and a to in is that it for was on are as with be by this have from "
    "de la le et les des en un une du que est pour dans qui sur par au pas plus il ne se ce "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es "
    "el los las y por con para una su al lo como del se no más"
).split()
SYMBOLS = "#*$%&|<>"
#: The letters beyond ASCII of the languages that those words are from.
ACCENTS = "àâäæçèéêëíîïñóôöœùúûüÿßÀÂÄÆÇÈÉÊËÍÎÏÑÓÔÖŒÙÚÛÜŸẞ¿¡«»„“”‘’…–—"
PUNCTUATION = ".,;:!?\"'()[]"

#: measure, what it is divided by (None: itself), comparison that must hold, bound,
#: and, where the rule cannot judge every text, the rule that one it judges must meet.
#: Stop words are only asked of texts written in the letters of their languages.
#: Bounds leave ordinary prose far inside: in clean prose a word has 2 to 15
#: characters on average, under one symbol for ten words, and function words.
RULES = (
    ("n_words", None, ">=", 50),
    ("word_chars", "n_words", ">=", 2.0),
    ("word_chars", "n_words", "<=", 15.0),
    ("n_symbols", "n_words", "<=", 0.3),
    ("n_stop_words", "n_words", ">=", 0.02, ("n_foreign", "word_chars", "<=", 0.02)),
    ("n_dup_lines", "n_lines", "<=", 0.6),
    ("n_repeat_words", "n_words", "<=", 0.5),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "n_foreign")


def _repeat_words(hashes: F.Column) -> F.Column:
    """Words inside 3-word windows that occur at least twice, from the sorted
    array of (window hash, position)."""
    again = F.filter(hashes, lambda s, j: (F.get(hashes, j - 1)["h"] == s["h"]) | (F.get(hashes, j + 1)["h"] == s["h"]))
    return F.size(F.array_distinct(F.flatten(F.transform(
        again, lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2)))))


def measures(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` plus the columns of MEASURES (long)."""
    keep = [c for c in df.columns if c.lower() not in MEASURES]
    text = F.coalesce(F.col("__text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    d = df.select(*keep, F.col(text_col).alias("__text"))
    d = d.withColumn("__words", words("__text")).withColumn("__lines", lines)
    d = d.withColumn("__n", F.size("__words"))
    d = d.withColumn("__windows", F.when(F.col("__n") >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.col("__n") - 3),
        lambda i: F.struct(F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)).alias("h"),
                           i.alias("i"))))))
    bare = lambda w: F.lower(F.translate(w, PUNCTUATION + SYMBOLS, ""))
    out = {
        "n_words": F.col("__n"),
        "word_chars": F.length(F.translate(text, BLANKS, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(F.when(F.col("__n") >= 3, _repeat_words(F.col("__windows"))), F.lit(0)),
        "n_stop_words": F.size(F.filter("__words", lambda w: bare(w).isin(STOP_WORDS))),
        "n_lines": F.size("__lines"),
        "n_foreign": F.length(F.translate(text, "".join(map(chr, range(1, 128))) + ACCENTS, "")),
    }
    # through a generator of one row, so that a filter on a measure is not pushed below, where
    # its expressions would replace the columns they are built from, again and again
    return d.select(*keep, F.inline(F.array(F.struct(*[v.cast("long").alias(k) for k, v in out.items()]))))


def verdict(rules=RULES) -> F.Column:
    """One boolean expression: every row of the threshold table holds. A ratio
    ``a / b <= bound`` is compiled as ``a <= bound * b``, so nothing is divided."""
    def holds(measure, base, op, bound, scope=None) -> F.Column:
        left, right = F.col(measure), F.lit(bound) if base is None else F.lit(float(bound)) * F.col(base)
        rule = left >= right if op == ">=" else left <= right
        return rule if scope is None else rule | ~holds(*scope)

    ok = F.lit(True)
    for r in rules:
        ok = ok & holds(*r)
    return ok


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(df: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """``df`` plus the measures, ``base_failed`` and ``kept``."""
    d = measures(df.drop("base_failed", "kept"), text_col)
    return d.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & verdict(rules))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept")


def kept_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep."""
    return judge(docs).where("kept").select(*docs.columns)


def _rule_sql() -> str:
    def holds(measure, base, op, bound, scope=None) -> str:
        right = f"{bound}" if base is None else f"{float(bound)}::DOUBLE * {base}"
        rule = f"{measure} {op} {right}"
        return rule if scope is None else f"({rule} OR NOT {holds(*scope)})"

    return " AND ".join(holds(*r) for r in RULES)


def measures_sql(source: str = "documents") -> str:
    stops = ", ".join("'" + w + "'" for w in STOP_WORDS)
    punct = "[" + "".join("\\" + c if c not in "'" else "''" for c in PUNCTUATION + SYMBOLS) + "]"
    return f"""
  WITH t AS (SELECT *, coalesce(text, '') AS s, row_number() OVER () AS rid FROM {source}),
  w AS (SELECT rid, regexp_extract_all(s, '[^\\x20\\x09-\\x0D]+') AS ws FROM t),
  win AS (SELECT rid, i, ws[i] || chr(1) || ws[i + 1] || chr(1) || ws[i + 2] AS g
          FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
  rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
  cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, range(3) AS r(k) GROUP BY rid),
  ln AS (SELECT rid, list_filter(string_split(s, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
  m AS (SELECT t.* EXCLUDE (s), len(ws)::BIGINT AS n_words,
         length(regexp_replace(s, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(s) - length(regexp_replace(s, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(ws, lambda x: lower(regexp_replace(x, '{punct}', '', 'g')) IN ({stops})))::BIGINT AS n_stop_words,
         len(ls)::BIGINT AS n_lines, length(regexp_replace(s, '[\\x00-\\x7F{ACCENTS}]', '', 'g'))::BIGINT AS n_foreign
       FROM t JOIN w USING (rid) JOIN ln USING (rid) LEFT JOIN cov USING (rid)),
  judged AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
  SELECT * EXCLUDE (rid), (NOT base_failed AND {_rule_sql()}) AS kept FROM judged"""


OP9_SQL = f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM ({measures_sql()})"
