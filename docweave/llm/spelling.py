"""Spelling variant grouping with PartEnum signatures.

Words that differ by one inserted, deleted or replaced code point have letter
multisets that differ in one or two members. A multiset is a binary vector, one
dimension per (letter, which occurrence of it), and such words are at Hamming
distance two at most. PartEnum deals the dimensions over ``GROUPS`` groups by a
hash: two differences touch at most two groups, so the words agree on all of
some choice of ``GROUPS`` - 2 of them. Every choice of groups with the word's
dimensions in them is one signature, 28 a word; words that share a signature
meet in an equi-join, whose condition verifies the edit distance on the words.

Counting is one pass over the texts in built-in functions: runs of five or more
letters, their checksum, partial sums before the only shuffle of words. What
follows grows with the distinct words, not with the text. A signature that many
words have is a key of a sort-merge join, which Spark splits; no group is ever
gathered, and only near pairs leave the join. The joins ask for a sort-merge join:
Spark takes the signatures (28 rows a word, made in Python) for as small as the
words' compressed file, and would gather them on the driver to broadcast them. A word's form has at least twice
its occurrences, so chains of forms are as short as the logarithm of the largest
count, and roots are found by doubling.

Defined cases: a null text has no runs, a null doc_id counts as an empty string
before the colon; a document that is there twice counts twice; very long texts
are one row, very long runs one word; ties of n go to the smallest word in
code-point order; an empty table gives no rows; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import hold, materialize, prepare, table
from docweave.llm.shingles import GOLDEN, U, mix

LEAST_LENGTH = 5
LEAST_COUNT = 3
SLIP = 97     # one run in so many, by its checksum, loses a code point
GROUPS = 8
DIFFER = 2    # dimensions that near words differ in at most
TIMES = 2     # how much more frequent a form is
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words with at least LEAST_LENGTH code points and LEAST_COUNT
    occurrences. Runs that are too short are never extracted."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit("[a-z\\u00C0-\\u00FF]{%d,}" % LEAST_LENGTH), F.lit(0))
    r = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    r = r.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    w = r.select(F.when(F.col("h") % SLIP == 0, short).otherwise(F.col("run")).alias("word"))
    return w.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def signature_matrix(words: list[str], groups: int = GROUPS, differ: int = DIFFER) -> np.ndarray:
    """uint64 signatures, a row for each word: one for every choice of all groups but
    ``differ``, a hash of the word's dimensions in them."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    order = np.lexsort((points, owner))
    points, owner = points[order], owner[order]
    new = np.ones(len(points), bool)
    new[1:] = (points[1:] != points[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    occurrence = np.arange(len(points)) - np.repeat(first, np.diff(np.append(first, len(points))))
    dims = mix((points.astype(np.uint64) << U(32)) + occurrence.astype(np.uint64) + U(GOLDEN))
    held = np.zeros((len(words), groups), np.uint64)
    np.add.at(held, (owner, (dims % U(groups)).astype(np.int64)), mix(dims))
    out = [mix(held[:, list(c)].sum(1, dtype=np.uint64) + U(k + 1) * mix(np.array([GOLDEN], np.uint64)))
           for k, c in enumerate(combinations(range(groups), groups - differ))]
    return np.stack(out, 1)


def signed_words(words: DataFrame) -> DataFrame:
    """(sig, word, n) rows, one for each signature of a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("spelling", lambda: None)  # lets go of what other operators kept
        for b in batches:
            if b.num_rows:
                s = signature_matrix(b.column(0).to_pylist())
                again = pa.array(np.repeat(np.arange(len(s)), s.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64).ravel()), b.column(0).take(again), b.column(1).take(again)], names=["sig", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "sig long, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """Distinct (a, an, b, bn), a < b, of words that differ by one code point."""
    signed = signed_words(words)
    left = signed.select("sig", F.col("word").alias("a"), F.col("n").alias("an"))
    right = signed.select("sig", F.col("word").alias("b"), F.col("n").alias("bn"))
    near = (F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    return left.join(right.hint("merge"), "sig").where(near).select("a", "an", "b", "bn").distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms, by doubling."""
    r = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = r.select(F.col("word").alias("root"), F.col("root").alias("next"))
        r = materialize(r.join(on.hint("merge"), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if r.where("moved").isEmpty():
            return r.select("word", "root")
        r = r.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    prepare(docs.sparkSession)
    words = materialize(word_counts(docs, id_col, text_col), "spelling-words")
    pairs = materialize(near_pairs(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("bn").alias("an"), F.col("a").alias("b"), F.col("an").alias("bn")))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("bn")).alias("m"), "b")).alias("best"))
    out = words.join(best.hint("merge"), "word", "left")
    real = -F.col("best.m") >= TIMES * F.col("n")
    out = materialize(out.select("word", F.when(real, F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(real, -F.col("best.m")).alias("form_n")), "spelling-forms")
    roots = last_forms(out.where("form IS NOT NULL"))
    return out.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The checksum is computed in SQL, byte by byte, from its reversed polynomial.
OP13_SQL = f"""WITH RECURSIVE crc(t) AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS keyed, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]{{{LEAST_LENGTH},}}')) AS run FROM documents)
  GROUP BY doc_id, run),
summed AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, octet_length(encode(keyed)) + 1), lambda i: ('0x' || substr(hex(encode(keyed)), 2 * i - 1, 2))::BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS h FROM runs, crc),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % {SLIP} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM summed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {LEAST_COUNT}),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, length(word) + 1) p(i)),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= {TIMES} * w.n THEN other END AS form,
    CASE WHEN m >= {TIMES} * w.n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)),
chain(word, root) AS (
  SELECT word, form FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM forms f LEFT JOIN ends e ON e.word = f.word"""
