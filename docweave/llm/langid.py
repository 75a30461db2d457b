"""Language identification by prediction by partial matching (PPM).

For every language a variable-order tree of byte contexts is counted on
labelled texts and frozen. A text's code length under a language is the sum
over its bytes of -log2 p(byte | the longest known context of up to ``order``
bytes before it): a context that has not seen the byte pays its escape
probability d / (n + d) (n bytes seen, d distinct ones) and passes on to the
context one byte shorter, whose seen bytes are excluded; below the empty
context every byte is equally likely. So every context's probabilities sum to
one and the code lengths are exact. The shortest code wins; ``score`` is that
language's posterior under equal priors.

The trees are fitted on a bounded sample: per language about ``sample_bytes``
bytes, fewer if ``TOTAL_BYTES`` would be passed, of texts chosen by a hash of the
text among the language's distinct ones, at least one: copies of a text
change nothing. A text over ``max_text_bytes`` takes part in pieces, each drawn by
itself, so a language of long texts only is learned as well. Counts are made in Spark and summed by (language, order, gram); what
reaches the driver is bounded by the sample. The workers keep every counted
(context, byte) pair and every context's escape, per language, in sorted
arrays (``Sparse``), so their memory follows the sample and no context is left
out; the distinct four-byte windows of a slice of text are looked up once.
``Trees`` is the same code as one dense table, which tests hold it against.

Defined cases: null text, or a text without a letter, is ``und`` with score 0
(so is everything if nothing can be learned); equal code lengths go to the
first language in code-point order; an empty table gives no rows; a very long
text is scored in slices with carried context, so memory stays bounded; extra
columns are carried along, those named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import hold, prepare, table, without

ORDER = 3
SAMPLE_BYTES = 400_000
MAX_TEXT_BYTES = 50_000
TOTAL_BYTES = 64_000_000  # of the samples of all languages, beyond one text each
SLICE = 1 << 18         # bytes scored at a time
OUT = ("lang_pred", "score")


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _grams(data: bytes, order: int) -> np.ndarray:
    """Codes of the (order + 1)-byte windows that end at each byte of ``data``
    after its first ORDER bytes (which are only context)."""
    b = np.frombuffer(data, np.uint8).astype(np.int64)
    code = np.zeros(len(b) - ORDER, np.int64)
    for k in range(order, -1, -1):
        code = (code << 8) | b[ORDER - k:len(b) - k]
    return code


PAD = b"\n" * ORDER


def count_grams(sample: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, k, gram, n): how often a byte followed its k bytes of context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(PAD + text.encode())
            for lang, texts in by.items():
                for k in range(ORDER + 1):
                    gram, n = np.unique(np.concatenate([_grams(t, k) for t in texts]), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array([k] * len(gram), pa.int32()),
                         pa.array(gram, pa.int64()), pa.array(n, pa.int64())], names=["lang", "k", "gram", "n"])

    counted = sample.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        run, "lang string, k int, gram long, n long")
    return counted.groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", sample_bytes: int = SAMPLE_BYTES,
          max_text_bytes: int = MAX_TEXT_BYTES) -> dict:
    """Frozen statistics: {"langs": [...], "k", "lang", "gram", "n": arrays}."""
    prepare(labelled.sparkSession)
    text, wide = F.col(text_col), max(1, max_text_bytes // 4)  # characters of a piece: at most four bytes each
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / wide)), lambda i: F.substring(text, (i * wide + 1).cast("int"), F.lit(wide)))
    texts = labelled.where(F.col(lang_col).isNotNull() & (F.octet_length(text) > 0)).select(
        F.col(lang_col).alias("lang"), F.explode(F.when(F.octet_length(text) <= max_text_bytes, F.array(text)).otherwise(pieces)).alias("text"))
    usable = texts.select("lang", "text", F.octet_length("text").alias("size"), F.xxhash64(F.lit("langid"), "text").alias("hash"))
    draw = F.pmod("hash", F.lit(1 << 30)) / float(1 << 30)
    distinct = usable.groupBy("lang", "hash").agg(F.max("size").alias("size"))
    found = distinct.groupBy("lang").agg(F.sum("size"), F.min(draw)).collect()
    if not found:
        return {"langs": []}
    # one short row a language, which the driver holds already: small enough to broadcast
    share = min(sample_bytes, TOTAL_BYTES // len(found))
    langs = sorted(r[0] for r in found)
    limits = labelled.sparkSession.createDataFrame([(r[0], float(max(share / r[1], r[2]))) for r in found], "lang string, most double")  # the smallest draw is always in
    sample = usable.join(F.broadcast(limits), "lang").where(draw <= F.col("most")).groupBy("lang", "hash").agg(F.min("text").alias("text"))
    counts = count_grams(sample, "lang", "text").toPandas()
    code = {x: i for i, x in enumerate(langs)}
    return {"langs": langs, "lang": counts["lang"].map(code).to_numpy(np.int64), "k": counts["k"].to_numpy(np.int64),
            "gram": counts["gram"].to_numpy(np.int64), "n": counts["n"].to_numpy(np.int64)}


class Trees:
    """The frozen trees as dense tables, for comparison. ``state[last three bytes]`` is the longest
    context known to any language; ``cost[state * 256 + byte]`` has the code
    length of the byte there for each language. ``max_cells`` leaves out the rarest
    longest contexts; by default none."""

    def __init__(self, model: dict, max_cells: int | None = None):
        langs = len(model["langs"])
        known = {k: np.unique(model["gram"][model["k"] == k] >> 8, return_inverse=True) for k in range(1, ORDER + 1)}
        room = max(0, (max_cells or 0) // (256 * langs) - 1 - sum(len(known[k][0]) for k in range(1, ORDER)))
        if max_cells is not None and len(known[ORDER][0]) > room:  # the most frequent longest contexts
            ctx, inverse = known[ORDER]
            seen = np.bincount(inverse, weights=model["n"][model["k"] == ORDER], minlength=len(ctx))
            known[ORDER] = (np.sort(ctx[np.argsort(-seen, kind="stable")[:room]]), None)
        first, states = {}, 1
        for k in range(1, ORDER + 1):
            first[k] = states
            states += len(known[k][0])
        prob = np.empty((langs, states, 256), np.float32)
        number = np.uint16 if states < 1 << 16 else np.int32
        self.state = np.zeros(1, number)
        parents = np.zeros(1, np.int64)
        for k in range(ORDER + 1):
            if k:
                ctx = known[k][0]
                parents = self.state[ctx & (256 ** (k - 1) - 1)].astype(np.int64)
                self.state = np.tile(self.state, 256)
                self.state[ctx] = np.arange(first[k], first[k] + len(ctx), dtype=number)
            for x in range(langs):
                if k:
                    rows = prob[x, parents].astype(np.float64)
                else:
                    rows = np.full((1, 256), 1 / 256)
                mine = (model["lang"] == x) & (model["k"] == k)
                c, sym, n = model["gram"][mine] >> 8, model["gram"][mine] & 255, model["n"][mine]
                if k:
                    at = np.searchsorted(ctx, c)
                    ok = (at < len(ctx)) & (ctx[np.minimum(at, max(0, len(ctx) - 1))] == c) if len(ctx) else np.zeros(len(c), bool)
                    at, sym, n = at[ok], sym[ok], n[ok]
                else:
                    at = np.zeros(len(c), np.int64)
                total = np.bincount(at, weights=n, minlength=len(rows))
                kinds = np.bincount(at, minlength=len(rows))
                rest = rows.copy()
                rest[at, sym] = 0  # exclusion: what the context has seen
                mass = rest.sum(1)
                escape = np.where(mass > 0, kinds / np.maximum(total + kinds, 1), 0.0)
                hit = kinds > 0
                rest[hit] *= (escape[hit] / np.maximum(mass[hit], 1e-300))[:, None]
                rest[at, sym] = n / total[at] * (1 - escape[at])
                prob[x, first.get(k, 0):first.get(k, 0) + len(rows)] = np.where(hit[:, None], rest, rows)
        np.log2(prob, out=prob)
        np.negative(prob, out=prob)
        self.cost = np.ascontiguousarray(prob.transpose(1, 2, 0)).reshape(states * 256, langs)
        self.langs = langs

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of every text under every language."""
        out = np.zeros((len(texts), self.langs))
        group: list[tuple[int, bytes]] = []
        held = 0
        for i, t in enumerate(texts):
            t = PAD + t
            for at in range(0, max(1, len(t) - ORDER), SLICE):
                group.append((i, t[at:at + SLICE + ORDER]))
                held += len(group[-1][1])
                if held >= SLICE:
                    self._add(out, group)
                    group, held = [], 0
        if group:
            self._add(out, group)
        return out

    def _add(self, out: np.ndarray, group: list[tuple[int, bytes]]) -> None:
        group = [g for g in group if len(g[1]) > ORDER]
        if not group:
            return
        b = np.frombuffer(b"".join(g[1] for g in group), np.uint8).astype(np.int32)
        starts = np.cumsum([0, *(len(g[1]) for g in group)])
        cuts = np.empty(2 * len(group), np.int64)
        cuts[0::2] = starts[:-1]             # a slice's own bytes ...
        cuts[1::2] = starts[1:] - ORDER      # ... end where the next one's context begins
        np.add.at(out, [g[0] for g in group], self._sums(b, cuts[:-1]))

    def _sums(self, b: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        before = (b[:-3] << 16) | (b[1:-2] << 8) | b[2:-1]
        cost = self.cost[self.state[before].astype(np.int64) * 256 + b[3:]]
        return np.add.reduceat(cost, cuts, axis=0, dtype=np.float64)[0::2]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted value is among the sorted keys, and where."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


class Sparse(Trees):
    """The frozen trees as sorted arrays: per language and order the seen grams
    (context and byte) with their code lengths, and the contexts with what an
    unseen byte pays before the next shorter context codes it."""

    def __init__(self, model: dict):
        self.langs = len(model["langs"])
        self.own: list[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = []
        for x in range(self.langs):
            self.own.append([])
            for k in range(ORDER + 1):
                mine = (model["lang"] == x) & (model["k"] == k)
                gram, n = model["gram"][mine].astype(np.uint32), model["n"][mine]
                order = np.argsort(gram)
                gram, n = gram[order], n[order]
                ctx, at = np.unique(gram >> 8, return_inverse=True)
                total, kinds = np.bincount(at, n, len(ctx)), np.bincount(at, minlength=len(ctx))
                below = np.exp2(-self._bits(x, gram, k - 1))
                mass = np.where(kinds < 256, 1 - np.bincount(at, below, len(ctx)), 0.0)  # of the unseen
                escape = np.where(mass > 0, kinds / (total + kinds), 0.0)
                back = np.log2(np.where(mass > 0, mass / np.where(mass > 0, escape, 1), 1.0))
                self.own[x].append((gram, -np.log2(n / total[at] * (1 - escape[at])), ctx, back))

    def _bits(self, x: int, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Code length under language x of each gram's last byte after up to
        ``order`` of the bytes before it."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for k in range(order, -1, -1):
            seen, cost, ctx, back = self.own[x][k]
            g = grams[left] & np.uint32((1 << 8 * (k + 1)) - 1)
            ok, at = _find(seen, g)
            out[left[ok]] += cost[at[ok]]
            left, g = left[~ok], g[~ok] >> 8
            ok, at = _find(ctx, g)
            out[left[ok]] += back[at[ok]]
        out[left] += 8
        return out

    def _sums(self, b: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        b = b.astype(np.uint32)
        grams, at = np.unique((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:], return_inverse=True)
        return np.stack([np.add.reduceat(self._bits(x, grams)[at], cuts)[0::2] for x in range(self.langs)], 1)


def predict(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and score."""
    import uuid
    prepare(docs.sparkSession)
    name, langs = uuid.uuid4().hex, model["langs"]
    base = without(docs, *OUT)
    if not langs:
        return base.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = hold(name, lambda: Sparse(shared.value))
        for batch in batches:
            *kept, text, letters = batch.columns
            texts = [t.as_py().encode() if ok.as_py() else b"" for t, ok in zip(text, letters, strict=True)]
            bits = trees.lengths(texts)
            best = bits.argmin(1)
            post = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
            known = letters.to_numpy(zero_copy_only=False).astype(bool)
            pred = [langs[i] if ok else "und" for i, ok in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pred, pa.string()), pa.array(np.where(known, post, 0.0))],
                                             names=[*batch.schema.names[:-2], *OUT])

    schema = base.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return base.withColumns({"__text": F.col(text_col), "__letters": letters}).mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Learn from the labelled documents that are not held out, predict all."""
    return predict(docs, learn(docs.where(~held_out(id_col)), lang_col, text_col), text_col)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score")


def identified_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in some language, ``lang`` set to the prediction.
    Only texts that have no letter (``und``) or whose best language has under
    half of the posterior go."""
    found = predict(docs, learn(docs.where(~held_out())))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5)).withColumn(
        "lang", F.col("lang_pred")).select(*docs.columns)
