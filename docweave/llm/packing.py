"""Best-fit packing: bounded-space online best-fit.

Documents are tokenized once, inside the scan's tasks, into pieces of at most
``capacity`` tokens (only documents over it are cut), written as narrow rows
(no ids, only their checksum) and counted. Pieces are then dealt at random
over as many groups as the counted tokens need (``GROUP_SEQUENCES`` sequences
each, so a group's size does not grow with the input) and every group is
packed online by one streaming pass: ``OPEN_BINS`` bins stay open, kept in a
bitset whose bit f says that a bin with f free tokens is open. A piece goes to
the lowest set bit at or above its length (best fit); if there is none a new
bin opens, and when too many are open the fullest (the lowest set bit) closes.
A task holds the open bins and one Arrow batch, whatever the group holds.

Defined cases: a null or empty text is one piece holding the end id only; a
document of n * capacity tokens fills n sequences; repeated rows are packed
each (group numbers come from row positions, so copies of one id spread over
all groups); an empty table gives no rows; extra columns are ignored.

Token ids are those of the ``tokenizers`` library for the whole text. The
vocabulary drops white space and encodes word by word, so the ids of each distinct
word are looked up in a bounded cache per worker; a text that holds the string of a
special token is encoded as a whole, by which the string becomes that token's id.
"""

from __future__ import annotations

import gc
import random
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import hold, materialize, prepare, table

CAPACITY = 4096
END_ID = 1
OPEN_BINS = 64
GROUP_SEQUENCES = 2048
TEXTS = 500             # texts encoded together
CACHE_WORDS = 300_000   # words kept by a worker before the cache starts anew (the one before is kept too)
CACHE_CHARS = 64        # longer words are not kept

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ord long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """ids of texts as little-endian unsigned 32-bit bytes. A text is cut into words
    as the vocabulary's own rule does, its chunks with letters beyond the Latin
    blocks stay whole, and each word or chunk is looked up. New words are encoded
    together: the last id of each word is marked as such in the vocabulary."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known, self.old = {}, {}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), 1000):
            part = words[at:at + 1000]
            ids = self._encode([" ".join(part)])[0]
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                raise ValueError("the vocabulary does not mark the ends of words")
            data, before = ids.tobytes(), 0
            for w, cut in zip(part, (4 * cuts).tolist(), strict=True):
                self.known[w] = data[before:cut]
                before = cut

    def _learn(self, keys: set[str]) -> None:
        words, far = [], []
        for k in keys:
            if k in self.old:
                self.known[k] = self.old[k]
            elif k.isascii() or not _FAR.search(k):
                words.append(k)
            else:
                far.append(k)
        self._learn_words(words)
        if far:
            self.known.update(zip(far, (i.tobytes() for i in self._encode(far)), strict=True))

    def ids(self, texts: list[str]) -> list[bytes]:
        gc.disable()  # many small strings, no cycles: collections would only walk the cache
        try:
            if len(self.known) > CACHE_WORDS:
                self.known, self.old = {}, self.known
            look, found, gaps = self.known.get, [], []
            for t in texts:
                if self.special and self.special.search(t):
                    found.append([self._encode([t])[0].tobytes()])
                    continue
                words = _cut(t)
                found.append(list(map(look, words)))
                if None in found[-1]:
                    gaps += [(found[-1], i, words[i]) for i, v in enumerate(found[-1]) if v is None]
            new = {w for _, _, w in gaps}
            self._learn(new)
            for values, i, w in gaps:
                values[i] = self.known[w]
            for w in new:
                if len(w) > CACHE_CHARS:
                    del self.known[w]
            return [b"".join(v) for v in found]
        finally:
            gc.enable()


def _lower_class(kind: str) -> str:
    """The characters of a Unicode category that lower-cased text of the Latin blocks can hold."""
    lower = {c for i in range(0x250) for c in chr(i).lower()}
    return "".join(re.escape(c) for c in sorted(lower) if unicodedata.category(c).startswith(kind))


_BLANK = "\x20\x09-\x0d"
#: Beyond the Latin blocks; U+0130 has a lower case of two characters.
_FAR = re.compile("[\u0130\u0250-\U0010ffff]")
_FAR_CHUNK = re.compile(f"([^{_BLANK}]*[\u0130\u0250-\U0010ffff][^{_BLANK}]*)")
# How the vocabulary's file cuts lower-cased words, for ASCII text and in general.
_ASCII_WORD = re.compile(f"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-z0-9{_BLANK}]+")
_LATIN_WORD = re.compile("[{0}]+|[{1}]|'(?:s|t|re|ve|m|ll|d)|[^{0}{1}{2}\x85\xa0]+".format(
    _lower_class("L"), _lower_class("N"), _BLANK))


def _cut(text: str) -> list[str]:
    """The words and far chunks of a text, in order."""
    if text.isascii():
        return _ASCII_WORD.findall(text.lower())
    if not _FAR.search(text):
        return _LATIN_WORD.findall(text.lower())
    out: list[str] = []
    for i, part in enumerate(_FAR_CHUNK.split(text)):
        if i % 2:
            out.append(part)
        else:
            out += _LATIN_WORD.findall(part.lower())
    return out


def tokenize(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """PIECES rows of every document."""
    path = tokenizer_path or default_tokenizer()
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = hold(path, lambda: WordEncoder(path))
        part = TaskContext.get().partitionId()
        deal = random.Random(part)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ord")}
            for first in range(0, batch.num_rows, TEXTS):
                part = batch.slice(first, TEXTS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.ids(texts), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at:at + 4 * capacity]
                        for name, v in zip(out, (doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece), deal.getrandbits(62)), strict=True):
                            out[name].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in out.items()], names=list(out))

    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, PIECES)


class OpenBins:
    """At most ``limit`` open bins in a bitset keyed by free space."""

    def __init__(self, capacity: int, limit: int, first: int):
        self.capacity, self.limit, self.next_id, self.open, self.bits = capacity, limit, first, 0, 0
        self.at: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        bins = self.at[free]
        if len(bins) == 1:
            self.bits ^= 1 << free
        self.open -= 1
        return bins.pop()

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            seq = self._take(free)
        else:
            free, seq = self.capacity, self.next_id
            self.next_id += 1
        rest = free - length
        if rest:
            if self.open == self.limit:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.at.setdefault(rest, []).append(seq)
            self.bits |= 1 << rest
            self.open += 1
        return seq, self.capacity - free


def pack(pieces: DataFrame, groups: int, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """PIECES rows -> PACKED rows; every group is packed by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins = None, None
        for batch in batches:
            seqs, offsets = [], []
            for g, length in zip(batch.column("grp").to_pylist(), batch.column("length").to_pylist(), strict=True):
                if g != group:
                    group, bins = g, OpenBins(capacity, open_bins, g << 40)
                seq, offset = bins.place(length)
                seqs.append(seq)
                offsets.append(offset)
            cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seqs, pa.int64()), pa.array(offsets, pa.int64())],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    dealt = pieces.withColumn("grp", F.pmod("ord", F.lit(groups)).cast("long"))
    return (dealt.repartition(groups, "grp").sortWithinPartitions("grp", "ord", "doc_id", "piece")
            .mapInArrow(run, PACKED))


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
                   open_bins: int = OPEN_BINS, group_sequences: int = GROUP_SEQUENCES) -> DataFrame:
    """Tokenize, count, deal, pack: one PACKED row per piece."""
    pieces = materialize(tokenize(docs, tokenizer_path, capacity), "pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (capacity * group_sequences)))
    return pack(pieces, groups, capacity, open_bins)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (the last): where each piece of each document goes."""
    return pack_documents(docs.select("doc_id", "text"))
