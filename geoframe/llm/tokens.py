"""Token ids of whole texts by a public tokenizer file, and the separator scan over flat token files."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoframe.llm.common import REMEMBERED, stored, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Words of these characters only are cut where letters, single digits and other signs meet, as the tokenizer's own pattern cuts them; NFC leaves them alone and lower case maps each to one.
_PLAIN = re.compile(r"[!-&(-;=?-~A-Za-zÀ-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"[a-zà-öø-ÿß]+|[0-9]|[^a-zà-öø-ÿß0-9]+")


def _byte_letters() -> dict[int, str]:
    """How a byte-level model writes the characters of U+0080 to U+00FF: each UTF-8 byte as a printable letter, the other bytes as those from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {x: chr(x) for x in own} | {x: chr(256 + k) for k, x in enumerate(x for x in range(256) if x not in own)}
    return {x: "".join(letter[y] for y in chr(x).encode()) for x in range(0x80, 0x100)}


_BYTES = _byte_letters()
#: Words and pieces that a worker remembers before it starts anew.
_REMEMBERED = 300_000


class Encoder:
    """Ids of many texts at once, equal to the tokenizer's own on each whole text.

    For a tokenizer that drops white space, so that a text's ids are those of its words in turn: each
    different word of a batch is encoded once. ``plain`` tells whether special tokens in texts are
    ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.model = self.tokenizer.model
        self.words: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _piece(self, piece: str) -> tuple[int, ...]:
        found = self.pieces.get(piece)
        if found is None:
            written = piece if piece.isascii() else piece.translate(_BYTES)
            found = self.pieces[piece] = tuple([t.id for t in self.model.tokenize(written)])
        return found

    def _learn(self, words: list[str]) -> None:
        """Plain words go to the model in pieces, without the tokenizer's costly normalizing; all others are encoded as they are."""
        piece, whole, known = self._piece, [], self.words
        for word in words:
            low = word.lower()
            if low.isascii() and low.isalpha():
                known[word] = piece(low)
            elif _PLAIN.fullmatch(word):
                parts = _PIECES.findall(low)
                known[word] = piece(parts[0]) if len(parts) == 1 else tuple(chain.from_iterable(map(piece, parts)))
            else:
                whole.append(word)
        for word, found in zip(whole, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
            known[word] = tuple(found.ids)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts in turn as uint32, and where each text's end; null is empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        split = pc.ascii_split_whitespace(texts)
        flat = split.flatten()
        offsets = split.offsets.to_numpy()
        coded = flat.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.words) > _REMEMBERED:
            self.words.clear()
        if len(self.pieces) > _REMEMBERED:
            self.pieces.clear()
        if "" not in self.words:
            self.words[""] = ()
        known = self.words
        self._learn([x for x in names if x not in known])
        each = [known[x] for x in names]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        pool = np.fromiter(chain.from_iterable(each), np.uint32, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        word = coded.indices.to_numpy()
        count = sizes[word]
        total = np.concatenate(([0], np.cumsum(count)))
        ids = pool[np.repeat(begin[word] - total[:-1], count) + np.arange(total[-1])]
        return ids, total[offsets[1:]]


def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker's encoder for a file; its memory of words carries over from batch to batch."""
    if (path, plain) not in REMEMBERED:
        REMEMBERED[path, plain] = Encoder(path, plain)
    return REMEMBERED[path, plain]


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about so many bytes of text, a single longer text alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - 1) // most if len(sizes) else sizes
    edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(sizes)])).astype(int)
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def with_end(ids: np.ndarray, ends: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id ``last`` after each text."""
    ends = ends + np.arange(1, len(ends) + 1)
    out = np.empty(len(ids) + len(ends), np.uint32)
    own = np.ones(len(out), bool)
    own[ends - 1] = False
    out[own], out[ends - 1] = ids, last
    return out, ends


#: <|endoftext|> of word_bpe_49k; texts never give it, since their special strings are read as ordinary text here.
SEPARATOR = 49407
BLOCK = 1 << 16


def write_flat(docs: DataFrame, path: str = WORD_BPE, separator: int = SEPARATOR, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Flat token files without an index: (shard, block, ids) rows of little-endian uint32 ids and, apart, the order of documents.

    Each task writes one shard: the ids of its texts in turn, the separator after each, cut into blocks
    of ``block`` ids wherever that falls. Rows with ids are the file; rows with doc_id (ordinal >= 0)
    are the list of what was written, which the scan itself doesn't read. Null text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, written = TaskContext.get().partitionId(), 0, 0
        left = np.empty(0, np.uint32)
        encode = encoder(path, plain=True)

        def blocks(parts: list[np.ndarray], first: int) -> pa.RecordBatch:
            n = len(parts)
            return pa.record_batch([pa.array(np.full(n, shard)), pa.array(np.arange(first, first + n)), pa.array([x.astype("<u4").tobytes() for x in parts], pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)

        names = ["shard", "block", "ids", "ordinal", "doc_id"]
        for batch in batches:
            for part in slices(batch, 1):
                n = part.num_rows
                yield pa.record_batch([pa.array(np.full(n, shard)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(np.arange(written, written + n)), part.column(0)], names)
                written += n
                left = np.concatenate((left, with_end(*encode(part.column(1)), separator)[0]))
                full = len(left) // block
                if full:
                    yield blocks([left[k * block : (k + 1) * block] for k in range(full)], number)
                    number, left = number + full, left[full * block :]
        if len(left):
            yield blocks([left], number)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "shard long, block long, ids binary, ordinal long, doc_id long")


def scan_separators(blocks: DataFrame, separator: int = SEPARATOR, width: int = 4) -> DataFrame:
    """(shard, ordinal, start, n_tokens) of each document in flat files given as (shard, block, ids) rows.

    Each block is searched on its own, by one vector comparison. Only block lengths and separator
    places are shuffled; a running sum over a shard's blocks gives where each begins, and the
    separator before gives the start, however many blocks a document spans. Ids after the last
    separator of a shard are a document without an end and come out too. Empty blocks are allowed;
    null blocks are skipped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.frombuffer(data.as_buffer(), f"<u{width}")
                at = np.flatnonzero(ids == separator)
                n = len(at) + 1
                yield pa.record_batch([pa.array(np.full(n, shard)), pa.array(np.full(n, block)), pa.array(np.append(at, len(ids))), pa.array(np.arange(n) == n - 1)], ["shard", "block", "at", "is_end"])

    marks = blocks.where("ids is not null").select("shard", "block", "ids").mapInArrow(run, "shard long, block long, at long, is_end boolean")
    in_shard = Window.partitionBy("shard").orderBy("block", "at", "is_end")
    placed = marks.withColumn("before", F.sum(F.when(F.col("is_end"), F.col("at")).otherwise(0)).over(in_shard) - F.when(F.col("is_end"), F.col("at")).otherwise(0))
    placed = placed.withColumn("place", F.col("before") + F.col("at"))
    tail = placed.groupBy("shard").agg(F.max(F.when(F.col("is_end"), F.col("place"))).alias("place"), F.max(F.when(~F.col("is_end"), F.col("place"))).alias("last")).where("place > coalesce(last, -1) + 1").select("shard", "place")
    ends = placed.where("not is_end").select("shard", "place").union(tail)
    order = Window.partitionBy("shard").orderBy("place")
    start = F.coalesce(F.lag("place").over(order) + 1, F.lit(0))
    return ends.select("shard", (F.row_number().over(order) - 1).cast("long").alias("ordinal"), start.alias("start"), (F.col("place") - start).alias("n_tokens"))


def token_counts(docs: DataFrame, path: str = WORD_BPE, separator: int = SEPARATOR, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, shard, start, n_tokens) of each row: written as flat token files, counted by the scan of these alone."""
    files = stored(write_flat(docs, path, separator, block, id_col, text_col), "tokens")
    listed = files.where("ordinal is not null").select("shard", "ordinal", "doc_id")
    return listed.join(scan_separators(files.where("block is not null"), separator), ["shard", "ordinal"]).select("doc_id", "shard", "start", "n_tokens")


def op7_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")
