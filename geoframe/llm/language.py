"""Language identification by n-gram filters whose every position holds one bit for each language."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoframe.llm.common import cut, steps, table

UNKNOWN = "und"
#: Of every so many documents one is held out and never learned from.
FOLDS = 5
#: About so many different texts of each language are learned from, those with the least hash.
SAMPLE = 4_000
#: Characters of an n-gram; a space stands at either end of a word only.
ORDERS = (2, 3, 4)
#: A language has an n-gram if this part of its texts does, and of the part that has it in the language where it is most common.
SHARE, RATIO = 0.01, 0.25
#: Positions of the filter as a power of two; each n-gram has HASHES of them, slices of its 64-bit hash.
BITS, HASHES = 20, 3
#: Characters that are worked off at once.
SLICE = 1 << 20
SPACE = 32


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out by its id; a null id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, number of its text) of every n-gram of all texts, in slices of bounded size, texts in order within an n-gram's length.

    Texts are in lower case; what isn't a letter is a space, runs of spaces are one, and a space
    stands before and after each text. N-grams with a space inside are left out, so none spans two
    words or two texts.
    """
    parts, owner = [np.array([SPACE], np.uint32)], [np.array([0], np.int64)]
    for k, text in enumerate(texts):
        code = _codes(text)
        parts += [np.where(_letters()[code], code, SPACE), parts[0]]
        owner.append(np.full(len(code) + 1, k))
    code, owner = np.concatenate(parts), np.concatenate(owner)
    blank = code == SPACE
    keep = ~blank | np.append(True, ~blank[:-1])
    code, owner = code[keep].astype(np.uint64), owner[keep]
    for first in range(0, len(code), SLICE):
        piece, of = code[first : first + SLICE + max(ORDERS) - 1], owner[first : first + SLICE + max(ORDERS) - 1]
        inner = piece != SPACE
        value = piece.copy()
        for n in range(2, max(ORDERS) + 1):
            size = min(len(piece) - n + 1, SLICE)
            if size <= 0:
                break
            value = value[: len(piece) - n + 1] * np.uint64(0x100000001B3) ^ piece[n - 1 :]
            if n in ORDERS:
                whole = np.ones(size, bool)
                for k in range(1, n - 1):
                    whole &= inner[k : k + size]
                yield _mixed(value[:size][whole] + np.uint64(n)), of[1 : 1 + size][whole]


def _mixed(value: np.ndarray) -> np.ndarray:
    """64-bit values with every bit dependent on all others."""
    value = (value ^ value >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ value >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return value ^ value >> np.uint64(31)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (lang, text): (lang, gram, texts), in how many of a batch's texts an n-gram is; a null gram counts the texts."""
    for batch in steps(batches, 256):
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        of_lang: dict[str, list[np.ndarray]] = {}
        own: dict[int, list[np.ndarray]] = {}
        for gram, of in ngrams(texts):
            for k, value in zip(*_groups(of, gram)):
                own.setdefault(k, []).append(value)
        for k, lang in enumerate(langs):
            of_lang.setdefault(lang, []).append(np.unique(np.concatenate(own.get(k, [np.empty(0, np.uint64)]))))
        for lang, found in of_lang.items():
            gram, seen = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(gram) + 1)), pa.array([None, *gram.view(np.int64)], pa.int64()), pa.array([len(found), *seen], pa.int64())], ["lang", "gram", "texts"])


def _groups(of: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values split where their rising group number changes."""
    if not len(of):
        return [], []
    at = np.flatnonzero(np.diff(of)) + 1
    return of[np.concatenate(([0], at))].tolist(), np.split(values, at)


class Filters(NamedTuple):
    """Languages, the most common one first, and planes[p, position] with a bit for each of eight of them."""

    langs: list[str]
    planes: np.ndarray

    def false_positives(self) -> np.ndarray:
        """By language, the part of foreign n-grams that it seems to have: the part of its bits that are set to the power of HASHES."""
        fill = np.array([(self.planes[k // 8] >> k % 8 & 1).mean() for k in range(len(self.langs))])
        return fill**HASHES

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of each text, by text and language how many of them the filters say the language has)."""
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
        total, found = np.zeros(len(texts), np.int64), np.zeros((len(texts), 8 * len(self.planes)), np.int64)
        low = np.uint64((1 << BITS) - 1)
        for gram, of in ngrams(texts):
            total += np.bincount(of, minlength=len(texts))
            at = [(gram >> np.uint64(BITS * k) & low).astype(np.int64) for k in range(HASHES)]
            for p, plane in enumerate(self.planes):
                mask = plane[at[0]]
                for other in at[1:]:
                    mask = mask & plane[other]
                seen = np.bincount(of * 256 + mask, minlength=256 * len(texts)).reshape(len(texts), 256)
                found[:, 8 * p : 8 * p + 8] += seen @ bits
        return total, found[:, : len(self.langs)]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and the part of its n-grams that are the language's own, 0 to 1.

        Counts are corrected for false positives; of equal ones the more common language wins.
        """
        total, found = self.hits([t or "" for t in texts])
        wrong = self.false_positives()
        part = np.clip((found - total[:, None] * wrong) / (1 - np.minimum(wrong, 0.999)) / np.maximum(total, 1)[:, None], 0, 1)
        best = part.argmax(1) if self.langs else None
        known = (total > 0) & bool(self.langs)
        return [self.langs[best[k]] if ok else UNKNOWN for k, ok in enumerate(known)], np.array([part[k, best[k]] if ok else 0.0 for k, ok in enumerate(known)])


def fit_filters(docs: DataFrame, sample: int = SAMPLE) -> Filters:
    """Filters of all languages of (lang, text) rows; rows without either are left out.

    From each language about ``sample`` different texts are taken, the same part of every language's
    texts by their hash, so what is learned is as large for any number of documents, and a text with
    many copies counts once. The filters hold 2^BITS bytes for each eight languages.
    """
    given = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("h"))
    sizes = given.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    limit = sizes.select(F.col("lang").alias("of"), (F.lit(float(1 << 30)) * F.least(F.lit(1.0), sample / F.col("n"))).alias("limit"))
    near = given.join(F.broadcast(limit), (F.col("lang") == F.col("of")) & (F.pmod(F.xxhash64("h", F.lit(11)), F.lit(1 << 30)) < F.col("limit")))
    grams = near.select("lang", "text", "h").dropDuplicates(["lang", "h"]).select("lang", "text").mapInArrow(_counted, "lang string, gram long, texts long")
    counts = cut(grams.groupBy("lang", "gram").agg(F.sum("texts").alias("texts")))
    learned = counts.where("gram is null").orderBy(F.desc("texts"), "lang").collect()
    langs = [r.lang for r in learned]
    planes = np.zeros((-(-len(langs) // 8), 1 << BITS), np.uint8)
    if langs:
        numbered = docs.sparkSession.createDataFrame([(r.lang, k, r.texts) for k, r in enumerate(learned)], "lang string, k int, all long")
        share = counts.where("gram is not null").join(F.broadcast(numbered), "lang").select("gram", "k", (F.col("texts") / F.col("all")).alias("share"))
        common = share.withColumn("top", F.max("share").over(Window.partitionBy("gram"))).where((F.col("share") >= SHARE) & (F.col("share") >= RATIO * F.col("top")))
        slices = F.array(*(F.shiftrightunsigned("gram", BITS * k).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int") for k in range(HASHES)))
        placed = common.select("k", F.explode(slices).alias("position")).groupBy((F.col("k") / 8).cast("int").alias("plane"), "position")
        set_bits = placed.agg(F.bit_or(F.expr("shiftleft(1, k % 8)")).alias("bits")).toArrow()
        planes[set_bits["plane"].to_numpy(), set_bits["position"].to_numpy()] = set_bits["bits"].to_numpy()
    return Filters(langs, planes)


def predicted(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of docs, from its whole text alone.

    A null text, and one without a letter, has the language ``und`` and a score of 0, as has every
    text if no language was learned. Repeated rows give equal rows, an empty table none; other
    columns aren't read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 256):
            langs, scores = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(each, "doc_id long, lang_pred string, score double")


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = fit_filters(docs.where(~held_out(F.col("doc_id"))))
    return predicted(docs, filters).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.round("score", 6).alias("score"))
