"""Exact removal of repeated byte strings, by longest-previous-factor arrays over bounded suffix orders.

Every string of ``length`` bytes holds a deterministic anchor (the leftmost least hash of GRAM bytes
in it), so equal strings have their anchor at the same offset. Offsets are cut into two cells, and
all strings of a cell share a core, the bytes that lie in each of them. Runs of strings meet on a
hash of the core; only what meets is sorted. Within a bucket of one core the suffix order of the
bytes around it, with ties in order of position, puts each string beside its previous smaller
position, the earlier match, and its next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import cut, merge_spans, table, text_bytes

GRAM = 32
#: A core met by more different runs than this is not sorted in one task: Spark groups hashes of its single strings, which is exact too.
BUCKET = 2048
#: Bytes that are sorted at once, beyond which a new batch of whole buckets begins.
CHUNK = 1 << 19
#: Long texts are scanned in pieces of so many string starts, which bounds memory.
STEP = 1 << 19
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of each GRAM bytes in the high 40 bits; the low 24 bits are zero."""
    size = 1 << max(12, len(data).bit_length())
    if size not in _TABLES:
        _TABLES[size] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    up, down = _TABLES[size]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    n = len(data) - GRAM + 1
    found = (total[GRAM:] - total[:n]) * down[:n]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found & np.uint64(0xFFFFFFFFFF000000)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours: suffix minima of one block of that width meet prefix minima of the next."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchored(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): maximal runs of string starts first..last whose strings have that anchor."""
    out = []
    for at in range(0, max(0, len(data) - length + 1), STEP):
        marked = _gram_hashes(data[at : at + STEP + length - 1])
        marked |= np.arange(len(marked), dtype=np.uint64)
        least = (_sliding_least(marked, length - GRAM + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        turn = np.flatnonzero(np.diff(least)) + 1
        first = np.concatenate(([0], turn))
        out.append((least[first] + at, first + at, np.append(turn, len(least)) - 1 + at))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def cell_width(length: int) -> int:
    return (length - GRAM + 2) // 2


def cells(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(at, first, last, cell): runs of string starts whose anchor offsets lie in one cell; all their strings hold the core from ``at`` on.

    The core has length - width + 1 bytes, width the number of offsets in a cell; a string that
    starts at p holds at - p bytes before the core and width - 1 - (at - p) after it.
    """
    anchor, first, last = anchored(data, length)
    width, out = cell_width(length), []
    for cell in (0, 1):
        at = anchor - cell * width
        start, stop = np.maximum(first, at - width + 1), np.minimum(last, at)
        ok = start <= stop
        out.append((at[ok], start[ok], stop[ok], np.full(int(ok.sum()), cell)))
    return tuple(np.concatenate(x) for x in zip(*out))


def longest_previous(rests: list[bytes], lead: np.ndarray, count: np.ndarray, bucket: np.ndarray, doc: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings that occur twice at least: (row, k, earlier), ordered by row and k.

    Row i stands for count[i] strings, the k-th being width bytes from rests[i][k] on around the core
    of bucket[i], lead[i] - k of them before the core, at the position (doc[i], first[i] + k). Ranks
    of prefixes of doubling length give the suffix order up to width; a prefix that occurs once ends
    there. In that order, ties by position, a string has a longest previous factor of the full
    length if and only if its previous neighbour is equal: that one is its previous smaller position.
    """
    sizes = np.array([len(x) for x in rests], np.int64)
    data = np.frombuffer(b"".join(rests) + bytes(8), np.uint8).astype(np.uint64)
    n = len(data) - 8
    begin = np.cumsum(sizes) - sizes
    room = np.repeat(begin + sizes, sizes) - np.arange(n)
    done = min(8, width)
    word = np.zeros(n, np.uint64)
    for k in range(done):
        word = (word << np.uint64(8)) | data[k : n + k]
    live = np.flatnonzero(room >= done)
    rank = np.full(n, -1, np.int64)
    rank[live] = np.unique(word[live], return_inverse=True)[1]
    while done < width:
        step = min(done, width - done)
        live = live[(room[live] >= done + step) & (np.bincount(rank[live], minlength=1)[rank[live]] > 1)]
        live = live[rank[live + step] >= 0]
        pair = rank[live] * (n + 1) + rank[live + step]
        rank = np.full(n, -1, np.int64)
        rank[live] = np.unique(pair, return_inverse=True)[1]
        done += step
    row = np.repeat(np.arange(len(rests)), sizes)[live]
    k = live - begin[row]
    ok = k < count[row]
    row, k, live = row[ok], k[ok], live[ok]
    offset = lead[row] - k
    order = np.lexsort((first[row] + k, doc[row], rank[live], offset, bucket[row]))
    keys = np.stack((bucket[row][order], offset[order], rank[live][order]))
    same = np.zeros(len(order), bool)
    same[1:] = (keys[:, 1:] == keys[:, :-1]).all(0)
    again = same.copy()
    again[:-1] |= same[1:]
    row, k, earlier = row[order][again], k[order][again], same[again]
    order = np.lexsort((k, row))
    return row[order], k[order], earlier[order]


def _unpack(pack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, at) of string starts: the high bits are first, then 12 bits each of last - first and at - first."""
    first = pack >> 24
    return first, first + (pack >> 12 & 4095), first + (pack & 4095)


def _runs(texts: DataFrame, length: int) -> DataFrame:
    """(core, whole, doc, text_id, pack) of every run; whole hashes all bytes of the run's strings and where the core lies in them."""
    width, core_bytes = cell_width(length), length - cell_width(length) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows: list[list[np.ndarray]] = []
            for doc, text_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                if len(text) < length:
                    continue
                at, first, last, cell = cells(np.frombuffer(text, np.uint8), length)
                n = len(at)
                core = np.fromiter((digest(text[x : x + core_bytes], c) for x, c in zip(at.tolist(), cell.tolist())), np.uint64, n)
                whole = np.fromiter((digest(text[a : b + length], x - a) for a, b, x in zip(first.tolist(), last.tolist(), at.tolist())), np.uint64, n)
                rows.append([core.view(np.int64), whole.view(np.int64), np.full(n, doc), np.full(n, text_id), first << 24 | (last - first) << 12 | at - first])
            if rows:
                yield pa.record_batch([pa.array(np.concatenate(x), pa.int64()) for x in zip(*rows)], ["core", "whole", "doc", "text_id", "pack"])

    return texts.select("doc", "text_id", "text").mapInArrow(run, "core long, whole long, doc long, text_id long, pack long")


def _rests(cut_at: DataFrame, length: int) -> DataFrame:
    """The bytes around the core, (core, kinds, doc, text_id, pack, rest), of the runs listed with each text."""
    core_bytes = length - cell_width(length) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text_id, text, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2)), batch.column(3)):
                parts = runs.values
                pack, core, kinds = (parts.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                first, last, at = _unpack(pack)
                rest = [text[a:x] + text[x + core_bytes : b + length] for a, b, x in zip(first.tolist(), last.tolist(), at.tolist())]
                yield pa.record_batch([pa.array(core), pa.array(kinds), pa.array(np.full(len(pack), doc)), pa.array(np.full(len(pack), text_id)), pa.array(pack), pa.array(rest, pa.binary())], ["core", "kinds", "doc", "text_id", "pack", "rest"])

    return cut_at.select("doc", "text_id", "text", "runs").mapInArrow(run, "core long, kinds long, doc long, text_id long, pack long, rest binary")


FOUND = "doc long, text_id long, first long, last long, earlier boolean"


def _spans(row: np.ndarray, k: np.ndarray, earlier: np.ndarray, doc: np.ndarray, text_id: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (k[1:] != k[:-1] + 1) | (earlier[1:] != earlier[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row)) - 1 if len(row) else begin
    r = row[begin]
    return pa.record_batch([pa.array(doc[r]), pa.array(text_id[r]), pa.array(first[r] + k[begin]), pa.array(first[r] + k[end]), pa.array(earlier[begin])], ["doc", "text_id", "first", "last", "earlier"])


def _sorted_buckets(rests: DataFrame, length: int) -> DataFrame:
    """FOUND of all runs in buckets of at most BUCKET, whole buckets at a time."""
    width = cell_width(length)

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts)
        core, doc, text_id, pack = (whole.column(c).to_numpy() for c in ("core", "doc", "text_id", "pack"))
        first, last, at = _unpack(pack)
        row, k, earlier = longest_previous(whole.column("rest").to_pylist(), at - first, last - first + 1, core, doc, first, width - 1)
        return _spans(row, k, earlier, doc, text_id, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            core = batch.column(0).to_numpy()
            sizes = np.fromiter((len(x) for x in batch.column(5).to_pylist()), np.int64, len(core))
            turns = np.flatnonzero(np.append(core[:1] != last if last is not None else [True], core[1:] != core[:-1]))
            begin = 0
            total = np.concatenate(([0], np.cumsum(sizes)))
            for turn in turns.tolist():
                if size + total[turn] - total[begin] >= CHUNK:
                    held.append(batch.slice(begin, turn - begin))
                    yield solve([x for x in held if x.num_rows])
                    held, size, begin = [], 0, turn
            held.append(batch.slice(begin))
            size += int(total[-1] - total[begin])
            last = core[-1] if len(core) else last
        if any(x.num_rows for x in held):
            yield solve([x for x in held if x.num_rows])

    return rests.select("core", "doc", "text_id", "pack", "kinds", "rest").repartition("core").sortWithinPartitions("core").mapInArrow(run, FOUND)


def _hashed_strings(rests: DataFrame, length: int) -> DataFrame:
    """FOUND of all runs in larger buckets: a row for each string, equal ones meet by a 128-bit hash."""
    width = cell_width(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for core, doc, text_id, pack, rest in zip(*(batch.column(c).to_pylist() for c in ("core", "doc", "text_id", "pack", "rest"))):
                first, last, at = pack >> 24, (pack >> 24) + (pack >> 12 & 4095), pack & 4095
                starts = np.arange(first, last + 1)
                n = len(starts)
                hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(rest[k : k + width - 1], (core + at - k) & 0xFFFFFFFFFFFFFFFF) for k in range(n)), "<i8").reshape(-1, 2)
                yield pa.record_batch([pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy()), pa.array(np.full(n, doc)), pa.array(np.full(n, text_id)), pa.array(starts)], ["h1", "h2", "doc", "text_id", "first"])

    strings = rests.mapInArrow(run, "h1 long, h2 long, doc long, text_id long, first long")
    # cut, so that the join has plain exchanges on both sides, of which Spark splits a string that very many runs have
    least = cut(strings.groupBy("h1", "h2").agg(F.min(F.struct("doc", "text_id", "first")).alias("least"), F.count("*").alias("n")).where("n > 1"))
    return strings.join(least, ["h1", "h2"]).select("doc", "text_id", "first", F.col("first").alias("last"), (F.struct("doc", "text_id", "first") != F.col("least")).alias("earlier"))


NO_ID = -(1 << 63)


def repeats(plain: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(found, copies): what repeats anywhere in the texts of plain (doc long, text_id long, text), taken as UTF-8 bytes.

    found: for one text of each group of equal texts (the smallest doc) the string starts first..last
    whose strings of ``length`` bytes occur elsewhere; earlier: at a smaller (doc, byte) too. copies:
    (doc, text_id, first_copy) of the texts that occur more than once.
    """
    if not 2 * GRAM <= length <= 4000:
        raise ValueError("length must be 64 to 4000 bytes")
    digest = plain.where(F.octet_length("text") >= length).select("doc", "text_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    group = digest.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc").alias("least")).where("n > 1")
    copies = digest.join(group, "digest").groupBy("doc", "text_id").agg(F.max(F.col("doc") == F.col("least")).alias("first_copy"))

    runs = _runs(plain.where(F.octet_length("text") >= length), length)
    key = F.xxhash64("text_id", "pack")
    # cut, so that both sides of the join are plain exchanges, of which Spark splits a core that very many runs have
    shared = cut(runs.groupBy("core").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo < hi").select("core"))
    alive = cut(runs.join(shared, "core"))
    single = alive.groupBy("core", "whole", "text_id", "pack").agg(F.min("doc").alias("doc"))
    entry = single.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct("doc", "text_id", "pack")).alias("rep"))
    kinds = entry.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1")
    first = F.shiftrightunsigned("pack", 24)
    again = cut(entry.where("n > 1").select("core", "whole", "rep"))
    equal = single.join(again, ["core", "whole"]).select("doc", "text_id", first.alias("first"), (first + F.shiftrightunsigned("pack", 12).bitwiseAND(F.lit(4095))).alias("last"), (F.struct("doc", "text_id", "pack") != F.col("rep")).alias("earlier"))
    need = entry.join(kinds, "core").select("rep.*", "core", "kinds").groupBy("doc", "text_id").agg(F.collect_list(F.struct("pack", "core", "kinds")).alias("runs"))
    rests = cut(_rests(plain.join(need, ["doc", "text_id"]), length))
    found = equal.union(_sorted_buckets(rests.where(F.col("kinds") <= BUCKET), length)).union(_hashed_strings(rests.where(F.col("kinds") > BUCKET), length))
    return found, copies


def strip(docs: DataFrame, length: int, keep_first: bool, out: str, make, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs joined with what ``make(text bytes, starts, ends)`` gives for the removed byte spans, in columns of the DDL ``out``.

    keep_first False removes every byte of a repeated string; True keeps the occurrence with the
    smallest (id, byte) of each string. Rows with a null id come first in that order. All rows and
    columns stay, repeated rows too; null text is treated as empty.
    """
    names = [f"given_{k}" for k in range(len(docs.columns))]
    text_at = docs.columns.index(text_col)
    text = F.coalesce(F.col(names[text_at]), F.lit(""))
    given = docs.toDF(*names).withColumns({"doc": F.coalesce(F.col(names[docs.columns.index(id_col)]).cast("long"), F.lit(NO_ID)), "text_id": F.xxhash64(text)})
    found, copies = repeats(given.select("doc", "text_id", text.alias("text")), length)
    if keep_first:
        found = found.where("earlier")
    spans = found.groupBy("doc", "text_id").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    joined = given.join(spans, ["doc", "text_id"], "left").join(copies, ["doc", "text_id"], "left")
    fields = joined.select(names).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = []
            copy = batch.column(len(names) + 1).to_pylist()
            for k, (text, runs) in enumerate(zip(text_bytes(batch.column(text_at)), batch.column(len(names)))):
                if copy[k] is not None and not (keep_first and copy[k]) and len(text) >= length:
                    starts, ends = np.zeros(1, np.int64), np.array([len(text)])
                elif runs.is_valid:
                    first, last = (runs.values.field(j).to_numpy(zero_copy_only=False) for j in (0, 1))
                    starts, ends = merge_spans(first, last + length)
                else:
                    starts = ends = np.empty(0, np.int64)
                results.append(make(text, starts, ends))
            made = [list(x) for x in zip(*results)] or [[] for _ in outs]
            yield pa.record_batch([*batch.columns[: len(names)], *(pa.array(x, t) for x, t in zip(made, kinds))], [*names, *outs])

    outs = [x.split()[0] for x in out.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in out.split(", ")]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), out])
    done = joined.select(*names, "spans", "first_copy").mapInArrow(run, schema)
    return done.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names)), *outs)


def kept_bytes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    edges = [0, *(x for pair in zip(starts.tolist(), ends.tolist()) for x in pair), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _digest(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    kept = kept_bytes(text, starts, ends)
    return len(text), int((ends - starts).sum()), len(starts), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests, and as text what is left, without the parts of characters at its cuts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = strip(docs, 400, False, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string", _digest)
    return found.drop("text").withColumnRenamed("kept", "text")


def _whole_characters(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[str]:
    """The kept text; spans shrink to whole characters, so that what is left is valid UTF-8."""
    data = np.frombuffer(text + b" ", np.uint8)
    inside = (data & 0xC0) == 0x80
    for k in range(len(starts)):
        while inside[starts[k]]:
            starts[k] += 1
        while inside[ends[k]]:
            ends[k] -= 1
    return (kept_bytes(text, starts, np.maximum(starts, ends)).decode(),)


def without_repeats(docs: DataFrame, length: int) -> DataFrame:
    """docs with later copies of strings of ``length`` or more bytes removed from text, the first kept; n_chars, if there, follows.

    Columns and rows stay as given, whatever their names; a text of which nothing is left becomes
    empty, null stays null, and shorter texts stay whole. An empty table gives no rows.
    """
    kept = next(c for k in range(len(docs.columns) + 1) if (c := f"kept_{k}") not in docs.columns)
    done = strip(docs, length, True, f"{kept} string", _whole_characters)
    renew = {"text": F.when(F.col("text").isNotNull(), F.col(kept))}
    if "n_chars" in docs.columns:
        renew["n_chars"] = F.when(F.col("text").isNull() | (F.col("text") == F.col(kept)), F.col("n_chars")).otherwise(F.char_length(kept).cast(docs.schema["n_chars"].dataType))
    return done.withColumns(renew).select(docs.columns)
