"""SimHash near-duplicate detection with pigeonhole blocks.

``fingerprints`` hashes word shingles, ``link`` finds all fingerprints within a Hamming distance, and
``classes`` numbers the groups. ``near_copies`` is the form for a wanted set similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import bounded, components, cut, forget, release, steps, table, text_bytes
from geoframe.llm.parts import taken_apart

SEED = 42
#: A bucket with more fingerprints than this is searched by shared centres instead of by pairs; both ways are exact.
PAIRWISE = 32


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, repeats included; a shorter text is one shingle, a text without words none."""
    joined = b" ".join(text.lower().split())  # bytes: only A-Z are lowered, only the six ASCII white spaces split
    if not joined:
        return np.empty(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    ends = ends[size - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(ends))


def simhash(hashes: np.ndarray) -> int:
    """64-bit fingerprint, unsigned: a bit is set if it is set in over half of the hashes; 0 for none."""
    if len(hashes) == 0:
        return 0
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16384):
        part = hashes[at : at + 16384].astype(">u8")
        votes += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long. Null and wordless texts have fingerprint 0; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((simhash(shingle_hashes(x, shingle)) for x in text_bytes(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _masks(distance: int, blocks: int) -> list[int]:
    """Signed masks: every choice of blocks - distance blocks. Two words within the distance agree under one of them at least."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    single = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    whole = [sum(c) for c in combinations(single, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in whole]


def link(words: DataFrame, distance: int = 2, blocks: int = 5) -> DataFrame:
    """All links (a, b) between distinct fingerprints, given as (fp, node), that differ in at most ``distance`` (0, 1 or 2) bits.

    Pigeonhole: the 64 bits are cut into ``blocks`` blocks; a pair within the distance agrees on
    blocks - distance of them, so fingerprints meet on each such choice and the pair is then verified.
    Buckets of more than PAIRWISE members emit no pairs: their members go to the 65 words that
    differ from them in at most one bit, and two members of one such centre are within two bits by
    the triangle inequality; a centre has at most 65 members, linked to one of them as a star. Links
    may then be reached over another member, so components are exact though not every pair is listed.
    """
    if distance not in (0, 1, 2):
        raise ValueError("distance must be 0, 1 or 2")
    if distance == 0:
        return words.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false")
    keyed = words.select("fp", "node", F.explode(F.array(*(F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(_masks(distance, blocks))))).alias("k")).select("fp", "node", "k.*")
    size = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1")
    keyed = cut(keyed.join(size, ["choice", "bits"]))
    few = keyed.where(F.col("n") <= PAIRWISE)
    other = few.select("choice", "bits", F.col("fp").alias("fp2"), F.col("node").alias("b"))
    near = few.join(other, ["choice", "bits"]).where((F.col("node") < F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= distance))
    pairs = near.select(F.col("node").alias("a"), "b")
    many = keyed.where(F.col("n") > PAIRWISE).select("fp", "node").distinct()
    one = [1 << k for k in range(63)] + [-(1 << 63)]
    centred = many.select("fp", "node", F.explode(F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(m)) for m in one))).alias("centre"))
    if distance == 2:
        hub = centred.groupBy("centre").agg(F.min(F.struct("node", "fp")).alias("hub"), F.count("*").alias("n")).where("n > 1")
    else:
        hub = centred.where("fp = centre").select("centre", F.struct("node", "fp").alias("hub"))
    star = centred.join(hub.select("centre", "hub"), "centre").where((F.col("node") != F.col("hub.node")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("hub.fp"))) <= distance))
    return pairs.union(star.select(F.col("hub.node").alias("a"), F.col("node").alias("b"))).distinct()


def classes(docs: DataFrame, shingle: int = 3, distance: int = 2, blocks: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id that links of at most ``distance`` bits reach.

    Equal fingerprints are linked whatever the texts, wordless and null texts (fingerprint 0) like any
    others. Repeated rows give repeated rows; rows with a null id are in no group and have a null
    component_id. Rows are collapsed to distinct fingerprints before any join.
    """
    marked = cut(fingerprints(docs, shingle, id_col, text_col))
    words = marked.groupBy("fp").agg(F.min("doc_id").alias("node"))
    groups = components(link(words.where("node is not null"), distance, blocks))
    named = words.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return marked.join(named, "fp").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Of the sets of shingles in order of hash, this share is looked at beyond what the prefix of a similar pair needs; as much must be shared.
SPARE = 0.1
#: Texts that share a rarest shingle with at most so many are compared pair by pair; larger groups are compared in blocks inside tasks.
FEW = 16
#: A block has at most about so many shingles and so many texts.
BLOCK, MEMBERS = 1 << 17, 1 << 10


def _overlap(n: int, similarity: float) -> int:
    """How many of its n shingles a set shares with a similar one at least."""
    return math.ceil(similarity * n - 1e-9)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def sketches(texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(node, fp, need, prefix) of each (node, text) with words.

    prefix are the shingles of least hash: of two similar sets, o shingles in common, the first l
    common ones have at most o - l common ones behind them, so they are among the first n - o + l of
    each. With l a share SPARE of the set's size a text shares at least ``need`` of its prefix with
    the prefix of any similar one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in steps(batches):
            nodes, fps, need, prefix = [], [], [], []
            for node, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                hashes = shingle_hashes(text, shingle)
                if len(hashes):
                    found = np.unique(hashes)
                    least = _overlap(len(found), similarity)
                    nodes.append(node)
                    fps.append(simhash(hashes))
                    need.append(_overlap(least, SPARE))
                    prefix.append(found[: len(found) - least + _overlap(len(found), SPARE)])
            yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(need, pa.int64()), _lists(prefix)], ["node", "fp", "need", "prefix"])

    return texts.select("node", "text").mapInArrow(run, "node long, fp long, need long, prefix array<long>")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, fp, size, shingles) of each (node, fp, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = [np.unique(shingle_hashes(x, shingle)) for x in text_bytes(batch.column(2))]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([len(x) for x in found], pa.int64()), _lists(found)], ["node", "fp", "size", "shingles"])

    return texts.select("node", "fp", "text").mapInArrow(run, "node long, fp long, size long, shingles array<long>")


def rarest(sets: DataFrame, similarity: float) -> DataFrame:
    """(node, fp, size, shared, prefix) of the sets that can have a similar one.

    shared are the shingles that other sets have too. Of two similar sets each has at most a share
    1 - similarity of its shingles outside the other, so that they share one of that many and one more,
    taken rarest first: prefix has those of them that are shared. A text of which more is its own has
    no partner, however large the group of texts is that it resembles.
    """
    each = sets.select("node", "fp", "size", F.explode("shingles").alias("shingle"))
    often = cut(each.groupBy("shingle").agg(F.count("*").alias("c")).where("c > 1"))
    shared = each.join(often, "shingle").groupBy("node", "fp", "size").agg(F.collect_list(F.struct("c", "shingle")).alias("shared"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            keep, all_, prefixes = [], [], []
            for size, found in zip(batch.column(2).to_pylist(), batch.column(3)):
                often, one = (found.values.field(k).to_numpy() for k in range(2))
                most = size - _overlap(size, similarity) + 1 - (size - len(one))
                keep.append(most > 0)
                if most > 0:
                    all_.append(np.sort(one))
                    prefixes.append(one[np.lexsort((one, often))[:most]])
            held = [c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:3]]
            yield pa.record_batch([*held, _lists(all_), _lists(prefixes)], ["node", "fp", "size", "shared", "prefix"])

    return shared.mapInArrow(run, "node long, fp long, size long, shared array<long>, prefix array<long>")


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those (a, b) whose sets of shingles have a Jaccard similarity of at least ``similarity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
                both = len(np.intersect1d(one.values.to_numpy(), two.values.to_numpy(), assume_unique=True))
                keep.append(both > 0 and both >= similarity * (n + m - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    one, two = (sets.select(F.col("node").alias(x), F.col("size").alias(f"size_{x}"), F.col("shared").alias(f"shared_{x}")) for x in "ab")
    fit = F.least("size_a", "size_b") >= similarity * F.greatest("size_a", "size_b") - 1e-9
    met = pairs.join(one, "a").join(two, "b").where(fit)
    return met.select("a", "b", "size_a", "size_b", "shared_a", "shared_b").mapInArrow(run, "a long, b long")


def few_pairs(rare: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b), a < b, of sets that share a shingle of their prefixes with at most FEW; shingles that the same sets share count once."""
    met = rare.join(groups.where(F.col("n") <= FEW), "shingle").groupBy("shingle").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    at = met.select("nodes").distinct().select("nodes", F.posexplode("nodes").alias("at", "a"))
    return at.select("a", F.explode(F.slice("nodes", F.col("at") + 2, F.size("nodes"))).alias("b")).distinct()


#: Columns of a 0/1 matrix and rows of a table of pairs that a task holds at a time.
TILE, BAND = 1024, 128


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many numbers each of the left sets shares with each of the right ones, by products of 0/1 matrices."""
    sides = [(np.repeat(np.arange(len(x)), [len(y) for y in x]), np.concatenate(x)) for x in (left, right)]
    known = np.intersect1d(sides[0][1], sides[1][1])
    placed = []
    for row, value in sides:
        at = np.minimum(np.searchsorted(known, value), max(0, len(known) - 1))
        ok = known[at] == value if len(known) else np.zeros(len(value), bool)
        order = np.argsort(at[ok], kind="stable")
        placed.append((row[ok][order], at[ok][order]))
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, len(known), TILE):
        parts = []
        for (row, at), n in zip(placed, out.shape):
            a, b = np.searchsorted(at, (first, first + TILE))
            part = np.zeros((n, TILE), np.float32)
            part[row[a:b], at[a:b] - first] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def _least_reached(label: np.ndarray, near: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least label that each text reaches over near, a table of left by right; a band of rows is looked at at a time."""
    while True:
        before = label.copy()
        for first in range(0, len(left), BAND):
            band, rows = near[first : first + BAND], left[first : first + BAND]
            least = np.minimum(label[rows], np.where(band, label[right], np.iinfo(np.int64).max).min(1))
            label[rows] = least
            label[right] = np.minimum(label[right], np.where(band, least[:, None], np.iinfo(np.int64).max).min(0))
        if (label == before).all():
            return label


def block_links(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b) that link all similar sets of each cluster, given as (cluster, node, size, shared), without a row for each pair.

    Similar sets are of one size class or of neighbouring ones. A class is dealt into blocks by hash,
    as many as its sets need; a task compares two blocks and gives each text one link to the least
    text that it reaches there. A set goes only to classes that its cluster has.
    """
    sized = members.withColumn("kind", F.floor(F.log("size") / (math.log(1 / similarity) + 1e-9)))
    load = sized.groupBy("cluster", "kind").agg(F.ceil(F.greatest(F.sum("size") / BLOCK, F.count("*") / MEMBERS)).cast("int").alias("parts"))
    parts = load.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("kind", "parts"))).alias("parts"))
    kind, part = F.col("kind"), F.col("part")
    dealt = sized.join(parts, "cluster").withColumn("part", F.pmod(F.xxhash64("node"), F.element_at("parts", kind)).cast("int"))
    meet = lambda low, i, high, j, side: F.struct(low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"), F.lit(side).alias("side"))
    count = lambda k: F.coalesce(F.try_element_at("parts", k), F.lit(0))
    every = lambda k: F.when(count(k) > 0, F.sequence(F.lit(0), count(k) - 1)).otherwise(F.array().cast("array<int>"))
    tasks = F.concat(
        F.transform(every(kind + 1), lambda j: meet(kind, part, kind + 1, j, 0)),
        F.transform(every(kind - 1), lambda j: meet(kind - 1, j, kind, part, 1)),
        F.transform(F.filter(every(kind), lambda j: j >= part), lambda j: meet(kind, part, kind, j, 0)),
        F.transform(F.filter(every(kind), lambda j: j < part), lambda j: meet(kind, j, kind, part, 1)),
    )
    sent = dealt.select("cluster", "node", "size", "shared", F.explode(tasks).alias("t")).select("cluster", "t.*", "node", "size", "shared")

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        node, size, side = (rows.column(c).to_numpy() for c in ("node", "size", "side"))
        sets = [np.asarray(x.values) for x in rows.column("shared")]
        alone = (key[1].as_py(), key[2].as_py()) == (key[3].as_py(), key[4].as_py())
        left, right = (np.arange(len(node)),) * 2 if alone else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        label = node.copy()
        if len(left) and len(right):
            both = _common([sets[k] for k in left], [sets[k] for k in right])
            near = np.empty(both.shape, bool)
            for first in range(0, len(left), BAND):
                some = slice(first, first + BAND)
                near[some] = (both[some] > 0) & (both[some] >= similarity * (size[left[some]][:, None] + size[right][None, :] - both[some]) - 1e-9)
            label = _least_reached(label, near, left, right)
        moved = label != node
        return pa.table({"a": label[moved], "b": node[moved]})

    return sent.groupBy("cluster", "low", "i", "high", "j").applyInArrow(compare, "a long, b long")


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, component_id, text_group) of the texts that copies or near copies of another text are linked to; others are absent.

    Equal texts are always linked; others if the Jaccard similarity of their sets of word shingles is
    at least ``similarity``. All such links count, up to hash collisions of 64 bits. At 0.8 the
    fingerprints of a pair differ in about 11 of 64 bits, for which pigeonhole blocks would be 3 to 5
    bits wide and select nothing. Blocks of fingerprints (``link``) therefore give the pairs within two
    bits, which are verified by their similarity; all other pairs share one of their rarest shingles.
    First a part of each set, in order of hash, tells which texts share enough with others; only
    their sets are counted whole (``rarest``). Texts that share a rarest shingle with few are compared
    by pairs; larger groups are taken apart by parts of their sets where that helps (``taken_apart``),
    and what is left is compared in blocks (``block_links``), so that no group emits its pairs.
    digest is the SHA-256 of the text; rows that repeat an id with different texts are told apart by
    it, and their groups by text_group. component_id is the smallest doc_id reachable. Null texts and null ids are in no group;
    wordless texts only link to equal ones. An empty table gives no rows; other columns don't matter.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null").withColumn("digest", F.unhex(F.sha2("text", 256)))
    each = cut(rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n")))
    # cut, so that Spark can split the rows of a text with very many copies in the join
    first = cut(each.groupBy("digest").agg(F.min("doc_id").alias("least"), F.sum("n").alias("copies")))
    others = cut(each.join(first, "digest").where("doc_id > least").select("doc_id", "digest"))
    if each.groupBy("doc_id").agg(F.sum("n").alias("n")).where("n > 1").isEmpty():
        first = cut(first.withColumn("node", F.col("least")))
        texts = rows.join(bounded(others.select("doc_id")), "doc_id", "left_anti").select(F.col("doc_id").alias("node"), "text")
    else:  # ids repeat: a number for each text, which no id may have
        first = cut(first.withColumn("node", F.xxhash64("digest", "least")))
        texts = rows.join(first.select("digest", "node", F.col("least").alias("doc_id")), ["digest", "doc_id"]).select("node", "text").dropDuplicates(["node"])
    sketch = cut(sketches(texts, shingle, similarity))

    prefix = sketch.select("node", F.explode("prefix").alias("shingle"))
    twice = cut(prefix.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle"))
    shares = prefix.join(twice, "shingle").groupBy("node").agg(F.count("*").alias("n"))
    rich = cut(sketch.select("node", "fp", "need").join(shares, "node").where("n >= need").select("node", "fp"))
    release(sketch, twice)
    whole = cut(shingle_sets(texts.join(bounded(rich), "node"), shingle))
    sets = cut(rarest(whole, similarity))
    release(whole, rich)

    prints = cut(sets.groupBy("fp").agg(F.min("node").alias("node")))
    same = sets.join(prints.withColumnRenamed("node", "least"), "fp").where("node > least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    rare = sets.select("node", F.explode("prefix").alias("shingle"))
    groups = cut(rare.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1"))
    pairs = cut(same.union(link(prints, 2, 5)).union(few_pairs(rare, groups)).distinct())
    crowd = components(rare.join(groups.where(F.col("n") > FEW), "shingle").select(F.col("node").alias("a"), F.col("least").alias("b")))
    clusters = cut(sets.join(crowd.withColumnRenamed("component", "cluster"), "node").select("cluster", "node", "size", "shared"))
    found = components(similar(pairs, sets, similarity).union(block_links(taken_apart(clusters, similarity), similarity)))
    release(sets, prints, groups, pairs, clusters)

    named = first.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = named.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("copies").alias("n")).where("n > 1").drop("n")
    members = cut(named.join(kept, "component").select(F.col("least").alias("doc_id"), "digest", "component_id", F.col("component").alias("text_group")))
    return members.union(others.join(members.drop("doc_id"), "digest").select(members.columns))


def without_near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without the near copies: of each group of near_copies the row with the smallest doc_id stays, one row only.

    Columns as given. Rows whose id or text is null stay. Of rows of one group that repeat the smallest id the one with
    the least digest stays.
    """
    found = near_copies(docs, shingle, similarity)
    stays = found.groupBy("text_group").agg(F.min(F.struct("doc_id", "digest")).alias("stays"))
    gone = cut(found.join(stays, "text_group").where(F.struct("doc_id", "digest") != F.col("stays")).select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")))
    id_, digest = docs["doc_id"].cast("long"), F.unhex(F.sha2(docs["text"], 256))
    held = docs.join(bounded(gone), (id_ == F.col("gone_id")) & (digest == F.col("gone_digest")), "left_anti")
    key = [F.col("doc_id").cast("long").alias("twice_id"), F.unhex(F.sha2("text", 256)).alias("twice_digest")]
    twice = cut(held.where("doc_id is not null and text is not null").select(*key).groupBy("twice_id", "twice_digest").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    if twice.isEmpty():
        return held
    match = (held["doc_id"].cast("long") == F.col("twice_id")) & (F.unhex(F.sha2(held["text"], 256)) == F.col("twice_digest"))
    return held.join(twice, match, "left_anti").union(held.join(twice, match, "left_semi").dropDuplicates(["doc_id", "text"]))
