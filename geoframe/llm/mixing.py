"""Mixing to target weights: soft domain membership, then nonnegative document rates by projected gradient.

Everything runs as DataFrame functions. The driver sees one number per domain and round.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import cut, table
from geoframe.llm.quality import SYMBOLS, WHITE, let

DOMAINS = ("clean", "toxic", "junk")
#: Shares of all tokens that the domains are to have.
TARGETS = (0.92, 0.05, 0.03)
#: Directions of memberships under this part of the largest one's eigenvalue don't exist but for rounding.
RANK = 1e-12
#: The classifier is fitted on at most so many labelled documents, those with the least hash of the id.
TRAINING = 20_000
#: Words are hashed to so many numbers, which bounds the table of weights.
BUCKETS = 1 << 18
#: A word counts if a domain has it in so many standard deviations more documents than expected.
MARKED = 4.0
#: At most so many of the words that a text has, and of those that it lacks, count in full, which keeps posteriors soft.
EVIDENCE = 10.0
#: Rounds after which a fit that hasn't settled ends with a warning, off shares of tokens that count as none, and the weight of the multipliers' distance from where a fit starts.
ROUNDS, TOLERANCE, HELD_BACK = 400, 1e-9, 1e-9
#: A fit has settled if so many rounds bring it no nearer by STALL, in shares of tokens.
PATIENCE, STALL = 60, 1e-8
#: Documents that a task of a round sums up; a round is short, and many tasks would leave many small files.
ROWS = 1 << 18
#: Off shares of tokens that are reported.
UNMET = 1e-6


def _level(ratio: Column, *bounds: float) -> Column:
    return reduce(lambda a, b: a + b, ((ratio >= b).cast("int") for b in bounds)).cast("string")


def words(text: Column) -> Column:
    """The different words of a text in lower case without closing punctuation, and words about it; those of an empty text for null.

    The latter have a space: levels of symbols, capitals, marks, variety and length, and, beginning
    with the space, the number of tokens, which are the words between white space. Only this one array
    goes through explode, since Spark evaluates what stands beside it for each word, and through
    explode_outer, since Spark would evaluate it once more to keep empty arrays out of explode.
    """

    def counts(t: Column) -> Column:
        count = lambda marks: F.regexp_count(t, F.lit(marks))
        n = F.when(t == "", 0).otherwise(1 + F.char_length(t) - F.char_length(F.replace(t, F.lit(" "), F.lit(""))))
        closed = F.regexp_replace(F.lower(t), "[.,;:!?]++(?= |\\z)", "")
        fields = {"n": n, "words": F.array_distinct(F.split(closed, " ")), "symbols": count(f"[{SYMBOLS}]"), "capitals": count("[A-Z]"), "marks": count("[!?]"), "chars": F.char_length(t)}
        return F.struct(*(v.alias(k) for k, v in fields.items()))

    def whole(c: Column) -> Column:
        n = F.greatest(c["n"], F.lit(1))
        shape = {
            "symbols": _level(c["symbols"] / n, 0.1, 0.5),
            "capitals": _level(c["capitals"] / F.greatest(c["chars"], F.lit(1)), 0.1, 0.3),
            "marks": _level(c["marks"] / n, 0.1, 0.5),
            "variety": _level(F.size(c["words"]) / n, 0.3, 0.5),
            "words": _level(c["n"], 10),
        }
        return F.concat(c["words"], F.array(F.concat(F.lit(" "), c["n"].cast("string")), *(F.concat(F.lit(f"# {k}"), v) for k, v in shape.items())))

    return let(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WHITE}]+", " ")), lambda t: let(counts(t), whole))


def _bucket(word: Column) -> Column:
    return F.when(F.startswith(word, F.lit(" ")), -1).otherwise(F.pmod(F.xxhash64(word), F.lit(BUCKETS))).cast("int")


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, F.lit(1)).when(quality == 1, F.lit(0)).when(quality == 0, F.lit(2))


def fit_classifier(docs: DataFrame, labels: DataFrame, training: int = TRAINING) -> DataFrame:
    """(bucket, w0, w1, w2): what a hashed word says about the domains, as differences of logarithms.

    Seen and expected numbers of documents that have it, and that lack it, are compared, both plus
    one. Only words that mark a domain (MARKED) are kept: others say little, and in long texts there
    are many. Bucket -1 has the logarithms of the domains' shares and what a text without any of the
    words says. At most BUCKETS + 1 rows. Labels without a value in both columns are left out; of
    repeated labels of one document the largest domain counts. Without labels there are no rows and
    posteriors are equal.
    """
    sample = labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain_of(F.col("quality"), F.col("toxic")).alias("k")).dropna().groupBy("doc_id").agg(F.max("k").alias("k")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(training)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("k", words(F.col("text")).alias("words"))
    number = range(len(DOMAINS))
    counts = lambda name: [F.coalesce(F.sum(F.when(F.col("k") == k, 1).otherwise(0)), F.lit(0)).alias(f"{name}{k}") for k in number]
    seen = cut(texts.select("k", F.explode_outer("words").alias("word")).select("k", _bucket(F.col("word")).alias("bucket")).groupBy("bucket").agg(*counts("c")))
    total = seen.where("bucket = -1").select((F.col("c0") + F.col("c1") + F.col("c2")).alias("n"), *(F.col(f"c{k}").alias(f"n{k}") for k in number))
    every = reduce(lambda a, b: a + b, (F.col(f"c{k}") for k in number))
    expected = [every * F.col(f"n{k}") / F.col("n") for k in number]
    marks = reduce(lambda a, b: a | b, ((F.col(f"c{k}") - e) / F.sqrt(e + 1) >= MARKED for k, e in enumerate(expected)))
    has = [F.log((F.col(f"c{k}") + 1) / (e + 1)).alias(f"h{k}") for k, e in enumerate(expected)]
    lacks = [F.log((F.greatest(F.col(f"n{k}") - F.col(f"c{k}"), F.lit(0)) + 1) / (F.greatest(F.col(f"n{k}") - e, F.lit(0.0)) + 1)).alias(f"l{k}") for k, e in enumerate(expected)]
    marked = cut(seen.where("bucket >= 0").join(F.broadcast(total)).where(marks).select("bucket", *has, *lacks))
    none = F.broadcast(marked.agg(F.greatest(F.count("*"), F.lit(EVIDENCE)).alias("m"), *(F.coalesce(F.sum(f"l{k}"), F.lit(0.0)).alias(f"s{k}") for k in number)))
    scale = EVIDENCE / F.col("m")
    prior = total.join(none).select(F.lit(-1).alias("bucket"), *((F.log((F.col(f"n{k}") + 1) / (F.col("n") + len(DOMAINS))) + scale * F.col(f"s{k}")).alias(f"w{k}") for k in number))
    return marked.join(none).select("bucket", *((F.col(f"h{k}") - scale * F.col(f"l{k}")).alias(f"w{k}") for k in number)).unionByName(prior)


def posteriors(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, p0, p1, p2) for each doc_id: words of all its rows, and soft domain membership.

    Null ids are one group; empty and null texts have no tokens.
    """
    number = range(len(DOMAINS))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"))
    # the word of a text's tokens has bucket -1, which stays without labels too
    known = weights.select("bucket", *(f"w{k}" for k in number)).unionByName(docs.sparkSession.sql("SELECT -1 AS bucket, " + ", ".join(f"0D AS w{k}" for k in number))).groupBy("bucket").agg(*(F.sum(f"w{k}").alias(f"w{k}") for k in number))
    scored = given.select("doc_id", F.explode_outer("words").alias("word")).select("doc_id", "word", _bucket(F.col("word")).alias("bucket")).join(F.broadcast(known), "bucket")
    prior = F.col("bucket") == -1
    summed = scored.groupBy("doc_id").agg(F.sum(F.when(prior, F.substring("word", 2, 20).cast("long"))).alias("n_tokens"), F.count(F.when(~prior, 1)).alias("n"), *(F.coalesce(F.sum(F.when(~prior, F.col(f"w{k}"))), F.lit(0.0)).alias(f"w{k}") for k in number), *(F.max(F.when(prior, F.col(f"w{k}"))).alias(f"q{k}") for k in number))
    scale = EVIDENCE / F.greatest(F.col("n"), F.lit(EVIDENCE))
    score = [F.col(f"w{k}") * scale + F.col(f"q{k}") for k in number]
    marked = summed.select("doc_id", "n_tokens", *(x.alias(f"s{k}") for k, x in enumerate(score)))
    power = [F.exp(F.col(f"s{k}") - F.greatest(*(F.col(f"s{j}") for j in number))) for k in number]
    total = reduce(lambda a, b: a + b, power)
    return marked.select("doc_id", "n_tokens", *((x / total).alias(f"p{k}") for k, x in enumerate(power)))


def attainable(targets: tuple[float, ...], shares: np.ndarray, most: float) -> np.ndarray:
    """Targets of which none is over ``most`` times the share that its domain has; what that takes away goes to the other domains in proportion.

    ``most`` is at least 1, so that shares which sum to 1 leave room for all.
    """
    out, free, bound = np.array(targets, float), np.ones(len(targets), bool), most * np.asarray(shares, float)
    while (over := free & (out > bound + 1e-12)).any():
        out[over], free = bound[over], free & ~over
        if not free.any() or out[free].sum() <= 0:
            break
        out[free] *= (sum(targets) - out[~free].sum()) / out[free].sum()
    return out


def fit_rates(members: DataFrame, targets: tuple[float, ...] = TARGETS, rounds: int = ROUNDS, most: float | None = None) -> DataFrame:
    """members, best a checkpoint, as (doc_id, n_tokens, p0, p1, ...) with ``rate``, 0 or more, such that sum(rate * n_tokens * p_k) is the targets times all tokens.

    Also ``wanted`` and ``reached``, those sums as shares of all tokens, one number per domain. With
    ``most``, a target is first limited to so many times its domain's share (``attainable``), so that
    what is hardly there isn't asked for, and ``wanted`` is what was asked. Targets that no rates meet
    are met as nearly as least squares can, with a warning; without ``most`` rates may then be large.
    A fit that hasn't settled after ``rounds`` ends there, also with a warning: of targets out of reach
    the last digits may then be missing.

    Projected gradient from a rate of 1, distances between rates weighted by tokens, so that long and
    short documents of one membership have the same rate. The steps are added up before they are
    projected, so a rate is max(0, 1 - sum(p_k * y_k)) with one number y_k per domain, and scaled by the
    inverse of sum(n_tokens * p_i * p_j) over documents with a positive rate, which makes them Newton
    steps; a step that doesn't help is shortened. A round is one aggregation to a few sums. Without
    tokens all rates stay 1.
    """
    names = [f"p{k}" for k in range(len(targets))]
    state = cut(members.coalesce(max(1, -(-members.count() // ROWS))))
    total = float(state.agg(F.sum("n_tokens")).first()[0] or 0)
    wanted = np.array(targets, float)

    def done(rate: Column, reached: list | None) -> DataFrame:
        listed = lambda xs: F.array(*(F.lit(float(x)) for x in xs))
        return state.select("*", rate.alias("rate"), listed(wanted).alias("wanted"), (listed(reached) if reached is not None else F.lit(None).cast("array<double>")).alias("reached"))

    if not total:
        return done(F.lit(1.0), None)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]

    def rate_at(y: np.ndarray) -> Column:
        return F.greatest(F.lit(0.0), F.lit(1.0) - reduce(lambda a, b: a + b, (F.col(p) * float(v) for p, v in zip(names, y))))

    def sums(y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Half the sum of squared rates, the domains' totals and the Gram matrix of documents with a positive rate, tokens as shares."""
        share = F.col("n_tokens") / total
        rated = state.select(*names, share.alias("share"), rate_at(y).alias("rate"))
        active = F.when(F.col("rate") > 0, F.col("share")).otherwise(0.0)
        row = rated.agg(F.sum(F.col("share") * F.col("rate") * F.col("rate") / 2), *(F.sum(F.col("share") * F.col(p) * F.col("rate")) for p in names), *(F.sum(active * F.col(names[i]) * F.col(names[j])) for i, j in pairs)).first()
        gram = np.zeros((len(names), len(names)))
        for (i, j), v in zip(pairs, row[1 + len(names) :]):
            gram[i, j] = gram[j, i] = v
        return float(row[0]), np.array(row[1 : 1 + len(names)], float), gram

    y = start = np.zeros(len(names))
    half, reached, gram = sums(y)
    if most is not None:
        wanted = attainable(targets, reached, most)
    used = 1
    size, base = np.linalg.eigh(gram)
    base = base[:, size > RANK * size.max()]
    best, last = (np.linalg.norm(reached - wanted), y, reached), math.inf
    nearest, since = best[0], 0
    while used < rounds:
        value = lambda h, at: h + wanted @ at + HELD_BACK / 2 * (at - start) @ (at - start)
        slope = base.T @ (wanted - reached + HELD_BACK * (y - start))
        if np.abs(slope).max() < TOLERANCE / 10:
            off = np.linalg.norm(reached - wanted)
            if off < TOLERANCE or off > 0.9 * last:
                break
            start, last = y, off
            continue
        step = -np.linalg.solve(base.T @ gram @ base + HELD_BACK * np.eye(base.shape[1]), slope)
        now, part, moved = value(half, y), 1.0, False
        while used < rounds and not moved:
            trial = y + part * base @ step
            found = sums(trial)
            used += 1
            moved = value(found[0], trial) <= now + 1e-4 * part * (slope @ step) + 1e-15 * abs(now)
            part /= 4
        if not moved:
            break
        y, (half, reached, gram) = trial, found
        best = min(best, (np.linalg.norm(reached - wanted), y, reached), key=lambda x: x[0])
        nearest, since = (best[0], used) if best[0] < nearest - STALL else (nearest, since)
        if used - since >= PATIENCE:
            break
    else:
        warnings.warn(f"the rates haven't settled in {rounds} rounds", stacklevel=2)
    off, y, reached = best
    if off > UNMET:
        warnings.warn(f"targets {wanted.tolist()} aren't met: reached {reached.tolist()}", stacklevel=2)
    return done(rate_at(y), reached)


def mix(docs: DataFrame, labels: DataFrame, targets: tuple[float, ...] = TARGETS, labelled_docs: DataFrame | None = None, most: float | None = None) -> DataFrame:
    """(doc_id, n_tokens, p0, p1, p2, rate, wanted, reached) for each doc_id of docs; the classifier is fitted on labelled_docs, docs by default."""
    weights = cut(fit_classifier(labelled_docs or docs, labels))
    return fit_rates(cut(posteriors(docs, weights)), targets, most=most)


def mixed(docs: DataFrame, labels: DataFrame, targets: tuple[float, ...] = TARGETS, labelled_docs: DataFrame | None = None, most: float | None = None) -> DataFrame:
    """docs resampled at the fitted rates, columns as given, whatever their names.

    A row of rate r comes floor(r) times, and once more for a share of r - floor(r) by a hash of its
    id. Null ids are one group with one rate; null and empty texts have no tokens but a rate, too; an
    empty table gives no rows. ``most`` limits targets as in ``fit_rates``.
    """
    rates = mix(docs.select("doc_id", "text"), labels, targets, labelled_docs, most).select(F.col("doc_id").alias("rate_id"), "rate")
    chance = F.pmod(F.xxhash64("rate_id", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = rates.select("rate_id", F.sequence(F.lit(1), F.floor(F.col("rate") + chance).cast("int")).alias("copies"), F.floor(F.col("rate") + chance).alias("times")).where("times > 0")
    names = [f"given_{k}" for k in range(len(docs.columns))]
    given = docs.toDF(*names)
    joined = given.join(copies, F.col(names[docs.columns.index("doc_id")]).cast("long").eqNullSafe(F.col("rate_id")))
    return joined.select(*names, F.explode("copies").alias("copy")).select(names).toDF(*docs.columns)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_tokens", *(F.round(f"p{k}", 6).alias(f"p_{d}") for k, d in enumerate(DOMAINS)), F.round("rate", 6).alias("rate"), *(F.round(F.col(c)[k], 6).alias(f"{c}_{d}") for c in ("wanted", "reached") for k, d in enumerate(DOMAINS)))
