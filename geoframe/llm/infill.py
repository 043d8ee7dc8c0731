"""Fill-in-middle: a learned rank index over the unit boundaries of each text, cuts read from it, and reversible layouts.

The index of a text maps a rank (after how many units) to an offset in code points. Straight
segments predict every boundary within ERROR code points, and what each prediction misses is
kept as one signed byte, so that a cut costs a segment, a product and a byte, and is exact.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import table

#: A prediction is off by at most so many code points, which is what a signed byte holds.
ERROR = 127
#: Ranks that are tested at once while a segment grows.
STRIDE = 512
MARKS = ("<P>", "<S>", "<M>")
SEED = 42
#: Of 100 documents so many are transformed, and of 100 of those so many have the suffix first.
RATE, SUFFIX_FIRST = 50, 80
INDEX = "n long, ranks array<long>, offsets array<long>, slopes array<double>, residuals binary"
_INDEX = pa.struct([("n", pa.int64()), ("ranks", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("slopes", pa.list_(pa.float64())), ("residuals", pa.binary())])


def boundaries(text: str) -> np.ndarray:
    """Offsets of all unit boundaries in code points, 0 first.

    A unit is a word with the white space before it; white space at the end of a text is one unit.
    """
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    white = (code == 32) | (code >= 9) & (code <= 13)
    ends = np.flatnonzero(~white & np.append(white[1:], True)) + 1
    if len(code) and white[-1]:
        ends = np.append(ends, len(code))
    return np.concatenate(([0], ends)).astype(np.int64)


def segments(offsets: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ranks, offsets, slopes) of straight lines, each through its first boundary, that together predict every boundary within ``error``.

    A segment grows while some slope stays within the error at all its boundaries, that is while the
    highest lower bound of the slope is at most the lowest upper one. Each segment but the last has
    two boundaries at least, whatever the distances are.
    """
    ranks, starts, slopes = [], [], []
    first, last = 0, len(offsets) - 1
    slack = error - 0.5
    while True:
        low, high, at = 0.0, np.inf, first + 1
        while at <= last:
            run = np.arange(at, min(at + STRIDE, last + 1))
            steps, rise = run - first, offsets[run] - offsets[first]
            lows = np.maximum(low, np.maximum.accumulate((rise - slack) / steps))
            highs = np.minimum(high, np.minimum.accumulate((rise + slack) / steps))
            fits = int(np.searchsorted(lows > highs, True))
            if fits:
                low, high = float(lows[fits - 1]), float(highs[fits - 1])
            at += fits
            if fits < len(run):
                break
        ranks.append(first)
        starts.append(int(offsets[first]))
        slopes.append((low + high) / 2 if at > first + 1 else 0.0)
        first = at
        if first > last:
            return np.array(ranks, np.int64), np.array(starts, np.int64), np.array(slopes)


def fitted(text: str, error: int = ERROR) -> dict:
    """The index of a text as of INDEX: its number of units, the segments and the residuals of all ranks from 0 to that number."""
    offsets = boundaries(text)
    ranks, starts, slopes = segments(offsets, error)
    every = np.arange(len(offsets))
    own = np.searchsorted(ranks, every, "right") - 1
    missed = offsets - (starts[own] + np.floor((every - ranks[own]) * slopes[own] + 0.5).astype(np.int64))
    if len(missed) and np.abs(missed).max() > ERROR:
        raise ArithmeticError("a segment misses a boundary by more than a byte holds")
    return {"n": len(offsets) - 1, "ranks": ranks, "offsets": starts, "slopes": slopes, "residuals": missed.astype(np.int8).tobytes()}


def _indexed(texts: pa.Array) -> pa.Array:
    return pa.array([fitted(t.as_py() or "") for t in texts], _INDEX)


def rank_index(text: Column) -> Column:
    """The learned index of each text (see INDEX); that of an empty text for null."""
    return F.arrow_udf(_indexed, INDEX)(text)


def _byte(value: Column, at: Column) -> Column:
    """The signed byte at position ``at``, from 0."""
    raw = F.conv(F.hex(F.substr(value, (at + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.when(raw > 127, raw - 256).otherwise(raw)


def offset_at(index: Column, rank: Column) -> Column:
    """The offset of the boundary after ``rank`` units, 0 to n: predicted by the rank's segment, corrected by its residual."""
    own = F.size(F.filter(index["ranks"], lambda r: r <= rank)) - 1
    predicted = F.element_at(index["offsets"], own + 1) + F.floor((rank - F.element_at(index["ranks"], own + 1)) * F.element_at(index["slopes"], own + 1) + F.lit(0.5))
    return predicted + _byte(index["residuals"], rank)


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a document, the first groups of the hex SHA-256 of seed and decimal id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _with(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.select("*", *(v.alias(k) for k, v in values.items()))


def infilled(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED, index: Callable[[Column], Column] = rank_index) -> DataFrame:
    """(doc_id, text, n, form, prefix_chars, middle_chars, output) for each row of docs; other columns are left out, so none can clash.

    Null texts count as empty, whose form is plain with no units, and stay null in ``text``. A text
    that holds a mark is plain, so that every output can be taken apart. Repeated rows give equal
    rows, an empty table none. Cuts lie between units at ranks drawn from the id.
    """
    given = docs.select("doc_id", "text", F.coalesce("text", F.lit("")).alias("whole"), *(h.alias(f"h{k}") for k, h in enumerate(draws(F.col("doc_id")), 1)))
    units = _with(given, {"at": index(F.col("text"))})
    ranks = [F.pmod(F.col(h), F.col("at.n") + 1) for h in ("h1", "h2")]
    ranked = _with(units, {"first": F.least(*ranks), "second": F.greatest(*ranks)})
    marked = F.lit(False)
    for mark in MARKS:
        marked |= F.contains("whole", F.lit(mark))
    plain = (F.col("whole") == "") | marked | (F.pmod("h3", F.lit(100)) >= rate)
    form = F.when(plain, "plain").when(F.pmod("h4", F.lit(100)) < suffix_first, "spm").otherwise("psm")
    cut = _with(ranked, {"form": form, "p": offset_at(F.col("at"), F.col("first")).cast("int"), "m": offset_at(F.col("at"), F.col("second")).cast("int")})
    prefix, middle = F.substr("whole", F.lit(1), F.col("p")), F.substr("whole", F.col("p") + 1, F.col("m") - F.col("p"))
    suffix = F.substr("whole", F.col("m") + 1)
    p, s, m = map(F.lit, MARKS)
    output = F.when(F.col("form") == "plain", F.col("whole")).when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    chars = lambda value: F.when(F.col("form") != "plain", value.cast("long"))
    return cut.select("doc_id", "text", F.col("at.n").alias("n"), "form", chars(F.col("p")).alias("prefix_chars"), chars(F.col("m") - F.col("p")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``infilled`` was given, from its output and form alone; a null text comes back as an empty one."""
    parts = F.split(output, "<[PSM]>", -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    made = infilled(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP13_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM units
), ranked AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), cut AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM ranked
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM cut
"""
