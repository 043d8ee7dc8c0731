"""Whitening, language filters and fill-in-middle against plain versions, and their cases."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from geoframe.llm import infill, language, whitening
from geoframe.llm.common import table

VECTORS = "vec_id long, embedding array<float>, label int"
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_whitening(rows, components=16):
    """By numpy's eigenvectors of the covariance of distinct vectors."""
    fixed = [(i, tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v)) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    distinct = np.array(sorted({x for _, x in fixed}), np.int64)
    n, total = len(distinct), distinct.sum(0)
    centred = (n * distinct - total) / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    kept = values > 1e-18 * values[0]
    values, axes = values[kept], axes[:, kept]
    out = {}
    for i, x in fixed:
        off = [n * c - int(s) for c, s in zip(x, total)]
        out.setdefault(i, []).append((n, sum(o * o for o in off), (np.array(off) / n) @ axes / np.sqrt(values), values / np.trace(covariance)))
    return out


def compare_whitening(got, want):
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {k: sum(len(x[2]) for x in v) for k, v in want.items()}
    k = max(r.component for r in got)
    signs = [0.0] * k
    for i, found in by.items():
        n, deviation, white, explained = want[i][0]
        for r in found:
            assert (r.n, r.deviation) == (n, deviation)
            c = r.component - 1
            signs[c] = signs[c] or (np.sign(r.whitened * white[c]) if abs(white[c]) > 1e-3 else 0.0)
            assert abs(r.whitened - (signs[c] or 1.0) * white[c]) < 1e-8 or abs(white[c]) <= 1e-3
            assert abs(r.explained / explained[c] - 1) < 1e-9
            assert 0 <= r.identity_error < 1e-9


def test_whitening_is_that_of_eigenvectors(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    compare_whitening(whitening.op11_whitening(spark, sf_dir).collect(), plain_whitening(rows))


def query(spark, rows, tmp_path):
    path = str(tmp_path / "given")
    spark.createDataFrame(rows, VECTORS).write.mode("overwrite").parquet(f"{path}/embeddings.parquet")
    return whitening.op11_whitening(spark, path)


def test_whitening_cases(spark, tmp_path):
    """Nulls, non-finite entries, repeated rows and vectors, other lengths, few dimensions, a dimension without variance."""
    random.seed(5)
    rows = [(k, [random.gauss(0, 0.3), random.gauss(1, 0.1), 0.5, random.gauss(-2, 2)], k) for k in range(60)]
    rows += [(60, None, 0), (61, [], 0), (62, [1.0, None, 1.0, 1.0], 0), (63, [1.0, float("nan"), 1.0, 1.0], 0), (64, [1.0, float("inf"), 1.0, 1.0], 0), (65, [1.0, 2.0], 0), (None, rows[3][1], 0), (7, rows[7][1], 1), *[(100 + k, rows[9][1], 0) for k in range(40)]]
    got = query(spark, rows, tmp_path).collect()
    want = plain_whitening([(i, v) for i, v, _ in rows if v is None or len(v) != 2])
    compare_whitening(got, want)
    assert {r.component for r in got} == {1, 2, 3}
    assert len([r for r in got if r.vec_id == 7]) == 6 and len({(r.deviation, r.component, r.whitened) for r in got if r.vec_id == 7}) == 3


def test_whitening_of_equal_deviations_and_of_little(spark, tmp_path):
    """A cross of points has one variance in all directions, which one Krylov space doesn't span; one vector and none have no component."""
    cross = [(2 * k + s, [(1.0 if s else -1.0) * (j == k) for j in range(5)], 0) for k in range(5) for s in (0, 1)]
    got = query(spark, cross, tmp_path).collect()
    assert len(got) == 50 and all(abs(r.explained - 0.2) < 1e-12 and r.identity_error < 1e-12 for r in got)
    assert query(spark, [(1, [1.0, 2.0], 0)] * 3, tmp_path).count() == 0
    made = query(spark, [], tmp_path)
    assert made.count() == 0 and made.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_reads_named_columns_only(spark):
    rows = spark.createDataFrame([(k, [float(k), float(k * k % 7)], "a", 1) for k in range(9)], "vec_id long, embedding array<double>, s string, block int").withColumn("component", F.lit(3))
    fixed = whitening.fixed_point(rows)
    assert whitening.whitened(fixed, whitening.fit(fixed)).count() == 18


def test_exact_multiples():
    x = np.array([[1 << 40, 3], [5, -7]])
    assert whitening._times(x, 1 << 30, (11, -2)).tolist() == [[(1 << 70) - 11, (3 << 30) + 2], [(5 << 30) - 11, -(7 << 30) + 2]]
    model = whitening.Fit(3, (7, 8), None, None, 0.0, 0.0)
    assert model.centred(np.array([[2, 3]])).tolist() == [[float(Fraction(-1, 3)), float(Fraction(1, 3))]]


def plain_grams(text):
    clean = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    clean = re.sub(" +", " ", clean)
    return [clean[i : i + n] for n in language.ORDERS for i in range(len(clean) - n + 1) if " " not in clean[i + 1 : i + n - 1]]


TEXTS = ["", "a", "ab c", "Éß — ﬁ!! x9y", " İstanbul\n\n", "...", "日本語 テキスト", "z\0w", "the theme " * 400, "q" * 5000]


def test_ngrams_are_those_of_each_text(monkeypatch):
    for size in (1 << 20, 64):
        monkeypatch.setattr(language, "SLICE", size)
        counts, seen = [0] * len(TEXTS), {}
        found = [[] for _ in TEXTS]
        for gram, of in language.ngrams(TEXTS):
            for g, k in zip(gram.tolist(), of.tolist()):
                counts[k] += 1
                found[k].append(g)
        for k, text in enumerate(TEXTS):
            want = plain_grams(text)
            assert counts[k] == len(want)
            by_hash, by_text = sorted(found[k]), sorted(want)
            assert len(set(by_hash)) == len(set(by_text))
            for g, n in zip(*np.unique(np.array(by_hash, np.uint64), return_counts=True)):
                assert seen.setdefault(int(g), n) is not None


def test_filters_return_all_languages_of_an_ngram(spark):
    """Every n-gram that was put in is found; others seem to be in a language as often as its filled bits say."""
    docs = spark.createDataFrame([("x", "aaa bab"), ("y", "aaa cac"), ("z", "zzz"), ("x", "aaa bab"), (None, "qqq"), ("w", None)], "lang string, text string")
    filters = language.fit_filters(docs)
    assert sorted(filters.langs) == ["x", "y", "z"]
    total, found = filters.hits(["aaa", "bab", "cac", "zzz", "qqq", ""])
    at = {k: i for i, k in enumerate(filters.langs)}
    own = total[0]
    assert found[0, [at["x"], at["y"], at["z"]]].tolist() == [own, own, 0]
    assert [found[k, at[c]] for k, c in ((1, "x"), (2, "y"), (3, "z"))] == [total[k] for k in (1, 2, 3)]
    assert found[4].sum() == 0 and total[5] == 0
    full = language.Filters(["a", "b"], np.random.default_rng(1).integers(0, 4, (1, 1 << language.BITS)).astype(np.uint8))
    many = [" ".join("".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=6)) for k in range(j, j + 3000)) for j in (0, 50000)]
    total, found = full.hits(many)
    assert np.abs(found / total[:, None] - full.false_positives()).max() < 0.02 and np.abs(full.false_positives() - 0.125).max() < 0.01
    assert full.predict(many)[1].max() < 0.02


def test_over_eight_languages_share_planes(spark):
    words = [f"{c}{c}{d}" for c in "abcdefghijk" for d in "xyz"]
    docs = spark.createDataFrame([(f"l{k // 3:02d}", w) for k, w in enumerate(words)], "lang string, text string")
    filters = language.fit_filters(docs)
    assert filters.planes.shape[0] == 2
    assert filters.predict([w for w in words])[0] == [f"l{k // 3:02d}" for k in range(len(words))]


def test_language_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = {r.doc_id: r for r in language.op12_language(spark, sf_dir).collect()}
    given = {r.doc_id: r for r in docs.collect()}
    assert got.keys() == given.keys()
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i].score <= 1 for i in given)
    held = [i for i in given if got[i].held_out and given[i].lang]
    assert np.mean([got[i].lang_pred == given[i].lang for i in held]) >= 0.95


def test_what_is_held_out_is_not_learned(spark):
    rows = [(k, "uvwuvw uvw", "yes" if zlib.crc32(str(k).encode()) % 5 else "no") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit_filters(docs.where(~language.held_out(F.col("doc_id")))).langs == ["yes"]


def test_language_cases(spark):
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate([None, "", " \n", "123 !?", "the cat", "the cat", "日本語", "the cat sat on the mat " * 20000])] + [(None, "the", "en", None, None)], "doc_id long, text string, gram string, k string, score int")
    filters = language.fit_filters(spark.createDataFrame([("en", "the cat sat on the mat"), ("fr", "le chat est là")], "lang string, text string"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predicted(docs, filters).collect()}
    assert [got[k] for k in range(4)] == [("und", 0.0)] * 4
    assert got[4] == got[5] and got[4][0] == got[7][0] == got[None][0] == "en" and got[4][1] > 0.99
    assert got[6][0] in ("en", "fr") and got[6][1] == 0.0
    none = language.fit_filters(spark.createDataFrame([], "lang string, text string"))
    assert none.langs == [] and {r.lang_pred for r in language.predicted(docs, none).collect()} == {"und"}
    assert language.predicted(docs.limit(0), filters).count() == 0


def plain_infill(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


INFILL_TEXTS = [None, "", " ", "\t\n ", "a", " a", "a ", "é 日本 𝔘𝔫𝔦", "<P> x", "x <S>y", "a<M", "<P", "<<S <", "one two  three\nfour\t", "w" * 100000 + " " + "v " * 3000, " x y z"]


def test_infill_cases(spark):
    random.seed(8)
    texts = INFILL_TEXTS + ["".join(random.choice("ab  \n<PSM>é") for _ in range(random.randrange(300))) for _ in range(150)] + [" ".join("x" * random.choice([1, 3, 9, 700]) for _ in range(2000)) for _ in range(8)]
    rows = [(k, t, 1, "x") for k, t in enumerate(texts)] + [(None, "no id at all here", 2, "y"), (13, texts[13], 1, "x"), *[(1000 + k, t, 0, "") for k, t in enumerate(texts)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, form string").withColumn("whole", F.lit(1)).withColumn("at", F.lit(2))
    got = infill.infilled(docs).withColumn("again", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_infill(r.doc_id, r.text)
        assert r.again == (r.text or "")
    assert infill.infilled(docs.limit(0)).count() == 0


def test_every_rank_is_predicted_within_the_error_and_corrected(spark):
    random.seed(2)
    texts = ["", "x", " ".join("w" * random.choice([1, 2, 3, 900]) for _ in range(1500)), "tail  \n", "word " * 5000]
    docs = spark.createDataFrame(enumerate(texts), "k int, text string").withColumn("at", infill.rank_index(F.col("text")))
    every = docs.select("k", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("at.n").cast("int")), lambda r: infill.offset_at(F.col("at"), r.cast("long")))).alias("rank", "offset"))
    got = {}
    for r in every.orderBy("k", "rank").collect():
        got.setdefault(r.k, []).append(r.offset)
    assert [got[k] for k in range(len(texts))] == [infill.boundaries(t).tolist() for t in texts]
    found = infill.fitted(texts[4])
    assert len(found["ranks"]) == 1 and set(found["residuals"]) <= {0, 1, 2, 254, 255}
    with pytest.raises(ArithmeticError):
        infill.fitted(texts[2], error=5000)


def test_infill_query(spark, sf_dir):
    got = infill.op13_infill(spark, sf_dir).toPandas().set_index("doc_id").sort_index()
    want = {}
    for r in table(spark, sf_dir, "documents").collect():
        n, form, p, m, out = plain_infill(r.doc_id, r.text)
        want[r.doc_id] = (n, form, p, m, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert len(got) == len(want)
    for i, row in got.iterrows():
        assert tuple(None if pd.isna(x) else x for x in row) == want[i]
