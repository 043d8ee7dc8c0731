"""The registered text queries on the small tables: SQL where there is some, brute force elsewhere."""

import hashlib
import re
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from oracle import connect, same
from tokenizers import Tokenizer

from geoframe.llm import mixing
from geoframe.llm.html import main_text
from geoframe.llm.registry import ORACLE, QUERIES
from geoframe.llm.tokens import WORD_BPE


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, name):
    same(QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir), ORACLE[name])


def test_simhash(spark, sf_dir, documents):
    assert sorted(map(tuple, QUERIES["op5_simhash"](spark, sf_dir).collect())) == brute.simhash_classes(documents)


def test_suffix(spark, sf_dir, documents):
    rows = QUERIES["op8_suffix"](spark, sf_dir).collect()
    assert sorted(tuple(r)[:5] for r in rows) == brute.repeat_digests(documents, 400)
    texts = dict(documents)
    assert all(r.text == texts[r.doc_id] or r.n_removed for r in rows)


def test_mixing(spark, sf_dir, documents):
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = QUERIES["op3_mixing"](spark, sf_dir).toPandas().sort_values("doc_id")
    assert len(got) == len({i for i, _ in documents}) and (got.rate >= 0).all()
    tokens, p = brute.memberships(documents, labels)
    assert dict(zip(got.doc_id, got.n_tokens)) == tokens
    found = got[["p_clean", "p_toxic", "p_junk"]].to_numpy()
    assert np.abs(found - np.array([p[i] for i in got.doc_id])).max() < 2e-6
    total = got.n_tokens.sum()
    held, now = ((got.n_tokens.to_numpy()[:, None] * found * rate[:, None]).sum(0) / total for rate in (np.ones(len(got)), got.rate.to_numpy()))
    # so few labels mark hardly any words: memberships are nearly equal and can only come closer
    assert np.linalg.norm(now - mixing.TARGETS) < np.linalg.norm(held - mixing.TARGETS)


def test_mixing_meets_its_targets(spark):
    got = QUERIES["op3_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    for column, share in zip(("p_clean", "p_toxic", "p_junk"), mixing.TARGETS):
        assert abs((got.n_tokens * got[column] * got.rate).sum() / got.n_tokens.sum() - share) < 1e-3


def test_separators(spark, sf_dir, documents):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.encode_special_tokens = True
    want = sorted((i, len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in documents)
    assert sorted(map(tuple, QUERIES["op7_separators"](spark, sf_dir).collect())) == want


def test_packing(spark, sf_dir, documents):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want, place = {}, defaultdict(list)
    for i, t in documents:
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[i, k // 2048] = (k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    rows = QUERIES["op9_packing"](spark, sf_dir).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    for r in rows:
        place[r.sequence_id].append((r.offset, r.length))
    for spans in place.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
    least = -(-sum(x[1] for x in want.values()) // 2048)
    assert least <= len(place) <= least * 1.02 + 2


def test_audio(spark, sf_dir, documents):
    features = {}
    for r in QUERIES["op6_audio"](spark, sf_dir).collect():
        text = (dict(documents)[r.doc_id] or "").encode()
        payload = text + bytes(max(64, -(-len(text) // 64) * 64) - len(text))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r.media_bytes == len(payload) + 44
        assert features.setdefault(text, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)


def test_density(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op4_density"](spark, sf_dir).collect()
    assert {r.page_id for r in got} == set(pages) and len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        import html

        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)[^>]*>", article)]
        assert r.text == "\n".join(x for x in blocks if x) == main_text(pages[r.page_id].html) and r.n_chars == len(r.text)


def test_pipeline(spark, sf_dir, documents):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    ids = {i for i, _ in documents}
    assert rows and {r.doc_id for r in rows} <= ids
