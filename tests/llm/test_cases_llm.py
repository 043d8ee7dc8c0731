"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns, for each text operator."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geoframe.llm import audio, chat, html, mixing, packing, quality, simhash, suffix, tokens, warc
from geoframe.llm.common import components, stored

LONG = " ".join(f"w{k * k}" for k in range(30000))
TEXTS = [None, "", "   ", "a", "Alpha beta gamma delta.", "alpha beta gamma delta.", "É ß ﬁ Ω  x\ny", LONG, LONG, "the end " * 300]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts=TEXTS, twice=True):
    rows = [(k, t, "en", "s", len(t) if t is not None else None) for k, t in enumerate(texts)]
    rows += [(2, "   ", "en", "s", 3), (None, "no id here", None, None, None)] if twice else []
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(spark):
    """Extra columns named like the operators' own."""
    return documents(spark).selectExpr("*", "1 AS doc", "2 AS node", "3 AS spans", "4 AS rate", "5 AS given_0", "6 AS bands")


def test_components(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 100), (102, 102), (None, 3)] + [(200, x) for x in range(201, 260)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100} | {k: 200 for k in range(200, 260)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_cases(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(2, "   ")]
    got = simhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in got) == brute.simhash_classes(rows)
    assert simhash.classes(empty(spark)).count() == 0
    assert simhash.classes(clashing(spark)).where("doc_id is null and component_id is not null").count() == 0


def test_links_of_large_buckets_are_whole(spark, monkeypatch):
    """Chains of single-bit changes in one block: more members than the pairwise limit, every link found."""
    random.seed(3)
    words = {0x1234567890ABCDEF}
    while len(words) < 400:
        words.add(random.choice(sorted(words)) ^ 1 << random.randrange(14))
    words |= {random.getrandbits(64) for _ in range(100)}
    words = sorted(words)
    want = brute.groups(list(range(len(words))), lambda a, b: (words[a] ^ words[b]).bit_count() <= 2)
    given = spark.createDataFrame([(w - (1 << 64) if w >> 63 else w, k) for k, w in enumerate(words)], "fp long, node long")
    for limit in (4, 32, 10**6):
        monkeypatch.setattr(simhash, "PAIRWISE", limit)
        got = dict(map(tuple, components(simhash.link(given)).collect()))
        assert [got.get(k, k) for k in range(len(words))] == want


def edited(text, changes, seed):
    random.seed(seed)
    words = text.split()
    for _ in range(changes):
        words[random.randrange(len(words))] = f"new{random.random():.8f}"
    return " ".join(words)


def test_near_copies_equal_brute_force(spark, monkeypatch):
    """Copies, chains of near copies, one large group that is mostly less than similar, short and wordless texts; small limits too."""
    random.seed(4)
    rows = [(k, t) for k, t in enumerate(t for t in TEXTS if t is not None)]
    base = [f"w{random.randrange(500)}" for _ in range(120)]
    for n in range(90):
        words = list(base)
        for _ in range(n % 5):
            words[random.randrange(len(words))] = random.choice(("x", f"y{n}", f"z{random.randrange(20)}"))
        rows.append((1000 - n, " ".join(words[: random.choice((120, 120, 100, 60))])))
    bases = [" ".join(f"w{random.randrange(5000)}" for _ in range(random.randrange(60, 300))) for _ in range(12)]
    rows += list(enumerate(bases + [edited(b, c, c) for b in bases for c in (1, 2, 3, 6)] + [bases[0]] * 4 + [edited(bases[1], 2, s) for s in range(60)], 4000))
    rows += [(2000 + k, " ".join(f"v{random.randrange(40)}" for _ in range(random.randrange(12)))) for k in range(60)] + [(3000, "A B"), (3001, "a  b"), (3002, "a"), (3003, "a ")]
    want = {i: c for (i, _), c in zip(rows, brute.similar_groups(rows))}
    size = Counter(want.values())
    want = {i: c for i, c in want.items() if size[c] > 1}
    assert len(size) > 60 and max(size.values()) > 20
    for few, block, members in ((simhash.FEW, simhash.BLOCK, simhash.MEMBERS), (1, 1 << 13, 40), (10**6, 1 << 17, 1 << 10)):
        for name, value in (("FEW", few), ("BLOCK", block), ("MEMBERS", members)):
            monkeypatch.setattr(simhash, name, value)
        found = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert {r.doc_id: r.component_id for r in found} == want and len(found) == len(want)


def test_without_near_copies_cases(spark):
    """Repeated rows and ids, nulls, clashing columns, an empty table."""
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long), (1, long), (1, "another text of the same id"), (2, long + " more"), (3, None), (3, None), (None, long), (4, ""), (5, ""), (6, "another text of the same id"), (6, None)]
    kept = simhash.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(1, long), (1, "another text of the same id"), (3, None), (3, None), (None, long), (4, ""), (6, None)]))
    given = clashing(spark)
    kept = simhash.without_near_copies(given)
    assert kept.columns == given.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 6, 7, 9]
    assert simhash.without_near_copies(empty(spark)).count() == 0


def test_near_copies_of_documents_equal_brute_force(spark, sf_dir):
    """Every document of the given table, recall and precision of groups of one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect() if r.text is not None]
    want = dict(zip((i for i, _ in rows), brute.similar_groups(rows)))
    size = Counter(want.values())
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()}
    assert got == {i: c for i, c in want.items() if size[c] > 1} and got


def repeated_rows():
    random.seed(5)
    passage = "".join(random.choice("abcdefgh ") for _ in range(700))
    text = lambda n: "".join(random.choice("ijklmnop éü") for _ in range(n))
    texts = [text(50) + passage[a:b] + text(60) for a, b in ((0, 700), (100, 600), (0, 150), (300, 700), (250, 460), (0, 700))]
    texts += [texts[0], texts[0], "z" * 900, "ab" * 300, passage[:200], "", None, text(3000), "q" * 199 + "é" * 60 + passage, "r" * 200 + "é" * 60 + passage[1:]]
    return list(enumerate(texts))


@pytest.mark.parametrize("bucket", [2048, 1])
@pytest.mark.parametrize("length", [64, 200])
def test_repeats_equal_brute_force(spark, monkeypatch, bucket, length):
    """Once through sorted buckets, once through hashed strings."""
    monkeypatch.setattr(suffix, "BUCKET", bucket)
    monkeypatch.setattr(suffix, "CHUNK", 4096)
    rows = repeated_rows()
    got = suffix.strip(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), length, False, "n_bytes long, n_removed long, n_spans long, kept_sha256 string", suffix._digest).drop("text")
    assert sorted(map(tuple, got.collect())) == brute.repeat_digests(rows, length)
    kept = dict(map(tuple, suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length).collect()))
    data, gone = brute.removed(rows, length, keep_first=True)
    for (k, t), d, g in zip(rows, data, gone):
        if t is None:
            assert kept[k] is None
            continue
        start = 0
        want = b""
        for c in t:  # a character stays if any of its bytes does
            n = len(c.encode())
            if not all(p in g for p in range(start, start + n)):
                want += c.encode()
            start += n
        assert kept[k].encode() == want


def test_repeats_cases(spark):
    given = clashing(spark)
    kept = suffix.without_repeats(given, 200)
    assert kept.columns == given.columns and kept.count() == given.count()
    texts = {r.doc_id: r for r in kept.collect()}
    assert texts[7].text == LONG and texts[8].text == "" and texts[8].n_chars == 0 and texts[0].text is None
    assert suffix.without_repeats(empty(spark), 200).count() == 0


def test_quality_cases(spark):
    given = clashing(spark)
    judged = quality.judge(given)
    assert judged.columns == [*given.columns, "quality"]
    for r in judged.collect():
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute.quality_counts(r.text)
        assert q.base_failed == (q.n_words < 10 or 100 * q.n_repeat_words > 20 * q.n_words)
    assert quality.accepted(given).columns == given.columns and quality.accepted(empty(spark)).count() == 0


def test_quality_agrees_with_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = docs.join(labels, "doc_id").select("quality", quality.measure(F.col("text")).alias("q")).select("quality", "q.kept", "q.base_failed").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    bad = [r for r in got if r.quality == 0]
    assert all(r.kept for r in good) and sum(r.kept for r in bad) <= 0.2 * len(bad) + 1


def test_mixing_cases(spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (9, 0, 0), (7, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    given = clashing(spark)
    got = mixing.mixed(given, labels)
    assert got.columns == given.columns
    assert mixing.mix(given, labels).count() == 11  # ten ids and the null one
    assert mixing.mix(empty(spark), labels).count() == 0
    assert mixing.mix(given, labels.limit(0)).where("abs(p0 - 1/3) > 1e-9").count() == 0


def test_rates_match_targets_or_come_close(spark):
    random.seed(2)
    members = spark.createDataFrame([(k, random.randrange(1, 900), *(lambda p: (p, 1 - p))(random.random())) for k in range(300)], "doc_id long, n_tokens long, p0 double, p1 double")
    for targets in ((0.8, 0.2), (0.3, 0.7), (0.6, 0.4), (0.45, 0.55), (0.999, 0.001)):
        got = mixing.fit_rates(members, targets, rounds=400).toPandas()
        assert (got.rate >= 0).all()
        a, n = np.stack((got.n_tokens * got.p0, got.n_tokens * got.p1)), got.n_tokens.sum()
        if targets[0] < 0.9:
            assert np.abs(a @ got.rate / n - targets).max() < 1e-6
            assert np.abs(got.rate - brute.nearest_rates(got.n_tokens.to_numpy() / n, a.T / got.n_tokens.to_numpy()[:, None], np.array(targets))).max() < 1e-3


@pytest.mark.parametrize("shares", [(0.1, 0.88, 0.02), (0.95, 0.047, 0.003), (0.993, 0.004, 0.003)])
def test_rates_match_the_targets_themselves(spark, shares):
    made = np.random.default_rng(3)
    p = np.eye(3)[made.choice(3, 3000, p=shares)] * 0.97 + made.dirichlet((1, 1, 1), 3000) * 0.03
    members = spark.createDataFrame([(k, int(n), *map(float, x)) for k, (n, x) in enumerate(zip(made.integers(1, 900, 3000), p))], "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    got = mixing.fit_rates(members).toPandas()
    now = [(got.n_tokens * got[f"p{k}"] * got.rate).sum() / got.n_tokens.sum() for k in range(3)]
    assert (got.rate >= 0).all() and np.abs(np.array(now) - mixing.TARGETS).max() < 1e-6
    assert np.allclose(got.reached[0], now) and list(got.wanted[0]) == list(mixing.TARGETS)


def test_targets_out_of_reach_are_reported(spark):
    members = spark.createDataFrame([(1, 10, 0.5, 0.5), (2, 30, 0.6, 0.4)], "doc_id long, n_tokens long, p0 double, p1 double")
    with pytest.warns(UserWarning, match="aren't met"):
        got = mixing.fit_rates(members, (0.9, 0.1)).toPandas()
    best = 30 * 0.6 * 0.9 + 30 * 0.4 * 0.1  # least squares on the second document alone, which is nearer than any mixture
    rate = best * 40 / (18**2 + 12**2)
    assert np.allclose(got.rate, [0, rate], atol=1e-5) and np.allclose(got.reached[0], np.array([18, 12]) * rate / 40, atol=1e-5)


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    weights = mixing.fit_classifier(docs, labels.where(~held))
    got = mixing.posteriors(docs, weights).join(labels.where(held), "doc_id").withColumn("domain", mixing.domain_of(F.col("quality"), F.col("toxic"))).toPandas()
    guess = got[["p0", "p1", "p2"]].to_numpy().argmax(1)
    assert (guess == got.domain).mean() > 0.85


def test_encoder_equals_tokenizer():
    texts = ["it's I'LL don't <|endoftext|> x<|startoftext|>y", "Ünï ΣΑΣ ﬁ é  z q áb \x1c é İI ǅ 12.5% ...!!", "", None, "a\u0085b ½ ² ª º µ ß ÿ Ā 日本語。 ​ x Å K ſ Á", LONG[:5000]]
    tokenizer = Tokenizer.from_file(tokens.WORD_BPE)
    for plain in (False, True):
        tokenizer.encode_special_tokens = plain
        ids, ends = tokens.Encoder(tokens.WORD_BPE, plain)(pa.array(texts, pa.string()))
        begin = 0
        for text, end in zip(texts, ends):
            assert ids[begin:end].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
            begin = end


def test_separator_scan_over_blocks(spark):
    ids = np.array([5, 9, 9, 1, 2, 3, 4, 9, 7], "<u4")
    blocks = [(s, k, ids[a : a + 2].tobytes()) for s in (0, 1) for k, a in enumerate(range(0, 9, 2))] + [(1, 9, b""), (2, 0, None)]
    got = tokens.scan_separators(spark.createDataFrame(blocks, "shard long, block long, ids binary"), 9)
    want = [(0, 1), (2, 0), (3, 4), (8, 1)]
    assert sorted(map(tuple, got.collect())) == [(s, k, a, n) for s in (0, 1) for k, (a, n) in enumerate(want)]


def test_token_cases(spark):
    counts = tokens.token_counts(clashing(spark), block=64).collect()
    tokenizer = Tokenizer.from_file(tokens.WORD_BPE)
    want = [(k, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for k, t in [*enumerate(TEXTS), (2, "   "), (None, "no id here")]]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.n_tokens) for r in counts), key=key) == sorted(want, key=key)
    assert tokens.token_counts(empty(spark)).count() == 0


def test_packing_cases(spark):
    rows = packing.pack(packing.pieces(clashing(spark), capacity=100), capacity=100, rounds=8).collect()
    assert len(rows) == packing.pieces(clashing(spark), capacity=100).count()
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in used.values():
        assert [a for a, _ in sorted(spans)] == [0, *np.cumsum([n for _, n in sorted(spans)])[:-1]] and sum(n for _, n in spans) <= 100
    assert packing.pack(packing.pieces(empty(spark))).count() == 0


def test_plan_places_every_item():
    random.seed(4)
    for lengths in ([], [64] * 3, [random.randrange(1, 65) for _ in range(500)], [40] * 50 + [24] * 30, [1] * 1000):
        counts = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int)
        bins = packing.plan_bins(counts, 64, rounds=32)
        assert all(sum(items) <= 64 for items, _ in bins)
        got = np.zeros(65, int)
        for items, n in bins:
            for x in items:
                got[x] += n
        assert (got == counts).all()
    assert sum(n for _, n in packing.plan_bins(np.bincount([40] * 50 + [24] * 50, minlength=65), 64)) == 50


def test_configuration_is_the_best_multiset():
    values = np.zeros(11)
    values[[3, 4, 5]] = [3.1, 4.3, 5.2]
    config = packing.best_configuration(values, 10)
    assert sum(k * n for k, n in config.items()) <= 10 and abs(sum(values[k] * n for k, n in config.items()) - (3.1 * 2 + 4.3)) < 1e-9


def test_chat_parts(spark):
    part = "array<struct<type:string,text:string,uri:string,width:long,height:long,seconds:double,pages:long>>"
    rows = [
        (1, 0, "user", [("text", "look <image:0>", None, None, None, None, None), ("image", None, "u1", 56, 29, None, None), ("audio", None, "u2", None, None, 2.0, None)], "x"),
        (1, 1, "assistant", [("text", "a\\b", None, None, None, None, None), ("document", None, "u3", None, None, None, 3), ("text", "</turn>", None, None, None, None, None)], "x"),
        (2, None, None, None, "x"),
        (None, 0, "user", [], "x"),
    ]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {part}, mask string")).collect()}
    r = got[1]
    assert [(a.type, a.uri, a.tokens, r.formatted[a.at : a.at + len(a.type) + 4]) for a in r.attachments] == [("image", "u1", 4, "<image:0>"[:9]), ("audio", "u2", 50, "<audio:1>"), ("document", "u3", 768, "<document:2>")]
    assert chat.read_turns(r.formatted) == [("user", [("text", "look <image:0>"), ("image", "0"), ("audio", "1")]), ("assistant", [("text", "a\\b"), ("document", "2"), ("text", "</turn>")])]
    assert "".join(chat.unescape(r.formatted[m.first : m.end]) for m in r.mask) == "a\\b</turn>" and r.expanded_tokens == 822
    assert chat.read_turns(got[2].formatted) == [("", [])] and chat.read_turns(got[None].formatted) == [("user", [])]
    with pytest.raises(ValueError, match="not a formatted"):
        chat.read_turns(got[1].formatted + "x")
    texts = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(texts).count() == 0


@pytest.mark.parametrize("text", ["", "plain", "\\", "\\\\<", "</turn>\n<turn:user>", "<turn:x>\\", "a>b\\>"])
def test_chat_round_trip(text):
    made = chat.Flattener()
    made.turn(text, [{"type": "text", "text": text}])
    made.turn("assistant", [{"type": None, "text": text}])
    parts = [("text", text)] if text else []
    assert chat.read_turns("".join(made.parts)) == [(text, parts), ("assistant", parts)]


PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body class="page">
<header><h2>Site</h2></header><nav><a href=x>Home</a></nav><div class="cookie-notice"><p>We use cookies, a lot of them, all day long.</p></div>
<div id=wrap><aside class="sidebar"><p>Side words that go on for a while.</p></aside>
<article><header><h1>Head&nbsp;line &amp; more</h1></header><p>One <b>bold</b>
 and <a href="y">linked</a> text.<p>Two<ul><li>first<li>second</ul><form><input value=1><p>Mail us</p></form>
<div class="ad-box">Buy!</div><table><tr><td>c1<td>c2</table>Loose text<br>here <img src=z alt="q>r"> end</article>
<section id="comments"><p>Reader says something rather long about all of this and more.</p></section></div>
<footer>&copy; all</footer></body></html>"""


def test_main_text():
    assert html.main_text(PAGE).split("\n") == ["Head line & more", "One bold and linked text.", "Two", "first", "second", "c1", "c2", "Loose text here end"]
    assert html.main_text("") == "" and html.main_text("<p>") == "" and html.main_text("just text & more") == "just text & more"
    assert html.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert html.main_text("<body><div><p>" + "word " * 50000 + "</p></div><div class=menu>x</div></body>") == ("word " * 50000).strip()


@pytest.mark.parametrize("wrapper", ["has-sidebar", "page no-comments", "sidebar"])
def test_layout_classes_keep_the_article(wrapper):
    page = f"<body><div class='{wrapper}'><main><p>Kept words of the article.</p></main><div class='sidebar'><p>Gone words.</p></div></div></body>"
    assert html.main_text(page) == "Kept words of the article."


LONG_P = "<p>" + "paragraph " * 50 + "</p>"
PARTS = f"<h2>Second head</h2>Bare <b>bold</b> <a href=x>linked</a> words.<section>{LONG_P * 3}</section><ul><li>first</ul><table><tr><td>c1</table><pre>code</pre><blockquote>said</blockquote><div>short</div><section>{LONG_P * 2}</section>tail <em>end</em>"


@pytest.mark.parametrize("wrapper", ["article", "main", "div"])
def test_text_beside_the_densest_part_is_kept(wrapper):
    got = html.main_text(f"<body><nav>menu</nav><{wrapper}>{PARTS}</{wrapper}><div>Small print</div></body>").split("\n")
    para = ("paragraph " * 50).strip()
    assert got == ["Second head", "Bare bold linked words.", *[para] * 3, "first", "c1", "code", "said", "short", *[para] * 2, "tail end"]


def test_bare_text_of_an_article_with_a_dense_part():
    bare = "0123456789" * 100
    assert html.main_text(f"<body><article>{bare}<div>{LONG_P * 3}</div></article></body>").startswith(bare)
    assert html.main_text(f"<body>{bare}<h3>Title</h3><div>{LONG_P * 3}</div></body>").startswith(f"{bare}\nTitle\n")


BODY = f"<h2>Head</h2>{LONG_P * 3}<ul><li>first</ul>"
BODY_TEXT = ["Head", *[("paragraph " * 50).strip()] * 3, "first"]


@pytest.mark.parametrize("opened", ["<form><article>{}</article></form>", "<form action=x><input value=1><div>{}</div><button>Send</button></form>", "<form><input value=1><div>{}</div>", "<nav><a href=x>Home</a><main>{}</main></nav>", "<aside><article>{}</article></aside>", "<div id=page class='header-fixed'><div>{}</div></div>", "<article><section class='social-history'>{}</section></article>"])
def test_wrappers_keep_the_page(opened):
    assert [x for x in html.main_text(f"<body>{opened.format(BODY)}</body>").split("\n") if x != "Home"] == BODY_TEXT


def test_boilerplate_beside_an_article_still_goes():
    comments = f"<section id=comments>{LONG_P * 6}</section>"
    teaser = "<aside><article><p>Teaser words</p></article></aside>"
    got = html.main_text(f"<body><form><p>Mail us</p></form><article>{BODY}</article>{teaser}{comments}</body>").split("\n")
    assert got == BODY_TEXT


def test_unmarked_menu_without_an_article_is_left_out():
    menu = "<ul>" + "<li><a href=x>Menu item</a>" * 30 + "</ul>"
    assert "Menu" not in html.main_text(f"<body><div>{menu}<h3>Title</h3><div>{LONG_P * 3}</div></div></body>")


def test_extract_cases(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 7), (1, "u", PAGE, 7), (None, None, None, None), (2, "v", "", 8)], "page_id long, url string, html string, text int")
    got = html.extract(pages.withColumnRenamed("text", "extra"))
    assert got.columns == ["page_id", "url", "extra", "text", "n_chars"] and got.count() == 4
    assert got.where("page_id is null").first().text == ""


def test_audio_cases(spark):
    media = audio.media_column(clashing(spark))
    rows = media.collect()
    assert len(rows) == 12 and all(audio.from_wav(r.media)[0] == audio.RATE for r in rows)
    assert {len(audio.from_wav(r.media)[1]) for r in rows if r.n_bytes == 0} == {64}
    patches = audio.audio_patches(media).groupBy("doc_id").count().collect()
    assert len(patches) == len({r.doc_id for r in rows})
    for r in stored(audio.audio_tensors(media), "tensors").collect():
        kept = pa.ipc.open_stream(r.tensors).read_all()
        assert kept.schema.field("logmel").type == pa.fixed_shape_tensor(pa.float16(), (audio.PATCH, audio.MELS), dim_names=["frame", "mel"])
        got, want = audio.from_tensors(r.tensors), audio.features(next(x.media for x in rows if x.doc_id == r.doc_id))
        assert r.doc_id == 2 or all(np.allclose(a.astype(float), b.astype(float), atol=0.02) for a, b in zip(got, want))  # products of matrices may round otherwise in another process
    assert audio.audio_segments(media).where("end_s <= start_s").count() == 0
    assert audio.audio_patches(audio.media_column(empty(spark))).count() == 0


@pytest.mark.parametrize(("rate", "target"), [(16000, 8000), (8000, 12000), (44100, 16000), (8000, 8000)])
def test_resampling_keeps_a_tone(rate, target):
    t = np.arange(rate) / rate
    y = audio.resample(np.sin(2 * np.pi * 440 * t).astype(np.float32), rate, target)
    want = np.sin(2 * np.pi * 440 * np.arange(len(y)) / target)
    assert len(y) == target and np.abs(y - want)[200:-200].max() < 0.02


def test_segments_have_hysteresis():
    quiet, loud = 128 * np.ones(16000, np.uint8), (128 + 100 * np.sin(np.arange(8000))).astype(np.uint8)
    got = audio.features(audio.to_wav(np.concatenate((quiet, loud, quiet)).tobytes())).segments
    assert len(got) == 1 and abs(got[0][0] - 1.0) < 0.05 and abs(got[0][1] - 1.5) < 0.05


def test_warc_cases(spark):
    long = "x" * 99 + "é"
    rows = [(5, "u", long), (3, "u b\r\nc", long), (9, None, long), (7, "s", "short"), (8, "s", "short"), (1, "n", None), (None, "n", long), (3, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    bundles = warc.write_bundles(warc.mark_revisits(pages), frame_bytes=200, bundle_bytes=300)
    got = warc.read_bundles(bundles).collect()
    assert len(got) == len(rows) and bundles.count() > 1
    assert all(r.payload.decode() == long for r in got if r.record_type == "response" and r.payload_bytes > 100)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    assert kinds == sorted([("5", "revisit", 3), ("3", "response", None), ("9", "revisit", 3), ("7", "response", None), ("8", "response", None), ("1", "response", None), ("None", "response", None), ("3", "response", None)])
    assert {r.url for r in got} == {"u", "u%20b%0D%0Ac", "", "s", "n"}
    assert warc.read_bundles(warc.write_bundles(warc.mark_revisits(pages.limit(0)))).count() == 0


def test_features_equal_plain_versions(monkeypatch):
    """Against zero-stuffing and convolution, and one frame at a time; also in small slices."""
    made = np.random.default_rng(5)
    for size in (64, 640, 20032):
        payload = made.integers(90, 170, size).astype(np.uint8).tobytes()
        x = (np.frombuffer(payload, np.uint8) - 128.0) / 128
        t = np.arange(-16, 17)
        taps = np.sinc(t / 2) * np.hanning(35)[1:-1]
        low = np.convolve(x, taps / taps.sum())[16 : 16 + size : 2]
        n = 1 + max(0, -(-(len(low) - 200) // 80))
        low = np.concatenate((low, np.zeros(max(0, (n - 1) * 80 + 200 - len(low)))))
        edges = 700 * (10 ** (np.linspace(0, 2595 * np.log10(1 + 4000 / 700), 26) / 2595) - 1)
        hertz = np.arange(129) * 8000 / 256
        bank = np.array([[max(0, min((f - a) / (b - a), (c - f) / (c - b))) for f in hertz] for a, b, c in zip(edges, edges[1:], edges[2:])])
        want = np.full((-(-n // 16) * 16, 24), np.log(1e-6))
        for k in range(n):
            spectrum = np.abs(np.fft.rfft(low[k * 80 : k * 80 + 200] * np.hanning(202)[1:-1], 256)) ** 2
            want[k] = np.log(bank @ spectrum + 1e-6)
        for piece in (audio.SLICE, 800):
            monkeypatch.setattr(audio, "SLICE", piece)
            got = audio.features(audio.to_wav(payload))
            assert np.abs(got.patches.reshape(-1, 24) - want).max() < 0.02


def test_damaged_conversations_end_at_once():
    for text in ("<turn:user>" + "a" * 40 + "</turn>", "<turn:" + "a" * 5000, "<turn:user>" + "a\\\\<" * 5000):
        with pytest.raises(ValueError, match="not a formatted conversation"):
            chat.read_turns(text)


def test_stages_keep_rows_and_clashing_columns(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(4, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for given in (clashing(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            done = stage(spark, given, str(tmp_path))
            assert done.columns == given.columns, name
            assert {r.doc_id for r in done.collect()} <= {r.doc_id for r in given.collect()}
        assert corpus_pipeline.STAGES[-1][1](spark, given, str(tmp_path)).count() >= given.count()


def test_pages_with_a_text_column(spark):
    pages = spark.createDataFrame([(1, "<p>New words.</p>", "old", 3)], "page_id long, html string, text string, n_chars long")
    assert [tuple(r) for r in html.extract(pages).collect()] == [(1, "New words.", 10)]


@pytest.mark.parametrize("marked", ["class='post alert-story'", "id='banner-story'", "class='social-history'"])
def test_marks_on_most_of_the_page_say_nothing(marked):
    story = "".join(f"<p>Sentence {k} of the story, which is long enough to be read as such.</p>" for k in range(6))
    page = f"<body><div class='nav'><a href='/'>Home</a></div><div {marked}>{story}</div><div>aside</div><div class='alert'>Cookies!</div></body>"
    assert html.main_text(page).startswith("Sentence 0 of") and "Sentence 5" in html.main_text(page) and "Cookies" not in html.main_text(page)


def test_density_leaves_out_what_is_not_marked():
    """Link lists without a class go by their density alone: with every density equal they would stay."""
    story = "".join(f"<p>Sentence {k} of the story, which is long enough to be read as such.</p>" for k in range(6))
    links = "<div>" + "".join(f"<div><a href='/{k}'>Link {k}</a></div>" for k in range(12)) + "</div>"
    page = f"<body>{links}<div><div>{story}</div></div>{links}</body>"
    got = html.main_text(page)
    assert got.startswith("Sentence 0") and got.endswith("as such.") and "Link" not in got
