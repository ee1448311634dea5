"""Each operator against a brute-force version, the library it stands for, or held-out rows."""

import base64
import hashlib
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import base, byte_bpe, decontaminate, html_text, licenses, ngram_join, queries, token_counts, toxicity, warc

tokenizers = pytest.importorskip("public_tokenizers")
TEXTS = st.text(alphabet=st.sampled_from("ab \n\té漢🙂▁'_1²<s>Ð"), max_size=60)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_token_counts_are_the_librarys(t):
    import sentencepiece

    path = tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    assert token_counts.counter(path)([t]) == [len(sp.encode(t, num_threads=1))]


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_byte_bpe_is_the_librarys(t):
    import tiktoken

    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    ids, back = byte_bpe.coder(path, tokenizers.PATTERN)([t])[0]
    assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(t) and back.decode() == t


def library(name):
    if name == "op8":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))
        return lambda t: sp.encode(t, num_threads=1)
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={}).encode_ordinary


LETTERS = {"one": "x" * 200_000, "two": "ab" * 30_000, "random": "".join(random.Random(1).choices("etaoinshrdlu", k=60_000)), "runs": "".join(random.Random(2).choices("aab", k=5_000)), "han": "".join(map(chr, random.Random(3).choices(range(0x4E00, 0x9000), k=20_000)))}


@pytest.mark.parametrize("kind", LETTERS)
def test_words_of_any_length(kind):
    t = f"so {LETTERS[kind]} und"
    assert token_counts.counter(tokenizers.path("piece_bpe_32k.model"))([t]) == [len(library("op8")(t))]
    code = byte_bpe.coder(tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
    ids, back = code([t])[0]
    assert back.decode() == t and np.frombuffer(ids, "<u4").tolist() == library("op10")(t)


@pytest.mark.parametrize("seed", range(30))
def test_windows_without_a_joint_are_merged(seed):
    # merges of a toy model whose tokens are long for its windows
    r = random.Random(seed)
    ranks = {bytes([c]): i for i, c in enumerate(b"abc")}
    while len(ranks) < 60:
        a, b = r.choices(list(ranks), k=2)
        ranks.setdefault(a + b, len(ranks))

    def merge(word):
        parts = [word[i : i + 1] for i in range(len(word))]
        while found := [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]:
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        at = np.cumsum([0, *map(len, parts)]).tolist()
        return list(zip(at, parts, strict=False))

    word = bytes(r.choices(b"abc", weights=(r.randint(1, 9), r.randint(1, 9), 1), k=300))
    spans = [(a, min(300, a + 24)) for a in range(0, 292, 16)]
    assert base.stitched(spans, lambda s: [[(a + k, t) for k, t in merge(word[a:b])] for a, b in s]) == merge(word)


def test_whole_tables_are_the_libraries(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    count, encode = library("op8"), library("op10")
    for r in queries.op8_token_counts(spark, sf).collect():
        assert (r["n_tokens"], r["n_bytes"]) == (len(count(texts[r["doc_id"]])), len(texts[r["doc_id"]].encode()))
    for r in queries.op10_byte_bpe(spark, sf).collect():
        ids = encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_decoding_a_column_of_ids(spark):
    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = [None, "", "a b", "漢字 🙂 é", "a b"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = byte_bpe.byte_bpe(d, path, tokenizers.PATTERN).select("doc_id", "ids")
    got = {r["doc_id"]: bytes(r["decoded"]).decode() for r in byte_bpe.decoded(ids, path, tokenizers.PATTERN).collect()}
    assert got == {k: t or "" for k, t in enumerate(texts)}
    with pytest.raises(ValueError):
        byte_bpe.coder(path, tokenizers.PATTERN).decode([b"\xff\xff\xff\x00"])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\té.\x0b"), max_size=50))
def test_word_hashes(t):
    data = t.encode().lower()
    h = base.hash_words(data)
    words = data.split()
    assert len(h) == len(words) and len(set(h.tolist())) == len(set(words))
    assert all(base.hash_words(w)[0] == x for w, x in zip(words, h, strict=True))


def near(r, words, changes):
    out = list(words)
    for _ in range(changes):
        out[r.randrange(len(out))] = f"neu{r.random()}"
    return out


def corpus(seed, n=300):
    """Texts of many lengths with copies, near copies on either side of the threshold, and a passage that many share."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 6)))
    passage = [word() for _ in range(60)]
    out = []
    while len(out) < n:
        w = [word() for _ in range(r.choice((1, 2, 3, 5, 12, 40, 60, 110, 150, 400, 900)))]
        if r.random() < 0.3:
            w = w[: len(w) // 2] + passage + w[len(w) // 2 :]
        for _ in range(r.choice((1, 1, 2, 5, 20)) if r.random() < 0.3 else 1):
            out.append(" ".join(near(r, w, r.choice((0, 0, 1, 2, max(1, len(w) // 60), max(1, len(w) // 40))))))
    return out


def brute_components(sets, num, den):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("size", "num"), [(3, 90), (5, 80)])
def test_ngram_classes_are_exact(spark, size, num, monkeypatch):
    texts = corpus(size)
    sets = []
    for t in texts:
        w = t.lower().split()
        n = min(size, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    want = brute_components(sets, num, 100)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # then components are cut into blocks, by shingles and by sets, keys have many classes and ties are united in small parts
    for block, few, many, rows in ((ngram_join.BLOCK, ngram_join.FEW, ngram_join.SETS, ngram_join.UNITED), (3_000, 2, 128, 1_000), (10_000, 1, 4, 50)):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "FEW", few)
        monkeypatch.setattr(ngram_join, "SETS", many)
        monkeypatch.setattr(ngram_join, "PAIRED", 8 * many)
        monkeypatch.setattr(ngram_join, "SPREAD", 1)
        monkeypatch.setattr(ngram_join, "UNITED", rows)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_classes(d, size, num, 100).collect()}
        assert [got[i] for i in range(len(texts))] == [(len(s), w) for s, w in zip(sets, want, strict=True)]


def test_keys_of_linked_sets_meet():
    r = np.random.default_rng(3)
    for num in (80, 90):
        for n in (3, 10, 60, 125, 160, 300, 399, 400, 401, 450, 499, 501, 656, 1049, 2000):
            for _ in range(20):
                a = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
                cut = r.integers(0, n * (100 - num) // (100 + num) + 1)
                b = np.unique(np.concatenate((a[cut:], r.integers(0, 2**64, cut, dtype=np.uint64))))
                common = ngram_join.overlap(a, b)
                if len(a) and len(b) and 100 * common >= num * (len(a) + len(b) - common):
                    for often in (np.zeros(0, np.uint64), np.sort(r.choice(a, len(a) // 2, replace=False))):
                        for miss in (0.0, 1e-12):
                            assert set(ngram_join.keys_of(a, num, 100, often, miss).tolist()) & set(ngram_join.keys_of(b, num, 100, often, miss).tolist())


@pytest.mark.parametrize("num", [80, 90])
def test_groups_for_a_chance_keep_to_it(num):
    # a chance that can be counted
    r = np.random.default_rng(12)
    low, most, groups = ngram_join.tiers(num, 100, 0.01)
    n, d, k = int(low[0]), int(most[0]), int(groups[0])
    lost = 0
    for _ in range(4000):
        common, other = r.integers(0, k, n * num // 100), r.integers(0, k, d)
        lost += not len(np.setdiff1d(common, other))
    assert k <= d and lost <= 0.015 * 4000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_united_ties_are_components(pairs):
    a, b = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    node, root = ngram_join.united(a, b)
    low = {x: x for p in pairs for x in p}
    for _ in pairs:
        for x, y in pairs:
            low[x] = low[y] = min(low[x], low[y])
    assert dict(zip(node.tolist(), root.tolist(), strict=True)) == {x: r for x, r in low.items() if r != x}


def test_count_tree_loses_nothing():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 400, r.integers(20, 300)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(200)]
    points = np.array([ngram_join.counts(s) for s in sets])
    tree = ngram_join.CountTree(points, 60, 100)
    for q, s in enumerate(sets):
        found = set(tree.search(points[q])[0].tolist())
        for k, t in enumerate(sets):
            common = ngram_join.overlap(s, t)
            if 100 * common >= 60 * (len(s) + len(t) - common):
                assert k in found


def test_embedding_graph_finds_all_links(spark, sf):
    r = np.random.default_rng(5)
    base_ = r.normal(size=(300, 16))
    x = np.concatenate([base_, base_[:60] + r.normal(scale=0.08, size=(60, 16)), base_[0] + r.normal(scale=0.03, size=(150, 16))])
    label = np.concatenate([np.arange(300) % 3, np.arange(60) % 3, np.zeros(150, int)])
    d = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<double>, label int")
    from lexmill.llm import embedding_graph

    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = (u @ u.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(hit, False)
    got = {q["vec_id"]: q for q in embedding_graph.near_duplicates(d).collect()}
    assert sum(got[i]["n_links"] for i in got) >= 0.99 * hit.sum() and all(got[i]["n_links"] <= hit[i].sum() for i in got)
    assert sum(q["audit_found"] or 0 for q in got.values()) >= 0.9 * sum(q["audit_links"] or 0 for q in got.values())


@pytest.mark.parametrize("cut", [0, 3])
def test_alignment_is_smith_waterman(cut):
    r = np.random.default_rng(6)
    for _ in range(50):
        a, b = (r.integers(0, 6, r.integers(1, 14)).astype(np.uint64) for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontaminate.align(a, b)[0] == h.max()


def test_leaks_are_found_and_clean_texts_left(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("aeiounst") for _ in range(r.randint(2, 7)))
    items = [[word() for _ in range(r.randint(15, 45))] for _ in range(30)]
    rows, want = [], {}
    for i in range(200):
        w = [word() for _ in range(r.randint(30, 400))]
        if i % 4 == 0:
            k = r.randrange(30)
            leak = list(items[k])
            if i % 8 == 0:
                for _ in range(len(leak) // 8):
                    leak[r.randrange(len(leak))] = word()
                del leak[r.randrange(len(leak))]
            at = r.randrange(len(w))
            w[at:at] = leak
            want[i] = k
        rows.append((i, " ".join(w)))
    d, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {q["doc_id"]: [m["item_id"] for m in q["matches"]] for q in decontaminate.contamination(d, b).collect()}
    assert {i: m for i, m in got.items() if m} == {i: [k] for i, k in want.items()}
    decontaminate.ITEM_WORDS, keep = 200, decontaminate.ITEM_WORDS  # several blocks of items
    try:
        again = {q["doc_id"]: [m["item_id"] for m in q["matches"]] for q in decontaminate.contamination(d, b).collect()}
    finally:
        decontaminate.ITEM_WORDS = keep
    assert {i: sorted(m) for i, m in again.items()} == got


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    out = queries.op9_toxicity(spark, d).toPandas()
    y = spark.read.parquet(f"{d}/labels.parquet").toPandas()
    m = out.merge(y, on="doc_id")
    m = m[m.held_out]
    assert ((m.score >= 0.5) == (m.predicted == 1)).all() and m.score.between(0, 1).all()
    both = ((m.predicted == 1) & (m.toxic == 1)).sum()
    assert both >= 0.85 * (m.toxic == 1).sum() and both >= 0.95 * (m.predicted == 1).sum()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab "), max_size=40), st.lists(st.sampled_from([" a", " ab", " aba", " b ", " bb", " ab "]), unique=True), st.lists(st.sampled_from([" a ab ", " ab a b ", " b ", " aba b "]), unique=True))
def test_hits_are_those_of_a_naive_matcher(text, terms, phrases):
    lex = toxicity.Lexicon({t: float(len(t)) for t in terms}, tuple(phrases))
    f = toxicity.fold(text)
    clear = [(i, i + len(p)) for p in phrases for i in range(len(f)) if f.startswith(p, i)]
    want = []
    for i in range(len(f)):
        here = [t for t in terms if f.startswith(t, i)]
        if here:
            n = max(map(len, here))
            if not any(a <= i and i + n <= b for a, b in clear):
                want.append((i, i + n, float(n)))
    assert sorted(toxicity.hits(lex.matcher(), f)) == want


@pytest.mark.parametrize("t", ["1d10t", "іdіоt", "ídíòt", "i​diot", "IDIOT", "id!ot", "ｉｄｉｏｔ"])
def test_folding(t):
    assert toxicity.fold(t) == " idiot "


def test_exception_phrases_cancel():
    lex = toxicity.Lexicon({" trash": 5.0}, (" trash can ",))
    m = lex.matcher()
    assert toxicity.hits(m, toxicity.fold("a trash can")) == [] and len(toxicity.hits(m, toxicity.fold("trash, trashy"))) == 2


def test_main_text_of_pages(spark, sf):
    import html
    import re

    out = {r["page_id"]: r["text"] for r in queries.op3_html_text(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        a = re.sub(r"<br>", " ", re.search(r"<article>(.*?)</article>", r["html"], re.DOTALL)[1])
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1|h2|li|ul)(?:\s[^>]*)?>", a)]
        assert out[r["page_id"]] == "\n".join(b for b in blocks if b)


def test_main_text_of_pages_that_were_not_trained_on():
    r = random.Random(12345)
    trees, right = html_text.model(), 0
    for _ in range(100):
        source = html_text.training_page(r)
        p = html_text.Page(source)
        want = "\n".join(b for b in (p.block(i) for i in range(len(p.tag)) if p.mark[i] == 1 and p.texts[i]) if b)
        right += html_text.texts([source], trees)[0] == want
    assert right >= 90


def test_trees_that_are_kept_are_those_that_are_fitted():
    a, b = html_text.model(), html_text.fitted()
    x = np.concatenate([html_text.features(html_text.Page(html_text.training_page(random.Random(k)))) for k in range(20)])
    assert np.allclose(a(x), b(x), atol=1e-6)


#: Pages by another hand than the one that writes those for training: other tags, names and order of parts.
PAGES = {
    "blog": ("""<html><head><title>T</title><style>p{}</style></head><body><div id="masthead"><a href="/">Home</a> <a href="/a">About</a></div><div class="hentry post-12"><h2 class="entry-title">A walk along the river</h2>
      <div class="entry-content"><p>The path begins behind the old mill, where the water is slow and the reeds are tall enough to hide a heron.</p><p>After two miles it turns away from the bank, and for a while there is only the noise of the road.</p></div></div>
      <div id="sidebar"><h3>Archive</h3><ul><li><a href="/1">May</a></li><li><a href="/2">June</a></li></ul></div><div id="footer">Copyright 2019. All rights reserved.</div></body></html>""",
      "A walk along the river\nThe path begins behind the old mill, where the water is slow and the reeds are tall enough to hide a heron.\nAfter two miles it turns away from the bank, and for a while there is only the noise of the road."),
    "news": ("""<body><nav><ul><li><a href=1>World</a><li><a href=2>Sport</a><li><a href=3>Culture</a></ul></nav><main><article><h1>Council votes for the bridge</h1><p>The council voted on Monday night to rebuild the bridge, nine years after it was closed to traffic.
      <p>Work is to begin in spring, and to last for eighteen months, said the mayor.<blockquote>We have waited long enough, and so have the people on the other side.</blockquote><aside class="related"><a href=5>More on this</a></aside><p>The cost is put at four million, of which the state pays half.</article></main><footer><p>Contact us | Imprint</p></footer></body>""",
      "Council votes for the bridge\nThe council voted on Monday night to rebuild the bridge, nine years after it was closed to traffic.\nWork is to begin in spring, and to last for eighteen months, said the mayor.\nWe have waited long enough, and so have the people on the other side.\nThe cost is put at four million, of which the state pays half."),
    "formula": ("""<article><h1>Sums</h1><p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is in all cases larger than either part, as long as both are positive numbers.</p><p>The same is true of three numbers, and of any number of them.</p></article>""",
      "Sums\nThe sum a+b is in all cases larger than either part, as long as both are positive numbers.\nThe same is true of three numbers, and of any number of them."),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text_of_pages_by_another_hand(name):
    source, want = PAGES[name]
    assert html_text.texts([source], html_text.model()) == [want]


def test_choices_never_contradict():
    r = random.Random(5)
    g = np.random.default_rng(5)
    for _ in range(20):
        p = html_text.Page(html_text.training_page(r))
        inside = html_text.decode(p, g.normal(0, 3, len(p.tag)))
        out = [False] * len(p.tag)
        for i in range(1, len(p.tag)):
            out[i] = out[p.parent[i]] or (inside[p.parent[i]] and not inside[i])
            assert not (out[i] and inside[i])


def test_warc_round_trip(spark, sf):
    out = queries.op4_warc(spark, sf).toPandas().set_index("page_id")
    pages = spark.read.parquet(f"{sf}/pages.parquet").toPandas()
    assert len(out) == len(pages)
    for r in pages.itertuples():
        body = r.html.encode()
        assert out.payload_digest[r.page_id] == base64.b32encode(hashlib.sha1(body).digest()).decode() and out.payload_bytes[r.page_id] == len(body)


def test_files_of_archives_are_bounded(spark):
    from lexmill.session import new_path

    d = spark.createDataFrame([(k, "http://a/", f"{k} " + "x" * 10_000) for k in range(60)], "page_id long, url string, html string").coalesce(1)
    path = new_path(spark, "warc-files")
    warc.write_archives(d, path, bytes_per_file=100_000)
    files = spark.read.format("binaryFile").load(path).count()
    assert 6 <= files <= 8 and warc.captures(warc.read_archives(spark, path)).count() == 60


def test_archives_of_members():
    import gzip

    one = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <a>\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    for data in (one * 3, gzip.compress(one) * 3, gzip.compress(one * 3)):
        assert [b for _, b in warc.Reader(data)] == [b"ab\r\nc"] * 3
    large = b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 30000000\r\n\r\n" + b"y" * 30_000_000 + b"\r\n\r\n"
    for data in (large + one, gzip.compress(large, 1) + gzip.compress(one)):
        assert [len(b) for _, b in warc.Reader(data)] == [30_000_000, 5]
    with pytest.raises(ValueError):
        list(warc.Reader(one[:-6]))


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""


@pytest.mark.parametrize(("t", "want"), [
    (MIT, ["MIT"]),
    ("Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License.", ["Apache-2.0"]),
    ("x. This work is licensed under the GNU General Public License, version 3. y", ["GPL-3.0-only"]),
    ("SPDX-License-Identifier: BSD-3-Clause\n", ["BSD-3-Clause"]),
    ("Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", ["CC-BY-NC-4.0", "MIT"]),
    ("the license is under review", []),
])
def test_licences(t, want):
    assert [r["license_id"] for r in licenses.recognised(t)] == want
    assert all(licenses.ANCHORS.search(s) for s in licenses.known())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rows = queries.queries()[name](spark, sf)
    names = sorted(rows.columns)
    a = [tuple(r[c] for c in names) for r in rows.collect()]
    b = con.execute(f"SELECT {', '.join(names)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_ties_inside_a_batch():
    nodes, sizes, keys = np.array([5, 3, 9]), np.array([2, 1, 1]), np.array([7, 8, 7, 8])
    key, node, a, b = ngram_join.local_ties(nodes, sizes, keys)
    assert sorted(zip(key.tolist(), node.tolist(), strict=True)) == [(7, 3), (7, 5), (8, 5), (8, 9)] and not len(a)
    key, node, a, b = ngram_join.local_ties(nodes, sizes, keys, few=1)
    assert sorted(zip(key.tolist(), node.tolist(), strict=True)) == [(7, 3), (8, 5)]
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(5, 3), (9, 5)]


def test_a_key_of_many_ties_only_what_may_link():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 2**64, int(r.integers(20, 60)), dtype=np.uint64)) for _ in range(150)]
    sets += [s[: len(s) - 1] for s in sets[:40]]
    points = np.array([ngram_join.counts(s) for s in sets])
    m = len(sets)
    node, head, key, times = np.arange(m), np.zeros(m, int), np.full(m, 7), np.full(m, m)
    t = points.sum(1)
    x, y = np.nonzero(180 * np.minimum(points[:, None], points[None]).sum(2) >= 80 * (t[:, None] + t[None]))
    want = sorted(zip(*(v.tolist() for v in ngram_join.united(x, y)), strict=True))
    for few in (4, 1_000):
        a, b = ngram_join.key_ties(key, node, head, times, points, 80, 100, few)
        assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == want and 40 <= len(want) < 60
    # more than are looked at, or a row that stands for others
    for more, most in ((0, 100), (1, 1_000)):
        a, b = ngram_join.key_ties(key, node, head, times + more, points, 80, 100, 4, most)
        assert a.tolist() == list(range(1, m)) and not b.any()


def test_the_sample_of_common_shingles_grows_with_the_texts(spark, monkeypatch):
    # each passage is in 64 of 6,400 texts, one in 100; of a sample of 50 texts no three would have one
    rows = [(i, f"p{i % 100}a p{i % 100}b p{i % 100}c own{i}a own{i}b") for i in range(6400)]
    d = spark.createDataFrame(rows, "id long, text string").repartition(4)
    monkeypatch.setattr(ngram_join, "SAMPLE", 50)
    passages = {int(ngram_join.shingle_set(f"p{k}a p{k}b p{k}c", 3)[0]) for k in range(100)}
    found = ngram_join.common_shingles(d, 3, 80, 100).tolist()
    assert len(passages & set(found)) >= 85 and set(found) <= passages and found == sorted(found)
    monkeypatch.setattr(ngram_join, "KNOWN", 30)
    assert 0 < len(ngram_join.common_shingles(d, 3, 80, 100)) <= 30


@pytest.mark.parametrize("few", [16, 4])
def test_a_stray_links_with_a_set_that_its_batch_has_collapsed(spark, few, monkeypatch):
    # sets of one-word shingles in hash order: a word that 25 sets of a batch share is the first of each; the stray has two words before it
    words = sorted((f"w{i}" for i in range(2000)), key=lambda w: int(ngram_join.shingle_set(w, 1)[0]))
    texts = [" ".join([words[2], *words[3 + 19 * i : 22 + 19 * i]]) for i in range(25)]
    head = min(range(25), key=lambda i: int(ngram_join.mix(ngram_join.shingle_set(texts[i], 1)).sum(dtype=np.uint64).view(np.int64)))
    twin = (head + 1) % 25
    stray = " ".join([*words[:2], texts[twin]])
    none = np.zeros(0, np.uint64)
    met = [set(ngram_join.keys_of(ngram_join.shingle_set(t, 1), 90, 100, none).tolist()) for t in (texts[twin], stray)]
    assert len(met[0] & met[1]) == 1
    monkeypatch.setattr(ngram_join, "SAMPLE", 0)
    monkeypatch.setattr(ngram_join, "FEW", few)
    one, other = (spark.createDataFrame(rows, "doc_id long, text string").coalesce(1) for rows in (list(enumerate(texts)), [(25, stray)]))
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, "25")  # the stray is alone in its batch
    try:
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_classes(one.union(other), 1, 90, 100).collect()}
    finally:
        spark.conf.set(rows, before)
    assert got == {i: i for i in range(25)} | {25: twin}


def test_edited_copies_are_found_where_an_item_leaked_into_many_rows(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("aeiounst") for _ in range(r.randint(4, 9)))
    item = [word() for _ in range(37)]
    leaks = [item] * 70 + [[word() if i % 5 == k else w for i, w in enumerate(item)] for k in range(5)]
    # one word of the item in each clean row, later ones in more rows, so that no two n-grams of it are equally rare
    alone = [w for i, w in enumerate(item) for _ in range(i // 4)]
    rows = [(i, " ".join([*(word() for _ in range(40)), *(leaks[i] if i < len(leaks) else alone[i - len(leaks) : i - len(leaks) + 1]), *(word() for _ in range(40))])) for i in range(len(leaks) + len(alone))]
    d, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = decontaminate.contamination(d, b).where("size(matches) > 0").select("doc_id").collect()
    assert sorted(q["doc_id"] for q in got) == list(range(75))


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """    This program is free software%s you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation%s either version %s of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
ONLY = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


@pytest.mark.parametrize(("t", "want", "n"), [
    (APACHE, ["Apache-2.0"], 5),
    (GPL % (":", ",", 3), ["GPL-3.0-or-later"], 3),
    (GPL % (";", ";", 2), ["GPL-2.0-or-later"], 3),
    (LGPL, ["LGPL-2.1-or-later"], 1),
    (ONLY, ["GPL-2.0-only"], 1),
    (MPL, ["MPL-2.0"], 2),
    ("This software is\nreleased under the\nMIT License.\n", ["MIT"], 1),
    (MIT, ["MIT"], 2),
    ("\n".join(MIT.split()), ["MIT"], 2),
    ("Released under the MIT License; Licensed under CC BY-NC 4.0: text", ["MIT", "CC-BY-NC-4.0"], 1),
])
def test_real_notices(t, want, n):
    for text in (t, "x\n" + "".join(f" * {x}\n" for x in t.splitlines())):
        got = licenses.recognised(text)
        assert [r["license_id"] for r in got] == want and len(got[0]["sentences"]) == n


@pytest.mark.parametrize("width", [20, 30, 72, 400])
def test_known_sentences_wrapped_at_any_width(width):
    import textwrap

    for sentence, what in licenses.SENTENCES.items():
        t = "Foreword.\n\n" + textwrap.fill(sentence.replace("#", "2.0").capitalize() + ".", width, break_on_hyphens=False) + "\n\nEnd."
        assert [x[3] for x in licenses.identified(t)] == [what], sentence


@pytest.mark.parametrize(("t", "want"), [
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n", ["GPL-3.0"]),
    ("                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n", ["LGPL-3.0"]),
    ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n", ["Apache-2.0"]),
    ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n", ["MPL-2.0"]),
    ("Creative Commons Attribution 4.0 International Public License\n\nBy exercising the Licensed Rights (defined below), You accept and agree to be\nbound by the terms and conditions of this Creative Commons Attribution 4.0\nInternational Public License (\"Public License\").", ["CC-BY-4.0"]),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n", ["BSL-1.0"]),
])
def test_whole_licence_texts(t, want):
    assert [r["license_id"] for r in licenses.recognised(t)] == want


@pytest.mark.parametrize(("size", "effective"), [(64, 16), (768, 30), (16, 2)])
def test_links_over_borders_of_shards(size, effective):
    from lexmill.llm import embedding_graph

    r = np.random.default_rng(9)
    turn = np.linalg.qr(r.normal(size=(size, effective)))[0].T
    x = embedding_graph.unit(r.normal(size=(3000, effective)))
    away = r.normal(size=x.shape)
    away = embedding_graph.unit(away - (away * x).sum(1, keepdims=True) * x)
    y = (0.935 * x + np.sqrt(1 - 0.935**2) * away) @ turn
    x = x @ turn
    c = embedding_graph.centroids(np.concatenate((x, y)), 30)
    homes = [k[0] for k in embedding_graph.cells(x, c, 0.93)]
    assert all(h in k for h, k in zip(homes, embedding_graph.cells(y, c, 0.93), strict=True))


def test_many_shards_lose_no_link(spark, monkeypatch):
    from lexmill.llm import embedding_graph

    monkeypatch.setattr(embedding_graph, "SHARD", 40)
    monkeypatch.setattr(embedding_graph, "BLOCK", 64)  # shards have several blocks and chunks
    r = np.random.default_rng(10)
    turn = np.linalg.qr(r.normal(size=(64, 6)))[0].T
    base_ = embedding_graph.unit(r.normal(size=(200, 6)))
    u = embedding_graph.unit(np.concatenate([base_, base_ + r.normal(scale=0.15, size=base_.shape)]) @ turn)
    d = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(u)], "vec_id long, embedding array<double>, label int")
    hit = u @ u.T >= 0.93
    np.fill_diagonal(hit, False)
    rows = embedding_graph.near_duplicates(d).collect()
    got = {q["vec_id"]: q["n_links"] for q in rows}
    assert [got[i] for i in range(len(u))] == hit.sum(1).tolist()
    audited = [q for q in rows if q["audit_links"] is not None]
    assert len(audited) == embedding_graph.PROBES and all(q["audit_links"] == hit[q["vec_id"]].sum() == q["audit_found"] for q in audited)


def test_borders_by_links_of_the_data_lose_hardly_any(spark, monkeypatch):
    from lexmill.llm import embedding_graph

    monkeypatch.setattr(embedding_graph, "SHARD", 40)
    monkeypatch.setattr(embedding_graph, "ENOUGH", 20)
    r = np.random.default_rng(11)
    base_ = embedding_graph.unit(r.normal(size=(1200, 64)))
    u = embedding_graph.unit(np.concatenate([base_] + [base_[:300] + r.normal(scale=0.045, size=(300, 64)) for _ in range(2)]))
    d = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(u)], "vec_id long, embedding array<double>, label int")
    hit = u @ u.T >= 0.93
    np.fill_diagonal(hit, False)
    shares = []
    whole = embedding_graph._probes
    monkeypatch.setattr(embedding_graph, "_probes", lambda *a: shares.append(whole(*a)) or shares[-1])
    rows = embedding_graph.near_duplicates(d).collect()
    got = np.array([q["n_links"] for q in sorted(rows, key=lambda q: q["vec_id"])])
    assert shares[0][1] < 0.6 and (got <= hit.sum(1)).all() and got.sum() >= 0.99 * hit.sum() and got.sum() % 2 == 0


def test_archives_of_other_names_and_in_subfolders(spark, tmp_path):
    import gzip

    (tmp_path / "a" / "b").mkdir(parents=True)
    for name, data in (("part-0", False), ("x.warc", False), ("a/y.warc.gz", True), ("a/b/z.gz", True), ("a/notes.txt", False)):
        one = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <{name}>\r\nContent-Length: 1\r\n\r\na\r\n\r\n".encode()
        (tmp_path / name).write_bytes(gzip.compress(one) if data else one)
    got = sorted(r["record_id"] for r in warc.read_archives(spark, f"file://{tmp_path}").collect())
    assert got == ["<a/b/z.gz>", "<a/y.warc.gz>", "<part-0>", "<x.warc>"]
