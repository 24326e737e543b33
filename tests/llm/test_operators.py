"""Every operator against a brute-force version, and on rows that are easy to trip over."""

import base64
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import attribution, decontaminate, digest, jaccard, kdtree, langid, links, lm, mixing, toxicity, wrappers
from millrace.llm.common import materialise, numbered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sample(spark, sf="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


# toxicity


def toxic_corpus(spark, n=300):
    words = [f"plain{i}" for i in range(50)]
    docs = []
    for i in range(n):
        own = [words[(i * 7 + k) % 50] for k in range(12)]
        if i % 4 == 0:
            own[5] = ("vilemonger", "vilest,", "Vileness")[i % 3]
        docs.append((i, " ".join(own)))
    labels = [(i, 0, int(i % 4 == 0)) for i in range(0, n, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_tags_spans_and_documents(spark):
    docs, labels = toxic_corpus(spark)
    chain = toxicity.train(docs.filter("doc_id < 200"), labels)
    found = rows(toxicity.tag(docs, chain).filter("doc_id >= 200"))
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in found)
    for r in found:
        assert [r["text"][s["start"] : s["end"]].lower()[:4] for s in r["spans"]] == (["vile"] if r["doc_id"] % 4 == 0 else [])


def test_clean_text_does_not_raise_a_score(spark):
    docs, labels = toxic_corpus(spark)
    chain = toxicity.train(docs, labels)
    clean = " ".join(f"plain{i % 50}" for i in range(8))
    mixed = "plain3 vilemonger plain4"
    texts = [(0, clean), (1, " ".join([clean] * 5000)), (2, mixed), (3, mixed + " " + " ".join([clean] * 5000)), (4, "never seen words " * 3000)]
    found = {r["doc_id"]: r for r in rows(toxicity.tag(spark.createDataFrame(texts, "doc_id long, text string"), chain))}
    assert found[1]["score"] <= found[0]["score"] + 1e-6 and found[3]["score"] <= found[2]["score"] + 1e-6
    assert found[2]["score"] >= 0.5 and found[3]["score"] >= 0.5 and found[4]["score"] < 0.5
    assert all(r["spans"] for r in found.values() if r["score"] >= 0.5)


def test_slices_and_memory_do_not_change_scores(spark, monkeypatch):
    docs, labels = toxic_corpus(spark)
    chain = toxicity.train(docs, labels)
    whole = {r["doc_id"]: r["score"] for r in rows(toxicity.tag(docs, chain))}
    for name, value in (("TOGETHER_BYTES", 100), ("KNOWN_WORDS", 5)):
        monkeypatch.setattr(toxicity, name, value)
    batch = docs.repartition(1).toArrow().combine_chunks().to_batches()[0]
    batch = batch.set_column(1, "text", batch.column(1).cast("binary"))
    scores = [s for _, sizes, odds in toxicity._summaries(iter([batch]), chain, 1) for s in chain.scores(chain.summary(odds, sizes))]
    assert np.allclose(scores, [whole[i] for i in batch.column(0).to_pylist()])


def test_marginals_equal_enumeration():
    chain = toxicity.Chain(steps=np.array([[0.3, -1.2], [0.1, 0.9]]))
    emission, sizes = np.array([0.5, -0.7, 1.1, 2.0, -0.4]), np.array([3, 0, 2])
    odds = chain.marginals(emission, sizes)
    for start, size in ((0, 3), (3, 2)):
        part = np.zeros((size, 2))
        for code in range(2**size):
            y = [(code >> k) & 1 for k in range(size)]
            weight = math.exp(sum(emission[start + k] * y[k] for k in range(size)) + sum(chain.steps[a, b] for a, b in zip(y, y[1:])))
            for k in range(size):
                part[k, y[k]] += weight
        assert np.allclose(odds[start : start + size], part[:, 1] / part[:, 0])


def test_fitted_chain_is_at_the_maximum_of_the_enumerated_likelihood():
    rng = np.random.default_rng(5)
    lengths = [1, 2, 3, 4, 5] * 8
    slots = [rng.integers(1, 7, (n, toxicity.SLOTS)) for n in lengths]
    # Marks follow the one before and, loosely, one slot, so that no weight runs away.
    marks = []
    for own in slots:
        y = []
        for k in range(len(own)):
            lean = 0.2 + 0.3 * (own[k, 0] < 3) + 0.3 * (y[-1] if y else 0)
            y.append(int(rng.random() < lean))
        marks.append(np.array(y, float))
    decay = 1e-3

    def likelihood(x):
        weights, bias, steps = x[:7], x[7], x[8:].reshape(2, 2)

        def score(own, y):
            emission = weights[own].sum(axis=1) + bias
            return sum(e for e, m in zip(emission, y) if m) + sum(steps[a, b] for a, b in zip(y, y[1:]))

        fits = [
            score(own, m.astype(int)) - np.logaddexp.reduce([score(own, y) for y in itertools.product((0, 1), repeat=len(own))])
            for own, m in zip(slots, marks)
        ]
        return np.mean(fits) - decay / 2 * (weights**2).sum()

    def slope(x):
        near = 1e-5 * np.eye(len(x))
        return np.array([(likelihood(x + d) - likelihood(x - d)) / 2e-5 for d in near])[1:]

    chain = toxicity.fit_chain(slots, marks, rounds=1500, decay=decay)
    fitted = np.concatenate([chain.weights[:7], [chain.bias], chain.steps.ravel()])
    start = np.zeros(12)
    assert np.abs(slope(start)).max() > 0.05 and np.abs(slope(fitted)).max() < 1e-3
    assert likelihood(fitted) > likelihood(start)
    # Without its steps the chain fits worse: neighbours matter.
    assert likelihood(np.concatenate([fitted[:8], np.zeros(4)])) < likelihood(fitted)


def test_toxicity_of_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (2, 1, 1), (None, 0, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(odd_documents, labels)
    found = rows(toxicity.tag(odd_documents, chain, "own_score"))
    assert len(found) == 13 and all(0 <= r["own_score"] <= 1 for r in found)
    none = toxicity.train(odd_documents, labels.limit(0))
    assert all(r["own"] < 0.5 for r in rows(toxicity.tag(odd_documents, none, "own", None)))
    assert toxicity.tag(empty(spark), none).count() == 0


# n-gram Jaccard join


def brute_components(docs, width, similarity):
    sets = []
    for _, text in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append({tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * both >= similarity * either:
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [docs[i][0] for i in members if docs[i][0] is not None]
        for i in members:
            out[i] = min(ids) if ids else None
    return Counter((docs[i][0], len(sets[i]), out[i]) for i in range(len(docs)))


@pytest.mark.parametrize("width, go", [(4, 1 << 19), (5, 64), (1, 7)])
def test_shingle_sets_equal_enumeration(monkeypatch, width, go):
    draw = np.random.default_rng(width)
    alphabet = [b"ab", b"AB", b"\xc3\xa9", b"c" * 90, b"d"]
    texts = [b"".join(alphabet[draw.integers(5)] + b" \t\n"[(k := draw.integers(3)) : k + 1 + draw.integers(2)] for _ in range(draw.integers(0, 40))) for _ in range(60)]
    monkeypatch.setattr(jaccard, "GO_BYTES", go)
    jaccard._powers.cache_clear()
    sets = list(jaccard.shingles([None, b"", b" \n ", *texts], width))
    assert [len(s) for s in sets[:3]] == [0, 0, 0]
    seen = {}
    for text, found in zip(texts, sets[3:]):
        words = text.lower().split()
        want = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
        assert len(found) == len(want) and (np.diff(found.astype(object)) > 0).all()
        assert seen.setdefault(frozenset(want), found.tolist()) == found.tolist()
    assert len({tuple(v) for v in seen.values()}) == len(seen)


def copies(seed, n, length, edits):
    rng = np.random.default_rng(seed)
    base = [f"b{seed}x{rng.integers(0, 10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        own = list(base)
        for at in rng.choice(length, edits, replace=False):
            own[at] = f"e{rng.integers(0, 10**6)}"
        out.append(" ".join(own[: length - int(rng.integers(0, 3))]))
    return out


@pytest.mark.parametrize("width, similarity", [(4, 85), (5, 80)])
def test_jaccard_join_equals_brute_force(spark, width, similarity):
    texts = []
    for seed, length in enumerate((6, 7, 9, 11, 14, 20, 30, 45, 80, 150, 300)):
        for edits in (0, 1, 2, 3):
            texts += copies(100 * seed + edits, 5, length, min(edits, length))
    passage = " ".join(f"shared{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"own{k}w{i}" for i in range(30 + k)) for k in range(90)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = jaccard.near_duplicates(df, width, similarity).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, found)) == brute_components(docs, width, similarity)


def test_large_buckets_are_joined_whole(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LARGE", 2)
    monkeypatch.setattr(jaccard, "TILE", 10)
    texts = [t for edits in (2, 4, 6, 8) for t in copies(7, 12, 90, edits)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = jaccard.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, found)) == brute_components(docs, 4, 85)


def test_jaccard_of_odd_rows(spark, odd_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    found = jaccard.near_duplicates(odd_documents).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, found)) == brute_components(docs, 4, 85)
    kept = rows(jaccard.one_of_each(odd_documents))
    assert kept and set(kept[0]) == set(odd_documents.columns)
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 0, 1, 4, 5, 6, 7, 8, 9, 10]
    assert jaccard.near_duplicates(empty(spark)).count() == 0
    assert jaccard.one_of_each(empty(spark)).count() == 0


def test_parity_bound():
    rng = np.random.default_rng(3)
    for n in (8, 30, 200):
        found = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        other = np.unique(np.append(found[1:], rng.integers(0, 2**64, 1, dtype=np.uint64)))
        a, b = set(jaccard.keys_of(found).tolist()), set(jaccard.keys_of(other).tolist())
        assert a & b or 100 * (n - 1) < 85 * (n + 1)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102)]
    found = links.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["comp"] for r in rows(found)} == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}


# fingerprints


def test_fingerprints_equal_brute_force(spark, odd_documents):
    for docs, blocks in ((sample(spark), 7), (odd_documents.filter("doc_id is not null").dropDuplicates(["doc_id"]), 3)):
        found = {r["doc_id"]: r for r in rows(digest.fingerprints(docs, blocks))}
        ordered = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
        assert len(found) == len(ordered)
        for (own, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
            cut = len(text) // 3
            edited = (text[: len(text) - cut] + following[:cut]).encode()
            codes = digest.quartile_codes([text.encode(), edited, following.encode()])
            r = found[own]
            assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited).hexdigest()
            assert [r["fingerprint"], r["edited_fingerprint"]] == digest.as_hex(codes[:2])
            assert r["near_edited"] == digest.likeness(codes[:1], codes[1:2])[0] and r["near_next"] == digest.likeness(codes[:1], codes[2:])[0]


def test_fingerprints_of_odd_rows(spark, odd_documents):
    found = rows(digest.fingerprints(odd_documents, 3))
    assert len(found) == 13
    assert len({r["fingerprint"] for r in found if r["doc_id"] in (1, 2)}) == 1
    assert digest.fingerprints(empty(spark)).count() == 0
    nulls = odd_documents.withColumn("doc_id", F.lit(None).cast("long"))
    assert digest.fingerprints(nulls, 3).count() == 13


# decontamination


def brute_hits(text, items, window=13):
    words = decontaminate.words_of(text.encode() if text else None)
    hit, names = set(), set()
    for name, item in items:
        own = decontaminate.words_of(item.encode() if item else None)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            part = own[k : k + window]
            for at in range(len(words) - len(part) + 1):
                if words[at : at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    names.add(str(name))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 600])
def test_decontamination_equals_brute_force(spark, odd_documents, broadcast_bytes):
    items = [(1, " ".join(f"w{i}" for i in range(20, 45))), (2, "w1 w2"), (3, None), (4, ""), (2, "w1 w2"), (5, "zz " * 20), (6, "wort"), (7, "long5 long6 long7")]
    items += [(20 + k, " ".join(f"w{i}" for i in range(k, k + 13))) for k in range(6)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_occurrences(odd_documents, benchmark, into="hits", broadcast_bytes=broadcast_bytes)
    for r in rows(found):
        got = r["hits"]
        assert (got["n_words"], got["n_hit"], got["items"]) == brute_hits(r["text"], items)
    kept = decontaminate.clean_documents(odd_documents, benchmark)
    assert kept.columns == odd_documents.columns and kept.filter("doc_id in (1, 2, 3)").count() == 0
    assert kept.filter("doc_id = 8").count() == 1


def test_decontamination_of_empty_tables(spark, odd_documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean_documents(odd_documents, none).count() == 13
    assert decontaminate.clean_documents(empty(spark), none).count() == 0


# HTML extraction


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header class="masthead">Site</header>
<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav>{notice}<{main}><h1>Title {n}</h1>
<p>First &amp; <b>bold</b>&nbsp;text {n}.<p>Second
 line {n}.</p>{more}<aside>More stories</aside></{main}><section id="comments"><p>Nice! {n}</p></section>
<form><input><p>Sign up</p></form><footer>&copy; Site</footer></body></html>"""


def pages(main):
    out = []
    for n in range(12):
        notice = '<div class="cookie-notice">We use cookies</div>' if n % 2 else ""
        more = "<ul><li>one</li><li>two</li></ul>" if n % 3 == 0 else ""
        out.append((n, f"https://{main.split()[0]}.example.org/{n}", PAGE.format(n=n, main=main, notice=notice, more=more).replace(f"</{main}>", f"</{main.split()[0]}>")))
    return out


def test_extraction_by_wrappers(spark):
    table = spark.createDataFrame(pages("article") + [(100 + n, u, h) for n, u, h in pages('div class="post-body"')], "page_id long, url string, html string")
    for r in rows(wrappers.main_text(table, ["page_id"])):
        n = r["page_id"] % 100
        assert r["text"] == f"Title {n}\nFirst & bold text {n}.\nSecond line {n}." + ("\none\ntwo" if n % 3 == 0 else "")


def test_constant_text_of_a_plain_host_is_template(spark):
    rows_ = [(n, "http://plain.example/", f"<html><body><table><tr><td>Welcome to us</td></tr></table><div><p>Story {n} goes on</p></div><p>Made here</p></body></html>") for n in range(8)]
    table = spark.createDataFrame(rows_, "page_id long, url string, html string")
    assert {r["text"] for r in rows(wrappers.main_text(table, ["page_id"]))} == {f"Story {n} goes on" for n in range(8)}


def test_shared_text_of_articles_and_copies_is_kept(spark):
    shared = "<h2>Summary</h2><ul><li>one</li><li>two</li></ul><p>Until next time</p>"
    own = [(n, "http://a.example/", f"<body><p>Site</p><article><h1>Title {n}</h1><p>Story {n}</p>{shared}</article></body>") for n in range(8)]
    # Copies of one page, and other pages, of a host without a sign of the article.
    copies = [(100 + n, "http://b.example/", f"<body><h1>Title</h1><p>Story</p>{shared}</body>") for n in range(6)]
    others = [(200 + n, "http://b.example/", f"<body><h1>Other {n}</h1><p>Tale {n}</p></body>") for n in range(3)]
    table = spark.createDataFrame(own + copies + others, "page_id long, url string, html string").repartition(3)
    ends = "\nSummary\none\ntwo\nUntil next time"
    for r in rows(wrappers.main_text(table, ["page_id"])):
        n = r["page_id"]
        assert r["text"] == (f"Title {n}\nStory {n}{ends}" if n < 100 else f"Title\nStory{ends}" if n < 200 else f"Other {n - 200}\nTale {n - 200}")


def text_of(source, others=()):
    """Text of a page by the wrapper of the page and ``others``."""
    whole = None
    for one in (source, *others):
        whole = wrappers.generalise(whole, wrappers.observe(wrappers.read_page(one)))
    return wrappers.extract(whole, wrappers.read_page(source), wrappers.article_slots(whole))


def test_ids_of_headings_and_paragraphs_tell_no_aside():
    assert text_of('<article><h1>T</h1><p>one</p><h2 id="related-work">Related work</h2><p>two</p><p id="social-effects">three</p></article>') == "T\none\nRelated work\ntwo\nthree"
    assert text_of('<article id="history-of-advertising"><h1>T</h1><p>one</p></article>') == "T\none"
    assert text_of('<body class="has-sidebar"><article><section id="related-work"><h2 class="header">R</h2><p>one</p></section></article></body>') == "R\none"
    assert text_of('<article><div class="post-header"><h1>T</h1><p>by X</p></div><p>one</p></article>') == "T\none"
    for aside in ('<div id="comments">no</div>', '<div id="social-share-2">no</div>', '<p class="advert">no</p>', '<div class="cookie-notice"><p>no</p></div>', "<aside>no</aside>"):
        assert text_of(f"<article><p>one</p>{aside}</article>") == "one"


def test_the_wrapper_decides_beside_an_article():
    page = "<main><p>{0}</p><article><p>teaser {1}</p></article><div><a href=x>More of it</a></div></main>"
    assert text_of(page.format("intro", 0)) == "intro\nteaser 0"
    others = [page.format("Welcome", n) for n in range(1, 7)]
    assert text_of(page.format("Welcome", 0), others) == "teaser 0"
    assert text_of(page.format("intro", 0), others) == "intro\nteaser 0"


def test_wrapper_expression_has_optional_and_repeated_groups():
    whole = None
    for _, _, source in pages("article")[:4]:
        whole = wrappers.generalise(whole, wrappers.observe(wrappers.read_page(source)))
    text = wrappers.expression(whole)
    assert ")+" in text and ")?" in text and "#" in text
    assert wrappers.expression(wrappers.load(wrappers.dump(whole))) == text


def test_extraction_of_odd_pages(spark):
    odd = [
        (1, "http://x.example/", None), (2, None, ""), (3, "not a url", "plain text &lt; &amp"), (4, "http://x.example/", "<article><p>cut &am"),
        (5, "http://x.example/", "<article><p>a < b</p><p>c<"), (6, "http://x.example/", "</p></div><<<>>" * 50),
        (7, "http://x.example/", "<article>" + "<p>word</p>" * 5000 + "</article>"), (7, "http://x.example/", "<article>" + "<p>word</p>" * 5000 + "</article>"),
    ]
    table = spark.createDataFrame([r + ("t",) for r in odd], "page_id long, url string, html string, text string")
    found = defaultdict(list)
    for r in rows(wrappers.main_text(table, ["page_id", "url"])):
        found[r["page_id"]].append(r["text"])
    assert found[1] == [""] and found[2] == [""] and found[3] == ["plain text < &"] and found[4] == ["cut &am"]
    assert found[5][0].startswith("a < b\nc") and found[7] == ["\n".join(["word"] * 5000)] * 2
    assert wrappers.main_text(table.limit(0), ["page_id"]).count() == 0


# language identification


def test_language_identification(spark):
    docs = sample(spark, "/root/testdata/sf0.01").filter("lang is not null")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = langid.train(docs.filter(~held))
    found = rows(langid.predict(docs.filter(held), model, ["doc_id", "lang"]))
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found)


def test_code_lengths_equal_a_plain_context_tree(spark):
    docs = [("x", "abab abac"), ("y", "abba b")]
    model = langid.train(spark.createDataFrame(docs, "lang string, text string"), 0.0)
    trees = {}
    for lang, text in docs:
        symbols = [0] * langid.ORDER + [int(langid.SYMBOL[b]) for b in text.encode()]
        tree = trees.setdefault(lang, defaultdict(Counter))
        for at in range(langid.ORDER, len(symbols)):
            for order in range(langid.ORDER + 1):
                tree[tuple(symbols[at - order : at])][symbols[at]] += 1
    for text in ("abac", "bbab!", "zzz"):
        symbols = [0] * langid.ORDER + [int(langid.SYMBOL[b]) for b in text.encode()]
        for number, lang in enumerate(model.langs):
            bits = 0.0
            for at in range(langid.ORDER, len(symbols)):
                for order in range(langid.ORDER, -1, -1):
                    seen = trees[lang].get(tuple(symbols[at - order : at]))
                    if not seen:
                        continue
                    whole = sum(seen.values()) + len(seen)
                    if symbols[at] in seen:
                        bits -= math.log(seen[symbols[at]] / whole)
                        break
                    bits -= math.log(len(seen) / whole)
                else:
                    bits += math.log(langid.K)
            assert model.lengths([text.encode()])[0, number] == pytest.approx(bits, rel=1e-5)


def test_rare_contexts_stay_in_spark(spark):
    """Only runs whose context has the share reach the driver; the shorter orders are whole."""
    docs = spark.createDataFrame([("x", "abab " * 200 + "qzjk wvxp"), ("y", "abba " * 200)], "lang string, text string")
    counts = [r.asDict() for r in langid.count_contexts(docs).collect()]
    total = sum(r["n"] for r in counts)
    found = langid.count_orders(langid.count_contexts(docs), 0.01)
    for order, part in enumerate(found):
        want, context = Counter(), Counter()
        for r in counts:
            want[r["lang"], r["code"] % langid.K ** (order + 1)] += r["n"]
            context[r["code"] // langid.K] += r["n"]
        if order == langid.ORDER:
            want = {k: n for k, n in want.items() if context[k[1] // langid.K] >= 0.01 * total}
            assert len(want) < len(counts)
        assert {(r["lang"], r["code"]): r["n"] for r in part.collect()} == want


def test_language_of_odd_rows(spark, odd_documents):
    model = langid.train(odd_documents)
    found = rows(langid.predict(odd_documents, model, ["doc_id", "text"]))
    assert len(found) == 13
    for r in found:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered) and 0 <= r["score"] <= 1
    none = langid.train(empty(spark))
    assert {r["lang_pred"] for r in rows(langid.predict(odd_documents, none, ["doc_id"]))} == {"und"}
    assert langid.predict(empty(spark), model, ["doc_id"]).count() == 0


# token counts


def test_tokens_are_attributed_by_offsets(spark, odd_documents):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, attribution.vocabulary(spark).splitlines())}
    encoding = tiktoken.Encoding("t", pat_str=attribution.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = defaultdict(list)
    for r in rows(attribution.section_tokens(odd_documents.withColumn("n", F.xxhash64("doc_id", "text")), ["n", "doc_id"])):
        found[r["doc_id"]].append(r)
    for r in odd_documents.filter("doc_id is not null").dropDuplicates(["doc_id"]).collect():
        text, own = r["text"] or "", sorted(found[r["doc_id"]], key=lambda x: x["section"])
        own = own[:: 2 if r["doc_id"] == 3 else 1]
        assert "".join(text[s["start"] : s["end"]] for s in own) == text
        assert sum(s["tokens"] for s in own) == len(encoding.encode_ordinary(text))
        offsets = encoding.decode_with_offsets(encoding.encode_ordinary(text))[1]
        assert [s["tokens"] for s in own] == [sum(s["start"] <= o < s["end"] for o in offsets) for s in own]
    assert attribution.section_tokens(empty(spark), ["doc_id"]).count() == 0


def test_boundary_rules():
    starts, ends, borders = np.array([0, 2, 5]), np.array([2, 5, 9]), np.array([3, 3, 9])
    assert attribution.attribute(starts, ends, borders, "start")[0].tolist() == [2, 0, 1]
    assert attribution.attribute(starts, ends, borders, "most")[0].tolist() == [1, 0, 2]
    split = attribution.attribute(starts, ends, borders, "split")[0]
    assert split.tolist() == pytest.approx([1 + 1 / 3, 0, 1 + 2 / 3])


def test_given_sections(spark):
    docs = spark.createDataFrame([(1, "Äb cd ef", [2, 5, 8]), (2, None, [1]), (3, "xy", []), (4, "xy", None)], "doc_id long, text string, ends array<int>")
    found = rows(attribution.section_tokens(docs, ["doc_id"], sections="ends", rule="split").orderBy("doc_id", "section"))
    assert [(r["doc_id"], r["start"], r["end"]) for r in found] == [(1, 0, 2), (1, 2, 5), (1, 5, 8), (2, 0, 0), (3, 0, 2), (4, 0, 2)]


# mixing


def plain_targets(sizes, share=1.5, most=2):
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, left, open_ = {}, share * sum(sizes.values()), set(sizes)
    while True:
        level = left / (sum(weights[s] for s in open_) or 1)
        full = {s for s in open_ if most * sizes[s] < level * weights[s]}
        if not full:
            return target | {s: level * weights[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full


@pytest.mark.parametrize("block_words", [5, 1024])
def test_mixing_reaches_targets(spark, odd_documents, block_words):
    for docs in (sample(spark), odd_documents):
        found = rows(mixing.mix(docs, block_words))
        source = {r["doc_id"]: r["source"] for r in docs.collect()}
        sizes, taken, target = defaultdict(int), defaultdict(int), {}
        for r in found:
            sizes[source[r["doc_id"]]] += r["size"]
            taken[source[r["doc_id"]]] += r["taken"]
            target[source[r["doc_id"]]] = r["target"]
            assert 0 <= r["taken"] <= 2 * r["size"]
        if docs is odd_documents:
            assert len(found) == 13
            continue
        assert target == pytest.approx(plain_targets(sizes))
        assert all(taken[s] == math.floor(target[s]) for s in sizes)


def test_schedule_follows_the_weights(spark):
    rows_ = materialise(mixing.rows_of(sample(spark)), "t")
    sources = materialise(mixing.targets(rows_), "t")
    slots = rows(mixing.schedule(sources, 64).orderBy("place"))
    n = Counter(r["ord"] for r in slots)
    seen = Counter()
    for at, r in enumerate(slots, 1):
        seen[r["ord"]] += 1
        assert abs(seen[r["ord"]] - at * n[r["ord"]] / len(slots)) < 12


def test_mixed_documents(spark, odd_documents):
    found = mixing.mixed_documents(odd_documents)
    assert found.columns == odd_documents.columns
    assert mixing.mixed_documents(empty(spark)).count() == 0
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, mixing.mixed_documents(odd_documents).collect()))


# language-model scoring


def test_lm_scores(spark, odd_documents):
    for docs in (sample(spark), odd_documents):
        held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(True))
        found = rows(lm.train_and_score(docs.withColumn("held", held), ~F.col("held"), ["doc_id", "text", "held"]))
        tokens = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b" "]
        counts = Counter(w for r in found if not r["held"] for w in tokens(r["text"]))
        total, mass = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
        for r in found:
            own = tokens(r["text"])
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), total)
            assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.1) / mass) for w in own), rel=1e-9)
            assert math.isfinite(r["score"])
        assert sum(r["score"] for r in found) >= sum(r["base_score"] for r in found)


def automaton_of(texts):
    """The automaton of a batch that is trained on its own texts."""
    tokens = [[*t.split(), " "] for t in texts]
    words = sorted({w for own in tokens for w in own})
    ids = np.array([words.index(w) for own in tokens for w in own], np.int32)
    batch = lm.Batch({
        "sizes": np.array([len(own) for own in tokens]).tobytes(), "n_tokens": len(ids), "ids": lm._pack(ids),
        "words": lm._hashes([w.encode() for w in words]).tobytes(), "trained": np.ones(len(texts), np.bool_).tobytes(),
    })
    found = {s: batch.grams(s) for s in (1, 2, 3)}
    n = {s: np.bincount(rank, minlength=len(keys)) for s, (keys, _, rank) in found.items()}
    arcs = {s: np.zeros(len(found[s][0]), np.int64) for s in (1, 2, 3)}
    for s in (2, 3):
        _, at, rank = found[s]
        for r in range(len(n[s])):
            end = at[np.flatnonzero(rank == r)[0]]
            arcs[s - 1][found[s - 1][2][np.flatnonzero(found[s - 1][1] == end - 1)[0]]] += 1
    return batch, lm.build(batch, n, arcs, len(ids) + lm.ADD * (len(words) + 1))


def test_states_of_the_automaton_sum_to_one():
    batch, auto = automaton_of(["a b a b c a b a c b a a b", "b a b a b c c a", "a b c a b c a b", ""])
    tokens = len(set(batch.word.tolist()))
    root = 10 ** auto.logp[:tokens]
    assert root.sum() + 0.1 / (len(batch.word) + 0.1 * (tokens + 1)) == pytest.approx(1.0)
    # Every occurring arc of a state, and what its failure arc leaves to the words without one.
    leaving = defaultdict(set)
    states = {}
    for text, begin in enumerate(np.cumsum([0, *batch.sizes[:-1]])):
        for at in range(begin + 1, begin + batch.sizes[text]):
            for depth in (1, 2):
                if at - depth >= begin:
                    state = states.setdefault(tuple(batch.word[at - depth : at]), auto.goal[auto.arc_at[depth - 1, at - 1]])
                    assert auto.depth[state] == depth and state == auto.goal[auto.arc_at[depth - 1, at - 1]]
                    assert auto.arc_at[depth, at] >= 0
                    leaving[state].add((auto.arc_at[depth, at], auto.arc_at[depth - 1, at]))
    assert len(leaving) > 8
    for state, arcs in leaving.items():
        taken = sum(10 ** auto.logp[a] for a, _ in arcs)
        rest = 1 - sum(10 ** auto.logp[b] for _, b in arcs)
        assert taken + 10 ** auto.weight[state] * rest == pytest.approx(1.0)
        assert auto.depth[auto.fail[state]] == auto.depth[state] - 1


def test_texts_walk_alike_alone_and_side_by_side():
    rng = np.random.default_rng(3)
    batch, auto = automaton_of([" ".join(f"w{k}" for k in rng.integers(0, 9, n)) for n in [0, 1, 2, 400, 3, 3, 50, 0, 7]])
    # Arcs that are not there, so that failure arcs are passed on the way.
    auto.arc_at[1:][rng.random(auto.arc_at[1:].shape) < 0.3] = -1
    alone = auto.walk(batch.sizes, 10**9)
    for together in (1, 2, 4, 9):
        assert auto.walk(batch.sizes, together).tolist() == alone.tolist()


def test_a_walk_carries_its_state():
    """Without failure weights a walk costs less, and another start state costs something else."""
    batch, auto = automaton_of(["a b c a b d", "b c c", "d a c b"])
    whole = auto.walk(batch.sizes)
    single = auto.walk(np.ones(len(batch.word), np.int64))
    assert single == pytest.approx(auto.logp[auto.arc_at[0]])
    assert not np.allclose(np.add.reduceat(single, np.cumsum([0, *batch.sizes[:-1]])), whole)


def test_lm_equals_backoff_over_all_ngrams(spark, monkeypatch):
    """Rare pairs and triples count at any size: 60,000 other tokens make them less than 2e-5 of all."""
    texts = [f"rare{i % 40} pair{i % 7} word{i % 3} rare{i % 5}" for i in range(60)] + [" ".join(f"f{k * i % 97}" for k in range(200)) for i in range(300)]
    held = ["rare1 pair1 word1 new rare1 pair1", "f1 f2 rare3 pair3", "", "new"]
    docs = spark.createDataFrame([(i, t, i < 360) for i, t in enumerate(texts + held)], "doc_id long, text string, trained boolean").repartition(5)
    monkeypatch.setattr(lm, "PART_LEAST", 5_000, raising=False)
    tokens = {i: [*t.split(), " "] for i, t in enumerate(texts + held)}
    grams = [Counter(tuple(own[k : k + size]) for i, own in tokens.items() if i < 360 for k in range(len(own) - size + 1)) for size in (1, 2, 3)]
    arcs = Counter(g[:-1] for size in (1, 2) for g in grams[size])
    total = sum(grams[0].values())

    def p(context, word):
        if not context:
            return (grams[0][(word,)] + 0.1) / (total + 0.1 * (len(grams[0]) + 1))
        n = grams[len(context) - 1][context]
        if not n:
            return p(context[1:], word)
        return max(grams[len(context)][(*context, word)] - 0.75, 0) / n + 0.75 * arcs[context] / n * p(context[1:], word)

    found = rows(lm.train_and_score(docs, F.col("trained"), ["doc_id"]))
    assert len(found) == 364
    for r in found:
        own = tokens[r["doc_id"]]
        assert r["score"] == pytest.approx(sum(math.log10(p(tuple(own[max(0, k - 2) : k]), w)) for k, w in enumerate(own)), rel=1e-9)


def test_lm_without_training_rows(spark, odd_documents):
    found = rows(lm.train_and_score(odd_documents, F.lit(False), ["doc_id"]))
    assert len(found) == 13 and all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in found)
    assert lm.train_and_score(empty(spark), F.lit(True), ["doc_id"]).count() == 0


# sharding


def shards_of(docs, **how):
    point = kdtree.text_point("text")
    table = materialise(docs.select("doc_id", *[c.alias(n) for n, c in point.items()]), "t")
    tree = kdtree.fit_tree(materialise(kdtree.groups(table), "t"), kdtree.TEXT_DIMS, **how)
    return table.select("doc_id", "key", "w", tree.shard({d: F.col(d) for d in kdtree.TEXT_DIMS}, F.col("key")).alias("shard")), tree


def test_shards_are_even_and_keep_groups(spark):
    docs = sample(spark, "/root/testdata/sf0.01")
    hot = spark.range(200).select((F.col("id") + 10_000).alias("doc_id"), F.lit("same text " * 50).alias("text"))
    placed, _ = shards_of(docs.select("doc_id", "text").union(hot), shards=16)
    found = rows(placed)
    loads, homes = Counter(), defaultdict(set)
    for r in found:
        loads[r["shard"]] += r["w"]
        homes[r["key"]].add(r["shard"])
    heaviest = max(Counter({k: sum(r["w"] for r in found if r["key"] == k) for k in [r["key"] for r in found[:1]]}).values())
    assert set(loads) == set(range(16)) and all(len(h) == 1 for h in homes.values())
    assert max(loads.values()) - min(loads.values()) < 0.05 * sum(loads.values()) / 16 + heaviest


def test_every_cut_is_the_best_of_all_cuts(spark):
    rng = np.random.default_rng(2)
    made = [(int(rng.integers(-(2**63), 2**63 - 1)), int(rng.integers(1, 6)), float(rng.integers(0, 9)), float(rng.normal())) for _ in range(3000)]
    points = materialise(spark.createDataFrame(made, "key long, w long, a double, b double"), "points")
    tree = kdtree.fit_tree(points, ["a", "b"], shards=4)
    found = rows(points.withColumn("shard", tree.shard({"a": F.col("a"), "b": F.col("b")}, F.col("key"))))
    assert len(found) == 3000 and not tree.large
    reach = lambda part, dim: max(r[dim] for r in part) - min(r[dim] for r in part)
    spread = {dim: reach(found, dim) for dim in ("a", "b")}
    met = set()

    def check(part, shards):
        if len(shards) == 1:
            assert {r["shard"] for r in part} == set(shards)
            return
        dim = max(("a", "b"), key=lambda d: reach(part, d) / spread[d])
        met.add(dim)
        least, width = min(r[dim] for r in part), reach(part, dim)

        def place(r):
            at = math.floor(min(kdtree.BINS - 1, (r[dim] - least) / width * kdtree.BINS))
            return at, (r["key"] % 2**64) >> (64 - 2 * kdtree.KEY_BITS)

        low = [r for r in part if r["shard"] in shards[: len(shards) // 2]]
        high = [r for r in part if r["shard"] in shards[len(shards) // 2 :]]
        assert len(low) + len(high) == len(part) and max(map(place, low)) < min(map(place, high))
        weights = Counter()
        for r in part:
            weights[place(r)] += r["w"]
        half = sum(weights.values()) / 2
        every = np.cumsum([0, *(weights[k] for k in sorted(weights))])
        assert abs(sum(r["w"] for r in low) - half) == np.abs(every - half).min()
        check(low, shards[: len(shards) // 2])
        check(high, shards[len(shards) // 2 :])

    check(found, [0, 1, 2, 3])
    assert met == {"a", "b"}


def test_a_group_above_a_share_gets_a_shard_of_its_own(spark):
    hot = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("hot text " * 20).alias("text"))
    cold = spark.range(300).select((F.col("id") + 1000).alias("doc_id"), F.concat(F.lit("cold "), F.repeat(F.md5(F.col("id").cast("string")), 3)).alias("text"))
    placed, _ = shards_of(hot.union(cold), shards=4)
    loads = {r["shard"]: (r["n"], r["kinds"]) for r in rows(placed.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("key").alias("kinds")))}
    assert len(loads) == 4 and sorted(loads.values())[-1] == (500, 1)
    assert all(abs(n - 100) <= 2 for n, kinds in loads.values() if kinds > 1)


def test_shards_by_target_bytes_and_odd_rows(spark, odd_documents):
    placed, tree = shards_of(odd_documents, target_bytes=100_000)
    assert tree.shards > 1 and all(0 <= r["shard"] < tree.shards for r in rows(placed))
    assert shards_of(empty(spark), shards=16)[0].count() == 0


def test_numbers_are_gapless(spark):
    table = materialise(spark.range(5000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") > 50, F.col("id")).alias("id")), "t")
    found = defaultdict(list)
    for r in rows(numbered(table, "g", ["id"], "slot", 5000, 100)):
        found[r["g"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in found.values())
    assert zlib.crc32(b"") == 0
