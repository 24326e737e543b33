"""Line frequency, fill-in-middle and whitening against brute force, and on rows that are easy to trip over."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import infill, linefreq, whitening

SPACE = "\x20\x09-\x0d"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# line frequency


def brute_lines(docs, line_docs, line_share, left_share):
    """Result of each (text, host) by plain counting."""
    words = lambda t: re.findall(f"[^{SPACE}]+", t or "")
    key = lambda line: " ".join(words(re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), line))))
    holders, texts = defaultdict(set), defaultdict(set)
    for text, host in docs:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if words(line):
                holders[host, key(line)].add(text or "")
    out = []
    for text, host in docs:
        own, lines = words(text), (text or "").split("\n")
        windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
        times = Counter(windows)
        covered = {p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + 8)}
        gone = [
            k for k, line in enumerate(lines)
            if words(line) and len(holders[host, key(line)]) >= max(line_docs, line_share * len(texts[host]))
        ]
        left = len(own) - sum(len(words(lines[k])) for k in gone)
        seen, repeats = set(), 0
        for line in lines:
            if words(line):
                repeats += line in seen
                seen.add(line)
        failed = len(own) < 20 or 100 * len(covered) > 30 * len(own)
        out.append(
            {
                "n_words": len(own), "word_chars": sum(map(len, own)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_dup_lines": repeats,
                "n_repeat_words": len(covered), "base_failed": failed, "removed": gone, "left_words": left,
                "kept": not failed and left >= left_share * len(own) and left >= 20,
            }
        )
    return out


def line_documents(seed=3, n=160):
    draw = random.Random(seed)
    furniture = ["Home | News | Über uns", "Copyright 2024 Example", "  read   MORE ", "Subscribe & save $5"]
    docs = []
    for i in range(n):
        lines = [" ".join(f"w{draw.randrange(60)}é" for _ in range(draw.randrange(1, 14))) for _ in range(draw.randrange(0, 6))]
        lines += [f.replace("2024", str(2000 + i)) for f in furniture if draw.random() < 0.4]
        if draw.random() < 0.2 and lines:
            lines += [lines[0]] * draw.randrange(1, 4)
        if draw.random() < 0.1:
            lines = ["", " \t", *lines, ""]
        draw.shuffle(lines)
        docs.append(("\n".join(lines), draw.choice(["a", "b", None])))
    return docs + docs[:15] + [(None, "a"), (None, None), ("", "b")]


@pytest.mark.parametrize("line_docs, line_share, left_share", [(4, 0.05, 0.5), (2, 0.2, 0.8), (1, 0.0, 0.1)])
def test_line_rules_equal_brute_force(spark, line_docs, line_share, left_share):
    docs = line_documents()
    table = spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(docs)], "doc_id long, text string, source string").repartition(5)
    found = {r["doc_id"]: r["quality"] for r in rows(linefreq.line_rules(table, line_docs=line_docs, line_share=line_share, left_share=left_share))}
    want = brute_lines(docs, line_docs, line_share, left_share)
    assert found == dict(enumerate(want))
    if line_docs == 4:
        assert any(w["kept"] and w["removed"] for w in want) and any(not w["kept"] and not w["base_failed"] for w in want)


def test_removed_lines_leave_the_text(spark):
    docs = [(i, f"Menu: start\nown text number {chr(97 + i)} " + " ".join(f"{chr(97 + i)}{k}" for k in range(40)) + "\n menu:  START \nend", "h") for i in range(6)]
    docs += [(10, docs[0][1], "elsewhere"), (11, "Menu: start\n" * 9, "h"), (12, "too few words", "h")]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["text"] for r in rows(linefreq.clean_documents(table))}
    assert sorted(kept) == [0, 1, 2, 3, 4, 5, 10]
    assert all(kept[i] == docs[i][1].split("\n")[1] for i in range(6)) and kept[10] == docs[0][1]


def test_copies_are_one_document(spark):
    page = "\n".join(" ".join(f"{line}x{k}" for k in range(10)) for line in "abc")
    table = spark.createDataFrame([(i, page, "h") for i in range(50)], "doc_id long, text string, source string")
    assert all(r["quality"]["kept"] and not r["quality"]["removed"] for r in rows(linefreq.line_rules(table)))


def test_all_lines_joined_by_shuffle(spark, monkeypatch):
    docs = line_documents(5)
    table = spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(docs)], "doc_id long, text string, source string")
    monkeypatch.setattr(linefreq, "BROADCAST_BYTES", 0)
    found = {r["doc_id"]: r["quality"] for r in rows(linefreq.line_rules(table))}
    assert found == dict(enumerate(brute_lines(docs, 4, 0.05, 0.5)))


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 12])
def test_repeated_words_equal_enumeration(width):
    draw = np.random.default_rng(width)
    texts = [draw.integers(0, 3, draw.integers(0, 60)).tolist() for _ in range(40)] + [[1] * 500, [], [2] * width]
    found = linefreq.repeated_words(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts]), width)
    for own, count in zip(texts, found):
        windows = [tuple(own[i : i + width]) for i in range(len(own) - width + 1)]
        times = Counter(windows)
        assert count == len({p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + width)})


def test_line_rules_of_odd_rows(spark, odd_documents):
    found = rows(linefreq.line_rules(odd_documents, into="score"))
    assert len(found) == 13 and all(set(r["score"]) >= {"kept", "left_words"} for r in found)
    assert [r["score"]["n_words"] for r in found if r["doc_id"] == 9] == [30_000]
    assert all(not r["score"]["kept"] for r in found if not (r["text"] or "").strip())
    kept = linefreq.clean_documents(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == sum(r["score"]["kept"] for r in found)
    none = odd_documents.limit(0)
    assert linefreq.line_rules(none).count() == 0 and linefreq.clean_documents(none).count() == 0


# fill-in-middle


def brute_infill(text, doc, seed):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    key = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(key[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return {"n": len(units), "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return {"n": len(units), "form": form, "prefix_chars": len(prefix), "middle_chars": len(middle), "output": output}


def infill_texts(seed=1, n=400):
    draw = random.Random(seed)
    pieces = ["word", "Ü", "日本", "😀", " ", "\n", "<", ">", "<S", "M>", "x" * 700, "é" * 300, "1", "\x00"]
    return ["".join(draw.choice(pieces) for _ in range(draw.randrange(0, 90))) for _ in range(n)] + ["a<P>b", "<M>", "x" * 5000, "é" * 5000, None, ""]


def test_infill_equals_brute_force_and_round_trips(spark):
    texts = infill_texts()
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = rows(infill.infill(table).withColumn("back", infill.restored("infill.output", "infill.form")))
    assert Counter(r["infill"]["form"] for r in found).keys() == {"plain", "psm", "spm"}
    for r in found:
        assert r["infill"] == brute_infill(texts[r["doc_id"]], r["doc_id"], 1)
        assert r["back"] == (texts[r["doc_id"]] or "")


@pytest.mark.parametrize("block", [1, 2, 7, 64, 4096])
def test_every_cut_of_the_tree(block):
    for text in infill_texts(block, 30):
        text = text or ""
        units, cuts = re.findall("[A-Za-z]+|[^A-Za-z]", text), infill.Cuts(text.encode(), block)
        assert cuts.n == len(units)
        for k in range(0, len(units) + 1, max(1, len(units) // 50)):
            before = "".join(units[:k])
            assert cuts.before(k) == (len(before.encode()), len(before))


def test_infill_of_odd_rows(spark, odd_documents):
    found = rows(infill.infill(odd_documents, into="score"))
    texts = {(r["doc_id"], r["text"]) for r in rows(odd_documents)}
    assert len(found) == 13
    for r in found:
        assert any(r["score"] == brute_infill(text, doc, 1) for doc, text in texts if doc == r["doc_id"])
    assert infill.infill(odd_documents.limit(0)).count() == 0


# whitening


def vectors(seed=0, n=300, dims=10):
    draw = np.random.default_rng(seed)
    return draw.normal(size=(n, dims)) @ draw.normal(size=(dims, dims)) * 0.3 + draw.normal(size=dims)


def check_whitening(found, usable, components=4):
    """Rows against numpy's eigenvectors of the same covariance; ``usable`` maps vec_id to its vector."""
    x = {k: np.floor(256 * np.asarray(v, np.float64)).astype(np.int64) for k, v in usable.items()}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, units = np.linalg.eigh(covariance)
    values, units = values[::-1], units[:, ::-1]
    count = min(components, int((values > 1e-9 * values[0]).sum()))
    assert Counter(r["vec_id"] for r in found) == {k: count for k in usable}
    signs = {}
    for r in found:
        k = r["component"] - 1
        own = x[r["vec_id"]]
        want = (own - sums / n) @ units[:, k] / math.sqrt(values[k])
        if abs(want) > 1e-3:
            sign = signs.setdefault(k, np.sign(want * r["whitened"]))
            assert r["whitened"] == pytest.approx(sign * want, rel=1e-8, abs=1e-8)
        assert r["n"] == n and r["deviation"] == sum((n * int(v) - int(s)) ** 2 for v, s in zip(own, sums))
        assert r["explained"] == pytest.approx(values[k] / covariance.trace(), rel=1e-9)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


def test_whitening_equals_eigenvectors(spark):
    data = [(i, v.tolist()) for i, v in enumerate(vectors())]
    data += [(1000 + i, data[7][1]) for i in range(200)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(6)
    found = rows(whitening.whiten(table, ["vec_id"]))
    check_whitening(found, {r["vec_id"]: r["embedding"] for r in rows(table)})


def test_whitening_of_few_directions(spark):
    draw = np.random.default_rng(4)
    data = [(i, [a, 2 * a, b, 0.5]) for i, (a, b) in enumerate((draw.integers(-50, 50, (80, 2)) / 4).tolist())]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    check_whitening(rows(whitening.whiten(table, ["vec_id"])), dict(data))
    same = table.filter("vec_id = 1").unionByName(table.filter("vec_id = 1"))
    assert whitening.whiten(same, ["vec_id"]).count() == 0


def test_whitening_of_odd_rows(spark):
    good = [(i, v.tolist(), 0, "x") for i, v in enumerate(vectors(2, 40, 3))]
    odd = [
        (100, None, 0, "x"), (101, [], 0, "x"), (102, [1.0, None, 2.0], 0, "x"), (103, [1.0, math.nan, 2.0], 0, "x"), (104, [math.inf, 0.0, 0.0], 0, "x"),
        (105, [1.0, 2.0], 0, "x"), (106, [1e300, 0.0, 0.0], None, None), (None, good[0][1], 0, "x"), (5, good[5][1], 0, "x"),
    ]
    schema = "vec_id long, embedding array<double>, component int, whitening string"
    table = spark.createDataFrame(good + odd, schema)
    found = rows(whitening.whiten(table, ["vec_id"]))
    assert {r["vec_id"] for r in found} == {*range(40), None} and len(found) == 3 * 42
    model = whitening.fit(table)
    assert model.n == 40 and sorted(r["vec_id"] for r in rows(model.apply(table)) if r["vec_id"] is not None) == sorted([*range(40), 5])
    assert whitening.whiten(table.limit(0), ["vec_id"]).count() == 0
    assert whitening.whiten(table.filter("vec_id = 100"), ["vec_id"]).count() == 0


def test_exact_deviations_of_wide_numbers():
    model = whitening.Whitening(1000, [5, -3 * 10**9], np.ones(2), np.eye(2), np.ones(2))
    x = np.array([[1, 2], [10**9, 10**6], [2**60, 0]])
    want = [sum((1000 * int(v) - s) ** 2 for v, s in zip(row, model.sums)) for row in x]
    assert model.deviations(x) == [w if w < 2**63 else None for w in want] and want[2] >= 2**63


@pytest.mark.parametrize("size, rank", [(1, 1), (6, 6), (9, 4), (30, 30), (31, 5)])
def test_factor_and_rotations(size, rank):
    draw = np.random.default_rng(size)
    half = draw.normal(size=(size, rank)) * np.logspace(0, -4, rank)
    matrix = half @ half.T
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape == (size, rank) and np.allclose(factor @ factor.T, matrix, atol=1e-12 * matrix.max())
    columns = whitening.one_sided_jacobi(factor)
    gram = columns.T @ columns
    assert np.abs(gram - np.diag(gram.diagonal())).max() < 1e-13 * gram.max()
    assert np.allclose(gram.diagonal(), np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-6)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
