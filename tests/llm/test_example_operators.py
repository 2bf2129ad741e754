"""Fill-in-the-middle, the quality classifier and importance resampling against brute force, with the odd cases of each."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from agrimill.llm import fill_middle, importance, nb_svm
from agrimill.llm.frames import Framed, pack
from agrimill.llm.prefix_crc import Running, shift

DOC = "doc_id long, text string, _text string, form string, n int, weight int, rank string, _tie int, bucket int, h int"


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows):
        """Documents with columns whose names the operators use inside."""
        return spark.createDataFrame([(i, t, "x", "f", 1, 2, "r", 3, 4, 5) for i, t in rows], DOC)

    return make


def hashes(seed, key):
    d = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(d[8 * i:8 * i + 8], 16) for i in range(4)]


def brute_example(key, text):
    text = text or ""
    h, n = hashes(1, key), len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def odd_texts():
    r = random.Random(5)
    alphabet = "ab é漢\U0001f600\n<SPM>"
    rows = [(i, "".join(r.choice(alphabet) for _ in range(r.choice([1, 2, 30, 900])))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "has <M> in it"), (None, "no key"), (203, "é" * 70_001), (204, "same"), (204, "same"), (205, "<" * 40), (206, "<S")]
    return rows


def test_examples_equal_brute_force(frame):
    rows = odd_texts()
    examples = fill_middle.fill_middle(frame(rows), units=64)
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["text"]) for r in fill_middle.texts(examples).collect()), key=repr)
    assert got == sorted(((k, *brute_example(k, t)) for k, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = sorted(((r["doc_id"], r["text"]) for r in fill_middle.texts(examples, restore=True).collect()), key=repr)
    assert back == sorted(((k, t or "") for k, t in rows), key=repr)
    for r in fill_middle.digests(examples).collect():
        assert len(r["output_sha256"]) == 64
    sums = sorted(((r["doc_id"], r["output_sha256"], r["restored_sha256"]) for r in fill_middle.digests(examples).collect()), key=repr)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sums == sorted(((k, sha(brute_example(k, t)[4]), sha(t or "")) for k, t in rows), key=repr)


def test_examples_of_an_empty_table(frame):
    empty = fill_middle.fill_middle(frame([]))
    assert empty.collect() == [] and fill_middle.digests(empty).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_frames_select_without_opening_whole_ones():
    text = "".join(chr(97 + i % 26) for i in range(1000))
    framed = Framed.of(text, 100)
    assert framed.ends == list(range(100, 1001, 100))
    parts = list(framed.select(150, 420))
    assert [type(p) for p, _ in parts] == [str, bytes, bytes, str] and [n for _, n in parts] == [50, 100, 100, 20]
    for a, b in ((0, 0), (0, 1000), (100, 200), (999, 1000), (3, 997), (1000, 1000)):
        out = Framed()
        out.copy(framed, a, b)
        assert b"".join(out.stream()).decode() == text[a:b] and len(out) == b - a
    whole = Framed()
    whole.copy(framed, 100, 300)
    assert whole.frames == framed.frames[1:3]


def test_marks_are_found_across_frames():
    for units in (1, 2, 3, 5):
        framed = Framed.of("x<S<S>ab<P><P<M>tail", units)
        assert framed.find(["<S>", "<P>", "<M>"]) == [3, 8, 13]
        assert framed.find(["<P>", "<S>"]) == [8, -1]


def test_a_broken_example_is_refused():
    with pytest.raises(ValueError):
        list(fill_middle.original(Framed([pack("<P>a<M>b")], [8]), "psm"))


def test_crc_of_any_run_of_words():
    r = random.Random(2)
    w = [bytes(r.randrange(48, 58) for _ in range(r.choice([1, 2, 7, 62, 63, 64, 65, 130, 5000]))) for _ in range(200)]
    run = Running(w)
    for n in (1, 2, 3, 9):
        assert run.ngrams(n).tolist() == [zlib.crc32(b" ".join(w[i:i + n])) for i in range(len(w) - n + 1)]
    assert len(run.ngrams(201)) == 0 and len(Running([]).ngrams(1)) == 0
    a, b = b"first", b"x" * 1000
    assert zlib.crc32(a + b) == int(shift(np.array([zlib.crc32(a)], np.uint32), np.array([1000]))[0]) ^ zlib.crc32(b)


def brute_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_resample(rows, target, max_n, buckets):
    def grams(text):
        w = brute_words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]

    docs = [(k, len(brute_words(t)), grams(t)) for k, t in rows]
    s, t = {}, {}
    for counts, found in ((s, (b for _, _, g in docs for b in g)), (t, (b for x in target for b in grams(x)))):
        for b in found:
            counts[b] = counts.get(b, 0) + 1
    sums, sumt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t.get(b, 0) + 1) * (sums + buckets) / ((s[b] + 1) * (sumt + buckets)))) for b in s}
    out = []
    for k, n, g in docs:
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        out.append((k, n, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[2]))
    drawn = len(fit) * 10 // 100
    return out, [x[4] for x in fit[:drawn]], fit[:drawn]


@pytest.mark.parametrize("max_n, buckets", [(1, 10_000), (3, 997), (2, 100_000)])
def test_resampling_equals_brute_force(spark, frame, max_n, buckets):
    r = random.Random(7)
    vocabulary = ["Alpha", "beta7", "ÉTÉ", "漢字", "x" * 80, "Z", "don't", "a-b", "\x00", "42"]
    text = lambda n: "".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    rows = [(i, text(r.choice([0, 3, 19, 20, 60]))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "-- !"), (None, text(40)), (903, text(3000)), (904, rows[5][1]), (905, "y" * 5000)] + [(7, text(50))] * 3
    target = ["Alpha beta7 42 alpha", None, "été"]
    got = importance.resample(frame(rows), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"), max_n=max_n, buckets=buckets).collect()
    want, scores, drawn = brute_resample(rows, target, max_n, buckets)
    assert sorted((tuple(x)[:5] for x in got), key=repr) == sorted(want, key=repr)
    ranked = sorted((x for x in got if x["rank"] is not None), key=lambda x: x["rank"])
    assert [x["rank"] for x in ranked] == list(range(1, len(drawn) + 1))
    assert [(x["doc_id"], x["score"]) for x in ranked] == [(x[0], x[4]) for x in drawn]


@pytest.mark.parametrize("portion", [1, 7, 40])
def test_portions_hold_every_ngram_once(monkeypatch, portion):
    monkeypatch.setattr(importance, "SLICE", portion)
    r = random.Random(4)
    for _ in range(40):
        text = "".join(r.choice("aB é.- \n") for _ in range(r.choice([0, 1, 50, 200]))) + "z" * r.choice([0, 90])
        words = [w.encode() for w in brute_words(text)]
        for n in (1, 2, 3):
            found = []
            for again, part in importance.pieces(text.encode(), 3):
                found += [tuple(part[i:i + n]) for i in range(max(0, again - n + 1), len(part) - n + 1)]
            assert found == [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]


def test_resampling_with_empty_sides(spark, frame):
    nothing = spark.createDataFrame([], "item_id long, text string")
    got = importance.resample(frame([(i, "word " * 30) for i in range(20)]), nothing).collect()
    assert sum(x["rank"] is not None for x in got) == 2
    assert importance.resample(frame([]), nothing).collect() == []


def corpus(n, seed=3):
    """Good prose, and bad one of four kinds: marked, shouted, barred, repeated."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["ta", "re", "on", "li", "né", "sch"]) for _ in range(r.choice([1, 2, 3])))
    rows = []
    for i in range(n):
        w = [word() for _ in range(r.choice([8, 30, 200]))]
        bad = r.random() < 0.3
        if bad:
            kind = r.randrange(4)
            w = [[x + r.choice(["$$$", "###"]) for x in w], [x.upper() + "!!" for x in w], [y for x in w for y in (x, "|")], [w[0]] * len(w)][kind]
        else:
            w[0] = w[0].capitalize()
        rows.append((i, " ".join(w) + ".", 0 if bad else 1))
    return rows


def test_held_out_quality(spark, frame):
    rows = corpus(700)
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")
    docs = frame([(i, t) for i, t, _ in rows])
    got = {x["doc_id"]: x for x in nb_svm.classify(docs, labels).collect()}
    assert all(x["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, x in got.items())
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.7) for x in got.values())
    unseen = [(got[i]["predicted"], y) for i, _, y in rows if got[i]["held_out"]]
    assert len(unseen) > 120 and sum(p == y for p, y in unseen) >= 0.95 * len(unseen)
    again = {x["doc_id"]: x["score"] for x in nb_svm.classify(docs.repartition(5), labels).collect()}
    assert again == {i: x["score"] for i, x in got.items()}
    # Labels that are held out change nothing.
    other = labels.withColumn("quality", F.when(nb_svm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {x["doc_id"]: x["score"] for x in nb_svm.classify(docs, other).collect()} == again


def test_quality_of_odd_rows(spark, frame):
    rows = corpus(200)
    odd = [(None, "keyless"), (900, None), (901, ""), (902, "same"), (902, "same"), (903, "long " * 400_000)]
    labels = [(i, y) for i, _, y in rows] + [(0, rows[0][2]), (1, 1 - rows[1][2]), (None, 1), (2, None), (3, 7)]
    got = nb_svm.classify(frame([(i, t) for i, t, _ in rows] + odd), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(rows) + len(odd) and all(x["score"] is not None for x in got)
    empty = {x["doc_id"]: x["score"] for x in got}
    assert empty[900] == empty[901]


def test_labels_beyond_the_bound_are_sampled(spark, frame):
    docs = frame([(i, f"t{i}") for i in range(2000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, quality int")
    assert nb_svm.labelled(docs, labels).count() == 2000
    some = {bytes(r["text"]) for r in nb_svm.labelled(docs, labels, max_labels=500).collect()}
    assert 400 < len(some) < 600 and some == {bytes(r["text"]) for r in nb_svm.labelled(docs, labels, max_labels=500).collect()}


def test_quality_without_labels(spark, frame):
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert [x["score"] for x in nb_svm.classify(frame([(1, "a b"), (2, None)]), nothing).collect()] == [0.5, 0.5]
    one_class = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")
    got = [x["score"] for x in nb_svm.classify(frame([(i, f"a {i}") for i in range(60)]), one_class).collect()]
    assert len(set(got)) == 1 and got[0] > 0.9
    assert nb_svm.classify(frame([]), one_class).collect() == []


def test_ngrams_do_not_depend_on_portions(monkeypatch):
    r = random.Random(9)
    texts = ["", "one", " \n", "é É", "A" * 300] + [" ".join(r.choice(["w1", "X,", "né", "!!", "w1"]) for _ in range(r.choice([3, 40, 700]))) for _ in range(30)]
    data = [t.encode() for t in texts] + [None]
    alone = [sorted(next(nb_svm.Grams(1 << 12).each([t])).tolist()) for t in data]
    assert [sorted(x.tolist()) for x in nb_svm.Grams(1 << 12).each(data)] == alone
    for portion in (1, 5, 100):
        monkeypatch.setattr(nb_svm, "SLICE", portion)
        assert [sorted(x.tolist()) for x in nb_svm.Grams(1 << 12).each(data)] == alone


def test_words_and_shapes():
    w, s, at = nb_svm.word_hashes("The the THE a,b x,y 12 3 né".encode())
    assert at.tolist() == [0, 4, 8, 12, 16, 20, 23, 25]
    assert w[0] == w[1] == w[2] != w[3] and len(set(w.tolist())) == 6
    assert s[3] == s[4] and s[5] == s[6] and len({*s[:4].tolist(), s[5]}) == 5


def test_dual_descent_reaches_the_optimum():
    r = np.random.default_rng(1)
    x = r.normal(size=(60, 5))
    y = np.where(x[:, 0] + 0.3 * r.normal(size=60) > 0, 1, -1)
    w = nb_svm.dual_descent([(np.arange(5), v) for v in x], y, 5, epochs=2000, tolerance=1e-9)
    share = np.where(y > 0, 60 / (2 * (y > 0).sum()), 60 / (2 * (y < 0).sum()))

    def primal(w):
        return 0.5 * w @ w + (share * np.maximum(0, 1 - y * (x @ w[:5] + w[5])) ** 2).sum()

    best = primal(w)
    assert all(best <= primal(w + 0.01 * r.normal(size=6)) + 1e-9 for _ in range(50))
