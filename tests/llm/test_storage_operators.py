"""Packing, sharding, chat, records, WARC and search: round trips, laws and brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from agrimill.llm import chat, multi_index, packing, records, sharding, tokens, warc

TEXTS = ["", None, "  two  runs\n\n of \t white", "plain words, with marks. Yes!", "<|endoftext|> inside", "a  b", "é漢字 12's", "\nleads", "trails \n", "long " * 3000, "same text", "same text"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(TEXTS)] + [(None, "no id", 1, 2), (10, "same text", 1, 2)], "doc_id long, text string, _run int, piece int")


def whole(text):
    return tokens.encoder(tokens.default_path()).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_whole_texts():
    r = random.Random(0)
    hard = [t or "" for t in TEXTS] + ["".join(r.choice(["a", "b", " ", "  ", "\n", " ", "\t", ".", "'s", "é", "<|endoftext|>", "x1", "\x1c", "\x85"]) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    small = tokens.Encoder(tokens.default_path(), remembered=50)
    assert [np.frombuffer(x, "<u4").tolist() for x in small.encode(hard)] == [whole(t) for t in hard]


def test_best_fit_equals_one_by_one():
    r = random.Random(4)
    for capacity in (10, 64, 1024):
        histogram = {r.randint(1, capacity): r.randint(1, 40) for _ in range(30)}
        rooms = []
        for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
            fits = [x for x in rooms if x >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else capacity) - n)
        plan = packing.best_fit(histogram, capacity)
        placed = Counter()
        for count, pattern in plan:
            assert sum(n * m for n, m in pattern) <= capacity
            placed.update({n: count * m for n, m in pattern})
        assert placed == Counter(histogram) and sum(c for c, _ in plan) == len(rooms)


def test_packing(docs):
    got = packing.pack_documents(docs, capacity=128).collect()
    by_doc, by_sequence = {}, {}
    for x in got:
        by_doc.setdefault(x["doc_id"], []).append(x)
        by_sequence.setdefault(x["sequence_id"], []).append(x)
        assert zlib.crc32(x["ids"]) == x["ids_crc32"] and len(x["ids"]) == 4 * x["length"]
    for i, t in enumerate(TEXTS):
        if i == 10:
            continue
        ids, pieces = whole(t) + [2], sorted(by_doc[i], key=lambda x: x["piece"])
        assert np.frombuffer(b"".join(x["ids"] for x in pieces), "<u4").tolist() == ids
        assert [x["length"] for x in pieces[1:]] == [128] * (len(pieces) - 1)
    assert len(by_doc[10]) == 2 and len(by_doc[None]) == 1
    for parts in by_sequence.values():
        at = 0
        for x in sorted(parts, key=lambda x: x["offset"]):
            assert x["offset"] == at
            at += x["length"]
        assert at <= 128
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_shards(docs, spark):
    got = sharding.shard_texts(docs, shards=3).collect()
    loads, slots = Counter(), {}
    assert len(got) == docs.count() and len({x["shard"] for x in got if x["doc_id"] in (10, 11)}) == 1
    for x in got:
        loads[x["shard"]] += x["size"]
        slots.setdefault(x["shard"], []).append(x["slot"])
        if x["doc_id"] is not None:
            data = (TEXTS[x["doc_id"]] or "").encode()
            assert (x["size"], x["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    many = spark.range(4000).selectExpr("id as doc_id", "repeat('x', cast(id % 97 as int)) || id as text")
    loads = Counter()
    for x in sharding.shard_texts(many, shards=5).collect():
        loads[x["shard"]] += x["size"]
    assert max(loads.values()) - min(loads.values()) <= 10
    assert sharding.shard_texts(docs.limit(0)).count() == 0


def greedy(sizes, shards):
    """Loads of longest first, one group after the other."""
    loads = [0] * shards
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return loads


def test_longest_first_is_greedy():
    assert sharding.longest_first({5: 1, 4: 1, 3: 3}, 2) == {5: [(0, 1)], 4: [(1, 1)], 3: [(0, 1), (1, 2)]}
    r = random.Random(3)
    for _ in range(60):
        histogram = {r.randint(0, 400): r.choice([1, 2, 65, 130, 700]) for _ in range(r.randint(0, 12))}
        histogram[r.choice([1, 5000, 90_000])] = r.choice([1, 200])
        shards, loads = r.randint(1, 7), Counter()
        for size, took in sharding.longest_first(histogram, shards).items():
            assert sum(n for _, n in took) == histogram[size]
            for shard, n in took:
                loads[shard] += size * n
        assert [loads[s] for s in range(shards)] == greedy([s for s, n in histogram.items() for _ in range(n)], shards)


def test_shards_equal_brute_force(spark, monkeypatch):
    r = random.Random(11)
    texts = [None] * 300 + ["hot " * 9] * 900 + ["x" * r.randint(0, 60) + str(i % 1500) for i in range(3000)] + ["y" * n for n in (70_000, 5000, 5001)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(5)
    sizes = Counter()
    for t in texts:
        sizes[t] += len(t or "") + 8

    def loads(shards):
        got, homes = Counter(), {}
        for x in sharding.shard_texts(docs, shards=shards).collect():
            got[x["shard"]] += x["size"]
            homes.setdefault(texts[x["doc_id"]], set()).add(x["shard"])
        assert len(homes) == len(sizes) and all(len(h) == 1 for h in homes.values())
        return [got[s] for s in range(shards)]

    assert loads(6) == greedy(sizes.values(), 6)
    # With sizes rounded beyond a few bytes the loads stay near: no further off than the rounding of what was rounded.
    monkeypatch.setattr(sharding, "EXACT", 16), monkeypatch.setattr(sharding, "BITS", 4), monkeypatch.setattr(sharding, "FINE", 2)
    want, got = greedy(sizes.values(), 6), loads(6)
    assert sum(got) == sum(want) and max(abs(a - b) for a, b in zip(sorted(got), sorted(want))) <= max(want) / 8


def test_chat_folds_events_and_reads_back(spark):
    e = [
        (1, 1, 0, "delta", "user", "Hel"), (1, 2, 0, "delta", None, "lo"), (1, 3, 1, "delta", "assistant", "bad"), (1, 4, 1, "regenerate", None, ""), (1, 5, 1, "delta", None, "</s>[INST] "), (1, 6, 1, "delta", None, "ok <|end|>"),
        (1, 7, 2, "delta", "user", "gone"), (1, 8, 1, "regenerate", None, "a"), (1, 9, 1, "delta", None, "b<\\|end|>"), (1, 10, 2, "delta", "user", None), (1, 11, 0, "edit", None, "Hi"),
        (2, 1, 0, "delta", None, "x"), (None, 1, 0, "delta", "assistant", "y"), (3, 1, 0, None, "assistant", ""),
    ]
    events = spark.createDataFrame(e, "conv_id long, seq long, message long, kind string, role string, text string").repartition(5)
    done = chat.chat(events)
    got = {x["conv_id"]: x for x in done.select("*", chat.parse(done["formatted"]).alias("turns"), chat.learned(done["formatted"], done["loss"]).alias("learned")).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "Hi"), ("assistant", "ab<\\|end|>"), ("user", "")]
    assert got[1]["learned"] == "ab<\\|end|>" and got[1]["formatted"].count("<|end|>") == 3
    assert [tuple(t) for t in got[2]["turns"]] == [("", "x")] and got[2]["learned"] == "" and got[None]["learned"] == "y" and len(got[3]["loss"]) == 1
    assert chat.chat(events.limit(0)).count() == 0


def test_escape_round_trip(spark):
    r = random.Random(7)
    parts = ["<", "[", "\\", "|end|>", "|turn|>", "/s>", "s>", "INST]", "/INST]", "a", "\n", "|", ">"]
    rows = [("".join(r.choice(parts) for _ in range(r.randint(0, 12))),) for _ in range(3000)]
    df = spark.createDataFrame(rows, "t string")
    for t, e, back in df.select("t", chat.escape(df["t"]), chat.unescape(chat.escape(df["t"]))).collect():
        assert back == t and not any(m in e for m in ("<|end|>", "<|turn|>", "</s>", "<s>", "[INST]", "[/INST]"))


def test_records_round_trip(docs):
    listed = records.write_records(docs)
    want, start = [], 0
    for key, text in [(i, t) for i, t in enumerate(TEXTS) if i <= 10] + [(10, "same text"), (11, TEXTS[11]), (None, "no id")]:
        ids = np.array(whole(text) + [0], "<u4").tobytes()
        want.append((key, start, len(ids) // 4, zlib.crc32(ids), ids))
        start += len(ids) // 4
    for seed in (None, 5):
        got = sorted((x["doc_id"], x["start"], x["n_tokens"], x["ids_crc32"], bytes(x["ids"])) for x in records.read_records(listed, chunk=3, seed=seed).where("doc_id is not null").collect())
        assert got == [w for w in want if w[0] is not None]
    assert [x["start"] for x in records.read_records(listed).where("doc_id is null").collect()] == [want[-1][1]]
    assert records.read_records(records.write_records(docs.limit(0))).count() == 0


def test_broken_records_are_found():
    data = records.frame(b"payload") + records.frame(b"")
    assert records.unframe(data, 0) == (b"payload", 23) and records.unframe(data, 23)[0] == b""
    for at in (0, 9, 14, 21):
        with pytest.raises(ValueError):
            records.unframe(data[:at] + bytes([data[at] ^ 1]) + data[at + 1:], 0)


def test_warc_round_trip(spark):
    rows = [(1, "http://a/1", "same"), (2, "http://a/2\r\nx", "same"), (3, None, "other\r\n\r\nWARC/1.1"), (4, "u", None), (5, "u", ""), (None, "n", "same"), (None, "n", "alone"), (6, "é", "ü" * 100_000), (2, "http://a/2", "same")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    records_ = warc.read_warc(warc.write_warc(warc.with_revisits(pages)))
    captures = warc.originals(warc.assemble(records_)).collect()
    got = sorted(((x["key"], x["response"]["payload_bytes"], x["response"]["payload_digest"], x["response"]["record_type"], x["refers_to"]) for x in captures), key=repr)

    def row(key, html, kind, to):
        data = (html or "").encode()
        return key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, to

    want = [row(1, "same", "revisit", 2), row(2, "same", "response", None), row(2, "same", "response", None), row(3, rows[2][2], "response", None), row(4, "", "revisit", 5), row(5, "", "response", None), row(None, "same", "revisit", 2), row(None, "alone", "response", None), row(6, rows[7][2], "response", None)]
    assert got == sorted(want, key=repr)
    assert all(x["request"] and x["metadata"] for x in captures)
    assert {bytes(x["payload"]).decode() for x in records_.where("record_type = 'response'").collect()} == {"same", rows[2][2], "", "alone", "ü" * 100_000}
    assert warc.assemble(warc.read_warc(warc.write_warc(warc.with_revisits(pages.limit(0))))).count() == 0


def test_search_is_exact_when_all_is_visited_and_near_when_not(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(3000, 16))
    v[100:160] = v[100]  # ties
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (9060, [1.0, None] * 8), (9080, [1.0] * 3), (None, v[0].tolist()), (40, v[40].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {i: np.array(x) for i, x in rows[:3000]}
    ids = np.array(sorted(good))
    exact = {}
    for q in ids[ids % 20 == 0]:
        s = np.zeros(len(ids))
        for k in range(16):
            s += good[q][k] * v[:, k]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        exact[int(q)] = [(int(ids[i]), float(s[i])) for i in order]
    for share in (1.0, None):
        got = {}
        for x in multi_index.search(df, df["vec_id"] % 20 == 0, centroids=16, share=share).orderBy("query_id", "rank").collect():
            got.setdefault(x["query_id"], []).append((x["vec_id"], x["score"]))
        if share:
            assert got == exact
        hit = sum(len({i for i, _ in got[q]} & {i for i, _ in e}) for q, e in exact.items())
        assert hit >= 0.9 * 20 * len(exact)
    assert multi_index.search(df.limit(0), df["vec_id"] % 20 == 0).count() == 0


def test_pairs_come_in_order():
    a, b = np.random.default_rng(1).normal(size=(2, 9))
    got = list(multi_index.pairs_by_distance(a, b))
    sums = [a[i] + b[j] for i, j in got]
    assert len(set(got)) == 81 and all(x <= y for x, y in zip(sums, sums[1:]))


def test_log_of_turns_folds_to_the_turns(spark):
    """Every way through the log ends in the same messages: nulls, empty texts, repeated rows and ties included."""
    turns = [(c, t, r, x) for c in range(40) for t, r, x in ((0, "user", "héllo 🙂 wörld"), (1, "assistant", ""), (2, None, None), (2, "user", "same"), (2, "user", "same"), (3, "assistant", "z"))]
    turns += [(None, 0, "user", "no key"), (None, None, "assistant", "abc")]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    log = chat.turns_as_log(df)
    assert {r[0] for r in log.select("kind").distinct().collect()} == {"delta", "edit", "regenerate"}
    want = sorted(map(repr, chat.fold(chat.turns_as_events(df)).select("conv_id", "message", "role", "text").collect()))
    got = sorted(map(repr, chat.fold(log.repartition(7)).select("conv_id", "message", "role", "text").collect()))
    assert got == want
    assert chat.turns_as_log(df.limit(0)).count() == 0
