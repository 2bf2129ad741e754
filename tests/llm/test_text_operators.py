"""Near-duplicates, line dedup, host rules and mixing against brute force, with the odd cases of each."""

from __future__ import annotations

import random

import pytest

from agrimill.llm import host_rules, lines, minhash, mixing

DOC = "doc_id long, text string, source string, bands int, row string, h string, lines int, pos int"


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows):
        """Documents with columns whose names the operators use inside."""
        return spark.createDataFrame([(i, t, s, 1, "r", "h", 2, 3) for i, t, s in rows], DOC)

    return make


def sets(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)] if w else [])


def brute_components(rows, size, percent):
    s = [sets(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and s[j] and 100 * both >= percent * (len(s[i]) + len(s[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids) if ids and s[i] else key
        out.append((key, len(s[i]), least, least is None or key == least))
    return sorted(out, key=repr)


def test_near_duplicates_equal_brute_force(frame):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, key = [], 0
    for _ in range(12):
        base = [r.choice(vocabulary) for _ in range(r.choice([2, 4, 60, 200]))]
        chain = list(base)
        for _ in range(r.choice([1, 4, 12])):  # copies of copies: links that no leader shows
            rows.append((key, " ".join(chain)))
            key += 1
            if len(chain) > 10:
                for _ in range(r.choice([0, 1, 2, 3])):
                    chain[r.randrange(len(chain))] = r.choice(vocabulary)
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "ONE"), (None, rows[0][1]), (None, "nobody has this text but me"), (905, "é  x y"), (905, "another text with that key again")]
    got = minhash.near_duplicates(frame([(k, t, "s") for k, t in rows]), size=3, percent=85)
    assert sorted((tuple(x) for x in got.collect()), key=repr) == brute_components(rows, 3, 85)


def test_near_duplicates_blocks_and_empty_table(frame, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    words = [f"v{i}" for i in range(100)]
    rows = [(i, " ".join([f"x{i}_{k}" if k % 7 == 0 and (i + k) % 5 == 0 else w for k, w in enumerate(words)])) for i in range(25)]
    got = minhash.near_duplicates(frame([(k, t, "s") for k, t in rows]), size=5, percent=80)
    assert sorted((tuple(x) for x in got.collect()), key=repr) == brute_components(rows, 5, 80)
    assert minhash.drop_near_duplicates(frame([])).count() == 0


def test_signature_is_circulant():
    first, rows = minhash.permutations(12, 1)
    assert sorted(first[:10]) != list(range(10)) and (rows[5][1:] == rows[6][:-1]).all() and rows[minhash.PLACES - 1][1] == rows[0][0]
    grams = minhash.shingles(b"a b c d e f g", 3)
    places = first[(grams >> 44).astype("int64")].astype(int)
    want = [min(rows[(p + k) % minhash.PLACES][0] for p in places) for k in range(12)]
    assert minhash.signature(grams, 12, 1).tolist() == want


def near(a, b):
    """Word edit distance of at most 1, by hand."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_lines(rows, least):
    seen, out = [], {}
    for key, text in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        kept = []
        for line in (text or "").split("\n"):
            w = line.encode().split()
            if w and any(line == o or (len(w) >= least and len(v) >= least and near(w, v)) for o, v in seen):
                seen.append((line, w))
                continue
            if w:
                seen.append((line, w))
            kept.append(line)
        out[key] = None if text is None else "\n".join(kept)
    return out


def test_lines_equal_brute_force(frame):
    r = random.Random(5)
    bases = [[f"{b}{i}" for i in range(r.randint(6, 14))] for b in "abcdefgh"]
    rows = []
    for key in range(40):
        text = []
        for _ in range(r.randint(1, 5)):
            w = list(r.choice(bases))
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                at = r.randrange(len(w))
                w[at:at + r.choice([0, 1])] = r.choice([[], ["new"], [f"n{r.randint(0, 3)}"]])
            text.append(" ".join(w) if r.random() < 0.9 else "")
        rows.append((key, "\n".join(text)))
    rows += [(50, None), (51, ""), (52, "\n \n"), (None, rows[0][1] + "\nonly here"), (53, "x " * 3000 + "\n" + "x " * 2999)]
    got = lines.dedup_lines(frame([(k, t, "s") for k, t in rows]))
    assert got.columns == DOC.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    assert {x["doc_id"]: x["text"] for x in got.collect()} == brute_lines(rows, lines.MIN_WORDS)


def test_lines_of_repeated_rows_and_no_rows(frame):
    rows = [(1, "a\nb", "s"), (1, "a\nb", "s"), (2, "b\nc", "s")]
    assert sorted(x["text"] for x in lines.dedup_lines(frame(rows)).collect()) == ["a\nb", "a\nb", "c"]
    assert lines.dedup_lines(frame([]), counts=True).count() == 0


def brute_repeats(w):
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    return len({i + d for i, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)})


def test_host_signals_and_verdicts(frame):
    r = random.Random(1)
    good = [" ".join(f"{r.choice('abcdef')}word{r.randint(0, 99)}" for _ in range(80)) for _ in range(30)]
    rows = [(i, t, "good" if i < 20 else "fine") for i, t in enumerate(good)]
    rows += [(100 + i, "buy now # " * 30, "spam") for i in range(20)] + [(130, good[0], "spam"), (131, good[1], None), (132, "short", None), (133, None, "good"), (134, "", "good"), (135, "a\nb\na\n\n a\na", "good"), (136, "a b c a b c a", "good"), (137, "buy now", "good")]
    got = {x["doc_id"]: x for x in host_rules.host_quality_ids(frame(rows)).select("row.doc_id", "*").collect()}
    for key, text, _ in rows:
        w = (text or "").split()
        x, solid = got[key], [z for z in (text or "").split("\n") if z.split()]
        assert (x["n_words"], x["word_chars"], x["n_repeat_words"], x["n_dup_lines"]) == (len(w), sum(map(len, w)), brute_repeats(w), len(solid) - len(set(solid)))
        assert x["n_symbols"] == sum(c in "#*$%&|<>" for c in text or "")
        assert x["base_failed"] == (len(w) < 50 or 100 * brute_repeats(w) > 50 * len(w))
    assert not got[130]["kept"] and not got[130]["base_failed"]  # a good text on a bad host
    assert got[131]["kept"] and all(got[i]["kept"] for i in range(30))
    kept = host_rules.keep_good(frame(rows))
    assert kept.columns == frame(rows).columns and sorted(x["doc_id"] for x in kept.collect()) == [*range(30), 131]
    assert host_rules.keep_good(frame([])).count() == 0


def brute_targets(sizes, epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    budget, capped = sum(sizes.values()), set()
    while True:
        rest = budget - sum(epochs * sizes[s] for s in capped)
        total = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and rest * weight[s] / total > epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in capped else rest * weight[s] / total for s in names}
        capped |= over


def test_mix_meets_targets(frame):
    r = random.Random(2)
    rows = [(i, " ".join(["w"] * r.randint(1, 40)), s) for i, s in enumerate(["a"] * 300 + ["b"] * 60 + ["c"] * 2 + [None] * 80 + ["z"] * 3)]
    rows += [(1000, None, "a"), (1001, "", "e"), (None, "w w w", "a"), (0, rows[0][1], "a"), (0, rows[0][1], "a")]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = brute_targets(sizes)
    got = mixing.mix_plan(frame(rows)).collect()
    taken = {s: 0 for s in sizes}
    for x in got:
        assert 0 <= x["copies"] <= 3 and x["source_size"] == sizes[x["source"]] and x["target"] == pytest.approx(targets[x["source"]])
        taken[x["source"]] += x["copies"] * x["words"] * x["rows"]
    for s, want in targets.items():
        assert abs(taken[s] - want) <= 125
    assert sum(x["rows"] for x in got) == len(rows)
    again = {(x["key"], x["source"], x["words"]): x["copies"] for x in mixing.mix_plan(frame(rows[::-1])).collect()}
    assert again == {(x["key"], x["source"], x["words"]): x["copies"] for x in got}
    mixed = mixing.mix(frame(rows))
    assert mixed.columns == frame(rows).columns and mixed.count() == sum(x["copies"] * x["rows"] for x in got)
    assert mixing.mix(frame([])).count() == 0
