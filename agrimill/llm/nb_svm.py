"""Quality classifier: indicators of n-grams scaled by class log-count ratios, and a linear SVM by dual coordinate descent."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from agrimill.llm.common import field, stored

# Buckets of hashed n-grams. Every task holds one number for each.
BUCKETS = 1 << 18
# Labels that are learned from at most, for the class counts; beyond that a sample by hash. So many may be broadcast.
MAX_LABELS = 1_000_000
# Bounds of the sample of those that the SVM is fitted on: documents, and n-grams of all of them.
MAX_ROWS, MAX_CELLS = 12_000, 12_000_000
# One sample document in so many is kept from the fit and used to turn margins into probabilities.
CALIBRATE = 5
ALPHA, COST, EPOCHS, TOLERANCE, BLEND = 1.0, 1.0, 30, 1e-3, 0.25
THRESHOLD = 0.7
# Texts are hashed in portions of about so many bytes.
SLICE = 1 << 20
# Odd multipliers that mix hashes, and what tells the kinds of n-grams apart.
MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
KINDS = {("word", 1): 1, ("word", 2): 2, ("shape", 1): 3, ("shape", 2): 4, ("shape", 3): 5}


def _looks() -> np.ndarray:
    """Class of every byte: 0 for white space, one for upper and one for lower letters, digits, bytes beyond ASCII; marks have their own."""
    table = np.arange(256, dtype=np.uint8)
    for members, look in ((b" \t\n\x0b\x0c\r", 0), (bytes(range(65, 91)), 65), (bytes(range(97, 123)), 97), (bytes(range(48, 58)), 48), (bytes(range(128, 256)), 128)):
        table[list(members)] = look
    return table


LOOKS = _looks()
LOWER = np.where(LOOKS == 65, np.arange(256) + 32, np.arange(256)).astype(np.uint8)
# Random numbers by byte and place: the hash of a word is the sum of those of its bytes, that of a shape of its classes.
PLACES, SHAPE_PLACES = 64, 16
BYTE_HASHES, SHAPE_HASHES = (np.random.default_rng(n).integers(1, 1 << 63, (256, n), np.uint64) for n in (PLACES, SHAPE_PLACES))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word of a text (A-Z lowered), hash of its shape, and where it begins.

    The shape says how a word looks: runs of upper or lower letters, of digits, of bytes beyond ASCII, and each mark once.
    """
    b = np.frombuffer(data, np.uint8)
    looks = LOOKS[b]
    solid = looks != 0
    at = np.flatnonzero(solid)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.uint64), at
    head = np.ones(len(at), bool)
    head[1:] = at[1:] != at[:-1] + 1
    first = np.flatnonzero(head)
    sizes = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    words = np.add.reduceat(BYTE_HASHES[LOWER[b[at]], place % PLACES], first)
    looks = looks[at]
    turn = head
    turn[1:] |= looks[1:] != looks[:-1]
    kept = np.flatnonzero(turn)
    begin = (np.cumsum(turn) - 1)[first]
    place = np.arange(len(kept)) - np.repeat(begin, np.diff(begin, append=len(kept)))
    shapes = np.add.reduceat(np.where(place < SHAPE_PLACES, SHAPE_HASHES[looks[kept], place % SHAPE_PLACES], np.uint64(0)), begin)
    return words, shapes, at[first]


class Grams:
    """Distinct buckets of the n-grams of texts, in an order that the text alone decides.

    N-grams are of one and two words, A-Z lowered, and of one to three word shapes; a word that repeats the one before it
    has a shape of its own.
    """

    def __init__(self, buckets: int = BUCKETS):
        self.buckets = buckets
        self.last = np.zeros(buckets, np.int32)
        self.seen = np.zeros(buckets, bool)

    def _ids(self, what: str, *parts: np.ndarray) -> np.ndarray:
        h = np.full(len(parts[0]), KINDS[what, len(parts)], np.uint64)
        for p in parts:
            h ^= p
            h *= np.uint64(MIX_A)
            h ^= h >> np.uint64(31)
        h *= np.uint64(MIX_B)
        h >>= np.uint64(32)
        return (h % np.uint64(self.buckets) if self.buckets & (self.buckets - 1) else h & np.uint64(self.buckets - 1)).astype(np.int32)

    def _group(self, texts: list[bytes], again: int = 0) -> Iterator[np.ndarray]:
        """Buckets of each text's n-grams, repeats included, that end after its first `again` words."""
        w, s, starts = word_hashes(b" ".join(texts))
        bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts])).tolist()
        repeats = np.zeros(len(w), bool)
        repeats[1:] = w[1:] == w[:-1]
        repeats[[x for x in bounds if x < len(w)]] = False
        s = np.where(repeats, s ^ np.uint64(MIX_B), s)
        ids = []
        for what, n in KINDS:
            h, last = (w if what == "word" else s), len(w) - n + 1
            ids.append((n, self._ids(what, *[h[i:last + i] for i in range(n)]) if last > 0 else np.empty(0, np.int32)))
        for lo, hi in zip(bounds, bounds[1:]):
            yield np.concatenate([x[lo + max(0, again - n + 1):max(lo, hi - n + 1)] for n, x in ids])

    def _long(self, text: bytes) -> np.ndarray:
        at = back = again = 0
        while at < len(text):
            end = min(at + SLICE, len(text))
            while end < len(text) and LOOKS[text[end]]:
                end += 1
            part = text[back:end]
            self.seen[next(self._group([part], again))] = True
            starts = word_hashes(part)[2][-3:]  # of three words shared with the next portion, the first tells whether the second repeats it
            at, back, again = end, back + int(starts[0]) if len(starts) else end, len(starts)
        found = np.flatnonzero(self.seen).astype(np.int32)
        self.seen[found] = False
        return found

    def _distinct(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for ids in self._group(texts):
            places = np.arange(len(ids), dtype=np.int32)
            self.last[ids] = places
            yield ids[self.last[ids] == places]

    def each(self, texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
        """Distinct buckets of each text in turn; a null text is empty. Short texts are hashed together, long ones in portions."""
        group, held = [], 0
        for text in texts:
            text = text or b""
            if held + len(text) > SLICE and group:
                yield from self._distinct(group)
                group, held = [], 0
            if len(text) > SLICE:
                yield self._long(text)
            else:
                group.append(text)
                held += len(text)
        if group:
            yield from self._distinct(group)


def log_count_ratios(positive: np.ndarray, negative: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    """Log ratio of the smoothed shares that each n-gram has in the indicator counts of the two classes."""
    p, q = positive + alpha, negative + alpha
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, size: int, cost: float = COST, epochs: int = EPOCHS, tolerance: float = TOLERANCE, seed: int = 1) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss: coordinate by coordinate of the dual, in random order.

    Rows are (places, values); the last weight is the bias. Each class weighs as much as the other. It stops when no
    projected gradient of a pass is above the tolerance.
    """
    w = np.zeros(size + 1)
    positive = max(int((signs > 0).sum()), 1), max(int((signs < 0).sum()), 1)
    share = {1: len(signs) / (2 * positive[0]), -1: len(signs) / (2 * positive[1])}
    slack = np.array([0.5 / (cost * share[int(s)]) for s in signs])
    norms = np.array([float(v @ v) + 1.0 for _, v in rows]) + slack
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            y = signs[i]
            gradient = y * (float(w[at] @ v) + w[size]) - 1 + slack[i] * alpha[i]
            if alpha[i] == 0 and gradient >= 0:
                continue
            worst = max(worst, abs(gradient))
            new = max(alpha[i] - gradient / norms[i], 0.0)
            step = (new - alpha[i]) * y
            alpha[i] = new
            w[at] += step * v
            w[size] += step
        if worst < tolerance:
            break
    return w


def probabilities(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid that fits the margins best, by Newton's method on smoothed targets."""
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, math.log((n1 + 1) / (n0 + 1))

    def loss(a: float, b: float) -> float:
        z = a * margins + b
        return float((np.logaddexp(0, z) - target * z).sum()) + 1e-6 * a * a

    for _ in range(100):
        z = np.clip(a * margins + b, -500, 500)
        p = 1 / (1 + np.exp(-z))
        d, h = p - target, np.maximum(p * (1 - p), 1e-12)
        ga, gb = float((d * margins).sum()) + 2e-6 * a, float(d.sum())
        haa, hab, hbb = float((h * margins * margins).sum()) + 2e-6, float((h * margins).sum()), float(h.sum()) + 1e-9
        det = haa * hbb - hab * hab
        if det <= 0 or max(abs(ga), abs(gb)) < 1e-9:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step, now = 1.0, loss(a, b)
        while step > 1e-6 and loss(a - step * da, b - step * db) > now:
            step /= 2
        if step <= 1e-6:
            break
        a, b = a - step * da, b - step * db
    return (a, b) if a > 0 else (0.0, math.log((n1 + 1) / (n0 + 1)))


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", usable: Column | None = None, max_labels: int = MAX_LABELS) -> DataFrame:
    """Texts with their label: h (a hash of the key), y (0 or 1), text.

    Labels other than 0 and 1, null keys, and keys whose labels disagree are left out. `usable` is a condition on the
    column `k`, the key, that a row must meet to be learned from. Of more than `max_labels` labels about so many are
    taken, by a hash of the key, so that they can be broadcast whatever the corpus, as 24 bytes each, and no text moves.
    """
    one = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)")
    one = one.where(usable) if usable is not None else one
    one = one.groupBy(F.xxhash64("k").alias("h"), F.xxhash64(F.lit(7), "k").alias("g")).agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z")
    one = stored(one, "labels")
    share = max_labels / max(one.count(), 1)
    if share < 1:
        one = one.where(F.pmod(F.shiftright("g", 8), F.lit(1 << 30)) < int(share * (1 << 30)))
    picked = docs.select(F.col(key).alias("k"), F.col(text).cast("string").cast("binary").alias("text"))
    picked = picked.where(usable) if usable is not None else picked
    hashed = picked.select(F.xxhash64("k").alias("h"), F.xxhash64(F.lit(7), "k").alias("g"), "text")
    return hashed.join(F.broadcast(one), ["h", "g"]).select("h", "y", "text")


def class_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """In how many texts of each class an n-gram occurs: bucket, positive, negative; bucket -1 counts the texts and -2 their n-grams.

    Tasks count for themselves first, so what is shuffled follows the buckets and not the texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(buckets)
        total, texts, cells = np.zeros((2, buckets), np.int64), [0, 0], [0, 0]
        for batch in batches:
            for y, found in zip(batch.column(0).to_pylist(), grams.each(t.as_py() for t in batch.column(1))):
                total[y][found] += 1
                texts[y] += 1
                cells[y] += len(found)
        at = np.flatnonzero(total.any(axis=0))
        columns = np.concatenate([[-1, -2], at]), *[np.concatenate([[texts[y], cells[y]], total[y][at]]) for y in (1, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["bucket", "positive", "negative"])

    counted = rows.select("y", "text").mapInArrow(count, "bucket long, positive long, negative long")
    return counted.groupBy("bucket").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))


def fit(rows: DataFrame, buckets: int = BUCKETS, max_rows: int = MAX_ROWS, max_cells: int = MAX_CELLS) -> DataFrame:
    """The model, one stored row: weights (64-bit numbers, one for each bucket), bias, slope, shift, rows.

    `rows` is what `labelled` gives. The log-count ratios are those of all these texts. The SVM is fitted in one task on a
    sample by hash of the key: about `max_rows` texts with about `max_cells` n-grams, whichever is fewer, which bounds
    that task whatever the corpus. Without texts of both classes every score is the smoothed share of class 1.
    """
    counts = stored(class_counts(rows, buckets), "class-counts").toArrow()
    at, positive, negative = (counts.column(i).to_numpy() for i in range(3))
    texts, cells = ({-1: 0, -2: 0} | {int(b): int(p + n) for b, p, n in zip(at, positive, negative) if b < 0}).values()
    held = at >= 0
    dense = np.zeros((2, buckets))
    dense[0][at[held]], dense[1][at[held]] = positive[held], negative[held]
    ratios = log_count_ratios(*dense)
    kinds = "weights binary, ratios binary, bias double, slope double, shift double, rows long"
    if not texts:
        none = np.zeros(buckets, "<f8").tobytes()
        return stored(rows.sparkSession.createDataFrame([(none, none, 0.0, 0.0, 0.0, 0)], kinds), "nb-svm")
    share = min(1.0, max_rows / texts, max_cells / max(cells, 1))
    # The key's hash decides, so that a second run takes the same texts.
    sample = rows.where(F.pmod(F.col("h"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))

    def indicators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(buckets)
        for batch in batches:
            found = [ids.astype("<i4").tobytes() for ids in grams.each(t.as_py() for t in batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["h", "y", "grams"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((h, y, g) for batch in batches for h, y, g in zip(*[c.to_pylist() for c in batch.columns]))
        rows, signs = [], np.array([1 if y else -1 for _, y, _ in got])
        for _, _, g in got:
            places = np.frombuffer(g, "<i4")
            v = ratios[places]
            length = math.sqrt(float(v @ v))
            rows.append((places, v / length if length else v))
        weights, bias, slope, shift = np.zeros(buckets), 0.0, 0.0, math.log((1 + (signs > 0).sum()) / (1 + (signs < 0).sum()))
        aside = np.array([(h >> 32) % CALIBRATE == 0 for h, _, _ in got], bool)
        if len(got) and all((signs[part] == s).any() for part in (aside, ~aside) for s in (1, -1)):
            learned = np.flatnonzero(~aside)
            w = dual_descent([rows[i] for i in learned], signs[learned], buckets)
            # A share of the mean weight for all n-grams keeps the ratios themselves in play.
            mean = float(np.abs(w[:buckets]).sum()) / max(int((w[:buckets] != 0).sum()), 1)
            weights, bias = ((1 - BLEND) * mean + BLEND * w[:buckets]) * ratios, float(w[buckets]) * BLEND
            held_back, both = np.flatnonzero(aside), np.stack([weights, ratios * ratios])
            margins = np.array([margin(both, rows[i][0]) for i in held_back]) + bias
            slope, shift = probabilities(margins, (signs[held_back] > 0).astype(int))
        yield pa.RecordBatch.from_pydict({"weights": [weights.astype("<f8").tobytes()], "ratios": [ratios.astype("<f8").tobytes()], "bias": [bias], "slope": [slope], "shift": [float(shift)], "rows": pa.array([len(got)], pa.int64())})

    made = sample.mapInArrow(indicators, "h long, y int, grams binary").repartition(1)
    return stored(made.mapInArrow(learn, kinds), "nb-svm")


def margin(both: np.ndarray, places: np.ndarray) -> float:
    """Margin of a text without the bias, from weights and squared ratios; its scaled indicators have length one."""
    total, squares = float(both[0][places].sum()), float(both[1][places].sum())
    return total / math.sqrt(squares) if squares else 0.0


def score(docs: DataFrame, model: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Key and score, 0 to 1, of every text; the model's two numbers for each bucket go to every task."""
    m = model.first()
    weights, ratios = (np.frombuffer(m[c], "<f8").astype(np.float64) for c in ("weights", "ratios"))
    both = np.stack([weights, ratios * ratios])
    bias, slope, shift = m["bias"], m["slope"], m["shift"]
    kind = field(docs.schema, key)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(buckets)
        for batch in batches:
            z = np.array([margin(both, ids) for ids in grams.each(t.as_py() for t in batch.column(1))], np.float64)
            p = 1 / (1 + np.exp(-np.clip(slope * (z + bias) + shift, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=[kind.name, "score"])

    schema = T.StructType([T.StructField(kind.name, kind.dataType), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(key).alias(kind.name), F.col(text).cast("string").cast("binary").alias("_text")).mapInArrow(rate, schema)


def held_out(key: Column, of: int = 4, rest: int = 2) -> Column:
    """Whether a row is kept from learning: CRC-32 of the key as text leaves `rest`; a null key counts as empty."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % of == rest


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """Score every document: key, held_out, score, predicted.

    Only labels of rows that are not held out are learned from, at most `MAX_LABELS` for the class counts and `MAX_ROWS` for
    the SVM; nothing but the text enters a score. Null texts are
    empty; empty texts get the score of the bias alone. Repeated rows are scored, and learned from, as often as they
    occur. An empty table gives an empty result. Only key and text are read, so other columns may have any name.
    """
    model = fit(labelled(docs, labels, key, text, label, ~held_out(F.col("k"))), buckets)
    name = field(docs.schema, key).name
    scored = score(docs, model, key, text, buckets)
    return scored.select(name, held_out(F.col(name)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
