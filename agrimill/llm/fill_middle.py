"""Fill-in-the-middle examples, cut out of and written as seekable compressed frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from agrimill.llm.common import field, stored
from agrimill.llm.frames import UNITS, Framed, digest

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, PLAIN_FROM, SPM_BELOW = 1, 90, 20
# Frames are handed on in portions of about so many bytes.
PORTION = 1 << 24

FRAMES = T.ArrayType(T.BinaryType())
ENDS = T.ArrayType(T.LongType())


def _mapped(df: DataFrame, kept: list[T.StructField], made: list[tuple[str, T.DataType, pa.DataType]], make: Callable[..., tuple[tuple, int]]) -> DataFrame:
    """Columns after the kept ones go to `make`, a row at a time, which returns the new values and their weight in bytes."""
    schema = T.StructType([*kept, *[T.StructField(n, t) for n, t, _ in made]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inputs = batch.columns[len(kept):]
            rows: list[tuple] = []
            first = weight = 0

            def block() -> pa.RecordBatch:
                head = [c.slice(first, len(rows)) for c in batch.columns[:len(kept)]]
                return pa.RecordBatch.from_arrays(head + [pa.array(c, t) for c, (_, _, t) in zip(zip(*rows), made)], names=schema.names)

            for row in range(batch.num_rows):
                values, size = make(*[c[row].as_py() for c in inputs])
                rows.append(values)
                weight += size
                if weight > PORTION:
                    yield block()
                    first, rows, weight = row + 1, [], 0
            if rows:
                yield block()

    return df.mapInArrow(run, schema)


def frame_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", units: int = UNITS) -> DataFrame:
    """Every text as frames of `units` code points: key, marked (holds one of the marks), frames, ends.

    `ends` counts the code points up to the end of each frame. Null and empty texts have no frames. A text of any length
    is compressed frame by frame.
    """
    kind = field(docs.schema, key)

    def make(value: str | None) -> tuple[tuple, int]:
        value = value or ""
        made = Framed.of(value, units)
        return (any(m in value for m in (PREFIX, SUFFIX, MIDDLE)), made.frames, made.ends), sum(map(len, made.frames))

    columns = [("marked", T.BooleanType(), pa.bool_()), ("frames", FRAMES, pa.list_(pa.binary())), ("ends", ENDS, pa.list_(pa.int64()))]
    return _mapped(docs.select(F.col(key).alias(kind.name), F.col(text).cast("string").alias("_text")), [kind], columns, make)


def plan(framed: DataFrame, key: str = "doc_id", seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """`framed` with n (code points), form, and the cuts `low` and `high` (null where the form is plain).

    Four 32-bit numbers are taken from SHA-256 of `seed:key`, so the choice depends on the key alone; a null key hashes as
    empty. Two of them give the cuts, any of 0 to n, the third whether the text stays plain (from `plain_from` percent
    on), the fourth whether the suffix leads (below `spm_below` percent). Empty texts and texts with a mark stay plain.
    """
    digest_of = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)

    def number(i: int) -> Column:
        return F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long")

    n = F.coalesce(F.element_at("ends", -1), F.lit(0)).cast("long")
    out = framed.withColumn("n", F.when(F.size("ends") > 0, n).otherwise(F.lit(0).cast("long"))).withColumn("_digest", digest_of)
    plain = (F.col("n") == 0) | F.col("marked") | (number(2) % 100 >= plain_from)
    form = F.when(plain, "plain").when(number(3) % 100 < spm_below, "spm").otherwise("psm")
    cuts = [number(i) % (F.col("n") + 1) for i in (0, 1)]
    out = out.withColumn("form", form).withColumn("low", F.when(F.col("form") != "plain", F.least(*cuts))).withColumn("high", F.when(F.col("form") != "plain", F.greatest(*cuts)))
    return out.drop("_digest", "marked")


def rearrange(planned: DataFrame, key: str = "doc_id") -> DataFrame:
    """The examples: key, n, form, prefix_chars, middle_chars (null if plain), frames, ends.

    An example is again a sequence of frames. Frames that no cut meets are taken over as stored; only the ones a cut falls
    into are decompressed and written anew, and every mark is a frame of its own. Plain examples are the stored frames.
    """
    kept = [field(planned.schema, c) for c in (key, "n", "form", "prefix_chars", "middle_chars") if c in planned.columns]

    def make(form: str, low: int | None, high: int | None, frames: list[bytes], ends: list[int]) -> tuple[tuple, int]:
        source = Framed(frames, ends)
        if form == "plain":
            return (source.frames, source.ends), sum(map(len, source.frames))
        parts = {PREFIX: (0, low), SUFFIX: (high, len(source)), MIDDLE: (low, high)}
        out = Framed()
        for mark in (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE):
            out.write(mark)
            out.copy(source, *parts[mark])
        return (out.frames, out.ends), sum(map(len, out.frames))

    columns = [("frames", FRAMES, pa.list_(pa.binary())), ("ends", ENDS, pa.list_(pa.int64()))]
    ready = planned.withColumn("prefix_chars", F.col("low")).withColumn("middle_chars", F.col("high") - F.col("low"))
    kept = [field(ready.schema, c) for c in (key, "n", "form", "prefix_chars", "middle_chars")]
    return _mapped(ready.select(*[f.name for f in kept], F.col("form").alias("_form"), "low", "high", "frames", "ends"), kept, columns, make)


def original(example: Framed, form: str) -> Iterator[bytes]:
    """UTF-8 of the text an example was made of, rebuilt in order from what it says and its form."""
    if form == "plain":
        yield from example.stream()
        return
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    places = example.find(order)
    if places[0] != 0 or -1 in places:
        raise ValueError(f"not an example of form {form}: marks at {places}")
    ends = [*places[1:], len(example)]
    parts = {mark: (at + len(mark), end) for mark, at, end in zip(order, places, ends)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from example.stream(*parts[mark])


def digests(examples: DataFrame) -> DataFrame:
    """The examples with output_sha256 and restored_sha256 in place of their frames, streamed a frame at a time."""
    kept = [f for f in examples.schema.fields if f.name not in ("frames", "ends")]

    def make(form: str, frames: list[bytes], ends: list[int]) -> tuple[tuple, int]:
        example = Framed(frames, ends)
        return (digest(example.stream()), digest(original(example, form))), 0

    columns = [("output_sha256", T.StringType(), pa.string()), ("restored_sha256", T.StringType(), pa.string())]
    return _mapped(examples.select(*[f.name for f in kept], F.col("form").alias("_form"), "frames", "ends"), kept, columns, make)


def texts(examples: DataFrame, restore: bool = False) -> DataFrame:
    """The examples with `text` in place of their frames: the example itself or, with `restore`, the text it was made of."""
    kept = [f for f in examples.schema.fields if f.name not in ("frames", "ends", "text")]

    def make(form: str, frames: list[bytes], ends: list[int]) -> tuple[tuple, int]:
        example = Framed(frames, ends)
        data = b"".join(original(example, form) if restore else example.stream())
        return (data.decode(),), len(data)

    picked = examples.select(*[f.name for f in kept], F.col("form").alias("_form"), "frames", "ends")
    return _mapped(picked, kept, [("text", T.StringType(), pa.string())], make)


def fill_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", units: int = UNITS, seed: int = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """Fill-in-the-middle examples of whole texts; columns as `rearrange` says.

    The frames of all texts are stored once and the examples cut out of them. Null texts are empty; empty texts and texts
    that hold a mark stay plain. Repeated rows, and rows with the same key, each give an example cut by the same numbers.
    An empty table gives an empty result. Only key and text are read, so other columns may have any name.
    """
    framed = stored(frame_texts(docs, key, text, units), "frames")
    name = field(docs.schema, key).name
    return rearrange(plan(framed, name, seed, plain_from, spm_below), name)
