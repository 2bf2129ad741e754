"""Filtered, versioned, checksummed releases and validated publishing."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from agrimill.functions.geometry import within
from agrimill.operators.aggregates import version_rank
from agrimill.operators.keyed import first_wins, number_rows
from agrimill.operators.quality import checks
from agrimill.specs import TableSpec

CREDITS = "datasource_credits"

CREDITS_SPEC = TableSpec(
    "credits", CREDITS,
    "datasource string, name string, url string, provider string, licence string, licence_url string, "
    "updated_at timestamp",
)


@dataclass(frozen=True)
class Flavor:
    """What a release holds: sources kept or left out, and a filter per table.

    A filter is a Spark SQL expression or a list of circles ``(x, y, distance)``
    around the table's centroid, any of which may match. ``order_by`` names
    columns the table is sorted by on output.
    """

    name: str
    only: tuple[str, ...] | None = None
    without: tuple[str, ...] = ()
    filters: dict[str, str | tuple[tuple[float, float, float], ...]] = field(default_factory=dict)
    order_by: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def merge(self, only: Iterable[str] | None) -> "Flavor":
        """The same flavor with more sources to keep; both lists are joined."""
        if self.only is None and only is None:
            return self
        return Flavor(self.name, (*(self.only or ()), *(only or ())), self.without, self.filters, self.order_by)


def _predicate(rule: str | tuple, centroid: str = "centroid") -> Column:
    if isinstance(rule, str):
        return F.expr(rule)
    x, y = F.col(f"{centroid}.x"), F.col(f"{centroid}.y")
    return reduce(lambda a, b: a | b, [within(x, y, *circle) for circle in rule])


def select_release(
    tables: Mapping[str, DataFrame], specs: Sequence[TableSpec], flavor: Flavor
) -> dict[str, DataFrame]:
    """Tables of the wanted sources with the flavor's filters applied.

    Credits always belong to a release. A source or table the specs do not know
    is an error rather than silently ignored.
    """
    sources = {s.source for s in specs} | {CREDITS_SPEC.source}
    names = {s.name for s in specs} | {CREDITS}
    unknown = ({*(flavor.only or ()), *flavor.without} - sources) | ({*flavor.filters, *flavor.order_by} - names)
    if unknown:
        raise ValueError(f"flavor {flavor.name}: unknown source or table {sorted(unknown)}")
    kept = sources if flavor.only is None else {*flavor.only, CREDITS_SPEC.source}
    kept -= set(flavor.without)
    out: dict[str, DataFrame] = {}
    for spec in [*specs, CREDITS_SPEC]:
        if spec.source not in kept or spec.name not in tables or spec.name in out:
            continue
        df = tables[spec.name]
        if spec.name in flavor.filters:
            df = df.where(_predicate(flavor.filters[spec.name]))
        if spec.name in flavor.order_by:
            df = df.orderBy(*flavor.order_by[spec.name])
        out[spec.name] = df
    return out


# ---- content hash and manifest ----------------------------------------------


def _canonical(name: str, dtype: DataType) -> Column:
    """Column in a form that can be hashed and does not depend on map order."""
    if isinstance(dtype, MapType):
        return F.to_json(F.array_sort(F.map_entries(F.col(name))))
    if isinstance(dtype, (ArrayType, StructType)):
        return F.to_json(F.struct(F.col(name)))
    return F.col(name)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row; which columns are NULL counts too."""
    cols = [_canonical(f.name, f.dataType) for f in df.schema.fields]
    nulls = F.concat(*[F.when(F.col(f.name).isNull(), "1").otherwise("0") for f in df.schema.fields])
    return F.xxhash64(*cols, nulls)


def strong_row_hash(df: DataFrame) -> Column:
    """SHA-256 of a row, for comparing single rows."""
    cols = [_canonical(f.name, f.dataType).alias(f.name) for f in df.schema.fields]
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def content_hash(df: DataFrame) -> DataFrame:
    """One row ``n_rows``, ``checksum``: the same whatever the order or partitioning of rows."""
    return df.agg(*_measures(df))


def _measures(df: DataFrame) -> list[Column]:
    total = F.coalesce(F.sum(row_hash(df).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return [F.count(F.lit(1)).alias("n_rows"), total.alias("checksum")]


def manifest(tables: Mapping[str, DataFrame], version: str, specs: Sequence[TableSpec] = ()) -> DataFrame:
    """One row per table of a release: version, source, schema, row count, checksum."""
    parts = [
        content_hash(df).select(*[F.lit(v).alias(k) for k, v in _entry(name, df, version, specs).items()], "n_rows", "checksum")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _entry(name: str, df: DataFrame, version: str, specs: Sequence[TableSpec]) -> dict[str, str]:
    """What a manifest says of a table before its rows are counted."""
    source = {s.name: s.source for s in specs}.get(name, CREDITS_SPEC.source)
    return {"version": version, "source": source, "table_name": name, "structure": df.schema.simpleString()}


# ---- sinks --------------------------------------------------------------------


def append_into(df: DataFrame, spec: TableSpec, path: str) -> None:
    """Append rows to a typed table; columns not given are NULL."""
    spec.align(df).write.mode("append").parquet(path)


# What stands in a release's text for characters a line of it cannot hold; the backslash comes first.
ESCAPES = (("\\", "\\b"), ("\r", "\\r"), ("\n", "\\n"))
# Put before an empty text or one of blanks only, which would leave a blank line.
BLANK_MARK = "\\e"
NULL_MARK = "\\N"


def _escaped(text: Column) -> Column:
    """One-line form of a text that `_unescaped` turns back exactly; no text becomes the NULL mark."""
    out = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)
    return F.when(F.rlike(text, F.lit(r"^[\x00-\x20]*$")), F.concat(F.lit(BLANK_MARK), out)).otherwise(out)


def _unescaped(text: Column) -> Column:
    out = F.replace(text, F.lit(BLANK_MARK), F.lit(""))
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), out)


def _flat(df: DataFrame) -> DataFrame:
    """Texts in one-line form and nested columns as JSON text, so that the table fits delimited lines."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (MapType, StructType, ArrayType)):
            cols.append(_escaped(F.to_json(F.col(f.name))).alias(f.name))
        elif isinstance(f.dataType, StringType):
            cols.append(_escaped(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


CSV_OPTIONS = {
    "header": "false", "quote": '"', "escape": '"', "nullValue": NULL_MARK,
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


# No file of a release has more rows, as compressed files are read back by one task each.
ROWS_PER_FILE = 2_000_000


def export_csv(df: DataFrame, path: str) -> None:
    """Gzip-compressed CSV without header, nested columns as JSON, files of at most ``ROWS_PER_FILE`` rows.

    A row is one line: backslash, CR and LF are written as ``\\b``, ``\\r``, ``\\n``, NULL as ``\\N``, and a text of
    blanks only has ``\\e`` before it, so that every text comes back as it was.
    """
    _flat(df).write.mode("overwrite").options(**CSV_OPTIONS).option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)


def read_csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Table written by ``export_csv``, typed by its schema."""
    nested = {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, (MapType, StructType, ArrayType))}
    flat = ", ".join(f"`{f.name}` {'string' if f.name in nested else f.dataType.simpleString()}" for f in schema.fields)
    df = spark.read.schema(flat).options(**CSV_OPTIONS).csv(path)
    cols = []
    for f in df.schema.fields:
        back = _unescaped(F.col(f.name)) if isinstance(f.dataType, StringType) else F.col(f.name)
        cols.append((F.from_json(back, nested[f.name].simpleString()) if f.name in nested else back).alias(f.name))
    return df.select(*cols)


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines, one file per task."""
    df.write.mode("overwrite").json(path)


def json_array_lines(df: DataFrame, order_by: str) -> DataFrame:
    """Lines that, put together in order, are one JSON array of all rows.

    Each row becomes its own line with ``[``, ``,`` and ``]`` around it, so no
    task ever holds the whole document. Rows without a value in ``order_by``
    come first, equal ones in any order; no rows give the one line ``[]``.
    """
    return _array_lines(df, order_by).select(order_by, "line")


def _array_lines(df: DataFrame, order_by: str) -> DataFrame:
    """``order_by``, ``line``, ``_at``: the lines of a JSON array and their places. The table is computed once."""
    doc = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    placed = number_rows(df.select(F.col(order_by), doc.alias("_doc")), "_at", [order_by], start=0)
    last = placed.agg(F.max("_at")).first()[0]
    if last is None:
        return df.sparkSession.range(1).select(F.lit(None).cast(df.schema[order_by].dataType).alias(order_by), F.lit("[]").alias("line"), F.lit(0).cast("long").alias("_at"))
    head = F.when(F.col("_at") == 0, "[").otherwise(",")
    tail = F.when(F.col("_at") == last, "]").otherwise("")
    return placed.select(F.col(order_by), F.concat(head, "_doc", tail).alias("line"), "_at")


def export_json_array(df: DataFrame, path: str, order_by: str) -> None:
    """One JSON array over ordered part files; their concatenation is the document."""
    _array_lines(df, order_by).orderBy("_at").select("line").write.mode("overwrite").text(path)


def write_release(
    tables: Mapping[str, DataFrame], specs: Sequence[TableSpec], flavor: Flavor, version: str, root: str
) -> str:
    """Write a filtered release under ``root/version``: table files, then the manifest.

    Rows are counted and hashed in the job that writes them, so each table is
    computed once. The measures stand above all shuffles, in the tasks that
    write, which count once however often one is tried.
    """
    chosen = select_release(tables, specs, flavor)
    base = f"{root}/{version}"
    listed = []
    for name, df in chosen.items():
        seen = Observation()
        export_csv(df.observe(seen, *_measures(df)), f"{base}/data/{name}")
        listed.append((*_entry(name, df, version, specs).values(), seen.get["n_rows"], seen.get["checksum"]))
    schema = "version string, source string, table_name string, structure string, n_rows bigint, checksum string"
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame(listed, schema).coalesce(1).write.mode("errorifexists").json(f"{base}/manifest")
    return base


def load_release(
    spark: SparkSession,
    base: str,
    only: Sequence[str] | None = None,
    without: Sequence[str] = (),
    verify: bool = True,
) -> dict[str, DataFrame]:
    """Tables of a written release, wanted sources only, checked against the manifest."""
    listed = spark.read.json(f"{base}/manifest").collect()  # one row per table
    wanted = [r for r in listed if (only is None or r["source"] in only) and r["source"] not in without]
    tables = {
        r["table_name"]: read_csv_table(spark, f"{base}/data/{r['table_name']}", _schema_of(r["structure"])) for r in wanted
    }
    if verify and tables:
        bad = verify_release(spark, tables, wanted).collect()
        if bad:
            raise ValueError(f"release {base} does not match its manifest: {[r['table_name'] for r in bad]}")
    return tables


def _schema_of(structure: str) -> StructType:
    """Schema out of a manifest's ``struct<…>`` text."""
    return StructType.fromDDL(f"s {structure}").fields[0].dataType


def verify_release(spark: SparkSession, tables: Mapping[str, DataFrame], listed: Sequence) -> DataFrame:
    """Tables whose row count or checksum differs from the manifest, or which one side lacks."""
    expected = spark.createDataFrame(
        [(r["table_name"], r["n_rows"], r["checksum"]) for r in listed], "table_name string, n_rows bigint, checksum string"
    )
    actual = manifest(tables, "loaded").select("table_name", F.col("n_rows").alias("n2"), F.col("checksum").alias("c2"))
    both = expected.join(actual, "table_name", "full_outer")
    return both.filter(~(F.col("n_rows").eqNullSafe(F.col("n2")) & F.col("checksum").eqNullSafe(F.col("c2"))))


def at_version(df: DataFrame, version: str | None = None, column: str = "release") -> DataFrame:
    """Rows of a named release, or of the newest one by its three version numbers."""
    if version is not None:
        return df.filter(F.col(column) == version)
    newest = df.agg(F.max_by(F.col(column), version_rank(F.col(column))).alias(column))
    return df.join(F.broadcast(newest), column, "left_semi")


def with_provenance(df: DataFrame, credits: DataFrame, source: str = "source") -> DataFrame:
    """Source, provider, licence and date of the credit put on every row; of repeated credits the first provider's."""
    c = first_wins(credits.select(F.col("datasource").alias(source), "provider", "licence", "updated_at"), [source], ["provider"])
    return df.join(c, source, "left")


def replace_credits(credits: DataFrame, fresh: DataFrame) -> DataFrame:
    """Credits with every row of the sources given anew replaced."""
    return credits.join(fresh.select("datasource").distinct(), "datasource", "left_anti").unionByName(fresh)


# ---- validated publish ----------------------------------------------------------


def publish(
    spark: SparkSession, tables: Mapping[str, DataFrame], specs: Sequence[TableSpec], root: str, others: Mapping[str, DataFrame] | None = None,
    since: int | None = None,
) -> DataFrame:
    """Replace a table set only if its keys and references hold.

    Tables are written to a staging copy of their own and checked as read back.
    A good copy becomes current by one new pointer file; a bad one is listed
    as an error and the previous copy stays current. Copies are never changed
    after they are written, so a lost job leaves the current one untouched.

    References are held both ways: the staged tables' own, and those of tables in
    ``others`` (with a spec in ``specs``) that point at a staged one. A reference
    to a table given nowhere counts as broken.

    Each good copy is a generation of the root, made by a pointer file that only
    one writer can create. A publisher that started from generation ``since`` (the
    one found at the start, if not given) and finds a later one at the end raises
    ``PublishConflict``: what its references were checked against may have changed.
    """
    since = generation(spark, root) if since is None else since
    token = uuid.uuid4().hex
    by_name = {s.name: s for s in specs}
    staged: dict[str, DataFrame] = {}
    for name, df in tables.items():
        path = f"{root}/copies/{token}/{name}"
        by_name[name].align(df).write.mode("errorifexists").parquet(path)
        staged[name] = spark.read.schema(by_name[name].schema).parquet(path)
    inbound = [
        replace(s, pk=(), not_null=(), fks={c: to for c, to in s.fks.items() if to[0] in staged})
        for s in specs if s.name in (others or {}) and s.name not in staged
    ]
    report = checks(spark, {**(others or {}), **staged}, [*(s for s in specs if s.name in staged), *(s for s in inbound if s.fks)])
    failed = report.filter(~F.col("ok") & ~F.startswith("rule", F.lit("state:")))
    good = not failed.limit(1).collect()
    said = {"token": token, "status": "ok" if good else "error", "published_at": datetime.now(timezone.utc).isoformat()}
    if good:
        said["generation"] = since + 1
    lines = "".join(json.dumps({"table_name": name, **said}) + "\n" for name in staged)
    if not _create_only(spark, f"{root}/pointer/{_GENERATION % (since + 1) if good else f'error-{token}.json'}", lines):
        raise PublishConflict(f"{root}: generation {since + 1} was published meanwhile")
    return report


class PublishConflict(Exception):
    """Another publisher was first."""


# Name of the pointer file of a generation.
_GENERATION = "generation-%012d.json"


def generation(spark: SparkSession, root: str) -> int:
    """Number of good copies published under ``root``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/pointer")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return 0
    found = [re.fullmatch(r"generation-(\d+)\.json", s.getPath().getName()) for s in store.listStatus(folder)]
    return max((int(m[1]) for m in found if m), default=0)


def _create_only(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; of several writers at once, one alone succeeds."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() == "file":
        # The local file system's own "create" looks first and writes then.
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = store.create(target, False)
    except Py4JJavaError:
        if store.exists(target):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def current(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """The published copy of a table: that of the latest generation that holds it."""
    schema = "table_name string, token string, status string, published_at timestamp, generation long"
    pointers = spark.read.schema(schema).json(f"{root}/pointer")
    newest = (
        pointers.filter((F.col("table_name") == spec.name) & (F.col("status") == "ok"))
        .agg(F.max_by("token", F.struct(F.coalesce("generation", F.lit(0)), "published_at")).alias("token")).collect()[0]["token"]
    )
    if newest is None:
        raise ValueError(f"{spec.name}: nothing published under {root}")
    return spark.read.schema(spec.schema).parquet(f"{root}/copies/{newest}/{spec.name}")
