"""The corpus queries op1 to op13, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from agrimill.session import configure, stored
from agrimill.llm import chat as chats, fill_middle, host_rules, importance, lines, minhash, mixing, multi_index, nb_svm, packing, records, sharding, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``f(spark, folder) -> DataFrame`` under its own name."""

    def register(f):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return f(configure(spark), folder)

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op3_longest_first_shards(spark, folder):
    """24 shards of nearly equal bytes; equal texts share a shard."""
    placed = sharding.shard_texts(table(spark, folder, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query(r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), safe as (
  select *, length(regexp_replace(text, '([<\[])(\\*)(/?INST\]|/?s>|\|[a-z_]+\|>)', '\1\\\2\3', 'g')) as n_text,
    length(regexp_replace(role, '([<\[])(\\*)(/?INST\]|/?s>|\|[a-z_]+\|>)', '\1\\\2\3', 'g')) as n_role
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(case when role = 'assistant' then length(text) end), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text), '')) as loss_sha256,
  cast(sum(n_text + n_role + 23) as bigint) as formatted_chars
from safe group by conv_id
""")
def op4_chat_events(spark, folder):
    """All conversations and one that tries to forge marks, as a log with chunks, edits and regenerations; read back from the rendered text and its loss mask."""
    forged = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(forged)
    done = chats.chat(chats.turns_as_log(rows)).withColumn("turns", chats.parse(F.col("formatted"))).withColumn("learned", chats.learned(F.col("formatted"), F.col("loss")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query(r"""
with docs as (
  select doc_id, source, cast(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) as bigint) as size from documents
), ranked as (
  select source, cast(sum(size) as bigint) as source_size, cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as double) as weight
  from docs group by source
), caps as (
  select *, 3 * source_size as cap, sum(source_size) over () as budget,
    coalesce(sum(3 * source_size) over (order by 3 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (order by 3 * source_size / weight, source nulls last rows between current row and unbounded following) as weights
  from ranked
), levels as (select *, cast(budget - before as double) / weights as level from caps),
first as (select level from levels where level <= cap / weight order by cap / weight, source nulls last limit 1),
targets as (
  select source, source_size, coalesce(least((select level from first) * weight, cap), cast(cap as double)) as target from levels
), summed as (
  select d.*, t.source_size, t.target,
    sum(d.size) over (partition by d.source order by md5('mix:' || coalesce(cast(doc_id as varchar), '')), doc_id, d.size rows between unbounded preceding and current row) as upto
  from docs d join targets t on d.source is not distinct from t.source
), copies as (
  select *, case when source_size = 0 then 0.0 else cast((epoch - 1) * source_size + upto as double) / target end as finish
  from summed cross join (values (1), (2), (3)) e(epoch)
), mixed as (
  select *, sum(size) over (order by finish, source nulls last, md5('mix:' || coalesce(cast(doc_id as varchar), '')), doc_id, epoch rows between unbounded preceding and current row) as so_far
  from copies
)
select doc_id, size, source_size, target, cast(sum(case when so_far <= (select sum(target) from targets) then size else 0 end) as bigint) as taken
from mixed group by doc_id, size, source_size, target
""")
def op5_fair_queue_mix(spark, folder):
    """Words the mix takes from every document."""
    got = mixing.mix_plan(table(spark, folder, "documents"))
    one = got.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return one.select(F.col("key").alias("doc_id"), F.col("words").alias("size"), "source_size", "target", (F.col("words") * F.col("copies")).cast("long").alias("taken"))


@query(r"""
with docs as (select doc_id, source, coalesce(text, '') as text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words from documents),
windows as (
  select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from docs)
), twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) as n from windows) where n > 1),
spread as (select doc_id, count(distinct i + d) as n from twice cross join (values (0), (1), (2)) o(d) group by doc_id),
lines as (select doc_id, unnest(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))) as line from docs),
same as (select doc_id, count(*) - count(distinct line) as n, count(*) as n_lines from lines group by doc_id),
counts as (
  select d.doc_id, d.source, len(d.words) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols, coalesce(l.n, 0) as n_dup_lines, coalesce(l.n_lines, 0) as n_lines, coalesce(s.n, 0) as n_repeat_words
  from docs d left join spread s using (doc_id) left join same l using (doc_id)
), failed as (
  select *, n_words < 50 as f1, 100 * n_repeat_words > 50 * n_words as f2, 10 * n_symbols > n_words as f3, 10 * n_dup_lines > 3 * n_lines as f4, word_chars > 20 * n_words or word_chars < 2 * n_words as f5 from counts
), rates as (
  select source, rule, count(*) as n, sum(cast(f as bigint)) as k from (select source, unnest([1, 2, 3, 4, 5]) as rule, unnest([f1, f2, f3, f4, f5]) as f from failed where source is not null) group by source, rule
), prior as (select rule, avg(k / n) as m, coalesce(var_samp(k / n), 0) as v from rates group by rule),
strength as (select rule, m, case when v > 0 then greatest(m * (1 - m) / v - 1, 0) else 1 end as s from prior),
bad as (select distinct source from rates join strength using (rule) where (k + m * s) / (n + s) > 0.5)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, f1 or f2 as base_failed, not (f1 or f2) and (source is null or source not in (select source from bad)) as kept
from failed
""")
def op9_host_quality(spark, folder):
    """Counts of every document, its base verdict and the verdict with its host's."""
    got = host_rules.host_quality_ids(table(spark, folder, "documents"))
    return got.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op2_histogram_best_fit(spark, folder):
    """Every document in sequences of at most 1024 tokens."""
    got = packing.pack_documents(table(spark, folder, "documents"), keep_ids=False)
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op6_framed_records(spark, folder):
    """Ids of every document, read back from record files."""
    listed = records.write_records(table(spark, folder, "documents"))
    return records.read_records(listed, keep_ids=False)


@query(r"""
with payloads as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
tops as (select body, max(page_id) as original from payloads group by body)
select page_id, cast(strlen(body) as bigint) as payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr(h, 5 * (i // 4) + 1, 5) as bigint) >> (15 - 5 * (i % 4))) & 31), 1)), 'string_agg', '') as payload_digest,
  case when page_id = original then 'response' else 'revisit' end as record_type,
  case when page_id <> original then original end as refers_to
from payloads join tops using (body)
""")
def op8_warc_transactions(spark, folder):
    """Every page as a capture, read back from WARC archives and assembled."""
    rows = warc.with_revisits(table(spark, folder, "pages"), least=0)
    # The archives are read once: what is kept of a record is its head.
    heads = stored(warc.read_warc(warc.write_warc(rows), payload=False), "warc-heads")
    captures = warc.originals(warc.assemble(heads))
    return captures.select(F.col("key").alias("page_id"), "response.payload_bytes", "response.payload_digest", "response.record_type", "refers_to")


@query(r"""
with lines as (
  select doc_id, line_no, line, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as line_no from documents where text is not null)
), solid as (select *, {'d': doc_id, 'l': line_no} as pos from lines where len(w) > 0),
firsts as (select line, any_value(w) as w, min(pos) as pos from solid group by line),
long as (select *, unnest(range(len(w))) as i from firsts where len(w) >= 8),
variants as (select line, pos, i, array_to_string(list_concat(w[:i], w[i + 2:]), ' ') as rest from long),
whole as (select line, pos, array_to_string(w, ' ') as rest from firsts where len(w) >= 8),
near as (
  select line from (select line, pos, min(pos) over (partition by rest, i) as least from variants) where least < pos
  union select v.line from variants v join whole u using (rest) where u.pos < v.pos
  union select u.line from variants v join whole u using (rest) where v.pos < u.pos
), gone as (
  select s.doc_id, s.line_no from solid s join firsts f using (line) where s.pos <> f.pos or s.line in (select line from near)
)
select d.doc_id, cast(coalesce(len(string_split(d.text, chr(10))), 0) as bigint) as n_lines,
  (select count(*) from gone g where g.doc_id = d.doc_id) as n_removed,
  case when d.text is not null then coalesce((select string_agg(l.line, chr(10) order by l.line_no) from lines l where l.doc_id = d.doc_id and not exists (select 1 from gone g where g.doc_id = l.doc_id and g.line_no = l.line_no)), '') end as text
from documents d
""")
def op10_line_neighbourhoods(spark, folder):
    """Documents without the lines that stand earlier in the corpus, equal or one word edit away."""
    return lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), counts=True)


@query()
def op1_circulant_minhash(spark, folder):
    """Near-duplicate components of all documents: three words, similarity of 0.85 or more."""
    return minhash.near_duplicates(table(spark, folder, "documents"), size=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op7_inverted_multi_index(spark, folder):
    """The 20 nearest vectors of every twentieth one, against all."""
    return multi_index.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op12_nb_svm_quality(spark, folder):
    """Quality of every document, learned from the labels that are not held out."""
    return nb_svm.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(r"""
with polynomial as (select list(c order by i) as t from (
  select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) r(i))
), docs as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w from documents
), wanted as (
  select unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) as w from benchmark
), found as (select r, unnest(w) as w from docs),
hashed as (
  select w, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(w)), lambda i: cast('0x' || substr(hex(encode(w)), 2 * i + 1, 2) as bigint))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as b
  from (select w from found union select w from wanted), polynomial
), s as (select b, count(*) as s from found join hashed using (w) group by b),
t as (select b, count(*) as t from wanted join hashed using (w) group by b),
gains as (
  select b, cast(floor(1000 * ln(cast(coalesce(t, 0) + 1 as double) * ((select sum(s) from s) + 10000) / (cast(s + 1 as double) * ((select coalesce(sum(t), 0) from t) + 10000)))) as bigint) as g
  from s left join t using (b)
), weights as (select r, sum(g) as weight from found join hashed using (w) join gains using (b) group by r),
scored as (
  select doc_id, cast(len(w) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
    cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast(cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) as double) + 0.5) / 4294967296))) as bigint) as score
  from docs left join weights using (r)
), ranks as (select *, n_features >= 20 as fit, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as k from scored)
select doc_id, n_features, weight, score, case when fit and k <= (select count(*) from scored where n_features >= 20) * 10 // 100 then k end as rank from ranks
""")
def op13_prefix_crc_resampling(spark, folder):
    """A tenth of the documents, drawn to look like the benchmark."""
    got = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")


@query(r"""
with docs as (select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as d from documents),
numbers as (
  select *, length(t) as n, cast('0x' || d[1:8] as bigint) as h1, cast('0x' || d[9:16] as bigint) as h2, cast('0x' || d[17:24] as bigint) as h3, cast('0x' || d[25:32] as bigint) as h4 from docs
), cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from numbers
), parts as (select *, substring(t, 1, a) as pre, substring(t, a + 1, b - a) as mid, substring(t, b + 1) as suf from cuts)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(t) as restored_sha256
from parts
""")
def op11_seekable_fill_middle(spark, folder):
    """Every document as a fill-in-the-middle example, with digests of the example and of the text rebuilt from it."""
    return fill_middle.digests(fill_middle.fill_middle(table(spark, folder, "documents")))
