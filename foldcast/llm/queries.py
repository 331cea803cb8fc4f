"""One query per operator over the whole driver tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcast.llm import (bpe, fertility, labelled, langid, lines, merkle, mixing, neardup, rules,
                          runs, sharding, simhash, spotsigs, toxicity)
from foldcast.llm.scratch import kept

#: The public vocabulary files; a parameter of the operators.
WORD_BPE, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return keep


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_shard_hypergeometric")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(documents(spark, sf_dir), 24)
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op4_bpe_trie")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(documents(spark, sf_dir).select("doc_id", "text"), vocabulary(WORD_BPE))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


LINES_SQL = """
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos from d),
k as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
f as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (f.key is not null) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (f.key is null), ''))
    as kept_sha256
from k left join f on k.key = f.key
group by doc_id"""


@query("op6_shared_lines", LINES_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.drop_shared_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


MIX_SQL = """
with d as (
  select doc_id, source, md5('mix:' || coalesce(cast(doc_id as varchar), '')) as u,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size
  from documents),
s as (
  select source, sum(size) as n, case (row_number() over (order by source nulls last) - 1) % 3
    when 0 then 5 when 1 then 2 else 1 end as w
  from d group by source),
l as (
  select *, 2 * n as room,
    sum(2 * n) over (order by 2 * n / w, source nulls last rows unbounded preceding) as room_upto,
    sum(w) over (order by 2 * n / w, source nulls last rows unbounded preceding) as weight_upto,
    sum(n) over () * 1.5::double as budget, sum(w) over () as weight
  from s),
f as (
  select *, (budget - (room_upto - room)) * w >= room * (weight - (weight_upto - w))::double as full_up
  from l),
g as (
  select *, coalesce(sum(room) filter (full_up) over (), 0) as used,
    coalesce(sum(w) filter (not full_up) over (), 1) as open_w
  from f),
t as (
  select source, n::bigint as source_size, budget,
    case when full_up then room::double else (budget - used) / open_w::double * w end as target
  from g),
q as (
  select d.*, t.source_size, t.target, t.budget,
    sum(d.size) over (partition by d.source order by d.u, d.doc_id rows unbounded preceding) as upto
  from d join t on d.source is not distinct from t.source),
r as (
  select *, (k * source_size + upto)::double / target as moment
  from q, (values (0), (1)) as rounds(k) where size > 0 and target > 0),
c as (
  select *, sum(size) over (order by moment, source nulls last, u, doc_id rows unbounded preceding) as sent
  from r),
x as (select doc_id, count(*) as copies from c where sent <= budget group by doc_id)
select q.doc_id, q.size::bigint as size, source_size, target,
  (q.size * coalesce(x.copies, 0))::bigint as taken, coalesce(x.copies, 0)::int as copies
from q left join x on q.doc_id = x.doc_id"""


@query("op8_mix_fair_queueing", MIX_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


@query("op9_tokeniser_fertility")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    measured = kept(fertility.measure(docs, vocabulary(PIECES)).drop("text"), "fertility")
    return fertility.verdicts(measured).drop("lang").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_tokens", "n_byte_tokens", "entropy")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query("op7_toxic_segments")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    sample = kept(labelled.training_labels(labels(spark, sf_dir), "toxic"), "toxic-labels")
    found = toxicity.score(docs, toxicity.fit(docs, sample))
    return found.select(
        "doc_id", labelled.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.size("passages").alias("n_passages"))


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    measured = kept(rules.measure(docs).drop("text"), "quality")
    sample = kept(labelled.training_labels(labels(spark, sf_dir), "quality"), "quality-labels")
    scored = measured.withColumn("score", rules.compiled(rules.fit(measured, sample)))
    return scored.select("doc_id", labelled.held_out().alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query("op2_spot_signatures")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spotsigs.with_next(documents(spark, sf_dir))
    chars = F.length("text")
    last = F.floor(chars / 4).cast("int")
    edited = rows.select(
        "doc_id", "text", "next_text", chars.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), chars - last),
                 F.substring("next_text", F.lit(1), last)).alias("edited"))
    prints = spotsigs.fingerprint(edited.withColumn("edited_sha256", F.sha2("edited", 256)), {
        "text": "fingerprint", "edited": "edited_fingerprint", "next_text": "next_fingerprint"})
    alike = spotsigs.likeness(prints.drop("text", "edited", "next_text"), {
        "near_edited": ("fingerprint", "edited_fingerprint"),
        "near_next": ("fingerprint", "next_fingerprint")})
    return alike.select("doc_id", "n_chars", "edited_sha256", "fingerprint",
                        "edited_fingerprint", "near_edited", "near_next")


@query("op5_weighted_minhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


@query("op10_language_fusion")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return langid.identify(pages, documents(spark, sf_dir))


#: Levels of the SQL's trees, enough for 3 ** 16 rows of a source.
_LEVELS = 16


def _tree_sql(name: str, rows: str) -> str:
    """CTEs of one tree per ``s`` over ``rows`` (s, pos, h, n): nodes by level, siblings, tops."""
    out = [f"{name}0 as materialized ({rows})"]
    for k in range(_LEVELS):
        out.append(f"""
{name}s{k} as materialized (
  select a.s, a.pos, any_value(a.n) as n,
    coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos < a.pos), '') as before,
    coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos > a.pos), '') as after
  from {name}{k} a join {name}{k} b on a.s = b.s and a.pos // 3 = b.pos // 3
  group by a.s, a.pos),
{name}{k + 1} as materialized (
  select s, pos // 3 as pos, case when any_value(n) > 1 then sha256(string_agg(h, '' order by pos))
    else any_value(h) end as h, (any_value(n) + 2) // 3 as n
  from {name}{k} group by s, pos // 3)""")
    return ",".join(out)


def _proof_sql(name: str) -> str:
    """What the levels add to ``proof`` and how they fold ``node``, from the leaf upwards."""
    out = []
    for k in range(_LEVELS):
        out.append(f"""
{name}f{k + 1} as materialized (
  select f.* replace (
    case when p.n > 1 then f.proof || p.before || p.after else f.proof end as proof,
    case when p.n > 1 then sha256(p.before || f.node || p.after) else f.node end as node)
  from {name}f{k} f join {name}s{k} p on f.s{name} = p.s and f.p{name} // {3 ** k} = p.pos)""")
    return ",".join(out)


def _leaf_sql(text: str) -> str:
    values = ["cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text]
    return "sha256(" + " || ".join(
        f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in values) + ")"


# the last bit of crc32(doc_id), bit by bit
_EVEN_SQL = """
  select doc_id as id, list_reduce(list_prepend(4294967295::ubigint, list_transform(
    range(8 * strlen(cast(doc_id as varchar))), lambda i: ((ascii(substr(cast(doc_id as varchar),
      cast(i // 8 + 1 as int), 1)) >> cast(i % 8 as int)) & 1)::ubigint)),
    lambda r, b: xor(r >> 1, case when (r & 1) <> b then 3988292384::ubigint else 0::ubigint end))
    & 1 = 1 as even
  from (select distinct doc_id from documents where doc_id is not null)"""

MERKLE_SQL = f"""
with lv as (
  select doc_id, coalesce('s' || source, 'n') as s, {_leaf_sql("text")} as h,
    {_leaf_sql("case when even then replace(text, chr(10), '') else text end")} as changed
  from documents left join ({_EVEN_SQL}) on id = doc_id),
nb as materialized (
  select *, row_number() over (partition by s order by doc_id nulls first, h) - 1 as pos,
    count(*) over (partition by s) as n from lv),
{_tree_sql("a", "select s, pos, h, n from nb")},
tp as materialized (
  select s as source, h, row_number() over (order by s) - 1 as pos, count(*) over () as n
  from a{_LEVELS}),
{_tree_sql("b", "select 0 as s, pos, h, n from tp")},
af0 as (
  select nb.doc_id, nb.h as leaf, nb.s as sa, nb.pos as pa, 0 as sb, tp.pos as pb,
    tp.h as subroot, (select h from b{_LEVELS}) as root, '' as proof, nb.changed as node
  from nb join tp on nb.s = tp.source),
{_proof_sql("a")},
bf0 as (select * from af{_LEVELS}),
{_proof_sql("b")}
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, node as folded_root,
  node = root as verified
from bf{_LEVELS}"""


@query("op13_merkle_butterfly", MERKLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    without = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = merkle.manifest(documents(spark, sf_dir), {"text": without})
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        merkle.fold(F.col("changed_leaf"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


SPACES = "[\\x20\\x09-\\x0D]+"


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` in which one text of ten repeats some stretch of its words up to its end."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", (mark / 10).cast("long").alias("g"), F.when(
        mark % 10 == 0, F.filter(F.split("text", SPACES), lambda w: w != "")).alias("words"))
    rows = rows.selectExpr("*", "size(words) as n", "cast(g % nullif(size(words), 0) as int) as a")
    rows = rows.selectExpr("*", "cast(1 + (n - a) div (3 + g % 8) as int) as p")
    planted = F.expr("""array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(
        slice(words, a + 1, p), cast((n - a) div p + 1 as int))), 1, n - a)), ' ')""")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_blocks")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_runs(documents(spark, sf_dir)))
    # exponents are compared as fractions
    best = F.expr("""get(array_sort(runs, (x, y) -> case
        when x.length * y.period <> y.length * x.period
          then if(x.length * y.period > y.length * x.period, -1, 1)
        when x.start <> y.start then if(x.start < y.start, -1, 1)
        when x.period <> y.period then if(x.period < y.period, -1, 1) else 0 end), 0)""")
    told = F.expr("""array_join(transform(runs, r -> concat(
        r.start, ',', r.length, ',', r.period, '\n')), '')""")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", "best.start", "best.length", "best.period",
             F.expr("1000 * best.length div best.period").alias("exponent_milli"),
             "runs_sha256", "collapsed_sha256")


@query("op11_simhash_planes")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", simhash.hex_of(F.col("fingerprint")).alias("fingerprint"), "component_id")
