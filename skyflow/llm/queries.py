"""The registered queries of the operators, over the whole of their tables, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm import (
    byte_bpe, conversations, exact_dedup, knn_join, lang_id, line_dedup, packing, quality, sharding, simhash, token_counts,
    token_file, whitening,
)
from skyflow.llm.common import id_crc32
from skyflow.session import ensure_checkpoint_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), WORDS))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(id_crc32(F.col("doc_id")), F.lit(3)) == 1
    out = quality.classify(docs, table(spark, sf_dir, "labels").where(~held_out))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join.top_k(knn_join.whole_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0, 10)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.encode_texts(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    spaces = F.length("ids") - F.length(F.replace("ids", F.lit(" ")))
    return out.select(
        "doc_id", F.when(F.col("ids") == "", 0).otherwise(spaces + 1).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_huffman_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    return token_file.digests(token_file.encode_corpus(table(spark, sf_dir, "documents"), WORDS, path))


def op7_section_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.line_token_counts(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op8_simhash_bk_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_unigram_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(id_crc32(F.col("doc_id")), F.lit(5)) == 0
    out = lang_id.identify(docs.drop("lang"), PIECES, docs.where(~held_out))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(whitening.whole_vectors(table(spark, sf_dir, "embeddings")))
    # a deviation beyond long is null here; the operator has it whole
    return out.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    _, report = conversations.repair(conversations.damage(rows))
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    found = ids.join(report, ids["id"].eqNullSafe(report["conv_id"]), "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return found.select(F.col("id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def op13_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.sharded(table(spark, sf_dir, "documents"), 24)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

def _repair_sql() -> str:
    """The cheapest audit by a recursion over the rows: for each of the four states the least (cost, audit, text)."""
    far = "{'c': 1000000000, 'a': '~', 't': ''}"
    line = lambda role, text: f"chr(10) || {role} || ':' || {text}"

    def step(state: str, cost: str, letter: str, text: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {text}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def inserts(of: str) -> str:
        user, assistant = line("'user'", "''"), line("'assistant'", "''")
        once = f"""select conv_id, n, s0, s1, {least('s2', step('s0', '5', 'I', user), step('s1', '5', 'I', user), step('s3', '5', 'I', user))} as s2,
 {least('s3', step('s2', '5', 'I', assistant))} as s3 from """
        return once + f"({once} {of})"

    stay = "5 * cast(fault = 3 as integer)"
    own = line("role", "text")

    def move(state: str, initial: str, role: str) -> tuple[str, str]:
        keep = f"case when fault not in (1, 2) and initial = '{initial}' then {step(state, stay, 'K', own)} else {far} end"
        redo = f"case when fault not in (1, 2) then {step(state, stay + ' + 1', 'R', line(repr(role), 'text'))} else {far} end"
        return keep, redo

    user = [o for s in ("s0", "s1", "s3") for o in move(s, "u", "user")]
    system = f"case when fault not in (1, 2) and initial = 's' then {step('s0', stay, 'K', own)} else {far} end"
    delete = {s: step(s, "2", "D") for s in ("s0", "s1", "s2", "s3")}
    return f"""
with recursive damaged as (
 select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  crc32_kind % 20 as kind from (select *, {_CRC32} as crc32_kind from conversations)),
rows as (
 select conv_id, turn, case when kind = 4 then 'user' else role end as role,
  case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
  unnest(range(case when kind = 3 then 2 else 1 end)) as copy
 from damaged where kind <> 0),
numbered as (
 select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n,
  row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen, left(role, 1) as initial,
  trim(text, {_SPACE}) as bare from rows),
faults as (
 select *, case when bare = '' then 1 when seen > 1 then 2 when right(bare, 1) not in ('.', '!', '?') then 3 else 0 end as fault,
  lag(initial) over (partition by conv_id order by n) || initial as pair from numbered),
counted as (
 select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank,
  count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
  count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal, count(*) as n from faults group by conv_id),
paths as (
 select conv_id, cast(0 as bigint) as n, {{'c': 0, 'a': '', 't': ''}} as s0, {far} as s1, {far} as s2, {far} as s3 from counted
 union all
 select p.conv_id, f.n, {delete['s0']}, {least(delete['s1'], system)}, {least(delete['s2'], *user)}, {least(delete['s3'], *move('s2', 'a', 'assistant'))}
 from ({inserts('paths')}) p join faults f on f.conv_id is not distinct from p.conv_id and f.n = p.n + 1),
ends as (select conv_id, n, {least('s0', 's3')} as best from ({inserts('paths')})),
repaired as (select c.*, best from counted c join ends e on e.conv_id is not distinct from c.conv_id and e.n = c.n)
select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
 coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(best.c, 0) as bigint) as cost,
 coalesce(best.a, '') as audit, sha256(coalesce(best.t[2:], '')) as repaired_sha256
from (select distinct conv_id from conversations) i left join repaired r on r.conv_id is not distinct from i.conv_id"""


#: DuckDB has no crc32: the reflected polynomial 0xEDB88320 bit by bit over the bytes of the key.
_CRC32 = """list_reduce(
 list_concat([cast(4294967295 as bigint)], [cast(ascii(c) as bigint) for c in string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), '')]),
 lambda a, b: list_reduce(list_concat([xor(a, b)], [cast(k as bigint) for k in range(8)]),
  lambda x, k: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end)))"""
_CRC32 = f"xor({_CRC32}, 4294967295)"

SQL = {
    "op12_conversation_repair": _repair_sql(),
    "op2_line_dedup": f"""
with lines as (
 select doc_id, unnest(l) as line, unnest(range(len(l))) as place
 from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
keyed as (select *, {LOWER.format(f"trim(line, {_SPACE})")} as key from lines),
repeated as (select key, min(doc_id) as first from keyed where length(key) >= 10 group by key having count(distinct doc_id) > 1),
marked as (select k.*, r.first is not null and k.doc_id <> r.first as gone from keyed k left join repeated r using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
 sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from marked group by doc_id""",
    "op4_voronoi_top_k": """
with v as (
 select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as v from embeddings
 where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
pairs as (
 select q.vec_id as query_id, c.vec_id, cast(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) as bigint) as score
 from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 10""",
    "op9_exact_dedup": f"""
with n as (select doc_id, {LOWER.format("coalesce(text, '')")} as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from n group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from n join g using (t)""",
}


def catalog() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    own = (op1_pattern_packing, op2_line_dedup, op3_quality_classifier, op4_voronoi_top_k, op5_byte_bpe,
           op6_huffman_token_file, op7_section_token_counts, op8_simhash_bk_tree, op9_exact_dedup, op10_unigram_language,
           op11_qd_whitening, op12_conversation_repair, op13_bounded_ring)
    return {f.__name__: (f, SQL.get(f.__name__)) for f in own}
