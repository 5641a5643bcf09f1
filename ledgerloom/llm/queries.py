"""One query for each operator of this package over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.alignment import alignment_statistics
from ledgerloom.llm.bpe import encode_and_decode
from ledgerloom.llm.chat import format_conversations, read_loss, read_turns
from ledgerloom.llm.language import identify_languages
from ledgerloom.llm.neighbours import nearest_neighbours
from ledgerloom.llm.ngram_join import jaccard_components
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.quality import score_quality
from ledgerloom.llm.sharding import kd_shards
from ledgerloom.llm.syncmers import fingerprints
from ledgerloom.llm.token_files import read_token_files, write_token_files
from ledgerloom.llm.warc import base32_of_hex, read_archives, write_archives
from ledgerloom.llm.whitening import whiten
from ledgerloom.session import fresh_path

#: What both turns of the added conversation say: text like the marks of templates.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op2_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    write_archives(_table(spark, sf_dir, "pages"), folder)
    read = read_archives(spark, folder)
    page_of = lambda name: F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")
    # Of a payload that is in the archive, what is returned comes from the payload as read.
    unpacked = F.col("payload").isNotNull()
    return read.select(
        page_of("record_id").alias("page_id"),
        F.when(unpacked, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("bigint").alias("payload_bytes"),
        F.when(unpacked, base32_of_hex(F.sha1("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    done = format_conversations(turns.unionByName(added))
    read = done.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("read"),
        F.array_join(read_loss(F.col("formatted"), F.col("loss")), "").alias("learnt"),
    )
    said = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("read").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_statistics(_table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), folder)
    return read_token_files(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_multiprobe_neighbours": op2_multiprobe_neighbours,
        "op3_syncmer_fingerprints": op3_syncmer_fingerprints,
        "op4_bpe": op4_bpe,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_language_id": op7_language_id,
        "op8_warc": op8_warc,
        "op9_chat_formatting": op9_chat_formatting,
        "op10_kd_sharding": op10_kd_sharding,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
        "op13_token_files": op13_token_files,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_warc": _OP8_SQL, "op9_chat_formatting": _OP9_SQL}


_OP8_SQL = r"""
with bits as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, upper(sha1(coalesce(html, ''))) as hex
  from pages),
named as (
  select page_id, payload_bytes, hex, max(page_id) over (partition by hex) as kept,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(
      list_transform(range(5), lambda j: (((instr('0123456789ABCDEF', substr(hex, ((i * 5 + j) // 4 + 1)::int, 1)) - 1)
        >> (3 - (i * 5 + j) % 4)::int) & 1) * (16 >> j::int)))::int, 1)), '') as payload_digest
  from bits)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  if(page_id = kept, 'response', 'revisit') as record_type, if(page_id = kept, null, kept) as refers_to
from named"""

_OP9_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, i, if(i = 0, 'user', 'assistant'), '\### Assistant: </turn> ok' from range(2) t(i)),
marked as (
  select *, lag(role) over w as before, lead(role) over w as after,
    replace(replace(replace(text, '\', '\b'), '<', '\l'), '>', '\g') as body,
    replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g') as head
  from turns window w as (partition by conv_id order by turn nulls first, role, text)),
conv as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as said,
    coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as learnt,
    sum(length(body) + if(before is distinct from role, length(head) + 8, 5)
      + if(after is distinct from role, 8, 0))::bigint as formatted_chars
  from marked group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, length(learnt)::bigint as loss_chars,
  sha256(learnt) as loss_sha256, formatted_chars
from conv"""
