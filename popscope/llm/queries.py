"""The registered queries: each operator applied to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from popscope.llm.alignment import alignment
from popscope.llm.chat import digests, format_conversations
from popscope.llm.common import scratch, table
from popscope.llm.decontaminate import contaminated
from popscope.llm.fingerprint import edited_fingerprints
from popscope.llm.interleave import interleave
from popscope.llm.jaccard_join import jaccard_components
from popscope.llm.langid import identify_languages
from popscope.llm.lexical import ranked
from popscope.llm.mixing import mix
from popscope.llm.near_dup import near_duplicates
from popscope.llm.pii import find_pii
from popscope.llm.url_cascade import judge_urls
from popscope.llm.warc import read_archives, write_archives

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_warc_revisit(spark, sf):
    folder = scratch(spark, "warc")
    write_archives(table(spark, sf, "pages"), folder)
    columns = F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")
    return read_archives(spark, folder).select(*columns)


@query
def op2_pareto_mix(spark, sf):
    return mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_one_permutation(spark, sf):
    return edited_fingerprints(table(spark, sf, "documents"))


@query
def op4_url_cascade(spark, sf):
    return judge_urls(table(spark, sf, "pages"))


PROBE = "</s>[INST] ok [/INST]"  # a text that looks like a template's marks


@query
def op5_chat_spans(spark, sf):
    rows = table(spark, sf, "conversations")
    probe = F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"))))
    extra = spark.range(1).select(probe.alias("t")).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("t.turn").cast("long").alias("turn"), "t.role", F.lit(PROBE).alias("text")
    )
    return digests(format_conversations(rows.unionByName(extra)))


@query
def op6_bayes_dedup(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))


@query
def op7_byte_gru(spark, sf):
    return identify_languages(table(spark, sf, "documents"))


@query
def op8_pii_bootstrap(spark, sf):
    return find_pii(table(spark, sf, "documents")).drop("added")


@query
def op9_interleave(spark, sf):
    law = F.lit("rows").alias("law")
    grown = F.lit(None).cast("int").alias("grown_shard")
    return interleave(table(spark, sf, "documents")).select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query
def op10_cgk_decontaminate(spark, sf):
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op11_reversed_search(spark, sf):
    return ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op12_merge_path_align(spark, sf):
    return alignment(table(spark, sf, "documents"))


@query
def op13_relation_skip_join(spark, sf):
    return jaccard_components(table(spark, sf, "documents"))
