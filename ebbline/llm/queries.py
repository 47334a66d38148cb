"""The registered queries of the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import chat, collocations, decontaminate, htmltext, idfiles, licences, mixing, packing, prefixtrie, quality, simhash, urlfilter, warc
from ebbline.llm.common import stored, table
from ebbline.llm.oracles import ORACLES
from ebbline.sources import scratch_path

__all__ = ["ORACLES", "QUERIES"]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "archives")
    warc.write_archives(pages, folder)
    rows = warc.read_archives(spark, folder, pages.schema["page_id"].dataType.simpleString(), payloads=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge_urls(pages, urlfilter.tracking_hosts(pages))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_text(table(spark, sf_dir, "pages"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licences.scan(table(spark, sf_dir, "documents"))
    every = F.array_sort(F.array_union("base_labels", "notice_labels"))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), "score",
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # Conversation -1: both texts hold control strings of the template.
    own = [(-1, 0, "user", chat.HOSTILE), (-1, 1, "assistant", chat.HOSTILE)]
    return chat.read_back(chat.expand(turns.unionByName(spark.createDataFrame(own, turns.schema))))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.best(collocations.mine(table(spark, sf_dir, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_idfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "ids")
    idfiles.write_ids(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return idfiles.read_ids(spark, folder, docs.schema["doc_id"].dataType.simpleString(), ids=False)


def op13_prefixtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(prefixtrie.turn_rows(table(spark, sf_dir, "conversations")), "turns")
    return prefixtrie.prefix_trie(*prefixtrie.rebuilt(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_urls": op4_urls,
    "op5_quality": op5_quality,
    "op6_decontaminate": op6_decontaminate,
    "op7_html": op7_html,
    "op8_licences": op8_licences,
    "op9_chat": op9_chat,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_idfiles": op12_idfiles,
    "op13_prefixtrie": op13_prefixtrie,
}
