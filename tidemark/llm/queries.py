"""One query per operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, codebooks, decontaminate, divergence, html_text, labelled, language_id, minhash, neighbours, quality, source_audit, toxicity, warc
from tidemark.llm.checks_sql import chat_sql, codebooks_sql, leaks_sql, near_dedup_sql, rules_sql, source_audit_sql, warc_sql
from tidemark.llm.registry import query, table

#: Rank file of the public tokenizers that the token queries use.
VOCABULARY = "byte_bpe_50k.tiktoken"


@query("op1_language_id")
def op1_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query("op5_quality_classifier")
def op5_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))
    outside = labelled.held_out(quality.MODULUS, quality.REMAINDER)
    return scored.select("doc_id", outside.alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op6_toxicity")
def op6_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))
    outside = labelled.held_out(toxicity.MODULUS, toxicity.REMAINDER)
    return scored.select("doc_id", outside.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op9_minhash_near_dedup", near_dedup_sql())
def op9_minhash_near_dedup(spark, folder):
    return minhash.group(table(spark, folder, "documents"), words=2)


@query("op2_html_extraction")
def op2_html_extraction(spark, folder):
    return html_text.extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op3_chat_formatting", chat_sql())
def op3_chat_formatting(spark, folder):
    held = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    vocabulary = chat.Vocabulary(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return chat.read_back(chat.format_turns(held.unionByName(extra), vocabulary), vocabulary)


@query("op4_decontamination", leaks_sql(decontaminate.UNITS, decontaminate.WINDOW, decontaminate.LITERAL))
def op4_decontamination(spark, folder):
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


LIMITS = (divergence.LEAST_CHARS, divergence.LEAST_WORDS, divergence.MOST_CHARS, divergence.MOST_WORDS)


@query("op7_quality_rules", rules_sql(list(divergence.WORDS), list(divergence.COMMON), LIMITS))
def op7_quality_rules(spark, folder):
    judged = divergence.judge(table(spark, folder, "documents"))
    return judged.withColumns({c: F.round(c, 6) for c in ("chars_distance", "words_distance")})


@query("op8_byte_bpe")
def op8_byte_bpe(spark, folder):
    return bpe.round_trip(table(spark, folder, "documents"), bpe.Vocabulary(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN))


@query("op10_warc", warc_sql())
def op10_warc(spark, folder):
    return warc.round_trip(table(spark, folder, "pages")).drop("url")


@query("op11_neighbours")
def op11_neighbours(spark, folder):
    return neighbours.search(table(spark, folder, "embeddings"), every=50, k=5)


@query("op12_vector_codes", codebooks_sql(codebooks.SCALE, codebooks.PARTS, codebooks.ENTRIES, codebooks.ROUNDS))
def op12_vector_codes(spark, folder):
    return codebooks.compress(table(spark, folder, "embeddings"))


@query("op13_source_audit", source_audit_sql(source_audit.MIN_DF, source_audit.ONE, source_audit.SMOOTH, source_audit.TOP))
def op13_source_audit(spark, folder):
    return source_audit.audit(table(spark, folder, "documents"))
