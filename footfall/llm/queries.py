"""The registered queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    alignment,
    chat,
    licenses,
    neighbours,
    parity,
    pieces,
    repeats,
    secrets,
    spotsigs,
    sql,
    toxicity,
    turns,
    warc,
    wumanber,
)
from footfall.llm.tables import small_batches, table

#: Held out of the toxicity labels: crc32 of the id as text, modulo 3, is 1.
HELD_OUT = "crc32(cast(doc_id as string)) % 3 = 1"
#: The date that the response records made of ``pages`` carry.
FETCHED = "2024-01-01T00:00:00Z"


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pages = table(spark, sf_dir, "pages")
    derived = warc.derivatives(warc.responses(pages, "page_id", "url", "html", FETCHED), "page_id")
    return derived.select(
        "page_id", "response_id", "metadata_id", "conversion_id", "metadata_digest", "conversion_digest",
        "title", "n_links",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
        F.sha2("metadata", 256).alias("metadata_sha256"),
        F.sha2("conversion", 256).alias("conversion_sha256"),
    )


def chat_records(conversations: DataFrame) -> DataFrame:
    """Conversations as JSON records of four layouts, whichever can hold them: ``conv_id, record``."""
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    held = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    kind = F.coalesce(F.col("conv_id") % 3, F.lit(0))
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    three = (roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))) & (F.col("t")[1]["text"] != "")
    named = F.size(F.filter(roles, lambda r: ~r.isin("user", "assistant", "system"))) == 0
    messages = F.struct(
        F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages")
    )
    share = F.struct(
        F.transform(
            "t",
            lambda t: F.struct(
                F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"),
                t["text"].alias("value"),
            ),
        ).alias("conversations")
    )
    prompt = F.struct(F.get("t", F.lit(0))["text"].alias("prompt"), F.get("t", F.lit(1))["text"].alias("completion"))
    instruction = F.struct(
        F.get("t", F.lit(0))["text"].alias("instruction"),
        F.get("t", F.lit(1))["text"].alias("input"),
        F.get("t", F.lit(2))["text"].alias("output"),
    )
    record = (
        F.when(pair & (kind != 0), F.to_json(prompt))
        .when(three & (kind != 0), F.to_json(instruction))
        .when(named & (kind == 1), F.to_json(share))
        .otherwise(F.to_json(messages))
    )
    return held.select("conv_id", record.alias("record"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    out = chat.format_records(chat_records(rows))
    back = out.select(
        "conv_id", "layout", "layout_hash", "formatted", "loss_spans",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "layout",
        "layout_hash",
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = wumanber.find_windows(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumn("n_notices", F.size("notices").cast("long")).drop("notices")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan_secrets(docs, secrets.train(docs), keep=["doc_id"])


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    coded = pieces.encode(docs, model_file(), keep=["doc_id", "text_sha256"])
    back = pieces.decode(coded, model_file())
    return back.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("piece_ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return parity.components(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(f"not ({HELD_OUT})")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", "predicted")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults dealt by the checksum of conversation and turn."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("fault", F.crc32(name.cast("binary")) % 20).filter("fault <> 0")
    fault = F.col("fault")
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    conversations = table(spark, sf_dir, "conversations")
    repaired = turns.repair(damaged(conversations)).withColumnRenamed("conv_id", "conv")
    every = conversations.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(repaired, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(f"not ({HELD_OUT})")
    scored = neighbours.score(docs, neighbours.train(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", "predicted")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, model_file("byte_bpe_50k.json"), model_file(), keep=["doc_id"])


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_spotsigs": op1_spotsigs,
        "op2_warc": op2_warc,
        "op3_chat": op3_chat,
        "op4_decontamination": op4_decontamination,
        "op5_licenses": op5_licenses,
        "op6_secrets": op6_secrets,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_ngram_join": op8_ngram_join,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_toxicity": op10_toxicity,
        "op11_turn_repair": op11_turn_repair,
        "op12_quality": op12_quality,
        "op13_alignment": op13_alignment,
    }


def llm_oracle_sql() -> dict[str, str]:
    return {
        "op3_chat": sql.chat(),
        "op4_decontamination": sql.decontamination(),
        "op8_ngram_join": sql.ngram_join(),
        "op11_turn_repair": sql.turn_repair(),
    }
