"""One query per operator: the operator over its whole table, as the digest
columns of its contract. Each query gets its rows from the operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import audit, chat, decontaminate, embed_join, htmltext, jaccard, katz, langid, licenses, mixing, substrings, toxicity, treap
from staylens.llm.common import remainder, table, written


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    mixed = mixing.mix(written(docs, "mix-sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 7) == 2
    found = katz.score(docs, ~held_out)
    return found.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "cosine", "lcs", "answer", "first_word")


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "component_id")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = langid.learn_from(docs, ~held_out)
    return (docs.select("doc_id", held_out.alias("held_out"), langid.identify(docs, model).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    weights = htmltext.learn_weights(pages.select("page_id", "html"))
    return (htmltext.main_text(pages.select("page_id", "url", "html"), weights).drop("html")
            .withColumn("n_chars", F.length("text").cast("long")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 3) == 1
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~held_out))
    return (docs.select("doc_id", held_out.alias("held_out"), toxicity.scorer(model)("text").alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0)))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", "scan.*")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of `conversations` and the two of conversation -7, one JSON
    record a row: (conv_id, turn, record). The records of a conversation are
    either flat turns, nested messages, or system, prompt and completion
    records, as feeds of different origin are."""
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema))

    def record(**fields):
        return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"})

    kind, role, text = F.pmod("conv_id", F.lit(3)), F.col("role"), F.col("text")
    return rows.select("conv_id", "turn", F.when(kind == 1, record(message=F.struct(role.alias("role"), text.alias("content"))))
                       .when((kind == 2) & (role == "system"), record(system=text))
                       .when((kind == 2) & (role == "user"), record(prompt=text))
                       .when((kind == 2) & (role == "assistant"), record(completion=text))
                       .otherwise(record(role=role, text=text)).alias("record"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.canonical_turns(conversation_records(spark, sf_dir))
    return chat.digest(written(chat.assemble(chat.segments(turns)), "chat"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_katz": op2_katz,
    "op3_decontamination": op3_decontamination,
    "op4_jaccard": op4_jaccard,
    "op5_langid": op5_langid,
    "op6_toxicity": op6_toxicity,
    "op7_substrings": op7_substrings,
    "op8_embeddings": op8_embeddings,
    "op9_licenses": op9_licenses,
    "op10_html_text": op10_html_text,
    "op11_filter_audit": op11_filter_audit,
    "op12_chat_format": op12_chat_format,
    "op13_ranked_search": op13_ranked_search,
}
