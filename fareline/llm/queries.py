"""The numbered queries on whole tables, each by its operator, and comparison SQL where it exists."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm import ann, chat, decontam, dialogue, gnat, html, linedup, minhash, mixing, pieces, tokens, toxicity, warc
from fareline.llm.common import store, table
from fareline.llm.oracles import ORACLES  # noqa: F401


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, threshold=0.8).select("doc_id", "n_shingles", "component_id", "kept")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "start_word", "end_word")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    formatted, _ = store(chat.format_conversations(told.unionByName(more)), "op5-formatted")
    return chat.digests(formatted)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized, _ = store(mixing.sized(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "rk"), "op9-sizes")
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    return linedup.repeated_runs(docs).drop("rid")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations")
    return dialogue.repaired(dialogue.damage(told), told)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat.compress(table(spark, sf_dir, "embeddings"))


_ALL = (
    op1_minhash_dedup, op2_decontamination, op3_toxicity, op4_warc, op5_chat_masks, op6_token_files, op7_main_text, op8_nearest, op9_mixing, op10_line_dedup,
    op11_sentencepiece, op12_conversation_repair, op13_vector_codes,
)
QUERIES = {f.__name__: f for f in _ALL}
