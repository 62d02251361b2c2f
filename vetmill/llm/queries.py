"""The queries of this subpackage: (spark, sf_dir) -> DataFrame, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetmill.llm import bpe, collocations, curves, html, langid, lm, minhash, multi_index, oracles, packing, pii, prefix_trie, secrets, toxicity
from vetmill.llm.common import fold, table

#: Tokenizer files of the installed package; a parameter of the operators, never copied.
WORD_BPE, BYTE_BPE, MANY_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"
#: Tokens in a packed sequence; groups that the pieces of one length are dealt over.
SEQUENCE, BUCKETS = 2048, 64


def tokenizer(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 7) == 2
    return lm.score_documents(_read(spark, sf_dir, "documents"), held_out, tokenizer(BYTE_BPE), "lang")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, labels, held_out)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out)
    return toxicity.score(docs, model, ["doc_id", "held_out"])


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_read(spark, sf_dir, "documents"), tokenizer())


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_read(spark, sf_dir, "documents")))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_read(spark, sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_read(spark, sf_dir, "documents")))


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"))


def packed(docs: DataFrame, most: int | None = packing.FILLINGS) -> DataFrame:
    """Documents packed into sequences: pieces with their place (see op9_packing); most: as in packing.pack.

    A null or empty text is its end token alone, a long one as many pieces as it needs; each of equal rows has
    pieces of its own; an empty table gives no rows; columns beside doc_id and text are left aside."""
    pieces = table(bpe.document_pieces(docs, tokenizer(), SEQUENCE, BUCKETS), "pieces")
    return packing.pack(pieces, SEQUENCE, ["doc_id", "piece", "ids_crc32"], BUCKETS, most)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packed(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32",
                      "sequence_id", "offset")


def op10_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.nearest(_read(spark, sf_dir, "embeddings"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_read(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.train(docs, held_out, tokenizer(MANY_BPE))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out)
    return langid.predict(docs, model, ["doc_id", "held_out"])


QUERIES = {"op1_lattice": op1_lattice, "op2_toxicity": op2_toxicity, "op3_bpe": op3_bpe, "op4_secrets": op4_secrets, "op5_html": op5_html, "op6_pii": op6_pii, "op7_multi_index": op7_multi_index, "op8_minhash": op8_minhash, "op9_packing": op9_packing, "op10_curves": op10_curves,
           "op11_prefix_trie": op11_prefix_trie, "op12_collocations": op12_collocations, "op13_language": op13_language}
#: Models, tokenizers, page parsing and approximate search are beyond SQL; their tests hold them
#: against brute force.
ORACLES: dict[str, str] = {
    "op4_secrets": oracles.secrets(secrets.RULES, secrets.BASE),
    "op7_multi_index": oracles.NEAR_VECTORS,
    "op8_minhash": oracles.NEAR_TEXTS,
    "op11_prefix_trie": oracles.PREFIX_TRIE,
    "op12_collocations": oracles.COLLOCATIONS,
}
