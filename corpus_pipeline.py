"""Training sequences from raw documents, stage by stage.

Every stage but the last takes documents and returns documents, in the same columns; each
is written as Parquet and read again before the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillhouse.llm import dart_minhash, language, packing, phrase_index, secrets
from tillhouse.llm.batches import ready, stored

TOKENIZER = "word_bpe_49k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of one of the learned languages. Texts without a letter, null texts and
    texts between two languages go. Learned from the labelled ones among the documents;
    where none is labelled, none is recognised. Repeated rows stay or go together, an empty
    table stays empty, and every column keeps its values whatever its name."""
    ready(spark)
    return language.recognised(docs, language.train(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, chosen by the label of the class.
    Repeated rows are one class, so one of them stays; a null text counts as an empty one. An
    empty table stays empty."""
    ready(spark)
    return dart_minhash.deduplicated(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row, nor a whole short item, with the
    benchmark. Null and empty texts share nothing and stay; ids may be null or repeated,
    since a row is known by its id and its text. With an empty benchmark all stay."""
    ready(spark)
    return phrase_index.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts replaced by a mark. A null text stays null,
    an empty one empty; repeated rows are treated alike; an empty table stays empty."""
    ready(spark)
    ratios = secrets.train(secrets.sampled_tokens(spark, docs))
    return secrets.redacted(docs, ratios)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences. A null text is
    packed as an empty one, which is its end mark; repeated rows are packed each; an empty
    table has no pieces."""
    ready(spark)
    return packing.packed(packing.pieces(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", not_in_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Language models and signatures are learned and drawn, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents to the packed pieces."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
