"""The operators of this package as queries over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import (
    compression,
    dart_minhash,
    host_rules,
    language,
    main_text,
    packing,
    phrase_index,
    prefix_trie,
    secrets,
    sharding,
    spelling,
    tool_calls,
    url_templates,
)
from tillhouse.llm.batches import ready

Query = Callable[[SparkSession, str], DataFrame]

# The parameters of the queries.
TOKENIZER = "word_bpe_49k.json"
GOOD_FROM = 0.3
RULES = [
    url_templates.Rule("allow", "org", "/"),
    url_templates.Rule("block", "example.org", "/es/"),
    url_templates.Rule("block", "example.org", "/en/1"),
    url_templates.Rule("allow", "com", "/fr/"),
    url_templates.Rule("block", "com", "/de/"),
]
SCHEMAS = [  # tool, path, kind, required, choices, least, most
    ("search", "query", "string", True, None, None, None),
    ("search", "limit", "integer", True, None, 1.0, 400.0),
    ("search", "strict", "boolean", False, None, None, None),
    ("search", "filter", "object", False, None, None, None),
    ("search", "filter/turn", "integer", True, None, 0.0, 6.0),
    ("search", "filter/sizes", "array", False, None, None, None),
    ("search", "filter/sizes/[]", "string", False, ['"short"', '"long"'], None, None),
    ("lookup", "id", "integer", True, None, None, None),
    ("lookup", "fields", "array", False, None, None, None),
    ("lookup", "fields/[]", "string", False, None, None, None),
    ("count", "query", "string", True, None, None, None),
]
SCHEMA_COLUMNS = (
    "tool string, parameter string, kind string, required boolean, choices array<string>, "
    "least double, most double"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(ready(spark), sf_dir, "documents")


def held_out(of: int, remainder: int) -> Column:
    """Whether crc32 of the doc_id as text has the remainder; never for null ids."""
    return F.coalesce(language.remainder("doc_id", of) == remainder, F.lit(False))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return packing.packed(cut)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = phrase_index.build_index(documents(spark, sf_dir))
    found = phrase_index.find_items(index, table(spark, sf_dir, "benchmark"))
    hit = F.expr("aggregate(runs, 0L, (n, run) -> n + run.last - run.first + 1)")
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judged(documents(spark, sf_dir)).drop("host")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dart_minhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "class_id", "class_size")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    code = language.train(docs.where(~held_out(3, 1)))
    found = language.identify(docs.select("doc_id", "text"), code)
    return found.select("record.doc_id", "lang_pred", "score", "ambiguous").withColumn(
        "held_out", held_out(3, 1)
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    found = compression.score(docs.select("doc_id", "text"), compression.train(docs, labels))
    good = F.when(F.col("score") >= GOOD_FROM, 1).otherwise(0)
    return found.select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", good.alias("predicted")
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ratios = secrets.train(secrets.sampled_tokens(spark, docs))
    found = secrets.scan(docs, ratios)
    base = F.expr("filter(spans, x -> x.kind < 3)")
    counts = [
        F.expr(f"cast(size(filter(spans, x -> x.kind = {n})) as bigint) as n_{name}")
        for n, name in enumerate(secrets.KINDS[:3])
    ]
    return found.withColumn("base", base).select(
        "record.doc_id", *counts, F.sha2(secrets.written("base"), 256).alias("base_sha256"),
        secrets.written("spans").alias("spans"),
    )


def messages(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results made of all turns of conversations: every assistant turn calls a
    tool with its whole text, every other turn answers the call before it, whether there is
    one or not."""
    turn, size = F.col("turn"), F.coalesce(F.char_length("text"), F.lit(0))
    whole = F.to_json(F.struct(F.col("text").alias("x")))
    quoted = F.when(F.col("text").isNull(), '""').otherwise(
        F.substring(whole, F.lit(6), F.char_length(whole) - 6)
    )
    name = F.concat(F.lit("c"), turn.cast("string"))
    tool = F.when(size % 3 == 0, "search").when(size % 3 == 1, "lookup").otherwise("count")
    sizes = F.when(size % 4 == 0, '["short", 3]').when(size % 4 == 1, '["odd", "odd"]').otherwise(
        '["short", "long"]'
    )
    within = F.concat(
        F.when(size % 5 == 0, F.lit('"more": {}')).otherwise(F.concat(F.lit('"turn": '), turn.cast("string"))),
        F.lit(', "sizes": '), sizes,
    )
    arguments = (
        F.when(size % 11 == 5, F.concat(F.lit("not json "), "text"))
        .when(size % 3 == 0, F.concat(F.lit('{"query": '), quoted, F.lit(', "limit": '),
                                      size.cast("string"), F.lit(', "filter": {'), within, F.lit("}}")))
        .when(size % 3 == 1, F.concat(F.lit('{"id": '), F.when(size % 7 == 0, quoted).otherwise(
            turn.cast("string")), F.lit(', "fields": ['), quoted, F.lit("]}")))
        .otherwise(F.concat(F.lit('{ "query" :'), quoted, F.lit(',"extra":null }')))
    )
    earlier = F.expr("if(turn > 2 and char_length(text) % 2 = 0, "
                     "array(concat('c', cast(turn - 2 as string))), cast(array() as array<string>))")
    calls = conversations.where("role = 'assistant'").select(
        "conv_id", name.alias("call_id"), "turn", tool.alias("tool"),
        arguments.alias("arguments"), earlier.alias("after"),
    )
    content = F.when(size % 5 == 0, F.concat(F.lit('{"words": '), size.cast("string"),
                                             F.lit(', "said": '), quoted, F.lit("}")))
    results = conversations.where("not (role <=> 'assistant')").select(
        "conv_id", F.expr("concat('c', cast(turn - 1 as string))").alias("call_id"), "turn",
        content.otherwise(F.col("text")).alias("content"),
    )
    return calls, results


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = messages(table(ready(spark), sf_dir, "conversations"))
    schemas = spark.createDataFrame(SCHEMAS, SCHEMA_COLUMNS)
    log = tool_calls.tool_log(calls, results, schemas)
    return log.withColumn("errors", F.concat_ws(", ", "errors"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = sharding.read_shards(spark, sharding.write_shards(docs), docs)
    text, doc_id = F.col("record.text"), F.col("record.doc_id")
    return rows.select(
        doc_id.alias("doc_id"), sharding.record_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"), F.lit("key").alias("law"),
        "shard", F.col("slot").cast("bigint").alias("slot"),
        sharding.shard_of(doc_id, sharding.SHARDS + 1).alias("grown_shard"),
    )


def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.filtered(table(ready(spark), sf_dir, "pages"), RULES)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(ready(spark), sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extracted(pages, main_text.train(pages))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(ready(spark), sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(documents(spark, sf_dir).select("doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_host_rules": op3_host_rules,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_tool_calls": op8_tool_calls,
    "op9_shards": op9_shards,
    "op10_url_templates": op10_url_templates,
    "op11_main_text": op11_main_text,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling": op13_spelling,
    "pipeline": pipeline,
}
