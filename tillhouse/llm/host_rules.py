"""Quality rules judged by host.

Rules are checked on every document, their failures are counted by host, and each host's
failure rates are shrunk towards the rates of all hosts by a beta prior that is fitted to
the hosts themselves. A host whose shrunk rate of some rule lies far out in the prior is
rejected, and the verdict goes back to its documents. Only built-in functions are used.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.batches import stored

# White space that ends a word, characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Bounds of the rules. A document with fewer words, or more than this share
# of words in repeated three-word windows, fails by itself; the others are rules by host.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
MOST_SYMBOLS_PER_WORD = 0.1
MOST_DUPLICATE_LINES = 0.3
WORD_LENGTHS = (2.0, 15.0)
#: A host is rejected if the shrunk share of its documents that fail some rule is more than
#: so many standard deviations of the rule's prior above the prior's mean, and this at least.
DEVIATIONS = 3.0
LEAST_FAILING = 0.2
#: A host's row in the join is repeated so often; its documents are dealt among them.
SALTS = 16

RULES = ("short", "repeated", "symbols", "lines", "lengths")


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """Figures of every whole text: doc_id, host, n_words, word_chars, n_symbols, n_lines
    (lines with a word), n_dup_lines, n_repeat_words. Null texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.col("doc_id"), F.col(host).cast("string").alias("host"), text.alias("text"),
        F.expr(rf"filter(split(coalesce(text, ''), r'{SPACE}'), w -> w <> '')").alias("words"),
    )
    lines = F.expr(r"filter(split(text, r'\n'), line -> line rlike r'[^\x20\x09-\x0D]')")
    windows = F.expr(
        "if(size(words) < 4, cast(array() as array<struct<hash:bigint,place:int>>), "
        "sort_array(zip_with(zip_with(slice(words, 1, size(words) - 2), "
        "slice(words, 2, size(words) - 2), (a, b) -> struct(a, b)), "
        "arrays_zip(slice(words, 3, size(words) - 2), sequence(0, size(words) - 3)), "
        "(ab, c) -> struct(xxhash64(ab.a, ab.b, c['0']) as hash, c['1'] as place))))"
    )
    shaped = base.select(
        "doc_id", "host", F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.concat_ws("", "words")).cast("bigint").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, "")))
        .cast("bigint").alias("n_symbols"),
        lines.alias("lines"), windows.alias("windows"),
    )
    # Places of windows equal to a neighbour in hash order.
    places = F.expr(
        "sort_array(transform(filter(zip_with(windows, zip_with("
        "concat(array(cast(null as bigint)), slice(windows.hash, 1, greatest(size(windows) - 1, 0))), "
        "concat(slice(windows.hash, 2, size(windows)), array(cast(null as bigint))), "
        "(before, after) -> struct(before, after)), (w, n) -> struct(w.place as place, "
        "w.hash <=> n.before or w.hash <=> n.after as twice)), x -> x.twice), x -> x.place))"
    )
    placed = shaped.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("windows") > 0, places).alias("places"),
    )
    covered = F.expr(
        "aggregate(places, struct(cast(0 as bigint) as words, -3 as last), (x, p) -> struct("
        "x.words + least(p - x.last, 3) as words, p as last), x -> x.words)"
    )
    return placed.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"),
    )


def failures() -> dict[str, Column]:
    """For each rule whether a measured document fails it."""
    words = F.col("n_words")
    length = F.try_divide(F.col("word_chars"), words)
    return {
        "short": words < LEAST_WORDS,
        "repeated": 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * words,
        "symbols": F.col("n_symbols") > MOST_SYMBOLS_PER_WORD * words,
        "lines": F.col("n_dup_lines") > MOST_DUPLICATE_LINES * F.col("n_lines"),
        "lengths": F.coalesce(~length.between(*WORD_LENGTHS), F.lit(True)),
    }


def host_rates(figures: DataFrame) -> DataFrame:
    """One row per host: documents, and per rule the failure rate shrunk by the prior.

    The prior of a rule is the beta distribution with the mean of all documents' rate and
    the strength that the spread of the hosts' rates suggests (method of moments, at least
    one document). Rows are (host, documents, rate_<rule>..., rejected).
    """
    flags = failures()
    hosts = figures.groupBy("host").agg(
        F.count(F.lit(1)).alias("documents"),
        *[F.sum(flags[rule].cast("bigint")).alias(rule) for rule in RULES],
    )
    # Weighted mean and variance of the hosts' rates: one row for all hosts.
    n = F.col("documents")
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("all"),
        F.sum(n.cast("double") * n).alias("squares"),
        *[F.sum(rule).alias(f"sum_{rule}") for rule in RULES],
        *[F.sum(F.col(rule).cast("double") * F.col(rule) / n).alias(f"sq_{rule}") for rule in RULES],
    ).first()
    rates, beyond = [], []
    for rule in RULES:
        mean, strength = prior(
            sums["hosts"], sums["all"] or 0, sums["squares"] or 0.0,
            sums[f"sum_{rule}"] or 0, sums[f"sq_{rule}"] or 0.0,
        )
        rates.append(((F.col(rule) + mean * strength) / (n + strength)).alias(f"rate_{rule}"))
        beyond.append(F.col(f"rate_{rule}") > bound(mean, strength))
    shrunk = hosts.select("host", "documents", *rates)
    return shrunk.withColumn("rejected", reduce(or_, beyond))


def bound(mean: float, strength: float) -> float:
    """Shrunk rate of a rule above which a host is rejected."""
    spread = math.sqrt(mean * (1 - mean) / (strength + 1))
    return max(LEAST_FAILING, mean + DEVIATIONS * spread)


def prior(hosts: int, total: int, squares: float, failed: int, scatter: float):
    """Mean and strength of the beta prior of one rule's failure rate. ``scatter`` is the
    sum of failures squared over documents, ``squares`` of documents squared, by host."""
    if not total:
        return 0.0, 1.0
    mean = failed / total
    room = total - squares / total
    chance = (hosts - 1) * mean * (1 - mean)
    between = (scatter - total * mean * mean - chance) / room if room > 0 else 0.0
    return mean, max(mean * (1 - mean) / max(between, 1e-6) - 1, 1.0)


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """Every document's figures, ``base_failed``, and ``kept``.

    A document is kept if it does not fail by itself and its host is not rejected. Null
    and empty texts have no words and fail; a null host is a host like any other; repeated
    rows count and are returned each; an empty table gives no rows.
    """
    figures = stored(measured(docs, host), "figures")
    flags = failures()
    base = flags["short"] | flags["repeated"]
    rejected = host_rates(figures).select(
        F.col("host").alias("judged"), "rejected",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    dealt = figures.withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
    ).alias("figures")
    same = F.col("host").eqNullSafe(F.col("judged")) & (
        F.col("figures.salt") == F.col("verdicts.salt")
    )
    return dealt.join(rejected.alias("verdicts"), same).select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~F.col("rejected")).alias("kept"),
    )
