"""Secrets in texts: fixed patterns, and strings that look random.

Two Markov models of character pairs, one of random strings and one of ordinary words and
identifiers, are trained from labelled samples. A long token whose log-likelihood ratio is
high enough is a secret too. Only built-in functions are used: positions of matches follow
from the lengths of the pieces between them, and the ratio is looked up pair by pair.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The patterns of the base, and the least length of what each must match.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
LEAST_VALUE, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "random")

# First and number of the characters in the table of pairs (+ to z).
FIRST_CHARACTER, CHARACTERS = 43, 80
#: Sampled tokens of each label, at most, and documents that tokens are sampled from.
SAMPLE = 20_000
SAMPLE_DOCUMENTS = 5_000
#: Documents that pass the threshold of the draw, for each one that is wanted.
DRAWN = 4
#: Mean log-likelihood ratio of a pair, and of the whole token, from which it is a secret.
LEAST_MEAN, LEAST_RATIO = 0.3, 8.0
#: Entries of a list that are summed up at once.
BLOCK = 64


def spans_of(text: str, pattern: str, group: int = 0) -> str:
    """SQL of all matches in the column ``text``: array of (start, end, value), end
    exclusive, in code points. What lies between matches gives their places."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return (
        f"zip_with(slice(split({text}, '{quoted}', -1), 1, "
        f"size(regexp_extract_all({text}, '{quoted}', 0))), "
        f"arrays_zip(regexp_extract_all({text}, '{quoted}', 0), "
        f"regexp_extract_all({text}, '{quoted}', {group})), "
        "(gap, m) -> struct(char_length(gap) as gap, char_length(m['0']) as length, "
        "m['1'] as value))"
    )


def placed(column: str) -> str:
    """SQL that turns gaps and lengths into starts and ends. Running sums are taken within
    blocks and over the blocks' totals, so long lists cost little more than short ones."""
    empty = "cast(array() as array<struct<start:int,end:int,value:string>>)"
    blocks = (
        f"transform(sequence(0, (size({column}) - 1) div {BLOCK}), "
        f"b -> slice({column}, cast(b as int) * {BLOCK} + 1, {BLOCK}))"
    )
    within = (
        f"aggregate(block, struct(x.at as at, {empty} as spans), (y, m) -> struct("
        "y.at + m.gap + m.length as at, concat(y.spans, array(struct("
        "y.at + m.gap as start, y.at + m.gap + m.length as end, m.value as value))) as spans))"
    )
    nested = "cast(array() as array<array<struct<start:int,end:int,value:string>>>)"
    return (
        f"if({column} is null or size({column}) = 0, {empty}, flatten(aggregate({blocks}, "
        f"struct(0 as at, {nested} as all), (x, block) -> transform(array({within}), "
        "s -> struct(s.at as at, concat(x.all, array(s.spans)) as all))[0], x -> x.all)))"
    )


# --- model -------------------------------------------------------------------------


def pairs_of(token: str) -> str:
    """SQL of the indices of a token's neighbouring characters in the table of pairs."""
    codes = f"transform(split({token}, ''), c -> ascii(c) - {FIRST_CHARACTER})"
    return (
        f"transform(array({codes}), q -> zip_with(slice(q, 1, size(q) - 1), "
        f"slice(q, 2, size(q) - 1), (a, b) -> a * {CHARACTERS} + b))[0]"
    )


def train(samples: DataFrame) -> list[int]:
    """Log-likelihood ratio of each pair of characters, in thousandths, from labelled
    samples: rows of (token, random), random true or false.

    Every pair is counted once more than it is seen. Null tokens or labels, and characters
    outside the table, teach nothing; without samples all ratios are 0.
    """
    pair = F.explode(F.expr(pairs_of("token"))).alias("pair")
    kept = samples.where("token is not null and random is not null and char_length(token) > 1")
    counts: dict[bool, dict[int, int]] = {True: {}, False: {}}
    cells = CHARACTERS * CHARACTERS
    for row in kept.select("random", pair).groupBy("random", "pair").count().where(
        f"pair >= 0 and pair < {cells}"
    ).collect():  # at most two tables of pairs
        counts[row["random"]][row["pair"]] = row["count"]
    table = []
    for first in range(CHARACTERS):
        total = {
            kind: sum(counts[kind].get(first * CHARACTERS + b, 0) for b in range(CHARACTERS))
            for kind in counts
        }
        for second in range(CHARACTERS):
            cell = first * CHARACTERS + second
            like = {
                kind: (counts[kind].get(cell, 0) + 1) / (total[kind] + CHARACTERS)
                for kind in counts
            }
            table.append(round(1000 * math.log(like[True] / like[False])))
    return table


def ratio_of(token: str, table: list[int]) -> str:
    """SQL of a token's log-likelihood ratio: positive if it is rather random."""
    values = f"from_json('{table}', 'array<int>')"
    return (
        f"aggregate({pairs_of(token)}, 0L, (sum, p) -> sum + "
        f"coalesce(get({values}, p), 0)) / 1000D"
    )


def sampled_tokens(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Labelled samples: hashes written in common alphabets are random, and words of
    documents, plain or joined as identifiers are, ordinary. At most ``SAMPLE`` of each,
    from the ``SAMPLE_DOCUMENTS`` different documents with the smallest hashes.

    Only documents whose hash is below a threshold that some ``DRAWN`` times as many pass are
    split and sorted, and repeated rows shrink to one before; so what meets in one task stays
    as small for any table. Null texts and texts without words are not drawn; where few
    documents differ the sample is smaller, and an empty table gives random strings only."""
    number = F.col("id").cast("string")
    base64 = F.base64(F.unhex(F.sha2(F.concat(F.lit("random "), number), 512)))
    letters = F.regexp_replace(base64, "[+/=]", "")
    random = spark.range(SAMPLE).select(
        F.when(F.col("id") % 4 == 0, base64)
        .when(F.col("id") % 4 == 1, F.upper(letters))
        .when(F.col("id") % 4 == 2, F.lower(letters))
        .otherwise(letters).alias("token"),
        F.lit(True).alias("random"),
    )
    words = F.expr("filter(split(text, '[^A-Za-z]+'), w -> char_length(w) > 2)")
    each = SAMPLE // SAMPLE_DOCUMENTS
    neighbours = F.expr(
        f"transform(sequence(1, {each}), j -> struct(xxhash64(hash, j) as order, "
        "get(words, cast(pmod(xxhash64(hash, j), size(words)) as int)) as one, "
        "coalesce(get(words, cast(pmod(xxhash64(hash, j), size(words)) as int) + 1), '') as two))"
    )
    share = min(1.0, DRAWN * SAMPLE_DOCUMENTS / max(docs.count(), 1))
    below = int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1
    hashed = docs.where("text is not null").select(
        F.xxhash64("doc_id", "text").alias("hash"), "text"
    ).where(F.col("hash") <= F.lit(below))
    some = hashed.groupBy("hash").agg(F.max("text").alias("text")).select(
        "hash", words.alias("words")
    ).where("size(words) > 0").select("hash", neighbours.alias("few"))
    few = some.orderBy("hash").limit(SAMPLE_DOCUMENTS).select(F.inline("few"))
    joined = (
        F.when(F.col("order") % 8 == 0, F.concat_ws("_", "one", "two"))
        .when(F.col("order") % 8 == 1, F.concat_ws("-", "one", "two"))
        .when(F.col("order") % 8 == 2, F.concat("one", F.initcap("two")))
        .when(F.col("order") % 8 == 3, F.concat_ws("_", F.upper("one"), F.upper("two")))
        .when(F.col("order") % 8 == 4, F.concat_ws("/", "one", "two", F.abs("order") % 100))
        .otherwise(F.concat("one", "two"))
    )
    ordinary = few.select(joined.alias("token"), F.lit(False).alias("random"))
    return random.unionByName(ordinary)


# --- scan --------------------------------------------------------------------------


def scan(docs: DataFrame, table: list[int]) -> DataFrame:
    """All columns of the frame in the struct ``record``, and ``spans``: array of (start,
    kind, end), kind a number in ``KINDS``, ordered by start, then kind.

    Null and empty texts have no spans. Repeated rows are scanned one by one. Spans of
    different kinds may overlap; tokens that are all of a base match's hex are not repeated.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
                       text.alias("text"))

    def found(pattern: str, group: int = 0) -> Column:
        return F.when(F.col("text").rlike(pattern), F.expr(spans_of("text", pattern, group)))

    gaps = rows.select(
        "record", found(ASSIGN, 2).alias("assign"), found(ACCESS).alias("access"),
        found(HEX).alias("hex"), found(TOKEN).alias("random"),
    )
    spans = gaps.select(
        "record", *[F.expr(placed(kind)).alias(kind) for kind in KINDS]
    )
    ratio, pairs = ratio_of("x.value", table), "(char_length(x.value) - 1)"
    tests = {
        "assign": f"char_length(x.value) >= {LEAST_VALUE}",
        "access": f"char_length(x.value) >= {LEAST_ACCESS}",
        "hex": "true",
        "random": f"not x.value rlike '^[0-9a-f]+$' and not x.value rlike '^AKIA[A-Z0-9]+$' "
        f"and exists(array({ratio}), r -> r >= {LEAST_RATIO} and r >= {LEAST_MEAN} * {pairs})",
    }
    kept = [
        f"transform(filter({kind}, x -> {test}), "
        f"x -> struct(x.start as start, {number} as kind, x.end as end))"
        for number, (kind, test) in enumerate(tests.items())
    ]
    return spans.select("record", F.expr(f"sort_array(concat({', '.join(kept)}))").alias("spans"))


def written(spans: str) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = ", ".join(f"'{kind}'" for kind in KINDS)
    return F.expr(
        f"concat_ws(',', transform({spans}, x -> concat_ws(':', array({names})[x.kind], "
        "cast(x.start as string), cast(x.end as string))))"
    )


def redacted(docs: DataFrame, table: list[int], mark: str = "[secret]") -> DataFrame:
    """The documents in their own columns, each run of secret characters replaced by the
    mark; ``n_chars``, if there is such a column, follows the text."""
    scanned = scan(docs, table)
    joined = F.expr(
        "aggregate(spans, struct(0 as at, cast(array() as array<string>) as parts), (x, s) -> "
        "if(s.end <= x.at, x, struct(s.end as at, concat(x.parts, "
        "if(s.start < x.at, array(), array(substring(record.text, x.at + 1, s.start - x.at), "
        f"'{mark}'))) as parts)), x -> concat(concat_ws('', x.parts), "
        "substring(record.text, x.at + 1)))"
    )
    changed = F.when(F.size("spans") > 0, joined).otherwise(F.col("record.text"))
    new = scanned.select("record", changed.alias("new"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("new").alias("text"))
        elif name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            length = F.char_length("new").cast(kind)
            same = F.col("new").eqNullSafe(F.col("record.text"))
            columns.append(F.when(same, F.col("record.n_chars")).otherwise(length).alias("n_chars"))
        else:
            columns.append(F.col(f"record.`{name}`").alias(name))
    return new.select(*columns)
