"""Groups of spelling variants: words one edit apart, found by walking a trie as a relation.

A state (word, place, node, edits) stands for a word that was read up to ``place`` on the
way to ``node`` of the trie, with at most one edit. Each round joins all states with the
table of edges, so that every state moves to the next node at once; a state with one edit
whose word is used up at the end of another word is a pair of neighbours.

Two tries, one of the words and one of the words read backwards, divide the work: an edit in
the second half of a word is found forwards, one in the first half backwards. So a walk
starts at the node of half a word, where few others are left, and no state ever stands at the
root, which all words would share. Chains of nodes without a fork are one edge, so rounds
grow with the forks on the way and not with the length of a word. Of the equal ways to drop
or add a letter within a run of the same letter only the last is walked.

Nodes are named by 128 bits of the text that leads to them; pairs are checked by their
distance in the end, and each is stored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.batches import passing, stored

# Letters of a word, lengths and numbers of a word that takes part, how much
# more frequent a form has to be, and one run in so many that loses a letter.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5
ONE_IN = 199

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def damaged(doc_id: Column, run: Column) -> Column:
    """The run without one letter where its digest says so."""
    digest = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (digest % F.char_length(run)).cast("int")
    less = F.concat(F.left(run, at), F.substr(run, at + 2))
    return F.when(digest % ONE_IN == 0, less).otherwise(run)


def occurrences(docs: DataFrame) -> DataFrame:
    """Every word of the texts with its number ``n``.

    Runs too short to become a word are not taken out of the text at all. A document
    without an id has the empty text in its place; a null text has no words.
    """
    runs = F.regexp_extract_all("text", F.lit(f"({LETTERS}{{{LEAST_LENGTH},}})"))
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    taken = docs.select(doc_id.alias("doc_id"), F.explode(runs).alias("run"))
    # Most runs are in lower case already, which is cheaper to see than to translate.
    small = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(
        F.translate("run", CAPITALS, CAPITALS.lower())
    )
    low = taken.select("doc_id", small.alias("run"))
    return low.groupBy(damaged(F.col("doc_id"), F.col("run")).alias("word")).agg(
        F.count("*").alias("n")
    )


def vocabulary(docs: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """Words that take part."""
    counted = occurrences(docs)
    return counted.where(
        (F.char_length("word") >= least_length) & (F.col("n") >= least_count)
    )


def spelled(words: DataFrame) -> DataFrame:
    """Each word in both directions, and from where on edits are looked for."""
    size = F.char_length("word")
    half = F.floor(size / 2).cast("int")
    forwards = F.struct(F.lit("f").alias("way"), F.col("word").alias("text"), half.alias("from"))
    backwards = F.struct(
        F.lit("b").alias("way"), F.reverse("word").alias("text"), (size - half).alias("from")
    )
    return words.select("id", F.inline(F.array(forwards, backwards)))


def places(texts: DataFrame, first: int) -> DataFrame:
    """The nodes on the way of each word, from ``first`` letters on; the code of the letter
    that follows, 0 at the end."""
    at = texts.withColumn(
        "place", F.explode(F.sequence(F.lit(first), F.char_length("text")))
    )
    prefix = F.concat("way", F.left("text", F.col("place")))
    letter = F.ascii(F.substr("text", F.col("place") + 1, F.lit(1)))
    return at.select(
        "id", "way", "place", F.unhex(F.md5(prefix)).alias("node"), letter.alias("letter")
    )


def forks(on_the_way: DataFrame) -> DataFrame:
    """Nodes where words part or end. ``ends`` is the word that ends there."""
    seen = on_the_way.groupBy("node").agg(
        F.min("letter").alias("low"), F.max("letter").alias("high"),
        F.max(F.when(F.col("letter") == 0, F.col("id"))).alias("ends"),
    )
    return seen.where((F.col("low") == 0) | (F.col("low") != F.col("high"))).select("node", "ends")


def edge_table(texts: DataFrame, on_the_way: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges out of each node, at most one for a letter of the alphabet, and where the
    walk of each word starts."""
    stops = on_the_way.join(forks(on_the_way), "node")
    ways = stops.groupBy("id", "way").agg(
        F.array_sort(F.collect_list(F.struct("place", "node", "ends", "letter"))).alias("stops")
    )
    known = stored(texts.join(ways, ["id", "way"]), "spelling-ways")
    steps = known.select(
        "text",
        F.inline(
            F.expr("transform(slice(stops, 1, size(stops) - 1), (s, i) -> named_struct("
                   "'node', s.node, 'ends', s.ends, 'letter', s.letter, 'place', s.place, "
                   "'last', stops[i + 1].place, 'child', stops[i + 1].node, "
                   "'word', stops[i + 1].ends))")
        ),
    )
    label = F.substr("text", F.col("place") + 1, F.col("last") - F.col("place"))
    flat = stored(
        steps.select("node", "ends", "letter", label.alias("label"), "child", "word")
        .dropDuplicates(["node", "letter"]),
        "spelling-edges",
    )
    # Which letters go on from a child: a state that none of them fits is not made at all.
    follow = flat.groupBy(F.col("node").alias("child")).agg(
        F.concat_ws("", F.collect_list(F.left("label", F.lit(1)))).alias("follow")
    )
    edge = F.struct(
        "letter", "label", F.substr("label", F.lit(2)).alias("tail"),
        F.char_length("label").alias("size"), "child", "word",
        F.coalesce("follow", F.lit("")).alias("follow"),
    )
    # A last letter too many ends where the state stands, over an edge without a label.
    stay = F.array(F.struct(
        F.lit(0).alias("letter"), F.lit("").alias("label"), F.lit("").alias("tail"),
        F.lit(0).alias("size"), F.col("node").alias("child"), F.col("ends").alias("word"),
        F.lit("").alias("follow"),
    ))
    onward = F.collect_list(edge)
    edges = flat.join(follow, "child", "left").groupBy("node", "ends").agg(onward.alias("onward"))
    edges = edges.select(
        "node",
        F.when(F.col("ends").isNull(), F.col("onward")).otherwise(F.concat("onward", stay)).alias("edges"),
    )
    starts = known.select(
        "id", "text", F.expr("filter(stops, s -> s.place >= from)[0]").alias("stop")
    ).where("stop IS NOT NULL")
    start = starts.select(
        "id", "text", F.col("stop.place").alias("place"), F.col("stop.node").alias("node"),
        F.lit(0).alias("edits"),
    )
    return stored(edges, "spelling-nodes"), start


# What an edge makes of a state: its next places with no edit, or with one edit by another
# letter, by a letter more in the trie or by a letter less. ``rest`` is the part of the word
# that is not yet read, ``later`` the same without its first letter.
MOVES = """array_compact(array(
  IF(size > 0 AND IF(edits = 1, startswith(rest, label), letter = code),
     named_struct('place', place + size, 'edits', edits), NULL),
  IF(edits = 0 AND letter <> code AND size > 0 AND rest <> '' AND startswith(later, tail),
     named_struct('place', place + size, 'edits', 1), NULL),
  IF(edits = 0 AND letter <> code AND size > 0 AND startswith(rest, tail),
     named_struct('place', place + size - 1, 'edits', 1), NULL),
  IF(edits = 0 AND letter <> code AND startswith(later, label) AND (size > 0 OR later = ''),
     named_struct('place', place + size + 1, 'edits', 1), NULL)))"""

# A state that goes on: with no edit anywhere, with one where a letter fits or a word ends.
GOES_ON = """edits = 0 OR IF(place < length(text),
  contains(follow, substr(text, place + 1, 1)), found IS NOT NULL)"""


def advanced(states: DataFrame, edges: DataFrame) -> DataFrame:
    """All states one node further. Those at the end of their word have the word that ends
    at their node in ``found``."""
    met = states.join(edges, "node").withColumns(
        {"rest": F.expr("substr(text, place + 1)"), "later": F.expr("substr(text, place + 2)")}
    )
    met = met.withColumn("code", F.ascii("rest"))
    return (
        met.select("id", "text", "place", "edits", "rest", "later", "code", F.inline("edges"))
        .withColumn("moves", F.expr(MOVES))
        .select("id", "text", F.col("child").alias("node"), F.col("word").alias("found"), "follow",
                F.inline("moves"))
        .where(GOES_ON)
        .select("id", "text", "place", "node", "edits", "found")
    )


def neighbours(words: DataFrame) -> DataFrame:
    """Pairs (id, other) of words exactly one edit apart, each in both directions.

    ``words`` has a unique ``id`` (long), ``word`` and ``n``, and is stored."""
    spark = words.sparkSession
    texts = spelled(words)
    shortest = words.agg(F.min(F.floor(F.char_length("word") / 2))).first()[0]
    empty = spark.createDataFrame([], "id bigint, other bigint")
    if shortest is None:
        return empty
    on_the_way = stored(places(texts, int(shortest)), "spelling-places")
    edges, states = edge_table(texts, on_the_way)
    pairs = []
    while True:
        moved = stored(advanced(states, edges), "spelling-states")
        over = (F.col("edits") == 1) & (F.col("place") == F.char_length("text"))
        pairs.append(moved.where(over).select("id", F.col("found").alias("other")))
        states = moved.where(~over).drop("found")
        if states.isEmpty():
            break
    found = pairs[0]
    for more in pairs[1:]:
        found = found.unionByName(more)
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """The last form of every word with a form: ``id`` and ``form`` in, ``root`` added.

    Forms grow in number with each step, so there are no rings; each round doubles the
    length of the ways that are followed."""
    reached = forms.select("id", F.col("form").alias("root"))
    while True:
        ahead = reached.select(F.col("id").alias("root"), F.col("root").alias("further"))
        both = stored(reached.join(ahead, "root", "left"), "spelling-roots")
        reached = both.select("id", F.coalesce("further", "root").alias("root"))
        if both.where("further IS NOT NULL").isEmpty():
            return reached


def grouped(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
) -> DataFrame:
    """Words of ``docs`` (``doc_id``, ``text``) with their form and root.

    ``word, n, n_near, form, form_n, root``: the form is the near word with the largest n,
    of several the first in the order of code points, if it is ``times`` as frequent. Null
    and empty texts have no words, an empty table no rows; repeated rows count each time;
    other columns are not looked at. Runs of fewer than ``LEAST_LENGTH`` letters are no words.
    """
    spark = docs.sparkSession
    with passing(spark):
        counted = vocabulary(docs, least_length, least_count)
        words = stored(
            stored(counted, "spelling-counts").withColumn("id", F.monotonically_increasing_id()),
            "spelling-words",
        )
        return _described(words, times)


def _described(words: DataFrame, times: int) -> DataFrame:
    own = words.select("id", F.col("word").alias("mine"))
    others = words.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = neighbours(words).join(others, "other").join(own, "id")
    sound = pairs.where(F.levenshtein("mine", "near", 1) == 1)
    best = sound.groupBy("id").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near", "other")).alias("best"),
    )
    rated = words.join(best, "id", "left")
    taken = -F.col("best.less") >= times * F.col("n")
    named = stored(
        rated.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(taken, F.col("best.near")).alias("form"),
            F.when(taken, -F.col("best.less")).alias("form_n"),
            F.when(taken, F.col("best.other")).alias("form_id"),
        ),
        "spelling-forms",
    )
    last = roots(named.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    texts = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    followed = named.join(last.join(texts, "root").select("id", "root_word"), "id", "left")
    result = followed.select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root_word", "word").alias("root")
    )
    return stored(result, "spelling-result", lasting=True)
