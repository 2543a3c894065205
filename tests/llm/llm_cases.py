"""Small frames with the cases every operator must handle."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wizards brew strong tea and "
    "argue about maps of distant islands where nobody has ever been before today "
)


def documents(spark, rows):
    """Documents of (doc_id, text) or whole rows."""
    whole = [
        row if len(row) == 5 else (*row, "en", "host", None if row[1] is None else len(row[1]))
        for row in rows
    ]
    return spark.createDataFrame(whole, DOCS)


def awkward(spark):
    """Nulls in every column, empty, repeated, very long and tied texts, and a clash of
    names with what operators add."""
    long = " ".join(f"w{i % 9000}x" for i in range(60_000))
    rows = [
        (1, PROSE * 3, "en", "a", 10), (2, None, None, None, None), (3, "", "en", "a", 0),
        (None, PROSE * 3, None, "b", 10), (4, long, "en", "a", 5), (5, " \n\t ", "de", "b", 4),
        (6, "!!! ... ###", "en", "a", 11), (6, "!!! ... ###", "en", "a", 11),
        (7, "word", "en", None, 4), (1, PROSE * 3, "en", "a", 10), (8, "ÄÖÜ ñandú 日本語 😀", "de", "b", 9),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("score", "node", "bucket", "shard", "spans", "segment", "rank", "size", "label"):
        docs = docs.selectExpr("*", f"'clash' as {name}")
    return docs


def rows_of(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
