"""Line dedup: later copies of repeated runs of lines go, found over all documents.

The corpus is a sequence of line IDs, document after document (by ``doc_id``, then a
hash of the text), blank lines left out.  Its suffixes are sorted by prefix
doubling: at level *k* every suffix has the name of its first 2**k lines, and a
level's names come from pairs of the one before.  A name is the first place where
those lines stand, so the suffixes of one name are an interval of the suffix
array whose longest common prefix is at least 2**k, and its first suffix is known.

A run is worth deleting if it has at least ``MIN_WORDS`` words.  Every such
repeated run is covered by windows that just reach that many words, looking forward
or backward from one of its lines.  A window of n lines, 2**k <= n < 2**(k+1),
has the two names of level k at its start and 2**k lines before its end, which
together say whether it stood before.  As every line has a word, no window
needs more than ``MIN_WORDS`` lines, so a few levels settle runs of any length.

Groups are reduced before they are joined back (a join that Spark splits when
one line holds a large part of all), and lines never meet in pairs.

Defined results: the first copy of a run always stays; a null text stays null and
has no lines; a document all of whose lines with words go gets an empty text; blank
lines next to deleted ones stay; rows with equal ``doc_id`` and text are one
document, all of them get its text; a null ``doc_id`` comes first; extra columns are
kept as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.core import materialize

#: Words of the shortest repeated run that is deleted.
MIN_WORDS = 10
_BLANK = r"[\x20\x09-\x0D]"
_DOC = ["doc_id", "text_hash"]


def _words(line: Column, least: int) -> Column:
    """Number of words, up to ``least``."""
    return F.least(F.size(F.array_remove(F.split(line, f"{_BLANK}+", least + 2), "")), F.lit(least))


def _same_doc(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])


def line_table(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_hash, lines``: per document its lines with words as (line number, ID, words up to ``min_words``)."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    full = F.filter(lines, lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))
    coded = F.transform(full, lambda s: F.struct(s["line"].alias("line"), F.unhex(F.md5(s["x"])).alias("id"), _words(s["x"], min_words).alias("w")))
    own = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), coded.alias("lines"))
    return materialize(own.where(F.size("lines") > 0), "lines")


def _window(lines: str, at: Column, n: int, forward: bool) -> Column:
    """Lines of the shortest window from the line at ``at`` (forward or backward) that has ``n`` words; 0 if none has."""
    if forward:
        own = F.slice(F.col(lines), at + 1, n)
    else:
        own = F.reverse(F.slice(F.col(lines), F.greatest(at + 2 - n, F.lit(1)), F.least(at + 1, F.lit(n))))
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))
    grow = F.aggregate(
        own,
        start,
        lambda acc, s: F.when(acc["words"] >= n, acc).otherwise(F.struct((acc["words"] + s["w"]).alias("words"), (acc["lines"] + 1).alias("lines"))),
    )
    return F.when(grow["words"] >= n, grow["lines"]).otherwise(0)


def _place() -> Column:
    return F.struct("doc_id", "text_hash", "pos")


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs at several places, with ``name``: the first of them."""
    groups = rows.groupBy(*keys).agg(F.min(_place()).alias("name"), F.max(_place()).alias("last"))
    groups = groups.where("name != last").drop("last")
    return rows.join(groups, keys)


def _at(rows: DataFrame, names: DataFrame, shift: Column, alias: str) -> DataFrame:
    """``rows`` with the name that ``names`` has in the same document ``shift`` lines further; others go."""
    there = names.select(F.col("doc_id").alias("d2"), F.col("text_hash").alias("h2"), F.col("pos").alias("p2"), F.col("name").alias(alias))
    on = F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("text_hash") == F.col("h2")) & (F.col("pos") + shift == F.col("p2"))
    return rows.join(there, on).drop("d2", "h2", "p2")


def with_windows(table: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """:func:`line_table` with each document once, and with ``ahead, back`` for each line: lines of its shortest windows."""
    windows = F.transform(
        "lines",
        lambda s, i: F.struct(
            s["line"].alias("line"), s["id"].alias("id"), s["w"].alias("w"),
            _window("lines", i, min_words, True).alias("ahead"), _window("lines", i, min_words, False).alias("back"),
        ),
    )
    return materialize(table.dropDuplicates(_DOC).select(*_DOC, windows.alias("lines")), "windows")


def later_copies(table: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_hash, pos``: lines of :func:`with_windows` (numbered among lines with words) inside later copies, each once."""
    rows = table.select(*_DOC, F.posexplode("lines").alias("pos", "l")).select(*_DOC, "pos", "l.id", "l.w", "l.ahead", "l.back")
    names = materialize(_named(rows, ["id"]).drop("id"), "names")  # level 0
    found = [names.where((F.col("w") >= min_words) & (F.col("name") != _place())).select(*_DOC, "pos")]
    short = names.where(F.col("w") < min_words)
    ahead = short.where("ahead > 1").select(*_DOC, "pos", F.col("ahead").alias("n"))
    back = short.where("back > 1").select(*_DOC, (F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("n"))
    windows = materialize(ahead.union(back).distinct(), "windows")
    names, width = names.select(*_DOC, "pos", "name"), 1
    while 2 * width <= min_words:
        pairs = _at(names.withColumnRenamed("name", "left"), names, F.lit(width), "right")
        names = materialize(_named(pairs, ["left", "right"]).select(*_DOC, "pos", "name"), "names")
        width *= 2
        own = windows.where(F.col("n").between(width, 2 * width - 1))
        own = _at(_at(own, names, F.lit(0), "left"), names, F.col("n") - width, "right")
        copies = _named(own, ["n", "left", "right"]).where(F.col("name") != _place())
        found.append(copies.select(*_DOC, F.explode(F.sequence("pos", F.col("pos") + F.col("n") - 1)).alias("pos")))
    return reduce(DataFrame.union, found).distinct()


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies deleted from ``text``, and ``n_lines, n_deleted`` (lines with words)."""
    table = with_windows(line_table(docs, min_words), min_words)
    gone = later_copies(table, min_words).groupBy(*_DOC).agg(F.collect_list("pos").alias("gone"))
    every = table.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("lines.line").alias("line"))
    on = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash"))
    cuts = every.join(gone, on, "left").select(
        "d", "h", F.size("line").cast("long").alias("n_lines"), F.transform("gone", lambda p: F.get("line", p)).alias("cut")
    )
    cuts = materialize(cuts.toDF("__d", "__h", "__n", "__cut"), "cuts")
    own = docs.withColumn("__hash", F.xxhash64("text"))
    own = own.join(cuts, F.col("__d").eqNullSafe(F.col("doc_id")) & (F.col("__h") == F.col("__hash")), "left")
    own = own.withColumn("__lines", F.when(F.size("__cut") > 0, F.split("text", "\n", -1)))
    keep = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__cut"))
    text = F.array_join(F.transform(keep, lambda i: F.get("__lines", i)), "\n")
    # a document without any line left has no use for its blank ones
    text = F.when(F.size("__cut") == F.col("__n"), F.lit("")).when(F.size("__cut") > 0, text).otherwise(F.col("text"))
    counts = [F.coalesce("__n", F.lit(0)).cast("long").alias("n_lines"), F.greatest(F.coalesce(F.size("__cut"), F.lit(0)), F.lit(0)).cast("long").alias("n_deleted")]
    return own.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_deleted")], *counts)
