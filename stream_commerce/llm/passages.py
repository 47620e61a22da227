"""Repeated lines and paragraphs, found by the hash of their normalised text.

A document is cut into units at line breaks. A unit is normalised (trimmed, white space runs as one
space, without case) and known by a 128-bit digest. Digests are grouped over the whole corpus; the
occurrence with the smallest (doc_id, unit number) stays and all others are removed. Only digests,
ids and offsets are shuffled, never texts; the minimum is combined map-side, and the join back is a
plain equi-join that Spark splits where one unit has very many occurrences.

`shared_runs` looks at finer units, sentences, and from both ends: how many words the longest run of sentences
has that other documents hold too, whichever of them came first.

Units of fewer than `min_words` words are no passages and stay. Offsets are characters of the original
text: a removed unit covers [start, end) without its line break.

Defined cases: a null or empty text has one empty unit, which stays; rows that repeat a doc_id are
ranked by their text's hash, and equal rows keep their units in the one that comes first (their rows
are told apart by `copy`); a null doc_id ranks last; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stream_commerce.llm.shared import saved, texts

MIN_WORDS = 8


def normalised(unit: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(unit, r"[ \t\x0B\f\r]+", " ")))


def units(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, copy, unit, start, end, words, digest): one row per line of every whole text.

    `copy` numbers the rows that share a doc_id; it is 0 where ids are unique.
    """
    rows = _numbered(texts(documents, id_col, text_col))
    lines = rows.select("doc_id", "copy", F.split("text", "\n").alias("lines"))
    # End of each line in the text: running sum of the lengths and the breaks between them.
    cut = lines.select("doc_id", "copy", F.posexplode("lines").alias("unit", "line"))
    plain = normalised(F.col("line"))
    sized = cut.select(
        "doc_id", "copy", "unit", F.char_length("line").alias("chars"), plain.alias("plain"))
    words = F.when(F.col("plain") == "", 0).otherwise(
        F.char_length("plain") - F.char_length(F.replace("plain", F.lit(" "))) + 1)
    return sized.select(
        "doc_id", "copy", "unit", "chars", words.alias("words"), F.unhex(F.md5("plain")).alias("digest"))


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with `copy`, which tells rows of one doc_id apart."""
    return rows.withColumn("copy", F.lit(0)) if not _repeats(rows) else rows.withColumn(
        "copy", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")) - 1)


def _repeats(rows: DataFrame) -> bool:
    return not rows.groupBy("doc_id").count().filter("count > 1").isEmpty()


def occurrences(documents: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The units of all documents with `kept` and, for removed ones, where the kept one is."""
    rows = saved(units(documents, id_col, text_col), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "copy", "unit")
    firsts = rows.filter(F.col("words") >= min_words).groupBy("digest").agg(
        F.min(rank).alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("digest").alias("d"), "first")
    joined = rows.join(firsts, (F.col("digest") == F.col("d")) & (F.col("words") >= min_words), "left")
    kept = F.col("first").isNull() | F.col("first").eqNullSafe(rank)
    return joined.select(
        "doc_id", "copy", "unit", "chars", "words", kept.alias("kept"),
        F.when(~kept, F.col("first.doc_id")).alias("first_doc"),
        F.when(~kept, F.col("first.unit")).alias("first_unit"))


def removed(documents: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, copy, n_units, n_removed, chars_removed, removed.

    `removed` lists (unit, start, end, first_doc, first_unit) in order; start and end are characters
    of the original text.
    """
    rows = occurrences(documents, min_words, id_col, text_col)
    before = Window.partitionBy("doc_id", "copy").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum(F.col("chars") + 1).over(before), F.lit(0)))
    entry = F.struct("unit", "start", (F.col("start") + F.col("chars")).alias("end"), "first_doc", "first_unit")
    gone = ~F.col("kept")
    return placed.groupBy("doc_id", "copy").agg(
        F.count("*").alias("n_units"), F.count_if(gone).alias("n_removed"),
        F.coalesce(F.sum(F.when(gone, F.col("chars"))), F.lit(0)).alias("chars_removed"),
        F.sort_array(F.collect_list(F.when(gone, entry))).alias("removed"))


def deduplicated(documents: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, copy, text, spans): what is left of each text, with the original [start, end) of
    every piece of it; pieces are joined by line breaks."""
    gone = removed(documents, min_words, id_col, text_col).select(
        F.col("doc_id").alias("d"), F.col("copy").alias("c"), "removed")
    rows = texts(documents, id_col, text_col).withColumn(
        "copy", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")) - 1)
    both = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c")))
    length = F.char_length("text")
    starts = F.concat(F.array(F.lit(0)), F.transform("removed.end", lambda x: (x + 1).cast("int")))
    ends = F.concat(F.transform("removed.start", lambda x: (x - 1).cast("int")), F.array(length))
    pieces = F.filter(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda s: s["start"] <= s["end"])
    return both.withColumn("spans", pieces).select(
        "doc_id", "copy",
        F.array_join(F.transform("spans", lambda s: F.substring("text", s["start"] + 1, s["end"] - s["start"])), "\n").alias("text"),
        "spans")


_SPACE = r"[ \t\x0B\f\r]"


def sentences(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, copy, unit, words, hash): the sentences of every text, normalised; a line break ends one too.

    Sentences are known by a 64-bit hash; below 10^9 different ones a collision is unlikely.
    """
    rows = _numbered(texts(documents, id_col, text_col))
    plain = F.regexp_replace("text", rf"^[ \t\x0B\f\r\n]+|[ \t\x0B\f\r\n]+\z", "")
    plain = F.regexp_replace(plain, rf"{_SPACE}*\n[ \t\x0B\f\r\n]*", "\n")
    plain = F.regexp_replace(plain, rf"([.!?]){_SPACE}+", "$1\n")
    plain = F.lower(F.regexp_replace(plain, rf"{_SPACE}+", " "))
    cut = rows.select("doc_id", "copy", F.posexplode(F.split(plain, "\n")).alias("unit", "plain")).filter("plain <> ''")
    words = F.char_length("plain") - F.char_length(F.replace("plain", F.lit(" "))) + 1
    return cut.select("doc_id", "copy", "unit", words.alias("words"), F.xxhash64("plain").alias("hash"))


def shared_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, copy, shared_words): the words of the longest run of sentences that all occur in another
    document too; documents without one have no row."""
    rows = saved(sentences(documents, id_col, text_col), "sentences")
    who = F.struct("doc_id", "copy")
    several = rows.groupBy("hash").agg(F.min(who).alias("low"), F.max(who).alias("high")).filter("low <> high").select(
        F.col("hash").alias("h"))
    hits = rows.join(several, F.col("hash") == F.col("h"), "left_semi")
    place = F.row_number().over(Window.partitionBy("doc_id", "copy").orderBy("unit"))
    runs = hits.withColumn("run", F.col("unit") - place).groupBy("doc_id", "copy", "run").agg(F.sum("words").alias("words"))
    return runs.groupBy("doc_id", "copy").agg(F.max("words").alias("shared_words"))
