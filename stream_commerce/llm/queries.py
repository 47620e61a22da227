"""The registered query of each operator of this subpackage, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stream_commerce.config import new_work_dir
from stream_commerce.llm import (
    alignment, chat, decontaminate, fingerprints, licences, lines, minmax, mixing, neighbours, passages, repair, token_files, toxicity,
)
from stream_commerce.llm.shared import read, with_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        fn = with_path(fn)
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
  with recursive w as (
    select doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') ws from documents),
  s as (
    select distinct doc_id, case when len(ws) = 1 then ws[1] else ws[i] || ' ' || ws[i + 1] end sh
    from (select doc_id, ws, unnest(range(1, greatest(len(ws), 2))) i from w where len(ws) > 0)),
  n as (select doc_id, count(*) n from s group by 1),
  e as (
    select p.a, p.b from (
      select x.doc_id a, y.doc_id b, count(*) c from s x join s y on x.sh = y.sh and x.doc_id < y.doc_id
      group by 1, 2) p join n na on na.doc_id = p.a join n nb on nb.doc_id = p.b
    where 100 * c >= 80 * (na.n + nb.n - c)),
  b as (select a, b from e union all select b, a from e),
  r(doc_id, o) as (
    select doc_id, doc_id from documents union select r.doc_id, b.b from r join b on r.o = b.a)
  select d.doc_id, coalesce(n.n, 0) n_shingles, c.o component_id, c.o = d.doc_id kept
  from documents d join (select doc_id, min(o) o from r group by 1) c using (doc_id) left join n using (doc_id)""")
def op10_minmax(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate documents on two-word shingles at similarity 0.8."""
    return minmax.near_duplicates(read(spark, folder, "documents"), size=2, percent=80)


@query()
def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest by inner product of every vector whose id is divisible by 20."""
    return neighbours.nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    documents = read(spark, folder, "documents")
    return toxicity.score(documents, toxicity.train(documents, read(spark, folder, "labels")))


@query()
def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Roles recovered from transcripts of all conversations, and their canonical rendering."""
    turns = read(spark, folder, "conversations")
    model = chat.train(turns)
    return chat.recover(chat.turn_lines(chat.marked(turns)), model)


@query()
def op4_licences(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licences.scan(read(spark, folder, "documents"))


def encoded(spark: SparkSession, documents: DataFrame) -> DataFrame:
    folder = new_work_dir(spark, "token-files")
    token_files.write(documents, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.summary(spark, folder)


@query()
def op5_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, written to rANS files and read back."""
    return encoded(spark, read(spark, folder, "documents"))


@query()
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark passage in every document."""
    return decontaminate.find(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


#: The domains are learnt from at most so many labelled documents, those with the smallest id hashes.
MAX_LABELLED = 20_000


def quality_domains(spark: SparkSession, folder: str, documents: DataFrame) -> DataFrame:
    """(domain, text): language and labelled quality of the labelled documents."""
    labels = read(spark, folder, "labels").filter("doc_id is not null and quality is not null").select("doc_id", "quality")
    sample = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    return documents.select("doc_id", "lang", "text").join(F.broadcast(sample), "doc_id").select(
        F.concat_ws("-", "lang", F.when(F.col("quality") == 1, "good").otherwise("poor")).alias("domain"), "text")


#: Every domain's share of the tokens is raised to this power, which lifts the small ones.
FLATTEN = 0.7


@query()
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Rates and copies of every document that bring the domains to flattened token shares."""
    documents = read(spark, folder, "documents")
    return mixing.rates(documents, quality_domains(spark, folder, documents), FLATTEN)


_UNITS = """
  with l as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 unit from documents),
  u as (
    select doc_id, unit, length(line) chars, lower(trim(regexp_replace(line, '[ \\t\\x0B\\f\\r]+', ' ', 'g'), ' ')) plain from l),
  w as (
    select *, case when plain = '' then 0 else length(plain) - length(replace(plain, ' ', '')) + 1 end words,
           coalesce(sum(chars + 1) over (partition by doc_id order by unit
                    rows between unbounded preceding and 1 preceding), 0) start_at from u),
  f as (
    select *, words >= 8 and row_number() over (partition by plain order by doc_id, unit) > 1 gone from w)"""


#: A document that shares so many words in a row with another one holds a repeated passage.
PASSAGE_WORDS = 30


@query(f"""{_UNITS},
  t as (
    select doc_id, regexp_replace(coalesce(text, ''), '^[ \\t\\x0B\\f\\r\\n]+|[ \\t\\x0B\\f\\r\\n]+\\z', '', 'g') a from documents),
  t2 as (
    select doc_id, regexp_replace(regexp_replace(a, '[ \\t\\x0B\\f\\r]*\\n[ \\t\\x0B\\f\\r\\n]*', chr(10), 'g'),
      '([.!?])[ \\t\\x0B\\f\\r]+', '\\1' || chr(10), 'g') b from t),
  s as (
    select doc_id, unnest(p) s, generate_subscripts(p, 1) unit
    from (select doc_id, string_split(lower(regexp_replace(b, '[ \\t\\x0B\\f\\r]+', ' ', 'g')), chr(10)) p from t2)),
  o as (select s from s where s <> '' group by s having min(doc_id) <> max(doc_id)),
  h as (
    select doc_id, unit - row_number() over (partition by doc_id order by unit) run,
           length(s) - length(replace(s, ' ', '')) + 1 words from s join o using (s)),
  r as (select doc_id, max(words)::bigint shared_words from (
    select doc_id, run, sum(words) words from h group by 1, 2) group by 1)
  select doc_id, count(*) n_units, count(*) filter (gone) n_removed,
         coalesce(sum(chars) filter (gone), 0)::bigint chars_removed,
         coalesce(string_agg(unit || ':' || start_at || '-' || (start_at + chars), ',' order by unit) filter (gone), '') removed,
         coalesce(any_value(shared_words), 0) shared_words,
         (coalesce(any_value(shared_words), 0) >= {PASSAGE_WORDS})::int has_passage
  from f left join r using (doc_id) group by 1""")
def op8_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Units of every document that an earlier document or line already has, with their offsets, and how
    many words in a row other documents share with it."""
    documents = read(spark, folder, "documents")
    rows = passages.removed(documents)
    runs = passages.shared_runs(documents).select(F.col("doc_id").alias("d"), F.col("copy").alias("c"), "shared_words")
    both = rows.join(runs, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c")), "left")
    spans = F.transform("removed", lambda s: F.concat(
        s["unit"].cast("string"), F.lit(":"), s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    shared = F.coalesce("shared_words", F.lit(0))
    return both.select("doc_id", "n_units", "n_removed", "chars_removed", F.array_join(spans, ",").alias("removed"),
                       shared.alias("shared_words"), (shared >= PASSAGE_WORDS).cast("int").alias("has_passage"))


@query()
def op9_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document with the near-equal line kept for it."""
    return lines.fuzzy_lines(read(spark, folder, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns after faults that follow from crc32(conv_id:turn) % 20: 0 drops a row, 1 empties its text, 2 takes
    its sentence ends, 3 repeats it, 4 makes it the user's. A null role or text is one space."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("again")).drop("again")


@query()
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation and its cheapest repair."""
    conversations = read(spark, folder, "conversations")
    return repair.report(damaged(conversations), conversations)


@query()
def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate documents by fingerprints that differ in at most two bits."""
    return fingerprints.near_duplicates(read(spark, folder, "documents"))


@query()
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Overlap links and groups of two tokenizers' ids for every document."""
    return alignment.align(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))
