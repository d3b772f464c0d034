"""Removal of repeated passages of lines by content-defined chunks.

A document's lines are cut into chunks after every line where a rolling hash over
the hashes of the last lines is divisible by a constant: the cuts move with the
text, so a passage shared by two documents falls into the same chunks wherever it
stands.  Of chunks of two lines or more that occur more than once anywhere, the
first occurrence (smallest doc_id, ids missing last, then position) stays; another
goes after its bytes have been compared with the first one's.

Built-in expressions only.  What is counted is a hash of each chunk; texts travel
twice, by document.  A chunk that a third of all documents share is one row per
task after partial aggregation; the joins that follow have it once on one side, so
adaptive execution can split the other.

Null text stays null, empty text empty.  Rows with the same id and text count as
one document and get the same result, one row each.  A text without line breaks is
never changed; one whose chunks all go becomes empty.  Chunks without any visible
character stay.  Other columns are dropped unless named in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, held

DIVISOR, MULTIPLIER = 3, 31


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def with_chunks(docs: DataFrame) -> DataFrame:
    """Adds lines and chunks (no, first, last): numbers from 1."""
    lines = held(docs, "lines", F.split("text", "\n", -1))
    hashes = held(lines, "hashes", F.transform("lines", line_hash))
    ends = held(hashes, "ends", F.expr(
        "filter(sequence(1, size(lines)), i -> i = size(lines) or pmod(hashes[i - 1] + "
        f"{MULTIPLIER} * if(i > 1, hashes[i - 2], 0L), {DIVISOR}) = 0)"))
    return held(ends, "chunks", F.expr(
        "transform(ends, (e, k) -> struct(k + 1 as no, if(k = 0, 1, ends[k - 1] + 1) as first, e as last))"
    )).drop("hashes", "ends")


CHUNK_TEXT = "array_join(slice(lines, chunk.first, chunk.last - chunk.first + 1), '\n')"


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, text, n_lines, n_removed, then ``keep``), one for each row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    source = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"),
        F.xxhash64(id_column, text_column).alias("version"), F.struct(*keep).alias("kept") if keep else F.lit(None).alias("kept"))
    chunked = with_chunks(source.where("text is not null").select("doc_id", "version", "text"))
    occurrence = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version", "no").alias("at")
    places = scratch.write(
        chunked.select("doc_id", "version", "lines", F.explode("chunks").alias("chunk"))
        .where("chunk.last > chunk.first").withColumn("chunk_text", F.expr(CHUNK_TEXT))
        .where(F.col("chunk_text").rlike(r"\S"))
        .withColumn("no", F.col("chunk.no"))
        .select(F.xxhash64("chunk_text").alias("key"), F.length("chunk_text").alias("size"), occurrence), "places")
    repeated = (places.groupBy("key", "size").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
                .where("first_at <> last_at").select("key", "size", "first_at"))
    wanted = (places.join(repeated, ["key", "size"])
              .select("at.doc_id", "at.version", F.col("at.no").alias("no"), "key", "size",
                      F.expr("at = first_at").alias("is_first"))
              .groupBy("doc_id", "version").agg(F.collect_set(F.struct("no", "key", "size", "is_first")).alias("wanted")))
    same = lambda a, b: a["version"].eqNullSafe(b["version"]) & a["doc_id"].eqNullSafe(b["doc_id"])
    asked = source.select("doc_id", "version", "text").where("text is not null")
    texts = scratch.write(
        with_chunks(asked.join(wanted, same(asked, wanted)).select(asked["doc_id"], asked["version"], "text", "wanted"))
        .select("doc_id", "version", "lines", "chunks", F.explode("wanted").alias("w"))
        .withColumn("chunk", F.expr("chunks[w.no - 1]"))
        .select("doc_id", "version", "w.*", F.expr(CHUNK_TEXT).alias("chunk_text")), "chunk-texts")
    firsts = texts.where("is_first").select("key", "size", F.col("chunk_text").alias("first_text")).distinct()
    removed = (texts.where("not is_first").join(firsts, ["key", "size"]).where("chunk_text = first_text")
               .groupBy("doc_id", "version").agg(F.collect_set("no").alias("removed")))
    out = source.join(removed, same(source, removed), "left").select(
        source["doc_id"], "text", "kept", "removed")
    return (
        held(with_chunks(out), "stays",
             F.expr("filter(chunks, c -> removed is null or not array_contains(removed, c.no))"))
        .select(
            "doc_id",
            F.expr("if(removed is null, text, array_join(transform(stays, c -> "
                   "array_join(slice(lines, c.first, c.last - c.first + 1), '\n')), '\n'))").alias("text"),
            F.expr("cast(coalesce(size(lines), 0) as long)").alias("n_lines"),
            F.expr("if(removed is null, 0L, cast(size(lines) - aggregate(stays, 0, "
                   "(a, c) -> a + c.last - c.first + 1) as long))").alias("n_removed"),
            *(F.col("kept")[c].alias(c) for c in keep)))


SQL = f"""
with l as (select doc_id, text, string_split(text, chr(10)) ls from documents),
h as (select *, list_transform(ls, lambda x: ('0x' || substr(md5(x), 1, 8))::bigint) hs from l),
e as (select *, list_filter(range(1, len(ls) + 1), lambda i: i = len(ls)
        or (hs[i] + {MULTIPLIER} * coalesce(hs[i - 1], 0)) % {DIVISOR} = 0) es from h),
k as (select doc_id, ls, es, unnest(range(1, len(es) + 1)) no from e),
c as (select doc_id, no, case when no = 1 then 1 else es[no - 1] + 1 end a, es[no] b, ls from k),
t as (select doc_id, no, b - a + 1 n, array_to_string(ls[a:b], chr(10)) chunk from c),
r as (select *, n >= 2 and regexp_matches(chunk, '\\S')
        and row_number() over (partition by chunk, n >= 2 order by doc_id, no) > 1 gone from t)
select d.doc_id, case when d.text is null then null else coalesce(s.text, '') end as text,
       coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines, coalesce(s.n_removed, 0)::bigint as n_removed
from documents d left join (
  select doc_id, string_agg(chunk, chr(10) order by no) filter (where not gone) as text,
         sum(case when gone then n else 0 end) as n_removed from r group by doc_id) s on d.doc_id = s.doc_id
"""
