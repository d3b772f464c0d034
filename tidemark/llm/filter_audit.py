"""How five quality filters interact: what each order of them removes at each step.

Four filters judge a text by itself: A too few words, B too few different words, C too
many capitals, D a sign that prose does not hold.  The fifth, E, is an existential
self-join: a document fails if a document with a smaller id has the same text.  Hashes
seen under two ids or more choose the candidates; of those only, texts move and are
reduced to the smallest id of each text within every task; a left-semi join on hash,
exact text and smaller id then marks E.  The ids it finds are united with the ids that
fail A to D, the bits of each document are added up, and documents are counted by
combination of bits.  All 120 orders are worked out from these counts: at most 32 rows a
part, whatever the number of documents.

A text that a third of all documents share is one row a task on the join's right side;
the left side is split by adaptive execution.  Both sides are written first, so that it
can.  No pair of documents is made and nothing is collected.

Null text counts as empty, null language as an empty string.  Rows that repeat are
documents of their own: rows with the same id are not smaller than each other.  A row
without an id never fails E, has no label and never makes another fail.  Words are those
between ASCII white space, of whole texts.  Of several labels of a document any that
says so makes it good or toxic; labels without an id or of unknown documents count for
nothing.  An empty table has no parts and gives no rows.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, held

# Fixed values of the filters, as their contract states them.
LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
SPACE, CAPITALS, SIGNS = r"[\x20\x09-\x0D]+", "[A-Z]+", "[#$%&*|]"
COPY = 1 << LETTERS.index("E")
ORDERS = ["".join(p) for p in permutations(LETTERS)]


def _bits(*failing: Column) -> Column:
    total = F.lit(0)
    for place, verdict in enumerate(failing):
        total = total + F.when(verdict, 1 << place).otherwise(0)
    return total


def _marked(source: DataFrame) -> DataFrame:
    """Every row with the bits of the filters that judge a text by itself."""
    words = held(source, "words", F.array_remove(F.split("text", SPACE), ""))
    size, length = F.size("words"), F.length("text")
    capitals = length - F.length(F.regexp_replace("text", CAPITALS, ""))
    return words.select("doc_id", "part", "hash", _bits(
        size < LEAST_WORDS, 100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT * size,
        100 * capitals.cast("long") > MOST_CAPITALS * length.cast("long"), F.col("text").rlike(SIGNS)).alias("bits"))


def copies(source: DataFrame, marks: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (doc_id, part, hash) whose text a document with a smaller id has too."""
    repeated = scratch.write(
        marks.where("doc_id is not null").groupBy("hash").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most").select("hash"), "repeated-hashes")
    candidates = scratch.write(
        source.where("doc_id is not null").join(repeated, "hash", "left_semi").select("doc_id", "part", "hash", "text"), "copy-candidates")
    earlier = scratch.write(
        candidates.groupBy("hash", "text").agg(F.min("doc_id").alias("least")), "first-copies")
    c, e = candidates.alias("c"), earlier.alias("e")
    found = c.join(e, F.expr("c.hash = e.hash and c.text = e.text and e.least < c.doc_id"), "left_semi")
    later = scratch.write(found.select("doc_id", "part", "hash"), "copies")
    for done in (repeated, candidates, earlier):
        scratch.drop(done)
    return later


def combinations(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 part_column: str = "lang", quality_column: str = "quality", toxic_column: str = "toxic") -> DataFrame:
    """Rows (part, bits, n, good, toxic): documents by the filters they fail, one row for
    each combination that occurs, and those that pass them all under bits 0."""
    scratch = Scratch(docs.sparkSession)
    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part")).withColumn("hash", F.xxhash64("text"))
    marks = scratch.write(_marked(source), "filter-marks")
    key = ("doc_id", "part", "hash")
    alone = marks.where("bits > 0").select(*key, "bits", F.lit(1).alias("judged"), F.lit(0).alias("copied"))
    later = copies(source, marks, scratch).select(*key, F.lit(COPY).alias("bits"), F.lit(0).alias("judged"), F.lit(1).alias("copied"))
    # Rows of one key have the same text and so fail alike: either count is that of all.
    failing = (alone.union(later).groupBy(*key)
               .agg(F.bit_or("bits").alias("bits"), F.greatest(F.sum("judged"), F.sum("copied")).alias("n")))
    known = (labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(quality_column).eqNullSafe(1).alias("good"),
                           F.col(toxic_column).eqNullSafe(1).alias("toxic"))
             .where("doc_id is not null and (good or toxic)")
             .groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    failed = (failing.join(known, "doc_id", "left").groupBy("part", "bits")
              .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                   F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")))
    passed = (marks.groupBy("part").count().join(failed.groupBy("part").agg(F.sum("n").alias("failed")), "part", "left")
              .select("part", F.lit(0).alias("bits"), F.expr("count - coalesce(failed, 0)").alias("n"),
                      F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic")))
    return failed.unionByName(passed)


def interactions(counted: DataFrame) -> DataFrame:
    """Rows (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) for all orders of the filters, from ``combinations``."""
    steps = (
        counted.withColumn("filter_order", F.explode(F.lit(ORDERS)))
        .withColumn("masks", F.expr("transform(split(filter_order, ''), letter -> shiftleft(1, ascii(letter) - ascii('A')))"))
        .select("*", F.posexplode("masks").alias("place", "own"))
        .withColumn("before", F.expr("aggregate(slice(masks, 1, place), 0, (seen, mask) -> seen | mask)")))
    total = lambda column, rule: F.sum(F.when(F.expr(rule), F.col(column)).otherwise(0))
    here, earlier = "bits & own <> 0 and bits & before = 0", "bits & own <> 0 and bits & before <> 0"
    summed = steps.groupBy("part", "filter_order", "place", "own").agg(
        total("n", "bits & (before | own) = 0").alias("kept"), total("n", here).alias("removed"),
        total("n", earlier).alias("redundant"), total("n", "bits = own").alias("unique_fails"),
        total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"))
    return summed.select(
        "part", "filter_order", F.expr("place + 1").alias("step"), "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", F.sum("removed").over(Window.partitionBy("part", "own")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    return interactions(combinations(docs, labels, **columns))


SQL = rf"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from d),
b as (select doc_id, part,
        (len(words) < {LEAST_WORDS})::int + 2 * (100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words))::int
        + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {MOST_CAPITALS} * length(text))::int
        + 8 * regexp_matches(text, '{SIGNS}')::int
        + 16 * coalesce(doc_id > min(doc_id) over (partition by text), false)::int as bits from w),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
c as (select part, bits, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
      from b left join l on b.doc_id = l.doc_id group by part, bits),
f as (select unnest(['A', 'B', 'C', 'D', 'E']) as x, unnest([1, 2, 4, 8, 16]) as m),
o as (select f1.x || f2.x || f3.x || f4.x || f5.x as filter_order, [f1.m, f2.m, f3.m, f4.m, f5.m] as ms
      from f f1, f f2, f f3, f f4, f f5 where f1.m | f2.m | f3.m | f4.m | f5.m = 31),
s as (select filter_order, step, ms[step] as own, coalesce(list_sum(ms[1:step - 1]), 0)::int as before
      from o, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (select part, filter_order, step, own,
        coalesce(sum(n) filter (where bits & (before | own) = 0), 0)::bigint as kept,
        coalesce(sum(n) filter (where bits & own <> 0 and bits & before = 0), 0)::bigint as removed,
        coalesce(sum(n) filter (where bits & own <> 0 and bits & before <> 0), 0)::bigint as redundant,
        coalesce(sum(n) filter (where bits = own), 0)::bigint as unique_fails,
        coalesce(sum(good) filter (where bits & own <> 0 and bits & before = 0), 0)::bigint as good_lost,
        coalesce(sum(toxic) filter (where bits & own <> 0 and bits & before = 0), 0)::bigint as toxic_lost
      from c, s group by part, filter_order, step, own)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley from r
"""
