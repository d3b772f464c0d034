"""Registered queries on awkward and empty tables, and faults that were found and mended."""

import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.samples import digest, documents, ordered, plain_passages, plain_similar, words
from tidemark.llm import hnsw, html_text, jaccard, substring
from tidemark.llm.bpe import REMEMBERED_CHARACTERS, Encoder, Vocabulary
from tidemark.llm.common import likely_members
from tidemark.llm.queries import REGISTRY

BYTES, FOLDED = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with every awkward case, as files."""
    place = str(tmp_path_factory.mktemp("awkward"))
    documents(spark).repartition(4).write.parquet(f"{place}/documents.parquet")
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (5, 0, 0), (99, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    rng = np.random.default_rng(0)
    vectors = [(i, v.tolist(), 1) for i, v in enumerate(rng.normal(size=(120, 8)))]
    vectors += [(i, [2.0 ** (i - 230)] * 8, 1) for i in range(200, 260)] + [(300, [1.0, 2.0], 1), (350, [1.0, 2.0], 1), (400, [2.0, 4.0], 1)]
    vectors += [(500, None, 1), (550, [0.0] * 8, 1), (600, [float("inf")] * 8, 1), (0, vectors[0][1], 1), (None, [1.0] * 8, 1), (650, [], 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>, point int").write.parquet(f"{place}/embeddings.parquet")
    pages = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>one", None), (3, "u", "<p>" + "word " * 20_000, "x"), (3, "u", "<b", "x")]
    spark.createDataFrame(pages, "page_id long, url string, html string, text string").write.parquet(f"{place}/pages.parquet")
    return place


@pytest.fixture(scope="module")
def empty(spark, folder, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "embeddings", "pages"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{place}/{name}.parquet")
    return place


@pytest.fixture(scope="module")
def texts(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


@pytest.mark.parametrize("name", list(REGISTRY))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert REGISTRY[name](spark, empty).count() == 0


def test_pipeline_of_empty_and_awkward_tables(spark, empty, folder, texts):
    assert corpus_pipeline.run(spark, empty).count() == 0
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = list(corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs.select(*columns, "version"), folder)
        assert kept.columns == columns and kept.count() <= docs.count()
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} <= {i for i, _ in texts}


def test_op1_scores_every_row(spark, folder, texts):
    rows = REGISTRY["op1_quality"](spark, folder).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)


def test_op2_places_every_id_once(spark, folder, texts):
    library = Tokenizer.from_file(FOLDED)
    rows = REGISTRY["op2_packing"](spark, folder).collect()
    expected = Counter()
    for i, t in texts:
        expected[i] += len(library.encode(t or "", add_special_tokens=False).ids) + 1
    found = Counter()
    for r in rows:
        found[r.doc_id] += r.length
        assert 0 <= r.start and r.start + r.length <= r.doc_tokens
        if r.length == r.doc_tokens and [i for i, _ in texts].count(r.doc_id) == 1:
            ids = [*library.encode(dict(texts)[r.doc_id] or "", add_special_tokens=False).ids, 1]
            assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert found == expected
    for sequence in {r.sequence_id for r in rows}:
        own = sorted((r.offset, r.length) for r in rows if r.sequence_id == sequence)
        ends = np.cumsum([n for _, n in own]).tolist()
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_op3_returns_every_page(spark, folder):
    rows = REGISTRY["op3_html"](spark, folder).collect()
    assert rows[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    assert ordered((r.page_id, r.text, r.n_chars) for r in rows) == ordered(
        [(1, "", 0), (2, "", 0), (None, "one", 3), (3, ("word " * 20_000).strip(), 99_999), (3, "", 0)])


def test_op6_and_op7_take_every_length(spark, folder):
    rows = {r.vec_id: r for r in REGISTRY["op6_pq_near_duplicates"](spark, folder).collect()}
    assert {(i, rows[i].n_links, rows[i].component_id) for i in (300, 350, 400)} == {(300, 2, 300), (350, 2, 300), (400, 2, 300)}
    assert all(rows[i].n_links == 59 and rows[i].component_id == 200 for i in range(200, 260))
    assert all((rows[i].n_links, rows[i].kept) == (0, True) for i in (500, 550, 600, 650))
    found = [r for r in REGISTRY["op7_hnsw"](spark, folder).collect()]
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 300] == [350, 400]
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 250] == [200, 201, 202, 203, 204]
    assert max(r.score for r in found) <= 1.0 and not {500, 550, 600, 650} & {r.query_id for r in found}


def test_op7_scores_are_cosines_of_the_vectors_as_given():
    rng = np.random.default_rng(1)
    raw = rng.normal(size=(50, 6)) * np.logspace(-150, 150, 50)[:, None]
    import pandas as pd
    scaled = hnsw.scaled(pd.Series(list(raw)))
    mid = raw[20:30] / np.abs(raw[20:30]).max()
    assert ((scaled / raw)[:, 0] == (scaled / raw)[:, 3]).all()
    scores = hnsw.cosines(scaled, scaled[25])
    assert np.isfinite(scores).all() and scores[25] <= 1.0
    plain = mid @ mid[5] / (np.sqrt((mid * mid).sum(1)) * np.sqrt((mid[5] * mid[5]).sum()))
    assert np.allclose(scores[20:30], plain, atol=1e-15)


def test_ties_of_many_parallel_vectors_go_to_the_smallest_ids(spark):
    rows = [(1000 - i, [float(2 ** (i % 24)), 0.0]) for i in range(60)] + [(50, [3.0, 0.0]), (7, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [r.vec_id for r in hnsw.nearest(df, shards=1).orderBy("rank").collect() if r.query_id == 50]
    assert found == sorted(i for i, v in rows if v[1] == 0 and i != 50)[:5]


def test_op8_digests(spark, folder, texts):
    rows = REGISTRY["op8_substring_dedup"](spark, folder).collect()
    assert ordered(rows) == ordered((i, n, gone, digest(kept)) for i, n, gone, kept in plain_passages(texts))


def test_op9_components(spark, folder, texts):
    assert ordered(REGISTRY["op9_jaccard_join"](spark, folder).collect()) == ordered(plain_similar(texts))


def test_op10_digests(spark, folder, texts):
    library = Tokenizer.from_file(BYTES)
    expected = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    assert ordered(REGISTRY["op10_bpe"](spark, folder).collect()) == ordered(expected)


# --- pages -------------------------------------------------------------------------------

LONG = "This is a sentence of the article that has more than enough words to be taken for text. " * 3


@pytest.mark.parametrize("piece", ['<a href="x', "<p ", "<a '", "<", "</", "<!", "<script ", "<div", "<div>", "</div>x", "<b><i>", "<!--", '"<p>',
                                   "<svg>", "<p hidden", "<a b='\"", "<div><p></x>"])
def test_broken_markup_takes_linear_time(piece):
    page = f"<p>{LONG}</p>" + piece * (1_000_000 // len(piece))
    began = time.process_time()
    text = html_text.main_text(page)
    assert time.process_time() - began < 12
    assert text.startswith(LONG.strip())


@pytest.mark.parametrize("tag", ["p hidden", "p class='advert'", 'p class="cookie-notice"', "p style='display: none'", "div class=advert",
                                 "span class=advert", "span hidden", "em aria-hidden=true", "p role=navigation"])
def test_paragraphs_and_inline_elements_name_themselves(tag):
    name = tag.split()[0]
    page = f"<article><p>{LONG}</p><{tag}>{LONG.replace('article', 'sponsor')}</{name}><p>And {LONG}</p></article>"
    assert html_text.main_text(page) == f"{LONG.strip()}\nAnd {LONG.strip()}"


def test_inline_names_within_prose_stay():
    page = f"<article><p>{LONG}<span class='search-hit'>kept</span> <mark class='related-term'>too</mark></p></article>"
    assert html_text.main_text(page).endswith("kept too")
    assert html_text.main_text(f"<article><p>{LONG}<span class=advert>open</p><p>{LONG}after</p></article>").endswith("after")


# --- memory and bounds ---------------------------------------------------------------------

@pytest.mark.parametrize("path", [BYTES, FOLDED])
def test_texts_without_blanks_are_not_remembered(path):
    rng = np.random.default_rng(0)
    signs = [chr(0x4E00 + i) for i in range(500)]
    encoder, library = Encoder(Vocabulary(path)), Tokenizer.from_file(path)
    for turn in range(20):
        batch = ["".join(rng.choice(signs, 300)) for _ in range(50)] + [f"word{turn} of a text", "the same words"]
        flat, counts = encoder.encode(batch)
        expected = [x.ids for x in library.encode_batch(batch, add_special_tokens=False)]
        assert counts == list(map(len, expected)) and flat.tolist() == [i for x in expected for i in x]
    assert len(encoder._place) < 200 and encoder._used < 2_000 and encoder._characters <= REMEMBERED_CHARACTERS
    assert len(encoder._starts) == len(encoder._counts) == len(encoder._place)


def test_likely_members_never_miss(spark):
    df = spark.range(50_000).withColumn("key", F.when(F.col("id") % 100 < 99, F.col("id")))
    members = spark.range(0, 50_000, 7)
    for bits in (1 << 15, 1 << 26):
        marked = likely_members(df, "key", members, bits)
        found = marked.where("likely")
        assert marked.columns == ["id", "key", "likely"] and marked.count() == 50_000
        assert found.where("id % 7 = 0").count() == df.where("key % 7 = 0").count()
        assert found.where("key is null").count() == 0
    assert found.count() < 1.25 * 50_000 / 7
    assert likely_members(df, "key", members.limit(0)).where("likely").count() == 0


# --- similarity join under pressure -----------------------------------------------------------

def near_copies(seed, count, length, changes):
    import random
    rng = random.Random(seed)
    base = words(seed, length)
    out = []
    for i in range(count):
        copy = list(base)
        for at in rng.sample(range(length), rng.randrange(changes)):
            copy[at] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


def test_hot_tokens_dealt_to_several_tasks_lose_no_link(spark):
    texts = near_copies(1, 150, 120, 8) + near_copies(2, 60, 80, 6) + [" ".join(words(s, 100)) for s in range(10, 60)]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    expected = ordered(plain_similar(rows))
    for most in (400_000, 20):
        found = jaccard.similar(df, most_in_task=most).select("doc_id", "n_shingles", "component_id")
        assert ordered(found.collect()) == expected


def test_sets_with_equal_first_hashes_stay_apart(spark, monkeypatch):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h i j k l"), (4, "m n o p q r")]
    own = jaccard.class_id
    monkeypatch.setattr(jaccard, "class_id", lambda tokens: (5, own(tokens)[1]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes, renamed = jaccard._classes(df.selectExpr(
        "doc_id", "xxhash64(text) version", "2L n", "5L cid", "xxhash64(text) second", "array(1L) parity"), jaccard.Scratch(spark))
    assert len(renamed) == 2 and classes.select("cls").distinct().count() == 3


def test_parity_never_rules_out_a_link():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        gone = int(rng.integers(0, max(1, n // 4)))
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2 ** 63, int(rng.integers(0, 20))).astype(np.uint64)]))
        common, size = len(np.intersect1d(a, b)), len(a) + len(b)
        differing = int(np.bitwise_count((jaccard.parity(a) ^ jaccard.parity(b)).view(np.uint64)).sum())
        if len(b) and 100 * common >= 80 * (size - common):
            assert 180 * differing <= 20 * size


def test_passages_of_many_documents(spark):
    shared = words(1, 40)
    rows = [(i, " ".join(words(100 + i, 30) + shared * (i % 3) + words(200 + i, 20))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = substring.dedup_passages(df).collect()
    assert ordered(found) == ordered(plain_passages(rows))
