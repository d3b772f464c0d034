"""Text operators against libraries, SQL or plain Python, on small awkward tables."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import DATA
from tests.llm.samples import documents, ordered, plain_passages, plain_similar, words
from tidemark.llm import html_text, jaccard, licenses, line_dedup, substring
from tidemark.llm.bpe import Encoder, Vocabulary, decode, encode
from tidemark.llm.packing import pack

BYTES, FOLDED = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("path", [BYTES, FOLDED])
def test_ids_are_the_librarys(path):
    rng = random.Random(0)
    signs = [*map(chr, range(32, 127)), *"\n\t\r\x0b\x1c\x85\xa0　éßñ中文字🙂́'ıİΣς٣²½", "<|endoftext|>", "  ", "'ll", "aaaa"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(rng.choices("aeinrst", k=rng.randrange(14))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 2000, "-" * 3000, " " * 999 + "x", "", "é" * 500]
    flat, counts = Encoder(Vocabulary(path)).encode(texts)
    library = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert counts == [len(x.ids) for x in library]
    assert flat.tolist() == [i for x in library for i in x.ids]


def test_encoding_and_decoding_awkward_rows(spark, docs):
    library = Tokenizer.from_file(BYTES)
    rows = decode(encode(docs, BYTES), BYTES).collect()
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in pairs(docs)]
    assert ordered((r.doc_id, r.ids) for r in rows) == ordered(expected)
    assert ordered((r.doc_id, r.text) for r in rows) == ordered(
        (i, library.decode(ids, skip_special_tokens=False)) for i, ids in expected)
    assert decode(encode(docs.limit(0), BYTES), BYTES).count() == 0


def test_packing_places_every_token_once(spark, docs):
    library = Tokenizer.from_file(FOLDED)
    named = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).repartition(5)
    pieces = pack(named, FOLDED, window=256, open_windows=4, least_cut=16).collect()
    for i, text in pairs(named):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert [x for p in own for x in p.ids] == ids
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own[:-1])]).tolist()
        assert all(p.doc_tokens == len(ids) and p.length == len(p.ids) for p in own)
    used = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == used.get(p.sequence_id, 0)
        used[p.sequence_id] = p.offset + p.length
    assert max(used.values()) <= 256
    assert sum(256 - n for n in used.values()) < 0.06 * sum(used.values())
    assert pack(docs.limit(0), FOLDED).count() == 0


PAGES = [
    (1, "u", None, ""), (2, None, "", ""), (3, "u", "<p>Hi &amp;  there<br>you<p>B</div>", "Hi & there you\nB"),
    (4, "u", "<nav><a href='x'>Menu</a></nav><article><h1>T</h1><p>short</p><aside>ad</aside><div class='comments'><p>"
     + "the cat is on the mat and " * 20 + "</p></div></article><footer>f</footer>", "T\nshort"),
    (5, "u", "<title>t</title><script>var a='</p>';</script><style>p{}</style><!-- c --><p>a &lt;b&gt; &#233;&nbsp;x</p><form>f</form><div", "a <b> é x"),
    (6, "u", "<div>" + "the quick fox and the dog are in the house " * 8 + "</div><div><a>one two</a> <a>three</a></div>",
     ("the quick fox and the dog are in the house " * 8).strip()),
    (7, "u", "no markup", "no markup"),
]


def test_main_text_of_pages(spark):
    df = spark.createDataFrame([(*p[:3], "x") for p in PAGES + PAGES[:1]], "page_id long, url string, html string, text string")
    assert ordered(html_text.extract(df).collect()) == ordered((i, u, t) for i, u, _, t in PAGES + PAGES[:1])
    assert html_text.extract(df.limit(0)).count() == 0


def test_main_text_is_the_article(spark):
    import html
    import re
    pages = spark.read.parquet(f"{DATA}/sf0.01/pages.parquet").collect()
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert html_text.main_text(page.html) == "\n".join(filter(None, blocks))


LONG_TEXT = ("the quick fox and the dog are in the house " * 8).strip()


@pytest.mark.parametrize("around", ["<aside>{}</aside>", "<div class='comments'>{}</div>"])
def test_articles_in_boilerplate_do_not_hide_the_text(around):
    others = around.format(f"<article><p>{LONG_TEXT[:160]}</p></article><article><p>{LONG_TEXT[:150]}</p></article>")
    assert html_text.main_text(f"<div class='entry-content'><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p></div>{others}") == (
        f"{LONG_TEXT}\n{LONG_TEXT}")


def test_teasers_that_are_articles_do_not_replace_the_text():
    teasers = "<div><article><p>Short teaser</p></article><article><p>Another</p></article></div>"
    assert LONG_TEXT in html_text.main_text(f"<div class='entry-content'><p>{LONG_TEXT}</p></div>{teasers}")


@pytest.mark.parametrize("before", [
    "<html><head><title>t</title><meta charset=utf-8><body>", "<head><style>p{}</style>", "<svg viewBox='0 0 1 1'/>",
    "<object data='x' />", "<button>", "<svg><svg></svg>", "<iframe src=x>", "<video src=x><video>v</video>",
    "<select><option>", "<button-group>", "<svg><a>x</a><title>y</title></svg>", "<template><div>z</div></template>"])
def test_open_and_empty_elements_keep_the_text_after_them(before):
    assert html_text.main_text(f"{before}<p>{LONG_TEXT}</p>") == LONG_TEXT


@pytest.mark.parametrize("wrapper", [
    "<div class='content has-sidebar'>{}</div>", "<div class='no-sidebar'>{}</div>", "<div class='with-comments'>{}</div>",
    "<div id='page-with-banner'>{}</div>", "<div class='sidebar'><article>{}</article></div>",
    "<div class='search'><main>{}</main></div>", "<div class='search results'>{}</div>",
    "<main><div class='sidebar'><article>{}</article></div></main>", "<main><div class='search'>{}</div></main>"])
def test_names_of_wrappers_keep_the_text(wrapper):
    beside = f"<div class='sidebar-left'><p>{LONG_TEXT[:200]}</p></div><div class='comment'>{LONG_TEXT[:99]}</div>"
    assert html_text.main_text(wrapper.format(f"<p>{LONG_TEXT}</p>") + beside) == LONG_TEXT


@pytest.mark.parametrize("operator, sql", [(line_dedup.dedup_lines, line_dedup.SQL), (licenses.scan, licenses.SQL)])
def test_native_operators_match_sql(spark, operator, sql):
    engine = duckdb.connect()
    engine.execute(f"create view documents as select * from '{DATA}/sf0.01/documents.parquet'")
    found = operator(spark.read.parquet(f"{DATA}/sf0.01/documents.parquet"))
    assert ordered(found.collect()) == ordered(engine.execute(sql).fetchall())


def test_repeated_lines_of_awkward_rows(spark, docs):
    rows = line_dedup.dedup_lines(docs, keep=("lang", "kept")).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in rows}
    assert texts[4] is None and texts[5] == "" and texts[17] == "\n\n\n\n" and texts[15].count("\n") == 9
    assert texts[16].startswith("z\n") and len(texts[16]) < 20  # the shared lines go, wherever they stand
    twice = [r for r in rows if r.doc_id == 1]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_licences_in_awkward_rows(spark, docs):
    mit = licenses.TEMPLATES["MIT"].replace(". ", ".\n")
    more = spark.createDataFrame(
        [(1, "x\nReleased under the MIT Licence.\ny"), (2, "Prose.\n\n" + mit + "\n\nMore."), (3, None), (4, "MIT"), (5, "")],
        "doc_id long, text string")
    found = {(r.doc_id, r.license) for r in licenses.scan(more).collect()}
    assert (2, "MIT") in found and not {i for i, _ in found} & {3, 4, 5}
    assert licenses.scan(docs).count() == 0 and licenses.scan(docs.limit(0)).count() == 0


def test_passages_match_the_definition(spark, docs):
    found = substring.dedup_passages(docs, keep=("lang",)).select("doc_id", "n_words", "n_removed", "kept_text")
    assert ordered(found.collect()) == ordered(plain_passages(pairs(docs)))
    assert substring.dedup_passages(docs.limit(0)).count() == 0


def test_similar_documents_match_the_definition(spark, docs):
    found = jaccard.similar(docs).select("doc_id", "n_shingles", "component_id")
    assert ordered(found.collect()) == ordered(plain_similar(pairs(docs)))
    assert jaccard.similar(docs.limit(0)).count() == 0


def test_similar_documents_without_a_common_centre(spark):
    """Chains and a group in which no document is similar to all others."""
    rng, rows = random.Random(7), []
    base = words(9, 200)
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(40), 4):
            text[5 * at] = f"x{i}"
        rows.append((i, " ".join(text)))
    drift = words(10, 150)
    for i in range(60, 90):
        drift[rng.randrange(150)] = f"y{i}"
        rows.append((i, " ".join(drift)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(jaccard.similar(df).select("doc_id", "n_shingles", "component_id").collect()) == ordered(plain_similar(rows))


def test_crc_of_pieces(spark):
    from tidemark.llm.digests import ids_crc32
    df = spark.createDataFrame([(1, [1, 2, 49000]), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.ids_crc32 for r in ids_crc32(df).collect()} == {
        1: zlib.crc32(np.array([1, 2, 49000], "<u4").tobytes()), 2: 0}
