"""Whitening, personal data and the filter audit against plain versions, on awkward rows."""

import re
from fractions import Fraction
from itertools import permutations

import duckdb
import numpy as np
import pytest

from tests.conftest import DATA
from tests.llm.samples import digest, documents, ordered
from tidemark.llm import filter_audit, personal_data, whitening
from tidemark.llm.queries import ORACLE, REGISTRY


def written(df, folder, name):
    df.coalesce(2).write.parquet(f"{folder}/{name}.parquet")


# --- whitening ---------------------------------------------------------------------------

def plain_whitening(vectors, most=8):
    """Exact integers, then numpy's eigenvectors."""
    x = [[int(np.floor(1024 * np.float64(c))) + 100000 for c in v] for v in vectors]
    n, size = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(size)]
    away = [[n * r[i] - sums[i] for i in range(size)] for r in x]
    scatter = np.array([[float(Fraction(sum(r[i] * r[j] for r in away), n ** 3)) for j in range(size)] for i in range(size)])
    values, vecs = np.linalg.eigh(scatter)
    values, vecs = values[::-1][:most], vecs[:, ::-1][:, :most]
    centred = np.array(away, dtype=np.float64) / n
    return (n, [sum(v * v for v in r) for r in away], centred @ vecs / np.sqrt(values), values / scatter.trace())


def vector_rows():
    rng = np.random.default_rng(1)
    raw = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) * 0.1).astype(np.float32)
    raw[200:] = raw[0] + rng.normal(scale=0.01, size=(100, 12))
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(raw)]
    rows += [(7, raw[7].tolist(), 1, 2), (None, raw[9].tolist(), None, None)]
    bad = [(900, None, 1, 1), (901, [float("nan")] * 12, 1, 1), (902, [None] + [1.0] * 11, 1, 1),
           (903, [float("inf")] * 12, 1, 1), (904, [], 1, 1)]
    return rows, bad


def test_whitening_equals_the_plain_version(spark, tmp_path):
    rows, bad = vector_rows()
    written(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, n int, component int").repartition(5), tmp_path, "embeddings")
    found = REGISTRY["op11_whitening"](spark, str(tmp_path)).collect()
    assert found[0].__fields__ == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    n, deviations, whitened, explained = plain_whitening([r[1] for r in rows])
    assert len(found) == 8 * len(rows)
    signs = {}
    for i, r in enumerate(rows):
        own = [f for f in found if f.vec_id == r[0]]
        for f in own:
            assert (f.n, f.deviation) == (n, deviations[i]) and f.identity_error < 1e-9
            assert abs(f.explained - explained[f.component - 1]) < 1e-10
            expected = whitened[i, f.component - 1]
            sign = signs.setdefault(f.component, np.sign(expected * f.whitened))
            assert abs(sign * f.whitened - expected) < 1e-7
        assert {f.component for f in own} == set(range(1, 9))


def test_whitening_of_few_equal_and_mixed_rows(spark):
    kind = "vec_id long, embedding array<double>"
    make = lambda rows: whitening.whiten(spark.createDataFrame(rows, kind)).collect()
    rows, bad = vector_rows()
    assert make([(1, [1.0, 2.0])]) == make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == make([b[:2] for b in bad]) == []
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    two = make([(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    assert ordered((r.vec_id, r.component, r.n, int(r.deviation)) for r in two) == [(1, 1, 2, 2 * 1024 ** 2), (2, 1, 2, 2 * 1024 ** 2)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and abs(r.explained - 1) < 1e-12 for r in two)
    mixed = make([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [5.0]), (4, [6.0]), (5, [6.0])])
    assert sorted(r.n for r in mixed) == [2, 2, 3, 3, 3]
    with pytest.raises(Exception, match="2\\^52"):
        make([(1, [1e300]), (2, [0.0])])
    with pytest.raises(ValueError, match="lengths"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], kind), most_lengths=1)


def test_large_whole_numbers_stay_exact(spark):
    rng = np.random.default_rng(2)
    raw = rng.normal(size=(40, 3)) * 1e9
    found = whitening.whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id long, embedding array<double>")).collect()
    n, deviations, _, explained = plain_whitening(raw.tolist())
    assert {(r.vec_id, int(r.deviation)) for r in found} == set(enumerate(deviations))
    assert all(abs(r.explained - explained[r.component - 1]) < 1e-10 for r in found)


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    for size, rank in ((1, 1), (2, 2), (7, 7), (20, 5), (64, 64)):
        x = rng.normal(size=(200, rank)) @ rng.normal(size=(rank, size)) * np.logspace(0, -4, size)
        scatter = x.T @ x
        factor = whitening.pivoted_cholesky(scatter)
        assert np.allclose(factor @ factor.T, scatter, atol=1e-9 * scatter.max())
        values, parts = whitening.eigen(scatter, 8)
        true = np.linalg.eigvalsh(scatter)[::-1][:len(values)]
        assert np.allclose(values[:min(rank, 8)], true[:min(rank, 8)], rtol=1e-9, atol=1e-12 * true[0])
        assert np.allclose(parts.T @ parts, np.eye(parts.shape[1]), atol=1e-10)


# --- personal data -----------------------------------------------------------------------

STRICT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_luhn(digits):
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10 == 0


def plain_spans(text):
    out = []
    for order, (kind, form) in enumerate(STRICT.items()):
        for m in re.finditer(form, text or ""):
            digits = "".join(c for c in m.group() if c in "0123456789")
            fits = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and plain_luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if fits:
                out.append((m.start(), order, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out)]


PRIVATE = [
    "write a.b+c@x-y.example.com or d@e.f_g@h.i.j@k.l now @@ a@ @b.c x@y", "from 1.2.3.4.5.6.7.8 to 256.1.1.1, 01.002.0003.255 1..2.3.4 9.9.9",
    "card 4539 1488 0343 6467, 4539-1488-0343-6467 4539148803436468 12345678901234567890 4 5 - 3", "+1 (168) 555-5254+49 30 1234567 +1 +12 +1((( +123 4567890123456",
    "naïve ② 𝔘 joe@exämple.com ü@x.de 中a@b.cn 1.1.1.1", "0" * 3000 + "." + "1" * 2000, "a" * 5000 + "@", "+" * 3000 + "1" * 40, "1 " * 3000, "a.b@" * 800,
    "call (555) 123-4567 or phone 555-123-4568, order 555 123 4569", "email joe (at) example (dot) com, ann [at] example.org, look at home",
    "iban DE89 3704 0044 0532 0130 00 and DE00370400440532013000", "ssn 123-45-6789 and part 000-12-3456", "Dear Mr. Smith Jones, Mary Brown called Peter Miller",
    "host 2001:0db8:0000:0000:0000:ff00:0042:8329", "4111.1111.1111.1111 card 4111/1111/1111/1112"]


def private(spark):
    rows = [(1000 + i, t, "x") for i, t in enumerate(PRIVATE * 3)] + [(1000, PRIVATE[0], "y")]
    return documents(spark).selectExpr("doc_id", "text", "kept as spans").union(spark.createDataFrame(rows, "doc_id long, text string, spans string"))


def test_base_spans_equal_the_patterns(spark, tmp_path):
    docs = private(spark)
    written(docs, tmp_path, "documents")
    found = REGISTRY["op12_personal_data"](spark, str(tmp_path)).collect()
    assert found[0].__fields__ == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    expected = []
    for r in docs.collect():
        base = plain_spans(r.text)
        expected.append((r.doc_id, *(sum(b.startswith(kind + ":") for b in base) for kind in STRICT), digest(",".join(base))))
    assert ordered(tuple(f)[:6] for f in found) == ordered(expected)
    for f in found:
        own = f.spans.split(",") if f.spans else []
        assert own == sorted(own, key=lambda s: (int(s.split(":")[1]), personal_data.KINDS.index(s.split(":")[0])))
        assert sum(s.split(":")[0] in STRICT for s in own) >= sum(tuple(f)[1:5])


def test_votes_add_likely_spans_only(spark):
    docs = private(spark)
    text = {r.doc_id: r.text for r in docs.collect()}
    added = {}
    for r in personal_data.find(docs).collect():
        for s in r.spans:
            assert 0 <= s.probability <= 1
            if not s.base:
                added.setdefault(r.doc_id, set()).add((s.kind, text[r.doc_id][s.start:s.end]))
    flat = set().union(*added.values())
    assert ("iban", "DE89 3704 0044 0532 0130 00") in flat and ("iban", "DE00370400440532013000") not in flat
    assert ("id", "123-45-6789") in flat and ("id", "000-12-3456") not in flat
    assert not any(k == "card" and v in ("4539148803436468", "4111/1111/1111/1112") for k, v in flat)
    assert personal_data.find(docs.limit(0)).count() == 0


def test_clean_documents_get_no_spans(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in personal_data.find(docs).collect():
        assert len(r.spans) == len(plain_spans(texts[r.doc_id]))


def test_reliabilities_recover_a_planted_model():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.8, 0.7])
    said = np.where(rng.random((20_000, 3)) < right, truth[:, None], ~truth[:, None])
    votes, counts = np.unique(np.where(said, 2, 0), axis=0, return_counts=True)
    share, rates, belief = personal_data.reliabilities(np.zeros(len(votes), int), votes, counts.astype(float))
    assert abs(share[0] - 0.3) < 0.05
    assert np.allclose(rates[0, :, 1, 2], right, atol=0.08)
    assert belief[votes.sum(1) == 6] > 0.95 and belief[votes.sum(1) == 0] < 0.05


def test_long_texts_take_linear_time():
    import time
    for text in ("1" * 400_000, "1.1" * 200_000, "+1 " * 200_000, "a" * 400_000 + "@", "a@" * 200_000, "( at " * 100_000, "1 2-3 " * 80_000, "A " * 200_000):
        began = time.process_time()
        personal_data.spans(text)
        assert time.process_time() - began < 8, text[:10]


# --- filter audit ------------------------------------------------------------------------

def plain_audit(docs, labels):
    """(part, order, step, ...) by running every order over every document."""
    space = re.compile(r"[^\x20\x09-\x0D]+")
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = space.findall(text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)}
        rows.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out, share = [], {}
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for step, letter in enumerate(order):
                own = [r for r in rows if r[0] == part and letter in r[1]]
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                share[part, letter] = share.get((part, letter), 0) + len(gone)
                out.append([part, order, step + 1, len(left), len(gone), len(own) - len(gone), sum(r[1] == {letter} for r in own),
                            sum(r[2] for r in gone), sum(r[3] for r in gone)])
    return [(*r, share[r[0], r[1][r[2] - 1]]) for r in out]


def test_audit_equals_running_every_order(spark, tmp_path):
    docs = documents(spark)
    extra = [(i, t, None if i % 2 else "de") for i, t in enumerate(["SHOUT LOUD " * 80, "a $ b", "", "SHOUT LOUD " * 80, "x y z"] * 3, 100)]
    docs = docs.select("doc_id", "text", "lang", "bucket", "kept").unionByName(
        spark.createDataFrame(extra, "doc_id long, text string, lang string"), allowMissingColumns=True)
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (5, 0, 0), (999, 1, 1), (103, 1, None)]
    written(docs.withColumnRenamed("bucket", "bits").withColumnRenamed("kept", "part"), tmp_path, "documents")
    written(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    found = REGISTRY["op13_filter_audit"](spark, str(tmp_path))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    plain = plain_audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], labels)
    assert ordered(found.collect()) == ordered(plain)
    assert filter_audit.audit(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_audit_equals_sql(spark):
    folder = f"{DATA}/sf0.01"
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    names = filter_audit.audit(*(spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")))
    result = connection.execute(f"select {', '.join(names.columns)} from ({ORACLE['op13_filter_audit']})").fetchall()
    assert ordered(names.collect()) == ordered(result) and len(result) % 600 == 0
