"""Steps made cheaper: what they give, and what they hold or do once."""

import zlib

import numpy as np
import pyarrow as pa

from tidemark.llm import bpe, quality, substring
from tidemark.llm.common import slices


def _cells(*parts):
    return pa.array([p.tobytes() for p in parts], pa.binary())


def _bucket(probes, blocks, docs):
    table = pa.table({"bucket": [3] * len(probes), "probes": _cells(*(np.array(p, np.uint32) for p in probes)),
                      "blocks": _cells(*(np.array(b, np.uint32) for b in blocks)),
                      "docs": _cells(*(np.array(d, np.int64) for d in docs))})
    return pa.concat_tables([table.slice(0, 1), table.slice(1)])


def test_anchors_are_blocks_of_two_documents_or_equal_to_a_window():
    found = substring._anchors(_bucket([[7, 7], [], [40]], [[5, 7, 9], [5, 5], [11, 9]], [[1, 1, 2], [1, 4], [3, 2]]))
    pairs = zip(found["doc_id"].to_pylist(), (a & 0xFFFFFFFF for a in found["anchor"].to_pylist()), strict=True)
    assert sorted(pairs) == [(1, 5), (1, 7), (4, 5)]
    assert substring._anchors(_bucket([[1]], [[]], [[]])).num_rows == 0


def test_cells_of_a_chunk_are_read_where_they_lie():
    table = _bucket([[1, 2], [], [3]], [[], [], []], [[], [], []])
    assert substring._joined(table.slice(1), "probes", np.uint32).tolist() == [3]
    before = pa.total_allocated_bytes()
    joined = substring._joined(table, "probes", np.uint32)
    assert joined.tolist() == [1, 2, 3] and pa.total_allocated_bytes() == before


def _texts(*texts):
    return pa.RecordBatch.from_pydict({"text": list(texts), "lang": ["en"] * len(texts), "source": ["s"] * len(texts)})


def test_remembered_words_stay_and_give_the_same_features(monkeypatch):
    monkeypatch.setattr(quality, "REMEMBERED", 3)
    looked_at = []
    features = quality._word_features
    monkeypatch.setattr(quality, "_word_features", lambda words: looked_at.extend(words) or features(words))
    views, batch = quality.Views(), _texts("One two. THREE four", "One five two. 7 One")
    first, again = views.of(batch), views.of(batch)
    assert looked_at == ["One", "two.", "THREE", "four", "five", "7", "four", "five", "7"]
    assert all((a == b).all() for a, b in zip(first, again, strict=True))
    meta = first[2].reshape(2, 8)
    named = [("upper", 2, quality._share(1, 4)), ("plain", 2, quality._share(4, 4))]
    for name, _, share in named:
        assert zlib.crc32(f"{name}={share}".encode()) % quality.META_FEATURES in meta[0].tolist()
    assert zlib.crc32(f"plain={quality._share(4, 5)}".encode()) % quality.META_FEATURES in meta[1].tolist()


def test_texts_are_encoded_in_bounded_slices():
    texts = pa.RecordBatch.from_pydict({"text": ["x" * 400_000] * 5 + ["y" * 3_000_000]})
    sizes = [sum(map(len, part.column("text").to_pylist())) for part in slices(texts, "text", bpe.SLICE)]
    assert sizes == [2_000_000, 3_000_000]
