"""Steps made cheaper: few lists asked by leaders, words found in bulk."""

import math
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, pq_dedup

FOLDED, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")

RADIUS = math.sqrt(0.1)


def _block(quantiser, unit, first):
    own, codes, error = quantiser.code(unit)
    order = np.argsort(own, kind="stable")
    leader, apart = pq_dedup.led(unit[order], own[order], RADIUS)
    return {"cls": first + np.arange(len(unit)), "size": np.ones(len(unit), np.int64), "unit": unit[order],
            "list": own[order].astype(np.int32), "codes": codes[order], "error": error[order],
            "leader": leader, "apart": apart}


def _groups(seed, scale=0.025):
    rng = np.random.default_rng(seed)
    raw = np.repeat(np.random.default_rng(1).normal(size=(150, 64)), 8, 0) / 8
    raw = np.concatenate([raw + rng.normal(scale=scale, size=raw.shape), rng.normal(size=(800, 64))])
    return raw / np.linalg.norm(raw, axis=1)[:, None]


def test_evenly_spread_groups_ask_few_lists_and_lose_no_link():
    quantiser = pq_dedup.Quantiser(_groups(2), 16, 8, 16)
    left, right = _block(quantiser, _groups(3), 0), _block(quantiser, _groups(4), 10_000)
    lists = np.unique(right["list"])
    assert quantiser.reaches(left["unit"], left["list"], RADIUS).mean() > 0.5
    assert pq_dedup._asks(left, right, lists, quantiser, RADIUS).mean() < 0.15
    for other, same in ((right, False), (left, True)):
        linked = left["unit"] @ other["unit"].T >= 0.95
        found = pq_dedup._links(left, other, same, quantiser, RADIUS, 0.95)
        counts = dict(zip(found["cls"].tolist(), found["n"].tolist(), strict=True))
        true = linked.sum(1) - same
        assert true.sum() > 5000 and [counts.get(c, 0) for c in left["cls"].tolist()] == true.tolist()


def test_leaders_are_of_the_list_lead_themselves_and_are_near():
    unit, own = _groups(5), np.sort(np.random.default_rng(0).integers(0, 5, 2000))
    leader, apart = pq_dedup.led(unit, own, RADIUS)
    assert (leader[leader] == leader).all() and (own[leader] == own).all() and apart.max() <= RADIUS + 1e-9
    assert np.allclose(apart, np.linalg.norm(unit - unit[leader], axis=1)) and len(np.unique(leader)) < 1800


def test_products_in_single_precision_leave_out_no_pair():
    unit = _groups(6, 0.02)
    square = ((unit[:400, None] - unit[None, :400]) ** 2).sum(2)
    reach = np.sqrt(square[7])  # bounds that are met exactly
    a, b = pq_dedup._within(unit[:400], unit[:400], reach)
    assert {*zip(*map(np.ndarray.tolist, np.nonzero(square <= reach ** 2)), strict=True)} <= {*zip(a.tolist(), b.tolist(), strict=True)}
    assert (square[a, b] <= reach[b] ** 2 + 1e-3).all()


def test_words_in_bulk_are_those_of_each_chunk_alone():
    encoder, rng = bpe.Encoder(bpe.vocabulary(FOLDED)), random.Random(0)
    signs = [chr(c) for c in [*range(0x250), 0x301, 0x3A3, 0x130, 0x2003, 0x4E2D, 0x1F600]]
    chunks = ["".join(rng.choices(signs, k=rng.randrange(9))) for _ in range(4000)]
    chunks += ["".join(rng.choices("abXYZ09,.;'\u00c9\u00e9\u00df\u00d7\u00f7\u00fe", k=rng.randrange(9))) for _ in range(4000)]
    chunks += ["", "Don't", "'S", "x'll", "1a2", "\u00c9t\u00c9,", "\u00d7", "a\x1cb", "\u00aa\u00ba"]
    plain, data, lengths, owner = encoder._plain_words(chunks)
    ends = np.cumsum(lengths)
    found = [[] for _ in chunks]
    for i, start, end in zip(owner.tolist(), (ends - lengths).tolist(), ends.tolist(), strict=True):
        found[i].append(data[start:end].tobytes().decode())
    assert plain.sum() > 2000 and plain[chunks.index("\u00c9t\u00c9,")]
    for chunk, own, here in zip(chunks, found, plain.tolist(), strict=True):
        assert own == ([w for w in encoder._words_of(chunk) if w] if here else [])


@pytest.mark.parametrize("path", [FOLDED, BYTES])
def test_ids_are_the_librarys_whatever_the_blanks_and_marks(path):
    rng, library = random.Random(1), Tokenizer.from_file(path)
    parts = [" ", "  ", "\n", "\t ", "\x0b", "\x1c", "\u00a0", "\u0085", "\u2003", "\u0301", "The", "the", "don't", "'s", "\u00c9l\u00e8ve",
             "\u00d7", "12", "3rd", ",", "...", "\u4e2d\u6587", "\u03a3\u03a3", "stra\u00dfe", "\u0130I", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(600)] + ["", " ", "\n\n", "<|endoftext|>"]
    plain = [t for t in texts if "<|" not in t]
    encoder = bpe.Encoder(bpe.vocabulary(path))
    for some in (texts, plain, texts[:50], [""], [" "]):
        flat, counts = encoder.encode(pa.array(some))
        ends = np.cumsum([0, *counts]).tolist()
        for text, start, end in zip(some, ends, ends[1:], strict=False):
            assert flat[start:end].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_word_is_looked_at_once_wherever_lines_break(monkeypatch):
    encoder = bpe.Encoder(bpe.vocabulary(FOLDED))
    learnt = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: (learnt.extend(new), learn(new)))
    monkeypatch.setattr(encoder, "_words_of", lambda chunk: pytest.fail(chunk))
    encoder.encode(["One two\nthree \u00c9t\u00e9, One\ttwo", "two One\n\nthree 4"])
    encoder.encode(["three two\r\nOne"])
    assert sorted(filter(None, learnt)) == sorted(["One", "two", "three", "\u00c9t\u00e9,", "4"])
