"""Byte-level BPE by speculation: guess tokens, verify neighbours, merge the rest.

Greedy longest match proposes the tokens of a word.  The proposal is what exact
merging gives if every token is one that merging its own bytes gives and no two
neighbours merge across the border between them.  Only words that fail are merged
exactly.  All three steps run with numpy over all new words of a batch at once;
what a chunk of text gave is remembered and looked up afterwards, each distinct chunk
of a batch once.

Two kinds of vocabulary files are read: those whose words keep their blanks, and
those that fold case, drop white space and mark the end of a word; the file says
which.

Encoding and decoding are projections: no shuffle, whole texts, a slice of
bounded size in memory (one text, if that is longer).  Null text counts as empty
and gives no ids.  Rows that repeat are encoded one by one; columns other than
the two named are dropped, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from unicodedata import category, normalize
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import lists, slices

# Fixed value: how the vocabulary's own pre-tokenizer cuts text into words.
WORD_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                r"|\s+(?!\S)|\s+")

NEVER = np.iinfo(np.int32).max
# What an encoder remembers at most: chunks, their characters in all, and of one.
REMEMBERED, REMEMBERED_CHARACTERS, REMEMBERED_LENGTH = 400_000, 6_000_000, 64
# Bytes of text encoded at once: what Python holds for them is many times as much.
SLICE = 2_000_000
ENDED = 256
MATRIX_WIDTHS = (8, 16, 32, 64)
# No word spans a blank between two characters that are no white space, so texts
# are cut there first and the pieces looked up.
BLANK = re.compile(r" (?<=\S )(?=\S)")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Kinds of bytes in words of a vocabulary that folds case: letters, single digits, marks,
# and those that need a look at the characters.  The letters of Latin-1 are a lead byte and
# one of 64 others, capitals and small ones 32 apart as in ASCII.
LETTER, DIGIT, MARK, OTHER = range(4)
LATIN, NO_LETTERS = 0xC3, (0x97, 0xB7)
BYTE_KINDS = np.array([LETTER if chr(b).isascii() and chr(b).isalpha() or b == LATIN or 0x80 <= b < 0xC0
                       else DIGIT if 48 <= b < 58 else MARK if chr(b) in MARKS and b != 39 else OTHER
                       for b in range(256)], np.uint8)
LOWER = np.array([b + 32 if 65 <= b < 91 or 0x80 <= b < 0x9F else b for b in range(256)], np.uint8)


def byte_alphabet() -> dict[str, int]:
    """The vocabulary spells bytes as characters: printable ones as themselves, the
    others, in order, as the characters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class IntMap:
    """Non-negative integers to integers, for whole arrays of keys: open addressing
    in an array a quarter full at most."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int) -> None:
        bits = max(4, int(4 * len(keys)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, np.int64)
        self._values = np.full(1 << bits, missing, np.int32)
        keys, values = keys.astype(np.int64), values.astype(np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self._keys[slots] < 0)
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self._keys[slots[placed]], self._values[slots[placed]] = keys[placed], values[placed]
            left = np.ones(len(keys), bool)
            left[placed] = False
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & self._mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        found, out = self._keys[slots], self._values[slots]
        at = np.flatnonzero((found != keys) & (found >= 0))
        while len(at):
            slots[at] = (slots[at] + 1) & self._mask
            found, out[at] = self._keys[slots[at]], self._values[slots[at]]
            at = at[(found != keys[at]) & (found >= 0)]
        return out


class Vocabulary:
    """Tokens and merges of a vocabulary file, with the tables the steps need."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        alphabet, model = byte_alphabet(), data["model"]
        spelled = model["vocab"]
        # A word is a row of symbols: its bytes, the last one marked if the file has a
        # suffix for the ends of words.
        suffix = model.get("end_of_word_suffix") or ""
        self.marks_ends = bool(suffix)
        self.folds = data["normalizer"] is not None
        self.pattern = (data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] if self.folds
                        else WORD_PATTERN)

        def symbols(token: str) -> tuple[int, ...]:
            ended = bool(suffix) and token.endswith(suffix)
            found = [alphabet[c] for c in token.removesuffix(suffix)] if ended else [alphabet[c] for c in token]
            return (*found[:-1], found[-1] + ENDED) if ended else tuple(found)

        tokens = {symbols(t): i for t, i in spelled.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = 1 + max(*spelled.values(), *self.special.values(), 0)
        self.bytes = [b""] * size
        for token, i in tokens.items():
            self.bytes[i] = bytes(c % ENDED for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self._size = size
        self._base = np.array([tokens.get((c,), -1) for c in range(2 * ENDED)], np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left = np.array([spelled[a] for a, _ in pairs], np.int64)
        right = np.array([spelled[b] for _, b in pairs], np.int64)
        self._made = np.array([spelled[a + b] for a, b in pairs], np.int64)
        ranks = np.arange(len(pairs))
        self._merge_ranks = IntMap(left * size + right, ranks, NEVER)
        # First merge that makes a token, and its halves; bytes are made by none.
        self._rank = np.full(size, -1, np.int32)
        self._left, self._right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        for table, values in ((self._rank, ranks), (self._left, left), (self._right, right)):
            table[self._made[::-1]] = values[::-1]
        if (np.maximum(self._rank[left], self._rank[right]) >= ranks).any():
            raise ValueError("a merge stands before the merges that make its halves")
        self._trie(tokens)
        # Whether merging a token's bytes gives that token.
        self.sound = np.zeros(size, bool)
        self.sound[self._base[self._base >= 0]] = True
        apart = self._apart(left, right, whole=False)
        for a, b, c, fine in zip(left.tolist(), right.tolist(), self._made.tolist(), apart.tolist(), strict=True):
            self.sound[c] |= fine and self.sound[a] and self.sound[b]

    def _trie(self, tokens: dict[tuple[int, ...], int]) -> None:
        nodes: dict[tuple[int, ...], int] = {(): 0}
        edges = {}
        for token in tokens:
            for end in range(1, len(token) + 1):
                if token[:end] not in nodes:
                    nodes[token[:end]] = len(nodes)
                    edges[nodes[token[:end - 1]] * 2 * ENDED + token[end - 1]] = nodes[token[:end]]
        self._children = IntMap(np.array(list(edges)), np.array(list(edges.values())), -1)
        self._token_at = np.full(len(nodes), -1, np.int64)
        for token, i in tokens.items():
            self._token_at[nodes[token]] = i

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._merge_ranks.get(a * self._size + b)

    def _apart(self, a: np.ndarray, b: np.ndarray, whole: bool = True) -> np.ndarray:
        """Whether nothing merges across the border of tokens ``a`` and ``b``.

        While ``a`` is being merged, its last part runs through its halves' halves
        on the right; likewise the first part of ``b``.  Two such parts merge if
        their rule ranks before the rules that take either into its own token; of
        equal rules the leftmost applies first.  Without ``whole`` the two tokens
        themselves are expected to merge and do not count.
        """
        fine = np.ones(len(a), bool)
        outer, last, last_taken = np.arange(len(a)), a, np.full(len(a), NEVER, np.int32)
        top = True
        while len(outer):
            rows, mine, first, first_taken = outer, last, b[outer], np.full(len(outer), NEVER, np.int32)
            mine_taken, both_top = last_taken, top
            while len(rows):
                rank = self._merge_rank(mine, first)
                if whole or not both_top:
                    fine[rows[(rank < mine_taken) & (rank <= first_taken) & (rank < NEVER)]] = False
                inner = self._left[first]
                deeper = inner >= 0
                rows, mine, mine_taken = rows[deeper], mine[deeper], mine_taken[deeper]
                first_taken, first, both_top = self._rank[first[deeper]], inner[deeper], False
            inner = self._right[last]
            deeper = inner >= 0
            outer, last_taken, last, top = outer[deeper], self._rank[last[deeper]], inner[deeper], False
        return fine

    def _propose(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list, list]:
        """Greedy longest match of all words, token after token; every single byte is a
        token.  For each round, the words that had a token in it and those tokens."""
        words, tokens = [], []
        rows, at = np.flatnonzero(starts < ends), starts[starts < ends]
        while len(rows):
            best, best_end = np.full(len(rows), -1, np.int64), at.copy()
            active, node, place, stop = np.arange(len(rows)), np.zeros(len(rows), np.int64), at, ends[rows]
            while len(active):
                node = self._children.get(node * 2 * ENDED + data[place])
                there = node >= 0
                active, node, place, stop = active[there], node[there].astype(np.int64), place[there] + 1, stop[there]
                token = self._token_at[node]
                named = token >= 0
                best[active[named]], best_end[active[named]] = token[named], place[named]
                more = place < stop
                active, node, place, stop = active[more], node[more], place[more], stop[more]
            words.append(rows)
            tokens.append(best)
            going = best_end < ends[rows]
            rows, at = rows[going], best_end[going]
        return words, tokens

    def _refused(self, words: list, tokens: list, count: int) -> np.ndarray:
        """Words whose proposal is not what exact merging gives."""
        bad = np.zeros(count, bool)
        rows, pairs = [], []
        for i, (owner, token) in enumerate(zip(words, tokens, strict=True)):
            bad[owner[~self.sound[token]]] = True
            if i:
                before = tokens[i - 1][np.searchsorted(words[i - 1], owner)]
                rows.append(owner)
                pairs.append(before * self._size + token)
        if rows:
            keys, back = np.unique(np.concatenate(pairs), return_inverse=True)
            apart = self._apart(keys // self._size, keys % self._size)
            bad[np.concatenate(rows)[~apart[back]]] = True
        return bad

    def _merge_matrix(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                      width: int) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of words of at most ``width`` bytes, one merge of each word a
        round: the pair of lowest rank, of equal ones the leftmost.  Ids and counts."""
        column = np.arange(width)
        inside = column < lengths[:, None]
        place = np.minimum(starts[:, None] + column, len(data) - 1)
        part = np.where(inside, self._base[data[place]], -1)
        rank = np.full(part.shape, NEVER, np.int32)
        paired = inside[:, 1:]
        rank[:, :-1][paired] = self._merge_rank(part[:, :-1][paired], part[:, 1:][paired])
        after = np.where(column + 1 < lengths[:, None], column + 1, -1)
        before = np.broadcast_to(column - 1, part.shape).copy()
        rows, view = np.arange(len(part)), rank
        while len(rows):
            at = view.argmin(1)
            best = view[np.arange(len(rows)), at]
            going = best < NEVER
            if going.sum() < 0.7 * len(rows):
                rows, at, best = rows[going], at[going], best[going]
                r = rows
            else:
                r, at, best = rows[going], at[going], best[going]
            token, gone = self._made[best], after[r, at]
            following = after[r, gone]
            part[r, at], part[r, gone], rank[r, gone] = token, -1, NEVER
            after[r, at], rank[r, at] = following, NEVER
            has = following >= 0
            before[r[has], following[has]] = at[has]
            rank[r[has], at[has]] = self._merge_rank(token[has], part[r[has], following[has]])
            previous = before[r, at]
            has = previous >= 0
            rank[r[has], previous[has]] = self._merge_rank(part[r[has], previous[has]], token[has])
            view = rank[rows] if len(rows) < len(part) else rank
        kept = part >= 0
        return part[kept], kept.sum(1)

    def _merge_long(self, word: np.ndarray) -> list[int]:
        """The same for one word of any length, with linked parts and a heap of pairs:
        its length times a logarithm."""
        part = self._base[word].tolist()
        after = [*range(1, len(part)), -1]
        before = [*range(-1, len(part) - 1)]
        ranks = self._merge_rank(np.array(part[:-1]), np.array(part[1:])).tolist()
        heap = [(rank, i, part[i], part[i + 1]) for i, rank in enumerate(ranks) if rank < NEVER]
        heapify(heap)
        while heap:
            rank, i, a, b = heappop(heap)
            if part[i] != a or after[i] < 0 or part[after[i]] != b:
                continue
            gone = after[i]
            part[i], part[gone], after[i] = int(self._made[rank]), -1, after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            for first in (i, before[i]):
                if first >= 0 and after[first] >= 0:
                    a, b = part[first], part[after[first]]
                    rank = int(self._merge_rank(np.array([a]), np.array([b]))[0])
                    if rank < NEVER:
                        heappush(heap, (rank, first, a, b))
        return [p for p in part if p >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each word has."""
        return self.encode_joined(np.frombuffer(b"".join(words), np.uint8),
                                  np.fromiter(map(len, words), np.int64, len(words)))

    def encode_joined(self, joined: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words whose bytes stand one after the other."""
        data, ends = joined.astype(np.int64), np.cumsum(lengths)
        starts = ends - lengths
        if self.marks_ends:
            data[ends[lengths > 0] - 1] += ENDED
        rounds, proposed = self._propose(data, starts, ends)
        bad = self._refused(rounds, proposed, len(lengths))
        counts = np.zeros(len(lengths), np.int64)
        for owner in rounds:
            counts[owner] += 1
        merged, low = [], 0
        for width in MATRIX_WIDTHS:
            rows = np.flatnonzero(bad & (lengths > low) & (lengths <= width))
            low = width
            if len(rows):
                ids, counts[rows] = self._merge_matrix(data, starts[rows], lengths[rows], width)
                merged.append((rows, ids))
        for row in np.flatnonzero(bad & (lengths > low)).tolist():
            ids = np.array(self._merge_long(data[starts[row]:ends[row]]))
            counts[row] = len(ids)
            merged.append((np.array([row]), ids))
        offsets = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for i, (owner, token) in enumerate(zip(rounds, proposed, strict=True)):
            good = ~bad[owner]
            out[offsets[owner[good]] + i] = token[good]
        for rows, ids in merged:
            out[spread(offsets[rows], counts[rows])] = ids
        return out, counts


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of runs of ``counts``, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


class Places(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = place = len(self)
        return place


class Encoder:
    """Texts to ids.  Remembers short chunks, the first it sees, which have the frequent
    ones among them, up to a number and a size in all; others are encoded again where
    they recur."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._words = regex.compile(vocabulary.pattern)
        self._folds = vocabulary.folds
        self._library: Tokenizer | None = None
        names = sorted(vocabulary.special, key=len, reverse=True)
        self._special = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None
        special = vocabulary.special
        self._place = {t: i for i, t in enumerate(special)}
        self._pool, self._used = np.array([*special.values(), 0], np.int32), len(special)
        self._starts = np.arange(len(special))
        self._counts = np.ones(len(special), np.int64)
        self._characters = 0

    def _chunks(self, text: str) -> list[str]:
        if self._special and len(parts := self._special.split(text)) > 1:
            return [c for i, part in enumerate(parts) for c in ([part] if i % 2 else self._cut(part))]
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        if not text:
            return []
        if self._folds:
            return BLANK.split(text)
        first, *rest = BLANK.split(text)
        return [first, *[" " + chunk for chunk in rest]]

    def _words_of(self, chunk: str) -> list[str]:
        if not chunk.isascii() and "Cn" in map(category, chunk):
            return self._words_by_library(chunk)
        if self._folds:
            if not chunk.isascii():
                chunk = normalize("NFC", chunk)
            # Character by character: the end of a word does not change its sigma.
            chunk = "".join(map(str.lower, chunk)) if "\u03a3" in chunk else chunk.lower()
            bare = chunk.rstrip(MARKS)
            if bare.isalpha():
                return [bare, chunk[len(bare):]] if len(bare) < len(chunk) else [chunk]
            return self._words.findall(chunk)
        bare = chunk.rstrip(MARKS)
        if bare[1:].isalpha() and (bare[0] == " " or bare[0].isalpha()):
            return [bare, chunk[len(bare):]] if len(bare) < len(chunk) else [chunk]
        return self._words.findall(chunk)

    def _words_by_library(self, chunk: str) -> list[str]:
        """For characters of a later Unicode version than Python's: whether they are
        letters is left to the library that defines the ids."""
        text = chunk
        if self._library is None:
            self._library = Tokenizer.from_file(self.vocabulary.path)
        if self._library.normalizer is not None:
            text = self._library.normalizer.normalize_str(text)
        pieces = self._library.pre_tokenizer.pre_tokenize_str(text)
        alphabet = byte_alphabet()
        return [bytes(map(alphabet.__getitem__, piece)).decode() for piece, _ in pieces]

    def _chunked(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct chunks of all texts, the number of each chunk, one text after the other,
        and how many chunks each text has."""
        if self._folds and not any(pc.any(pc.match_substring(texts, t)).as_py() for t in self.vocabulary.special):
            # White space is dropped, so every blank or line break may be a cut.
            cut = pc.ascii_split_whitespace(texts)
            coded = cut.flatten().dictionary_encode()
            names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            return names, coded.indices.to_numpy(), pc.list_value_length(cut).to_numpy()
        # The chunks of one text at a time: as text they take many times what their numbers do.
        own = Places()
        placed = [np.fromiter(map(own.__getitem__, self._chunks(text)), np.int32) for text in texts.to_pylist()]
        return list(own), np.concatenate([np.zeros(0, np.int32), *placed]), np.fromiter(map(len, placed), np.int64, len(placed))

    def _plain_words(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of the chunks that are Latin-1 letters, digits and marks alone, for a vocabulary
        that folds case: which chunks those are, the words' bytes, lengths and chunks."""
        data = np.frombuffer("".join(chunks).encode(), np.uint8)
        lengths = pc.binary_length(pa.array(chunks, pa.large_string())).to_numpy()
        kinds, ends = BYTE_KINDS[data], np.cumsum(lengths)
        for byte in NO_LETTERS:
            kinds[data == byte] = OTHER
        others = np.concatenate([[0], np.cumsum(kinds == OTHER)])
        plain = others[ends] == others[ends - lengths]
        inside = np.repeat(plain, lengths)
        owner = np.repeat(np.arange(len(chunks)), lengths)[inside]
        data, kinds = LOWER[data[inside]], kinds[inside]
        first = np.ones(len(data), bool)
        first[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(first)
        return plain, data, np.diff(starts, append=len(data)), owner[starts]

    def _learn(self, new: list[str]) -> None:
        if self._folds:
            plain, data, lengths, owner = self._plain_words(new)
        else:
            plain, data = np.zeros(len(new), bool), np.zeros(0, np.uint8)
            lengths, owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = [np.flatnonzero(plain), np.flatnonzero(~plain)]
        words = [self._words_of(new[i]) for i in order[1].tolist()]
        spelled = [w.encode() for ws in words for w in ws]
        ids, counts = self.vocabulary.encode_joined(
            np.concatenate([data, np.frombuffer(b"".join(spelled), np.uint8)]),
            np.concatenate([lengths, np.fromiter(map(len, spelled), np.int64, len(spelled))]))
        owner = np.concatenate([owner, np.repeat(order[1], np.fromiter(map(len, words), np.int64, len(words)))])
        counts = np.bincount(owner, counts, len(new)).astype(np.int64)
        order, starts = np.concatenate(order), np.zeros(len(new), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        room = self._used + len(ids)
        if room > len(self._pool):
            self._pool = np.resize(self._pool, 2 * room)
        self._pool[self._used:room] = ids
        self._starts = np.concatenate([self._starts, self._used + starts])
        self._counts = np.concatenate([self._counts, counts])
        self._used = room

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, list[int]]:
        """Ids of all texts, one after the other, and how many each text has."""
        before, used = len(self._starts), self._used
        names, rows, sizes = self._chunked(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        place = np.fromiter(map(self._place.get, names, repeat(-1)), np.int64, len(names))
        fresh = np.flatnonzero(place < 0)
        new = [names[i] for i in fresh.tolist()]
        if new:
            place[fresh] = before + np.arange(len(new))
            self._learn(new)
        place = place[rows]
        counts = self._counts[place]
        ids = self._pool[spread(self._starts[place], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *sizes.tolist()])]
        self._keep(new, before, used)
        return ids, np.diff(ends).tolist()

    def _keep(self, new: list[str], before: int, used: int) -> None:
        """Remember of the chunks just learnt those that are not long, if all of them fit."""
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        short = np.flatnonzero(lengths <= REMEMBERED_LENGTH)
        size = self._characters + int(lengths[short].sum())
        if before + len(short) > REMEMBERED or size > REMEMBERED_CHARACTERS:
            short, size = short[:0], self._characters
        self._characters = size
        self._place.update((new[i], before + k) for k, i in enumerate(short.tolist()))
        if len(short) == len(new):
            return
        rows = before + short
        counts = self._counts[rows]
        ids = self._pool[spread(self._starts[rows], counts)]
        self._used = used + len(ids)
        self._pool[used:self._used] = ids
        if len(self._pool) > 4 * max(self._used, 1 << 16):
            self._pool = self._pool[:2 * max(self._used, 1 << 16)].copy()
        self._starts = np.concatenate([self._starts[:before], used + np.cumsum(counts) - counts])
        self._counts = np.concatenate([self._counts[:before], counts])


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary a worker process, whatever the number of its tasks."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, ids): ids of each whole text, one row per row of ``docs``.

    ``path`` names a BPE vocabulary file over bytes that executors can read.
    Special tokens spelled out in a text become their ids.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, counts = encoder.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists(ids, counts, pa.int32())], ["doc_id", "ids"])

    return (docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, ids array<int>"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, ids, text): the bytes of the ids as text; ids that do not form
    whole characters give replacement characters, null ids an empty text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = vocabulary(path).bytes.__getitem__
        for batch in batches:
            texts = []
            for row in batch.column("ids"):
                ids = row.values.to_numpy().tolist() if row.is_valid else []
                texts.append(b"".join(map(token, ids)).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
                ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
