"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Four kinds have strict forms (email, ip, card, phone); what has one is a base span and
always stays.  Looser forms, and strict ones that fail their check, are candidates of
these kinds and of three more (iban, id, name), if they overlap no base span.  Five labelers vote yes, no or nothing on
every candidate and base span: the form's own check, gazetteers (top-level domains,
country codes, issuers, given names), cue words before it, the signs on both sides, and
personal data nearby in the same text.  Expectation-maximisation estimates how reliable
each labeler is for each kind and how many of a kind's candidates are personal data, from
the counts of all vote patterns of the corpus, where base spans are known; the resulting probabilities are the targets of a logistic
classifier over the span's own features, which has the last word: a candidate with
``threshold`` or more is added, unless it fails its form's check or overlaps an earlier one.

One pass finds the spans and writes them without the texts; the counts of vote and feature
patterns are summed by Spark and only they, of bounded variety, reach the driver; then the
written spans are decided.  No text is shuffled, and every text is read once and whole.
All forms are searched in time linear in the text.

Null and empty texts have no spans.  Rows that repeat are judged one by one and count one
by one; null ids are kept.  Spans are in code points, end exclusive, by start, then kind as
in ``KINDS``, then end.  Without candidates, or in an empty table, the base spans are all.
Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, slices

KINDS = ("email", "ip", "card", "phone", "iban", "id", "name")
BASE = KINDS[:4]
EMAIL, IP, CARD, PHONE, IBAN, ID, NAME = range(len(KINDS))

# The strict forms, as their contract states them, in possessive writing.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
FOUR_PARTS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]++")

# Looser forms, all of bounded length.
AT = re.compile(r" ?[(\[{] ?at ?[)\]}] ?| at ", re.I)
SPELLED = re.compile(r"[A-Za-z0-9-]{1,63}+(?:(?: ?[(\[{] ?dot ?[)\]}] ?| dot )[A-Za-z0-9-]{1,63}+){1,4}", re.I)
NATIONAL = re.compile(r"(?<![\w+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])")
GROUPED = re.compile(r"(?<![\w.])[0-9]{4}(?:[ ./_-]{1,3}[0-9]{4}){2}[ ./_-]{1,3}[0-9]{2,4}(?!\w)")
SIX = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])")
ACCOUNT = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
NUMBERED = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
NAMED = re.compile(r"(?<!\w)[A-Z][a-z]{1,19}(?= [A-Z][a-z]{1,19}(?!\w))")
SURNAME = re.compile(r" [A-Z][a-z]{1,19}")

# Gazetteers and cue words.
DOMAINS = frozenset("com org net edu gov mil int info biz io co de fr es it uk us ca au at ch nl be se no dk fi pl eu "
                    "jp cn in br ru example test".split())
DIALLED = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 "
                    "65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 234 254 351 352 353 354 358 380 420 421".split())
ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "6011", "62", "65", "22", "23", "24", "25", "26", "27")
IBAN_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22,
                "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
GIVEN = frozenset("James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth "
                  "Barbara Susan Jessica Sarah Karen Anna Maria Peter Paul Hans Klaus Jean Pierre Marie Claire Carlos Juan "
                  "José Ana Carmen Luis Laura Emma Anne Daniel Mark George Kevin Brian Edward Lisa Nancy".split())
TITLES = frozenset("mr mrs ms dr prof herr frau señor señora monsieur madame".split())
CUES = {
    EMAIL: "email e-mail mail contact write courriel correo".split(), IP: "ip address host server adresse dirección".split(),
    CARD: "card visa mastercard amex credit debit karte carte tarjeta".split(),
    PHONE: "phone tel telephone call mobile fax cell telefon téléphone teléfono".split(),
    IBAN: "iban account konto compte cuenta bank".split(), ID: "ssn social security sozialversicherung".split(),
    NAME: "name named called mr mrs ms dr prof dear herr frau nom nombre".split()}
FOREIGN = frozenset("version release order invoice isbn issn total price page chapter section serial part sku build commit hash".split())

LABELERS = ("form", "gazetteer", "cue", "sides", "company")
COMPANY, BEFORE = 200, 48
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
# Parameters: how often each labeler says no, nothing, yes of spans that are none, and of
# spans that are personal data, before any is seen; worth so many spans.
PRIOR = np.array([
    [[0.80, 0.10, 0.10], [0.005, 0.395, 0.60]], [[0.40, 0.40, 0.20], [0.15, 0.40, 0.45]], [[0.30, 0.60, 0.10], [0.05, 0.55, 0.40]],
    [[0.30, 0.30, 0.40], [0.10, 0.30, 0.60]], [[0.10, 0.60, 0.30], [0.10, 0.50, 0.40]]])
PRIOR_WEIGHT, MOST_STEPS = 20.0, 200
CELLS = "array<struct<kind: string, start: int, end: int, base: boolean, cell: string>>"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def strict_emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ decides alone: its local part starts where the run of such signs before it
    does, or where the match before ended."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(free, at + 1))


def strict_phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PLUS.finditer(text):
        run = m.group().rstrip(" ().-")
        if len(run) >= 4 and 10 <= sum(map(str.isdigit, run)) <= 15:
            yield m.start(), m.start() + len(run)


def bare(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def forms(text: str) -> Iterator[tuple[int, int, int, bool, int]]:
    """(kind, start, end, base, vote of the form's own check)."""
    if "@" in text:
        yield from ((EMAIL, a, b, True, 1) for a, b in strict_emails(text))
    for m in FOUR_PARTS.finditer(text):
        fits = small_parts(m.group())
        yield IP, m.start(), m.end(), fits, 1 if fits else -1
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := bare(m.group())) <= 19:
            fits = luhn(digits)
            yield CARD, m.start(), m.end(), fits, 1 if fits else -1
    if "+" in text:
        yield from ((PHONE, a, b, True, 1) for a, b in strict_phones(text))
    for m in AT.finditer(text):
        domain = SPELLED.match(text, m.end()) or ("(" in m.group() or "[" in m.group()) and DOMAIN.match(text, m.end(), m.end() + 255)
        start = m.start()
        while start > 0 and m.start() - start < 64 and text[start - 1] in LOCAL:
            start -= 1
        if domain and start < m.start():
            yield EMAIL, start, domain.end(), False, 0 if m.group() == " at " else 1
    yield from ((PHONE, m.start(), m.end(), False, 0) for m in NATIONAL.finditer(text))
    for m in GROUPED.finditer(text):
        yield CARD, m.start(), m.end(), False, 1 if luhn(bare(m.group())) else -1
    if ":" in text:
        yield from ((IP, m.start(), m.end(), False, 1 if m.group().count(":") == 7 else 0) for m in SIX.finditer(text))
    for m in ACCOUNT.finditer(text):
        flat = m.group().replace(" ", "")
        number = int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4]))
        yield IBAN, m.start(), m.end(), False, 1 if number % 97 == 1 else -1
    for m in NUMBERED.finditer(text):
        area = m.group()[:3]
        yield ID, m.start(), m.end(), False, -1 if area in ("000", "666") or area[0] == "9" else 1
    for m in NAMED.finditer(text):
        titled = text[max(0, m.start() - 12):m.start()].rstrip(" .").rpartition(" ")[2].lower() in TITLES
        if titled or m.group() in GIVEN:
            yield NAME, m.start(), SURNAME.match(text, m.end()).end(), False, 0


def known(kind: int, span: str) -> int:
    """The gazetteers' vote."""
    if kind == EMAIL:
        return 1 if span.rpartition(".")[2].lower() in DOMAINS else 0
    if kind == IP:
        return 0 if ":" in span else 1 if 0 < int(span.partition(".")[0].lstrip("0")[:4] or 0) < 224 else -1
    if kind == CARD:
        return 1 if bare(span).startswith(ISSUERS) else 0
    if kind == PHONE:
        return 0 if span[0] != "+" else 1 if any(bare(span[:6])[:n] in DIALLED for n in (1, 2, 3)) else -1
    if kind == IBAN:
        return 1 if IBAN_LENGTHS.get(span[:2]) == len(span.replace(" ", "")) else -1
    return 1 if kind == NAME and span.partition(" ")[0] in GIVEN else 0


def _side(sign: str) -> int:
    """0 edge or white space, 1 a mark that ends or wraps, 2 another mark, 3 glued on."""
    return 0 if not sign or sign.isspace() else 1 if sign in ".,;:!?()<>\"'" else 3 if sign.isalnum() else 2


def _apart(found: list[tuple]) -> list[tuple]:
    """Base spans, and the candidates that overlap none."""
    fixed = [(s[1], s[2]) for s in found if s[3]]
    out, reach, passed = [], 0, 0
    for s in found:
        while passed < len(fixed) and fixed[passed][0] <= s[1]:
            reach = max(reach, fixed[passed][1])
            passed += 1
        if s[3] or reach <= s[1] and (passed == len(fixed) or fixed[passed][0] >= s[2]):
            out.append(s)
    return out


def spans(text: str) -> list[tuple[int, int, int, bool, str]]:
    """All base spans and candidates of a text, each with its votes and features."""
    found = sorted(set(forms(text)), key=lambda s: (s[1], s[0], s[2], not s[3]))
    places = [s[1] for s in found if s[3]]
    found = _apart(found)
    out = []
    for kind, start, end, base, form in found:
        span = text[start:end]
        before = [w.lower() for w in WORD.findall(text[max(0, start - BEFORE):start])][-4:]
        cue = 1 if any(w in CUES[kind] for w in before) else -1 if any(w in FOREIGN for w in before) else 0
        left, right = _side(text[start - 1:start]), _side(text[end:end + 1])
        sides = -1 if 3 in (left, right) else 1 if max(left, right) < 2 else 0
        at = bisect_left(places, start - COMPANY)
        near = [p for p in places[at:at + 3] if p <= end + COMPANY and p != start]
        votes = (form, known(kind, span), cue, sides, 1 if near else 0)
        digits = sum(map(str.isdigit, span))
        features = (min(5, (end - start).bit_length()), 4 * digits // len(span), min(3, sum(not c.isalnum() for c in span)),
                    left, right, form + 1, cue + 1)
        out.append((kind, start, end, base, "".join("-0+"[v + 1] for v in votes) + "".join(map(str, features)) + KINDS[kind]))
    return out


def parsed(cell: str) -> tuple[int, np.ndarray, list[int]]:
    """Kind, votes as 0 to 2, and features of a cell."""
    count = len(LABELERS)
    return KINDS.index(cell[count + 7:]), np.array(["-0+".index(c) for c in cell[:count]]), list(map(int, cell[count:count + 7]))


def reliabilities(kinds: np.ndarray, votes: np.ndarray, counts: np.ndarray,
                  certain: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM over vote patterns: for each kind the share of personal data among its candidates
    and each labeler's votes by truth, and the probability of each pattern.  ``certain``
    marks patterns of base spans, which teach the votes on personal data and are no
    candidates."""
    labelers = np.arange(votes.shape[1])
    certain = np.zeros(len(counts), bool) if certain is None else certain
    share = np.full(len(KINDS), 0.5)
    prior = PRIOR[:votes.shape[1]]
    rates = np.repeat(prior[None], len(KINDS), 0)  # kind, labeler, truth, vote
    belief = np.zeros(len(counts))
    for _ in range(MOST_STEPS):
        logs = np.log(rates)[kinds[:, None], labelers, :, votes].sum(1) + np.log(np.stack([1 - share, share], 1))[kinds]
        new = np.where(certain, 1.0, 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700))))
        if np.abs(new - belief).max(initial=0) < 1e-9:
            break
        belief = new
        weight = np.stack([1 - belief, belief], 1) * counts[:, None]
        for kind in range(len(KINDS)):
            mine = kinds == kind
            own = weight[mine & ~certain].sum(0)
            share[kind] = (own[1] + 1) / (own.sum() + 2)
            for labeler in labelers:
                seen = np.stack([weight[mine & (votes[:, labeler] == v)].sum(0) for v in range(3)], 1) + PRIOR_WEIGHT * prior[labeler]
                rates[kind, labeler] = seen / seen.sum(1, keepdims=True)
    return share, rates, belief


def design(kinds: list[int], features: list[list[int]]) -> np.ndarray:
    """One-hot features, the kind, and the kind with the outcome of the form's check."""
    width = 8
    out = np.zeros((len(kinds), 7 * width + 4 * len(KINDS)))
    for row, (kind, values) in enumerate(zip(kinds, features, strict=True)):
        out[row, [width * place + value for place, value in enumerate(values)]] = 1
        out[row, [7 * width + kind, 7 * width + len(KINDS) + 3 * kind + values[5]]] = 1
    return out


def classifier(x: np.ndarray, target: np.ndarray, counts: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Weights of a logistic regression on probabilities, by damped Newton steps."""
    weights = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (counts * (p - target)) + penalty * weights
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fitted(counted: dict[tuple[str, bool], int]) -> dict[str, float]:
    """The classifier's probability of each cell, from the counts of all cells by whether
    their spans are base spans."""
    if not counted:
        return {}
    cells = sorted(counted)
    kinds, votes, features = zip(*(parsed(c) for c, _ in cells), strict=True)
    counts = np.array([counted[c] for c in cells], np.float64)
    _, _, belief = reliabilities(np.array(kinds), np.array(votes), counts, np.array([base for _, base in cells]))
    x = design(list(kinds), list(features))
    weights = classifier(x, belief, counts)
    likely = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
    return {cell: p for (cell, _), p in zip(cells, likely.tolist(), strict=True)}


def decided(found: list[dict], likely: dict[str, float], threshold: float) -> list[dict]:
    """Base spans, and likely candidates that do not overlap an earlier one."""
    out, reach = [], 0
    for s in found:
        if not s["base"]:
            if likely[s["cell"]] < threshold or s["cell"][0] == "-" or reach > s["start"]:
                continue
            reach = s["end"]
        out.append({"kind": s["kind"], "start": s["start"], "end": s["end"], "base": s["base"], "probability": likely[s["cell"]]})
    return out


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.8) -> DataFrame:
    """Rows (doc_id, spans), one for each row of ``docs``; a span is (kind, start, end, base,
    probability by the classifier)."""
    scratch = Scratch(docs.sparkSession)
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "base", "cell")
        cell = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("base", pa.bool_()), ("cell", pa.string())]))
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [[dict(zip(names, (KINDS[s[0]], *s[1:]), strict=True)) for s in spans(t or "")]
                        for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, cell)], ["doc_id", "cells"])

    found = scratch.write(source.mapInArrow(search, f"doc_id {kind}, cells {CELLS}"), "span-candidates")
    counted = (found.select(F.explode("cells").alias("s")).groupBy("s.cell", "s.base").count().toArrow())
    cells = zip(*(counted.column(c).to_pylist() for c in ("cell", "base")), strict=True)
    likely = fitted(dict(zip(cells, counted.column("count").to_pylist(), strict=True)))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("base", pa.bool_()), ("probability", pa.float64())]))
        for batch in batches:
            rows = [decided(cells, likely, threshold) for cells in batch.column("cells").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, span)], ["doc_id", "spans"])

    return found.mapInArrow(
        decide, f"doc_id {kind}, spans array<struct<kind: string, start: int, end: int, base: boolean, probability: double>>")
