"""Personal data by weak supervision.

Candidates are spans that a strict or a loose pattern finds.  Five labelers vote on each of them: the
strict pattern with its checks, a gazetteer, the words before the span, its borders, and its
shape.  Expectation-maximisation estimates from all votes in the corpus how reliable each labeler is
and how likely each pattern of votes marks personal data.  With these probabilities as labels a
logistic classifier of span features is fitted.  It decides about the spans that only the loose
patterns found; what the strict patterns accept always stays.  What they matched and refused counts in the
estimates and hides nothing: a phone number behind a date, which together look like a card, is a candidate.

Texts are read once.  What comes to the driver are counts by pattern of votes (at most 243 for each kind)
and by cell of features (at most ``N_CELLS``), both over all documents.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.llm.common import filled
from orderline_kpi.sources.scratch import WorkArea

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
LABELERS = ("strict", "gazetteer", "context", "borders", "shape")
#: Features of a span and how many levels each has.
FEATURES = {"kind": len(KINDS), "length": 6, "digits": 5, "before": 4, "after": 4, "check": 3}
N_CELLS = math.prod(FEATURES.values())

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9][0-9.]*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOOSE_EMAIL = re.compile(r"[A-Za-z0-9_%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]+(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]+)+")
LOOSE_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
LOOSE_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])")
SECRET = re.compile(r"[=:]\s?[\"']?([A-Za-z0-9_-]{16,})")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")

#: Top-level domains, first digits of card issuers, words that speak for or against a kind.
TOP_DOMAINS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us", "it", "nl"}
ISSUERS = {"3", "4", "5", "6"}
CUES = {
    "email": re.compile(r"e?-?mail|contact|write|@", re.I), "phone": re.compile(r"tel|phone|call|fon|mobile|fax", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|login", re.I),
    "card": re.compile(r"card|visa|credit|karte|carte|tarjeta", re.I),
    "secret": re.compile(r"token|secret|passw|api.?key|private.?key|credential", re.I),
}
COUNTER_CUES = re.compile(r"version|\bv\.?$|order|invoice|isbn|\bid\b|article|section|part no", re.I)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain; found from the @, so long words cost nothing."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and not NOT_LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost runs of four numbers with single dots between."""
    for run in NUMBERS.finditer(text):
        if run.group().count(".") < 3:
            continue
        at, parts = run.start(), []
        for part in run.group().split("."):
            parts = [*parts, (at, at + len(part))] if part else []
            at += len(part) + 1
            if len(parts) == 4:
                yield parts[0][0], parts[3][1]
                parts = []


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def base_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, valid) of all matches of the strict patterns."""
    if "@" in text:
        for start, end in _emails(text):
            yield 0, start, end, True
    for start, end in _addresses(text):
        yield 1, start, end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text[start:end].split("."))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = _only_digits(match.group())
            if len(digits) >= 12:
                yield 2, match.start(), match.end(), len(digits) <= 19 and _luhn(digits)
    if "+" in text:
        for match in PHONE.finditer(text):
            yield 3, match.start(), match.end(), 9 <= len(_only_digits(match.group())) <= 15


def _loose_matches(text: str) -> Iterator[tuple[int, int, int]]:
    if "(at)" in text or "[at]" in text:
        yield from ((0, *match.span()) for match in LOOSE_EMAIL.finditer(text))
    if text.count(":") >= 7:
        yield from ((1, *match.span()) for match in LOOSE_IP.finditer(text))
    yield from ((3, *match.span()) for match in LOOSE_PHONE.finditer(text))
    if "=" in text or ":" in text:
        yield from ((4, *match.span(1)) for match in SECRET.finditer(text))


def _kind_of_character(text: str, at: int) -> int:
    if not 0 <= at < len(text) or text[at].isspace():
        return 0
    return 1 if text[at].isdigit() else 2 if text[at].isalpha() else 3


def _gazetteer(kind: str, span: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[^A-Za-z]+", span.rstrip(")]"))[-1].lower() in TOP_DOMAINS else -1
    if kind == "card":
        return 1 if span[0] in ISSUERS else -1
    if kind == "ip":
        return -1 if span.split(".")[0] in ("0", "127", "255") else 0
    if kind == "phone":
        return 1 if re.match(r"\+(?:1|33|34|44|49|39|31)\b", span) else 0
    return 0


def _votes(kind: str, strict: int, text: str, start: int, end: int) -> list[int]:
    span, lead = text[start:end], text[max(0, start - 32):start]
    cue = 1 if CUES[kind].search(lead) else -1 if COUNTER_CUES.search(lead) else 0
    clean = not text[start - 1:start].isalnum() and not text[end:end + 1].isalnum()
    varied = len(set(span)) >= min(6, len(span) // 2)
    return [strict, _gazetteer(kind, span), cue, 1 if clean else -1, 1 if varied else -1]


class Spans:
    """Spans that do not overlap, in order of their starts, so that a look needs one search and no scan."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlap(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start

    def add(self, start: int, end: int) -> None:
        """One more span, which overlaps none of those here."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def find(text: str) -> tuple[list[dict], list[dict]]:
    """The base spans of a text, and all candidates with votes and features."""
    base, candidates = [], []
    matches = [(*match, True) for match in base_matches(text)]
    taken = Spans((s, e) for _, s, e, valid, _ in matches if valid)
    matches += [(*match, False, False) for match in _loose_matches(text)]
    for kind, start, end, valid, by_strict in matches:
        if valid:
            base.append({"kind": kind, "start": start, "end": end})
        elif taken.overlap(start, end):
            continue
        elif not by_strict:
            # A match that failed its check counts in the estimates only, so it must not hide a loose one.
            taken.add(start, end)
        span = text[start:end]
        digits = sum(map(str.isdigit, span))
        candidates.append({
            "kind": kind, "start": start, "end": end, "base": valid,
            "votes": _votes(KINDS[kind], (1 if valid else -1) if by_strict else 0, text, start, end),
            "length": min(5, (end - start) // 8), "digits": 4 * digits // len(span),
            "before": _kind_of_character(text, start - 1), "after": _kind_of_character(text, end),
            "check": (2 if valid else 1) if by_strict else 0,
        })
    base.sort(key=lambda span: (span["start"], span["kind"]))
    return base, candidates


_SPAN = "struct<kind:int,start:int,end:int>"
_CANDIDATE = "struct<kind:int,start:int,end:int,base:boolean,votes:array<int>," + ",".join(
    f"{name}:int" for name in FEATURES if name != "kind") + ">"


def candidates(docs: DataFrame, columns: list[str], text_column: str) -> DataFrame:
    rows = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(columns)], filled(F.col(text_column)).alias("text"))
    kept = [f"c{k}" for k in range(len(columns))]
    types = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [find(text) for text in batch["text"]]
            yield batch[kept].assign(base=[b for b, _ in found], candidates=[c for _, c in found])

    return rows.mapInPandas(run, f"{types}base array<{_SPAN}>, candidates array<{_CANDIDATE}>")


def vote_probabilities(patterns: pd.DataFrame, rounds: int = 100) -> np.ndarray:
    """The probability that each pattern of votes marks personal data.

    ``patterns``: kind, votes, n.  The model: a share of each kind is personal; each labeler, if it votes, is right
    with a probability of its own for personal and for other spans, given which votes are independent.
    """
    votes = np.array(patterns["votes"].tolist(), np.int64).reshape(-1, len(LABELERS))
    n, kind = patterns["n"].to_numpy(float), patterns["kind"].to_numpy(int)
    right = np.full((2, len(LABELERS)), 0.7)  # of votes on other spans, on personal ones
    share = np.full(len(KINDS), 0.5)
    p = np.full(len(n), 0.5)
    for _ in range(rounds):
        yes = np.where(votes == 0, 0, np.log(np.where(votes > 0, right[1], 1 - right[1]))).sum(1)
        no = np.where(votes == 0, 0, np.log(np.where(votes < 0, right[0], 1 - right[0]))).sum(1)
        p = 1 / (1 + np.exp(np.clip(no - yes + np.log(1 - share[kind]) - np.log(share[kind]), -50, 50)))
        personal, other = n * p, n * (1 - p)
        share = (np.bincount(kind, personal, len(KINDS)) + 1) / (np.bincount(kind, n, len(KINDS)) + 2)
        # A labeler counts as right more often than not, or the two classes could change places.
        right[1] = np.clip((personal @ (votes > 0) + 7) / (personal @ (votes != 0) + 10), 0.51, 0.99)
        right[0] = np.clip((other @ (votes < 0) + 7) / (other @ (votes != 0) + 10), 0.51, 0.99)
    return p


def fit_classifier(cells: pd.DataFrame, rounds: int = 30, ridge: float = 1.0) -> dict[str, list[float]]:
    """Weights of each level of each feature; ``cells``: the features, n, and the sum p of their probabilities."""
    offsets = np.cumsum([0, *FEATURES.values()])
    x = np.zeros((len(cells), offsets[-1]))
    for name, offset in zip(FEATURES, offsets, strict=False):
        x[np.arange(len(cells)), offset + cells[name].to_numpy(int)] = 1
    n, p, w = cells["n"].to_numpy(float), cells["p"].to_numpy(float), np.zeros(offsets[-1])
    for _ in range(rounds):
        fit = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - n * fit) - ridge * w
        step = np.linalg.solve((x.T * (n * fit * (1 - fit))) @ x + ridge * np.eye(len(w)), slope)
        w += np.clip(step, -2, 2)
    return {name: w[a:a + size].tolist() for (name, size), a in zip(FEATURES.items(), offsets, strict=False)}


def _text_of(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, columns: list[str], text_column: str = "text") -> DataFrame:
    """``columns`` of each row of ``docs`` with ``base`` and ``spans``, arrays of (start, kind, end), and both as text.

    Positions are code points, the end exclusive; kinds are numbers, places in ``KINDS``; spans are in the order of
    start and kind.  A null text counts as empty.  Rows that repeat each count in the estimates.  An
    empty table gives an empty result.
    """
    work = WorkArea(docs.sparkSession, "pii")
    found = work.table(candidates(docs, columns, text_column), "candidates")
    each = found.select(F.explode("candidates").alias("c")).select("c.*")
    cells = each.groupBy(*FEATURES, "votes").agg(F.count(F.lit(1)).alias("n")).toPandas()
    patterns = cells.assign(votes=cells["votes"].map(tuple)).groupby(["kind", "votes"], as_index=False)["n"].sum()
    chance = dict(zip(zip(patterns["kind"], patterns["votes"]), vote_probabilities(patterns)))
    cells["p"] = [n * chance[kind, tuple(votes)] for n, kind, votes in zip(cells["n"], cells["kind"], cells["votes"], strict=True)]
    weights = fit_classifier(cells.groupby(list(FEATURES), as_index=False)[["n", "p"]].sum())

    def personal(c: Column) -> Column:
        score = F.lit(0.0)
        for name, levels in weights.items():
            score = score + F.get(F.array(*map(F.lit, levels)), c[name])
        return score > 0

    span = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    spans = F.sort_array(F.transform(F.filter(
        "candidates", lambda c: c["base"] | ((c["check"] == 0) & personal(c))), span))
    return found.select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)],
        F.transform("base", span).alias("base"), spans.alias("spans"),
        _text_of(F.col("base")).alias("base_text"), _text_of(spans).alias("spans_text"),
    )
