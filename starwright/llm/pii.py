"""Personal data by weak supervision.

Every document yields candidate spans: the base spans of exact patterns and
looser ones (other phone notations, masked e-mail signs, long digit groups,
credentials).  Four labelers vote on each candidate (for, against or nothing):

* pattern: the exact pattern of the kind and its validity rule;
* gazetteer: top-level domains, card issuers' first digits, reserved networks,
  number lengths of the kind;
* context: words before the span that announce such data, or something else;
* shape: grouping and variety of the characters.

The votes of all documents are counted by pattern of votes (a bounded number),
expectation-maximisation on these counts estimates each labeler's reliability
and each pattern's probability, and these train the final classifier, a
logistic model of the span's features.  Base spans stay whatever it says;
looser ones that it accepts are added where they overlap nothing better.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import map_batches, written

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run that begins inside a number can't match where its whole number didn't.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOOSE_PHONE = re.compile(
    r"(?<![\w.+-])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ ./-])[0-9]{3,4}[ .-][0-9]{3,5}(?![\w-])")
_MASKED_EMAIL = re.compile(
    r"(?<![\w.+-])[\w.+-]++ ?[\[(](?:at|AT)[\])] ?[\w-]++"
    r"(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[\w-]++)+")
_SECRET = re.compile(
    r"(?i)\b(?:password|passwd|pwd|api[_-]?key|secret|token)[ ]?[=:][ ]?[\"']?[^\s\"']{4,}")

# Words that announce personal data, words that announce something else.
_FOR = re.compile(r"(?i)mail|contact|phone|call|tel|fax|mobile|reach|write|card|visa|credit|"
                  r"host|server|login|user|address")
_AGAINST = re.compile(r"(?i)version|isbn|issn|order|invoice|page|chapter|figure|license|doi|"
                      r"example|table|section")
_TOP_LEVEL = frozenset("com org net edu gov info io de fr es it uk eu nl ch at us ca br".split())
CONTEXT = 32


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the e-mail pattern, found from their signs, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _gazetteer(kind: int, span: str, digits: str) -> int:
    if kind == EMAIL:
        return int(re.split(r"\W+", span)[-1].lower() in _TOP_LEVEL)
    if kind == IP:
        first = span.split(".", 1)[0]
        return int(len(first) <= 3 and 0 < int(first) < 224 and int(first) != 127)
    if kind == CARD:
        return int(digits[0] in "3456")
    return int(10 <= len(digits) <= 12) if kind == PHONE else 2


def _shape(kind: int, span: str, digits: str) -> int:
    if kind == EMAIL:
        return int(span[0].isalnum() and ".." not in span)
    if kind == SECRET:
        return int(len(set(span)) >= 8)
    if len(set(digits)) <= 2:
        return 0
    groups = re.findall("[0-9]+", span)
    if kind == CARD:
        return int(len(groups) == 1 or [*map(len, groups)] in ([4, 4, 4, 4], [4, 6, 5]))
    return int(all(g == (g.lstrip("0") or "0") for g in groups)) if kind == IP else int(len(groups) >= 3)


def _code(kind: int, exact: bool, text: str, start: int, end: int) -> str:
    """The features of a span: kind, the four votes (2: none), digits, separators."""
    span, before = text[start:end], text[max(0, start - CONTEXT):start]
    digits = _digits(span)
    context = 0 if _AGAINST.search(before) else 1 if _FOR.search(before) else 2
    votes = (int(exact), _gazetteer(kind, span, digits), context, _shape(kind, span, digits))
    return f"{kind}{''.join(map(str, votes))}{min(len(digits), 20) // 2:x}" \
           f"{int(bool(re.search('[ ().-]', span)))}"


def candidates(text: str) -> list[tuple[int, int, int, bool, str]]:
    """Spans (kind, start, end, whether it is a base span, features) of one text."""
    base: list[tuple[int, int, int]] = []
    loose: list[tuple[int, int, int]] = []
    if "@" in text:
        base += [(EMAIL, *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]  # of any length
        fits = all(len(p) <= 3 and int(p) <= 255 for p in parts)
        (base if fits else loose).append((IP, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                base.append((CARD, *m.span()))
            elif 12 <= len(digits) <= 19:
                loose.append((CARD, *m.span()))
    if "+" in text:
        base += [(PHONE, *m.span()) for m in _PHONE.finditer(text)
                 if 10 <= len(_digits(m[0])) <= 15]
    loose += [(PHONE, *m.span()) for m in _LOOSE_PHONE.finditer(text)]
    if "(" in text or "[" in text:
        loose += [(EMAIL, *m.span()) for m in _MASKED_EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        loose += [(SECRET, *m.span()) for m in _SECRET.finditer(text)]
    found = [(k, s, e, True, _code(k, True, text, s, e)) for k, s, e in base]
    # a looser span overlaps a base span if, of those that start before its end, one ends
    # after its start
    starts = sorted(s for _, s, _ in base)
    reach = [*accumulate((e for _, s, e in sorted(base, key=lambda x: x[1])), max)]
    for k, s, e in loose:
        before = bisect_left(starts, e)
        if not before or reach[before - 1] <= s:
            found.append((k, s, e, False, _code(k, k == SECRET, text, s, e)))
    return sorted(found, key=lambda x: (x[1], x[0], x[2]))


def estimate(counts: dict[tuple[int, tuple[int, ...]], float], rounds: int = 50
             ) -> tuple[dict[tuple[int, tuple[int, ...]], float], np.ndarray]:
    """Expectation-maximisation over counts of (kind, votes): the probability of
    each and the labelers' reliabilities [labeler, truth, vote]."""
    keys = sorted(counts)
    n = np.array([counts[k] for k in keys], float)
    kind, votes = np.array([k for k, _ in keys]), np.array([v for _, v in keys])
    # at first a vote is right four times out of five, the pattern's more often
    belief = np.full((votes.shape[1], 2, 3), 0.2)
    belief[:, 1, 1] = belief[:, 0, 0] = 0.6
    belief[0] = [[0.85, 0.05, 0.1], [0.05, 0.85, 0.1]]
    prior = np.full(len(KINDS), 0.5)
    for _ in range(rounds):
        like = np.log([1 - prior[kind], prior[kind]])
        for labeler in range(votes.shape[1]):
            like += np.log(belief[labeler][:, votes[:, labeler]])
        p = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
        for k in range(len(KINDS)):
            here = kind == k
            prior[k] = (1 + (n * p)[here].sum()) / (2 + n[here].sum())
        for labeler, vote in product(range(votes.shape[1]), range(3)):
            cast = votes[:, labeler] == vote
            for truth, weight in enumerate((n * (1 - p), n * p)):
                belief[labeler, truth, vote] = (0.5 + weight[cast].sum()) / (1.5 + weight.sum())
    return dict(zip(keys, p.tolist(), strict=True)), belief


class SpanClassifier:
    """Logistic model over one-hot features of a span's code."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights or {}
        self.known: dict[str, float] = {}

    @staticmethod
    def features(code: str) -> list[str]:
        return ["bias", *(f"{i}={c}" for i, c in enumerate(code)), f"kind+pattern={code[:2]}",
                f"kind+digits={code[0]}{code[5]}", f"kind+gazetteer={code[0]}{code[2]}"]

    def score(self, code: str) -> float:
        if code not in self.known:
            z = sum(self.weights.get(f, 0.0) for f in self.features(code))
            self.known[code] = float(1 / (1 + np.exp(-z)))
        return self.known[code]

    @classmethod
    def fit(cls, counts: dict[str, int], steps: int = 400) -> SpanClassifier:
        """Trained on the probabilities that the votes' estimation gives each code."""
        if not counts:
            return cls()
        votes: dict[tuple[int, tuple[int, ...]], float] = {}
        key = {c: (int(c[0]), tuple(map(int, c[1:5]))) for c in counts}
        for code, n in counts.items():
            votes[key[code]] = votes.get(key[code], 0) + n
        probability, _ = estimate(votes)
        codes = sorted(counts)
        names = sorted({f for c in codes for f in cls.features(c)})
        at = {f: i for i, f in enumerate(names)}
        x = np.zeros((len(codes), len(names)))
        for row, code in enumerate(codes):
            x[row, [at[f] for f in cls.features(code)]] = 1
        y = np.array([probability[key[c]] for c in codes])
        n = np.sqrt([counts[c] for c in codes])
        n /= n.sum()
        w = np.zeros(len(names))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-(x @ w)))
            w -= 2.0 * (x.T @ (n * (p - y)) + 1e-4 * w)
        return cls(dict(zip(names, w.tolist(), strict=True)))


def resolve(spans: list, model: SpanClassifier, threshold: float
            ) -> list[tuple[str, int, int, bool, float]]:
    """Base spans, and accepted looser ones that overlap no better one, by start."""
    kept, ends = [], []
    for k, s, e, base, code in spans:
        score = model.score(code)
        if base:
            kept.append((k, s, e, True, score))
        elif score >= threshold:
            ends.append((-score, s, e, k))
    added: list[tuple[int, int]] = []
    for negative, s, e, k in sorted(ends):
        at = bisect_left(added, (s, e))            # those added don't overlap each other
        if (at == 0 or added[at - 1][1] <= s) and (at == len(added) or e <= added[at][0]):
            added.insert(at, (s, e))
            kept.append((k, s, e, False, -negative))
    return [(KINDS[k], s, e, b, p) for k, s, e, b, p in
            sorted(kept, key=lambda x: (x[1], x[0], x[2]))]


_CANDIDATES = "candidates array<struct<kind:int,start:int,end:int,base:boolean,code:string>>"
SPANS = "spans array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"


def _found(texts: list) -> list:
    names = ("kind", "start", "end", "base", "code")
    return [[dict(zip(names, x, strict=True)) for x in candidates(t or "")] for t in texts]


def _find(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    source = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = source.schema[0].dataType.simpleString()
    return map_batches(source, f"`{id_col}` {kind}, {_CANDIDATES}",
                       lambda: lambda keys, texts: [keys, _found(texts)])


def _fit(found: DataFrame) -> SpanClassifier:
    """The number of different codes is bounded by the features' values."""
    counts = (found.select(F.explode("candidates.code").alias("code"))
              .groupBy("code").count().collect())
    return SpanClassifier.fit({r["code"]: r["count"] for r in counts})


def fit_span_classifier(docs: DataFrame, text_col: str = "text") -> SpanClassifier:
    """The classifier of all candidates of all rows of ``docs``."""
    return _fit(_find(docs.select(F.lit(0).alias("k"), text_col), "k", text_col))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: float = 0.5) -> DataFrame:
    """``id_col`` and ``spans`` (kind, start, end exclusive in code points, base,
    score) for each row of ``docs``, ordered by start.

    A null or empty text has no spans; null and repeated ids stay rows of their
    own; without any candidate the classifier is empty and adds nothing."""
    found = written(_find(docs, id_col, text_col), "pii")
    shared = docs.sparkSession.sparkContext.broadcast(_fit(found).weights)
    names = ("kind", "start", "end", "base", "score")

    def start():
        model = SpanClassifier(shared.value)
        return lambda keys, lists: [keys, [
            [dict(zip(names, x, strict=True)) for x in
             resolve([tuple(c.values()) for c in spans], model, threshold)] for spans in lists]]

    kind = found.schema[0].dataType.simpleString()
    return map_batches(found, f"`{id_col}` {kind}, {SPANS}", start)


def mask_texts(docs: DataFrame, model: SpanClassifier, id_cols: list[str],
               text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with each personal span of ``text_col`` replaced by its kind in
    angle brackets; a null text stays null.  ``id_cols`` are carried along."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)

    def start():
        known = SpanClassifier(shared.value)

        def mask(text: str | None) -> str | None:
            if not text:
                return text
            parts, done = [], 0
            for kind, s, e, _, _ in resolve(candidates(text), known, threshold):
                if e > done:
                    parts += [text[done:max(s, done)], f"<{kind}>"]
                    done = e
            return "".join([*parts, text[done:]])

        return lambda texts, *rest: [[mask(t) for t in texts], *rest]

    source = docs.select(F.col(text_col).cast("string"), *id_cols)
    return map_batches(source, source.schema, start)
