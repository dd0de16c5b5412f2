"""Personal data by a semi-Markov conditional random field over whole spans.

Four kinds: email, ip, card, phone.  The base rules (patterns with checks, see ``base_spans``)
are found in the whole text in linear time and always stay.  Around digits, ``@`` and spelled-out
at-signs (in brackets, or with "dot" or a dot and an ending after them) that no base span covers, a semi-Markov field decides: candidate segments are runs of
up to ``LONGEST`` tokens, scored by features of the whole span (digit count, grouping, Luhn sum,
parts in range, spelled-out separators, the word before it), and dynamic programming chooses
boundaries and kinds together.  A decoded span is added if its posterior probability is at
least ``SURE`` and it overlaps no base span.

The field is trained here by gradient steps on its log-likelihood: on sentences made from a
fixed seed, with written-out forms of each kind and with numbers that are no personal data
(versions, years, prices, keys).
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import ship, slices

ship(__name__)
KINDS = ("email", "ip", "card", "phone")  # fixed order of the result
LONGEST, SURE = 13, 0.9
REMEMBERED = 400  # tokens of a region up to which its result is kept for equal ones
AROUND = 3  # words of context on either side of an open place

_AT = re.compile(r"@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
# The look-behind starts each run of digits once; a run is never entered in its middle.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_ANCHOR = re.compile(r"[0-9@]|(?<![^\W\d_])[Aa][Tt](?![^\W\d_])")
_WRAPPED = re.compile(r"\s{0,3}[)\]}]")
_WRAPS = re.compile(r"[(\[{]\s{0,3}\Z")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_", re.UNICODE)
_WORD = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every base span, by start, then kind."""
    found: list[tuple[int, int, str]] = []
    floor = 0
    for m in _AT.finditer(text):
        at = a = m.start()
        while a > floor and _LOCAL_END.match(text[a - 1]):
            a -= 1
        domain = _DOMAIN.match(text, at + 1) if a < at else None
        if domain:
            found.append((a, domain.end(), "email"))
            floor = domain.end()
        else:
            floor = max(floor, at + 1)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# --- whole-span features -------------------------------------------------------------------

_HINTS = {  # words that announce a kind
    "email": {"email", "mail", "e", "contact", "write", "reach"},
    "ip": {"ip", "host", "server", "address", "ping", "from"},
    "card": {"card", "visa", "credit", "pay", "mastercard", "payment"},
    "phone": {"phone", "call", "tel", "telephone", "mobile", "fax", "dial"},
}
_ATS, _DOTS = {"at"}, {"dot"}
_BRACKETS = {"{": "[", "}": "]"}
_ENDINGS = {"com", "org", "net", "edu", "info", "io", "de", "fr", "es", "co", "uk", "eu"}


def _is_digits(token: str) -> bool:
    return "0" <= token[0] <= "9"


def span_features(tokens: list[str], gaps: list[bool], a: int, b: int) -> list[str]:
    """Features of tokens[a:b] that hold for any kind; the field crosses them with the kind."""
    part = tokens[a:b]
    low = [t.lower() for t in part]
    numbers = [t for t in part if _is_digits(t)]
    letters = [t for t in low if t[0].isalpha()]
    signs = {t for t in part if not t[0].isalnum()}
    digits = "".join(numbers)
    out = ["bias", f"digits{min(len(digits), 20)}", f"groups{min(len(numbers), 6)}"]
    out.append("lens" + "-".join(str(min(len(n), 5)) for n in numbers[:5]))
    if letters and numbers:
        out.append("mixed")
    out.append(f"letters{min(len(letters), 8)}")
    if 12 <= len(digits) <= 19:
        out.append("luhn" if luhn(digits) else "noluhn")
    if len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers):
        out.append("fourbytes")
    wrapped = any(
        low[i] in _ATS and (i and part[i - 1] in "([" and i + 1 < len(part) and part[i + 1] in ")]")
        for i in range(len(part))
    )
    spelled_at, spelled_dot = any(t in _ATS for t in low), any(t in _DOTS for t in low)
    if wrapped:
        out.append("(at)")
    elif spelled_at:
        out.append("at")
    if spelled_at:  # how far into the span: an address has one word before it
        out.append(f"lead{min(next(i for i, t in enumerate(low) if t in _ATS), 4)}")
    if spelled_dot:
        out.append("dot")
    if (wrapped or spelled_at) and (spelled_dot or "." in signs) and low[-1] in _ENDINGS:
        out.append("address")
    out += [f"sign{s}" for s in sorted(signs)]
    if signs - set(".@()[]+-_ "):
        out.append("oddsign")
    if part[0] == "(" and len(part) > 2 and part[2] == ")":
        out.append("areacode")
    out.append(f"first:{'d' if _is_digits(part[0]) else 'a' if part[0].isalpha() else part[0]}")
    out.append(f"last:{'d' if _is_digits(part[-1]) else 'a' if part[-1].isalpha() else part[-1]}")
    if any(gaps[a + 1 : b]):
        out.append("blank")
    if a and not gaps[a]:
        out.append(f"glued:{'w' if tokens[a - 1].isalnum() else tokens[a - 1]}")
    if b < len(tokens) and not gaps[b]:
        out.append(f"tied:{'w' if tokens[b].isalnum() else tokens[b]}")
    before = [t.lower() for t in tokens[max(0, a - 3) : a]]
    out += [f"hint:{k}" for k in KINDS if any(t in _HINTS[k] for t in before)]
    return out


def candidates(tokens: list[str]) -> Iterator[tuple[int, int]]:
    """Segments that could be a span: at least four digits or an at-sign, digits or words at
    the ends, and nothing but words, digits and joining signs inside.  In order of their start."""
    for a, t in enumerate(tokens):
        if not (t[0].isalnum() or t in "(+["):
            continue
        digits, at = 0, False
        for b in range(a + 1, min(a + LONGEST, len(tokens)) + 1):
            u = tokens[b - 1]
            if not (u[0].isalnum() or u in "@.()[]+-_/"):
                break
            digits += len(u) if _is_digits(u) else 0
            at = at or u == "@" or u.lower() in _ATS
            if (digits >= 4 or (at and b - a > 3)) and u[0].isalnum():
                yield a, b


def apart(segments: Iterable[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Groups of segments that no segment joins: the field can decode each by itself, with the same
    result as all together, because what lies between them scores 0."""
    group: list[tuple[int, int]] = []
    reach = 0
    for a, b in segments:
        if group and a >= reach:
            yield group
            group = []
        group.append((a, b))
        reach = max(reach, b)
    if group:
        yield group


class Field:
    """Semi-Markov field: segments of a kind, or single tokens outside (score 0)."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}

    def scored(self, tokens: list[str], gaps: list[bool]):
        out = []
        for a, b in candidates(tokens):
            features = span_features(tokens, gaps, a, b)
            for k in KINDS:
                names = [f"{k}|{f}" for f in features]
                out.append((a, b, k, sum(self.weights.get(n, 0.0) for n in names), names))
        return out

    def posteriors(self, n: int, segments: list) -> tuple[list[float], float]:
        """Probability of every segment, and the log-partition function."""
        by_end: list[list[int]] = [[] for _ in range(n + 1)]
        by_start: list[list[int]] = [[] for _ in range(n + 1)]
        for i, (a, b, *_rest) in enumerate(segments):
            by_end[b].append(i)
            by_start[a].append(i)
        left, right = [0.0] * (n + 1), [0.0] * (n + 1)

        def total(xs: list[float]) -> float:
            m = max(xs)
            return m + math.log(sum(math.exp(x - m) for x in xs))

        for e in range(1, n + 1):
            left[e] = total([left[e - 1], *(left[segments[i][0]] + segments[i][3] for i in by_end[e])])
        for s in range(n - 1, -1, -1):
            right[s] = total([right[s + 1], *(right[segments[i][1]] + segments[i][3] for i in by_start[s])])
        whole = left[n]
        return [math.exp(left[s[0]] + s[3] + right[s[1]] - whole) for s in segments], whole

    def decode(self, tokens: list[str], gaps: list[bool]) -> list[tuple[int, int, str, float]]:
        """Best segmentation: (first token, end token, kind, posterior) of its segments.

        Regions of any length are decoded as a whole, a group of connected candidates at a time."""
        return [s for group in apart(candidates(tokens)) for s in self._decoded(tokens, gaps, group)]

    def _decoded(self, tokens: list[str], gaps: list[bool], group: list[tuple[int, int]]):
        first = group[0][0]
        n = max(b for _, b in group) - first
        segments = []
        for a, b in group:
            features = span_features(tokens, gaps, a, b)
            for k in KINDS:
                score = sum(self.weights.get(f"{k}|{f}", 0.0) for f in features)
                segments.append((a - first, b - first, k, score))
        best, back = [0.0] * (n + 1), [-1] * (n + 1)
        ends: list[list[int]] = [[] for _ in range(n + 1)]
        for i, s in enumerate(segments):
            ends[s[1]].append(i)
        for e in range(1, n + 1):
            best[e] = best[e - 1]
            for i in ends[e]:
                value = best[segments[i][0]] + segments[i][3]
                if value > best[e]:
                    best[e], back[e] = value, i
        sure, _ = self.posteriors(n, segments)
        out, e = [], n
        while e > 0:
            i = back[e]
            if i < 0:
                e -= 1
            else:
                a, b, k, _score = segments[i]
                out.append((a + first, b + first, k, sure[i]))
                e = a
        return out[::-1]

    def learn(self, examples: list, rounds: int = 5, rate: float = 0.3) -> None:
        """Stochastic gradient on the log-likelihood, steps scaled per weight."""
        squares: dict[str, float] = {}
        order = random.Random(3)
        examples = list(examples)
        for _ in range(rounds):
            order.shuffle(examples)
            for tokens, gaps, gold in examples:
                segments = self.scored(tokens, gaps)
                if not segments:
                    continue
                p, _ = self.posteriors(len(tokens), segments)
                step: dict[str, float] = {}
                for (a, b, k, _s, names), q in zip(segments, p, strict=True):
                    g = ((a, b, k) in gold) - q
                    if abs(g) > 1e-3:
                        for name in names:
                            step[name] = step.get(name, 0.0) + g
                for name, g in step.items():
                    g -= 1e-3 * self.weights.get(name, 0.0)
                    squares[name] = squares.get(name, 0.1) + g * g
                    self.weights[name] = self.weights.get(name, 0.0) + rate * g / math.sqrt(squares[name])


def tokenised(text: str) -> tuple[list[str], list[bool], list[tuple[int, int]]]:
    """Tokens, whether white space precedes each, and their places."""
    tokens, gaps, places, end = [], [], [], 0
    for m in _TOKEN.finditer(text):
        tokens.append(m[0])
        gaps.append(m.start() > end or m.start() == 0)
        places.append(m.span())
        end = m.end()
    return tokens, gaps, places


def _sentences(count: int, seed: int = 17) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """Made sentences with the spans they hold: (text, [(kind, span text)])."""
    r = random.Random(seed)
    fill = "the of and report note une der para mit over under with said file page see about".split()

    def word() -> str:
        return "".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(3, 9)))

    def digits(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    def card(valid: bool) -> str:
        body = r.choice("3456") + digits(14)
        last = next(c for c in "0123456789" if luhn(body + c) == valid)
        return body + last

    def some(kind: str) -> str:
        if kind == "email":
            at = r.choice([" (at) ", " [at] ", "(at)", "[at]", " at "])
            dot = r.choice([" dot ", "."]) if at != " at " else " dot "
            return word() + at + word() + dot + r.choice(["com", "org", "net", "edu", "de", "fr"])
        if kind == "ip":
            return r.choice(["[.]", " . ", "(.)"]).join(str(r.randint(1, 255)) for _ in range(4))
        if kind == "card":
            c = card(True)
            return r.choice([".", "/", " - "]).join((c[:4], c[4:8], c[8:12], c[12:]))
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice([f"({a}) {b}-{c}", f"({a}) {b} {c}", f"({a}){b}-{c}"])

    def other() -> str:
        return r.choice(
            [
                f"version {r.randint(1, 9)}.{r.randint(0, 9)}.{r.randint(0, 20)}",
                f"in {r.randint(1800, 2099)}",
                f"{r.randint(1, 12)}/{r.randint(1, 28)}/{r.randint(1990, 2030)}",
                f"{r.randint(1990, 2030)}-0{r.randint(1, 9)}-{r.randint(10, 28)}",
                f"{r.randint(1, 999)},{digits(3)}.{digits(2)}",
                f"AK{word().upper()}{digits(6)}",
                f"password={digits(2)}{word()}{digits(5)}{word()[:2]}{digits(3)}",
                f"no. {digits(r.randint(4, 8))}",
                f"id {digits(r.randint(9, 20))}",
                card(False),
                f"{word()} at {word()}",
                f"{word()} at {word()}. {word()}",
                f"see pages {digits(3)}-{digits(3)}",
                f"{digits(3)}-{digits(2)}-{digits(4)}",
                f"{digits(2)}:{digits(2)}:{digits(2)}.{digits(4)}",
                f"isbn 978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}",
                f"@{word()} {digits(4)}",
                f"x={digits(4)}.{digits(4)}",
                f"{word()}{digits(4)}{word()}",
                f"{digits(4)} {digits(4)} {digits(4)}",
                f"({digits(4)}) {digits(3)}",
            ]
        )

    for _ in range(count):
        parts, gold = [], []
        for _ in range(r.randint(1, 2)):
            parts += [r.choice([word(), r.choice(fill)]) for _ in range(r.randint(2, 4))]
            if r.random() < 0.4:
                kind = r.choice(KINDS)
                if r.random() < 0.3:
                    parts.append(r.choice(sorted(_HINTS[kind])) + r.choice(["", ":"]))
                span = some(kind)
                gold.append((kind, span))
                parts.append(span + r.choice(["", "", ".", ","]))
            else:
                parts.append(other())
        parts += [word(), word()]
        yield " ".join(parts), gold


@lru_cache(maxsize=1)
def trained(count: int = 900) -> Field:
    examples = []
    for text, spans in _sentences(count):
        tokens, gaps, places = tokenised(text)
        gold = set()
        for kind, span in spans:
            at = text.index(span)
            inside = [i for i, (a, b) in enumerate(places) if a >= at and b <= at + len(span)]
            gold.add((inside[0], inside[-1] + 1, kind))
        examples.append((tokens, gaps, gold))
    field = Field()
    field.learn(examples)
    return field


# --- texts ---------------------------------------------------------------------------------


def _spelled_at(text: str, start: int, end: int) -> bool:
    """Whether the word "at" is in brackets, or "dot" or a dot and an ending follow within a span."""
    if _WRAPPED.match(text, end) and _WRAPS.search(text[max(0, start - 4) : start]):
        return True
    last = ""
    for t in islice(_TOKEN.finditer(text, end), LONGEST):
        token = t[0].lower()
        if token in _DOTS or (last == "." and token in _ENDINGS):
            return True
        last = token
    return False


def _reach(text: str, start: int, end: int) -> tuple[int, int]:
    """Place of the words within ``LONGEST`` tokens of a spelled-out at-sign."""
    back, before = 600, []
    while len(before) <= LONGEST:  # one more than asked for: the first may be cut
        before = [m.start() for m in _TOKEN.finditer(text, max(0, start - back), start)]
        if back >= start:
            break
        back *= 4
    before = before[-LONGEST:]
    after = [m.end() for m in islice(_TOKEN.finditer(text, end), LONGEST)]
    return min([start, *before]), max([end, *after])


def open_regions(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Stretches around anchors that no base span covers, with some words of context."""
    regions: list[list[int]] = []
    s, reach = 0, 0
    for m in _ANCHOR.finditer(text):
        while s < len(spans) and spans[s][0] <= m.start():
            reach = max(reach, spans[s][1])
            s += 1
        if m.start() < reach:
            continue
        a, b = max(0, m.start() - 60), min(len(text), m.end() + 60)
        if m.end() - m.start() == 2:
            if not _spelled_at(text, *m.span()):
                continue
            first, end = _reach(text, *m.span())
            a, b = min(a, first), max(b, end)
        if regions and a <= regions[-1][1]:
            regions[-1] = [min(a, regions[-1][0]), max(b, regions[-1][1])]
        else:
            regions.append([a, b])
    merged: list[tuple[int, int]] = []
    for a, b in regions:  # a spelled-out sign may reach back over earlier regions
        while merged and a <= merged[-1][1]:
            first, end = merged.pop()
            a, b = min(a, first), max(b, end)
        merged.append((a, b))
    return merged


def _shape(tokens: list[str], gaps: list[bool]) -> tuple:
    """All that the features see of a region; equal shapes decode alike."""
    hints = set().union(*_HINTS.values()) | _ATS | _DOTS | _ENDINGS
    return (
        tuple(t if not t[0].isalpha() or t.lower() in hints else "a" for t in tokens),
        tuple(gaps),
    )


def _covered(x: int, y: int, starts: list[int], ends: list[int]) -> bool:
    """Whether x to y meets one of the spans, which are in order and apart."""
    last = bisect.bisect_left(starts, y) - 1
    return last >= 0 and ends[last] > x


class Finder:
    """All spans of a text; decoded shapes are remembered, up to a bound."""

    def __init__(self, field: Field, remembered: int = 50_000):
        self.field, self.memo, self.bound = field, {}, remembered

    def added(self, text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        out = []
        base = [([s[0] for s in spans if s[2] == k], [s[1] for s in spans if s[2] == k]) for k in KINDS]
        for a, b in open_regions(text, spans):
            tokens, gaps, places = tokenised(text[a:b])
            tokens = [_BRACKETS.get(t, t) for t in tokens]  # the field was shown no braces
            # Short regions are often alike; a long one is not worth remembering.
            key = _shape(tokens, gaps) if len(tokens) <= REMEMBERED else None
            if key is None or key not in self.memo:
                found = [s for s in self.field.decode(tokens, gaps) if s[3] >= SURE]
                if key is not None:
                    if len(self.memo) >= self.bound:
                        self.memo.clear()
                    self.memo[key] = found
            else:
                found = self.memo[key]
            for first, end, kind, _p in found:
                x, y = places[first][0] + a, places[end - 1][1] + a
                if all(not _covered(x, y, *of_kind) for of_kind in base) and (not out or x >= out[-1][1]):
                    out.append((x, y, kind))
        return out

    def spans(self, text: str):
        base = base_spans(text)
        return base, self.added(text, base)


def _line(spans) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in ordered)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added for every row.

    Counts and the digest are of the base spans; ``spans`` holds base and added spans as
    kind:start:end in code points.  Null and empty texts have no spans.  Other columns are
    ignored; repeated rows get equal results; an empty table gives no rows.
    """
    field = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(field)
        for batch in slices(batches, "text"):
            counts = np.zeros((len(KINDS) + 1, batch.num_rows), np.int64)
            digest, listed = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                base, added = finder.spans(text) if text else ([], [])
                for _, _, kind in base:
                    counts[KINDS.index(kind), i] += 1
                counts[-1, i] = len(added)
                digest.append(hashlib.sha256(_line(base).encode()).hexdigest())
                listed.append(_line([*base, *added]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, counts), pa.array(digest), pa.array(listed)],
                ["doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in (*KINDS, "added"))
    return (
        docs.select("doc_id", "text")
        .mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")
        .select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added")
    )


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span (overlapping ones together) replaced by its kind in brackets."""
    out, at = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of its ``text`` masked; all other columns and rows as they are."""
    field = trained()
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(field)
        for batch in slices(batches, "text"):
            texts = [
                masked(t, [s for part in finder.spans(t) for s in part]) if t else t
                for t in batch.column("text").to_pylist()
            ]
            at = columns.index("text")
            yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
