"""Personal data by base patterns and a semi-Markov conditional random field.

Base spans are pattern matches that pass a check (email; ip with parts up to
255; card with 12 to 19 digits and the Luhn sum; phone with 9 to 15 digits).

The semi-Markov field reads a region -- words with a digit or ``@``, and one
word before and after -- as tokens (digit runs, letter runs, single signs). A segmentation
cuts the tokens into entity segments of at most ``MAX_TOKENS`` tokens and single
other tokens. A segment's score is a sum of weights of whole-span features for
its type: digit count, separators, shape of the runs, checks such as Luhn and
octet ranges, the word before, and what its edges touch (a word, or a number
beyond a sign or a blank); a weight for each pair of neighbouring types is
added. A type is open to a segment only if the segment passes that type's check
(Luhn, octets, digit count, a dotted domain). Dynamic programming over segment
ends chooses boundaries and types together; its sums (forward and backward) give
the gradient of the conditional log-likelihood.

Weights are trained on regions of a bounded sample (``sample_docs`` documents
with a digit or ``@``, the first by a hash of the id, of ``max_chars``
characters or fewer), labelled by the base patterns, and on the same regions
with a country code, brackets or separators changed, so that the whole-span
features and not one notation carry the decision. Of a sampled text the first
``per_text_limit`` regions shorter than ``max_region`` characters are learned
from; what is searched has no such bound. Segments that the model finds
beside the base spans are added, of the same kinds (a phone number without its
country code, a card number with dots).

Edge cases: a null text counts as empty and has no spans. Repeated rows and
rows without an id are read each for itself, an empty table gives no row. With
no sample the model is trained on the built-in seed regions alone. Of equally
good segments up to one place no entity goes before an entity, a longer one before
a shorter one. Long texts:
scans and segmentation take time in proportion to the text, also where it has no
blank. Extra columns stay; one that is named like the output is replaced.
Nothing is shuffled; memory is that of one Arrow batch and one region's tokens.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import col, per_text

# The base patterns in the order of their kinds, in forms that read a text in linear time. An email is
# found from its ``@``; a number starts where a run of digits does; no run is tried again from its middle.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
OTHER = "other"
LABELS = (OTHER, *KINDS)
MAX_TOKENS = 24
#: No kind without an ``@`` has more (a card).
MAX_DIGITS = 19

#: Regions with their spans, so that a model exists without any sample.
SEEDS = (
    ("mail jo.doe@site.example.org today", (("email", 5, 29),)),
    ("host 10.20.30.40 port 8080", (("ip", 5, 16),)),
    ("card 4111 1111 1111 1111 exp 09/27", (("card", 5, 24),)),
    ("call +1 (555) 010-4477 or wait 15 min", (("phone", 5, 22),)),
    ("4111 1111 1111 1111 09/27", (("card", 0, 19),)),
    ("+1 555-010-4477 +1 555-010-4478", (("phone", 0, 15), ("phone", 16, 31))),
    ("555-010-4477 555-010-4478", (("phone", 0, 12), ("phone", 13, 25))),
    ("+1 (555) 010-4477 10:30", (("phone", 0, 17),)),
    ("cards 4111.1111.1111.1111 5500-0000-0000-0004", (("card", 6, 25), ("card", 26, 45))),
    ("10 20 30 40 50 60 70 80 90 100", ()),
    ("scores 18 27 36 45 54 63 72 81 90 99 of 120", ()),
    ("rows 1 2 3 4 5 6 7 8 9 10 11 12 13", ()),
    ("serial 123-456-789-012-345-678", ()),
    ("at 2021-05-06 10:30:15 and 2021-05-07 11:30:16", ()),
    ("2021-05-06 10:30:15 2021-05-07 11:30:16", ()),
    ("version 4.0 of 2021-05-06 and 12.5 percent", ()),
    ("pages 100-250, order 2024/118, 3 of 1,250", ()),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]+", "", s)


def _octet(number: str) -> bool:
    short = number.lstrip("0")
    return len(short) < 4 and int(short or "0") < 256


def _emails(text: str) -> list[tuple[int, int, int]]:
    """Leftmost non-overlapping emails: each ``@`` with the local characters before it and its domain."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base kinds, sorted."""
    out = []
    if "@" in text:
        out += _emails(text)
    if re.search("[0-9]", text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in CARD.finditer(text):
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
REGION = re.compile(r"(?<!\S)(?:[^\s0-9@]++[ ]++)?[^\s0-9@]*+[0-9@]\S*+(?:[ ]++[^\s0-9@]*+[0-9@]\S*+)*+(?:[ ]++[^\s0-9@]++)?")


@dataclass
class Region:
    """A stretch of text as tokens with their places in it."""

    text: str
    tokens: list[str] = field(init=False)
    at: list[tuple[int, int]] = field(init=False)

    def __post_init__(self) -> None:
        found = list(TOKEN.finditer(self.text))
        self.tokens, self.at = [m[0] for m in found], [m.span() for m in found]
        # digits, numbers and ``@`` among the first tokens
        self.n_digits, self.n_numbers, self.n_mails = [0], [0], [0]
        for t in self.tokens:
            number = "0" <= t[0] <= "9"
            self.n_digits.append(self.n_digits[-1] + (len(t) if number else 0))
            self.n_numbers.append(self.n_numbers[-1] + number)
            self.n_mails.append(self.n_mails[-1] + (t == "@"))

    def starts(self, j: int) -> list[int]:
        """Starts of the token ranges up to ``j`` that could pass a check: 9 to ``MAX_DIGITS`` digits, four numbers, or one ``@`` between words."""
        last, out = self.tokens[j - 1], []
        if not last[0].isalnum():
            return out
        number = "0" <= last[0] <= "9"
        for i in range(j - 1, max(0, j - MAX_TOKENS) - 1, -1):
            if i < j - 1 and self.at[i + 1][0] - self.at[i][1] > 1:
                break
            first = self.tokens[i]
            if not (first[0].isalnum() or first in "+("):
                continue
            mails = self.n_mails[j] - self.n_mails[i]
            if mails:
                if mails > 1:
                    break
                if i < j - 1:
                    out.append(i)
                continue
            digits = self.n_digits[j] - self.n_digits[i]
            if number and not first[0].isalpha() and (9 <= digits <= MAX_DIGITS or self.n_numbers[j] - self.n_numbers[i] == 4 <= digits <= 12):
                out.append(i)
        return out[::-1]

    def kinds(self, i: int, j: int) -> list[str]:
        """Kinds whose checks tokens i to j pass, as the base kinds check them; what stands beside them is for the features."""
        s = self.text[self.at[i][0]:self.at[j - 1][1]]
        if "@" in s:
            left, _, right = s.partition("@")
            return ["email"] if left and "." in right[1:] and "@" not in right and " " not in s else []
        if any(t[0].isalpha() for t in self.tokens[i:j]):
            return []
        d, numbers = _digits(s), [t for t in self.tokens[i:j] if "0" <= t[0] <= "9"]
        out = []
        if len(numbers) == 4 and all(len(x) < 4 and int(x) < 256 for x in numbers) and s.count(".") == 3:
            out.append("ip")
        if 12 <= len(d) <= 19 and luhn(d):
            out.append("card")
        if 9 <= len(d) <= 15 and len(numbers) > 1 and not re.search(r"[^0-9\x20().+-]", s):
            out.append("phone")
        return out

    def beside(self, a: int, step: int) -> str:
        """What goes on beyond the edge at character ``a`` (the first outside the span): a word, or a number after a sign or blank."""
        near, far = (self.text[k] if 0 <= k < len(self.text) else "" for k in (a, a + step))
        if near.isalnum():
            return "word"
        if "0" <= far <= "9":
            return "blank" if near == " " else "sign"
        return "free"

    def features(self, i: int, j: int) -> list[str]:
        """Whole-span features of tokens i to j."""
        a, b = self.at[i][0], self.at[j - 1][1]
        s = self.text[a:b]
        d = _digits(s)
        runs = self.tokens[i:j]
        numbers = [t for t in runs if "0" <= t[0] <= "9"]
        signs = "".join(sorted({t for t in runs if not t[0].isalnum()} | ({" "} if " " in s else set())))
        before = self.text[a - 1] if a else " "
        after = self.text[b] if b < len(self.text) else " "
        letters = any(t[0].isalpha() for t in runs)
        out = [f"digits={min(len(d), 20)}", f"signs={signs}", f"numbers={min(len(numbers), 6)}", f"letters={letters}",
               f"plus={s[0] == '+'}", f"open={before.isalnum() or before in '@+' or after.isalnum() or after == '@'}"]
        if "@" in s:
            left, _, right = s.partition("@")
            out += [f"mail={bool(left) and '.' in right and '@' not in right and ' ' not in s}", f"tail={min(len(right.rpartition('.')[2]), 7)}"]
        elif not letters:
            octets = len(numbers) == 4 and all(len(x) < 4 and int(x) < 256 for x in numbers)
            out += [f"octets={octets and signs == '.'}", f"luhn={12 <= len(d) <= 19 and luhn(d)}", f"groups={'-'.join(str(len(x)) for x in numbers[:6])}",
                    f"phone={9 <= len(d) <= 15}", f"even={len({len(x) for x in numbers}) == 1}", f"digits={min(len(d), 20)} signs={signs}"]
        left, right = self.beside(a - 1, -1), self.beside(b, 1)
        out += [f"left={left}", f"right={right}", f"beside={left} {right}"]
        if i:
            word = self.tokens[i - 1].lower()
            out.append(f"after={word if word.isalpha() and len(word) < 12 else 'sign'}")
        return out


def _logsum(xs: list[float]) -> float:
    top = max(xs)
    return top if top == -math.inf else top + math.log(sum(math.exp(x - top) for x in xs))


@dataclass
class SemiMarkov:
    """Weights of ``type|feature`` and of neighbouring types ``type>type``."""

    weights: dict[str, float] = field(default_factory=dict)

    def _segments(self, region: Region) -> Iterator[list[tuple[int, str, list[str]]]]:
        """For each end, from 1 on, the segments ``(start, type, weight names)``; made when asked for, as a region may be long."""
        for j, token in enumerate(region.tokens, 1):
            row = [(j - 1, OTHER, [f"{OTHER}|token={'9' if token[0].isdigit() else 'x'}"])]
            for i in region.starts(j):
                if kinds := region.kinds(i, j):
                    fs = region.features(i, j)
                    row += [(i, k, [f"{k}|{f}" for f in fs]) for k in kinds]
            yield row

    def _sum(self, names: list[str]) -> float:
        return sum(self.weights.get(n, 0.0) for n in names)

    def best(self, region: Region) -> list[tuple[int, str, int]]:
        """The best segmentation's entities ``(start token, kind, end token)``."""
        n = len(region.tokens)
        value: list[dict[str, tuple[float, tuple | None]]] = [{OTHER: (0.0, None)}] + [{} for _ in range(n)]
        for j, segments in enumerate(self._segments(region), 1):
            for i, k, names in segments:
                own = self._sum(names)
                p, prev = max((v + self.weights.get(f"{q}>{k}", 0.0), q) for q, (v, _) in value[i].items())
                if k not in value[j] or p + own > value[j][k][0]:
                    value[j][k] = p + own, (i, prev)
        out, j = [], n
        k = max(value[n], key=lambda q: value[n][q][0])
        while j:
            i, prev = value[j][k][1]
            if k != OTHER:
                out.append((i, k, j))
            j, k = i, prev
        return out[::-1]

    def _gradient(self, region: Region, gold: list[tuple[int, str, int]], grad: dict[str, float]) -> None:
        """Adds observed minus expected feature counts."""
        n, segments = len(region.tokens), [[], *self._segments(region)]
        known = {(i, j): k for i, k, j in gold}
        inside = {t for i, _, j in gold for t in range(i, j)}
        score = [[(i, k, names, self._sum(names)) for i, k, names in row] for row in segments]
        w = self.weights
        alpha: list[dict[str, float]] = [{OTHER: 0.0}] + [{} for _ in range(n)]
        for j in range(1, n + 1):
            parts: dict[str, list[float]] = defaultdict(list)
            for i, k, _, s in score[j]:
                parts[k].append(s + _logsum([v + w.get(f"{q}>{k}", 0.0) for q, v in alpha[i].items()]))
            alpha[j] = {k: _logsum(v) for k, v in parts.items()}
        z = _logsum(list(alpha[n].values()))
        beta: list[dict[str, float]] = [defaultdict(lambda: -math.inf) for _ in range(n)] + [{k: 0.0 for k in LABELS}]
        for j in range(n, 0, -1):
            for i, k, names, s in score[j]:
                b = beta[j].get(k, -math.inf)
                if b == -math.inf:
                    continue
                for q, v in alpha[i].items():
                    t = w.get(f"{q}>{k}", 0.0)
                    p = math.exp(v + t + s + b - z)
                    if p > 1e-6:
                        grad[f"{q}>{k}"] -= p
                        for name in names:
                            grad[name] -= p
                    beta[i][q] = _logsum([beta[i][q], t + s + b])
        prev, j = OTHER, 0
        steps = [(i, j, k) for (i, j), k in known.items()] + [(t, t + 1, OTHER) for t in range(n) if t not in inside]
        for i, j, k in sorted(steps):
            names = next((x[2] for x in segments[j] if x[0] == i and x[1] == k), None)
            if names is not None:
                grad[f"{prev}>{k}"] += 1
                for name in names:
                    grad[name] += 1
            prev = k

    def fit(self, examples: list[tuple[Region, list[tuple[int, str, int]]]], rounds: int = 12, rate: float = 0.5, decay: float = 0.002) -> SemiMarkov:
        """Gradient ascent with per-weight rates on the regularised log-likelihood."""
        squares: dict[str, float] = defaultdict(float)
        for _ in range(rounds):
            for region, gold in examples:
                grad: dict[str, float] = defaultdict(float)
                self._gradient(region, gold, grad)
                for name, g in grad.items():
                    g -= decay * self.weights.get(name, 0.0)
                    squares[name] += g * g
                    if squares[name]:
                        self.weights[name] = self.weights.get(name, 0.0) + rate * g / math.sqrt(squares[name])
        return self


def example(text: str, spans: list[tuple[str, int, int]]) -> tuple[Region, list[tuple[int, str, int]]]:
    """A region with its gold segments; spans that do not fall on token edges are left out."""
    region = Region(text)
    first, last = {a: i for i, (a, _) in enumerate(region.at)}, {b: i + 1 for i, (_, b) in enumerate(region.at)}
    gold, end = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a in first and b in last and first[a] >= end and first[a] in region.starts(last[b]) and k in region.kinds(first[a], last[b]):
            gold.append((first[a], k, last[b]))
            end = last[b]
    return region, gold


def varied(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The region with one span's notation changed: no country code, other separators."""
    out = []
    for k, a, b in spans:
        s = text[a:b]
        forms = []
        if k == "phone":
            bare = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", s)
            plain = bare.replace("(", "").replace(") ", "-").replace(")", "-")
            forms = [bare, bare.replace("-", " "), plain, plain.replace("-", " "), plain.replace("-", ".")]
        elif k == "card" and len(_digits(s)) == 16:
            d = _digits(s)
            forms = [sep.join(d[i:i + 4] for i in range(0, 16, 4)) for sep in (" ", "-", ".")]
        for f in forms:
            if f != s and len(spans) == 1:
                out.append((text[:a] + f + text[b:], [(k, a, a + len(f))]))
    return out


def regions(text: str) -> Iterator[tuple[int, str]]:
    return ((m.start(), m[0]) for m in REGION.finditer(text))


def training_examples(texts: list[str], per_text_limit: int = 6, max_region: int = 400, seed_every: int = 20) -> list[tuple[Region, list[tuple[int, str, int]]]]:
    """Regions labelled by the base patterns, with their varied forms; the seeds come first and again after every ``seed_every`` texts.

    Of each text the first ``per_text_limit`` regions shorter than ``max_region`` characters are taken."""
    pairs = [(t, list(s)) for t, s in SEEDS]
    for n, text in enumerate(texts, 1):
        spans = [(KINDS[k], a, b) for a, k, b in base_spans(text)]
        for at, body in islice(((at, body) for at, body in regions(text) if len(body) < max_region), per_text_limit):
            pairs.append((body, [(k, a - at, b - at) for k, a, b in spans if at <= a and b <= at + len(body)]))
        if n % seed_every == 0:
            pairs += [(t, list(s)) for t, s in SEEDS]
    full = [p for pair in pairs for p in (pair, *varied(*pair))]
    return [x for x in (example(t, s) for t, s in full) if x[0].tokens]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 300, max_chars: int = 20_000) -> SemiMarkov:
    """Weights from a bounded sample of ``docs`` (see the module's head)."""
    own = docs.select(F.xxhash64(col(id_col)).alias("h"), col(text_col).alias("text"))
    own = own.filter(F.col("text").rlike(r"@|[0-9][^A-Za-z]{0,3}[0-9][^A-Za-z]{0,3}[0-9]") & (F.length("text") <= max_chars))
    # About twice the rows needed pass a hash threshold, so that tasks do not each send a full sample.
    share = (2.0 * sample_docs + 50) / max(1, own.count())
    near = own.filter(F.pmod("h", F.lit(1 << 30)) < F.lit(min(1.0, share) * (1 << 30)))
    rows = near.orderBy(F.pmod("h", F.lit(1 << 30)), "h", "text").limit(sample_docs).collect()
    return SemiMarkov().fit(training_examples([r["text"] for r in rows]))


def find(text: str | None, model: SemiMarkov) -> list[tuple[int, int, int]]:
    """Base spans and the model's spans that touch none of them, as ``(start, kind number, end)`` in order."""
    if not text or not re.search("[0-9@]", text):
        return []
    out = base_spans(text)
    taken, reach = [a for a, _, _ in out], [0, *accumulate((b for _, _, b in out), max)]
    added = []
    for at, body in regions(text):
        region = Region(body)
        if not any(region.starts(j) for j in range(1, len(region.tokens) + 1)):
            continue
        for i, k, j in model.best(region):
            a, b = at + region.at[i][0], at + region.at[j - 1][1]
            if reach[bisect_left(taken, b)] <= a:
                added.append((a, KINDS.index(k), b))
    return sorted(out + added)


def listing(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, n_added long, base string, spans string"


def personal_data(docs: DataFrame, model: SemiMarkov, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a struct ``out`` of ``SCHEMA``: base counts, and base and all spans as ``kind:start:end`` lists."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def found(text: str | None) -> tuple:
        spans = find(text, shared.value)
        base = base_spans(text) if spans else []
        counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
        return *counts, len(spans) - len(base), listing(base), listing(spans)

    return docs.withColumn(out, per_text(docs.sparkSession, SCHEMA, found)(col(text_col)))
