"""Language identification by cross-parsing entropy.

Each language's labelled text becomes a suffix automaton. A new text is parsed
against each automaton: every phrase is the longest match that starts where the
last one ended (one letter where nothing matches). A text of a language needs
few phrases, so the language with the lowest ``phrases * log2(training
letters)`` wins; the factor makes automata of different sizes comparable
(c log n bits to point at c phrases among n places). Phrases do not span white
space: each word is parsed with a space on both sides, which lets one parse of
a word serve all its occurrences.

A word is a letter (Unicode category L) and the letters and marks (M) after it;
digits, numerals and signs are none.

Learning uses a bounded sample: the first ``max_chars`` characters of at most
``rows_per_language`` texts for each language, the first by a hash of the id,
until ``letters`` training letters are reached as far as they have them. At
most ``max_languages`` languages are accepted, more raise an error. These
bounds keep what travels to the tasks small at any input size; prediction reads
every whole text and shuffles nothing.

Edge cases: null texts and texts without a letter give ``und`` with score 0, as
does a table with no labelled text. Ties go to the first label in order. Score:
``1 - best / second`` of the bits (1 if only one language is known).
"""

from __future__ import annotations

import math
from collections import Counter

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from churnspark.llm.common import built, col, per_text

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
CACHE = 300_000


def automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of ``text``: walks from state 0 spell exactly its substrings."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in text:
        now = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return step


def phrases(step: list[dict[str, int]], text: str) -> int:
    """Number of longest-match phrases that ``text`` needs."""
    count, state = 0, 0
    for c in text:
        to = step[state].get(c)
        if to is None:
            if state:
                count += 1
                to = step[0].get(c)
            if to is None:  # an unseen letter is a phrase of its own
                count += 1
                to = 0
        state = to
    return count + (state > 0)


def letters_only(text: str) -> str:
    return " " + " ".join(WORD.findall(text.lower())) + " "


class CrossParser:
    """Automata of all languages and the phrase counts of the words seen so far (at most ``CACHE``)."""

    def __init__(self, training: dict[str, str]):
        self.labels = sorted(training)
        self.steps = [automaton(training[k]) for k in self.labels]
        self.bits = [math.log2(max(2, len(training[k]))) for k in self.labels]
        self.known: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = [phrases(s, f" {word} ") for s in self.steps]
            if len(word) <= 40:
                self.known[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        words = Counter(WORD.findall(text.lower())) if text and self.labels else None
        if not words:
            return "und", 0.0
        total = [0] * len(self.labels)
        for w, n in words.items():
            for i, x in enumerate(self.word(w)):
                total[i] += n * x
        cost = sorted((x * b, k) for x, b, k in zip(total, self.bits, self.labels))
        return cost[0][1], 1.0 if len(cost) < 2 else 1.0 - cost[0][0] / cost[1][0]


def training_text(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  rows_per_language: int = 60, max_chars: int = 20_000, letters: int = 100_000,
                  max_languages: int = 500) -> dict[str, str]:
    """Bounded labelled sample: language -> training letters. ``learn`` says which rows may be used; of a longer
    text the first ``max_chars`` code points are learned, so a language of long texts alone is learned too."""
    own = docs.filter(learn & col(lang_col).isNotNull() & col(text_col).isNotNull())
    own = own.select(col(lang_col).alias("lang"), F.substring(col(text_col), 1, max_chars).alias("text"),
                     F.xxhash64(col(id_col), col(lang_col)).alias("h"))
    sizes = own.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not sizes:
        return {}
    # About twice the rows needed pass a hash threshold, so the exact choice sorts only those.
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, (2.0 * rows_per_language + 50) / r["count"]))])
    near = own.filter((F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))) < share[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h", "text"))
    rows = near.withColumn("k", rank).filter(F.col("k") <= rows_per_language).collect()
    out: dict[str, str] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["k"])):
        have = out.get(r["lang"], "")
        if len(have) < letters:
            out[r["lang"]] = (have + letters_only(r["text"]))
    return {k: v for k, v in out.items() if v.strip()}


def identify(docs: DataFrame, training: dict[str, str], text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out``: ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(training)

    def predicted(text: str | None) -> tuple[str, float]:
        return built(CrossParser, shared.value).predict(text)

    guess = per_text(docs.sparkSession, "lang_pred string, score double", predicted)
    return docs.withColumn(out, guess(col(text_col)))
