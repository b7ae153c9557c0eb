"""Line-first quality rules: judge lines, remove the failing ones, then reject
documents that lost too much of their text.

A line (cut at ``\\n``) with at least one word fails when one of these holds:

* navigation: it is a menu (``|`` as every fifth word or more), or it has at
  most three words and no sentence mark at its end;
* punctuation: it has no sentence mark anywhere, or symbols ``#*$%&|<>`` are
  more than a tenth of its words, or half of its words or more end in ``!!``;
* boilerplate: it holds a phrase of ``BOILERPLATE`` (legal notices, consent
  banners, placeholders), or it has ten words or more of which less than a
  third differ.

A document is kept when its base rule holds (50 words or more, not more than
half of them in repeated three-word windows) and failing lines held at most
``max_lost`` of its words.

These line rules are those of op7 and its SQL twin. ``keep_clean`` (the pipeline)
judges by ``PROSE``, which loses no clean prose to them: a phrase counts as whole
words, in lines of at most ``notice_words`` words that are no part of a wrapped
sentence, or where phrases are ``notice_share`` of the words; a line without a sentence mark passes where another
sound line of its paragraph (lines without a blank one between) has one; marks
are those of all scripts; and lines mostly in a script that writes no marks or no
blanks between words are not judged by marks or by their number of words.

Edge cases: a null or blank text has no words, fails the base rule and is not
kept; its cleaned text is empty (null stays null). Repeated rows are judged
alike, each for itself. One document is one row of one task; nothing is
shuffled, and memory is that of one Arrow batch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import col, fresh, per_text

# Phrases of notices, banners and placeholders, compared without case.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "general public license", "copyright",
    "cookie", "javascript", "privacy policy", "terms of use", "terms of service", "lorem ipsum", "click here",
    "sign in", "subscribe", "skip to content",
)
MARKS = ".!?;:,…。！？"
END_MARKS = MARKS + "\"'”’»)]"
SYMBOLS = "#*$%&|<>"
#: Unicode's Sentence_Terminal marks, and commas, colons and semicolons of other scripts.
ALL_MARKS = MARKS + (
    "\u0589\u061b\u061d\u061e\u061f\u060c\u06d4\u0700\u0701\u0702\u07f9\u0837\u0839\u083d\u083e\u0964\u0965\u0df4\u0e5a\u0e5b"
    "\u0f08\u0f0d\u0f0e\u104a\u104b\u1361\u1362\u1363\u1364\u1365\u1366\u1367\u1368\u166e\u1735\u1736\u17d4\u17d5\u1803\u1808\u1809"
    "\u1944\u1945\u1aa8\u1aa9\u1aaa\u1aab\u1b5a\u1b5b\u1b5e\u1b5f\u1c3b\u1c3c\u1c7e\u1c7f\u203c\u203d\u2047\u2048\u2049\u2e2e\u2e3c"
    "\u2e53\u2e54\u3001\ua4fe\ua4ff\ua60e\ua60f\ua6f3\ua6f7\ua876\ua877\ua8ce\ua8cf\ua92f\ua9c8\ua9c9\uaa5d\uaa5e\uaa5f\uaaf0\uaaf1"
    "\uabeb\ufe50\ufe52\ufe56\ufe57\uff0c\uff0e\uff1a\uff1b\uff61\uff64")
#: Scripts that end sentences by blanks (Thai, Lao), or put none between words (also Tibetan, Myanmar, Khmer, Kana, Han).
UNMARKED = re.compile("[\u0e01-\u0e4e\u0e81-\u0ece]")
UNSPACED = re.compile("[\u0e01-\u0e4e\u0e81-\u0ece\u0f40-\u0fbc\u1000-\u1049\u1780-\u17d3\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))
_SYMBOL = re.compile(r"[#*$%&|<>]")
_MARK = re.compile("[" + re.escape(MARKS) + "]")
_ALL_MARK = re.compile("[" + re.escape(ALL_MARKS) + "]")
_ALL_ENDS = ALL_MARKS + END_MARKS[len(MARKS):] + "\u300d\u300f\uff09\u203a"
_NOTICE = re.compile(r"\b(?:" + "|".join(re.escape(p) + ("s?" if p == "cookie" else "") for p in BOILERPLATE) + r")\b")
_SPACE = re.compile(r"[\x20\x09-\x0D]")

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "n_lines long, n_removed_lines long, n_lost_words long, kept boolean, clean_text string")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; the defaults are the production ones."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_lost: float = 0.3
    max_symbols_per_word: float = 0.1
    menu_share: float = 0.2
    short_line: int = 3
    least_distinct: float = 1 / 3
    #: Rules for clean prose (see the module's head) with the limits of notices and of a short line in letters.
    prose: bool = False
    notice_words: int = 12
    notice_share: float = 0.25
    short_letters: int = 12


PROSE = Rules(prose=True)


def line_fails(line: str, words: list[bytes], rules: Rules = Rules()) -> bool:
    """Whether a line with ``words`` breaks a navigation, punctuation or boilerplate rule."""
    n = len(words)
    if words.count(b"|") >= rules.menu_share * n or n <= rules.short_line and line.rstrip()[-1] not in END_MARKS:
        return True
    if not _MARK.search(line):
        return True
    if len(_SYMBOL.findall(line)) > rules.max_symbols_per_word * n:
        return True
    if "!!" in line and 2 * sum(w.endswith(b"!!") for w in words) >= n:
        return True
    if n >= 10 and len(set(words)) < rules.least_distinct * n:
        return True
    return bool(_BOILERPLATE.search(line.lower()))


def _mostly(script: re.Pattern, line: str) -> bool:
    """Whether half of the line's signs that are no blanks or more belong to ``script``."""
    return not line.isascii() and 2 * len(script.findall(line)) >= len(line) - len(_SPACE.findall(line))


def notice(line: str, words: list[bytes], wrapped: bool = False, rules: Rules = PROSE) -> bool:
    """Whether phrases of ``BOILERPLATE`` stand in a short line (one that is not part of a wrapped sentence) or are a large share of a line."""
    found = [m[0] for m in _NOTICE.finditer(line.lower())]
    return bool(found) and (not wrapped and len(words) <= rules.notice_words or sum(len(p.split()) for p in found) >= rules.notice_share * len(words))


def prose_fails(lines: list[tuple[str, list[bytes]]], rules: Rules = PROSE) -> list[bool]:
    """For each line (with its words) whether it fails by the rules for clean prose."""
    out, marked = [], []
    open_end = [bool(words) and line.rstrip()[-1] not in _ALL_ENDS for line, words in lines]
    for i, (line, words) in enumerate(lines):
        n = len(words)
        wrapped = i > 0 and open_end[i - 1] or open_end[i] and i + 1 < len(lines) and bool(lines[i + 1][1])
        unspaced = n > 0 and _mostly(UNSPACED, line)
        short = len(UNSPACED.findall(line)) <= rules.short_letters if unspaced else n <= rules.short_line
        out.append(n > 0 and (
            words.count(b"|") >= rules.menu_share * n
            or short and open_end[i]
            or len(_SYMBOL.findall(line)) > rules.max_symbols_per_word * (len(line) / 4 if unspaced else n)
            or "!!" in line and 2 * sum(w.endswith(b"!!") for w in words) >= n
            or n >= 10 and len(set(words)) < rules.least_distinct * n
            or notice(line, words, wrapped, rules)))
        marked.append(bool(_ALL_MARK.search(line)))
    start = 0
    for end in [i for i, (_, words) in enumerate(lines) if not words] + [len(lines)]:
        if not any(marked[i] and not out[i] for i in range(start, end)):
            for i in range(start, end):
                out[i] = out[i] or not marked[i] and not _mostly(UNMARKED, lines[i][0])
        start = end + 1
    return out


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen: set = set()
    twice = {w for w in windows if w in seen or seen.add(w)} if len(set(windows)) < len(windows) else ()
    if not twice:
        return 0
    count, end = 0, 0
    for i, w in enumerate(windows):
        if w in twice:
            count += i + 3 - max(end, i)
            end = i + 3
    return count


def judge(text: str | None, rules: Rules = Rules()) -> tuple:
    """One document's row of ``SCHEMA``."""
    if not text:
        return 0, 0, 0, 0, 0, True, 0, 0, 0, False, text
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    earlier: set[str] = set()
    kept_lines, n_lines, n_dup, removed, lost = [], 0, 0, 0, 0
    lines = [(line, line.encode("utf-8", "surrogatepass").split()) for line in text.split("\n")]
    fails = prose_fails(lines, rules) if rules.prose else [bool(own) and line_fails(line, own, rules) for line, own in lines]
    for (line, own), fail in zip(lines, fails):
        if own:
            n_lines += 1
            if line in earlier:
                n_dup += 1
            else:
                earlier.add(line)
            if fail:
                removed += 1
                lost += len(own)
                continue
        kept_lines.append(line)
    repeats = repeated_words(words)
    failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    kept = not failed and lost <= rules.max_lost * n
    chars = len(text) - len(_SPACE.findall(text))
    return n, chars, len(_SYMBOL.findall(text)), n_dup, repeats, failed, n_lines, removed, lost, kept, "\n".join(kept_lines)


def quality_rules(docs: DataFrame, text_col: str = "text", rules: Rules = Rules(), out: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``out`` of ``SCHEMA`` (counts, verdict and the text without failing lines)."""
    judged = per_text(docs.sparkSession, SCHEMA, lambda text: judge(text, rules))
    return docs.withColumn(out, judged(col(text_col)))


def keep_clean(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", rules: Rules = PROSE) -> DataFrame:
    """Documents that pass, with their cleaned text (and its length in ``chars_col``); same columns as ``docs``."""
    (q,) = fresh(docs, "quality")
    judged = quality_rules(docs, text_col, rules, q).filter(col(q)["kept"])
    clean = col(q)["clean_text"]
    new = {text_col: clean, chars_col: F.char_length(clean).cast(docs.schema[chars_col].dataType) if chars_col in docs.columns else None}
    return judged.select(*[(new[c] if c in new else col(c)).alias(c) for c in docs.columns])
