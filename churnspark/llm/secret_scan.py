"""Secret scan with DataFrame functions only.

Base kinds are patterns (leftmost, non-overlapping, each kind by itself):

* ``assign``: a credential name, ``:`` or ``=``, and a value of 12 characters or more;
* ``access``: ``AKIA`` and capitals or digits, 18 characters or more in all;
* ``hex``: 16 or more of ``[0-9a-f]``.

The method adds kind ``entropy``: candidate strings of 20 or more characters
``[A-Za-z0-9+/_=-]`` with a letter are read through a sliding window of
``WINDOW`` characters. The window keeps a count for each different character;
one that enters or leaves changes its own count by one and the sum by its own
term ``c log2 c``. The highest entropy met is held against the limit of the
string's character class (hex digits; one letter case and digits; both cases
or signs). Strings that the allow-list matches as a whole (identifiers, paths of
plain words) are not added, nor are strings that overlap a base span. Sample
words and runs of the alphabet or of digits only take the windows that touch
them out, so a key beside such a word is still found. Letters of one case alone
count as a word: entropy does not tell them from long compounds.

Positions are code points, end exclusive. They come from the pieces between the
matches, whose lengths add up.

Edge cases: a null text counts as empty and has no spans; the digest of no
spans is that of the empty text. Repeated rows are scanned each for itself, an
empty table gives no row. Spans with one start stand in the order of the kinds.
Extra columns stay; one that is named like the output is replaced. Nothing is
shuffled; a long candidate costs its length times its different characters (at
most 67).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import col

# The base patterns and their kinds, in their order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Least entropy (bits a character, over a window) of a secret, by character class.
LIMITS = {"hex": 3.0, "one_case": 3.6, "mixed": 3.8}
#: Strings that look random but are no secrets: UUIDs. Paths of plain words are found by ``_plain_words``.
ALLOWED = (r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",)
#: Parts that no window may touch: sample words, and runs of the alphabet, the keyboard or the digits in full length.
HARMLESS = (r"(?i)example|sample|placeholder|changeme|x{6,}|abcdefgh(i(j(k(l(m(n(o(p(q(r(s(t(u(v(w(x(y(z)?)?)?)?)?)?)?)?)?)?)?)?)?)?)?)?)?)?"
            r"|qwertyui(o(p)?)?|01234567(8(9)?)?|12345678(9(0)?)?|98765432(1(0)?)?")

SPAN = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,match:string>>"


def matches(text: Column, pattern: str, kind_no: int) -> Column:
    """All leftmost non-overlapping matches with their positions, as ``SPAN``."""
    found, rest = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["rest"])
        end = start + F.length(x["found"])
        span = F.struct(start.alias("start"), F.lit(kind_no).alias("kind_no"), end.alias("end"),
                        F.lit(KINDS[kind_no]).alias("kind"), x["found"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).cast(SPAN).alias("out"))

    # arrays_zip pads the last piece, which no match follows; it is cut off
    pairs = F.slice(F.arrays_zip(rest.alias("rest"), found.alias("found")), F.lit(1), F.size(found))
    spans = F.aggregate(pairs, begin, add, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def _term(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def peak_entropy(text: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy of the windows of ``text`` (``window`` characters or more), by incremental counts.

    The state holds a count for each different character of ``text``; a step adds one to the count of the character that
    enters, takes one from that of the character that leaves, and adds the differences of their terms to the sum."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")

    def step(codes: Column):
        def move(acc: Column, i: Column) -> Column:
            enters = F.element_at(codes, i)
            # 0 while the window is not full: no character has that code
            leaves = F.when(i > window, F.element_at(codes, F.greatest(i - window, F.lit(1)))).otherwise(F.lit(0))
            counts = F.transform(acc["counts"], lambda n, k: n + (k + 1 == enters).cast("int") - (k + 1 == leaves).cast("int"))
            more = F.element_at(acc["counts"], enters)
            less = F.element_at(acc["counts"], F.greatest(leaves, F.lit(1)))
            change = _term(more + 1) - _term(more) - F.when(leaves > 0, _term(less) - _term(less - 1)).otherwise(F.lit(0.0))
            total = acc["total"] + F.when(enters == leaves, F.lit(0.0)).otherwise(change)
            bits = F.when(i >= window, F.lit(math.log2(window)) - total / window).otherwise(F.lit(0.0))
            return F.struct(counts.alias("counts"), total.alias("total"), F.greatest(acc["best"], bits).alias("best"))
        return move

    def peak(own: Column) -> Column:
        zero = F.struct(F.transform(own["kinds"], lambda k: F.lit(0)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(1), F.size(own["codes"])), zero, step(own["codes"]), lambda a: a["best"])

    # characters and codes are bound once, each as the only element of an array
    kinds = F.transform(F.array(chars), lambda cs: F.struct(cs.alias("cs"), F.array_distinct(cs).alias("kinds")))
    coded = F.transform(kinds, lambda x: F.struct(x["kinds"].alias("kinds"),
                                                  F.transform(x["cs"], lambda c: F.array_position(x["kinds"], c).cast("int")).alias("codes")))
    return F.element_at(F.transform(coded, peak), 1)


def _plain_words(x: Column) -> Column:
    """Whether every part between separators is words of one case or capitalised, with two letters and four digits beside them at most."""
    return F.forall(F.split(x, "[/_=+-]+"), lambda part: F.regexp_replace(part, "[A-Z]?[a-z]{2,}|[A-Z]{2,}", "").rlike("^[A-Za-z]{0,2}[0-9]{0,4}$"))


def _random_looking(x: Column, window: int, limits: dict[str, float], allowed: tuple[str, ...], harmless: str) -> Column:
    least = (F.when(x.rlike("^([0-9a-f]+|[0-9A-F]+)$"), limits["hex"])
             .when(x.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), limits["one_case"]).otherwise(limits["mixed"]))
    ok = ~_plain_words(x)
    for p in allowed:
        ok = ok & ~x.rlike(p)
    pieces = F.filter(F.split(x, harmless), lambda piece: F.length(piece) >= window)
    return F.when(ok, F.exists(pieces, lambda piece: peak_entropy(piece, window) >= least)).otherwise(F.lit(False))


def secret_spans(docs: DataFrame, text_col: str = "text", out: str = "secrets", window: int = WINDOW,
                 limits: dict[str, float] | None = None, allowed: tuple[str, ...] = ALLOWED, harmless: str = HARMLESS) -> DataFrame:
    """``docs`` with ``out``: all spans in order, as an array of (start, kind_no, end, kind, match)."""
    text = F.coalesce(col(text_col), F.lit(""))
    assign = F.filter(matches(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 12)
    base = F.concat(assign, matches(text, ACCESS, 1), matches(text, HEX, 2))
    loose = F.filter(matches(text, CANDIDATE, 3), lambda s: _random_looking(s["match"], window, limits or LIMITS, allowed, harmless))

    def merged(b: Column) -> Column:
        apart = F.filter(loose, lambda s: ~F.exists(b, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])))
        return F.array_sort(F.concat(b, apart))

    both = F.element_at(F.transform(F.array(base), merged), 1)
    return docs.withColumn(out, both)


def listing(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
