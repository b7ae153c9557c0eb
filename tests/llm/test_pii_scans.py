"""PII: linear scans against the stated patterns, segmentation against enumeration, notations that no seed holds, long texts."""

import random
import re
import time

import pytest

from churnspark.llm import pii

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]")


def stated(text):
    """The contract's base spans, read with its own patterns and checks."""
    def digits(s):
        return [int(c) for c in s if c in "0123456789"]

    def card(s):
        d = digits(s)[::-1]
        return 12 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    checks = (lambda s: True, lambda s: all(int(x) <= 255 for x in s.split(".")), card, lambda s: 9 <= len(digits(s)) <= 15)
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if checks[k](m[0]))


@pytest.mark.parametrize("alphabet", ["a.@-1 +", "01.", "12 -+()", "ab@.1é\n ", "0123456789 -.", "a1 \t@x"])
def test_base_spans_follow_the_patterns(alphabet):
    draw = random.Random(alphabet)
    for _ in range(2000):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40)))
        assert pii.base_spans(text) == stated(text)


def test_base_spans_in_full_notation():
    text = "a@b.c@d.e 1.2.3.4.5.6.7.8 256.1.1.1 4465 7583-8288 9437 +49 (30) 1234-5678 x@y " + "0" * 5000 + ".1.1.1"
    assert pii.base_spans(text) == stated(text[:-5006]) + [(len(text) - 5006, 1, len(text))]


def test_best_segmentation_is_the_best_of_all():
    model = pii.SemiMarkov().fit(pii.training_examples([]))

    def value(steps):
        total, last = 0.0, pii.OTHER
        for _, kind, names in steps:
            total += sum(model.weights.get(n, 0.0) for n in names) + model.weights.get(f"{last}>{kind}", 0.0)
            last = kind
        return total

    for text in ("(212) 867-5309 10:30", "5425.2334.3010.9903 11/29", "10.0.0.1 8080", "x a.b@c.de 12"):
        region = pii.Region(text)
        by_end = [[], *model._segments(region)]

        def all_ways(j):
            if not j:
                return [[]]
            return [way + [seg] for seg in by_end[j] for way in all_ways(seg[0])]

        ways = all_ways(len(region.tokens))
        got, at, steps = model.best(region), 0, []
        for i, kind, j in [*got, (len(region.tokens), None, None)]:
            steps += [next(s for s in by_end[t] if s[1] == pii.OTHER) for t in range(at + 1, i + 1)]
            if kind:
                steps.append(next(s for s in by_end[j] if s[0] == i and s[1] == kind))
                at = j
        assert len(ways) > 1 and abs(value(steps) - max(map(value, ways))) < 1e-9


def test_notations_that_no_seed_holds():
    model = pii.SemiMarkov().fit(pii.training_examples([]))
    for text, kind, want in (
            ("212.867.5309 212.867.5310", "phone", ["212.867.5309", "212.867.5310"]),
            ("(212) 867-5309, (212) 867-5310", "phone", ["(212) 867-5309", "(212) 867-5310"]),
            ("5425.2334.3010.9903 11/29", "card", ["5425.2334.3010.9903"]),
            ("6011.0009.9013.9424 until 12/31 12:00", "card", ["6011.0009.9013.9424"]),
            ("2021-05-06 10:30:15.123", "phone", [])):
        assert [(pii.KINDS[k], text[a:b]) for a, k, b in pii.find(text, model)] == [(kind, w) for w in want]


def test_long_texts_are_read_in_linear_time():
    model, m = pii.SemiMarkov().fit(pii.training_examples([])), 1_000_000
    for text in ("7" * m, "1 x" + "漢" * m, "a" * m + " x@y 1", "0" * m + ".1.1.1", "x" * m + "@" + "y" * m + ".z"):
        start = time.time()
        assert len(pii.find(text, model)) == (text[-1] == "z" or text.endswith(".1.1.1"))
        assert time.time() - start < 20


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    text = "mail a.b@c.example and 10.20.30.40"
    rows = [(1, text, "p"), (1, text, "p"), (None, text, "q"), (2, None, None), (3, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = pii.personal_data(docs, pii.SemiMarkov()).collect()
    assert [r["doc_id"] for r in got] == [1, 1, None, 2, 3]
    assert [r["pii"]["spans"] for r in got] == ["email:5:18,ip:23:34"] * 3 + ["", ""]
