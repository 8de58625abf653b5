"""The rule ledger against plain counting; policies and ablations against a second look at every row."""

import random
import re
from collections import Counter

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_words string, fail_bits string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", "x", "y") for i, t in rows], DOCS)


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    three = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(three)
    inside = {i + k for i, t in enumerate(three) if often[t] > 1 for k in range(3)}
    seen, again, lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, again, len(inside),
            len(re.findall("[A-Z]", text)), text.count("!"))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    sentence = lambda n, k: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    out = [None, "", " \t\n", "a", "a b c", "a b c a b c", "x\x0bx\x0cx x x x", "!!! ###\n!!! ###\n\n \n", "é" * 300,
           "a a a a", "\x1c\x85\xa0 not blanks", "line\nline \nline", "퟿ \U0001f600 |<>|"]
    out += [sentence(rng.randrange(1, 120), k) + "\n" + sentence(30, k) for k in (2, 5, 40, 2000) for _ in range(12)]
    out += [sentence(20_000, 300), "LOUD WORDS HERE! " * 30, "# $ % word " * 40, ("same line of text here\n") * 20]
    return list(enumerate(out))


def test_ledger_measures_every_text(spark, texts):
    from txmon.llm import quality_rules as m
    got = {r.doc_id: tuple(r[c] for c in m.MEASURES) for r in m.ledger(table(spark, texts)).collect()}
    assert got == {i: brute(t) for i, t in texts}


def test_repeated_words_with_many_names():
    """Numbers of windows stay exact where a plain product would leave 64 bits."""
    from txmon.llm.quality_rules import repeated
    words = [f"v{i}" for i in range(40)] * 2
    assert repeated(words, 3) == 80 and repeated(words, 14) == 80
    assert repeated(words[:41], 14) == 0


def test_rules_policies_and_ablation(spark, texts):
    from txmon.llm import quality_rules as m
    book = m.ledger(table(spark, texts)).cache()
    rows = book.collect()
    failed = {r.doc_id: {n for n, b in m.BIT.items() if r.fail_bits & b} for r in rows}
    assert all("few_words" in failed[i] for i, t in texts if len((t or "").split()) < 50)
    assert {n for f in failed.values() for n in f} >= {"few_words", "repeated_words", "symbols", "repeated_lines", "upper_case"}
    for policy in m.POLICIES:
        kept = {r.doc_id for r in m.apply_policy(book, policy).collect() if r.kept}
        assert kept == {i for i, f in failed.items() if not f & set(policy.rules)}
    words = {r.doc_id: r.n_words for r in rows}
    got = {(r.version, r.rule): tuple(r)[2:] for r in m.ablation(book).collect()}
    want = {}
    for p in m.POLICIES:
        for rule in p.rules:
            others = set(p.rules) - {rule}
            back = [i for i, f in failed.items() if not f & others]
            want[p.version, rule] = (
                len(rows), sum(not f & set(p.rules) for f in failed.values()), sum(rule in f for f in failed.values()),
                sum(f & set(p.rules) == {rule} for f in failed.values()), len(back), sum(words[i] for i in back))
    assert got == want
    (all_,) = m.reach(book).collect()
    ever, always = 0, -1
    for r in rows:
        ever, always = ever | r.fail_bits, always & r.fail_bits
    assert (all_.docs, all_.ever, all_.always) == (len(rows), ever, always)


def test_ledger_edges(spark):
    from txmon.llm import quality_rules as m
    none = table(spark, [])
    assert m.ledger(none).count() == 0 and m.ablation(m.ledger(none)).count() == 0
    rows = m.ledger(table(spark, [(None, "a b"), (4, "a b"), (4, "a b"), (5, None)])).collect()
    assert sorted((str(r.doc_id), r.n_words, r.fail_bits & 1) for r in rows) == [
        ("4", 2, 1), ("4", 2, 1), ("5", 0, 1), ("None", 2, 1)]


def test_bits_are_stable():
    """Bits of rules already in ledgers; new rules are added behind them."""
    from txmon.llm.quality_rules import BIT, RULES
    assert list(RULES)[:8] == ["few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words",
                               "upper_case", "bangs"]
    assert [BIT[r] for r in RULES] == [1 << i for i in range(len(RULES))]
