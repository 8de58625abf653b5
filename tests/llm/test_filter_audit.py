"""The filter audit against filters applied document by document in every order."""

import random
import re
from itertools import permutations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, part string, mask int, digest string"
LABELS = "doc_id bigint, quality int, toxic int, part string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, "p", 3, "d") for i, t, s in rows], DOCS)


def labels(spark, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], LABELS)


def fails(rows):
    out = []
    for i, text, source in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            f.add("C")
        if re.search(r"[#$%&*|]", t):
            f.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows):
            f.add("E")
        out.append((i, source or "", f))
    return out


def brute(rows, marks):
    docs, out = fails(rows), {}
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, x in marks if x == 1 and i is not None}
    shapley = {}
    for part in {p for _, p, _ in docs}:
        own = [(i, f) for i, p, f in docs if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                out[part, order, step] = (
                    len(left), len(gone), sum(letter in f for _, f in own) - len(gone), sum(f == {letter} for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(spark, rows, marks):
    from txmon.llm import filter_audit as m
    df = m.audit(m.cells(m.masks(table(spark, rows)), labels(spark, marks)))
    assert df.columns == ["part", "filter_order", "step", *m.METRICS, "shapley"]
    return {(r[0], r[1], r[2]): tuple(r)[3:] for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    text = lambda n, k, extra="": " ".join([f"w{rng.randrange(k)}" for _ in range(n)] + [extra] * bool(extra))
    out = [(1, None, "a"), (2, "", "b"), (3, " \t", None), (4, "", ""), (None, "", "a"), (None, text(210, 900), "a")]
    for i in range(60):
        t = text(rng.choice([20, 199, 200, 260]), rng.choice([30, 5000]), rng.choice(["", "#", "LOUD" * rng.randrange(40)]))
        out.append((10 + i, t, rng.choice(["a", "b", None])))
    out += [(200 + i, out[10][1], "b") for i in range(40)] + [(205, out[10][1], "b"), (9, out[10][1], "a")]
    return out


def test_audit_matches_every_order(spark, rows):
    rng = random.Random(6)
    marks = [(i, rng.randrange(2), rng.randrange(2)) for i, _, _ in rows if rng.random() < 0.7]
    marks += [(None, 1, 1), (10, None, 1), (10, 1, None), (777, 1, 1)]
    got, want = result(spark, rows, marks), brute(rows, marks)
    assert len(want) == 3 * 600 and got == want


def test_audit_edges(spark, rows):
    assert result(spark, [], [(1, 1, 1)]) == {}
    few = rows[:3]
    assert result(spark, few, []) == brute(few, [])


def test_audit_other_letters(spark):
    """Two filters: the cells decide, whatever the letters stand for."""
    from txmon.llm import filter_audit as m
    cells = spark.sql("SELECT 'p' AS part, array(named_struct('mask', 1, 'n', 5L, 'good', 1L, 'toxic', 0L), "
                      "named_struct('mask', 3, 'n', 7L, 'good', 0L, 'toxic', 2L), named_struct('mask', 0, 'n', 2L, 'good', 2L, "
                      "'toxic', 0L)) AS cells")
    got = sorted(tuple(r) for r in m.audit(cells, "XY").collect())
    assert got == [("p", "XY", 1, 2, 12, 0, 5, 1, 2, 17), ("p", "XY", 2, 2, 0, 7, 0, 0, 0, 7),
                   ("p", "YX", 1, 7, 7, 0, 0, 0, 2, 7), ("p", "YX", 2, 2, 5, 7, 5, 1, 0, 17)]
    with pytest.raises(ValueError):
        m.audit(cells, "XX")


def test_recursion_limit_is_restored(spark, rows):
    """Thousands of parts exceed Spark's own row limit, and the session's setting comes back."""
    from txmon.llm import filter_audit as m
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    cells = spark.range(3300).selectExpr(
        "concat('s', id) AS part", "array(named_struct('mask', 1, 'n', id, 'good', 0L, 'toxic', 0L)) AS cells")
    out = m.audit(cells)
    assert out.count() == 3300 * 600 and spark.conf.get(key) == before
