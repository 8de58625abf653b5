"""Whitening against numpy on the same whole numbers; edge rows."""

import math

import numpy as np
import pytest

VECTORS = "vec_id bigint, embedding array<float>, label int, n int, at string, whitened string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, "x", "y") for i, v in rows], VECTORS)


def brute(rows, components=16):
    """{(vec_id, component): (deviation, whitened, explained)}, n; one vec_id a row."""
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    a = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in fit])
    v = a.T @ a / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, row in x.items():
        apart = [n * c - s for c, s in zip(row, sums, strict=True)]
        for k in range(min(components, len(e))):
            if e[k] > e[0] * len(e) * np.finfo(float).eps:
                out[i, k + 1] = (sum(d * d for d in apart), np.array(apart) / n @ u[:, k] / math.sqrt(e[k]), e[k] / np.trace(v))
    return out, n


def compare(spark, rows, extra=()):
    from txmon.llm import whitening as m
    got = m.whiten(table(spark, [*rows, *extra])).collect()
    want, n = brute(rows)
    assert len(got) == len(want) and all(r.n == n and r.identity_error < 1e-9 for r in got)
    signs = {}
    for r in got:
        deviation, whitened, explained = want[r.vec_id, r.component]
        sign = signs.setdefault(r.component, 1 if whitened * r.whitened >= 0 else -1) if abs(whitened) > 1e-6 else 1
        assert r.deviation == deviation and r.explained == pytest.approx(explained, rel=1e-9)
        assert r.whitened == pytest.approx(sign * whitened, abs=1e-7) or abs(whitened) <= 1e-6
    return got


def vectors(n, dim, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) @ rng.standard_normal((dim, dim))
    return [(i, [float(c) for c in row.astype(np.float32)]) for i, row in enumerate(x)]


def test_whitening_matches_numpy(spark, monkeypatch):
    """More rows than a block, several column blocks, a third of all rows equal; rows that take no part."""
    from txmon.llm import whitening as m
    monkeypatch.setattr(m, "ROWS", 64)
    monkeypatch.setattr(m, "COLS", 8)
    rows = vectors(300, 20)
    rows += [(1000 + i, rows[5][1]) for i in range(150)]
    odd = [(2000, None), (2001, []), (2002, [None] * 20), (2003, [float("nan")] + [0.0] * 19),
           (2004, [float("inf")] + [0.0] * 19), (2005, [1.0, 2.0])]
    got = compare(spark, rows, odd)
    assert {r.component for r in got} == set(range(1, 17)) and {r.vec_id for r in got} == {i for i, _ in rows}


def test_whitening_few_components_and_flat_dimensions(spark):
    """Fewer dimensions than components; a dimension that never varies has no component."""
    got = compare(spark, [(i, [*v, 1.5]) for i, v in vectors(40, 3)])
    assert {r.component for r in got} == {1, 2, 3}


def test_whitening_empty_and_single(spark):
    from txmon.llm import whitening as m
    assert m.whiten(table(spark, [])).count() == 0
    assert m.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    assert m.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance


def test_whitening_null_ids_and_repeated_rows(spark):
    from txmon.llm import whitening as m
    rows = vectors(30, 4)
    got = m.whiten(table(spark, [*rows, rows[0], (None, rows[1][1])])).collect()
    assert len(got) == 32 * 4 and {r.n for r in got} == {30}
    assert sorted(r.whitened for r in got if r.vec_id is None) == sorted(r.whitened for r in got if r.vec_id == 1)


def test_whitening_exact_beyond_longs(spark):
    """Squares that need more than 64 bits are summed exactly; what fits into no long is null."""
    from txmon.llm import whitening as m
    rows = [(0, [3e9, 0.0]), (1, [-3e9, 1.0]), (2, [1e9, 5.0])]
    got = {r.vec_id: r.deviation for r in m.whiten(table(spark, rows)).collect()}
    want, _ = brute(rows)
    assert got == {i: d if (d := want[i, 1][0]) < 1 << 63 else None for i, _ in rows}
    assert any(v is None for v in got.values())


def test_whitening_moments_in_decimals(spark, monkeypatch):
    """The wide arithmetic gives what the narrow one gives."""
    from txmon.llm import whitening as m
    rows = vectors(50, 5)
    want = sorted(map(str, m.whiten(table(spark, rows)).collect()))
    plain = m.Moments.__init__

    def wide(self, *a):
        plain(self, *a)
        self.exact_in_long = self.squares_in_long = False

    monkeypatch.setattr(m.Moments, "__init__", wide)
    assert sorted(map(str, m.whiten(table(spark, rows)).collect())) == want
