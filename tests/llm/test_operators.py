"""The ten operators against brute force, round trips and planted cases; edge rows for each."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, pattern string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, len(t or ""), "x", "y") for i, t, lang, src in rows], DOCS)


def words(rng, n, stem="w"):
    return " ".join(f"{stem}{rng.randrange(400)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Null, empty, blank, long and repeated texts, exact and near copies, and two languages."""
    rng = random.Random(5)
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "12 !!", "en", "b"),
            (5, words(rng, 9000), "en", "a"), (None, "no id at all here now", "en", "b")]
    base = words(rng, 80).split(" ")
    for i in range(30):  # near copies of one text
        t = list(base)
        t[rng.randrange(80)] = f"edit{i}"
        rows.append((10 + i, " ".join(t), "en", "a"))
    rows += [(50 + i, "Exact copy of  a text\twith spaces" + " " * (i % 3), "en", "c") for i in range(12)]
    rows += [(80 + i, words(rng, 30, "the quick "), "en", "c") for i in range(20)]
    rows += [(120 + i, words(rng, 30, "größe über "), "de", None) for i in range(20)]
    rows += [(200, "Exact copy of a text with spaces", "en", "c")] * 2
    return documents(spark, rows).cache()


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_exact_dedup(spark, corpus):
    from txmon.llm.exact_dedup import exact_dedup, stage
    rows = corpus.select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r").encode()).hexdigest()
    groups = {}
    for r in rows:
        groups.setdefault(sha(r.text), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0, r.doc_id))
    want = sorted((str(r.doc_id), str(min(g)[3]), len(g), r.doc_id == min(g)[3], sha(r.text))
                  for r in rows for g in [groups[sha(r.text)]])
    got = exact_dedup(corpus).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in got) == want
    assert stage(spark, corpus, "").count() == len(groups)
    assert exact_dedup(empty(spark)).count() == 0


def test_exact_dedup_false_positives_keep_results(spark, monkeypatch, corpus):
    """A filter of one full block sends every row to the grouping; nothing changes."""
    from txmon.llm import exact_dedup as m
    want = sorted(map(str, m.exact_dedup(corpus).collect()))
    monkeypatch.setattr(m, "_probes", lambda sha: [m.F.lit(1).cast("bigint")])
    assert sorted(map(str, m.exact_dedup(corpus).collect())) == want


def brute_components(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = [x for x in (t or "").translate(low).replace("\t", " ").replace("\n", " ").split(" ") if x]
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("node", [256, 6])
def test_near_dedup(spark, corpus, monkeypatch, node):
    """With nodes of 6 the dense group exceeds every node at full depth: the exact way for the rest."""
    from txmon.llm import near_dedup as m
    monkeypatch.setattr(m, "NODE", node)
    monkeypatch.setattr(m, "BLOCK", 8)
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").distinct().collect() if r.doc_id is not None]
    want = brute_components(rows)
    got = m.near_dedup(corpus).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {
        (i, *v) for i, v in want.items()}
    assert len(got) == corpus.count() and all(r.kept == (r.doc_id == r.component_id) for r in got)
    if node == 256:
        assert m.near_dedup(empty(spark)).count() == 0


def dense_pairs(n):
    """Pairs of similarity 0.85 whose similarity with all others is 0.82."""
    rows = []
    for i in range(n):
        both = [f"s{j}" for j in range(204)] + [f"p{i}x{j}" for j in range(5)]
        rows += [(2 * i + k, " ".join(both + [f"q{k}y{i}x{j}" for j in range(17)])) for k in (0, 1)]
    return rows


@pytest.mark.parametrize("node,block", [(540, 64), (100, 16)])
def test_near_dedup_dense_region(spark, monkeypatch, node, block):
    """Large nodes of many components are read deeper, with more orders; no pair is lost."""
    from txmon.llm import near_dedup as m
    monkeypatch.setattr(m, "NODE", node)
    monkeypatch.setattr(m, "BLOCK", block)
    deeper = []
    plain = m.more_trees
    monkeypatch.setattr(m, "more_trees", lambda *a: deeper.append(1) or plain(*a))
    rows = dense_pairs(1200)
    sets = [set(m.shingle_set(t).tolist()) for _, t in rows[:4]]
    assert 0.85 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.87
    assert len(sets[0] & sets[2]) / len(sets[0] | sets[2]) < 0.84
    got = m.near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert deeper and {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, _ in rows}


def test_near_dedup_copies_are_not_read_deeper(spark, monkeypatch):
    """2,000 near copies are one component after the first links; two strangers in their nodes cost no depth."""
    from txmon.llm import near_dedup as m
    monkeypatch.setattr(m, "more_trees", lambda *a: pytest.fail("read deeper"))
    rng = random.Random(9)
    base = [f"s{j}" for j in range(200)]
    rows = []
    for i in range(2000):
        t = list(base)
        t[rng.randrange(200)] = f"edit{i}"
        rows.append((i, " ".join(t)))
    rows += [(5000 + i, " ".join(base[:150] + [f"own{i}x{j}" for j in range(60)])) for i in range(2)]
    got = m.near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = {i: c for i, (_, c) in brute_components(rows[:60] + rows[2000:]).items()}
    assert {want[i] for i in range(60)} == {0}
    assert {r.doc_id: r.component_id for r in got} == {i: 0 if i < 2000 else want[i] for i, _ in rows}


def test_near_dedup_stage_percent(spark):
    """Pairs of similarity 0.78 to 0.87 through the pipeline's stage: those of 0.80 and more are one."""
    from txmon.llm import near_dedup as m
    rows, want = [], set()
    for i in range(90):
        own = [f"w{i}x{j}" for j in range(124)]
        other = own[:-8 - i % 9] + [f"v{i}x{j}" for j in range(8 + i % 9)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(other))]
        a, b = (set(tuple(w[k:k + 5]) for k in range(120)) for w in (own, other))
        want |= {2 * i} if 100 * len(a & b) >= 80 * len(a | b) else {2 * i, 2 * i + 1}
    assert 100 < len(want) < 130
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "'en' lang", "'s' source", "cast(length(text) as bigint) n_chars")
    assert {r.doc_id for r in m.stage(spark, docs, "").collect()} == want


def test_near_dedup_bounds():
    from txmon.llm import near_dedup as m
    assert (m.first_depth(85), m.first_depth(80), m.first_depth(70)) == (3, 2, 1)
    for percent in (70, 80, 85, 95):
        for depth in range(m.first_depth(percent), m.DEPTH + 1):
            assert (1 - (percent / 100) ** depth) ** max(m.trees_at(depth, percent), m.TREES) <= m.MISS
    assert abs(m.may_link(85) - 0.70) < 0.001 and m.may_link(70) < 0.52


def test_components_long_chain(spark):
    from txmon.llm.components import components
    rows = [(i, i + 1) for i in range(70)] + [(200, 300), (300, 200), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(71)}, 200: 200, 300: 200}


def test_chat_format(spark):
    from txmon.llm.chat_format import as_events, escape, fold_events, read_back, render, unescape
    nasty = [r"\### Assistant: </turn> ok", "####", "##\\", "</turn></turn>\n", "<\\/turn>", "", None, "\\", "a\nb ###\n"]
    rows = [(c, t, role, nasty[(c + t) % len(nasty)]) for c in range(9) for t, role in enumerate(["user", "assistant", None, "###\nx"])]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = {r.conv_id: r for r in read_back(render(fold_events(as_events(df)))).collect()}
    for c in range(9):
        mine = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        assert [(t.role, t.text) for t in out[c].turns] == mine
        assert out[c].loss_texts == [t for role, t in mine if role == "assistant"]
        for s in out[c].loss_spans:  # absolute places are right, too
            assert out[c].formatted[s.start - 4 - len("assistant ###\n") + 0:s.start].endswith(" ###\n")
    texts = spark.createDataFrame([(t,) for t in nasty if t is not None], "t string")
    assert all(r[0] == r[1] for r in texts.select("t", unescape(escape(texts.t))).collect())
    log = [(1, 1, 1, "message", "user", "hi"), (1, 2, 2, "message", "assistant", ""), (1, 3, 2, "delta", None, "Hel"),
           (1, 4, 2, "delta", None, "lo"), (1, 5, 3, "message", "user", "more"), (1, 6, 2, "regenerate", None, None),
           (1, 7, 2, "delta", None, "Good "), (1, 8, 2, "delta", None, "day"), (1, 9, 1, "edit", None, "hi!"),
           (1, 10, 4, "message", "user", "bye")]
    ev = spark.createDataFrame(log, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")
    assert [(r.role, r.text) for r in fold_events(ev).orderBy("position").collect()] == [
        ("user", "hi!"), ("assistant", "Good day"), ("user", "bye")]
    assert fold_events(ev.limit(0)).count() == 0


def test_mixing_flow_and_selection(spark, corpus):
    from txmon.llm.mixing import min_cost_flow, mixed_documents, route, stage, targets
    t = targets({"a": 100, "b": 10, None: 1000})
    assert sum(t.values()) == pytest.approx(1.5 * 1110) and t["b"] == 20 and t["a"] == 200
    assert min_cost_flow([[0, 1, 5, 0], [0, 2, 5, 3], [1, 3, 9, 0], [2, 3, 9, 0]], 0, 3, 4) == [5, 5, 5, 5]
    flow = route({("a",): 100, ("a", "b"): 50}, {"a": 120, "b": 60})
    assert sum(f.get("a", 0) for f in flow.values()) == 120 and flow["a", "b"]["b"] == 60  # shared words where needed
    got = mixed_documents(corpus).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixed_documents(corpus).collect()))
    assert len(got) == corpus.count() and all(0 <= r.taken <= 2 * r.size for r in got)
    for s in {r.source for r in got}:
        mine = [r for r in got if r.source == s]
        assert mine[0].source_size == sum(r.size for r in mine)
        sums = {0}  # what whole documents, none, once or twice each, can reach at all
        for r in mine:
            sums |= {x + k * r.size for x in sums for k in (1, 2)}
        best = min(abs(x - mine[0].target) for x in sums)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= best + 0.02 * mine[0].target
    assert stage(spark, corpus, "").count() == sum(r.taken // r.size for r in got if r.size)
    assert mixed_documents(empty(spark)).count() == 0


def _checked_flow(arcs, flow, source, sink, n):
    """The flow keeps capacities and balance, and no path or cycle of its residual network improves it."""
    assert all(0 <= f <= a[2] for f, a in zip(flow, arcs, strict=True))
    net = [sum(f for f, a in zip(flow, arcs, strict=True) if a[1] == v) - sum(
        f for f, a in zip(flow, arcs, strict=True) if a[0] == v) for v in range(n)]
    assert all(net[v] == 0 for v in range(n) if v not in (source, sink)) and net[sink] == -net[source]
    free = [(a, b, w) for (a, b, c, w), f in zip(arcs, flow, strict=True) if f < c]
    free += [(b, a, -w) for (a, b, c, w), f in zip(arcs, flow, strict=True) if f]
    seen = {source}
    for _ in range(n):
        seen |= {b for a, b, _ in free if a in seen}
    assert sink not in seen  # as much as can flow
    dist = [0] * n
    for i in range(n + 1):
        changed = False
        for a, b, w in free:
            if dist[a] + w < dist[b]:
                dist[b], changed = dist[a] + w, True
        if not changed:
            break
    assert not changed  # no cycle costs less


def test_flow_is_greatest_and_cheapest():
    from txmon.llm.mixing import min_cost_flow
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(3, 9))
        arcs = [[*map(int, rng.choice(n, 2, replace=False)), int(rng.integers(0, 9)), int(rng.integers(0, 5))]
                for _ in range(rng.integers(2, 25))]
        _checked_flow(arcs, min_cost_flow(arcs, 0, n - 1, n), 0, n - 1, n)


def test_route_of_many_overlapping_patterns():
    """100,000 arcs: each source gets its target where its patterns can give it, and no pattern gives more than twice."""
    import time
    from txmon.llm.mixing import route, targets
    rng = np.random.default_rng(5)
    names = [f"s{i:03d}" for i in range(100)]
    patterns = {}
    while len(patterns) < 20_000:
        patterns[tuple(sorted(rng.choice(names, 3, replace=False)))] = int(rng.integers(1, 10**6))
    sizes = {s: 0 for s in names}
    for p, size in patterns.items():
        for s in p:
            sizes[s] += size
    wanted = {s: round(t / 3) for s, t in targets(sizes).items()}
    start = time.time()
    flow = route(patterns, wanted)
    assert time.time() - start < 60
    assert all(sum(f.values()) <= 2 * patterns[p] for p, f in flow.items())
    for s in names:
        assert sum(f.get(s, 0) for f in flow.values()) == wanted[s]


def test_packing(spark, corpus):
    import public_tokenizers as files
    from tokenizers import Tokenizer
    from txmon.llm.packing import cut, pack, plan
    assert cut(5000) == [(0, 904), (904, 2048), (2952, 2048)] and cut(2048) == [(0, 2048)] and cut(1) == [(0, 1)]
    rng = np.random.default_rng(1)
    for top in (3, 50, 2048):
        counts = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, top + 1, 3000), return_counts=True))}
        seen, used = {}, {}
        for length, rank, n, first, offset in plan(counts):
            for i in range(n):
                assert seen.setdefault((length, rank + i), 1) == 1
                used.setdefault(first + i, []).append((offset, length))
        assert len(seen) == 3000
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 2048
        total = sum(k * v for k, v in counts.items())
        assert len(used) <= total / 2048 * 11 / 9 + 1
    docs = corpus.unionByName(documents(spark, [(900, "stop <|endoftext|> go", "en", "a"), (901, "é\u00a0 \r\n\t 12's", "en", "a")]))
    tokenizer = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = pack(docs).collect()
    by = {}
    for r in rows:
        ids = np.array([*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.piece == 0 for r in rows) == docs.count()
    assert all(sum(n for _, n in v) <= 2048 and [o for o, _ in sorted(v)] == list(np.cumsum([0, *[n for _, n in sorted(v)]])[:-1]) for v in by.values())
    assert pack(empty(spark)).count() == 0


def test_ann(spark):
    from txmon.llm.ann import perturbations, search
    assert [list(p) for p in perturbations(np.array([0.1, 0.8]), 3)] == [[-1, 0], [0, 1], [-1, 1]]
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 16)).astype(np.float32)
    x[50:90] = x[50]  # copies: ties go to the smaller id
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(300)]
    rows += [(1000, None, 1), (1050, [0.0] * 16, 1), (1100, [float("nan")] * 16, 1), (1150, [None] * 16, 1), (1200, [1.0], 1),
             (None, rows[0][1], 1), rows[7]]
    got = {}
    for r in search(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int"), "vec_id % 10 = 0").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    d = x.astype(float)
    unit = d / np.sqrt((d * d).sum(axis=1))[:, None]
    hit = 0
    assert set(got) == set(range(0, 300, 10))
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -9
        s[50:90] = np.where(np.arange(50, 90) == q, -9, s[50:90].max() if not 50 <= q < 90 else 1)
        best = np.lexsort((np.arange(300), -np.round(s, 12)))[:5]
        assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
        assert all(abs(v - s[i]) < 1e-9 for _, i, v in found)
        hit += len(set(best) & {i for _, i, _ in found})
    assert hit >= 0.9 * 5 * len(got)
    assert [i for _, i, _ in sorted(got[60])] == [50, 51, 52, 53, 54]


def test_ann_finds_all_there_are(spark):
    """Tables of 2 to 6 rows, and queries opposite to a tight cluster that holds all other rows."""
    from txmon.llm.ann import search
    rng = np.random.default_rng(5)
    tables = {n: rng.standard_normal((n, 64)) for n in (2, 3, 6)}
    tables[0] = np.concatenate([-np.ones((3, 64)), np.ones((60, 64))]) + 0.01 * rng.standard_normal((63, 64))
    for n, x in tables.items():
        x = x.astype(np.float32)
        df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id bigint, embedding array<float>")
        d = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
        got = {}
        for r in search(df, "vec_id < 6").collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
        for q in range(min(len(x), 6)):
            s = d @ d[q]
            s[q] = -9
            best = np.argsort(-s)[:min(5, len(x) - 1)]
            assert [i for _, i in sorted(got.get(q, []))] == list(best), (n, q)


def test_url_rules(spark):
    from txmon.llm.url_filter import RULES, judge_urls
    urls = ["http://a.example.org/en/12?x", "https://EXAMPLE.org/es/", "http://x.com/fr/1", "http://x.com/de/#a", "http://org",
            "http://org/", "ftp://myexample.org/es/", "no url", "", None, "http://a.net/?q=://example.org/es/", "x://h.com:80/de/",
            "http://example.org/es/" + "a" * 5000] + ["http://x.com/de/"] * 2
    got = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")).collect()
    for r, u in zip(sorted(got), urls, strict=True):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.lower()
        fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "allow"), u


def test_many_url_rules_are_not_broadcast(spark, monkeypatch):
    """Rules past the bound are joined by shuffle, with the same verdicts; small ones move one row a url."""
    from pyspark.sql import functions as F
    from txmon.llm import url_filter as u
    urls = spark.createDataFrame([(i, f"http://h{i % 40}.a{i % 7}.com/p{i % 9}/x") for i in range(300)] + [(None, None)],
                                 "page_id bigint, url string").withColumn("host", F.lit("extra"))
    rules = [("block" if i % 2 else "allow", f"a{i % 7}.com", f"/p{i}/") for i in range(9)] + [("block", "com", "/")]
    small = u.judge_urls(urls, rules)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    want = sorted(map(str, small.collect()))
    monkeypatch.setattr(u, "BROADCAST_BYTES", 0)
    assert sorted(map(str, u.judge_urls(urls, rules).collect())) == want and len(want) == 301
    assert u.judge_urls(urls.limit(0), rules).count() == 0


def test_language_id(spark, corpus):
    from txmon.llm.language_id import codewords, identify, stage
    for n in (2, 3, 5, 6, 40):
        code = codewords(n)
        assert len({tuple(c) for c in code}) == n
    got = {r.doc_id: r for r in identify(corpus, ["doc_id"]).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[4].lang_pred == "und"
    assert all(got[i].lang_pred == "de" for i in range(120, 140)) and all(got[i].lang_pred == "en" for i in range(80, 100))
    kept = {r.doc_id for r in stage(spark, corpus, "").collect()}
    assert kept == {i for i in got if i not in (1, 2, 3, 4)}
    assert identify(empty(spark), ["doc_id"]).count() == 0
    nothing = identify(corpus.withColumn("lang", corpus["lang"].substr(9, 1)).where("lang IS NULL"), ["doc_id"])
    assert {r.lang_pred for r in nothing.collect()} <= {"und"}


def test_toxicity(spark):
    from txmon.llm.toxicity import counterfactual, fit, score, train
    assert counterfactual("Old men. No one") == "young girls. no one" and counterfactual("none") is None
    rng = random.Random(2)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        t = words(rng, 20).split()
        if bad:
            t[3] = rng.choice(["idiot", "scum"])
        if bad or i % 40 == 1:  # a group named mostly in toxic rows
            t[9] = "muslims"
        rows.append((i, " ".join(t), int(bad)))
    model = fit(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
    df = spark.createDataFrame([(1, "you IDIOT!!"), (2, "muslims are here"), (3, "here they are"), (4, None), (5, "")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in score(df, model).collect()}
    assert got[1].predicted == 1 and not any(got[i].predicted for i in (2, 3, 4, 5))
    x = np.array([[1, 1], [1, 1], [0, 1], [0, 0]] * 20, np.float32)  # insult, identity
    y, swapped = np.array([1, 1, 0, 0] * 20, float), x * np.array([1, 0], np.float32)
    free, _ = train(x, y, np.zeros((0, 2), np.float32), np.zeros(0, int))
    held, _ = train(x, y, swapped, np.arange(len(x)))
    assert abs(held[1]) < 0.5 * abs(free[1]) + 1e-6 and held[0] > 1
    none = fit(spark.createDataFrame([(1, "a b", 0)], "doc_id bigint, text string, toxic int"))
    assert score(df, none).where("predicted = 1").count() == 0


def test_html_extract(spark):
    from txmon.llm.html_extract import extract_text, induce, match, parse, Shape
    page = ("<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/a>{0}</a>"
            "</li></ul></nav><div class=\"ad\">buy {0}</div><article><h1>Title {0}</h1><p><b>one &amp; {0}<br>two<p>three\n\t {0}</p>"
            "<form>name</form></article><div class='comments'>nice {0}</div><footer>&copy; {0}</footer></body></html>")
    rows = [(i, "http://h.net/" + str(i), page.format(f"v{i}")) for i in range(8)] + [
        (20, "http://x.net/", None), (21, None, ""), (22, "no", "plain <b>te</b>xt"), (23, "http://y.net/", "<div>" * 3000 + "deep"),
        (24, "http://z.net/", "<article>" + "long " * 50000 + "</article>"), (0, "http://h.net/0", page.format("v0"))]
    plain = "".join("<html><body><div class='menu'>m</div><div><p>Site name</p><div><p>{}</p></div></div></body></html>")
    rows += [(30 + i, f"http://p.net/{i}", plain.format(f"body text {i} here")) for i in range(5)]
    got = {r.page_id: r for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in range(8):
        assert got[i].text == f"Title v{i} one & v{i} two three v{i}" and got[i].n_chars == len(got[i].text)
    assert got[20].text == got[21].text == "" and got[22].text == "plain text" and got[23].text == "deep"
    assert got[24].n_chars == 249999
    assert all(got[30 + i].text == f"body text {i} here" for i in range(5))  # what all pages share is template
    assert match([Shape([parse("<p>a<p>b")])], [Shape([parse("<p>c")])])[0] == 2
    assert induce([])[1] == "content"


def test_html_raw_ends_and_depth():
    from txmon.llm.html_extract import DEPTH, extract
    none = ["#root", "content", []]
    turkish = "<article><p>" + "\u0130" * 40 + "</p><SCRIPT>x('</p>')</Script><p>first <b>bold</b></p><p>last</p></article>"
    assert extract(turkish, none) == "\u0130" * 40 + " first bold last"
    n = DEPTH + 50
    deep = "<nav>" + "<div>" * n + "menu" + "</div>" * n + " more menu</nav><p>text</p>"
    assert extract(deep, none) == "text"
    inner = "<article><div>" + "<span>" * n + "<div>a</div>" + "</span>" * n + "b</div>c</article>d"
    assert extract(inner, none).replace(" ", "") == "abc"


def test_html_class_words():
    """A listed word in the class of an element that is or holds the article drops nothing of it."""
    from txmon.llm.html_extract import extract
    none = ["#root", "content", []]
    for shell in ('<body class="has-sidebar">{}</body>', '<body class="no-sidebar cookie-notice">{}</body>', "<body class=sidebar>{}</body>",
                  '<body><div id="main" class="related-wide">{}</div></body>', '<body><div class="widget">{}</div></body>'):
        for article in ('<article class="post has-comments">{}</article>', '<article class="comments">{}</article>', "<main>{}</main>"):
            page = shell.format("<div class=menu>m</div>" + article.format("text<div class='cookie-notice'>c</div><p class=ad>a</p>")
                                + "<div class=related>r</div>")
            assert extract(page, none) == "text", page
    assert extract('<body class="has-sidebar"><p>plain</p><div class="menu">m</div></body>', none) == "plain"
    assert extract("<article>one</article><div class=related><article>teaser</article></div>", none) == "one"
    assert extract("<div class=main-menu>m</div><div class=main-content>one</div>", none) == "one"


def test_html_template_of_all_pages(spark):
    """Constant nodes are template inside articles, in each of two layouts and beside an odd page; copies
    and near copies of an article keep their text."""
    from txmon.llm.html_extract import extract_text
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    rows, want = [], {}

    def add(host, html, text):
        rows.append((len(rows), f"http://{host}/{len(rows)}", html))
        want[len(rows) - 1] = text

    for i in range(10):  # inside a marked article: whole constant nodes go, constant words in a varying node stay
        add("m.net", f"<article><p>Share this page</p><p>By <b>{body(i)}</b></p></article>", f"By {body(i)}")
    for i in range(8):
        add("m.net", "<article><p>Share this page</p><p>By <b>copy of one</b></p></article>", "By copy of one")
    for i in range(20):  # two layouts and an odd page in each
        add("two.net", f"<div class=a><p>Site A</p><div>{body(i)}</div></div>", body(i))
        add("two.net", f"<div class=b><h2>Site B</h2><div>{body(100 + i)}</div></div>", body(100 + i))
    add("two.net", f"<div class=a><p>other</p><div>{body(900)}</div></div>", "other " + body(900))
    add("two.net", "<table><tr><td>odd</td></tr></table>", "odd")
    menu = "<div class=menu>" + "long menu " * 100 + "</div>"
    for i in range(8):  # short articles under a long menu
        add("short.net", f"{menu}<div><p>Site name</p><p>{body(i)}</p></div>", body(i))
    for i in range(8):  # near copies
        add("copy.net", f"<article><p>{body(1)}</p><p>{body(2)}</p><p>v{i}</p></article>", f"{body(1)} {body(2)} v{i}")
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {i: t for i, t in got.items() if t != want[i]} == {} and len(got) == len(rows)


def test_html_menus_of_all_pages(spark, monkeypatch):
    """A list of links that few pages of a layout have is a menu there, whichever pages these are; a node that
    holds links on a few pages and prose on most is none."""
    from txmon.llm import html_extract as m
    monkeypatch.setattr(m, "GROUP", 4)  # several rounds
    rows, want = [], {}
    for i in range(200):
        body = " ".join(f"w{i}x{j}" for j in range(20 + i % 7))
        more = "".join(f"<h2>h{i}y{j}</h2><p>p{i}y{j}</p>" for j in range(i % 9))
        links = f"<ul><li><a href=/>see {i} and {i}</a></li></ul>" if i in (40, 81, 122, 163) else ""
        note = f"<blockquote>{f'<a href=/>n{i}</a>' if i % 50 == 3 else f'prose of page {i}, long enough'}</blockquote>"
        rows.append((i, f"http://h{i % 4}.net/{i}", f"<div><p>{body}</p>{more}{note}{links}</div>"))
        want[i] = " ".join([body, *(f"h{i}y{j} p{i}y{j}" for j in range(i % 9)),
                            f"n{i}" if i % 50 == 3 else f"prose of page {i}, long enough"])
    got = {r.page_id: r.text for r in m.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {i: (t, want[i]) for i, t in got.items() if t != want[i]} == {} and len(got) == len(rows)


def test_html_slots_keep_their_trees():
    from txmon.llm.html_extract import Page, Slot
    slot = Slot.of(Page("<div class='a b'><p>one<p>two <a>link</a></div><ul><li>x</ul>").root)
    again = Slot.load(slot.tree(), iter(slot.sizes()))
    assert (again.tree(), again.sizes(), again.totals()) == (slot.tree(), slot.sizes(), slot.totals())
    assert again.totals() == (11, 4)
    again.align(slot)
    assert again.tree() == slot.tree() and again.totals() == (22, 8)


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    docs = p.read(spark, "/root/testdata/sf0.001", "documents")
    assert [n for n, _ in p.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    seen = docs.count()
    for name, stage in p.STAGES[:3]:
        docs = p.staged(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        n = docs.count()
        assert 0 < n <= seen and docs.select("doc_id").distinct().count() == n
        seen = n
