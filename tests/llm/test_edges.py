"""Bad markup, ties, hostile label columns and held-out folds of the training-data operators."""

import time
import zlib

import pytest


@pytest.mark.parametrize("piece", ["<a ", '<a x="', "<!--", "<a x='\"", "<!", "<b>", "<a<", "</i>", "<script>"])
def test_html_parser_is_linear(piece):
    """A megabyte of unclosed markup, alone and before text that must still be read."""
    from txmon.llm.html_extract import parse
    page = piece * (1_000_000 // len(piece))
    began = time.time()
    parse(page)
    parse(page + ">")
    assert time.time() - began < 20


def all_text(node):
    return "".join(x if isinstance(x, str) else all_text(x) for x in node.items)


def test_html_tags_end_outside_quotes():
    from txmon.llm.html_extract import parse
    for page, want in [('<p title="a > b">x</p>y', "xy"), ("a < b <i>c</i>", "a < b c"), ("<!-- <p> -->z", "z"),
                       ('<a x="never <b>bold</b>', '<a x="never bold'), ("<p x='\">'>q</p>", "q"), ("1 <", "1 <"),
                       ("<!doctype html>k", "k"), ("a<!--open", "a"), ("<p>one<p>two", "onetwo")]:
        assert all_text(parse(page)) == want, page


def test_html_chrome_below_the_depth():
    from txmon.llm.html_extract import Page, read_out
    deep = "<div>" * 200 + "text <nav>menu <b>x</b></nav><div class='advert'>buy<p>now</p></div> more" + "</div>" * 200
    page = f"<html><body><article>{deep}</article></body></html>"
    assert read_out(Page(page), None, frozenset()).split() == ["text", "more"]


def test_fold_events_ties(spark):
    """At one sequence number events apply in the order of kind, role and text; the last reset wins."""
    from txmon.llm.chat_format import fold_events
    rows = [(1, 1, 1, "delta", "", "x"), (1, 1, 1, "edit", "", "y"),
            (2, 1, 1, "edit", "", "b"), (2, 1, 1, "edit", "", "c"),
            (3, 1, 1, "message", "user", "m"), (3, 1, 1, "edit", "", "e"), (3, 2, 1, "delta", "", "+"),
            (4, 1, 1, "message", "user", "old"), (4, 2, 1, "regenerate", "", "ignored"), (4, 2, 1, "delta", "", "lost"),
            (4, 3, 1, "delta", "", "new"),
            (5, None, 1, "delta", None, None), (5, None, 1, "delta", "assistant", "only")]
    got = {r.conv_id: (r.role, r.text) for r in fold_events(spark.createDataFrame(
        rows, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")).collect()}
    assert got == {1: ("", "y"), 2: ("", "c"), 3: ("user", "m+"), 4: ("user", "new"), 5: ("assistant", "only")}


def test_too_many_languages_are_refused(spark):
    from txmon.llm import language_id as m
    many = spark.range(100_000).selectExpr("id AS doc_id", "concat('some text ', id) AS text", "concat('l', id) AS lang")
    began = time.time()
    with pytest.raises(ValueError, match="languages"):
        m.fit(many)
    assert time.time() - began < 60


def fold(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_labels_teach_nothing(spark):
    """Other labels on held-out rows change no score of op3 and op9."""
    from txmon.llm import language_id, toxicity
    rows = [(i, ("der hund und die katze " if i % 2 else "the dog and the cat ") * 3 + f"w{i % 7}", "de" if i % 2 else "en", "s", 9)
            for i in range(120)]
    docs = lambda flip: spark.createDataFrame(
        [(i, t, "xx" if flip and fold(i) else lang, s, n) for i, t, lang, s, n in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    said = lambda flip: sorted(map(str, language_id.predict(
        docs(False), language_id.fit(docs(flip).where(~language_id.held_out())), ["doc_id"]).collect()))
    assert any(fold(i) for i, *_ in rows) and said(False) == said(True)
    marks = lambda flip: spark.createDataFrame(
        [(i, 1, (i // 3) % 2 if not (flip and fold(i)) else 1 - (i // 3) % 2) for i, *_ in rows],
        "doc_id bigint, quality int, toxic int")
    bad = docs(False).selectExpr("doc_id", "concat(text, CASE WHEN (doc_id div 3) % 2 = 1 THEN ' vile scum' ELSE '' END) AS text",
                                 "lang", "source", "n_chars")
    score = lambda flip: sorted(map(str, toxicity.score(bad, toxicity.fit(toxicity.sampled(
        bad, marks(flip).where(~toxicity.held_out()).select("doc_id", "toxic")))).collect()))
    plain = score(False)
    assert plain == score(True)
    by_id = {r.doc_id: r.score for r in toxicity.score(bad, toxicity.fit(toxicity.sampled(
        bad, marks(False).where(~toxicity.held_out()).select("doc_id", "toxic")))).collect()}
    wrong = [i for i in by_id if fold(i) and (by_id[i] >= 0.3) != ((i // 3) % 2 == 1)]
    assert not wrong


def test_stages_of_dedup_keep_one_row_a_group(spark):
    """Ids on several rows, repeated rows, null ids and null texts through both dedup stages."""
    from txmon.llm import exact_dedup, near_dedup
    docs = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string"
    rows = [(1, "a b c"), (2, "a  b c"), (2, "other text"), (3, "abc "), (3, "abc "), (3, "only here"), (4, "x"), (4, "x"),
            (None, "a b c"), (None, "nobody else"), (None, "nobody else"), (5, None), (6, ""), (7, " "), (8, "single")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k") for i, t in rows], docs)
    got = exact_dedup.stage(spark, df, "").collect()
    norm = lambda t: "".join((t or "").split())
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i, t))
    want = sorted((str(min(g, key=lambda x: x[:3])[3]), min(g, key=lambda x: x[:3])[4] or "") for g in groups.values())
    assert sorted((str(r.doc_id), r.text or "") for r in got) == want
    assert exact_dedup.stage(spark, df.limit(0), "").count() == 0
    words = " ".join(f"w{j}" for j in range(60))
    near = [(1, words), (2, words + " end"), (2, words + " end"), (3, "else " * 9), (None, words), (4, None)]
    got = near_dedup.stage(spark, spark.createDataFrame([(i, t, "en", "s", 1, "k") for i, t in near], docs), "").collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "3", "4", "None"]


def test_without_ids(spark):
    from txmon.llm.common import without_ids
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'t' AS text").unionByName(
        spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id, 'n' AS text"))
    gone = spark.range(0, 20_000, 3).selectExpr("id AS doc_id").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id"))
    left = without_ids(docs, gone)
    assert {r.doc_id for r in left.collect()} == {None, *(i for i in range(20_000) if i % 3)}
    assert without_ids(docs, gone.limit(0)).count() == 20_001
