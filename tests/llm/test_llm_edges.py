"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import re

import brute
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidewater.llm import (
    chat_snapshots,
    components,
    exact_dedup,
    html_extraction,
    license_scan,
    minhash_dedup,
    mixing,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    sharding,
    suffix_dedup,
)
from tidewater.llm.queries import PIECES, TOKENIZERS

MODEL = f"{TOKENIZERS}/{PIECES}"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 9973}x{i % 17}" for i in range(120_000))
#: Names that the operators use for columns of their own.
CLASHING = ["id", "digest", "content", "size", "copies", "row", "w", "t", "key", "kept", "signature", "place", "batch", "data", "u", "of", "good"]
TEXTS = [
    (0, "Alpha beta gamma delta epsilon zeta eta theta"),
    (1, "ALPHA beta gamma delta epsilon zeta eta theta"),
    (2, "É beta"), (3, "é beta"), (4, ""), (5, None), (6, "   \n\t "), (7, "one two"), (8, "ONE\ttwo"),
    (9, LONG), (10, LONG + " end"), (11, LONG.upper()), (None, "no id"), (None, "no id"), (12, "under the MIT license\n" * 3),
    (13, "a a a a a a a a a a"), (14, "x\n\nx\ny\nx"), (15, "ab" * 150), (15, "ab" * 150), (16, "ab" * 150 + "c"),
    (17, "▁ odd 𝄞   ​ Kİ"), (18, "#$%&!! " * 40),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "en", "de"][k % 3], [None, "b", "a", "b"][k % 4], None) for k, (i, t) in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(f"{c} of the input").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(0, 1, 0), (0, 0, 0), (9, 1, None), (None, 1, 1), (18, None, 0), (13, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def named(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def test_equal_texts(docs):
    df = exact_dedup.equal_texts(docs)
    got = named(df)
    assert df.count() == len(TEXTS)
    assert (got[0].keep_id, got[0].kept, got[1].keep_id, got[1].kept) == (1, False, 1, True)
    assert got[2].keep_id == 2 and got[3].keep_id == 3
    assert got[4].keep_id == got[5].keep_id == 5 and got[5].group_size == 2
    assert got[9].keep_id == 11 and got[15].group_size == 2 and got[15].kept
    assert [(r.keep_id, r.kept) for r in df.where("doc_id is null").collect()] == [(None, True)] * 2


def test_equal_texts_by_a_weak_digest(docs):
    """Contents are compared in full: a digest that most texts share changes nothing but the work."""
    weak = exact_dedup.equal_texts(docs, digest=lambda c: F.substring(F.md5(c), 1, 1))
    assert sorted(map(str, weak.collect())) == sorted(map(str, exact_dedup.equal_texts(docs).collect()))


def test_without_copies_keeps_columns(docs):
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15, 16, 17, 18, None}


def test_without_copies_of_a_table_loaded_twice(docs, spark):
    """One row of each text stays, also of those whose rows repeat the id or have none."""
    twice = docs.unionByName(docs).repartition(7)
    kept = [(r.doc_id, r.text) for r in exact_dedup.without_copies(twice).collect()]
    assert kept.count((None, "no id")) == kept.count((15, "ab" * 150)) == 1
    assert sorted(map(str, kept)) == sorted({str((r.doc_id, r.text)) for r in exact_dedup.without_copies(docs).collect()})
    rows = [(None, "x", "A"), (None, "X", "B"), (1, None, "A"), (1, "", "B"), (1, "y", "A"), (2, "Y", "B"), (2, "y", "C")]
    kept = exact_dedup.without_copies(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert kept.columns == ["doc_id", "text", "source"]
    assert sorted((r.doc_id or 0, (r.text or "").lower()) for r in kept.collect()) == [(0, "x"), (1, ""), (2, "y")]


def test_near_duplicates(docs):
    df = minhash_dedup.near_duplicates(docs)
    assert df.count() == len(TEXTS)
    want = brute.near_duplicates({i: t for i, t in TEXTS if i is not None}.items())
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in named(df).items()} == want
    assert [(r.component_id, r.kept) for r in df.where("doc_id is null").collect()] == [(None, True)] * 2
    assert minhash_dedup.without_near_copies(docs).columns == docs.columns


def test_links_between_different_components_of_a_key(spark):
    """Chains: neighbours are linked, the ends are not; every order of ids gives one component."""
    words = [f"w{i}" for i in range(400)]
    chain = [" ".join(words[k * 12 : k * 12 + 200]) for k in range(12)]
    rows = [((k * 7) % 12, text) for k, text in enumerate(chain)] + [(50 + k, " ".join([f"v{k}"] * 3 + words[:60])) for k in range(5)]
    got = named(minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute.near_duplicates(rows)


def test_a_shared_template_without_links_makes_no_pairs(spark, monkeypatch):
    """124 common and 26 own words: every key may hold them all, no two are similar enough."""
    common = [f"word{i}" for i in range(124)]
    rows = [(k, " ".join([*[f"own{k}x{i}" for i in range(26)], *common])) for k in range(120)]
    made = []
    meetings = minhash_dedup._meetings
    monkeypatch.setattr(minhash_dedup, "_meetings", lambda first: made.append(meetings(first)) or made[-1])
    got = named(minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute.near_duplicates(rows)
    assert made and all(pairs.count() == 0 for pairs in made)


def test_similarities_about_the_threshold_and_sizes_that_differ(spark):
    common = [f"word{i}" for i in range(130)]
    rows = [(k, " ".join([*common[: 130 - k % 40], *[f"own{k}x{i}" for i in range(8 + k % 18)]])) for k in range(90)]
    got = named(minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute.near_duplicates(rows)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == want
    assert 1 < len({c for _, c, _ in want.values()}) < 90


def test_large_family_and_shared_passage(spark):
    base = [f"word{i}" for i in range(150)]
    rows = [(k, " ".join([*base[: k % 140], f"odd{k}", *base[k % 140 + 1 :]])) for k in range(250)]
    rows += [(1000 + k, " ".join([*base[:60], *[f"own{k}x{i}" for i in range(90)]])) for k in range(250)]
    got = named(minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute.near_duplicates(rows)


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (9, 1), (7, 8), (8, 7), (6, 6), (None, 2)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {5: 1, 4: 1, 3: 1, 9: 1, 1: 1, 7: 7, 8: 7}
    path = spark.createDataFrame([((i * 37) % 101, ((i + 1) * 37) % 101) for i in range(100)], "a long, b long")
    assert {r.component for r in components.components(path).collect()} == {0}


def test_quality_scores(docs, labels):
    df = quality_classifier.classify(docs, labels)
    assert df.count() == len(TEXTS) and df.where("score between 0 and 1").count() == len(TEXTS)
    assert df.where("doc_id is null and held_out").count() == 0


def test_repeats(docs):
    # equal ids are ordered by a hash of the text; these two rows are alike
    rows = [(i, t) for i, t in TEXTS if i is not None] + [(None, t) for i, t in TEXTS if i is None]
    got = suffix_dedup.repeats(docs, batch=200_000, bucket=1000).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute.without_repeats(rows)))


def test_passages_across_documents(spark):
    passage = "".join(chr(97 + (i * i + 3 * i) % 26) for i in range(137))
    rows = [(k, f"{'é' * k} start {k} {passage}{'z' * (k % 3)} end {k}") for k in range(60)]
    rows += [(100 + k, passage[k % 30 : k % 30 + 95 + k % 8]) for k in range(40)]
    rows.append((200, passage * 4))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = suffix_dedup.repeats(df, batch=2000, bucket=64).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got)) == brute.without_repeats(rows)


def test_licenses(docs, spark):
    df = license_scan.scan(docs)
    got = sorted(map(str, map(tuple, df.collect())))
    assert got == sorted(str((i, *brute.licenses(t))) for i, t in TEXTS)
    texts = [
        "Under THE mit\nLicense, under_the--MIT license", "_cc_by_nc", "cc-by-nc-sa 4.0 and CC BY 4.0", "cc by ncx", "é cc by nc é",
        "GNU General Public License, version 3 or later; the GNU Lesser General Public License version 2.1",
        "Licensed under the Apache License, Version 2.0", "mit K license undeR the mit licenſe", "gpl v2 gpl 3 licence",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: tuple(r)[1:] for r in license_scan.scan(rows).collect()} == {i: brute.licenses(t) for i, t in enumerate(texts)}


def every_license(text):
    """(labels, score) with every rule tried, whatever words the text holds."""
    norm = f" {' '.join(w for w in re.split(license_scan.GAP, text.lower()) if w)} "
    found = {(m.start(), -m.end(), r.priority, r.label) for r in license_scan.rules() for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", norm)}
    left = [d for d in found if not any(o < d and o[0] <= d[0] and o[1] <= d[1] and o[2] <= d[2] for o in found)]
    return ",".join(sorted({d[3] for d in left})), license_scan.STRENGTHS[min(d[2] for d in left)] if left else 0.0


def alternatives(pattern):
    """All texts a rule's pattern matches: it has no more than groups, sets of characters and question marks."""
    at = 0

    def choice():
        nonlocal at
        out = sequence()
        while pattern[at : at + 1] == "|":
            at += 1
            out = out | sequence()
        return out

    def sequence():
        nonlocal at
        out = {""}
        while at < len(pattern) and pattern[at] not in "|)":
            if pattern.startswith("(?:", at):
                at += 3
                item = choice()
                at += 1
            elif pattern[at] == "[":
                end = pattern.index("]", at)
                item, at = set(pattern[at + 1 : end]), end + 1
            else:
                item, at = {pattern[at]}, at + 1
            if pattern[at : at + 1] == "?":
                item, at = item | {""}, at + 1
            out = {a + b for a in out for b in item}
        return out

    return choice()


def test_license_rules_have_no_gate_of_their_own(spark):
    texts = [
        "Released under Apache 2.0", "BSD 3-Clause", "released under MIT", "CDDL 1.0", "WTFPL 2", "CC0 1.0", "Mozilla Public 2.0", "CeCILL 2.1",
        "confidential and proprietary", "the Expat License", "X11 licence", "do what the fuck you want to public license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "commit 3, permit licenses",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee", "PHP\n3.01, _ruby_license_",
    ]
    for rule in license_scan.rules():
        met = sorted(alternatives(rule.pattern))
        assert all(re.fullmatch(rule.pattern, m) for m in met)
        texts += [m.replace(" ", ", ").title() for m in met[:: max(1, len(met) // 20)]] + [min(met, key=len), max(met, key=len)]
    texts = sorted(set(texts))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {texts[r.doc_id]: (r.labels, r.score) for r in license_scan.scan(rows).collect()}
    assert got == {t: every_license(t) for t in texts}
    assert got["BSD 3-Clause"] == ("bsd-3-clause", 0.9) and got["the Expat License"][0] == "mit" and got["commit 3, permit licenses"][0] == ""


def test_every_license_text_passes_the_gate():
    gate = re.compile(license_scan.GATE)
    for rule in license_scan.rules():
        part = re.compile(f" (?:{rule.part}) ")
        assert all(gate.search(m) and part.search(f" {m} ") for m in alternatives(rule.pattern))


def test_rules_are_ordered_and_many():
    rules = license_scan.rules()
    assert len(rules) > 300 and {r.priority for r in rules} == {0, 1, 2, 3}
    assert all(r.keyword and r.label and r.pattern for r in rules)


def test_pieces(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = sentencepiece_codec.encode(docs, MODEL).collect()
    assert len(rows) == len(TEXTS)
    want = sorted((str(i), library.encode(t or ""), (t or "").replace("▁", " ")) for i, t in TEXTS)
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in rows) == want


def test_unigram_path():
    pieces = [("<unk>", 0.0, 2), *[(p, s, 1) for p, s in (("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -3.5), ("▁a", -4.0), ("ba", -1.0))]]
    transducer = sentencepiece_codec.Transducer(sentencepiece_codec.Model(sentencepiece_codec.UNIGRAM, pieces, 0, True))
    ids = transducer.encode("aba").tolist()  # ▁a + ba (5) beats ▁ + ab + a (8.5) and the rest
    assert [pieces[i][0] for i in ids] == ["▁a", "ba"]
    assert [pieces[i][0] for i in transducer.encode("ac")] == ["▁a", "<unk>"]


def test_quality_rules(docs, labels):
    judged = quality_rules.judge(docs, labels)
    rows = judged.collect()
    assert len(rows) == len(TEXTS)
    texts = dict(TEXTS)
    for r in rows:
        words = [w for w in (texts[r.id] or "").translate(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if w]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), brute.repeated_words(words))
        assert r.n_symbols == sum((texts[r.id] or "").count(c) for c in "#*$%&|<>")
        assert r.base_failed == (len(words) < 50 or 2 * r.n_repeat_words > len(words)) and not (r.base_failed and r.kept)
    assert {r.id: r.n_dup_lines for r in rows}[14] == 2
    assert quality_rules.passing(docs, labels).columns == docs.columns


def test_cutoffs_limit_false_rejection(spark):
    """3000 good texts a stratum: a cutoff that fails 1 % of them is refused, one that fails none is taken."""
    rates = list(quality_rules.GRIDS)
    rows = [("a", 1, *[0.0] * 5)] * 2970 + [("a", 1, *[0.25] * 5)] * 30 + [("a", 0, *[0.35] * 5)] * 200 + [("b", 1, *[0.0] * 5)] * 50 + [("b", 0, *[0.9] * 5)] * 50
    rated = spark.createDataFrame(rows, f"stratum string, good int, {', '.join(f'{r} double' for r in rates)}")
    (row,) = quality_rules.cutoffs(rated).collect()
    assert row.stratum == "a" and row.cut_symbol_rate == 0.3 and row.cut_repeat_rate == 0.3 and row.cut_upper_rate == 0.3


def test_binomial_tail(spark):
    from math import comb

    cases = [(10, 0, 0.1), (50, 3, 0.1), (400, 20, 0.1), (2000, 5, 0.01), (100, 10, 0.1), (30, 29, 0.1)]
    for n, k, rate in cases:
        (got,) = spark.range(1).select(quality_rules.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), rate)).first()
        want = sum(comb(n, j) * rate**j * (1 - rate) ** (n - j) for j in range(k + 1)) if k < n * rate else 1.0
        assert got == pytest.approx(want, rel=1e-9)
    (huge,) = spark.range(1).select(quality_rules.binomial_tail(F.lit(10**9).cast("long"), F.lit(9_990_000).cast("long"), 0.01)).first()
    assert 0 < huge < 1


BLOCKS = [f"A long paragraph, with commas, and text enough to score, {n}." for n in ("one", "two", "three")]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div class=story><p title=it's>{}</p><p>{}</p><p title='x'>{}</p></div>", BLOCKS),
        ('<div><p title="a > b" class=c>{}</p><p>{}</p><p>{}</p></div>', BLOCKS),
        ('<div><p>{}</p><p>{}</p><p>see <a href="x>link</a> and <a href="y">other</a></p><p>{}</p></div>', [*BLOCKS[:2], "see link and other", BLOCKS[2]]),
        ('<form id="form1" action="/x"><input type=hidden><div><p>{}</p><p>{}</p><p>{}</p></div></form>', BLOCKS),
        ("<article><p>{}</p><p>{}</p><form><p>Leave a reply, please, in this form, at once.</p></form><p>{}</p></article>", BLOCKS),
        ("<main><article><p>{}</p></article><article><p>{}</p><p>{}</p></article></main>", BLOCKS),
        ("<article><p>{}</p></article><article><p>{}</p><p>{}</p></article><article><p><a href=z>All that is to be read, elsewhere</a></p></article>", BLOCKS),
        (
            "<article><p>{}</p><p>{}</p><p>If <label>x</label> is <math><mi>y</mi><mo>=</mo><mn>2</mn></math> <svg><text>no</text></svg>then.</p><label>Find</label><p>{}</p></article>",
            [*BLOCKS[:2], "If x is y=2 then.", BLOCKS[2]],
        ),
    ],
)
def test_no_text_of_the_article_is_lost(page, want):
    assert html_extraction.main_text(f"<html><body>{page.format(*BLOCKS)}</body></html>").split("\n") == want


def test_pages(spark):
    page = """<html><body><header class="site-header"><p>Site, the, long, enough, name, of, it, all</p></header>
    <div id="cookie-notice"><p>We use cookies, really, to make things better for you, ok?</p></div><div class="layout has-sidebar">
    <div class="sidebar-left"><p>About me, a long text, with commas, and so on and on.</p></div><div class="content"><h1>Title</h1>
    <p>First &amp; long   paragraph,\nwith commas, and enough text to count.</p><script>var a = "<p>no</p>";</script>
    <ul><li>one<li>two, <a href=x>link</a></ul><p>Short.<div class="share-buttons"><a href=x>tweet</a></div>
    <form><p>subscribe now, please, do it now, it is free</p></form></div>
    <section id="comments"><div class="comment-body"><p>I think, as a reader, that this is, well, really great.</p></div></section></div>
    <footer><p>(c) 2020, all, rights, reserved, etc.</p></footer></body>"""
    rows = [
        (1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "plain text"), (5, "u", "<article><p>a<br>b<p>c &am"),
        (5, "u", "<article><p>a<br>b<p>c &am"), (6, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (7, "u", "< 5 > 3 <!-- open"),
        (8, "u", "<p>" + "long text, " * 50_000 + "</p>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1))
    got = [(r.page_id, r.text) for r in html_extraction.extract(df).collect()]
    assert got[0][1] == "Title\nFirst & long paragraph, with commas, and enough text to count.\none\ntwo, link\nShort."
    assert [t for _, t in got[1:6]] == ["", "", "plain text", "a b\nc &am", "a b\nc &am"]
    assert got[6][1] == "deep" and got[7][1] == "< 5 > 3" and len(got[8][1]) == 11 * 50_000 - 1


def test_articles_of_readers_are_beside():
    story = "<p>A long paragraph, with commas, and text enough to score.</p>" * 2
    reader = "<p>I think, as a reader, that this is, well, really great.</p>"
    page = f"""<div class="content-sidebar"><article class="post has-sidebar"><header class="entry-header"><h1>T</h1></header>{story}
    <ul class="post-meta"><li>one</li></ul></article><div class="comments-area"><article class="comment-body">{reader}</article>
    <ol class="comment-list"><li><article>{reader}</article></ol></div></div><header><p>page, header, with, commas, and more</p></header>"""
    assert html_extraction.main_text(page).split("\n") == ["T", *["A long paragraph, with commas, and text enough to score."] * 2, "one"]


def test_siblings_of_few_points_stay():
    lead = "A lead, " + "of one hundred and fifty characters or so, that stands in a box of its own before the story begins and "[:140].replace(",", "")
    story = "<p>" + "A long paragraph, with commas, and, of course, text enough to score well. " * 4 + "</p>"
    links = "<a href=x>Home of the site</a> <a href=y>All about the authors</a>"
    page = f"""<body><div class=bar>{links}</div><div class=lead><p>{lead}</p></div><div class=wrap><div class=story>{story * 10}</div></div>
    Bare <b>text</b> between, <a href=x>one link</a> in a longer sentence of it.<ul><li>an item<li>another</ul>
    <div><p>End.</p></div><div class=comments><p>I think, as a reader, that this is, well, really great.</p></div>{links}</body>"""
    lines = html_extraction.main_text(page).split("\n")
    assert lines[0] == lead.strip() and len(lines) == 15
    assert lines[11:] == ["Bare text between, one link in a longer sentence of it.", "an item", "another", "End."]


@pytest.mark.parametrize("name", ["article", "main"])
def test_lists_of_links_in_an_article_stay(name):
    story = "<p>A long paragraph, with commas, and text enough to score.</p>" * 3
    links = "<li><a href=x>A source of it</a><li><a href=y>Another one</a>"
    page = f"""<{name}><ul class=post-tags>{links}</ul><div role=navigation>{links}</div><ul class=menu>{links}</ul><nav>{links}</nav>{story}
    <h2>References</h2><ol class=references>{links}</ol><section><h2>Further reading</h2><ul>{links}</ul></section></{name}><ul>{links}</ul>"""
    both = ["A source of it", "Another one"]
    assert html_extraction.main_text(page).split("\n")[3:] == ["References", *both, "Further reading", *both]


def test_chats(spark):
    turns = [("user", "hi"), ("assistant", "hello"), ("user", "more"), (None, None)]
    rows = []
    for conv, n in ((1, 2), (2, 4), (3, 4), (4, 1), (None, 3)):
        rows += [(conv, k, *turns[k]) for k in range(n)]
    rows += [(7, 0, "user", "hi"), (7, 1, "assistant", "hello!<|im_end|>"), (8, None, "user", "x"), (8, 5, "user", "y"), (8, 5, "user", "y")]
    rows += [(9, k, "user", str(k)) for k in range(200)] + [(10, k, "user", str(k)) for k in range(199)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("x")).withColumn("pos", F.lit(1))
    got = {(r.conv_id, r.part): (r.n_turns, r.copies, r.text) for r in chat_snapshots.format_chats(df.repartition(5)).collect()}
    assert {k[0] for k in got} == {2, 7, 8, 9} and {k[1] for k in got if k[0] == 9} == {0, 1, 2, 3}
    assert got[2, 0][:2] == (4, 2) and got[2, 0][2].endswith("<|im_start|>unknown\n<|im_end|>\n")
    assert "hello!< |im_end|><|im_end|>" in got[7, 0][2] and got[8, 0][0] == 3
    whole = "".join(got[9, p][2] for p in range(4))
    assert whole == "".join(f"<|im_start|>user\n{k}<|im_end|>\n" for k in range(200))


def test_mix(docs):
    df = mixing.mix(docs)
    rows = df.collect()
    assert len(rows) == len(TEXTS) and sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))
    assert all(0 <= r.taken == r.copies * r.size and r.copies <= 3 for r in rows)
    repeated = mixing.mixed(docs)
    assert repeated.columns == docs.columns


def test_mix_reaches_targets(spark):
    rows = [(i, "w " * (5 + i % 40), "abc"[min(2, i % 10)]) for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("target").agg(F.sum("taken").alias("taken")).collect()
    assert len(got) == 3 and all(abs(r.taken - r.target) <= 25 for r in got)


def test_mixed_rows_take_the_words_of_the_mix(spark):
    """Ids repeat over sources and a third is missing; each row goes as often as the mix says, not as its id's others."""
    rows = [(None if i % 3 == 0 else i % 300, "w " * (5 + i % 40), [None, "a", "a", "b", "c"][i % 5], i) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    words = F.size(F.split(F.trim("text"), " "))
    got = {r.source: r.n for r in mixing.mixed(docs).groupBy("source").agg(F.sum(words).alias("n")).collect()}
    sizes = docs.groupBy("source").agg(F.sum(words).alias("source_size"))
    for r in mixing.targets(sizes).collect():
        # rows with one id share a number: they go together where the sample ends
        assert abs(got[r.source] - r.target) <= 45
    assert mixing.mixed(docs).columns == docs.columns


def test_targets(spark):
    """A source that stops at three times its size leaves its excess to the others by weight."""
    sizes = spark.createDataFrame([("a", 10), ("b", 500), ("c", 490), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 30 and got[None] == 0
    assert got["b"] == pytest.approx(970 * 2 / 3) and got["c"] == pytest.approx(970 / 3)


def test_empty_tables(spark, empty, labels):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (
        exact_dedup.equal_texts(empty), exact_dedup.without_copies(empty), minhash_dedup.near_duplicates(empty),
        minhash_dedup.without_near_copies(empty), quality_rules.judge(empty, none), quality_rules.passing(empty, labels),
        quality_classifier.classify(empty, none), suffix_dedup.repeats(empty), license_scan.scan(empty),
        sentencepiece_codec.encode(empty, MODEL), mixing.mix(empty), mixing.mixed(empty),
        html_extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")),
        chat_snapshots.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
    ):
        assert df.count() == 0


def slots_of(rows):
    found = {}
    for r in rows:
        found.setdefault(r.shard, []).append(r.slot)
    return {s: sorted(n) for s, n in found.items()}


def test_shards_of_odd_rows(docs, empty):
    df = sharding.shards(docs, shards=4)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = df.collect()
    assert len(rows) == len(TEXTS)
    assert all(n == list(range(len(n))) for n in slots_of(rows).values())
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [(got[i]["size"], got[i].text_crc32) for i in (4, 5)] == [(1, 0)] * 2 and got[4].shard == got[5].shard
    assert got[2]["size"] == len("É beta".encode()) + 1
    assert len({r.shard for r in rows if r.doc_id == 15}) == 1
    none = sharding.shards(empty)
    assert none.columns == df.columns and none.count() == 0


def test_shards_of_a_hot_text(spark):
    """A text of more than a shard's rows is cut, others stay whole; all sizes end near equal."""
    text = F.when(F.col("id") % 3 == 0, "the same text").when(F.col("id") % 3 == 1, F.concat(F.lit("pair "), F.floor(F.col("id") / 6)))
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), text.otherwise(F.concat(F.lit("alone "), "id")).alias("text"))
    found = sharding.shards(rows, cell=10)
    size = found.groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert len(size) == 16 and all(r.n == r.d == r.m + 1 for r in size)
    assert max(r.s for r in size) <= 1.01 * min(r.s for r in size)
    assert found.join(rows, "doc_id").where("text <> 'the same text'").groupBy("text").agg(F.countDistinct("shard").alias("k")).where("k > 1").isEmpty()
    again = sharding.shards(rows.repartition(7), cell=10)
    assert found.exceptAll(again).isEmpty()
