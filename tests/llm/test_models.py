"""Quality classifier, language model, page text and the pipeline."""

import math

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callscope.llm import katz, quality
from callscope.llm.html_text import _inherit, _stop_density, extract, main_text
from callscope.llm.requests import _pack, unique

SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def rated(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, quality.graded(spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_grades(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    ratings = quality.graded(spark.read.parquet(f"{LARGER}/labels.parquet"))
    train, test = ratings.where("xxhash64(doc_id) % 4 != 0"), ratings.where("xxhash64(doc_id) % 4 = 0")
    model = quality.train(docs, train)
    assert (np.diff(model.thresholds) > 0).all()
    scored = quality.score(docs, model, selected=2, keep=["doc_id"]).join(test, "doc_id").toPandas()
    good, poor, toxic = (scored[scored.grade == g].selected for g in (2, 1, 0))
    assert good.mean() > 0.95
    assert poor.mean() < 0.15 and toxic.mean() < 0.25
    means = [scored[scored.grade == g].expected_grade.mean() for g in (0, 1, 2)]
    assert means[2] > max(means[:2])


def test_scores_of_odd_rows(spark, odd_docs, odd_rows, no_docs, rated):
    model = quality.train(*rated)
    out = quality.score(odd_docs, model, selected=2)
    assert {"expected_grade", "tail_probability", "selected", "n_words"} <= set(out.columns)
    got = out.collect()
    assert len(got) == len(odd_rows) and all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in got)
    assert sorted(r.n_words for r in got) == sorted(len(plain.spaced(t)) for _, t in odd_rows)
    same = [r.expected_grade for r in got if r.text == odd_rows[6][1]]
    assert len(set(same)) == 1 and len(same) > 3
    assert quality.score(no_docs, model, selected=2).count() == 0


def test_training_without_ratings(odd_docs, rated):
    none = quality.train(odd_docs, rated[1].limit(0))
    assert not none.weights.any()
    one = quality.fit(np.array([0, 1, 2]), np.array([3, 4]), np.array([2, 2]))
    assert one.tails(np.zeros(1)).shape[1] == 2
    # gradient steps reach the maximum: clearly separated grades are told apart
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 3, 600)
    starts = np.arange(601) * 2
    numbers = np.stack([grades * 7, np.full(600, 50)], axis=1).ravel()
    model = quality.fit(starts, numbers, grades)
    tails = model.tails(quality._sums(model.weights[numbers], starts))
    assert ((tails >= 0.5).sum(axis=1) == grades).mean() > 0.99


def test_fit_reaches_the_plain_maximum():
    rng = np.random.default_rng(3)
    for top in (1, 2, 3):
        rows = [set(np.flatnonzero(rng.random(6) < 0.5).tolist()) | {9} for _ in range(120)]
        grades = [int(np.clip(round(0.8 * len(r & {0, 1, 2}) - 0.7 * len(r & {3, 4}) + rng.normal(0, 0.8) + 0.6), 0, top)) for r in rows]
        numbers = np.array([f for r in rows for f in sorted(r)])
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        model = quality.fit(starts, numbers, np.array(grades))
        # what all rows have tells nothing and is left out
        weights, cuts = plain.ordinal_fit(rows, grades, list(range(6)))
        assert np.abs(model.weights[:6] - [weights[f] for f in range(6)]).max() < 0.02 and model.weights[9] == 0
        assert np.abs(model.thresholds - cuts).max() < 0.02


def test_first_stage_keeps_what_the_model_selects(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.train(docs, quality.graded(labels))
    wanted = set()
    for r in docs.collect():
        _, numbers, _ = quality.features(pa.array([r.text], pa.string()))
        score = sum(model.weights[f] for f in numbers.tolist())
        if 1 / (1 + math.exp(model.thresholds[1] - score)) >= 0.5:
            wanted.add(r.doc_id)
    kept = corpus_pipeline.keep_good(spark, docs, "/root/testdata/sf0.001")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == wanted
    assert 0 < len(wanted) < docs.count()


def test_katz_is_its_definition(odd_docs, odd_rows, no_docs):
    held = "crc32(cast(doc_id AS string)) % 7 = 2"
    from pyspark.sql import functions as F

    wanted, p, vocabulary, histories = plain.katz(odd_rows, katz.CUTOFFS, katz.discounts)
    got = katz.Katz(odd_docs, F.expr(held)).scores().collect()
    key = lambda r: (repr(r[0]), r[2], round(r[6], 6))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(wanted, key=key), strict=True):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9)
    for h in [*histories[:20], ("never", "seen")]:
        assert math.isclose(sum(p((*h, w)) for w in vocabulary) + p((*h, "no such word")), 1.0, rel_tol=1e-9)
    assert katz.Katz(no_docs, F.expr(held)).scores().count() == 0


def test_katz_reads_the_texts_once_for_all_shorter_orders(odd_docs, monkeypatch):
    stored = []
    store = katz.Scratch.store
    monkeypatch.setattr(katz.Scratch, "store", lambda self, df, name: stored.append(name) or store(self, df, name))
    katz.Katz(odd_docs, F.expr("false"))
    assert stored == ["count-2", "count-3", "sum-2", "sum-3"]


@pytest.mark.parametrize("texts", [["a b a b c", None, "", "b"], ["a"], [" "]])
def test_katz_histories_are_the_shorter_ngrams_before(texts):
    """Numbered from the n-grams of the place before, as if each place's history had been hashed and sorted."""
    docs = pa.table({"text": texts, "held": [False] * len(texts)})
    tokens = katz.Tokens(docs)
    orders = [katz.Order(1, 1, (0.0,) + (1.0,) * 5, 1, (0,) * 6)] * 3
    evaluation = katz.Evaluation(docs, pa.table({c: [] for c in ("kind", "owner", "a", "b")}), 1, len(texts), orders)
    for n in (1, 2, 3):
        keys, place, number = unique(tokens.ngram(n))
        counts = np.bincount(number)
        evaluation.answers[f"count-{n}"] = [(_pack(counts, False), _pack(np.ones(len(keys), np.uint8), False))]
    for n in (2, 3):
        at, keys, number = evaluation._histories(n)
        assert (np.diff(keys.astype(object)) > 0).all() and len(at) == len(tokens.token)
        for i, key in enumerate(keys[number]):
            first = [tokens._back(j)[i] for j in range(1, n)]
            wanted = np.full(1, np.uint64(n - 1))
            for token in first:
                wanted = katz.mix(wanted * katz._STEP + token)
            assert key == wanted[0]


def test_katz_beats_the_base_on_held_out_texts(spark):
    rows = katz.scored(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).where("held_out").collect()
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_discounts():
    assert katz.discounts([0] * 6, 1) == (0.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    d = katz.discounts([1000, 300, 150, 90, 60, 42], 1)
    assert all(0 < x < 1 for x in d[1:]) and d[0] == 0
    assert katz.discounts([1000, 300, 150, 90, 60, 42], 2)[1] == 0


GOOD = "The house of the people is in the city and it was for them that he was at the door of it. " * 3
PAGES = [
    (None, ""),
    ("", ""),
    ("<p", ""),
    ("<article><h1>Title</h1><p>a <b>bo</b>ld&amp;amp; x<br>y</article>", "Title a bold&amp; x y"),
    (f"<nav><a href=x>Menu</a></nav><article><p>{GOOD}</p><p>Short one.</p></article><footer>the end of it</footer>", f"{GOOD.strip()} Short one."),
    (f"<article><p>{GOOD}<div class='comments'><p>{GOOD}</p></div></article>", GOOD.strip()),
    (f"<div><p>{GOOD}</p><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div>", GOOD.strip()),
    (f"<h2>Head</h2><p>{GOOD}</p><form>{GOOD}</form><aside>{GOOD}</aside>", f"Head {GOOD.strip()}"),
    ("<script>var t='</p>';</script><style>p{}</style><article>text<script>x</script> here</article>", "text here"),
    (f"<article><p>{GOOD}<!-- <p>no</p> --> on", f"{GOOD.strip()} on"),
    ("<article><p>&nbsp; a&#x41;\t\n b &copy;</p></article>", "aA b ©"),
    ("<div class=cookie-notice>" + GOOD + "</div><p>" + GOOD + "</p>", GOOD.strip()),
    ("<" * 3000, ""),
]


def test_page_texts(spark, collected):
    for html, text in PAGES:
        assert main_text(html) == text, html
    rows = [(i, "u", h, "t", 5) for i, (h, _) in enumerate(PAGES)] + [(0, "u", None, "t", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, key long")
    got = collected(extract(pages), "page_id", "url", "key", "text", "n_chars")
    wanted = [(i, "u", 5, t, len(t)) for i, (_, t) in enumerate(PAGES)] + [(0, "u", 5, "", 0)]
    assert got == sorted(wanted, key=repr)
    assert extract(pages.limit(0)).count() == 0


def test_articles_of_generated_pages(spark):
    import re
    from html import unescape

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert main_text(r.html) == " ".join(filter(None, parts))


def test_linked_blocks_in_an_article():
    plain_block = "Zylo mentrak osbun quilp dravon tessik. " * 6  # long, without stop words
    see = "<p>See <a href=m>the manual</a> for details.</p>"
    links = "<ul><li><a href=a>One</a><li><a href=b>Another one</a></ul>"
    told = "See the manual for details."
    assert main_text(f"<article>{see}</article>") == told
    assert main_text(f"<article><h1>Title</h1><p>{plain_block}</p>{see}<p>Short.</p></article>") == f"Title {plain_block}{told} Short."
    assert main_text(f"<main><p>{GOOD}</p>{see}{links}<p>{plain_block}</p>{links}</main>") == f"{GOOD}{told} {plain_block}".strip()


def test_wrappers_around_an_article():
    told = GOOD.strip()
    for name in ("layout has-sidebar", "no-comments", "page with-banner", "related-content", "search-result", "main social"):
        assert main_text(f"<div class='{name}'><div>Menu</div><article><p>{GOOD}</p></article></div>") == told, name
    assert main_text(f"<html class=cookie><form id=search><main><p>{GOOD}</p></main></form>") == told
    assert main_text(f"<div class='content-sidebar-wrap'><main><p>{GOOD}</p></main></div>") == told
    assert main_text(f"<article class='post sponsored'><p>{GOOD}</p></article>") == told
    teaser = "<article><p>A teaser of another text.</p></article>"
    for name in ("related", "sidebar", "comments"):
        assert main_text(f"<article><p>{GOOD}</p></article><div class={name}>{teaser}{teaser}</div>") == told
        assert main_text(f"<div class=widget><main><p>{GOOD}</p><div class={name}>{teaser}</div></main></div>") == told
    assert main_text(f"<main><h1>Head</h1><div class=social><article><p>{GOOD}</p></article></div></main>") == f"Head {told}"
    for name in ("comments", "sidebar"):
        assert main_text(f"<div class={name}><article><p>{GOOD}</p></article></div>") == ""
    assert main_text(f"<div class=banner><p>{GOOD}</p></div>") == ""
    assert main_text(f"<aside><article><p>{GOOD}</p></article></aside><nav><main>{GOOD}</main></nav>") == ""


def test_dropped_elements_without_a_closing_tag():
    told = GOOD.strip()
    article = f"<article><p>{GOOD}</p></article>"
    for name in ("button", "select", "object", "svg", "math", "canvas", "audio", "video", "template"):
        assert main_text(f"<div><{name}>x <i>y</i></div>{article}") == told, name
        assert main_text(f"<{name}>x<g>y<p>{GOOD}</p>") == told, name
        assert main_text(f"<div><{name}>x</div><p>{GOOD}</p><div><{name}>y</{name}></div><p>{GOOD}</p>") == f"{told} {told}", name
        assert main_text(f"<article><{name}><p>no</p>no</{name}><p>{GOOD}<{name}><{name}>x</{name}></p><p>on</p></article>") == f"{told} on", name
    for name in ("button", "svg", "video"):
        assert main_text(f"<{name}>x{article}<{name}>y</{name}></{name}>") == told, name
        assert main_text(f"<{name}/>{article}") == told, name
    assert main_text(f"<template>{article}</template><p>{GOOD}</p><svg><svg></svg><p>no</p></svg>") == told
    for name in ("script", "style", "textarea"):
        assert main_text(f"{article}<{name}>x<p>{GOOD}</p>") == told, name
    assert main_text(f"<head><title>x</head><body>{article}") == told
    many = 20000
    assert main_text(f"{article}{'<svg><div>' * many}") == told and main_text(f"{article}{'<svg>' * many}") == told


ITALIAN = "Ieri mattina molti cittadini hanno visto arrivare grandi navi nuove, cariche di merci pregiate, mentre i pescatori ritornavano verso casa dopo una lunga notte passata lontano dalla costa sotto tante stelle luminose."
RUSSIAN = "Вчера утром жители города увидели, как в гавань вошли большие новые корабли, а рыбаки возвращались домой после долгой ночи вдали от берега. Они рассказывали детям о звёздах, о ветре и о далёких странах, где никогда не бывает зимы."
CHINESE = "昨天早上，许多市民看到满载货物的新船驶入港口，渔民们在远离海岸的地方度过漫长的夜晚之后正在回家的路上。他们给孩子们讲述星星、风和遥远国度的故事，那里从来没有冬天，人们整年都在海边唱歌跳舞。"


def test_articles_in_div_markup_and_other_languages():
    menu = "<div><a href=a>Uno</a> <a href=b>Due</a></div>"
    for told in (ITALIAN, RUSSIAN, CHINESE):
        page = f"<body>{menu}<div><h1>Titolo</h1><p>{told}</p><p>{told[: len(told) // 2]}</p><p>{told}</p></div>{menu}<footer>{told}</footer>"
        assert main_text(page) == f"Titolo {told} {told[: len(told) // 2].strip()} {told}"
    notice = f"<div>{GOOD}</div>"
    assert RUSSIAN in main_text(f"<div><p>{RUSSIAN}</p></div>{menu}{notice}")
    rare = "The ship of the harbour sailed to distant islands carrying heavy barrels, woollen blankets, copper kettles, wooden chairs, iron nails, dried fish, candles, salted butter, linen shirts, leather boots and tin plates. "
    keywords = "tickets hotels flights cruises trains buses ferries cars bikes scooters boats planes tours guides maps " * 3
    assert main_text(f"<div><p>{rare}</p><p>{rare}</p><p>{keywords}</p></div>") == (rare * 2).strip()
    assert main_text(f"{menu}<div>Hello there</div><div>Contact us today</div>") == ""


def test_long_blocks_beside_a_menu():
    some = "Most ships of the harbour sailed to distant islands carrying heavy barrels, woollen blankets, copper kettles, wooden chairs and iron nails with dried fish, candles, salted butter, linen shirts and leather boots in it. "
    assert 0.15 < _stop_density(some) < 0.3
    assert main_text(f"<nav>Menu</nav><p>{some}</p><p>{some}</p><p>{GOOD}</p>") == f"{some}{some}{GOOD}".strip()


def test_surroundings_of_an_unmarked_article():
    told = GOOD.strip()
    article = f"<div class=text><h2>Title</h2><p>{GOOD}</p><p>{GOOD}</p></div>"
    whole = f"Title {told} {told}"
    above = "<div id=header><h1>My Site</h1><p>News of the day for all</p></div>"
    below = "<div id=bottom>Copyright 2020 by the people of the site</div>"
    assert main_text(f"<body>{above}{article}{below}</body>") == whole
    assert main_text(f"<body><div><h1>My Site</h1><p>News of the day for all</p></div>{article}<div>© 2020 The people</div></body>") == whole
    for name in ("commentlist", "commentList", "comment-list", "cookiebar", "cookieBar", "topnav", "adbox", "siteHeader"):
        assert main_text(f"<body>{article}<div class={name}><p>{GOOD}</p></div></body>") == whole, name
    for name in ("entry-header", "article-title", "page-header"):
        assert main_text(f"<body><div><div class={name}><h1>Head</h1></div><p>{GOOD}</p></div></body>") == f"Head {told}", name
    # titles above the container of the text
    assert main_text(f"<body><h1>Head</h1><p>By the people</p><div class=x><p>{GOOD}</p><p>{GOOD}</p></div></body>") == f"Head By the people {told} {told}"
    # what holds most of the page is none of its edges
    for opened in ("form id=aspnetForm", "form", "div id=top", "div class=header-fixed"):
        closed = opened.split()[0]
        assert main_text(f"<body><{opened}><div class=menu>Menu</div>{article}</{closed}></body>") == whole, opened
    assert main_text(f"<body>{article}<form><p>Your name, and what you want to say to the people.</p></form></body>") == whole


def test_names_of_the_article_itself_and_hidden_blocks():
    told = GOOD.strip()
    for name in ("post comments-open", "post comments-closed", "comments", "has-sidebar", "hentry sidebar-right"):
        assert main_text(f"<body><article class='{name}'><p>{GOOD}</p></article></body>") == told, name
    remark = "<article class=comment><p>What a text this is, for all of us.</p></article>"
    assert main_text(f"<body><article><p>{GOOD}</p></article>{remark}{remark}</body>") == told
    assert main_text(f"<body><article><p>{GOOD}</p>{remark}{remark}</article></body>") == told
    for hidden in ("hidden", "hidden=''", "style='color:red; display: none'", "STYLE=display:none", "style='visibility:hidden'"):
        assert main_text(f"<article><p>{GOOD}</p><div {hidden}><p>{GOOD}</p></div></article>") == told, hidden
        assert main_text(f"<article><p>{GOOD}<span {hidden}>no <span>no</span> no</span></p></article>") == told, hidden
    assert main_text(f"<body style='display:none'><article><p title='hidden'>{GOOD}</p></article></body>") == told
    away = "<h3>Related</h3><ul><li>Another text<li>One more text</ul>"
    assert main_text(f"<article><p>{GOOD}</p>{away}<p>The end of it.</p></article>") == f"{told} The end of it."
    assert main_text(f"<article><h3>Related</h3><p>{GOOD}</p></article>") == f"Related {told}"


def test_short_unmarked_pages():
    menu = "<div><a href=a>Uno</a> <a href=b>Due</a></div>"
    one = "The ship of the harbour sailed at noon, and nobody saw it again on that day."
    assert main_text(f"<body>{menu}<p>{one}</p><div>© 2020</div></body>") == one
    assert main_text(f"<body>{menu}<p>The ship sailed at noon.</p></body>") == "The ship sailed at noon."
    assert main_text(f"<body>{menu}<div>Copyright 2020 by the people. All rights reserved.</div></body>") == ""


def test_deep_and_long_pages():
    many = 30000
    assert main_text("<div id=top><form>" * many + f"<article><p>{GOOD}</p></article>") == GOOD.strip()
    assert main_text(("<div class=header><p>" + GOOD) * many).count("house") <= 3 * many
    long = main_text(f"<body><div><ul><li>{'<div><p>' + GOOD + '</p></div>' * 3}</ul></div></body>" + f"<p>{GOOD}</p>" * many)
    assert long.startswith(GOOD.strip()) and long.count("house") >= 3 * many


def test_neighbours():
    assert _inherit([None, True, None, None, False, None], False) == [True, True, True, False, False, False]
    assert _inherit([None, None], True) == [True, True]
    assert _inherit([False, None, True], False) == [False, True, True]


def test_pipeline(spark, make_docs, odd_rows, tmp_path):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    folder = str(tmp_path)
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = source.unionByName(source.limit(5)).unionByName(source.selectExpr("doc_id", "null AS text", "lang", "source", "n_chars").limit(2))
    docs.write.parquet(f"{folder}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    current = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    columns = current.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in current.collect()]
        stage(spark, current, folder).write.parquet(f"{folder}/{k}")
        current = spark.read.parquet(f"{folder}/{k}")
        after = current.collect()
        if name != "bpe":
            assert current.columns == columns
        ids = sorted(r.doc_id for r in after)
        if name == "exact_dedup":
            assert ids == sorted(k for k, _ in {(k, sha) for _, k, _, _, sha in plain.exact(before)})
        elif name == "near_dedup":
            assert ids == sorted(d for d, _, _, kept in plain.near(before) if kept)
        elif name == "decontamination":
            assert ids == sorted(h[0] for h in plain.contamination(before, items) if not h[5])
        else:
            assert 0.5 * len(before) < len(after) <= len(before)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(r.doc_id for r in whole.collect()) == ids
    empty = make_docs([]).select(*columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_features_are_per_text():
    texts = ["Hello world!!", None, "", "Hello world!!"]
    starts, numbers, counts = quality.features(pa.array(texts))
    own = [numbers[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert own[0] == own[3] and own[1] == own[2] and counts.tolist() == [2, 0, 0, 2]
