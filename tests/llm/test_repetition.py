"""Repetition rules, token alignment and periodic runs: against plain versions, on odd rows and none."""

import random

import plain
import pytest

from callscope.llm import alignment, repetition, runs
from callscope.llm.queries import QUERIES
from callscope.llm.vocabularies import vocabulary_file

A, B = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")
DIGEST = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
RULES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat", "base_failed", "kept")
ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def _repeating(seed):
    """Texts with repeated stretches, lines and periods of all kinds."""
    rng = random.Random(seed)
    texts = []
    for i in range(60):
        k = rng.choice([1, 2, 3, 30])
        w = []
        while len(w) < rng.choice([5, 40, 150]):
            if rng.random() < 0.5:
                u = [f"v{rng.randrange(k)}" for _ in range(rng.randint(1, 9))]
                w += (u * rng.randint(2, 7))[: rng.randint(4, 60)]
            else:
                w += [f"v{rng.randrange(50)}" for _ in range(rng.randint(1, 30))]
        texts.append(rng.choice([" ", "\n", "  ", "\n\n"]).join(w))
    texts.append("line one #\n \nline one #\nline two\n\nline one #\r\n" + "a|b " * 12)
    texts.append("x " * 4000)
    return [(7 * i, t) for i, t in enumerate(texts)]


def test_rules_are_those_of_plain_counting(make_docs, odd_docs, odd_rows, no_docs, collected):
    limits = repetition.Limits()
    for docs, rows in ((odd_docs, odd_rows), (make_docs(_repeating(1)), _repeating(1))):
        found = collected(repetition.repetition_rules(docs), *RULES)
        assert found == sorted((plain.repetition(d, t, limits) for d, t in rows), key=repr)
    assert repetition.repetition_rules(no_docs).count() == 0


def test_maximal_repeats(make_docs):
    rows = [r for r in _repeating(2) if len(r[1]) < 2000]
    limits = repetition.Limits(least=2)
    for r in repetition.repetition_rules(make_docs(rows), limits, with_repeats=True).collect():
        found = {(x.length, x.times, x.start) for x in r.repeats}
        assert found == plain.maximal_repeats(plain.spaced(dict(rows)[r.doc_id]), 2)


def test_limits_decide(make_docs):
    words = [f"u{i}" for i in range(200)]
    once, twice = " ".join(words), " ".join(words + words[:40])
    rows = repetition.repetition_rules(make_docs([(1, once), (2, twice)]), repetition.Limits(longest=30)).collect()
    assert {r.doc_id: (r.n_covered, r.longest_repeat, r.kept) for r in rows} == {1: (0, 0, True), 2: (80, 40, False)}


def test_runs_are_those_of_plain_scanning(make_docs, odd_docs, odd_rows, no_docs, collected):
    for docs, rows in ((odd_docs, odd_rows), (make_docs(_repeating(3)), _repeating(3))):
        assert collected(runs.collapse_runs(docs), *DIGEST) == sorted((plain.periodic(d, t) for d, t in rows), key=repr)
    assert runs.collapse_runs(no_docs).count() == 0


def test_runs_and_collapsed_text_are_returned(make_docs):
    (r,) = runs.collapse_runs(make_docs([(1, "s a b a b a b a b a e")]), with_output=True).collect()
    assert [tuple(x) for x in r.runs] == [(1, 9, 2)] and r.collapsed == "s a b e"


def test_periodic_tails(odd_docs, odd_rows, no_docs):
    found = [(r.doc_id, plain.spaced(r.text)) for r in runs.with_periodic_tails(odd_docs).collect()]
    wanted = [(d, plain.periodic_tail(d, plain.spaced(t))) for d, t in odd_rows]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert runs.with_periodic_tails(no_docs).count() == 0


def test_equal_hashes_are_not_enough():
    """Thue-Morse words make polynomial hashes of different stretches equal; no run is made of them."""
    import numpy as np

    signs = np.array([bin(i).count("1") & 1 for i in range(1 << 13)])
    words = np.where(signs, np.uint64(0x9E3779B97F4A7C15), np.uint64(0x123456789ABCDEF1))
    assert [len(x) for x in runs.runs_of(words, np.array([0, len(words)]))] == [0, 0, 0]


def test_very_long_text(make_docs, collected):
    """More than words are handled at once, with a period longer than most texts."""
    rng = random.Random(8)
    part = [f"w{rng.randrange(10**6)}" for _ in range(70_000)]
    text = " ".join(["head", *part * 4, "tail"])
    assert len(text) > 2 << 20
    (r,) = runs.collapse_runs(make_docs([(5, text)])).collect()
    assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 1, 280_000, 70_000, 4000)
    (r,) = repetition.repetition_rules(make_docs([(5, text)])).collect()
    assert (r.n_words, r.n_covered, r.longest_repeat, r.kept) == (280_002, 280_000, 210_000, False)


ODD_TEXTS = [
    "a▁b", "▁", "  two  spaces  ", "tab\t end ", " ", "\n", "x \n y", "<|endoftext|> and <s> </s> <unk> <0x41>", "a 　b  c",
    "naïve café 日本語 \U0001f600 ﬁ", "it's 1234567 don't", "\x00 \x1c \x85", "é ՘'s ₏1", "word " * 300, "x" * 3000,
]


def test_alignment_is_that_of_the_libraries(make_docs, odd_docs, odd_rows, no_docs, collected):
    mixed = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    for docs, rows in ((odd_docs, odd_rows), (make_docs(mixed), mixed)):
        assert collected(alignment.align(docs, A, B), *ALIGNED) == sorted(plain.aligned(rows, A, B), key=repr)
    assert alignment.align(no_docs, A, B).count() == 0


def test_pair_counts(make_docs):
    rows = [(i, f"shared words {i}") for i in range(600)] + [(None, "shared shared")]
    counts = alignment.Alignment(make_docs(rows), A, B).pair_counts().collect()
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in counts} == plain.pair_counts(rows, A, B)


@pytest.mark.parametrize("docs", [1, 255, 256, 4096])
def test_bitmaps_return_what_they_hold(docs):
    import numpy as np

    rng = np.random.default_rng(docs)
    row = np.repeat([0, 2], docs)
    doc = np.concatenate([np.sort(rng.permutation(4096)[:docs])] * 2)
    times = rng.integers(1, 1 << 20, 2 * docs)
    planes = alignment.bit_planes(row, doc, times, 3)
    found = np.zeros((3, 4096), np.int64)
    at, digit, member = alignment.members(planes.slice(0, 3))
    np.add.at(found, (at, member), np.int64(1) << digit)
    wanted = np.zeros((3, 4096), np.int64)
    wanted[row, doc] = times
    assert (found == wanted).all()


def test_blocks_end(make_docs, monkeypatch, collected):
    """Many blocks give what one gives."""
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 50)
    rows = [(i, f"some words of {i} and of {i % 3}") for i in range(40)]
    assert collected(alignment.align(make_docs(rows), A, B), *ALIGNED) == sorted(plain.aligned(rows, A, B), key=repr)


def test_queries_over_whole_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_periodic_runs"](spark, sf_dir)
    wanted = [plain.periodic(d, " ".join(plain.periodic_tail(d, plain.spaced(t)))) for d, t in rows]
    assert sorted((tuple(r[c] for c in DIGEST) for r in found.collect()), key=repr) == sorted(wanted, key=repr)
    found = QUERIES["op12_token_alignment"](spark, sf_dir)
    assert sorted((tuple(r[c] for c in ALIGNED) for r in found.collect()), key=repr) == sorted(plain.aligned(rows, A, B), key=repr)
