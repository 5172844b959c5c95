"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, per operator."""

from __future__ import annotations

import hashlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, fm_quality, line_dedup, lm_score, pii, quotes, rules_quality, secrets_forest, simhash

LONG = "lorem ipsum dolor 12 " * 20_000
#: A table with every awkward row, and columns named like internal ones.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, doc string, body string, "
    "fp long, n int, word string, place int, start int, part int, rid long, label int, slots string, spans string, words int"
)
ROWS = [
    (1, "The same line of words stands in here.\nA second line 12 of its own words.", "en", "a", 70),
    (2, "The same line of words stands in here.\nAnother one.", None, None, None),
    (2, "The same line of words stands in here.\nAnother one.", None, None, None),
    (None, "The same line of words stands in here.", "en", "b", 38),
    (None, None, None, None, None),
    (3, None, "en", "c", 0),
    (4, "", "en", "c", 0),
    (5, " \n\t ", "en", "c", 4),
    (6, LONG, "en", "c", len(LONG)),
    (7, "x" * 50_000, "en", "c", 50_000),
    (8, "Grüße \U0001f600 ÀÉ x@y.de\nÀÉ \x00 end", "de", "c", 20),
]


@pytest.fixture(scope="module")
def docs(spark):
    filler = ("k", "d", "b", 1, 2, "w", 3, 4, 5, 6, 1, "s", "p", 7)
    return spark.createDataFrame([(*r, *filler) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1), (1, 1), (2, 0), (4, 0), (6, 1), (None, 1), (7, None), (99, 1)]
    return spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, quality int, key string, n int")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "same line of words"), (2, "the same line OF words stands in here another thing"), (3, None), (4, "..."), (5, "x@y.de")]
    return spark.createDataFrame([(*r, "d") for r in rows], "item_id long, text string, doc string")


def operators(docs, labels, items):
    return {
        "line_dedup": lambda d: line_dedup.report(d),
        "lines": lambda d: line_dedup.without_recurring(d),
        "pii": lambda d: pii.report(d),
        "bpe": lambda d: bpe.digests(bpe.round_trip(d)),
        "decontam": lambda d: decontam.report(d, items),
        "decontaminate": lambda d: decontam.decontaminate(d, items),
        "spans": lambda d: decontam.decontaminate(d, items, remove="spans"),
        "fm": lambda d: fm_quality.judge(d, labels),
        "good": lambda d: fm_quality.keep_good(d, labels),
        "rules": lambda d: rules_quality.judge(d, rules_quality.train(d, labels)),
        "lm": lambda d: lm_score.score(d),
        "secrets": lambda d: secrets_forest.report(d),
        "simhash": lambda d: simhash.near_duplicates(d),
        "dedup": lambda d: simhash.deduplicate(d),
    }


NAMES = ["line_dedup", "lines", "pii", "bpe", "decontam", "decontaminate", "spans", "fm", "good", "rules", "lm", "secrets", "simhash", "dedup"]
FILTERS = {"lines", "decontaminate", "spans", "good", "dedup"}


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows_and_empty_tables(spark, docs, labels, items, name):
    run = operators(docs, labels, items)[name]
    got = run(docs)
    rows = got.collect()
    if name in FILTERS:
        assert got.columns == docs.columns
        assert len(rows) <= len(ROWS)
    else:
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
        twice = [r for r in rows if r["doc_id"] == 2]
        assert twice[0] == twice[1]
    assert run(docs.where("doc_id = -1")).collect() == []


def test_defined_results(docs, labels, items):
    ops = operators(docs, labels, items)
    by_id = lambda name: {r["doc_id"]: r for r in ops[name](docs.where("doc_id is not null")).collect()}
    lines = by_id("line_dedup")
    assert (lines[1]["n_dropped"], lines[2]["n_dropped"], lines[3]["n_dropped"]) == (0, 1, 0)
    kept = ops["lines"](docs).collect()
    assert [r["text"] for r in kept if r["doc_id"] == 2] == ["Another one."] * 2
    assert [r["n_chars"] for r in kept if r["doc_id"] == 1] == [70]
    assert [r["text"] for r in kept if r["doc_id"] == 3] == [None]
    empty = hashlib.sha256(b"").hexdigest()
    tokens = by_id("bpe")
    assert all(tokens[k]["n_tokens"] == 0 and tokens[k]["ids_sha256"] == empty == tokens[k]["decoded_sha256"] for k in (3, 4, 5))
    hit = by_id("decontam")
    assert (hit[1]["n_hit"], hit[1]["n_items"], hit[3]["n_words"], hit[8]["n_items"]) == (4, 1, 0, 1)
    words = by_id("lm")
    assert (words[3]["n_words"], words[3]["mean_log_score"], words[6]["n_words"]) == (0, None, 80_000)
    prints = by_id("simhash")
    assert {prints[k]["component_id"] for k in (3, 4, 5)} == {3}
    assert prints[3]["fingerprint"] == "0" * 16
    rules = by_id("rules")
    assert rules[3]["base_failed"] and not rules[3]["kept"] and rules[6]["n_repeat_words"] == 80_000
    assert [r["doc_id"] for r in ops["dedup"](docs).collect()].count(2) == 1


def test_all_labels_alike_or_none(spark, docs):
    some = spark.createDataFrame([(1, 1), (6, 1)], "doc_id long, quality int")
    none = some.where("doc_id = 0")
    assert {round(r["score"], 6) for r in rules_quality.judge(docs, rules_quality.train(docs, none)).collect()} == {0.5}
    assert len(fm_quality.judge(docs, none).collect()) == len(ROWS)
    assert len(fm_quality.judge(docs, some).collect()) == len(ROWS)


def test_masks_cover_every_pair_within_the_radius():
    rng = np.random.default_rng(1)
    for family in range(3):
        masks = simhash.masks(family)
        assert len(masks) == 31
        for _ in range(3000):
            differing = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(m & differing == 0 for m in masks)
    both = min((a | b).bit_count() for a in simhash.masks(0) for b in simhash.masks(1))
    assert both >= 40


def test_groups_do_not_depend_on_the_bucket_size(spark):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 63, 6)]
    prints = {b ^ sum(1 << int(i) for i in rng.choice(63, int(rng.integers(0, 5)), replace=False)) for b in base for _ in range(40)}
    want = plain.groups(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 4)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    for bucket in (20_000, 5):
        roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame, bucket)).collect()}
        assert {p: roots.get(p, p) for p in prints} == want


def test_a_long_bucket_is_cut_in_place():
    rng = np.random.default_rng(3)
    near = [int(b) ^ (1 << int(i)) for b in rng.integers(0, 1 << 63, 900, dtype=np.uint64) for i in (0, 5)]
    links = simhash.bucket_links(np.array(sorted(set(near)), dtype=np.uint64))
    assert len(links) >= 900 and all((int(a) ^ int(b)).bit_count() <= 4 for a, b in links)


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 103), (100, 100)]
    frame = spark.createDataFrame([(min(p), max(p)) for p in chain], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(frame).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 105: 100, 103: 100}


def test_windows_in_several_blocks(spark, docs, items):
    one = decontam.hits(docs, items).collect()
    more = decontam.hits(docs, items, block=2).collect()
    key = lambda r: (str(r["doc"]), r["body"])
    assert [(key(r), r["spans"], sorted(r["items"])) for r in sorted(one, key=key)] == [
        (key(r), r["spans"], sorted(r["items"])) for r in sorted(more, key=key)
    ]


def test_cutting_hit_spans(spark):
    docs = spark.createDataFrame([(1, "Start. One two, THREE four! End of it."), (2, "Nothing here.")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs, items, remove="spans").collect()}
    assert got[2] == "Nothing here." and "two" not in got[1] and got[1].startswith("Start. ") and got[1].endswith("End of it.")


def test_line_templates_generalise_fields(spark):
    rows = [
        (1, "Connection from 10.0.0.1 closed after 30 seconds"),
        (2, "Connection from 10.9.8.7 closed after 999 seconds"),
        (3, "one two three four five six seven eight nine ten eleven twelve"),
        (4, "one two three four FIVE SIX seven eight nine ten eleven twelve"),
        (5, "one two THREE four five six seven eight nine TEN eleven twelve"),
        (6, "to be or"),
        (7, "to be or"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in line_dedup.report(docs).where("n_dropped > 0").collect()} == {2, 4, 7}
    assert {r["doc_id"]: r["text"] for r in line_dedup.without_recurring(docs).collect()} == plain.without_recurring(dict(rows))


def test_pii_beyond_the_base_patterns(spark):
    rows = [(i, f"Contact mail: ann{i} (at) mail (dot) com or tel 030 1234 56{i % 10}8, card 4111 1111 1111 1111.") for i in range(40)]
    rows += [(100 + i, f"version 1234 5678 9012 345{i % 10} of 300.1.2.{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(docs).collect()}
    for i, text in rows:
        listed = [f"{k}:{s}:{e}" for s, _, k, e in plain.base_spans(text)]
        assert set(listed) <= set(got[i]["spans"].split(",")) | {""}
    assert "email:" in got[0]["spans"] and got[0]["n_email"] == 0
    assert got[0]["n_card"] == 1
    assert "ip:" not in got[100]["spans"]


def test_reliable_labelers_win():
    counted = [("card", (1, 1, 1, 0, 0), 90), ("card", (-1, -1, 1, 0, -1), 60), ("card", (1, 1, -1, 0, 0), 10), ("card", (-1, -1, -1, -1, 0), 30)]
    chance = pii.reliabilities(counted)
    assert chance["card", (1, 1, 1, 0, 0)] > 0.9 > 0.5 > chance["card", (-1, -1, 1, 0, -1)]
    assert chance["card", (1, 1, -1, 0, 0)] > 0.5 and pii.reliabilities([]) == {}


def test_positions_of_many_matches(spark):
    text = "é1 22 333 " * 300
    frame = spark.createDataFrame([(text,)], "text string")
    got = frame.select(pii.matches(F.col("text"), "[0-9]+").alias("m")).first()["m"]
    import re

    assert [(m["start"], m["end"], m["match"]) for m in got] == [(m.start(), m.end(), m.group()) for m in re.finditer("[0-9]+", text)]


def test_forest_from_labelled_findings(spark):
    rng = np.random.default_rng(4)
    letters = list("0123456789abcdef")
    rows, findings = [], []
    for i in range(120):
        if i % 2:
            rows.append((i, f'config key = "{"".join(rng.choice(letters, 32))}" end', "app/settings.py"))
        else:
            rows.append((i, f"see internationalization{'abc'[i % 3]}guidelines here", "doc/readme.md"))
        findings.append((i, 14 if i % 2 else 4, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    known = spark.createDataFrame([f for f in findings if f[0] < 80], "doc long, start long, label int")
    got = {r["doc_id"]: r["n_secrets"] for r in secrets_forest.report(docs, known).collect()}
    assert all(got[i] == i % 2 for i in range(80, 120))


def test_quotations(spark):
    rows = [
        ("a", 1, "Shall we meet on Monday about the plan?"),
        ("b", 2, "Yes, Monday.\n\nOn Monday Ann wrote:\n> Shall we  meet on Monday\n> about the plan?"),
        ("c", 3, "Good.\n> Yes, Monday.\n> > Shall we meet on Monday about the plan?"),
        ("d", 4, "Only in part.\n> Yes, but a longer sentence of somebody else\n> which stands in nobody's text"),
        ("e", 5, "First line of a long message here.\nSecond line of a long message here."),
        ("f", 6, "To the second.\n> Second line of a long message here."),
        ("g", 7, "Yes, Monday.\n> Something else entirely was asked"),
        ("h", 8, "> Yes, Monday.\n> > Something else entirely was asked"),
        ("i", 9, "> i quote what nobody wrote"),
        ("j", 1, None),
        (None, 3, "x\n> Good."),
        ("a", 1, "Shall we meet on Monday about the plan?"),
    ]
    frame = spark.createDataFrame([(*r, "p", 1) for r in rows], "id string, sent long, text string, parent string, depth int")
    found = quotes.conversations(frame)
    got = {r["id"]: r for r in found.collect()}
    assert len(found.collect()) == len(rows)
    assert {k: r["parent"] for k, r in got.items() if k} == dict(a=None, b="a", c="b", d=None, e=None, f="e", g=None, h="g", i=None, j=None)
    assert (got["c"]["thread"], got["c"]["depth"], got["c"]["own"], got["b"]["own"]) == ("a", 2, "Good.", "Yes, Monday.")
    assert got["h"]["own"] == "" and got["j"]["own"] == "" and got[None]["thread"] is None
    talks = {r["id"]: r["turns"] for r in quotes.chats(found).collect()}
    assert talks["c"] == ["Shall we meet on Monday about the plan?", "Yes, Monday.", "Good."]
    assert talks["f"][1] == "To the second." and "a" not in talks
    assert quotes.conversations(frame.where("id = 'none'")).collect() == []


def test_mail_round_trip(spark):
    rows = [(c, t, f"text {c} {t}\nmore of {c % 3}") for c in range(6) for t in range(5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = quotes.conversations(quotes.quoted_mail(turns)).collect()
    assert {r["id"]: (r["thread"], r["depth"], r["own"]) for r in got} == {f"{c}/{t}": (f"{c}/0", t, x) for c, t, x in rows}


def test_backoff_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "A b c"), (3, "c")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score.score(docs).collect()}
    # start-a 2 of 3, a-b 2 of 2; b-c and start-c once each, so 0.4 * 2 / 6
    assert got[1]["mean_log_score"] == round(np.log([2 / 3, 1]).mean(), 6)
    assert got[2]["mean_log_score"] == round(np.log([2 / 3, 1, 0.4 * 2 / 6]).mean(), 6)
    assert (got[3]["n_backed_off"], got[3]["mean_log_score"]) == (1, round(np.log(0.4 * 2 / 6), 6))


def test_encoding_fuzz():
    import random

    from tokenizers import Tokenizer

    words, library = bpe.vocabulary(bpe.default_path()), Tokenizer.from_file(bpe.default_path())
    rng = random.Random(6)
    pieces = [*"aaaabcdeinrstho ABZ'.,!#-\t\n0123456789", "the", "ing", "'ll", "é", "ß", "İ", "Σ", "日本", "\U0001f642", "\x1c", "\x85", "\x00", "<|endoftext|>", "</w>"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["a" * 2000, "ab" * 1000, "#" * 500]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = words.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert words.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_factorisation_in_linear_time_equals_all_pairs():
    rng = np.random.default_rng(8)
    model = fm_quality.Machine(0.3, rng.normal(size=fm_quality.SLOTS).astype(np.float32), rng.normal(size=(fm_quality.SLOTS, 8)).astype(np.float32))
    slots, values = rng.choice(fm_quality.SLOTS, 20, replace=False), rng.random(20).astype(np.float32)
    v = model.factors[slots]
    pairs = sum(float(v[i] @ v[j]) * values[i] * values[j] for i in range(20) for j in range(i + 1, 20))
    want = 0.3 + float(model.weights[slots] @ values) + pairs
    assert abs(model.margins(slots, values, np.array([0]))[0] - want) < 1e-3


def test_words_are_found_once_for_the_hits(spark, docs, items):
    """An inner explode made Spark find all words and hash all windows in a filter, and then again."""
    plan = decontam.hits(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert plan.count("xxhash64(10") <= 1


def test_words_are_those_of_the_negated_class(spark):
    chars = spark.range(0, 0x110000).where("id < 55296 or id > 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    for word, other in ((decontam.WORD, "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), (decontam.RAW_WORD, "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")):
        assert chars.where(F.col("c").rlike(word) != F.col("c").rlike(other)).count() == 0


def test_latin_pieces_need_no_library():
    """Every chunk beyond ASCII went to the tokenizers library to be evened out and split."""
    import random

    from tokenizers import Tokenizer

    library, words = Tokenizer.from_file(bpe.default_path()), bpe.Vocabulary(bpe.default_path())
    rng, letters = random.Random(2), [chr(c) for c in range(0x20, 0x100) if not 0x7F <= c < 0xA0] + ["'s", "'ll"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(2_000)]
    texts += [x for c in range(0x100) for x in (chr(c), f"É{chr(c)}ß", f"1{chr(c)}²")]
    want = [bpe._packed(library.encode(t, add_special_tokens=False).ids) for t in texts]
    words.library = None
    assert [words.encode(t) for t in texts] == want
