"""The registered text queries: against SQL where it can express them, else against plain Python."""

from __future__ import annotations

import hashlib
import re

import duckdb
import numpy as np
import plain
import pytest
from test_jaccard import least_of_groups

from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = "documents benchmark labels conversations".split()


def sql(folder: str, query: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    result = con.execute(query)
    return [d[0] for d in result.description], result.fetchall()


def texts(folder: str) -> dict:
    return dict(sql(folder, "SELECT doc_id, text FROM documents")[1])


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    names, want = sql(SMALL, ORACLES[name])
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    got = df.collect()
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got) == sorted(repr(tuple(r[i] for i in places)) for r in want)
    assert got


def test_simhash_equals_all_pairs(spark):
    want = plain.near_duplicates(list(texts(SMALL).items()))
    assert sorted(map(tuple, QUERIES["op10_simhash"](spark, SMALL).collect())) == want


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    from tidemark.llm.bpe import default_path

    library = Tokenizer.from_file(default_path())
    docs = texts(SMALL)
    for r in QUERIES["op5_bpe"](spark, SMALL).collect():
        ids = library.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_pii_base_equals_plain_patterns(spark):
    docs = texts(SMALL)
    found = 0
    for r in QUERIES["op4_pii"](spark, SMALL).collect():
        base = plain.base_spans(docs[r["doc_id"]])
        listed = [f"{k}:{s}:{e}" for s, _, k, e in base]
        assert r["base_sha256"] == sha(",".join(listed))
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(b[2] == k for b in base) for k in ("email", "ip", "card", "phone")]
        assert set(listed) <= set(r["spans"].split(","))
        found += len(base)
    assert found


def test_quality_on_the_held_out_fold(spark):
    labels = dict(sql(MEDIUM, "SELECT doc_id, quality FROM labels")[1])
    rows = [r for r in QUERIES["op7_quality"](spark, MEDIUM).collect()]
    assert len(rows) == len(texts(MEDIUM))
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held) > 0.95
    good = [r["score"] for r in held if labels[r["doc_id"]] == 1]
    bad = [r["score"] for r in held if labels[r["doc_id"]] == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.98


def test_rules_equal_plain_counts_and_keep_clean_documents(spark):
    docs, labels = texts(MEDIUM), dict(sql(MEDIUM, "SELECT doc_id, quality FROM labels")[1])
    rows = QUERIES["op8_quality_rules"](spark, MEDIUM).collect()
    for r in rows:
        n_words, *counts = plain.rule_counts(docs[r["doc_id"]])
        assert [r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]] == [n_words, *counts]
        assert r["base_failed"] == (n_words < 50 or 100 * counts[3] > 50 * n_words)
        assert not (r["base_failed"] and r["kept"])
    judged = [(r["kept"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(kept == bool(label) for kept, label in judged) / len(judged) > 0.95


def test_secrets_are_the_assigned_tokens(spark):
    docs = texts(MEDIUM)
    want = {
        (d, f"{m.start(1)}:{m.end(1)}") for d, t in docs.items() for m in re.finditer(r'token = "([0-9a-f]{40})"', t or "")
    }
    rows = QUERIES["op3_secrets"](spark, MEDIUM).collect()
    got = {(r["doc_id"], s) for r in rows for s in r["secrets"].split(",") if s}
    assert want and len(got & want) >= 0.95 * len(want) and len(got) <= 1.1 * len(want)


def _folder(spark, path, rows, schema) -> str:
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_pipeline_with_awkward_rows_and_names(spark, tmp_path):
    """Nulls, repeated rows, short lines, near copies and columns named like internal ones."""
    import corpus_pipeline

    good = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()][:120]
    rows = [*good, good[3], (None, good[4][1]), (None, None), (9001, None), (9002, ""), (9003, "word " * 30_000)]
    words = good[0][1].split()
    rows.append((9004, " ".join(words[: len(words) // 2] + ["another"] + words[len(words) // 2 :])))
    names = ["first", "__first", "kept", "__kept", "cut", "__cut", "row", "node", "bucket", "size", "key"]
    full = [(k, t, "en", None, None, *range(len(names))) for k, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names)
    folder = _folder(spark, tmp_path / "in", full, schema)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        for r in kept.collect():
            assert [r[n] for n in names] == list(range(len(names)))
    got = corpus_pipeline.run(spark, folder).collect()
    ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert len(ids) == len(set(ids)) and set(ids) <= {k for k, _ in rows}
    # a near copy of a document that stays goes
    assert good[0][0] not in ids or 9004 not in ids


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    folder = _folder(spark, tmp_path / "in", [], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_short_lines_recur_too(spark):
    from tidemark.llm import line_dedup

    rows = [(1, "All rights reserved.\nfirst text here"), (2, "second text here\nAll rights reserved."), (3, "ok\n\n \nthird"), (4, "fourth\n\nok")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_recurring(docs, size=None).collect()}
    assert got == plain.without_recurring(dict(rows)) == {1: rows[0][1], 2: "second text here", 3: rows[2][1], 4: "fourth\n"}


def test_pipeline_equals_its_stages_in_plain_python(spark):
    import corpus_pipeline
    from tidemark.llm.common import settle, table

    docs, ids = table(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if name != "quality" else texts(SMALL)
        columns = docs.columns
        docs = settle(stage(spark, docs, SMALL), f"test-{name}")
        if name != "bpe":
            assert docs.columns == columns
            after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "line_dedup":
            assert after == plain.without_recurring(before)
        if name == "near_duplicates":
            least = set(least_of_groups(before).values())
            assert after == {k: t for k, t in before.items() if k in least}
        if name == "decontamination":
            items = [t for (t,) in sql(SMALL, "SELECT text FROM benchmark")[1]]
            assert after == {k: t for k, t in before.items() if not plain.contaminated(t, items)}
        ids[name] = set(before)
    assert len(ids["bpe"]) < len(ids["quality"])
    assert {r["doc_id"] for r in docs.collect()} == ids["bpe"]
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))
