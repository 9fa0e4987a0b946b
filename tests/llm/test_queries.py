"""Every opN_ query on the smallest tables: columns, types and rows."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from tests.llm import helpers as h
from tests.llm.test_model_operators import plain as plain_rule
from tests.llm.test_text_operators import library_ids

from gridloom.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
TYPES = {
    "op1_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_removed": "bigint", "removed": "string"},
    "op2_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op5_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op6_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op7_near_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_topk_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op11_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op12_collocations": {"lang": "string", "phrase": "string", **dict.fromkeys(("rank", "a", "l", "r", "n", "score"), "bigint")},
    "op13_hard_negatives": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
    "op10_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
}


@pytest.fixture(scope="module")
def run(spark):
    found = {}

    def get(name):
        if name not in found:
            df = QUERIES[name](spark, SF)
            kinds = dict(df.dtypes)
            assert {c: kinds[c] for c in TYPES.get(name, {})} == TYPES.get(name, {})
            found[name] = df.collect()
        return found[name]

    return get


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_all_are_here():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)] and set(TYPES) | {"op3_token_counts"} == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(run, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    rows, want = run(name), con.sql(ORACLES[name])
    assert sorted(tuple(r[c] for c in want.columns) for r in rows) == sorted(want.fetchall())


def test_languages(run, docs, spark):
    rows, langs = run("op2_language_id"), {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs) and all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in docs[r.doc_id] or "")) for r in rows)
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out and langs[r.doc_id] and r.lang_pred != "und"]
    assert np.mean(held) > 0.9


def test_token_counts(run, docs):
    assert {r.doc_id: r.n_words for r in run("op3_token_counts")} == {i: len((t or "").encode().split()) for i, t in docs.items()}


def test_token_files(run, docs):
    rows, at = run("op4_token_files"), 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        ids = library_ids("word_bpe_49k.json", docs[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)
    assert len(rows) == len(docs)


def test_packing(run, docs):
    rows, sequences, total = run("op5_packing"), {}, 0
    for i in docs:
        ids, own = library_ids("byte_bpe_50k.json", docs[i]), sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        total += len(ids)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 1024)))
        assert b"".join(ids[r.start : r.start + r.length].tobytes() for r in own) == ids.tobytes() and all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length]) for r in own)
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024
    assert len(sequences) <= 1.03 * -(-total // 1024) + 1


def test_decontamination(run, docs, spark):
    want = h.contamination(docs, [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    for r in run("op6_decontaminate"):
        n, hit, items = want[r.doc_id]
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(items), digest, hit > 0)


def test_near_duplicates(run, docs):
    want = h.near_components(docs, 2)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run("op7_near_dedup")} == {i: (len(h.shingles(t, 2)), want[i], want[i] == i) for i, t in docs.items()}


def test_toxicity(run, docs):
    rows = run("op8_toxicity")
    assert {r.doc_id for r in rows} == set(docs)
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_url_filter(run, spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = run("op10_url_filter")
    assert {r.page_id for r in rows} == set(urls)
    for r in rows:
        host, path, rule, verdict = plain_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ((verdict,) if verdict else ("allow", "block"))


def test_simhash(run, docs):
    prints = {i: h.simhash(t, 4) for i, t in docs.items()}
    want = h.linked(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run("op11_simhash")} == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}
