"""The registered corpus queries over whole tables: SQL where there is any, else brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from oracle import _rows
from test_scans import base_pii, base_secrets
from tokenizers import Tokenizer

from tidemark.llm.common import TOKENIZERS
from tidemark.llm.pii import KINDS as PII
from tidemark.llm.queries import QUERIES
from tidemark.llm.secrets import KINDS as SECRETS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())


def result(spark, name):
    return {r.doc_id: r for r in QUERIES[name].run(spark, SF).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    out = con.execute(QUERIES[name].sql)
    df = QUERIES[name].run(spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == _rows([d[0] for d in out.description], out.fetchall())


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int("0" + re.sub(r"\D", "", n.split("_")[0])))] == [
        "pipeline", *(f"op{n}" for n in range(1, 14))
    ]


def test_personal_data(spark, texts):
    for doc_id, r in result(spark, "op2_pii").items():
        base = base_pii(texts[doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        spelled = [f"{PII[k]}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == sha(",".join(spelled))
        assert [s for s in r.spans.split(",") if s and not s.startswith("context")] == spelled


def test_secrets(spark, texts):
    for doc_id, r in result(spark, "op10_secrets").items():
        base = base_secrets(texts[doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in base) for k in range(3)]
        spelled = [f"{SECRETS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == sha(",".join(spelled))
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == spelled


def test_token_counts(spark, texts):
    library = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    for doc_id, r in result(spark, "op3_token_counts").items():
        n = len(library.encode(texts[doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[doc_id].encode()), n, n > 1024)


def check_packed(rows, texts, capacity=4096):
    library = Tokenizer.from_file(f"{TOKENIZERS}/word_bpe_49k.json")
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(documents) == set(texts)
    for doc_id, parts in documents.items():
        ids = np.array([*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return 1 - sum(n for parts in sequences.values() for _, n in parts) / (capacity * len(sequences))


def test_packing(spark, texts):
    assert check_packed(QUERIES["op7_packing"].run(spark, SF).collect(), texts) < 0.05


def test_licenses(spark, texts):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for doc_id, r in result(spark, "op8_licenses").items():
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[doc_id]))
        found = [(at, label) for at in range(len(ws)) for p, label in phrases.items() if ws[at : at + len(p.split())] == p.split()]
        places = [at for at, _ in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(ws), len(found), min(places, default=None), max(places, default=None)
        )
        labels = {label for _, label in found}
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1


def test_quality_of_held_out_documents(spark):
    known = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    rows = result(spark, "op4_quality")
    tested = [r for r in rows.values() if r.held_out and r.doc_id in known]
    assert tested and sum(r.predicted == known[r.doc_id] for r in tested) >= 0.9 * len(tested)


def test_pipeline_keeps_only_documents(spark, texts):
    rows = QUERIES["pipeline"].run(spark, SF).collect()
    assert {r.doc_id for r in rows} < set(texts)
    assert max(Counter((r.doc_id, r.start) for r in rows).values()) == 1
