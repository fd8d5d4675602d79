"""The numbered queries over the smallest tables, against brute force."""

import zlib
from collections import defaultdict

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tests.llm import brute
from tidemark.llm import registry

TABLES = ("documents", "pages", "benchmark", "embeddings")


def test_quality(results, small):
    got = {r["doc_id"]: r for r in results("op1_quality_rules")}
    assert len(got) == len(small)
    for d, text in small:
        want = brute.quality(text)
        assert {k: got[d][k] for k in want} == want
        assert got[d]["kept"] == (not want["base_failed"] and not got[d]["failed_rules"])


def test_quality_agrees_with_labels(spark, results):
    labels = dict(spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "quality").collect())
    kept = {r["doc_id"]: r["kept"] for r in results("op1_quality_rules") if not r["base_failed"]}
    both = [d for d in labels if d in kept]
    assert sum(kept[d] == (labels[d] == 1) for d in both) >= 0.97 * len(both)


def test_warc(spark, results):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "html").collect()]
    by = lambda rows: sorted(rows, key=lambda r: r["page_id"])
    assert by(results("op2_warc_packages")) == by(brute.warc(pages))


def test_decontamination(spark, results, small):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    plain = lambda t: " ".join(brute.WORD.findall((t or "").lower()))
    whole = {(d, i["item_id"]) for d, t in small for i in items if plain(i["text"]) in plain(t)}
    got = {(r["doc_id"], r["item_id"]) for r in results("op3_decontamination")}
    assert whole <= got
    assert len(got) <= len(whole) + 1  # passages inside symbols are no plain text


def test_sharding(results, small):
    rows, texts = results("op4_sharding"), dict(small)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_packing(results, small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    rows = results("op5_best_fit_packing")
    want = sorted((d, *p) for d, t in small for p in brute.packed_pieces(t, tokenizer))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    inside = defaultdict(list)
    for r in rows:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(inside) <= 1.03 * -(-sum(r["length"] for r in rows) // 4096) + 2


def test_secrets(results, small):
    got = {r["doc_id"]: r for r in results("op6_secret_scans")}
    for d, text in small:
        base = brute.secret_base(text)
        r = got[d]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x[0] for x in base) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == brute.sha(brute.written(base))
        spans = [s for s in r["spans"].split(",") if s and not s.startswith("random:")]
        assert ",".join(spans) == brute.written(base)


def test_private(results, small):
    got = {r["doc_id"]: r for r in results("op7_personal_data")}
    for d, text in small:
        base = brute.private_base(text)
        r = got[d]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
            sum(k == x[0] for x in base) for k in ("email", "ip", "card", "phone")]
        assert r["base_sha256"] == brute.sha(brute.written(base))
        assert ",".join(s for s in r["spans"].split(",") if s and not s.startswith("term:")) == brute.written(base)


def test_repeats(results, small):
    want = dict(zip((d for d, _ in small), brute.repeats([t for _, t in small]), strict=True))
    for r in results("op8_repeated_passages"):
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]


def test_urls(spark, results):
    urls = dict(spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url").collect())
    rows = results("op9_url_filters")
    assert len(rows) == len(urls)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute.url(urls[r["page_id"]])


def test_jaccard(results, small):
    got = sorted((r["doc_id"], r["class_id"], r["text_id"], r["n_links"]) for r in results("op10_jaccard_join"))
    assert got == sorted(brute.jaccard(small))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(results, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    rel = con.sql(registry.ORACLES[name])
    want = [dict(zip(rel.columns, r, strict=True)) for r in rel.fetchall()]
    key = lambda r: sorted((k, v is None, str(v)) for k, v in r.items())
    assert sorted(results(name), key=key) == sorted(want, key=key)


def test_every_number_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
