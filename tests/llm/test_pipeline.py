"""The pipeline over the smallest tables, stage by stage against brute force."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import prose
from tidemark.llm import quality, secrets
from tidemark.sources.scratch import materialise


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs.collect()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "jaccard_join", "decontamination", "secret_scans", "best_fit_packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        if name != "best_fit_packing":
            columns = docs.columns
        docs = materialise(stage(spark, docs, SF_SMALL), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
        kept[name] = docs.collect()
    good = {r["doc_id"] for r in quality.measure(spark.createDataFrame(before)).where("kept").collect()}
    assert {r["doc_id"] for r in kept["quality_rules"]} == good
    classes = {}
    for d, c, _, _ in brute.jaccard([(r["doc_id"], r["text"]) for r in kept["quality_rules"]]):
        classes.setdefault(c, []).append(d)
    assert sorted(r["doc_id"] for r in kept["jaccard_join"]) == sorted(min(ds) for ds in classes.values())
    items = [" ".join(brute.WORD.findall(r["text"].lower()))
             for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    holds = lambda r: any(i in " ".join(brute.WORD.findall(r["text"].lower())) for i in items)
    assert {r["doc_id"] for r in kept["decontamination"]} == {r["doc_id"] for r in kept["jaccard_join"] if not holds(r)}
    for a, b in zip(*(sorted(kept[n], key=lambda r: r["doc_id"]) for n in ("decontamination", "secret_scans")), strict=True):
        want, at = "", 0
        for _, start, end in brute.secret_base(a["text"]):
            if start >= at:
                want, at = want + a["text"][at:start] + secrets.MARK, end
            at = max(at, end)
        assert b["text"] == want + a["text"][at:]
        assert b["n_chars"] == (len(b["text"]) if b["text"] != a["text"] else a["n_chars"])
        assert not re.search(r"[0-9a-f]{32}", b["text"])
    assert {r["doc_id"] for r in kept["best_fit_packing"]} == {r["doc_id"] for r in kept["secret_scans"]}


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def hostile(spark):
    """Nulls in every column, empty, long, repeated and hurtful rows, and
    columns named like those the operators use."""
    good, other = prose(1, 80), prose(2, 90)
    secret = prose(3, 60) + ' token = "24be64439e3e49cf46b2d7c90f3602a3" ' + prose(4, 30)
    rows = [(None, None, None, None, None), (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "one", None, None, 3),
            (4, good, "en", "s", len(good)), (5, good, "en", "s", len(good)), (5, good, "en", "s", len(good)),
            (None, good + " more", "en", "s", 1), (6, other, "en", None, None), (6, other, "en", None, None),
            (7, secret, "en", "s", len(secret)), (None, secret + " again", None, None, None), (8, prose(5, 30_000), "en", "s", 7),
            (None, prose(6, 70), None, None, None)]
    return spark.createDataFrame(rows, DOCUMENTS).withColumns(
        {c: F.lit("x") for c in ("key", "kept", "row", "before", "root", "size", "unit", "sequence_id")})


def test_stages_with_hostile_rows(spark):
    docs = hostile(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, SF_SMALL), name)
        assert out.columns == docs.columns
        got = out.collect()
        assert {tuple(r[5:]) for r in got} == {("x",) * 8}
        given = {(r["doc_id"], r["text"]): r for r in docs.collect()}
        if name != "secret_scans":  # what is kept is as it was
            assert all(given[r["doc_id"], r["text"]] == r for r in got)
        texts = [r["text"] for r in got]
        if name == "quality_rules":
            assert all(texts) and "one" not in texts and len(got) == docs.where("length(text) > 10").count()
        elif name == "jaccard_join":
            # One of each group: the least id; equal texts and near copies.
            assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [
                (False, 1), (False, 3), (False, 4), (False, 6), (False, 7), (False, 8), (True, 0)]
        elif name == "decontamination":
            assert len(got) == docs.count()
        else:
            assert len(got) == docs.count()
            for r in got:
                if r["text"] and "token" in r["text"]:
                    assert secrets.MARK in r["text"] and r["n_chars"] == len(r["text"])
            assert sum(t is None for t in texts) == 2
            assert {r["doc_id"]: r["n_chars"] for r in got if r["doc_id"] in (1, 2, 4, 6, 8)} == {1: None, 2: 0, 4: len(prose(1, 80)), 6: None, 8: 7}
    packed = corpus_pipeline.best_fit_packing(spark, docs, SF_SMALL).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
    assert sum(r["length"] == 1 for r in packed) == 3  # null and empty texts


def test_stages_with_empty_tables(spark):
    docs = hostile(spark).where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.best_fit_packing(spark, docs, SF_SMALL).count() == 0


def test_a_repeated_run_gives_the_same_rows(spark):
    docs = hostile(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        once, again = (sorted(map(str, stage(spark, d, SF_SMALL).select("doc_id", "text", "n_chars").collect()))
                       for d in (docs, docs.repartition(7)))
        assert once == again


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0
