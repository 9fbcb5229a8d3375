"""Odd tables: nulls, empty and long texts, repeated rows, no rows, extra columns with clashing names."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from refreshguard.llm import (decontam, hnsw, htmltext, jaccard, langid, mixing, pii, secrets,
                              toxicity, warc)

NONE = hashlib.sha256(b"").hexdigest()
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, "
          "block string, size string, text_hash string, class string, spans string")
LONG = "alpha beta gamma delta " * 20_000
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def docs_rows():
    def row(i, text, lang="en", source="a"):
        return (i, text, lang, source, len(text or ""), "k", "b", "s", "h", "c", "x")

    return [row(1, WORDS), row(1, WORDS), row(2, WORDS), row(3, ""), row(4, None), row(5, LONG),
            row(None, WORDS + " fifteen"), row(6, "mail a.b@c.de now", None, None),
            row(7, "\n \t ", "de", None), row(8, "héllo wörld", "fr", "b"), row(3, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(docs_rows(), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, None, None), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, WORDS), (2, None), (3, ""), (None, WORDS), (4, "too short")],
                                 "item_id long, text string")


def by_id(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["doc_id"], []).append(r.asDict())
    return out


def test_secrets(docs, nothing):
    model = secrets.train(secrets.labelled_strings(docs))
    rows = by_id(secrets.secret_report(docs, model))
    assert sum(map(len, rows.values())) == docs.count()
    assert rows[4][0]["base_sha256"] == rows[3][0]["base_sha256"] == NONE
    assert rows[5][0]["spans"] == ""
    empty = secrets.train(secrets.labelled_strings(nothing))
    assert set(empty) == {0} and secrets.secret_report(nothing, empty).count() == 0


def test_pii(docs, nothing):
    model = pii.train(docs)
    rows = by_id(pii.pii_report(docs, model))
    assert rows[6][0]["spans"] == "email:5:13" and rows[6][0]["n_email"] == 1
    assert rows[4][0]["base_sha256"] == NONE and len(rows[1]) == 2
    new = by_id(pii.redact(docs, model))
    assert new[6][0]["text"] == "mail [email] now" and new[6][0]["n_chars"] == 16
    assert new[4][0]["text"] is None and new[1][0]["text"] == WORDS
    assert pii.redact(docs, model).columns == docs.columns
    assert pii.pii_report(nothing, pii.train(nothing)).count() == 0


def test_toxicity(docs, nothing, labels):
    model = toxicity.train(docs, labels)
    rows = by_id(toxicity.toxicity_report(docs, model))
    assert sum(map(len, rows.values())) == docs.count()
    assert all(0 <= r["score"] <= 1 for found in rows.values() for r in found)
    assert rows[3][0]["score"] == rows[4][0]["score"] == rows[7][0]["score"]
    assert rows[None][0]["held_out"]
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.toxicity_report(nothing, toxicity.train(nothing, labels)).count() == 0


def test_language(docs, nothing):
    model = langid.train(docs)
    rows = by_id(langid.language_report(docs, model))
    assert {rows[k][0]["lang_pred"] for k in (3, 4, 7)} == {"und"}
    assert all(0 <= r["score"] <= 1 for found in rows.values() for r in found)
    assert langid.language_report(nothing, langid.train(nothing)).count() == 0
    assert {r["lang_pred"] for r in langid.language_report(docs, langid.train(nothing)).collect()} \
        == {"und"}


def test_jaccard(docs, nothing):
    rows = by_id(jaccard.jaccard_groups(docs))
    assert [r["component_id"] for r in rows[1]] == [1, 1] and rows[2][0]["component_id"] == 1
    assert rows[None][0]["component_id"] == 1  # 10 of 11 shingles
    assert [r["n_shingles"] for r in rows[3]] == [0, 0] and rows[3][0]["component_id"] == 3
    assert rows[4][0]["n_shingles"] == 0 and rows[8][0]["n_shingles"] == 1
    assert rows[5][0]["n_shingles"] == 4
    assert jaccard.jaccard_groups(nothing).count() == 0
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [1, 3, 3, 4, 5, 6, 7, 8]
    assert jaccard.one_of_each_group(nothing).count() == 0


def test_decontamination(docs, nothing, benchmark, spark):
    rows = by_id(decontam.decontamination_report(docs, benchmark))
    assert sum(map(len, rows.values())) == docs.count()
    assert {k for k, found in rows.items() if found[0]["contaminated"]} == {None, 1, 2}
    assert rows[1][0]["passages"] == "1:0:14"
    assert decontam.drop_contaminated(docs, benchmark).columns == docs.columns
    assert decontam.drop_contaminated(docs, benchmark).count() == docs.count() - 4
    assert decontam.decontamination_report(nothing, benchmark).count() == 0
    none = benchmark.limit(0)
    assert decontam.drop_contaminated(docs, none).count() == docs.count()


def test_mixing(docs, nothing):
    rows = by_id(mixing.mix_report(docs))
    assert sum(map(len, rows.values())) == docs.count()
    assert rows[4][0]["size"] == rows[7][0]["size"] == 0 and rows[7][0]["taken"] == 0
    assert all(r["taken"] <= 3 * r["size"] for found in rows.values() for r in found)
    out = mixing.mixed(docs)
    assert out.columns[:len(docs.columns)] == docs.columns and "mix_size" in out.columns
    assert mixing.mix_report(nothing).count() == 0


def test_pages(spark):
    schema = "page_id long, url string, html string, host string, digest string, text string"
    page = "<article><h1>A</h1><p>b &amp; c<p>d</article><footer>no</footer>"
    rows = [(1, "http://x.org/1", page, "h", "d", "t"), (1, "http://x.org/1", page, "h", "d", "t"),
            (2, None, None, "h", "d", "t"), (3, "http://y.org", "", "h", "d", "t"),
            (None, "http://x.org/2", page, "h", "d", "t"),
            (4, "http://x.org/\r\n4", "<p>" + "long " * 100_000, "h", "d", "t")]
    pages = spark.createDataFrame(rows, schema)
    text = {r["page_id"]: r for r in htmltext.extract(pages).collect()}
    assert text[1]["text"] == "A\nb & c\nd" and text[1]["n_chars"] == 9
    assert text[2]["text"] == text[3]["text"] == "" and text[4]["n_chars"] == 499_999
    assert htmltext.extract(pages).count() == 6
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"])
                   for r in warc.archive_report(pages).collect())
    assert kinds == [(0, "revisit", 1), (1, "response", None), (1, "response", None),
                     (2, "revisit", 3), (3, "response", None), (4, "response", None)]
    none = pages.limit(0)
    assert htmltext.extract(none).count() == 0 and warc.archive_report(none).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [0.0, 1.0], "x"),
            (3, None, "x"), (4, [], "x"), (5, [0.0, 0.0], "x"), (6, [nan, 1.0], "x"),
            (7, [1.0, None], "x"), (8, [inf, 1.0], "x"), (9, [1.0, 2.0, 3.0], "x"),
            (None, [1.0, 1.0], "x"), (20, [0.5, 0.5], "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    found = [(r["query_id"], r["rank"], r["vec_id"], r["score"])
             for r in hnsw.nearest(vectors).orderBy("query_id", "rank").collect()]
    # 9 is longer: what the others lack of it counts as zero.
    assert found == [(0, 1, 1, 1.0), (0, 2, 9, 1.0), (0, 3, 20, 0.5), (0, 4, 2, 0.0),
                     (20, 1, 9, 1.5), (20, 2, 0, 0.5), (20, 3, 1, 0.5), (20, 4, 2, 0.5)]
    assert hnsw.nearest(vectors.limit(0)).count() == 0


def test_pipeline_stages(spark, docs, nothing, labels, benchmark, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    for table in (docs, nothing):
        frame = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, str(tmp_path))
            assert frame.columns == docs.columns, name
        last = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path))
        assert last.filter(F.col("taken") > 0).count() == last.count()
