"""Very long texts, hubs, and columns whose names clash with the operators' own."""

import random
import time

import pytest
from pyspark.sql import functions as F

from spendlake.llm import common, language, mixing, quality, secret_scan, shingles
from spendlake.llm.queries import QUERIES  # noqa: F401  (all modules import)


def rows(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_long_values_end(spark):
    r = random.Random(1)
    base64 = "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1_000_000))
    texts = ["img " + base64, "a1" + "." * 1_000_000 + " x", "a1" + ".b1" * 300_000, "token" * 200_000 + " = 1",
             "1" + "@" * 1_000_000, "password" + ":" * 1_000_000 + "x1"]
    began = time.time()
    found = secret_scan.secret_findings(rows(spark, *texts, "the token = 0123456789abcdef0123 end")).collect()
    assert time.time() - began < 120
    values = {x.doc_id: x.value for x in found}
    assert values[0] == base64 and values[6] == "0123456789abcdef0123" and len(values[2]) == 900_002


def test_pages_left_open_end():
    began = time.time()
    for html in ("<script " * 130_000, "<!-- " * 200_000, "<" * 1_000_000, "<html " * 160_000, "<style>" * 150_000):
        text, declared, *_ = language.page_parts("http://a.example/", f"<html lang=en>before{html}")
        assert "before" in text and declared == "en"
    assert time.time() - began < 30


def test_visible_text_and_declaration():
    html = '<HTML data-x=1 lang = "fr"><script>a<b</script >x<!-- <p> -->y<style>s</STYLE>z<b>q</b>5 < 6<i'
    assert language.visible_text(html) == "  x y z q 5 < 6<i"
    assert language.declared_language(html) == "fr"
    assert language.declared_language("<html><html lang=de>") == "de"
    assert language.declared_language("<html x <html lang=xyzw>") is None


def test_a_secret_is_masked_where_it_was_found(spark):
    text = "the house\n\n of password = the  and the, token=x1y2z3 x1y2z3 the"
    table = rows(spark, text, "  the password = the", "the")
    masked = {r.doc_id: r.text for r in secret_scan.masked_documents(table, _marks(spark, "the", "x1y2z3")).collect()}
    assert masked == {
        0: "the house\n\n of password = <SECRET>  and the, token=<SECRET> x1y2z3 the",
        1: "  the password = <SECRET>", 2: "the",
    }


def _marks(spark, *values):
    return spark.createDataFrame([(v, 1) for v in values], "value string, label int")


def test_hubs_and_chains_give_the_same_components(spark, monkeypatch):
    edges = [(0, i) for i in range(1, 3000)] + [(i, i + 1) for i in range(5000, 5200)] + [(2999, 5000)]
    edges += [(9000, i) for i in range(9001, 9600)] + [(9599, 9599)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(7)
    wanted = {i: 0 for i in [*range(3000), *range(5000, 5201)]} | {i: 9000 for i in range(9000, 9600)}
    for share in (1000, 3, 10**9):  # some hubs, only the largest, all joined by broadcast
        monkeypatch.setattr(common, "HUBS", share)
        found = {r.id: r.component_id for r in common.components(table).collect()}
        assert found == wanted


CLASHING = ("__id", "__values", "__source", "__k", "__text", "__row", "row", "id", "of", "k", "position", "found",
            "found_id", "kept_id", "values", "place", "given", "changed", "copies")


@pytest.fixture(scope="module")
def clashing(spark):
    words = " ".join(f"w{i % 17}x{i}" for i in range(80))
    docs = [(i, f"{words} {i // 2}. token = 0123456789abcdef012{i % 3}", "en", "ab"[i % 2], 5) for i in range(12)]
    docs += [docs[0], (None, "no id " + words, "en", None, None), (50, None, None, "a", 0), (51, "", "fr", "a", 0)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    return table.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING))


def test_stages_keep_columns_of_any_name(spark, clashing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for stage in (
        lambda d: quality.quality_documents(d, labels),
        shingles.distinct_documents,
        secret_scan.masked_documents,
        mixing.mixed_documents,
    ):
        out = stage(clashing)
        assert out.columns == clashing.columns
        assert all(r[c] == f"{c}{r.doc_id}" for r in out.where("doc_id IS NOT NULL").collect() for c in CLASHING)


def test_pipeline_over_odd_tables(spark, clashing, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(3, 1), (None, 0), (4, None)], "doc_id long, quality int")
    clashing.write.parquet(f"{tmp_path}/full/documents.parquet")
    labels.write.parquet(f"{tmp_path}/full/labels.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    assert out and all(r.round_trip and r.n_tokens for r in out) and {r.doc_id for r in out} <= {None, *range(12)}
    clashing.where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.where("false").write.parquet(f"{tmp_path}/none/labels.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/none")
    assert out.count() == 0 and out.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids", "round_trip"]
