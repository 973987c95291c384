"""Queries over whole tables: what a filter or a cut would leave out."""

import hashlib
import os
import re

import duckdb
import pytest

from scenewright.operators import packages
from scenewright.plans import catalogue, chains

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "customer orders events documents pages conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_pages_of_all_languages_reach_the_later_queries(spark, duck):
    docs = duck.sql("SELECT doc_id, source, text FROM documents").fetchall()
    for name in ("package_quality", "prompts_by_mode"):
        assert {r.doc_id for r in catalogue.QUERIES[name](spark, DATA).select("doc_id").collect()} == {d[0] for d in docs}
    assert {r.scene_id for r in catalogue.QUERIES["scene_context"](spark, DATA).select("scene_id").collect()} == {d[0] for d in docs}
    said = {(r.doc_id, r.canonical_name) for r in catalogue.QUERIES["proper_name_mentions"](spark, DATA).select("doc_id", "canonical_name").collect()}
    named = {(s, n) for (i, n) in said for (j, s, _) in docs if i == j}
    for name in ("candidate_gate", "evidence_labels", "visual_entity_validation"):
        assert {(r.document_id, r.canonical_name) for r in catalogue.QUERIES[name](spark, DATA).select("document_id", "canonical_name").collect()} == named
    assert {(r.doc_id, r.canonical_name) for r in catalogue.QUERIES["presence"](spark, DATA).select("doc_id", "canonical_name").collect()} == said
    assert any(re.search(r"[^\x00-\x7F]", n) for _, n in said)


def test_moments_of_all_languages(spark, duck):
    """By a loop in Python: DuckDB's word boundaries stop at letters outside ASCII."""
    want = set()
    for doc, text in duck.sql("SELECT doc_id, text FROM documents").fetchall():
        flat = re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ")
        said = {s for s in re.split(r"(?<=[.!?]) ", flat) if s and len(s.split(" ")) >= 4}
        has = lambda s, p: re.search(p, s) is not None
        kept = [s for s in said if not has(s, packages.SPEECH) or has(s, packages.L.ACTION)]
        score = {s: 10 + 50 * has(s, packages.L.ACTION) + 12 * has(s, packages.L.DESTRUCTION) + 8 * has(s, packages.L.COMBAT) + 6 * has(s, packages.L.REACTION) for s in kept}
        best = sorted(kept, key=lambda s: (-score[s], s.lower(), s))[:3]
        want |= {(doc, k, score[s], hashlib.md5(s.encode()).hexdigest()) for k, s in enumerate(best, 1)}
    got = catalogue.QUERIES["moments_topk"](spark, DATA).select("doc_id", "rank", "score", "moment_md5").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_blocks_are_whole_and_without_tags(spark):
    long = "word " * 60 + "end"
    page = f"<html><style>p{{}}</style><script>t='<p>no</p>'</script><!-- <p>no</p> --><ul><li><a href='/x'>Link</a></li></ul><h1 class='a'>A <i>title</i></h1><p><b>bold</b> and<br>plain<p>{long}</p><P>a < b</P><p>open<footer>foot</footer></html>"
    got = chains.html_fragments(spark.createDataFrame([(1, page)], "page_id long, html string")).orderBy("frag_idx").collect()
    assert [r.text for r in got] == ["Link", "2 A title", "bold and plain", long, "a < b", "open"]
    assert [r.label for r in got] == ["text", "section_header", *["text"] * 4]
