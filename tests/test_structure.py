from pyspark.sql import functions as F

from scenewright.operators import segment, structure

FRAGMENT = "document_id string, page_number int, frag_idx int, text string, x double, y double, font_size double, confidence double, width double, height double, label string"


def fragments(spark, rows):
    full = [("b", p, i, t, x, y, s, None, w, h, label) for i, (p, t, x, y, s, w, h, label) in enumerate(rows)]
    return spark.createDataFrame(full, FRAGMENT)


def test_layout_lines(spark):
    one = fragments(spark, [(1, "First", 10., 10., None, 20., 10., None), (1, "paragraph.", 35., 10., None, 40., 10., None), (1, "Second", 10., 30., None, 30., 10., None), (1, "paragraph.", 45., 30., None, 30., 10., None)])
    assert structure.fragments_to_text(one, "ocr").first().text == "First paragraph.\n\nSecond paragraph."
    two = fragments(spark, [(1, "cata-", 10., 100., 10., None, None, None), (1, "logues", 45., 100., 10., None, None, None)])
    assert structure.fragments_to_text(two).first().text == "catalogues"
    three = fragments(spark, [(1, t, None, None, None, None, None, None) for t in ("The", "next")])
    assert structure.fragments_to_text(three).first().text == "The next"


def test_number_headings_without_coordinates(spark):
    rows = [(1, t, None, None, None, None, None, None) for t in ("2", "T HE", "SEED", "Ravana", "He walked across the wide and empty plain.")]
    got = {r.text for r in structure.heading_candidates(fragments(spark, rows), headers=("ravana",)).collect()}
    assert "2 T HE SEED" in got
    rows = [(1, t, None, None, None, None, None, None) for t in ("1", "The", "end", "Ravana", "I am not afraid of death.", "I")]
    got = {r.text for r in structure.heading_candidates(fragments(spark, rows), headers=("ravana",)).collect()}
    assert "1 The end" in got and not any(t.startswith("I I am") for t in got)


def test_inline_and_keyword_headings(spark):
    rows = [(1, "3. The River Bend", 10., 10., 20., 50., 20., None), (1, "Body text here", 10., 60., 10., 50., 10., None), (2, "Chapter", 10., 10., 20., 50., 20., None), (2, "IV", 70., 10., 20., 10., 20., None), (2, "Storm", 10., 40., 20., 40., 20., None)]
    found = structure.heading_candidates(fragments(spark, rows))
    got = {(r.page_number, r.number, r.title) for r in found.collect()}
    assert (1, "3", "The River Bend") in got
    assert any(p == 2 and n == "IV" for p, n, _ in got)
    kinds = structure.classify_pages(fragments(spark, rows), found)
    assert {r.page_number: r.page_type for r in kinds.collect()}[1] == "SECTION_START"
    assert structure.validate_sections(found, kinds).filter("page_number = 1").first().title == "The River Bend"


def test_labelled_headings_win_when_alone(spark):
    df = fragments(spark, [(1, "II The Cave", 0., 0., 10., 1., 1., "section_header"), (1, "5 Other Place", 0., 50., 20., 1., 20., "text")])
    labelled = structure.labelled_candidates(df)
    assert [(r.number, r.title, r.score) for r in labelled.collect()] == [("II", "The Cave", 10)]
    assert structure.select_candidates(structure.heading_candidates(df), labelled).count() == 1


def test_numerals(spark):
    tokens = spark.createDataFrame([("VIL",), ("VIIL",), ("XXVIL",), ("XXXVL",), ("XXXVIIL",), ("DID",), ("12",), ("XIV",)], "token string")
    got = {r.original: r.normalized for r in structure.normalize_numerals(tokens).collect()}
    assert got == {"VIL": "VII", "VIIL": "VIII", "XXVIL": "XXVII", "XXXVL": "XXXVI", "XXXVIIL": "XXXVIII", "12": "12", "XIV": "XIV"}
    assert structure.normalize_numerals(tokens, digits=True).filter("original = '12'").count() == 0


def test_reconcile_and_recover(spark):
    s = spark.createDataFrame([("b", 1, "VIL", "The Cave", 10.0, "layout"), ("b", 1, "VII", "THE CAVE", 12.0, "layout"), ("b", 2, "DID", "He Did", 10.0, "layout"), ("b", 3, "IX", "lower start", 10.0, "layout")], "document_id string, page_number int, section_number string, title string, confidence double, detection_method string")
    got = structure.reconcile_sections(s).collect()
    assert [(r.section_number, r.title, r.confidence) for r in got] == [("VII", "THE CAVE", 12.0)]


def test_line_sections(spark):
    pages = spark.createDataFrame([("b", 1, "CHAPTER IV\nThe Long Road\nthe men walked slowly over the hills and far away from home."), ("b", 2, "Chapter 1\nChapter 2"), ("b", 3, "Plain page.")], "document_id string, page_number int, text string")
    got = structure.line_sections(pages).collect()
    assert [(r.page_number, r.section_number, r.title) for r in got] == [(1, "IV", "The Long Road")]
    assert structure.chapter_markers(pages).filter("page_number = 1").first().number == "IV"
    assert structure.line_headings(pages).filter("page_number = 2").count() == 2


def test_stories_and_chunks(spark):
    pages = spark.createDataFrame([("b", i + 1, t) for i, t in enumerate(["front", "A paragraph.", "More.", "Second story."])], "document_id string, page_number int, text string")
    heads = spark.createDataFrame([("b", 2, "One", 1.0), ("b", 4, "Two", 1.0), ("b", 9, "Beyond", 1.0)], "document_id string, page_number int, title string, confidence double")
    sections = segment.section_ranges(heads, pages)
    assert [(r.page_start, r.page_end) for r in sections.orderBy("section_order").collect()] == [(2, 3), (4, 4)]
    told = segment.stories(pages, sections).orderBy("story_order").collect()
    assert [(r.title, r.text) for r in told] == [("1. One", "A paragraph.\n\nMore."), ("2. Two", "Second story.")]
    assert [r.page_number for r in segment.unassigned_pages(pages, sections).collect()] == [1]
    cut = segment.chunks(pages, sections, size=6, overlap=2)
    assert cut.filter("section_order IS NULL").count() == 1
    assert [r.text for r in cut.filter("page_number = 2").orderBy("chunk_index").collect()] == ["A para", "ragrap", "aph."]


def reference_fold(paragraphs, target, minimum):
    groups, now, size = [], [], 0
    for p in paragraphs:
        extra = len(p) + (2 if now else 0)
        if now and size >= minimum and size + extra > target:
            groups.append("\n\n".join(now))
            now, size = [], 0
        now.append(p)
        size += extra
    if groups and size < minimum:
        groups[-1] += "\n\n" + "\n\n".join(now)
    else:
        groups.append("\n\n".join(now))
    return groups


def test_scene_fold_matches_a_loop(spark):
    cases = [[1800, 1800, 1800], [100, 50], [900, 2700, 10], [3600, 20, 4000, 880], [50] * 200, [901, 2598, 1, 900]]
    rows = [("b", i, "t", 1, 1, "\n\n".join(chr(97 + k % 26) * n for k, n in enumerate(sizes))) for i, sizes in enumerate(cases)]
    stories = spark.createDataFrame(rows, "document_id string, story_order int, title string, page_start int, page_end int, text string")
    got = {}
    for r in segment.scenes(stories).orderBy("story_order", "scene_order").collect():
        got.setdefault(r.story_order, []).append(r.text)
    for i, row in enumerate(rows):
        assert got[i] == reference_fold(row[-1].split("\n\n"), 3500, 900)
        assert "\n\n".join(got[i]) == row[-1]


def test_scene_pages(spark):
    pages = spark.createDataFrame([("b", 1, "a" * 1800), ("b", 2, "b" * 1800), ("b", 3, "c" * 1800)], "document_id string, page_number int, text string")
    heads = spark.createDataFrame([("b", 1, "One", 1.0)], "document_id string, page_number int, title string, confidence double")
    told = segment.stories(pages, segment.section_ranges(heads, pages))
    cut = segment.scenes(told)
    got = segment.scene_pages(cut, told, pages).orderBy("scene_order").collect()
    assert [(r.page_start, r.page_end) for r in got] == [(1, 1), (2, 2), (3, 3)]
    assert segment.events(cut).select(F.sum("event_order")).first()[0] == 3


def test_scenes_keep_the_digits_of_their_paragraphs(spark):
    told = spark.createDataFrame([("d", 1, "t", 1, 1, "10 men\n\n 11 more 1 \n\n2")], "document_id string, story_order int, title string, page_start int, page_end int, text string")
    assert segment.scenes(told).first().text == "10 men\n\n11 more 1\n\n2"


def test_scene_pages_from_lengths(spark, tmp_path, monkeypatch):
    """Shapes of pages give the scenes, and the pages of scenes, that texts give; the query joins no texts."""
    import random

    from scenewright.plans import books

    rng = random.Random(4)
    line = lambda: rng.choice(["", " ", "\t", "  x ", "é" * rng.randint(1, 400), "w " * rng.randint(1, 900), " " + "y" * 3600])
    rows = [(i, f"s{i % 3}", None if i % 41 == 7 else rng.choice(["", "  ", "One two\n", " Head \n\n", "a b c d e\n"]) + "\n".join(line() for _ in range(rng.randint(0, 6)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumns({"lang": F.lit("en"), "n_chars": F.length("text")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    book, told, cut = books.scenes_of(spark, str(tmp_path))
    shape = segment.page_shapes(book)
    short = segment.scene_shapes(segment.story_shapes(shape, books.sections(book)))
    keys = ["document_id", "story_order", "scene_order", "strategy"]
    size = F.when(F.col("strategy") != "story_default", F.length("text")).alias("size")
    listed = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert listed(cut.select(*keys, size)) == listed(short.select(*keys, "size")) and short.filter("scene_order > 1").count() > 5
    want = listed(segment.scene_pages(cut, told, book, para_sep="\n").select(*keys[:3], "page_start", "page_end"))
    monkeypatch.setattr(segment, "stories", None)
    assert listed(books.scene_page_ranges(spark, str(tmp_path))) == want


def test_layers_of_the_union_are_written_once(spark):
    """Sections, stories and scenes are made once, not for each layer that tells of them: of the documents only names and their counts are read again."""
    import os

    import pytest

    from scenewright.plans import books

    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("needs the test tables")
    plan = books.rag_union_counts(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("n_chars#") <= 2
