"""Exported layouts, and what may be supposed of a character."""

import pytest
from pyspark.sql import functions as F

from scenewright.operators import profiles
from scenewright.sources import layouts


def test_layouts_keep_texts_whole(spark, tmp_path):
    """Quotes, commas, line breaks, backslashes and white space at the ends come back as they were; the order is kept over files."""
    texts = ['a "b", c\n\n d\\"', " ends ", "", None, "r\r\nn", "\\", "\t#x"]
    rows = [("d1", 10 - i, 1, 10 - i, t, i, i + 1, i / 7, "m", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "document_id string, scene_id int, story_id int, scene_order int, title string, page_start int, page_end int, confidence double, segmentation_method string, text string")
    path = str(tmp_path / "scenes")
    layouts.export_layout(df, "scenes", path)
    got = layouts.read_layout(spark, "scenes", path).collect()
    assert {(r.scene_id, r.text, r.title) for r in got} == {(str(10 - i), t or "", t or "") for i, t in enumerate(texts)}
    assert {r.scene_id: r.confidence for r in got}["9"] == "0.143" and {r.scene_id: r.confidence for r in got}["10"] == "0.0"
    one = df.coalesce(1)
    layouts.export_layout(one, "scenes", str(tmp_path / "folders"), folders=True)
    assert (tmp_path / "folders" / "document_id=d1").is_dir()
    back = layouts.read_layout(spark, "scenes", str(tmp_path / "folders"))
    assert back.count() == len(rows) and back.columns == ["document_id", *layouts.LAYOUTS["scenes"].columns]


def test_layout_rows(spark):
    cut = spark.createDataFrame([("d", 1, 0, "A", 1, 0.0625), ("d", 2, None, "B", 5, 2 / 3), ("d", 3, 7, None, 9, None)], "document_id string, section_order int, section_number int, title string, page_start int, confidence double")
    assert [tuple(r) for r in layouts.layout_rows(cut, "chapter_index").orderBy("page_number").collect()] == [("d", "", "A", "1"), ("d", "", "B", "5"), ("d", "7", "", "9")]
    assert [r.confidence for r in layouts.layout_rows(cut, "sections").orderBy("section_order").collect()] == ["0.062", "0.667", ""]
    assert layouts.layout_rows(cut.limit(0), "sections").count() == 0
    with pytest.raises(ValueError, match="section_order"):
        layouts.export_layout(cut.drop("section_order"), "sections", "/nowhere")


def test_visual_profiles(spark):
    people = spark.createDataFrame(
        [(1, "King  Arun", ["He ruled."], "fantasy", ["detected culture: indic"]), (2, "Mira", ["An aged woman."], "unheard", None), (3, None, None, None, None)],
        "profile_id long, canonical_name string, contexts array<string>, genre string, labels array<string>",
    )
    told = spark.createDataFrame(
        [(1, "Expression", "stern", "supported"), (1, "build", "tall", "CONFLICT"), (1, "hair_color", " dark ", None), (2, "clothing", "", "supported"), (9, "build", "tall", "supported")],
        "profile_id long, attribute string, value string, status string",
    )
    got = {r.profile_id: r for r in profiles.visual_profiles(people, told).collect()}
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert one.visual_role == "ruler" and [tuple(f) for f in one.source_facts] == [("Expression", "stern"), ("hair_color", "dark")]
    # presentation is settled by the expression, physique is not, as that fact is in conflict
    assert [(f.attribute, f.basis) for f in one.inferred_facts] == [("world_context", "world_context"), ("visual_style", "genre_prior"), ("costume_direction", "genre_prior")]
    assert one.unknown_attributes == ["exact_age", "exact_height", "eye_color", "facial_measurements"] and one.identity_anchor.startswith("vib-") and len(one.identity_anchor) == 16
    # an unknown genre keeps its name and takes the default's baseline; an elder's prior speaks of an exact age and is left out
    assert got[2].visual_role == "elder" and got[2].genre == "unheard" and len(got[2].inferred_facts) == 3 and not any("exact age" in f.value for f in got[2].inferred_facts)
    assert got[3].visual_role == "person" and got[3].canonical_name == "" and got[3].source_facts == [] and len(got[3].inferred_facts) == 5
    assert profiles.visual_profiles(people.limit(0), told.limit(0)).count() == 0
    assert all(f.locked for f in one.inferred_facts)


def test_labels_and_genres(spark):
    seen = spark.createDataFrame([("d", "period", 1, "modern"), ("d", "culture", 1, "greek"), ("d", "culture", 2, "roman"), ("d", "religious_context", 1, "sikh"), ("d", "narrative_type", 1, "fantasy")], "document_id string, dimension string, rank int, label string")
    assert profiles.context_labels(seen).first().labels == ["detected culture: greek", "detected religious context: sikh", "detected period: modern"]
    assert [tuple(r) for r in profiles.genres(seen).collect()] == [("d", "fantasy")]


def test_half_a_thousandth_is_rounded_by_its_binary_value(spark):
    """1 / 2000 is stored a little above 0.0005."""
    from scenewright.sources.tables import export_rows

    values = [1 / 2000, -1 / 2000, 0.00049999, 0.0007, 0.0009999, 0.0015, 0.0625, 0.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [float(r.v) for r in export_rows(df, ["i", "v"]).orderBy(F.col("i").cast("int")).collect()]
    assert got == [float(f"{v:.3f}") for v in values]
