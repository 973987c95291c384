"""Lines by a running median and the spatial rules of sections, against plain Python."""

import random
from statistics import median

from scenewright.operators import structure

SCHEMA = "document_id string, page_number int, frag_idx int, text string, x double, y double, font_size double, confidence double, width double, height double, label string"


def lines_by_force(rows, source):
    """All lines are looked at for each fragment, the nearest median within the tolerance takes it."""
    mid = lambda r: r[5] + (abs(r[9]) / 2 if r[9] is not None else 0)
    scale = median([abs(r[9]) for r in rows if r[9] and abs(r[9]) > 0.1] or [abs(r[6]) for r in rows if r[6] and abs(r[6]) > 0.1] or [8.0])
    lines = []
    for r in sorted(rows, key=mid, reverse=source.startswith("pdf")):
        near = [(abs(mid(r) - median(map(mid, g))), k) for k, g in enumerate(lines)]
        near = [d for d in near if d[0] <= max(1.5, scale * 0.45)]
        lines[min(near)[1]].append(r) if near else lines.append([r])
    return [(median(map(mid, g)), [r[3] for r in sorted(g, key=lambda r: r[4])]) for g in lines]


def test_lines_by_running_median(spark):
    rng = random.Random(2)
    for source in ("ocr", "pdf_text"):
        rows = []
        for page in range(1, 25):
            y = 0.0
            for i in range(rng.randint(1, 40)):
                y += rng.choice([0.0, 0.4, 1.1, 2.0, 2.9, 7.0])  # drifts: neighbours are close, ends of a line are not
                rows.append(("b", page, i, f"t{i}", float(rng.randint(0, 500)), y, 10.0, None, 5.0, rng.choice([None, 6.0, 8.0, -8.0]), None))
        rng.shuffle(rows)
        got = {}
        for r in structure.layout_lines(spark.createDataFrame(rows, SCHEMA), source).collect():
            got.setdefault(r.page_number, []).append((r.line, r.y, r.text.split()))
        for page in range(1, 25):
            want = lines_by_force(sorted((r for r in rows if r[1] == page), key=lambda r: r[2]), source)
            found = [(y, t) for _, y, t in sorted(got[page])]
            assert [sorted(t) for _, t in found] == [sorted(t) for _, t in want]
            assert all(abs(a[0] - b[0]) < 1e-9 for a, b in zip(found, want, strict=True))


def test_drifting_fragments_make_two_lines(spark):
    """Neighbours are never further apart than the tolerance, but the third is too far from the median of the first two."""
    rows = [("b", 1, i, t, x, y, 10.0, None, 5.0, 10.0, None) for i, (t, x, y) in enumerate([("a", 1.0, 0.0), ("b", 2.0, 4.0), ("c", 3.0, 8.0), ("d", 4.0, 11.0)])]
    lines = structure.layout_lines(spark.createDataFrame(rows, SCHEMA), "ocr").orderBy("line").collect()
    assert [(r.text, r.y) for r in lines] == [("a b", 7.0), ("c d", 14.5)]


PARTS = "document_id string, page_number int, score int, parts array<struct<text:string,x:double,y:double>>"


def test_spatial_rules(spark):
    rows = [
        ("b", 1, 5, [("CHAPTER", 10.0, 5.0), ("iv.", 10.0, 10.0), ("River", 90.0, 12.0), ("The", 40.0, 20.0)]),  # two fragments close in height
        ("b", 2, 5, [("7", 10.0, 10.0), ("The", 40.0, 10.0), ("Sea", 80.0, 90.0)]),  # too far apart for the bonus
        ("b", 3, 5, [("7", 10.0, 10.0), ("Contents", 40.0, 10.0), ("112", 300.0, 10.0)]),  # number far to the right
        ("b", 4, 5, [("7", 10.0, 10.0), ("Sea", 40.0, 10.0), ("PAGE", 50.0, 10.0)]),  # page mark
        ("b", 5, 5, [("7", 10.0, 10.0), ("chapter", 40.0, 10.0)]),  # no title
        ("b", 6, 5, [("Sea", 40.0, 10.0)]),  # no number
        ("b", 7, 5, [("7", 10.0, 10.0), ("Sea", 40.0, 10.0)]),  # contents page
        ("b", 8, 2, [("7", None, None), ("Sea", 400.0, None), ("shore", 300.0, None)]),  # no places: nothing is far
    ]
    kinds = spark.createDataFrame([("b", p, "CONTENTS" if p == 7 else "NORMAL") for p in range(1, 9)], "document_id string, page_number int, page_type string")
    got = {r.page_number: (r.section_number, r.title, r.confidence) for r in structure.validate_sections(spark.createDataFrame(rows, PARTS), kinds, least=0.0).collect()}
    assert got == {1: ("IV", "The River", 10.5), 2: ("7", "The Sea", 9.0), 4: ("7", "Sea", 5.0), 7: ("7", "Sea", 4.0), 8: ("7", "shore Sea", 6.0)}
    assert {r.page_number for r in structure.validate_sections(spark.createDataFrame(rows, PARTS), kinds).collect()} == {1, 2}
