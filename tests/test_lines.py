import random
from statistics import median

from pyspark.sql import functions as F

from scenewright.functions.text import join_tokens
from scenewright.operators import structure


def glue(tokens):
    out = ""
    for t in (t.strip(" ") for t in tokens):
        if not t or not out:
            out = out or t
        elif out.endswith("-") and t[0].islower():
            out = out[:-1] + t
        elif t[0] in ",.;:!?%)]}" or out[-1] in "([{—–/":
            out += t
        else:
            out += " " + t
    return out


def test_tokens_are_joined_as_one_by_one(spark):
    dice = random.Random(3)
    lines = [[dice.choice(["a", "-", "b-", "(", "—", ",", ".x", "", " ", "É", "two words", "[-", "/-", "\u0001", "a\u0001"]) for _ in range(dice.randint(0, 7))] for _ in range(400)]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, t array<string>").select("i", join_tokens(F.col("t")).alias("s"))
    assert {r.i: r.s for r in got.collect()} == {i: glue(t) for i, t in enumerate(lines)}


def test_lines_follow_the_running_median(spark):
    dice = random.Random(5)
    pages = [sorted(round(dice.uniform(0, 60), 1) for _ in range(dice.randint(1, 30))) for _ in range(60)]
    rows = [("d", p, k, f"w{k}", float(k), y, 10.0, 10.0) for p, ys in enumerate(pages) for k, y in enumerate(ys)]
    got = structure.layout_lines(spark.createDataFrame(rows, "document_id string, page_number int, frag_idx int, text string, x double, y double, font_size double, height double"), "ocr")
    expected = []
    for p, ys in enumerate(pages):
        held = []
        for y in ys:
            if held and abs(y + 5.0 - median(held[-1])) <= 4.5:
                held[-1].append(y + 5.0)
            else:
                held.append([y + 5.0])
        expected += [(p, i, round(median(h), 6)) for i, h in enumerate(held)]
    assert sorted((r.page_number, r.line, round(r.y, 6)) for r in got.collect()) == expected


def test_pages_are_laid_out_once(spark):
    rows = spark.range(10).selectExpr("'d' AS document_id", "id AS page_number", "id AS frag_idx", "'t' AS text", "1.0D AS x", "1.0D AS y", "1.0D AS font_size", "1.0D AS height")
    plan = structure.fragments_to_text(rows, "ocr")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("line_starts(") == 1
