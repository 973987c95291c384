"""Identity groups and pairs by classes of names, against comparing all pairs in a loop by id."""

import random

import pytest
from pyspark.sql import functions as F

from scenewright.operators import identity

SCHEMA = "document_id string, entity_id long, entity_type string, canonical_name string, decision string, score double"


def gate(spark, names, document="b"):
    return spark.createDataFrame([(document, i, "character", n, "validated" if i % 3 else "probable", 0.8) for i, n in enumerate(names)], SCHEMA)


def invented(seed, n):
    rng = random.Random(seed)
    titles, given, last = ["Lord", "Mr.", "Professor", "King", "Lord-"], ["Anna", "Axel", "Bo", "Berta", "Shiva", "the"], ["Shiva", "Lind", "Stone", "Great", "Holy", "Lind-", "River"]
    out = []
    for _ in range(n):
        words = [rng.choice(titles)] * (rng.random() < 0.5) + [rng.choice(given) for _ in range(rng.randint(0, 2))] + [rng.choice(last) for _ in range(rng.randint(1, 3) if rng.random() < 0.4 else 1)]
        out.append(" ".join(words) + ("-" if rng.random() < 0.03 else ""))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_loop_over_all_pairs(spark, seed):
    names = [*invented(seed, 140), "Lord Shiva", "Lord Shiva Pasupathi", "Lord Shiva Pasupathi Literally", "", "Mr.", "Lord Shiva Shiva"]
    gated = gate(spark, names)
    distinct = {n: i for i, n in reversed(list(enumerate(names)))}
    rows = spark.createDataFrame([(i, n) for n, i in distinct.items()], "i int, n string")
    both = rows.alias("x").crossJoin(rows.alias("y")).select(F.col("x.n").alias("a"), F.col("y.n").alias("b"), identity.compatible(F.col("x.n"), F.col("y.n")).alias("c"))
    fits = {(r.a, r.b): (r.c.ok, r.c.confidence, r.c.method) for r in both.collect()}
    norm = {r.n: r.m for r in rows.select("n", identity.name_norm(F.col("n")).alias("m")).collect()}
    got = {(r.a, r.b): (r.confidence, r.method) for r in identity.compatible_pairs(gated).collect()}
    assert got == {(i, j): fits[names[j], names[i]][1:] for j in range(len(names)) for i in range(j) if fits[names[j], names[i]][0]}
    groups = {}
    for j, name in enumerate(names):
        home = next((i for i in sorted(groups) if fits[name, names[i]][0]), None)
        groups.setdefault(j if home is None else home, []).append(j)
    found, members = identity.identity_groups(gated)
    assert {r.group_id: list(r.member_ids) for r in found.collect()} == groups
    for r in members.collect():
        if r.entity_id != r.group_id and norm[names[r.entity_id]] != norm[names[r.group_id]]:
            assert (True, r.confidence, r.match_method) == fits[names[r.entity_id], names[r.group_id]]


def test_one_surname_that_all_share(spark, monkeypatch):
    """No step makes more rows than a few a name, and a handful of rounds settle it."""
    names = [f"{chr(65 + i % 26)}{i} Stone" for i in range(20_000)] + ["Stone", "Mr. Stone"]
    random.Random(3).shuffle(names)
    sizes, cut = [], identity._cut

    def counted(df):
        out = cut(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(identity, "_cut", counted)
    groups, _ = identity.identity_groups(gate(spark, names))
    assert max(sizes) <= 5 * len(names) and len(sizes) <= 12
    taken, single = {}, None
    for i, n in enumerate(names):
        if n.endswith("Stone") and len(n.split()) == 2 and not n.startswith("Mr."):
            if single is not None:
                taken.setdefault(single, []).append(i) if n[0] not in {names[g][0] for g in taken if g < single} else taken[next(g for g in taken if names[g][0] == n[0] and g < single)].append(i)
            elif any(names[g][0] == n[0] for g in taken):
                taken[next(g for g in taken if names[g][0] == n[0])].append(i)
            else:
                taken[i] = [i]
        elif taken:
            taken[min(taken)].append(i)
        else:
            single = i
            taken[i] = [i]
    assert {r.group_id: list(r.member_ids) for r in groups.collect()} == taken


def test_names_are_normalised_once(spark):
    """What comes after the groups is read from the written members, not worked out from the names again."""
    groups, members = identity.identity_groups(gate(spark, ["Anna Stone", "A. Stone", "Mr. Stone", "Lord-", "Lorde-", ""]))
    for df in (groups, members):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "regexp_replace" not in plan and "RLIKE" not in plan and "Join" not in plan
    assert {r.variant_name for r in members.collect()} >= {"Anna Stone", "Mr Stone", "Lord"}
