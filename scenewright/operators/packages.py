"""Scene packages: dialogue, moments, presence, inferred attributes, prompts, quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import clean_limit, sentences, trimmed_items, unique_limit

SPEECH = r"(?i)\b(?:said|says|asked|replied|answered|whispered|shouted|cried)\b"
QUOTES = "[\"“]([^\"”]+)[\"”]"
STYLES = {
    "destruction": "wide shot through smoke and ruin", "combat": "fast, close coverage", "travel": "tracking shot along the way",
    "dialogue": "over-the-shoulder exchange", "characters": "medium shot of those present", "default": "establishing shot",
}


def words(c: Column) -> Column:
    return F.size(F.filter(F.split(F.btrim(c), r"\s+"), lambda w: w != ""))


def dialogue(scenes: DataFrame, mode: str = "ranked", *, keys: list[str], spoken: str = SPEECH) -> DataFrame:
    """keys, rank, line. ranked: quotes of 4 words and more by length and a speech word near; ordered: the first quotes, else sentences that sound spoken."""
    if mode == "ranked":
        q = scenes.select(*keys, "text", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(QUOTES), 1))).alias("line")).filter(words(F.col("line")) >= 4)
        at = F.instr("text", F.col("line"))
        start = F.greatest(F.lit(1), at - 120)
        near = F.substr("text", start, at - start + F.length("line") + 100)
        score = F.least(F.length("line"), F.lit(120)) + F.when(near.rlike(spoken), 80).otherwise(0)
        w = Window.partitionBy(*keys).orderBy(F.desc("score"), "line")
        return q.withColumn("score", score).withColumn("rank", F.row_number().over(w)).filter("rank <= 3").select(*keys, "rank", F.btrim("line").alias("line"), "score")
    quotes = F.slice(F.array_distinct(F.filter(trimmed_items(F.regexp_extract_all("text", F.lit(QUOTES), 1)), lambda s: words(s) >= 3)), 1, 3)
    said = F.slice(F.array_distinct(F.filter(sentences(F.col("text")), lambda s: s.rlike(spoken) | (s.rlike(r"^(?:I|We|My|Our)\b") & (words(s) <= 28)))), 1, 2)
    return scenes.select(*keys, F.posexplode(F.when(F.size(quotes) > 0, quotes).otherwise(said)).alias("i", "line")).withColumn("rank", F.col("i") + 1).drop("i")


def has(c: str | Column, pattern: str) -> Column:
    """Whether a column holds a pattern whose words and word boundaries are those of all alphabets."""
    return (F.col(c) if isinstance(c, str) else c).rlike("(?U)" + pattern)


def by_first_letters(words: list[str]) -> str:
    """A pattern for the same words, branching letter by letter: at a place few of a long list of words are tried."""
    if len(words) < 2 or not all(w[:1].isalpha() for w in words):
        return "|".join(words)
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[0], []).append(w[1:])
    return "|".join(h + (rest[0] if len(rest) == 1 else f"(?:{by_first_letters(rest)})") for h, rest in heads.items())


def _listed(pattern: str) -> list[str]:
    return pattern.removeprefix(r"(?i)\b(?:").removesuffix(r")\b").split("|")


def any_word(words: list[str]) -> str:
    """A pattern that is found where any of the words is, but gone through once and word by letters."""
    return rf"(?i)(?=[{''.join(sorted({w[0] for w in words}))}])\b(?:{by_first_letters(words)})\b"


#: A word of action or presence.
_WORDS = sorted({*_listed(L.ACTION), *_listed(L.PRESENCE)})
LIVELY = any_word(_WORDS)
#: A word that a moment's score or its place among the moments depends on.
_TELLING = sorted({w for p in (SPEECH, L.ACTION, L.DESTRUCTION, L.COMBAT, L.REACTION) for w in _listed(p)})
TELLING = any_word(_TELLING)
#: A word that tells a scene's coverage.
MOVING = any_word(sorted({w for p in (L.DESTRUCTION, L.COMBAT, L.TRAVEL) for w in _listed(p)}))


def moments(scenes: DataFrame, events: DataFrame | None = None, names: DataFrame | None = None, *, keys: list[str], k: int = 4, min_words: int = 4) -> DataFrame:
    """keys, rank, moment, score: events and sentences by action, destruction, combat, reaction and named characters."""
    bonus = lambda p, n, m="moment": F.when(has(m, p), n).otherwise(0)

    def scored(m: Column) -> Column:
        # most sentences hold no such word, which one pass over them tells
        worth = 10 + bonus(L.ACTION, 50, m) + bonus(L.DESTRUCTION, 12, m) + bonus(L.COMBAT, 8, m) + bonus(L.REACTION, 6, m)
        score = F.when(~has(m, TELLING), 10).when(~has(m, SPEECH) | has(m, L.ACTION), worth)
        return F.struct((-score).alias("less"), F.lower(m).alias("low"), m.alias("moment"))

    each = F.filter(F.transform(F.array_distinct(sentences(F.col("text"), min_words)), lambda m: scored(m)), lambda x: x["less"].isNotNull())
    if names is None:  # of a row's sentences none but its own first k can be among the first k, so no others are moved
        each = F.slice(F.sort_array(each), 1, k)
    said = scenes.select(*keys, F.explode(each).alias("__m"))
    rows = said.select(*keys, F.col("__m.moment").alias("moment"), (-F.col("__m.less")).alias("score"), F.lit(12).alias("__named"))
    if events is not None:
        told = events.select(*keys, clean_limit(F.col("text"), 300).alias("moment")).filter("moment <> ''")
        rows = rows.unionByName(told.withColumn("score", 50 + bonus(L.ACTION, 35) + bonus(L.DESTRUCTION, 10)).withColumn("__named", F.lit(10)))
    if names is not None:
        listed = names.groupBy(*keys).agg(F.collect_set(F.lower("canonical_name")).alias("__names"))
        rows = rows.join(listed, keys, "left")
        here = F.exists(F.coalesce("__names", F.array().cast("array<string>")), lambda n: (n != "") & F.contains(F.lower("moment"), n))
        rows = rows.withColumn("score", F.col("score") + F.when(here, F.col("__named")).otherwise(0)).drop("__names")
    best = rows.groupBy(*keys, "moment").agg(F.max("score").alias("score"))
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.lower("moment"), "moment")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def presence(names: DataFrame | None, events: DataFrame | None, contexts: DataFrame, *, keys: list[str], visible: int | None = None, referenced: int | None = None) -> DataFrame:
    """keys, canonical_name, visible: an event, else a context, that names the character has a word of action or presence.

    names: the characters of each scene; without it they are those of the contexts' canonical_name, so that one pass over
    the contexts gives both. visible and referenced: how many names of a scene are listed of either kind, in order of the
    name (all by default).
    """
    # only texts with such a word are looked at, each once, with all names of its scene beside it
    low = lambda c: F.when(has(c, LIVELY), F.lower(c)).alias("low")
    none = F.lit(None).cast("string").alias("canonical_name")
    rows = contexts.select(*keys, none if names is not None else "canonical_name", low("context"))
    if names is not None:
        rows = rows.unionByName(names.select(*keys, "canonical_name", F.lit(None).cast("string").alias("low")))
    if events is not None:
        rows = rows.unionByName(events.select(*keys, none, low("text")))
    scenes = rows.filter("canonical_name IS NOT NULL OR low IS NOT NULL").groupBy(*keys).agg(F.collect_set("canonical_name").alias("ns"), F.collect_set("low").alias("lows"))
    seen = lambda n: F.struct(n.alias("canonical_name"), F.exists("lows", lambda t: F.contains(t, F.lower(n))).alias("visible"))
    out = scenes.select(*keys, F.explode(F.transform("ns", seen)).alias("n")).select(*keys, "n.*")
    if visible is None and referenced is None:
        return out
    place = F.row_number().over(Window.partitionBy(*keys, "visible").orderBy("canonical_name"))
    most = F.when(F.col("visible"), F.lit(visible)).otherwise(F.lit(referenced))
    return out.withColumn("__place", place).filter(most.isNull() | (F.col("__place") <= most)).drop("__place")


def direction(c: Column, has_dialogue: Column, has_characters: Column) -> Column:
    """Class of a scene's coverage, the first that fits."""
    told = F.when(c.rlike(L.DESTRUCTION), "destruction").when(c.rlike(L.COMBAT), "combat").otherwise("travel")
    return F.when(c.rlike(MOVING), told).when(has_dialogue, "dialogue").when(has_characters, "characters").otherwise("default")


def infer_attributes(known: DataFrame, priors: DataFrame, roles: DataFrame) -> DataFrame:
    """profile_id, attribute, value, source: source facts without conflict, and priors of the role for attributes that are not known."""
    facts = known.filter("status <> 'conflict'").select("profile_id", "attribute", "value", F.lit("source").alias("source"))
    guessed = roles.join(priors, "role").select("profile_id", "attribute", "value").join(known.select("profile_id", "attribute").distinct(), ["profile_id", "attribute"], "left_anti")
    return facts.unionByName(guessed.withColumn("source", F.lit("inferred")))


def identity_anchor(*parts: Column) -> Column:
    """vib- and 12 hex digits of the parts' digest."""
    return F.concat(F.lit("vib-"), F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 12))


def scene_packages(scenes: DataFrame, children: dict[str, tuple[DataFrame, list[str]]], *, key: str = "scene_id") -> DataFrame:
    """One row per scene with each child table nested, in its order (name: rows, order columns)."""
    out = scenes
    for name, (rows, order) in children.items():
        fields = [*order, *[c for c in rows.columns if c not in (*order, key)]]
        nested = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
        out = out.join(nested, key, "left").withColumn(name, F.coalesce(name, F.array().cast(nested.schema[name].dataType)))
    return out


def evidence_list(*typed: tuple[str, Column]) -> Column:
    """Arrays of structs with a `text` field, as one array of (kind, text)."""
    def of(kind: str, c: Column) -> Column:
        return F.transform(c, lambda x: F.struct(F.lit(kind).alias("kind"), x["text"].alias("text")))

    return F.concat(*[of(kind, c) for kind, c in typed])


def render(packages: DataFrame, template: str = "{title}. {moment} Characters: {names}. Source-grounded; unknown details stay unknown.", *, clips: int = 3) -> DataFrame:
    """packages (title, names, moments, ...) with image_prompt, clips and shots; the focus of clip i is moment i modulo their number."""
    def fill(moment: Column) -> Column:
        out = F.lit(template)
        for name, value in (("{title}", F.coalesce("title", F.lit(""))), ("{names}", F.array_join(F.slice("names", 1, 6), ", ")), ("{moment}", moment)):
            out = F.replace(out, F.lit(name), value)
        return out

    n = F.greatest(F.size("moments"), F.lit(1))
    focus = lambda i: F.coalesce(F.try_element_at("moments", (i % n + 1).cast("int")), F.lit("Quiet scene."))
    shots = F.least(F.lit(6), F.greatest(F.lit(4), F.size("moments")))
    return packages.withColumns({
        "image_prompt": fill(focus(F.lit(0))),
        "clips": F.transform(F.sequence(F.lit(0), F.lit(clips - 1)), lambda i: F.struct((i + 1).alias("number"), fill(focus(i)).alias("prompt"))),
        "shots": F.transform(F.sequence(F.lit(0), shots - 1), lambda i: F.struct((i + 1).alias("number"), focus(i).alias("focus"))),
    })


def quality_errors(packages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """packages with errors (the names of rules whose SQL condition holds) and status."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(F.expr(condition), F.lit(False)), F.lit(name)) for name, condition in rules]))
    return packages.withColumn("errors", found).withColumn("status", F.when(F.size("errors") == 0, "pass").otherwise("fail"))


#: (error, condition under which a rendered package has it)
PACKAGE_RULES = [
    ("missing_title", "title IS NULL OR trim(title) = ''"), ("image_prompt_missing", "image_prompt IS NULL OR trim(image_prompt) = ''"),
    ("image_prompt_too_short", "length(image_prompt) < 60"), ("clip_count", "size(clips) <> 3"), ("shot_count", "size(shots) NOT BETWEEN 4 AND 6"),
    ("clip_numbering", "transform(clips, c -> c.number) <> sequence(1, size(clips))"), ("shot_numbering", "transform(shots, s -> s.number) <> sequence(1, size(shots))"),
    ("empty_clip", "exists(clips, c -> trim(c.prompt) = '')"), ("empty_shot", "exists(shots, s -> trim(s.focus) = '')"),
    ("grounding_phrase_missing", "NOT contains(image_prompt, 'Source-grounded')"), ("unknown_phrase_missing", "NOT contains(image_prompt, 'unknown details stay unknown')"),
    ("name_missing_in_prompt", "size(names) > 0 AND NOT contains(image_prompt, names[0])"), ("no_moments", "size(moments) = 0"),
    ("page_range", "page_end < page_start"), ("text_missing", "text IS NULL OR trim(text) = ''"),
]


def quality_histogram(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def even_sample(df: DataFrame, n: int, order: str) -> DataFrame:
    """n rows spread evenly in order: places round(i * (count - 1) / (n - 1)), halves up."""
    total = df.agg(F.count(F.lit(1)).alias("__count"))
    i = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    places = total.select(F.col("__count"), i.alias("__i")).select(F.least(F.col("__count") - 1, F.round(F.col("__i") * (F.col("__count") - 1) / max(1, n - 1))).cast("long").alias("__place")).filter("__place >= 0").distinct()
    numbered = df.withColumn("__all", F.lit(1))
    from ..functions.ranges import numbered as ranked

    placed = ranked(numbered, "__all", order, "__n").withColumn("__place", (F.col("__n") - 1).cast("long"))
    return placed.join(F.broadcast(places), "__place").drop("__all", "__n").withColumnRenamed("__place", "place")


def output_check(planned: DataFrame, outputs: DataFrame, *, key: str = "output_id") -> DataFrame:
    """Each planned or delivered id with its errors: missing, unplanned, no provider."""
    p, o = planned.select(key).withColumn("planned", F.lit(True)), outputs.select(key, "provider").withColumn("delivered", F.lit(True))
    both = p.join(o, key, "full_outer")
    return quality_errors(both, [("missing_output", "delivered IS NULL"), ("unplanned_output", "planned IS NULL"), ("provider_missing", "delivered AND coalesce(trim(provider), '') = ''")]).select(key, "errors", "status")


def compact_spec(packages: DataFrame) -> DataFrame:
    """Names, at most 5 actions and 8 objects, and the first 3 sentences."""
    return packages.select("scene_id", unique_limit(F.col("names"), 6).alias("names"), F.slice("moments", 1, 5).alias("actions"), unique_limit(F.col("objects"), 8).alias("objects"), F.slice(sentences(F.col("text"), 1), 1, 3).alias("opening"))


def pick_prompt(packages: DataFrame, mode: str) -> DataFrame:
    """scene_id, prompt, reason: the image prompt, or the first clip, else the first shot; a reason where there is none."""
    first = F.try_element_at("clips", F.lit(1))["prompt"]
    prompt = F.col("image_prompt") if mode == "image" else F.coalesce(first, F.try_element_at("shots", F.lit(1))["focus"])
    return packages.select("scene_id", prompt.alias("prompt"), F.when(prompt.isNull(), F.concat(F.lit(mode), F.lit("_plan_unavailable"))).alias("reason"))
