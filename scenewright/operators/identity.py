"""From entity candidates to canonical characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import base_name, base_of, dash_norm, name_norm, plain_words, quoted

_TITLE = rf"^(?i)(?:{'|'.join(L.PERSON_TITLES)})\.?"
_VERBS = "|".join([*L.SPEECH_VERBS, "rejoined", "called"])
SPEECH = rf"(?i)\b(?:{_VERBS}|continued|added)\b"
PRONOUN_ACTION = r"(?i)\b(?:he|she|his|her)\s+(?:said|replied|asked|cried|shouted|looked|turned|stood|sat|walked|ran|came|went|took|gave|held|put|made)\b"
PRONOUN = r"(?i)\b(?:he|she|him|her|his|hers|himself|herself)\b"
HUMAN_ACTION = r"(?i)\b(?:entered|left|went|came|looked|saw|heard|spoke|said|asked|replied|answered|walked|ran|stood|sat|turned|smiled|laughed|wept|shouted|cried|took|gave|held|carried|followed|returned|arrived|departed|climbed|descended|examined|opened|closed)\b"
DIALOGUE = r"(?i)\b(?:said|asked|replied|answered|cried|shouted|whispered|exclaimed|remarked|observed|continued|added|returned)\b"
CUED_TITLES = r"(?:Mr\.?|Mrs\.?|Ms\.?|Miss|Dr\.?|Professor|Prof\.?|Captain|Capt\.?|Sir|Colonel|Major|Lieutenant)"


def reasons(*rules: tuple[Column, str]) -> Column:
    """The names of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in rules]))


def points(start: float, *rules: tuple[Column, float]) -> Column:
    score = F.lit(start)
    for condition, worth in rules:
        score = score + F.when(condition, F.lit(worth)).otherwise(0.0)
    return score


def unit(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def other_types(entities: DataFrame) -> DataFrame:
    """entities with other_types: what else a name of the same spelling was taken for."""
    same = Window.partitionBy("document_id", F.lower(dash_norm(F.col("canonical_name"))))
    types = entities.withColumn("__types", F.collect_set("entity_type").over(same))
    return types.withColumn("other_types", F.array_sort(F.array_except("__types", F.array("entity_type")))).drop("__types")


_WORD = r"[\p{L}\p{Nd}_]"
#: A direct sign of a person, in lower-case text where the sign stands for the name.
_SIGN = "\u0001"
DIRECT = rf"(?u)(?:\b(?:{_VERBS})\s+{_SIGN}(?!{_WORD})|(?<!{_WORD}){_SIGN}\s+(?:{_VERBS})\b|(?i:\b{CUED_TITLES})\s+{_SIGN}(?!{_WORD}))"


def _led(words: list[str]) -> str:
    """Words as alternatives, those of one first letter together."""
    heads = sorted({w[0] for w in words})
    return "|".join(f"{h}(?:{'|'.join(w[1:] for w in words if w[0] == h)})" for h in heads)


#: Without this in its lower-case text, no context of it holds speech, a pronoun acting or a direct sign of a person, wherever it is cut.
ANY_SIGN = rf"(?:{_led([*_VERBS.split('|'), 'continued', 'added'])})|{PRONOUN_ACTION.removeprefix('(?i)').replace(chr(92) + 'b', '')}|(?i:{CUED_TITLES})\s"
#: The same by a first letter that few places have, so that boundaries are looked at there alone.
QUICK = {PRONOUN: r"(?i)[hs](?<=\b.)(?:(?<=h)(?:e|im|ers?|is|imself|erself)|(?<=s)he)\b"}
#: The longest word of the patterns that `within` takes, and a sign more.
_EDGE = 20


def text_signs(text: Column) -> dict[str, Column]:
    """What `mention_features` and `classify_evidence` may know of a mention's whole text: a pattern that its text does not hold need not be looked for in contexts, which overlap and are many times the text."""
    return {"may_show": F.lower(text).rlike(ANY_SIGN), "has_dialogue": text.rlike(DIALOGUE), "has_action": text.rlike(HUMAN_ACTION), "has_pronoun": text.rlike(QUICK[PRONOUN])}


def within(context: Column, pattern: str, whole: Column) -> Column:
    """context.rlike(pattern), for words between boundaries, where `whole` says whether its text holds the pattern.

    If it does not, a cut may still have made a word: one that begins or ends the context.
    """
    words = pattern.removeprefix(r"(?i)\b").removesuffix(r"\b")
    pattern = QUICK.get(pattern, pattern)
    edge = F.substring(context, 1, _EDGE).rlike(rf"(?i)^{words}\b") | F.right(context, F.lit(_EDGE)).rlike(rf"(?i)\b{words}\z")
    # a mark without its letter is no part of a word
    return F.when(whole | F.substring(context, 1, 1).rlike(r"\p{M}"), context.rlike(pattern)).otherwise(edge)


def mention_features(entities: DataFrame, mentions: DataFrame) -> DataFrame:
    """Counts per entity: mentions, scenes, contexts with the name, speech, a pronoun acting, and a direct sign of a person.

    Mentions that have a canonical_name are taken to have their entity's; others get it by entity_id.
    Mentions with may_show (`text_signs`) are looked through only where it holds.
    """
    may = F.col("may_show") if "may_show" in mentions.columns else F.lit(True)
    named = mentions if "canonical_name" in mentions.columns else mentions.join(entities.select("entity_id", "canonical_name"), "entity_id")
    named = named.select("entity_id", "scene_id", "context", may.alias("__may"), F.lower("context").alias("__low"), F.lower(dash_norm(F.col("canonical_name"))).alias("__name"))
    has = F.contains("__low", "__name")
    # the name is put as one sign first, so that one pattern serves all rows
    direct = F.replace("__low", F.col("__name"), F.lit(_SIGN)).rlike(DIRECT)
    counts = named.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("mentions"), F.count_distinct("scene_id").alias("scenes"), F.count_if(has).alias("exact"),
        F.count_if(F.col("__may") & F.col("context").rlike(SPEECH)).alias("speech"), F.count_if(F.col("__may") & F.col("context").rlike(PRONOUN_ACTION)).alias("action"),
        F.count_if(F.col("__may") & has & direct).alias("direct"),
    )
    out = entities.join(counts, "entity_id", "left")
    return out.fillna(0, ["mentions", "scenes", "exact", "speech", "action", "direct"])


def candidate_gate(entities: DataFrame, mentions: DataFrame, *, common: list[str] | None = None, roles: list[str] | None = None) -> DataFrame:
    """entity_id, decision (validated, probable, review, non_character), score, reasons for every entity."""
    common, roles = common or L.COMMON_WORDS, roles or L.ROLE_WORDS
    df = mention_features(other_types(entities), mentions).withColumn("__n", dash_norm(F.col("canonical_name")))
    n, low = F.col("__n"), F.lower("__n")
    words = F.split(F.replace(n, F.lit("-"), F.lit(" ")), r"\s+")
    bare = F.transform(F.filter(words, lambda w: ~F.lower(w).isin(L.PERSON_TITLES)), lambda w: F.btrim(w, F.lit(".")))
    df = df.withColumn("__bare", F.filter(bare, lambda w: w != "")).withColumn("__title", n.rlike(_TITLE + r"\s+"))
    bare, title, size = F.col("__bare"), F.col("__title"), F.size("__bare")
    has_common = F.exists(bare, lambda w: F.lower(w).isin(common))
    clash, direct = F.arrays_overlap("other_types", F.array(F.lit("location"), F.lit("environment"))), F.col("direct") > 0
    one_word, untitled = (size == 1) & ~title & ~direct, (size >= 2) & ~title & ~direct & (F.col("exact") < 3)
    score = points(
        0.25, (title, 0.25), (size >= 2, 0.15), (F.col("exact") >= 2, 0.15), (F.col("mentions") >= 3, 0.10), (F.col("scenes") >= 2, 0.10),
        (direct, 0.25), (F.col("speech") > 0, 0.05), (F.col("action") > 0, 0.05), (has_common, -0.45),
    )
    score = F.when(one_word, F.least(score, F.lit(0.44))).otherwise(score)
    score = F.round(unit(F.when(untitled, F.least(score, F.lit(0.47))).otherwise(score)), 6)
    why = reasons(
        (clash, "name_also_classified_as_location_or_environment"), (title, "personal_title"), (size >= 2, "multiword_person_name"),
        (F.col("exact") >= 2, "name_repeated_in_context"), (F.col("mentions") >= 3, "recurring_mentions"), (F.col("scenes") >= 2, "multi_scene_presence"),
        (direct, "direct_person_reference"), (F.col("speech") > 0, "speech_context"), (F.col("action") > 0, "character_action_context"),
        (has_common, "stopword_name_component"), (one_word, "single_word_without_direct_person_reference"), (untitled, "untitled_name_without_repeated_direct_evidence"),
    )
    early = [
        (F.col("entity_type") != "character", "non_character", 1.0, "upstream_type_not_character"),
        (n.rlike(_TITLE + "$"), "non_character", 1.0, "title_only"),
        (low.isin(common) | low.isin(L.DEMOGRAPHIC_WORDS), "non_character", 1.0, "common_word_or_demographic_term"),
        (F.btrim("canonical_name").rlike("[-‐‑‒–—]$"), "review", 0.4, "line_break_fragment"),
        ((F.length(n) < 3) | (F.length(n) > 45), "review", 0.9, "name_length_anomaly"),
        (~F.forall(bare, lambda w: w.rlike(r"^[A-Z][A-Za-z'’-]+$")), "review", 0.65, "non_name_token"),
        (~title & F.exists(bare, lambda w: F.regexp_replace(F.lower(w), r"\.+$", "").isin(roles)), "non_character", 0.95, "generic_non_person_name_pattern"),
        (clash & ~direct, "non_character", 1.0, "ambiguous_name_without_person_evidence"),
        (title & (size == 1) & has_common & ~direct, "review", 0.35, "title_with_stopword_name_without_direct_person_reference"),
    ]
    left = F.struct(F.when(score >= 0.75, "validated").when(score >= 0.48, "probable").otherwise("review").alias("decision"), score.alias("score"), why.alias("reasons"))
    out = left
    for condition, decision, fixed, reason in reversed(early):
        out = F.when(condition, F.struct(F.lit(decision).alias("decision"), F.lit(fixed).alias("score"), F.array(F.lit(reason)).alias("reasons"))).otherwise(out)
    return df.withColumn("__g", out).select("document_id", "entity_id", "entity_type", "canonical_name", F.col("__n").alias("normalized_name"), "__g.decision", "__g.score", "__g.reasons")


def classify_evidence(entities: DataFrame, mentions: DataFrame) -> DataFrame:
    """entity_id, label (validated, probable, uncertain, reference, non_character), score, evidence, reasons.

    Mentions that have a canonical_name are taken to have their entity's; those with the columns of `text_signs` are looked
    through only where these hold.
    """
    clean = F.btrim(F.regexp_replace(F.translate("canonical_name", "‐‑–—", "----"), r"\s+", " "), F.lit(" ,.;:\"'"))
    named = entities.withColumn("__n", clean)
    said = mentions.withColumn("__n", clean) if "canonical_name" in mentions.columns else mentions.join(named.select("entity_id", "__n"), "entity_id")
    said = said.withColumn("__flat", F.regexp_replace("context", r"\s+", " ")).withColumns({"__low": F.lower("__flat"), "__low_n": F.lower("__n")})
    # the name is put as one sign, so that one pattern serves all rows. Where case is more than capitals and small letters, or
    # hits may overlap, a miss is asked again of a pattern of the name's own
    plain = ~F.col("__flat").rlike(rf"[{_SIGN}\u0130\u0131\u017f]")
    found = F.replace("__low", F.col("__low_n"), F.lit(_SIGN)).rlike(rf"(?U){_SIGN}(?<![\w{_SIGN}]{_SIGN})(?![\w{_SIGN}])")
    whole = F.regexp_like("__flat", F.concat(F.lit(r"(?iU)(?<!\w)"), quoted(F.regexp_replace("__n", "[.,;:]+$", "")), F.lit(r"(?!\w)")))
    judged = F.when(plain & F.col("__n").rlike("^[A-Za-zÀ-ÖØ-öø-ÿ]+$"), found).when(plain & (F.col("__n") != "") & found, True).otherwise(whole)
    said = said.withColumn("__hit", F.contains("__low", "__low_n") & judged)
    order = [c for c in ("page_start", "scene_id") if c in mentions.columns]
    shown = F.transform(F.slice(F.array_sort(F.collect_list(F.when(F.col("__hit"), F.struct(*order, F.substring("context", 1, 500).alias("c"))))), 1, 3), lambda x: x["c"])
    has = lambda name: F.col(name) if name in mentions.columns else F.lit(True)
    hit = lambda p, name: F.count_if(F.col("__hit") & within(F.col("context"), p, has(name)))
    counts = said.groupBy("entity_id").agg(F.count(F.lit(1)).alias("m"), F.count_distinct("scene_id").alias("s"), F.count_if("__hit").alias("hits"), hit(DIALOGUE, "has_dialogue").alias("d"), hit(HUMAN_ACTION, "has_action").alias("a"), hit(PRONOUN, "has_pronoun").alias("p"), shown.alias("evidence"))
    df = named.join(counts, "entity_id", "left").fillna(0, ["m", "s", "hits", "d", "a", "p"])
    n, low = F.col("__n"), F.lower("__n")
    title, shape, fragment = n.rlike(rf"(?i)\b(?:{'|'.join(L.PERSON_TITLES)})\.?\b"), F.size(F.split(n, r"\s+")).isin(2, 3), n.rlike("[-‐‑‒–—]$")
    score = points(0.0, (title, 0.25), (shape, 0.08), (F.col("m") >= 10, 0.12), (F.col("m").between(3, 9), 0.07), (F.col("m") == 1, -0.08), (F.col("s") >= 5, 0.08), (fragment, -0.30))
    score = score + F.least(F.lit(0.30), F.col("d") * 0.10) + F.least(F.lit(0.18), F.col("a") * 0.03) + F.least(F.lit(0.08), F.col("p") * 0.015)
    score = F.round(unit(score), 6)
    why = reasons(
        (title, "personal_title"), (shape, "person_name_shape"), (F.col("d") > 0, "dialogue_context_near_entity"), (F.col("a") > 0, "human_action_context_near_entity"),
        (F.col("p") > 0, "human_pronoun_context"), (F.col("m") >= 10, "strong_recurring_mentions"), (F.col("m").between(3, 9), "recurring_mentions"),
        (F.col("m") == 1, "single_mention"), (F.col("s") >= 5, "multi_scene_presence"), (fragment, "line_break_fragment"),
    )
    none = F.array().cast("array<string>")
    cases = [
        (F.col("entity_type").isin("location", "environment", "organization", "object", "event"), "non_character", 0.99, F.concat(F.lit("upstream_"), "entity_type", F.lit("_type"))),
        (low.isin(L.NON_NAMES), "reference", 0.99, F.lit("common_word_or_title_only")),
        (low.isin(L.PLACE_NAMES) | n.rlike(rf"(?i)\b(?:{'|'.join(L.INSTITUTION_WORDS)})\b"), "non_character", 0.98, F.lit("place_institution_or_publication_signal")),
        (F.length(n) > 45, "reference", 0.95, F.lit("unusually_long_entity_name")),
        (F.col("hits") == 0, "reference", 0.90, F.lit("no_exact_name_in_mention_context")),
    ]
    label, value, told, kept = F.when(score >= 0.70, "validated").when(score >= 0.45, "probable").when(score >= 0.20, "uncertain").otherwise("reference"), score, why, F.coalesce("evidence", none)
    for condition, fixed, worth, reason in reversed(cases):  # each column by itself, so that evidence is gathered only where it is asked for
        label, value, told, kept = F.when(condition, fixed).otherwise(label), F.when(condition, worth).otherwise(value), F.when(condition, F.array(reason)).otherwise(told), F.when(condition, none).otherwise(kept)
    return df.select("document_id", "entity_id", F.col("m").alias("mention_count"), F.col("s").alias("scene_count"), label.alias("label"), value.alias("score"), kept.alias("evidence"), told.alias("reasons"))


def validate_visual_entities(entities: DataFrame, institutions: list[str] | None = None, references: tuple[str, ...] = ()) -> DataFrame:
    """entity_id, visual_type, decision, score, reasons from an entity's type, name, mention_count and profile_text."""
    n = dash_norm(F.col("canonical_name"))
    low, size = F.lower(n), F.size(F.split(n, r"\s+"))
    rules = [
        (F.col("entity_type") == "character", 0.45, "upstream_character_type"), (n.rlike(_TITLE + r"\s+"), 0.20, "personal_title"), (size.isin(2, 3), 0.10, "person_name_shape"),
        (F.col("mention_count") >= 3, 0.10, "recurring_mentions"), (F.col("mention_count") == 1, -0.05, "single_mention"),
        (low.rlike(L.any_of(institutions or [*L.INSTITUTION_WORDS, "times", "news", "station", "river", "mountain", "island", "ocean", "sea", "valley", "village", "hotel", "street", "road", "church", "expedition", "thousand", "hundred"])), -0.75, "institution_publication_or_place_term"),
        (low.isin(list(references)) if references else F.lit(False), -0.30, "known_reference_only_name"), (F.length(n) > 45, -0.35, "unusually_long_name"),
        (F.length(F.coalesce("profile_text", F.lit(""))) > 1500, -0.10, "oversized_upstream_profile_evidence"),
        (n.rlike(r"(?:[-‐‑‒–—]|\s)[A-Za-z]{1,3}$|^[A-Za-z]{1,3}[-‐‑‒–—]$") & (F.length(n) < 8), -0.50, "likely_ocr_fragment"),
    ]
    place, other = F.col("entity_type").isin("location", "environment"), F.col("entity_type").isin("organization", "object", "event")
    score = F.when(place | other, 0.0).otherwise(F.round(unit(points(0.0, *[(c, w) for c, w, _ in rules])), 6))
    kind = F.when(place, "environment").when(other, "reference").when(score >= 0.60, "character").when(score >= 0.35, "character_candidate").otherwise("reference")
    why = F.when(place, F.array(F.lit("upstream_location_or_environment_type"))).when(other, F.array(F.concat(F.lit("upstream_"), "entity_type", F.lit("_type")))).otherwise(reasons(*[(c, r) for c, _, r in rules]))
    return entities.select("document_id", "entity_id", kind.alias("visual_type"), F.when(kind == "character", "validated").when(kind == "character_candidate", "review").otherwise("excluded").alias("decision"), n.alias("canonical_name"), score.alias("score"), why.alias("reasons"))


def _prefix(short: Column, long: Column) -> Column:
    extra = F.slice(long, F.size(short) + 1, F.greatest(F.size(long) - F.size(short), F.lit(0)))
    fits = (F.size(short) >= 2) & (F.size(long) > F.size(short)) & short[0].isin(L.PERSON_TITLES) & (F.slice(long, 1, F.size(short)) == short)
    return fits & ((F.size(extra) == 1) | ((F.size(extra) == 2) & F.element_at(long, -1).isin(L.QUALIFIERS)))


def compatible(a: Column, b: Column) -> Column:
    """Struct (ok, confidence, method): whether two names may be one person's."""
    return _compatible(name_norm(a), name_norm(b), base_name(a), base_name(b))


def _compatible(na: Column, nb: Column, ba: Column, bb: Column) -> Column:
    ta, tb = F.split(ba, " "), F.split(bb, " ")
    fa, fb = (F.split(F.btrim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " ")), " ") for x in (na, nb))
    blocked = lambda base, t: (base == "") | F.arrays_overlap(t, F.array(*[F.lit(w) for w in L.SEMANTIC_BLOCK_WORDS]))
    two, same_last = (F.size(ta) >= 2) & (F.size(tb) >= 2), F.element_at(ta, -1) == F.element_at(tb, -1)
    verdict = lambda ok, c, m: F.struct(F.lit(ok).alias("ok"), F.lit(c).alias("confidence"), F.lit(m).alias("method"))
    return (
        F.when(na.rlike("[-‐‑‒–—]$") | nb.rlike("[-‐‑‒–—]$"), verdict(False, 0.0, "ocr_fragment"))
        .when(blocked(ba, ta) | blocked(bb, tb), verdict(False, 0.0, "semantic_non_person_block"))
        .when(ba == bb, verdict(True, 0.98, "normalized_exact"))
        .when(two & same_last & (F.size(ta) == 2) & (F.size(tb) == 2) & (F.substring(ta[0], 1, 1) == F.substring(tb[0], 1, 1)), verdict(True, 0.86, "same_surname_initial_variant"))
        .when(two & same_last, verdict(False, 0.0, "same_surname_but_different_given_name"))
        .when(((F.size(ta) == 1) & (F.size(tb) >= 2) & (ta[0] == F.element_at(tb, -1))) | ((F.size(tb) == 1) & (F.size(ta) >= 2) & (tb[0] == F.element_at(ta, -1))), verdict(True, 0.82, "surname_variant"))
        .when(_prefix(fa, fb) | _prefix(fb, fa), verdict(True, 0.88, "qualified_identity_variant"))
        .otherwise(verdict(False, 0.0, "no_safe_identity_match"))
    )


def name_classes(gated: DataFrame) -> DataFrame:
    """(document_id, entity_id, kind, key, side): the classes by which names fit, a few rows a name.

    Two names fit exactly if they share a class (kind, key) and are on different sides of it or
    both on side 'any': equal base names; two-part names of one surname and initial; a single
    part and the longer names that end in it; a titled name and its qualified forms, which
    continue it by one word, or by two that end in a qualifier. A qualified form whose own
    surname is that of the shorter name is kept apart (another given name), which is why the key says
    whether the shorter base name has two parts. Names that fit nothing have no class.
    """
    return _classes(_spelled(gated.select("document_id", "entity_id", "canonical_name")))


def _spelled(names: DataFrame) -> DataFrame:
    """names with the forms of canonical_name that comparisons ask for: norm, base, and words, its titles among them.

    They are worth writing down: an expression over them would work each out again wherever it names it.
    """
    rows = names.withColumn("norm", name_norm(F.col("canonical_name")))
    return rows.withColumns({"base": base_of(F.col("norm")), "words": plain_words(F.col("norm"))})


def _is_person() -> Column:
    """Whether a name, by its norm and base, may be compared at all; then it fits itself."""
    return ~F.col("norm").rlike("[-‐‑‒–—]$") & (F.col("base") != "") & ~F.arrays_overlap(F.split("base", " "), F.array(*[F.lit(w) for w in L.SEMANTIC_BLOCK_WORDS]))


def _classes(spelled: DataFrame) -> DataFrame:
    """name_classes of names with their norm, base and words."""
    rows = spelled.filter(_is_person()).select("document_id", "entity_id", "base", F.split("base", " ").alias("t"), F.split("words", " ").alias("f"))
    parts, long, last = F.size("t"), F.size("f"), F.element_at("t", -1)
    row = lambda kind, key, side: F.struct(F.lit(kind).alias("kind"), key.alias("key"), F.lit(side).alias("side"))

    def prefixes(drop: int) -> list[Column]:
        """Classes of the names that this one may continue by `drop` words."""
        head = F.slice("f", 1, F.greatest(long - drop, F.lit(0)))
        fits = (long - drop >= 2) & F.col("f")[0].isin(L.PERSON_TITLES)
        if drop == 2:
            fits = fits & F.element_at("f", -1).isin(L.QUALIFIERS)
        apart = (parts >= 2) & (F.element_at("f", -1) == F.try_element_at("f", F.greatest(long - drop, F.lit(1))))
        key = lambda two: F.concat(F.array_join(head, " "), F.lit(two))
        return [F.when(fits, row("qualified", key("|1"), "long")), F.when(fits & ~apart, row("qualified", key("|2"), "long"))]

    found = [
        row("base", F.col("base"), "any"),
        F.when(parts == 2, row("initial", F.concat_ws(" ", F.substring(F.col("t")[0], 1, 1), last), "any")),
        F.when(parts >= 2, row("surname", last, "long")).otherwise(row("surname", last, "short")),
        F.when((long >= 2) & F.col("f")[0].isin(L.PERSON_TITLES), row("qualified", F.concat(F.array_join("f", " "), F.when(parts >= 2, "|2").otherwise("|1")), "short")),
        *prefixes(1), *prefixes(2),
    ]
    classes = F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull()))
    return rows.select("document_id", "entity_id", F.explode(classes).alias("c")).select("document_id", "entity_id", "c.*")


def compatible_pairs(gated: DataFrame) -> DataFrame:
    """(document_id, a, b, confidence, method) of all pairs a < b of entities whose names fit.

    Names meet by their classes, in which all that meet fit, so the work is that of the result;
    `identity_groups` does without pairs.
    """
    classes = name_classes(gated)
    left, right = classes.alias("l"), classes.alias("r")
    sides = (F.col("l.side") == "any") | (F.col("l.side") != F.col("r.side"))
    met = left.join(right, (F.col("l.document_id") == F.col("r.document_id")) & (F.col("l.kind") == F.col("r.kind")) & (F.col("l.key") == F.col("r.key")) & sides & (F.col("l.entity_id") < F.col("r.entity_id")))
    pairs = met.select(F.col("l.document_id").alias("document_id"), F.col("l.entity_id").alias("a"), F.col("r.entity_id").alias("b")).distinct()
    return judged(pairs, _spelled(gated.select("entity_id", "canonical_name")))


def judged(pairs: DataFrame, spelled: DataFrame) -> DataFrame:
    """pairs (document_id, a, b) that fit, with confidence and method; spelled: names with their norm and base."""
    one, two = (spelled.select(F.col("entity_id").alias(k), F.col("norm").alias(f"n{k}"), F.col("base").alias(f"b{k}")) for k in "ab")
    tried = pairs.join(one, "a").join(two, "b").withColumn("c", _compatible(F.col("nb"), F.col("na"), F.col("bb"), F.col("ba")))
    return tried.filter("c.ok").select("document_id", "a", "b", "c.confidence", "c.method")


def identity_groups(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, members) of gated characters: each entity joins the first group, by id, whose root it fits, else it starts one.

    Entities of one name fit whatever the first of them fits, so only the first of a name is
    looked at. Roots are the maximal independent set that a loop by id would find. They are found in
    rounds over the classes of the names, not over pairs: each class keeps, for either side, its
    least open and its least root member. An open entity with a smaller root opposite it is no
    root; one that has no smaller open entity opposite it in any class, nor a smaller root, is one.
    A round is two groupings of a few rows a name, however many share a surname, and class
    members are never paired. A class settles in two rounds or three; rounds add up only along
    names that are linked through different classes with falling ids.
    """
    kept = gated.filter("entity_type = 'character' AND decision IN ('validated', 'probable')").select("document_id", "entity_id", "canonical_name")
    kept = _cut(_spelled(kept))
    firsts = kept.groupBy("document_id", "norm").agg(F.min("entity_id").alias("first"))
    kept = kept.join(firsts, ["document_id", "norm"])
    kept = _cut(kept.withColumn("same_as", F.when(_is_person(), F.col("first")).otherwise(F.col("entity_id"))).drop("first"))
    alone = kept.filter("entity_id = same_as")
    classes = _cut(_classes(alone))
    crowded = classes.groupBy("document_id", "kind", "key").agg(F.count(F.lit(1)).alias("n"), F.min("side").alias("lo"), F.max("side").alias("hi")).filter("n > 1 AND (lo = 'any' OR lo <> hi)")
    classes = _cut(classes.join(crowded.select("document_id", "kind", "key"), ["document_id", "kind", "key"]))
    state = _cut(classes.select("entity_id").distinct().withColumn("root", F.lit(None).cast("boolean")))
    while not state.filter("root IS NULL").isEmpty():
        live = classes.join(state.filter("root IS NULL OR root").withColumn("is_root", F.coalesce("root", F.lit(False))).select("entity_id", "is_root"), "entity_id")
        least = live.groupBy("document_id", "kind", "key", "side").agg(F.min(F.when(F.col("is_root"), F.col("entity_id"))).alias("first_root"), F.min(F.when(~F.col("is_root"), F.col("entity_id"))).alias("first_open"))
        facing = least.withColumn("side", F.when(F.col("side") == "long", "short").when(F.col("side") == "short", "long").otherwise("any"))
        asked = classes.join(state.filter("root IS NULL").select("entity_id"), "entity_id").join(facing, ["document_id", "kind", "key", "side"], "left")
        seen = asked.groupBy("entity_id").agg(F.min("first_root").alias("r"), F.min("first_open").alias("o"))
        verdict = F.when(F.col("r") < F.col("entity_id"), False).when(F.coalesce(F.col("o") >= F.col("entity_id"), F.lit(True)), True)
        settled = seen.select("entity_id", verdict.alias("now"))
        before, state = state, _cut(state.join(settled, "entity_id", "left").select("entity_id", F.coalesce("root", "now").alias("root")))
        before.unpersist()
    roots = classes.join(state.filter("root").select("entity_id"), "entity_id").groupBy("document_id", "kind", "key", "side").agg(F.min("entity_id").alias("a"))
    facing = roots.withColumn("side", F.when(F.col("side") == "long", "short").when(F.col("side") == "short", "long").otherwise("any"))
    joined = classes.join(state.filter("NOT root").select("entity_id"), "entity_id").join(facing, ["document_id", "kind", "key", "side"])
    chosen = joined.groupBy("document_id", F.col("entity_id").alias("b")).agg(F.min("a").alias("a"))
    best = judged(chosen, alone).select(F.col("b").alias("same_as"), F.struct("a", "confidence", "method").alias("f"))
    met = kept.join(best, "same_as", "left")
    own = F.col("entity_id") == F.col("same_as")
    members = met.select(
        "document_id", F.coalesce("f.a", "same_as").alias("group_id"), "entity_id",
        F.when(F.col("f").isNotNull(), F.col("f.confidence")).when(own, 1.0).otherwise(0.98).alias("confidence"),
        F.when(F.col("f").isNotNull(), F.col("f.method")).when(own, "canonical").otherwise("normalized_exact").alias("match_method"), F.col("norm").alias("variant_name"),
    )
    members = _cut(members)  # groups, their evidence and the characters all start from them
    groups = members.groupBy("document_id", "group_id").agg(F.min("confidence").alias("confidence"), F.max_by("variant_name", F.col("match_method") == "canonical").alias("canonical_name"), F.array_sort(F.collect_list("entity_id")).alias("member_ids"))
    groups = groups.withColumn("method", F.when(F.size("member_ids") == 1, "single_candidate").otherwise("conservative_identity_alias"))
    return groups, members


def _cut(df: DataFrame) -> DataFrame:
    """df computed once: in the shared checkpoint folder, where the session names one."""
    return df.checkpoint() if df.sparkSession.sparkContext.getConf().get("spark.checkpoint.dir") else df.persist()


ACCEPTED = ["normalized_exact", "same_full_name_variant", "surname_variant", "same_surname_initial_variant"]


def identity_evidence(groups: DataFrame, members: DataFrame, *, strict: bool = False) -> DataFrame:
    """group_id, relationship, confidence of groups of several members.

    The root is exempt from the accepted methods, and the qualifier method is accepted;
    strict=True keeps the original rule, in which the root's own mark blocks every group.
    """
    bare = F.regexp_replace("variant_name", _TITLE + r"\s+", "")
    fragment = F.col("variant_name").endswith("-") | ((F.size(F.split(bare, r"\s+")) == 1) & (F.length("variant_name") <= 4))
    fits = F.col("match_method").isin(ACCEPTED if strict else [*ACCEPTED, "qualified_identity_variant", "canonical"])
    found = members.groupBy("document_id", "group_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or(fragment).alias("fragment"), F.bool_and(fits).alias("fits"), F.min("confidence").alias("least"), F.array_sort(F.collect_list("variant_name")).alias("evidence")).filter("n > 1")
    kind = F.when(F.col("fragment"), "ocr_fragment").when(F.col("fits"), "identity_alias").otherwise("unresolved")
    return found.select("document_id", "group_id", kind.alias("relationship"), F.when(F.col("fragment"), 0.99).when(F.col("fits"), F.col("least")).otherwise(0.0).alias("confidence"), "evidence")


def resolve_groups(groups: DataFrame, members: DataFrame, *, method: str = "evidence", evidence: DataFrame | None = None, mentions: DataFrame | None = None) -> DataFrame:
    """group_id, relationship (confirmed_alias, likely_alias, ocr_fragment, unresolved), confidence of every group."""
    if method == "evidence":
        top = (evidence if evidence is not None else identity_evidence(groups, members)).select("group_id", "relationship", F.col("confidence").alias("c"))
        kind = F.when(F.col("relationship") == "identity_alias", "confirmed_alias").otherwise("unresolved")
        return groups.select("document_id", "group_id").join(top, "group_id", "left").select("document_id", "group_id", kind.alias("relationship"), F.when(F.col("relationship") == "identity_alias", F.col("c")).otherwise(0.0).alias("confidence"))
    if mentions is None:
        raise ValueError("scene_overlap needs mentions")
    seen = mentions.groupBy("entity_id").agg(F.collect_set("scene_id").alias("scenes"))
    each = members.join(seen, "entity_id", "left").withColumn("base", base_name(F.col("variant_name"))).withColumn("scenes", F.coalesce("scenes", F.array().cast(seen.schema["scenes"].dataType)))
    held = each.groupBy("document_id", "group_id").agg(F.bool_or(F.col("variant_name").rlike("[-‐‑‒–—]$")).alias("fragment"), F.array_sort(F.collect_set("base")).alias("bases"), F.count(F.lit(1)).alias("n"), F.collect_list("scenes").alias("sets")).filter("n > 1")
    a, b = F.split(F.col("bases")[0], " "), F.split(F.try_element_at("bases", F.lit(2)), " ")
    surname = (F.size("bases") == 2) & (F.col("n") == 2) & (((F.size(a) == 1) & (F.size(b) >= 2) & (a[0] == F.element_at(b, -1))) | ((F.size(b) == 1) & (F.size(a) >= 2) & (b[0] == F.element_at(a, -1))))
    overlap = F.size(F.aggregate("sets", F.col("sets")[0], F.array_intersect)) > 0
    kind = F.when(F.col("fragment"), "ocr_fragment").when(F.size("bases") == 1, "confirmed_alias").when(surname & overlap, "likely_alias").otherwise("unresolved")
    return held.select("document_id", "group_id", kind.alias("relationship")).withColumn("confidence", F.when(F.col("relationship").isin("ocr_fragment", "confirmed_alias"), 0.99).when(F.col("relationship") == "likely_alias", 0.88).otherwise(0.0))


def canonical_characters(groups: DataFrame, members: DataFrame, resolution: DataFrame, gate: DataFrame) -> DataFrame:
    """group_id, status (confirmed, likely, singleton), canonical_name, confidence, canonical_entity_id; other groups are excluded."""
    judged = members.join(gate.select("entity_id", "decision", "score"), "entity_id", "left")
    valid = F.when(F.col("decision") == "validated", F.struct("entity_id", "variant_name", "score"))
    held = judged.groupBy("document_id", "group_id").agg(F.count(F.lit(1)).alias("n"), F.min(valid).alias("v"), F.bool_or(F.coalesce(F.col("decision").isin("validated", "probable"), F.lit(False))).alias("eligible"))
    df = groups.join(held, ["document_id", "group_id"]).join(resolution.select("group_id", "relationship", F.col("confidence").alias("rc")), "group_id", "left").fillna({"relationship": "unresolved", "rc": 0.0})
    status = F.when((F.col("relationship") == "confirmed_alias") & F.col("eligible"), "confirmed").when((F.col("relationship") == "likely_alias") & F.col("eligible"), "likely").when(F.col("v").isNotNull(), "confirmed").when((F.col("n") == 1) & F.col("eligible"), "singleton")
    by_alias = F.col("relationship").isin("confirmed_alias", "likely_alias") & F.col("eligible")
    name = F.when(by_alias | F.col("v").isNull(), F.col("canonical_name")).otherwise(F.col("v.variant_name"))
    conf = F.least("confidence", F.when(F.col("relationship") != "unresolved", F.greatest("rc", F.lit(0.5))).otherwise(F.col("confidence")))
    conf = F.when(F.col("v").isNotNull(), F.greatest(conf, F.col("v.score"))).otherwise(conf)
    return df.withColumn("status", status).filter("status IS NOT NULL").select("document_id", "group_id", "status", name.alias("canonical_name"), conf.alias("confidence"), F.coalesce("v.entity_id", "group_id").alias("canonical_entity_id"))


def canonical_aliases(characters: DataFrame, members: DataFrame) -> DataFrame:
    """Each member of a canonical character: canonical, alias (confirmed or likely characters) or variant."""
    m = members.select("group_id", "entity_id", F.col("variant_name").alias("alias"), F.col("confidence").alias("c"))
    kind = F.when(F.col("entity_id") == F.col("canonical_entity_id"), "canonical").when(F.col("status").isin("confirmed", "likely"), "alias").otherwise("variant")
    return characters.join(m, "group_id").select("document_id", "group_id", "entity_id", "alias", kind.alias("relationship"), F.col("c").alias("confidence"))
