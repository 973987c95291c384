"""Column functions on text. Nulls stay null unless a function says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons

DASHES = "‐‑‒–—"
TRIM = " ,.;:\"'"
PAGE_NUMBER = r"^(?i)(?:\d{1,4}|[ivxlcdm]{1,8})$"


def squeezed(c: Column) -> Column:
    """White space runs as one space, trimmed."""
    return F.btrim(F.regexp_replace(c, r"\s+", " "))


def trimmed_items(items: Column) -> Column:
    """Each item trimmed. (transform() hands a function of two arguments the place too, which btrim would take for the signs to cut off.)"""
    return F.transform(items, lambda x: F.btrim(x))


def rebuild_paragraphs(c: Column, para_sep: str = "\n\n") -> Column:
    """Lines joined by a space, paragraphs by para_sep; blank lines end a paragraph; a page number that opens one is dropped."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def add(state: Column, line: Column) -> Column:
        text = F.btrim(line)
        ended = F.when(state["now"] == "", state["done"]).otherwise(F.concat(state["done"], F.array(state["now"])))
        return (
            F.when(text == "", F.struct(ended.alias("done"), F.lit("").alias("now")))
            .when((state["now"] == "") & text.rlike(PAGE_NUMBER), state)
            .otherwise(F.struct(state["done"].alias("done"), F.when(state["now"] == "", text).otherwise(F.concat_ws(" ", state["now"], text)).alias("now")))
        )

    def finish(state: Column) -> Column:
        return F.array_join(F.when(state["now"] == "", state["done"]).otherwise(F.concat(state["done"], F.array(state["now"]))), para_sep)

    return F.aggregate(F.split(c, r"\r?\n"), start, add, finish)


def cleanup_text(c: Column) -> Column:
    """Soft hyphens dropped, broken words joined, spaces around punctuation and line breaks inside paragraphs removed."""
    c = F.translate(c, "­", "")
    c = F.regexp_replace(c, r"(?<=\w)-\s*\n\s*(?=[a-z])", "")
    c = F.regexp_replace(c, r"\s+([,.;:!?%)\]}])", "$1")
    c = F.regexp_replace(c, r"([(\[{])\s+", "$1")
    paragraphs = F.transform(F.split(c, r"\n\s*\n+"), lambda p: F.btrim(F.regexp_replace(p, r"\s*\n\s*", " ")))
    return F.array_join(F.filter(paragraphs, lambda p: p != ""), "\n\n")


def text_quality(c: Column, letters: str = r"\p{L}", confidence: Column | None = None) -> Column:
    """0 for empty text, else from length and share of letters, and the median scan confidence where there is one."""
    size = F.length(c)
    score = 0.45 + 0.25 * F.least(size / 1000.0, F.lit(1.0)) + 0.30 * F.regexp_count(c, F.lit(letters)) / F.greatest(size, F.lit(1))
    if confidence is not None:
        score = F.when(confidence.isNull(), score).otherwise(0.8 * score + 0.2 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence)))
    return F.when(F.coalesce(size, F.lit(0)) == 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 3))


#: Stands between tokens while they are put together.
_BETWEEN = "\u0001"


def join_tokens(tokens: Column) -> Column:
    """Tokens of a line as text: a hyphen glues a lower-case follower, punctuation glues left, openings and dashes glue right.

    What comes between two tokens is told by their edges alone, so the joined line is gone through once.
    """

    def add(out: Column, token: Column) -> Column:
        t = F.btrim(token)
        return (
            F.when(t == "", out).when(out == "", t)
            .when(out.endswith("-") & t.rlike(r"^\p{Ll}"), F.concat(F.substr(out, F.lit(1), F.length(out) - 1), t))
            .when(F.substring(t, 1, 1).isin(*",.;:!?%)]}") | F.substring(out, -1, 1).isin(*"([{—–/"), F.concat(out, t))
            .otherwise(F.concat_ws(" ", out, t))
        )

    joined = F.array_join(F.filter(trimmed_items(tokens), lambda t: t != ""), _BETWEEN)
    glued = F.regexp_replace(joined, rf"-{_BETWEEN}(?=\p{{Ll}})|{_BETWEEN}(?=[,.;:!?%)\]}}])", "")
    glued = F.translate(F.regexp_replace(glued, rf"(?<=[(\[{{—–/]){_BETWEEN}", ""), _BETWEEN, " ")
    # tokens that hold the sign themselves, or are null, go one by one
    plain = F.forall(tokens, lambda t: t.isNotNull() & ~F.contains(t, F.lit(_BETWEEN)))
    return F.when(plain, glued).otherwise(F.aggregate(tokens, F.lit(""), add))


def dash_norm(c: Column) -> Column:
    """Dashes unified, white space squeezed, edge punctuation and a hanging dash removed."""
    s = F.btrim(F.regexp_replace(F.translate(c, DASHES, "-" * len(DASHES)), r"\s+", " "), F.lit(TRIM))
    s = F.regexp_replace(s, r"\s+([,.;:])", "$1")
    return F.regexp_replace(s, r"(?s)\A(.{3,})-\z", "$1")


def name_norm(c: Column) -> Column:
    """dash_norm, and titles without their dot."""
    return dash_norm(F.regexp_replace(c, rf"(?i)\b({'|'.join(lexicons.PERSON_TITLES)})\.\s+", "$1 "))


def base_name(c: Column) -> Column:
    """The name without its title, lower-case, other signs than letters and digits as spaces."""
    return base_of(name_norm(c))


def base_of(norm: Column) -> Column:
    """base_name of a name that is normalised already."""
    return plain_words(F.regexp_replace(norm, rf"^(?i)(?:{'|'.join(lexicons.PERSON_TITLES)})\.?\s+", ""))


def plain_words(c: Column) -> Column:
    """Lower-case, other signs than letters and digits as spaces."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def entity_key(c: Column) -> Column:
    """Lower-case, apostrophes dropped, other signs as spaces."""
    return squeezed(F.regexp_replace(F.regexp_replace(F.lower(F.btrim(c)), "[’'`]", ""), r"[^a-z0-9\s-]", " "))


def context_at(text: Column, at: Column, size: Column, radius: int = 220) -> Column:
    """radius characters around the size characters at place at (from 1), or the first radius characters where at is 0; trimmed."""
    start = F.greatest(F.lit(1), at - radius)
    return F.btrim(F.when(at == 0, F.substring(text, 1, radius)).otherwise(F.substr(text, start, at - start + size + radius)))


def context_window(text: Column, term: Column, radius: int = 220) -> Column:
    """The text around the first hit of term, whatever its case, else its beginning; trimmed."""
    return context_at(text, F.instr(F.lower(text), F.lower(term)), F.length(term), radius)


def clean_limit(c: Column, n: int) -> Column:
    """White space squeezed, cut to n characters, right-trimmed."""
    return F.rtrim(F.substring(squeezed(c), 1, n))


def unique_limit(items: Column, n: int) -> Column:
    """The first n items that differ, whatever their case, in order; each item is compared with those kept so far, n at most."""
    some = F.filter(items, lambda x: x.isNotNull())
    known = lambda out, x: (F.size(out) >= n) | F.exists(out, lambda y: F.lower(y) == F.lower(x))
    return F.aggregate(some, F.array().cast("array<string>"), lambda out, x: F.when(known(out, x), out).otherwise(F.concat(out, F.array(x))))


def strip_quotes(c: Column) -> Column:
    """Quoted spans blanked out."""
    return F.regexp_replace(c, "(?s)[\"“][^\"”]*[\"”]", " ")


def sentences(c: Column, min_words: int = 4) -> Column:
    """Sentences of min_words words or more, white space squeezed."""
    parts = trimmed_items(F.split(squeezed(c), r"(?<=[.!?])\s+"))
    return F.filter(parts, lambda s: (s != "") & (F.size(F.split(s, " ")) >= min_words))


def strip_heading(c: Column, title: Column) -> Column:
    """The scene's title and a heading number in front removed; a bare "I" is prose."""
    s = F.btrim(c)
    s = F.when(s.startswith(title) & (F.length(title) > 0), F.btrim(F.substr(s, F.length(title) + 1))).otherwise(s)
    return F.btrim(F.regexp_replace(s, r"^(?:\d{1,4}|(?!I\s)[IVXLCDM]{1,8})[.)\-:]?\s+(?=[A-Z])", ""))


def clean_dialogue(c: Column, title: Column, starts: str = r"^(?i)(?:i|we|my|our|you|your|this|that|it|he|she|they|why|how|what|when|where|who|can|could|will|would|must|let|perhaps|if|there|here)$") -> Column:
    """strip_heading, and capitalised words in front of a word that starts speech removed (a speaker's name)."""
    words = F.split(strip_heading(c, title), r"\s+")
    at = F.array_min(F.filter(F.transform(words, lambda w, i: F.when(w.rlike(starts), i)), lambda i: i.isNotNull()))
    name = F.slice(words, 1, F.greatest(F.coalesce(at, F.lit(0)), F.lit(0)))
    speaker = at.isNotNull() & (at > 0) & (at <= 4) & F.forall(name, lambda w: w.rlike(r"^[A-Z][\w'’-]*[:,]?$"))
    return F.array_join(F.when(speaker, F.slice(words, at + 1, F.size(words))).otherwise(words), " ")


def quoted(c: Column) -> Column:
    """The text as a literal inside a pattern."""
    return F.concat(F.lit("\\Q"), F.regexp_replace(c, r"\\E", ""), F.lit("\\E"))
