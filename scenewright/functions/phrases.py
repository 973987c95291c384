"""Many phrases looked up in one pass over each text, by Aho-Corasick automata."""

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Phrases, and their characters, of one automaton at most: what is broadcast at a time.
PACK, LETTERS = 50_000, 4_000_000
_JOINERS = frozenset("'-")
_TOKEN = frozenset("abcdefghijklmnopqrstuvwxyz'-")


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def at_words(text: str, start: int, end: int) -> bool:
    """Whether word boundaries lie on both sides of text[start:end]."""
    left = start == 0 or _word(text[start - 1]) != _word(text[start])
    return left and (end == len(text) or _word(text[end - 1]) != _word(text[end]))


def at_tokens(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] is a whole token: a letter a-z and all letters, apostrophes and hyphens after it, two at least."""
    said = text[start:end]
    if len(said) < 2 or said[0] in _JOINERS or not _TOKEN.issuperset(said) or text[end : end + 1] in _TOKEN:
        return False
    while start and text[start - 1] in _JOINERS:
        start -= 1
    return not start or text[start - 1] not in _TOKEN


#: Texts, and their bytes, of one Arrow batch at most.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20

#: What a hit must be besides a substring.
BOUNDS = {"none": None, "word": at_words, "token": at_tokens}


def packs(phrases: Iterable[str]) -> Iterator[ahocorasick.Automaton]:
    """Automata of at most PACK phrases and LETTERS characters each; empty phrases are left out."""
    made, size = ahocorasick.Automaton(), 0
    for phrase in phrases:
        if phrase:
            made.add_word(phrase, phrase)
            size += len(phrase)
        if len(made) >= PACK or size >= LETTERS:
            made.make_automaton()
            yield made
            made, size = ahocorasick.Automaton(), 0
    if len(made):
        made.make_automaton()
        yield made


def phrases_in(automaton: ahocorasick.Automaton, text: str | None, fits) -> list[str]:
    """The phrases that occur in the text, each once, in order of their first hit's end."""
    found: dict[str, None] = {}
    for last, phrase in automaton.iter(text or ""):
        if phrase not in found and (fits is None or fits(text, last + 1 - len(phrase), last + 1)):
            found[phrase] = None
    return list(found)


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of BATCH_ROWS rows and BATCH_BYTES: as many rows as Spark sends by default are gigabytes of long texts in each task's Python."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def looked_up(sent, fits):
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = sent.value
        for batch in batches:
            yield pd.Series([phrases_in(automaton, t, fits) for t in batch], dtype=object)

    return look


def with_phrases(texts: DataFrame, phrases: DataFrame | Iterable[str], *, text_col: str, out: str, bounds: str = "none") -> DataFrame:
    """texts with out, the phrases that a text holds, each once.

    Every text is gone through once for a pack of PACK phrases, whatever their number, so its
    cost does not grow with the phrases. A larger list is taken in several passes, one for
    each pack: a row then comes once for each pack, with the phrases of that pack. What is
    broadcast is one automaton of bounded size a pass. phrases: a list, or a table whose first column
    holds them. Defined results: a null or empty text holds no phrase, nor does an empty phrase
    occur; phrases that are listed twice count once; without phrases out is empty.
    """
    fits = BOUNDS[bounds]
    spark = texts.sparkSession
    small_batches(spark)
    if isinstance(phrases, DataFrame):
        name = phrases.columns[0]
        phrases = (r[0] for r in phrases.select(name).where(F.col(name).isNotNull()).distinct().toLocalIterator())
    done = None
    for automaton in packs(phrases):
        look = F.pandas_udf(looked_up(spark.sparkContext.broadcast(automaton), fits), "array<string>")
        one = texts.withColumn(out, look(F.col(text_col)))
        done = one if done is None else done.unionByName(one)
    return texts.withColumn(out, F.array().cast("array<string>")) if done is None else done
