"""Quality rules over whole texts, run as a cascade that stops at the first rule that rejects.

Each rule is a boolean expression over the text. On a sample of the documents every rule's cost (seconds) and
selectivity (share of rows that it rejects) are measured, and the rules run by rejections per cost, highest first. The
order changes what a verdict costs, never the verdict. All expressions are built-in functions; nothing is shuffled.
"""

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.llm.shared import Held, is_empty

#: About so many rows are sampled to order the rules.
SAMPLE_ROWS = 2000
MIN_WORDS = 20
WINDOW = 8

_SPACE = " \t\n\x0b\x0c\r"
_WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"

_trimmed = f"btrim(txt, '{_SPACE}')"
_words = f"CASE WHEN {_trimmed} = '' THEN CAST(array() AS array<string>) ELSE split({_trimmed}, r'{_GAP}') END"
_lines = f"filter(split(txt, '\\n'), line -> btrim(line, '{_SPACE}') <> '')"
_word_chars = f"char_length(translate(txt, '{_SPACE}', ''))"
_symbols = "char_length(txt) - char_length(translate(txt, '#*$%&|<>', ''))"
_capitals = "char_length(txt) - char_length(translate(txt, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))"
# Hash the windows, sort them by key, keep those with an equal neighbour, and add up the words that each adds to the
# covered ones. Every step is bound by a lambda, so that it runs once per text wherever the optimiser moves it.
_repeated = f"""
transform(transform(array({_words}),
    words -> CASE WHEN size(words) < {WINDOW} THEN CAST(array() AS array<bigint>)
        ELSE transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW}))) END),
    keys -> CASE WHEN size(array_distinct(keys)) = size(keys) THEN 0L ELSE aggregate(
        transform(
            array(sort_array(transform(keys, (h, i) -> named_struct('h', h, 'i', i)))),
            s -> sort_array(transform(filter(s, (x, k) -> x.h <=> get(s, k - 1).h OR x.h <=> get(s, k + 1).h), x -> x.i)))[0],
        named_struct('last', -{WINDOW}, 'total', 0L),
        (a, at) -> named_struct('last', at, 'total', a.total + least({WINDOW}, at - a.last)),
        a -> a.total) END)[0]"""

#: Rules that need no more than the text: a document is rejected where the expression is true.
BASE = {
    "too few words": f"regexp_count(txt, r'{_WORD}') < {MIN_WORDS}",
    "repeated words": "100 * n_repeat_words > 30 * n_words",
}
MORE = {
    "symbols": f"10 * ({_symbols}) > 3 * regexp_count(txt, r'{_WORD}')",
    "capitals": f"2 * ({_capitals}) > {_word_chars}",
    "repeated lines": f"2 * (size({_lines}) - size(array_distinct({_lines}))) > size({_lines})",
    "word length": f"{_word_chars} NOT BETWEEN 2 * regexp_count(txt, r'{_WORD}') AND 20 * regexp_count(txt, r'{_WORD}')",
}


def _with_repeats(df: DataFrame) -> DataFrame:
    """Adds n_words and n_repeat_words."""
    n_words = F.expr(f"regexp_count(txt, r'{_WORD}')").cast("long")
    return df.withColumn("n_words", n_words).withColumn("n_repeat_words", F.expr(_repeated))


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, txt (null as empty) and the base counts of every row, in the order of the rows."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("txt"))
    df = df.withColumn("lines", F.expr(_lines))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    df = _with_repeats(df)
    return df.withColumn("word_chars", F.expr(_word_chars).cast("long")).withColumn("n_symbols", F.expr(_symbols).cast("long"))


def ordered(docs: DataFrame, rules: dict[str, str]) -> list[str]:
    """Names of the rules by measured rejections per second on a sample, highest first; ties keep the given order."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("txt"))
    rows = texts.count()
    held = Held(spark)
    sample = held.table(texts.sample(fraction=min(1.0, SAMPLE_ROWS / max(rows, 1)), seed=1))
    if is_empty(sample):
        held.drop(sample)
        return list(rules)
    rate = {}
    sample.agg(F.sum(F.length("txt"))).head()
    for name, rule in rules.items():
        began = time.perf_counter()
        frame = _with_repeats(sample) if "n_repeat_words" in rule else sample
        rejected = frame.agg(F.count_if(F.expr(rule))).head()[0]
        rate[name] = rejected / (time.perf_counter() - began)
    held.drop(sample)
    return sorted(rules, key=lambda name: -rate[name])


def _passes(rules: dict[str, str], names: list[str]) -> Column:
    """True where no rule rejects; evaluation stops at the first that does."""
    verdict = F.lit(True)
    for name in reversed(names):
        verdict = F.when(F.expr(rules[name]), False).otherwise(verdict)
    return verdict


def judged(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    `docs` needs doc_id and text; other columns are ignored, whatever their names. Null texts count as empty; empty
    texts have counts of 0 and fail the base. Repeated rows are judged each for itself; an empty table gives none.
    """
    order = ordered(docs, MORE)
    failed = F.expr(f"n_words < {MIN_WORDS} OR {BASE['repeated words']}")
    df = counts(docs).withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), False).otherwise(_passes(MORE, order))
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept")
    )


def passing(docs: DataFrame) -> DataFrame:
    """The rows that no rule rejects, with their columns. Only rows that reach the rule on repeats pay for it."""
    columns = docs.columns
    rules = BASE | MORE
    order = ordered(docs, rules)
    at = order.index("repeated words")
    df = docs.select(F.struct(*columns).alias("row"), F.coalesce("text", F.lit("")).alias("txt"))
    df = df.where(_passes(rules, order[:at]))
    df = _with_repeats(df).where(_passes(rules, order[at:]))
    return df.select("row.*")
