"""Operator 5: quality rules that compare a document's make-up with that of its language.

Counts decide the plain cases. For the rest, two histograms of the document, of
character classes and of the common words of its language, are compared with
those of all documents of the language by the Jensen-Shannon distance. In languages
with few words the classes are compared with those of all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.llm.common import SPACE, WORD, join_null_safe, let, text_of, whole_row
from demandflow.session import materialize, sized

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    """Limits of the rules."""

    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 16  # of each language, 60 at most
    common_length: int = 4  # code points of a common word at most; such words carry grammar, not topics
    guard_words: int = 80  # shorter documents are not compared with their language
    guard_language: int = 2_000  # languages with fewer short words in all have no list of common ones
    max_class_distance: float = 0.30
    max_word_distance: float = 0.55


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, n: a + n)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def class_counts(text: Column) -> Column:
    """Code points by class: capitals, digits, marks, symbols, white space, all others."""
    patterns = (r"\p{Lu}", "[0-9]", r"""[.,:;!?'"()-]""", SYMBOLS)
    # Most of a text is small letters and spaces: without them the classes are counted in a short rest.
    rare = F.regexp_replace(text, r"[a-z\x20\u00DF-\u00F6\u00F8-\u00FF]+", "")
    some = let(rare, lambda r: F.array(*[F.regexp_count(r, F.lit(p)).cast("bigint") for p in patterns]))
    space = (F.length(text) - F.length(F.regexp_replace(text, SPACE, ""))).cast("bigint")
    return let(F.concat(some, F.array(space)), lambda c: F.concat(c, F.array(F.length(text) - total(c))))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    return let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))


def grams(words: Column, n: Column) -> Column:
    """A hash of each window of three words."""
    windows = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(windows, F.lit(1), F.greatest(n - 2, F.lit(0)))


def repeated_starts(windows: Column) -> Column:
    """Sorted numbers of the windows that occur more than once."""
    # Plain numbers sort fast: those that share the upper bits of their hash are looked at again in full.
    packed = F.transform(windows, lambda h, i: h.bitwiseAND(F.lit(-1 << 28)).bitwiseOR(i.cast("bigint")))

    def alike(x: Column, y: Column) -> Column:
        return F.shiftright(x, 28) == F.shiftright(y, 28)

    def maybe(p: Column) -> Column:
        return F.filter(p, lambda x, k: alike(x, F.get(p, k - 1)) | alike(x, F.get(p, k + 1)))

    places = F.transform(let(F.sort_array(packed), maybe), lambda x: x.bitwiseAND(F.lit((1 << 28) - 1)).cast("int"))
    ordered = F.sort_array(F.transform(places, lambda i: F.struct(F.get(windows, i).alias("h"), i.alias("i"))))

    def starts(sorted_windows: Column) -> Column:
        twin = F.transform(
            sorted_windows,
            lambda x, k: F.when(
                (F.get(sorted_windows, k - 1)["h"] == x["h"]) | (F.get(sorted_windows, k + 1)["h"] == x["h"]), x["i"]
            ),
        )
        return F.sort_array(F.array_compact(twin))

    return let(ordered, starts)


def covered(starts: Column) -> Column:
    """Words inside the windows of three that begin at the sorted ``starts``."""
    steps = F.transform(starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1), s + 3) - s))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)


def counted(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` as a struct, lang, the words and the base counts of every row."""
    text = text_of(docs)
    first = docs.select(F.struct(*keep).alias("_keep"), docs["lang"].alias("lang"), text.alias("text"), words_of(text).alias("words"))
    second = first.withColumn("n_words", F.size("words").cast("bigint"))
    third = second.withColumn("windows", grams(F.col("words"), F.col("n_words").cast("int")))
    repeats = F.size("windows") != F.size(F.array_distinct("windows"))
    fourth = third.withColumn("starts", F.when(repeats, repeated_starts(F.col("windows"))))
    return fourth.withColumns(
        {
            "classes": class_counts(F.col("text")),
            "n_dup_lines": duplicate_lines(F.col("text")).cast("bigint"),
            "n_repeat_words": F.coalesce(covered(F.col("starts")), F.lit(0)).cast("bigint"),
        }
    ).drop("windows", "starts")


def references(docs: DataFrame, rules: Rules) -> DataFrame:
    """One row per language: its common words, and the shares of its common words and character classes.

    Both are counted over all documents of the language; a null language is one too. The classes of
    a language below ``guard_language`` are those of all languages together, six sums that are read back.
    """
    text = text_of(docs)
    texts = docs.select(docs["lang"].alias("lang"), text.alias("text"))
    classes = texts.select("lang", class_counts(F.col("text")).alias("c"))
    names = [f"c{i}" for i in range(6)]
    sums = classes.groupBy("lang").agg(*[F.sum(F.get("c", i)).alias(n) for i, n in enumerate(names)])
    by_class = materialize(sums, "language_classes")
    of_all = F.array(*[F.lit(n or 0).cast("bigint") for n in by_class.agg(*[F.sum(n) for n in names]).first()])
    words = texts.select("lang", F.explode(F.split("text", SPACE)).alias("word"))
    short = words.where(F.length("word").between(1, rules.common_length)).select("lang", F.lower("word").alias("word"))
    counts = materialize(short.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "language_words")
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.common_words)
    listed = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    joined = join_null_safe(join_null_safe(by_class, listed, "lang", how="left"), totals, "lang", how="left")
    few = F.coalesce("total", F.lit(0)) < rules.guard_language
    common = F.coalesce(F.col("top"), F.array().cast("array<struct<rank:int,word:string,n:bigint>>"))
    return materialize(
        joined.select(
            "lang",
            F.coalesce("total", F.lit(0)).alias("language_words"),
            F.transform(common, lambda t: t["word"]).alias("common"),
            with_rest(F.transform(common, lambda t: t["n"]), F.coalesce("total", F.lit(0))).alias("word_reference"),
            F.when(few, of_all).otherwise(F.array(*names)).alias("class_reference"),
        ),
        "language_references",
    )


def with_rest(counts: Column, whole: Column) -> Column:
    """``counts`` followed by what is left of ``whole``."""
    return let(counts, lambda c: F.concat(c, F.array(whole.cast("bigint") - total(c))))


def shares(counts: Column) -> Column:
    return let(counts, lambda c: let(F.greatest(total(c), F.lit(1)), lambda t: F.transform(c, lambda n: n / t)))


def divergence(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of two histograms of the same length."""

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(shares(counts), shares(reference), lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) / 2))


def common_counts(words: Column, common: Column, length: int) -> Column:
    """How often each of ``common`` is among the short ones of ``words``, in any case, and then the other short ones."""
    short = F.filter(words, lambda w: F.length(w) <= length)
    # One character per word, "@" for those that are not common; counting is then removing one character.
    codes = F.array_join(F.transform(short, lambda w: F.char(F.array_position(common, F.lower(w)) + 64)), "")

    def histogram(c: Column) -> Column:
        places = F.concat(F.transform(common, lambda _, k: k + 1), F.array(F.lit(0)))
        return F.transform(
            places, lambda k: (F.octet_length(c) - F.octet_length(F.replace(c, F.char(k + 64)))).cast("bigint")
        )

    return let(codes, histogram)


def judged(docs: DataFrame, rules: Rules, *keep: Column) -> DataFrame:
    """``keep``, at least one column, and, of every row of ``docs``, the base counts, both distances and the verdict.

    Columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance, kept. A null text has no words and fails; a null
    language is a language of its own; an empty table gives no rows; equal rows get
    equal verdicts. Both distances are null for documents shorter than ``guard_words``, the word distance
    also for languages below ``guard_language``, and then do not reject. Rows are not shuffled.
    """
    reference = references(docs, rules)
    rows = counted(docs, *keep)
    joined = join_null_safe(rows, sized(reference), "lang", how="left")
    long = F.col("n_words") >= rules.guard_words
    listed = long & (F.col("language_words") >= rules.guard_language)
    counts = common_counts(F.col("words"), F.col("common"), rules.common_length)
    measured = joined.withColumn("word_counts", F.when(listed, counts)).withColumns(
        {
            "class_distance": F.when(long, divergence(F.col("classes"), F.col("class_reference"))),
            "word_distance": F.when(listed, divergence(F.col("word_counts"), F.col("word_reference"))),
            "base_failed": (F.col("n_words") < rules.min_words)
            | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")),
        }
    )
    close = (F.coalesce("class_distance", F.lit(0.0)) <= rules.max_class_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= rules.max_word_distance
    )
    return measured.select(
        "_keep.*",
        "n_words",
        (F.length("text") - F.element_at("classes", 5)).cast("bigint").alias("word_chars"),
        F.element_at("classes", 4).alias("n_symbols"),
        *["n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance"],
        (~F.col("base_failed") & close).alias("kept"),
    )


def passing(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """The rows of ``docs`` that the rules keep, in its own columns.

    The condition also names a running number, because the optimizer does not push a filter below one. Pushed down, the
    verdict would be written out in full for every column that it is made of.
    """
    rows = judged(docs, rules, whole_row(docs).alias("row")).withColumn("_n", F.monotonically_increasing_id())
    return rows.where("kept AND _n >= 0").select("row.*")
