"""Per-document text statistics, and natural prose told from lists, tables and junk by an induced rule list."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import cut, spread
from .rules import induce, to_sql

#: Unicode white space, and the control characters that part fields and records.
WHITE = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: White space without the line feed.
IN_LINE = r"\x{9}\x{b}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Closing punctuation.
CLOSERS = ".!?…\"”“»)"
WORD = r"[\p{L}\p{N}]+"
LAST_IN_LINE = rf"[{IN_LINE}]*(?:\n|\z)"

#: So many common words are looked up in place (a hash set in the plan); more are joined.
WORDS_IN_PLAN = 20_000
#: Labelled documents of each class that the rules are induced from, at most about.
LABELLED = 20_000

FEATURES = ["common_share", "closed_share", "symbol_ratio", "mean_word_length"]


def text_statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """One row per row of documents: `doc_id`, `n_words`, `mean_word_length`, `n_visible` (characters that are no white
    space), `symbol_ratio` (share of these that are neither letter nor digit), `n_lines` (not blank), `closed_share` (of
    lines that end in closing punctuation) and `common_share` (of words found in common_words, under any language).

    Shares and means without a base are 0, so null, empty and blank texts give zeros; texts of any length are read whole;
    repeated rows each give a row, a null doc_id is kept; empty tables give no row, or no common word; other columns are not
    read. All is native: one pass, no shuffle.
    """
    text = F.coalesce("text", F.lit(""))
    base = documents.select("doc_id", text.alias("text")).withColumn("low", F.lower("text"))
    ratio = lambda part, whole: F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    # a letter's lower case is one letter or digit, with marks at most: words hold as many as the text itself
    measured = (
        base.withColumn("words", F.regexp_extract_all("low", F.lit(WORD), F.lit(0)))
        .withColumn("n_words", F.size("words"))
        .withColumn("n_letters", F.length(F.array_join("words", "")))
        .withColumn("n_visible", F.length(F.regexp_replace("text", f"[{WHITE}]+", "")))
        .withColumn("ends", F.regexp_extract_all("text", F.lit(rf"([^{WHITE}]){LAST_IN_LINE}"), F.lit(1)))
        .withColumn("n_lines", F.size("ends"))
        .withColumn("n_closed", F.size(F.filter("ends", lambda c: c.isin(list(CLOSERS)))))
    )
    counted = _count_common(measured, common_words)
    return counted.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        ratio(F.col("n_letters"), F.col("n_words")).alias("mean_word_length"),
        F.col("n_visible").cast("long").alias("n_visible"),
        ratio(F.col("n_visible") - F.col("n_letters"), F.col("n_visible")).alias("symbol_ratio"),
        F.col("n_lines").cast("long").alias("n_lines"),
        ratio(F.col("n_closed"), F.col("n_lines")).alias("closed_share"),
        ratio(F.col("n_common"), F.col("n_words")).alias("common_share"),
    )


def _count_common(measured: DataFrame, common_words: DataFrame) -> DataFrame:
    """Adds `n_common`, the words of `words` that are common ones."""
    lexicon = common_words.select(F.col("word").alias("w")).dropna().distinct()
    if lexicon.count() <= WORDS_IN_PLAN:
        known = [r["w"] for r in lexicon.collect()]
        hit: Column = F.size(F.filter("words", lambda w: w.isin(known))) if known else F.lit(0)
        return measured.withColumn("n_common", hit)
    tagged = cut(measured.withColumn("row", F.monotonically_increasing_id()))
    hits = tagged.select("row", F.explode("words").alias("w")).groupBy("row", "w").count().join(lexicon, "w")
    totals = hits.groupBy("row").agg(F.sum("count").alias("n_common"))
    return tagged.join(totals, "row", "left").withColumn("n_common", F.coalesce("n_common", F.lit(0)))


def defects() -> Column:
    """How many of the four stated marks of junk a document bears."""
    marks = [
        F.col("common_share") < 0.15,
        F.col("closed_share") < 0.4,
        F.col("symbol_ratio") > 0.25,
        (F.col("mean_word_length") < 2.5) | (F.col("mean_word_length") > 9.0),
    ]
    return sum((m.cast("int") for m in marks[1:]), marks[0].cast("int"))


def learn_rules(stats: DataFrame, label: Column, labelled: int = LABELLED, features: list[str] = FEATURES) -> list:
    """Rules for documents with a true label, induced from at most about `labelled` rows of each class.

    The rows are those of lowest hash of doc_id: all documents are counted first, then the hash bound that keeps so many
    of each class is applied, so that the driver's part never grows with the corpus."""
    own = stats.select(*features, "doc_id", label.alias("label"))
    counts = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    bound = {k: -(-1_000_000 * labelled // n) if n > labelled else 1_000_000 for k, n in counts.items()}
    kept = own.filter(place < F.when(F.col("label"), bound.get(True, 0)).otherwise(bound.get(False, 0)))
    rows = sorted(kept.select(*features, "label").collect())
    x = np.array([r[: len(features)] for r in rows], float).reshape(-1, len(features))
    return induce(x, np.array([r["label"] for r in rows], bool))


def judged(documents: DataFrame, common_words: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """The statistics with `verdict`: 'blank' for texts without a visible character, else 'junk' or 'prose' by the learned rule
    list applied as one CASE expression.

    A document's label is junk if it bears two of the stated marks. The rules describe junk and come from a bounded number of
    labelled rows, all of whose junk they cover and nothing else; on other rows they may err, near their thresholds or where
    they saw no like. Nulls and empty texts are blank, repeated rows each get their verdict, an empty table gives no row."""
    stats = cut(text_statistics(spread(documents.select("doc_id", "text")), common_words))
    rules = learn_rules(stats.filter(F.col("n_visible") > 0), defects() >= 2, labelled)
    verdict = F.when(F.col("n_visible") == 0, F.lit("blank")).otherwise(F.expr(to_sql(rules, FEATURES, "junk", "prose")))
    return stats.withColumn("verdict", verdict)


def junk(documents: DataFrame, common_words: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """`doc_id` of texts that are no natural prose: those the rule list calls junk, less those that an exact check of the stated
    marks clears. The check strikes false alarms only; what the list doesn't call junk isn't looked at again, so while a class
    has more than `labelled` documents the result is as complete as the rules are."""
    return judged(documents, common_words, labelled).filter((F.col("verdict") == "junk") & (defects() >= 2)).select("doc_id")
