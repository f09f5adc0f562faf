"""Word counts and the most and least common words of each group.

A group may hold a third of all recordings, and its vocabulary may be of any size. So words
are counted by (group, word) with map-side partial sums, and the ranking is written such that
Spark keeps only a few rows per group before it shuffles (``WindowGroupLimit``): no task ever
holds a whole group.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from speechviews.functions.keys import packed, unpacked
from speechviews.functions.text import clean_text, comma_list, is_word
from speechviews.schemas import GROUP
from speechviews.session import broadcast_if_small

WORDS_KEPT = 5
LITERAL_WORDS = 1000  # up to here a set lookup, beyond a join; the result is the same


def words_of(df: DataFrame, *keep: str) -> DataFrame:
    """One row per surviving word of ``text``, next to the columns to keep."""
    return df.select(*keep, F.explode(F.split(clean_text(F.col("text")), " ")).alias("word")).where(
        is_word(F.col("word"))
    )


def word_counts(grouped: DataFrame) -> DataFrame:
    """How often each word occurs in each group."""
    return words_of(grouped, *GROUP).groupBy(*GROUP, "word").agg(F.count("*").alias("cnt"))


def _as_table(df: DataFrame, stop_words) -> DataFrame:
    if not isinstance(stop_words, DataFrame):
        stop_words = df.sparkSession.createDataFrame([(w,) for w in stop_words], "word string")
    # Other words cannot occur among the counted ones. The empty word, which an empty line of a
    # file would give, stands for a recording and its totals: it is never a stop word.
    return stop_words.select("word").where(is_word(F.col("word")))


def without_stop_words(df: DataFrame, stop_words) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose word is not listed (exact match), and the list if it is still to be applied.

    Nulls and the empty word list nothing. A short Python list becomes a set lookup, a table
    proven small a broadcast. A larger table is given back: joining it pays only after counting.
    """
    if not isinstance(stop_words, DataFrame):
        stop_words = [w for w in stop_words if w]
        if len(stop_words) <= LITERAL_WORDS:
            return df.where(~F.col("word").isin(stop_words)) if stop_words else df, None
    listed, small = broadcast_if_small(_as_table(df, stop_words))
    return (df.join(listed, "word", "left_anti"), None) if small else (df, listed)


def counts_without_stop_words(pieces: DataFrame, stop_words, *aggregates: Column, by=GROUP) -> DataFrame:
    """Aggregate pieces by group and word, stop words (a list or a table ``word``) left out.

    Listed words are most of a text, so they go before counting if they can. A list too large
    for that is joined afterwards, when even the commonest word is one row per group.
    """
    kept, listed = without_stop_words(pieces, stop_words)
    counts = kept.groupBy(*by, "word").agg(*aggregates)
    return counts if listed is None else counts.join(listed, "word", "left_anti")


def hopefuls(counts: DataFrame, n: int, by: str) -> DataFrame:
    """Rows that can be among the ``n`` most or least common words of their group, and all totals.

    A task passes over its rows once and leaves out what ``n`` rows before beat, so that only few rows of
    each task are sorted and ranked afterwards.
    """

    def run(batches):  # by value in whole: workers need not have this package
        codes, best = {}, []  # a group's number; its n first and n last words so far
        most_cnt, least_cnt = np.zeros(0, np.int64), np.zeros(0, np.int64)  # what a further word must reach
        most_word, least_word = [], []

        def code_of(group):
            if group not in codes:
                codes[group] = len(codes)
                best.append(([], []))
                most_word.append("")
                least_word.append("")
            return codes[group]

        def reaching(code, cnt, word):
            wanted = (cnt > most_cnt[code]) | (cnt < least_cnt[code])
            for of_group, words, reaches in ((most_cnt, most_word, pc.less_equal), (least_cnt, least_word, pc.greater_equal)):
                tie = np.nonzero(~wanted & (cnt == of_group[code]))[0]
                bound = pa.array(words, pa.string()).take(pa.array(code[tie]))
                wanted[tie] = reaches(word.take(pa.array(tie)), bound).to_numpy(zero_copy_only=False)
            return wanted

        def cut(k):
            most, least = best[k]
            most.sort(key=lambda e: (-e[0], e[1]))
            least.sort(key=lambda e: e[1], reverse=True)
            least.sort(key=lambda e: e[0])
            del most[n:], least[n:]
            if len(most) == n:
                (most_cnt[k], most_word[k]), (least_cnt[k], least_word[k]) = most[-1], least[-1]

        for batch in batches:
            groups = batch.column(by).dictionary_encode()
            numbers = np.array([*map(code_of, groups.dictionary.to_pylist()), code_of(None) if groups.indices.null_count else 0], np.int64)
            more = len(codes) - len(most_cnt)  # until n are known, all are wanted
            most_cnt = np.append(most_cnt, np.full(more, np.iinfo(np.int64).min))
            least_cnt = np.append(least_cnt, np.full(more, np.iinfo(np.int64).max))
            code = numbers[pc.fill_null(groups.indices, len(groups.dictionary)).to_numpy(zero_copy_only=False)]
            cnt, word = batch.column("cnt").to_numpy(zero_copy_only=False), batch.column("word")
            total = pc.equal(word, "").to_numpy(zero_copy_only=False)
            wanted = reaching(code, cnt, word)
            new, changed = np.nonzero(wanted & ~total)[0], set()
            for k, c, w in zip(code[new].tolist(), cnt[new].tolist(), word.take(pa.array(new)).to_pylist()):
                for kept in best[k]:
                    kept.append((c, w))
                changed.add(k)
                if len(best[k][0]) >= 8 * n:
                    cut(k)
            for k in changed:
                cut(k)
            if 8 * len(new) > len(cnt):  # the first batches: the bounds have just been found
                wanted = reaching(code, cnt, word)
            yield batch.filter(pa.array(wanted | total))

    return counts.mapInArrow(run, counts.schema)


def ranked(counts: DataFrame, n=WORDS_KEPT, by=GROUP, sides=("most", "least")) -> DataFrame:
    """The first ``n`` words of each group by (count descending, word), side 'most', and the last
    ``n`` of the same order, side 'least', where rank 1 is the very last word.

    The sides asked for are ranked in one window over (group, side), so the counts are read once. A row
    with the empty word is not a word but carries totals of its group; it passes as side 'all'.
    """
    if len(by) == 1:
        counts = hopefuls(counts, n, *by)
    word, side = F.col("word"), F.col("side")
    asked = F.when(word == "", F.array(F.lit("all"))).otherwise(F.array(*[F.lit(s) for s in sides]))
    if len(sides) == 1:
        rows = counts.withColumn("side", F.when(word == "", "all").otherwise(sides[0]))
    else:
        rows = counts.withColumn("side", F.explode(asked))
    order = Window.partitionBy(*by, "side").orderBy(
        F.when(side == "most", -F.col("cnt")).otherwise(F.col("cnt")),
        F.when(side == "most", word),
        F.when(side == "least", word).desc(),
    )
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def listed_words(side: str) -> Column:
    """Aggregate over ranked rows: the words of one side as an array, commoner words first."""
    entries = F.collect_list(F.when(F.col("side") == side, F.struct("rank", "word")))
    return F.transform(F.sort_array(entries, asc=side == "most"), lambda e: e.getField("word"))


def word_ranking(grouped: DataFrame, stop_words, n=WORDS_KEPT, sides=("most", "least")) -> DataFrame:
    """(group columns, side, rank, word, cnt): the ``n`` most and least common words of each group.

    Until the few rows that stay are known, the group is one packed string.
    """
    pieces = words_of(grouped.select(packed(*GROUP).alias("group"), "text"), "group")
    counts = counts_without_stop_words(pieces, stop_words, F.count("*").alias("cnt"), by=["group"])
    return ranked(counts, n, by=["group"], sides=sides).select(
        *unpacked(F.col("group"), GROUP), "side", "rank", "word", "cnt"
    )


def word_lists(ranking: DataFrame, by=GROUP) -> DataFrame:
    """Both word lists of each group that has any word, as comma-separated text."""
    return ranking.groupBy(*by).agg(
        comma_list(listed_words("most")).alias("most_common_words"),
        comma_list(listed_words("least")).alias("least_common_words"),
    )
