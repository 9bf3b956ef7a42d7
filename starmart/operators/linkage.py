"""Matching entries of two code lists by name.

Codes of one list need not be those of another (a yearly payroll and its master
may share none), but the names are alike. ``candidates`` scores pairs of names
by the weighted share of their words; ``one_to_one`` picks pairs from the best
down, each entry once; ``crosswalk`` is the table of both codes that results, by
which ``translated`` gives a payroll the master's codes.

Rare words weigh more: log(1 + entries / entries with the word), in thousandths.
Pairs below ``least`` are never made: an entry is looked up only under its rarest
words, so many that the rest together weigh less than ``least`` of the name. Two
names of that score share a word among those, so no pair is lost, and frequent
words ("DEPARTMENT", "OF") bring nobody together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import checked_broadcast
from starmart.session import materialize


def name_words(name: Column, same: dict[str, str] | None = None) -> Column:
    """Distinct lower-case runs of letters and digits; ``same`` maps a word to
    the one it is counted as (abbreviations). No name, no words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("([a-z0-9à-öø-ÿ]+)"))
    if same:
        table = F.create_map(*[F.lit(x) for pair in same.items() for x in pair])
        words = F.transform(words, lambda w: F.coalesce(table[w], w))
    return F.array_distinct(words)


def _weighed(entries: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, words, total): words as (weight, word), the heaviest first."""
    return (entries.select("id", F.explode("words").alias("word")).join(checked_broadcast(weights), "word")
            .groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("light"), "word"))).alias("s"))
            .select("id", F.transform("s", lambda x: F.struct((-x["light"]).alias("weight"), x["word"].alias("word"))).alias("words"))
            .withColumn("total", F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + x["weight"])))


def _looked_up(entries: DataFrame, least: float) -> DataFrame:
    """``entries`` once for each word under which they are looked up (``word``):
    the heaviest, until the rest weighs less than ``least`` of all."""
    # a word belongs to them if it and what follows weigh that much
    before = F.transform("words", lambda x, i: F.aggregate(
        F.slice("words", F.lit(1), i), F.lit(0).cast("long"), lambda a, y: a + y["weight"]))
    rare = F.filter(F.arrays_zip(F.col("words").alias("x"), before.alias("y")),
                    lambda z: F.col("total") - z["y"] >= F.lit(least) * F.col("total") - 1e-6)
    return entries.withColumn("word", F.explode(F.transform(rare, lambda z: z["x"]["word"])))


def candidates(left: DataFrame, right: DataFrame, least: float = 0.5, same: dict[str, str] | None = None) -> DataFrame:
    """(left_id, right_id, score) of all pairs of ``left`` and ``right`` (id, name),
    ids unique in each, whose names score ``least`` or more. The score is the
    weight of the shared words over that of all words of both."""
    lists = [df.select("id", name_words(F.col("name"), same).alias("words")) for df in (left, right)]
    words = lists[0].select("words").unionByName(lists[1].select("words"))
    n = words.count()
    weights = materialize(
        words.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
        .select("word", F.floor(1000 * F.log1p(F.lit(float(n)) / F.col("df"))).cast("long").alias("weight")), "word-weights")
    a, b = (materialize(_weighed(df, weights), "weighed-names") for df in lists)
    a = _looked_up(a, least).select("word", F.col("id").alias("left_id"), F.col("words").alias("lw"), F.col("total").alias("lt"))
    b = _looked_up(b, least).select("word", F.col("id").alias("right_id"), F.col("words").alias("rw"), F.col("total").alias("rt"))
    shared = F.aggregate(F.array_intersect("lw", "rw"), F.lit(0).cast("long"), lambda s, x: s + x["weight"])
    scored = a.join(b, "word").withColumn("shared", shared).withColumn(
        "score", F.col("shared") / (F.col("lt") + F.col("rt") - F.col("shared")))
    # of the words under which a pair meets, the heaviest alone reports it
    first = F.array_intersect("lw", "rw")[0]["word"] == F.col("word")
    return scored.where(first & (F.col("score") >= least)).select("left_id", "right_id", "score")


def one_to_one(pairs: DataFrame) -> DataFrame:
    """``pairs`` (left_id, right_id, score) picked from the best score down (of
    equal ones the smallest ids), each id at most once.

    In a round every pair that is the best of both its entries is picked: these
    are pairs that picking one by one picks too. Each round picks the best pair
    left at least, and usually most of them; entries that are taken leave with
    all their pairs. An entry's pairs are compared map-side first, so one that is
    like a great many others does not gather in a task."""
    order = F.struct((-F.col("score")).alias("less"), F.col("left_id"), F.col("right_id"))
    left = materialize(pairs, "pairs-left")
    picked: DataFrame | None = None
    while not left.isEmpty():
        best = lambda of: left.groupBy(of).agg(F.min(order).alias("b")).select("b.*")  # noqa: B023, E731
        both = best("left_id").intersect(best("right_id"))
        new = materialize(both.select("left_id", "right_id", (-F.col("less")).alias("score")), "pairs-picked")
        picked = new if picked is None else picked.unionByName(new)
        left = materialize(
            left.join(checked_broadcast(new.select("left_id")), "left_id", "left_anti")
            .join(checked_broadcast(new.select("right_id")), "right_id", "left_anti")
            .select("left_id", "right_id", "score"), "pairs-left")
    return left if picked is None else picked


def crosswalk(left: DataFrame, right: DataFrame, least: float = 0.5, same: dict[str, str] | None = None) -> DataFrame:
    """(left_id, right_id, score): which entry of ``right`` (id, name) each entry of
    ``left`` (id, name) is, at most one for either. Entries without a partner of
    that score have no row."""
    return one_to_one(candidates(left, right, least, same))


def translated(rows: DataFrame, code: str, walk: DataFrame, out: str) -> DataFrame:
    """``rows`` with the other list's code for ``code`` in ``out`` (null: none)."""
    side = checked_broadcast(walk.select(F.col("left_id").alias("_left"), F.col("right_id").alias(out)))
    return rows.join(side, F.col(code) == F.col("_left"), "left").drop("_left")


def orphan_report(rows: DataFrame, code: str, master: DataFrame, walk: DataFrame) -> DataFrame:
    """(matched_by, n_rows, n_orphans): rows of ``rows`` that find no entry of
    ``master`` (id, name) by their own code, and by the crosswalk."""
    ids = checked_broadcast(master.select(F.col("id").alias("_id")).distinct())
    by_walk = translated(rows, code, walk, "_right")

    def counted(matched_by: str, df: DataFrame, key: str) -> DataFrame:
        found = df.join(ids, F.col(key) == F.col("_id"), "left")
        return found.agg(F.count("*").alias("n_rows"), F.count_if(F.col("_id").isNull()).alias("n_orphans")).select(
            F.lit(matched_by).alias("matched_by"), "n_rows", "n_orphans")

    return counted("code", rows, code).unionByName(counted("crosswalk", by_walk, "_right"))
