"""Owners by part of a name: an inverted index on the words of names, asked by the rarest word.

"Ann Lee" and "Lee, Ann B." mean the same owner where all words of the one are among the words of the other. Names are
compared once, however many accounts or sources bear them: the index holds distinct sets of words. A set that lies
in another shares its rarest word with it, so each set asks for that word's postings alone; the postings of a word
that many names have are dealt over parts. Words count by how many names of the other side have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetmill.functions.text import fold_key, phone_digits
from vetmill.sources.shared import kept

#: Postings of a word that one part holds.
PART = 100_000
#: Fewest words of a name that may be part of another.
LEAST = 2


def name_words(c: Column | str) -> Column:
    """The distinct words of a folded name in order; commas and full stops part words."""
    words = F.split(F.regexp_replace(fold_key(c), "[.,]", " "), " ")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


def contained(small: DataFrame, large: DataFrame, part: int = PART) -> DataFrame:
    """small, large: the keys of sets of words (key, words; keys are unique) of which the one lies in the other, equal ones
    too. An empty set lies in none."""
    postings = large.select("key", "words", F.explode("words").alias("word"))
    known = kept(postings.groupBy("word").agg(F.count("*").alias("n")), "words")
    asking = small.select("key", "words", F.explode("words").alias("word")).join(known, "word").groupBy("key").agg(
        F.first("words").alias("few"), F.count("*").alias("held"), F.min(F.struct("n", "word")).alias("rarest"))
    parts = lambda n: F.floor((n - 1) / part).cast("int") + 1
    asking = asking.where("held = size(few)").select(
        F.col("key").alias("small"), "few", "rarest.word", F.explode(F.sequence(F.lit(0), parts(F.col("rarest.n")) - 1)).alias("part"))
    crowded = known.where(F.col("n") > part).select("word", parts(F.col("n")).alias("parts"))  # at most postings / part words
    postings = postings.join(crowded, "word", "left").select(
        "word", F.coalesce(F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"), F.lit(0)).alias("part"), F.col("key").alias("large"), F.col("words").alias("many"))
    return asking.join(postings, ["word", "part"]).where(F.size(F.array_except("few", "many")) == 0).select("small", "large")


def owners_by_part(src: DataFrame, accounts: DataFrame, least: int = LEAST, part: int = PART) -> DataFrame:
    """src_id, level, n, account_id: for each source whose owner's name meets an account's, how it does (exact, words: the
    same words, part: one lies in the other and has `least` words at least), the number of accounts that are left, and their
    id if it is one.

    The best level counts, and within it accounts of an equal phone, if there are any. Accounts are counted by name, and
    by name and phone, before they are joined; blank names meet nothing."""
    wanted = src.select("src_id", fold_key("client_name").alias("name"), phone_digits("phone_no").alias("phone")).where("name <> ''")
    words = lambda df: df.withColumn("words", name_words("name")).withColumn("key", F.array_join("words", " "))
    asked = kept(words(wanted.select("name", "phone").distinct()), "asked")
    have = accounts.select(fold_key("display_name").alias("name"), F.coalesce("primary_phone", F.lit("")).alias("phone"), "account_id").where("name <> ''")
    count = [F.count("*").alias("n"), F.min("account_id").alias("id")]
    by_name = kept(words(have.groupBy("name").agg(*count)), "by_name")
    by_phone = have.where("phone <> ''").groupBy(F.col("name").alias("other"), "phone").agg(F.struct(*count).alias("own"))

    sets = [df.select("key", "words").distinct() for df in (asked, by_name)]
    long = [s.where(F.size("words") >= least) for s in sets]
    pairs = contained(*long, part).toDF("key", "their").unionByName(contained(*long[::-1], part).toDF("their", "key"))
    pairs = pairs.unionByName(sets[0].join(sets[1].select("key"), "key", "left_semi").select("key", F.col("key").alias("their"))).distinct()
    names = by_name.select(F.col("key").alias("their"), F.col("name").alias("other"), "n", "id")
    found = asked.drop("words").join(pairs, "key").join(names, "their").join(by_phone, ["other", "phone"], "left")
    level = F.when(F.col("name") == F.col("other"), 0).when(F.col("key") == F.col("their"), 1).otherwise(2)
    found = found.groupBy("name", "phone", level.alias("level")).agg(
        F.sum("n").alias("n"), F.min("id").alias("id"), F.sum("own.n").alias("own_n"), F.min("own.id").alias("own_id"))
    best = found.groupBy("name", "phone").agg(F.min(F.struct("level", "n", "id", "own_n", "own_id")).alias("b"))
    n = F.coalesce("b.own_n", "b.n")
    best = best.select("name", "phone", F.element_at(F.array(*map(F.lit, ("exact", "words", "part"))), F.col("b.level") + 1).alias("level"),
                       n.alias("n"), F.when(n == 1, F.coalesce("b.own_id", "b.id")).alias("account_id"))
    return wanted.join(best, ["name", "phone"]).select("src_id", "level", "n", "account_id")
