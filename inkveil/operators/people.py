"""Listed people: homonyms, name orders, patterns, join keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkveil.functions import grammar
from inkveil.functions.grammar import MAX_NAMES, PLAIN_WORD


def terms(people: DataFrame) -> DataFrame:
    """`person_id, term` for every name and surname, upper-cased."""
    return people.select(
        "person_id", F.explode(F.concat("names", F.array("surname"))).alias("term")
    ).withColumn("term", F.upper("term"))


def shared_terms(people: DataFrame) -> DataFrame:
    """Terms of at least two people. Counted, not paired: no pair of people is built."""
    return (
        terms(people)
        .groupBy("term")
        .agg(F.min("person_id").alias("_lo"), F.max("person_id").alias("_hi"))
        .filter("_lo < _hi")
        .select("term")
    )


def with_homonyms(people: DataFrame) -> DataFrame:
    """Add `has_homonym`. People to be kept neither are nor make homonyms."""
    listed = people.filter(~F.col("keep"))
    marked = (
        terms(listed)
        .join(shared_terms(listed), "term", "left_semi")
        .select("person_id")
        .distinct()
        .withColumn("has_homonym", F.lit(True))
        .withColumn("keep", F.lit(False))
    )
    return people.join(marked, ["person_id", "keep"], "left").withColumn(
        "has_homonym", F.coalesce("has_homonym", F.lit(False))
    )


def variants(people: DataFrame, *extra: str) -> DataFrame:
    """Every ordered choice of a person's names, longest first.

    `person_id, variant_rank, terms`; homonyms only have the full-length choices. Each
    step adds one of the names left or stops, so ten names (9.9 million choices) unfold
    row by row and never sit in one array.
    """
    level = people.withColumn("n", F.size("names")).withColumn(
        "path", F.array().cast("array<int>")
    ).withColumn("open", F.lit(True))
    for _ in range(MAX_NAMES):
        rest = F.array_except(F.sequence(F.lit(0), F.col("n") - 1), F.col("path"))
        steps = F.when(F.col("open"), F.concat(rest, F.array(F.lit(-1)))).otherwise(
            F.array(F.lit(-1))
        )
        grown = F.col("step") >= 0
        level = (
            level.withColumn("step", F.explode_outer(steps))
            .withColumn("open", grown)
            .withColumn(
                "path", F.when(grown, F.concat("path", F.array("step"))).otherwise(F.col("path"))
            )
            .drop("step")
        )
    chosen = level.filter(
        F.when(F.col("has_homonym"), F.size("path") == F.col("n")).otherwise(
            F.size("path") > 0
        )
    )
    return chosen.select(
        "person_id",
        variant_rank(F.col("path"), F.col("n"), F.col("has_homonym")).alias("variant_rank"),
        F.transform("path", lambda i: F.get("names", i)).alias("terms"),
        *extra,
    )


def variant_rank(path: Column, n: Column, full_only: Column) -> Column:
    """Place of a choice among all choices: longer ones before, then by list order.

    Computed from the choice itself, so no sort over the choices of a person is needed.
    """
    size = F.size(path)

    def arrangements(k: Column) -> Column:  # n * (n - 1) * ... , k factors
        return F.when(k < 1, F.lit(1).cast("bigint")).otherwise(
            F.aggregate(
                F.sequence(F.lit(0), F.greatest(k, F.lit(1)) - 1),
                F.lit(1).cast("bigint"),
                lambda acc, i: acc * (n - i),
            )
        )

    longer = F.when(
        full_only | (size >= n), F.lit(0).cast("bigint")
    ).otherwise(
        F.aggregate(
            F.sequence(F.least(size + 1, n), n),
            F.lit(0).cast("bigint"),
            lambda acc, k: acc + arrangements(k),
        )
    )

    def weight(i: Column) -> Column:
        # how many unused names with a smaller index could stand at place i
        smaller = F.get(path, i) - F.size(
            F.filter(F.slice(path, 1, i), lambda p: p < F.get(path, i))
        )
        # ways to fill the places after it
        tail = F.when(size - i - 1 < 1, F.lit(1).cast("bigint")).otherwise(
            F.aggregate(
                F.sequence(F.lit(1), F.greatest(size - i - 1, F.lit(1))),
                F.lit(1).cast("bigint"),
                lambda acc, j: acc * (n - i - j),
            )
        )
        return smaller * tail

    same = F.aggregate(
        F.sequence(F.lit(0), size - 1), F.lit(0).cast("bigint"), lambda acc, i: acc + weight(i)
    )
    return longer + same + 1


def patterns(people: DataFrame) -> DataFrame:
    """Add `pattern` to people with `has_homonym`."""
    return people.withColumn(
        "pattern",
        grammar.person_pattern(F.col("names"), F.col("surname"), F.col("has_homonym")),
    )


def word_key(some_words: Column) -> Column:
    """Words in lower case, in any order, under one key."""
    return F.array_join(F.sort_array(some_words), " ")


def entries(people: DataFrame) -> DataFrame:
    """People as search entries: `ord, keep, plain_name, pattern, mark,
    anchor, keys, width, plain` (`plain`: can only be found as capitalised words), and `names,
    surname, full_only`, of which the pattern is made.

    Keys are looked up among the words of a text before the pattern is tried.
    * A person without homonym is found with any of the names next to the surname: keys
      are those pairs of adjacent words. No term is shared, so a pair leads to one person.
    * A homonym is found with all terms only: the key is the sorted list of all words of
      the nominative and `width` their number, so people that merely share a name or a
      surname, however many, are not tried.
    Same names and surname in any order of names give the same pattern twice; the first
    in the list always wins, the others are left out.
    """
    listed = patterns(with_homonyms(people))
    same = ["keep", "_bag", "surname"]
    first = (
        listed.withColumn("_bag", F.array_join(F.sort_array("names"), ":"))
        .groupBy(*same)
        .agg(F.min(F.struct("person_id", "names", "has_homonym", "pattern")).alias("p"))
        .select("keep", "surname", "p.*")
    )
    name_words = F.transform("names", lambda n: grammar.words(F.lower(n)))
    last_words = grammar.words(F.lower("surname"))
    pairs = F.flatten(
        F.transform(
            name_words,
            lambda w: F.array(
                word_key(F.array(F.get(w, F.size(w) - 1), F.get(last_words, 0))),
                word_key(F.array(F.get(last_words, F.size(last_words) - 1), F.get(w, 0))),
            ),
        )
    )
    all_words = F.concat(F.flatten(name_words), last_words)
    tight = F.col("has_homonym")
    return first.select(
        # kept people come before all others
        F.when(F.col("keep"), -F.col("person_id")).otherwise(F.col("person_id")).alias("ord"),
        "keep",
        F.get("names", 0).alias("plain_name"),
        "pattern",
        F.lit(None).cast("string").alias("mark"),
        grammar.surname_pattern(F.col("surname")).alias("anchor"),
        F.array_distinct(
            F.when(tight, F.array(word_key(all_words))).otherwise(pairs)
        ).alias("keys"),
        F.when(tight, F.size(all_words)).otherwise(2).alias("width"),
        F.forall(
            F.concat("names", F.array("surname")), lambda t: t.rlike(PLAIN_WORD)
        ).alias("plain"),
        "names",
        "surname",
        tight.alias("full_only"),
    )


def dictionary_entries(dictionary: DataFrame) -> DataFrame:
    """Dictionary names as search entries; names that differ in the case of their later
    letters only give the same pattern, of which the first wins."""
    name = F.col("name")
    first = (
        dictionary.withColumn(
            "_same",
            F.concat(
                F.substring(name, 1, 1), grammar.ascii_lower(F.substring(name, 2, 1 << 30))
            ),
        )
        .groupBy("_same")
        .agg(F.min(F.struct("dict_id", "name")).alias("d"))
        .select("d.*")
    )
    plain = name.rlike(PLAIN_WORD)
    parts = grammar.words(name)
    by_length = F.transform(parts, lambda w: F.struct(F.length(w).alias("n"), w.alias("word")))
    longest = F.element_at(F.sort_array(by_length), -1)["word"]
    return first.filter(name.rlike(grammar.WORD)).select(
        F.col("dict_id").cast("bigint").alias("ord"),
        F.lit(False).alias("keep"),
        name.alias("plain_name"),
        F.when(~plain, grammar.dictionary_pattern(name)).alias("pattern"),
        F.when(plain, name).alias("mark"),
        grammar.term_pattern(name).alias("anchor"),
        F.array(F.lower(longest)).alias("keys"),
        F.lit(1).alias("width"),
        plain.alias("plain"),
        F.lit(None).cast("array<string>").alias("names"),
        F.lit(None).cast("string").alias("surname"),
        F.lit(None).cast("boolean").alias("full_only"),
    )
