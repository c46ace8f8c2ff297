"""Spelling variants by permuterm rotations.

A word and its terminator are written as a ring; cut open behind the edited
character, two words that differ by a replacement begin alike up to their last
character, and a word that lacks the character is that beginning as a whole. So
every word gives all its rotations, and all rotations without their last
character; sorted, those that agree stand together: at most one whole rotation and
at most one word for each letter of the alphabet. A scan over a group gives each
member how many neighbours it has there and its most frequent other member, so
that a group's rows grow with its members, not with its pairs. All of it is
DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from contactmine.llm.scratch import materialised

END = "$"  # never in a word
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_length: int = 7,
    least_count: int = 2,
    thin: int = 31,
) -> DataFrame:
    """``word``, ``n``: runs of letters, A-Z lower-cased, found ``least_count`` times or more.

    One of ``thin`` runs, by checksum of id and run, loses a character first.
    """
    # Shorter runs cannot give a word that is long enough.
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[A-Za-zÀ-ÿ]{{{least_length},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("run"))
    each = each.select("_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    mark = F.crc32(F.concat("_id", F.lit(":"), "run"))
    place = (F.col("mark") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    word = F.when(F.col("mark") % thin == 0, cut).otherwise(F.col("run"))
    words = each.select("run", mark.alias("mark")).select(word.alias("word"))
    words = words.where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """``key``, ``edited``, ``single``, ``n``: whole rotations (``edited`` empty) and those without their last character.

    ``single``: the character is not followed by an equal one; of equal
    neighbours only the last counts as the one that another word lacks.
    """
    size = F.char_length("word")
    each = words.select("word", "n", F.explode(F.sequence(F.lit(0), 2 * size)).alias("k"))
    at = F.expr("k div 2").cast("int")
    skips = F.col("k") % 2
    head = F.substring("word", F.lit(1), at)
    edited = F.substring("word", at + 1, skips.cast("int"))
    after = F.substring("word", (at + 1 + skips).cast("int"), size)
    return each.select(
        F.concat(after, F.lit(END), head).alias("key"),
        edited.alias("edited"),
        (F.substring("word", at + 2, F.lit(1)) != edited).alias("single"),
        "n",
    )


def _word_of(key: Column, edited: Column) -> Column:
    return F.concat(F.substring_index(key, END, -1), edited, F.substring_index(key, END, 1))


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best`` (n, word): of every word that has a near word.

    Near words differ by exactly one inserted, deleted or replaced character;
    ``best`` is the most frequent one, the smallest of ties.
    """
    named = rotations(words).withColumn("word", _word_of(F.col("key"), F.col("edited")))
    order = Window.partitionBy("key").orderBy(F.desc("n"), "word")
    group = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = F.col("edited") == ""
    this = F.struct((-F.col("n")).alias("n"), "word")
    scanned = named.withColumns(
        {
            "members": F.count(F.lit(1)).over(group),
            "singles": F.sum((~whole & F.col("single")).cast("int")).over(group),
            "wholes": F.sum(whole.cast("int")).over(group),
            "rank": F.row_number().over(order),
            "first": F.first(this).over(group),
            "second": F.nth_value(this, 2).over(group),
        }
    ).where("members > 1")
    best = F.when(F.col("rank") == 1, F.col("second")).otherwise(F.col("first"))
    near = F.when(whole, F.col("singles")).otherwise(
        F.col("members") - F.col("wholes") - 1 + F.when(F.col("single"), F.col("wholes")).otherwise(0)
    )
    found = scanned.select("word", near.alias("near"), best.alias("best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: forms followed to the last, twice as far each round."""
    found = materialised(forms.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = found.join(further, "root", "left")
        found = materialised(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        )
        if found.where("moved").isEmpty():
            return found.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_length: int = 7,
    least_count: int = 2,
    ratio: int = 10,
    thin: int = 31,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: one row per word.

    Words are maximal runs of ASCII and Latin-1 letters, A-Z lower-cased, of
    ``least_length`` code points and ``least_count`` occurrences at least, after
    one of ``thin`` runs (by checksum of id and run) has lost a character. The
    form is the most frequent near word (the smallest of ties) if it has
    ``ratio`` times as many occurrences; the root is where forms lead, the word
    itself without a form. Null and empty texts have no words; a null id counts
    as an empty one; repeated rows count again; other columns are ignored; an
    empty table gives an empty table. Very long texts are cut into words whole.
    """
    words = materialised(word_counts(docs, id_column, text, least_length, least_count, thin))
    near = words.join(neighbours(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"),
    )
    fits = F.col("best_n") >= ratio * F.col("n")
    formed = materialised(
        near.select(
            "word", "n", "n_near", F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")
        )
    )
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
