"""Exact duplicates by distributed MSD radix partitioning.

All texts start as one group. Each round splits every group by its texts' next bytes (a digit of 256 bytes, then of
16 times as many each round, so the number of rounds follows the logarithm of the longest text). A group of one is
done, a group whose texts have ended holds equal texts; only the others go on, with the bytes not yet compared. Texts
are compared by their bytes; the digest is only reported, and tells rows with one doc_id apart.

A round is an aggregate of one row per group and digit, combined before the shuffle, so that a group with a third of
all rows reaches a task as a few rows; the rows are then joined with the groups that go on. Both sides are read from
tables and the join is a sort-merge join at every size, which adaptive execution can split where a group is hot.

Texts are equal when they are identical after each run of white space is replaced by one space; null counts as empty.
Of equal texts the smallest doc_id stays. Rows of one text and one doc_id are all ``kept`` or none is; rows with a null doc_id
group like others, are kept only if the whole group has none, and never give their id to a group that has one.
``without_copies`` leaves one row of each group: of several kept ones that whose columns have the least hash. An empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.llm import bitmaps
from pedalflow.llm.scratch import stored

FIRST_DIGIT, DIGIT_GROWTH = 256, 16
# A run of white space other than one space, which stays what it is.
WHITE_SPACE = "[\\x09-\\x0D][\\x20\\x09-\\x0D]*|\\x20[\\x20\\x09-\\x0D]+"


def normal_bytes(text: str = "text") -> Column:
    return F.encode(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE, " "), "UTF-8")


def _split(rows: DataFrame, digit: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their digit, and the groups of two or more among (group, digit)."""
    size = F.octet_length("rest")
    cut = rows.withColumns({"_digit": F.substring("rest", 1, digit), "_ended": size <= digit})
    groups = _groups(cut, ["group", "_digit", "_ended"])
    return cut, groups


def _groups(cut: DataFrame, keys: list[str]) -> DataFrame:
    # A text is in one group, so its digest names the group, whatever ids repeat.
    label = F.min("text_sha256")
    made = cut.groupBy(*keys).agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"), label.alias("_label")
    )
    return stored(made.filter("group_size > 1"), "radix-groups")


def exact_groups(docs: DataFrame, first_digit: int = FIRST_DIGIT) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every row of ``docs`` (``doc_id``, ``text``)."""
    whole = docs.select("doc_id", normal_bytes().alias("rest"))
    size = F.octet_length("rest")
    # The first round reads all texts; it needs no more of them than digit and digest.
    heads = stored(
        whole.select(
            "doc_id",
            F.sha2("rest", 256).alias("text_sha256"),
            F.substring("rest", 1, first_digit).alias("_digit"),
            (size <= first_digit).alias("_ended"),
        ),
        "radix-heads",
    )
    groups = _groups(heads, ["_digit", "_ended"])
    done = [heads.filter("_ended").join(groups.filter("_ended"), ["_digit", "_ended"]).select(*_DONE)]

    going = groups.filter("NOT _ended").select("_digit", F.col("_label").alias("group"))
    # Most texts are alone with their first digit; they are passed over before the shuffle. Whether a text is longer is told
    # with that, as a filter of its own would normalise each text once more.
    digit = F.coalesce(F.substring("rest", 1, first_digit), F.lit(b""))  # never null, which the join would test on its own
    cut = whole.withColumns({"_digit": digit, "_longer": size > first_digit})
    chance = bitmaps.with_chance(cut, [F.col("_digit")], bitmaps.pages(going.select("_digit")), "_chance")
    active = stored(
        chance.filter(F.when(F.col("_chance"), F.col("_longer")).otherwise(False))
        .join(going.hint("merge"), "_digit")
        .select("doc_id", F.sha2("rest", 256).alias("text_sha256"), "group", _from("rest", first_digit)),
        "radix-active",
    )
    digit = first_digit * DIGIT_GROWTH
    while not active.isEmpty():
        cut, groups = _split(active, digit)
        joined = stored(
            cut.join(groups.hint("merge"), ["group", "_digit", "_ended"]).select(
                *_DONE, "_ended", F.col("_label").alias("group"), _from("rest", digit)
            ),
            "radix-active",
        )
        done.append(joined.filter("_ended").select(*_DONE))
        active = joined.filter("NOT _ended").select("doc_id", "text_sha256", "group", "rest")
        digit *= DIGIT_GROWTH

    copies = done[0]
    for more in done[1:]:
        copies = copies.unionByName(more)
    copies = copies.distinct().select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), "keep_id", "group_size"
    )
    same_row = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_sha256") == F.col("_sha"))
    rows = heads.select("doc_id", "text_sha256").join(copies, same_row, "left")
    keep = F.when(F.col("_sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


_DONE = ("doc_id", "text_sha256", "keep_id", "group_size")


def _from(column: str, digit: int) -> Column:
    return F.expr(f"substring({column}, {digit + 1})").alias("rest")


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs``, with all its columns, for each group of equal texts."""
    per_row = exact_groups(docs).groupBy("doc_id", "text_sha256").agg(F.bool_and("kept").alias("tied"), F.count("*").alias("n"))
    gone = stored(
        per_row.filter("NOT tied OR n > 1").select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha"), "tied"),
        "copies",
    )
    # Columns of any name may come along, so they are packed away from those of the join.
    packed = docs.select(F.struct("*").alias("row"))
    # Few rows have an id of those that go; the texts of the others are not looked at.
    named = bitmaps.with_chance(packed, [F.col("row.doc_id")], bitmaps.pages(gone.select("gone_id")), "named")
    hashed = named.withColumn("own_sha", F.when(F.col("named"), F.sha2(normal_bytes("row.text"), 256)))
    chance = bitmaps.with_chance(hashed, [F.col("row.doc_id"), F.col("own_sha")], bitmaps.pages(gone.drop("tied")), "chance")
    marked = chance.withColumn("may_go", F.col("named") & F.col("chance"))
    same = F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.col("own_sha") == F.col("gone_sha"))
    judged = marked.filter("may_go").select("row", "own_sha").join(gone, same, "left").filter("tied IS NULL OR tied")
    judged = stored(judged.select("row", "tied", "gone_id", "gone_sha"), "judged")
    left = judged.filter("tied IS NULL").select("row")
    # Rows that tie are combined where they are read, so many of them are one row from each task.
    first = F.min_by("row", F.xxhash64(F.to_json("row")))
    one = judged.filter("tied").groupBy("gone_id", "gone_sha").agg(first.alias("row")).select("row")
    return marked.filter("NOT may_go").select("row").unionByName(left).unionByName(one).select("row.*")
