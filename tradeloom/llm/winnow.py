"""Document fingerprints by winnowing, in DataFrame expressions only.

The k-grams run over units: what stands between white space, or, where that is longer
than ``LONG`` as in scripts that write without spaces, its single characters. Every unit
is hashed once; a k-gram's hash is made of the hashes of its units. Of each window of ``WINDOW``
k-grams the smallest hash is chosen, of equal ones the rightmost, and kept with its
place. Two texts that share ``K + WINDOW - 1`` units in a row share a chosen k-gram.

A chosen k-gram is one integer: 33 bits of hash, then 31 bits that fall as the place
rises, so that the smaller integer is the rightmost smallest hash. Hash and place come
back by shifting. The minimum of a window is taken from minima of four and two.

Arrays are bound as variables of lambdas (``let``); a column of the row would be copied
each time that an element is read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import narrow, stored

K = 4
WINDOW = 8  # a product of fours and twos, see WAYS
WAYS = (4, 2)
LONG = 24
LAST = 2147483647


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def minima(values: Column, stride: int, ways: int) -> Column:
    """At each place the least of ``ways`` values, ``stride`` places apart."""
    last = F.size(values) - 1 - stride * (ways - 1)
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.least(*[F.get(values, i + stride * j) for j in range(ways)])
    )


def window_minima(values: Column) -> Column:
    """Minima of all windows; of fewer values than a window the one minimum."""
    def step(array: Column, stride: int, ways: tuple[int, ...]) -> Column:
        if not ways:
            return F.array_distinct(array)
        return let(minima(array, stride, ways[0]), lambda a: step(a, stride * ways[0], ways[1:]))

    return F.when(F.size(values) <= WINDOW, F.array(F.array_min(values))).otherwise(step(values, 1, WAYS))


def packed(code: Column, place: Column) -> Column:
    return F.shiftleft(code, 31).bitwiseOR((F.lit(LAST) - place).cast("bigint"))


def grams(codes: Column) -> Column:
    """Packed k-grams of unit hashes; fewer units than K are one k-gram."""
    many = F.transform(
        F.sequence(F.lit(0), F.size(codes) - K),
        lambda i: packed(F.xxhash64(*[F.get(codes, i + j) for j in range(K)]), i),
    )
    few = F.array(packed(F.aggregate(codes, F.lit(0).cast("bigint"), lambda a, c: F.xxhash64(a, c)), F.lit(0)))
    return F.when(F.size(codes) >= K, many).otherwise(few)


def winnowed(text: Column) -> Column:
    """Chosen k-grams of a text, in the order of their places.

    A text without any unit has one k-gram, that of its characters; the empty text none.
    """
    spaced = text
    for white in "\t\n\r\x0b\x0c":
        spaced = F.replace(spaced, F.lit(white), F.lit(" "))
    words = F.filter(F.split(spaced, " "), lambda w: F.octet_length(w) > 0)
    codes = F.flatten(F.transform(words, lambda w: F.when(F.length(w) <= LONG, F.array(F.xxhash64(w))).otherwise(
        F.transform(F.split(w, ""), lambda c: F.xxhash64(c)))))
    codes = let(codes, lambda c: F.when(F.size(c) > 0, c).otherwise(F.array(F.xxhash64(text))))
    chosen = let(codes, lambda c: let(grams(c), window_minima))
    return F.when(F.octet_length(text) == 0, F.array().cast("array<bigint>")).otherwise(chosen)


def hashes(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, 31)))


def places(chosen: Column) -> Column:
    """Places of chosen k-grams: the number of their first unit."""
    return F.transform(chosen, lambda x: F.lit(LAST) - x.bitwiseAND(F.lit(LAST)).cast("int"))


def digest(chosen: Column) -> Column:
    """One string for all chosen hashes and places."""
    return F.sha2(F.array_join(chosen.cast("array<string>"), ","), 256)


def likeness(a: Column, b: Column) -> Column:
    """Shared part of two sets of hashes, 0 to 1; two empty sets are alike."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared.cast("double") / total)


def fingerprints(documents: DataFrame) -> DataFrame:
    """All columns with ``chosen`` (hash, place) for every row; null texts are empty."""
    chosen = winnowed(F.coalesce("text", F.lit("")))
    return documents.withColumn("chosen", F.transform(chosen, lambda x: F.struct(
        F.shiftright(x, 31).alias("hash"), (F.lit(LAST) - x.bitwiseAND(F.lit(LAST)).cast("int")).alias("place")
    )))


def following(keys: DataFrame) -> DataFrame:
    """doc_id, id0, code, n_chars and ``next`` (id0 and code of the next key) for each key in ascending order; after the last comes the first.

    Keys are dealt by ranges; each range looks ahead in itself, and the first key of the
    next range, one small row a range, completes its last row.
    """
    partitions = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("code")]
    ranges = stored(keys.repartitionByRange(partitions, *order).withColumn("part", F.spark_partition_id()), "order")
    own = F.struct("id0", "code")
    inside = Window.partitionBy("part").orderBy(*order)
    firsts = ranges.groupBy("part").agg(F.min_by(own, F.struct(F.col("doc_id").isNotNull(), "doc_id", "code")).alias("start"))
    parts = Window.orderBy("part")  # one row a range
    starts = firsts.select("part", F.coalesce(F.lead("start").over(parts), F.first("start").over(parts)).alias("start"))
    ahead = ranges.withColumn("next", F.lead(own).over(inside)).join(F.broadcast(starts), "part")
    return ahead.select("doc_id", "id0", "code", "n_chars", F.coalesce("next", "start").alias("next"))


def edit_likeness(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last ``floor(n_chars / 4)`` code points replaced by as many
    (or all) from the start of the next document in ascending ``doc_id``. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts are empty. Null ids come first. Rows of one id follow in the order of a
    hash of their text; repeated rows of one id and text are one place in that order and
    each give a row. A single document is its own next one. Extra columns are not read.

    Texts move once, by their key; what a document gives to the one before it (at most a
    quarter of that one's length, and its own hashes) moves once more.
    """
    texts = narrow(documents, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    texts = texts.withColumn("id0", F.coalesce("doc_id", F.lit(0))).withColumn("code", F.xxhash64("doc_id", "text"))
    keys = texts.select("doc_id", "id0", "code", F.length("text").alias("n_chars")).distinct()
    texts = texts.select("id0", "code", "text")  # both joins below read one exchange of it
    order = following(keys)
    gives = stored(order.select(
        F.col("next.id0").alias("id0"), F.col("next.code").alias("code"),
        F.col("id0").alias("to_id0"), F.col("code").alias("to_code"), "doc_id", F.floor(F.col("n_chars") / 4).cast("int").alias("need"),
    ), "gives")
    donors = texts.join(gives, ["id0", "code"]).select(
        "to_id0", "to_code", "doc_id", F.expr("substring(text, 1, need)").alias("gift"), hashes(winnowed(F.col("text"))).alias("next_set")
    ).dropDuplicates(["to_id0", "to_code"])
    both = texts.join(donors, (texts["id0"] == donors["to_id0"]) & (texts["code"] == donors["to_code"]))
    kept = F.length("text") - F.floor(F.length("text") / 4).cast("int")
    edited = both.select("doc_id", "text", "next_set", F.length("text").cast("bigint").alias("n_chars"), F.concat(
        F.substring("text", F.lit(1), kept), F.col("gift")).alias("edited"))
    made = edited.select(
        "doc_id", "n_chars", "next_set", F.sha2("edited", 256).alias("edited_sha256"),
        winnowed(F.col("text")).alias("chosen"), winnowed(F.col("edited")).alias("edited_chosen"),
    )
    sets = made.select(
        "doc_id", "n_chars", "edited_sha256", digest(F.col("chosen")).alias("fingerprint"),
        digest(F.col("edited_chosen")).alias("edited_fingerprint"), "next_set",
        hashes(F.col("chosen")).alias("own"), hashes(F.col("edited_chosen")).alias("other"),
    )
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_set")).alias("near_next"),
    )
