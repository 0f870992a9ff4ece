"""Line dedup across documents: exact set-similarity join on line tokens, in DataFrame functions.

A line is the set of its words (split at ASCII white space, case kept). In the order of document
id, row and line number, a line goes when an earlier line has a Jaccard similarity of the threshold
or more with it, whether that one stays or goes.

1. Rarity: words are counted over all lines in a hashed table of fixed size. A word's number has
   the logarithm of its count in the upper bits and its hash below, so sorted numbers are ordered
   by rarity, and equal numbers are equal words.
2. Classes: lines of equal sets are one class; its first line stands for it, others go.
3. Prefix filter: of n words sorted by rarity, similar sets share one of the first
   n - ceil(t n) + 1, and the smaller set has it among its first n - ceil(2 t n / (1 + t)) + 1. Sets
   meet at equal prefix words; length, positional and bitmap filters (the bits in which two maps
   differ cannot outnumber the words that only one set has) leave few pairs.
4. Frequent words: similar sets also share a second word of prefixes that are one word longer. Sets
   that meet at a word of more than `GROUP` sets meet at two words instead.
5. Verification of whole sets. Pairs are emitted only at keys of at most `GROUP` sets. At two words
   of more sets, these are dealt into blocks of about `GROUP`, in which a left semi join with the
   whole sets stops at the first earlier similar one. Each line first looks in its own block at the
   least of its keys; the few that find none are then compared with all blocks at all their keys.
   No pairs are emitted, however large the group, and a join's key is one block of it.

Defined cases: null text counts as empty; a line without words is kept and never matches; null ids
come last; repeated rows lose their lines to the first of them; very long lines and texts are read
whole; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bucketed, release, shuffles_removed, stored

THRESHOLD = 0.8
GROUP = 512  # sets with a prefix word, up to which pairs are emitted
SLOTS = 1 << 18  # of the table of counts: 256 KB, whatever the size of the corpus
STEPS = 23  # of a size class in a power of e: 4.4 % each, exact below 23 words
_BITS, _MORE = 45, 64  # of the parts of a map
_FIELD = 512  # size classes, and shares of a set before a word
_HASH = (1 << 57) - 1
_EMPTY = -7444071767201028348  # xxhash64 of the empty string with the default seed
_SPACES = "\t\r\x0b\x0c"


def lines_of(docs: DataFrame, row_col: str, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, no, line) of every line; the text without one has one empty line."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{row_col}`").cast("long").alias("row"),
        F.posexplode(F.split(text, "\n")).alias("no", "line"))


def words_of(line: Column) -> Column:
    """Parts between spaces, empty ones included; other white space, if any, becomes spaces first."""
    other = F.lit(False)
    for space in _SPACES:
        other = other | F.contains(line, F.lit(space))
    return F.split(F.when(other, F.translate(line, _SPACES, "    ")).otherwise(line), " ")


def word_hashes(line: Column) -> Column:
    """Distinct hashes of the words of a line."""
    return F.array_remove(F.array_distinct(F.transform(words_of(line), lambda w: F.xxhash64(w))),
                          F.lit(_EMPTY))


def rarity(lines: DataFrame) -> Column:
    """The table of counts as one value: a byte for each slot, 64 and the logarithm of its count."""
    counts = (lines.select(F.explode(words_of(F.col("line"))).alias("word"))
              .groupBy(F.xxhash64("word").bitwiseAND(SLOTS - 1).alias("slot"))
              .agg(F.count("*").alias("times")))
    upper = F.char(64 + F.floor(F.log2(F.coalesce("times", F.lit(1)))))
    whole = (lines.sparkSession.range(SLOTS).withColumnRenamed("id", "slot")
             .join(counts, "slot", "left")
             .select(F.struct("slot", upper.alias("upper")).alias("s"))
             .agg(F.array_sort(F.collect_list("s")).alias("all"))
             .select(F.array_join(F.transform("all", lambda s: s["upper"]), "").alias("table")))
    with shuffles_removed(lines.sparkSession):
        return F.lit(bytearray(whole.select("table").first()["table"].encode("ascii")))


def numbers(line: Column, table: Column) -> Column:
    """The numbers of the distinct words of a line, rarest first."""
    def number(h: Column) -> Column:
        slot = h.bitwiseAND(SLOTS - 1).cast("int") + 1
        upper = F.ascii(F.substring(table, slot, F.lit(1))).cast("long") - 64
        return F.shiftleft(upper, 57).bitwiseOR(h.bitwiseAND(_HASH))

    return F.sort_array(F.transform(word_hashes(line), number))


def flipped(words: Column, start: int, width: int) -> Column:
    """`width` bits, from `start` on, of a map of 109 bits in which each word flips one."""
    def flip(bits: Column, x: Column) -> Column:
        at = (F.shiftright(x, 6) % (_BITS + _MORE)).cast("int") - start
        return F.when(at.between(0, width - 1), bits.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), at))).otherwise(bits)

    return F.aggregate(words, F.lit(0).cast("long"), flip)


def size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) * STEPS).cast("long")


def least_size(size: Column) -> Column:
    return F.exp(size / STEPS)


def classes(docs: DataFrame, row_col: str, id_col: str, text_col: str,
            threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, first) and (id, n, map, second, prefix) of each distinct set; `first` is its first place.

    `second` is the other part of its map.
    """
    lines = lines_of(docs, row_col, id_col, text_col)
    numbered = lines.select("doc_id", "row", "no", numbers(F.col("line"), rarity(lines)).alias(
        "set")).where(F.size("set") > 0)
    n = F.size("set")
    kept = (n - F.ceil(n * F.lit(threshold) - 1e-9) + 2).cast("int")
    parts = [flipped(F.col("set"), 0, _BITS).alias("map"),
             flipped(F.col("set"), _BITS, _MORE).alias("second")]
    described = numbered.select(
        F.xxhash64("set").alias("h1"), F.xxhash64("set", F.lit(7)).alias("h2"),
        F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "no").alias("first"),
        F.struct(n.alias("n"), *parts, F.slice("set", F.lit(1), kept).alias("prefix")).alias(
            "about"))
    one = described.groupBy("h1", "h2").agg(F.min("first").alias("first"),
                                            F.first("about").alias("about"))
    whole = stored(one.select(F.monotonically_increasing_id().alias("id"), "first", "about.*"),
                   "lines")
    return stored(whole.select("id", "first"), "places"), whole.drop("first")


def similar(a: Column, b: Column, threshold: float) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common >= F.lit(threshold) * (F.size(a) + F.size(b) - common) - 1e-9


def packed(n: Column, at: Column, fore: Column, bits: Column) -> Column:
    """Of a set that meets others at a word: map, size class, share before the word, and whether
    the word is in the prefix that a smaller set needs (the sign), in one number."""
    share = F.floor(at * _FIELD / n).cast("long")
    about = bits.bitwiseOR(F.shiftleft(size_class(n), _BITS)).bitwiseOR(
        F.shiftleft(share, _BITS + 9))
    return F.when(fore, about.bitwiseOR(-(1 << 63))).otherwise(about)


def unpacked(rows: DataFrame) -> DataFrame:
    """`rows` with `size`, `least` (words a set has at least) and `left` (that it has at most from
    the word on) for the filters."""
    about = F.col("about")
    size = F.shiftright(about, _BITS).bitwiseAND(_FIELD - 1)
    share = F.shiftright(about, _BITS + 9).bitwiseAND(_FIELD - 1)
    return rows.withColumn("size", size).withColumns({
        "least": least_size(F.col("size")),
        "left": least_size(F.col("size") + 1) * (1 - share / _FIELD),
        "map": about.bitwiseAND((1 << _BITS) - 1)})


def likely(threshold: float) -> Column:
    """Length, positional and bitmap filters on rows `a` and `b` that meet at their first key.

    Sizes are known by class, so a filter takes the bound that drops no similar pair.
    """
    bits = (F.bit_count(F.col("a.map").bitwiseXOR(F.col("b.map")))
            + F.bit_count(F.col("a.second").bitwiseXOR(F.col("b.second"))))
    least = F.col("a.least") + F.col("b.least")
    share = (1 - threshold) / (1 + threshold)  # of both sizes: words that only one set has
    return ((F.abs(F.col("a.size") - F.col("b.size")) <= STEPS * math.log(1 / threshold) + 1 + 1e-6)
            & (F.least("a.left", "b.left") >= (1 - share) / 2 * least - 1e-6)
            & (bits <= share * math.exp(1 / STEPS) * least + 1e-6))


def first_words(n: Column, threshold: float) -> Column:
    """How many of the rarest words of a set hold the first it has in common with a similar set
    of its own or a larger size class."""
    both = n + least_size(size_class(n))
    return n - F.ceil(both * F.lit(threshold / (1 + threshold) * (1 - 1e-9))) + 1


def met(rows: DataFrame, threshold: float, group: int) -> tuple[DataFrame, DataFrame]:
    """Stored candidate pairs (a, b) of keys of at most `group` sets, and (key, id, about, second,
    sets) of the others. `rows` holds (key, id, about, second)."""
    # the filter and the columns are the same for all readers, who thus share one shuffle
    counted = rows.where("key is not null").withColumn(
        "sets", F.count("*").over(Window.partitionBy("key")))
    few = unpacked(counted.where(F.col("sets").between(2, group)))
    a, b = few.where("about < 0").alias("a"), few.alias("b")
    smaller = (F.col("a.size") < F.col("b.size")) | (
        (F.col("a.size") == F.col("b.size")) & (F.col("b.about") < 0)
        & (F.col("a.id") < F.col("b.id")))
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & smaller & likely(threshold)).select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    # one job, so that the prefix words are dealt out once
    many = counted.where(F.col("sets") > group)
    found = stored(pairs.unionByName(many, allowMissingColumns=True), "pairs")
    # stored alone, so that its size says how to join it
    return (found.where("a is not null").select("a", "b"),
            stored(found.where("id is not null").drop("a", "b"), "many"))


def candidates(sets: DataFrame, threshold: float, group: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) to verify, and (key, id, about, second, sets) of keys of more sets.

    Empties the table `sets` when it has been read.
    """
    n, at = F.col("n"), F.col("at")
    fore = first_words(n, threshold)
    plain = (n - F.ceil(n * threshold - 1e-9) + 1).cast("int")
    by_word = sets.select("id", "n", "map", "second", F.posexplode(
        F.slice("prefix", F.lit(1), plain)).alias("at", "key"))
    pairs, hot = met(by_word.select(
        "key", "id", packed(n, at, at < fore, F.col("map")).alias("about"), "second"),
        threshold, group)
    # sets that may share no more than one word with a similar one have a key without a second
    tail = F.slice("prefix", at + 2, F.size("prefix"))
    alone = n * threshold <= 1
    tail = F.when(alone, F.concat(tail, F.array(F.lit(0).cast("long")))).otherwise(tail)
    # the words are at most 1/group of all prefix words, so the sets stay where they are
    words = stored(hot.select(F.col("key").alias("word")).distinct(), "words")
    by_two = sets.select("id", "n", "map", "second", "prefix", F.posexplode(
        F.slice("prefix", F.lit(1), plain)).alias("at", "word")).join(words, "word").select(
        "id", "n", "map", "second", "at", "word", F.posexplode(tail).alias("step", "next"))
    more, many = met(by_two.select(
        F.xxhash64("word", "next").alias("key"), "id",
        packed(n, at, (at < fore) & ((at + F.col("step") < fore) | alone), F.col("map")).alias(
            "about"), "second"), threshold, group)
    release(sets)
    return stored(pairs.unionAll(more).distinct(), "candidates"), many


def whole_sets(docs: DataFrame, ids: DataFrame, places: DataFrame, row_col: str,
               text_col: str) -> DataFrame:
    """(id, first, set) of the classes `ids`, read from the texts of their first lines.

    A table bucketed by id, so that joins read it without a shuffle.
    """
    by_row = ids.join(places, "id").groupBy(F.col("first.row").alias("row")).agg(
        F.map_from_entries(F.collect_list(F.struct("first.no", F.struct("id", "first")))).alias(
            "at"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return bucketed(
        docs.select(F.col(f"`{row_col}`").cast("long").alias("row"), text.alias("text"))
        .join(by_row, "row").select("at", F.posexplode(F.split("text", "\n")).alias("no", "line"))
        .select(F.col("at")[F.col("no")].alias("at"), "line").where("at is not null")
        .select("at.id", "at.first", word_hashes(F.col("line")).alias("set")), "id", "sets")


def removed_in_pairs(pairs: DataFrame, whole: DataFrame, threshold: float) -> DataFrame:
    """Stored (id) of the later classes of the pairs that are similar."""
    early = whole.select(F.col("id").alias("a"), F.col("first").alias("fa"))
    late = whole.select(F.col("id").alias("b"), F.col("first").alias("fb"))
    turn = F.col("fa") < F.col("fb")
    ordered = stored(pairs.join(early, "a").join(late, "b").select(
        F.when(turn, F.col("a")).otherwise(F.col("b")).alias("early"),
        F.when(turn, F.col("b")).otherwise(F.col("a")).alias("late"),
        F.least("fa", "fb").alias("place")), "ordered")

    def matched(candidates: DataFrame) -> DataFrame:
        sets_of = whole.select("id", "set")
        one = sets_of.withColumnsRenamed({"id": "early", "set": "se"})
        two = sets_of.withColumnsRenamed({"id": "late", "set": "sl"})
        return candidates.join(one, "early").join(two, "late").where(
            similar(F.col("se"), F.col("sl"), threshold)).select(F.col("late").alias("id"))

    # most lines that go are like their earliest candidate; the others are only for the rest
    earliest = ordered.groupBy("late").agg(F.min_by("early", "place").alias("early"))
    at_once = stored(matched(earliest).distinct(), "lines")
    rest = ordered.select("early", "late").join(
        at_once.withColumnRenamed("id", "late"), "late", "left_anti")
    return stored(at_once.unionAll(matched(rest)).distinct(), "lines")


def removed_in_blocks(many: DataFrame, whole: DataFrame, gone: DataFrame, threshold: float,
                      group: int) -> DataFrame:
    """(id) of the classes, beyond `gone`, that have an earlier similar one at a key of many sets."""
    blocks = F.ceil(F.col("sets") / group).cast("int")
    dealt = unpacked(many).withColumns(
        {"blocks": blocks, "block": F.pmod(F.xxhash64("id"), blocks).cast("int")})

    def with_sets(rows: DataFrame) -> DataFrame:
        # a set is joined once, however many keys it has
        at = F.collect_list(F.struct(*[c for c in rows.columns if c != "id"])).alias("at")
        return rows.groupBy("id").agg(at).join(whole, "id").select(
            "id", "first", "set", F.inline("at"))

    def matched(late: DataFrame, early: DataFrame) -> DataFrame:
        a, b = early.alias("a"), late.alias("b")
        return b.join(
            a, (F.col("a.key") == F.col("b.key")) & (F.col("a.block") == F.col("b.block"))
            & (F.col("a.first") < F.col("b.first")) & likely(threshold)
            & similar(F.col("a.set"), F.col("b.set"), threshold), "left_semi").select("id")

    # similar sets have most keys in common, so most find an earlier one at the least of them
    least = dealt.join(dealt.groupBy("id").agg(F.min("key").alias("key")), ["id", "key"])
    own = stored(matched(least.join(gone, "id", "left_anti").join(whole, "id"),
                         least.join(whole, "id")).distinct(), "lines")
    rest = stored(dealt.join(gone.unionAll(own), "id", "left_anti"), "rest")
    early = dealt.join(rest.select("key").distinct(), "key", "left_semi")
    late = with_sets(rest).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return own.unionAll(matched(late, with_sets(early)))


def removed(docs: DataFrame, places: DataFrame, sets: DataFrame, row_col: str, text_col: str,
            threshold: float, group: int) -> DataFrame:
    """(id) of the classes whose first line goes; empties the table `sets` when it has been read."""
    pairs, many = candidates(sets, threshold, group)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionAll(many.select("id"))
    whole = whole_sets(docs, ids.distinct(), places, row_col, text_col)
    gone = removed_in_pairs(pairs, whole, threshold)
    return gone.unionAll(removed_in_blocks(many, whole, gone, threshold, group)).distinct()


def kept_lines(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD, group: int = GROUP) -> DataFrame:
    """(row, kept): by row, the sorted numbers (from 0) of the lines with words that stay.

    Rows none of whose lines stay are absent. `row_col` numbers the rows of `docs`, which must be a
    table that reads the same each time.
    """
    places, sets = classes(docs, row_col, id_col, text_col, threshold)
    gone = removed(docs, places, sets, row_col, text_col, threshold, group)
    return (places.join(gone, "id", "left_anti")
            .groupBy(F.col("first.row").alias("row"))
            .agg(F.sort_array(F.collect_list("first.no")).alias("kept")))


def has_words(line: Column) -> Column:
    return F.length(F.ltrim(line, F.lit(" " + _SPACES))) > 0


def dedup(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with the lines that go cut out of the texts; null text stays null."""
    kept = kept_lines(docs, row_col, id_col, text_col, threshold)
    kept = kept.select(F.col("row").alias("__of"), F.col("kept").alias("__kept"))
    left = F.filter(F.split(F.col(f"`{text_col}`"), "\n"), lambda line, i: ~has_words(line)
                    | F.coalesce(F.array_contains(F.col("__kept"), i), F.lit(False)))
    joined = docs.join(kept, F.col(f"`{row_col}`") == F.col("__of"), "left")
    return joined.withColumn(text_col, F.array_join(left, "\n")).drop("__of", "__kept")
