"""Removal of repeated and nearly repeated lines by an exact set-similarity join."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsalpha.llm.common import released, shuffles_dropped, staged

# Counters of the rarity of tokens, a power of two, and the bits of a token's number below its rarity.
COUNTERS = 1 << 18
TOKEN_BITS = 57
# Sets of more tokens than this have a second bitmap.
WIDE = 64

# White space between words besides spaces and ends of lines; few texts have any.
OTHER_SPACES = r"[\t\x0B\f\r]"

LINE = ("doc", "version", "line")


def _words(text: Column) -> Column:
    """Words of a text, letters lowered, and some empty ones: cut at single spaces, which takes no search of a pattern."""
    lowered = F.lower(text)
    return F.when(text.rlike(OTHER_SPACES), F.split(lowered, r"\s+")).otherwise(F.split(F.replace(lowered, F.lit("\n"), F.lit(" ")), " "))


def _tokens(line: Column) -> Column:
    """Distinct numbers of the words of a line, letters lowered."""
    return F.array_except(F.transform(_words(line), lambda word: F.xxhash64(word)), F.array(F.xxhash64(F.lit(""))))


def _rarity(rows: DataFrame) -> bytes:
    """How often the tokens of each counter stand in all texts, as twice the binary logarithm.

    One byte per counter, whatever the table: the cluster packs them by thousands, the driver joins the packs.
    """
    counters = rows.sparkSession.range(COUNTERS).select(F.col("id").alias("counter"), F.lit(0).cast("long").alias("n"))
    counted = (
        rows.select(F.explode(_words(F.col("text"))).alias("word"))
        .groupBy(F.xxhash64("word").bitwiseAND(COUNTERS - 1).alias("counter")).agg(F.count("*").alias("n"))
        .unionByName(counters).groupBy("counter").agg(F.sum("n").alias("n"))
        .select((F.col("counter") / 4096).cast("int").alias("pack"), F.struct("counter", F.expr("cast(least(63, 2 * log2(n + 1)) as int)").alias("level")).alias("c"))
    )
    packs = counted.groupBy("pack").agg(F.sort_array(F.collect_list("c")).alias("cs")).select(
        "pack", F.expr("unhex(array_join(transform(cs, c -> lpad(hex(c.level), 2, '0')), ''))").alias("levels")
    )
    return b"".join(bytes(row["levels"]) for row in packs.orderBy("pack").collect())


def _ordered(tokens: Column, rarity: bytes) -> Column:
    """Tokens as numbers that sort by rarity, rarest first, then by the token's own number."""
    # An array that the optimizer makes once, so that a token costs one access.
    table = F.split(F.lit(",".join(map(str, rarity))), ",").cast("array<tinyint>")

    def number(token: Column) -> Column:
        level = F.get(table, token.bitwiseAND(COUNTERS - 1).cast("int"))
        return F.shiftleft(level.cast("long"), TOKEN_BITS).bitwiseOR(token.bitwiseAND((1 << TOKEN_BITS) - 1))

    return F.sort_array(F.transform(tokens, number))


def _classes(rows: DataFrame, rarity: bytes, percent: int) -> DataFrame:
    """One row per distinct set: its first line, size, prefix tokens, bitmaps of the parity of its tokens, and the
    least and largest of its words' numbers, which alike sets mostly share.

    Ids follow the order of the first lines, so of two classes the one with the larger id is the later one.
    The tokens with an odd or even seventh bit have a bitmap each if the set is large; otherwise both share one.
    """
    lines = rows.select("doc", "version", F.posexplode(F.split("text", "\n")).alias("line", "string"))
    words = lines.where(F.col("string").rlike(r"\S")).select(F.struct(*LINE).alias("first"), _tokens(F.col("string")).alias("words"))
    sets = words.select(
        "first", _ordered(F.col("words"), rarity).alias("tokens"), F.array_min("words").alias("low"), F.array_max("words").alias("high")
    )
    least = f"cast(ceil({percent} * size(tokens) / 100) as int)"
    return (
        sets.select(
            F.xxhash64("tokens").alias("h"), F.xxhash64(F.reverse("tokens"), F.lit(1)).alias("g"),
            F.size("tokens").alias("size"), "first", "low", "high",
            F.expr(f"transform(slice(tokens, 1, size(tokens) - {least} + 1), t -> hash(t))").alias("prefix"),
            F.expr("aggregate(tokens, 0L, (bits, t) -> bits ^ shiftleft(1L, cast(t & 63 as int)))").alias("bitmap"),
            F.expr(f"""if(size(tokens) <= {WIDE}, null, aggregate(tokens, 0L,
                (bits, t) -> if(t & 64 = 0, bits, bits ^ shiftleft(1L, cast(t & 63 as int)))))""").alias("odd"),
        )
        .groupBy("h", "g", "size")
        .agg(F.min("first").alias("first"), *(F.first(c).alias(c) for c in ("prefix", "bitmap", "odd", "low", "high")))
        .repartitionByRange("first").sortWithinPartitions("first")
        .withColumn("id", F.monotonically_increasing_id())
    )


def _bounds(percent: int) -> str:
    """Whether length and bitmaps of sets a and b leave room for enough common tokens."""
    whole = "(a_size + b_size)"
    # Tokens that only one of the sets has, at least: bits that differ, in both bitmaps where both sets are large.
    both, odd = "(a_bitmap ^ b_bitmap)", "(a_odd ^ b_odd)"
    differ = f"coalesce(bit_count({odd}) + bit_count({both} ^ {odd}), bit_count({both}))"
    return (
        f"100 * least(a_size, b_size) >= {percent} * greatest(a_size, b_size)"
        f" and {100 + percent} * ({whole} - {differ}) >= {2 * percent} * {whole}"
    )


def _first_candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Each class with the earliest class that has the same key, for some keys of a class.

    Keys are its least and largest prefix token, the least and largest number of all its words, and pairs of
    these: a pair divides a large group of variants, so that a class also meets other classes than the earliest.
    At most one pair of classes a key. Variants of a line nearly always match one of them.
    """
    keys = ("array_min(prefix)", "array_max(prefix)", "low", "high", "low, high", "array_min(prefix), low", "array_max(prefix), high", "array_min(prefix), high")
    each = F.explode(F.array(*(F.expr(f"xxhash64({n}, {key})") for n, key in enumerate(keys)))).alias("key")
    leaders = classes.select("id", each).groupBy("key").agg(F.min("id").alias("a_id"), F.count("*").alias("members")).where("members > 1")
    known, members = (classes.select(*(F.col(c).alias(f"{side}_{c}") for c in ("id", "size", "bitmap", "odd")), *key) for side, key in (("a", ()), ("b", (each,))))
    # Members have their bitmaps with them: most pairs of a key are unlike lines and go here, before any other shuffle.
    led = leaders.drop("members").join(known, "a_id")
    return members.join(led.hint("merge"), "key").where(f"a_id < b_id and {_bounds(percent)}").select("a_id", "b_id").distinct()


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that share a prefix token and that no bound on their overlap rules out.

    The later class of a pair is not settled yet. A settled class posts its size as a negative number, and the
    test is part of a comparison of both sides: so both read the same shuffled postings.
    """
    # No id is null; said of both sides, it keeps a filter for one side only from telling their plans apart.
    postings = classes.where("id is not null").select(
        "id", F.expr("if(settled, -size, size) as signed"), "bitmap", "odd", F.posexplode("prefix").alias("place", "token")
    )
    columns = ("id", "signed", "bitmap", "odd", "place")
    a, b = (postings.select("token", *(F.col(c).alias(f"{side}_{c}") for c in columns)) for side in "ab")
    # Overlap o is enough when (100 + percent) * o >= percent * (sum of the sizes).
    enough = f"{100 + percent} * least(a_size - a_place, b_size - b_place) >= {percent} * (a_size + b_size)"
    test = f"a_id < if(b_signed < 0, -1, b_id) and {enough} and {_bounds(percent)}"
    test = test.replace("a_size", "abs(a_signed)").replace("b_size", "abs(b_signed)")
    return a.join(b, "token").where(test).select("a_id", "b_id").distinct()


def _later(classes: DataFrame, rows: DataFrame, rarity: bytes, percent: int) -> DataFrame:
    """First lines of classes that match a class with an earlier first line.

    A class needs one earlier match only. A likely one is verified first, which settles nearly all members of a
    large group of variants; only for the classes that are left are all candidates found and verified, so that
    the pairs of a group are not spelled out.
    """
    likely = staged(_first_candidates(classes, percent), "likely")
    sets = staged(_sets_of(likely, classes, rows, rarity), "sets")
    settled = staged(_verified(likely, sets, percent), "settled")
    released(likely, sets)
    flags = settled.select(F.col("b_id").alias("id"), F.lit(True).alias("flag")).hint("merge")
    flagged = classes.join(flags, "id", "left").withColumn("settled", F.coalesce("flag", F.lit(False)))
    pairs = staged(_candidates(flagged, percent), "candidates")
    sets = staged(_sets_of(pairs, classes, rows, rarity), "sets")
    later = staged(settled.unionByName(_verified(pairs, sets, percent)).select("b_first.*").distinct(), "later")
    released(settled, pairs, sets)
    return later


def _sets_of(pairs: DataFrame, classes: DataFrame, rows: DataFrame, rarity: bytes) -> DataFrame:
    """(id, first, tokens) of the classes that occur in pairs, from the texts."""
    named = pairs.select(F.col("a_id").alias("id")).distinct().union(pairs.select("b_id").distinct()).distinct()
    wanted = (
        classes.join(named, "id").select("first.*", "id")
        .groupBy("doc", "version").agg(F.collect_list(F.struct("line", "id")).alias("lines"))
    )
    strings = F.expr("transform(array(split(text, '\n')), every -> transform(lines, l -> struct(l.id, l.line, every[l.line] as string)))[0]")
    lines = _match(rows, wanted, ("doc", "version")).select("doc", "version", F.explode(strings).alias("l"))
    return lines.select(
        "l.id", F.struct("doc", "version", "l.line").alias("first"), _ordered(_tokens(F.col("l.string")), rarity).alias("tokens")
    ).dropDuplicates(["id"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(b_id, b_first) of the pairs whose whole sets are alike enough."""
    a, b = (sets.select(*(F.col(c).alias(f"{side}_{c}") for c in sets.columns)) for side in "ab")
    shared = "size(array_intersect(a_tokens, b_tokens))"
    return (
        pairs.join(a, "a_id").join(b, "b_id")
        .where(f"{100 + percent} * {shared} >= {percent} * (size(a_tokens) + size(b_tokens))")
        .select("b_id", "b_first").distinct()
    )


def _match(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str = "inner") -> DataFrame:
    """Join on equal keys, where null equals null; the keys of the left side stay.

    Both sides grow with the texts, so they are shuffled at every size and never broadcast.
    """
    other = right.select(*(F.col(c).alias(f"r_{c}" if c in keys else c) for c in right.columns)).hint("merge")
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys))
    return left.join(other, same, how).drop(*(f"r_{k}" for k in keys))


def deduplicate_lines(
    df: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Remove every line that an earlier line of the corpus repeats, wholly or nearly.

    A line is the set of its words, letters lowered. Two lines match when 100 * intersection >= ``percent``
    * union. A line goes when any line before it matches it, in order of document id, then of a hash of the
    text, then of place; whether the earlier line stays itself does not matter. Lines without words stay.

    Lines with the same set are one class, settled by an aggregation. Between classes, tokens are ordered by
    rarity, counted over all lines; a class posts the tokens of its prefix, and classes meet in a join on the
    token. Length, position of the token and a bitmap of the whole set bound the overlap from above; the
    pairs that are left are verified on their whole sets. All of it is built-in expressions. Tokens are
    numbers of ``TOKEN_BITS`` bits, a set is known by two numbers of 64. Texts are shuffled twice: to fetch
    the lines that are verified, and for the result.

    Null text stays null, empty text stays empty; both have no matches. Rows that are equal in id and text
    count as one document and are treated alike. Null ids come first. Empty table: no rows.
    Returns the columns of ``df`` with the text replaced, and ``n_lines, n_removed`` (input columns of these
    two names are replaced).
    """
    names = [c for c in df.columns if c not in (text_column, "n_lines", "n_removed")]
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.col(id_column).alias("doc"), F.xxhash64(text_column).alias("version"), F.col(text_column).alias("text"),
    )
    with shuffles_dropped(df.sparkSession):
        rarity = _rarity(rows)
        classes = staged(_classes(rows, rarity, percent), "lines")
        later = _later(classes, rows, rarity, percent)
        stay = _match(classes.select("first.*"), later, LINE, "left_anti").groupBy("doc", "version").agg(F.collect_list("line").alias("stay"))
        stay = staged(stay, "stay")
    released(classes, later)
    made = _match(rows, stay, ("doc", "version"), "left").select(
        "row", "text",
        # Lines are split once per text; the lines that stay are taken by their places.
        F.expr("""transform(array(split(text, '\n')), every -> struct(size(every) as n, transform(
            sort_array(concat(coalesce(stay, cast(array() as array<int>)),
                              filter(sequence(0, size(every) - 1), i -> not every[i] rlike '\\\\S'))),
            i -> every[i]) as kept))[0]""").alias("made"),
    )
    return made.select(
        *(F.col("row").getField(c).alias(c) for c in names),
        F.when(F.col("text").isNotNull(), F.array_join("made.kept", "\n")).alias(text_column),
        F.when(F.col("text").isNotNull(), F.col("made.n")).otherwise(0).cast("long").alias("n_lines"),
        F.when(F.col("text").isNotNull(), F.col("made.n") - F.size("made.kept")).otherwise(0).cast("long").alias("n_removed"),
    )
