"""Line dedup by an exact set-similarity join, with DataFrame functions only.

A line is the set of its lower-cased words. It is removed if an earlier line of the corpus (smaller id, or
the same id and an earlier place) has a Jaccard similarity of ``PERCENT`` or more to it; all lines are judged on the
input, removed ones included.

1. Lines with equal sets are one class; all but its first line go. The first lines take part in the join, if they
   have words enough to be similar to another set at all: at 80 percent, lines of one to three words equal or differ.
2. The words of a line are ordered by rarity: by how often their hash bucket occurs in the corpus, then by hash, an
   order that all lines share. Of n words the first n - ceil(t n) + 1 are the prefix; similar lines share one of it.
3. Lines of equal length that share one of the last ``STAR`` words of their prefixes are compared with the first line
   that has it and with the ``NEAREST`` ones in front of them. That settles the many versions of a much copied line
   without their pairs: what a version changes is rarer than the words it keeps, which stand at the end of the prefix.
4. Each line left meets the lines in front of it that share a prefix word. Length and positional filters, and a
   parity of 128 bits over the words, of which two similar lines differ in few, come with the join, so that
   nearly all pairs it makes are similar.
5. The Jaccard similarity of the pairs is verified on the whole sets, read from the texts again: of each line first
   the pair whose parities are nearest, and all others only if that one is not similar.

A word that very many lines share is salted in step 3, and its rows are split by adaptive execution in step 4. Words are
compared by their 64-bit hashes; prefix rows are narrow and are shuffled once.

Defined results: NULL texts have no lines and stay NULL; lines without words stay; a NULL id comes after all others;
rows that repeat an id have equal places, of which none is earlier; a text that loses all its lines is empty. A very
long text is many lines, a very long line one set; empty tables stay empty. Other columns are kept whatever their name, but
for the two that are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telemetry_lake.llm.common import SPACES, sized, written

PERCENT = 80
# Last words of a prefix by which lines are compared with the first line that has them.
STAR = 2
# Lines of such a group just in front of a line with which it is compared as well.
NEAREST = 4
# Buckets in which the words of the corpus are counted for their order, and steps of the counts' logarithm.
RARITY_BUCKETS, STEPS = 1 << 18, 3
# Words up to which half of the parity is enough to tell lines apart.
FEW_WORDS = 64
# Rows of one word that meet in a task when its first line is looked for.
GROUP_ROWS = 1 << 20
LINE = ["id", "at"]
BLANKS = " \t\x0b\x0c\r"


def _words(text: str | Column) -> Column:
    """The lower-cased words of a text, and perhaps empty ones; blanks alone part most texts, which is faster."""
    text = F.lower(text)
    other = F.lit(False)
    for blank in BLANKS[1:] + "\n":
        other = other | (F.instr(text, blank) > 0)
    return F.when(other, F.split(text, SPACES)).otherwise(F.split(text, " "))


def _plain(text: str) -> Column:
    """A text in lower case whose words are parted by blanks and line ends alone."""
    other = F.lit(False)
    for blank in BLANKS[1:]:
        other = other | (F.instr(text, blank) > 0)
    return F.lower(F.when(other, F.translate(text, BLANKS[1:], " " * len(BLANKS[1:]))).otherwise(F.col(text)))


def _hashes(line: str | Column) -> Column:
    """The distinct words of a line, as hashes."""
    return F.array_distinct(F.transform(F.array_remove(_words(line), ""), lambda w: F.xxhash64(w)))


def _low(value: Column) -> Column:
    return value.bitwiseAND(F.lit(0xFFFFFFFF))


def _at(pos: str | Column, checksum: Column) -> Column:
    """Place of a line in its text, and in the lower half the text's checksum, which tells texts of one id apart."""
    return F.shiftleft(F.col(pos).cast("long") if isinstance(pos, str) else pos, 32).bitwiseOR(_low(checksum))


def _pos(at: Column) -> Column:
    return F.shiftright(at, 32).cast("int")


def _place(id_: str, at: str) -> Column:
    """Places as values that sort in the order of the corpus."""
    return F.struct(F.col(id_).isNull().alias("last"), F.col(id_).alias("id"), _pos(F.col(at)).alias("pos"))


def least_words(percent: int) -> int:
    """Fewest words of a line that can be similar to one of other words."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 30


def _number(word: Column) -> Column:
    """A word as its hash, without the highest byte."""
    return F.shiftrightunsigned(F.xxhash64(word), 8)


def _rarity(plain: DataFrame) -> Column:
    """How often the words of each bucket occur, on a logarithmic scale: an array of fixed size, a constant of the plan."""
    lines = plain.select(F.explode(F.split("text", "\n")).alias("line"))
    words = lines.select(F.explode(F.split("line", " ")).alias("w")).filter("w <> ''")
    counts = words.groupBy(_number(F.col("w")).bitwiseAND(F.lit(RARITY_BUCKETS - 1)).alias("bucket")).agg(F.count("*").alias("n"))
    level = F.least(F.floor(STEPS * F.log2("n")) + 1, F.lit(126))
    levels = [0] * RARITY_BUCKETS
    for row in counts.select("bucket", level.alias("level")).collect():
        levels[row.bucket] = row.level
    return F.split(F.lit(" ".join(map(str, levels))), " ").cast("array<bigint>")


def _ranked(line: str, levels: Column) -> Column:
    """The distinct words of a plain line, rarest first, as numbers: rarity in the highest byte, the word's hash below.

    Each word is hashed once, and ranked once however often it occurs.
    """
    def placed(h: Column) -> Column:
        return F.shiftleft(F.get(levels, h.bitwiseAND(F.lit(RARITY_BUCKETS - 1)).cast("int")), 56).bitwiseOR(h)

    numbers = F.array_distinct(F.transform(F.array_remove(F.split(line, " "), ""), _number))
    return F.sort_array(F.transform(numbers, placed))


def _parity(words: str, half: int) -> Column:
    """A 64-bit half of the words' parity: each word flips one bit of one half. Of few words the second half is empty."""
    def one(w: Column, value: Column) -> Column:
        return F.call_function("shiftleft", value, w.bitwiseAND(F.lit(63)).cast("int"))

    def flip(bits: Column, w: Column) -> Column:
        mine = F.shiftright(w, 6).bitwiseAND(F.lit(1)).bitwiseXOR(F.lit(1 - half)).cast("long")
        return bits.bitwiseXOR(one(w, mine))

    none = F.lit(0).cast("long")
    few = none if half else F.aggregate(words, none, lambda bits, w: bits.bitwiseXOR(one(w, F.lit(1).cast("long"))))
    return F.when(F.size(words) <= FEW_WORDS, few).otherwise(F.aggregate(words, none, flip))


def _line_table(rows: DataFrame, percent: int) -> DataFrame:
    """A written row per line with words: ``id, at, k1, k2`` (its set), ``n, prefix, b1, b2``."""
    plain = rows.select("id", "sum", _plain("text").alias("text"))
    levels = _rarity(plain)
    lines = plain.select("id", "sum", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.btrim("line")).filter("line <> ''")
    lines = lines.select("id", _at("pos", F.col("sum")).alias("at"), _ranked("line", levels).alias("ranked"))
    n = F.size("ranked")
    taking_part = n >= least_words(percent)
    length = F.when(taking_part, n - F.ceil(percent * n / 100) + 1).otherwise(0).cast("int")
    lines = lines.select(
        *LINE, F.xxhash64("ranked").alias("k1"), F.xxhash64(F.lit(1), "ranked").alias("k2"), n.alias("n"),
        F.slice("ranked", 1, length).alias("prefix"),
        *[F.when(taking_part, _parity("ranked", half)).alias(f"b{half + 1}") for half in (0, 1)],
    )
    return written(lines, "line-sets")


def _rows_of(lines: DataFrame, words: Column) -> DataFrame:
    """A row per word of ``words``: ``w``, the line, ``ni`` (length of the line above, place of the word below) and parity."""
    rows = lines.select(*LINE, "n", "b1", "b2", *[c for c in ("settled",) if c in lines.columns], F.posexplode(words).alias("i", "p"))
    ni = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("i").cast("long"))
    extra = [F.col("settled")] if "settled" in rows.columns else []
    return rows.select(F.col("p").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("w"), *LINE, ni.alias("ni"), "b1", "b2", F.shiftright("p", 56).cast("int").alias("level"), *extra)


def _flips(a: str, b: str, n: Column, m: Column) -> Column:
    """Bits in which the parities of two lines of n and m words differ.

    Where one line has few words, whose bits are all in the first half, those of the other are put together.
    """
    first, second = (F.col(f"{a}{bits}").bitwiseXOR(F.col(f"{b}{bits}")) for bits in ("b1", "b2"))
    return F.when(F.least(n, m) > FEW_WORDS, F.bit_count(first) + F.bit_count(second)).otherwise(F.bit_count(first.bitwiseXOR(second)))


def _part(side: str) -> tuple[Column, Column]:
    """Length of a row's line, and the place of its word."""
    return F.shiftright(f"{side}ni", 32), _low(F.col(f"{side}ni"))


def _may_match(a: str, b: str, percent: int, placed: bool = True) -> Column:
    """Parity, length and (if the rows know it) positional filter on two rows of one prefix word, the first common one or not.

    In whole numbers, the cheapest and most telling condition first: sets of n and m words have at least
    percent (n + m) / (100 + percent) in common if they are similar, and differ in no more than the others.
    """
    (n, i), (m, j) = _part(a), _part(b)
    differ = (100 + percent) * _flips(a, b, n, m) <= (100 - percent) * (n + m)
    ahead = (100 + percent) * (F.least(i, j) + F.least(n - i, m - j)) >= percent * (n + m)
    fits = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return differ & ahead & fits if placed else differ & fits


def _similar(pairs: DataFrame, rows: DataFrame, percent: int, purpose: str) -> DataFrame:
    """Later lines ``(id, at)`` of those pairs ``(id, at, eid, eat, flips)`` that are similar indeed.

    One similar pair is enough to remove a line. So the pair of fewest flips of each line is verified first, which
    settles nearly all that have a similar one, and the others only of lines that it leaves over.
    """
    pairs = written(pairs.distinct(), purpose)
    asked = pairs.select(*LINE).union(pairs.select("eid", "eat")).distinct()
    asked = asked.groupBy("id", _low(F.col("at")).alias("s")).agg(F.collect_set(_pos(F.col("at"))).alias("wanted"))
    asked = sized(written(asked, f"{purpose}-asked"), F.size("wanted")).withColumnsRenamed({"id": "_id", "s": "_s"})
    texts = rows.join(asked, rows["id"].eqNullSafe(F.col("_id")) & (_low(rows["sum"]) == F.col("_s")))
    parts = F.split("text", "\n")
    lines = texts.select("id", "sum", F.explode(F.arrays_zip(F.col("wanted").alias("pos"), F.transform("wanted", lambda p: F.get(parts, p)).alias("line"))).alias("l"))
    sets = lines.select("id", _at(F.col("l.pos").cast("long"), F.col("sum")).alias("at"), _hashes(F.col("l.line")).alias("words"))
    sets = written(sets.dropDuplicates(LINE), f"{purpose}-sets")
    best = pairs.groupBy(*LINE).agg(F.min(F.struct("flips", "eid", "eat")).alias("e")).select(*LINE, "e.eid", "e.eat")
    settled = written(_verified(best, sets, percent), f"{purpose}-best")
    known = sized(settled.withColumnsRenamed({"id": "_id", "at": "_at"}))
    others = pairs.join(known, pairs["id"].eqNullSafe(F.col("_id")) & (pairs["at"] == F.col("_at")), "left_anti")
    return settled.union(_verified(others.select(*LINE, "eid", "eat"), sets, percent)).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Later lines ``(id, at)`` of the similar ones among pairs of lines, by the whole ``sets`` of these."""
    earlier = sets.select(F.col("id").alias("_eid"), F.col("at").alias("_eat"), F.col("words").alias("earlier"))
    mine = sets.select(F.col("id").alias("_id"), F.col("at").alias("_at"), "words")
    both = pairs.join(mine, pairs["id"].eqNullSafe(F.col("_id")) & (pairs["at"] == F.col("_at")))
    both = both.join(earlier, F.col("eid").eqNullSafe(F.col("_eid")) & (F.col("eat") == F.col("_eat")))
    common = F.size(F.array_intersect("words", "earlier"))
    similar = 100 * common >= percent * (F.size("words") + F.size("earlier") - common)
    return both.filter(similar).select(*LINE).distinct()


def removed_lines(docs: DataFrame, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(id, s, gone)``: numbers of the removed lines of each text, named by its id and half of its checksum."""
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.xxhash64(text).alias("sum"), F.col(text).alias("text"))
    lines = _line_table(rows, percent)
    place = _place("id", "at")
    first = lines.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    first = sized(written(first.select("k1", "k2", "first"), "line-first"))
    repeated = place > F.col("first")
    repeats = lines.select(*LINE, "k1", "k2").join(first, ["k1", "k2"]).filter(repeated).select(*LINE)
    # One line of each class is enough, also where several stand at its first place.
    alone = F.col("first").isNull() | ~repeated
    firsts = lines.filter(F.size("prefix") > 0).join(first, ["k1", "k2"], "left").filter(alone).select(*LINE, "n", "prefix", "b1", "b2")

    # With the first line of the same length that has one of the last words of the prefix.
    star = _rows_of(firsts, F.slice("prefix", F.greatest(F.lit(1), F.size("prefix") - (STAR - 1)), STAR))
    # Places in the prefix count from its end here, so only length and parity are asked for.
    salts = F.greatest(F.lit(1), F.ceil(F.pow(F.lit(2.0), F.col("level") / STEPS) / GROUP_ROWS))
    star = star.withColumn("salt", F.pmod(F.xxhash64(*LINE), salts).cast("int")).drop("level")
    group = Window.partitionBy("w", F.shiftright("ni", 32), "salt").orderBy(place, "at")
    own = F.struct(place.alias("place"), F.col("at").alias("eat"), *[F.col(c).alias(f"e{c}") for c in ("ni", "b1", "b2")])
    star = star.withColumn("own", own)
    met = F.array(F.first("own").over(group), *[F.lag("own", k).over(group) for k in range(1, NEAREST + 1)])
    star = star.withColumn("met", met).select(*LINE, "ni", "b1", "b2", F.explode("met").alias("e")).filter("e IS NOT NULL")
    star = star.select(*LINE, "ni", "b1", "b2", "e.*").filter(_may_match("", "e", percent, placed=False) & (place > F.col("place")))
    flips = _flips("", "e", _part("")[0], _part("e")[0]).alias("flips")
    settled = written(_similar(star.select(*LINE, F.col("place.id").alias("eid"), "eat", flips), rows, percent, "line-star"), "line-settled")

    # Those left with all others in front of them.
    known = sized(settled.withColumnsRenamed({"id": "_id", "at": "_at"}))
    same = firsts["id"].eqNullSafe(F.col("_id")) & (firsts["at"] == F.col("_at"))
    index = firsts.join(known, same, "left").withColumn("settled", F.col("_at").isNotNull().cast("int")).drop("_id", "_at")
    index = _rows_of(index, F.col("prefix")).drop("level")
    index, other = (index.select(*[F.col(c).alias(side + c) for c in index.columns]) for side in ("l", "e"))
    # Both sides are one exchange: they need the same columns, and a condition on one of them alone would be applied
    # before it and part them. All lines here have words, so this asks for a line that is not settled.
    left = F.col("lsettled") * (F.shiftright("eni", 32) + F.col("esettled")) < 1
    rest = index.join(other, F.col("lw") == F.col("ew"))
    rest = rest.filter(_may_match("l", "e", percent) & left & (_place("lid", "lat") > _place("eid", "eat")))
    flips = _flips("l", "e", _part("l")[0], _part("e")[0]).alias("flips")
    more = _similar(rest.select(F.col("lid").alias("id"), F.col("lat").alias("at"), "eid", "eat", flips), rows, percent, "line-rest")
    gone = repeats.union(settled).union(more).distinct()
    return gone.groupBy("id", _low(F.col("at")).alias("s")).agg(F.collect_set(_pos(F.col("at"))).alias("gone"))


def dedupe_lines(docs: DataFrame, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the text without its removed lines, and ``_lines`` and ``_removed``, how many there were."""
    if clash := {"_lines", "_removed"} & set(docs.columns):
        raise ValueError(f"the input already has columns {sorted(clash)}")
    gone = sized(written(removed_lines(docs, percent, text, key), "line-removed"), F.size("gone"))
    gone = gone.select(F.col("id").alias("_id"), F.col("s").alias("_s"), F.col("gone").alias("_gone"))
    # The columns of the caller travel as one, so that their names cannot meet those used here.
    packed = docs.select(F.struct(*docs.columns).alias("_own"), F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = packed.join(gone, F.col("_key").eqNullSafe(F.col("_id")) & (_low(F.xxhash64("_text")) == F.col("_s")), "left")
    parts = F.split("_text", "\n")
    kept = F.filter(parts, lambda x, i: ~F.array_contains("_gone", i))
    worded = F.size(F.filter(parts, lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    columns = [
        F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")).alias(text) if c == text else F.col("_own")[c].alias(c)
        for c in docs.columns
    ]
    return rows.select(
        *columns,
        F.when(F.col("_text").isNull(), 0).otherwise(worded).cast("long").alias("_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("_removed"),
    )
