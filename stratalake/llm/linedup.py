"""Line dedup (operator 4) by an exact set-similarity join, in DataFrame functions only.

A line's tokens are its distinct five-word shingles (A-Z lower-cased), or its whole word sequence
if it has fewer words. A line goes if an earlier line, by doc_id, text and line number, has a Jaccard
similarity of at least 75 percent. Tokens are ordered by rarity: by how often their first word's
hash place occurs in the corpus, then by that word's hash, an order that all lines share. A line
offers only the shortest prefix of that order that must meet the prefix of every similar line.
Pairs that meet pass a length filter, a positional filter and one by signatures: 128 bits, each the parity
of the tokens that fall on it. As many tokens differ as bits do at least, and similar lines differ in few, so
lines that only share a passage part without their sets. The rest are verified on full sets.

Lines with the same text are found first, by two 64-bit hashes: all but the earliest go, and but for a
few only the earliest takes part in the join, as it is earlier than a line whenever one of its copies is.

Lines that meet in a token are numbered in their order. Each line is first tried against the
first line of each of its tokens, those without a match against the following ones, 64 times as
many each round, until none has an untried earlier line. So a line that thousands share costs
one pair per copy, and no match is lost.

Blank lines have no tokens and always stay. Rows with a null doc_id, and null texts, are returned
unchanged. Rows equal in doc_id and text count as one document: they are returned alike, and do not
remove each other's lines. Rows with one doc_id and different texts are documents of their own, in the
order of a hash of their texts. Other columns are returned as they are, whatever their names; only
columns called ``n_lines`` and ``n_removed`` are replaced by the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm import common
from stratalake.llm.common import may_be_in
from stratalake.session import discard, keep

SIZE, PERCENT = 5, 75
PLACES = 1 << 15  # hash places of word counts
GROWTH = 64  # of the number of earlier lines tried per round
SPARSE = 64  # bits a key of bitmaps that stand for a join
LINE = ["_doc", "_copy", "_no"]  # names a line: rows that share a doc_id are told apart by a hash of their texts
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CASED = r"[\p{Lu}\p{Lt}\p{IsUppercase}\p{Cn}&&[^A-Z]]"  # what ``lower`` may change beyond A-Z; unassigned ones as it may know newer letters
BLANKS = "\t\v\f\r"  # and the blank itself


def hold(value: Column) -> Column:
    """A value computed once: expressions above a generator are not copied into each other."""
    return F.explode(F.array(value))


def lowered(line: Column) -> Column:
    """A-Z lower-cased; ``lower`` does the same on text without other capital letters, at a fraction of the time."""
    same = (F.length(line) == F.octet_length(line)) | ~F.regexp_like(line, F.lit(CASED))
    return F.when(same, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def blanked(text: Column) -> Column:
    """``BLANKS`` as blanks; most texts have none and are only searched."""
    plain, found = text, F.lit(False)
    for blank in BLANKS:
        plain, found = F.replace(plain, F.lit(blank), F.lit(" ")), found | F.contains(text, F.lit(blank))
    return F.when(found, plain).otherwise(text)


def split_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """``LINE``, ``_line``: all lines, their words between single or several blanks."""
    whole = F.col(text).cast("string")
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_doc"), F.xxhash64(whole).alias("_copy"), hold(blanked(whole)).alias("_text"))
    return rows.select("_doc", "_copy", F.posexplode(F.split("_text", "\n")).alias("_no", "_line"))


def hashed(lines: DataFrame) -> DataFrame:
    """``LINE``, ``_h``: the lines with a word, A-Z lower-cased, as arrays of word hashes."""
    words = F.array_remove(F.split(lowered(F.col("_line")), " "), "")
    rows = lines.select(*LINE, hold(words).alias("_w")).where(F.size("_w") > 0)
    return rows.select(*LINE, hold(F.transform("_w", lambda w: F.xxhash64(w))).alias("_h"))


def shingle(hashes: str, i: Column) -> Column:
    """Hash of the words from place ``i`` on; places behind the end are null and count for nothing."""
    return F.xxhash64(*[F.get(hashes, i + j) for j in range(SIZE)])


def shingles(hashes: str) -> Column:
    """All shingle hashes of a line, with repeats."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(hashes) - SIZE, F.lit(0))), lambda i: shingle(hashes, i))


def parity(tokens: str, half: int) -> Column:
    """64 bits of a line's signature: the parities of its tokens on the places of one half."""
    one = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
    mine = F.filter(tokens, lambda h: h.bitwiseAND(64) == 64 * half)
    return F.aggregate(mine, F.lit(0).cast("long"), lambda bits, h: bits.bitwiseXOR(one(h)))


def signatures(lines: DataFrame) -> DataFrame:
    """``LINE``, ``_n`` (size of the set), ``_sa``, ``_sb`` (signature) of each line."""
    sets = hashed(lines).select(*LINE, hold(F.array_distinct(shingles("_h"))).alias("_s"))
    return sets.select(*LINE, F.size("_s").alias("_n"), parity("_s", 0).alias("_sa"), parity("_s", 1).alias("_sb")).dropDuplicates(LINE)


def word_places(df: DataFrame, text: str) -> list[int]:
    """How often each hash place of words occurs; its size is fixed. Only the order of tokens depends on it, so ``lower`` will do."""
    whole = F.lower(F.replace(F.col(text).cast("string"), F.lit("\n"), F.lit(" ")))
    words = df.select(F.explode(F.split(whole, " ")).alias("_word")).where("_word != ''")
    counted = words.select(F.xxhash64("_word").bitwiseAND(PLACES - 1).alias("p")).groupBy("p").count().collect()
    found = [0] * PLACES
    for place, n in counted:
        found[place] = n
    return found


def looks_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``may_be_in`` for lines, with few enough rows marked wrongly to do without the join."""
    return common.may_be_in(rows, keys, LINE, SPARSE)


def later_copies(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``LINE`` of the lines with a word that equal an earlier line; and of those that equal none but look so in a bitmap of the former."""
    worded = lines.where(F.ltrim("_line") != "")
    rows = keep(worded.select(*LINE, F.xxhash64("_line").alias("_a"), F.xxhash64(F.lit(1), "_line").alias("_b")), "hashes")
    first = rows.groupBy("_a", "_b").agg(F.min(F.struct(*LINE)).alias("_first"), F.count("*").alias("_c")).where("_c > 1")
    first = keep(first.drop("_c"), "first")  # a line that many rows share can then be split
    copies = keep(rows.join(first, ["_a", "_b"]).where(F.struct(*LINE) != F.col("_first")).select(*LINE).distinct(), "copies")
    alike = looks_in(rows.select(*LINE), copies).where("_may").drop("_may")
    lone = keep(alike.join(copies, LINE, "left_anti"), "lone")
    discard(rows, first)
    return copies, lone


def earlier_matches(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``LINE`` of every line that an earlier line matches."""
    lines = split_lines(df, key, text)
    copies, lone = later_copies(lines)
    # copies leave by two bitmaps, without a shuffle; a few that both bitmaps mark stay and are matched like other lines
    some = looks_in(lines, copies).withColumnRenamed("_may", "_alike")
    words = hashed(looks_in(some, lone).where("not _alike or _may"))
    counts = word_places(df, text)
    ranks = {n: i for i, n in enumerate(sorted(set(counts)))}
    table = F.split(F.lit(",".join(str(ranks[n] << 44) for n in counts)), ",").cast("array<long>")  # folded to one literal
    size = F.greatest(F.size("_h") - (SIZE - 1), F.lit(1))
    # rank of the word's place above, its hash below: one order for all lines; known not to be null, they are sorted as numbers
    keys = F.transform(F.slice("_h", 1, size), lambda h: F.coalesce(table[h.bitwiseAND(PLACES - 1)], F.lit(0).cast("long")).bitwiseOR(F.shiftrightunsigned(h, 20)))
    keyed = words.select(*LINE, "_h", size.alias("_n"), hold(keys).alias("_k"))
    keyed = keyed.select(*LINE, "_h", "_n", "_k", hold(F.sort_array(F.array_distinct("_k"))).alias("_sorted"))
    length = F.col("_n") - F.ceil(F.col("_n") * PERCENT / 100).cast("int") + 1
    keyed = keyed.select(*LINE, "_h", "_n", "_k", "_sorted", F.get("_sorted", F.least(length, F.size("_sorted")) - 1).alias("_last"))
    rows = keyed.select(*LINE, "_h", "_sorted", "_last", F.posexplode("_k").alias("_i", "_key")).where("_key <= _last")
    rows = rows.select(shingle("_h", F.col("_i")).alias("_token"), *LINE, (F.array_position("_sorted", F.col("_key")) - 1).cast("int").alias("_pos"))

    line = LINE
    # few tokens are met again; only their lines are put in order
    rows = rows.withColumn("_met", F.count("*").over(Window.partitionBy("_token"))).where("_met > 1").drop("_met")
    order = Window.partitionBy("_token").orderBy(*line)
    again = F.lag(F.struct(*line)).over(order) == F.struct(*line)  # a shingle that its line repeats
    rows = rows.withColumn("_again", again).where(~F.coalesce("_again", F.lit(False))).drop("_again")
    shared = rows.withColumns({"_rn": F.row_number().over(order), "_next": F.lead("_doc").over(order)})
    shared = keep(shared.where((F.col("_rn") > 1) | F.col("_next").isNotNull()).select("_token", *line, "_pos", "_rn"), "shared")
    several = keep(shared.select(*line).distinct(), "several")
    lines = keep(looks_in(lines, several).where("_may").drop("_may"), "lines")  # with a few others; read in each round
    discard(several)
    me = F.struct(*line, "_n", "_sa", "_sb", "_pos")
    signed = shared.join(signatures(lines), line)
    met = keep(signed.withColumn("_pivot", F.first(me).over(order)), "met")
    discard(shared)

    def close(x: str, y: str) -> Column:
        """Filters of two lines that share a token: by size, by the token's places and by signature."""
        (n, m), (p, q), (a, c), (b, d) = ([F.col(f"{s}_{part}") for s in (x, y)] for part in ("n", "p", "sa", "sb"))
        fits = (100 * n >= PERCENT * m) & (100 * m >= PERCENT * n)
        fits &= (100 + PERCENT) * F.least(n - p, m - q) >= PERCENT * (n + m)
        differ = F.bit_count(a.bitwiseXOR(c)) + F.bit_count(b.bitwiseXOR(d))
        return fits & ((100 + PERCENT) * differ <= (100 - PERCENT) * (n + m))

    def side(row: str, name: str) -> list[Column]:
        parts = {"d": "_doc", "c": "_copy", "l": "_no", "n": "_n", "p": "_pos", "sa": "_sa", "sb": "_sb"}
        return [F.col(f"{row}{c}").alias(f"{name}_{s}") for s, c in parts.items()]

    ends = [f"{s}_{c}" for s in "xy" for c in "dcl"]
    pairs = met.where("_rn > 1").select(*side("", "x"), *side("_pivot.", "y"))
    matched, low, high = copies, 1, 1
    open_rows = met
    while True:
        pairs = pairs.where(close("x", "y") & (F.struct("x_d", "x_c", "x_l") != F.struct("y_d", "y_c", "y_l")))
        pairs = keep(pairs.select(*ends).distinct(), "pairs")
        found = keep(verified(pairs, lines), "matched")
        discard(pairs)
        matched = matched.unionByName(found)
        low, high = high + 1, high * GROWTH
        some = may_be_in(open_rows.where(F.col("_rn") > low), found, line)
        open_rows = some.where("not _may").drop("_may").unionByName(some.where("_may").drop("_may").join(found, line, "left_anti"))
        x = open_rows.select("_token", F.col("_rn").alias("_rx"), *side("", "x"))
        if x.isEmpty():
            discard(met, lines)
            return matched
        y = met.where(F.col("_rn").between(low, high)).select("_token", F.col("_rn").alias("_ry"), *side("", "y"))
        pairs = x.join(y, "_token").where("_ry < _rx")


def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Distinct later lines of the pairs whose full sets are similar."""
    names = dict(zip("dcl", LINE))
    one = [F.struct(*[F.col(f"{s}_{c}").alias(n) for c, n in names.items()]) for s in "xy"]
    both = pairs.select(F.explode(F.array(*one)).alias("e")).select("e.*").distinct()
    lines = may_be_in(lines, both, LINE).where("_may").drop("_may").join(both, LINE, "left_semi")
    words = hashed(lines).select(*LINE, F.array_distinct(shingles("_h")).alias("_s")).dropDuplicates(LINE)
    for side in "xy":
        named = [F.col(n).alias(f"{side}_{c}") for c, n in names.items()]
        pairs = pairs.join(words.select(*named, F.col("_s").alias(f"_s{side}")), [f"{side}_{c}" for c in names])
    common = F.size(F.array_intersect("_sx", "_sy"))
    pairs = pairs.select(*[F.col(f"x_{c}").alias(n) for c, n in names.items()], common.alias("_c"), (F.size("_sx") + F.size("_sy")).alias("_both"))
    return pairs.where(100 * F.col("_c") >= PERCENT * (F.col("_both") - F.col("_c"))).select(*LINE).distinct()


def line_dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns with ``text`` less its removed lines, and ``n_lines`` / ``n_removed``."""
    gone = earlier_matches(df, key, text).groupBy("_doc", "_copy").agg(F.sort_array(F.collect_set("_no")).alias("_gone"))
    # the text takes part in the join once
    rows = df.select(F.struct(*df.columns).alias("_in"), F.col(key).alias("_doc"), F.xxhash64(F.col(text).cast("string")).alias("_copy"))
    rows = rows.join(gone, ["_doc", "_copy"], "left")
    lines = F.split(F.col(f"_in.`{text}`").cast("string"), "\n")
    # what lies between removed lines, slice by slice
    starts, ends = F.concat(F.array(F.lit(-1)), "_gone"), F.concat("_gone", F.array(F.size(lines)))
    left = F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 2, b - a - 1)))
    cleaned = F.when(F.col("_gone").isNull(), F.col(f"_in.`{text}`")).otherwise(F.array_join(left, "\n"))
    n_lines = F.coalesce(F.size(F.filter(lines, lambda x: F.ltrim(x, F.lit(" " + BLANKS)) != "")), F.lit(0))
    n_removed = F.coalesce(F.size("_gone"), F.lit(0))
    names = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    columns = [cleaned.alias(c) if c == text else F.col(f"_in.`{c}`").alias(c) for c in names]
    return rows.select(*columns, n_lines.cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed"))
