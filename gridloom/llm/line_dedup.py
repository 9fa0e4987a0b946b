"""Line dedup: an exact set-similarity join in DataFrame functions.

A line is the set of its words. Lines of equal sets form a class whose first line
stands for it. Words are ordered by rarity. Of two sets of similarity 0.8 or more the
smaller has its first common word among its rarest ninth, the larger among its
rarest fifth (prefix filter); their sizes are like (length filter), and what stands behind
that word leaves room for enough other common ones (positional filter). How many hashed words
fall into each of 32 ranges bounds the difference of two sets before the sets of both are joined
to the pair and the similarity is computed. A line that resembles an earlier one is removed.

It goes in two rounds, each exact about what it removes. In the first, a line meets only
the earliest line of each of its rare words and sizes, which is enough for most lines of large
families. In the second, the lines that are left meet all others, so no group is
paired with itself. What travels is small: classes carry their rarest words and no set;
the sets of the lines in a pair are made anew from the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, documents, with_keys

CELLS = 1 << 18
BITS = 1 << 19
MASK = (1 << 56) - 1
#: They part the hashes into 32 ranges.
BOUNDS = [-(1 << 63) + (k << 59) for k in range(1, 32)]
PAIR = ("xdoc_id", "xline_no", "ydoc_id", "yline_no")
POSTING = ("doc_id", "line_no", "size", "pos", "low", "high")


def plain(docs: DataFrame, *more: str) -> DataFrame:
    """`text` in lower case and with spaces for all other ends of words but line feeds, beside the columns `more`.

    A step of its own over whole texts, so that Spark compiles it; few texts hold what is replaced."""
    ends, text = "\t\r\f\x0b", F.col("text")
    spaced, some = text, F.lit(False)
    for end in ends:
        spaced, some = F.replace(spaced, F.lit(end), F.lit(" ")), some | F.contains(text, F.lit(end))
    return docs.select(*more, F.lower("text").alias("text")).select(*more, F.when(some, spaced).otherwise(text).alias("text"))


def hashed(line: Column) -> Column:
    """The hashes of the distinct words of a line of a `plain` text."""
    words = F.transform(F.split(line, " "), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(words), F.xxhash64(F.lit("")))


def keys_of(hashes: str) -> tuple[Column, Column]:
    """Two independent hashes of a set: neither follows from the other."""
    return F.xxhash64(hashes).alias("d1"), F.xxhash64(F.lit(1), hashes).alias("d2")


def cell_of(h: Column) -> Column:
    return h.bitwiseAND(F.lit(CELLS - 1)).cast("int")


def code_of(h: Column) -> Column:
    """How common a word is by `counts` above, 56 bits of its hash below; never null, so that Spark sorts plain numbers."""
    common = F.coalesce(F.get("counts", cell_of(h)), F.lit(0).cast("tinyint")).cast("long")
    return F.shiftleft(common, 56).bitwiseOR(h.bitwiseAND(F.lit(MASK)))


def word_counts(docs: DataFrame) -> DataFrame:
    """One row with `counts`, an array of CELLS numbers that tell how often words of all texts fall into a hash
    cell, on a logarithmic scale. Its size does not depend on the data."""
    words = plain(docs).select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("w")).where("w <> ''")
    # eight cells a row: the map in which Spark counts stays small
    eights = words.select(cell_of(F.xxhash64("w")).alias("cell")).groupBy(F.shiftright("cell", 3).alias("eight")).agg(*(F.count_if(F.col("cell").bitwiseAND(F.lit(7)) == i).alias(f"n{i}") for i in range(8)))
    cells = eights.select("eight", F.posexplode(F.array(*(f"n{i}" for i in range(8)))).alias("i", "n")).where("n > 0").select((F.col("eight") * 8 + F.col("i")).alias("cell"), "n")
    scale = F.coalesce(F.least(F.lit(126), F.floor(F.log2("n") * 2) + 1), F.lit(0)).cast("tinyint")
    all_cells = docs.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("cell")).join(cells, "cell", "left")
    ordered = F.sort_array(F.collect_list(F.struct("cell", scale.alias("scale"))))
    return all_cells.agg(ordered.alias("ordered")).select(F.col("ordered.scale").alias("counts"))


def probe_length(size: Column) -> Column:
    """Among so many rarest words a set holds the first word that it shares with a similar smaller one."""
    return size - F.floor((4 * size + 4) / 5).cast("int") + 1


def index_length(size: Column) -> Column:
    """The same with a similar set that is no smaller."""
    return size - F.floor((8 * size + 8) / 9).cast("int") + 1


def cyclic(n: Column) -> Column:
    """Four bits for a number, one of which changes when it grows by one."""
    return F.call_function("shiftright", F.lit(0xF0), n.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(0xF)).cast("long")


def ranges(ends: list[Column]) -> list[Column]:
    """Two numbers of 64 bits that tell how many words of a set fall into each range; `ends` are the places of BOUNDS among its sorted
    hashes, and its size with them plus one. Of two sets they differ in no more bits than the sets differ in words."""
    codes = [cyclic(end - start - 1) for start, end in zip([F.lit(0), *ends], ends, strict=False)]
    both = []
    for half in (codes[:16], codes[16:]):
        bits = half[0]
        for i, code in enumerate(half[1:], 1):
            bits = bits.bitwiseOR(F.shiftleft(code, 4 * i))
        both.append(bits)
    return both


def classes_of(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """Per distinct set: its first line (doc_id, line_no), size, the bits of `ranges` and its rarest words in
    order. Sets of fewer than 4 words, which resemble none but themselves, have an empty list."""
    lines = plain(docs, "doc_id").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    sets = lines.select("doc_id", "line_no", hashed(F.col("line")).alias("words"))
    bounds = F.array(*(F.lit(b).cast("long") for b in BOUNDS))
    sets = sets.select("doc_id", "line_no", "words", F.sort_array(F.concat("words", bounds)).alias("hashes"))
    places = [F.array_position("hashes", F.lit(b).cast("long")).cast("int").alias(f"end{i}") for i, b in enumerate(BOUNDS)]
    # a lambda over one number: with it Spark projects the places by methods of their own and not within its whole stage, which was slower
    size = F.get(F.transform(F.array(F.size("words")), lambda n: n), F.lit(0))
    sets = sets.select("doc_id", "line_no", "words", *places, (F.size("hashes") + 1).alias(f"end{len(BOUNDS)}"), size.alias("size"))
    low, high = ranges([F.col(f"end{i}") for i in range(len(BOUNDS) + 1)])
    size = F.col("size")
    length = F.when(size >= 4, probe_length(size)).otherwise(0)
    # the numbers come by a subquery, so that they stand in no plan's text; what follows names each of these columns once, so
    # that Spark puts the subquery where it is used and not into rows
    sets = sets.select("doc_id", "line_no", "words", size, low.alias("low"), high.alias("high"), length.alias("length"), counts.scalar().alias("counts"))
    # no function with a lambda stands around the sort, or Spark would not compile it
    sets = sets.select("doc_id", "line_no", "size", "low", "high", "length", F.sort_array(F.transform("words", code_of)).alias("codes"))
    first = F.struct("doc_id", "line_no", "size", "low", "high", F.slice("codes", F.lit(1), F.col("length")).alias("codes"))
    classes = sets.select(*keys_of("codes"), first.alias("first")).groupBy("d1", "d2").agg(F.min("first").alias("first")).select("first.*")
    rarest = F.transform("codes", lambda c: c.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    return classes.select("doc_id", "line_no", "size", "low", "high", rarest.alias("rarest"))


def postings(classes: DataFrame, length=None, *more: str) -> DataFrame:
    """A row for each of the first `length` rarest words of each set; all that are stored if none is given."""
    words = F.col("rarest") if length is None else F.slice("rarest", F.lit(1), length(F.col("size")))
    rows = classes.where("size >= 4").select("doc_id", "line_no", "size", "low", "high", *more, F.posexplode(words).alias("pos", "word"))
    # said here, so that Spark need not infer it on one side of a join only and can deal both sides at once
    return rows.where(" and ".join(f"{c} is not null" for c in rows.columns))


def side(rows: DataFrame, prefix: str) -> DataFrame:
    return rows.select("word", *(F.col(c).alias(prefix + c) for c in rows.columns if c != "word"))


def earlier(x: str, y: str) -> Column:
    return F.struct(f"{x}doc_id", f"{x}line_no") < F.struct(f"{y}doc_id", f"{y}line_no")


def close(x: str, y: str) -> Column:
    """Length, positional and range filters of two postings of one word."""
    a, b = F.col(f"{x}size"), F.col(f"{y}size")
    overlap = F.floor((4 * (a + b) + 8) / 9)
    room = F.least(a - F.col(f"{x}pos"), b - F.col(f"{y}pos"))
    differ = sum((F.bit_count(F.col(x + c).bitwiseXOR(F.col(y + c))) for c in ("low", "high")), F.lit(0))
    return (5 * a >= 4 * b) & (5 * b >= 4 * a) & (room >= overlap) & (differ <= a + b - 2 * overlap)


def first_pairs(classes: DataFrame) -> DataFrame:
    """Each line with the earliest one of a word and a range of sizes, if they may be similar."""
    index = postings(classes, index_length)
    sizes = F.floor(F.log(F.col("size")) / F.log(F.lit(1.25)))
    group = W.partitionBy("word", "sizes").orderBy("doc_id", "line_no").rowsBetween(W.unboundedPreceding, 0)
    met = index.withColumn("sizes", sizes).select(*(F.col(c).alias(f"y{c}") for c in POSTING), F.first(F.struct(*POSTING)).over(group).alias("x"))
    met = met.select(*(f"y{c}" for c in POSTING), *(F.col(f"x.{c}").alias(f"x{c}") for c in POSTING))
    return met.where(earlier("x", "y") & close("x", "y")).select(*PAIR)


def rest_pairs(classes: DataFrame) -> list[DataFrame]:
    """All pairs that may be similar and whose later line is not `gone` yet."""
    index, probe = side(postings(classes, index_length, "gone"), "i"), side(postings(classes, None, "gone"), "p")
    smaller = (F.col("isize") < F.col("psize")) | ((F.col("isize") == F.col("psize")) & earlier("i", "p"))
    fits, forward = smaller & close("i", "p"), earlier("i", "p")
    left = index.join(probe.where("not pgone"), "word").where(fits & (forward | ~F.col("igone")))
    back = index.where("not igone").join(probe.where("pgone"), "word").where(fits & ~forward)
    ordered = [F.when(forward, F.col(a)).otherwise(F.col(b)).alias(c) for c, a, b in zip(PAIR, ("idoc_id", "iline_no", "pdoc_id", "pline_no"), ("pdoc_id", "pline_no", "idoc_id", "iline_no"), strict=True)]
    return [left.select(*ordered), back.select(*ordered)]


def likely(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose doc_id may be in `wanted`, by BITS bits of its hashes; these don't grow with the data."""
    bit = F.xxhash64("doc_id").bitwiseAND(F.lit(BITS - 1)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)))
    found = {r.at: r.bits for r in wanted.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(one).alias("bits")).collect()}
    bits = F.from_json(F.lit(str([found.get(i, 0) for i in range(BITS // 64)])), "array<bigint>")
    return docs.where(F.get(bits, F.shiftright(bit, 6)).bitwiseAND(one) != 0)


def confirm(pairs: DataFrame, docs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The later line of each pair whose sets have a similarity of 0.8 or more."""
    ends = pairs.select(F.col("xdoc_id").alias("doc_id"), F.col("xline_no").alias("line_no")).union(pairs.select("ydoc_id", "yline_no"))
    wanted = ends.groupBy("doc_id").agg(F.collect_set("line_no").alias("wanted"))
    wanted = scratch.write(wanted, f"{name}-wanted")
    parts = plain(likely(docs, wanted), "doc_id").join(wanted, "doc_id").select("doc_id", F.split("text", "\n").alias("parts"), "wanted")
    lines = parts.select("doc_id", F.explode(F.transform("wanted", lambda i: F.struct(i.alias("line_no"), F.get("parts", i).alias("line")))).alias("own"))
    sets = scratch.write(lines.select("doc_id", "own.line_no", hashed(F.col("own.line")).alias("h")), f"{name}-sets")
    x = pairs.join(sets.withColumnsRenamed({"doc_id": "xdoc_id", "line_no": "xline_no", "h": "xh"}), ["xdoc_id", "xline_no"])
    both = x.join(sets.withColumnsRenamed({"doc_id": "ydoc_id", "line_no": "yline_no", "h": "yh"}), ["ydoc_id", "yline_no"])
    alike = both.where(9 * F.size(F.array_intersect("xh", "yh")) >= 4 * (F.size("xh") + F.size("yh")))
    later = scratch.write(alike.select(F.col("ydoc_id").alias("doc_id"), F.col("yline_no").alias("line_no")).distinct(), name)
    scratch.drop(f"{name}-sets", f"{name}-wanted")
    return later


def kept_lines(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id and `keep`, the numbers of its lines that have words and resemble no earlier line.

    doc_id must be a key of `docs`."""
    at = ["doc_id", "line_no"]
    counts = scratch.write(word_counts(docs), "counts")
    classes = scratch.write(classes_of(docs, counts).where("size > 0"), "classes")
    pairs = scratch.write(first_pairs(classes).distinct(), "first-pairs")
    gone = confirm(pairs, docs, scratch, "gone")
    marked = scratch.write(classes.join(gone.withColumn("gone", F.lit(True)), at, "left").withColumn("gone", F.col("gone").isNotNull()), "marked")
    scratch.drop("classes", "first-pairs")
    for part in rest_pairs(marked):
        pairs = scratch.write(part.distinct(), "rest-pairs", "append")
    late = confirm(pairs, docs, scratch, "late")
    keep = marked.where("not gone").select(*at).join(late, at, "left_anti").groupBy("doc_id").agg(F.collect_set("line_no").alias("keep"))
    found = scratch.write(keep, "keep")
    scratch.drop("marked", "rest-pairs", "gone", "late")
    return found


def judge_lines(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, line_no, kept of every line that has words; see judge_documents."""
    judged = judge_documents(docs, scratch).select("doc_id", "removed", F.explode("worded").alias("line_no"))
    return judged.select("doc_id", "line_no", (~F.array_contains("removed", F.col("line_no"))).alias("kept"))


def judge_documents(docs: DataFrame, scratch: Scratch, *more: str) -> DataFrame:
    """Per row doc_id, `worded` (the numbers of its lines that have words), `removed` (those of them
    that are removed) and the columns `more`.

    Words stand between spaces, tabs and returns and count in lower case. The order of
    lines is by doc_id, then number. A line is removed if its set, or one of
    similarity 0.8 or more, stands in an earlier line, removed or not. Lines without words are
    kept. Null texts have no lines, empty ones one without words. Rows that share a
    doc_id follow each other in the order of their texts' digests, and only those of equal
    texts are judged alike; rows without an id take no part and are kept.
    Other columns don't matter.
    """
    keyed, repeated = with_keys(docs.select("doc_id", "text", *more))
    own = keyed.where("doc_id is not null and text is not null").select(F.col("_at").alias("doc_id"), "text")
    keep = kept_lines(own.dropDuplicates(["doc_id"]) if repeated else own, scratch).withColumnRenamed("doc_id", "_at")
    numbers = F.transform(F.split("text", "\n"), lambda line, i: F.when(F.trim(line, F.lit(" \t\r\f\x0b")) != "", i))
    worded = F.coalesce(F.filter(numbers, lambda i: i.isNotNull()), F.array().cast("array<int>"))
    removed = F.when(F.col("doc_id").isNotNull(), F.array_except("worded", F.coalesce("keep", F.array().cast("array<int>")))).otherwise(F.array().cast("array<int>"))
    return keyed.select("doc_id", "_at", worded.alias("worded"), *more).join(keep, "_at", "left").select("doc_id", "worded", removed.alias("removed"), *more)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows without their removed lines; a row that loses all its words goes.

    Rows whose text is null, empty or blank stay as they are. See judge_documents.
    """
    # the rows travel as one struct, so that their columns' names can't clash
    rows = docs.select("doc_id", "text", F.struct("*").alias("_row"))
    judged = judge_documents(rows, Scratch(docs.sparkSession, "line-dedup"), "_row")
    parts = F.split("_row.text", "\n")
    numbers = F.sequence(F.lit(0), F.size(parts) - 1)
    text = F.array_join(F.transform(F.array_except(numbers, "removed"), lambda i: F.get(parts, i)), "\n")
    cut = F.size("removed") > 0
    left = judged.where(~cut | (F.size("removed") < F.size("worded")))
    return left.select(F.when(cut, F.col("_row").withField("text", text)).otherwise(F.col("_row")).alias("_row")).select("_row.*")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines (with words), n_removed, removed (the numbers of the removed lines, comma-joined).

    See judge_documents; rows that share a doc_id, and those without one, are counted together."""
    judged = judge_documents(documents(spark, sf_dir), Scratch(spark, "line-dedup"))
    return judged.groupBy("doc_id").agg(
        F.sum(F.size("worded").cast("long")).alias("n_lines"),
        F.sum(F.size("removed").cast("long")).alias("n_removed"),
        F.array_join(F.array_sort(F.flatten(F.collect_list("removed"))), ",").alias("removed"),
    )


ORACLE = r"""
WITH l AS (
  SELECT doc_id, CAST(line_no - 1 AS INTEGER) AS line_no,
         list_sort(list_distinct(list_filter(string_split_regex(lower(line), '[ \t\r\f\v]+'), lambda w: w <> ''))) AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)
), c AS (
  SELECT w, len(w) AS n, min({'d': doc_id, 'l': line_no}) AS f FROM l WHERE len(w) > 0 GROUP BY w
), t AS (
  SELECT f, n, unnest(w) AS word FROM c
), d AS (
  SELECT word, count(*) AS df FROM t GROUP BY word
), r AS (
  SELECT f, n, word, row_number() OVER (PARTITION BY f ORDER BY df, word) AS nth FROM t JOIN d USING (word)
), g AS (
  SELECT f, n, word FROM r WHERE nth <= n - (4 * n + 4) // 5 + 1
), q AS (
  SELECT DISTINCT x.f AS xf, y.f AS yf FROM g x JOIN g y ON x.word = y.word
  WHERE x.f < y.f AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n
), p AS (
  SELECT DISTINCT yf AS f FROM q JOIN c x ON x.f = xf JOIN c y ON y.f = yf
  WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (x.n + y.n)
), k AS (
  SELECT f FROM c WHERE f NOT IN (SELECT f FROM p)
), j AS (
  SELECT doc_id, line_no, len(w) = 0 AS blank, len(w) = 0 OR {'d': doc_id, 'l': line_no} IN (SELECT f FROM k) AS kept FROM l
), s AS (
  SELECT doc_id, count(*) FILTER (NOT blank) AS n_lines, count(*) FILTER (NOT kept) AS n_removed,
         coalesce(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) FILTER (NOT kept), '') AS removed
  FROM j GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN s USING (doc_id)
"""
