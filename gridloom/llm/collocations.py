"""Phrase collocations from a prefix-free parse.

Texts are cut into chunks at words whose window of three words hashes to a trigger, so equal
passages are cut alike wherever they stand. A chunk reaches three words into the next one:
every phrase of up to four words lies whole in the chunk in which it begins, and is counted there
and nowhere else. Equal chunks become one entry of a dictionary with its frequency, and phrases are counted
inside the distinct chunks, weighted by it.

A phrase that is frequent enough has frequent parts only. So words are counted first, then pairs
of frequent words, then the phrases of frequent pairs; what is frequent enough so far is passed on as bits of
a fixed number of hash cells, which can let too much pass but nothing be missed. The last
count is by the phrases themselves and exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, documents, ship
from .textbytes import LOWER, RADIX, U, mix, pieces, text_buffer, word_spans

LIMIT = 2 << 20
ROWS = 4096
U8 = np.uint8
TRIGGER = 16
CELLS = 1 << 24
BLANK = np.isin(np.arange(256), [0x20, 9])
STOP = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\x0b\x0c\r"])


def gathered(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the spans one after another, offsets)."""
    off = np.concatenate(([0], np.cumsum(size)))
    return raw[np.repeat(begin - off[:-1], size) + np.arange(off[-1])], off


def strings(raw: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words from each place on; places near the end give numbers that mean nothing."""
    total = np.full(len(words), mix(np.array([n], U))[0])
    for k in range(n):
        total = mix(total * U(RADIX) + np.roll(words, -k))
    return total


def chunks(column: pa.Array, longest: int, trigger: int):
    """Per slice of the column: (row of each chunk, how many phrases begin in it, its text with a space between words)."""
    for a, b in pieces(column, LIMIT, ROWS):
        raw, off = text_buffer(column.slice(a, b - a))
        (hashes,), begin, stop = word_spans(raw, off, BLANK | STOP)
        if not len(hashes):
            continue
        row = np.searchsorted(off, begin, "right") - 1
        stops = np.cumsum(STOP[raw])[begin]
        fresh = np.concatenate(([True], (row[1:] != row[:-1]) | (stops[1:] != stops[:-1])))
        # a piece of text: no phrase reaches over its end
        first = np.flatnonzero(fresh)
        end = np.repeat(np.append(first[1:], len(hashes)), np.diff(np.append(first, len(hashes))))
        whole = np.arange(len(hashes)) + longest - 1 <= end
        cut = np.flatnonzero(fresh | whole & (windows(hashes, longest - 1) % U(trigger) == 0))
        own = np.diff(np.append(cut, len(hashes)))
        last = np.minimum(cut + own + longest - 1, end[cut])
        size = stop - begin
        # all words with a space behind each, then the chunks' parts of it
        spaced, place = gathered(np.append(LOWER[raw], U8(32)), begin, size + 1)
        spaced[place[1:] - 1] = 32
        text, at = gathered(spaced, place[cut], place[last] - 1 - place[cut])
        yield row[cut] + a, own, strings(text, at)


def parse(docs: DataFrame, longest: int, trigger: int) -> DataFrame:
    """The dictionary: lang, own (phrases of each length that begin in the chunk, if they don't reach over its end), chunk, freq."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            langs = batch.column(0)
            for row, own, text in chunks(batch.column(1), longest, trigger):
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(row)), pa.array(own, pa.int64()), text.cast(pa.string())], names=["lang", "own", "chunk"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(run, "lang string, own long, chunk string").groupBy("lang", "own", "chunk").agg(F.count("*").alias("freq"))


class Places:
    """The words of some chunks: hashes that hold the language too, and the places where phrases begin."""

    def __init__(self, batch: pa.RecordBatch):
        raw, off = text_buffer(batch.column(2))
        self.raw, self.lang, self.freq = raw, batch.column(0), batch.column(3).to_numpy()
        (words,), self.begin, self.stop = word_spans(raw, off, BLANK)
        self.row = np.searchsorted(off, self.begin, "right") - 1
        names = self.lang.dictionary_encode()
        seeds = np.array([int.from_bytes(n.encode()[:64], "little") * 0x9E3779B97F4A7C15 % (1 << 64) for n in names.dictionary.to_pylist()], U)
        self.words = mix(words + mix(seeds[names.indices.to_numpy()][self.row]))
        first = np.searchsorted(self.row, np.arange(len(off) - 1))
        self.owned = np.arange(len(self.row)) - first[self.row] < batch.column(1).to_numpy()[self.row]
        self.left = np.append(first[1:], len(self.row))[self.row] - np.arange(len(self.row))

    def hashes(self, n: int) -> np.ndarray:
        return windows(self.words, n) if n > 1 else self.words

    def whole(self, n: int) -> np.ndarray:
        """Where n words follow in the chunk, the place's own counted."""
        return self.left >= n


def passes(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    cell = hashes & U(8 * len(bits) - 1)
    return bits[(cell >> U(3)).astype(np.int64)] >> (cell & U(7)).astype(np.uint8) & 1 == 1


def frequent_from(p: Places, n: int, bits: list[np.ndarray], frequent: list) -> np.ndarray:
    """The places where a phrase of n words begins whose parts of up to len(bits) words may all be frequent."""
    k = min(n, len(bits))
    if not k:
        return p.whole(n)
    while len(frequent) < k:
        m = len(frequent) + 1
        frequent.append(passes(p.hashes(m), bits[m - 1]) & p.whole(m))
    ok = p.whole(n)
    for shift in range(n - k + 1):
        ok &= np.roll(frequent[k - 1], -shift)
    return ok


def batches_of(batches):
    for batch in batches:
        for a, b in pieces(batch.column(2), LIMIT, 1 << 15):
            yield Places(batch.slice(a, b - a))


def hashed_counts(dictionary: DataFrame, n: int, bits) -> DataFrame:
    """h, n: how often phrases of n words, by their hash, begin, those that may be frequent."""

    def run(batches):
        known = bits.value if bits else []
        for p in batches_of(batches):
            at = np.flatnonzero(p.owned & frequent_from(p, n, known, []))
            h, back = np.unique(p.hashes(n)[at], return_inverse=True)
            total = np.zeros(len(h), np.int64)
            np.add.at(total, back, p.freq[p.row[at]])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(total)], names=["h", "n"])

    return dictionary.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def cells_of(counts: DataFrame, least: int) -> np.ndarray:
    """CELLS bits: in which cells the hashes of frequent phrases fall; so many whatever the data."""
    cell = F.col("h").bitwiseAND(F.lit(CELLS - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(F.lit(63)).cast("int"))
    found = counts.where(F.col("n") >= least).groupBy(F.shiftright(cell, 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(CELLS // 64, np.int64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def spelled_counts(dictionary: DataFrame, longest: int, bits) -> DataFrame:
    """lang, words, phrase, f of phrases of 1 to `longest` words that may be frequent."""

    def run(batches):
        for p in batches_of(batches):
            frequent: list = []
            for n in range(1, longest + 1):
                at = np.flatnonzero(p.owned & frequent_from(p, n, bits.value, frequent))
                h, one, back = np.unique(p.hashes(n)[at], return_index=True, return_inverse=True)
                total = np.zeros(len(h), np.int64)
                np.add.at(total, back, p.freq[p.row[at]])
                at = at[one]
                text, off = gathered(p.raw, p.begin[at], p.stop[at + n - 1] - p.begin[at])
                yield pa.RecordBatch.from_arrays(
                    [p.lang.take(pa.array(p.row[at])), pa.array(np.full(len(at), n, np.int32)), strings(text, off).cast(pa.string()), pa.array(total)], names=["lang", "words", "phrase", "f"]
                )

    return dictionary.mapInArrow(run, "lang string, words int, phrase string, f long").groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(docs: DataFrame, scratch: Scratch, longest: int, least: int, trigger: int) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) of all phrases of 1 to `longest` words that occur `least` times, (lang, n) all words)."""
    spark = docs.sparkSession
    dictionary = scratch.write(parse(docs, longest, trigger), "dictionary")
    totals = scratch.write(dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n")), "totals")
    bits: list[np.ndarray] = []
    shared = None
    for n in (1, 2):
        counts = scratch.write(hashed_counts(dictionary, n, shared).where(F.col("n") >= least), f"hashed-{n}")
        bits.append(cells_of(counts, least))
        scratch.drop(f"hashed-{n}")
        if shared:
            shared.destroy()
        shared = spark.sparkContext.broadcast(list(bits))
    found = scratch.write(spelled_counts(dictionary, longest, shared).where(F.col("f") >= least), "frequent")
    shared.destroy()
    scratch.drop("dictionary")
    return found, totals


def part(words, start, size):
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, cover: int = 80, top: int = 2000, scale: int = 2_000_000, trigger: int = TRIGGER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` best phrases of each language.

    A-Z counts as a-z. Texts are cut at . , ; : ! ? and line ends into pieces and those at spaces and tabs into
    words. Per language (null: `und`), n counts all words and f(phrase) its contiguous occurrences
    within pieces, overlaps included. Candidates have 2 to `longest` words and a = f(phrase) >= least. Of
    the cuts of a candidate into two parts, l and r times frequent, that with the least score
    floor(scale * a / (l + r)) counts, the earliest among equals. A candidate goes whose words
    stand in any longer candidate with 100 * f(longer) >= cover * a. Order: score, then a,
    downward, then phrase. Null and empty texts have no words; repeated rows count again; an empty table gives an
    empty result; other columns and missing ids don't matter. Counts and products are exact.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    found, totals = frequent_phrases(docs, scratch, longest, least, trigger)
    split = F.split("phrase", " ")
    some = found.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    cuts = some.select("lang", "phrase", "words", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", part(split, F.lit(1), F.col("k")).alias("left"), part(split, F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    f = found.select("lang", "phrase", "f")
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # parts occur as often as the whole at least, so the score is no more than half of `scale`; products take 38 digits
    score = F.expr(f"cast(a as decimal(28,0)) * {scale} div (l + r)").cast("long")
    best = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = some.where("words > 2").select("lang", "words", "a", split.alias("w"), F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
    inner = inner.select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("start"))
    covered = inner.select("lang", part(F.col("w"), F.col("start"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(covered, ["lang", "phrase"], "left").where(F.coalesce(F.expr(f"cast(longer as decimal(28,0)) * 100 < cast(a as decimal(28,0)) * {cover}"), F.lit(True)))
    ranked = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's 2,000 best phrases of 2 to 4 words; see collocations."""
    return collocations(documents(spark, sf_dir))


ORACLE = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM t
), g AS (
  SELECT lang, k AS words, unnest(list_transform(range(1, CAST(len(w) - k + 2 AS BIGINT)), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)
), f AS (
  SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang
), c AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 30
), k AS (
  SELECT lang, words, phrase, a, w, unnest(range(1, words)) AS k FROM c
), s AS (
  SELECT k.lang, k.words, k.phrase, a, k, x.f AS l, y.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(w[1:k], ' ')
         JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
), b AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM s
), i AS (
  SELECT lang, a, w, size, unnest(range(1, CAST(words - size + 2 AS BIGINT))) AS start
  FROM (SELECT lang, words, a, w, unnest(range(2, words)) AS size FROM c)
), v AS (
  SELECT lang, array_to_string(w[start:start + size - 1], ' ') AS phrase, max(a) AS longer FROM i GROUP BY ALL
), o AS (
  SELECT b.lang, b.phrase, a, l, r, score,
         row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN v ON v.lang = b.lang AND v.phrase = b.phrase
  WHERE nth = 1 AND (longer IS NULL OR 100 * longer < 80 * a)
)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""
