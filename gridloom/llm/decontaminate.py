"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of whole documents in one partition. Its words become symbols;
words that no benchmark phrase holds end a segment, since no phrase can span
them. Over the segments a suffix array, the Burrows-Wheeler transform, a wavelet
matrix for ranks and sampled suffix positions are built. All phrases are searched
backward at once, occurrences are located by walking to sampled positions, and
overlapping spans are merged. No step shuffles documents. Words are known by 64-bit hashes. Phrases are made by Spark
in blocks of bounded size, each a file of arrays in the shared folder. A shard is indexed once and searched for one block after
another; a worker holds the blocks it read last, up to a bound.
"""

from __future__ import annotations

import io
import re
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, fetch, lean, put, ship
from .textbytes import U, pieces, text_buffer, word_hashes

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: All bytes but ASCII letters and digits and those of other characters end a word.
ENDS = np.array([not WORD.match(bytes([b])) for b in range(256)])
SAMPLE = 8
HELD = 64 << 20


class Phrases:
    """Benchmark windows as rows of word hashes (0 behind the last), and the items that hold each.

    `items` are numbers of `names`; an item without a name is searched and has no number."""

    def __init__(self, words: np.ndarray, length: np.ndarray, start: np.ndarray, items: np.ndarray, names: list[str]):
        self.words, self.length, self.start, self.items, self.names = words, length, start, items, names
        self.shortest = int(length.min()) if len(length) else 0

    @classmethod
    def of(cls, names: list[str | None], texts: pa.Array, window: int) -> Phrases:
        hashes, first = word_hashes(*text_buffer(texts), ENDS)[:2]
        count = np.diff(first)
        runs = np.where(count > 0, np.maximum(1, count - window + 1), 0)
        owner = np.repeat(np.arange(len(count)), runs)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
        place = (first[:-1][owner] + inside)[:, None] + np.arange(window)
        length = np.minimum(count[owner], window)
        rows = np.append(hashes, U(0))[np.where(np.arange(window) < length[:, None], place, len(hashes))]
        rows, back = np.unique(np.column_stack((length.astype(U), rows)), axis=0, return_inverse=True)
        known = sorted({n for n in names if n is not None})
        at = {n: i for i, n in enumerate(known)}
        number = np.array([-1 if n is None else at[n] for n in names], np.int64)[owner]
        named = np.unique(np.column_stack((back.ravel(), number))[number >= 0], axis=0).reshape(-1, 2)
        return cls(rows[:, 1:], rows[:, 0].astype(np.int64), np.searchsorted(named[:, 0], np.arange(len(rows) + 1)), named[:, 1], known)

    def packed(self) -> bytes:
        out, name = io.BytesIO(), [n.encode() for n in self.names]
        sizes = np.array([len(n) for n in name], np.int64)
        np.savez(out, words=self.words, length=self.length, start=self.start, items=self.items, name=np.frombuffer(b"".join(name), np.uint8), sizes=sizes)
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Phrases:
        with np.load(io.BytesIO(data)) as f:
            end = np.cumsum(f["sizes"]).tolist()
            name = f["name"].tobytes()
            return cls(f["words"], f["length"], f["start"], f["items"], [name[a:b].decode() for a, b in zip([0, *end], end, strict=False)])

    def numbered(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrases that have only words among the sorted hashes `known`, their words' numbers there from 1 on)."""
        at = np.minimum(np.searchsorted(known, self.words), len(known) - 1)
        missing = (known[at] != self.words) & (np.arange(self.words.shape[1]) < self.length[:, None])
        some = np.flatnonzero(~missing.any(1))
        return some, at[some] + 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order by prefix doubling. 0 ends a segment and counts as smaller the
    earlier it stands, so no comparison passes the end of a segment."""
    n = len(text)
    ends = np.cumsum(text == 0)
    rank = np.where(text == 0, ends - 1, ends[-1] + text - 1).astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Backward search over segments of symbols 1..sigma that 0 ends."""

    def __init__(self, text: np.ndarray, starts: np.ndarray):
        sa = suffix_array(text)
        bwt = text[sa - 1]
        self.n, top = len(text), int(text.max())
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.levels = max(1, top.bit_length())
        self.ones, self.zeros, left = [], [], bwt
        for level in range(self.levels - 1, -1, -1):
            bit = (left >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            left = np.concatenate((left[bit == 0], left[bit == 1]))
        self.bwt = bwt
        inside = np.arange(self.n) - starts[np.searchsorted(starts, np.arange(self.n), "right") - 1]
        self.sampled = inside[sa] % SAMPLE == 0
        self.place = np.where(self.sampled, sa, -1)[self.sampled]
        self.nth = np.cumsum(self.sampled) - 1

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transform."""
        begin = np.zeros(len(at), np.int64)
        for k in range(self.levels):
            bit = (symbol >> (self.levels - 1 - k)) & 1 == 1
            ones, zeros = self.ones[k], self.zeros[k]
            at = np.where(bit, zeros + ones[at], at - ones[at])
            begin = np.where(bit, zeros + ones[begin], begin - ones[begin])
        return at - begin

    def search(self, symbols: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place) of every occurrence of the phrases, rows of symbols of which the first `length` count."""
        live = np.arange(len(length))
        lo, hi = np.zeros(len(live), np.int64), np.full(len(live), self.n, np.int64)
        done = []
        for back in range(1, symbols.shape[1] + 1):
            over = length[live] < back
            done.append((live[over], lo[over], hi[over]))
            live, lo, hi = live[~over], lo[~over], hi[~over]
            symbol = symbols[live, length[live] - back]
            lo = self.first[symbol] + self.rank(symbol, lo)
            hi = self.first[symbol] + self.rank(symbol, hi)
            some = lo < hi
            live, lo, hi = live[some], lo[some], hi[some]
        done.append((live, lo, hi))
        live, lo, hi = (np.concatenate(x) for x in zip(*done, strict=True))
        size = hi - lo
        rows = np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        return np.repeat(live, size), self.locate(rows)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        place, steps = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            hit = self.sampled[rows]
            place[open_[hit]] = self.place[self.nth[rows[hit]]] + steps[open_[hit]]
            open_, rows = open_[~hit], rows[~hit]
            steps[open_] += 1
            symbol = self.bwt[rows]
            rows = self.first[symbol] + self.rank(symbol, rows)
        return place


class Shard:
    """The words of some texts: how many each text has, and an index of the runs of those that the benchmark holds."""

    def __init__(self, texts: pa.Array, vocabulary: np.ndarray, shortest: int):
        hashes, first = word_hashes(*text_buffer(texts), ENDS)[:2]
        self.counts, self.index = np.diff(first), None
        if not len(vocabulary) or not len(hashes):
            return
        known = vocabulary[np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)] == hashes
        # runs of such words within a text
        open_ = np.zeros(len(hashes) + 1, bool)
        open_[first] = True
        edge = known & (open_[:-1] | ~np.concatenate(([False], known[:-1])))
        last = known & (open_[1:] | ~np.concatenate((known[1:], [False])))
        start, end = np.flatnonzero(edge), np.flatnonzero(last) + 1
        keep = end - start >= shortest
        start, size = start[keep], end[keep] - start[keep]
        if not len(start):
            return
        at = np.concatenate(([0], np.cumsum(size + 1)))
        text, self.origin = np.zeros(at[-1], np.int64), np.zeros(at[-1], np.int64)
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        target = np.repeat(at[:-1], size) + inside
        self.origin[target] = np.repeat(start, size) + inside
        self.words, numbers = np.unique(hashes[self.origin[target]], return_inverse=True)
        text[target] = numbers + 1
        self.first, self.index = first, FMIndex(text, at[:-1])

    def search(self, phrases: Phrases) -> dict[int, tuple[list[int], list[tuple[int, int]]]]:
        """{text: (phrases that occur, merged word spans)}."""
        hits: dict[int, tuple[list[int], list[tuple[int, int]]]] = {}
        if self.index is None or not phrases.shortest:
            return hits
        some, symbols = phrases.numbered(self.words)
        phrase, place = self.index.search(symbols, phrases.length[some])
        if not len(phrase):
            return hits
        phrase, place = some[phrase], self.origin[place]
        order = np.argsort(place, kind="stable")
        phrase, place = phrase[order], place[order]
        owner = np.searchsorted(self.first, place, "right") - 1
        reach = np.maximum.accumulate(place + phrases.length[phrase])
        cut = np.concatenate(([0], np.flatnonzero((place[1:] > reach[:-1]) | (owner[1:] != owner[:-1])) + 1, [len(place)]))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            doc = int(owner[a])
            which, spans = hits.setdefault(doc, ([], []))
            which.extend(np.unique(phrase[a:b]).tolist())
            spans.append((int(place[a] - self.first[doc]), int(reach[b - 1] - self.first[doc])))
        return hits


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in WORD.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, text[last:]])


def benchmark_blocks(benchmark: DataFrame, block_bytes: int, window: int) -> tuple[list[str], str]:
    """The distinct items as files of Phrases, of about `block_bytes` of text at most, and the file of their words' hashes.

    Tasks write them; the driver sees the blocks' names only."""
    spark = benchmark.sparkSession
    scratch = Scratch(spark, "benchmark")
    folder = scratch.path("phrases")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))

    def write(table: pa.Table) -> pa.Table:
        uri = f"{folder}/{table.column('block')[0].as_py()}"
        put(uri, [Phrases.of(table.column("item_id").to_pylist(), table.column("text").combine_chunks(), window).packed()])
        return pa.table({"uri": [uri]})

    def words(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(word_hashes(*text_buffer(batch.column(0)), ENDS)[0]).view(np.int64))], names=["h"])

    blocks = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))).groupBy("block")
    found = sorted(r.uri for r in blocks.applyInArrow(write, "uri string").collect())
    scratch.write(items.select("text").mapInArrow(lean(words), "h long").distinct(), "vocabulary")
    return found, scratch.path("vocabulary")


def vocabulary(uri: str) -> np.ndarray:
    """The sorted hashes of all words of the benchmark, eight bytes a word."""
    fs, path = pafs.FileSystem.from_uri(uri)
    parts = [f.path for f in fs.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".parquet")]
    found = [pq.read_table(p, filesystem=fs).column("h").to_numpy() for p in parts]
    return np.sort(np.concatenate(found).astype(np.int64).view(U)) if found else np.zeros(0, U)


class Blocks:
    """Blocks of phrases by address; those read last stay, up to HELD bytes."""

    def __init__(self):
        self.held: OrderedDict[str, tuple[int, Phrases]] = OrderedDict()

    def __getitem__(self, uri: str) -> Phrases:
        if uri not in self.held:
            data = fetch(uri)
            self.held[uri] = len(data), Phrases.unpacked(data)
            while len(self.held) > 1 and sum(n for n, _ in self.held.values()) > HELD:
                self.held.popitem(last=False)
        self.held.move_to_end(uri)
        return self.held[uri][1]


def scan(docs: DataFrame, benchmark: DataFrame, window: int, shard_bytes: int, block_bytes: int, schema: str, kept: list[str], make) -> DataFrame:
    """Searches every shard for every block of phrases; `make(part, column, counts, items, spans)`
    gives the columns of `schema` for the rows of a shard, of which `kept` are read."""
    ship(docs.sparkSession)
    blocks, words = benchmark_blocks(benchmark, block_bytes, window)

    def run(batches):
        known, held = vocabulary(words), Blocks()
        shortest = min((p.shortest for p in (held[uri] for uri in blocks) if p.shortest), default=0)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            for a, b in pieces(column, shard_bytes):
                part = batch.slice(a, b - a)
                items: list[set[str]] = [set() for _ in range(b - a)]
                spans: list[list[tuple[int, int]]] = [[] for _ in range(b - a)]
                shard = Shard(column.slice(a, b - a), known, shortest)
                for uri in blocks:
                    phrases = held[uri]
                    for doc, (which, found) in shard.search(phrases).items():
                        items[doc].update(phrases.names[i] for k in which for i in phrases.items[phrases.start[k] : phrases.start[k + 1]])
                        spans[doc].extend(found)
                yield make(part, column.slice(a, b - a), shard.counts, items, [merge(s) for s in spans])

    return docs.select(*kept).mapInArrow(lean(run), schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_bytes: int = 24 << 20, block_bytes: int = 16 << 20) -> DataFrame:
    """Per document: doc_id, n_words, items that occur, merged word spans.

    Words are runs of ASCII letters, digits and non-ASCII characters, lower-cased in
    A-Z only. Windows are `window` words; a shorter item is one window, an item
    without words none. Null or empty text: no words, no spans.
    Repeated rows are each judged; an empty table gives an empty table; items without an id are searched like
    others but not among the named ones; items with null text have no words; other columns of either table don't matter.
    """

    def make(part, column, counts, items, spans):
        return pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array(counts, pa.int64()),
                pa.array([sorted(s) for s in items], pa.list_(pa.string())),
                pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ],
            names=["doc_id", "n_words", "items", "spans"],
        )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, items array<string>, spans array<struct<start:long,end:long>>"
    return scan(docs, benchmark, window, shard_bytes, block_bytes, schema, ["doc_id", "text"], make)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_bytes: int = 24 << 20, block_bytes: int = 16 << 20) -> DataFrame:
    """The rows, of all their columns, with the merged spans cut out of text; a row that
    loses its last word goes. Other rows, null and empty texts included, stay as they are."""
    columns = docs.columns

    def make(part, column, counts, items, spans):
        changed = [i for i, s in enumerate(spans) if s]
        texts = {i: cut_words(column[i].as_py().encode(), spans[i]) for i in changed}
        stay = np.ones(len(spans), bool)
        stay[[i for i in changed if not WORD.search(texts[i])]] = False
        text = column.cast(pa.string())
        if changed:
            mask = np.zeros(len(spans), bool)
            mask[changed] = True
            text = pc.replace_with_mask(text, pa.array(mask), pa.array([texts[i].decode() for i in changed], pa.string()))
        arrays = [text if c == "text" else part.column(i) for i, c in enumerate(columns)]
        return pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(stay))

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return scan(docs, benchmark, window, shard_bytes, block_bytes, schema, columns, make)


def items_digest(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", F.array_sort(items)), 256)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document; see find_contamination."""
    found = find_contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        items_digest(F.col("items")).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
