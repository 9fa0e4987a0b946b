import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm import helpers as h

from gridloom.llm import decontaminate, line_dedup, near_dedup, packing, textbytes, token_counts, token_files, tokens
from gridloom.llm.common import Scratch

LONG = "long word " * 200_000
ODD = [None, "", " ", "\n\n", "A.", "A.", "the cat sat on the mat and looked at the dog\nthe cat", LONG, "x" * 1_500_000, "é ÉCLAIR ½ <|endoftext|> \x1c don't  stop\t\r\n", "the cat sat on the mat and looked at the dog"]


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def words(rng, n, size=30):
    return " ".join(rng.choice([f"w{i}" for i in range(size)]) for _ in range(n))


def copies(seed=3, groups=12):
    """Groups of texts, each an edit of the group's first."""
    rng, out = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}x{i}" for i in range(rng.choice((3, 12, 40)))]
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(50)}"
            out.append(" ".join(w))
    rng.shuffle(out)
    return out


def test_word_hashes(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab c\nXÿ é") for _ in range(rng.randint(0, 200))) for _ in range(40)] + [None, "", "x" * 500]
    raw, off = textbytes.text_buffer(pa.array(texts))
    want = textbytes.word_hashes(raw, off, textbytes.SPACE, (3,))
    monkeypatch.setattr(textbytes, "STEP", 64)
    for a, b in zip(want, textbytes.word_hashes(raw, off, textbytes.SPACE, (3,)), strict=True):
        assert (a == b).all()
    seen = {}
    for i, t in enumerate(texts):
        split = (t or "").encode().split()
        own = want[0][want[1][i] : want[1][i + 1]]
        assert len(own) == len(split)
        for w, x in zip(split, own.tolist(), strict=True):
            assert seen.setdefault(bytes(textbytes.LOWER[np.frombuffer(w, np.uint8)]), x) == x
    assert len(set(seen.values())) == len(seen)
    one = pa.array(["y" * (5 << 20)])
    assert len(textbytes.word_hashes(*textbytes.text_buffer(one), textbytes.SPACE)[0]) == 1


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    rng, encoder = random.Random(2), tokens.Encoder(tokens.vocabulary(name), "<u4", 50)
    wide = [chr(c) for a, b in ((0x80, 0x250), (0x250, 0x3000)) for c in rng.sample(range(a, b), 60)]
    alphabet = [*wide, *" \n\t'sStTrReEvVmMlLdD_-.,!9½²Ⅷé́ÉİΣσßñÑ日本　\xa0\x1c\x85٣…", "​", " ", "the ", "'ll ", "  ", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for t in [*texts, *(x for x in ODD if x and len(x) < 1000)]:
        assert encoder.encode(t) == np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def library_ids(name, text, end=2):
    from tokenizers import Tokenizer

    return np.array([*Tokenizer.from_file(tokens.vocabulary(name)).encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_token_files(spark):
    docs = h.docs_of(spark, [*ODD, "last"], ids=[5, 3, 3, 9, None, 1, 2, 4, 6, 7, 8, 3]).repartition(3)
    scratch = Scratch(spark, "test")
    files = token_files.write_token_files(docs, scratch.path("ids"), tokens.vocabulary("word_bpe_49k.json"), 2)
    got = sorted(token_files.read_token_files(spark, files, True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3, 3, 4, 5, 6, 7, 8, 9]
    at, texts = 0, {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4"))
        at += r.n_tokens
        if r.doc_id != 3:
            assert r.ids == library_ids("word_bpe_49k.json", texts[r.doc_id]).tolist()
    none = token_files.write_token_files(docs.limit(0), scratch.path("none"), tokens.vocabulary("word_bpe_49k.json"), 2)
    assert token_files.read_token_files(spark, none).count() == 0


def test_token_counts(spark):
    vocab = tokens.vocabulary("byte_bpe_50k.json")
    begin, inner = map(set, token_counts.word_pieces(vocab))

    def plain(word):
        n, i = 0, 0
        while i < len(word):
            j = next((j for j in range(min(len(word), i + 40), i, -1) if word[i:j] in (inner if i else begin)), None)
            if j is None:
                return 1
            n, i = n + 1, j
        return n

    texts = [t for t in ODD if t is None or len(t) < 1000] + ["thationing unbelievable ÿÿÿ \x00\x01"]
    got = rows(token_counts.count_tokens(h.docs_of(spark, texts), vocab))
    for i, t in enumerate(texts):
        split = (t or "").encode().split()
        assert (got[i].n_words, got[i].n_tokens) == (len(split), sum(map(plain, split)))
    small = token_counts.LongestMatch([b"a", b"abcd"], [b"b", b"c", b"bc"])
    assert [small.count(w) for w in (b"abcd", b"abc", b"abcb", b"x", b"abcx", b"")] == [1, 2, 3, None, None, 0]
    assert token_counts.count_tokens(h.docs_of(spark, []), vocab).count() == 0


def test_token_counts_without_a_space_piece(spark):
    vocab = tokens.vocabulary("byte_bpe_50k.json")
    with open(vocab, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    letters = token_counts.byte_alphabet()
    made = {bytes(letters[c] for c in t) for t in vocabulary if all(c in letters for c in t)}
    spaced, other = {t[1:] for t in made if t[:1] == b" " and len(t) > 1}, {t for t in made if t[:1] != b" "}

    def longest(word, among):
        return next((k for k in range(min(len(word), 130), 0, -1) if word[:k] in among), 0)

    def plain(word):
        at = longest(word, spaced)
        n = int(at > 0)
        while at < len(word):
            at, n = at + longest(word[at:], other), n + 1
        return n

    texts = ["рядом стоит человек", "中文没有空格的一行文字", "한국어 문장", "日本語 ありがとう", "😀🎉 👩‍👩‍👧 𝒳", "हिन्दी ไทย", "\x01\x02", "Ԁ ׀ ﷽ naïve"]
    got = rows(token_counts.count_tokens(h.docs_of(spark, texts), vocab))
    for i, t in enumerate(texts):
        assert (got[i].n_tokens, got[i].n_unknown) == (sum(map(plain, t.encode().split())), 0), t
    assert got[1].n_tokens > 5 and got[0].n_tokens > 6


def test_packing(spark):
    rng = random.Random(5)
    docs = h.docs_of(spark, [t for t in ODD if t is None or len(t) < 1_000_000] + [LONG] + [words(rng, rng.randint(0, 60)) for _ in range(200)])
    got = packing.pack(docs, tokens.vocabulary("byte_bpe_50k.json"), size=128).collect()
    texts, pieces, sequences = {r.doc_id: r.text for r in docs.collect()}, {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for i, t in texts.items():
        ids, own = library_ids("byte_bpe_50k.json", t), sorted(pieces[i], key=lambda r: r.piece)
        total += len(ids)
        assert [r.piece for r in own] == list(range(len(own))) and [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        assert all(r.length == 128 for r in own[1:]) and sum(r.length for r in own) == len(ids) and (len(ids) > 128) == (len(own) > 1)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length]) for r in own)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 128
    assert len(sequences) <= 1.02 * -(-total // 128) + 1
    assert packing.pack(docs.limit(0), tokens.vocabulary("byte_bpe_50k.json")).count() == 0


def test_a_shard_is_indexed_once(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i if i % 3 else None, words(rng, 14, 12)) for i in range(60)]
    texts = [words(rng, 200, 12) + " " + items[i][1] for i in range(12)]
    docs, bench = h.docs_of(spark, texts).coalesce(1), spark.createDataFrame(items, "item_id long, text string")
    uris, vocabulary = decontaminate.benchmark_blocks(bench, 80, 10)
    assert len(uris) >= 15
    known, held = decontaminate.vocabulary(vocabulary), decontaminate.Blocks()
    assert len(known) == len({w for _, t in items for w in t.split()})
    built = []
    init = decontaminate.FMIndex.__init__
    monkeypatch.setattr(decontaminate.FMIndex, "__init__", lambda self, *a: (built.append(1), init(self, *a))[1])
    shard = decontaminate.Shard(pa.array(texts), known, min(held[u].shortest for u in uris))
    spans: dict[int, list] = {}
    for u in uris:
        for doc, (_, found) in shard.search(held[u]).items():
            spans.setdefault(doc, []).extend(found)
    want = h.contamination(dict(enumerate(texts)), items)
    assert built == [1] and {i: sum(b - a for a, b in decontaminate.merge(spans.get(i, []))) for i in want} == {i: n for i, (_, n, _) in want.items()}
    assert any(n and not found for _, n, found in want.values())
    got = rows(decontaminate.find_contamination(docs, bench, block_bytes=80))
    assert {i: (sum(s.end - s.start for s in r.spans), set(r.items)) for i, r in got.items()} == {i: (n, {str(x) for x in found}) for i, (_, n, found) in want.items()}


def test_held_blocks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "HELD", 100)
    bench = spark.createDataFrame([(i, f"w{i} x y z") for i in range(40)], "item_id long, text string")
    uris, _ = decontaminate.benchmark_blocks(bench, 40, 10)
    held = decontaminate.Blocks()
    assert sorted(n for u in uris for n in held[u].names) == sorted(map(str, range(40))) and len(held.held) == 1


def test_patterns_fill_most_sequences():
    count = np.zeros(257, np.int64)
    count[1:] = np.random.default_rng(1).integers(50, 90, 256)
    plan = packing.Plan(count)
    assert plan.by_patterns > 0.5 * plan.sequences
    assert plan.sequences <= 1.01 * -(-int((count * np.arange(257)).sum()) // 256) + 1
    seen = set()
    for length in range(1, 257):
        s, o = plan.place(np.full(count[length], length), np.arange(count[length]))
        seen.update(zip(s.tolist(), o.tolist(), strict=True))
    assert len(seen) == count.sum()


def test_decontamination(spark):
    rng = random.Random(7)
    items = [(0, words(rng, 25)), (1, words(rng, 12)), (2, "only three words"), (2, "Only THREE words"), (3, None), (None, "x y z"), (4, "!!"), (5, "solo")]
    inside = items[0][1].split()
    texts = ["a " + " ".join(inside[3:15]) + ", z " + " ".join(inside[10:25]) + ".", items[1][1].upper(), "ONLY, three-Words only three words here", "solo", *ODD, *(words(rng, 60, 4) for _ in range(20))]
    items += [(6, words(rng, 10, 4)), (7, words(rng, 3, 2))]
    docs, bench = h.docs_of(spark, texts), spark.createDataFrame([(*x, "n") for x in items], "item_id long, text string, doc_id string")
    want = h.contamination(dict(enumerate(texts)), items)
    for block in (16 << 20, 60):
        got = rows(decontaminate.find_contamination(docs, bench, shard_bytes=400, block_bytes=block))
        for i, (n, hit, found) in want.items():
            assert (got[i].n_words, sum(s.end - s.start for s in got[i].spans), set(got[i].items)) == (n, hit, {str(x) for x in found}), texts[i]
    clean = rows(decontaminate.remove_contamination(docs, bench))
    assert clean[0].text == "a , z ." and 3 not in clean and 1 not in clean and clean[4].text is None and clean[4].items == "i"
    assert h.contamination({i: r.text for i, r in clean.items()}, items)[2][1] == 0
    assert decontaminate.find_contamination(docs.limit(0), bench).count() == 0
    assert all(not r.spans for r in decontaminate.find_contamination(docs, bench.limit(0)).collect())


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(spark, n):
    texts = [*copies(), *(t for t in ODD if t is None or len(t) < 1_000_000)]
    got = rows(near_dedup.near_duplicates(h.docs_of(spark, texts), words=n))
    want = h.near_components(dict(enumerate(texts)), n)
    for i, t in enumerate(texts):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(h.shingles(t, n)), want[i], want[i] == i)
    assert near_dedup.near_duplicates(h.docs_of(spark, [])).count() == 0


def test_near_duplicates_of_a_large_group(spark):
    rng, texts = random.Random(11), []
    for _ in range(150):  # most are linked with few of the others
        w = [f"a{i}" for i in range(60)]
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(60)] = f"z{rng.randrange(1000)}"
        texts.append(" ".join(w))
    got = rows(near_dedup.near_duplicates(h.docs_of(spark, texts)))
    assert {i: r.component_id for i, r in got.items()} == h.near_components(dict(enumerate(texts)), 2)


def test_a_large_bucket_of_unlinked_sets(spark):
    rng, sets = random.Random(19), []
    for i in range(3000):  # a third of each set is in all of them
        own = rng.sample(range(1000, 1_000_000), 40) if i % 50 else list(sets[-1][20:-1]) + [i] if sets else list(range(2000, 2040))
        sets.append([*range(20), *own])
    rows = [("k", bytes([i >> 8, i & 255]), len(s), bytes([i >> 8, i & 255]), [0] * 16) for i, s in enumerate(sets)]
    spread = spark.createDataFrame(rows, "key string, c binary, n long, comp binary, odd array<long>")
    full = spark.createDataFrame([(r[1], s) for r, s in zip(rows, sets, strict=True)], "c binary, shingles array<long>")
    got = {(bytes(r.a), bytes(r.b)) for r in near_dedup.open_pairs(spread, full, 80).collect()}
    linked = {(rows[i - 1][1], rows[i][1]) for i in range(50, 3000, 50)}
    assert linked <= got and len(got) < 300


def test_edits_of_one_text_in_a_large_bucket(spark):
    """Each is edited in own places: next to none are linked, though all share most of their words."""
    rng, sets = random.Random(23), []
    for i in range(700):
        own = rng.sample(range(100), 100 - rng.randint(14, 22))
        sets.append([*own, *range(1000 * i + 1000, 1000 * i + 1100 - len(own))])
    sets += [[*s[:-2], 2_000_000 + i] for i, s in enumerate(sets[::50])]  # fifteen links of unequal sizes
    ids = [bytes([i >> 8, i & 255]) for i in range(len(sets))]
    odd = near_dedup.parities([np.array(s, np.uint64) * np.uint64(0x9E3779B97F4A7C15) for s in sets]).tolist()
    spread = spark.createDataFrame([("k", c, len(s), c, o) for c, s, o in zip(ids, sets, odd, strict=True)], "key string, c binary, n long, comp binary, odd array<long>")
    full = spark.createDataFrame(list(zip(ids, sets, strict=True)), "c binary, shingles array<long>")
    got = {(bytes(r.a), bytes(r.b)) for r in near_dedup.open_pairs(spread, full, 80).collect()}
    linked = {(ids[i], ids[j]) for i in range(len(sets)) for j in range(i) for x, y in [(set(sets[i]), set(sets[j]))] if 100 * len(x & y) >= 80 * len(x | y)}
    linked = {(min(p), max(p)) for p in linked}
    assert len(linked) >= 14 and linked <= got and len(got) < len(linked) + 700, (len(linked), len(got))


def test_long_chains_are_one_component(spark):
    from gridloom.llm.graph import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (5, 5)], "a long, b long")
    got = {r.node: r.comp for r in components(edges, Scratch(spark, "test"), "chain").collect()}
    assert got == {i: 0 for i in range(101)} | {200: 200, 201: 200}


def test_line_dedup(spark):
    rng = random.Random(13)
    texts = [*(t for t in ODD if t is None or len(t) < 1_000_000)]
    pool = copies(17, 20)
    texts += ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 6))) for _ in range(40)]
    docs, want = h.docs_of(spark, texts), h.removed(dict(enumerate(texts)))
    judged = line_dedup.judge_lines(docs, Scratch(spark, "test")).collect()
    assert {(r.doc_id, r.line_no) for r in judged if not r.kept} == want and len(judged) == sum(bool(x.strip()) for t in texts if t is not None for x in t.split("\n"))
    left = rows(line_dedup.dedup_lines(docs))
    for i, t in enumerate(texts):
        kept = [x for k, x in enumerate((t or "").split("\n")) if (i, k) not in want]
        gone = t is not None and t.strip() and not "".join(kept).strip()
        assert (i in left) != bool(gone)
        if i in left:
            assert left[i].text == (None if t is None else "\n".join(kept)) and left[i].items == "i"
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    assert line_dedup.dedup_lines(h.docs_of(spark, ["x", "x"], ids=[None, None])).where(F.col("doc_id").isNull()).count() == 2


def lines_of(spark, texts, ids):
    return sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(h.docs_of(spark, texts, ids)).collect())


def test_lines_of_repeated_ids(spark):
    assert lines_of(spark, ["a b c d", "e f g h"], [1, 1]) == [(1, "a b c d"), (1, "e f g h")]
    assert len(line_dedup.judge_lines(h.docs_of(spark, ["a b c d", "e f g h"], [1, 1]), Scratch(spark, "test")).collect()) == 2
    assert lines_of(spark, ["a b c d e", "a b c d e", "p q r s t"], [0, 1, 1]) == [(0, "a b c d e"), (1, "p q r s t")]
    assert lines_of(spark, ["a b c d e", "a b c d e f", "p q r s t"], [0, 1, 1]) == [(0, "a b c d e"), (1, "p q r s t")]
    same = lines_of(spark, ["u v w x\nu v w x y"] * 3, [1, 1, 2])
    assert same == [(1, "u v w x")] * 2


def test_rows_that_share_an_id_are_judged_by_their_own_lines(spark):
    first, near, own = "a b c d e f g h i j", "a b c d e f g h i k", "only this row holds these words"
    docs = h.docs_of(spark, [first, own + "\nend", near + "\nlast", "n o", None], ids=[1, 2, 2, 3, None])
    left = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).where("doc_id is not null").collect())
    assert left == [(1, first), (2, "last"), (2, own + "\nend"), (3, "n o")]


def test_class_keys_are_independent(spark):
    m = (1 << 64) - 1
    p1, p2, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    turn = lambda x, n: (x << n | x >> (64 - n)) & m
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    step = lambda v: turn(v * p2 & m, 31) * p1 & m

    def seed(v):
        x = (turn((42 + p5 + 8) & m ^ step(v), 27) * p1 + p4) & m
        x = (x ^ x >> 33) * p2 & m
        x = (x ^ x >> 29) * 0x165667B19E3779F9 & m
        return ((x ^ x >> 32) + p5 + 8) & m

    other = turn((seed(1) ^ step(7) ^ seed(2)) * pow(p1, -1, 1 << 64) & m, 33) * pow(p2, -1, 1 << 64) & m
    sets = spark.createDataFrame([([1, 7],), ([2, signed(other)],)], "hashes array<long>")
    one, two = (tuple(r) for r in sets.select(*line_dedup.keys_of("hashes")).collect())
    assert one[0] == two[0] and one[1] != two[1]


def test_packing_with_a_bounded_memory_of_words(spark):
    rng = random.Random(31)
    docs, path = h.docs_of(spark, [words(rng, 300) for _ in range(6)] + [None, ""]), tokens.vocabulary("byte_bpe_50k.json")
    ids = lambda **more: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packing.pack(docs, path, **more).collect())
    assert ids(memo_words=3) == ids()
    small = tokens.Encoder(path, "<u2", 3)
    for i in range(50):
        small.encode(f"word{i} other{i} third{i}")
    assert max(len(x) + len(x.old) for x in (small.word, small.tail)) <= 6


def test_codes_of_words_are_sorted_as_plain_numbers(spark):
    rows = spark.range(1).select(F.array_repeat(F.lit(3).cast("tinyint"), line_dedup.CELLS).alias("counts"), F.array(F.xxhash64(F.lit("a")), F.xxhash64(F.lit("b"))).alias("h"))
    codes = rows.select(F.sort_array(F.transform("h", line_dedup.code_of)).alias("codes"))
    assert not codes.schema["codes"].dataType.containsNull
    assert [c >> 56 for c in codes.first().codes] == [3, 3]


def test_bits_of_a_set_bound_its_difference_and_no_word_is_folded_by_a_lambda(spark):
    rng = random.Random(41)
    pool = [f"w{i}" for i in range(400)]
    sets = [set(rng.sample(pool, rng.randint(1, 120))) for _ in range(20)]
    sets += [(s - set(rng.sample(sorted(s), len(s) // 9))) | {f"n{i}"} for i, s in enumerate(sets)]
    counts = spark.range(1).select(F.array_repeat(F.lit(3).cast("tinyint"), line_dedup.CELLS).alias("counts"))
    texts = [rng.choice(" \t\r").join(sorted(s)).upper() for s in sets]
    classes = line_dedup.classes_of(h.docs_of(spark, texts), counts)
    found = {r.doc_id: r for r in classes.collect()}
    assert [found[i].size for i in range(len(sets))] == [len(s) for s in sets]
    differ = lambda x, y: sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in ((x.low, y.low), (x.high, y.high)))
    for i, a in enumerate(sets):
        for k, b in enumerate(sets[:i]):
            assert differ(found[i], found[k]) <= len(a ^ b)
            assert len(a ^ b) < 60 or differ(found[i], found[k]) > 12
    plan = classes._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and "transform(slice(sort_array" not in plan


def test_places_of_bounds_are_not_in_one_method_of_a_whole_stage(spark):
    counts = spark.range(1).select(F.array_repeat(F.lit(3).cast("tinyint"), line_dedup.CELLS).alias("counts"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = line_dedup.classes_of(h.docs_of(spark, ["a b c d"]), counts)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    places = [x for x in plan.splitlines() if "array_position(" in x]
    assert places and not any("*(" in x for x in places)
