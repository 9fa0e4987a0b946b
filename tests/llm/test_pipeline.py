import os

import corpus_pipeline as pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm import helpers as h

from gridloom.llm import tokens
from gridloom.llm.common import lean, small_batches
from gridloom.llm.tokens import vocabulary

SF = "/root/testdata/sf0.001"


def test_stages_take_small_batches(spark):
    """Whole batches of 10,000 long texts took an executor's memory."""
    small_batches(spark)
    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("a b c d "), 1000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "b": [batch.nbytes]})

    found = texts.mapInArrow(sizes, "n long, b long").collect()
    assert sum(r.n for r in found) == 3000 and max(r.b for r in found) < 5 << 20


def test_a_worker_drops_encoders_of_steps_before():
    tokens.encoder(vocabulary("byte_bpe_50k.json"), "<u2")
    assert list(lean(iter, encoders=True)([1, 2])) == [1, 2] and tokens.encoder.cache_info().currsize == 1
    assert list(lean(iter)([3])) == [3] and tokens.encoder.cache_info().currsize == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")
def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(pipeline.STAGES) - 1:
            assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()} if "text" in docs.columns else docs.collect())
    named, lined, near, clean, packed = kept
    assert named == {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if any(c.isalpha() for c in r.text or "")}
    gone = h.removed(named)
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in named.items()}
    assert lined == {i: t for i, t in want.items() if t.strip() or not any((i, k) in gone for k in range(len(named[i].split("\n"))))}
    comps = h.near_components(lined, 5)
    assert near == {i: t for i, t in lined.items() if comps[i] == i}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = h.contamination(near, bench)
    for i, t in near.items():
        assert clean.get(i, "" if found[i][1] else None) == t if not found[i][1] else True
        if found[i][1] and i in clean:
            left = h.contamination({i: clean[i]}, [])[i][0]
            assert left == found[i][0] - found[i][1]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    sizes: dict[int, int] = {}
    for r in packed:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in clean.items()}


def test_texts_of_symbols_are_rejected(spark):
    texts = ["the end of the day", "und das ist ein Tag", "“”… €", "😀 👍🏽", "٠١٢٣", "\u00a0\u3000", "“я”"]
    docs = h.docs_of(spark, texts, langs=["en", "de", *[None] * 5])
    assert {r.text for r in pipeline.identify(spark, docs, "").collect()} == {t for t in texts if any(c.isalpha() for c in t)}


#: Columns that bear names of what the operators add, and of what the stages use themselves.
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred int, kept string, removed string, `_row` string, items int, component_id string"
PASSAGE = "the quick brown fox jumps over the lazy dog and runs away from here at once"
ODD_TEXTS = [
    (1, "the end of the day and the start of the night in the town of the hills"),
    (1, "the end of the day and the start of the night in the town of the hills"),  # a repeated row
    (1, "something else that has the same id but no like words at all in it"),
    (None, "a row without any id that is kept by all the stages of the pipeline"),
    (None, "the end of the day and the start of the night in the town of the hills"),
    (4, "the end of the day and the start of the night in the town of the hill"),
    (5, None),
    (6, ""),
    (7, " \n\t "),
    (8, f"before it {PASSAGE} and after it there are more words of the own kind"),
    (9, PASSAGE),
    (10, "word " * 60_000),
]


def odd_docs(spark):
    rows = [(i, t, "en" if k % 2 else None, "s", len(t or ""), f"own{k}", k, "k", "r", "row", 3, "c") for k, (i, t) in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows, ODD_SCHEMA)


@pytest.fixture(scope="module")
def with_benchmark(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(1, PASSAGE, "x"), (None, "an item without id that stands in no document at all, not anywhere here", "y")], "item_id long, text string, doc_id string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder)


def kept(df, docs):
    assert df.columns == docs.columns and df.dtypes == docs.dtypes
    return sorted((r.score, r.doc_id, r.text) for r in df.collect())


def test_stages_on_odd_rows(spark, with_benchmark):
    docs = odd_docs(spark)
    rows = {f"own{k}": (i, t) for k, (i, t) in enumerate(ODD_TEXTS)}
    named = {r.score: r for r in pipeline.identify(spark, docs, "").collect()}
    # own columns called like the model's results keep their values
    assert set(named) == {k for k, (_, t) in rows.items() if any(c.isalpha() for c in t or "")} and all(r.lang_pred == int(k[3:]) and r.lang == "en" and r.text == rows[k][1] for k, r in named.items())
    lined = {s: (i, t) for s, i, t in kept(pipeline.drop_lines(spark, docs, ""), docs)}
    # equal rows of one id are judged alike, rows without an id take no part, the near line of row 4 goes with its text
    assert set(lined) == set(rows) - {"own5"} and all(lined[k] == rows[k] for k in lined)
    near = {s: (i, t) for s, i, t in kept(pipeline.drop_near(spark, docs, ""), docs)}
    assert "own5" not in near and len({"own0", "own1"} & set(near)) == 1 and {"own2", "own3", "own4", "own6", "own7", "own8"} <= set(near)
    clean = {s: (i, t) for s, i, t in kept(pipeline.decontaminated(spark, docs, with_benchmark), docs)}
    assert "own10" not in clean and PASSAGE not in clean["own9"][1] and all(clean[k] == rows[k] for k in clean if k != "own9")
    packed = pipeline.packed(spark, docs, "")
    sizes: dict = {}
    for r in packed.collect():
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert set(sizes) == {i for i, _ in ODD_TEXTS} and sizes[5] == 1 and sizes[10] > 60_000


@pytest.mark.parametrize("at", range(len(pipeline.STAGES)))
def test_stages_on_an_empty_table(spark, with_benchmark, at):
    docs = odd_docs(spark).limit(0)
    found = pipeline.STAGES[at][1](spark, docs, with_benchmark)
    assert found.count() == 0 and (at == len(pipeline.STAGES) - 1 or found.dtypes == docs.dtypes)


def test_recall_of_near_duplicates(spark):
    """The links of planted pairs of similarity 0.8 and a little more that min-max bands find."""
    import random

    from gridloom.llm import near_dedup

    rng, texts = random.Random(21), []
    for g in range(300):
        base = [f"g{g}w{k}" for k in range(101)]
        other = list(base)
        for k in rng.sample(range(50), 5):
            other[2 * k + rng.randrange(2)] = f"e{g}x{k}"
        texts += [" ".join(base), " ".join(other)]
    want = h.near_components(dict(enumerate(texts[:60])), 2)
    sets = [h.shingles(t, 2) for t in texts]
    linked = [k for k in range(0, len(texts), 2) if 100 * len(sets[k] & sets[k + 1]) >= 80 * len(sets[k] | sets[k + 1])]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(h.docs_of(spark, texts)).collect()}
    assert len(linked) > 100 and all(got[k + 1] == k for k in linked)
    assert all(got[i] == c for i, c in want.items())
