"""Language identification by hierarchical discrimination.

A text is first given a language family, then a language of that family. Both steps
vote among one-versus-one linear support vector machines over hashed letter n-grams
of one to three bytes. The machines are fitted by Spark's LinearSVC on a bounded
sample of labelled rows (`per_language`); their weights, of a fixed size, go to all
tasks, and every text is judged whole.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, crc_mod, documents, hash_limit, lean, ship
from .textbytes import LOWER, NO_LETTER, pieces, text_buffer

DIMS = 4096
UNKNOWN = "und"
#: Families of languages by ISO 639-1 code. A code that is not here is its own family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tk", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("ar", "he", "mt", "am"),
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


def has_letters(raw: np.ndarray) -> bool:
    """Whether any code point of the text is a letter; bytes alone tell this of ASCII only."""
    if (~NO_LETTER[raw] & (raw < 128)).any():
        return True
    return any(c.isalpha() for c in raw.tobytes().decode(errors="replace"))


def letters(raw: np.ndarray, after_blank: bool) -> np.ndarray:
    """The bytes of letters in lower case, each run of anything else as one space, none where
    one stands before. All bytes of non-ASCII characters count as letters here."""
    out = np.where(NO_LETTER[raw], np.uint8(32), LOWER[raw])
    blank = out == 32
    return out[~(blank & np.concatenate(([after_blank], blank[:-1])))].astype(np.uint32)


def profile(raw: np.ndarray, step: int = 8 << 20) -> np.ndarray:
    """Square roots of the shares of the hashed n-grams; all 0 for a text without any.

    A long text is read `step` bytes at a time; the last two letters of a slice go on to the
    next, so that the n-grams are those of the whole."""
    count, some = np.zeros(DIMS), False
    tail, space = np.zeros(0, np.uint32), np.full(1, 32, np.uint32)
    for a in range(0, len(raw), step):
        own = letters(raw[a : a + step], a == 0 or bool(NO_LETTER[raw[a - 1]]))
        some = some or bool((own != 32).any())
        b = np.concatenate((tail, *([space] if a == 0 else []), own, *([space] if a + step >= len(raw) else [])))
        k = len(tail)
        one, two, three = b[k:], b[max(k - 1, 0) :], b[max(k - 2, 0) :]
        for gram in (one, (two[:-1] << 8 | two[1:]) + np.uint32(1 << 20), (three[:-2] << 16 | three[1:-1] << 8 | three[2:]) + np.uint32(1 << 25)):
            count += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMS)
        tail = b[-2:]
    return np.sqrt(count / count.sum()) if some else np.zeros(DIMS)


def profiles(column: pa.Array):
    """(first row, end, profiles) of a slice after another; all 0 for a text without letters."""
    for a, b in pieces(column, 1 << 20, 128):
        raw, off = text_buffer(column.slice(a, b - a))
        yield a, b, np.array([profile(raw[x:y]) if has_letters(raw[x:y]) else np.zeros(DIMS) for x, y in zip(off[:-1], off[1:], strict=True)]).reshape(-1, DIMS)


def with_profiles(docs: DataFrame) -> DataFrame:
    """lang and profile of every row that has letters."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for a, b, found in profiles(batch.column(1)):
                some = found.any(1)
                lang = batch.column(0).slice(a, b - a).filter(pa.array(some))
                rows = pa.FixedSizeListArray.from_arrays(pa.array(found[some].ravel()), DIMS).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([lang, rows], names=["lang", "profile"])

    return docs.select("lang", "text").mapInArrow(lean(run), "lang string, profile array<double>")


class Vote:
    """One-versus-one machines between `names`: the most votes win, then the larger margins."""

    def __init__(self, names: list[str], machines: dict[tuple[int, int], tuple[np.ndarray, float]]):
        self.names, self.pairs = names, list(machines)
        self.weights = np.array([machines[p][0] for p in self.pairs]).reshape(-1, DIMS).T
        self.bias = np.array([machines[p][1] for p in self.pairs])

    def judge(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the name, confidence: the least of its machines' logistic margins)."""
        margin = x @ self.weights + self.bias
        votes, least = np.zeros((len(x), len(self.names))), np.ones((len(x), len(self.names)))
        for k, (i, j) in enumerate(self.pairs):
            p = 1 / (1 + np.exp(-np.clip(3 * margin[:, k], -35, 35)))
            votes[:, i] += (p >= 0.5) + 1e-3 * p
            votes[:, j] += (p < 0.5) + 1e-3 * (1 - p)
            least[:, i], least[:, j] = np.minimum(least[:, i], p), np.minimum(least[:, j], 1 - p)
        best = votes.argmax(1)
        return best, least[np.arange(len(x)), best]


class Model:
    """The families' vote, and in each family the languages' vote."""

    def __init__(self, families: Vote, languages: list[Vote]):
        self.families, self.languages = families, languages

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lang, score = np.full(len(x), UNKNOWN, object), np.zeros(len(x))
        some = np.flatnonzero(x.any(1))
        if not self.families.names or not len(some):
            return lang, score
        family, sure = self.families.judge(x[some])
        for f, vote in enumerate(self.languages):
            at = some[family == f]
            if len(at):
                best, within = vote.judge(x[at])
                lang[at] = np.array(vote.names, object)[best]
                score[at] = sure[family == f] * within
        return lang, score


def fit_vote(rows: DataFrame, column: str, names: list[str]) -> Vote:
    machines = {}
    for i, j in combinations(range(len(names)), 2):
        pair = rows.where(F.col(column).isin(names[i], names[j])).withColumn("label", (F.col(column) == names[i]).cast("double"))
        share = pair.agg(F.avg("label")).first()[0]
        pair = pair.withColumn("weight", F.when(F.col("label") == 1, 0.5 / share).otherwise(0.5 / (1 - share)))
        fitted = LinearSVC(maxIter=20, regParam=1e-3, weightCol="weight", standardization=False).fit(pair)
        machines[i, j] = (fitted.coefficients.toArray(), fitted.intercept)
    return Vote(names, machines)


def train(docs: DataFrame, per_language: int = 1_000, families: dict[str, str] | None = None) -> Model:
    """Fits on rows with a lang and letters, of each language about `per_language` at most,
    chosen by a fixed hash of the text, so that copies count alike. No such row gives a
    model that answers `und`; a single language is always its answer."""
    spark, of = docs.sparkSession, FAMILY if families is None else families
    counts = {r.lang: r["count"] for r in docs.where("lang is not null and text is not null").groupBy("lang").count().collect()}
    if not counts:
        return Model(Vote([], {}), [])
    limit = F.create_map(*(F.lit(v) for k, n in sorted(counts.items()) for v in (k, hash_limit(min(1.0, per_language / n)))))
    chosen = docs.where("lang is not null and text is not null").select("lang", "text").where(F.xxhash64("text") <= F.element_at(limit, F.col("lang"))).distinct()
    scratch = Scratch(spark, "language-id")
    family = F.coalesce(F.try_element_at(F.create_map(*(F.lit(v) for kv in sorted(of.items()) for v in kv)), F.col("lang")), F.col("lang")) if of else F.col("lang")
    sample = scratch.write(with_profiles(chosen).withColumn("family", family), "sample")
    rows = sample.repartition(4).select("lang", "family", array_to_vector("profile").alias("features")).cache()
    langs: dict[str, list[str]] = {}
    for r in rows.select("family", "lang").distinct().collect():
        langs.setdefault(r.family, []).append(r.lang)
    names = sorted(langs)
    model = Model(fit_vote(rows, "family", names), [fit_vote(rows, "lang", sorted(langs[f])) for f in names])
    rows.unpersist()
    scratch.close()
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of each row, and lang_pred and score (0 to 1).

    A null text or one without letters (Unicode's) gets `und` and 0. Repeated rows are judged alike;
    lang, source and doc_id play no part; an input column named lang_pred or score is
    replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    types = dict(docs.dtypes)

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            for a, b, x in profiles(column):
                lang, score = shared.value.predict(x)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns), pa.array(lang.tolist(), pa.string()), pa.array(score)],
                    names=[*batch.schema.names, "lang_pred", "score"],
                )

    return docs.select(*kept).mapInArrow(lean(run), "".join(f"`{c}` {types[c]}, " for c in kept) + "lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; rows without an id are not held out. See train and predict."""
    docs = documents(spark, sf_dir)
    held = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    model = train(docs.where(~held))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
