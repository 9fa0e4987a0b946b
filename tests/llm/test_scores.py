"""Scores of the trained models, recomputed in plain Python from their weights, rows and trees."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F
from tests.llm import helpers as h
from tests.llm.test_model_operators import SYLLABLES, prose

from gridloom.llm import language_id, toxicity, url_filter

M = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M
    return x ^ x >> 31


# op2: n-grams counted one by one, machines voting one by one


def plain_profile(text):
    raw, out = (text or "").encode(), [32]
    if not any(c.isalpha() for c in text or ""):
        return None
    for b in raw:
        b = b + 32 if 65 <= b <= 90 else b
        letter = 97 <= b <= 122 or b >= 128
        if letter or out[-1] != 32:
            out.append(b if letter else 32)
    out.append(32)  # the text stands between two blanks
    count = {}
    for n, tag in ((1, 0), (2, 1 << 20), (3, 1 << 25)):
        for i in range(len(out) - n + 1):
            gram = 0
            for b in out[i : i + n]:
                gram = gram << 8 | b
            at = ((gram + tag) * 2654435761 & 0xFFFFFFFF) >> 20
            count[at] = count.get(at, 0) + 1
    total = sum(count.values())
    return {at: math.sqrt(c / total) for at, c in count.items()}


def plain_vote(vote, profile):
    votes, least = [0.0] * len(vote.names), [1.0] * len(vote.names)
    for k, (i, j) in enumerate(vote.pairs):
        margin = vote.bias[k] + sum(x * vote.weights[at, k] for at, x in profile.items())
        p = 1 / (1 + math.exp(-3 * margin))
        votes[i] += (p >= 0.5) + 1e-3 * p
        votes[j] += (p < 0.5) + 1e-3 * (1 - p)
        least[i], least[j] = min(least[i], p), min(least[j], 1 - p)
    best = max(range(len(votes)), key=lambda n: (votes[n], -n))
    return best, least[best]


def test_languages(spark):
    rng = random.Random(11)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(200)]
    model = language_id.train(h.docs_of(spark, [prose(rng, x) for x in langs], langs=langs))
    texts = [None, "", "…", "7 8", "A", " a. B,c! ", *(prose(rng, rng.choice(list(SYLLABLES)), rng.randint(1, 40)) + rng.choice(["", ".", " 12", "\n"]) for _ in range(40)), "mixed: the und que, "]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(h.docs_of(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        profile, want = plain_profile(t), ("und", 0.0)
        if profile:
            f, sure = plain_vote(model.families, profile)
            n, within = plain_vote(model.languages[f], profile)
            want = model.languages[f].names[n], sure * within
        assert got[i][0] == want[0] and got[i][1] == pytest.approx(want[1], abs=1e-9), t


# op8: features as a set of numbers, weights learned with a dictionary


def plain_features(text):
    radix = 0x9E3779B97F4A7C15 | 1
    words = re.findall(rb"[a-z\x80-\xff]+", (text or "").translate(h.LOW).encode())
    hashed = lambda w: mix(sum(mix((b + 1) * radix & M) * pow(radix, i, 1 << 64) for i, b in enumerate(w)) & M)
    w = [hashed(x) for x in words]
    out = {mix(x ^ 1) for x in w}
    for k, n in enumerate((4, 5, 6)):
        out |= {mix(hashed(x[:n]) ^ 10 + k) for x in words}
    out |= {mix((a * 3 + b & M) ^ 4) for a, b in zip(w, w[1:])}
    out |= {mix((a * 5 + b & M) ^ 6) for a, b in zip(w, w[2:])}
    return {x >> 46 for x in out}


def plain_ftrl(rows, alpha=0.1, beta=1.0, l1=12.0, l2=1.0, epochs=3):
    z, n, bias = {}, {}, 1 << 18

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        limit = 0.0 if i == bias else l1
        return 0.0 if abs(zi) <= limit else -(zi - math.copysign(limit, zi)) / ((beta + math.sqrt(ni)) / alpha + l2)

    toxic = sum(y for _, y in rows)
    times = [min(10, max(1, round((len(rows) - c) / max(1, c)))) for c in (len(rows) - toxic, toxic)]
    for _ in range(epochs):
        for found, y in rows:
            for _ in range(times[y]):
                at = sorted(found) + [bias]
                w = [weight(i) for i in at]
                g = 1 / (1 + math.exp(-max(-35, min(35, sum(w))))) - y
                for i, wi in zip(at, w, strict=True):
                    z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha * wi
                    n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_toxicity(spark):
    rng = random.Random(12)
    toxic = [int(rng.random() < 0.2) for _ in range(160)]
    texts = [prose(rng, "en", 12) + (" " + rng.choice(["Vile", "rotten,", "rottenest"]) + " end" if y else " kind end") for y in toxic]
    texts[7], texts[8] = None, ""
    docs = h.docs_of(spark, texts)
    labels = spark.createDataFrame(list(enumerate(toxic)) + [(7, 1)], "doc_id long, toxic int")
    weights = {r["index"]: r.weight for r in toxicity.train(docs, labels).collect()}
    order = [r.doc_id for r in docs.orderBy(F.xxhash64("doc_id", F.lit("order")), "doc_id").select("doc_id").collect()]
    known = toxic[:7] + [1] + toxic[8:]
    want = plain_ftrl([(plain_features(texts[i]), known[i]) for i in order])
    assert set(weights) == set(want) and all(weights[i] == pytest.approx(want[i], rel=1e-6) for i in want) and len(want) > 3
    scored = h.docs_of(spark, [*texts, "x" * 100_000, "rotten Éclair"], ids=[*range(160), 160, 160])
    got = toxicity.score(scored, toxicity.train(docs, labels)).collect()
    plain = lambda t: 1 / (1 + math.exp(-sum(want.get(i, 0.0) for i in [*plain_features(t), 1 << 18])))
    for i, t in enumerate(texts):
        assert [r.score for r in got if r.doc_id == i] == [pytest.approx(plain(t), abs=1e-6)]
    # rows that share an id are each scored
    assert sorted(r.score for r in got if r.doc_id == 160) == [pytest.approx(s, abs=1e-6) for s in sorted((plain("x" * 100_000), plain("rotten Éclair")))]


# op10: features by hand, trees walked as they are printed


def entropy(t):
    return sum(-t.count(c) / len(t) * math.log2(t.count(c) / len(t)) for c in set(t)) if t else 0.0


def walk(lines, at, depth, x):
    """(prediction, next line) of the tree whose root is line `at`."""
    m = re.match(r"Predict: (\S+)", lines[at].strip())
    if m:
        return float(m[1]), at + 1
    m = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at].strip())
    yes, after = walk(lines, at + 1, depth + 1, x)
    assert lines[after].strip().startswith("Else (feature")
    no, end = walk(lines, after + 1, depth + 1, x)
    return (yes if x[int(m[1])] <= float(m[2]) else no), end


def test_url_trees(spark, monkeypatch):
    rng = random.Random(13)
    made = [f"http{rng.choice(['', 's'])}://{rng.choice(['cheap-pills-777', 'news', 'x'])}{i}.example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'de', 'es', 'fr'])}/{i}{rng.choice(['', '.html', '?a=1&b=2', '#top'])}" for i in range(250)]
    made += ["http://com/en/1", "http://a.com/en/2?x", "http://net/de/3", "http://org/es/4", None, "", "no scheme", "http://other.info/q"]
    caught = []

    class Caught(url_filter.GBTClassifier):
        def fit(self, rows):
            caught.append(super().fit(rows))
            return caught[0]

    monkeypatch.setattr(url_filter, "GBTClassifier", Caught)
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, url string")
    rows = url_filter.judge(pages).collect()
    trees, names = caught[0], list(url_filter.lexical(F.lit(""), F.lit(""), F.lit("")))
    known = {r.page_id: float(r.verdict == "block") for r in rows if r.rule is not None}
    assert 0 < sum(known.values()) < len(known)
    suffix = {r.page_id: re.search(r"[^.]*$", r.host)[0] for r in rows}
    prior = sum(known.values()) / len(known)
    blocks = [b.split("\n") for b in re.split(r"  Tree \d+ \(weight [^)]*\):\n", trees.toDebugString)[1:]]
    for r in rows:
        url = made[r.page_id] or ""
        of = [v for i, v in known.items() if suffix[i] == suffix[r.page_id]]
        query = re.search(r"\?([^#]*)", url)
        x = {
            "f_length": len(url), "f_host_length": len(r.host), "f_path_length": len(r.path), "f_depth": len(re.findall("/[^/]", r.path)),
            "f_labels": r.host.count("."), "f_hyphens": r.host.count("-"), "f_digit_ratio": len(re.findall("[0-9]", url)) / max(1, len(url)),
            "f_host_digits": len(re.findall("[0-9]", r.host)), "f_entropy": entropy(url), "f_host_entropy": entropy(r.host),
            "f_parameters": len(re.findall("[^&]+", query[1])) if query else 0, "f_fragment": float("#" in url), "f_secure": float(url.lower().startswith("https")),
            "f_extension": float(bool(re.search(r"[.][A-Za-z0-9]{1,5}$", r.path))),
        }
        values = [float(x[n]) for n in names] + [sum(of) / len(of) if of else prior, float(len(of))]
        margin = sum(w * walk(b, 0, 0, values)[0] for w, b in zip(trees.treeWeights, blocks, strict=True))
        assert r.score == pytest.approx(1 / (1 + math.exp(-2 * margin)), abs=1e-9), url
        assert r.rule is not None or r.verdict == ("block" if r.score >= 0.5 else "allow")
    # one kind of labelled URL only: the trees are replaced by it
    for keep, verdict in (("url like 'http://com/en%'", "block"), ("url = 'http://other.info/q'", "allow")):
        some = pages.where(f"{keep} or url = 'http://other.info/q'")
        assert {r.verdict for r in url_filter.judge(some).collect()} >= {verdict} and {r.score for r in url_filter.judge(some).collect()} <= {0.0, 1.0}
