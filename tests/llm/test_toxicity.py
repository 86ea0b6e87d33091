import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterloom.llm import toxicity as t
from rosterloom.llm.queries import QUERIES
from rosterloom.llm.text_arrays import Words


def word_hash(raw, salt=None):
    h = Words([raw], t._WORD_BYTES).hashes()[0]
    return int(h if salt is None else t.mixed(np.array([h + np.uint64(salt)]))[0])


def brute_terms(text):
    """Words and beginnings of words, one after the other."""
    out = Counter()
    for word in re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode()):
        out[word_hash(word)] += 1
        for k in t.PREFIXES:
            if len(word) > k:
                out[word_hash(word[:k], k)] += 1
    return out


TEXTS = ["Some Words, some WORDS again", None, "", "ÉCOLE école écoles", "x" * 40, "a b c " * 50, "-- !!", "nothing 12345678 else"]


def test_terms_agree_with_brute_force():
    wanted = [brute_terms(x) for x in TEXTS]
    every = np.array(sorted({term for c in wanted for term in c}), np.uint64)
    vocabulary = t.Vocabulary(every[::2])
    got = [{int(vocabulary.terms[p]): n for p, n in zip(*found, strict=True)} for found in vocabulary.places(TEXTS)]
    kept = set(every[::2].tolist())
    assert got == [{term: n for term, n in c.items() if term in kept} for c in wanted]
    assert [len(p) for p, _ in t.Vocabulary(every[:0]).places(TEXTS)] == [0] * len(TEXTS)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 700])
@pytest.mark.parametrize("k", [1, 5, 32])
def test_index_finds_exactly_the_nearest(n, k):
    random_ = np.random.default_rng(n)
    terms = 40
    dense = random_.random((n, terms)) * (random_.random((n, terms)) < 0.1)
    dense[n // 2 :: 7] = dense[n // 2] if n else 0  # many equal examples
    index = t.BlockMaxIndex([(np.flatnonzero(v), v[v > 0]) for v in dense], terms)
    for case in range(30):
        query = random_.random(terms) * (random_.random(terms) < 0.15)
        without = case % 3 - 1
        got, scores = index.nearest(np.flatnonzero(query), query[query > 0], k, without)
        exact = dense @ query
        if 0 <= without < n:
            exact[without] = 0
        order = [e for e in np.lexsort((np.arange(n), -exact.round(12))) if exact[e] > 1e-12][:k]
        assert np.allclose(np.sort(scores)[::-1], exact[order])
        assert (exact[got] == pytest.approx(scores)) and len(set(got.tolist())) == len(got) == len(order)


def test_held_out_documents_and_evidence(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = QUERIES["op11_toxicity"](spark, folder).cache()
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    judged = found.where("held_out").join(labels, "doc_id")
    told = {(r["toxic"], r["predicted"]): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    assert told[1, 1] >= 0.8 * (told[1, 1] + told.get((1, 0), 0)) and told.get((0, 1), 0) <= 0.02 * told[0, 0]
    # calibration: mean score and share of toxic documents agree, above and below the threshold
    for above in (0, 1):
        mean, share = judged.where(f"predicted = {above}").agg(F.avg("score"), F.avg("toxic")).first()
        assert abs(mean - share) < 0.1
    evidence = found.select(F.explode("evidence").alias("e")).select("e.*")
    assert evidence.where("similarity <= 0 or similarity > 1.000001").count() == 0
    learnt = evidence.join(labels.withColumnRenamed("toxic", "said"), "doc_id")
    assert learnt.where("toxic <> said or crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").count() == 0
    found.unpersist()


def test_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 0, None), (3, 1, 1), (5, 1, 0), (6, 0, 0), (6, 0, 1), (None, 1, 1), (99, 0, 1), (10, 1, None)],
        "doc_id long, quality int, toxic int",
    )
    got = t.scored(edge_docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "evidence"] and got.count() == edge_docs.count()
    assert got.where("score < 0 or score > 1 or score is null or predicted <> int(score >= 0.5)").count() == 0
    assert t.scored(edge_docs, labels.limit(0)).where("score <> 0 or predicted <> 0").count() == 0
    assert t.scored(no_docs, labels).count() == 0
    assert t.scored(edge_docs, labels.where("toxic = 0")).where("predicted <> 0").count() == 0


def test_nearest_examples_decide(spark):
    rows = [(i, f"the plain text number {i} says vile{'abc'[i % 3]}x things" if i % 4 == 0 else f"the plain text number {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    new = spark.createDataFrame([(1000, "VILEZZZ words"), (1001, "plain words"), (1002, ""), (1003, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in t.scored(docs.union(new), labels).collect()}
    assert all(got[i]["predicted"] == (i % 4 == 0) for i in range(400))
    assert [got[i]["predicted"] for i in range(1000, 1004)] == [1, 0, 0, 0]  # an unseen form of a known word
    assert all(e["toxic"] == 1 for e in got[1000]["evidence"]) and len(got[1000]["evidence"]) == 3
