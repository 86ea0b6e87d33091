"""The classifiers' formulas in plain loops, over small tables."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterloom.llm import language, quality
from rosterloom.llm.learning import softmax, temperature
from rosterloom.llm.storage import stored
from rosterloom.llm.text_arrays import Words, mixed

MASK = (1 << 32) - 1
TEXTS = [
    "The cat sat on the mat. The CAT, again!", "", None, "x", "a b a b a b", "naïve café – ok", "12 34 5678 (x-y); z's",
    "one\ntwo\tthree  four", "!!! ??? ...", "Ünï çødé 漢字 text", "w" * 300 + " end",
]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# quality


def words_of(text):
    return [w for w in (text or "").encode().replace(b"\x0b", b" ").split() if w]


def word_bucket(word):
    return int(Words([word], quality._NOT_SPACE).hashes()[0] >> quality._SHIFT)


def shape_bucket(word):
    def kind(b):
        c = chr(b)
        if b >= 128:
            return 32
        if c.islower():
            return 1
        if c.isupper():
            return 2
        if c.isdigit():
            return 4
        return (8 if c in ",.;:'-()" else 16) if 33 <= b < 127 else 0

    kinds = 0
    for b in word:
        kinds |= kind(b)
    shape = kinds << 16 | kind(word[0]) << 8 | min(int(math.log2(len(word))), 7)
    return int(mixed(np.array([shape + (1 << 40)], np.uint64))[0] >> quality._SHIFT)


def index_vector(bucket):
    places, signs = quality._index_vectors()
    out = np.zeros(quality.DIMENSIONS)
    for p, s in zip(places[bucket], signs[bucket], strict=True):
        out[p] += s
    return out


def test_word_vectors_by_random_indexing():
    want = {}

    def add(bucket, vector):
        want[bucket] = want.get(bucket, 0) + vector

    for text in TEXTS:
        words = words_of(text)
        for i, w in enumerate(words):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(words):
                    add(word_bucket(w), index_vector(word_bucket(words[j])))
            add(shape_bucket(w), index_vector(shape_bucket(w)))
            if i:
                add(shape_bucket(w), index_vector(shape_bucket(words[i - 1])))
    got = quality._contexts(TEXTS)
    for bucket in range(quality.BUCKETS):
        assert np.allclose(got[bucket], want.get(bucket, 0)), bucket


def test_document_vectors_and_scores():
    random_ = np.random.default_rng(0)
    d = quality.DIMENSIONS
    vectors = random_.normal(size=(quality.BUCKETS, d)).astype(np.float32)
    rows = []
    for text in TEXTS:
        words, row = words_of(text), np.zeros(2 * d + 6)
        if words:
            n = len(words)
            row[:d] = sum(vectors[word_bucket(w)].astype(float) for w in words) / n
            row[d : 2 * d] = sum(vectors[shape_bucket(w)].astype(float) for w in words) / n
            row[-6:] = (
                math.log1p(n) / 8, len({word_bucket(w) for w in words}) / n,
                sum(word_bucket(a) == word_bucket(b) for a, b in zip(words, words[1:], strict=False)) / n,
                math.log1p(sum(map(len, words)) / n), math.sqrt(sum(row[:d] ** 2)), math.sqrt(sum(row[d : 2 * d] ** 2)),
            )
        rows.append(row)
    got = np.concatenate(list(quality.document_vectors(TEXTS, vectors)))
    assert np.allclose(got, rows, atol=1e-4)
    layers = [random_.normal(size=s) for s in (2 * d + 6, 2 * d + 6, (2 * d + 6, 3), 3, 3, 1)]
    layers[1] = np.abs(layers[1]) + 1
    model = quality.QualityModel(vectors, layers, 1.7)
    for row, score in zip(got.astype(float), model.score(TEXTS), strict=True):
        hidden = [math.tanh(sum((row - layers[0]) / layers[1] * layers[2][:, k]) + layers[3][k]) for k in range(3)]
        z = (sum(h * w for h, w in zip(hidden, layers[4], strict=True)) + layers[5][0]) / 1.7
        assert score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6)


def test_quality_learns_from_labels_of_the_other_folds_only(spark):
    random_ = random.Random(1)
    good, bad = "alpha beta gamma delta epsilon".split(), "zz!! qq?? xx## yy$$".split()
    docs = [(i, " ".join(random_.choices(bad if i % 3 == 0 else good, k=30))) for i in range(400)]
    # labels of held-out documents say the opposite and must not matter
    labels = [(i, int(i % 3 != 0) ^ held_out(i), 0) for i, _ in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.scored(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert all(got[i]["predicted"] == int(i % 3 != 0) and got[i]["held_out"] == held_out(i) for i, _ in docs)


# language


def ngrams(text):
    out = {}
    c = [(ord(ch) * 0x9E3779B1) & MASK for ch in text.lower()]
    for i in range(len(c)):
        h = c[i]
        for n in range(1, 4):
            if i + n > len(c):
                break
            if n > 1:
                h = ((h ^ (h >> 15)) * 0x85EBCA6B + c[i + n - 1]) & MASK
            bucket = ((h * 0xC2B2AE35) & MASK) >> 19
            out[bucket] = out.get(bucket, 0) + 1
    return out


def features(text, idf):
    counts = dict(sorted(ngrams(text).items()))
    value = {b: (1 + math.log(n)) * idf[b] for b, n in counts.items()}
    length = max(math.sqrt(sum(v * v for v in value.values())), 1e-12)
    return {b: v / length for b, v in value.items()}


def brute_languages(docs, alpha=0.5, beta=1.0, l1=1e-4, l2=1e-3, epochs=4):
    learn = [(i, t, g) for i, t, g in docs if not held_out(i) and t is not None and g is not None]
    df = {}
    for _, t, _ in learn:
        for b in ngrams(t):
            df[b] = df.get(b, 0) + 1
    idf = [math.log((1 + len(learn)) / (1 + df.get(b, 0))) + 1 for b in range(language.BUCKETS)]
    languages = sorted({g for _, _, g in learn})
    rows = []
    for _, t, g in learn:
        x = features(t, idf)
        at, value = np.array(list(x), "<i4"), np.array(list(x.values()), "<f4")
        rows.append((at.tobytes(), value.tobytes(), languages.index(g), dict(zip(at.tolist(), value.astype(float).tolist(), strict=True))))
    rows.sort(key=lambda r: r[:2])
    used, aside = [r for k, r in enumerate(rows) if k % 5], rows[::5]
    z, n = {}, {}

    def weight(b, c):
        big = max(abs(z.get((b, c), 0.0)) - l1, 0)
        return -math.copysign(1, z.get((b, c), 0.0)) * big / ((beta + math.sqrt(n.get((b, c), 0.0))) / alpha + l2) if big else 0.0

    def logits(x):
        return np.array([sum(v * weight(b, c) for b, v in x.items()) + weight(-1, c) for c in range(len(languages))])

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(used)):
            _, _, truth, x = used[k]
            error = softmax(logits(x))
            error[truth] -= 1
            now = {(b, c): weight(b, c) for b in (*x, -1) for c in range(len(languages))}
            for b, v in (*x.items(), (-1, 1.0)):
                for c in range(len(languages)):
                    g, before = v * error[c], n.get((b, c), 0.0)
                    z[b, c] = z.get((b, c), 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / alpha * now[b, c]
                    n[b, c] = before + g * g
    divisor = temperature(np.array([logits(x) for *_, x in aside]), np.array([r[2] for r in aside]))
    out = []
    for i, t, _ in docs:
        if t is None or not any(ch.isalpha() for ch in t):
            out.append((i, "und", 0.0))
            continue
        p = softmax(logits(features(t, idf)) / divisor)
        out.append((i, languages[int(np.argmax(p))], float(p.max())))
    return out


def test_language_agrees_with_plain_loops(spark):
    random_ = random.Random(6)
    lexicon = {"de": "und der nicht schön über", "en": "the and with through", "fr": "été où le dans avec"}
    docs = []
    for i in range(70):
        g = random_.choice(list(lexicon))
        docs.append((i, " ".join(random_.choices(lexicon[g].split(), k=random_.randrange(1, 9))), g if i % 9 else None))
    docs += [(70, None, "en"), (71, "", "en"), (72, "12 !?", "de"), (73, "漢字 the", None)]
    got = language.identified(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3))
    found = {r["doc_id"]: r for r in got.collect()}
    for i, lang, score in brute_languages(docs):
        assert found[i]["lang_pred"] == lang and found[i]["score"] == pytest.approx(score, abs=1e-6), i
        assert found[i]["held_out"] == held_out(i)
    assert got.where(F.col("lang_pred") == "und").count() == 3


def test_language_features_are_made_where_the_texts_are(spark, monkeypatch, tmp_path):
    features, folder = language.features, str(tmp_path)

    def noted(text, idf):
        from pyspark import TaskContext

        task = TaskContext.get()
        with open(f"{folder}/{task.stageId()}-{task.partitionId()}", "a") as file:
            file.write("x")
        return features(text, idf)

    monkeypatch.setattr(language, "features", noted)
    docs = [(i, f"{'und der nicht' if i % 2 else 'the and with'} {i}", "de" if i % 2 else "en") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(8)
    language.fit(stored(df, "test-docs"))  # as a table, whose rows Spark has not counted
    texts = [p.stat().st_size for p in tmp_path.iterdir()]
    # the whole sample, and no task had more than its share of the texts
    assert sum(texts) == sum(not held_out(i) for i, *_ in docs) and max(texts) < sum(texts) / 4
