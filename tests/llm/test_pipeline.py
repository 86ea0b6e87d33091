import hashlib
import re
from collections import defaultdict
from string import ascii_lowercase, ascii_uppercase

import pytest
from oracle import connect, difference
from test_llm_operators import brute_fingerprint, components

import corpus_pipeline
from rosterloom.llm import quality
from rosterloom.llm.queries import ORACLE, QUERIES
from rosterloom.llm.storage import stored

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_sql(spark, name):
    assert difference(spark, connect(SMALL), SMALL, name, QUERIES, ORACLE) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_query_returns_whole_tables(spark, name):
    tables = {"op3_graph_nearest": None, "op4_main_text": "pages", "op12_conversation_repair": None}
    table = tables.get(name, "documents")
    got = QUERIES[name](spark, SMALL)
    if table:
        assert got.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    else:
        assert got.count() > 0


@pytest.mark.parametrize("source", ["edge_docs", "no_docs"])
def test_stages_handle_edge_cases(spark, source, request):
    docs = request.getfixturevalue(source)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), name.replace(" ", "-"))
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), name.replace(" ", "-"))
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]
    assert corpus_pipeline.run(spark, SMALL).count() == counts[-1]


def test_one_row_of_each_group_of_near_duplicates_stays(spark):
    """Compared with brute force over rows with repeated ids and without ids."""
    text = lambda n: " ".join(f"w{n}x{k * k * (n + 3)}" for k in range(30))
    data = [
        (1, text(1)), (2, text(1)), (2, text(2)),  # one row of 2 is a copy, the other has a text of its own
        (3, text(3)), (3, text(3)), (3, text(3).upper()), (4, text(3)),  # the smallest id three times
        (None, text(4)), (None, text(4)), (None, text(4).upper()),  # no ids
        (None, text(5)), (9, text(5)), (10, ""), (11, None), (None, None), (12, text(6)),
    ]
    df = spark.createDataFrame([(i, t, 1, "m") for i, t in data], "doc_id long, text string, i int, mark string").repartition(5)
    got = corpus_pipeline.near_dedup(spark, df, SMALL)
    assert got.columns == df.columns
    kept = sorted(((r["doc_id"], brute_fingerprint(r["text"])) for r in got.collect()), key=repr)
    groups = defaultdict(list)
    values = [brute_fingerprint(t) for _, t in data]
    for label, (i, _), value in zip(components(values), data, values, strict=True):
        groups[label].append((i is None, i or 0, i, value))
    assert kept == sorted((min(g)[2:] for g in groups.values()), key=repr)
    again = corpus_pipeline.near_dedup(spark, df.union(df), SMALL)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, got.collect()))


def test_line_and_near_dedup_agree_with_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(120)
    docs = stored(docs.union(docs.where("doc_id % 3 = 0")), "repeated")
    kept = stored(corpus_pipeline.line_dedup(spark, docs, SMALL), "kept")
    values = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    label = components([brute_fingerprint(t) for _, t in values])
    want = sorted(min(i for (i, _), b in zip(values, label, strict=True) if b == a) for a in set(label))
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, kept, SMALL).collect()) == want


def brute_pipeline(docs, items):
    """The stages after the quality filter in plain Python: (doc_id, sha256 of the text that is left) of what stays."""
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(i)
    gone = lambda i, k: len(held.get(k, ())) >= 3 and i != max(held[k])
    docs = [(i, "\n".join(s for s in (t or "").split("\n") if not gone(i, key(s)))) for i, t in docs]
    label = components([brute_fingerprint(t) for _, t in docs])
    least = {}
    for (i, _), group in zip(docs, label, strict=True):
        least[group] = min(i, least.get(group, i))
    docs = [(i, t) for (i, t), group in zip(docs, label, strict=True) if least[group] == i]
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    windows = {}
    for item in items:
        w = words(item)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(len(w[k : k + 13]), set()).add(tuple(w[k : k + 13]))
    out = []
    for i, t in docs:
        w, hit = words(t), set()
        for n, known in windows.items():
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    hit.update(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(w)):
            out.append((i, hashlib.sha256(t.replace("▁", " ").encode()).hexdigest()))
    return sorted(out)


def test_the_whole_agrees_with_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r["doc_id"] for r in quality.scored(docs, labels).where("predicted = 1").collect()}
    texts = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in good]
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = brute_pipeline(texts, items)
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SMALL).collect()) == want
    assert 0 < len(want) < len(texts) < docs.count()
