import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from rosterloom.llm import vector_codes as v


@pytest.mark.parametrize("high", [1, 2000, 2**24 + 3, 2**28])
@pytest.mark.parametrize("d", [1, 16, 33])
def test_products_and_nearest_entries_are_exact(high, d):
    random_ = np.random.default_rng(d)
    x = random_.integers(-high, high + 1, (40, d))
    c = random_.integers(-high, high + 1, (9, d))
    c[5] = c[2]  # a tie
    x[0], x[1] = -high, high
    want = [[sum(int(a) * int(b) for a, b in zip(p, q, strict=True)) for q in c] for p in x]
    assert v.products(x, c).tolist() == want
    index, distance = v.nearest_entries(x, c)
    for row, k, got in zip(x.tolist(), index.tolist(), distance.tolist(), strict=True):
        all_ = [sum((a - b) ** 2 for a, b in zip(row, entry, strict=True)) for entry in c.tolist()]
        assert got == min(all_) and k == all_.index(got)


def test_limbs_stay_small_and_add_up():
    values = np.array([[0, -1, 2**40 + 5, -(2**40) - 7, 2**20]])
    parts = v.limbs(values, 20)
    assert len(parts) == 3 and all(np.abs(p).max() <= 2**20 for p in parts)
    assert (sum(p.astype(np.int64) << (20 * k) for k, p in enumerate(parts)) == values).all()


def brute(table, entries, rounds=4, parts=4, scale=1024):
    """Plain integers, one vector after the other, for rows (vec_id, vector or None, label)."""
    ok = lambda e: e and all(x is not None and np.isfinite(x) for x in e)
    kept = [(i, [int(np.floor(scale * float(x))) for x in e], g) for i, e, g in table if ok(e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, len(r[1]), r[1]))
    if not kept:
        return []
    n = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == n]
    width = -(-n // parts)
    cut = lambda e: [(e + [0] * (parts * width - n))[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(e)[p] for _, e, _ in kept[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, e, _ in kept:
            for p, x in enumerate(cut(e)):
                groups[p, near(p, x)[1]].append(x)
        for (p, k), xs in groups.items():
            books[p][k] = [sum(column) // len(xs) for column in zip(*xs, strict=True)]
    out, by_label = [], defaultdict(int)
    for i, e, g in kept:
        found = [near(p, x) for p, x in enumerate(cut(e))]
        error = sum(d for d, _ in found)
        by_label[g] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, g))
    flat = [x for p, book in enumerate(books) for c in book for x in c[: n - p * width]]
    digest = hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()
    return sorted(((i, code, error, by_label[g], digest) for i, code, error, g in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


@pytest.mark.parametrize("dimensions", [8, 10])
def test_codes_agree_with_brute_force(spark, dimensions):
    random_ = random.Random(dimensions)
    table = [(i, [random_.gauss(0, 1) for _ in range(dimensions)], random_.choice([None, 1, 2])) for i in range(150)]
    table += [(i, table[3][1], 7) for i in range(150, 220)]  # a hot vector
    table += [table[5]] * 3  # repeated rows
    table += [(300, None, 1), (301, [], 1), (302, [None] * dimensions, 1), (303, [float("nan")] * dimensions, 1)]
    table += [(304, [float("inf")] * dimensions, None), (305, [1.0] * (dimensions + 1), 2), (None, [0.25] * dimensions, None)]
    random_.shuffle(table)
    df = spark.createDataFrame([(*r, "x", 0) for r in table], "vec_id long, embedding array<double>, label int, code string, error int")
    assert got(v.vector_codes(df.repartition(5), entries=20)) == brute(table, 20)
    few = df.where("vec_id < 7")
    assert got(v.vector_codes(few)) == brute([r for r in table if r[0] is not None and r[0] < 7], 256)
    assert v.vector_codes(df.limit(0)).count() == 0
    assert v.vector_codes(df.where("vec_id between 300 and 304")).count() == 0


def test_values_beyond_64_bits_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30] * 4, 0)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError, match="64 bits"):
        v.vector_codes(df)
