"""Vector codes and hard negatives against plain versions, with nulls, ties, copies, short vectors, empty tables and clashing columns."""

import hashlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from nearfield.llm import hard_negatives as hn
from nearfield.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, v string, part int, anchor int, rank string, is_anchor int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 0) for r in rows], SCHEMA).repartition(parts)


def random_rows(n, dim, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, spread, dim).astype(np.float32)], int(rng.integers(0, 3))) for i in range(n)]


AWKWARD = [(300, None, 1), (301, [0.5, None] + [0.1] * 30, 1), (302, [float("nan")] * 32, 1), (303, [float("inf")] * 32, 2), (304, [0.25] * 32, None),
           (None, [0.25] * 32, 2), (305, [], 1), (306, [0.5] * 20, 1), (307, [1e30] * 32, 2), (7, [0.25] * 32, 2), (7, [0.25] * 32, 2), (7, [0.125] * 32, 1)]


@pytest.mark.parametrize("seed, spread", [(0, 300), (1, 2), (2, 0)])
def test_gnat_finds_the_nearest_entry_and_the_lower_of_equals(seed, spread):
    rng = np.random.default_rng(seed)
    entries = np.rint(rng.normal(0, spread, (64, 4))).astype(np.int64)
    queries = np.concatenate([np.rint(rng.normal(0, spread + 1, (3000, 4))).astype(np.int64), entries])
    squares = ((queries[:, None] - entries[None]) ** 2).sum(axis=2)
    number, best = vc.Gnat(entries).nearest(queries)
    assert (best == squares.min(axis=1)).all() and (number == squares.argmin(axis=1)).all()


def test_gnat_prunes_subtrees():
    rng = np.random.default_rng(3)
    entries = rng.integers(-1000, 1000, (64, 4))
    tree, compared = vc.Gnat(entries), [0]
    plain = tree._squares

    def counting(queries, members):
        compared[0] += len(queries) * len(members)
        return plain(queries, members)

    tree._squares = counting
    queries = entries[rng.integers(0, 64, 2000)] + rng.integers(-20, 20, (2000, 4))
    tree.nearest(queries)
    assert compared[0] < 0.5 * 2000 * 64


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 65), (70, 130, 201), (512, 64, 300)])
def test_strassen(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-2**24, 2**24, (m, k)), rng.integers(-2**24, 2**24, (n, k))
    assert (hn.strassen(a, b) == a @ b.T).all()


@pytest.mark.parametrize("rows", [random_rows(150, 32, 4), random_rows(10, 18, 5), AWKWARD, random_rows(90, 32, 6, 0.004) + AWKWARD, []])
def test_vector_codes(spark, rows):
    want, books = brute.vector_codes(rows)
    sums = {}
    for _, _, e, label in want:
        sums[label] = sums.get(label, 0) + e
    digest = hashlib.sha256(books.encode()).hexdigest()
    got = vc.vector_report(*vc.vector_codes(table(spark, rows))).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, c, e, sums[label], digest) for i, c, e, label in want), key=key)


def test_codes_decode_to_within_their_error(spark):
    rows = random_rows(100, 32, 8)
    coded, books = vc.vector_codes(table(spark, rows))
    vectors = {i: v for i, _, v in brute.integer_vectors(rows)}
    for r in coded.collect():
        assert ((vc.decode(r.codes, books) - np.array(vectors[r.vec_id])) ** 2).sum() == r.error


@pytest.mark.parametrize("rows, block", [(random_rows(120, 16, 9), 8192), (random_rows(120, 16, 9), 3), (random_rows(60, 4, 10, 0.004), 4),
                                         (AWKWARD + random_rows(40, 32, 11), 5), (AWKWARD, 8192), ([], 8192)])
def test_hard_negatives(spark, rows, block):
    got = hn.hard_negatives(table(spark, rows), F.col("vec_id") % 7 == 0, block=block)
    assert sorted(tuple(r) for r in got.collect()) == brute.hard_negatives(rows, lambda i: i % 7 == 0)


def test_anchors_without_partners_give_no_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (2, [-1.0, 0.0], 1), (3, [0.0, 0.0], 1)]
    got = [tuple(r) for r in hn.hard_negatives(table(spark, rows), F.col("vec_id") == 0).collect()]
    assert got == brute.hard_negatives(rows, lambda i: i == 0) == []


def test_a_label_given_in_place_of_the_column(spark):
    rows = random_rows(80, 16, 12)
    moved = [(i, v, (label + 1) % 3) if i % 5 == 0 else (i, v, label) for i, v, label in rows]
    label = F.when(F.col("vec_id") % 5 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    got = hn.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, label).collect()
    assert sorted(tuple(r) for r in got) == brute.hard_negatives(moved, lambda i: i % 10 == 0)
