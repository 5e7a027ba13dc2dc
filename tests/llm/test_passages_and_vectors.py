"""Repeated passages, whitening and hard negatives against brute force."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavid.llm import negatives, queries, substrings
from stratavid.llm.negatives import mine, packed, scores, tables
from stratavid.llm.substrings import repeated_passages, without_repeats
from stratavid.llm.whitening import bidiagonal, whiten
from tests.compare import check
from tests.llm.conftest import ODD, SF_DIR

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_passages(rows, window):
    """(id, text) rows to (id, words, removed, kept text), in the order given."""
    lists = [((-math.inf if i is None else i), WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, words in lists:
        for s in range(len(words) - window + 1):
            seq = tuple(words[s : s + window])
            first[seq] = min(first.get(seq, (math.inf, 0)), (i, s))
    out = []
    for (i, _), (key, words) in zip(rows, lists):
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (key, s):
                gone.update(range(s, s + window))
        out.append((i, len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return sorted(out, key=repr)


def passages(df, **more):
    return sorted(map(tuple, without_repeats(df, **more).collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_substring_dedup", "op13_hard_negatives"])
def test_queries_equal_sql(spark, name):
    assert check(spark, SF_DIR, name, queries.queries()[name], queries.oracle_sql()[name]) is None


def test_passages_of_odd_rows_equal_brute_force(spark, odd, none):
    rows = [(i, t) for i, t, _ in ODD]
    for window in (1, 3, 20):
        assert passages(odd, window=window) == brute_passages(rows, window)
    assert passages(none) == [] and repeated_passages(none).count() == 0


def test_passages_of_repetitive_texts_equal_brute_force(spark, monkeypatch):
    """Small alphabets, repeats inside a text, a passage in a third of the rows, repeated ids and rows."""
    draw = np.random.default_rng(3)
    shared = " ".join(f"s{n}" for n in range(9))
    rows = []
    for n in range(120):
        text = " ".join(draw.choice(list("ab"), size=draw.integers(0, 40)).tolist())
        rows.append((int(draw.integers(0, 90)), text + (f"\t{shared}\n" if n % 3 == 0 else " ")))
    rows += [(7, "a b a b a b a b a b a b"), (7, "a b a b a b a b a b a b"), (None, shared), (None, shared)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = brute_passages(rows, 6)
    assert passages(df, window=6) == expected
    assert passages(df, window=6, bucket_bytes=100) == expected  # many buckets
    monkeypatch.setattr(substrings, "SIEVE_BITS", 0)  # all texts joined
    assert passages(df, window=6) == expected


def test_windows_with_one_hash_are_told_apart_by_the_second():
    key = np.array([5, 5, 5, 5, 9], np.uint64)
    check_ = np.array([1, 2, 1, 2, 1], np.uint32)
    place = np.array([30, 10, 20, 40, 0])
    order = substrings._ordered(key, check_, place)
    assert place[order].tolist() == [20, 30, 10, 40, 0]
    assert substrings._group_least(key[order], check_[order], place[order]).tolist() == [20, 20, 10, 10, 0]


@pytest.mark.parametrize("window", [1, 2, 3, 7, 8, 20, 31])
def test_polynomial_is_the_sum_by_definition(window):
    values = np.random.default_rng(window).integers(1 << 63, size=60, dtype=np.uint64)
    base = substrings.BASES[0]
    expected = [
        sum(int(values[s + n]) * base ** (window - 1 - n) for n in range(window)) % (1 << 64) for s in range(60 - window + 1)
    ]
    assert substrings._polynomial(values, window, base).tolist() == expected


def test_intervals_are_maximal(spark):
    words = [f"w{n}" for n in range(30)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words[:8], "y", *words[10:14], "z"]))]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), window=4).collect()
    assert [(r["doc_id"], [tuple(s) for s in r["spans"]]) for r in found] == [(2, [(1, 9), (10, 14)])]


def test_substring_query_digests_what_stays(spark, docs):
    digests = {r["doc_id"]: r["kept_sha256"] for r in queries.op11_substring_dedup(spark, SF_DIR).collect()}
    for doc_id, _, _, kept in passages(docs)[:50]:
        assert digests[doc_id] == hashlib.sha256(kept.encode()).hexdigest()


# --- vectors ------------------------------------------------------------------------------

BAD = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [1.0, math.nan, 0.0]), (904, [math.inf, 0.0, 0.0])]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.select("*", *(F.lit("x").alias(c) for c in ("x", "v", "d", "i", "n", "anchor", "list", "rank"))) if extra else df


def brute_whitened(vectors, scale=64, offset=1_000_000):
    x = np.floor(scale * np.array(vectors)).astype(np.int64) + offset
    n, sums = len(x), x.sum(axis=0)
    c = (n * x - sums) / n
    e, axes = np.linalg.eigh(c.T @ c / n)
    return c, e[::-1], axes[:, ::-1], ((n * x - sums) ** 2).sum(axis=1)


def test_whitening_equals_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    found = queries.op12_whitening(spark, SF_DIR).toPandas()
    c, e, axes, deviation = brute_whitened([r["embedding"] for r in rows])
    ids = [r["vec_id"] for r in rows]
    wide = found.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    expected = c @ axes[:, :32] / np.sqrt(e[:32])
    sign = np.sign((wide * expected).sum(axis=0))
    assert np.abs(wide - sign * expected).max() < 1e-8
    assert found.groupby("component").explained.first().to_numpy() == pytest.approx(e[:32] / e.sum(), rel=1e-10)
    assert found.groupby("vec_id").deviation.first().loc[ids].tolist() == deviation.tolist()
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-10 and set(found.n) == {len(rows)}


def test_whitening_of_odd_rows(spark):
    draw = np.random.default_rng(2)
    good = [(n % 40, draw.normal(size=3).tolist(), 1) for n in range(60)] + [(None, [0.5, 1.0, 2.0], None)] * 2
    rows = good + [(i, v, 1) for i, v in BAD] + [(950, [1.0, 2.0], 1)]
    found = whiten(frame(spark, rows)).collect()
    _, e, _, deviation = brute_whitened([v for _, v, _ in good])
    assert len(found) == 3 * len(good) and {r["n"] for r in found} == {len(good)}
    assert sorted(r["deviation"] for r in found) == sorted(deviation.tolist() * 3)
    assert found[0]["identity_error"] < 1e-10
    assert [whiten(frame(spark, rows[:k])).count() for k in (0, 1)] == [0, 0]
    assert whiten(frame(spark, [(n, [1.0, 2.0, 3.0], 1) for n in range(5)])).count() == 0  # no variance
    flat = [(n, [float(n % 4), 7.0, float(n % 4)], 1) for n in range(12)]  # rank one
    assert {r["component"] for r in whiten(frame(spark, flat)).collect()} == {1}


@pytest.mark.parametrize("sigma", [[3, 2, 1, 0.5], [2, 2, 2, 2], [5, 5, 1, 0], [4, 0, 0, 0], [1, 1e-5, 1, 1e-5]])
def test_bidiagonal_keeps_every_singular_value(sigma):
    """Equal and zero values included, where the plain recurrence ends early."""
    draw = np.random.default_rng(1)
    u, _ = np.linalg.qr(draw.standard_normal((30, 4)))
    w, _ = np.linalg.qr(draw.standard_normal((4, 4)))
    x = u * np.array(sigma, float) @ w.T

    def products(v, inner, beta):
        left = x @ inner
        y = x @ v - (beta * left[:, -1] if inner.shape[1] else 0)
        return np.concatenate([x.T @ y, left.T @ y, [y @ y]])

    right, b = bidiagonal(products, 4)
    assert np.abs(right.T @ right - np.eye(4)).max() < 1e-12
    assert np.linalg.svd(b)[1] == pytest.approx(sorted(sigma, reverse=True), abs=1e-9)
    assert np.allclose(b, np.triu(np.tril(b, 1)))
    assert np.abs(b.T @ b - right.T @ (x.T @ x) @ right).max() < 1e-9


@pytest.mark.parametrize("d", [1, 7, 8, 13, 64])
def test_table_scores_are_inner_products(d):
    draw = np.random.default_rng(d)
    x, anchors = draw.integers(-300, 300, (50, d)), draw.integers(-300, 300, (9, d))
    assert (scores(packed(x, 10), tables(anchors)) == x @ anchors.T).all()


def brute_negatives(rows, every):
    """The contract over (vec_id, vector, label) rows with distinct ids."""
    usable = [
        (i, np.floor(256 * np.array(v)).astype(np.int64), label)
        for i, v, label in rows
        if i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for i, a, label in usable:
        if i % every:
            continue
        ranked = sorted((-int(a @ x), j, other) for j, x, other in usable if j != i)
        for s, p, _ in [r for r in ranked if r[2] == label][:5]:
            near = [(t, j) for t, j, other in ranked if other != label and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(i, p, rank, j, -s, -t) for rank, (t, j) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("round_bytes", [negatives.ROUND_BYTES, 100])
def test_negatives_equal_brute_force(spark, monkeypatch, round_bytes):
    """Ties, few positives, negative scores, null and bad rows; one round of anchors and many."""
    monkeypatch.setattr(negatives, "ROUND_BYTES", round_bytes)
    draw = np.random.default_rng(4)
    rows = [(n, (draw.integers(-3, 5, size=3) / 4).tolist(), int(draw.integers(0, 3))) for n in range(90)]
    rows += [(n, [0.5, 0.25, 1.0], n % 2) for n in range(100, 130)]  # one vector many times
    rows += [(200, [1.0, 1.0, 1.0], 9), (210, [0.5, 0.5, 0.5], None), (None, [1.0, 1.0, 1.0], 1)]
    rows += [(i, v, 1) for i, v in BAD]
    found = mine(frame(spark, rows).repartition(3), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, 10)


def test_negatives_of_empty_and_lonely_tables(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)], [(0, None, 1)]):
        assert mine(frame(spark, rows), F.col("vec_id") % 10 == 0).count() == 0
    twice = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 1.0], 1), (2, [1.0, 0.25], 2), (2, [1.0, 0.25], 2)]
    found = mine(frame(spark, twice), F.col("vec_id") == 0).collect()
    assert [(r["positive_id"], r["rank"], r["negative_id"]) for r in found] == []  # 288 < 0.8 * 384
    near = [*twice[:3], (2, [1.0, 0.9], 2), (2, [1.0, 0.9], 2)]
    found = sorted(mine(frame(spark, near), F.col("vec_id") == 0).collect())
    assert [(r["positive_id"], r["rank"], r["negative_id"]) for r in found] == [(1, 1, 2), (1, 2, 2)]


def test_components_too_large_are_an_error(spark):
    with pytest.raises(ValueError, match="bits"):
        mine(frame(spark, [(0, [1e9], 1), (1, [1.0], 1)]), F.col("vec_id") == 0)
