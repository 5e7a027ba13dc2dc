import re
import tracemalloc
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavid.llm import neardup, queries
from stratavid.llm.common import BATCH_BYTES, BATCH_SETTING, in_small_batches
from stratavid.llm.exact_dedup import drop_copies, exact_groups
from stratavid.llm.neardup import Rule, band_keys, drop_near, full_sets, near_groups, shingle_sets, signatures, spanning_links
from stratavid.llm.packing import pack
from stratavid.llm.quality import WIDTH, Ranker, strengths
from tests.compare import check
from tests.llm.conftest import ODD, SF_DIR

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact_dedup_equals_sql(spark):
    name = "op8_exact_dedup"
    assert check(spark, SF_DIR, name, queries.queries()[name], queries.oracle_sql()[name]) is None


def test_exact_groups_of_odd_rows(odd):
    rows = exact_groups(odd, keep="largest").collect()
    assert len(rows) == len(ODD)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert [by_id[n]["keep_id"] for n in (5, 6, 7, 1, 2, 8, 9)] == [7, 7, 7, 2, 2, 8, 9]
    assert by_id[10]["group_size"] == 2 and by_id[10]["kept"]
    assert sorted(r["group_size"] for r in rows if r["doc_id"] is None) == [1, 1]


def test_exact_groups_take_unlike_texts_with_one_hash_apart(odd):
    weak = lambda text: F.substring(F.md5(text), 1, 1)
    strong = {(r["doc_id"], r["text_sha256"]): r for r in exact_groups(odd).collect()}
    for row in exact_groups(odd, digest=weak, sieve_bits=16).collect():
        assert row == strong[row["doc_id"], row["text_sha256"]]


def test_drop_copies_keeps_one_row_and_all_columns(odd, none):
    kept = drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 8, 9, 10, 11]
    assert drop_copies(none).count() == 0
    with pytest.raises(ValueError):
        exact_groups(odd, keep="middle")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[n : n + k]) for n in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows, rule):
    """Smallest id reachable over all linked pairs of (id, text) rows."""
    sets = [(i, shingles(t, rule.words)) for i, t in rows]
    label = {i: i for i, _ in rows}
    links = [
        (i, j) for (i, a), (j, b) in combinations(sets, 2) if a and b and 100 * len(a & b) >= rule.percent * len(a | b)
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return label


def family(seed, base_words, copies, most):
    """Copies of a text with up to ``most`` words changed."""
    draw = np.random.default_rng(seed)
    base = [f"w{draw.integers(5000)}" for _ in range(base_words)]
    out = []
    for _ in range(copies):
        words = list(base)
        for at in draw.integers(base_words, size=draw.integers(most + 1)):
            words[at] = f"x{draw.integers(10**6)}"
        out.append(" ".join(words))
    return out


def test_near_groups_equal_brute_force(spark, monkeypatch):
    import stratavid.llm.neardup as module

    monkeypatch.setattr(module, "BLOCK_DOCS", 40)  # several blocks even for a small group
    texts = family(1, 90, 120, 9) + family(2, 40, 30, 3) + family(3, 12, 20, 2) + ["a b", "a b", "A B", "a", "", None, "a b c"]
    rows = list(enumerate(texts))
    rule = Rule(words=3, percent=85)
    got = near_groups(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()
    want = brute_components(rows, rule)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t, 3)) for i, t in rows}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(set(want.values())) > 20  # the groups do not all hang together


def test_near_groups_of_odd_rows(odd, none):
    got = near_groups(odd, Rule(words=3, percent=85)).collect()
    assert len(got) == len(ODD)
    assert {r["component_id"] for r in got if r["doc_id"] in (5, 6, 7)} == {5}
    assert all(r["n_shingles"] == 0 and r["kept"] for r in got if r["doc_id"] in (1, 2, 3))
    assert near_groups(none).count() == 0
    kept = drop_near(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, 1, 2, 3, 4, 5, 8, 9, 10, 11}


def test_near_groups_of_documents_equal_brute_force(spark):
    """All documents of the small table; sets are met over an inverted list, so that all pairs are looked at."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rule = Rule(words=3, percent=85)
    sets = {r["doc_id"]: shingles(r["text"], 3) for r in rows}
    holders, shared = {}, {}
    for i, own in sorted(sets.items()):
        for shingle in own:
            for j in holders.setdefault(shingle, []):
                shared[j, i] = shared.get((j, i), 0) + 1
            holders[shingle].append(i)
    label = {i: i for i in sets}
    for (i, j), both in shared.items():
        if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
            low, high = sorted((label[i], label[j]))
            label = {k: low if v == high else v for k, v in label.items()}
    got = near_groups(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), rule).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == label
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}


def test_rows_of_one_id_and_rows_without_one_are_judged_by_their_texts(spark):
    base = " ".join(f"w{n}" for n in range(60))
    near, other = base.replace("w59", "x"), " ".join(f"o{n}" for n in range(60))
    third = " ".join(f"t{n}" for n in range(60))
    rows = [(1, base), (2, near), (2, other), (None, base + " y"), (None, third), (None, third + " z"), (5, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(near_groups(df).collect(), key=repr)
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"] in (1, 2)] == [(1, 1, True), (2, 1, False), (2, 2, True)]
    alone = [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None and r["n_shingles"]]
    assert sorted(alone, key=repr) == [(1, False), (None, True), (None, True)]
    left = sorted(((r["doc_id"], r["text"]) for r in drop_near(df).collect()), key=repr)
    assert [r for r in left if r[0] is not None] == [(1, base), (2, other), (5, "")]
    assert len(left) == 5 and (None, None) in left and len([r for r in left if r[0] is None and r[1] and r[1].startswith("t0")]) == 1


def test_bands_reach_the_promised_chance():
    for percent in (70, 80, 85, 95):
        rows, bands = Rule(5, percent).bands
        assert (1 - (percent / 100) ** rows) ** bands <= 1e-9


def test_signatures_estimate_similarity_without_bias():
    import pyarrow as pa

    texts = family(9, 200, 2, 0) + family(9, 200, 1, 30)
    sets, bounds = shingle_sets(pa.array(texts), 3)
    keys = band_keys(sets, bounds, 1, 256)
    assert (keys[0] == keys[1]).all()
    a, b = shingles(texts[0], 3), shingles(texts[2], 3)
    assert abs((keys[0] == keys[2]).mean() - len(a & b) / len(a | b)) < 0.15


def test_spanning_links_join_what_all_pairs_join():
    import pyarrow as pa

    texts = family(4, 60, 50, 5)
    rule = Rule(3, 85)
    flat, bounds = shingle_sets(pa.array(texts), 3)
    sets = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
    links = spanning_links(sets, np.arange(len(sets)), rule)
    label = list(range(len(sets)))
    for a, b in links:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = [new if x == old else x for x in label]
    want = brute_components(list(enumerate(texts)), rule)
    groups = lambda of: {frozenset(n for n in of if of[n] == x) for x in of.values()}
    assert groups(dict(enumerate(label))) == groups(want)
    assert len(links) < len(sets)


def test_python_is_handed_texts_a_few_megabytes_at_a_time(spark, docs):
    ranker = Ranker(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 0.0)
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.lit(0).cast("long").alias("tag"))
    own = spark.conf.get(BATCH_SETTING, None)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    try:
        for made in (lambda: signatures(rows, Rule()), lambda: full_sets(rows, 5), lambda: strengths(docs, ranker), lambda: pack(docs)):
            spark.conf.unset(BATCH_SETTING)
            made()
            assert spark.conf.get(BATCH_SETTING) == str(BATCH_BYTES)
        # One split of 30 MB in fewer rows than Spark's bound, and a row longer than a batch.
        texts = spark.range(0, 3000, 1, 1).select(F.expr("repeat('x', if(id = 1500, 3 * 4194304, 10000))").alias("text"))
        found = in_small_batches(texts).mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in found) == 3000
        assert sorted(r["bytes"] for r in found)[-2] < 1.1 * BATCH_BYTES and max(r["bytes"] for r in found) < 4.1 * BATCH_BYTES
        spark.conf.set(BATCH_SETTING, "1m")
        in_small_batches(texts)
        assert spark.conf.get(BATCH_SETTING) == "1m"
    finally:
        spark.conf.unset(BATCH_SETTING)
        if own is not None:
            spark.conf.set(BATCH_SETTING, own)


def test_near_dedup_takes_little_memory_in_a_worker(spark):
    import pyarrow as pa

    class Rows:
        """Stands for a table: gives the function that would run on its batches."""

        sparkSession = spark

        def mapInArrow(self, function, schema):
            return function

    text = family(5, 300, 1, 0)[0]
    texts = pa.array([f"{n} {text}" for n in range(4 * BATCH_BYTES // (3 * len(text)))])
    ids = pa.array(range(len(texts)))
    batch = pa.record_batch([ids, ids, texts], ["id", "tag", "text"])
    tracemalloc.start()
    rows = sum(len(b) for b in signatures(Rows(), Rule())(iter([batch])))
    _, most = tracemalloc.get_traced_memory()
    assert rows == len(texts) and most < 4 * texts.nbytes
    sets = [np.arange(700, dtype=np.uint64) + np.uint64(n % 3) for n in range(400)]
    tracemalloc.reset_peak()
    links = spanning_links(sets, np.arange(len(sets)), Rule())
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(links) == len(sets) - 1 and most < 40e6
    # The same links when counts are added up after every distance.
    held = neardup.HELD_PAIRS
    try:
        neardup.HELD_PAIRS = 1
        assert spanning_links(sets[:30], np.arange(30), Rule()) == links[:29]
    finally:
        neardup.HELD_PAIRS = held
