import math
import time
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tokenizers import Tokenizer

import corpus_pipeline
from stratavid.llm import queries, token_output
from stratavid.llm.common import components
from stratavid.llm.mixing import mix, mixed_rows
from stratavid.llm.packing import differencing, pack, pack_lengths, written_order
from stratavid.llm.token_output import decode_values, encode_values, read_token_files, write_token_files
from stratavid.llm.tokens import WordEncoder, vocabulary_path
from stratavid.llm.warc import derivatives, metadata_block, plain_text, read_warc, responses, write_warc
from tests.llm.conftest import ODD, SF_DIR
from tests.llm.test_exact_and_near import LOWER, brute_components


@pytest.fixture(scope="module")
def words():
    return WordEncoder(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def plain_ids(words, text):
    return np.array(words.full.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


# --- tokens ---

ODD_TEXTS = [
    "", "  ", "don't STOP", "áb É x y", "Ω ΑΣ ΣΑΣ. İstanbul ﬁne", "x,y--z 12.5 <|endoftext|> it's",
    "　tab\tline\r\n é, é́,", "ß STRASSE ÿ× ÷ª º", "a" * 5000, "naïve-Œuvre ǅ", None, "ȩ́ ,̸ a,̸ b≠", "\x1c\x1dq\x85z",
]


def test_encoder_equals_the_library(words, texts):
    every = ODD_TEXTS + list(texts.values())
    ids, bounds = words.encode(pa.array(every, pa.string()))
    for n, text in enumerate(every):
        assert ids[bounds[n] : bounds[n + 1]].tolist() == plain_ids(words, text)[:-1].tolist(), text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_encoder_equals_the_library_on_any_text(words, some):
    some = [t.encode("utf-8", "ignore").decode() for t in some]
    ids, bounds = words.encode(pa.array(some, pa.string()))
    for n, text in enumerate(some):
        assert ids[bounds[n] : bounds[n + 1]].tolist() == plain_ids(words, text)[:-1].tolist()


ADDED = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext|", "T49407", "t49407", "Σ", "é", "\u0301", "'s", " ", "Word,"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ADDED) | st.text(max_size=4), max_size=8).map("".join), max_size=5))
def test_encoder_equals_an_unmodified_library_on_added_tokens(words, library, some):
    some = ["one doc <|endoftext|> next", *(t.encode("utf-8", "ignore").decode() for t in some), "<|ENDOFTEXT|><|startoftext|>A"]
    ids, bounds = words.encode(pa.array(some, pa.string()))
    for n, text in enumerate(some):
        assert ids[bounds[n] : bounds[n + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert ids[: bounds[1]].tolist() == [637, 7251, 49407, 1131]


@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=9), max_size=6))
def test_codes_decode_to_their_values(lists):
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int64)
    values = np.array([v for x in lists for v in x], np.uint32)
    control, control_bounds, data, data_bounds = encode_values(values, bounds)
    assert decode_values(control, data, np.diff(bounds)).tolist() == values.tolist()
    assert control_bounds[-1] == len(control) and data_bounds[-1] == len(data)


def test_token_files_of_documents(spark, words, texts):
    rows = sorted(queries.op10_token_output(spark, SF_DIR).collect())
    start = 0
    for row, i in zip(rows, sorted(texts), strict=True):
        ids = plain_ids(words, texts[i])
        assert tuple(row) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_odd_rows(spark, words, odd, none, tmp_path):
    rows = read_token_files(spark, write_token_files(odd, str(tmp_path / "odd")), with_ids=True).collect()
    order = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted([i for i, _, _ in ODD], key=lambda i: (i is not None, i))
    got = sorted((r["doc_id"] or 0, bytes(r["ids"])) for r in rows)
    assert got == sorted((i or 0, plain_ids(words, t).tobytes()) for i, t, _ in ODD)
    ranks = {r["id"]: r["rank"] for r in spark.read.parquet(str(tmp_path / "odd/ranks")).collect()}
    counts = np.bincount(np.concatenate([plain_ids(words, t) for _, t, _ in ODD]))
    assert [i for i, _ in sorted(ranks.items(), key=lambda x: x[1])] == sorted(ranks, key=lambda i: (-counts[i], i))
    assert read_token_files(spark, write_token_files(none, str(tmp_path / "none"))).count() == 0


# --- packing ---


def check_packing(rows, ids_of, capacity=4096):
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_window.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == ids_of.keys()
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids_of[i])
            assert r["ids_crc32"] == zlib.crc32(ids_of[i][at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids_of[i])
    for pieces in by_window.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
    return 1 - sum(r["length"] for r in rows) / (capacity * len(by_window))


def test_packing_of_documents(spark, words, texts):
    rows = queries.op6_pack(spark, SF_DIR).collect()
    assert check_packing(rows, {i: plain_ids(words, t) for i, t in texts.items()}) < 0.02


def test_packing_of_odd_rows(words, odd, none):
    single = odd.where("doc_id <> 10")
    ids_of = {i: plain_ids(words, t) for i, t, _ in ODD if i not in (None, 10)}
    assert check_packing(pack(single, capacity=64, group_tokens=500).collect(), ids_of, 64) < 0.15
    assert pack(odd).groupBy("doc_id").count().count() == len({i for i, _, _ in ODD})
    assert pack(none).count() == 0


@given(st.lists(st.integers(0, 400), max_size=40), st.booleans())
@settings(max_examples=80, deadline=None)
def test_windows_hold_every_token_once(lengths, cut):
    windows = pack_lengths(lengths, 100, cut)
    seen = sorted((d, s, n) for w in windows for d, s, n in w)
    for doc, length in enumerate(lengths):
        at = 0
        for _, s, n in (p for p in seen if p[0] == doc):
            assert s == at
            at += n
        assert at == length
    assert all(0 < sum(n for _, _, n in w) <= 100 for w in windows)
    if cut:
        assert len(windows) == sum(x // 100 for x in lengths) + -(-sum(x % 100 for x in lengths) // 100)


def test_differencing_balances_and_raises_the_window_count():
    draw = np.random.default_rng(1)
    sizes = draw.integers(1, 500, size=300).tolist()
    sums = [sum(sizes[n] for n in part) for part in differencing(sizes, 12)]
    assert max(sums) - min(sums) <= 10
    assert sorted(n for part in differencing(sizes, 12) for n in part) == list(range(300))
    assert sorted(map(sorted, differencing([8, 7, 6, 5, 4], 2))) in ([[0, 3], [1, 2, 4]], [[0, 2], [1, 3, 4]], [[0, 1], [2, 3, 4]])
    assert len(pack_lengths([60, 60, 60], 100, cut=False)) == 3  # two would do by their sum


# --- mixing ---


def brute_schedule(blocks, shares):
    """Earliest deadline first over exact fractions: the source of every slot, and its window."""
    done, left, since, out = [0] * len(blocks), list(blocks), 0, []
    live = sum(shares)
    while sum(left):
        t, found = len(out), []
        for i, w in enumerate(shares):
            w = w / live
            if left[i] and since + math.floor(done[i] / w) <= t:
                found.append((since + math.ceil((done[i] + 1) / w), i, since + math.floor(done[i] / w)))
        deadline, i, release = min(found)
        out.append((i, release, deadline))
        done[i] += 1
        left[i] -= 1
        if not left[i]:
            since, live, done = t + 1, live - shares[i], [0] * len(blocks)
    return out


@pytest.mark.parametrize(
    "counts, weights",
    [
        ([150] * 20, [Fraction(1, 20)] * 20),  # equal shares that no power of two divides
        ([700, 300, 90, 11], [Fraction(1, 2), Fraction(3, 10), Fraction(3, 20), Fraction(1, 20)]),
        ([900, 500, 400, 3], [Fraction(3, 7), Fraction(2, 7), Fraction(2, 7) - Fraction(1, 10**5), Fraction(1, 10**5)]),
        ([1, 1, 40], [Fraction(1, 3)] * 3),
        ([25], [Fraction(1)]),
    ],
)
def test_mixture_equals_earliest_deadline_first_by_brute_force(spark, counts, weights):
    rows = [(n, f"s{i:02}") for i, k in enumerate(counts) for n in range(k)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    given = {f"s{i:02}": float(w) for i, w in enumerate(weights)}
    got = sorted(mix(df, weights=given, bucket_rows=64).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(len(rows)))
    assert sorted((r["row"]["doc_id"], r["source"]) for r in got) == sorted(rows)
    assert [(int(r["source"][1:]), r["release"], r["deadline"]) for r in got] == brute_schedule(counts, weights)
    done = [0] * len(counts)
    for t, r in enumerate(got, 1):  # within a block of the exact weights while all are live
        done[int(r["source"][1:])] += 1
        assert all(abs(n - t * w) < 1 for n, w in zip(done, weights))
        if any(n == k for n, k in zip(done, counts)):
            break


def test_mixture_in_blocks_keeps_blocks_together(spark):
    df = spark.range(1000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'x', 'y') AS source")
    got = sorted(mix(df, block=10, bucket_rows=100).collect(), key=lambda r: r["position"])
    runs = [[r["source"], r["block"]] for r in got]
    assert sum(a != b for a, b in zip(runs, runs[1:])) + 1 == len({tuple(r) for r in runs})
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    assert len({r["position"] for r in mix(df, slots=64).collect()}) == 1000
    with pytest.raises(ValueError, match="slots"):
        mix(df, block=1, slots=64)


def test_mixture_of_documents_and_odd_rows(spark, odd, none):
    rows = queries.op9_mix_sources(spark, SF_DIR).collect()
    assert len({r["position"] for r in rows}) == len(rows) == 200
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    kept = mixed_rows(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted((i or 0, t or "") for i, t, _ in ODD)
    assert mixed_rows(none).count() == 0
    with pytest.raises(Exception, match="no weight for source"):
        mix(odd, weights={"a": 1.0}).count()


# --- WARC ---


def test_derivatives_refer_to_their_source(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    sources = {r["record_id"]: r for r in responses(pages).collect()}
    rows = queries.op2_warc_derivatives(spark, SF_DIR).collect()
    assert len(sources) == pages.count() and len(rows) == 2 * len(sources)
    assert len({r["record_id"] for r in rows}) == len(rows)
    for r in rows:
        source = sources[r["refers_to"]]
        assert r["source_headers"] == source["http_headers"] and r["target_uri"] == source["target_uri"]
        assert r["content_length"] == len(r["block"].encode())
        if r["warc_type"] == "conversion":
            assert r["block"] == plain_text(source["payload"])
            assert "<" not in r["block"] or "&lt;" in source["payload"] or "<" in plain_text(source["payload"])
        else:
            assert f"source-payload-digest: {r['source_payload_digest']}" in r["block"]


def test_plain_text_of_a_page():
    page = "<html><head><title>T</title><style>x{}</style></head><body><h1>A &amp; B</h1><script>no()</script><p>one <b>two</b>\r\n three<br>four</p><!-- c --></body>"
    assert plain_text(page) == "A & B\none two three\nfour"


def test_warc_files_read_back(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a.example/", "<p>one</p>"), (2, None, None), (None, "http://b.example/", ""), (2, None, None), (3, "u\r\nv", "<p>x\r\n\r\nWARC/1.1\r\n y</p>")],
        "page_id long, url string, html string",
    ).repartition(2)
    rows = derivatives(responses(pages))
    write_warc(rows, str(tmp_path / "warc"))
    back = read_warc(spark, str(tmp_path / "warc"))
    one = sorted(tuple(r) for r in rows.where("target_uri <> 'u\\r\\nv'").collect())
    assert one == sorted(tuple(r) for r in back.where("target_uri <> 'u v'").collect())
    assert back.count() == 10 and rows.count() == 10
    assert derivatives(responses(pages.limit(0))).count() == 0


# --- shared parts and the pipeline ---


def test_components_of_chains_stars_and_rings(spark):
    chain = [(n, n + 1) for n in range(100, 160)]
    star = [(5, n) for n in range(10, 60)]
    ring = [(n, 200 + (n - 199) % 30) for n in range(200, 230)] + [(7, 7)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(chain + star + ring, "a long, b long"), "t").collect()}
    want = {n: 100 for n in range(100, 161)} | {n: 5 for n in [5, *range(10, 60)]} | {n: 200 for n in range(200, 230)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_pipeline_equals_its_stages_by_brute_force(spark, words, texts):
    from stratavid.llm.quality import score_documents, train

    read = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = {r["doc_id"] for r in score_documents(docs, labels, train(docs, labels)).where("predicted = 1").collect()}
    (_, quality), (_, exact), (_, near), (_, mixture), (_, packing) = corpus_pipeline.STAGES
    one = quality(spark, docs, SF_DIR)
    assert one.columns == docs.columns and read(one) == {i: texts[i] for i in good}

    first = {}
    for i in sorted(good):
        first.setdefault(texts[i].translate(LOWER), i)
    two = exact(spark, one, SF_DIR)
    assert two.columns == docs.columns and set(read(two)) == set(first.values())

    left = sorted((i, texts[i]) for i in first.values())
    alone = {i for i, root in brute_components(left, corpus_pipeline.Rule(5, 80)).items() if i == root}
    three = near(spark, two, SF_DIR)
    assert three.columns == docs.columns and set(read(three)) == alone

    four = mixture(spark, three, SF_DIR)
    assert four.columns == docs.columns and read(four) == {i: texts[i] for i in alone}
    check_packing(packing(spark, four, SF_DIR).collect(), {i: plain_ids(words, texts[i]) for i in alone})


def test_packing_follows_the_mixture_over_part_files(spark, tmp_path):
    path, sizes = str(tmp_path / "mixture"), [30, 2000, 5, 800, 1, 400]
    bounds = np.cumsum([0, *sizes]).tolist()
    for n, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        made = spark.range(lo, hi, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 20) AS text", "'s' AS source")
        made.write.parquet(f"{path}-{n}")
        (file,) = (tmp_path / f"mixture-{n}").glob("part-*.parquet")
        (tmp_path / "mixture").mkdir(exist_ok=True)
        (tmp_path / "mixture" / f"part-{99998 + n:05d}-x-c000.snappy.parquet").write_bytes(file.read_bytes())
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")
    try:
        docs = spark.read.parquet(path)
        assert [r["doc_id"] for r in written_order(docs).collect()] == list(range(bounds[-1]))
        rows = corpus_pipeline.packing(spark, docs, SF_DIR).collect()
    finally:
        spark.conf.set(adaptive, before)
    tasks = {}
    for r in rows:
        tasks.setdefault(r["sequence_id"] >> 32, set()).add(r["doc_id"])
    assert len(tasks) > 1
    assert [i for t in sorted(tasks) for i in sorted(tasks[t])] == list(range(bounds[-1]))


def test_pipeline_runs_as_one(spark, words, texts):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    check_packing(rows, {i: plain_ids(words, texts[i]) for i in {r["doc_id"] for r in rows}})


# --- hostile and odd input ---


@pytest.mark.parametrize("mark", ["<script>", "<!--", "<title>", "<title ", "<a ", '<a href="', "<p ", "<html ", "</script "])
def test_a_megabyte_of_open_tags_is_read_at_once(mark):
    page = mark * ((1 << 20) // len(mark))
    began = time.perf_counter()
    plain_text(page)
    metadata_block(page, "", "d")
    assert time.perf_counter() - began < 20  # seconds; a quadratic scan takes minutes


def test_parts_of_a_page():
    page = (
        "<HTML class=x><html lang='de'><head><title a=1>A &amp; <b>B</b></title ></head><!-- <a href=no> --><p>one<p>two"
        "<script>if (a<b) x</script>three <a id=1 href=\"u?a=b\">l</a><a name=q><a HREF='v'>m</a> href=w <style>unclosed <i>four"
    )
    assert plain_text(page) == "one\ntwo three lm href=w unclosed four"
    assert metadata_block(page, "HTTP/1.1 200 OK\nX-A:  1 ", "d").split("\n") == [
        "source-payload-digest: d", "title: A & B", "language: de", "http-x-a: 1", "outlink: no", "outlink: u?a=b", "outlink: v",
    ]


def test_derivatives_of_pages_with_clashing_names(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "v", "<title>" * 30_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    sources = responses(pages).select("*", *(F.lit("x").alias(c) for c in ("block", "source_id", "warc_type", "text")))
    found = derivatives(sources).collect()
    assert len(found) == 8 and len({r["record_id"] for r in found}) == 6
    assert [r["block"] for r in found if r["warc_type"] == "conversion"] == ["a", "a", "", ""]


def test_token_files_of_repetitive_texts_are_sliced_by_their_ids(spark, words, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "SLICE_IDS", 3000)
    texts = {n: "again " * (5000 if n % 50 == 0 else 7) for n in range(200)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    files = write_token_files(df, str(tmp_path / "files"))
    start = 0
    for r in sorted(read_token_files(spark, files, with_ids=True).collect(), key=lambda r: r["doc_id"]):
        ids = plain_ids(words, texts[r["doc_id"]])
        assert np.frombuffer(r["ids"], "<u4").tolist() == [*ids, 2][: len(r["ids"]) // 4] and r["start"] == start
        start += r["n_tokens"]
    batch = pa.record_batch([pa.array([5, 2999, 9000, 1, 1, 0])], ["n"])
    sizes = [part.column("n").to_pylist() for part in token_output._slices(batch, "n")]
    assert [x for s in sizes for x in s] == [5, 2999, 9000, 1, 1, 0] and all(sum(s) - max(s) < 3000 for s in sizes)


def test_pipeline_of_odd_rows(spark, odd, none, tmp_path):
    labels = spark.createDataFrame([(5, 1), (None, 0), (5, 1), (99, 0)], "doc_id long, quality int")
    for name, docs in (("odd", odd), ("none", none)):
        docs.drop("source").withColumn("source", F.lit(None).cast("string")).write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    assert {r["doc_id"] for r in rows} == {None, 1, 3, 4, 5, 8, 9, 10, 11}
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_the_order_of_rows_that_are_no_scan_is_kept(spark):
    sorted_ = spark.range(500).select(F.col("id").alias("doc_id"), (-F.col("id")).alias("_part")).repartitionByRange(7, "_part").sortWithinPartitions("_part")
    found = [(r["doc_id"], r["_part"]) for r in written_order(sorted_).collect()]
    assert found == [(n, -n) for n in range(499, -1, -1)]
