import hashlib
import itertools
import random
import tracemalloc
import zlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratavid.llm import pii, quality, queries, secrets
from stratavid.llm.fingerprint import as_text, chunk_weights, containment, edit_resistance, edited, fingerprints, from_text
from stratavid.llm.quality import Ranker, features, fit_pairs, held_out, keep_good, place_cut, score_documents, train
from stratavid.llm.spans import joined
from tests.llm.conftest import LONG, ODD, SF_DIR


def digest(spans):
    return hashlib.sha256(joined(spans).encode()).hexdigest()


# --- fingerprints ---


def test_fingerprints_of_documents_and_edits(spark, texts):
    rows = {r["doc_id"]: r for r in queries.op1_fingerprint(spark, SF_DIR).collect()}
    ids = sorted(texts)
    for at, i in enumerate(ids):
        follow = texts[ids[(at + 1) % len(ids)]]
        new, own = edited(texts[i], follow), chunk_weights([texts[i]])[0]
        assert rows[i]["n_chars"] == len(texts[i])
        assert rows[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert rows[i]["fingerprint"] == as_text(own)
        assert rows[i]["near_edited"] == containment(own, chunk_weights([new])[0])
        assert rows[i]["near_next"] == containment(own, chunk_weights([follow])[0])
    assert np.median([r["near_edited"] for r in rows.values()]) > 0.4


def test_fingerprints_resist_shifts_and_do_not_depend_on_neighbours():
    plain, shifted = LONG, "some words in front " + LONG[:40_000] + " and in between " + LONG[40_000:]
    one, other, again = chunk_weights([plain, shifted, plain])
    assert one == again == chunk_weights([plain])[0] == from_text(as_text(one))
    assert 0.99 < containment(one, other) < 1
    assert containment({}, {}) == 1 and containment(one, {}) == containment({}, one) == 0


def test_edit_resistance_of_odd_rows(spark, odd, none):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = edit_resistance(odd).collect()
        assert edit_resistance(none).count() == 0
        one = edit_resistance(odd.where("doc_id = 8")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    low = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = [
        (i, hashlib.sha256(edited(t or "", low[(n + 1) % len(low)][1] or "").encode()).hexdigest()) for n, (i, t, _) in enumerate(low)
    ]
    assert sorted(((r["doc_id"], r["edited_sha256"]) for r in rows), key=repr) == sorted(want, key=repr)
    assert one[0]["edited_sha256"] == hashlib.sha256(edited("É élan", "É élan").encode()).hexdigest()
    assert fingerprints(odd).count() == len(ODD)


# --- personal data ---

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            odd, even = digits[-1::-2], [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                "card": 12 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), n, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def messy_texts(alphabet, count=3000, seed=2):
    draw = random.Random(seed)
    return ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(count)]


def test_personal_base_spans_equal_plain_patterns():
    for text in messy_texts("1234.5@a-B +()é%") + messy_texts("0125 .-+"):
        assert sorted(pii.base_spans(text)) == sorted(plain_spans(text)), text


def test_personal_data_in_documents(spark, texts):
    for r in queries.op3_personal_data(spark, SF_DIR).collect():
        base = plain_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(base)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(joined(base).split(",")) <= set(r["spans"].split(","))


def sample_windows(seed, count):
    draw, out = random.Random(seed), []
    words = "the and of onder sich eine que para con les des".split()
    for n in range(count):
        value = [
            f"{draw.choice(words)}{draw.randrange(99)}@mail{draw.randrange(9)}.example.com",
            ".".join(str(draw.randrange(256)) for _ in range(4)),
            f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}",
        ][n % 3]
        text = " ".join(draw.choices(words, k=4)) + " " + value + " " + " ".join(draw.choices(words, k=4))
        out.append((text[:64], [s for s in pii.base_spans(text) if s[2] <= 64]))
    return out


def test_tagger_learns_spans_and_reconciles_windows():
    tagger = pii.fit_windows(sample_windows(1, 500))
    held = [w for w in sample_windows(2, 150) if w[1]]
    found = pii.tag_texts(tagger, [w[0] for w in held])
    assert sum(set(w[1]) <= set(f) for w, f in zip(held, found)) / len(held) > 0.9
    long = " ".join(w[0] for w in held)  # many windows, one path
    assert len(set(pii.tag_texts(tagger, [long])[0]) & set(pii.base_spans(long))) / len(pii.base_spans(long)) > 0.85
    assert pii.tag_texts(tagger, ["nothing to see here", ""]) == [[], []]
    for own, every in pii.find(tagger, [w[0] for w in held]):
        assert set(own) <= set(every)


def test_tagger_gradient_is_the_slope_of_its_loss():
    tagger = pii.Tagger()
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    x, tags = np.full((2, 9), pii.PAD), np.zeros((2, 9), int)
    x[0], x[1, :5] = pii.codes("ab 12@c.d"), pii.codes("+1 23")
    tags[0, 3:6], tags[1, :5] = [1, 2, 2], [7, 8, 8, 8, 8]

    def loss():
        emit, move = tagger.emissions(x.T), np.where(pii.FORBIDDEN, -30.0, tagger.p["move"])
        total = 0.0
        for w in range(2):
            size = int((x[w] != pii.PAD).sum())
            a, score = emit[0, w], emit[0, w, tags[w, 0]]
            for t in range(1, size):
                a = pii._logsum(a[:, None] + move, 0) + emit[t, w]
                score += move[tags[w, t - 1], tags[w, t]] + emit[t, w, tags[w, t]]
            total += pii._logsum(a, 0) - score
        return total / 2

    grad = tagger.gradient(x.T, tags.T)
    for name, at in (("x", (0, 0, 3)), ("x", (1, 3, 28)), ("h", (0, 2, 5)), ("h", (1, 7, 30)), ("c", (1, 4)), ("out", (3, 2)), ("move", (0, 1)), ("bias", (8,))):
        old = tagger.p[name][at]
        tagger.p[name][at] = old + 1e-4
        up = loss()
        tagger.p[name][at] = old - 1e-4
        down = loss()
        tagger.p[name][at] = old
        assert abs((up - down) / 2e-4 - grad[name][at]) < 2e-3, name


def test_scan_gives_the_emissions_of_the_training_loop():
    tagger, draw = pii.Tagger(), np.random.default_rng(2)
    x = draw.integers(0, pii.PAD, (40, 9))
    x[25:, 3] = x[1:, 5] = pii.PAD
    slow, fast = tagger.emissions(x).transpose(1, 0, 2), tagger.scan(x.astype(np.int8))
    assert np.abs(slow - fast)[(x != pii.PAD).T].max() < 1e-4


def test_scan_is_as_exact_as_single_precision():
    tagger, draw = pii.Tagger(), np.random.default_rng(4)
    for scale in (1, 30):  # with weights of 30 times the size gates close and sums pass what exp can hold
        tagger.p["x"] *= np.float32(scale)
        x = draw.integers(0, pii.PAD, (60, 20))
        x[40:, ::3] = pii.PAD
        slow, fast = tagger.emissions(x).transpose(1, 0, 2), tagger.scan(x.astype(np.int8))
        assert np.abs(slow - fast)[(x != pii.PAD).T].max() < 1e-5


def test_decoding_is_the_best_of_all_paths():
    draw = np.random.default_rng(6)
    for _ in range(6):
        tagger = pii.Tagger()
        tagger.p["move"] = draw.normal(0, 1, (pii.TAGS, pii.TAGS))
        emit = draw.normal(0, 2, (4, pii.TAGS))
        move = tagger.moves()
        for ends in ((False, False), (True, False), (True, True)):
            def worth(path):
                inside = path[0] and path[0] % 2 == 0
                score = sum(emit[t, k] for t, k in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])) - 1e4 * bool(inside)
                return score + (move[0, path[0]] if ends[0] else 0) + (move[path[-1], 0] if ends[1] else 0)

            want = max(itertools.product(range(pii.TAGS), repeat=4), key=worth)
            assert tuple(tagger.decode([emit], [ends])[0]) == want


def test_paths_of_parts_are_the_path_of_the_whole_text():
    draw = np.random.default_rng(8)
    for n in range(60):
        tagger = pii.Tagger(n)
        tagger.p["move"] = draw.normal(0, 1, (pii.TAGS, pii.TAGS))
        emit = draw.normal(0, 1.5, (80, pii.TAGS)) + np.where(np.arange(pii.TAGS) == 0, 2.5, 0)
        emit[draw.random(80) < 0.6, 0] += 9
        whole, parts = tagger.decode([emit])[0], np.zeros(80, int)
        inside = np.flatnonzero(tagger.within(emit))
        for run in np.split(inside, np.flatnonzero(np.diff(inside) > 1) + 1) if len(inside) else []:
            parts[run] = tagger.decode([emit[run]], [(run[0] > 0, run[-1] < 79)])[0]
        assert (whole == parts).all()


def test_model_reads_whole_texts_and_knows_forms_in_other_words(spark):
    tagger = pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))  # smaller tables have too few spans
    texts = {
        "please write to info @ customer-relations-department.example.com for help": "info @ customer-relations-department.example.com",
        "a.very.long.local.part.of.somebody.important @ mail.example.net is mine": "a.very.long.local.part.of.somebody.important @ mail.example.net",
        "my number is 619-555-0053, thanks": "619-555-0053",
        "the server at 10 . 0 . 12 . 7 is down": "10 . 0 . 12 . 7",
        "pay with 4111/1111/1111/1111 please": "4111/1111/1111/1111",
    }
    found = pii.find(tagger, [*texts, "nothing here, or there, " * 3000 + "reach jane.doe @ example.org today"])
    got = [[t[s:e] for _, s, e in every] for t, (_, every) in zip(texts, found)]
    assert sum([want] == own for want, own in zip(texts.values(), got)) >= 4, got
    assert [s for _, s, _ in found[-1][1]] == [72006]


def test_spans_apart_stay_quick():
    base = [("ip", n, n + 4) for n in range(0, 1_000_000, 10)]
    found = [("card", n + 3, n + 5) for n in range(0, 1_000_000, 10)] + [("card", n + 5, n + 8) for n in range(0, 1_000_000, 10)]
    assert len(pii.apart(found, base)) == 100_000
    assert pii.apart([("ip", 0, 3), ("ip", 2, 5), ("ip", 5, 6)], [("card", 6, 9), ("card", 7, 8)]) == [("ip", 0, 3), ("ip", 5, 6)]


def test_personal_data_of_odd_rows(odd, none):
    rows = pii.find_personal_data(odd, pii.train(odd)).collect()
    assert len(rows) == len(ODD) and sum(r["n_email"] for r in rows) == 1
    assert pii.train(none) is None and pii.find_personal_data(none, None).count() == 0


# --- secrets ---


def plain_secrets(text):
    out = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", m, len(m[2]) >= 12) for m in re.finditer(assign, text, re.I | re.A)]
    found += [("access", m, len(m[0]) >= 18) for m in re.finditer("AKIA[A-Z0-9]+", text)]
    found += [("hex", m, len(m[0]) >= 16) for m in re.finditer("[0-9a-f]+", text)]
    out = [(m.start(), secrets.KINDS.index(k), k, m.end()) for k, m, good in found if good]
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def test_secret_base_spans_equal_plain_patterns():
    made = [t.replace("T", "token").replace("S", "Secret").replace("K", "AKIA") for t in messy_texts("TSK:= 'ab0123456789+Zé", 2000)]
    for text in made + messy_texts("0123abcdefgé ", 2000):
        assert sorted(m[:3] for m in secrets.base_matches(text)) == sorted(plain_secrets(text)), text


def test_secrets_in_documents(spark, texts):
    for r in queries.op7_secrets(spark, SF_DIR).collect():
        base = plain_secrets(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(base)
        assert [r[f"n_{k}"] for k in secrets.KINDS] == [sum(s[0] == k for s in base) for k in secrets.KINDS]
        assert set(joined(base).split(",")) <= set(r["spans"].split(","))


def test_inferred_grammar_tells_credentials_from_words():
    draw = random.Random(4)
    make = lambda: "AKIA" + "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(12, 20)))
    grammar = secrets.fit({"access": [make() for _ in range(200)], "plain": [word() for _ in range(400)]})
    assert len(grammar.kinds["access"].step) < 60  # the prefix tree has thousands of states
    text = f"é {word()} {make()[:1]}KIB{make()[4:]} {word()}"
    own, every = secrets.find(grammar, [text])[0]
    assert own == [] and [(k, text[s:e][1:4]) for k, s, e in every] == [("access", "KIB")]
    assert secrets.find(grammar, ["", word()]) == [([], []), ([], [])]


@pytest.mark.parametrize("bare_share", [0.01, 0.3])
def test_bare_credentials_of_a_labelled_format_are_found(bare_share):
    draw = random.Random(6)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    make = lambda: "".join(draw.choice(letters) for _ in range(32))
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(12, 20)))
    bare = [make() for _ in range(int(1000 * bare_share))]
    texts = [f"password={make()} and {word()} {word()}" for _ in range(200)] + [f"{word()} is {b} here" for b in bare]
    texts += [f"{word()} {word()}" for _ in range(600)]
    picked = {}
    for kind, piece in {x: None for t in texts for x in secrets.examples(t)}:
        picked.setdefault(kind, []).append(piece)
    assert set(bare) <= set(picked["plain"])  # unlabelled, so they lie among the plain examples
    found = secrets.find(secrets.fit(picked), texts)
    added = {t[s:e] for t, (own, every) in zip(texts, found) for _, s, e in every[len(own) :]}
    assert len(added & set(bare)) >= 0.9 * len(bare)
    assert len(added - set(bare)) <= 5  # plain words


def test_held_out_credentials_of_documents_have_their_formats(spark):
    """Automata of some documents know bare credentials of the others, and take few plain words for one."""
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    half = len(texts) // 2
    seen, unseen = ({x: None for t in part for x in secrets.examples(t)} for part in (texts[:half], texts[half:]))
    picked = {k: [p for kind, p in seen if kind == k][: secrets.PLAIN if k == "plain" else secrets.EXAMPLES] for k in (*secrets.KINDS, "plain")}
    grammar = secrets.fit(picked)
    for kind in (*grammar.kinds, "plain"):
        held = [p for k, p in unseen if k == kind and p not in picked[kind]]
        share = float((grammar.score(*secrets._laid(held))[0] > 0).mean())
        assert share <= 0.01 if kind == "plain" else share >= 0.9, (kind, share, len(held))


def test_merged_automaton_takes_every_example_it_learned_from():
    draw = random.Random(9)
    made = ["AKIA" + "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)) for _ in range(60)]
    grammar = secrets.infer(made)
    for text in made:  # no transition of the prefix tree is lost by merging
        state = 0
        for c in text:
            state = grammar.step[state, secrets._SYMBOL[ord(c)]]
        assert state < len(grammar.step) - 1, text


def test_automaton_recovers_a_repeating_format():
    draw = random.Random(8)
    grammar = secrets.infer(["".join(draw.choice("0123") + "-" for _ in range(draw.randrange(3, 9))) for _ in range(300)])
    score = lambda t: grammar.likelihood(secrets._SYMBOL[np.frombuffer(t.encode(), np.uint8)], np.array([0]), np.array([len(t)]))[0]
    assert score("1-2-3-0-") > score("1-2--0-3") + 0.5 and score("1-2-3-0-") > score("aaaaaaaa") + 2


def test_secrets_of_odd_rows(odd, none):
    rows = secrets.find_secrets(odd, secrets.train(odd)).collect()
    assert len(rows) == len(ODD) and sum(r["n_assign"] for r in rows) == 3
    assert secrets.train(none) is None and secrets.find_secrets(none, None).count() == 0


# --- quality ---


def test_quality_is_learned_and_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = queries.op5_quality(spark, sf_dir).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 40
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_held_out_rows_are_not_learned_from(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = train(docs, labels), train(docs, turned)
    assert (one.weight == other.weight).all()
    assert score_documents(docs, labels, one).exceptAll(score_documents(docs, turned, other)).isEmpty()


def test_cut_is_the_quantile_with_the_fewest_labels_on_the_wrong_side(spark):
    draw = np.random.default_rng(4)
    rows = [(n, float(draw.normal(n % 4 > 0, 0.6)), int(n % 4 > 0)) for n in range(4000)]
    rated = spark.createDataFrame([r[:2] for r in rows], "doc_id long, strength double")
    labels = spark.createDataFrame([(n, q) for n, _, q in rows], "doc_id long, quality int")
    flat = Ranker(np.zeros(1), np.ones(1), np.zeros(1), 0.0)
    cut = place_cut(rated, labels, flat).cut
    known = [(s, q) for n, s, q in rows if zlib.crc32(str(n).encode()) % 5]
    wrong = lambda at: sum((s >= at) != (q == 1) for s, q in known)
    assert wrong(cut) <= min(wrong(s) for s, _ in known) + 1
    assert place_cut(rated, labels.where("quality = 1"), flat).cut == -np.inf
    same = rated.withColumn("strength", F.lit(2.0))  # one tie: most labels are good, so all stay
    assert place_cut(same, labels, flat).cut < 2


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (4, 0), (6, 1), (6, 0), (None, 1), (9, None)], "doc_id long, quality int")
    ranker = train(odd, labels)
    assert score_documents(odd, labels, ranker).count() == len(ODD)
    assert keep_good(odd, labels, ranker).columns == odd.columns
    flat = train(none, labels.limit(0))
    assert score_documents(none, labels, flat).count() == 0
    assert keep_good(odd, labels.limit(0), flat).count() == len(ODD)  # nothing learned, nothing rejected


def test_pairs_rank_good_above_bad():
    good = features(pa.array(["plain words in a row, nothing else."] * 5 + ["other words here."] * 5))
    bad = features(pa.array(["### $$$ %%% !!! ***"] * 5))
    ranker = fit_pairs(good, bad)
    assert ranker.strength(good).min() > ranker.strength(bad).max()


def test_features_take_little_more_memory_than_their_texts():
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefgh,.1A#é", k=6)) for _ in range(300)]
    texts = pa.array([" ".join(draw.choices(words, k=300)) for _ in range(1500)] + [None, "", "x"])
    tracemalloc.start()
    found = features(texts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 4 * texts.nbytes
    # The same numbers as from each text's pairs, counted one by one.
    block, long = quality.BLOCK, texts[0].as_py()
    raw = long.encode()
    pairs = np.zeros(quality.KINDS**2)
    for a, b in zip(raw, raw[1:]):
        pairs[int(quality.CLASS[a]) * quality.KINDS + int(quality.CLASS[b])] += 1
    assert np.array_equal(found[0, : quality.KINDS**2], 3 * pairs / (len(raw) + quality.PRIOR))
    try:
        quality.BLOCK = 7
        assert np.array_equal(features(texts.slice(0, 3)), found[:3])
    finally:
        quality.BLOCK = block
    assert np.array_equal(found[-3], found[-2])
