"""BPE, token files, toxicity, license scans, token counts: against the library or brute force, with odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import bpe, license_scan, token_counts, token_files, toxicity
from quarry.llm.shared import scratch

ODD = [(1, "Hello, it's  Wörld ΟΔΟΣ 日本語 12½", "en", "s"), (2, None, None, None), (3, "", "de", "s"), (4, "x" * 5000, "en", "s"), (5, "<|endoftext|> a\x1cb <|startoftext|>", "en", "s"), (5, "same id", "en", "s"), (6, "word " * 30_000, "en", "s"), (None, "no id", "en", "s"), (7, "same text", "en", "s"), (8, "same text", "en", "s")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with more columns whose names are those of results or of inner columns."""
    df = spark.createDataFrame(ODD, SCHEMA)
    for c in ("n_tokens", "ids", "score", "id", "row", "size", "part", "decoded", "words", "kept", "target", "copies", "base", "n", "key", "bit", "word", "shard", "slot", "start", "labels"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def clip():
    return Tokenizer.from_file(bpe.default_path())


def test_bpe_equals_the_library(clip):
    codec, rng = bpe.Codec(bpe.read_spec(bpe.default_path())), random.Random(4)
    letters = "aaabcdeeinorst'’.,!  \n\t\x1c\x85\xa0éßΣσ日本😀İ0½²_-AB" + "<|startoftext|>"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        ids = clip.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == clip.decode(ids, skip_special_tokens=False)


def test_streamed_tokens_are_those_of_the_whole(clip):
    codec, rng = bpe.Codec(bpe.read_spec(bpe.default_path())), random.Random(9)
    for n in (300, 2000, 20_000):
        word = "".join(rng.choice("aehilnorst") for _ in range(n))
        expected = clip.encode(word, add_special_tokens=False).ids
        assert list(codec.transducer.stream(word[k : k + 77] for k in range(0, n, 77))) == expected
        assert codec.encode(word) == expected


def test_stream_keeps_few_symbols(monkeypatch):
    codec = bpe.Codec(bpe.read_spec(bpe.default_path()))
    most, inner = [0], codec.transducer._last
    monkeypatch.setattr(codec.transducer, "_last", lambda text, *a: (most.__setitem__(0, max(most[0], len(text))), inner(text, *a))[1])
    list(codec.transducer.stream("abcdefghij" for _ in range(3000)))
    assert most[0] < 4 * bpe.BLOCK < codec.transducer.lookahead


def test_decoder_in_pieces():
    codec = bpe.Codec(bpe.read_spec(bpe.default_path()))
    ids = codec.encode("日本語 wörld abc")
    one, many = bpe.Decoder(codec), bpe.Decoder(codec)
    assert "".join(many.text([i]) for i in ids) == one.text(ids)
    many = bpe.Decoder(codec)
    assert "".join(many.bytes_text([i]) for i in ids) + many.bytes_text([], True) == "日本語 wörld abc "


def test_bpe_rows(odd, clip):
    got = bpe.digest_documents(odd, bpe.default_path()).collect()
    assert len(got) == len(ODD)
    expected = []
    for doc_id, text, *_ in ODD:
        ids = clip.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(clip.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=repr) == sorted(expected, key=repr)
    round_trip = bpe.decode_documents(bpe.encode_documents(odd, bpe.default_path()), bpe.default_path()).where("doc_id = 1").first()
    assert round_trip.decoded == clip.decode(round_trip.ids, skip_special_tokens=False)
    assert bpe.digest_documents(odd.limit(0), bpe.default_path()).count() == 0


def test_token_files(spark, odd):
    gpt = Tokenizer.from_file(token_files.default_path())
    uri = scratch(spark, "test-tokens")
    manifest = token_files.write_tokens(odd, uri, token_files.default_path(), length=64)
    got = [tuple(r) for r in token_files.read_tokens(manifest, uri).orderBy("start").collect()]
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, expected = 0, []
    for doc_id, text, *_ in rows:
        ids = gpt.encode(text or "", add_special_tokens=False).ids + [token_files.END]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected
    part = manifest.orderBy("part").first()
    opened = token_files.TokenFile(uri, part.sequences, part.docs)
    ids, mask = opened.sequence(0)
    assert len(ids) == len(mask) == 64 and not ids.flags.owndata
    assert token_files.read_tokens(token_files.write_tokens(odd.limit(0), uri, token_files.default_path()), uri).count() == 0


def test_pieces_never_cross_pre_tokens():
    gpt, rng = Tokenizer.from_file(token_files.default_path()), random.Random(2)
    encoder = token_files.Encoder(bpe.read_spec(token_files.default_path()))
    for _ in range(1500):
        text = "".join(rng.choice("aabc'’st.,!   \n\n\t\x1c\x85\xa0　éß日😀0½²_-") for _ in range(rng.randrange(50)))
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == gpt.encode(text, add_special_tokens=False).ids


def test_words_encoded_by_one_call(monkeypatch):
    gpt, rng = Tokenizer.from_file(token_files.default_path()), random.Random(5)
    encoder, sizes = token_files.Encoder(bpe.read_spec(token_files.default_path()), table=20), []
    monkeypatch.setattr(encoder, "_together", lambda missing, plain=encoder._together: sizes.append(len(found := plain(missing))) or found)
    for _ in range(300):
        words = ["".join(rng.choice("aeioutnsré日1\x1c-") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(40))]
        text = "".join(rng.choice([" ", " ", " ", "  ", "\n"]) + w + rng.choice(["", "", ".", ","]) for w in words)
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == gpt.encode(text, add_special_tokens=False).ids
    assert max(sizes) > 10


def test_long_texts_are_cut_where_it_does_not_matter(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 100)
    gpt, encoder = Tokenizer.from_file(token_files.default_path()), token_files.Encoder(bpe.read_spec(token_files.default_path()))
    text = " lorem ipsum,  dolor\n sit\namet" * 60
    assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == gpt.encode(text, add_special_tokens=False).ids


def test_trees_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    margin = toxicity.Trees().fit(x[:1000], y[:1000]).margin(x[1000:])
    assert ((margin > 0) == (y[1000:] == 1)).mean() > 0.97
    xs, ys = toxicity.isotonic(np.array([1.0, 2, 3, 3, 4]), np.array([0.0, 1, 0, 1, 1]))
    assert (np.diff(ys) >= 0).all() and ys[0] == 0 and ys[-1] == 1
    assert abs(np.interp(2.0, xs, ys) - 2 / 3) < 1e-9


def test_toxicity_learns_and_generalises(spark):
    rng = random.Random(1)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "vita", "nova", "terra"]
    rows = []
    for k in range(900):
        text = [rng.choice(words) for _ in range(40)]
        if k % 5 == 0:
            text[rng.randrange(40)] = "zork" + rng.choice(["a", "us", "ix", "olo", "en"])
        rows.append((k, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels)
    assert model.lexicon and not any(t in model.lexicon for t in words)
    unseen = spark.createDataFrame([(1, "lorem zorkabc dolor"), (2, "lorem ipsum"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score_documents(unseen, model).collect()}
    assert got[1] >= 0.7 and got[2] < 0.3 and got[3] == got[4] < 0.3


def test_toxicity_without_labels(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_documents(odd, toxicity.train(odd, labels)).collect()
    assert len(got) == len(ODD) and all(r.score == 0.0 for r in got)
    one = spark.createDataFrame([(1, 1), (4, None)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.score_documents(odd, toxicity.train(odd, one)).collect())


def test_features_do_not_depend_on_blocks(monkeypatch):
    make = toxicity.Features({"bad": 4.0}, most=50_000)
    text = " ".join(["you are bad", "st*ff B4D !!", "x"] * 300)
    assert np.allclose(make.of(text), toxicity.Features({"bad": 4.0}, most=50_000).of(text))
    assert make.of("b@d")[14] == 1.0 and make.of("you bad")[7] == 1 and make.of("")[0] == 0


def brute_licenses(text):
    words, places, labels = license_scan.words_of(text or ""), [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan(spark, odd):
    mit = license_scan.PASSAGES[0][0]
    texts = ["MIT License", "the mit license, MIT-License! mit  licenses", "General Public\nLicense apache license", mit, mit.replace("free of charge, ", "").replace("without restriction", "without any restriction"), "All rights reserved.", "licensed under CC BY-NC 4.0.", "mit x license", None, "", "Übergeneral public license"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licenses(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(r["labels"].split(","))
    assert [got[k]["labels"] for k in (3, 4, 5, 6, 7)] == ["mit", "mit", "reserved", "cc-by-nc", ""]
    assert got[4].score < 1.0 == got[3].score and got[8].score == 0.0
    assert license_scan.scan(odd).count() == len(ODD) and license_scan.scan(odd.limit(0)).count() == 0


def test_license_spans(spark):
    name = "licensed under a Creative Commons Attribution{} 4.0 International License"
    texts = [f"x y {name.format(m)} z" for m in ("", "-ShareAlike", "-NonCommercial", "-NoDerivatives", "-NonCommercial-ShareAlike")]
    texts += ["a " + name.format("").replace("under a", "under a new"), "see the MIT License", "all rights all rights all rights", name.format("-NonCommercial") + " b " * 30 + name.format("")]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[k]["labels"] for k in range(9)] == ["cc-by", "cc-by-sa", "cc-by-nc", "", "", "cc-by", "mit", "", "cc-by,cc-by-nc"]
    assert [[tuple(s) for s in got[k].spans] for k in (0, 2, 3, 5, 6, 8)] == [[("cc-by", 2, 12)], [("cc-by-nc", 2, 13)], [], [("cc-by", 1, 12)], [("mit", 2, 4)], [("cc-by", 41, 51), ("cc-by-nc", 0, 11)]]


def test_rollup(spark):
    rollup = token_counts.Rollup(spark, scratch(spark, "test-rollup"))
    change = lambda *rows: spark.createDataFrame(rows, "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long")
    totals = lambda: sorted((tuple(r) for r in rollup.totals().collect()), key=repr)
    assert totals() == []
    first = change(("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None), ("insert", None, None, "v1", None, None))
    assert rollup.commit("b1", first) and not rollup.commit("b1", first)
    rollup.commit("b2", change(("revise", "a", "en", "v1", 7, 5), ("insert", "a", "en", "v2", 3, None)))
    rollup.commit("b3", change(("delete", "a", "en", "v1", 10, None)))
    expected = sorted([("a", "en", "v1", 1, 7), ("a", "en", "v2", 1, 3), (None, None, "v1", 1, 0)], key=repr)
    assert totals() == expected
    rollup.fold()
    assert totals() == expected and not rollup.commit("b2", first)
    rollup.commit("b4", change(("delete", "a", "en", "v2", 3, None)))
    rollup.commit("b5", first.limit(0))
    rollup.fold()
    assert totals() == sorted([("a", "en", "v1", 1, 7), (None, None, "v1", 1, 0)], key=repr)
    with pytest.raises(Exception, match="unknown change"):
        rollup.commit("bad", change(("move", "a", "en", "v1", 1, None)))
    assert "bad" not in rollup.committed() and totals() == sorted([("a", "en", "v1", 1, 7), (None, None, "v1", 1, 0)], key=repr)
    with pytest.raises(ValueError):
        rollup.commit("../x", first)


def test_token_counts_query(spark, sf):
    gpt = Tokenizer.from_file(token_files.default_path())
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    last = {}
    for d in docs:
        key = (d.text or "").translate(lower)
        last[key] = max(last.get(key, d.doc_id), d.doc_id)
    sums = {}
    for d in docs:
        if last[(d.text or "").translate(lower)] == d.doc_id:
            n = sums.setdefault((d.source, d.lang), [0, 0])
            n[0] += 1
            n[1] += len(gpt.encode(d.text or "", add_special_tokens=False).ids)
    got = {(r.source, r.lang): [r.documents, r.tokens] for r in token_counts.op8_token_counts(spark, sf).collect()}
    assert got == sums


def test_blocks_do_not_change_tokens(clip, monkeypatch):
    monkeypatch.setattr(bpe, "TEXT_BLOCK", 50)
    monkeypatch.setattr(bpe, "PIECES", 7)
    codec, rng = bpe.Codec(bpe.read_spec(bpe.default_path())), random.Random(8)
    letters = "aaabcdeeinorst'’.,!    \n\t\x1c\x85\xa0e\u0301\u0323ßΣσ日本😀İ0½²_-AB" + "<|startoftext|>"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(600)))
        text = rng.choice([text, text.replace(" ", ""), text + "ab" * 400 + "!?" * 300])
        ids = clip.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        n, of_ids, of_text = bpe._digest(codec, text)
        assert n == len(ids) and of_ids == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert of_text == hashlib.sha256(clip.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_decoder_does_not_depend_on_its_calls(clip):
    codec, rng = bpe.Codec(bpe.read_spec(bpe.default_path())), random.Random(3)
    ids = [rng.randrange(49_000) for _ in range(3000)] + [10**9]
    machine, at, out = bpe.Decoder(codec), 0, []
    while at < len(ids):
        n = rng.randrange(0, 40)
        out.append(machine.text(ids[at : at + n]))
        at += n
    assert "".join(out) + machine.end() == clip.decode(ids[:-1], skip_special_tokens=False)


def test_long_text_is_held_in_blocks():
    import tracemalloc

    codec = bpe.Codec(bpe.read_spec(bpe.default_path()))
    words = [f"{a}{b} " for a in ("some", "more", "other") for b in ("thing", "word", "time")]
    peak = []
    for n in (400_000, 4_000_000):
        text = "".join(words[k % 9] for k in range(n // 9))
        bpe._digest(codec, "warm up")
        tracemalloc.start()
        bpe._digest(codec, text)
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peak[1] < 1.3 * peak[0] and peak[1] < 4_000_000


def test_full_tables_keep_what_is_in_use():
    made = []
    table = bpe.Bounded(lambda k: made.append(k) or k * 2, 10)
    for k in range(45):
        assert table[k] == 2 * k and table[3 if k > 3 else k] in (6, 2 * k)
    assert len(table) <= 10 and len(table.aside) <= 10 and made.count(3) == 1


def test_token_files_of_text_ids_and_one_hot_id(spark, tmp_path):
    rows = [("a", f"text {k}") for k in range(300)] + [("b", "x"), (None, "y"), ("c", None)]
    uri = f"file://{tmp_path}/t"
    df = spark.createDataFrame(rows, "doc_id string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_tokens(df, uri, token_files.default_path())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = token_files.read_tokens(manifest, uri).orderBy("start").collect()
    assert [r.id for r in got] == [None, *["a"] * 300, "b", "c"] and manifest.count() > 2
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_totals_of_repeated_and_null_ids(spark, tmp_path):
    rows = [(1, "one two", "en", "s"), (1, "one two", "en", "s"), (1, "One two", "en", "t"), (2, "three", "de", "s"), (None, "four five six", None, None), (None, "four five six", None, None), (3, None, "en", "s"), (4, "", "en", "t")]
    gpt = Tokenizer.from_file(token_files.default_path())
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {(r.source, r.lang): (r.documents, r.tokens) for r in token_counts.corpus_totals(df, f"file://{tmp_path}/r", token_files.default_path(), "t").collect()}
    n = lambda text: len(gpt.encode(text, add_special_tokens=False).ids)
    # of the three equal texts of id 1 one stays, and of "" and null the one with the larger id, 4
    expected = []
    for a, b in ((1, 0), (0, 1)):
        want = {("s", "de"): (1, n("three")), (None, None): (1, n("four five six")), ("t", "en"): (1 + b, b * n("One two"))}
        expected.append(want | ({("s", "en"): (1, n("one two"))} if a else {}))
    assert got in expected


def test_fold_leaves_batches_that_come_meanwhile(spark, tmp_path):
    rollup = token_counts.Rollup(spark, f"file://{tmp_path}/f")
    change = lambda n: spark.createDataFrame([("insert", "s", "en", "t", n, None)], "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long")
    rollup.commit("a", change(5))
    listed = rollup._folders
    rollup._folders = lambda kind: [x for x in listed(kind) if x != "b"]
    rollup.commit("b", change(7))
    rollup.fold()
    rollup._folders = listed
    assert [tuple(r) for r in rollup.totals().select("documents", "tokens").collect()] == [(2, 12)]
    rollup.fold()
    assert [tuple(r) for r in rollup.totals().select("documents", "tokens").collect()] == [(2, 12)] and rollup.committed() == ["a", "b"]


def test_toxicity_query_on_a_table(spark):
    import zlib as z

    sf = "/root/testdata/sf0.1"
    got = toxicity.op2_toxicity(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.held_out == (z.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.predicted, truth[r.doc_id], r.score) for r in got if r.held_out and r.doc_id in truth]
    toxic = [s for _, y, s in held if y]
    assert sum(p for p, y, _ in held if y) >= 0.88 * len(toxic) and sum(p for p, y, _ in held if not y) <= 0.02 * len(held)
    clean = [s for _, y, s in held if not y]
    assert np.mean([np.mean([a > b or (a == b) / 2 for b in clean]) for a in toxic]) > 0.95


def test_toxicity_without_both_labels(spark):
    docs = spark.createDataFrame([(k, "a b c") for k in range(20)], "doc_id long, text string")
    for labels in ([], [(k, 0) for k in range(20)], [(k, 1) for k in range(20)], [(None, 1), (3, None)]):
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        scores = {r.score for r in toxicity.score_documents(docs, model).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 1
