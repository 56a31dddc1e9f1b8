import hashlib
import json
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linfold.llm import bpe, op1_fingerprint, op2_packing, op4_rules, op7_toxicity, op8_revisits, op9_bpe, op10_classifier
from tests.llm import brute


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_path())


ODD = ["", " ", "a", "  two  spaces ", "tab\t tab", "line\n\n line \n", "it's we'll I'M", "<|endoftext|>", "x <|endoftext|> y",
       "a<|endoftext|>b <|endof", "no break em　wide", "\x1c odd \x85 controls \x1f", "漢字 かな 한국어", "é" * 50,
       "1234567 89", "!!! ??? ...", " \n \t mixed \r\n end ", "🙂 emoji 🙂🙂", "word" * 2000, "a " * 3000, "​ zero"]


def shingles(text):
    w = brute.words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_whole_table(spark):
    rows = brute.corpus(80, seed=4)
    got = {r.doc_id: r for r in op1_fingerprint.fingerprinted(brute.table(spark, rows)).collect()}
    assert len(got) == len(rows)
    falling = sorted(rows, reverse=True)
    by_text = {}
    for at, (i, text) in enumerate(falling):
        text, following = text or "", falling[(at + 1) % len(falling)][1] or ""
        third = len(text) // 3
        changed = text[:len(text) - third] + following[:third]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert abs(r.near_edited - jaccard(shingles(text), shingles(changed))) < 0.15
        assert abs(r.near_next - jaccard(shingles(text), shingles(following))) < 0.15
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        if changed == text:
            assert r.near_edited == 1.0


def test_densified_one_text_at_a_time():
    """Every number of filled bins, alone in its chunk: each empty bin takes the first filled one of
    its own order."""
    rng = np.random.default_rng(0)
    order, _ = op1_fingerprint._probe_order()
    for filled in range(op1_fingerprint.BINS + 1):
        for _ in range(3):
            bins = np.full((1, op1_fingerprint.BINS), op1_fingerprint.EMPTY)
            at = rng.permutation(op1_fingerprint.BINS)[:filled]
            bins[0, at] = rng.integers(0, 1 << 40, filled).astype(np.uint64)
            got = op1_fingerprint.densified(bins)[0]
            if not filled:
                assert (got == 0).all()
                continue
            have = bins[0] != op1_fingerprint.EMPTY
            first = np.argmax(have[order], axis=1)
            want = np.where(have, bins[0], bins[0, order[np.arange(op1_fingerprint.BINS), first]])
            assert (got == want).all()


def test_fingerprints_of_odd_tables(spark):
    assert op1_fingerprint.fingerprinted(brute.table(spark, [])).count() == 0
    one = op1_fingerprint.fingerprinted(brute.table(spark, [(7, "abc def")])).first()
    assert (one.near_next, one.n_chars) == (1.0, 7)
    rows = [(None, "a b c"), (None, None), (5, "x y z"), (5, "x y z"), (5, "q r s"), (9, "t u v")]
    got = op1_fingerprint.fingerprinted(brute.table(spark, rows)).collect()
    assert len(got) == 6 and sum(r.near_next is None for r in got) == 2
    assert sorted(r.n_chars for r in got) == [0, 5, 5, 5, 5, 5]


def test_densified_bins_are_consistent():
    rng = np.random.default_rng(1)
    bins = np.full((40, op1_fingerprint.BINS), op1_fingerprint.EMPTY, dtype=np.uint64)
    for i in range(39):
        bins[i, rng.choice(op1_fingerprint.BINS, i * 13 + 1, replace=False)] = rng.integers(0, 2 ** 50, i * 13 + 1)
    out = op1_fingerprint.densified(bins)
    assert not (out[:39] == op1_fingerprint.EMPTY).any() and not out[39].any()
    order, _ = op1_fingerprint._probe_order()
    for i in range(39):
        for b in range(0, op1_fingerprint.BINS, 37):
            want = bins[i, b] if bins[i, b] != op1_fingerprint.EMPTY else next(
                bins[i, j] for j in order[b] if bins[i, j] != op1_fingerprint.EMPTY)
            assert out[i, b] == want


def test_encoder_equals_the_library(tokenizer):
    encoder = bpe.Encoder.get(bpe.default_path())
    texts = ODD + [t or "" for _, t in brute.corpus(30, seed=6)]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids
        assert encoder.decode(encoder.encode(text)) == tokenizer.decode(ids, skip_special_tokens=False)


def test_joins_are_repaired_wherever_the_cut_falls(tokenizer):
    encoder = bpe.Encoder.get(bpe.default_path())
    for text in ODD:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        for step in (1, 2, 3, 7):
            cuts = [text[i:i + step] for i in range(0, min(len(text), 400), step)] + [text[400 + (-400) % step:]]
            if "".join(cuts) != text:
                continue
            parts = [(c, encoder.encode(c)) for c in cuts if c] or [("", b"")]
            assert np.frombuffer(op9_bpe.joined(parts, encoder.encode, encoder.sizes()), "<u4").tolist() == want


def test_coded_texts(spark, tokenizer):
    base = brute.corpus(40, seed=8, ids=False)
    passage = " ".join(f"passage{i} of words" for i in range(300))
    rows = base + [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, f"{i} start {passage} end {i}") for i in range(4)]
    got = op9_bpe.coded(brute.table(spark, rows), values=True).collect()
    want = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha((text or "").encode())))
        assert tokenizer.decode(ids, skip_special_tokens=False) == (text or "")
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.n_tokens == len(r.ids) and brute.sha(r.decoded.encode()) == r.decoded_sha256 for r in got)
    assert op9_bpe.coded(brute.table(spark, [])).count() == 0


def test_packing(spark, tokenizer):
    rows = brute.corpus(60, seed=9, ids=False)
    got = op2_packing.packed(brute.table(spark, rows), sequence=256, group_pieces=40).collect()
    pieces = []
    for i, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % 256 or 256
        at = 0
        for n, size in enumerate([first] + [256] * ((len(ids) - first) // 256)):
            pieces.append((i, n, at, size, zlib.crc32(ids[at:at + size].tobytes())))
            at += size
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(pieces, key=repr)
    full = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == full.get(r.sequence_id, 0)
        full[r.sequence_id] = r.offset + r.length
    assert max(full.values()) <= 256
    assert op2_packing.packed(brute.table(spark, [])).count() == 0


def test_best_fit_takes_the_tightest_sequence():
    rng = np.random.default_rng(2)
    length = np.sort(rng.integers(1, 101, 500))[::-1]
    number, offset = op2_packing.best_fit(length, 100)
    room = []
    for need, n, at in zip(length.tolist(), number.tolist(), offset.tolist()):
        fits = [r for r in room if r >= need]
        if fits:
            assert room[n] == min(fits) and at == 100 - room[n]
            room[n] -= need
        else:
            assert n == len(room) and at == 0
            room.append(100 - need)


def test_rule_counts():
    texts = [t for _, t in brute.corpus(50, seed=11)] + ["a b\na b\n\nc", "# x | <y>\n \n# x | <y>", "w " * 40]
    c = op4_rules.rule_counts(pa.array(texts, pa.string()))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = op4_rules.base_failed(c["n_words"], c["n_repeat_words"])
    assert [(*(int(c[n][i]) for n in names), bool(failed[i])) for i in range(len(texts))] == [brute.rules(t) for t in texts]


def labelled(spark, n=400, seed=0):
    """Good prose, and documents full of symbols or of insults, half of them labelled."""
    rng = np.random.default_rng(seed)
    prose = [f"{c}{v}n" for c in "bcdfghklmnprst" for v in ("a", "e", "io", "ou")]
    rows, labels = [], []
    for i in range(n):
        w = [str(x) for x in rng.choice(prose, int(rng.integers(30, 120)))]
        bad, toxic = i % 5 == 0, i % 4 == 1
        if bad:
            w = [x + "$$$" if rng.random() < 0.7 else x for x in w]
        if toxic:
            for _ in range(6):
                w[int(rng.integers(0, len(w)))] = str(rng.choice(["idiot", "Mor0n", "vékuro", "vékuli", "vékuta"]))
        rows.append((i, " ".join(w)))
        if i % 2 or bad:
            labels.append((i, int(not bad), int(toxic)))
    return rows, spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def test_rules_reject_what_labels_reject(spark):
    rows, labels = labelled(spark)
    rows += [(None, None), (1000, ""), (1000, "")]
    docs = brute.table(spark, rows)
    got = op4_rules.judged(docs, labels).collect()
    assert len(got) == len(rows)
    rejected = {r.doc_id for r in got if not r.kept and r.doc_id is not None and r.doc_id < 1000}
    assert rejected == set(range(0, 400, 5))
    kept = op4_rules.keep(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 320
    none = op4_rules.judged(docs, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in none)
    assert op4_rules.judged(brute.table(spark, []), labels).count() == 0


def test_classifier(spark):
    rows, labels = labelled(spark, seed=1)
    rows += [(None, None), (1000, ""), (1000, "")]
    docs = brute.table(spark, rows)
    scores = op10_classifier.scored(docs, labels, ~op10_classifier.held_out()).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    held = [r for r in scores if r.doc_id is not None and r.doc_id < 1000 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 5 > 0) for r in held]) > 0.97
    assert len({r.score for r in scores if r.doc_id in (None, 1000)}) == 1
    again = op10_classifier.scored(docs.repartition(7), labels, ~op10_classifier.held_out()).collect()
    assert sorted(map(repr, scores)) == sorted(map(repr, again))
    assert op10_classifier.keep(docs, labels).columns == docs.columns
    assert {r.score for r in op10_classifier.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert op10_classifier.scored(brute.table(spark, []), labels).count() == 0


def test_toxicity(spark):
    rows, labels = labelled(spark, seed=2)
    rows += [(None, None), (1000, ""), (1001, "class clown and trash can " * 5), (1002, "what an 1d1ot, " * 5)]
    docs = brute.table(spark, rows)
    scores = {r.doc_id: r.score for r in op7_toxicity.scored(docs, labels, ~op7_toxicity.held_out()).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(scores[i] >= 0.5) == (i % 4 == 1) for i in held]) > 0.97
    assert scores[1000] == scores[None] < 0.5 and scores[1001] < 0.5 < scores[1002]
    fixed = {r.doc_id: r.score for r in op7_toxicity.scored(docs, labels.limit(0)).collect()}
    assert fixed[1002] >= 0.5 > fixed[1001]
    assert op7_toxicity.scored(brute.table(spark, []), labels).count() == 0


def test_exception_phrases_are_learned(spark):
    """A term that is harmless beside one word, in clean documents only."""
    rng = np.random.default_rng(12)
    rows, marks = [], []
    for i in range(600):
        toxic, words = i % 3 == 0, [f"w{x}" for x in rng.integers(0, 400, 20)]
        words[7] = "grubble" if toxic else "grubble hook" if i % 9 == 1 else words[7]
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs, labels = brute.table(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = op7_toxicity.learn(docs, labels)
    assert "grubble hook" in model.exceptions and "grub*" in model.lexicon
    assert not any(p.startswith("grubble w") or p.endswith(" grubble") for p in model.exceptions)
    again = op7_toxicity.learn(docs.repartition(7), labels.repartition(3))
    assert again.lexicon == model.lexicon and again.exceptions == model.exceptions
    assert np.allclose(again.curve, model.curve)
    extra = brute.table(spark, [(1, "a grubble hook " * 9), (2, "a grubble hook, you grubble"), (3, "a hook")])
    score = {r.doc_id: r.score for r in op7_toxicity.scored(docs.limit(0).union(extra), labels.limit(0)).collect()}
    assert score[1] == score[3]   # nothing learned: the fixed lexicon has no such term
    counts, x = model.counted(pa.RecordBatch.from_pydict({"text": [r.text for r in extra.orderBy("doc_id").collect()]}))
    assert [sum(c.values()) for c in counts] == [0, 1, 0]
    p = model.probability(x)
    assert p[1] > 0.5 > p[0] == p[2]


def test_phrases_around_terms():
    matcher = op7_toxicity.Matcher(("idiot", "trash", "moro*"))
    assert matcher.phrases("an idiot box; trash can idiot, (moronic) x morons 9") == {
        "an idiot", "idiot box", "x morons", "can idiot"}
    assert matcher.phrases("a" * 50 + " idiot") == set() == matcher.phrases("")


def test_folding():
    assert op7_toxicity.fold("ІDIOT m0r0n trash### $cum st00pid.") == "idiot moron trash### scum stoopid."
    assert op7_toxicity.fold("trash$$$ 1234 don't").startswith("trash$$$ 1234")


RECORDS = "record_id long, url string, ts long, revisit boolean, etag string, last_modified string, headers map<string,string>, digest string, canonical_url string, block int"


def test_revisits(spark):
    full = {"Content-Type": "text/html", "ETag": '"1"', "Cache-Control": "a", "cache-control": "b"}
    rows = [
        (1, "http://www.X.org/a/?b=2&a=1&utm_source=z", 10, False, '"1"', "mon", full, "d1"),
        (2, "https://x.org/a?a=1&b=2#frag", 20, True, 'W/"1"', None, {"Date": "now", "Content-Type": "no"}, None),
        (3, "https://x.org:443/a?a=1&b=2", 30, False, '"2"', "tue", None, "d2"),
        (4, "http://x.org/a?b=2&a=1", 40, True, '"1"', "mon", None, None),
        (5, "http://x.org/a?b=2&a=1", 50, True, None, "tue", {"X": "y"}, None),
        (6, "http://x.org/a?b=2&a=1", 60, True, None, None, None, None),
        (7, "http://x.org/a?b=2&a=1", 5, True, '"1"', None, None, None),
        (8, None, 70, True, '"1"', None, None, None),
        (9, "http://x.org/a?b=2&a=1", None, True, '"1"', None, None, None),
        (10, "http://x.org/a?b=2&a=1", 30, None, '"3"', None, None, "d3"),
        (11, "http://x.org/A", 80, True, None, None, None, None)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], RECORDS)
    for blocks in (1, 3, None):
        got = {r.record_id: r for r in op8_revisits.resolved(df, blocks).collect()}
        assert {i: (r.status, r.base_id) for i, r in got.items()} == {
            2: ("resolved", 1), 4: ("mismatch", None), 5: ("unverified", None), 6: ("unverified", None),
            7: ("orphan", None), 8: ("orphan", None), 9: ("orphan", None), 11: ("orphan", None)}
        assert got[2].base_digest == "d1"
        assert got[2].headers == {"cache-control": "b", "content-type": "text/html", "date": "now", "etag": '"1"'}
        assert got[5].headers == {"x": "y"} and got[4].headers == {}
    assert op8_revisits.resolved(df.limit(0)).count() == 0


def test_revisits_of_one_hot_url(spark):
    rng = np.random.default_rng(3)
    rows, last, want = [], None, {}
    for ts in range(600):
        revisit = rng.random() < 0.7
        if revisit:
            want[ts] = last
        else:
            last = ts
        rows.append((ts, "http://hot.org/", ts, bool(revisit), "e", None, None, None if revisit else str(ts)))
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], RECORDS)
    assert {r.record_id: r.base_id for r in op8_revisits.resolved(df).collect()} == want


def test_canonical_urls(spark):
    urls = {"HTTP://WWW.Example.COM:80/index.html": "example.com", "https://m.a.org/p/": "m.a.org/p",
            "http://a.org/p/index.htm?ref=1&utm_campaign=2": "a.org/p", "http://a.org?z=1&&b=": "a.org?b=&z=1",
            "http://a.org:8080/X#y?z": "a.org:8080/X"}
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.c for r in df.select("u", op8_revisits.canonical_url(F.col("u")).alias("c")).collect()} == urls


def test_long_texts_without_spaces_are_joined_in_linear_time(tokenizer):
    rng = np.random.default_rng(4)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 700_000)))   # 2 MB, no place to start anew
    encoder = bpe.Encoder.get(bpe.default_path())
    parts = [(text[i:i + 350], b"") for i in range(0, len(text), 350)]
    began = time.perf_counter()
    got = op9_bpe.joined(parts, encoder.encode, encoder.sizes())
    assert time.perf_counter() - began < 30
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_vocabularies_of_another_kind_are_left_to_the_library(tmp_path, tokenizer):
    with open(bpe.default_path(), encoding="utf-8") as f:
        spec = json.load(f)
    assert bpe.plain_byte_level(spec)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}},
                   {"model": {**spec["model"], "merges": spec["model"]["merges"][::-1]}}):
        assert not bpe.plain_byte_level({**spec, **change})
    path = tmp_path / "lower.json"
    path.write_text(json.dumps({**spec, "normalizer": {"type": "Lowercase"}}), encoding="utf-8")
    from tokenizers import Tokenizer
    encoder, library = bpe.Encoder.get(str(path)), Tokenizer.from_file(str(path))
    text = "The Quick  BROWN fox's É"
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want != tokenizer.encode(text, add_special_tokens=False).ids
    parts = [(text[i:i + 3], b"") for i in range(0, len(text), 3)]
    assert np.frombuffer(op9_bpe.joined(parts, encoder.encode, encoder.sizes(), encoder.known), "<u4").tolist() == want


def test_phrases_hide_their_hits_in_any_number():
    phrase = sorted(op7_toxicity.EXCEPTIONS)[0]
    word = phrase.split()[0]
    matcher = op7_toxicity.Matcher((word, "idiot"))
    rng = np.random.default_rng(3)
    for _ in range(50):
        text = " ".join(rng.choice([phrase, word, "idiot", "calm"], 12))
        spans = [m.span() for m in re.finditer(rf"(?=\b({phrase})\b)", text) for m in [re.compile(phrase).match(text, m.start())]]
        want = {}
        for i, term in enumerate((word, "idiot")):
            n = sum(not any(b <= m.start() and m.end() <= e for b, e in spans) for m in re.finditer(rf"\b{term}\b", text))
            if n:
                want[i] = n
        assert matcher.count(text) == want
    began = time.perf_counter()
    assert matcher.count(f"{phrase} idiot " * 100_000) == {1: 100_000}
    assert time.perf_counter() - began < 10


def test_texts_of_megabytes(spark):
    """One text of 3 MB beside short ones: fingerprints and rules read it whole."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(3000)]
    long = " ".join(words[i] for i in rng.integers(0, 3000, 500_000))
    rows = [(1, "short text"), (2, long), (3, None)]
    got = {r.doc_id: r for r in op1_fingerprint.fingerprinted(brute.table(spark, rows)).collect()}
    assert got[2].n_chars == len(long) and abs(got[2].near_edited - 2 / 3) < 0.1   # the last third is cut
    counts = op4_rules.rule_counts(pa.array([long, None, "a b"], pa.large_string()))
    want = [brute.rules(t) for t in (long, None, "a b")]
    assert [tuple(int(counts[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            for i in range(3)] == [w[:5] for w in want]
    pieces = op2_packing.packed(brute.table(spark, rows), sequence=2048).where("doc_id = 2").orderBy("piece").collect()
    assert [p.start for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1].tolist()]
    assert all(p.length == 2048 for p in pieces[1:])


def test_rules_learn_from_every_labelled_document(spark):
    """20,300 labelled documents: bad ones that come last in the order of hashed ids count as any other."""
    ids = spark.range(20_300).select(F.col("id").alias("doc_id"))
    last = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id").desc()).limit(200).collect()]
    bad = F.col("doc_id").isin(last)
    word = F.concat(F.lit("w"), F.conv(F.col("doc_id") * 31 + F.col("i"), 10, 36))
    docs = (ids.select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("i"))
            .select("doc_id", F.when(bad, F.concat(word, F.lit("$$$"))).otherwise(word).alias("w"))
            .groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list("w")).alias("text")))
    labels = ids.select("doc_id", F.when(bad, 0).otherwise(1).alias("quality"))
    rules, scored = op4_rules._taught(docs, labels)
    assert rules.forest.rows == 20_100
    rejected = scored.where(F.col("anomaly") >= rules.cut)
    assert {r.doc_id for r in rejected.collect()} == set(last)


def test_forest_counts_and_threshold(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 3))
    x[:, 2] = 1.0
    splits = op4_rules.Forest.splits(x.min(axis=0), x.max(axis=0), trees=4, depth=5)
    size = splits.feature.shape[1]
    counts = np.bincount(splits.nodes(x).ravel(), minlength=4 * size).reshape(4, size)
    grown = splits.grown(counts, 500)
    for tree in range(4):
        def walk(node, rows, level):
            f = splits.feature[tree, node]
            assert f in (0, 1) if level < 5 else f == -1
            if len(rows) <= 1 or level == 5:
                assert grown.feature[tree, node] == -1
                assert grown.length[tree, node] == pytest.approx(level + float(op4_rules.expected_path(len(rows))))
                return
            first = x[rows, f] <= splits.value[tree, node]
            walk(2 * node + 1, rows[first], level + 1)
            walk(2 * node + 2, rows[~first], level + 1)

        walk(0, np.arange(500), 0)
    for seed in range(4):
        rng = np.random.default_rng(seed)
        score, cost = rng.integers(0, 60, 200) / 64, rng.choice([10, -1], 200, p=[0.08, 0.92])
        df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(score, cost)], "score double, cost int")
        values = np.unique(score)[::-1]
        total = [int(cost[score >= v].sum()) for v in values]
        best = int(np.argmin(total))
        want = (values[best] + values[min(best + 1, len(values) - 1)]) / 2 if total[best] < 0 else float("inf")
        assert op4_rules.threshold(df) == want
    assert op4_rules.threshold(df.where("cost > 0")) == float("inf")
