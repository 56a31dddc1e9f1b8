import numpy as np
import pyarrow as pa
import pytest
import xxhash

from linfold.llm import op3_simhash, op5_substring, op6_suffix, rindex
from linfold.llm.components import components
from linfold.llm.xxh import xxh64
from tests.llm import brute


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("ids", [True, False])
def test_substring_and_suffix_match_brute_force(spark, ids):
    rows = brute.corpus(70, seed=1, ids=ids)
    docs = brute.table(spark, rows)
    got = rows_of(op5_substring.removed(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substring(rows), key=repr)
    got = rows_of(op6_suffix.removed(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.suffix(rows), key=repr)


def test_empty_table(spark):
    docs = brute.table(spark, [])
    assert op5_substring.removed(docs).count() == 0
    assert op6_suffix.removed(docs).count() == 0
    assert op6_suffix.keep(docs).count() == 0
    assert op3_simhash.simhash_classes(docs).count() == 0
    assert op3_simhash.keep_first(docs).count() == 0


def test_kept_words(spark):
    docs = brute.table(spark, [(1, "a b " * 30), (2, None)])
    got = {r.doc_id: r for r in op5_substring.removed(docs, texts=True).collect()}
    assert got[2].kept == "" and got[2].n_words == 0
    assert got[1].n_removed + len(got[1].kept.split()) == 60


def test_suffix_keep_cuts_whole_code_points(spark):
    passage = "é".join(f"{i}漢" for i in range(100, 160))
    docs = brute.table(spark, [(1, "start " + passage), (2, "ö" + passage + " end"), (3, passage), (4, ""), (5, None)])
    got = {r.doc_id: r for r in op6_suffix.keep(docs).collect()}
    assert got[1].text == "start " + passage
    assert 3 not in got and got[4].text == "" and got[5].text == ""
    assert got[2].text == "ö end"
    assert got[2].n_chars == len(got[2].text) and got[2].marks == "m" and got[2].row == "r"
    assert op6_suffix.keep(docs).columns == docs.columns


@pytest.mark.parametrize("hot", [1, 20, 4096])
def test_suffix_hot_anchors(spark, monkeypatch, hot):
    """A passage in every text, with a low bound on the rows of an anchor: the same result."""
    monkeypatch.setattr(op6_suffix, "HOT_ROWS", hot)
    rng = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 900, 30)) + " " + passage + " "
             + " ".join(f"w{x}" for x in rng.integers(0, 900, 30))) for i in range(40)]
    rows += [(40 + i, rows[i][1]) for i in range(9)]
    got = rows_of(op6_suffix.removed(brute.table(spark, rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(brute.suffix(rows), key=repr)


def suffix_in_process(rows, often, seed):
    """op6's steps in one process, each text a slice of its own or all in one, with batches of a few rows."""
    rng = np.random.default_rng(seed)
    batch = pa.RecordBatch.from_pydict({"_k": [i for i, _ in rows], "text": [t for _, t in rows]})
    found = pa.Table.from_batches(list(op6_suffix.candidates(100, 24)(batch.slice(i, 1) for i in range(len(rows)))))
    found = found.take(pa.array(rng.permutation(found.num_rows))).sort_by("key")
    found = pa.Table.from_batches(list(op5_substring.repeated("key", 1)(iter(found.to_batches(max_chunksize=5)))), found.schema)
    runs = found.to_pylist()
    listed = [[{c: r[c] for c in ("anchor", "pos", "n")} for r in runs if r["k"] == i] for i, _ in rows]
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("pos", pa.int32()), ("n", pa.int32())]))
    whole = pa.RecordBatch.from_arrays([*batch.columns, pa.array(listed, kind)], ["_k", "text", "found"])
    whole = next(op5_substring.pressed(iter([whole])))
    cut = pa.Table.from_batches(list(op6_suffix.cut_strings(100, often)(iter([whole]))))
    cut = cut.take(pa.array(rng.permutation(cut.num_rows))).sort_by("key")
    out = op6_suffix.resolved(100)(iter(cut.to_batches(max_chunksize=int(rng.integers(1, 9)))))
    return [(r["k"], r["pos"] + j) for b in out for r in b.to_pylist() for j in range(r["n"])]


@pytest.mark.parametrize("index_bytes", [500, 1 << 20])
@pytest.mark.parametrize("often", [2, 8, 1000])
def test_suffix_steps_in_any_order_and_batches(monkeypatch, often, index_bytes):
    """Also with one anchor beyond what is indexed at a time, and texts of one repeated phrase."""
    monkeypatch.setattr(op6_suffix, "INDEX_BYTES", index_bytes)
    rng = np.random.default_rng(often)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 900, 20)) + " " + passage * (i % 4 > 0)) for i in range(24)]
    rows += [(30, rows[1][1]), (31, rows[2][1]), (32, "a" * 2500), (33, "ab" * 300 + "a" * 300), (34, ""), (35, "é" * 700),
             (36, "x " + "nd " * 45), (37, "is, " * 27 + "end"), (38, "0123456789" * 11)]   # repeats within one segment
    rows = [(int(k), t) for k, (_, t) in zip(rng.permutation(1000)[:len(rows)] - 500, rows, strict=True)]
    marks = suffix_in_process(rows, often, often)
    seen, want = set(), set()
    for i, text in brute.order(rows):
        raw = text.encode()
        for at in range(len(raw) - 99):
            if raw[at:at + 100] in seen:
                want.add((i, at))
            seen.add(raw[at:at + 100])
    assert len(marks) == len(set(marks)) and set(marks) == want


def test_every_suffix_mark_comes_from_the_index(monkeypatch):
    """An index that finds nothing: nothing is marked, whatever the hashes say."""
    rows = [(i, " ".join(f"w{x}" for x in range(80))) for i in range(30)]
    count = []

    def index(data, k, pos, n, size):
        later = rindex.repeated_windows(data, k, pos, n, size)
        count.append(int(later.sum()))
        return later

    monkeypatch.setattr(op6_suffix, "repeated_windows", index)
    marks = suffix_in_process(rows, 8, 1)
    assert len(marks) == sum(count) > 0
    monkeypatch.setattr(op6_suffix, "repeated_windows", lambda data, k, pos, n, size: np.zeros(int(n.sum()), dtype=bool))
    assert not suffix_in_process(rows, 8, 1)


def in_process(rows, size, ranges, seed):
    """The three levels of op5 in one process, each text a slice, with batches of a few rows.
    Returns the rows after each of the first two levels and the marked windows."""
    rng = np.random.default_rng(seed)

    def dealt(table, key):
        table = table.take(pa.array(rng.permutation(table.num_rows))).sort_by(key)
        return iter(table.to_batches(max_chunksize=int(rng.integers(1, 6))))

    batch = pa.RecordBatch.from_pydict({"_k": [i for i, _ in rows], "text": [t for _, t in rows]})
    found = pa.Table.from_batches(list(op5_substring.candidates(size)(batch.slice(i, 1) for i in range(len(rows)))))
    after = []
    for key, bit in (("short", op5_substring.SHORT), ("half", op5_substring.HALF)):
        found = pa.Table.from_batches(list(op5_substring.repeated(key, bit)(dealt(found, key))), found.schema)
        after.append(found)
    if not found.num_rows:
        return after, []
    runs = found.select(["k", "pos", "n"]).to_pylist()
    listed = [[{"pos": r["pos"], "n": r["n"]} for r in runs if r["k"] == i] for i, _ in rows]
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("n", pa.int32())]))
    whole = pa.RecordBatch.from_arrays([*batch.columns, pa.array(listed, kind)], ["_k", "text", "found"])
    whole = whole.filter(pa.array([len(x) > 0 for x in listed]))
    whole = next(op5_substring.pressed(iter([whole])))
    packed = pa.Table.from_batches(list(op5_substring.packed_windows(size, ranges)(whole.slice(i, 1) for i in range(whole.num_rows))))
    marks = [(r["k"], r["pos"] + j) for b in op5_substring.settled(dealt(packed, "range"))
             for r in b.to_pylist() for j in range(r["n"])]
    return after, marks


@pytest.mark.parametrize("size", [4, 8, 20, 40])
def test_levels_in_any_order_and_batches(size):
    """A passage in every text, texts of few different words, copies and overlaps."""
    for seed in range(4):
        rng = np.random.default_rng(seed)
        passage = " ".join(f"p{i}" for i in range(60))
        rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 2 if i % 3 == 0 else 900, 30 + 40 * (i % 2))) + " "
                 + passage * (i % 5 > 0) + " " + " ".join(f"w{x}" for x in rng.integers(0, 900, 30))) for i in range(30)]
        rows += [(30 + i, rows[3 * i][1]) for i in range(8)]
        rows = [(int(k), t) for k, (_, t) in zip(rng.permutation(1000)[:len(rows)] - 500, rows, strict=True)]
        _, marks = in_process(rows, size, 3, seed)
        assert len(marks) == len(set(marks))
        want = {i: set() for i, _ in rows}
        seen = set()
        for i, text in brute.order(rows):
            w = text.split()
            for at in range(len(w) - size + 1):
                window = tuple(w[at:at + size])
                if window in seen:
                    want[i].add(at)
                seen.add(window)
        got = {i: set() for i, _ in rows}
        for i, at in marks:
            got[i].add(at)
        assert got == want


def test_only_repeated_windows_go_on():
    """Repeats of 7 and of 14 words stop at the first and at the second level."""
    rng = np.random.default_rng(9)
    def fresh(n):
        return [f"w{x}" for x in rng.integers(0, 10**9, n)]
    seven, fourteen = fresh(7), fresh(14)
    rows = [(i, " ".join(fresh(40) + (seven if i % 2 else fourteen) + fresh(40))) for i in range(40)]
    (short, half), marks = in_process(rows, 20, 2, 1)
    assert not marks and 0 < half.num_rows < short.num_rows
    odd = [k % 2 for k in half["k"].to_pylist()]
    assert not any(odd) and any(k % 2 for k in short["k"].to_pylist())
    # A row is one occurrence: nothing that occurs once goes on.
    (short, half), marks = in_process([(i, " ".join(fresh(200))) for i in range(40)], 20, 2, 1)
    assert short.num_rows == half.num_rows == 0 and not marks


def test_run_index_matches_direct_search():
    rng = np.random.default_rng(5)
    for case in range(6):
        base = rng.integers(0, 2 + case, 300).astype(np.uint8).tobytes()
        data = []
        for _ in range(30):
            at = int(rng.integers(0, 150))
            piece = bytearray(base[at:at + int(rng.integers(101, 150))])
            if rng.random() < 0.6:
                piece[int(rng.integers(0, len(piece)))] = 9
            data.append(bytes(piece))
        n = np.array([len(d) - 99 for d in data])
        k, pos = rng.permutation(30).astype(np.int64), np.zeros(30, np.int64)
        got = rindex.repeated_windows(data, k, pos, n, 100)
        first = {}
        for i in np.argsort(k):
            for j in range(n[i]):
                first.setdefault(data[i][j:j + 100], (i, j))
        want = [first[data[i][j:j + 100]] != (i, j) for i in range(30) for j in range(n[i])]
        assert got.tolist() == want


def test_xxh64_equals_the_library():
    rng = np.random.default_rng(0)
    buf = rng.integers(0, 256, 5000).astype(np.uint8)
    length = np.concatenate((np.arange(0, 300), [1000, 4000]))
    start = rng.integers(0, 900, len(length))
    got = xxh64(buf, start, length)
    assert [int(x) for x in got] == [xxhash.xxh64_intdigest(buf[s:s + n].tobytes(), seed=42) for s, n in zip(start, length)]


@pytest.mark.parametrize("ids", [True, False])
def test_simhash_classes_and_kept_rows(spark, ids):
    rows = brute.corpus(60, seed=2, ids=ids)
    docs = brute.table(spark, rows)
    prints = [brute.simhash(t) for _, t in rows]
    root = brute.classes(prints)
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    got = op3_simhash.simhash_classes(docs).collect()
    want = sorted(((i, p, least[r]) for (i, _), p, r in zip(rows, prints, root)), key=repr)
    assert sorted(((g.doc_id, g.fp % 2 ** 64, g.component_id) for g in got), key=repr) == want
    kept = op3_simhash.keep_first(docs)
    assert kept.columns == docs.columns
    chosen = sorted(min((t or "" for (i, t), r in zip(rows, root) if r == one and i == least[one])) for one in set(root))
    assert sorted(r.text or "" for r in kept.collect()) == chosen


def test_links_are_complete(spark):
    rng = np.random.default_rng(7)
    prints = {int(x) for x in rng.integers(-2 ** 63, 2 ** 63 - 1, 40)}
    for x in list(prints):
        for _ in range(6):
            y = x % 2 ** 64
            for bit in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                y ^= 1 << int(bit)
            prints.add(y - 2 ** 64 if y >= 2 ** 63 else y)
    nodes = spark.createDataFrame([(x,) for x in prints], "fp long")
    got = {(r.a, r.b) for r in op3_simhash.link_pairs(nodes).collect()}
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) % 2 ** 64).bit_count() <= 3}
    assert got == want


def test_majority_of_long_rows():
    values = np.full(70_000, 5, dtype=np.uint64)
    values[:36_000] = 2 ** 63 + 1
    assert int(op3_simhash.bit_majority(values, np.array([0, 70_000]))[0]) == 2 ** 63 + 1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {300: 300, 301: 300}


def test_links_under_hot_keys_are_complete(spark, monkeypatch):
    """Fingerprints that share 32 bits and drift in the others: the same links by either way."""
    rng = np.random.default_rng(12)
    base = int(rng.integers(0, 1 << 62))
    values = {base}
    for shared in (0x00000000FFFFFFFF, 0x0000FFFFFFFF0000, 0xFFFF00000000FFFF):   # neighbours on the ring, too
        free = [b for b in range(64) if not shared >> b & 1]
        walk = base
        for _ in range(150):
            for b in rng.choice(free, int(rng.integers(1, 5)), replace=False):
                walk ^= 1 << int(b)
            values.add(walk)
    signed = np.array(sorted(values), dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {(min(a, b), max(a, b)) for x, a in enumerate(signed) for b in signed[:x]
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert len(want) > 50
    for hot in (op3_simhash.HOT_KEY, 2):
        monkeypatch.setattr(op3_simhash, "HOT_KEY", hot)
        assert {(r.a, r.b) for r in op3_simhash.link_pairs(nodes).collect()} == want


def test_run_index_rows_and_matches():
    """Rows and matches of the streamed index against sorted suffixes; each row's run from the directory."""
    from linfold.llm.rindex import RunIndex
    rng = np.random.default_rng(3)
    for trial in range(30):
        part = bytes(rng.integers(97, 100, 40).astype(np.uint8))
        data = list({part[int(rng.integers(0, 20)):] + bytes(rng.choice([0, 97, 255], int(rng.integers(0, 12))).astype(np.uint8))
                     for _ in range(int(rng.integers(1, 9)))} | {b"", b"a", bytes([0] * trial)})
        index = RunIndex.build(data)
        row_of, match_of = index.stream()
        assert index.run_of.tolist() == (np.searchsorted(index.run_start, np.arange(index.rows), "right") - 1).tolist()
        places = [(s, i) for s, d in enumerate(data) for i in range(len(d) + 1)]
        keys = [[b + len(data) for b in data[s][i:]] + [s] for s, i in places]   # marks before bytes, in string order
        order = sorted(range(len(places)), key=lambda x: keys[x])
        assert [row_of[x] for x in order] == list(range(len(places)))
        for above, here in zip(order, order[1:]):
            a, b = keys[above], keys[here]
            same = next(i for i in range(len(b)) if a[i] != b[i])
            if places[here][1] < len(data[places[here][0]]):
                assert match_of[here] == same
