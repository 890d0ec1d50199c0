"""Each operator against brute force on a small table that holds nulls, empty and very long
texts, ties, repeated rows and clashing extra columns; and on an empty table."""

import hashlib
import re
import tracemalloc
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF001
from drover.llm import (best_fit, components, decontaminate, difference_cover, language, packed_output, previous_factor,
                        quality, queries, simhash, token_counts, tokens, url_model, words)
from drover.llm.common import NULL_ID
from drover.session import scratch_path

WORD = "[^\x20\x09-\x0d]+"
rng = np.random.default_rng(3)
VOCAB = ["".join(rng.choice(list("abcdefghiknorstu"), rng.integers(2, 9))) for _ in range(400)]


def prose(n, seed):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(VOCAB, n))


PASSAGE = prose(60, 99)
LONG = prose(30_000, 98)
TEXTS = [
    prose(80, 1), prose(80, 1), prose(40, 2) + "\n" + PASSAGE, PASSAGE + "\t" + prose(30, 3), None, "", " \n\t ", "one two",
    PASSAGE, LONG, prose(50, 4) + " " + LONG[5000:9000] + " é ü " + prose(20, 5), "Ünïcode 日本 text " * 40,
    "same line\n" * 50, "x" * 300, PASSAGE.upper(), prose(79, 1) + " changed", "### $$$ *** " * 30 + prose(20, 6)]
ROWS = [(i, t, "en" if i % 2 else "de", f"s{i % 3}", None if t is None else len(t), "clash", i) for i, t in enumerate(TEXTS)]
ROWS += [(3, TEXTS[3], "en", "s0", 1, "clash", 3), (None, PASSAGE, None, None, None, None, None), (5, prose(30, 7), "de", "s1", 0, None, 5)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key_id string, fp long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    return queries.tokenizer_path()


def key(i):
    return NULL_ID if i is None else i


# ------------------------------------------------------------------ 9, 7
def brute_words(rows):
    first = {}
    for i, t in sorted(((key(r[0]), r[1] or "") for r in rows)):
        w = re.findall(WORD, t)
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p:p + 13]), i)
    out = []
    for r in rows:
        w = re.findall(WORD, r[1] or "")
        drop = [False] * len(w)
        for p in range(len(w) - 12):
            if first[tuple(w[p:p + 13])] < key(r[0]):
                drop[p:p + 13] = [True] * 13
        kept = " ".join(x for x, d in zip(w, drop) if not d)
        out.append((key(r[0]), len(w), sum(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_difference_cover(docs, empty):
    got = difference_cover.remove_repeats(docs).collect()
    assert sorted((r.key_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(ROWS)
    assert difference_cover.remove_repeats(empty).count() == 0
    out = difference_cover.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    by = {r.doc_id: r.text for r in out.where("doc_id in (0, 8)").collect()}
    assert by[0] == TEXTS[0] and by[8] == ""       # the null id counts as the smallest and holds the passage


def test_cover_meets_every_pair_of_positions():
    for i in range(7):
        for j in range(7):
            assert any((i + d) % 7 in (0, 1, 3) and (j + d) % 7 in (0, 1, 3) for d in range(7))


def brute_bytes(rows):
    uniq = sorted({(key(r[0]), int(digest(r[1])), (r[1] or "").encode()) for r in rows})
    seen, res = set(), {}
    for i, g, t in uniq:
        drop = bytearray(len(t))
        for p in range(len(t) - 99):
            s = t[p:p + 100]
            if s in seen:
                drop[p:p + 100] = b"\1" * 100
            seen.add(s)
        res[i, t] = (i, len(t), sum(drop), len(re.findall(b"\1+", bytes(drop))),
                     hashlib.sha256(bytes(c for c, d in zip(t, drop) if not d)).hexdigest())
    return sorted(res[key(r[0]), (r[1] or "").encode()] for r in rows)


def digest(text):
    return 0 if text is None else xxhash.xxh64_intdigest(text.encode(), 42) & 0x7FFFFFFF


def test_previous_factor(docs, empty):
    got = previous_factor.remove_repeats(docs).collect()
    assert sorted((r.key_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(ROWS)
    assert previous_factor.remove_repeats(empty).count() == 0


def test_hot_anchor_is_taken_apart(spark, monkeypatch):
    line = "the one line that very many documents share, word for word"
    rows = [(k, f"{prose(30, 500 + k % 70)} {k % 7}\n{line}\n{prose(12, 600 + k % 11)} {prose(20, 700 + k)}") for k in range(240)]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (7, rows[8][1]), (300, line * 9)]
    monkeypatch.setattr(previous_factor, "HOT", 20)
    monkeypatch.setattr(previous_factor, "SUFFIX_BYTES", 1 << 13)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = previous_factor.remove_repeats(docs).collect()
    assert sorted((r.key_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(rows)


def test_no_suffix_array_exceeds_its_bound(spark, monkeypatch):
    line = "the one line that very many documents share, word for word"
    n, r = 4 * previous_factor.HOT, np.random.default_rng(5)
    texts = ["".join(map(chr, r.integers(97, 123, 60))) + line + "".join(map(chr, r.integers(97, 123, 60))) for _ in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = previous_factor.doc_key(docs)
    near = previous_factor.X.exchanged(keyed.mapInArrow(previous_factor._anchors(4), previous_factor.X.SCHEMA),
                                       previous_factor.X.meet_shared(4, True, previous_factor.HOT), previous_factor._near, "hot-test")
    hot = near.where("key_digest = -1").collect()
    assert len(hot) >= 1
    shared = spark.sparkContext.broadcast(np.sort(np.array([x.key_id for x in hot], np.int64)))
    found = previous_factor.X.with_spans(keyed, near.where("key_digest >= 0")).mapInArrow(
        previous_factor._contexts(4, shared), previous_factor.X.SCHEMA).where("not known").toArrow()
    e = previous_factor.X.Entries(found, False)
    assert len(e) and max(np.unique(e.hashes[e.extra >= 0], return_counts=True)[1], default=0) <= previous_factor.HOT
    assert max(np.unique(e.hashes[e.extra < 0], return_counts=True)[1]) <= n // 100
    sizes = np.array([100] * 50)
    whole = list(previous_factor._portions(np.arange(50), np.repeat(np.arange(25), 2).astype(np.uint64), sizes))
    assert sum(map(len, whole)) == 50


def test_previous_factors_equal_brute_force():
    r = np.random.default_rng(8)
    text = r.integers(97, 99, 600).astype(np.uint8)
    text[300:450] = text[100:250]
    win = np.arange(0, 500)
    got = previous_factor.previous_factors(text, win)
    raw = text.tobytes()
    for i in range(0, 500, 7):
        best = 0
        for j in range(i):
            k = 0
            while k < 124 and raw[i + k:i + k + 1] == raw[j + k:j + k + 1]:
                k += 1
            best = max(best, k)
        assert got[i] == best // 4 * 4


def thue_morse(n):
    """Two words of n letters that every polynomial hash modulo 2**64 gives the same value."""
    a = "".join("ab"[k.bit_count() % 2] for k in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_words_that_collide_modulo_a_power_of_two(spark):
    a, b = thue_morse(2048)
    data = np.frombuffer(f"{a} {b}".encode(), np.uint8)
    w = words.words_of(data, np.array([0, len(data)]), words.PLAIN)
    assert w.hash[0] != w.hash[1]
    rest = prose(12, 40)
    rows = [(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a} {rest}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.key_id: r.n_removed for r in difference_cover.remove_repeats(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 13}
    items = spark.createDataFrame([("i", f"{a} one two")], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"x {a} one two y"), (2, f"x {b} one two y")], "doc_id long, text string")
    assert {r.key_id: r.n_hit for r in decontaminate.contamination(docs, items).collect()} == {1: 3, 2: 0}


def test_words_in_pieces(monkeypatch):
    r = np.random.default_rng(2)
    texts = ["", "one", "a b  c", " x" * 40, "y" * 300, prose(200, 3), "\n", prose(50, 4) + " " + "z" * 90 + " end"]
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw])
    whole = words.words_of(data, off, words.PLAIN)
    for piece in (7, 64, int(r.integers(100, 400))):
        monkeypatch.setattr(words, "PIECE", piece)
        part = words.words_of(data, off, words.PLAIN)
        assert all((getattr(whole, n) == getattr(part, n)).all() for n in ("start", "end", "hash", "check", "first"))
    assert [len(t.split()) for t in texts] == whole.counts.tolist()
    a, b = r.integers(0, 2 ** 61 - 1, 100, dtype=np.uint64), r.integers(0, 2 ** 61 - 1, 100, dtype=np.uint64)
    assert words.times(a, b).tolist() == [int(x) * int(y) % (2 ** 61 - 1) for x, y in zip(a, b)]
    monkeypatch.setattr(words, "LONG_WORD", 50)
    again = words.words_of(data, off, words.PLAIN)
    same = whole.end - whole.start <= 50
    assert (again.hash[same] == whole.hash[same]).all() and not (again.hash[~same] == whole.hash[~same]).any()


def test_words_hash_alike_wherever_they_lie():
    a = words.words_of(np.frombuffer(b"ab cd  ab", np.uint8), np.array([0, 9]), words.PLAIN)
    b = words.words_of(np.frombuffer(b"xxab", np.uint8), np.array([0, 2, 4]), words.PLAIN)
    assert a.hash[0] == a.hash[2] == b.hash[1] != a.hash[1]
    assert list(a.counts) == [3] and list(b.counts) == [1, 1]


# ------------------------------------------------------------------ 6
def brute_fp(t):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash(docs, empty, spark):
    got = simhash.near_duplicates(docs).select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("f"), "component_id").collect()
    fps = [(r[0], brute_fp(r[1])) for r in ROWS]
    group = list(range(len(fps)))
    for _ in fps:
        for a in range(len(fps)):
            for b in range(len(fps)):
                if (fps[a][1] ^ fps[b][1]).bit_count() <= 4:
                    group[a] = group[b] = min(group[a], group[b])
    least = defaultdict(list)
    for (i, _), g in zip(fps, group):
        if i is not None:
            least[g].append(i)
    want = sorted((str(i), f"{f:016x}", min(least[g])) for (i, f), g in zip(fps, group))
    assert sorted((str(r.doc_id), r.f, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("shape", ["random", "dense"])
def test_grid_loses_no_link(spark, shape):
    r = np.random.default_rng(4)
    if shape == "dense":      # one large group of near copies, far over the small-cell size
        base = r.integers(0, 2 ** 63, dtype=np.uint64)
        fp = np.unique([base ^ np.bitwise_or.reduce(np.uint64(1) << r.choice(64, r.integers(0, 4), replace=False).astype(np.uint64))
                        for _ in range(600)])
    else:
        fp = r.integers(0, 2 ** 63, 300, dtype=np.uint64)
        flips = [f ^ np.bitwise_or.reduce(np.uint64(1) << r.choice(64, 1 + k % 6, replace=False).astype(np.uint64)) for k, f in enumerate(fp)]
        fp = np.unique(np.concatenate([fp, flips]))
    links = simhash.links(spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long"))
    assert links.count() <= 8 * len(fp)
    roots = {x.node: x.root for x in components.components(links).collect()}
    par = {int(x): int(x) for x in fp.view(np.int64)}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    s = fp.view(np.int64)
    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 4):
            a, b = find(int(s[i])), find(int(s[j]))
            par[max(a, b)] = min(a, b)
    for x in par:
        assert roots.get(x, x) == find(x)


# ------------------------------------------------------------------ 10
def brute_hits(rows, items, window=10):
    low = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = [(i, w[p:p + window]) for i, t in items for w in [low(t)] if w for p in range(max(1, len(w) - window + 1))]
    out = []
    for r in rows:
        w = low(r[1])
        hit, names = set(), set()
        for i, x in wins:
            for p in range(len(w) - len(x) + 1):
                if w[p:p + len(x)] == x:
                    hit.update(range(p, p + len(x)))
                    names.add(i)
        out.append((key(r[0]), len(w), len(hit), sorted(str(n) for n in names if n is not None)))
    return sorted(out)


ITEMS = [(1, PASSAGE[:200]), (12, prose(80, 1)), (2, "one two"), (3, None), (4, ""), (None, prose(30, 3)), (12, prose(80, 1)), (7, "Same line, SAME")]


@pytest.mark.parametrize("block", [None, 400])
def test_decontamination(spark, docs, empty, monkeypatch, block):
    if block:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block * 20)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [r for r in ROWS if r[1] is not LONG]
    d = docs.where("doc_id is null or doc_id <> 9")
    got = decontaminate.contamination(d, items).collect()
    assert sorted((r.key_id, r.n_words, r.n_hit, r["items"]) for r in got) == brute_hits(rows, ITEMS)
    if not block:
        assert decontaminate.contamination(empty, items).count() == 0
        assert decontaminate.contamination(d, items.limit(0)).where("n_hit > 0").count() == 0


# ------------------------------------------------------------------ 2, 5, 1
def ids_of(tokenizer, text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_best_fit(docs, empty, tokenizer):
    got = best_fit.packed_sequences(docs, tokenizer, capacity=512).collect()
    want = []
    for r in ROWS:
        ids = np.array(ids_of(tokenizer, r[1]), "<u4")
        want += [(str(r[0]), k, s, min(512, len(ids) - s), zlib.crc32(ids[s:s + 512].tobytes())) for k, s in enumerate(range(0, len(ids), 512))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 512
    assert len(seqs) <= -(-sum(r.length for r in got) // 512) + 2
    assert best_fit.packed_sequences(empty, tokenizer).count() == 0


@pytest.mark.parametrize("lengths", [[700] * 90, list(range(1, 300)), [2047, 1, 1, 1024, 1024, 1025]])
def test_packing_rounds(spark, lengths):
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    got = best_fit.pack(items).collect()
    assert sorted(r["item"] for r in got) == list(range(len(lengths)))
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, lengths[r["item"]]))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == list(np.cumsum([0, *(n for _, n in s)])[:-1]) and sum(n for _, n in s) <= 2048
    best = max(len(seqs) if lengths[0] == 700 else 0, -(-sum(lengths) // 2048))
    assert len(seqs) <= max(45 if lengths[0] == 700 else 0, best + 2)


def test_packed_rows_round_trip(spark, docs, empty, tokenizer):
    path = scratch_path(spark, "packed-test")
    packed_output.write_packed(packed_output.packed_rows(docs, tokenizer, capacity=256, buffer=20_000), path)
    texts = defaultdict(list)
    for row in packed_output.read_packed(spark, path).collect():
        ids = np.frombuffer(row.ids, "<u2")
        assert len(ids) == 256 and row.cu_seqlens[-1] == row.n_tokens and not ids[row.n_tokens:].any()
        for k, (a, b) in enumerate(zip(row.cu_seqlens, row.cu_seqlens[1:])):
            texts[str(row.doc_ids[k])].append((row.position_starts[k], ids[a:b].tolist()))
    for i in {str(r[0]) for r in ROWS} - {"3", "5"}:
        whole = [x for _, part in sorted(texts[i]) for x in part]
        assert whole == next(ids_of(tokenizer, r[1]) for r in ROWS if str(r[0]) == i)
    assert packed_output.packed_rows(empty, tokenizer).count() == 0
    with pytest.raises(ValueError):
        packed_output.packed_rows(docs, tokenizer, dtype="<u1")


def test_segment_tree_packs_best_fit_decreasing():
    assert packed_output.best_fit_decreasing([], 10) == []
    r = np.random.default_rng(1).integers(1, 100, 300).tolist()
    rows = packed_output.best_fit_decreasing(r, 100)
    fill = defaultdict(int)
    for n, k in zip(r, rows):
        fill[k] += n
    assert max(fill.values()) <= 100
    room, want = [], 0
    for n in sorted(r, reverse=True):
        fit = [k for k, x in enumerate(room) if x >= n]
        if fit:
            room[min(fit, key=lambda k: room[k])] -= n
        else:
            room.append(100 - n)
            want += 1
    assert len(fill) == want


def test_token_totals(spark, docs, tokenizer):
    counts = {str(r.doc_id): r.n_tokens for r in token_counts.counted(docs, tokenizer, "v").where("doc_id is null or doc_id not in (3, 5)").collect()}
    assert all(counts[str(r[0])] == len(ids_of(tokenizer, r[1])) - 1 for r in ROWS if r[0] not in (3, 5))
    t = token_counts.TokenTotals(spark, scratch_path(spark, "totals-test"))
    mk = lambda rows: spark.createDataFrame(rows, "op string, doc_id long, tokenizer string, source string, lang string, n_tokens long")
    read = lambda: sorted(tuple(r) for r in t.totals().fillna("-").collect())
    assert read() == []
    assert t.apply(1, mk([("insert", 1, "a", "s", "en", 10), ("insert", 2, "a", "s", "en", 5), ("insert", 1, "b", "s", "en", 7), ("insert", None, "a", None, None, 3)]))
    first = [("-", "-", "a", 1, 3), ("s", "en", "a", 2, 15), ("s", "en", "b", 1, 7)]
    assert read() == first
    second = mk([("revise", 1, "a", "s", "en", 12), ("delete", 2, "a", None, None, None), ("delete", 9, "a", None, None, None),
                 ("insert", 1, "b", "t", "fr", 7), ("revise", None, "a", None, None, None)])
    assert t.apply(2, second) and not t.apply(2, second)
    want = [("-", "-", "a", 1, 0), ("s", "en", "a", 1, 12), ("t", "fr", "b", 1, 7)]
    assert read() == want
    # a batch that stopped before its commit is not seen, and is written anew
    spark.createDataFrame([("s", "en", "a", 100, 100)], token_counts.DELTAS).write.parquet(f"{t.path}/deltas/batch=3")
    assert read() == want
    assert t.apply(3, mk([("delete", 1, "a", None, None, None), ("insert", 1, "a", "s", "en", 4)]))
    assert read() == [("-", "-", "a", 1, 0), ("t", "fr", "b", 1, 7)]
    assert t.apply(4, mk([])) and read() == [("-", "-", "a", 1, 0), ("t", "fr", "b", 1, 7)]
    with pytest.raises(ValueError):
        TokenTotals = token_counts.TokenTotals(spark, t.path)
        TokenTotals.apply(0, mk([]))


def test_token_totals_count_every_row_without_an_id(spark):
    t = token_counts.TokenTotals(spark, scratch_path(spark, "totals-null-test"))
    mk = lambda rows: spark.createDataFrame(rows, "op string, doc_id long, tokenizer string, source string, lang string, n_tokens long")
    read = lambda: sorted(tuple(r) for r in t.totals().fillna("-").collect())
    t.apply(1, mk([("insert", None, "a", s, "en", n) for s, n in (("s", 5), ("s", 5), ("s", 9), ("t", 7), (None, 2))] + [("insert", 1, "a", "s", "en", 100)]))
    assert read() == [("-", "en", "a", 1, 2), ("s", "en", "a", 4, 119), ("t", "en", "a", 1, 7)]
    assert t.apply(2, mk([("revise", None, "a", s, "en", n) for s, n in (("s", 6), ("s", 0), ("s", 0), ("t", 8), (None, 3))] + [("revise", 1, "a", "s", "en", 90)]))
    assert read() == [("-", "en", "a", 1, 3), ("s", "en", "a", 4, 96), ("t", "en", "a", 1, 8)]
    assert t.apply(3, mk([("delete", None, "a", "s", "en", 0)] * 2 + [("delete", None, "a", "t", "en", 4), ("delete", None, "a", None, "en", None)]))
    assert read() == [("s", "en", "a", 2, 96), ("t", "en", "a", 1, 8)]
    assert t.apply(4, mk([("insert", None, "a", "s", "en", 6), ("revise", None, "a", "u", None, 1), ("delete", 1, "a", None, None, None)]))
    assert read() == [("s", "en", "a", 2, 12), ("t", "en", "a", 1, 8), ("u", "-", "a", 1, 1)]
    assert sorted((r.source, r.n_tokens, r.docs) for r in t.counts().collect()) == [("s", 6, 2), ("t", 8, 1), ("u", 1, 1)]


# ------------------------------------------------------------------ 3
def test_quality(docs, empty):
    got = quality.quality(docs).collect()
    for r in got:
        w = re.findall(WORD, r.text or "")
        lines = [x for x in (r.text or "").split("\n") if re.search(WORD, x)]
        where = defaultdict(list)
        for p in range(len(w) - 7):
            where[tuple(w[p:p + 8])].append(p)
        cover = {q for ps in where.values() if len(ps) > 1 for p in ps for q in range(p, p + 8)}
        assert (r.q_n_words, r.q_word_chars, r.q_n_symbols, r.q_n_dup_lines, r.q_n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r.text or "")), len(lines) - len(set(lines)), len(cover))
        assert r.q_base_failed == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
        assert not (r.q_base_failed and r.q_kept)
    kept = {r.doc_id for r in got if r.q_kept}
    assert {0, 2, 3, 8, 9, 10} <= kept and not kept & {4, 6, 7, 11, 12, 13, 16}
    assert quality.quality(empty).count() == 0
    with pytest.raises(ValueError):
        quality.quality(docs, prefix="key")


def test_cascade_orders_by_rejection_per_cost_and_keeps_the_verdict(spark):
    d = spark.range(2000).select(F.col("id").alias("x"))
    slow = F.size(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: F.xxhash64(i + F.col("x"))))) < 0
    rules = [quality.Rule("never", slow), quality.Rule("odd", F.col("x") % 2 == 1), quality.Rule("null", F.lit(None).cast("boolean"))]
    assert quality.ordered(rules, d)[0].name == "odd"
    out = quality.cascade(d, rules)
    assert out.where("rejected_by is null").count() == 1000 and out.where("rejected_by <> 'odd'").count() == 0


# ------------------------------------------------------------------ 4
def test_url_parts_and_rules(spark):
    rows = [("http://A.Example.NET/en/x?q=/", "a.example.net", "/en/x", "example.net/en/"), ("https://b.net", "b.net", "", None),
            ("https://b.net/", "b.net", "/", "net/"), ("http://example.com/de/1#f", "example.com", "/de/1", "example.com/de/"),
            ("http://myexample.com/de/1", "myexample.com", "/de/1", None), ("x://z.org/fr/?", "z.org", "/fr/", "org/fr/"),
            ("no scheme", "", "", None), ("", "", "", None), (None, "", "", None), ("http://q?u=http://b.net/", "q", "", None),
            ("ftp://É.net/", "É.net", "/", "net/")]
    pages = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "page_id long, url string")
    got = sorted(url_model.judge(pages).collect())
    assert [(r.host, r.path, r.rule) for r in got] == [r[1:] for r in rows]
    assert [r.verdict for r in got if r.rule] == ["allow", "block", "block", "allow", "block"]
    assert all(r.verdict in ("allow", "block") and 0 <= r.p_rejected <= 1 for r in got)
    assert url_model.judge(pages.limit(0)).count() == 0


def test_url_models_separate_held_out_urls(spark):
    r = np.random.default_rng(2)
    host = lambda bad: "".join(r.choice(list("xqzj-0123" if bad else "aeiourstln"), 8))
    rows = [(f"http://{host(k % 2)}.com/{host(k % 2)}", bool(k % 2)) for k in range(600)]
    model = url_model.train(spark.createDataFrame(rows[:400], "url string, rejected boolean"))
    raw = [u.encode() for u, _ in rows[400:]]
    off = np.cumsum([0, *map(len, raw)])
    p = model.rejection(model.differences(np.frombuffer(b"".join(raw), np.uint8), off))
    assert np.mean((p >= 0.5) == np.array([y for _, y in rows[400:]])) > 0.95


def brute_difference(url, labelled):
    symbols = lambda u: [None] * url_model.ORDER + list(u.encode()) + [0]
    log = []
    for c in (0, 1):
        n, follow = labelled[c]
        p_all, s = [], symbols(url)
        for i in range(url_model.ORDER, len(s)):
            p = 1 / 257
            for k in range(url_model.ORDER + 1):
                ctx = tuple(s[i - k:i])
                m, t = n[k, ctx], len(follow[k, ctx])
                if m:
                    p = (follow[k, ctx].get(s[i], 0) + t * p) / (m + t)
            p_all.append(np.log(p))
        log.append(np.mean(p_all))
    return log[1] - log[0]


def brute_counts(urls):
    n, follow = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for u in urls:
        s = [None] * url_model.ORDER + list(u.encode()) + [0]
        for i in range(url_model.ORDER, len(s)):
            for k in range(url_model.ORDER + 1):
                n[k, tuple(s[i - k:i])] += 1
                follow[k, tuple(s[i - k:i])][s[i]] += 1
    return n, follow


def test_url_counts_are_exact_whatever_their_number(spark, monkeypatch):
    r = np.random.default_rng(6)
    word = lambda k: "".join(r.choice(list("abcdefghijklmnopqrstuvwxyz0123456789" if k % 2 else "0123456789.-_~"), 24))
    rows = [(f"http://{word(k)}.{'net' if k % 2 else 'org'}/fr/{word(k)}", bool(k % 2)) for k in range(2600)]
    train = spark.createDataFrame(rows, "url string, rejected boolean")
    fold = {x.url: x.f for x in train.select("url", F.pmod(F.xxhash64("url"), F.lit(url_model.FOLD)).alias("f")).collect()}
    labelled = [brute_counts([u for u, y in rows if y == bool(c) and fold[u]]) for c in (0, 1)]
    assert sum(len(f) for n, follow in labelled for (k, _), f in follow.items() if k == 4) > 1 << 16
    test = [u for u, _ in rows[:60]] + [f"http://{word(k)}/x" for k in range(20)] + ["", "é"]
    want = [brute_difference(u, labelled) for u in test]
    raw = [u.encode() for u in test]
    model = url_model.train(train)
    assert np.allclose(model.differences(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])), want)
    # more counts than may be broadcast: the same by joins, with repeated rows and null urls
    monkeypatch.setattr(url_model, "MODEL_BYTES", 0)
    monkeypatch.setattr(url_model, "BLOCK", 30)
    joined = url_model.train(train)
    assert joined.shared is None and np.allclose([joined.weight, joined.bias], [model.weight, model.bias])
    asked = spark.createDataFrame([(None if u == "" else u, k) for k, u in enumerate(test)] + [("é", 81)] * 3, "url string, i long")
    got = sorted((x.i, x.difference) for x in joined.scored(asked).collect())
    assert [i for i, _ in got] == [*range(81), *[81] * 4]
    assert np.allclose([x for _, x in got], [*want, *want[-1:] * 3])
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows[:40])] + [(90, "http://plain.com/"), (None, None)], "page_id long, url string")
    by_join = url_model.judge(pages).collect()
    monkeypatch.undo()
    row = lambda x: (str(x.page_id), x.host, x.path, x.rule, x.verdict, round(x.p_rejected, 9))
    assert sorted(map(row, by_join)) == sorted(map(row, url_model.judge(pages).collect()))


# ------------------------------------------------------------------ 8
def test_language(spark, empty):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = spark.createDataFrame([(None, None, "en", None, None), (10 ** 6, "", None, None, 0), (10 ** 6, "123 !?", "de", None, 1)], d.schema)
    both = d.union(extra)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = language.identify(both, held).collect()
    assert len(got) == d.count() + 3 and all(0 <= r.score <= 1 for r in got)
    lang = {r.doc_id: r.lang for r in d.collect()}
    test = [r for r in got if r.held_out and r.doc_id in lang and r.lang_pred != "und"]
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in test]) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert [r.lang_pred for r in got if r.doc_id in (None, 10 ** 6)] == ["und"] * 3
    # labels of held-out rows are not learned from
    same = language.identify(both.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))), held)
    assert sorted((str(r.doc_id), r.lang_pred) for r in same.collect()) == sorted((str(r.doc_id), r.lang_pred) for r in got)
    assert language.identify(empty, F.lit(False)).count() == 0
    unlabelled = d.limit(5).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled, F.lit(False)).collect()} == {"und"}


def test_ftrl_is_sparse_and_temperature_calibrates(monkeypatch):
    r = np.random.default_rng(0)
    x = r.random((200, 30))
    y = (x[:, 0] > 0.5).astype(int)
    rows = [(np.arange(30), v) for v in x]
    monkeypatch.setattr(language, "L1", 8.0)
    w = language.ftrl(rows, y, 2, 30)
    monkeypatch.undo()
    assert (language.ftrl(rows, y, 2, 30)[:-1] == 0).mean() < 0.1 < 0.5 < (w[:-1] == 0).mean() and np.abs(w[0]).max() > 1
    logits = np.stack([np.zeros(400), np.full(400, 8.0)], axis=1)
    assert language.best_temperature(logits, (r.random(400) < 0.7).astype(int)) > 5


def _plain_grams(text):
    low = text.lower()
    out = defaultdict(int)
    for k in language.ORDERS:
        for i in range(len(low) - k + 1):
            out[low[i:i + k]] += 1
    return out


def test_grams_are_counted_exactly(monkeypatch):
    """Keys tell all n-grams apart, short texts joined and long ones cut into pieces alike."""
    monkeypatch.setattr(language, "_CHARS", 50)
    texts = ["", "a", "ab", "\x00\x00a", "İstanbul ΑΣ", "日本語 text " * 20, prose(40, 5), "aaaa" * 30, "\U0010ffff\U0010ffff" * 30]
    want = [_plain_grams(t) for t in texts]
    names = sorted({g for w in want for g in w})
    keys = np.array([language.gram_keys(np.array([ord(c) for c in g]), len(g))[0] for g in names])
    assert len(set(keys.tolist())) == len(names) and (keys > 0).all()
    for known in (names, names[::3]):
        v = language.Vocabulary(np.array([k for k, g in zip(keys, names, strict=True) if g in set(known)]))
        name = dict(zip(v.places(keys).tolist(), names, strict=True))
        got = [{} for _ in texts]
        for d, p, n in zip(*v.counts(texts), strict=True):
            got[d][name[p]] = n
        assert got == [{g: n for g, n in w.items() if g in set(known)} for w in want]


def test_language_equals_a_plain_version(spark):
    """Sample, vocabulary, document frequencies, FTRL steps, temperature and scores against
    dictionaries and loops."""
    import math
    d = spark.read.parquet(f"{SF001}/documents.parquet").where("doc_id < 70 and text is not null and lang is not null").select("doc_id", "text", "lang")
    sample = 32
    pick = {r.doc_id: r.pick for r in d.select("doc_id", F.xxhash64("doc_id", F.lit("sample")).alias("pick")).collect()}
    docs = sorted(d.collect(), key=lambda r: pick[r.doc_id])
    chosen = docs[:sample + sample // 4]
    counted = {r.doc_id: _plain_grams(r.text) for r in docs}
    vocabulary = {g for r in chosen for g in counted[r.doc_id]}
    idf = {g: math.log((1 + len(docs)) / (1 + sum(g in counted[r.doc_id] for r in docs))) + 1 for g in vocabulary}

    def row(r):
        x = {g: math.log1p(n) * idf[g] for g, n in counted[r.doc_id].items() if g in vocabulary}
        size = math.sqrt(sum(v * v for v in x.values())) or 1.0
        return {g: v / size for g, v in x.items()} | {"": 1.0}      # the bias
    langs = sorted({r.lang for r in chosen})
    fitted, held = [r for i, r in enumerate(chosen) if i % 5], [r for i, r in enumerate(chosen) if not i % 5]
    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        if abs(z[k]) <= language.L1:
            return 0.0
        return -(z[k] - math.copysign(language.L1, z[k])) / ((language.BETA + math.sqrt(n[k])) / language.ALPHA + language.L2)

    def logits(x):
        return [sum(v * weight((g, c)) for g, v in x.items()) for c in langs]

    def softmax(s):
        e = [math.exp(v - max(s)) for v in s]
        return [v / sum(e) for v in e]
    order = np.random.default_rng(5)
    for _ in range(language.EPOCHS):
        for i in order.permutation(len(fitted)):
            x = row(fitted[i])
            p = softmax(logits(x))
            for c, pc in zip(langs, p, strict=True):
                for g, v in x.items():
                    k, grad = (g, c), v * (pc - (c == fitted[i].lang))
                    w = weight(k)
                    z[k] += grad - (math.sqrt(n[k] + grad * grad) - math.sqrt(n[k])) / language.ALPHA * w
                    n[k] += grad * grad
    t = language.best_temperature(np.array([logits(row(r)) for r in held]), np.array([langs.index(r.lang) for r in held]))
    got = {r.doc_id: r for r in language.identify(d, F.lit(False), sample=sample).collect()}
    assert len(got) == len(docs) > len(chosen)
    for r in docs:
        p = softmax([v / t for v in logits(row(r))])
        best = max(range(len(langs)), key=lambda c: p[c])
        if any(map(str.isalpha, r.text)):
            assert abs(got[r.doc_id].score - p[best]) < 1e-6 and got[r.doc_id].lang_pred == langs[best]


def test_short_pieces_fill_gaps_below_a_bundle(spark, tokenizer):
    """40 pieces of 1,984 tokens leave gaps of 64: each takes one of 40 pieces of 64, though
    their bundles of 128 fit nowhere. Pieces of one token fill what is left."""
    rows = [(k, "a " * 1983) for k in range(40)] + [(100 + k, "a " * 63) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = best_fit.packed_sequences(docs, tokenizer).collect()
    assert sum(r.length for r in got) == 40 * 2048 and len({r.sequence_id for r in got}) == 40
    rows = [(k, "a " * 2044) for k in range(9)] + [(100 + k, "") for k in range(27)]
    got = best_fit.packed_sequences(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer).collect()
    assert len({r.sequence_id for r in got}) == 9
    short = spark.createDataFrame([(k, "a " * (k % 9)) for k in range(700)], "doc_id long, text string")
    got = best_fit.packed_sequences(short, tokenizer).collect()
    assert len({r.sequence_id for r in got}) == -(-sum(r.length for r in got) // 2048)


def test_workers_give_back_and_batches_are_short(spark, tmp_path):
    from drover.llm import common as C
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    for given, inside in (("10000", str(C.TEXT_ROWS)), ("0", str(C.TEXT_ROWS)), ("7", "7")):
        spark.conf.set(key, given)
        with pytest.raises(KeyError), C.short_batches(spark):
            assert spark.conf.get(key) == inside
            raise KeyError
        assert spark.conf.get(key) == given
    spark.conf.set(key, old)

    def resident() -> int:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def kept(task) -> int:
        """Bytes that the process holds more after a task of many small allocations."""
        import numpy as np
        before = resident()

        def run(batches):
            parts = [np.ones(8_000) for _ in range(3_000)]      # 190 MB below the mmap threshold
            pin.append(np.ones(8_000))                        # one that lives on, above them
            yield len(parts)
        list(task(run)(iter(())))
        return resident() - before
    pin: list = []
    assert kept(C.lean) < 60 << 20


def _new_tokens(tokenizer, monkeypatch, cache=None):
    """A tokenizer of its own, and the pieces that it has to learn."""
    if cache:
        monkeypatch.setattr(tokens, "CACHE", cache)
    tok, learned, own = tokens.Tokens(tokenizer), [], tokens.Tokens(tokenizer).words

    class Counting:
        def encode_batch_fast(self, lots, **k):
            learned.extend(p for lot in lots for p in lot.split())
            return own.encode_batch_fast(lots, **k)
    tok.words = Counting()
    return tok, learned


def _whole(tok, texts):
    return [np.array(e.ids, "<u4").tobytes() for e in tok.whole.encode_batch(texts, add_special_tokens=False)]


def test_a_full_cache_keeps_the_words_in_use(tokenizer, monkeypatch):
    """Calls that share words but bring as many new ones: a full cache must not lose the
    words that every call holds."""
    tok, learned = _new_tokens(tokenizer, monkeypatch, 60)
    common = [f"{w}." for w in VOCAB[:20]] + VOCAB[20:30]
    for call in range(30):
        texts = [" ".join([*common, *(f"{w}{'xyz'[call % 3]}{'abcdefghij'[call // 3]}" for w in VOCAB[30:70])]), " The\nÜ", "\t"]
        assert tok.encode([*texts, None, ""]) == [*_whole(tok, texts), b"", b""]
    count = defaultdict(int)
    for p in learned:
        count[p] += 1
    assert {count[w] for w in VOCAB[:30]} == {1} and count["."] == 1
    assert len(tok.cache) + len(tok.older) < 60 + 60 + 2 * 100


def test_capitals_whose_small_letters_are_not_latin(tokenizer, monkeypatch):
    """Ɓ, Ʃ and 21 others are lower-cased to letters beyond the Latin blocks; a chunk with a
    full stop is cut at the stop alone."""
    tok, _ = _new_tokens(tokenizer, monkeypatch)
    texts = [f"a{chr(k)}b. x{chr(k)}'s .{chr(k)}9" for k in range(0x20, 0x250)]
    assert tok.encode(texts) == _whole(tok, texts)


@pytest.mark.parametrize("task", [
    lambda path: best_fit._pieces(path, 2048, 0), lambda path: packed_output._pack(path, 2048, 0, 0, "<u2", 1 << 22)])
def test_tasks_encode_many_megabytes_at_once(tokenizer, monkeypatch, task):
    """Words that texts share are looked up once a call: 4 MB of texts are one call."""
    calls, encode = [], tokens.Tokens.encode
    monkeypatch.setattr(tokens.Tokens, "encode", lambda self, texts: calls.append(len(texts)) or encode(self, texts))
    batch = pa.record_batch({"doc_id": pa.array(range(400), pa.int64()), "text": pa.array([prose(2000, k) for k in range(400)])})
    rows = list(task(tokenizer)(iter([batch])))
    assert batch.column("text").nbytes > 4_000_000 and sum(r.num_rows for r in rows) >= 400 and calls == [400]


def test_a_call_holds_little_beside_its_text_and_ids(tokenizer, monkeypatch):
    """A megabyte of short words: their ids are laid out, and new words learnt, in blocks."""
    tok, lots, longest = tokens.Tokens(tokenizer), [], 0
    own = tok.words

    class Counting:
        def encode_batch_fast(self, given, **k):
            lots.append(sum(len(g.split()) for g in given))
            return own.encode_batch_fast(given, **k)
    tok.words = Counting()
    new = [" ".join(f"{a}{b}{c}" for c in VOCAB[:40]) for a in VOCAB[:40] for b in VOCAB[:40]]
    want = _whole(tok, new)
    assert tok.encode(new) == want and sum(lots) > 40_000 and max(lots) <= 20_000
    texts = ["a b c d e f g h " * 500] * 250
    tok.encode(texts[:1])
    tracemalloc.start()
    try:
        got = tok.encode(texts)
        longest = tracemalloc.get_traced_memory()[1] - sum(map(len, got))
    finally:
        tracemalloc.stop()
    assert got == _whole(tok, texts[:1]) * 250 and longest < 16 << 20


def test_batches_of_token_jobs_are_short(spark, tokenizer, tmp_path, monkeypatch):
    """Executors hold several copies of a batch: no job over whole texts takes 10,000 rows at once."""
    key, seen, own = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, best_fit.written
    monkeypatch.setattr(best_fit, "written", lambda df, name: seen.setdefault(name, int(spark.conf.get(key))) and own(df, name))
    docs = spark.range(9).selectExpr("id as doc_id", "'a b' as text")
    old = spark.conf.get(key)
    assert best_fit.packed_sequences(docs, tokenizer).count() == 9
    assert seen["pieces"] == tokens.CALL_ROWS == 4_000 and spark.conf.get(key) == old
    seen.clear()
    assert corpus_pipeline.best_fit_packing(spark, docs, "").count() == 9 and seen["pieces"] == 1_000
    packed_output.write_packed(packed_output.packed_rows(docs, tokenizer), f"{tmp_path}/rows")
    assert packed_output.read_packed(spark, f"{tmp_path}/rows").count() >= 1 and spark.conf.get(key) == old
