"""Fingerprints, fill-in-middle and source divergence against brute force on small tables
with nulls, empty and very long texts, ties, repeated rows and clashing columns."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from drover.llm import chunk_fingerprint as cf, divergence, fill_in_middle as fim, queries

rng = np.random.default_rng(11)
VOCAB = ["".join(rng.choice(list("abcdefgé日Z"), rng.integers(1, 7))) for _ in range(150)]


def prose(n, seed, sep=" "):
    r = np.random.default_rng(seed)
    return "".join(w + (sep if r.random() < .9 else "\n") for w in r.choice(VOCAB, n))


LONG = prose(60_000, 1)
TEXTS = [None, "", "\n", "\n\n a", "no line feed", "x" * 700, "é" * 400 + "\n" + "日本" * 300, "a <P> b\nc", "ends <S", "\n" * 600,
         LONG, LONG[:200_000] + "changed" + LONG[200_000:], prose(30, 2), prose(30, 2), *(prose(60, s) for s in range(3, 60))]
LANGS = ["en", "de", None, "", "fr"]
ROWS = [(i, t, LANGS[i % 2] if i > 13 else LANGS[i % 5], f"s{i % 4}" if i % 9 else None, "x", 1, "y", "z") for i, t in enumerate(TEXTS)]
ROWS += [(12, TEXTS[12], "de", "s0", "x", 1, "y", "z"), (None, prose(40, 70), None, None, None, None, None, None), (None, TEXTS[12], "en", "s1", None, None, None, None),
         (12, prose(20, 71), "en", "s2", None, None, None, None), (-7, "tail", "fr", "only", None, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, bucket string, output string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# ------------------------------------------------------------------ 12
def plain_fim(doc_id, text, rate=100, spm=50, seed=7, unit=r"[^\n]*\n|[^\n]+"):
    text = text or ""
    units = re.findall(unit, text, re.S)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k:k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("units, unit", [("lines", r"[^\n]*\n|[^\n]+"), ("characters", r".")])
def test_fill_in_middle(docs, empty, units, unit):
    for rate, spm in ((100, 50), (40, 80)):
        out = fim.fill_in_middle(docs, rate=rate, spm=spm, units=units)
        got = out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
        key = lambda r: (str(r[0]), r[-1])
        assert sorted((tuple(r)[:-1] for r in got), key=key) == sorted((plain_fim(r[0], r[1], rate, spm, unit=unit) for r in ROWS), key=key)
        assert sorted((str(r.doc_id), r.back) for r in got) == sorted((str(r[0]), r[1] or "") for r in ROWS)
    assert fim.fill_in_middle(empty).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, units="words")


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab\né日😀 ", max_size=80), st.integers(1, 9))
def test_tree_cuts_where_units_end(text, block):
    raw = np.frombuffer(text.encode(), np.uint8)
    for units, unit in (("lines", r"[^\n]*\n|[^\n]+"), ("characters", r".")):
        found = re.findall(unit, text, re.S)
        tree = fim.UnitTree(raw, units, block)
        assert tree.n_units == len(found) and tree.n_chars == len(text)
        for k in range(len(found) + 1):
            head = "".join(found[:k])
            assert tree.cut(k) == (len(head.encode()), len(head))


# ------------------------------------------------------------------ 11
def plain_chunks(raw):
    """Chunks byte by byte."""
    out, at = [], 0
    while at < len(raw):
        end = at + 1
        while end < len(raw):
            size = end - at
            h = 0
            for k, c in enumerate(reversed(raw[max(0, end - cf.WINDOW):end])):
                h = (h + (int(cf.GEAR[c]) << k)) & 0xFFFFFFFF
            bits = cf.STRICT if size <= cf.NORMAL else cf.LOOSE
            if size >= cf.LEAST and h >> (32 - bits) == 0 or size >= cf.MOST:
                break
            end += 1
        out.append(raw[at:end])
        at = end
    return out


def test_chunks_equal_a_plain_scan():
    r = np.random.default_rng(3)
    for raw in (b"", b"a", b"x" * 1000, prose(300, 5).encode(), r.integers(0, 256, 3000, dtype=np.uint8).tobytes()):
        want = plain_chunks(raw)
        assert cf.chunk_set(raw) == {xxhash.xxh3_64_intdigest(c): len(c) for c in want}
        ends = cf.boundaries(np.frombuffer(raw, np.uint8))
        assert [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)] == want
        assert cf.decoded(cf.encoded(cf.chunk_set(raw))) == cf.chunk_set(raw)


def test_chunks_resist_a_shift():
    a = LONG[:50_000].encode()
    one, other = cf.chunk_set(a), cf.chunk_set(a[:20_000] + b"inserted" + a[20_000:])
    assert cf.containment_of(one, other) > 0.98
    assert cf.containment_of({}, {}) == 1.0 and cf.containment_of({}, {1: 2}) == cf.containment_of({1: 2}, {}) == 0.0


def plain_neighbours(rows):
    digest = lambda t: 42 if t is None else int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64))
    line = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), digest(r[1])))
    out = []
    for k, r in enumerate(line):
        t, u = r[1] or "", line[(k + 1) % len(line)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        a, b, c = (cf.chunk_set(x.encode()) for x in (t, e, u))
        out.append((str(r[0]), len(t), e, cf.encoded(a), cf.encoded(b), cf.containment_of(a, b), cf.containment_of(a, c)))
    return sorted(out)


@pytest.mark.parametrize("n", [1, 5, 40])
def test_neighbours(spark, docs, empty, n):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        got = cf.neighbour_likeness(docs).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == plain_neighbours(ROWS)
        # one id, and null ids, hold a third of the rows each
        r = np.random.default_rng(n)
        rows = [(int(k) if k > 3 else 4 if k > 1 else None, prose(5, int(r.integers(0, 40)))) for k in r.integers(0, 9, 90)]
        got = cf.neighbour_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((str(x[0]), *x[1:]) for x in got) == plain_neighbours(rows)
        only = cf.neighbour_likeness(spark.createDataFrame([(3, "abcd")], "doc_id long, text string")).first()
        assert only.edited_text == "abab" and only.near_next == 1.0
        assert cf.neighbour_likeness(empty).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ranges_spread_ids_that_repeat(spark):
    ids = spark.range(900).selectExpr("if(id % 3 = 0, 5L, if(id % 3 = 1, null, id)) as id")
    r = cf.Ranges(ids, 30)
    assert r.own[5][1] >= 8 and r.own[None][1] == 10 and r.n <= 42


def test_fingerprints_and_containment(docs, empty):
    got = cf.fingerprints(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.fingerprint) for r in got) == sorted(
        (str(r[0]), len(r[1] or ""), cf.encoded(cf.chunk_set((r[1] or "").encode()))) for r in ROWS)
    by = {r.doc_id: r.fingerprint for r in got}
    frame = docs.sparkSession.createDataFrame([(by[10], by[11]), ("", ""), (by[10], "")], "a string, b string")
    x = [r[0] for r in frame.select(cf.containment(F.col("a"), F.col("b"))).collect()]
    assert x[0] > 0.99 and x[1:] == [1.0, 0.0]
    assert cf.fingerprints(empty).count() == 0


def test_fingerprint_query(spark):
    got = queries.op11_chunk_fingerprint(spark, SF001).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, sha(e), a, b, x, y) for i, n, e, a, b, x, y in plain_neighbours(rows)]
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


# ------------------------------------------------------------------ 13
def plain_audit(rows, min_docs=10, top=10):
    rows = [tuple(x or "" for x in (r[2], r[3], r[1])) for r in rows]
    terms = [(g, s, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for g, s, t in rows]
    out = []
    for lang in {g for g, _, _ in terms}:
        df, total, own = Counter(), Counter(), {}
        for g, s, w in terms:
            if g == lang:
                df.update(set(w))
                total.update(w)
                own.setdefault(s, Counter()).update(w)
        kept = sorted(t for t in df if df[t] >= min_docs)
        freq = lambda c: {t: 1 + 10 ** 9 * (c[t] + 2) // (sum(c[u] for u in kept) + 2 * len(kept)) for t in kept}
        value = lambda p, q: (p - q) ** 2 // (p + q)
        q = freq(total)
        ps = {s: freq(c) for s, c in own.items()}
        for s in own:
            pairs = sorted(((o, sum(value(ps[s][t], ps[o][t]) for t in kept)) for o in own if o != s), key=lambda x: (-x[1], x[0].encode()))
            over = sorted(((t, value(ps[s][t], q[t])) for t in kept if own[s][t] and ps[s][t] > q[t]), key=lambda x: (-x[1], x[0].encode()))[:top]
            out += [(lang, s, part, t, v, k + 1) for part, x in (("pair", pairs), ("term", over)) for k, (t, v) in enumerate(x)]
    return sorted(out)


@pytest.mark.parametrize("min_docs, block", [(10, 65_536), (2, 7), (1000, 7)])
def test_audit(docs, empty, monkeypatch, min_docs, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    got = sorted(tuple(r) for r in divergence.audit(docs, min_docs).collect())
    assert got == plain_audit(ROWS, min_docs)
    assert any(r[2] == "pair" for r in got)
    if block == 7:
        assert divergence.audit(empty).count() == 0


def test_term_pieces_cut_no_term(monkeypatch):
    raw = ("Ab cd, " * 500 + "x" * 900 + " tail é日").encode()
    want = [w.lower().encode() for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", raw.decode())]
    for piece in (5, 64, 10 ** 6):
        assert [t for part in divergence.term_pieces(raw, piece) for t in part] == want


def test_counts_are_sent_on_in_bounded_parts(docs, monkeypatch):
    whole = sorted(map(str, divergence.term_counts(docs).collect()))
    batches = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                          F.coalesce("text", F.lit("")).alias("text")).toArrow().to_batches()
    monkeypatch.setattr(divergence, "FLUSH", 50)
    parts = list(divergence._counts(batches))
    assert len(parts) > len({(r[2], r[3]) for r in ROWS}) and max(p.num_rows for p in parts) < 400
    total = Counter()
    for p in parts:
        for r in p.to_pylist():
            total[r["lang"], r["source"], r["term"]] += r["n"]
    assert len(total) == len(whole)


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 4000)), st.sets(st.integers(0, 4000)), st.integers(0, 3000))
def test_galloping_intersection(a, b, wide):
    a |= set(range(wide))
    x, y = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    for p, q in ((x, y), (y, x)):
        i, j = divergence.galloping_intersection(p, q)
        assert p[i].tolist() == q[j].tolist() == sorted(a & b)


def test_frequencies_are_exact_for_huge_counts():
    total = 4_611_686_018_427_387
    counts = np.array([0, 1, 7, 10 ** 12 + 3, total // 3, total - 2], np.int64)
    assert divergence.frequency(counts, total).tolist() == [1 + 10 ** 9 * (int(c) + 2) // total for c in counts]
