"""The pipeline's stages and run() against plain Python on a small corpus."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline as P
from drover.llm import queries, tokens
from drover.llm.common import NULL_ID

WORD = "[^\x20\x09-\x0d]+"
VOCAB = ["".join(np.random.default_rng(k).choice(list("abcdeghilmnoprstu"), 2 + k % 7)) for k in range(600)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCAB, n))


BASE = prose(400, 1)
PASSAGE = prose(60, 2)
ITEM = prose(14, 3)
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE + " end"), (4, BASE.upper()), (5, prose(300, 4) + " " + PASSAGE), (6, PASSAGE + " " + prose(200, 5)),
    (7, prose(150, 6) + " " + ITEM + " " + prose(150, 7)), (8, "too short"), (9, "same words again " * 40), (10, None), (11, ""),
    (12, prose(300, 8)), (12, prose(300, 9)), (12, BASE), (None, prose(300, 10)), (None, prose(300, 10)), (None, BASE), (None, prose(280, 11)),
    (13, "### $$$ " * 60 + prose(20, 12)), *((20 + k, prose(120 + k, 50 + k)) for k in range(12))]


def row(k, i, t):
    return i, t, "en", f"s{k % 3}", None if t is None else len(t)


ROWS = [row(k, i, t) for k, (i, t) in enumerate(TEXTS)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([("i1", ITEM), ("i2", None), ("i3", "")], "item_id string, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


# ------------------------------------------------------------------ plain stages
def plain_quality(rows):
    out = []
    for r in rows:
        t = r[1] or ""
        w = re.findall(WORD, t)
        n, chars = len(w), sum(map(len, w))
        win = Counter(tuple(w[i:i + 8]) for i in range(n - 7))
        rep = {j for i in range(n - 7) if win[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        if n < 20 or 100 * len(rep) > 30 * n or 20 * len(re.findall(r"[#*$%&|<>]", t)) > chars:
            continue
        if 5 * (len(lines) - len(set(lines))) > 2 * len(lines) or not 28 * n <= 10 * chars <= 105 * n:
            continue
        if 100 * sum(any(c.isalpha() for c in x) for x in w) < 55 * n or 10 * sum(a == b for a, b in zip(w, w[1:])) > 3 * n:
            continue
        out.append(r)
    return out


def plain_fp(t):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_simhash(spark, rows):
    digests = [r[0] for r in spark.createDataFrame([(k, r[1]) for k, r in enumerate(rows)], "k int, text string").orderBy("k").select(
        P.simhash.text_digest()).collect()]
    fps = [plain_fp(r[1]) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(a):
                if (fps[a] ^ fps[b]).bit_count() <= 4:
                    group[a] = group[b] = min(group[a], group[b])
    best = {}
    for k, r in enumerate(rows):
        rank = (r[0] is None, r[0] or 0, digests[k], r[2:])
        if group[k] not in best or rank < best[group[k]][0]:
            best[group[k]] = (rank, r)
    return [r for _, r in best.values()]


def plain_substring(rows):
    first, out = {}, []
    key = lambda r: NULL_ID if r[0] is None else r[0]
    for r in sorted(rows, key=key):
        w = re.findall(WORD, r[1] or "")
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p:p + 13]), key(r))
    for r in rows:
        w = re.findall(WORD, r[1] or "")
        drop = [False] * len(w)
        for p in range(len(w) - 12):
            if first[tuple(w[p:p + 13])] < key(r):
                drop[p:p + 13] = [True] * 13
        t = " ".join(x for x, d in zip(w, drop) if not d) if any(drop) else r[1]
        if t:
            out.append((r[0], t, r[2], r[3], len(t)))
    return out


def plain_clean(rows, item=ITEM):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    i = words(item)
    bad = {tuple(i[p:p + 10]) for p in range(max(1, len(i) - 9))}
    return [r for r in rows if not any(tuple(words(r[1])[p:p + 10]) in bad for p in range(len(words(r[1]))))]


def same(df, rows):
    key = lambda r: (str(r[0]), str(r[1]), *map(str, r[2:]))
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(rows, key=key)


def test_stages_and_run_equal_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, at = ROWS, docs
    plain = [plain_quality, lambda r: plain_simhash(spark, r), plain_substring, plain_clean]
    for (name, stage), expected in zip(P.STAGES, plain):
        out = stage(spark, at, sf_dir)
        assert out.columns == docs.columns, name
        want = expected(rows)
        assert want and sorted(map(str, want)) != sorted(map(str, rows)), name      # the stage has something to do
        same(out, want)
        rows, at = want, spark.createDataFrame(want, docs.schema)
    got = P.run(spark, sf_dir).collect()
    tok = tokens.tokens(queries.tokenizer_path())
    want, lengths = Counter(), Counter()
    for r in rows:
        want[r[0]] += len(tok.whole.encode(r[1], add_special_tokens=False).ids) + 1
    for r in got:
        lengths[r.doc_id] += r.length
    assert lengths == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048


def test_simhash_stage_cases(spark, sf_dir):
    other, third = prose(300, 80), prose(300, 81)
    a, c = prose(300, 82), prose(310, 83)
    for rows in ([(3, c), (5, c), (5, a)],                                  # the clean row of a repeated id stays
                 [(1, a), (None, a), (None, c)],                             # a copy without an id goes
                 [(None, c), (None, c), (None, other)],                      # a group without ids keeps one
                 [(None, None), (None, ""), (4, None), (4, "")],             # empty texts link
                 [(7, third), (7, third), (7, other), (8, third + " x")], []):
        rows = [row(0, i, t) for i, t in rows]
        out = P.simhash_dedup(spark, spark.createDataFrame(rows, SCHEMA), sf_dir)
        same(out, plain_simhash(spark, rows))
    # columns that the stage could use itself
    df = spark.createDataFrame([(1, a, 5, "x"), (2, a, 6, "y")], "doc_id long, text string, __id long, __GONE string")
    out = P.simhash_dedup(spark, df, sf_dir)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [(1, a, 5, "x")]
    # of equal rows one, of rows that differ elsewhere the smallest
    df = spark.createDataFrame([(1, a, "z"), (1, a, "b"), (2, c, "q")], "doc_id long, text string, note string")
    assert sorted(tuple(r) for r in P.simhash_dedup(spark, df, sf_dir).collect()) == sorted([(1, a, "b"), (2, c, "q")])


def test_other_stages_keep_clashing_columns(spark, sf_dir):
    rows = [(1, prose(40, 90) + " " + PASSAGE, 1, 2, 3, 4, 5), (2, PASSAGE + " " + prose(40, 91), 1, 2, 3, 4, 5), (3, ITEM, 1, 2, 3, 4, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id long, __digest int, __key_id long, __spans int, n_chars long")
    out = P.substring_dedup(spark, df, sf_dir)
    assert out.columns == df.columns and {r.doc_id: len(r.text.split()) for r in out.collect()} == {1: 100, 2: 40, 3: 14}
    out = P.decontamination(spark, df, sf_dir)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 2]


def test_registered_queries_without_sql(spark, sf_dir):
    """op6 and op7 as registered, on the small corpus."""
    got = queries.op6_simhash(spark, sf_dir).collect()
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(r[0]), f"{plain_fp(r[1]):016x}") for r in ROWS)
    rows = sorted({(NULL_ID if r[0] is None else r[0], xxhash.xxh64_intdigest((r[1] or "").encode(), 42) & 0x7FFFFFFF if r[1] is not None else 42 & 0x7FFFFFFF,
                    (r[1] or "").encode()) for r in ROWS})
    seen, want = set(), {}
    for i, _, t in rows:
        drop = bytearray(len(t))
        for p in range(len(t) - 99):
            if t[p:p + 100] in seen:
                drop[p:p + 100] = b"\1" * 100
            seen.add(t[p:p + 100])
        want[i, t] = (sum(drop), hashlib.sha256(bytes(c for c, d in zip(t, drop) if not d)).hexdigest())
    unique = [r for r in ROWS if Counter((x[0]) for x in ROWS)[r[0]] == 1]
    by = {r.doc_id: (r.n_removed, r.kept_sha256) for r in queries.op7_previous_factor(spark, sf_dir).collect()}
    assert {r[0]: by[r[0]] for r in unique} == {r[0]: want[r[0], (r[1] or "").encode()] for r in unique}
