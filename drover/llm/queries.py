"""Registered queries of this package: each applies one operator, with production
parameters, to its whole table. SQL is given where DuckDB can express the result."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from drover.llm import (best_fit, chunk_fingerprint, decontaminate, difference_cover, divergence, fill_in_middle, language,
                        packed_output, previous_factor, quality, simhash, token_counts, url_model)
from drover.llm.common import NULL_ID, short_batches, table, written
from drover.llm.tokens import CALL_ROWS
from drover.session import scratch_path


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer lies; $DROVER_TOKENIZER overrides it."""
    own = os.environ.get("DROVER_TOKENIZER")
    if own:
        return own
    import public_tokenizers
    return public_tokenizers.path(name)


def _doc_id():
    return F.when(F.col("key_id") != NULL_ID, F.col("key_id")).alias("doc_id")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over a store that got three batches: every document with its token estimate
    (a quarter of its bytes), every document's exact count as a revision, and the removal
    of documents without a token; the second batch is applied twice."""
    docs = table(spark, sf_dir, "documents")
    with short_batches(spark, CALL_ROWS):
        exact = written(token_counts.counted(docs, tokenizer_path(), "word_bpe_49k"), "token-counts")
    store = token_counts.TokenTotals(spark, scratch_path(spark, "token-totals"))
    guess = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.lit("word_bpe_49k").alias("tokenizer"),
                        F.coalesce(F.octet_length("text") / 4, F.lit(0)).cast("long").alias("n_tokens"), F.lit("insert").alias("op"))
    store.apply(1, guess)
    store.apply(2, exact.withColumn("op", F.lit("revise")))
    store.apply(2, exact.withColumn("op", F.lit("revise")))
    store.apply(3, exact.where("n_tokens = 0").withColumn("op", F.lit("delete")))
    return store.totals()


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of 2048 tokens as bulk-synchronous best fit finds."""
    return best_fit.packed_sequences(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, line and repetition counts, base verdict and the cascade's verdict."""
    q = quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return q.select("doc_id", *(F.col(f"q_{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host rules, and for the rest the language models' verdict."""
    return url_model.judge(table(spark, sf_dir, "pages"))


def op5_packed_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows, written and read back: one row per segment."""
    path = scratch_path(spark, "packed")
    packed_output.write_packed(packed_output.packed_rows(table(spark, sf_dir, "documents"), tokenizer_path()), path)
    return packed_output.segments(packed_output.read_packed(spark, path))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op7_previous_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed from each document, and the digest of the rest."""
    return previous_factor.remove_repeats(table(spark, sf_dir, "documents")).select(
        _doc_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose crc32(doc_id) is not 0 modulo 5."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return language.identify(table(spark, sf_dir, "documents"), held)


def op9_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from each document, and the digest of the rest."""
    return difference_cover.remove_repeats(table(spark, sf_dir, "documents")).select(
        _doc_id(), "n_words", "n_removed", "kept_sha256")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words hit in each document, and the items found."""
    hits = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(_doc_id(), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       decontaminate.items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_chunk_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and its likeness to the edited
    text and to the next document."""
    return chunk_fingerprint.neighbour_likeness(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines cut into prefix, middle and suffix; the text is rebuilt
    from the output."""
    f = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return f.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                    sha(fill_in_middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every two sources of a language, and each source's over-used terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_best_fit_packing, op3_quality_rules, op4_url_filter, op5_packed_output, op6_simhash,
    op7_previous_factor, op8_language_id, op9_difference_cover, op10_decontamination, op11_chunk_fingerprint,
    op12_fill_in_middle, op13_source_divergence)}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_ALNUM = (r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")

ORACLE_SQL = {
    "op3_quality_rules": rf"""
with d as (select doc_id, coalesce(text, '') as t, {_WORDS} as w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines from documents),
p as (select doc_id, i, w[i:i + 7] as s from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d)),
m as (select doc_id, i from (select *, count(*) over (partition by doc_id, s) as c from p) where c > 1),
r as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + 8)) as j from m) group by doc_id),
f as (select d.doc_id, w, lines, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words
      from d left join r using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 20 * n_symbols > word_chars or 5 * n_dup_lines > 2 * len(lines)
    or 10 * word_chars < 28 * n_words or 10 * word_chars > 105 * n_words
    or 100 * len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) < 55 * n_words
    or 10 * len(list_filter(list_zip(w[1:-2], w[2:]), lambda x: x[1] = x[2])) > 3 * n_words) as kept
from b""",
    "op9_difference_cover": rf"""
with d as (select doc_id, {_WORDS} as w from documents),
win as (select doc_id, p, w[p:p + 12] as s from (select doc_id, w, unnest(range(1, len(w) - 11)) as p from d)),
f as (select s, min(doc_id) as m from win group by s),
gone as (select distinct win.doc_id, unnest(range(p, p + 13)) as i from win join f using (s) where f.m < win.doc_id),
x as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from d),
k as (select doc_id, string_agg(word, ' ' order by i) as kept, count(*) as n from x anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k on d.doc_id = k.doc_id""",
    "op10_decontamination": rf"""
with d as (select doc_id, {_ALNUM} as w from documents),
b as (select item_id, {_ALNUM} as w from benchmark),
iw as (select item_id, w[p:p + 9] as s from (select item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) as p from b where len(w) > 0)),
ls as (select distinct len(s) as l from iw),
dw as (select doc_id, p, l, w[p:p + l - 1] as s from (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as p from d, ls)),
h as (select doc_id, p, l, item_id from dw join iw using (s)),
c as (select doc_id, count(distinct i) as n from (select doc_id, unnest(range(p, p + l)) as i from h) group by doc_id),
i as (select doc_id, list_sort(list(distinct item_id::varchar)) as items from h group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(c.n, 0)::bigint as n_hit, coalesce(len(items), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(c.n, 0) > 0 as contaminated
from d left join c on d.doc_id = c.doc_id left join i on d.doc_id = i.doc_id""",
    "op12_fill_in_middle": r"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
             sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
x as (select *, len(u) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
        ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain'
          when h4 % 100 < 50 then 'spm' else 'psm' end as form from x),
p as (select *, array_to_string(u[1:a], '') as pre, array_to_string(u[a + 1:b], '') as mid, array_to_string(u[b + 1:], '') as suf from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(pre)::bigint end as prefix_chars,
  case when form <> 'plain' then length(mid)::bigint end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
    else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(pre || mid || suf) as restored_sha256
from p""",
    "op13_source_divergence": r"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
c as (select lang, source, r, term, count(*) as n from (select lang, source, r, unnest(w) as term from d) group by all),
k as (select lang, term, sum(n)::hugeint as n from c group by all having count(*) >= 10),
g as (select distinct lang, source from d),
v as (select lang, count(*) as v, sum(n) as total from k group by all),
s2 as (select c.lang, c.source, c.term, sum(c.n)::hugeint as n from c join k on c.lang = k.lang and c.term = k.term group by all),
t2 as (select lang, source, sum(n) as total from s2 group by all),
e as (select g.lang, g.source, k.term, coalesce(s2.n, 0) as n,
        1 + (1000000000 * (coalesce(s2.n, 0) + 2)) // (coalesce(t2.total, 0) + 2 * v.v) as p,
        1 + (1000000000 * (k.n + 2)) // (v.total + 2 * v.v) as q
      from g join k on g.lang = k.lang join v on g.lang = v.lang
      left join s2 on g.lang = s2.lang and g.source = s2.source and k.term = s2.term
      left join t2 on g.lang = t2.lang and g.source = t2.source),
pv as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
       from e a join e b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
rows as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
         from g a join g b on a.lang = b.lang and a.source <> b.source
         left join pv on pv.lang = a.lang and pv.source = a.source and pv.item = b.source
         union all
         select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from e where n > 0 and p > q),
x as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from rows)
select lang, source, part, item, value, rank::int as rank from x where part = 'pair' or rank <= 10""",
}
