"""The queries of this subpackage and, where DuckDB can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearthspark.llm import (
    alignment, decontaminate, html, langid, licenses, linededup, neighbours, packing, phrases, pieces, quality, simhash,
    tokens,
)
from hearthspark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", "n_lines", "n_dropped", "kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans", "items", "near_items")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    name: f for name, f in globals().items() if name.startswith("op") and callable(f)
}

LINE_DEDUP_SQL = r"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
    from documents
), keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), firsts as (
    select key, min(doc_id) as first from keyed where length(key) >= 10 group by key having min(doc_id) < max(doc_id)
), marked as (
    select k.doc_id, k.line, k.place, f.first is not null and f.first < k.doc_id as dropped
    from keyed k left join firsts f using (key)
)
select doc_id, count(*) as n_lines, cast(sum(cast(dropped as int)) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
"""

DECONTAMINATION_SQL = r"""
with doc_words as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents
), item_words as (
    select item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from benchmark where text is not null and item_id is not null
), item_starts as (
    select item_id, words, least(13, len(words)) as size,
           unnest(range(1, greatest(1, len(words) - 12) + 1)) as start
    from item_words where len(words) > 0
), windows as (
    select distinct item_id, size, array_to_string(words[start:start + size - 1], ' ') as body from item_starts
), sizes as (
    select distinct size from windows
), doc_starts as (
    select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as start from doc_words cross join sizes
    where len(words) >= size
), found as (
    select d.doc_id, d.start, d.size, w.item_id
    from (select doc_id, start, size, array_to_string(words[start:start + size - 1], ' ') as body from doc_starts) d
    join windows w on w.size = d.size and w.body = d.body
), hit as (
    select doc_id, count(distinct place) as n_hit
    from (select doc_id, unnest(range(start, start + size)) as place from found) group by doc_id
), named as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
)
select d.doc_id, len(d.words) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(n.n_items, 0) as n_items,
       sha256(coalesce(n.items, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.words) as contaminated
from doc_words d left join hit h using (doc_id) left join named n using (doc_id)
"""

COLLOCATIONS_SQL = r"""
with cut as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), pieces as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from cut
), grams as (
    select lang, m, array_to_string(words[start:start + m - 1], ' ') as phrase
    from (select lang, words, m, unnest(range(1, len(words) - m + 2)) as start
          from pieces cross join (values (1), (2), (3)) sizes(m) where len(words) >= m)
), f as materialized (
    select lang, m, phrase, count(*)::hugeint as f from grams group by all
), cands as (
    select lang, m, phrase, f as a, string_split(phrase, ' ') as words from f where m >= 2 and f >= 10
), parts as materialized (
    select lang, m, phrase, a, k, array_to_string(words[1:k], ' ') as head, array_to_string(words[k + 1:m], ' ') as tail
    from (select *, unnest(range(1, m)) as k from cands)
), cuts as (
    select c.lang, c.m, c.phrase, c.a, c.k, l.f as l, r.f as r, 1000000::hugeint * c.a * c.a // (l.f * r.f) as score
    from parts c join f l on l.lang = c.lang and l.phrase = c.head join f r on r.lang = c.lang and r.phrase = c.tail
), best as (
    select *, row_number() over (partition by lang, phrase order by score, k) as place from cuts
), inner_ as (
    select lang, array_to_string(words[start:start + 1], ' ') as phrase, max(a) as most
    from (select lang, words, a, unnest([1, 2]) as start from cands where m = 3) group by all
), ranked as (
    select b.lang, b.phrase, b.a, b.l, b.r, b.score,
           row_number() over (partition by b.lang order by b.score desc, b.a desc, b.phrase) as rank
    from best b left join inner_ i on b.m = 2 and i.lang = b.lang and i.phrase = b.phrase
    where b.place = 1 and (i.most is null or 100 * i.most < 50 * b.a)
), sizes as (
    select lang, sum(f) as n from f where m = 1 group by lang
)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
       cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked join sizes using (lang) where rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {"op2_line_dedup": LINE_DEDUP_SQL, "op9_decontamination": DECONTAMINATION_SQL,
                              "op12_collocations": COLLOCATIONS_SQL}
