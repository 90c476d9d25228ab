"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import (
    chat,
    decontam,
    langid,
    lexical,
    licenses,
    masked_lm,
    phrases,
    pieces,
    prefixes,
    pseudonyms,
    rans,
    simhash,
    vectors,
)
from lakeloom.llm.shared import session, table
from lakeloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    return licenses.licenses(table(spark, folder, "documents"))


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    return langid.identify(table(spark, folder, "documents"), folds=4, fold=2)


def piece_model() -> bytes:
    """The public piece file; another path is the caller's choice in ``pieces.model_bytes``."""
    import public_tokenizers

    return pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    return pieces.round_trip(table(spark, folder, "documents"), piece_model())


PSEUDONYM_KEY = "example key; a real one comes from the caller's secret store"


@query
def op4_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(session(spark), folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY, count="n_replaced")


@query
def op5_masked_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    docs = table(spark, folder, "documents")
    counted = masked_lm.word_counts(docs)
    return masked_lm.score(docs, *masked_lm.fit(docs, counted=counted), counted=counted)


@query
def op6_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    return chat.perspectives(table(spark, folder, "conversations"))


ORACLES["op6_chat_perspectives"] = chat.ORACLE


@query
def op7_rans_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    session(spark)
    path = scratch_path(spark, "rans")
    definition = rans.definition_of(public_tokenizers.path("word_bpe_49k.json"))
    rans.write(table(spark, folder, "documents"), definition, path, end_id=1)
    return rans.digests(spark, path)


@query
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    return decontam.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query
def op9_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    return vectors.near_duplicates(table(spark, folder, "embeddings"), threshold=0.93)


ORACLES["op9_embedding_near_dedup"] = """
with recursive cleaned as (
    select row_number() over () as n, vec_id, label,
           cast(embedding as double[]) as x
    from embeddings),
usable as (
    select *, 1 / sqrt(list_dot_product(x, x)) as scale from cleaned
    where vec_id is not null and label is not null and len(x) > 0
      and len(list_filter(x, lambda v: v is null or not isfinite(v))) = 0
      and len(list_filter(x, lambda v: v <> 0)) > 0),
links as (
    select a.n as source, b.n as target
    from usable a join usable b
      on a.label = b.label and len(a.x) = len(b.x) and a.n <> b.n
     and list_dot_product(a.x, b.x) * a.scale * b.scale >= 0.93),
reach as (
    select n as source, n as target from usable
    union
    select r.source, l.target from reach r join links l on r.target = l.source),
lowest as (
    select source, min(vec_id) as component_id from reach join usable on n = target
    group by source),
counts as (select source, count(*) as n_links from links group by source)
select c.vec_id, coalesce(n_links, 0) as n_links,
       coalesce(component_id, c.vec_id) as component_id,
       coalesce(c.vec_id = coalesce(component_id, c.vec_id), false) as kept
from cleaned c left join counts k on k.source = c.n left join lowest l on l.source = c.n
"""


@query
def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle_words=4, max_bits=4)


TOKEN_LIMIT = 2048


@query
def op11_prefix_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    session(spark)
    definition = rans.definition_of(public_tokenizers.path("word_bpe_49k.json"))
    counted = prefixes.prefix_table(table(spark, folder, "documents"), definition)
    return prefixes.within(counted, TOKEN_LIMIT).withColumn(
        "over_limit", prefixes.over_limit(TOKEN_LIMIT)
    )


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    return lexical.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


ORACLES["op12_lexical_search"] = r"""
with words as (
    select row_number() over () as doc, doc_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents),
lengths as (select doc, doc_id, len(terms) as n from words where len(terms) > 0),
totals as (select cast(count(*) as bigint) as docs, cast(sum(n) as bigint) as terms from lengths),
asked as (
    select distinct item, item_id, unnest(regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select row_number() over () as item, item_id, text from benchmark)),
counted as (
    select doc, term, count(*) as tf
    from (select doc, unnest(terms) as term from words)
    where term in (select term from asked) group by doc, term),
weights as (
    select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w
    from counted, totals group by term, docs),
scored as (
    select item, item_id, doc_id,
           cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // t.terms)))) as bigint) as score
    from asked join counted using (term) join weights using (term) join lengths using (doc), totals t
    group by item, item_id, doc, doc_id),
ranked as (
    select item_id, doc_id, score,
           cast(row_number() over (partition by item order by score desc, doc_id asc nulls last) as integer) as rank
    from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    session(spark)
    return phrases.collocations(table(spark, folder, "documents"))


ORACLES["op13_collocations"] = r"""
with pieces as (
    select row_number() over () as piece, lang, words from (
        select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from (
            select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) as piece
            from documents))
    where len(words) > 0),
places as (
    select lang, words, unnest(generate_series(1, len(words))) as s from pieces),
grams as (
    select lang, list_slice(words, s, s + d - 1) as w, count(*) as f
    from places, (values (1), (2), (3), (4)) t(d)
    where s + d - 1 <= len(words)
    group by all having count(*) >= 30),
totals as (select lang, sum(len(words)) as n from pieces group by lang),
cuts as (
    select c.lang, c.w, c.f as a, k, l.f as l, r.f as r,
           cast(cast(2000000 as hugeint) * c.f // (cast(l.f as hugeint) + r.f) as bigint) as score
    from (select *, unnest(generate_series(1, len(w) - 1)) as k from grams where len(w) > 1) c
    join grams l on l.lang = c.lang and l.w = list_slice(c.w, 1, k)
    join grams r on r.lang = c.lang and r.w = list_slice(c.w, k + 1, len(c.w))),
best as (
    select * from cuts qualify row_number() over (partition by lang, w order by score, k) = 1),
inner_parts as (
    select lang, list_slice(w, s, s + d - 1) as w, max(f) as longer
    from (select lang, w, f, d, unnest(generate_series(1, len(w) - d + 1)) as s
          from grams, (values (2), (3)) t(d) where len(w) > d)
    group by all),
ranked as (
    select b.lang, array_to_string(b.w, ' ') as phrase, a, l, r, score
    from best b left join inner_parts i on i.lang = b.lang and i.w = b.w
    where longer is null or cast(100 as hugeint) * longer < cast(80 as hugeint) * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
       phrase, a, l, r, cast(n as bigint) as n, score
from ranked join totals using (lang)
qualify rank <= 2000
"""
