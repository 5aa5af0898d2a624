"""One query per operator over its whole table, with production parameters; SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide.llm import (
    conversation_repair, decontaminate, exact_dedup, language_model, ngram_join, nearest, packing, pii, quality, repair_sql, sharding, spelling,
    url_rules, warc,
)
from salestide.llm.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return shipped


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from labels that are not held out."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"))


@_query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back, with digests of what was read."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


ORACLES["op3_warc"] = """
    with p as (
        select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest,
            max(page_id) over (partition by coalesce(html, '')) as keep
        from pages
    )
    select page_id, payload_bytes, payload_digest,
        case when payload_bytes >= 1000 and page_id <> keep then 'revisit' else 'response' end as record_type,
        case when payload_bytes >= 1000 and page_id <> keep then keep end as refers_to, true as intact
    from p
"""


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark, with the passages."""
    return decontaminate.passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op5_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents under a hidden Markov model trained on those not held out."""
    return language_model.score(_table(spark, sf_dir, "documents"))


@_query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document stays of each group of equal texts."""
    return exact_dedup.duplicates(_table(spark, sf_dir, "documents"))


ORACLES["op6_exact_dedup"] = r"""
    with d as (
        select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
        from documents
    )
    select doc_id, min(doc_id) over (partition by text_sha256) as keep_id,
        count(*) over (partition by text_sha256) as group_size,
        doc_id = min(doc_id) over (partition by text_sha256) as kept, text_sha256
    from d
"""


@_query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents by three-word shingles."""
    return ngram_join.join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


ORACLES["op7_ngram_jaccard_join"] = r"""
    with recursive split as (
        select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') as w from documents
    ), sets as (
        select doc_id, coalesce(list_distinct(case when len(w) between 1 and 2 then [array_to_string(w, chr(31))]
            else list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(31) || w[i + 1] || chr(31) || w[i + 2]) end), []) as s
        from split
    ), shingles as (
        select doc_id, len(s) as n, unnest(s) as shingle from sets
    ), linked as (
        select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
        group by a.doc_id, b.doc_id having 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
    ), reached as (
        select doc_id, doc_id as other from sets
        union select reached.doc_id, linked.b from reached join linked on linked.a = reached.other
    ), least as (
        select doc_id, min(other) as component_id from reached group by doc_id
    )
    select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept from sets join least using (doc_id)
"""


@_query
def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all urls: by the stated rules, else by rules mined from the urls those decide."""
    return url_rules.judge(_table(spark, sf_dir, "pages"))


@_query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dealt to 16 shards by jump consistent hashing of doc_id."""
    return sharding.shard_table(_table(spark, sf_dir, "documents"), shards=16)


@_query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.digest(pii.find(_table(spark, sf_dir, "documents")))


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that differ by one letter, and the form each is a variant of."""
    return spelling.variants_of(_table(spark, sf_dir, "documents"))


_CRC_OF_HEX = """xor(4294967295, list_reduce(list_transform(range(strlen(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::bigint),
    lambda c, b: list_reduce(range(8), lambda v, j: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b)), 4294967295::bigint))"""

ORACLES["op11_spelling_variants"] = f"""
    with recursive found as (
        select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) as run from documents
    ), lowered as (
        select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
        from found where length(run) >= 7 group by all
    ), drawn as (
        select run, n, {_CRC_OF_HEX} as c
        from (select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from lowered)
    ), cut as (
        select case when c % 31 = 0 then run[1 : c % length(run)] || run[c % length(run) + 2 :] else run end as word, n from drawn
    ), words as (
        select word, sum(n)::bigint as n from cut where length(word) >= 7 group by word having sum(n) >= 2
    ), shorter as (
        select word, i, word[1 : i] || word[i + 2 :] as left_over
        from (select word, unnest(range(length(word))) as i from words)
    ), pairs as (
        select a.word, b.word as other from shorter a join shorter b on a.i = b.i and a.left_over = b.left_over and a.word <> b.word
        union select word, left_over from shorter where left_over in (select word from words)
        union select left_over, word from shorter where left_over in (select word from words)
    ), ranked as (
        select p.word, other, o.n as other_n, count(*) over (partition by p.word) as n_near,
            row_number() over (partition by p.word order by o.n desc, other) as place
        from pairs p join words o on o.word = other
    ), judged as (
        select w.word, w.n, coalesce(n_near, 0)::bigint as n_near,
            case when other_n >= 10 * w.n then other end as form, case when other_n >= 10 * w.n then other_n end as form_n
        from words w left join ranked r on r.word = w.word and place = 1
    ), ways as (
        select word, word as root from judged
        union all select ways.word, form from ways join judged on judged.word = ways.root where form is not null
    ), roots as (
        select ways.word, root from ways join judged on judged.word = root where form is null
    )
    select word, form, root, n, n_near, form_n from judged join roots using (word)
"""


@_query
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors, by inner product, of every vector whose id is divisible by 20."""
    return nearest.search(_table(spark, sf_dir, "embeddings"), F.col("key") % 20 == 0, k=20)


@_query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of all conversations after a stated damage, and their cheapest repair."""
    damaged = conversation_repair.damage(_table(spark, sf_dir, "conversations"))
    return conversation_repair.audit(conversation_repair.repair(damaged))


ORACLES["op13_conversation_repair"] = repair_sql.ORACLE
