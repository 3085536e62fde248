"""Registered queries of the operators, each over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    language_id,
    mixing,
    packing,
    quality,
    simhash,
    substring_dedup,
    token_histogram,
    toxicity,
    warc,
    whitening,
)

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(key: str, sql: str | None = None):
    def register(function):
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


@query(
    "op1_rlz_substring_dedup",
    r"""
with docs as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), places as (
  select doc_id, words, unnest(range(1, greatest(len(words) - 11, 1))) as pos from docs
), windows as (
  select doc_id, pos, array_to_string(words[pos:pos + 12], ' ') as seed from places
), firsts as (
  select seed, min(doc_id) as first_id from windows group by seed having count(*) > 1
), removed as (
  select distinct doc_id, unnest(range(pos, pos + 13)) as pos from windows join firsts using (seed) where first_id < doc_id
), kept as (
  select doc_id, string_agg(word, ' ' order by pos) as kept, count(*) as n_kept
  from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from docs) anti join removed using (doc_id, pos)
  group by doc_id
)
select doc_id, len(words) as n_words, len(words) - coalesce(n_kept, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from docs left join kept using (doc_id)
""",
)
def rlz_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = substring_dedup.remove_repeated_passages(table(spark, sf_dir, "documents"))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_nb_svm_quality")
def nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op3_block_naming_dedup",
    r"""
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from texts
""",
)
def block_naming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op4_byte_gru_language")
def byte_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted_languages(table(spark, sf_dir, "documents"))


@query("op5_token_length_histogram")
def token_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_histogram.token_counts(table(spark, sf_dir, "documents"), VOCABULARY)
    return token_histogram.length_histogram(counts)


@query("op6_crf_toxicity")
def crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_tiled_simhash")
def tiled_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.packed_sequences(table(spark, sf_dir, "documents"))
    return packed.select("shard", "part", "bin", "capacity", "n_words", "doc_ids", "starts", "lengths", F.sha2("text", 256).alias("text_sha256"))


_BLOCK = mixing.BLOCK_WORDS


@query(
    "op9_mixed_sources",
    rf"""
with recursive docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents
), sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source is null, encode(source)) - 1 as rank
  from docs group by source
), weighed as (
  select *, [5.0, 2.0, 1.0][(rank % 3 + 1)::int]::double as weight, 3.0::double * source_size as most from sources
), rounds as (
  select 0 as turn, rank, source, source_size, weight, most, 0.0::double as target, false as capped from weighed
  union all
  select turn + 1, rank, source, source_size, weight, most, case when capped or share >= most then most else share end,
    capped or share >= most
  from (
    select *, case when capped then most else
      (sum(source_size) over () - coalesce(sum(most) filter (capped) over (), 0)) / (sum(weight) filter (not capped) over ()) * weight end as share
    from rounds
  ) where turn <= 40
), targets as (
  select rank, source, source_size, target, (source_size + {_BLOCK - 1}) // {_BLOCK} as blocks from rounds where turn = 40
), blocks as (
  select rank, blocks, unnest(range(0, blocks)) as block from targets
), ordered as (
  select rank, blocks, block, row_number() over (
    partition by rank order by ('0x' || substr(md5('{mixing.SEED}:' || rank || ':' || block), 1, 8))::bigint, block) - 1 as index from blocks
), ends as (
  select t.*, o.index as last_index, floor(target / source_size) as turns from targets t join ordered o on o.rank = t.rank and o.block = t.blocks - 1 where target > 0
), choices as (
  select *, round((target - turns * source_size) / {_BLOCK}) as fewer, round((target - turns * source_size + blocks * {_BLOCK} - source_size) / {_BLOCK}) as more from ends
), slots as (
  select rank, blocks, least(greatest(turns * blocks + case when fewer <= last_index then fewer else greatest(last_index + 1, more) end, 1), 3 * blocks)::bigint as slots
  from choices
), draws as (
  select rank, blocks, unnest(range(0, slots)) as draw from slots
), drawn as (
  select rank, draw % blocks as index, count(*) as times, min(('0x' || substr(md5('{mixing.SEED}:shard:' || rank || ':' || draw), 1, 8))::bigint
    % (select ceil(sum(slots) / {mixing.SHARD_SLOTS})::bigint from slots)) as first_shard
  from draws group by all
), placed as (
  select rank, doc_id, size, sum(size) over (
    partition by rank order by ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint % {mixing.GROUPS}, doc_id nulls last, size
    rows between unbounded preceding and current row)::bigint - size as start
  from docs join targets on docs.source is not distinct from targets.source
), parts as (
  select rank, doc_id, size, start, unnest(range(start // {_BLOCK}, (start + size - 1) // {_BLOCK} + 1))::bigint as block from placed where size > 0
), taken as (
  select rank, doc_id, start, sum((least(start + size, (block + 1) * {_BLOCK}) - greatest(start, block * {_BLOCK})) * coalesce(times, 0))::bigint as taken,
    min(first_shard) as first_shard
  from parts join ordered using (rank, block) left join drawn using (rank, index) group by all
)
select p.doc_id, p.size::bigint as size, t.source_size, t.target, coalesce(k.taken, 0)::bigint as taken, k.first_shard
from placed p join targets t on p.rank = t.rank
left join taken k on k.rank = p.rank and k.doc_id = p.doc_id and k.start = p.start and p.size > 0
""",
)
def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sources(table(spark, sf_dir, "documents"))


@query(
    "op10_cross_polytope",
    """
with recursive vectors as (
  select vec_id, label, embedding::double[] as v from embeddings where label is not null and embedding is not null
), usable as (
  select * from vectors
  where len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as u, b.vec_id as v from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.93
), reach as (
  select vec_id as node, vec_id as other from usable
  union
  select r.node, l.v from reach r join links l on l.u = r.other
), components as (
  select node, min(other) as component_id from reach group by node
), counts as (
  select u, count(*) as n from links group by u
)
select e.vec_id, coalesce(c.n, 0)::bigint as n_links, coalesce(k.component_id, e.vec_id) as component_id,
  coalesce(k.component_id, e.vec_id) = e.vec_id as kept
from embeddings e left join counts c on c.u = e.vec_id left join components k on k.node = e.vec_id
""",
)
def cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query(
    "op11_dictionary_warc",
    """
with payloads as (
  select page_id, coalesce(html, '') as payload from pages
), firsts as (
  select *, strlen(payload) >= 100 and page_id is distinct from min(page_id) over (partition by payload)
    and min(page_id) over (partition by payload) is not null as again, min(page_id) over (partition by payload) as first_id
  from payloads
)
select page_id, strlen(payload)::bigint as payload_bytes, sha256(payload) as payload_digest,
  case when again then 'revisit' else 'response' end as record_type, case when again then first_id end as refers_to
from firsts
""",
)
def dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived_pages(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op12_kronecker_negatives",
    """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, embedding from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), rows as (
  select vec_id, label, list_transform(embedding, lambda c: floor(256 * c::double)) as x from vectors
), scored as (
  select a.vec_id as anchor_id, o.vec_id, a.label = o.label as same, list_inner_product(a.x, o.x)::bigint as score
  from rows a join rows o on a.vec_id <> o.vec_id and len(a.x) = len(o.x) where a.vec_id % 50 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select * from (
  select p.anchor_id, p.positive_id, row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id)::int as rank,
    s.vec_id as negative_id, p.positive_score, s.score as negative_score
  from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
  where 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
) where rank <= 3
""",
)
def kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


@query("op13_jacobi_davidson_whitening")
def jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_vectors(table(spark, sf_dir, "embeddings"))
