"""The registered corpus queries, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .attention_lm import scored
from .burst_trie import trie_nodes
from .common import read_table
from .fingerprints import fingerprint_pairs
from .hard_negatives import hard_negatives
from .html_blocks import extract
from .langid import predict_language
from .mixing import mixed
from .near_dedup import near_groups
from .packing import packed
from .quality import quality
from .ring import sharded
from .simhash import simhash_groups
from .substring_dedup import repeats

SHARDS = 40
#: four fifths of all tokens; English half as dear as the other languages together
MIX = {"percent": 80, "max_epochs": 2, "seed": 7,
       "weights": {"domain": {"d0": 2, "d1": 1, "d2": 1}, "lang": {"en": 3}}}

LLM_QUERIES: dict = {}
LLM_ORACLE: dict[str, str] = {}


def query(fn):
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_mcd(spark, sf_dir):
    """Word statistics and the robust outlier verdict of every document."""
    return quality(read_table(spark, sf_dir, "documents"))


@query
def op4_superminhash(spark, sf_dir):
    """Near-duplicate components of all documents at similarity 0.85."""
    return near_groups(read_table(spark, sf_dir, "documents"))


@query
def op9_suffix_trees(spark, sf_dir):
    """Words left of every document without its repeated 35-word passages."""
    return repeats(read_table(spark, sf_dir, "documents"))


@query
def op6_hash_ring(spark, sf_dir):
    """All documents in 40 shards whose counts differ by one at most."""
    out = sharded(read_table(spark, sf_dir, "documents"), SHARDS)
    return out.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query
def op7_mixing(spark, sf_dir):
    """The documents taken to the target weights, one row per epoch."""
    return mixed(read_table(spark, sf_dir, "documents"), **MIX).select(
        F.col("row.doc_id").alias("doc_id"), "domain", "lang", "source", "n_tokens", "epoch")


@query
def op8_best_fit(spark, sf_dir):
    """Every document's pieces and their places in sequences of 4096 tokens."""
    return packed(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def pipeline(spark, sf_dir):
    """All stages of corpus_pipeline.py applied to documents."""
    import corpus_pipeline  # which uses this module's parameters
    return corpus_pipeline.run(spark, sf_dir)


@query
def op2_weighted_sampling(spark, sf_dir):
    """Fingerprints of every text and its edited form."""
    return fingerprint_pairs(read_table(spark, sf_dir, "documents"))


@query
def op10_marginal_unigrams(spark, sf_dir):
    """The language of every document."""
    return predict_language(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_block_tree(spark, sf_dir):
    """The main text of every page."""
    return extract(read_table(spark, sf_dir, "pages"))


@query
def op3_attention_lm(spark, sf_dir):
    """Base and model scores of every document."""
    return scored(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), lower=True)


@query
def op11_shared_lists(spark, sf_dir):
    """Hard negatives of every anchor's positives."""
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


LLM_ORACLE["op11_shared_lists"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
         list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (
  select * from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (
  select p.anchor_id, p.id as positive_id, s.id as negative_id, p.score as positive_score, s.score as negative_score,
         row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id) as rank
  from p join s on s.anchor_id = p.anchor_id and not s.same
    and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 5
"""


@query
def op12_deletion_simhash(spark, sf_dir):
    """SimHash fingerprints of all documents and the components of those that differ by two bits at most."""
    return simhash_groups(read_table(spark, sf_dir, "documents"))


@query
def op13_burst_trie(spark, sf_dir):
    """The nodes of the trie of all rebuilt conversations."""
    return trie_nodes(read_table(spark, sf_dir, "conversations"))
