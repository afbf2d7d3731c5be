"""The operators bound to the given tables: one query each, with its SQL where SQL can say it."""

import public_tokenizers

from tallyhouse.llm import (
    base, byte_bpe, chosen_path, decontamination, html_text, importance, language_id, ngram_join, quality_cnn, quality_rules,
    substring_dedup, token_shards, toxicity, whitening,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = base.crc_remainder("doc_id", 5) == 0
    return language_id.predict(docs, language_id.learn(docs.where(~held_out)), held_out)


def op2_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op3_decontamination(spark, sf_dir):
    return decontamination.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_quality_classifier(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = base.crc_remainder("doc_id", 4) == 2
    return quality_cnn.quality_report(docs, quality_cnn.learn(docs, labels.where(~held_out)), held_out)


def op5_token_shards(spark, sf_dir):
    return token_shards.token_report(_table(spark, sf_dir, "documents"), TOKENIZER)


def op6_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = base.crc_remainder("doc_id", 5) == 0
    return toxicity.toxicity_report(docs, toxicity.learn(docs, labels.where(~held_out)), held_out)


def op7_html_extraction(spark, sf_dir):
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op8_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.near_duplicate_groups(_table(spark, sf_dir, "documents")).drop("text_key")


def op9_quality_rules(spark, sf_dir):
    trusted = quality_rules.trusted_ids(_table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"), trusted)


def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.removal_report(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark, sf_dir):
    return whitening.whitening_report(_table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark, sf_dir):
    return importance.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_minhash_near_dedup(spark, sf_dir):
    return chosen_path.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_byte_bpe, op3_decontamination, op4_quality_classifier, op5_token_shards, op6_toxicity,
        op7_html_extraction, op8_ngram_jaccard_join, op9_quality_rules, op10_substring_dedup,
        op11_embedding_whitening, op12_importance_resampling, op13_minhash_near_dedup,
    )
}

ORACLE_SQL = {
    "op8_ngram_jaccard_join": r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w
  from documents
), grams as (
  select distinct doc_id, unnest(case
    when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) g
  from words
), sizes as (
  select doc_id, count(*) n from grams group by doc_id
), shared as (
  select x.doc_id a, y.doc_id b, count(*) k from grams x join grams y on x.g = y.g and x.doc_id < y.doc_id group by all
), links as (
  select a, b from shared join sizes p on a = p.doc_id join sizes q on b = q.doc_id
  where 100 * k >= 75 * (p.n + q.n - k)
), both_ways as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id, doc_id c from documents union select b, c from reach join both_ways on doc_id = a
)
select d.doc_id, cast(coalesce(any_value(n), 0) as bigint) n_shingles, min(c) component_id
from documents d left join sizes s on d.doc_id = s.doc_id join reach r on d.doc_id = r.doc_id group by d.doc_id
""",
    "op10_substring_dedup": r"""
with words as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w
  from documents
), windows as (
  select doc_id, unnest(range(1, len(w) - 33)) i, w from words
), keyed as (
  select doc_id, i, array_to_string(w[i:i + 34], ' ') g from windows
), repeated as (
  select doc_id, i from keyed where g in (select g from keyed group by g having count(*) > 1)
), covered as (
  select distinct doc_id, i + unnest(range(0, 35)) p from repeated
), gone as (
  select doc_id, list(p) ps from covered group by doc_id
), kept as (
  select doc_id, w, list_filter(w, lambda x, p: not list_contains(coalesce(ps, []), p)) k
  from words left join gone using (doc_id)
)
select doc_id, cast(len(w) as bigint) n_words, cast(len(w) - len(k) as bigint) n_removed,
  sha256(array_to_string(k, ' ')) kept_sha256
from kept
""",
    "op12_importance_resampling": r"""
with crc_table as (
  select list_transform(range(256), lambda i: list_reduce(
    range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) t
), words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from documents
), target_words as (
  select unnest(list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) f
  from benchmark
), features as (
  select doc_id, unnest(w) f from words
), buckets as (
  select f, xor(list_reduce(
    list_transform(range(strlen(f)), lambda i: cast('0x' || substr(hex(encode(f)), 2 * i + 1, 2) as bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), cast(4294967295 as bigint)), 4294967295) % 10000 b
  from (select f from features union select f from target_words), crc_table
), corpus_counts as (
  select b, count(*) s from features join buckets using (f) group by b
), target_counts as (
  select b, count(*) t from target_words join buckets using (f) group by b
), sums as (
  select (select count(*) from features) cs, (select count(*) from target_words) ts
), gains as (
  select b, cast(floor(1000 * ln((coalesce(t, 0) + 1)::double * (cs + 10000)::double
    / ((s + 1)::double * (ts + 10000)::double))) as bigint) g
  from corpus_counts left join target_counts using (b), sums
), weights as (
  select doc_id, cast(sum(g) as bigint) total, count(*) n
  from features join buckets using (f) join gains using (b) group by doc_id
), scores as (
  select doc_id, cast(coalesce(n, 0) as bigint) n_features,
    cast(case when n is null then 0 else (total - ((total % n) + n) % n) // n end as bigint) weight,
    cast(('0x' || substr(sha256('2024:' || doc_id), 1, 8)) as bigint) h
  from documents left join weights using (doc_id)
), scored as (
  select doc_id, n_features, weight,
    weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) score
  from scores
), placed as (
  select doc_id, row_number() over (order by score desc, doc_id) place, count(*) over () n_all
  from scored where n_features >= 20
)
select s.doc_id, n_features, weight, score, case when place <= 10 * n_all // 100 then place end rank
from scored s left join placed p on s.doc_id = p.doc_id
""",
    "op13_minhash_near_dedup": r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w
  from documents
), grams as (
  select distinct doc_id, unnest(case
    when len(w) >= 2 then list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) g
  from words
), sizes as (
  select doc_id, count(*) n from grams group by doc_id
), numbered as (
  select doc_id, n, g, row_number() over (partition by doc_id order by holders, g) place
  from grams join sizes using (doc_id) join (select g, count(*) holders from grams group by g) using (g)
), prefixes as (
  select doc_id, n, g from numbered where place <= n - (80 * n + 99) // 100 + 1
), candidates as (
  select distinct x.doc_id a, y.doc_id b, x.n na, y.n nb from prefixes x join prefixes y on x.g = y.g and x.doc_id < y.doc_id
  where 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
), links as (
  select a, b from candidates join grams x on x.doc_id = a join grams y on y.doc_id = b and x.g = y.g
  group by a, b, na, nb having 100 * count(*) >= 80 * (na + nb - count(*))
), both_ways as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id, doc_id c from documents union select b, c from reach join both_ways on doc_id = a
), groups as (
  select doc_id, min(c) component_id from reach group by doc_id
)
select d.doc_id, cast(coalesce(n, 0) as bigint) n_shingles, component_id, d.doc_id = component_id kept
from documents d left join sizes s on d.doc_id = s.doc_id join groups g on d.doc_id = g.doc_id
""",
}
