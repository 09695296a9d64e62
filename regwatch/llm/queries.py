"""The registered queries of the text operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exact, fingerprint, lang, lm, near, negatives, packing, pii, substring, toxicity, trie, warc

#: Vocabulary of the packing query; the file is never part of this library.
VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary())


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.find_duplicates(_table(spark, sf_dir, "documents"))


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.derive(warc.responses(_table(spark, sf_dir, "pages")))
    source = lambda kind: F.col("headers")[f"X-Source-{kind}-Digest"].alias(f"source_{kind.lower()}_digest")
    return made.select(*(c for c in made.columns if c != "headers"), source("Payload"), source("Block"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classes(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang.identify(_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(_table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_tree(_table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edits(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_exact_dedup, op3_warc_derivatives, op4_minhash_near_dedup, op5_toxicity, op6_substring_dedup, op7_decontamination, op8_language_id, op9_pii, op10_lm_scoring, op11_prefix_trie, op12_hard_negatives, op13_fingerprints)}

#: An id from a hash h, as the WARC operator cuts it.
_UUID = "'urn:uuid:' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-8' || substr(h, 18, 3) || '-' || substr(h, 21, 12)"

ORACLES = {
    "op2_exact_dedup": r"""
        with t as (select doc_id, length(coalesce(text, '')) n,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) h from documents),
        g as (select *, count(*) over (partition by h) group_size,
                     first_value(doc_id) over (partition by h order by n desc, doc_id nulls last) keep_id from t)
        select doc_id, keep_id, cast(group_size as bigint) group_size, doc_id is not distinct from keep_id as kept, h text_sha256 from g
    """,
    "op3_warc_derivatives": rf"""
        with p as (select url, coalesce(html, '') html from pages),
        r as (select url, html, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || chr(13) || chr(10) || html as block from p),
        s as (select *, 'sha256:' || sha256(html) as pd, 'sha256:' || sha256(block) as bd, sha256('response' || chr(10) || coalesce(url, '') || chr(10) || '{warc.UNDATED}' || chr(10) || chr(10) || block) as h from r),
        a as (select *, {_UUID} as source, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'),
              '(?is)</?(?:{warc.BLOCKS})\b[^>]*>', chr(10), 'g'), '(?s)<[a-zA-Z/!?][^>]*>', '', 'g') as t from s),
        b as (select *, replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&') as u from a),
        c as (select *, regexp_replace(regexp_replace(regexp_replace(u, '[ \t\r\f\x0B]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g') as text from b),
        m as (select 'conversion' as kind, 'text/plain; charset=utf-8' as ct, *, text as body from c
              union all select 'metadata', 'application/warc-fields', *, 'http-status: 200' || chr(13) || chr(10) || 'http-header-content-type: text/html; charset=utf-8' || chr(13) || chr(10)
                || 'payload-characters: ' || cast(length(html) as varchar) || chr(13) || chr(10) || 'text-characters: ' || cast(length(text) as varchar) || chr(13) || chr(10)
                || 'title: ' || trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1), '\s+', ' ', 'g')) || chr(13) || chr(10) from c),
        n as (select kind, ct, url, source, pd, bd, body, sha256(kind || chr(10) || coalesce(url, '') || chr(10) || '{warc.UNDATED}' || chr(10) || source || chr(10) || body) as h from m)
        select {_UUID} as record_id, kind as warc_type, url as target_uri, '{warc.UNDATED}' as warc_date, source as refers_to, ct as content_type,
               'sha256:' || sha256(body) as payload_digest, 'sha256:' || sha256(body) as block_digest, body as block, pd as source_payload_digest, bd as source_block_digest from n
    """,
    "op11_prefix_trie": r"""
        with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                          row_number() over (partition by conv_id order by turn nulls first, left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32)) as i
                   from conversations where conv_id is not null),
        c as (select distinct conv_id, list_reduce(list_prepend(cast(4294967295 as bigint), flatten(list_transform(string_split(cast(conv_id as varchar), ''), lambda x: [cast(ascii(x) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
                  lambda a, x: case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a >> 1, cast(3988292384 as bigint)) else a >> 1 end) as crc from t),
        h as (select conv_id, xor(crc, cast(4294967295 as bigint)) % 4 as h, conv_id - conv_id % 20 as base from c),
        r as (select h.conv_id, 0 as part, i, role, text from h join t on t.conv_id = h.base and i <= h union all select h.conv_id, 1, i, role, text from h join t on t.conv_id = h.conv_id and i > h),
        s as (select conv_id, row_number() over (partition by conv_id order by part, i) as d, role, text from r),
        q as (select conv_id, d, text, sha256(string_agg(sha256(length(role) || ':' || role || text), '' order by d) over (partition by conv_id order by d rows unbounded preceding)) as node from s
              union all select conv_id, 0, null, '' from c),
        n as (select d, node, min(conv_id) as conv_id, count(*) as n_convs, any_value(text) as text from q group by 1, 2),
        m as (select conv_id, max(d) as d from q group by 1), e as (select q.d, q.node, string_agg(cast(m.conv_id as varchar), ',' order by m.conv_id) as ids from m join q on q.conv_id = m.conv_id and q.d = m.d group by 1, 2),
        u as (select n.*, a.node as above, coalesce(n.n_convs - 1, 0) * len(regexp_extract_all(coalesce(n.text, ''), '[^\x20\x09-\x0D]+')) as saved, p.conv_id as parent_conv_id
              from n left join q a on a.conv_id = n.conv_id and a.d = n.d - 1 left join n p on p.d = a.d and p.node = a.node),
        k as (select d - 1 as d, above as node, count(*) as n_children from u where d > 0 group by 1, 2),
        v as (select a.d, a.node, sum(u.saved) as saved_tokens, count(*) filter (k.node is null) as n_leaves from u join q a on a.conv_id = u.conv_id and a.d <= u.d left join k on k.d = u.d and k.node = u.node group by 1, 2)
        select u.conv_id, cast(u.d as bigint) as depth, u.parent_conv_id, cast(u.n_convs as bigint) as n_convs, cast(coalesce(k.n_children, 0) as bigint) as n_children, cast(v.n_leaves as bigint) as n_leaves,
               cast(v.saved_tokens as bigint) as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
        from u join v using (d, node) left join k using (d, node) left join e using (d, node)
    """,
    "op12_hard_negatives": """
        with k as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
                   where label is not null and embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
        s as (select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, cast(list_inner_product(a.v, r.v) as bigint) as score from k a join k r on a.vec_id <> r.vec_id where a.vec_id % 50 = 0),
        p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
        n as (select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
                     row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as rank
              from p join s on s.anchor_id = p.anchor_id and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
        select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 3
    """,
    "op6_substring_dedup": r"""
        with p as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
        w as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i from p),
        v as (select doc_id, k, array_to_string(ws[k:k + 49], ' ') as x from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as k from p where len(ws) >= 50) q),
        f as (select x, min(doc_id) as lo from v group by 1), h as (select doc_id, k from v join f using (x) where doc_id > lo),
        g as (select distinct doc_id, k + j as i from h cross join (select unnest(range(0, 50)) as j) r),
        k as (select w.doc_id, string_agg(word, ' ' order by i) as kept, count(*) as n from w anti join g using (doc_id, i) group by 1)
        select p.doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(k.n, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from p left join k on k.doc_id = p.doc_id
    """,
}
