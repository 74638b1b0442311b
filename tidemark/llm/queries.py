"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import report
from tidemark.llm.helpers import shared_folder, table
from tidemark.llm.lexical import rank_documents
from tidemark.llm.licenses import license_notices
from tidemark.llm.merkle import verify_tampered
from tidemark.llm.near_duplicates import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.prefix_bpe import digests
from tidemark.llm.quality import score_quality, train_quality
from tidemark.llm.repeats import remove_repeats
from tidemark.llm.secrets import constructed_findings, findings, train_secrets
from tidemark.llm.sharding import shuffle_into_shards
from tidemark.llm.topk import top_products
from tidemark.llm.warc import archive_pages


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The file of a public tokenizer, at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out():
    """A third of the documents, by a checksum of their ids, whose labels the classifier does not see."""
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def op1_license_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices(table(spark, sf_dir, "documents"))


def op2_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = score_quality(docs, train_quality(docs.filter(~held_out()), labels.filter(~held_out())))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op5_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, vectors.filter("vec_id % 100 = 0"), 10)


def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = train_secrets(constructed_findings(docs)).judge(findings(docs))
    return judged.select(
        "doc_id", "start", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "probability", "secret"
    )


def op8_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = archive_pages(table(spark, sf_dir, "pages"), shared_folder(spark, "archives"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shuffle_into_shards(table(spark, sf_dir, "documents"))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_hybrid_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)
    return found.select("item_id", "rank", "doc_id", "score")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_tampered(table(spark, sf_dir, "documents"))


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_compression": op1_license_compression,
    "op2_quality_nbsvm": op2_quality_nbsvm,
    "op3_repeated_strings": op3_repeated_strings,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_benchmark_containment": op5_benchmark_containment,
    "op6_norm_bucket_topk": op6_norm_bucket_topk,
    "op7_secret_forest": op7_secret_forest,
    "op8_warc_zstd": op8_warc_zstd,
    "op9_hypergeometric_shards": op9_hypergeometric_shards,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_hybrid_ranking": op11_hybrid_ranking,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_bpe": op13_prefix_bpe,
}

_SHINGLES = """
    unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)"""

#: Word pattern and lower case as in the operator: of A-Z alone.
_WORDS = r"""
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

ORACLES: dict[str, str] = {
    "op4_minhash_near_dedup": f"""
        with recursive words as (select doc_id, {_WORDS} w from documents),
        sets as (
            select distinct doc_id, {_SHINGLES} s from words),
        sizes as (select doc_id, count(*) n from sets group by doc_id),
        common as (
            select a.doc_id a, b.doc_id b, count(*) c from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id
            group by 1, 2),
        links as (
            select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * c >= 85 * (x.n + y.n - c)),
        reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
        least as (select a doc_id, min(b) m from reach group by a)
        select d.doc_id, coalesce(n, 0)::bigint n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) component_id,
            d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) kept
        from documents d left join sizes using (doc_id) left join least using (doc_id)""",
    "op5_benchmark_containment": f"""
        with i as (
            select distinct item_id, {_SHINGLES} s from (select item_id, {_WORDS} w from benchmark)),
        d as (select distinct doc_id, {_SHINGLES} s from (select doc_id, {_WORDS} w from documents)),
        n as (select item_id, count(*) n from i group by 1),
        c as (select doc_id, item_id, count(*) c from d join i using (s) group by 1, 2),
        f as (
            select doc_id, item_id, c / n containment, count(*) over (partition by doc_id) n_items,
                row_number() over (partition by doc_id order by c / n desc, item_id) nth
            from c join n using (item_id) where c / n >= 0.8)
        select d.doc_id, coalesce(n_items, 0)::bigint n_items, item_id, containment
        from documents d left join f on f.doc_id = d.doc_id and nth = 1""",
    "op6_norm_bucket_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::hugeint) x from embeddings
            where vec_id is not null and embedding is not null and len(embedding) > 0
                and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
        s as (
            select q.vec_id query_id, c.vec_id vec_id,
                list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::bigint score
            from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int rank from s)
        select query_id, rank, vec_id, score from r where rank <= 10""",
    "op8_warc_zstd": """
        with p as (
            select page_id, octet_length(encode(coalesce(html, '')))::bigint payload_bytes,
                sha1(coalesce(html, '')) payload_digest from pages),
        l as (
            select payload_digest, payload_bytes, max(page_id) last from p where payload_bytes >= 1000 group by all)
        select page_id, p.payload_bytes, p.payload_digest,
            case when page_id < last then 'revisit' else 'response' end record_type,
            case when page_id < last then last end refers_to
        from p left join l using (payload_digest, payload_bytes)""",
    "op11_hybrid_ranking": r"""
        with t as (
            select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from documents),
        q as (
            select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark),
        c as (select count(distinct doc_id) n, count(*) l from t),
        sizes as (select doc_id, count(*) n from t group by 1),
        tf as (select doc_id, term, count(*) tf from t group by 1, 2),
        w as (select term, floor(1000 * ln((2.0::double * any_value(c.n) + 2) / (2.0::double * count(*) + 1)))::bigint w from tf, c group by term),
        s as (
            select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * sizes.n * c.n) // c.l))))::bigint score
            from q join tf using (term) join w using (term) join sizes using (doc_id), c group by 1, 2),
        r as (select *, row_number() over (partition by item_id order by score desc, doc_id)::int rank from s where score > 0)
        select item_id, rank, doc_id, score from r where rank <= 20""",
    "op12_merkle_manifest": """
        with recursive c as (
            select *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
                lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                    lambda r, z: xor(r >> 1, (r & 1) * 3988292384::bigint))), 4294967295::bigint) crc
            from documents),
        f as (
            select doc_id, source,
                concat(coalesce(octet_length(encode(doc_id::varchar)) || ':' || doc_id, '-'),
                    coalesce(octet_length(encode(source)) || ':' || source, '-'), coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
                    coalesce(octet_length(encode(n_chars::varchar)) || ':' || n_chars, '-')) head,
                text, case when crc % 2 = 0 then replace(text, chr(10), '') else text end tampered from c),
        l as (
            select doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) leaf,
                sha256(head || coalesce(octet_length(encode(tampered)) || ':' || tampered, '-')) changed from f),
        p as (
            select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 pos,
                count(*) over (partition by source) n from l),
        t as (
            select 0 lvl, source, pos, n, leaf h from p
            union all
            select lvl + 1, source, pos // 3, max((n + 2) // 3), sha256(string_agg(h, '' order by pos))
            from t where n > 1 group by lvl, source, pos // 3),
        sub as (
            select source, h, row_number() over (order by source is not null, encode(source)) - 1 pos, count(*) over () n from t where n = 1),
        u as (
            select 0 lvl, pos, n, h from sub
            union all
            select lvl + 1, pos // 3, max((n + 2) // 3), sha256(string_agg(h, '' order by pos)) from u where n > 1 group by lvl, pos // 3),
        s as (  -- siblings of every leaf on every level of its source, and of the tree above
            select p.doc_id, p.leaf, p.source, t.lvl, false upper,
                coalesce(string_agg(t.h, '' order by t.pos) filter (t.pos < p.pos // (3 ** t.lvl)::bigint), '') lt,
                coalesce(string_agg(t.h, '' order by t.pos) filter (t.pos > p.pos // (3 ** t.lvl)::bigint), '') rt
            from p join t on t.source is not distinct from p.source and t.n > 1 and t.pos // 3 = p.pos // (3 ** (t.lvl + 1))::bigint
            group by all
            union all
            select p.doc_id, p.leaf, p.source, u.lvl, true,
                coalesce(string_agg(u.h, '' order by u.pos) filter (u.pos < b.pos // (3 ** u.lvl)::bigint), ''),
                coalesce(string_agg(u.h, '' order by u.pos) filter (u.pos > b.pos // (3 ** u.lvl)::bigint), '')
            from p join sub b on b.source is not distinct from p.source
                join u on u.n > 1 and u.pos // 3 = b.pos // (3 ** (u.lvl + 1))::bigint group by all),
        way as (
            select doc_id, leaf, source, list({'l': lt, 'r': rt} order by upper, lvl) path,
                sha256(string_agg(lt || rt, '' order by upper, lvl)) proof from s group by all)
        select p.doc_id, p.leaf, sub.h subroot, top.h root, coalesce(proof, sha256('')) proof_sha256,
            list_reduce(list_prepend({'l': changed, 'r': ''}, coalesce(path, [])),
                lambda x, y: {'l': sha256(y.l || x.l || y.r), 'r': ''}).l folded_root,
            folded_root = top.h verified
        from p join sub on sub.source is not distinct from p.source join u top on top.n = 1
            left join way on way.doc_id = p.doc_id and way.leaf = p.leaf and way.source is not distinct from p.source""",
}
