"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from txlake.llm import chat_formatting, token_store
from txlake.llm.contamination import leaks
from txlake.llm.html_extraction import extract_pages
from txlake.llm.line_dedup import dedup_lines
from txlake.llm.merkle_manifest import audit, build_manifest
from txlake.llm.near_duplicates import near_duplicates
from txlake.llm.packing import pack_documents
from txlake.llm.pairwise_quality import score_quality, train_ranking
from txlake.llm.quality_rules import quality_rules
from txlake.llm.periodic_runs import periodic_runs
from txlake.llm.personal_data import find_personal_data, labelled_table, train_tagger
from txlake.llm.substring_dedup import remove_repeats
from txlake.llm.working import ship_package, stored

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        LLM_QUERIES[name] = run
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


@query("op2_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, placed = pack_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query("op3_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
        F.size("span_starts").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op4_quality_rules")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_token_store")
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = token_store.write_tokens(docs)
    found = token_store.lookup(store, token_store.keys_of(docs))
    read = token_store.read_ids(store, found, checksums=True)
    return read.join(token_store.shard_starts(store.blocks), "shard").select(
        F.nullif("doc_id", F.lit(token_store.NO_ID)).alias("doc_id"),
        (F.col("before") + F.col("start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


@query("op6_near_duplicate_join")
def near_duplicate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_pairwise_quality")
def pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_ranking(docs, table(spark, sf_dir, "labels")))


@query("op8_chat_formatting")
def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    messages = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], messages.schema
    )
    written = stored(
        chat_formatting.format_conversations(messages.unionByName(extra)), "conversations"
    )
    return chat_formatting.read_back(written)


@query("op9_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


@query("op10_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_periodic_runs")
def repeated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), trial=True, digests=True)
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.col("runs").alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )


@query("op12_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagger = train_tagger(labelled_table(spark))
    return find_personal_data(table(spark, sf_dir, "documents"), tagger)


@query("op13_merkle_manifest")
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(build_manifest(table(spark, sf_dir, "documents")))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


_ROLE, _TEXT = "coalesce(role, '')", "coalesce(text, '')"
_ESCAPED = r"replace(replace({}, '\', '\b'), '<', '\l')"

LLM_ORACLES: dict[str, str] = {
    "op8_chat_formatting": f"""
        with said as (
            select cast(conv_id as bigint) as conv_id, cast(turn as bigint) as turn,
                {_ROLE} as role, {_TEXT} as text
            from conversations
            union all
            select * from (values
                (-7, 0, 'user', '\\### Assistant: </turn> ok'),
                (-7, 1, 'assistant', '\\### Assistant: </turn> ok')) as v
        ), talks as (
            select conv_id, count(*) as n_turns,
                string_agg(role || chr(10) || text || chr(10), ''
                    order by turn nulls first, role, text) as turns,
                coalesce(string_agg(case when role = 'assistant' then text end, ''
                    order by turn nulls first, role, text), '') as loss,
                sum(length('<turn>' || replace({_ESCAPED.format("role")}, chr(10), '\\n')
                    || chr(10) || {_ESCAPED.format("text")} || '</turn>' || chr(10)))
                    as formatted_chars
            from said group by conv_id
        )
        select conv_id, cast(n_turns as bigint) as n_turns, sha256(turns) as turns_sha256,
            cast(length(loss) as bigint) as loss_chars, sha256(loss) as loss_sha256,
            cast(formatted_chars as bigint) as formatted_chars
        from talks
    """,
    # crc32 byte by byte, and the trees level by level; lists are cut around a node's place.
    "op13_merkle_manifest": f"""
        with recursive docs as (
            select row_number() over () as r, doc_id, lang, source, n_chars, text,
                list_reduce(list_concat([4294967295::bigint],
                    list_transform(string_split(cast(doc_id as varchar), ''),
                        lambda c: cast(ascii(c) as bigint))),
                    lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
                        lambda x, k: xor(x >> 1, (x & 1) * 3988292384))) as crc
            from documents
        ), texts as (
            select *, false as tampered, text as held from docs
            union all
            select *, true, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') from docs where xor(crc, 4294967295) % 3 = 0
        ), digests as (
            select r, doc_id, lang, tampered, sha256({" || ".join(
                f"coalesce(strlen(cast({c} as varchar)) || ':' || {c}, '-')"
                for c in ("doc_id", "source", "lang", "n_chars", "held"))}) as leaf
            from texts
        ), leaves as (
            select d.r, d.doc_id, d.leaf, coalesce(t.leaf, d.leaf) as changed,
                dense_rank() over (order by d.lang nulls first) - 1 as tree,
                row_number() over (partition by d.lang
                    order by d.doc_id nulls first, d.leaf) - 1 as idx,
                count(*) over (partition by d.lang) as n
            from digests d left join digests t on t.r = d.r and t.tampered
            where not d.tampered
        ), nodes as (
            select 0 as level, tree, idx, leaf as digest, n from leaves
            union all
            select level + 1, tree, idx // 8, sha256(string_agg(digest, '' order by idx)),
                (n + 7) // 8
            from nodes where n > 1 group by level, tree, idx // 8, n
        ), runs as (
            select level, tree, idx // 8 as run, list(digest order by idx) as held
            from nodes where n > 1 group by all
        ), subroots as (
            select tree, digest, count(*) over () as n from nodes where n = 1
        ), top as (
            select 0 as level, tree as idx, digest, n from subroots
            union all
            select level + 1, idx // 8, sha256(string_agg(digest, '' order by idx)),
                (n + 7) // 8
            from top where n > 1 group by level, idx // 8, n
        ), top_runs as (
            select level, idx // 8 as run, list(digest order by idx) as held
            from top where n > 1 group by all
        ), walk as (
            select r, 0 as level, tree, idx, n, changed as mine, '' as proof from leaves
            union all
            select r, w.level + 1, w.tree, idx // 8, (n + 7) // 8,
                sha256(array_to_string(list_concat(held[:idx % 8], [mine], held[idx % 8 + 2:]), '')),
                proof || array_to_string(list_concat(held[:idx % 8], held[idx % 8 + 2:]), '')
            from walk w join runs u
                on u.level = w.level and u.tree = w.tree and u.run = w.idx // 8
            where n > 1
        ), walked as (
            select w.r, 0 as level, w.tree as idx, s.n, w.mine, w.proof
            from walk w join subroots s using (tree) where w.n = 1
        ), climb as (
            select * from walked
            union all
            select r, c.level + 1, idx // 8, (n + 7) // 8,
                sha256(array_to_string(list_concat(held[:idx % 8], [mine], held[idx % 8 + 2:]), '')),
                proof || array_to_string(list_concat(held[:idx % 8], held[idx % 8 + 2:]), '')
            from climb c join top_runs u on u.level = c.level and u.run = c.idx // 8
            where n > 1
        )
        select l.doc_id, l.leaf, s.digest as subroot, t.digest as root,
            sha256(c.proof) as proof_sha256, c.mine as folded_root, c.mine = t.digest as verified
        from leaves l join climb c on c.r = l.r and c.n = 1
            join subroots s on s.tree = l.tree join top t on t.n = 1
    """,
}

if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
