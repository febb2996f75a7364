"""The registered queries of these operators, each over its whole tables with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirstone.llm import (
    alignment,
    bottom_k,
    linear_grouping,
    nbsvm,
    ngram_rules,
    periodic_runs,
    pitman_yor,
    pivot_distance,
    secret_scan,
    separator_scan,
    source_divergence,
    suffix_levels,
    zip_warc,
)
from weirstone.llm.runtime import ship
from weirstone.session import configure

GOOD = 0.7


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_separator_scan(spark: SparkSession, folder: str) -> DataFrame:
    return separator_scan.count(_table(spark, folder, "documents"), vocabulary())


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")

    def joined(kinds: tuple[str, ...]) -> F.Column:
        chosen = F.filter("secrets", lambda s: s["kind"].isin(*kinds))
        return F.concat_ws(",", F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def number(kind: str) -> F.Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = secret_scan.KINDS[:3]
    counts = [number(kind) for kind in base]
    return secret_scan.scan(docs).select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(secret_scan.KINDS).alias("spans")
    )


def op4_nb_svm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = nbsvm.learn(docs, _table(spark, folder, "labels"))
    return nbsvm.score(docs, model).select(
        "doc_id",
        nbsvm.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op6_log_ratio_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    trusted = _table(spark, folder, "labels").where("quality = 1")
    return ngram_rules.rules(docs, ngram_rules.ratios(docs, trusted))


def op3_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pitman_yor.score(docs.select("doc_id", "text", nbsvm.held_out(F.col("doc_id"), 7, 2).alias("held_out")))


def op5_zip_warc(spark: SparkSession, folder: str) -> DataFrame:
    return zip_warc.round_trip(_table(spark, folder, "pages"))


def op7_suffix_levels(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_levels.remove_repeats(_table(spark, folder, "documents")).drop("kept_text")


def op8_linear_grouping(spark: SparkSession, folder: str) -> DataFrame:
    return linear_grouping.pack(_table(spark, folder, "documents"), vocabulary())


def op9_rare_seed_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.matches(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    return bottom_k.near_duplicates(_table(spark, folder, "documents"))


def op11_pivot_distance(spark: SparkSession, folder: str) -> DataFrame:
    index = pivot_distance.build(_table(spark, folder, "embeddings"))
    return pivot_distance.search(index, F.col("vec_id") % 50 == 0, 5, spark)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, chosen by id, end in a repetition; a document without id stays as it is."""
    if doc_id is None or not words or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g, n = h // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + [words[start + i % period] for i in range(n - start)]


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.collapse(_table(spark, folder, "documents"), planted)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    # the least of (-length, start, period) is the longest run
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.expr("(-1000 * best.l) div best.p").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_separator_scan": op1_separator_scan,
    "op2_secret_scan": op2_secret_scan,
    "op3_pitman_yor": op3_pitman_yor,
    "op4_nb_svm": op4_nb_svm,
    "op5_zip_warc": op5_zip_warc,
    "op6_log_ratio_rules": op6_log_ratio_rules,
    "op7_suffix_levels": op7_suffix_levels,
    "op8_linear_grouping": op8_linear_grouping,
    "op9_rare_seed_alignment": op9_rare_seed_alignment,
    "op10_bottom_k": op10_bottom_k,
    "op11_pivot_distance": op11_pivot_distance,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_source_divergence": op13_source_divergence,
}
#: Check SQL where SQL can say it; the other queries have brute-force tests.
SQL: dict[str, str] = {
    "op5_zip_warc": """
        with digits as (
            select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages
        ),
        named as (
            select *, array_to_string(list_transform(range(32), lambda i: substr(
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + (((('0x' || substr(h, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31))::int, 1)), '') as payload_digest,
                max(page_id) over (partition by h) as first
            from digits
        )
        select page_id, payload_bytes, payload_digest,
               case when page_id is not distinct from first then 'response' else 'revisit' end as record_type,
               case when page_id is distinct from first then first end as refers_to
        from named
    """,
    "op10_bottom_k": r"""
        with recursive docs as (
            select doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
            ), lambda w: w <> '') as w
            from documents
        ),
        sets as (
            select doc_id, case
                when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
                when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
            from docs
        ),
        items as (select doc_id, len(s) as n, unnest(s) as g from sets),
        shared as (
            select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as k
            from items a join items b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
        ),
        links as (select a, b from shared where 100 * k >= 75 * (n + m - k)),
        edges as (select a, b from links union all select b, a from links),
        reach(doc_id, other) as (
            select doc_id, doc_id from docs union select r.doc_id, e.b from reach r join edges e on e.a = r.other
        ),
        least as (select doc_id, min(other) as component_id from reach group by doc_id)
        select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept
        from sets join least using (doc_id)
    """,
    "op11_pivot_distance": """
        with usable as (
            select row_number() over () as own, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select q.own, q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score, c.own as other
            from usable q join usable c on q.own <> c.own
            where q.vec_id % 50 = 0
        )
        select query_id, row_number() over (partition by own order by score desc, vec_id, other)::int as rank, vec_id, score
        from scored
        qualify rank <= 5
    """,
    "op13_source_divergence": r"""
        with docs as (
            select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
            from documents
        ),
        words as (
            select d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
        ),
        kept as (select lang, term, count(*) as total from words group by all having count(distinct d) >= 30),
        v as (select lang, count(*) as v, sum(total) as n from kept group by all),
        groups as (select distinct lang, source from docs),
        counted as (select lang, source, term, count(*) as c from words group by all),
        cells as (
            select g.lang, g.source, k.term, k.total, coalesce(c.c, 0) as c
            from groups g join kept k using (lang) left join counted c using (lang, source, term)
        ),
        sums as (select lang, source, sum(c) as n from cells group by all),
        ps as (
            select lang, source, term, c,
                   1 + (1000000000 * (c + 5)::hugeint) // (s.n::hugeint + 5 * v.v) as p,
                   1 + (1000000000 * (total + 5)::hugeint) // (v.n::hugeint + 5 * v.v) as q
            from cells join sums s using (lang, source) join v using (lang)
        ),
        apart as (
            select a.lang, a.source, b.source as item, sum(abs(a.p - b.p))::bigint as value
            from ps a join ps b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
        ),
        pairs as (
            select g.lang, g.source, 'pair' as part, h.source as item, coalesce(a.value, 0) as value
            from groups g join groups h on g.lang = h.lang and g.source <> h.source
            left join apart a on a.lang = g.lang and a.source = g.source and a.item = h.source
        ),
        terms as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from ps where c > 0 and p > q),
        ranked as (
            select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
            from (select * from pairs union all select * from terms)
        )
        select * from ranked where part = 'pair' or rank <= 50
    """,
}
