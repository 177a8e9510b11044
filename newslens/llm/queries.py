"""Registered queries of the operators, over whole tables and with production parameters, and SQL twins where SQL can."""

from __future__ import annotations

from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.llm import bpe, hard_negatives, html_text, language_mix, license_scan, line_dedup, near_dups, packing, quality, repeats, runs, token_files, top_k
from newslens.session import working_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """All documents without the bytes of repeats of 200 bytes."""
    docs = table(spark, sf, "documents")
    return repeats.digests(docs, repeats.repeated_spans(docs, working_path(spark, "repeats")))


def op2_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """BPE by merge rounds and back again, as digests of every document."""
    return bpe.round_trip_digests(table(spark, sf, "documents"), VOCABULARY)


def op3_html_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.main_text(table(spark, sf, "pages"))


def op4_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Licence rules over all documents."""
    return license_scan.scan(table(spark, sf, "documents"))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality rules on all documents, with bands from all documents."""
    rows = quality.quality(table(spark, sf, "documents"), VOCABULARY, PIECES, working_path(spark, "quality"), ["doc_id"])
    return rows.select("doc.doc_id", *[c for c in rows.columns if c != "doc"])


def op6_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The ten best of all vectors for every hundredth."""
    vectors = top_k.whole_numbers(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return top_k.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """All documents written as token files and read back."""
    path = working_path(spark, "token-files")
    return token_files.write(table(spark, sf, "documents"), VOCABULARY, path, end_id=0).digests()


def op8_near_dups(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of near duplicates of all documents."""
    return near_dups.classes(table(spark, sf, "documents"), working_path(spark, "near-dups")).select("doc_id", "class_id")


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """All documents without the lines that ten or more of them have."""
    docs = table(spark, sf, "documents")
    return line_dedup.digests(docs, line_dedup.keep_bitmaps(docs, working_path(spark, "line-dedup"), 10, keep_first=False))


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents packed into sequences of 1,024 tokens."""
    _, places = packing.pack(table(spark, sf, "documents"), VOCABULARY, working_path(spark, "packing"), end_id=2)
    return places.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all; labels of every seventh are shifted by one."""
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    vectors = hard_negatives.whole_numbers(table(spark, sf, "embeddings"), 256, "vec_id", "embedding", label)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, working_path(spark, "hard-negatives"))


def op12_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Languages of all documents, learned from four fifths of them; null ids are held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    found = language_mix.mixtures(docs, language_mix.fit(docs, ~held_out), ["doc_id"])
    return found.select("doc.doc_id", "lang_pred", "score").withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def _with_periods(doc_id: object, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents become periodic behind some word, as the hash of their id says; a null id changes nothing."""
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op13_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of words of all documents."""
    return runs.digests(runs.word_runs(table(spark, sf, "documents"), rewritten=_with_periods))


QUERIES = {
    query.__name__: query
    for query in (
        op1_repeats,
        op2_bpe_round_trip,
        op3_html_text,
        op4_license_scan,
        op5_quality,
        op6_top_k,
        op7_token_files,
        op8_near_dups,
        op9_line_dedup,
        op10_packing,
        op11_hard_negatives,
        op12_languages,
        op13_runs,
    )
}

#: SQL twins for DuckDB.
STATEMENTS: dict[str, str] = {
    "op6_top_k": """
        with numbers as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
            from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select q.vec_id as query_id, c.vec_id,
                cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
            from numbers q join numbers c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
        )
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
        from scored qualify rank <= 10
    """,
    "op9_line_dedup": r"""
        with lines as (
            select doc_id, pos, parts[pos] as line, translate(trim(parts[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
            from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents) d,
                lateral (select unnest(range(1, len(d.parts) + 1)) as pos) p
        ),
        gone as (
            select line_key from lines where line_key <> '' group by line_key having count(distinct doc_id) >= 10
        )
        select doc_id, count(*)::bigint as n_lines, count(gone.line_key)::bigint as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where gone.line_key is null), '')) as kept_sha256
        from lines left join gone on lines.line_key = gone.line_key
        group by doc_id
    """,
    "op11_hard_negatives": """
        with numbers as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same_label,
                cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) as bigint) as score
            from numbers a join numbers c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id
        ),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scored where same_label
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        )
        select p.anchor_id, p.positive_id,
            cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as integer) as rank,
            s.vec_id as negative_id, p.positive_score, s.score as negative_score
        from positives p join scored s on s.anchor_id = p.anchor_id and not s.same_label
            and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
        qualify rank <= 5
    """,
}
