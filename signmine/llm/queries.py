"""The operators over their whole tables, with production parameters, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signmine.llm import decontaminate, html, langid, line_dedup, mixing, quality, secrets, simhash, substring_dedup, topk
from signmine.llm.common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over all documents: expected grade, tail chances and selection of each, learnt from the rated ones."""
    return quality.classify(table(spark, sf_dir, "documents"), quality.grade(table(spark, sf_dir, "labels")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over all documents: doc_id, text without repeated chunks, n_chars."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: the ten best inner products of each vector whose id is divisible by 100, against all rows but its own."""
    vectors = topk.quantized(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.pmod("vec_id", F.lit(100)) == 0))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: leaks of any benchmark item in any document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over all documents: counts and digest of the fixed spans, and all spans."""
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over all documents: how many words the mix takes of each, and when."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "position")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over all documents: paragraphs and passages that stand in more than one."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all pages: main text and its length."""
    return html.main_text(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all documents: predicted language and its probability, learnt from those that are not held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over all documents: fingerprint and component of each."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_line_dedup, op3_exact_topk, op4_decontamination, op5_secret_scan, op6_mixing, op7_substring_dedup, op8_html_extraction, op9_language_id, op10_simhash)}

_TOPK_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024.0 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
  where q.vec_id % 100 = 0
), ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

_LINES_SQL = f"""
with recursive docs as (select doc_id, text, n_chars from documents),
line as (
  select doc_id, i, lines[i] as body, cast('0x' || substr(md5(lines[i]), 1, 7) as bigint) as h
  from (select doc_id, string_split(text, chr(10)) as lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from docs)
), ended as (
  select *, case when (h + coalesce(lag(h) over (partition by doc_id order by i), 0) * {line_dedup.BASE}) % {line_dedup.MODULUS} % {line_dedup.DIVISOR} = 0 then 1 else 0 end as ends from line
), placed as (
  select *, coalesce(sum(ends) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as chunk from ended
), chunk as (
  select doc_id, chunk, count(*) as n_lines, string_agg(body, chr(10) order by i) as body from placed group by doc_id, chunk
), first as (
  select body, min({{'doc_id': doc_id, 'chunk': chunk}}) as at from chunk where n_lines >= 2 group by body having count(*) > 1
), stays as (
  select c.doc_id, c.chunk, c.body, (f.at is null or (f.at.doc_id = c.doc_id and f.at.chunk = c.chunk)) as kept
  from chunk c left join first f on c.n_lines >= 2 and c.body = f.body
), rest as (
  select doc_id, coalesce(string_agg(body, chr(10) order by chunk) filter (where kept), '') as text from stays group by doc_id
)
select d.doc_id, case when d.text is null then null else r.text end as text, case when d.text is null then null else cast(length(r.text) as bigint) end as n_chars
from docs d left join rest r on d.doc_id = r.doc_id
"""

_MIX_SQL = """
with doc as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size, md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as key
  from documents
), src as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as place from doc group by source
), weighed as (
  select *, case (place - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as w, case (place - 1) % 3 when 0 then 0.5 when 1 then 1.0 else 2.0 end::double as ramp, (source_size * 3)::double as cap from src
), levels as (
  select *, ((sum(source_size) over ())::double - coalesce(sum(cap) over before, 0)) / (sum(w) over () - coalesce(sum(w) over before, 0)) as level from weighed
  window before as (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding)
), goal as (
  select source, source_size, ramp, case when level * w >= cap then cap else (select l2.level from levels l2 where l2.level * l2.w < l2.cap order by l2.cap / l2.w, l2.source nulls last limit 1) * w end as target from levels
), placed as (
  select d.*, g.source_size, g.ramp, g.target, floor(g.target)::bigint as goal_words,
    (coalesce(sum(d.size) over (partition by d.source order by d.key rows between unbounded preceding and 1 preceding), 0))::bigint as start_at
  from doc d join goal g on d.source is not distinct from g.source
), took as (
  select *, (greatest(0, least(size, goal_words - start_at)) + greatest(0, least(size, goal_words - start_at - source_size)) + greatest(0, least(size, goal_words - start_at - 2 * source_size)))::bigint as taken, start_at / target * (ramp + 1.0) as demand from placed
)
select doc_id, size, source_size, target, taken, case when taken > 0 then round(demand / (sqrt((ramp - 1.0) * demand + 1.0) + 1.0), 9) end as position from took
"""

ORACLES = {"op2_line_dedup": _LINES_SQL, "op3_exact_topk": _TOPK_SQL, "op6_mixing": _MIX_SQL}
