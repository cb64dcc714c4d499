"""Queries over the test tables, one or more for each operator, and DuckDB SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signmine.functions import captions as cap
from signmine.functions import geometry, naming, planning
from signmine.functions.captions import VISIBLE_TEXT_WORDS
from signmine.operators import detections as det
from signmine.operators import index, metas, preview, sequence, stats
from signmine.plans import pipeline
from signmine.sources import captions, files
from signmine.sources.captions import captions_from_parts
from signmine.sources.sinks import CropStore
from signmine.streaming import resume

QUERIES, ORACLES = {}, {}

# --- inputs, once as DataFrames and once as SQL -------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions_from_parts(_table(spark, sf_dir, "part"))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.build_index(_captions(spark, sf_dir))


def _dets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of two detectors, made from lineitem."""
    side, x, y = 20 + F.col("l_quantity"), (F.col("l_partkey") % 40).cast("double"), (F.col("l_suppkey") % 30).cast("double")
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("image"), (F.col("l_linenumber") % 2).cast("int").alias("det"), F.col("l_linenumber").cast("long").alias("q"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"),
        x.alias("x1"), y.alias("y1"), (x + side).alias("x2"), (y + side).alias("y2"), (F.col("l_discount") * 10).alias("score"),
    )


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return det.suppressed(det.confident(_dets(spark, sf_dir)), ties=("p", "s"))


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("worker"), "ts", (F.col("event_type") != "error").alias("ok"), F.col("value").alias("seconds"), F.col("event_type").alias("phase"))


_W = r"[\p{L}\p{N}_]"
_WORDS = "|".join(VISIBLE_TEXT_WORDS)
_SPEAKS = rf"""(regexp_matches(coalesce({{0}}, ''), '(?i)(^|[^\p{{{{L}}}}\p{{{{N}}}}_])({_WORDS})($|[^\p{{{{L}}}}\p{{{{N}}}}_])') or regexp_matches(coalesce({{0}}, ''), '["“][^"“”\n]+["”]|(^|[^\p{{{{L}}}}\p{{{{N}}}}_])[''‘][^''‘’\n]+[''’]($|[^\p{{{{L}}}}\p{{{{N}}}}_])'))"""


def _speaks(column: str) -> str:
    return _SPEAKS.format(column)


_CAPTIONS = """captions as (
  select 'train-' || lpad(cast(p_partkey % 4 as varchar), 5, '0') || '-of-00004' as shard, cast(floor(p_partkey / 4) as bigint) as row,
    case when p_partkey % 17 = 0 then null when p_partkey % 19 = 0 then '' else 'http://img.example.com/' || p_partkey || '.jpg' end as url,
    case p_partkey % 6 when 0 then 'A photo of a ' || p_name when 1 then 'A sign that reads "' || p_name || '"' when 2 then 'A box labeled ' || p_brand
      when 3 then 'the shop' || chr(39) || 's ' || p_name when 4 then 'A poster ' || chr(39) || p_name || chr(39) || ' on a wall' else 'A contextual view of ' || p_type end as re_caption,
    p_type as org_caption
  from part)"""
_INDEX = f"{_CAPTIONS}, idx as (select shard, row, url from captions where {_speaks('re_caption')})"
_DETS = """dets as (
  select l_orderkey as image, cast(l_linenumber % 2 as integer) as det, cast(l_linenumber as bigint) as q, l_partkey as p, l_suppkey as s,
    cast(l_partkey % 40 as double) as x1, cast(l_suppkey % 30 as double) as y1, cast(l_partkey % 40 as double) + (20 + l_quantity) as x2, cast(l_suppkey % 30 as double) + (20 + l_quantity) as y2, l_discount * 10 as score
  from lineitem)"""
_IOU = """case when least(a.x2, b.x2) - greatest(a.x1, b.x1) > 0 and least(a.y2, b.y2) - greatest(a.y1, b.y1) > 0 then
  (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1))
  / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1))) else 0.0 end"""
_BOX = "{'det': det, 'q': q, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'score': score}"
_KEPT = f"""{_DETS}, ranked as (
  select *, row_number() over (partition by image order by -score, det, q, p, s) as n from dets where score >= 0.3
), walk(image, n, kept) as (
  select image, 1::bigint, [{_BOX}] from ranked where n = 1
  union all
  select w.image, b.n, case when len(list_filter(w.kept, lambda a: ({_IOU}) > 0.5)) > 0 then w.kept else list_append(w.kept, {_BOX.replace(': ', ': b.')}) end
  from walk w join ranked b on b.image = w.image and b.n = w.n + 1
), last as (select image, arg_max(kept, n) as kept from walk group by image),
kept as (select image, cast(generate_subscripts(kept, 1) - 1 as integer) as keep_pos, unnest(kept) as b from last),
boxes as (select image, keep_pos, b.det as det, b.q as q, b.x1 as x1, b.y1 as y1, b.x2 as x2, b.y2 as y2, b.score as score from kept)"""
_CAPPED = f"{_KEPT}, capped as (select * from boxes qualify row_number() over (partition by image order by md5('0:' || image || ':' || keep_pos), keep_pos) <= 3)"
_RECTS = f"{_CAPPED}, rects as (select * from (select *, greatest(0, cast(trunc(x1 - 5) as integer)) as l, greatest(0, cast(trunc(y1) as integer)) as t, least(64, cast(ceil(x2 - 5) as integer)) as r, least(48, cast(ceil(y2) as integer)) as b from capped) where r > l and b > t)"
_FETCHES = "fetches as (select user_id as worker, ts, event_type <> 'error' as ok, value as seconds, event_type as phase from events)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- captions and the index ---------------------------------------------------------------------


@query(f"with {_CAPTIONS} select shard, row, {_speaks('re_caption')} as speaks from captions")
def filter_predicate(spark, sf_dir):
    return _captions(spark, sf_dir).select("shard", "row", cap.speaks_of_text(F.col("re_caption")).alias("speaks"))


@query(f"select doc_id from documents where {_speaks('text')}")
def filter_documents(spark, sf_dir):
    return _table(spark, sf_dir, "documents").where(cap.speaks_of_text(F.col("text"))).select("doc_id")


@query(f"with {_INDEX} select shard, count(*) as hits, min(row) as first, max(row) as last from idx group by shard")
def shard_index(spark, sf_dir):
    return _index(spark, sf_dir).groupBy("shard").agg(F.count("*").alias("hits"), F.min("row").alias("first"), F.max("row").alias("last"))


@query(f"with {_INDEX} select shard, row, url from idx")
def index_rows(spark, sf_dir):
    return _index(spark, sf_dir)


@query(f"with {_CAPTIONS} select shard, count(*) as rows, count(*) filter (where {_speaks('re_caption')}) as matched from captions group by shard")
def index_manifest(spark, sf_dir):
    return index.manifest(_captions(spark, sf_dir)).select("shard", "rows", "matched")


@query(f"with {_CAPTIONS}, m as (select shard, count(*) as n, count(*) filter (where {_speaks('re_caption')}) as k from captions group by shard) select count(*) as shards, 0::bigint as shards_cached, sum(n)::bigint as rows, sum(k)::bigint as matched, sum(k)::double / sum(n)::double as match_rate from m")
def index_summary(spark, sf_dir):
    return index.summary(index.manifest(_captions(spark, sf_dir)))


@query(f"with {_CAPTIONS} select shard, row from captions where shard not in ('train-00001-of-00004', 'train-00003-of-00004')")
def cached_shard_skip(spark, sf_dir):
    rows = _captions(spark, sf_dir)
    known = index.manifest(rows).where("shard in ('train-00001-of-00004', 'train-00003-of-00004')")
    return index.not_cached(rows, known).select("shard", "row")


@query(f"with {_INDEX} select distinct shard from captions where shard in (select shard from idx where row > 10)")
def indexed_shards(spark, sf_dir):
    return index.indexed_shards(_captions(spark, sf_dir).select("shard").distinct(), _index(spark, sf_dir).where("row > 10"))


@query(f"with {_INDEX} select distinct shard from captions where shard not in (select shard from idx where shard < 'train-00002')")
def shards_without_index(spark, sf_dir):
    return index.shards_without_index(_captions(spark, sf_dir).select("shard").distinct(), _index(spark, sf_dir).where("shard < 'train-00002'"))


@query(f"with {_CAPTIONS} select shard, row from captions where shard in (select distinct shard from captions order by shard limit 2)")
def shard_limit(spark, sf_dir):
    return captions.first_shards(_captions(spark, sf_dir), 2).select("shard", "row")


@query(f"""with {_CAPTIONS} select shard, row, len(regexp_extract_all(re_caption, '["“][^"“”\\n]+["”]')) + (p > 0)::int as hits from (select *, (position(chr(39) || ' on a wall' in re_caption) > 0)::int as p from captions)""")
def quoted_hits(spark, sf_dir):
    return _captions(spark, sf_dir).select("shard", "row", F.size(cap.quoted_spans(F.col("re_caption"))).cast("long").alias("hits"))


@query(f"""with {_CAPTIONS} select shard, row, case when contains(re_caption, ' reads ') then strpos(re_caption, ' reads ') when contains(re_caption, ' labeled ') then strpos(re_caption, ' labeled ') end::int as start from captions where {_speaks('re_caption')} and (contains(re_caption, ' reads ') or contains(re_caption, ' labeled '))""")
def word_hits(spark, sf_dir):
    found = cap.word_spans(F.col("re_caption"))
    return _captions(spark, sf_dir).select("shard", "row", F.get(found, 0)["start"].alias("start")).where("start is not null")


_ESC = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;')"
_OUT = r"[^\p{L}\p{N}_]"
_DOUBLE, _SINGLE, _WORD = r"""["“][^"“”\n]+["”]""", rf"(^|{_OUT})([''‘][^''‘’\n]+[''’])($|{_OUT})", rf"(?i)(^|{_OUT})({_WORDS})($|{_OUT})"


# From left to right: the next hit of each kind in what is left, and of those the first. A kind with a word border about it is found with that border.
@query(f"""with recursive {_CAPTIONS}, walk as (
  select shard, row, coalesce(re_caption, '') as rest, '' as out, false as done from captions
  union all
  select shard, row, case when spot is null then '' else substr(rest, spot + length(hit)) end,
    out || case when spot is null then {_ESC.format("rest")} else {_ESC.format("substr(rest, 1, spot - 1)")} || '<span class="hl-' || kind || '">' || {_ESC.format("hit")} || '</span>' end, spot is null
  from (
    select shard, row, rest, out, least(d_at, s_at, w_at) as spot, case least(d_at, s_at, w_at) when w_at then w when d_at then d else s end as hit, case when least(d_at, s_at, w_at) = w_at then 'v' else 'q' end as kind
    from (
      select *, case when d <> '' then strpos(rest, d) end as d_at, case when s <> '' then strpos(rest, regexp_extract(rest, '{_SINGLE}')) + length(regexp_extract(rest, '{_SINGLE}', 1)) end as s_at,
        case when w <> '' then strpos(rest, regexp_extract(rest, '{_WORD}')) + length(regexp_extract(rest, '{_WORD}', 1)) end as w_at
      from (select shard, row, rest, out, regexp_extract(rest, '{_DOUBLE}') as d, regexp_extract(rest, '{_SINGLE}', 2) as s, regexp_extract(rest, '{_WORD}', 2) as w from walk where not done)
    )
  )
) select shard, row, out as caption_html from walk where done""")
def highlight_html(spark, sf_dir):
    return preview.highlighted(_captions(spark, sf_dir)).select("shard", "row", "caption_html")


@query("""select page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') as escaped from pages""")
def html_escape(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", cap.escape_html(F.col("html")).alias("escaped"))


# --- previews -----------------------------------------------------------------------------------

_CANDIDATES = f"{_INDEX}, cands as (select c.shard, c.row, c.url, coalesce(c.re_caption, '') as re_caption, coalesce(c.org_caption, '') as org_caption from captions c join idx i on c.shard = i.shard and c.row = i.row where c.url is not null and c.url <> '' order by md5('7:' || c.shard), md5('7:' || c.shard || ':' || c.row), c.shard, c.row limit 200)"


def _candidates(spark, sf_dir):
    return preview.candidates(metas.rows_of_index(_captions(spark, sf_dir), _index(spark, sf_dir)), 7)


@query(f"with {_CANDIDATES} select * from cands")
def preview_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir)


@query(f"with {_CANDIDATES} select shard, row from cands where row % 3 <> 1 order by md5('7:' || shard), md5('7:' || shard || ':' || row), shard, row limit 10")
def preview_first_n(spark, sf_dir):
    return preview.first_good(_candidates(spark, sf_dir).withColumn("ok", F.col("row") % 3 != 1), 10, 7).select("shard", "row")


@query(f"with {_INDEX} select shard || '__r' || lpad(row::varchar, 8, '0') || '__c00' as name from idx order by name limit 20")
def preview_topk(spark, sf_dir):
    return preview.first_by_name(_index(spark, sf_dir).select(naming.crop_name(F.col("shard"), F.col("row"), F.lit(0)).alias("name")), 20)


# --- work items ---------------------------------------------------------------------------------


@query(f"with {_CAPTIONS} select shard, row from captions where cast(substr(shard, 7, 5) as integer) % 3 = 1")
def shard_modulo(spark, sf_dir):
    return metas.machine_share(_captions(spark, sf_dir), 3, 1).select("shard", "row")


@query(f"with {_CAPTIONS}, names as (select distinct shard from captions union all select 'nonsense' union all select 'a-b') select shard, coalesce(try_cast(split_part(shard, '-', 2) as integer), -1) as number, ((coalesce(try_cast(split_part(shard, '-', 2) as integer), -1) % 4) + 4) % 4 as share from names")
def shard_numbers(spark, sf_dir):
    names = _captions(spark, sf_dir).select("shard").distinct().unionByName(spark.createDataFrame([("nonsense",), ("a-b",)], "shard string"))
    return names.select("shard", naming.shard_number(F.col("shard")).alias("number"), F.pmod(naming.shard_number(F.col("shard")), F.lit(4)).alias("share"))


@query(f"with {_INDEX} select c.shard, c.row, c.url from captions c where exists (select 1 from idx i where i.shard = c.shard and i.row = c.row) and c.url is not null and c.url <> ''")
def metas_semi(spark, sf_dir):
    return metas.with_url(metas.rows_of_index(_captions(spark, sf_dir), _index(spark, sf_dir))).select("shard", "row", "url")


_PROGRESS = "prog as (select shard, max(row) as max_row from captions where row % 2 = 0 and row < 40 and shard <> 'train-00002-of-00004' group by shard)"


@query(f"with {_INDEX}, {_PROGRESS} select i.shard, i.row, i.url from idx i left join prog p on i.shard = p.shard where (p.max_row is null or i.row > p.max_row) and i.shard <> 'train-00003-of-00004' and i.url is not null and i.url <> ''")
def metas_hwm(spark, sf_dir):
    progress = metas.progress_of(_captions(spark, sf_dir).where("row % 2 = 0 and row < 40 and shard <> 'train-00002-of-00004'"))
    done = spark.createDataFrame([("train-00003-of-00004",)], "shard string")
    return metas.work_items(_index(spark, sf_dir), done, progress)


@query(f"with {_INDEX} select shard, cast(floor(row / 50) as bigint) as row_group, min(row) as first, max(row) as last, count(*) as hits from idx group by all")
def metas_rowgroup_range(spark, sf_dir):
    return metas.by_row_group(_index(spark, sf_dir), 50)


_GROUPS = "groups as (select 'train-' || lpad(cast(s as varchar), 5, '0') || '-of-00004' as shard, g as row_group, (g * (g + 1) * (7 + s))::bigint as start from (select unnest(range(0, 4)) as s), (select unnest(range(0, 40)) as g))"


@query(f"with {_INDEX}, {_GROUPS}, ends as (select *, lead(start) over (partition by shard order by start) as stop from groups) select i.shard, e.row_group, min(i.row) as first, max(i.row) as last, count(*) as hits from idx i join ends e on i.shard = e.shard and i.row >= e.start and (i.row < e.stop or e.stop is null) group by all")
def metas_real_row_groups(spark, sf_dir):
    """Row groups of different sizes, as files have them."""
    g, s = spark.range(40).withColumnRenamed("id", "row_group"), spark.range(4).withColumnRenamed("id", "s")
    shard = F.concat(F.lit("train-"), F.lpad(F.col("s").cast("string"), 5, "0"), F.lit("-of-00004"))
    groups = g.join(F.broadcast(s)).select(shard.alias("shard"), "row_group", (F.col("row_group") * (F.col("row_group") + 1) * (7 + F.col("s"))).alias("start"))
    return metas.in_row_groups(_index(spark, sf_dir), groups)


@query(f"with {_INDEX} select shard, row from idx where shard not in ('train-00000-of-00004')")
def done_anti(spark, sf_dir):
    return metas.not_done(_index(spark, sf_dir), spark.createDataFrame([("train-00000-of-00004",)], "shard string")).select("shard", "row")


@query(f"with {_CAPTIONS} select shard, max(row) as max_row from captions where row % 2 = 0 or row < 10 group by shard")
def hwm_max(spark, sf_dir):
    rows = _captions(spark, sf_dir)
    return metas.progress_of(rows.where("row % 2 = 0"), metas.progress_of(rows.where("row < 10")))


@query(f"with {_CAPTIONS} select distinct shard from captions")
def finished_union(spark, sf_dir):
    rows = _captions(spark, sf_dir)
    return metas.finished_shards(rows.where("row < 5"), rows)


@query("with t as (select event_id as n, event_type as shard, lag(event_type) over (order by event_id, event_type) as previous from events) select * from t where previous is null or previous <> shard")
def shard_transitions(spark, sf_dir):
    return metas.transitions(_table(spark, sf_dir, "events").select(F.col("event_id").alias("n"), F.col("event_type").alias("shard")))


@query(f"with {_INDEX} select shard, row, url from idx where url is not null and url <> '' order by shard, row limit 37")
def submission_cap(spark, sf_dir):
    return metas.capped(metas.work_items(_index(spark, sf_dir)), 37)


_KIND = "case page_id % 4 when 0 then 'image/png' when 1 then 'text/html' end"
_URL = "url || case page_id % 3 when 0 then '.JPG?w=1' when 1 then '?x=.png' else '.webp' end"


@query(f"select page_id, contains(lower(coalesce({_KIND}, '')), 'image') or regexp_matches(lower(split_part({_URL}, '?', 1)), '\\.(jpg|jpeg|png|webp|gif|bmp)$') as image from pages")
def imageish(spark, sf_dir):
    n = F.col("page_id")
    kind = F.when(n % 4 == 0, "image/png").when(n % 4 == 1, "text/html")
    url = F.concat("url", F.when(n % 3 == 0, ".JPG?w=1").when(n % 3 == 1, "?x=.png").otherwise(".webp"))
    return _table(spark, sf_dir, "pages").select("page_id", naming.looks_like_image(kind, url).alias("image"))


# --- polygons and boxes -------------------------------------------------------------------------


@query("""with p as (select vec_id, list_transform(range(1, len(embedding), 2), lambda i: embedding[i]) as xs, list_transform(range(2, len(embedding) + 1, 2), lambda i: embedding[i]) as ys from embeddings)
select vec_id, list_min(xs)::double as x1, list_min(ys)::double as y1, list_max(xs)::double as x2, list_max(ys)::double as y2 from p where list_max(xs) > list_min(xs) and list_max(ys) > list_min(ys)""")
def poly_reshape_aabb(spark, sf_dir):
    box = geometry.bounding_box(geometry.reshape(F.col("embedding")))
    return _table(spark, sf_dir, "embeddings").select("vec_id", box.alias("b")).where("b is not null").select("vec_id", "b.*")


@query(f"with {_DETS} select image, det, q, x1, y1, x2, y2, coalesce(case when q % 5 = 0 then null else score end, 1.0) as score from dets where x2 > x1 and y2 > y1")
def normalized_boxes(spark, sf_dir):
    rows = _dets(spark, sf_dir).withColumn("score", F.when(F.col("q") % 5 != 0, F.col("score")))
    return det.boxes(det.normalized(rows))


@query(f"with {_DETS} select image, det, count(*) as n, sum(x1) as x1 from dets group by image, det")
def detector_union(spark, sf_dir):
    rows = _dets(spark, sf_dir)
    both = det.union_of(rows.where("det = 0"), rows.where("det = 1"))
    return both.groupBy("image", "det").agg(F.count("*").alias("n"), F.sum("x1").alias("x1"))


@query(f"with {_DETS} select image, det, q, score from dets where score >= 0.3")
def score_filter(spark, sf_dir):
    return det.confident(_dets(spark, sf_dir)).select("image", "det", "q", "score")


@query(f"with {_DETS} select image, det, q, p, x1::float::double as a, y1::float::double as b, x2::float::double as c, y2::float::double as d from dets")
def box_polygons(spark, sf_dir):
    poly = geometry.box_polygon(*map(F.col, ("x1", "y1", "x2", "y2")))
    at = lambda i, c: F.get("poly", i)[c].cast("double")
    return _dets(spark, sf_dir).withColumn("poly", poly).select("image", "det", "q", "p", at(0, "x").alias("a"), at(1, "y").alias("b"), at(2, "x").alias("c"), at(3, "y").alias("d"))


@query(f"with {_DETS} select a.image, a.det as a_det, a.q as a_q, a.p as a_p, a.s as a_s, b.det as b_det, b.q as b_q, b.p as b_p, b.s as b_s, {_IOU} as iou from dets a join dets b on a.image = b.image and (a.det, a.q, a.p, a.s) < (b.det, b.q, b.p, b.s) where {_IOU} > 0.5")
def iou_pairs(spark, sf_dir):
    return det.overlapping_pairs(_dets(spark, sf_dir), key=("det", "q", "p", "s"))


@query(f"with recursive {_KEPT} select * from boxes")
def nms(spark, sf_dir):
    return _kept(spark, sf_dir)


@query(f"with recursive {_CAPPED} select * from capped")
def nms_cap(spark, sf_dir):
    return det.capped(_kept(spark, sf_dir), 3)


@query()
def nms_cap_mt(spark, sf_dir):
    return det.capped_by_generator(_kept(spark, sf_dir), 3)


def _rects(spark, sf_dir):
    moved = det.capped(_kept(spark, sf_dir), 3).withColumns({"x1": F.col("x1") - 5, "x2": F.col("x2") - 5})
    return det.crop_rectangles(moved, F.lit(64), F.lit(48))


@query(f'with recursive {_RECTS} select image, keep_pos, l as "left", t as top, r as "right", b as bottom from rects')
def crop_rects(spark, sf_dir):
    return _rects(spark, sf_dir).select("image", "keep_pos", "left", "top", "right", "bottom")


@query(f"with recursive {_RECTS} select image, keep_pos, (row_number() over (partition by image order by keep_pos) - 1)::int as c, row_number() over (order by image, keep_pos) + 100 as seq from rects")
def crop_sequence(spark, sf_dir):
    rows = sequence.ordinals(_rects(spark, sf_dir).select("image", "keep_pos"), ["image"])
    return sequence.dense_numbers(rows, ["image", "keep_pos"], 100)


@query(f"with recursive {_RECTS} select image, keep_pos, row_number() over (order by image, keep_pos) as seq from rects qualify row_number() over (order by image, keep_pos) <= 500")
def target_cap(spark, sf_dir):
    return sequence.up_to(sequence.dense_numbers(_rects(spark, sf_dir).select("image", "keep_pos"), ["image", "keep_pos"]), 500)


@query(f"with recursive {_RECTS}, n as (select image, row_number() over (order by image, keep_pos) as seq, row_number() over (partition by image order by keep_pos) - 1 as c from rects) select 'image-' || lpad(seq::varchar, 9, '0') as key, 'train__r' || lpad(image::varchar, 8, '0') || '__c' || lpad(c::varchar, 2, '0') as name, 'recap_' || lpad(c::varchar, 5, '0') as preview from n")
def crop_keys(spark, sf_dir):
    rows = sequence.with_keys(sequence.dense_numbers(sequence.ordinals(_rects(spark, sf_dir).select("image", "keep_pos"), ["image"]), ["image", "keep_pos"]))
    return rows.select("key", naming.crop_name(F.lit("train"), F.col("image"), F.col("c")).alias("name"), naming.preview_name(F.col("c")).alias("preview"))


@query("select part.p_partkey, to_base64(encode(p_name)) as b64 from part")
def base64_names(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", naming.base64_of(F.col("p_name").cast("binary")).alias("b64"))


# --- planning -----------------------------------------------------------------------------------

_TARGETS = "t as (select p_partkey * 977 as target, greatest(p_size / 4.0, 0.1)::double as y, greatest((p_partkey % 10) / 10.0, 0.05)::double as d from part)"


def _targets(spark, sf_dir):
    return _table(spark, sf_dir, "part").select((F.col("p_partkey") * 977).alias("target"), (F.col("p_size") / 4).alias("y"), ((F.col("p_partkey") % 10) / 10).alias("d"))


@query(f"with {_TARGETS} select target, greatest(1, ceil(greatest(1, ceil(greatest(1, ceil(target / y)) / d)) * 2.5::double))::bigint as shown, greatest(1, ceil(target / y / d * 2.5::double))::bigint as used from t")
def plan_fetch_cap(spark, sf_dir):
    t, y, d = map(F.col, ("target", "y", "d"))
    return _targets(spark, sf_dir).select("target", planning.shown_fetch_cap(t, y, d).alias("shown"), planning.fetch_cap(t, y, d).alias("used"))


@query(f"with {_TARGETS} select target, greatest(1, ceil(greatest(1, ceil(target / y / d * 2.5::double)) * 2 / 71000.0::double))::bigint as shards, case when target <= 100000 then 0 else least(greatest(target // 30, 50000), 1000000) end::bigint as chunk from t")
def plan_shards_chunks(spark, sf_dir):
    t, y, d = map(F.col, ("target", "y", "d"))
    return _targets(spark, sf_dir).select("target", planning.shards_needed(t, y, d).alias("shards"), planning.chunk_size(t).alias("chunk"))


# --- statistics ---------------------------------------------------------------------------------


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(f"with {_FETCHES} select phase, count(*) as tried, count(*) filter (where ok) as decoded, round((count(*) filter (where ok))::double / count(*), 6) as ok_rate, round(sum(seconds) * 1000 / count(*), 6) as avg_ms, round(coalesce(sum(seconds) filter (where ok) * 1000 / (count(*) filter (where ok)), 0), 6) as avg_ok_ms, round(coalesce(sum(seconds) filter (where not ok) * 1000 / (count(*) filter (where not ok)), 0), 6) as avg_fail_ms from fetches group by phase")
def fetch_stats(spark, sf_dir):
    return _rounded(stats.fetch_stats(_fetches(spark, sf_dir), ["phase"]))


def _spans(spark, sf_dir):
    start = (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("start")
    return _fetches(spark, sf_dir).select("phase", start, "seconds").select("phase", "start", (F.col("start") + F.col("seconds")).alias("end"))


_SPANS = f"""{_FETCHES}, spans as (select phase, epoch_us(ts) / 1e6::double as start, epoch_us(ts) / 1e6::double + seconds as stop from fetches),
env as (select phase, min(start) as first, max(stop) as last, max(stop) - min(start) as wall, sum(stop - start) as busy from spans group by phase)"""


@query(f"with {_SPANS} select phase, round(first, 3) as first, round(last, 3) as last, round(wall, 3) as wall, round(busy, 3) as busy from env")
def phase_envelope(spark, sf_dir):
    return _rounded(stats.phase_envelopes(_spans(spark, sf_dir)), 3)


@query(f"with {_SPANS} select phase, round(busy / greatest(wall * 8, 1e-9), 6) as util, round(busy / 1000, 6) as seconds_an_image, round(8.0 / greatest(busy / 1000, 1e-9), 6) as images_a_second from env")
def throughput(spark, sf_dir):
    return _rounded(stats.throughput(stats.phase_envelopes(_spans(spark, sf_dir)), 1000, 8))


@query(f"with {_SPANS}, w as (select max(wall) filter (where phase = 'click') as f, max(wall) filter (where phase = 'error') as g from env) select case when f >= g - 1 then 'fetch' else 'gpu' end as bottleneck from w")
def bottleneck(spark, sf_dir):
    one = stats.phase_envelopes(_spans(spark, sf_dir)).agg(F.max(F.when(F.col("phase") == "click", F.col("wall"))).alias("f"), F.max(F.when(F.col("phase") == "error", F.col("wall"))).alias("g"))
    return one.select(stats.bottleneck(F.col("f"), F.col("g")).alias("bottleneck"))


@query("with r as (select cast(epoch_us(ts) // 86400000000 as bigint) as run_no, count(*) as urls_tried, count(*) filter (where event_type <> 'error') as urls_decoded, nullif(count(*) filter (where event_type = 'purchase'), 0) as crops, max(user_id) as target_crops from events group by 1) select sum(urls_tried)::bigint as urls_tried, sum(urls_decoded)::bigint as urls_decoded, coalesce(sum(crops), 0)::bigint as crops, arg_max(target_crops, run_no) as target_crops from r")
def run_cumulative(spark, sf_dir):
    day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000).alias("run_no")
    good, sold = F.count_if(F.col("event_type") != "error"), F.count_if(F.col("event_type") == "purchase")
    runs = _table(spark, sf_dir, "events").groupBy(day).agg(F.count("*").alias("urls_tried"), good.alias("urls_decoded"), F.when(sold > 0, sold).alias("crops"), F.max("user_id").alias("target_crops"))
    return stats.cumulative(runs, ("urls_tried", "urls_decoded", "crops"), ("target_crops",))


@query("with r as (select cast(epoch_us(ts) // 86400000000 as bigint) as day, count(*) filter (where event_type <> 'error') as images, count(*) filter (where event_type = 'purchase') as crops from events group by 1), t as (select day, images, crops, sum(crops) over (order by day)::bigint as crops_total from r) select day, images, crops, crops_total, crops / greatest(images, 1) as crops_per_image, crops_total >= 60 as target_met, crops_total < 60 and images < 260 as target_missed from t")
def crop_outcome(spark, sf_dir):
    from pyspark.sql import Window

    day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000).alias("day")
    days = _table(spark, sf_dir, "events").groupBy(day).agg(F.count_if(F.col("event_type") != "error").alias("images"), F.count_if(F.col("event_type") == "purchase").alias("crops"))
    return stats.crop_outcome(days.withColumn("crops_total", F.sum("crops").over(Window.orderBy("day"))), 60, 260)


@query("with e as (select user_id, event_id, case when event_type in ('purchase', 'signup') then 1 else 0 end as made from events), g as (select *, sum((made > 0)::int) over (partition by user_id order by event_id) as good from e) select user_id, min(event_id) as first, max(event_id) as last, count(*) as length from g where made = 0 group by user_id, good having count(*) >= 3")
def zero_streak(spark, sf_dir):
    chunks = _table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").isin("purchase", "signup").cast("int").alias("made"))
    return stats.zero_streaks(chunks, 3, "event_id", "made", ["user_id"])


# Tenths of minutes and hundredths of hours in whole numbers: ties go up, as they do in Spark.
@query("""with s as (select event_id, event_id * 7 + 3 as x from events), r as (select *, (x * 10 + 30) // 60 as tenths, (x * 100 + 1800) // 3600 as hundredths from s)
select event_id, case when x < 60 then x || '.0s' when x < 3600 then (tenths // 10) || '.' || (tenths % 10) || 'min (' || x || 's)' else (hundredths // 100) || '.' || lpad((hundredths % 100)::varchar, 2, '0') || 'h (' || x || 's)' end as text from r""")
def fmt_secs(spark, sf_dir):
    x = (F.col("event_id") * 7 + 3).cast("double")
    return _table(spark, sf_dir, "events").select("event_id", naming.readable_seconds(x).alias("text"))


@query("with n as (select p_partkey, (p_partkey * case p_partkey % 4 when 0 then 1 when 1 then 1000 when 2 then 1000000 else 1000000000 end)::bigint as n from part) select p_partkey, case when n >= 1000000000 and n % 1000000000 = 0 then (n // 1000000000) || 'B' when n >= 1000000 and n % 1000000 = 0 then (n // 1000000) || 'M' when n >= 1000 and n % 1000 = 0 then (n // 1000) || 'K' else n::varchar end as text from n")
def short_count(spark, sf_dir):
    k = F.col("p_partkey")
    scale = F.when(k % 4 == 0, F.lit(1)).when(k % 4 == 1, F.lit(1000)).when(k % 4 == 2, F.lit(1_000_000)).otherwise(F.lit(1_000_000_000)).cast("long")
    return _table(spark, sf_dir, "part").select("p_partkey", naming.short_count(k * scale).alias("text"))


# --- runs over real files -------------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    import uuid

    return f"{files.shared_dir(spark)}/catalogue-{uuid.uuid4().hex}"


def _dataset(spark: SparkSession, sf_dir: str) -> str:
    """The captions as a folder of four Parquet files named as shards are, each in order of row."""
    root = _folder(spark)
    rows = _captions(spark, sf_dir).repartition("shard").sortWithinPartitions("shard", "row")
    rows.write.partitionBy("shard").parquet(f"{root}/parts")
    for shard in files.names(spark, f"{root}/parts"):
        if shard.startswith("shard="):
            (part,) = files.names(spark, f"{root}/parts/{shard}", ".parquet")
            files.move(spark, f"{root}/parts/{shard}/{part}", f"{root}/data/{shard.removeprefix('shard=')}.parquet")
    return f"{root}/data"


_FILES = f"{_CAPTIONS}, rows as (select shard, row_number() over (partition by shard order by row) - 1 as row, url, re_caption from captions)"


@query(f"with {_FILES} select shard, row, url from rows")
def dataset_scan(spark, sf_dir):
    """Shards found in a folder, one column of them read, rows known by their place in the file."""
    return captions.read(spark, _dataset(spark, sf_dir), ("url",))


@query(f"with {_FILES} select shard, count(*) as rows, count(*) filter (where {_speaks('re_caption')}) as matched, min(row) filter (where {_speaks('re_caption')}) as first, max(row) filter (where {_speaks('re_caption')}) as last from rows group by shard")
def filter_run(spark, sf_dir):
    """The filter step over files: what it has written to the index and the manifest."""
    config = pipeline.Config(dataset=_dataset(spark, sf_dir), out_root=_folder(spark), max_shards=0, filter_preview_n=0, steps=("filter",)).resolved()
    pipeline.filter_step(spark, config)
    found = index.read_index(spark, f"{config.out_root}/index").groupBy("shard").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    return spark.read.parquet(f"{config.out_root}/manifest").select("shard", "rows", "matched").join(found, "shard")


class SizeCodec:
    """Images are texts "width,height", and their parts texts "left,top,right,bottom"."""

    def decode(self, data):
        return tuple(map(int, data.decode().split(","))) if data[:1].isdigit() else None

    def size(self, image):
        return image

    def crop(self, image, left, top, right, bottom):
        return f"{left},{top},{right},{bottom}".encode()


def made_up_fetcher(url: str) -> bytes:
    """By the number in the URL: every fifth fails, every seventh is no image, and the others have a size that it gives."""
    n = int("".join(c for c in url if c.isdigit()))
    if n % 5 == 0:
        raise OSError(url)
    return f"{40 + n % 6},30".encode() if n % 7 else b"nonsense"


def made_up_detectors() -> list:
    """One gives two boxes of which one is suppressed, and one without area; the other a box that reaches out of the image, without a score, and one of a low score."""
    one = lambda images: [[([(2, 2), (20, 2), (20, 10), (2, 10)], 0.75), ([(3, 2), (20, 2), (20, 10), (3, 10)], 0.5), ([(1, 1), (2, 2)], 0.9)] for _ in images]
    two = lambda images: [[([(30.5, 20), (50, 20), (50, 28.5), (30.5, 28.5)], None), ([(1, 1), (5, 1), (5, 5)], 0.1)] for _ in images]
    return [one, two]


def _crop_run(spark: SparkSession, sf_dir: str, target: int) -> tuple:
    config = pipeline.Config(out_root=_folder(spark), max_shards=0, target=target, crop_preview_n=0, shards_at_once=3, steps=("crop",)).resolved().planned(spark)
    index.write_index(_index(spark, sf_dir), f"{config.out_root}/index")
    done = [pipeline.crop_step(spark, config, made_up_fetcher, SizeCodec(), made_up_detectors) for _ in range(2)]
    return done, CropStore(spark, f"{config.out_root}/crops").read()


_RUN = f"""{_INDEX}, items as (select *, cast(regexp_extract(url, '([0-9]+)', 1) as bigint) as n from idx where url is not null and url <> ''),
images as (select *, row_number() over (order by shard, row) as image from items where n % 5 <> 0 and n % 7 <> 0),
used as (select * from images where image <= 120),
cuts as (select * from (values (0, 30, 20, 99, 29, 1.0::double), (1, 2, 2, 20, 10, 0.75::double)) as t(c, "left", top, "right", bottom, score))"""


@query(f"""with {_RUN} select 'image-' || lpad((row_number() over (order by shard, row, c))::varchar, 9, '0') as key, row_number() over (order by shard, row, c) as seq, shard, row, c::integer as c, "left"::integer as "left", top::integer as top, least("right", 40 + n % 6)::integer as "right", bottom::integer as bottom, score,
  "left" || ',' || top || ',' || least("right", 40 + n % 6) || ',' || bottom as jpeg from used cross join cuts""")
def crop_run(spark, sf_dir):
    """Two runs of 60 images each over the index, the second going on where the first stopped: all that is in the store."""
    return _crop_run(spark, sf_dir, 60)[1].select("key", "seq", "shard", "row", "c", "left", "top", "right", "bottom", "score", F.col("jpeg").cast("string").alias("jpeg"))


@query(f"""with {_RUN}, tried as (
  select i.shard, i.row, (select count(*) from images m where (m.shard, m.row) < (i.shard, i.row)) // 60 as run, (i.n % 5 <> 0 and i.n % 7 <> 0) as good from items i
) select run::integer as run, count(*) as urls_tried, count(*) filter (where good) as gpu_imgs, 2 * count(*) filter (where good) as crops from tried where run < 2 group by run""")
def crop_run_statistics(spark, sf_dir):
    """What each of the two runs counted. Items after a run's last image belong to the next."""
    done, _ = _crop_run(spark, sf_dir, 60)
    return spark.createDataFrame([(i, d["urls_tried"], d["gpu_imgs"], d["crops"]) for i, d in enumerate(done)], "run int, urls_tried long, gpu_imgs long, crops long")


@query(f"with {_INDEX} select 'image-' || lpad((row_number() over (order by shard, row))::varchar, 9, '0') as key, row_number() over (order by shard, row) as seq, shard, row from idx where url is not null and url <> ''")
def stream_resume(spark, sf_dir):
    """The index as files, streamed by rows into a store with dense numbers, in runs that each go on where the last stopped, until one has nothing left."""
    root = _folder(spark)
    index.write_index(_index(spark, sf_dir).repartition("shard").sortWithinPartitions("shard", "row"), f"{root}/index")
    store, size = CropStore(spark, f"{root}/store"), index.read_index(spark, f"{root}/index").count() // 3 + 1
    while resume.run(resume.by_row(spark, f"{root}/index", size), lambda batch: metas.with_url(batch).withColumn("c", F.lit(0)), store, f"{root}/progress")["crops"]:
        pass
    return store.read().select("key", "seq", "shard", "row")
