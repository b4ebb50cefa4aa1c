"""Boxes, glyph runs and trees: overlap joins, containment, segmentation, reading order, tables and code layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillfold.functions import udfs
from quillfold.functions.codecs import html_escaped
from quillfold.registry import query
from quillfold.sources.tables import load

BOXES_SQL = """b AS (SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS box, l_quantity AS l, CAST(l_linenumber * 10 AS DOUBLE) AS t, l_quantity + 12 AS r, CAST(l_linenumber * 10 + 14 AS DOUBLE) AS bt FROM lineitem)"""
IOU_SQL = "greatest(0, least(x.r, y.r) - greatest(x.l, y.l)) * greatest(0, least(x.bt, y.bt) - greatest(x.t, y.t))"


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of pages: page, box, l, t, r, bt (top-left origin)."""
    li = load(spark, d, "lineitem")
    k = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity"))
    n = F.col("l_linenumber").cast("double")
    return li.select(F.col("l_orderkey").alias("page"), k.cast("long").alias("box"), F.col("l_quantity").alias("l"), (n * 10).alias("t"), (F.col("l_quantity") + 12).alias("r"), (n * 10 + 14).alias("bt"))


def overlap(a: str, b: str) -> Column:
    """Intersection over union of two boxes."""
    def c(x, k):
        return F.col(f"{x}_{k}")

    both = F.greatest(F.lit(0.0), F.least(c(a, "r"), c(b, "r")) - F.greatest(c(a, "l"), c(b, "l"))) * F.greatest(F.lit(0.0), F.least(c(a, "bt"), c(b, "bt")) - F.greatest(c(a, "t"), c(b, "t")))
    area = [(c(x, "r") - c(x, "l")) * (c(x, "bt") - c(x, "t")) for x in (a, b)]
    return F.try_divide(both, area[0] + area[1] - both)


def named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("page", *[F.col(k).alias(f"{prefix}_{k}") for k in ("box", "l", "t", "r", "bt")])


@query("best_overlap", f"WITH {BOXES_SQL}, p AS (SELECT x.page, x.box, y.box AS other, {IOU_SQL} / ((x.r - x.l) * (x.bt - x.t) + (y.r - y.l) * (y.bt - y.t) - {IOU_SQL}) AS iou FROM b x JOIN b y ON x.page = y.page AND x.box % 2 = 0 AND y.box % 2 = 1) SELECT page, box, arg_max(other, iou * 1000 - other / 1000.0) AS other, round(max(iou), 8) AS iou FROM p GROUP BY 1, 2 HAVING max(iou) >= 0.2")
def best_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Each box's best partner on its page, if they overlap enough: an equi join on the page before any geometry."""
    b = boxes(spark, d)
    p = named(b.where("box % 2 = 0"), "x").join(named(b.where("box % 2 = 1"), "y"), "page").withColumn("iou", overlap("x", "y"))
    g = p.groupBy("page", F.col("x_box").alias("box")).agg(F.max_by("y_box", F.struct("iou", -F.col("y_box"))).alias("other"), F.max("iou").alias("iou"))
    return g.where("iou >= 0.2").select("page", "box", "other", F.round("iou", 8).alias("iou"))


@query("points_in_boxes", f"WITH {BOXES_SQL}, c AS (SELECT page, box AS chr, (l + r) / 2 + 3 AS x, (t + bt) / 2 + 2 AS y FROM b) SELECT c.page, c.chr, count(b.box) AS boxes, min(b.box) AS first FROM c LEFT JOIN b ON b.page = c.page AND c.x BETWEEN b.l AND b.r AND c.y BETWEEN b.t AND b.bt GROUP BY 1, 2")
def points_in_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Character centres and the boxes that hold them."""
    b = boxes(spark, d)
    chars = b.select("page", F.col("box").alias("chr"), ((F.col("l") + F.col("r")) / 2 + 3).alias("x"), ((F.col("t") + F.col("bt")) / 2 + 2).alias("y"))
    inside = F.col("x").between(F.col("l"), F.col("r")) & F.col("y").between(F.col("t"), F.col("bt"))
    hit = chars.join(b, "page").where(inside).groupBy("page", "chr").agg(F.count("*").alias("boxes"), F.min("box").alias("first"))
    return chars.select("page", "chr").join(hit, ["page", "chr"], "left").select("page", "chr", F.coalesce("boxes", F.lit(0)).alias("boxes"), "first")


@query("interval_containment", "WITH t AS (SELECT user_id, event_id, epoch_us(ts) AS a, epoch_us(ts) + CAST(value * 36000000 AS BIGINT) AS z FROM events WHERE event_type = 'purchase'), c AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events WHERE event_type = 'click') SELECT c.event_id, EXISTS (SELECT 1 FROM t WHERE t.user_id = c.user_id AND c.t > t.a AND c.t < t.z) AS inside FROM c")
def interval_containment(spark: SparkSession, d: str) -> DataFrame:
    """Commits inside a long transaction: the furthest end among earlier starts tells, in one sorted pass."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    e = load(spark, d, "events").where(F.col("event_type").isin("purchase", "click"))
    end = F.when(F.col("event_type") == "purchase", us + F.round(F.col("value") * 36_000_000).cast("long"))
    x = e.select("user_id", "event_id", "event_type", us.alias("t"), end.alias("z"))
    reach = F.max("z").over(Window.partitionBy("user_id").orderBy("t").rangeBetween(Window.unboundedPreceding, -1))
    return x.withColumn("reach", reach).where("event_type = 'click'").select("event_id", F.coalesce(F.col("reach") > F.col("t"), F.lit(False)).alias("inside"))


@query("target_images", "SELECT p_partkey, coalesce(CASE WHEN p_size < 10 THEN 'picture:' || p_partkey END, CASE WHEN p_size < 30 THEN 'page:' || p_size END, 'none') AS image FROM part")
def target_images(spark: SparkSession, d: str) -> DataFrame:
    """An item's own picture, else its page's image."""
    p = load(spark, d, "part")
    own = p.where("p_size < 10").select("p_partkey", F.concat(F.lit("picture:"), F.col("p_partkey").cast("string")).alias("own"))
    pages = p.where("p_size < 30").select("p_size").distinct().select("p_size", F.concat(F.lit("page:"), F.col("p_size").cast("string")).alias("page"))
    return p.join(own, "p_partkey", "left").join(pages, "p_size", "left").select("p_partkey", F.coalesce("own", "page", F.lit("none")).alias("image"))


GLYPHS_SQL = """g AS (SELECT user_id AS line, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, CAST(round(value * 10) AS BIGINT) AS x, event_type AS font FROM events)"""


def glyphs(spark: SparkSession, d: str) -> DataFrame:
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return load(spark, d, "events").select(F.col("user_id").alias("line"), i.cast("long").alias("i"), F.round(F.col("value") * 10).cast("long").alias("x"), F.col("event_type").alias("font"))


RUNS_SQL = GLYPHS_SQL + ", f AS (SELECT *, CASE WHEN lag(font) OVER w IS DISTINCT FROM font THEN 1 ELSE 0 END AS new FROM g WINDOW w AS (PARTITION BY line ORDER BY i)), r AS (SELECT *, sum(new) OVER (PARTITION BY line ORDER BY i) AS run FROM f)"


def runs(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("line").orderBy("i")
    f = glyphs(spark, d).withColumn("new", (~F.lag("font").over(w).eqNullSafe(F.col("font"))).cast("long"))
    return f.withColumn("run", F.sum("new").over(w))


@query("glyph_runs", f"WITH {RUNS_SQL} SELECT line, CAST(run AS BIGINT) AS run, font, count(*) AS glyphs, min(i) AS first FROM r GROUP BY 1, 2, 3")
def glyph_runs(spark: SparkSession, d: str) -> DataFrame:
    """Adjacent glyphs of one font are a run."""
    return runs(spark, d).groupBy("line", "run", "font").agg(F.count("*").alias("glyphs"), F.min("i").alias("first"))


@query("even_steps", f"WITH {RUNS_SQL}, s AS (SELECT line, run, abs(x - lag(x) OVER (PARTITION BY line, run ORDER BY i)) AS step FROM r), m AS (SELECT line, run, median(step) AS mid, count(step) AS steps FROM s GROUP BY 1, 2) SELECT s.line, CAST(s.run AS BIGINT) AS run, any_value(steps) AS steps, coalesce(bool_and(abs(step - mid) <= 0.5 * mid), true) AS even FROM s JOIN m USING (line, run) GROUP BY 1, 2")
def even_steps(spark: SparkSession, d: str) -> DataFrame:
    """A run is even if every step lies near the run's median step."""
    step = F.abs(F.col("x") - F.lag("x").over(Window.partitionBy("line", "run").orderBy("i")))
    g = runs(spark, d).withColumn("step", step).groupBy("line", "run").agg(F.count("step").alias("steps"), F.median("step").alias("mid"), F.collect_list("step").alias("s"))
    return g.select("line", "run", "steps", F.forall("s", lambda v: F.abs(v - F.col("mid")) <= 0.5 * F.col("mid")).alias("even"))


@query("evenness_sweep", f"WITH {RUNS_SQL}, s AS (SELECT line, run, font, abs(x - lag(x) OVER (PARTITION BY line, run ORDER BY i)) AS step FROM r), m AS (SELECT line, run, font, median(step) AS mid, count(step) AS n, list(step) FILTER (step IS NOT NULL) AS st FROM s GROUP BY 1, 2, 3), t AS (SELECT unnest([0.1, 0.5, 0.9]) AS tol) SELECT font, CAST(tol AS DOUBLE) AS tol, count(*) AS runs, count(*) FILTER (len(list_filter(st, lambda v: abs(v - mid) > CAST(tol AS DOUBLE) * mid)) = 0) AS even FROM m, t WHERE n >= 1 GROUP BY 1, 2")
def evenness_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Even runs a font over a grid of tolerances: the grid is exploded after the runs are reduced."""
    step = F.abs(F.col("x") - F.lag("x").over(Window.partitionBy("line", "run").orderBy("i")))
    g = runs(spark, d).withColumn("step", step).groupBy("line", "run", "font").agg(F.median("step").alias("mid"), F.collect_list("step").alias("s")).where(F.size("s") > 0)
    t = g.select("font", "mid", "s", F.explode(F.array(*[F.lit(v) for v in (0.1, 0.5, 0.9)])).alias("tol"))
    even = F.forall("s", lambda v: F.abs(v - F.col("mid")) <= F.col("tol") * F.col("mid"))
    return t.groupBy("font", "tol").agg(F.count("*").alias("runs"), F.count_if(even).alias("even"))


@query("neighbour_scan", f"WITH {RUNS_SQL}, a AS (SELECT *, bool_or(x > 950) OVER (PARTITION BY line, run) AS anchored FROM r) SELECT line, i, anchored AND font <> 'error' AS listing FROM a")
def neighbour_scan(spark: SparkSession, d: str) -> DataFrame:
    """From each anchor outwards while the font holds: the island that holds an anchor."""
    anchored = F.max(F.col("x") > 950).over(Window.partitionBy("line", "run"))
    return runs(spark, d).select("line", "i", (anchored & (F.col("font") != "error")).alias("listing"))


@query("font_mode", f"WITH {GLYPHS_SQL}, n AS (SELECT line, font, count(*) AS n FROM g GROUP BY 1, 2) SELECT line, arg_max(font, struct_pack(n := n, f := font)) AS font, max(n) AS glyphs FROM n GROUP BY 1")
def font_mode(spark: SparkSession, d: str) -> DataFrame:
    """A line's commonest font; of equals the last by name."""
    n = glyphs(spark, d).groupBy("line", "font").agg(F.count("*").alias("n"))
    return n.groupBy("line").agg(F.max_by("font", F.struct("n", "font")).alias("font"), F.max("n").alias("glyphs"))


@query("monospaced_neighbours", f"WITH {GLYPHS_SQL}, x AS (SELECT font, lag(font) OVER w AS prev, lead(font) OVER w AS next FROM g WINDOW w AS (PARTITION BY line ORDER BY i)) SELECT CASE WHEN prev = 'error' OR next = 'error' THEN 'next_to' ELSE 'away' END AS place, count(*) AS nodes FROM x WHERE font = 'view' GROUP BY 1")
def monospaced_neighbours(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("line").orderBy("i")
    x = glyphs(spark, d).withColumns({"prev": F.lag("font").over(w), "next": F.lead("font").over(w)}).where("font = 'view'")
    near = F.coalesce(F.col("prev") == "error", F.lit(False)) | F.coalesce(F.col("next") == "error", F.lit(False))
    return x.groupBy(F.when(near, "next_to").otherwise("away").alias("place")).agg(F.count("*").alias("nodes"))


@query("renumbered_refs", "SELECT doc_id, '#/texts/' || doc_id AS old_ref, '#/texts/' || (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) AS new_ref FROM documents WHERE n_chars > 500")
def renumbered_refs(spark: SparkSession, d: str) -> DataFrame:
    k = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    return load(spark, d, "documents").where("n_chars > 500").select("doc_id", F.concat(F.lit("#/texts/"), F.col("doc_id").cast("string")).alias("old_ref"), F.concat(F.lit("#/texts/"), k.cast("string")).alias("new_ref"))


TREE_SQL = "WITH RECURSIVE n AS (SELECT p_partkey AS id, p_partkey // 3 AS parent FROM part), t AS (SELECT id, id AS root, printf('%012d', id) AS path, 0 AS depth FROM n WHERE parent = 0 UNION ALL SELECT n.id, t.root, t.path || '/' || printf('%012d', n.id), t.depth + 1 FROM n JOIN t ON n.parent = t.id WHERE n.parent > 0)"


#: Levels of a tree whose nodes are ordered by one task, those below by a task a subtree.
TREE_TOP = 8
#: Rows of two longs that are broadcast at most; beyond, they are joined by shuffle.
BROADCAST_ROWS = 1_000_000


@query("reading_order", TREE_SQL + " SELECT root, id, CAST(depth AS INTEGER) AS depth, row_number() OVER (PARTITION BY root ORDER BY path) AS ordinal FROM t")
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    """Depth-first order of each tree, in which paths of padded ids sort as the walk goes.

    A node's ancestors follow from its id, so no recursion walks down to it. What is left to look up is whether each
    ancestor is there, and how often: ids for which that is not once are few, or none. A tree is ordered within its
    subtrees of TREE_TOP levels down, after the counts of the subtrees before.
    """
    def parent(id, n=1):
        return F.call_function("div", id, F.lit(3**n) if isinstance(n, int) else n)

    ids = load(spark, d, "part").select(F.col("p_partkey").alias("id")).where("id > -3")  # others have a parent that is no node
    seen = ids.select("id", F.lit(1).alias("m")).union(ids.where("id > 2").select(parent(F.col("id")), F.lit(0))).groupBy("id").agg(F.sum("m").alias("m"))
    powers = [F.lit(3**k) for k in range(40)]  # up to the last below 2**63
    depth = sum((F.when(F.col("id") >= p, 1).otherwise(0) for p in powers[1:]), F.lit(0))
    nodes = seen.where("m > 0").select("id", depth.alias("depth"))
    chain = F.transform(F.slice(F.array(*powers[::-1]), F.lit(40) - F.col("depth"), F.col("depth") + 1), lambda p: parent(F.col("id"), p))

    odd = seen.where("m <> 1").select(F.col("id").alias("a"), "m")
    odd = F.broadcast(odd) if odd.count() <= BROADCAST_ROWS else odd
    met = nodes.select("id", F.explode_outer(chain).alias("a")).join(odd, "a").groupBy("id").agg(F.product("m").cast("long").alias("copies"))
    here = nodes.join(met, "id", "left").select("id", "depth", chain.alias("chain"), F.coalesce("copies", F.lit(1)).alias("copies")).where("copies > 0")

    def path(c):
        padded = F.transform(c, lambda a: F.when(a < 10**12, F.lpad(a.cast("string"), 12, "0")).otherwise(a.cast("string")))
        return F.array_join(padded, "/")

    part = parent(F.col("id"), F.element_at(F.array(*powers), F.greatest(F.lit(1), F.col("depth") - TREE_TOP + 1)))
    t = here.select(F.get("chain", F.lit(0)).alias("root"), "id", "depth", "chain", part.alias("part"), F.slice("chain", 1, TREE_TOP + 1).alias("top"), "copies")
    parts = t.groupBy("root", "part", "top").agg(F.sum("copies").alias("n"))  # some 3 ** (TREE_TOP + 1) at most
    earlier = F.sum("n").over(Window.partitionBy("root").orderBy(path("top")).rowsBetween(Window.unboundedPreceding, -1))
    before = parts.select("part", F.coalesce(earlier, F.lit(0)).alias("before"))
    each = t.select("root", "id", "depth", "part", path(F.slice("chain", TREE_TOP + 2, 40)).alias("path"), F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    k = F.row_number().over(Window.partitionBy("part").orderBy("path"))
    return each.withColumn("k", k).join(F.broadcast(before), "part").select("root", "id", "depth", (F.col("before") + F.col("k")).alias("ordinal"))


@query("provenance_split", "SELECT conv_id, turn, list_transform(range(1, 4), lambda k: substr(text, CAST(length(text) - 20 * k + 1 AS BIGINT), 20))[1] AS last_part, substr(text, 1, length(text) - 60) AS rest FROM conversations WHERE length(text) > 70")
def provenance_split(spark: SparkSession, d: str) -> DataFrame:
    """Parts cut off a text from its end by their lengths: a fold over the reversed spans."""
    c = load(spark, d, "conversations").where(F.length("text") > 70)
    start = F.struct(F.col("text").alias("rest"), F.array().cast("array<string>").alias("parts"))
    cut = F.aggregate(F.array(F.lit(20), F.lit(20), F.lit(20)), start, lambda a, n: F.struct(F.substring(a["rest"], F.lit(1), F.length(a["rest"]) - n).alias("rest"), F.array_append(a["parts"], F.substring(a["rest"], F.length(a["rest"]) - n + 1, n)).alias("parts")))
    return c.select("conv_id", "turn", cut.alias("c")).select("conv_id", "turn", F.get("c.parts", F.lit(0)).alias("last_part"), "c.rest")


@query("box_pixels", f"WITH {BOXES_SQL} SELECT page, box, CAST(round_even(greatest(0, l) * 1.5, 0) AS BIGINT) AS x0, CAST(round_even(greatest(0, 100 - bt) * 1.5, 0) AS BIGINT) AS y0, CAST(round_even(least(60, r) * 1.5, 0) AS BIGINT) AS x1, CAST(round_even(least(100, 100 - t) * 1.5, 0) AS BIGINT) AS y1 FROM b")
def box_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Flip by the page's height, clamp, scale, round halves to even."""
    def px(c):
        return F.bround(c * 1.5, 0).cast("long")

    return boxes(spark, d).select("page", "box", px(F.greatest(F.lit(0.0), "l")).alias("x0"), px(F.greatest(F.lit(0.0), 100 - F.col("bt"))).alias("y0"), px(F.least(F.lit(60.0), "r")).alias("x1"), px(F.least(F.lit(100.0), 100 - F.col("t"))).alias("y1"))


@query("table_html", "WITH c AS (SELECT s_suppkey // 20 AS tbl, s_suppkey % 20 // 5 AS row, s_suppkey AS col, s_name AS text FROM supplier), r AS (SELECT tbl, row, '<tr>' || string_agg('<td>' || text || '</td>', '' ORDER BY col) || '</tr>' AS h, count(*) AS n FROM c GROUP BY 1, 2) SELECT tbl, count(*) AS num_rows, max(n) AS num_cols, '<table>' || string_agg(h, '' ORDER BY row) || '</table>' AS html FROM r GROUP BY 1")
def table_html(spark: SparkSession, d: str) -> DataFrame:
    cell = F.concat(F.lit("<td>"), html_escaped(F.col("s_name")), F.lit("</td>"))
    c = load(spark, d, "supplier").select(F.floor(F.col("s_suppkey") / 20).alias("tbl"), F.floor(F.col("s_suppkey") % 20 / 5).alias("row"), F.col("s_suppkey").alias("col"), cell.alias("h"))
    r = c.groupBy("tbl", "row").agg(F.array_sort(F.collect_list(F.struct("col", "h"))).alias("cells"))
    line = F.concat(F.lit("<tr>"), F.array_join(F.transform("cells", lambda x: x["h"]), ""), F.lit("</tr>"))
    t = r.select("tbl", "row", line.alias("h"), F.size("cells").cast("long").alias("n")).groupBy("tbl").agg(F.count("*").alias("num_rows"), F.max("n").alias("num_cols"), F.array_sort(F.collect_list(F.struct("row", "h"))).alias("rows"))
    return t.select("tbl", "num_rows", "num_cols", F.concat(F.lit("<table>"), F.array_join(F.transform("rows", lambda x: x["h"]), ""), F.lit("</table>")).alias("html"))


@query("grid_difference", "WITH g AS (SELECT s_nationkey AS tbl, list_distinct(list(s_suppkey % 5 || ':' || s_suppkey % 3)) AS a, list_distinct(list(s_suppkey % 4 || ':' || s_suppkey % 3)) AS b FROM supplier GROUP BY 1) SELECT tbl, len(list_filter(a, lambda x: NOT list_contains(b, x))) AS lost, len(list_filter(b, lambda x: NOT list_contains(a, x))) AS gained FROM g")
def grid_difference(spark: SparkSession, d: str) -> DataFrame:
    """Cells of one grid that the other lacks, both ways."""
    def cell(m):
        return F.concat_ws(":", (F.col("s_suppkey") % m).cast("string"), (F.col("s_suppkey") % 3).cast("string"))

    g = load(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("tbl")).agg(F.collect_set(cell(5)).alias("a"), F.collect_set(cell(4)).alias("b"))
    return g.select("tbl", F.size(F.array_except("a", "b")).cast("long").alias("lost"), F.size(F.array_except("b", "a")).cast("long").alias("gained"))


@query("character_coverage", f"WITH {BOXES_SQL}, c AS (SELECT page, box, (l + r) / 2 + 3 AS x FROM b) SELECT c.page, count(*) AS chars, count(*) FILTER (EXISTS (SELECT 1 FROM b WHERE b.page = c.page AND b.box % 2 = 1 AND c.x BETWEEN b.l AND b.r)) AS covered FROM c GROUP BY 1")
def character_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Characters inside any code box of their page."""
    b = boxes(spark, d)
    code = b.where("box % 2 = 1").groupBy("page").agg(F.collect_list(F.struct("l", "r")).alias("code"))
    x = (F.col("l") + F.col("r")) / 2 + 3
    inside = F.coalesce(F.exists("code", lambda k: (x >= k["l"]) & (x <= k["r"])), F.lit(False))
    return b.join(code, "page", "left").groupBy("page").agg(F.count("*").alias("chars"), F.count_if(inside).alias("covered"))


@query("formula_mismatch")
def formula_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Digits and operators of a formula's text against those of its LaTeX, as multisets."""
    p = load(spark, d, "part")
    text = F.concat(F.col("p_size").cast("string"), F.lit(" × "), F.col("p_partkey").cast("string"), F.lit(" ≤ "), F.col("p_retailprice").cast("string"))
    tex = F.concat(F.col("p_size").cast("string"), F.lit(r" \times "), F.when(F.col("p_size") == 7, F.lit("0")).otherwise(F.col("p_partkey").cast("string")), F.lit(r" \leq "), F.col("p_retailprice").cast("string"), F.lit(r" \tag{3}"))
    return p.select("p_partkey", "p_size", (udfs.symbols(text) == udfs.latex(tex)).alias("same"))


@query("code_reconstruction")
def code_reconstruction(spark: SparkSession, d: str) -> DataFrame:
    """Code text of each box from its glyphs' places."""
    g = boxes(spark, d).groupBy("page").agg(F.collect_list(F.struct(F.col("l").alias("x"), F.col("t").alias("y"), F.lit(6.0).alias("w"), F.lit(9.0).alias("h"), F.char(97 + F.col("box") % 26).alias("c"))).alias("g"))
    return g.select("page", udfs.code_text("g").alias("code"))


@query("literal_ocr")
def literal_ocr(spark: SparkSession, d: str) -> DataFrame:
    """Compatibility-normalised text without white space."""
    return load(spark, d, "benchmark").select("item_id", F.regexp_replace(udfs.nfkc("text"), r"\s+", "").alias("literal"), udfs.capitals("text").alias("capitals"))
