"""URL filter by path-template trees (operator 8), in DataFrame functions only.

Rules (host, path, verdict) come first: a rule fits its host and all subdomains if the url's path
starts with its own, and the longest wins. Urls with a rule are the labelled ones. For the others:

1. Segments: a path's segments, each with digits made '#'; a segment of a host and depth stays a
   literal if it holds at least KEEP_SHARE of the host's urls at that depth, and is else a wildcard.
   The last part of a file name after a dot stays apart from its stem.
2. Tree: a template is the path of generalised segments; its nodes are its beginnings, per host.
   Nodes count urls and labelled urls.
3. Merge: of siblings with at least MERGE_URLS urls and MERGE_LABELS labels, those whose labels lean to one side
   are compared with the one of them that has most labels. One that is alike both in its share of blocks (two
   proportions within MERGE_Z standard errors) and in what follows it (chi-squared over the next segments within
   MERGE_Z standard deviations of its mean) is merged with that one: all merged ones share their counts. What has
   too few urls or labels to be tested stays apart.
4. Verdict: from the root down, a node's purity is its blocks over its labels, smoothed with weight
   SMOOTH by the purity of the node above it; above a host's root stand the template in all hosts, and all
   urls. A template whose purity reaches REJECT is rejected if it has LEAST_LABELS labels of its own (merged ones
   included): nothing is rejected for what is known of other branches or hosts alone.

All steps group by (host, depth, segment) or (host, template): sums are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

KEEP_SHARE, SMOOTH, REJECT, LEAST_LABELS = 0.05, 4.0, 0.5, 3
MERGE_Z, MERGE_URLS, MERGE_LABELS = 2.0, 8, 3
#: Rules of the query (fixed list): host, path, verdict.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or no ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host up to ? # or the end; empty for null or no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does. Of equally long ones the first in the list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # later ones win
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """Segments of a path with runs of digits as '#', the suffix of a file name as one of its own, and '$' at the end."""
    plain = F.regexp_replace(F.regexp_replace(path, "[0-9]+", "#"), r"\.([^./]*)\z", "/.$1")
    return F.concat(F.filter(F.split(plain, "/"), lambda x: x != ""), F.array(F.lit("$")))


def templates(urls: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """urls (host, path, n, blocks, labels: counts by distinct host and shape) with template, an array of generalised segments."""
    each = urls.select("host", "shape", "n", F.posexplode("shape").alias("depth", "segment"))
    counts = each.groupBy("host", "depth", "segment").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("host", "depth").agg(F.sum("n").alias("total"))
    literal = counts.join(totals, ["host", "depth"]).where(F.col("n") >= F.col("total") * keep_share).select("host", "depth", "segment", F.lit(True).alias("literal"))
    kept = each.join(literal, ["host", "depth", "segment"], "left").withColumn("part", F.when(F.col("literal") | F.col("segment").isin("#", "$"), F.col("segment")).otherwise("*"))
    ordered = kept.groupBy("host", "shape").agg(F.array_sort(F.collect_list(F.struct("depth", "part"))).alias("parts"))
    return ordered.select("host", "shape", F.transform("parts", lambda x: x["part"]).alias("template"))


def merged(tree: DataFrame, merge_z: float = MERGE_Z) -> DataFrame:
    """tree (host, depth, above, node, part, n, blocks, labels: a row a node) with the counts that merged siblings share.

    Columns: host, depth, node, blocks, labels. A host has at most 1 / KEEP_SHARE literal segments a depth, and so
    few siblings; pools and sums are by key all the same.
    """
    side = F.when((F.col("n") >= MERGE_URLS) & (F.col("labels") >= MERGE_LABELS), (2 * F.col("blocks") >= F.col("labels")).cast("int"))
    sided = tree.withColumn("side", side)
    pool = ["host", "depth", "above", "side"]
    tested = sided.where("side is not null")
    first = tested.groupBy(*pool).agg(F.max(F.struct("labels", "n", "node", "blocks")).alias("r"), F.count("*").alias("members")).where("members > 1")
    each = tested.join(first.select(*(F.col(c).alias(f"_{c}") for c in pool), "r"), [tested[c].eqNullSafe(F.col(f"_{c}")) for c in pool]).drop(*(f"_{c}" for c in pool))
    # What follows a node beside what follows the first: m and k of each next segment.
    after = tree.select("host", F.col("above").alias("up"), (F.col("depth") - 1).alias("depth"), F.col("part").alias("next"), F.col("n").alias("m"))
    own = each.select("host", "depth", "node", F.col("node").alias("up")).join(after, ["host", "depth", "up"]).select("host", "depth", "node", "next", "m", F.lit(0).cast("long").alias("k"))
    other = each.select("host", "depth", "node", F.col("r.node").alias("up")).join(after, ["host", "depth", "up"]).select("host", "depth", "node", "next", F.lit(0).cast("long").alias("m"), F.col("m").alias("k"))
    both = own.unionByName(other).groupBy("host", "depth", "node", "next").agg(F.sum("m").alias("m"), F.sum("k").alias("k"))
    square = lambda x: F.sum(F.col(x) * F.col(x) / (F.col("m") + F.col("k")))
    both = both.groupBy("host", "depth", "node").agg(square("m").alias("mm"), square("k").alias("kk"), F.sum("m").alias("ms"), F.sum("k").alias("ks"), (F.count("*") - 1).alias("free"))
    chi = (F.col("ms") + F.col("ks")) * (F.col("mm") / F.col("ms") + F.col("kk") / F.col("ks") - 1)
    followers_alike = F.when((F.col("ms") > 0) & (F.col("ks") > 0), chi <= F.col("free") + merge_z * F.sqrt(2.0 * F.col("free")) + 1e-9).otherwise(F.coalesce(F.col("ms") + F.col("ks"), F.lit(0)) == 0)
    share = (F.col("blocks") + F.col("r.blocks")) / (F.col("labels") + F.col("r.labels"))
    apart = F.abs(F.col("blocks") / F.col("labels") - F.col("r.blocks") / F.col("r.labels"))
    labels_alike = apart <= merge_z * F.sqrt(share * (1 - share) * (1 / F.col("labels") + 1 / F.col("r.labels"))) + 1e-9
    alike = each.join(both, ["host", "depth", "node"], "left").where(labels_alike & followers_alike).select(*pool, "node", "blocks", "labels")
    shared = alike.groupBy(*pool).agg(F.sum("blocks").alias("some_blocks"), F.sum("labels").alias("some_labels"))
    shared = shared.select(*(F.col(c).alias(f"_{c}") for c in pool), "some_blocks", "some_labels")
    shared = alike.join(shared, [alike[c].eqNullSafe(F.col(f"_{c}")) for c in pool]).select("host", "depth", "node", "some_blocks", "some_labels")
    out = tree.join(shared, ["host", "depth", "node"], "left")
    return out.select("host", "depth", "node", F.coalesce("some_blocks", "blocks").alias("blocks"), F.coalesce("some_labels", "labels").alias("labels"))


def judge(urls: DataFrame, smooth: float = SMOOTH, reject: float = REJECT, merge_z: float = MERGE_Z, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Purity and verdict of every (host, shape) of urls (host, path, verdict: block, allow or null).

    Columns: host, shape, template, purity, labels, rejected. Hosts may be empty; an empty table gives no rows.
    """
    shaped = urls.select("host", segments(F.col("path")).alias("shape"), (F.col("verdict") == "block").cast("int").alias("b"), F.col("verdict").isNotNull().cast("int").alias("l"))
    counted = shaped.groupBy("host", "shape").agg(F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("blocks"), F.sum("l").alias("labels"))
    counted = cut(counted)  # one row a host and shape, used several times below
    named = counted.join(templates(counted, keep_share), ["host", "shape"])
    sums = [F.sum(c).alias(c) for c in ("n", "blocks", "labels")]
    leaves = cut(named.groupBy("host", "template").agg(*sums))
    # A node is a beginning of a template.
    nodes = leaves.select("host", "n", "blocks", "labels", "template", F.explode(F.sequence(F.lit(0), F.size("template"))).alias("depth"))
    begin = lambda d: f"array_join(slice(template, 1, {d}), '/')"
    nodes = nodes.select("host", "n", "blocks", "labels", "depth", F.expr(begin("depth")).alias("node"), F.expr(f"if(depth = 0, null, {begin('depth - 1')})").alias("above"), F.expr("if(depth = 0, '', template[depth - 1])").alias("part"))
    tree = cut(nodes.groupBy("host", "depth", "above", "node", "part").agg(*sums))
    by_node = merged(tree, merge_z).select("host", "depth", "node", F.struct("depth", "blocks", "labels").alias("at"))
    chains = leaves.select("host", "template", F.posexplode(F.expr("transform(sequence(0, size(template)), d -> array_join(slice(template, 1, d), '/'))")).alias("depth", "node"))
    chains = chains.join(by_node, ["host", "depth", "node"]).groupBy("host", "template").agg(F.array_sort(F.collect_list("at")).alias("chain"))
    # Above the host: the template in all hosts, and all urls, whose sums are one row.
    anywhere = leaves.groupBy("template").agg(F.sum("blocks").alias("t_blocks"), F.sum("labels").alias("t_labels"))
    a_blocks, a_labels = leaves.agg(F.sum("blocks"), F.sum("labels")).first()
    smoothed = lambda blocks, labels, prior: (blocks + smooth * prior) / (labels + smooth)
    start = smoothed(F.col("t_blocks"), F.col("t_labels"), F.lit(((a_blocks or 0) + smooth * 0.5) / ((a_labels or 0) + smooth)))
    purity = F.aggregate("chain", start, lambda p, x: smoothed(x["blocks"], x["labels"], p))
    scored = chains.join(anywhere, "template").select("host", "template", purity.alias("purity"), F.element_at("chain", -1)["labels"].alias("labels"))
    rejected = (F.col("purity") >= reject) & (F.col("labels") >= LEAST_LABELS)
    return named.select("host", "shape", "template").join(scored, ["host", "template"]).select("host", "shape", "template", "purity", "labels", rejected.alias("rejected"))


def filter_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity and labels of every row of pages (page_id, url).

    Null urls and those without :// have an empty host and path, and so the template of an empty path.
    """
    parsed = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumn("rule", name).withColumn("by_rule", verdict)
    judged = judge(ruled.select("host", "path", F.col("by_rule").alias("verdict"))).withColumnsRenamed({"host": "h", "shape": "s"})
    keyed = ruled.withColumn("shape", segments(F.col("path")))
    out = keyed.join(judged, (keyed.host == judged.h) & (keyed["shape"] == judged.s))
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"), F.array_join("template", "/").alias("template"), "purity", "labels")


def evaluate(pages: DataFrame, rules: tuple = RULES, folds: int = 5) -> DataFrame:
    """One row: how the templates judge urls that a rule decides when the rule's answer is hidden from them.

    pages: page_id, url. Of the ruled urls those whose crc32 of the id is 0 modulo ``folds`` are hidden. ruled, hidden,
    blocked (hidden ones that rules block), found (of these, rejected by their template), wrong (rejected, but allowed by rule).
    """
    parsed = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    _, verdict = rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumn("by_rule", verdict).withColumn("hidden", F.col("by_rule").isNotNull() & (F.pmod(F.crc32(F.col("page_id").cast("string").cast("binary")), F.lit(folds)) == 0))
    judged = judge(ruled.select("host", "path", F.when(~F.col("hidden"), F.col("by_rule")).alias("verdict"))).select(F.col("host").alias("h"), F.col("shape").alias("s"), "rejected")
    keyed = ruled.withColumn("shape", segments(F.col("path")))
    out = keyed.join(judged, (F.col("host") == F.col("h")) & (F.col("shape") == F.col("s")))
    count = lambda c, name: F.coalesce(F.sum(c.cast("int")), F.lit(0)).alias(name)
    is_block = F.col("by_rule") == "block"
    return out.agg(count(F.col("by_rule").isNotNull(), "ruled"), count(F.col("hidden"), "hidden"), count(F.col("hidden") & is_block, "blocked"), count(F.col("hidden") & is_block & F.col("rejected"), "found"), count(F.col("hidden") & ~is_block & F.col("rejected"), "wrong"))


def sql(rules: tuple = RULES, keep_share: float = KEEP_SHARE, smooth: float = SMOOTH, reject: float = REJECT, merge_z: float = MERGE_Z) -> str:
    """DuckDB SQL for the rows of ``filter_urls`` over pages, without purity."""
    fits = [(h + p, v, f"((host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}'))") for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1]))]
    name = "case " + " ".join(f"when {f} then '{n}'" for n, _, f in fits) + " end"
    verdict = "case " + " ".join(f"when {f} then '{v}'" for _, v, f in fits) + " end"
    return f"""
with recursive parsed as (
  select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
ruled as (select page_id, host, path, {name} as rule, {verdict} as by_rule,
  list_append(list_filter(string_split(regexp_replace(regexp_replace(path, '[0-9]+', '#', 'g'), '\\.([^./]*)\\z', '/.\\1'), '/'), lambda x: x <> ''), '$') as shape from parsed),
counted as (select host, shape, count(*) as n, sum(case when by_rule = 'block' then 1 else 0 end) as blocks, count(by_rule) as labels from ruled group by all),
each_segment as (select host, shape, n, d.depth, shape[d.depth] as segment from counted, unnest(range(1, len(shape) + 1)) as d(depth)),
counts as (select host, depth, segment, sum(n) as n from each_segment group by all),
totals as (select host, depth, sum(n) as total from counts group by all),
literal as (select c.host, c.depth, c.segment from counts c join totals t using (host, depth) where c.n >= t.total * {keep_share}),
named as (select e.host, e.shape, list(case when l.segment is not null or e.segment in ('#', '$') then e.segment else '*' end order by e.depth) as template
  from each_segment e left join literal l on e.host = l.host and e.depth = l.depth and e.segment = l.segment group by e.host, e.shape),
leaves as (select host, template, sum(n) as n, sum(blocks) as blocks, sum(labels) as labels from counted join named using (host, shape) group by all),
nodes as (select host, blocks, labels, n, d.depth, array_to_string(template[1:d.depth], '/') as node, case when d.depth > 0 then array_to_string(template[1:d.depth - 1], '/') end as above,
  case when d.depth = 0 then '' else template[d.depth] end as part from leaves, unnest(range(0, len(template) + 1)) as d(depth)),
tree as (select host, depth, above, node, part, sum(n) as n, sum(blocks)::double as blocks, sum(labels)::double as labels from nodes group by all),
tested as (select *, case when 2 * blocks >= labels then 1 else 0 end as side from tree where n >= {MERGE_URLS} and labels >= {MERGE_LABELS}),
first as (select host, depth, above, side, arg_max(node, (labels, n, node)) as r_node, arg_max(blocks, (labels, n, node)) as r_blocks, max(labels) as r_labels from tested group by all having count(*) > 1),
each_tested as (select v.*, r_node, r_blocks, r_labels from tested v join first f on f.host = v.host and f.depth = v.depth and f.above is not distinct from v.above and f.side = v.side),
followers as (select v.host, v.depth, v.node, c.part as next, c.n as m, 0 as k from each_tested v join tree c on c.host = v.host and c.depth = v.depth + 1 and c.above = v.node
  union all select v.host, v.depth, v.node, c.part, 0, c.n from each_tested v join tree c on c.host = v.host and c.depth = v.depth + 1 and c.above = v.r_node),
beside as (select host, depth, node, next, sum(m)::double as m, sum(k)::double as k from followers group by all),
squares as (select host, depth, node, sum(m * m / (m + k)) as mm, sum(k * k / (m + k)) as kk, sum(m) as ms, sum(k) as ks, count(*) - 1 as free from beside group by all),
alike as (select v.host, v.depth, v.above, v.side, v.node, v.blocks, v.labels from each_tested v left join squares q on q.host = v.host and q.depth = v.depth and q.node = v.node
  where abs(blocks / labels - r_blocks / r_labels) <= {merge_z} * sqrt((blocks + r_blocks) / (labels + r_labels) * (1 - (blocks + r_blocks) / (labels + r_labels)) * (1 / labels + 1 / r_labels)) + 1e-9
  and case when ms > 0 and ks > 0 then (ms + ks) * (mm / ms + kk / ks - 1) <= free + {merge_z} * sqrt(2.0 * free) + 1e-9 else coalesce(ms + ks, 0) = 0 end),
pooled as (select host, depth, above, side, sum(blocks) as some_blocks, sum(labels) as some_labels from alike group by all),
merged as (select t.host, t.depth, t.node, coalesce(some_blocks, t.blocks) as blocks, coalesce(some_labels, t.labels) as labels from tree t
  left join alike a on a.host = t.host and a.depth = t.depth and a.node = t.node left join pooled p on p.host = a.host and p.depth = a.depth and p.above is not distinct from a.above and p.side = a.side),
anywhere as (select template, sum(blocks)::double as t_blocks, sum(labels)::double as t_labels from leaves group by all),
overall as (select sum(blocks)::double as a_blocks, sum(labels)::double as a_labels from leaves),
walk as (
  select l.host, l.template, -1 as depth, 0::double as labels, (t_blocks + {smooth} * ((a_blocks + {smooth} * 0.5) / (a_labels + {smooth}))) / (t_labels + {smooth}) as purity
  from leaves l join anywhere using (template), overall
  union all
  select w.host, w.template, w.depth + 1, m.labels, (m.blocks + {smooth} * w.purity) / (m.labels + {smooth})
  from walk w join merged m on m.host = w.host and m.depth = w.depth + 1 and m.node = array_to_string(w.template[1:w.depth + 1], '/')
  where w.depth < len(w.template)),
judged as (select host, template, purity >= {reject} and labels >= {LEAST_LABELS} as rejected from walk where depth = len(template))
select r.page_id, r.host, r.path, r.rule, coalesce(r.by_rule, case when j.rejected then 'block' else 'allow' end) as verdict, array_to_string(n.template, '/') as template
from ruled r join named n on r.host = n.host and r.shape = n.shape join judged j on j.host = n.host and j.template = n.template
"""
