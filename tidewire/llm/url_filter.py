"""URL filters by a path-template tree, in DataFrame functions only.

A page lies in the tree of its host: the root, first path segment, second, and so on to its last, whatever its depth.
Variable segments are wildcards: a segment with a digit, or one of a branch with too many values. Rules label the pages they
fit. Sibling branches whose labelled purity can't be told from the rest of their parent's (a chi-square test) are merged to one
node, from the root down: they share their labels, and what is below them meets, segment by segment, and is tested again. A template is rejected if its purity, smoothed towards that of all labelled pages, is too low. A page
without a rule is judged by the deepest template on its way with labelled pages: its host's own, else that of its host's
suffix, else that of any host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import small, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A branch with more distinct children than this has a wildcard child instead, and so have all below.
CHILDREN = 50
#: Chi-square (one degree of freedom, 10 %) up to which a branch is like its siblings.
ALIKE = 2.706
#: Pages that the overall purity counts as in smoothing, and the purity in tenths below which a template is rejected.
STRENGTH, PURE_TENTHS = 2, 6


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (Rule("com", "/", True), Rule("example.com", "/en/", False), Rule("www.example.com", "/en/", True), Rule("net", "/es/", False), Rule("net", "/fr/", False))


def parts(url: Column) -> tuple[Column, Column]:
    """host and path of a url; both empty without ://."""
    whole = F.coalesce(url, F.lit(""))
    has = F.instr(whole, "://") > 0
    host = F.translate(F.regexp_extract(whole, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def fitting(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """(name, allow) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<name:string,allow:boolean>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.allow).alias("allow"))).otherwise(out)
    return out


def alike(good: Column, bad: Column, all_good: Column, all_bad: Column) -> Column:
    """Whether a branch's share of good pages can't be told from that of its siblings; also without siblings, or if all are of one kind."""
    g, b, gg, bb = (x.cast("double") for x in (good, bad, all_good, all_bad))
    n, other = g + b, gg + bb - g - b
    differ = g * (bb - b) - b * (gg - g)
    return (gg + bb) * differ * differ <= F.lit(ALIKE) * n * other * gg * bb


def merged(tree: DataFrame) -> DataFrame:
    """tree (host, way, segs, good, bad: one row a template) with names: what each template's nodes are called from the root down, an empty one for the root and
    for merged branches, so that equal lists of names are one node.

    A round for each depth, as what is merged decides what meets below. Where no node holds two labelled templates any more nothing is left to merge,
    and the rest of the names are the segments; so there are as many rounds as labelled templates of a host have common levels.
    """
    now = written(tree.withColumn("names", F.array(F.lit(""))), "url-names")
    depth = 0
    while True:
        depth += 1
        open_ = now.where((F.size("segs") >= depth) & (F.col("good") + F.col("bad") > 0))
        if not open_.groupBy("host", "names").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
            break
        child = F.element_at("segs", depth)
        each = open_.groupBy("host", "names", child.alias("seg")).agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
        whole = each.groupBy("host", "names").agg(F.sum("g").alias("gg"), F.sum("b").alias("bb"))
        like = each.join(whole, ["host", "names"]).where(alike(F.col("g"), F.col("b"), F.col("gg"), F.col("bb")))
        like = small(written(like.select("host", "names", "seg", F.lit("").alias("_name")), "url-alike"))
        deeper = now.withColumn("seg", F.try_element_at("segs", F.lit(depth))).join(like, ["host", "names", "seg"], "left")
        name = F.coalesce("_name", "seg")
        now = written(deeper.withColumn("names", F.when(F.size("segs") >= depth, F.concat("names", F.array(name))).otherwise(F.col("names"))).select(*now.columns), "url-names")
    rest = F.slice("segs", F.lit(depth), F.greatest(F.size("segs") - depth + 1, F.lit(0)))
    return now.withColumn("names", F.when(F.size("segs") >= depth, F.concat("names", rest)).otherwise(F.col("names")))


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template for each row of pages (page_id, url).

    Null urls and those without :// have an empty host and path and no rule, and are judged by the template of an empty path.
    template: the page's own, with wildcards. Without any labelled page the verdict is allow. A path is read to its end.
    Repeated rows are judged alike and count each; a purity of exactly PURE_TENTHS is allowed; an empty table
    gives no rows; further columns, html too, aren't read. Pages are read twice, to count templates and to give verdicts.
    """
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    split = split.withColumn("fit", fitting(F.col("host"), F.col("path"), rules))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    split = split.withColumn("segs", F.transform(segments, lambda s: F.when(s.rlike("[0-9]"), "*").otherwise(s))).withColumn("way", F.concat_ws("/", "segs"))
    keys = split.groupBy("host", "way", "segs").agg(F.sum(F.when(F.col("fit.allow"), 1).otherwise(0)).alias("good"), F.sum(F.when(~F.col("fit.allow"), 1).otherwise(0)).alias("bad"))
    # One row for each distinct template of a host: small beside the pages, and read more than once.
    keys = written(keys, "url-keys")
    below = lambda upto: F.concat_ws("/", F.slice("segs", F.lit(1), upto))
    # Branches with many children get a wildcard.
    levels = keys.select("host", "way", "segs", F.explode(F.sequence(F.lit(1), F.size("segs") + 1)).alias("level"))
    levels = levels.select("host", "way", "level", below(F.col("level") - 1).alias("above"), F.coalesce(F.try_element_at("segs", F.col("level")), F.lit("")).alias("child"))
    wide = levels.groupBy("host", "level", "above").agg(F.count_distinct("child").alias("c")).where(F.col("c") > CHILDREN).drop("c")
    wild = levels.join(wide, ["host", "level", "above"]).groupBy("host", "way").agg(F.min("level").alias("wild"))
    tree = keys.join(wild, ["host", "way"], "left")
    tree = tree.withColumn("segs", F.transform("segs", lambda s, k: F.when(k + 1 >= F.col("wild"), "*").otherwise(s)))
    tree = tree.select("host", "way", "segs", "good", "bad")
    nodes = merged(tree).select("host", F.substring_index("host", ".", -1).alias("suffix"), "way", "segs", "names", "good", "bad", F.explode(F.sequence(F.lit(0), F.size("segs"))).alias("depth"))
    node, name = F.concat(F.lit("/"), below(F.col("depth"))), F.array_join(F.slice("names", F.lit(1), F.col("depth") + 1), "/")
    nodes = written(nodes.select("host", "suffix", "way", "depth", node.alias("node"), name.alias("name"), F.concat(F.lit("/"), F.concat_ws("/", "segs")).alias("template"), "good", "bad"), "url-nodes")
    branch = nodes.groupBy("host", "suffix", "depth", "node", "name").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    labelled = branch.where("good + bad > 0")
    own = labelled.groupBy("host", "name").agg(F.sum("good").alias("hg"), F.sum("bad").alias("hb"))
    # Many hosts share a suffix's nodes: these tables are sent to all tasks where they are small, and joined by a shuffle that can be split beyond.
    under = small(written(labelled.groupBy("suffix", "depth", "node").agg(F.sum("good").alias("sg"), F.sum("bad").alias("sb")), "url-suffixes"))
    anywhere = small(written(under.groupBy("depth", "node").agg(F.sum("sg").alias("ag"), F.sum("sb").alias("ab")), "url-anywhere"))
    total = keys.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("g"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")).first()
    told = branch.select("host", "suffix", "depth", "node", "name").join(own, ["host", "name"], "left").join(under, ["suffix", "depth", "node"], "left").join(anywhere, ["depth", "node"], "left")

    def pure(good: str, bad: str) -> Column:
        """Whether the smoothed purity, (good + STRENGTH share) / (all + STRENGTH), reaches PURE_TENTHS; in whole numbers. Null without pages."""
        n, every = F.col(good) + F.col(bad), max(1, total.g + total.b)
        return F.when(n > 0, 10 * (F.col(good) * every + STRENGTH * total.g) >= PURE_TENTHS * (n + STRENGTH) * every)

    told = told.select("host", "node", "name", F.coalesce(pure("hg", "hb"), pure("sg", "sb"), pure("ag", "ab")).alias("pure")).where("pure is not null")
    verdicts = nodes.join(told, ["host", "node", "name"], "left").groupBy("host", "way").agg(F.first("template").alias("template"), F.max_by("pure", F.when(F.col("pure").isNotNull(), F.col("depth"))).alias("pure"))
    verdicts = written(verdicts.select(F.col("host").alias("vh"), F.col("way").alias("vw"), "template", F.coalesce("pure", F.lit(True)).alias("pure")), "url-verdicts")
    out = split.join(verdicts, (F.col("host") == F.col("vh")) & (F.col("way") == F.col("vw")))
    return out.select("page_id", "host", "path", F.col("fit.name").alias("rule"), F.when(F.coalesce("fit.allow", "pure"), "allow").otherwise("block").alias("verdict"), "template")


#: The same in DuckDB's SQL.
ORACLE = r"""
with recursive p as (
  select page_id, case when contains(coalesce(url, ''), '://') then translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
    case when contains(coalesce(url, ''), '://') then regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) else '' end as path from pages),
s as (
  select *, case
    when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule,
    rule in ('com/', 'www.example.com/en/') as allow,
    list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: case when regexp_matches(x, '[0-9]') then '*' else x end) as segs from p),
k as (select host, segs, count(*) filter (where allow) as good, count(*) filter (where not allow) as bad from s group by all),
l as (select host, segs, unnest(range(1, len(segs) + 2)) as level from k),
c as (select host, level, segs[1:level - 1] as above, count(distinct coalesce(segs[level], '')) as c from l group by all),
w as (select l.host, l.segs, min(l.level) as wild from l join c on c.host = l.host and c.level = l.level and c.above = l.segs[1:l.level - 1] where c.c > 50 group by all),
t as (select k.host, k.segs, string_split(k.host, '.')[-1] as suffix, good, bad, list_transform(k.segs, lambda x, i: case when i >= wild then '*' else x end) as way from k left join w on w.host = k.host and w.segs = k.segs),
x(host, segs, suffix, good, bad, way, depth, names) as (select host, segs, suffix, good, bad, way, 0, [''] from t
  union all select host, segs, suffix, good, bad, way, depth + 1, list_append(names, case when g + h > 0 and
    (gd + bd) * (g * (bd - h) - h * (gd - g)) * (g * (bd - h) - h * (gd - g)) <= 2.706::double * (g + h) * (gd + bd - g - h) * gd * bd then '' else way[depth + 1] end)
  from (select *, cast(sum(good) over (partition by host, names, way[depth + 1]) as double) as g, cast(sum(bad) over (partition by host, names, way[depth + 1]) as double) as h,
    cast(sum(good) over (partition by host, names) as double) as gd, cast(sum(bad) over (partition by host, names) as double) as bd from x where len(way) > depth)),
n as (select host, segs, suffix, good, bad, depth, names, '/' || array_to_string(way, '/') as template, way[1:depth] as node from x),
b as (select host, suffix, depth, node, names, sum(good) as good, sum(bad) as bad from n group by all),
a as (select * from b where good + bad > 0),
m as (select host, names, sum(good) as hg, sum(bad) as hb from a group by all),
u as (select suffix, depth, node, sum(good) as sg, sum(bad) as sb from a group by all),
e as (select depth, node, sum(sg) as ag, sum(sb) as ab from u group by all),
o as (select sum(good) as tg, greatest(1, sum(good) + sum(bad)) as tn from k),
v as (select b.host, b.node, b.names, case
    when hg + hb > 0 then 10 * (hg * tn + 2 * tg) >= 6 * (hg + hb + 2) * tn
    when sg + sb > 0 then 10 * (sg * tn + 2 * tg) >= 6 * (sg + sb + 2) * tn
    when ag + ab > 0 then 10 * (ag * tn + 2 * tg) >= 6 * (ag + ab + 2) * tn end as pure
  from b cross join o left join m on m.host = b.host and m.names = b.names left join u on u.suffix = b.suffix and u.depth = b.depth and u.node = b.node left join e on e.depth = b.depth and e.node = b.node),
j as (select n.host, n.segs, any_value(template) as template, coalesce(arg_max(pure, depth) filter (where pure is not null), true) as pure from n join v on v.host = n.host and v.node = n.node and v.names = n.names group by all)
select page_id, s.host, path, rule, case when coalesce(allow, pure) then 'allow' else 'block' end as verdict, template from s join j on j.host = s.host and j.segs = s.segs
"""
