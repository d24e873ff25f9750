"""URL filters: host rules, and a path-template tree with labelled purity where no rule fits.

Rules. A rule is a host and a path start; it fits its host and all subdomains. The longest
fitting rule decides.

Tree. Urls shrink to (host, typed path) keys with page and label counts first, summed
before their shuffle, so repeated urls are one row from here on. Typing
replaces long runs of hexadecimal digits and dashes by ``<x>`` and other digit runs by
``<n>``. Then, level by level from each host's root, a segment that is not just typed is
variable, and becomes the wildcard ``*``, if fewer than ``min_pages`` pages have it behind the same
template, on its host or any other: too few to be judged by. A segment with more stays, however many
siblings it has, so a section keeps its own labels whatever else a site adds, and shares them
with sections of the same name elsewhere. Templates of one key, or with fewer than
``min_pages`` pages, are finished at once, so levels go on only as deep as different paths share a start.

Merging. Sibling templates (equal but for one literal, the first) are ordered by labelled
purity and merged while neighbours' shares of blocked pages differ by less than ``z``
standard errors; siblings without ``min_labels`` labels are never merged.

Verdict. Purity is smoothed by back-off, so labels reach hosts that have none: the purity of
a merged branch on its host is (blocked + weight * p) / (labelled + weight) with p the
purity of the same template on the host's last two labels; that one backs off to the last
label, that to the template on any host, and that to the share of all labelled pages. A
template is blocked if it has ``min_labels`` labelled pages on any hosts and its purity is
at least ``threshold``; otherwise it is allowed. Labels are the pages that the rules decide
and those of ``labels``.

Hot hosts. Every join meets an aggregate that lies in files, so a side that a third of all
keys share can be split; the only ordered groups are a host's siblings with labels enough.

Edge cases: a null url, or one without ``://``, has an empty host and path, no rule, and
the template of the empty host; repeated pages count each, also as labels; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.runtime import Tables, cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed values of the query: (verdict, rule).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

# Fixed value: an identifier in hexadecimal.
HEX = r"\b[0-9A-Fa-f][0-9A-Fa-f-]{14,}[0-9A-Fa-f]\b"

MIN_LABELS = 5
MIN_PAGES = 5
WEIGHT = 2.0
THRESHOLD = 0.8
Z = 2.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        own, slash, start = r.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def typed_path(path: Column) -> Column:
    """All segments of a path, identifiers typed."""
    seg = F.split(F.regexp_replace(path, "^/", ""), "/")
    return F.transform(seg, lambda s: F.regexp_replace(F.regexp_replace(s, HEX, "<x>"), r"[0-9]+", "<n>"))


def _literal(s: Column) -> Column:
    return ~s.isin("<n>", "<x>", "")


def templates(keys: DataFrame, min_pages: int = MIN_PAGES, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """``keys`` (host, seg array, pages, ...) with ``template``: seg with variable literals as ``*``."""
    columns = [*keys.columns, "template"]
    rest, finished, level = keep(keys.withColumn("template", F.array().cast("array<string>"))), [], 0
    while True:
        level += 1
        here = rest.withColumn("_s", F.try_element_at("seg", F.lit(level)))
        finished.append(here.where("_s IS NULL").select(columns))
        here = here.where("_s IS NOT NULL")
        child = keep(here.groupBy("template", "_s").agg(F.sum("pages").alias("_p"), F.count(F.lit(1)).alias("_n")))
        if child.isEmpty():
            break
        step = F.when(_literal(F.col("_s")) & (F.col("_p") < min_pages), "*").otherwise(F.col("_s"))
        child = child.withColumn("_step", step)
        stars = keep(child.where("_step = '*'").groupBy("template").agg(F.sum("_p").alias("_sp"), F.sum("_n").alias("_sn")))
        here = here.join(child.join(stars.hint("merge"), "template", "left").hint("merge"), ["template", "_s"])
        star = F.col("_step") == "*"
        pages, n = F.when(star, F.col("_sp")).otherwise(F.col("_p")), F.when(star, F.col("_sn")).otherwise(F.col("_n"))
        here = here.withColumns({"template": F.concat("template", F.array("_step")), "_few": pages < min_pages, "_one": n == 1})
        here = keep(here)
        left = F.slice("seg", level + 1, F.greatest(F.size("seg") - level, F.lit(0)))
        whole = F.concat("template", F.when(F.col("_few"), F.transform(left, lambda s: F.when(_literal(s), "*").otherwise(s))).otherwise(left))
        finished.append(here.where("_few OR _one").withColumn("template", whole).select(columns))
        rest = here.where("NOT (_few OR _one)").select(columns)
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out


def judge(keys: DataFrame, min_labels: int = MIN_LABELS, weight: float = WEIGHT, threshold: float = THRESHOLD, z: float = Z, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """``keys`` (host, seg, template, pages, labelled, blocked) with merged ``branch`` and ``verdict``."""
    keys = keep(keys)
    leaf = keys.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    is_literal = lambda s: ~s.contains("<") & ~s.contains("*") & (s != "")
    first = F.array_position(F.transform("template", is_literal), True)
    shape = F.when(first == 0, F.col("template")).otherwise(F.concat(F.slice("template", 1, F.greatest(first - 1, F.lit(0)).cast("int")), F.array(F.lit("?")), F.slice("template", (first + 1).cast("int"), F.size("template"))))
    leaf = keep(leaf.withColumns({"shape": shape, "p": F.when(F.col("n") >= min_labels, F.col("b") / F.col("n"))}))
    w = Window.partitionBy("host", "shape").orderBy("p", "n", "template")
    pooled = (F.lag("b").over(w) + F.col("b")) / (F.lag("n").over(w) + F.col("n"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.lag("n").over(w) + 1 / F.col("n")))
    apart = F.lag("p").over(w).isNull() | (F.col("p") - F.lag("p").over(w) > z * error)
    told = leaf.where("p IS NOT NULL").withColumn("apart", apart.cast("int")).withColumn("branch", F.sum("apart").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    told = keep(told.drop("apart"))
    merged = keep(told.groupBy("host", "shape", "branch").agg(F.sum("n").alias("bn"), F.sum("b").alias("bb")))
    out = told.join(merged.hint("merge"), ["host", "shape", "branch"])
    bare = leaf.where("p IS NULL").withColumns({"branch": F.lit(None).cast("long"), "bn": F.col("n"), "bb": F.col("b")})
    out = out.unionByName(bare)
    total = leaf.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    smooth = lambda b, n, p: (F.col(b) + weight * p) / (F.col(n) + weight)
    parts = F.split("host", r"\.")
    ends = {"d2": F.array_join(F.slice(parts, -F.least(F.lit(2), F.size(parts)), 2), "."), "d1": F.element_at(parts, -1)}
    out, leaf = out.withColumns(ends), leaf.withColumns(ends)
    for name, by in (("any", ["template"]), ("top", ["d1", "template"]), ("domain", ["d2", "template"])):
        known = keep(leaf.groupBy(*by).agg(F.sum("n").alias(f"{name}_n"), F.sum("b").alias(f"{name}_b")))
        out = out.join(known.hint("merge"), by)  # the sums lie in files, so a very common template can be split
    p = F.lit(((total.b or 0) + 1) / ((total.n or 0) + 2))
    for name in ("any", "top", "domain"):
        p = smooth(f"{name}_b", f"{name}_n", p)
    out = out.withColumn("purity", smooth("bb", "bn", p))
    out = out.withColumn("verdict", F.when((F.col("any_n") >= min_labels) & (F.col("purity") >= threshold), "block").otherwise("allow"))
    return keys.join(out.select("host", "template", "branch", "purity", "verdict").hint("merge"), ["host", "template"])


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, page_id: str = "page_id", url: str = "url", labels: DataFrame | None = None, teaches: Column | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, learned, template, purity), one row per page.

    ``labels``: (page_id, bad 0/1), known besides the rules; several of one page count as bad
    if any is. ``teaches``: a condition on host and path; pages that fail it are judged, but
    their labels are not learned from. ``learned`` is the tree's verdict, whether a rule fits or not.
    """
    own = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = own.withColumns({"rule": rule, "known": verdict, "seg": typed_path(F.col("path"))})
    label = F.col("known")
    if labels is not None:
        bad = labels.where("bad IN (0, 1)").groupBy("page_id").agg(F.when(F.max("bad") == 1, "block").otherwise("allow").alias("given"))
        own = own.join(bad.hint("merge"), "page_id", "left")
        label = F.coalesce("known", "given")
    if teaches is not None:
        label = F.when(teaches, label)
    keys = own.withColumn("label", label).groupBy("host", "seg").agg(F.count(F.lit(1)).alias("pages"), F.count("label").alias("labelled"), F.count_if(F.col("label") == "block").alias("blocked"))
    with Tables(pages.sparkSession, "urls") as keep:
        tree = cut(judge(templates(keys, keep=keep), keep=keep).select("host", "seg", "template", "purity", F.col("verdict").alias("learned")))
    out = own.join(tree.hint("merge"), ["host", "seg"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("known", "learned").alias("verdict"), "learned", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity")


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdicts on all pages."""
    from quorumtext.runtime import table

    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    """The same in DuckDB: rules, typed paths, wildcards level by level, merged branches, back-off."""
    fit = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')", v, r) for v, r in sorted(RULES, key=lambda x: -len(x[1])) for h, _, p in [r.partition("/")]]
    case = lambda k: "CASE " + " ".join(f"WHEN {c} THEN '{x[k]}'" for c, *x in fit) + " END"
    return rf"""
    WITH RECURSIVE u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    o AS (SELECT *, {case(1)} AS rule, {case(0)} AS known,
          list_transform(string_split(regexp_replace(path, '^/', ''), '/'), lambda x: regexp_replace(regexp_replace(x, '{HEX}', '<x>', 'g'), '[0-9]+', '<n>', 'g')) AS g FROM u),
    own AS (SELECT page_id, host, path, rule, known, g AS seg FROM o),
    t AS (SELECT host, seg, count(*) AS pages, count(known) AS labelled, count(*) FILTER (known = 'block') AS blocked, CAST([] AS VARCHAR[]) AS template, 0 AS k FROM own GROUP BY host, seg
          UNION ALL
          SELECT host, seg, pages, labelled, blocked, list_append(template, CASE WHEN s NOT IN ('<n>', '<x>', '') AND sum(pages) OVER (PARTITION BY template, s) < {MIN_PAGES} THEN '*' ELSE s END), k + 1
          FROM (SELECT *, seg[k + 1] AS s FROM t WHERE k < len(seg))),
    done AS (SELECT * FROM t WHERE k = len(seg)),
    leaf AS (SELECT host, template, sum(labelled) AS n, sum(blocked) AS b FROM done GROUP BY ALL),
    f AS (SELECT *, coalesce(list_position(list_transform(template, lambda x: NOT contains(x, '<') AND NOT contains(x, '*') AND x <> ''), true), 0) AS i,
          CASE WHEN n >= {MIN_LABELS} THEN b / n END AS p FROM leaf),
    h AS (SELECT *, CASE WHEN i = 0 THEN template ELSE template[1:i - 1] || ['?'] || template[i + 1:] END AS shape FROM f),
    l AS (SELECT *, lag(b) OVER w AS lb, lag(n) OVER w AS ln, lag(p) OVER w AS lp FROM h WINDOW w AS (PARTITION BY host, shape, p IS NULL ORDER BY p, n, template)),
    e AS (SELECT *, (lb + b) / (ln + n) AS q FROM l),
    a AS (SELECT *, CAST(p IS NULL OR lp IS NULL OR p - lp > {Z} * sqrt(q * (1 - q) * (1 / ln + 1 / n)) AS INTEGER) AS apart FROM e),
    c AS (SELECT *, sum(apart) OVER (PARTITION BY host, shape, p IS NULL ORDER BY p, n, template ROWS UNBOUNDED PRECEDING) AS branch,
          array_to_string(string_split(host, '.')[-2:], '.') AS d2, string_split(host, '.')[-1] AS d1 FROM a),
    y AS (SELECT host, template, sum(n) OVER (PARTITION BY host, shape, p IS NULL, branch) AS bn, sum(b) OVER (PARTITION BY host, shape, p IS NULL, branch) AS bb,
          sum(n) OVER (PARTITION BY template) AS an, sum(b) OVER (PARTITION BY template) AS ab, sum(n) OVER (PARTITION BY d1, template) AS tn, sum(b) OVER (PARTITION BY d1, template) AS tb,
          sum(n) OVER (PARTITION BY d2, template) AS dn, sum(b) OVER (PARTITION BY d2, template) AS db, (sum(b) OVER () + 1) / (sum(n) OVER () + 2) AS prior FROM c),
    z AS (SELECT host, template, CASE WHEN an >= {MIN_LABELS} AND (bb + {WEIGHT} * (db + {WEIGHT} * (tb + {WEIGHT} * (ab + {WEIGHT} * prior) / (an + {WEIGHT})) / (tn + {WEIGHT})) / (dn + {WEIGHT})) / (bn + {WEIGHT}) >= {THRESHOLD} THEN 'block' ELSE 'allow' END AS learned FROM y),
    k AS (SELECT t.host, t.seg, z.learned FROM done t JOIN z ON t.host = z.host AND t.template = z.template)
    SELECT own.page_id, own.host, own.path, own.rule, coalesce(own.known, k.learned) AS verdict FROM own JOIN k ON own.host = k.host AND own.seg = k.seg
"""


ORACLE = _oracle()
