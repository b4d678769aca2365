"""URL filter by association rules over URL tokens.

Listed rules (host and path prefix) come first: the longest that fits decides. For all other urls, Spark's
FP-growth mines token combinations of labelled urls; those that imply a block with enough support,
confidence and lift, and that no shorter rule makes superfluous, match through an inverted index: a rule is
filed under its rarest token, urls meet it over that token, and the rest of its tokens is then looked up.

Only blocked rows are mined; the rows of all labels that hold a combination are then counted through the
same index. A rule needs ``least`` blocked labels besides the support share, and the lower Wilson limit of
its confidence (``z`` standard deviations) must reach the confidence asked for, so labels by chance make no
rule. Tokens that occur in the same rows are one item (the rule names all of them as alternatives), and
tokens of every row are none: so tokens that always go together don't multiply the combinations. Rules may
have any number of tokens.

``labelled_by_text`` gives labels that concern the pages themselves: a page is labelled as the documents
are whose text is its main text (with or without its title), equal but for white space.

Only distinct urls are matched, so a url that a third of the rows share is judged once. Nothing is
broadcast by request; joins of rules leave the choice to measured sizes, and the verdicts are joined from
a written table, so that Spark can split a hot url.

Edge cases: a null url or one without ``://`` has an empty host and path, fits no rule and no tokens, and is
allowed. Labels that contradict each other count one each. Without labels, or without blocked ones, nothing
is mined. Repeated rows are judged alike. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galefold.llm import mainhtml
from galefold.llm.shared import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The listed rules, host with path prefix.
LISTED = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, with A-Z lowered; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host_col: Column, path_col: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest listed rule that fits, or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        domain, _, prefix = rule.partition("/")
        fits = ((host_col == domain) | host_col.endswith(f".{domain}")) & path_col.startswith(f"/{prefix}")
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def tokens(url: Column) -> Column:
    """Distinct typed tokens: scheme, labels of the host, words of the path (digits as #), keys of the query, fragment."""
    tagged = lambda kind, values: F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    rest = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    every = F.concat(
        tagged("scheme:", F.array(F.translate(F.regexp_extract(url, r"(?s)^(.*?)://", 1), UPPER, LOWER))),
        tagged("host:", F.split(host(url), r"\.")),
        tagged("path:", F.split(F.regexp_replace(F.translate(path(url), UPPER, LOWER), r"[0-9]+", "#"), r"[/.]")),
        tagged("key:", F.transform(F.split(rest, "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1)))),
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    return F.coalesce(F.array_distinct(every), F.array().cast("array<string>"))


def lower_limit(share: Column, n: Column, z: float) -> Column:
    """Lower limit of Wilson's interval of a share of ``n`` rows."""
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def held_by(rows: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key, rule, antecedent): which rows (key, own: array of tokens) hold which rules (rule, antecedent: array of arrays of alternatives)."""
    spread = rows.select(key, "own", F.explode("own").alias("token"))
    sides = rules.select("rule", "antecedent", F.posexplode("antecedent").alias("at", "part"))
    weight = sides.select(F.explode("part").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    # A rule's key: of its parts the one whose tokens the fewest rules have.
    parts = sides.select("rule", "at", F.explode("part").alias("token")).join(weight, "token").groupBy("rule", "at").agg(F.sum("n").alias("n"))
    rarest = parts.groupBy("rule").agg(F.min_by("at", F.struct("n", "at")).alias("at"))
    filed = sides.join(rarest, ["rule", "at"]).select("rule", "antecedent", F.explode("part").alias("token"))
    met = spread.join(filed, "token").where(F.forall("antecedent", lambda part: F.arrays_overlap(part, F.col("own"))))
    return met.select(key, "rule", "antecedent").dropDuplicates([key, "rule"])


RULES = "rule bigint, antecedent array<array<string>>, n_rows bigint, n_blocked bigint, confidence double, lift double"


def mined(labelled: DataFrame, support: float = 0.002, confidence: float = 0.6, lift: float = 1.5, least: int = 20, z: float = 1.645) -> DataFrame:
    """(rule, antecedent, n_rows, n_blocked, confidence, lift) of the pruned rules; ``labelled`` has url and blocked (boolean).

    An antecedent is a list of parts, each a list of tokens of which a url must have one.
    """
    spark = labelled.sparkSession
    work = Scratch(spark, "urlrules")
    rows = labelled.where("url IS NOT NULL AND blocked IS NOT NULL").select(F.monotonically_increasing_id().alias("row"), tokens(F.col("url")).alias("own"), "blocked")
    rows = work.keep(rows.where(F.size("own") > 0))
    sums = rows.agg(F.count("*").alias("n"), F.count_if("blocked").alias("b")).head()
    floor = max(least, support * sums["n"])
    empty = spark.createDataFrame([], RULES)
    if sums["b"] < max(1, floor):
        work.drop()
        return empty
    # Tokens of the same rows are one item; those of every row say nothing.
    spread = rows.select("row", "blocked", F.explode("own").alias("token"))
    known = spread.groupBy("token").agg(F.count("*").alias("n"), F.count_if("blocked").alias("b"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y"))
    items = known.where((F.col("b") >= floor) & (F.col("n") < sums["n"])).groupBy("n", "x", "y").agg(F.array_sort(F.collect_set("token")).alias("part"))
    items = work.keep(items.select("part", F.col("part")[0].alias("item")))
    told = items.select("part", "item", F.explode("part").alias("token"))
    baskets = spread.where("blocked").join(told, "token").groupBy("row").agg(F.collect_set("item").alias("items"))
    baskets = work.keep(baskets.select("items"))
    if baskets.isEmpty():
        work.drop()
        return empty
    # Half a row less, so that rounding excludes no combination of just as many rows.
    held = baskets.count()
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (floor - 0.5) / held), numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(baskets)
    found = work.keep(model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n_blocked")).where(F.col("n_blocked") >= floor))
    named = found.select("items", "n_blocked", F.posexplode("items").alias("at", "item")).join(items, "item")
    candidates = named.groupBy("items", "n_blocked").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts"))
    candidates = work.keep(candidates.select(F.xxhash64("items").alias("rule"), "items", F.col("parts.part").alias("antecedent"), "n_blocked"))
    counts = held_by(rows, candidates, "row").groupBy("rule").agg(F.count("*").alias("n_rows"))
    rules = candidates.join(counts, "rule").withColumn("confidence", F.col("n_blocked") / F.col("n_rows")).withColumn("lift", F.col("confidence") * sums["n"] / sums["b"])
    rules = work.keep(rules.where((F.col("lift") >= lift) & (lower_limit(F.col("confidence"), F.col("n_rows"), z) >= confidence)))
    # A rule goes if one without one of its items is as sure.
    fewer = F.explode(F.transform("items", lambda x: F.array_remove("items", x)))
    shorter = rules.select(F.col("items").alias("fewer"), F.col("confidence").alias("sure"))
    needless = rules.select("rule", "confidence", fewer.alias("fewer")).join(shorter, "fewer").where("sure >= confidence").select("rule").distinct()
    out = Scratch(spark, "urlrules-found").keep(rules.join(needless, "rule", "left_anti").select(*[x.split()[0] for x in RULES.split(", ")]))
    work.drop()
    return out


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, hits) of the distinct urls that fulfil a rule or more."""
    return held_by(urls.select("url", tokens(F.col("url")).alias("own")), rules, "url").groupBy("url").agg(F.count("*").alias("hits"))


def precision(rules: DataFrame, labelled: DataFrame) -> tuple[int, int]:
    """How many rows of ``labelled`` (url, blocked) the rules block, and how many of these are labelled so."""
    hits = matched(labelled.select("url").where("url IS NOT NULL").distinct(), rules)
    r = labelled.join(hits, "url").agg(F.count("*").alias("n"), F.count_if("blocked").alias("b")).head()
    return r["n"], r["b"]


def labelled_by_text(pages: DataFrame, docs: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(url, blocked) of the pages whose main text is a labelled document: blocked if most such labels are bad (low quality or toxic)."""
    even = lambda text: F.trim(F.regexp_replace(text, r"\s+", " "))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    judged_ids = labels.select("doc_id", bad.alias("bad")).where("doc_id IS NOT NULL AND bad IS NOT NULL")
    # Only ids and hashes are shuffled.
    keyed = docs.select("doc_id", F.xxhash64(even(F.col("text").cast("string"))).alias("key")).where("doc_id IS NOT NULL AND key IS NOT NULL")
    # Both grow with the corpus: merged, not broadcast on a first guess of their size.
    known = keyed.join(judged_ids.hint("merge"), "doc_id").groupBy("key").agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
    title = even(F.coalesce(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit("")))
    own = mainhtml.extract(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")), keep_html=True)
    own = own.where("text <> ''").withColumn("title", title)
    bare = F.when(F.startswith("text", F.concat("title", F.lit(" "))), F.substr("text", F.length("title") + 2)).otherwise(F.col("text"))
    keys = own.select("page_id", "url", F.explode(F.array_distinct(F.array(F.xxhash64("text"), F.xxhash64(bare)))).alias("key"))
    told = keys.join(known.hint("merge"), "key").groupBy("page_id", "url").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    return told.select(F.col("url").cast("string").alias("url"), (2 * F.col("bad") > F.col("n")).alias("blocked"))


def judged(
    pages: DataFrame,
    labelled: DataFrame,
    rules: list[tuple[str, str]] | None = None,
    support: float = 0.002,
    confidence: float = 0.6,
    lift: float = 1.5,
    least: int = 20,
    z: float = 1.645,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per row: page_id, host, path, rule (the listed one, or null), verdict (allow or block), mined_hits."""
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    distinct = rows.where("url IS NOT NULL").select("url").distinct()
    open_urls = distinct.where(listed(host(url), path(url), rules or LISTED).isNull())
    learnt = mined(labelled, support, confidence, lift, least, z)
    hits = Scratch(pages.sparkSession, "urlhits").keep(matched(open_urls, learnt))
    own = rows.join(hits, "url", "left").select("page_id", host(url).alias("host"), path(url).alias("path"), F.coalesce("hits", F.lit(0).cast("bigint")).alias("mined_hits"))
    own = own.withColumn("listed", listed(F.col("host"), F.col("path"), rules or LISTED))
    verdict = F.coalesce(F.col("listed.verdict"), F.when(F.col("mined_hits") > 0, "block").otherwise("allow"))
    return own.select("page_id", "host", "path", F.col("listed.rule").alias("rule"), verdict.alias("verdict"), "mined_hits")


def listed_sql() -> str:
    """page_id, host, path and rule in DuckDB's SQL."""
    whens = " ".join(
        f"WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '/{p}') THEN '{d}/{p}'" for d, _, p in (r.partition("/") for r, _ in sorted(LISTED, key=lambda r: -len(r[0])))
    )
    return rf"""
WITH u AS (SELECT page_id, strpos(url, '://') AS cut, url FROM pages),
r AS (SELECT page_id, CASE WHEN cut > 0 THEN substr(url, cut + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r)
SELECT page_id, host, path, CASE {whens} END AS rule FROM h
"""
