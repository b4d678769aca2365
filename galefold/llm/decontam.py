"""Benchmark decontamination by template canonicalisation, in DataFrame expressions only.

Texts become tokens in which numbers, names (capitalised words inside a sentence) and units after a number
are typed placeholders; other words are lower-cased. A token of a placeholder keeps its value behind its mark.
Windows of ``WINDOW`` tokens of the benchmark items are hashed and meet those of the texts in a hash join:
windows with ``LITERALS`` ordinary words or more by their templates, so that re-parameterised ones meet;
windows with fewer, which say too little as templates, by their values.
The matches of one text and item at the same shift are one alignment; it counts if its slots are
consistent: each value of a slot of the item has a single counterpart in the text, and two names stay two
(numbers may become equal). An item leaks into a text if consistent alignments cover ``percent`` % of its tokens.

A capital is a name only after a word and a blank; the first word of an item is taken both as an ordinary
word and as a name, as a text may quote the item inside of a sentence.

The item side is broadcast only if a count finds at most ``broadcast_windows`` windows; beyond that the
join shuffles hashes with the values of their own window, never texts. The documents' windows are made,
hashed and probed in one generated stage, and one scan serves all sizes of windows.

Edge cases: null or short texts have no windows; items shorter than a window are one window of their own
length; items of under ``LEAST`` tokens say too little to be looked for. A text is known by its id and its hash, so rows with a null
or repeated id are judged each on its own. Repeated rows add nothing, an item repeated in a text neither.
Extra columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galefold.llm.shared import Scratch

WINDOW = 6
LITERALS = 3
LEAST = 3
MARK, STOP = "\ue000", "\ue001"
#: Units that may follow a number.
UNITS = "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l gal s sec min h hr hrs ms hz khz mhz ghz kb mb gb tb w kw v a k c f usd eur gbp dollars euros percent meters metres miles hours minutes seconds days weeks months years".split()
NAME = r"(?<=[^.!?:\x09-\x0D ][ \t])(\p{Lu}\p{Ll}++)(?![\p{L}\p{M}])"
NUMBER = rf"(\p{{N}}++(?:[.,]\p{{N}}++)*+)(?:( ?)({'|'.join(UNITS)})(?![\p{{L}}\p{{M}}\p{{N}}{MARK}]))?"
TOKEN = rf"{MARK}[!#%][^{STOP}]+{STOP}|[\p{{L}}\p{{M}}]++"


def tokens(text: Column) -> Column:
    """Lower-cased words; those of a placeholder as its mark, kind, value and an end sign."""
    plain = F.translate(text.cast("string"), MARK + STOP, "  ")
    named = F.lower(F.regexp_replace(plain, NAME, f"{MARK}!$1{STOP}"))
    # Without a unit the last group is empty, and what it leaves is no token.
    counted = F.regexp_replace(named, NUMBER, f"{MARK}#$1{STOP}$2{MARK}%$3{STOP}")
    return F.regexp_extract_all(counted, F.lit(TOKEN), F.lit(0))


def is_slot(token: Column) -> Column:
    return token.startswith(MARK)


def template(own: Column) -> Column:
    """``tokens`` without values."""
    return F.transform(own, lambda t: F.when(is_slot(t), F.substring(t, 1, 2)).otherwise(t))


def key(size: int, exact: bool, held: Column) -> Column:
    return F.xxhash64(F.lit(2 * size + exact), held)


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(size, exact, key, item_id, item_n, item_at, item_values): windows of the items; item_values is null at ordinary words."""
    rows = items.select(F.col(id_col).alias("item_id"), tokens(F.col(text_col)).alias("own")).where(F.size("own") >= LEAST)
    # The first word as a name too.
    first = F.col("own")[0]
    named = F.when(~is_slot(first), F.concat(F.array(F.concat(F.lit(f"{MARK}!"), first, F.lit(STOP))), F.slice("own", 2, F.size("own"))))
    rows = rows.select("item_id", F.posexplode(F.array("own", named)).alias("as_name", "own")).where("own IS NOT NULL")
    rows = rows.withColumn("size", F.least(F.size("own"), F.lit(WINDOW))).withColumn("item_n", F.size("own"))
    rows = rows.withColumn("item_at", F.explode(F.when(F.col("as_name") == 0, F.expr("sequence(1, item_n - size + 1)")).otherwise(F.array(F.lit(1)))))
    rows = rows.withColumn("held", F.expr("slice(own, item_at, size)"))
    rows = rows.withColumn("exact", F.size(F.filter("held", lambda t: ~is_slot(t))) < LITERALS)
    hashed = F.xxhash64(2 * F.col("size") + F.col("exact").cast("int"), F.when(F.col("exact"), F.col("held")).otherwise(template(F.col("held"))))
    return rows.select("size", "exact", hashed.alias("key"), "item_id", "item_n", "item_at", F.transform("held", lambda t: F.when(is_slot(t), t)).alias("item_values"))


def found_leaks(docs: DataFrame, items: DataFrame, percent: int, broadcast_windows: int, id_col: str, text_col: str, item_id_col: str, item_text_col: str) -> DataFrame:
    """(doc_id, text_hash, item_id, item_tokens, covered_tokens, same)."""
    theirs = item_windows(items, item_id_col, item_text_col)
    kinds = {(r["size"], r["exact"]): r["n"] for r in theirs.groupBy("size", "exact").agg(F.count("*").alias("n")).collect()}  # 2 * WINDOW groups at most
    small = sum(kinds.values()) <= broadcast_windows
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), tokens(F.col(text_col)).alias("own"))
    # Exploding an array of one binds its value, so that it isn't made anew for each window.
    rows = rows.select("doc_id", "text_hash", "own", F.explode(F.array(template(F.col("own")))).alias("tokens"))
    rows = rows.where(F.size("tokens") >= min((s for s, _ in kinds), default=WINDOW))
    rows = rows.select("doc_id", "text_hash", "own", "tokens", F.explode(F.sequence(F.lit(1), F.size("tokens"))).alias("at"))
    keys = [F.when(F.col("at") + (s - 1) <= F.size("tokens"), key(s, exact, F.slice("own" if exact else "tokens", F.col("at"), s))) for s, exact in sorted(kinds) or [(WINDOW, False)]]
    if len(keys) == 1:
        rows = rows.select("doc_id", "text_hash", "own", "at", keys[0].alias("key"))
    else:
        rows = rows.select("doc_id", "text_hash", "own", "at", F.explode(F.array(*keys)).alias("key"))
    rows = rows.where("key IS NOT NULL")
    if small:
        met = rows.join(F.broadcast(theirs), "key").withColumn("held", F.expr("slice(own, at, size)"))
    else:  # only windows that some item has leave the scan's stage with their own tokens
        met = rows.select("doc_id", "text_hash", "at", "key", F.slice("own", F.col("at"), WINDOW).alias("held")).join(theirs, "key")
    pairs = F.filter(F.arrays_zip(F.col("item_values").alias("item"), F.slice("held", F.lit(1), F.col("size")).alias("doc")), lambda p: p["item"].isNotNull())
    met = met.select("doc_id", "text_hash", "item_id", "item_n", "item_at", (F.col("at") - F.col("item_at")).alias("shift"), "size", pairs.alias("pairs"))
    aligned = met.groupBy("doc_id", "text_hash", "item_id", "item_n", "shift", "size").agg(F.collect_set("item_at").alias("at"), F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    names = F.filter("pairs", lambda p: p["item"].startswith(f"{MARK}!"))
    single = lambda pairs, side: F.size(F.array_distinct(F.transform(pairs, lambda p: p[side]))) == F.size(pairs)
    consistent = aligned.where(single(F.col("pairs"), "item") & single(names, "doc"))
    token = F.explode(F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + F.col("size") - 1)))))
    covered = consistent.select("doc_id", "text_hash", "item_id", "item_n", F.forall("pairs", lambda p: p["item"] == p["doc"]).alias("same"), token.alias("token"))
    found = covered.groupBy("doc_id", "text_hash", "item_id", "item_n").agg(F.count_distinct("token").alias("covered_tokens"), F.bool_and("same").alias("same"))
    return found.where(100 * F.col("covered_tokens") >= percent * F.col("item_n"))


def leaks(
    docs: DataFrame,
    items: DataFrame,
    percent: int = 60,
    broadcast_windows: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, item_tokens, covered_tokens, kind) of each item found in a text; kind: verbatim or reparameterised.

    Texts of one id with equal results give one row.
    """
    found = found_leaks(docs, items, percent, broadcast_windows, id_col, text_col, item_id_col, item_text_col)
    kind = F.when(F.col("same"), "verbatim").otherwise("reparameterised")
    return found.select("doc_id", "item_id", F.col("item_n").cast("bigint").alias("item_tokens"), "covered_tokens", kind.alias("kind")).distinct()


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = 60,
    broadcast_windows: int = 1_000_000,
    broadcast_ids: int = 1_000_000,
) -> DataFrame:
    """``docs`` without the rows whose text holds an item; their ids and hashes are broadcast only if a count finds few."""
    found = found_leaks(docs, items, percent, broadcast_windows, id_col, text_col, item_id_col, item_text_col)
    ids = Scratch(docs.sparkSession, "leaks").keep(found.select(F.col("doc_id").alias("__gf_id"), F.col("text_hash").alias("__gf_hash")).distinct())
    few = ids.count() <= broadcast_ids
    same = F.col(id_col).eqNullSafe(F.col("__gf_id")) & (F.xxhash64(F.col(text_col)) == F.col("__gf_hash"))
    return docs.join(F.broadcast(ids) if few else ids, same, "left_anti")


def oracle_sql() -> str:
    """The same in DuckDB's SQL, with the windows themselves as join keys."""
    space = r"[^.!?:\x09-\x0D ][ \t]"
    name = rf"'({space})(\p{{Lu}}\p{{Ll}}+)($|[^\p{{L}}\p{{M}}])', '\1{MARK}!\2{STOP}\3', 'g'"
    canon = f"lower(regexp_replace(regexp_replace(translate(text, '{MARK}{STOP}', '  '), {name}), {name}))"
    unit = rf"(?:( ?)({'|'.join(UNITS)})($|[^\p{{L}}\p{{M}}\p{{N}}{MARK}]))?"
    canon = rf"regexp_replace({canon}, '(\p{{N}}+(?:[.,]\p{{N}}+)*){unit}', '{MARK}#\1{STOP}\2{MARK}%\3{STOP}\4', 'g')"
    tokens = rf"regexp_extract_all({canon}, '{MARK}[!#%][^{STOP}]+{STOP}|[\p{{L}}\p{{M}}]+')"
    slot = f"starts_with(t, '{MARK}')"
    shape = f"list_transform(held, lambda t: CASE WHEN {slot} THEN left(t, 2) ELSE t END)"
    kind = f"CASE WHEN len(list_filter(held, lambda t: NOT {slot})) < {LITERALS} THEN '=' || array_to_string(held, ' ') ELSE array_to_string({shape}, ' ') END"
    return f"""
WITH d AS (SELECT DISTINCT doc_id, text, {tokens} AS own FROM documents WHERE text IS NOT NULL),
b0 AS (SELECT item_id, {tokens} AS own FROM benchmark WHERE text IS NOT NULL),
b AS (SELECT item_id, own, len(own) AS item_n, least(len(own), {WINDOW}) AS size FROM b0 WHERE len(own) >= {LEAST}),
bp AS (SELECT item_id, item_n, size, item_at, own[item_at:item_at + size - 1] AS held FROM (SELECT *, unnest(range(1, item_n - size + 2)) AS item_at FROM b)
  UNION ALL SELECT item_id, item_n, size, 1, list_prepend('{MARK}!' || own[1] || '{STOP}', own[2:size]) FROM b WHERE NOT starts_with(own[1], '{MARK}')),
bk AS (SELECT *, {kind} AS key FROM bp),
dp AS (SELECT doc_id, text, size, own, unnest(range(1, len(own) - size + 2)) AS pos FROM d, (SELECT DISTINCT size FROM bk) WHERE len(own) >= size),
dw AS (SELECT doc_id, text, size, pos, own[pos:pos + size - 1] AS held FROM dp),
dk AS (SELECT *, {kind} AS key FROM dw),
m AS (SELECT dk.doc_id, dk.text, bk.item_id, bk.item_n, bk.item_at, bk.size, dk.pos - bk.item_at AS shift, bk.held AS item_held, dk.held AS doc_held FROM dk JOIN bk USING (size, key)),
s AS (SELECT *, unnest(range(1, size + 1)) AS o FROM m),
p AS (SELECT DISTINCT doc_id, text, item_id, item_n, size, shift, item_at + o - 1 AS token, CASE WHEN starts_with(item_held[o], '{MARK}') THEN item_held[o] END AS iv, CASE WHEN starts_with(item_held[o], '{MARK}') THEN doc_held[o] END AS dv FROM s),
v AS (SELECT DISTINCT doc_id, text, item_id, item_n, size, shift, iv, dv FROM p),
ok AS (SELECT doc_id, text, item_id, item_n, size, shift, coalesce(bool_and(iv = dv), true) AS same FROM v GROUP BY ALL
  HAVING count(DISTINCT iv) = count(iv) AND count(DISTINCT dv) FILTER (starts_with(iv, '{MARK}!')) = count(dv) FILTER (starts_with(iv, '{MARK}!')))
SELECT DISTINCT doc_id, item_id, item_tokens, covered_tokens, kind FROM (
SELECT p.doc_id, p.text, p.item_id, CAST(p.item_n AS BIGINT) AS item_tokens, count(DISTINCT p.token) AS covered_tokens, CASE WHEN bool_and(ok.same) THEN 'verbatim' ELSE 'reparameterised' END AS kind
FROM p JOIN ok USING (doc_id, text, item_id, item_n, size, shift) GROUP BY p.doc_id, p.text, p.item_id, p.item_n HAVING 100 * count(DISTINCT p.token) >= 60 * p.item_n)
"""
