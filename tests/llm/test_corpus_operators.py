"""The corpus operators against brute force, the reference libraries' results and edge cases."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from galefold.llm import bpe, decontam, entry, langid, licences, mainhtml, minmax, perplexity, resample, slots, urlrules

SMALL = "/root/testdata/sf0.001"
VOCABULARY = P.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, slot string, score string"


def words(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(400)}" for _ in range(n)]


def fixture():
    """Copies, near copies, short, empty, null, long and repeated rows; extra columns with names of results."""
    base = words(120, 1)
    near = [*base[:60], "x", *base[61:]]
    texts = {1: base, 2: base, 3: near, 4: words(100, 2), 5: base[:90], 6: ["a", "b"], 7: ["A", "b"], 8: words(30, 3), 9: words(30, 3)[1:], 10: words(30_000, 4), 12: words(30_000, 4)}
    rows = [(k, " ".join(v)) for k, v in texts.items()] + [(20, None), (21, ""), (22, " \n "), (1, " ".join(base)), (None, " ".join(base)), (None, None)]
    return [(i, t, "en" if i != 4 else None, None, 0, "k", "s", "c") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture(), DOCS)


def brute_components(rows):
    sets = [(i, minmax.word_tuples(t, 5)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets if i is not None}


def test_near_duplicates(spark, docs):
    got = minmax.near_duplicates(docs).collect()
    want = brute_components([r[:2] for r in fixture()])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert len(got) == docs.count() and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    assert {(r["n_shingles"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is None} == {(116, 1, False), (0, None, True)}
    left = minmax.deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in left.collect()) == sorted([*(i for i, (_, c) in want.items() if i == c), -1, -1])


def test_near_duplicates_of_an_unlinked_family(spark):
    """Texts that share buckets without being alike, and a chain that only their neighbours link."""
    base = words(200, 9)
    family = [[*base[: 8 * k], *words(60, 100 + k), *base[8 * k + 60 :]] for k in range(12)]
    chain = [base[i * 12 : i * 12 + 110] for i in range(8)]
    rows = [(i, " ".join(t)) for i, t in enumerate(family + chain)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minmax.near_duplicates(frame).collect()} == brute_components(rows)


def test_components_of_a_long_chain(spark):
    from galefold.llm.shared import Scratch

    edges = spark.range(300).select(F.xxhash64("id").alias("u"), F.xxhash64(F.col("id") + 1).alias("v"))
    assert minmax.components(edges, Scratch(spark, "chain")).select("comp").distinct().count() == 1


@pytest.fixture(scope="module")
def vocabulary():
    with open(VOCABULARY, "rb") as f:
        return bpe.Vocabulary(f.read(), bpe.class_table())


def test_bpe_equals_the_library(vocabulary, monkeypatch):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    r = random.Random(5)
    odd = ["".join(r.choice(" \n\t 'sdtmrevlaAé日1٣½!?.,😀\u0301\r\u3000") for _ in range(r.randrange(50))) for _ in range(1500)]
    odd += ["", "'s'll don't''s 're  's\n's", "x" * 3000, "ab" * 1500 + " " * 99, "\n" * 50 + "a", "<|endoftext|>"]
    for block in (bpe.BLOCK, 7):
        monkeypatch.setattr(bpe, "BLOCK", block)
        ids, counts = vocabulary.encode(odd)
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [library.encode_ordinary(t) for t in odd]
    with pytest.raises(ValueError):
        vocabulary.decode(np.array([50256]))


def test_bpe_query(spark, docs):
    got = {(r["doc_id"], r["decoded_sha256"]): r for r in entry.digests(bpe.encode(docs, VOCABULARY, decode=True)).collect()}
    for i, text, *_ in fixture():
        r = got[i, hashlib.sha256((text or "").encode()).hexdigest()]
        assert (r["n_tokens"] == 0) == (not text)
    tokens = bpe.encode(docs, VOCABULARY, keep=("doc_id", "text"))
    back = bpe.decode(tokens, VOCABULARY, keep=("doc_id", "text")).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)
    assert all(r["starts"] == sorted(set(r["starts"])) for r in tokens.collect())


def test_quality_features():
    text = "a b c\nx  y\na b c\n\n \na b c # $"
    assert perplexity.features(text)[:5] == (13, 13, 2, 1, 9)
    assert perplexity.features(None) == (0, 0, 0, 0, 0, True)
    for seed in range(30):
        r = random.Random(seed)
        ws = [r.choice("abc").encode() for _ in range(r.randrange(40))]
        seen = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
        want = {i + k for i in range(len(ws) - 2) if seen[tuple(ws[i : i + 3])] > 1 for k in range(3)}
        assert perplexity.repeat_words(ws) == len(want)


def brute_kneser_ney(texts, others=None):
    """Mean costs of ``others`` (or of the texts) by p(symbol | three before), by dictionaries, for one language."""
    fold = perplexity.folded()
    raw = Counter()

    def folded(t):
        codes = [0, 0, 0]
        for c in t:
            s = int(fold[ord(c)])
            if not (s == 1 and codes[-1] == 1 and len(codes) > 3):
                codes.append(s)
        return codes

    for codes in map(folded, texts):
        raw.update(tuple(codes[i - 3 : i + 1]) for i in range(3, len(codes)))
    sequences = [folded(t) for t in (texts if others is None else others)]
    counts = {4: raw}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off = {k: perplexity.discounts(*[sum(1 for v in c.values() if v == i) for i in (1, 2, 3, 4)]) for k, c in counts.items()}
    own = {k: defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, v in c.items():
            own[k][g[:-1]].append(v)

    def p(gram):
        k = len(gram)
        if not k:
            return 2.0**-perplexity.SYMBOL
        around = own[k].get(gram[:-1])
        if not around:
            return p(gram[1:])
        total = sum(around)
        v = counts[k].get(gram, 0)
        weight = sum(off[k][min(x, 3) - 1] for x in around) / total
        return (v - off[k][min(v, 3) - 1] if v else 0) / total + weight * p(gram[1:])

    return [-sum(math.log(p(tuple(s[i - 3 : i + 1]))) for i in range(3, len(s))) / (len(s) - 3) for s in sequences]


def test_perplexity_is_kneser_ney(spark):
    texts = ["the cat sat on the  mat", "the dog sat on the log 12", "Éa é", "a cat and a dog"]
    frame = spark.createDataFrame([(i, t, "en-GB") for i, t in enumerate(texts)], "doc_id int, text string, lang string")
    model = perplexity.trained(frame)
    code = frame.select(perplexity.language(F.col("lang"))).head()[0]
    got = perplexity.mean_costs(model, texts, np.full(len(texts), code))
    assert got == pytest.approx(brute_kneser_ney(texts), rel=1e-5)
    unseen = perplexity.mean_costs(model, ["zzzz qqq"], np.array([code]))
    assert np.isfinite(unseen).all() and unseen[0] > got.max()


def test_quality_judgement(spark, docs):
    got = perplexity.judged(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["kept"] in (True, False) and not (r["kept"] and r["base_failed"])
    assert {r["doc_id"] for r in got if not r["base_failed"]} == {1, 2, 3, 4, 5, 10, 12, None}
    assert all(r["kept"] for r in got if r["doc_id"] in (1, 2, 3))
    passed = perplexity.passed(docs)
    assert passed.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in passed.collect()) == sorted((r["doc_id"] or 0) for r in got if r["kept"])


def test_language_accuracy_and_edges(spark, docs):
    got = entry.op7_language(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.97 * len(out)
    edge = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert edge[20]["lang_pred"] == edge[21]["lang_pred"] == edge[22]["lang_pred"] == "und" and edge[20]["score"] == 0
    assert langid.accepted(docs).columns == docs.columns
    none = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def against_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    frame = entry.queries()[name](spark, SMALL)
    names = sorted(frame.columns)
    return sorted((tuple(r[c] for c in names) for r in frame.collect()), key=repr), sorted(con.sql(f"SELECT {', '.join(names)} FROM ({entry.oracle_sql()[name]})").fetchall(), key=repr)


@pytest.mark.parametrize("name", ["op1_decontamination", "op8_licences", "listed_url_rules", "counted_text_rules"])
def test_native_operators_match_sql(spark, name):
    got, want = against_duckdb(spark, name)
    assert got == want and got


def test_decontamination_of_templates(spark, docs):
    item = "A train leaves with Alice Smith at 60 km from Boston and returns after 3 hours with Alice on board of the train."
    other = "A train leaves with Bob Jones at 75 km from Denver and returns after 4 hours with Bob on board of the train."
    mixed = "A train leaves with Bob Jones at 75 km from Denver and returns after 4 hours with Carol on board of the train."
    items = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, "a bb ccc")], "item_id bigint, text string")
    rows = [(1, f"so it says. {item} and more"), (2, f"first. {other}"), (3, mixed), (4, None), (5, "nothing of it here at all, nothing"), (None, item), (6, "x. a bb ccc")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item_id", F.lit(9)).withColumn("key", F.lit("k"))
    found = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontam.leaks(frame, items).collect()}
    assert found == {(1, 1): "verbatim", (2, 1): "reparameterised", (None, 1): "verbatim", (6, 4): "verbatim"}
    shuffled = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(frame, items, broadcast_windows=0).collect()}
    assert shuffled == set(found)
    assert sorted(r["doc_id"] for r in decontam.decontaminated(frame, items).collect()) == [3, 4, 5]
    assert decontam.leaks(frame.limit(0), items).count() == 0 and decontam.leaks(frame, items.limit(0)).count() == 0


def test_licence_edges(spark):
    rows = [(1, "x\nReleased under the MIT  license\n y"), (2, None), (3, ""), (4, "Licensed under CC BY-NC 4.0."), (5, "one\n\nPermission to use copy\nmodify\n\n")]
    frame = spark.createDataFrame(rows, "doc_id int, text string").withColumn("pair", F.lit(1))
    assert {(r["doc_id"], r["licence"]) for r in licences.scan(frame).where("shared * 2 = unit_bigrams + template_bigrams").collect()} == {(1, "MIT"), (4, "CC-BY-NC-4.0")}


def test_resampling(spark):
    values = [5, 5, -3, 2**62, -(2**62), 0, 5]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    for k in range(1, 8):
        assert resample.kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]
    assert resample.kth_largest(frame, "v", 8) is None and resample.kth_largest(frame, "v", 0) is None
    good, bad = "the cat sat on the mat ", "### $$$ !!! ### "
    docs = spark.createDataFrame([(i, (good if i < 8 else bad) * 20) for i in range(12)] + [(None, None)], "doc_id bigint, text string").withColumn("log_weight", F.lit(0))
    labels = spark.createDataFrame([(i, int(i < 8), 0) for i in range(0, 12, 2)], "doc_id bigint, quality int, toxic int")
    got = resample.resampled(docs, labels, share=9 / 13).collect()
    assert {r["doc_id"] for r in got if r["kept"]} == {*range(8), None} and len(got) == 13
    counts = {True: Counter(), False: Counter()}
    for i in range(12):
        for ids in resample.features((good if i < 8 else bad) * 20):
            counts[False].update(ids.tolist())
            if i < 8 and i % 2 == 0:
                counts[True].update(ids.tolist())
    n = {k: sum(c.values()) + resample.BUCKETS for k, c in counts.items()}
    weight = sum(math.log((counts[True][b] + 1) / n[True] / ((counts[False][b] + 1) / n[False])) for ids in resample.features(good * 20) for b in ids.tolist())
    assert [r["log_weight"] for r in got if r["doc_id"] == 0] == [pytest.approx(weight, abs=1e-4)]
    assert resample.resampled(docs.limit(0), labels).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";x(1<2)</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><!-- ad > --><div class="ad">Buy</div><aside>side</aside><div id="cookie-notice">We use</div>
<article><h1>Title &amp; more</h1><p><b>One, two,<br>three&nbsp;<i>fo</i>ur<p>Five &lt;six&gt;</p><form><input value="x">Send</form><ul><li>seven<li>eight</ul><div class="comments"><p>Nice, very nice, text</p></div></article>
<section class="comments"><p>First! This is, I think, a long, long comment, with commas, many of them.</p></section><footer>&copy; x</footer>"""


def test_main_text():
    assert mainhtml.main_text(PAGE) == "Title & more One, two, three four Five <six> seven eight"
    assert mainhtml.main_text(None) == mainhtml.main_text("") == mainhtml.main_text("<nav>x</nav>") == ""
    assert mainhtml.main_text("just text") == "just text"
    assert mainhtml.main_text("<div>" * 3000 + "<p>deep, down" + "</div>" * 10) == "deep, down"
    two = "<div id=c><div class=part><p>" + "long, text " * 30 + "</p></div><div class=part><p>" + "other, words " * 30 + "</p></div></div>"
    assert len(mainhtml.main_text(two).split()) == 120
    assert mainhtml.main_text("<article><p>a" + "<p>b" * 5 + "</article><article class=comment><p>no") == "a b b b b b"


def test_pages_query(spark):
    got = entry.op6_main_text(spark, SMALL).collect()
    assert got and all(r["n_chars"] == len(r["text"]) for r in got)
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in got:
        body = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        assert r["text"] == " ".join(mainhtml.unescape(mainhtml.re.sub(r"<[^>]*>", " ", body)).split())


def test_url_rules(spark):
    urls = {1: "http://a.example.com/en/1", 2: "http://WWW.example.com/en/1", 3: "https://x.net/es/", 4: "https://x.net/de/", 5: None, 6: "nothing", 7: "http://q.com?x://y", 8: "http://spam.org/buy/7", 9: "http://good.org/buy/7"}
    pages = spark.createDataFrame(list(urls.items()), "page_id bigint, url string").withColumn("host", F.lit("clash"))
    known = [(f"http://spam.org/buy/{i}", True) for i in range(20)] + [(f"http://good.org/buy/{i}", False) for i in range(60)]
    labelled = spark.createDataFrame(known, "url string, blocked boolean")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlrules.judged(pages, labelled).collect()}
    assert got == {
        1: ("a.example.com", "/en/1", "example.com/en/", "block"), 2: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 3: ("x.net", "/es/", "net/es/", "block"), 4: ("x.net", "/de/", None, "allow"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("q.com", "", None, "allow"), 8: ("spam.org", "/buy/7", None, "block"), 9: ("good.org", "/buy/7", None, "allow"),
    }
    rules = urlrules.mined(labelled, 0.01, 0.6, 1.5).collect()
    assert [r["antecedent"] for r in rules] == [[["host:spam"]]]
    assert {r["verdict"] for r in urlrules.judged(pages, labelled.limit(0)).where("rule IS NULL").collect()} == {"allow"}
    assert urlrules.judged(pages.limit(0), labelled).count() == 0
    twice = urlrules.judged(pages.union(pages), labelled).collect()
    assert sorted(map(repr, twice)) == sorted(map(repr, urlrules.judged(pages, labelled).collect() * 2))


def brute_rules(labelled, floor, confidence, lift, z):
    """Every combination of tokens with rows enough, by enumeration; (rows it blocks) of those sure enough."""
    rows = [(frozenset(t), b) for t, b in labelled]
    share = sum(b for _, b in rows) / len(rows)
    out = {}
    for own in {frozenset(c) for t, b in rows if b for k in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), k)}:
        n, hit = sum(own <= t for t, _ in rows), sum(own <= t for t, b in rows if b)
        p = hit / n
        low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if hit >= floor and p / share >= lift and low >= confidence:
            out[own] = p
    return out


def test_url_rules_equal_brute_force(spark):
    """The urls that mined rules block are those of all sure combinations; each rule has the rows asked for, and holds on other labels."""
    r = random.Random(3)

    def make(n):
        rows = []
        for _ in range(n):
            site, kind, tail = r.choice(["news", "shop", "win", "blog"]), r.choice(["a", "b", "c"]), r.choice(["", "?utm=1", "?q=2&utm=3"])
            bad = r.random() < (0.97 if site == "win" or site == "shop" and kind == "c" and tail else 0.1)
            rows.append((f"https://{site}.example.{'org' if site == 'news' else 'net'}/{kind}/{r.randrange(99)}{tail}", bad))
        return rows

    known, later = make(600), make(400)
    frame, held_out = (spark.createDataFrame(x, "url string, blocked boolean") for x in (known, later))
    token_rows = frame.select(urlrules.tokens(F.col("url")).alias("t"), "blocked").collect()
    want = brute_rules([(x["t"], x["blocked"]) for x in token_rows], 20, 0.6, 1.5, 1.645)
    rules = urlrules.mined(frame)
    got = rules.collect()
    assert got and want and all(x["n_blocked"] >= 20 and x["confidence"] == pytest.approx(x["n_blocked"] / x["n_rows"]) for x in got)
    for x in got:
        for own in itertools.product(*x["antecedent"]):
            assert want[frozenset(own)] == pytest.approx(x["confidence"])
    urls = held_out.select("url").distinct()
    hit = {x["url"] for x in urlrules.matched(urls, rules).collect()}
    assert hit == {x["url"] for x in urls.withColumn("t", urlrules.tokens(F.col("url"))).collect() if any(own <= set(x["t"]) for own in want)}
    n, right = urlrules.precision(rules, held_out)
    assert n >= 50 and right >= 0.9 * n


def test_url_labels_come_by_text(spark):
    pages = spark.createDataFrame([(7, "http://a.org/1", "<html><title>T u</title><body><article><h1>T u</h1><p>bad  text, here</article>"), (8, "http://b.org/", "<p>fine text"), (9, "http://c.org/", "<p>other"), (1, None, None)], "page_id int, url string, html string")
    docs = spark.createDataFrame([(1, "bad text,\n here"), (2, "fine text"), (3, "fine  text"), (4, None), (9, "other")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 1, 0), (4, 0, 1), (7, 1, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert sorted(tuple(r) for r in urlrules.labelled_by_text(pages, docs, labels).collect()) == [("http://a.org/1", True), ("http://b.org/", False)]


def test_virtual_slots(spark, docs, tmp_path):
    store = str(tmp_path / "store")
    got = slots.sharded(docs, store, shards=3, piece=4).collect()
    places = defaultdict(list)
    for r in got:
        places[r["shard"]].append(r["slot"])
    assert len(got) == docs.count() and all(sorted(p) == list(range(len(p))) for p in places.values())
    texts = defaultdict(set)
    for i, t, *_ in fixture():
        texts[i].add((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())))
    assert all((r["size"], r["text_crc32"]) in texts[r["doc_id"]] for r in got)
    sizes = [random.Random(i).randrange(100, 200) for i in range(500)]
    first = slots.planned(sizes, 24)
    total = lambda m, n: [sum(s for s, o in zip(sizes, m.shards, strict=True) if o == k) for k in range(n)]
    assert max(total(first, 24)) - min(total(first, 24)) <= max(sizes)
    grown = slots.rebalanced(first, sizes, 25)
    moved = sum(a != b for a, b in zip(first.shards, grown.shards, strict=True))
    assert grown.version == 2 and moved <= 500 / 25 + 25 and max(total(grown, 25)) - min(total(grown, 25)) <= 2 * max(sizes)
    assert slots.rebalanced(first, sizes, 24).shards == first.shards
    path = str(tmp_path / "maps")
    first.saved(spark, path)
    grown.saved(spark, path)
    assert slots.loaded(spark, path, 1) == first and slots.loaded(spark, path, 2) == grown
    with pytest.raises(Exception, match="(?i)exists"):
        first.saved(spark, path)


def test_slot_map_is_stored_and_edited(spark, tmp_path):
    """Version 1 stays in force for the same rows; more rows edit it, and only the slots that even out the shards move."""
    store = str(tmp_path / "store")
    make = lambda n: spark.range(n).select(F.col("id").alias("doc_id"), F.expr("repeat('é', int(id % 97))").alias("text"))

    def held(n, shards):
        rows = slots.sharded(make(n), store, shards=shards, slots=256).collect()
        assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {(i, 8 + 2 * (i % 97), zlib.crc32(("é" * (i % 97)).encode())) for i in range(n)}
        places, total, owner = defaultdict(list), Counter(), {}
        for r in rows:
            places[r["shard"]].append(r["slot"])
            total[r["shard"]] += r["size"]
            assert owner.setdefault(r["virtual_slot"], r["shard"]) == r["shard"]
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
        assert len(total) == shards and max(total.values()) - min(total.values()) <= 0.05 * max(total.values())
        (version,) = {r["version"] for r in rows}
        return version, owner

    first, owner = held(3000, 6)
    assert (first, owner) == held(3000, 6) == (1, owner)
    grown, more = held(3000, 7)
    moved = [more[i] for i in owner if more[i] != owner[i]]
    assert grown == 2 and 6 in moved and len(moved) <= 256 / 7 + 7
    assert slots.loaded(spark, store, 2).shards == slots.loaded(spark, store, grown).shards
    later, _ = held(4000, 7)
    assert later in (2, 3) and slots.listed_names(spark, store) == [f"v{i:06d}" for i in range(1, later + 1)]


def test_empty_tables(spark, docs, tmp_path):
    none = docs.limit(0)
    assert minmax.near_duplicates(none).count() == 0
    assert perplexity.judged(none).count() == 0
    assert langid.identify(none).count() == 0
    assert bpe.encode(none, VOCABULARY).count() == 0
    assert licences.scan(none).count() == 0
    assert slots.sharded(none, str(tmp_path / "none")).count() == 0
    assert mainhtml.extract(spark.createDataFrame([], "page_id int, url string, html string")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    alive = {i for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}
    after = {}
    given = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        given = stage(spark, given, SMALL).checkpoint()
        assert sorted(given.columns) == sorted(docs.columns)
        after[name] = {r["doc_id"] for r in given.select("doc_id").collect()}
    assert after["language"] == alive
    assert all(not perplexity.features(rows[i]["text"])[5] for i in after["quality"])
    quality = {r["doc_id"]: r["quality"] for r in entry.table(spark, SMALL, "labels").collect() if r["doc_id"] in alive and not perplexity.features(rows[r["doc_id"]]["text"])[5]}
    good, bad = ({i for i, q in quality.items() if q == k} for k in (1, 0))
    assert len(good & after["quality"]) >= 0.97 * len(good) and bad and not bad & after["quality"]
    want = brute_components([(i, rows[i]["text"]) for i in sorted(after["quality"])])
    assert after["near-duplicates"] == {i for i, (_, c) in want.items() if i == c}
    found = {r["doc_id"] for r in decontam.leaks(docs, entry.table(spark, SMALL, "benchmark")).collect()}
    assert after["decontamination"] == after["near-duplicates"] - found
    tokens = corpus_pipeline.STAGES[4][1](spark, given, SMALL).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in tokens} == {i: hashlib.sha256(rows[i]["text"].encode()).hexdigest() for i in after["decontamination"]}
