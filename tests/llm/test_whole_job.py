"""Cases in which the corpus operators once did less than the whole job."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_corpus_operators import brute_components, brute_kneser_ney

from galefold.llm import bpe, decontam, entry, langid, licences, mainhtml, minmax, perplexity, resample, shared, slots, urlrules

SMALL = "/root/testdata/sf0.001"


def test_fences_follow_the_spread_of_each_language(spark):
    """Texts a tenth of a nat beyond a narrow language's scores are outside, on either side; a wide language keeps them."""
    rows = [(1, False, 1.48 + 0.0004 * i) for i in range(101)] + [(2, False, 1.2 + 0.006 * i) for i in range(101)] + [(1, True, 9.0), (1, False, None)]
    bounds = perplexity.fences(spark.createDataFrame(rows, "lang_code int, base_failed boolean, log_ppl double"))
    low, high = bounds[1]
    assert 1.40 < low < 1.48 and 1.52 < high < 1.60
    assert bounds[2][0] < 1.2 and bounds[2][1] > 1.8
    same = perplexity.fences(spark.createDataFrame([(1, False, 1.5)] * 9, "lang_code int, base_failed boolean, log_ppl double"))
    assert same[1][0] < 1.5 < same[1][1]


def test_url_rules_need_rows_enough(spark):
    """One or two blocked urls among many imply nothing, nor do 6 of 9 or 19 of 19; 24 of 24 do."""
    known = [("http://once.org/a", True), ("http://twice.org/b", True), ("http://twice.org/c", True)]
    known += [(f"http://mostly.org/{x}", i < 6) for i, x in enumerate("defghijkl")] + [("http://always.org/", True)] * 24 + [("http://nearly.org/", True)] * 19 + [("http://fine.org/", False)] * 60
    rules = urlrules.mined(spark.createDataFrame(known, "url string, blocked boolean"), 0.002, 0.6, 1.5).collect()
    assert [r["antecedent"] for r in rules] == [[["host:always"]]]


def test_main_text_keeps_short_parts_without_an_article():
    long = "<p>" + "long, text " * 30 + "</p>"
    ten = "<section>" + long * 10 + "</section>"
    note = "<section><h2>Note</h2><p>Short end.</p></section>"
    nav = "<nav><a href=/>Home</a></nav><div class=related><p>Other news</p></div>"
    links = "<ul><li><a href=/a>Read this</a><li><a href=/b>and this</a></ul>"
    assert mainhtml.main_text(f"<body>{nav}<div>{ten}{note}</div>{links}").split()[600:] == ["Note", "Short", "end."]
    assert mainhtml.main_text(f"<body>{nav}{ten}{note}<div>{note}</div>{links}").split()[600:] == ["Note", "Short", "end."] * 2
    text = mainhtml.main_text(f"<body>{nav}<h1>Title</h1><div>{long * 10}</div>Loose, <b>bold</b>.<p>The end.</p>{links}").split()
    assert text[0] == "Title" and text[601:] == ["Loose,", "bold.", "The", "end."]
    assert len(mainhtml.main_text(f"<body><div><div>{ten}</div>{note}</div>").split()) == 603
    assert mainhtml.main_text(f"<body><article>{long}</article><section>{note}</section>").split()[-1] == "text"


def test_languages_never_learnt_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    texts = ["Съешь ещё этих мягких французских булок, да выпей чаю.", "我们今天去市场买了很多新鲜的水果和蔬菜。"]
    foreign = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    stays = {r["doc_id"] for r in langid.accepted(docs.union(foreign)).select("doc_id").collect()}
    assert stays == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}


def test_languages_are_learnt_from_every_row(spark):
    """150,000 texts of one language teach, 50,000 held-out ones give its least mean, and none of either is left out."""
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))  # what a sample once went by
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.when(draw < 400_000, "abba abba").when(draw < 999_000, "baobab cab").otherwise("quiz").alias("text"), F.lit("xx").alias("lang"))
    texts = {r["text"]: (r["learnt"], r["held"]) for r in docs.groupBy("text").agg(F.count_if(~langid.held_out()).alias("learnt"), F.count_if(langid.held_out()).alias("held")).collect()}
    model = langid.fit(docs.where(~langid.held_out()), "text", "lang", "doc_id")
    wide, counts = model.log_p.shape[1] - 1, np.zeros(model.log_p.shape[1])
    for text, (n, _) in texts.items():
        for ids in langid.grams([text], wide)[0]:
            np.add.at(counts, ids, n)
    want = np.log((counts[:-1] + 0.5) / (counts[:-1].sum() + 0.5 * wide))
    assert np.allclose(model.log_p[0, :-1], want)
    means = sorted((float(np.mean([want[x] for ids in langid.grams([t], wide)[0] for x in ids if x != wide])), n) for t, (_, n) in texts.items())
    upto = np.cumsum([n for _, n in means])
    median = means[int(np.searchsorted(upto, upto[-1] / 2))][0]
    ((_, low, deviation),) = langid.ranges(docs, model, "text", "lang", "doc_id")
    assert low + deviation == pytest.approx(median, abs=0.011)


LONG = "<p>" + "long, text " * 30 + "</p>"


@pytest.mark.parametrize(
    "part",
    [
        '<p title="the hidden gem">Kept words</p>', '<p data-hidden="false">Kept words</p>', '<p data-role="status">Kept words</p>', '<p>Kept <a href="/x?id=ad">words</a></p>',
        '<ul><li><a href="/a">Kept</a></li><li><a href="/b">words</a></li></ul>', '<p class="social-history">Kept words</p>', "<p>Kept <math><mi>words</mi></math></p>",
        "<video>Kept words</video>", "<noscript><p>Kept words</p></noscript>", "<object>Kept words</object>", '<div class="header"><h2>Kept words</h2></div>', "<table><tr><td><a href=/s>Kept words</a></table>",
        '<p class="copyright-law">Kept words</p>', "<p id='skip-list'>Kept words</p>", '<p role="note">Kept words</p>', '<p onclick="x(1)" id=a>Kept words</p>',
    ],
)
def test_main_text_drops_nothing_of_the_article(part):
    """Names inside of attribute values, lists of links, fallbacks and hyphenated names aren't reasons to drop."""
    for page in (f"<body><article>{LONG}{part}{LONG}</article>", f"<body><main><article>{LONG}{part}{LONG}</article></main>"):
        assert mainhtml.main_text(page).split()[60:62] == ["Kept", "words"]


@pytest.mark.parametrize(
    "part",
    ['<div class="cookie-notice">Gone</div>', '<ul class="main-nav"><li>Gone</ul>', '<p hidden>Gone</p>', '<p style="display: none">Gone</p>', '<div role="search">Gone</div>', '<div id="comments"><p>Gone</div>', '<div class="related-posts"><p>Gone</div>', "<form>Gone</form>", "<p aria-hidden=true>Gone"],
)
def test_main_text_leaves_out_other_parts(part):
    for page in (f"<body><article>{LONG}{part}</article>", f"<body>{part}<div>{LONG}</div>", f"<body><main>{LONG}{part}</main>"):
        assert "Gone" not in mainhtml.main_text(page) and len(mainhtml.main_text(page).split()) == 60


def test_main_text_of_containers():
    """An article in main comes without the teasers beside it; main without an article comes whole, but for lists of links."""
    more = '<div class="more"><a href=/1>One teaser</a> <a href=/2>Another</a></div>'
    assert len(mainhtml.main_text(f"<body><main><article>{LONG}</article>{more}</main>").split()) == 60
    text = mainhtml.main_text(f"<body><main><h1>Title</h1><div>{LONG}</div><div>Loose end</div>{more}</main><p>Elsewhere</p>").split()
    assert text[0] == "Title" and text[-2:] == ["Loose", "end"] and "Elsewhere" not in text and "teaser" not in text
    teaser = "<article><a href=/t>Read more</a></article>"
    assert mainhtml.main_text(f"<body>{teaser}<div>{LONG * 9}</div>{teaser}").split() == ["long,", "text"] * 270


def test_main_text_edges(spark):
    """Nulls, empty and very long pages, repeated rows, and columns named as results."""
    rows = [(1, "u", LONG, "x", 1), (1, "u", LONG, "x", 1), (None, None, None, None, None), (2, "v", "", "y", 2), (3, "w", "<p>" + "word, " * 400_000, "z", 3)]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string, text string, n_chars int")
    got = sorted((r["page_id"] or 0, r["n_chars"]) for r in mainhtml.extract(frame).collect())
    assert got == [(0, 0), (1, 329), (1, 329), (2, 0), (3, 6 * 400_000 - 1)]


def sentences(n, seed, words):
    r = random.Random(seed)
    return [" ".join(r.choice(words) for _ in range(r.randrange(60, 90))) for _ in range(n)]


def test_quality_verdicts_equal_brute_force(spark):
    """Scores, fences and verdicts by dictionaries over the reference texts; tables, symbols and foreign noise are outside."""
    good = sentences(40, 1, "the cat sat on a mat while old dogs ran over green hills and slept under trees near rivers with many fish".split())
    junk = [" | ".join(t.split()) for t in sentences(8, 2, "green hills old dogs cat".split())] + [" ".join(w + "%%%" for w in t.split()) for t in sentences(8, 3, "cat dog mat".split())]
    odd = sentences(3, 4, "xqzj zzkw qqpv jjxw wvkz kkqj".split())
    # More than the language's usual, so that the odd texts are references too but no majority.
    texts = good + junk + odd + ["short text", None]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in perplexity.judged(spark.createDataFrame(rows, "doc_id int, text string, lang string")).collect()}
    chosen = [i for i, t, _ in rows if t and perplexity.reference(t)]
    assert not any(i in chosen for i in range(40, 56)) and set(range(40)) <= set(chosen)
    cost = dict(zip(range(len(texts) - 1), brute_kneser_ney([texts[i] for i in chosen], texts[:-1]), strict=True))
    for i, c in cost.items():
        assert got[i]["log_ppl"] == pytest.approx(c, rel=1e-5)
    bins = sorted(math.floor(cost[i] / perplexity.BIN) for i in chosen)
    low, high = (perplexity.BIN * (bins[math.ceil(q * len(bins)) - 1] + 0.5) for q in (0.25, 0.75))
    reach = 3 * max(perplexity.BIN, high - low)
    for i, c in cost.items():
        assert got[i]["kept"] == (not perplexity.features(texts[i])[5] and low - reach <= c <= high + reach)
    assert all(got[i]["kept"] for i in range(40)) and not any(got[i]["kept"] for i in range(40, len(texts)))


def test_pruned_model_stays_a_distribution(spark):
    """With room for few n-grams, those of a small language stay, and the probabilities after any context still add up to 1."""
    big, small = sentences(30, 5, "alpha beta gamma delta epsilon zeta eta theta".split()), ["one two"]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(big)] + [(99, small[0], "de")], "doc_id int, text string, lang string")
    whole, pruned = perplexity.trained(frame), perplexity.trained(frame, entries=40)
    assert all(len(x.keys) <= 40 for x in (*pruned.grams.values(), *pruned.weights.values())) and len(whole.grams[4].keys) > 60
    codes = {r["lang"]: r["c"] for r in frame.select("lang", perplexity.language(F.col("lang")).alias("c")).distinct().collect()}
    fold = perplexity.folded()
    for model in (whole, pruned):
        for lang, text in (("en", "alp"), ("en", "zzz"), ("en", "ta "), ("de", "one")):
            context = codes[lang] << 48
            for c in text:
                context = (context & ~((1 << 48) - 1)) | ((context & ((1 << 24) - 1)) << 12) | int(fold[ord(c)])
            head = (context & ~((1 << 48) - 1)) | ((context & ((1 << 36) - 1)) << 12)
            keys = np.uint64(head) | np.arange(1 << perplexity.SYMBOL, dtype=np.uint64)
            assert np.exp(model.log_p(keys)).sum() == pytest.approx(1, abs=1e-3)
    assert perplexity.mean_costs(pruned, small, np.array([codes["de"]])) == pytest.approx(perplexity.mean_costs(whole, small, np.array([codes["de"]])), rel=0.5)


@pytest.mark.parametrize("entries", [40, 0])
def test_scores_do_not_depend_on_the_arrays_size(spark, monkeypatch, entries):
    """With room for few n-grams or for none, the others' probabilities come by joins: scores equal brute force, verdicts those of full arrays."""
    words = "the cat sat on a mat while old dogs ran over green hills and slept under trees near rivers with many fish".split()
    texts = sentences(30, 1, words) + sentences(3, 4, "xqzj zzkw qqpv".split()) + ["short text", None, "", "%%%% " * 70, "unseen Ωж 文字 " * 9]
    rows = [(i if i % 5 else None, t, "en") for i, t in enumerate(texts)] + [(7, texts[7], "en"), (8, texts[8], "de"), (9, "one two", None)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    seen = lambda found: sorted(((r["doc_id"] or 0, r["n_words"], r["word_chars"], r["kept"], -1.0 if r["log_ppl"] is None else r["log_ppl"]) for r in found.collect()))
    want, passed = seen(perplexity.judged(frame)), sorted(perplexity.passed(frame).collect(), key=repr)
    monkeypatch.setattr(perplexity.trained, "__defaults__", ("text", "lang", entries, None))
    got = seen(perplexity.judged(frame))
    assert [x[:4] for x in got] == [x[:4] for x in want] and [x[4] for x in got] == pytest.approx([x[4] for x in want], rel=1e-5)
    assert sorted(perplexity.passed(frame).collect(), key=repr) == passed and passed
    english = [t for _, t, lang in rows if t and lang == "en"]
    cost = dict(zip(english, brute_kneser_ney([t for t in english if perplexity.reference(t)], english), strict=True))
    one = {r["doc_id"]: r["log_ppl"] for r in perplexity.judged(frame.where("lang = 'en'")).collect() if r["doc_id"]}
    assert all(one[i] == pytest.approx(cost[t], rel=1e-5) for i, t, lang in rows if i and t and lang == "en")


def test_thresholds_share_out_evenly():
    tallies = [(1, 0, 50), (1, 1, 30), (1, 2, 20), (2, 0, 5), (3, 0, 10), (3, 5, 10)]
    assert perplexity.thresholds(tallies, 1000) == {1: 1, 2: 1, 3: 1}
    assert perplexity.thresholds(tallies, 60) == {2: 1, 3: 1, 1: 4}
    assert perplexity.thresholds(tallies, 30) == {2: 1, 3: 32, 1: 1 << 62}


def test_decontamination_of_items_full_of_slots(spark):
    """Items of numbers and names are found word for word; short ones also after a colon or inside a sentence."""
    items = [(1, "Compute 3/4 + 5/8 - 1/2"), (2, "What is the capital of France?"), (3, "12 18 24 30 36 42 48"), (4, "If Ann has 7 apples and Tom has 9 apples, how many apples do Ann and Tom have?")]
    texts = [
        (1, "so: compute 3/4 + 5/8 - 1/2 now"), (2, "Q: What is the capital of France? Paris."), (3, "they asked What is the capital of France"), (4, "the row 12 18 24 30 36 42 48 goes on"),
        (5, "the row 13 18 24 30 36 42 49 goes on"), (6, "compute 1/4 + 3/8 - 1/3 now"), (7, "nothing at all of these"),
        (8, "first. If Kim has 5 apples and Lee has 5 apples, how many apples do Kim and Lee have?"), (9, "first. If Kim has 5 apples and Kim has 6 apples, how many apples do Kim and Kim have?"),
    ]
    found = decontam.leaks(spark.createDataFrame(texts, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["kind"]) for r in found} == {(1, 1, "verbatim"), (2, 2, "verbatim"), (3, 2, "verbatim"), (4, 3, "verbatim"), (8, 4, "reparameterised")}


def test_decontamination_judges_rows_on_their_own(spark):
    """Two texts of one id, or of none, don't add up to a leak; a clean row of a leaking id stays."""
    item = "one river runs down from cold hills past seven mills before winter snow closes all northern roads again"
    words = item.split()
    first, second = " ".join(words[:10]), " ".join(words[8:])
    items = spark.createDataFrame([(1, item)], "item_id int, text string")
    docs = spark.createDataFrame([(None, first), (None, second), (3, first), (3, second), (4, item), (4, "clean"), (None, item), (5, "x " * 200_000 + item), (4, item)], "doc_id int, text string")
    for most in (1_000_000, 0):
        assert {(r["doc_id"], r["covered_tokens"]) for r in decontam.leaks(docs, items, percent=80, broadcast_windows=most).collect()} == {(None, 18), (4, 18), (5, 18)}
    left = decontam.decontaminated(docs, items, percent=80).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == sorted([(0, first), (0, second), (3, first), (3, second), (4, "clean")])


@pytest.mark.parametrize("large", [256, 0])
def test_near_duplicates_of_families_around_the_threshold(spark, monkeypatch, large):
    """Boilerplate families, chains and copies of many shares and lengths give the brute-force components, with and without the prefix filter."""
    monkeypatch.setattr(minmax, "LARGE", large)
    monkeypatch.setattr(minmax, "FEW_IDS", 10**6 if large else 0)
    r = random.Random(8)
    rows = []
    for _ in range(12):
        base = [f"b{r.randrange(10**6)}" for _ in range(r.choice([12, 60, 200]))]
        for _ in range(12):
            share = r.choice([0.5, 0.7, 0.8, 0.86, 0.9, 0.97, 1.0])
            cut = int(len(base) * share)
            at = r.randrange(len(base) - cut + 1)
            rows.append(base[at : at + cut] + [f"u{r.randrange(10**6)}" for _ in range(r.randrange(1 + int(0.3 * len(base))))])
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    got = minmax.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == brute_components(rows)


@pytest.mark.parametrize("few", [0, 1 << 16])
def test_near_duplicates_write_no_table_of_few_rows(spark, monkeypatch, few):
    rng, rows = random.Random(8), []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(60)]
        rows += [(len(rows) + 1000 * family + i, " ".join(base[: 60 - rng.randrange(22)] + [f"t{rng.randrange(99)}" for _ in range(rng.randrange(9))])) for i in range(12)]
    written, keep = [], shared.Scratch.keep
    monkeypatch.setattr(shared, "FEW_ROWS", few)
    monkeypatch.setattr(minmax, "LARGE", 3)
    monkeypatch.setattr(shared.Scratch, "keep", lambda self, *a: (out := keep(self, *a), written.append(id(out) in self.paths))[0])
    got = minmax.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == brute_components(rows)
    assert sum(written) <= 12 if few else sum(written) > 20


@pytest.mark.parametrize("few", [0, 50, 1 << 16])
def test_components_whether_written_or_joined_by_the_driver(spark, monkeypatch, few):
    monkeypatch.setattr(shared, "FEW_ROWS", few)
    rng = np.random.default_rng(4)
    u, v = rng.integers(-1 << 62, 1 << 62, (2, 300))
    u, v = np.concatenate([u, u[:150], v[:99], u[:3]]), np.concatenate([v, u[1:151], v[1:100], u[:3]])
    edges = spark.createDataFrame(list(zip(u.tolist(), v.tolist(), strict=True)), "u bigint, v bigint")
    got = {r["node"]: r["comp"] for r in minmax.components(edges, shared.Scratch(spark, "graph"), len(u)).collect()}
    want = {x: x for x in [*u.tolist(), *v.tolist()]}
    for _ in range(len(want)):
        before = dict(want)
        for x, y in zip(u.tolist(), v.tolist(), strict=True):
            want[x] = want[y] = min(want[x], want[y])
        if want == before:
            break
    parts = lambda labels: {frozenset(k for k in labels if labels[k] == c) for c in set(labels.values())}
    assert parts(got) == parts(want)


def test_few_texts_are_strings_at_once():
    texts = [None, "", *(f"{i} " + "x" * 100_000 for i in range(300))]
    column = pa.array(texts)
    tracemalloc.start()
    try:
        assert sum(len(x or "") for x in shared.each_text(column)) == sum(len(x or "") for x in texts)
        assert tracemalloc.get_traced_memory()[1] < 8 << 20
    finally:
        tracemalloc.stop()
    assert list(shared.each_text(column)) == texts


def test_boilerplate_family_stays_cheap(spark):
    """Pages that share two thirds of their words meet nowhere, so none of them is compared."""
    from galefold.llm.shared import Scratch

    r = random.Random(2)
    base = [f"b{i}" for i in range(80)]
    rows = [(i, " ".join(base + [f"u{r.randrange(10**9)}" for _ in range(20)])) for i in range(400)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    contested = spark.range(400).select(F.lit(0).alias("group"), F.col("id").alias("rep"), F.xxhash64("id").alias("comp"))
    scratch = Scratch(spark, "family")
    sets = scratch.keep(minmax.hashed_sets(contested.select("rep"), texts, 5))
    assert minmax.meetings(minmax.prefixes(contested.join(sets, "rep"), 75), 75, scratch).count() == 0


def brute_windows(text, percent=75):
    """{template: (shared, window's bigrams, place)} of the best window at the places that anchors give."""
    words = licences.re.findall("[a-z0-9]+", text.lower())
    out = {}
    for t in licences.prepared(licences.TEMPLATES):
        best = None
        places = {max(0, at - place) for place, pair in t.anchors(percent) for at in range(len(words) - 1) if f"{words[at]} {words[at + 1]}" == pair}
        for start in sorted(places):
            held = words[start : start + len(t.words)]
            pairs = {f"{a} {b}" for a, b in zip(held, held[1:], strict=False)}
            shared = len(pairs & set(t.pairs))
            if 200 * shared >= percent * (len(pairs) + len(t.pairs)):
                dice = 2.0 * shared / (len(pairs) + len(t.pairs))
                if best is None or dice > best[0]:
                    best = (dice, shared, len(pairs), start)
        if best:
            out[t.number] = best[1:]
    return out


def test_licences_wherever_they_stand(spark):
    """Notices inside longer lines, wrapped, with CRLF or CR, or a few words changed are found; every window equals brute force."""
    r = random.Random(6)
    filler = lambda n: " ".join(r.choice("the of to software licence and in any use work for is it with from".split()) for _ in range(n))
    rows, want = [], set()
    for i, (name, text) in enumerate(licences.TEMPLATES):
        words = text.split()
        wrapped = "\n".join(" ".join(words[k : k + 7]) for k in range(0, len(words), 7))
        changed = [w for k, w in enumerate(words) if k % 23 != 22]
        forms = [f"{filler(40)} {text} {filler(40)}", f"{filler(9)}\n{wrapped}\n{filler(9)}", f"{filler(9)}\r\n" + wrapped.replace("\n", "\r\n") + f"\r\n{filler(3)}", wrapped.replace("\n", "\r"), f"{filler(20)} {' '.join(changed)} {filler(5)}"]
        for k, form in enumerate(forms):
            rows.append((10 * i + k, form))
            want.add((10 * i + k, name))
    rows += [(9000, filler(3000)), (9001, None), (9002, ""), (9003, "the"), (9004, filler(30_000) + " " + licences.TEMPLATES[5][1]), (9004, filler(9)), (None, licences.TEMPLATES[5][1])]
    frame = spark.createDataFrame(rows, "doc_id int, text string").withColumns({"unit": F.lit(1), "licence": F.lit("x"), "template": F.lit(0)})
    found = licences.scan(frame.unionByName(frame.limit(3))).collect()
    assert want <= {(x["doc_id"], x["licence"]) for x in found}
    assert (9004, "Apache-2.0") in {(x["doc_id"], x["licence"]) for x in found} and not {x["doc_id"] for x in found} & {9000, 9001, 9002, 9003}
    windows = {(x["doc_id"], x["template"]): (x["shared"], x["unit_bigrams"], x["unit_no"]) for x in found if x["unit"] == "window"}
    for i, text in rows:
        if i is not None and i < 9000:
            assert {t: v for (doc, t), v in windows.items() if doc == i} == brute_windows(text)


def brute_language(model_rows, texts, buckets=1 << 16, alpha=0.5):
    """Language and posterior of each text by dictionaries: equal priors, n-grams of letters and blanks."""

    def grams(text):
        codes = [0]
        for c in text:
            code = ord(c.lower()[0]) if c.isalpha() else 0
            if code or codes[-1]:
                codes.append(code)
        shift = 64 - (buckets.bit_length() - 1)
        for n in langid.ORDERS:
            for i in range(n - 1, len(codes)):
                if n > 1 or codes[i]:
                    key = sum(codes[i - k] << (21 * k) for k in range(n)) & (2**64 - 1)
                    yield n, ((key + n) * 0x9E3779B97F4A7C15 % 2**64) >> shift

    counts = {}
    for text, lang in model_rows:
        counts.setdefault(lang, Counter()).update(g for _, g in grams(text))
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        total = {x: sum(math.log((c[g] + alpha) / (c.total() + alpha * buckets)) for _, g in grams(text)) / len(langid.ORDERS) for x, c in counts.items()}
        best = max(sorted(total), key=total.get)
        out.append((best, 1 / sum(math.exp(v - total[best]) for v in total.values())))
    return out


def test_languages_equal_brute_force(spark):
    known = {"en": "the quick brown fox jumps over lazy dogs while small cats sleep", "de": "der schnelle braune Fuchs springt über faule Hunde während kleine Katzen schlafen", "fr": "le vif renard brun saute par dessus des chiens paresseux où dorment les chats"}
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(t.split()) for _ in range(r.randrange(1, 9))) + r.choice(["", "!", " 12 "]), lang) for i, (lang, t) in enumerate(list(known.items()) * 12)]
    rows += [(100, None, "en"), (101, "123", "de"), (102, "", None), (103, "Fuchs fox renard", None), (None, "the", "fr"), (104, "é", "fr"), (104, "é", "fr")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumns({"lang_pred": F.lit("x"), "score": F.lit(1)})
    got = langid.identify(frame).collect()
    train = [(t, lang) for i, t, lang in rows if i is not None and lang is not None and t is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    want = {t: x for (_, t, _), x in zip(rows, brute_language(train, [t for _, t, _ in rows]), strict=True)}
    text_of = {i: t for i, t, _ in rows}
    assert len(got) == len(rows)
    for x in got:
        lang, score = want[text_of[x["doc_id"]]]
        assert x["lang_pred"] == lang and x["score"] == pytest.approx(score, abs=2e-6)


def test_resampling_draw_equals_brute_force(spark):
    """Kept are the rows with the largest sums of log weight and Gumbel noise, for ids of any type."""
    r = random.Random(9)
    rows = [(f"d{i}", " ".join(r.choice("alpha beta gamma ### $$$".split()) for _ in range(30)) if i % 9 else None) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", i % 2, 0) for i in range(0, 90, 3)], "doc_id string, quality int, toxic int")
    got = resample.resampled(docs, labels, share=0.4).collect()
    noise = {x["doc_id"]: (x["n"] % 2**64 + 0.5) / 2.0**64 for x in docs.select("doc_id", F.xxhash64("doc_id", F.lit(7)).alias("n")).collect()}
    counts, targets = Counter(), Counter()
    for i, t in rows:
        ids = [b for part in resample.features(t) for b in part.tolist()]
        counts.update(ids)
        if int(i[1:]) % 3 == 0 and int(i[1:]) % 2 == 1:
            targets.update(ids)
    ratio = lambda b: math.log((targets[b] + 1) / (targets.total() + resample.BUCKETS) / ((counts[b] + 1) / (counts.total() + resample.BUCKETS)))
    drawn = {i: sum(ratio(b) for part in resample.features(t) for b in part.tolist()) - math.log(-math.log(noise[i])) for i, t in rows}
    assert {x["doc_id"] for x in got if x["kept"]} == set(sorted(drawn, key=drawn.get, reverse=True)[:36])


def test_bpe_query_equals_the_library(spark):
    """Ids and decoded bytes of the whole table, and of unbroken and repeated pieces beyond the cache's bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        vocabulary = bpe.Vocabulary(f.read(), bpe.class_table(), cached_bytes=500)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    texts = {x["doc_id"]: x["text"] or "" for x in entry.table(spark, SMALL, "documents").collect()}
    for x in entry.op4_byte_bpe(spark, SMALL).collect():
        ids = library.encode_ordinary(texts[x["doc_id"]])
        assert (x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[x["doc_id"]].encode()).hexdigest())
    odd = ["QUJD" * 300, "QUJE" * 300, "ab cd " * 50, "QUJD" * 300]
    ids, counts = vocabulary.encode(odd)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)] == [library.encode_ordinary(t) for t in odd] and vocabulary.held <= 2500


def test_shards_equal_brute_force(spark, tmp_path):
    """Sizes, checksums, slots of the map and gapless places, with null and repeated ids, for slots in parts too."""
    rows = [(i % 40 if i % 7 else None, "é" * (i % 13) if i % 11 else None) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"slot": F.lit("x"), "shard": F.lit(1), "noise": F.lit(0)})
    for piece in (7, 10**6):
        got = slots.sharded(frame, str(tmp_path / f"s{piece}"), shards=5, slots=64, piece=piece).collect()
        assert Counter((x["doc_id"], x["size"], x["text_crc32"]) for x in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
        owner = slots.loaded(spark, str(tmp_path / f"s{piece}"), 1).shards
        assert all(owner[x["virtual_slot"]] == x["shard"] and x["version"] == 1 for x in got)
        places = {}
        for x in got:
            places.setdefault(x["shard"], []).append(x["slot"])
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
        of_id = {}
        assert all(of_id.setdefault(x["doc_id"], x["virtual_slot"]) == x["virtual_slot"] for x in got if x["doc_id"] is not None)
        assert len({x["virtual_slot"] for x in got if x["doc_id"] is None}) > 20


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Nulls in any column, empty texts, repeated rows, clashing columns and an empty table pass every stage."""
    import corpus_pipeline

    rows = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    names = rows.columns
    odd = rows.union(rows.limit(5)).union(spark.createDataFrame([(None,) * len(names), (9991, None, None, None, None), (9992, "", "en", "s", 0), (None, "words " * 80, None, None, 1)], rows.schema))
    odd = odd.withColumns({"kept": F.lit("k"), "key": F.lit(1), "lang_pred": F.lit("x")})
    for frame in (odd, odd.limit(0)):
        given = frame
        for name, stage in corpus_pipeline.STAGES:
            given = stage(spark, given, SMALL).checkpoint()
            if name != "tokens":
                assert sorted(given.columns) == sorted(frame.columns)
        ids = [x["doc_id"] for x in given.select("doc_id").collect() if x["doc_id"] is not None]
        assert len(ids) == len(set(ids)) and bool(ids) == (frame is odd)
