"""Line blocks (6), language ID (7), SimHash (8), quality rules (9)."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tsquality.llm import extract, langid, quality, simhash

from edge import documents, split, stored

PROSE = "A long enough paragraph of prose that any reader would take as the text of this page, with commas."


# -- 6 -----------------------------------------------------------------------

@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<html></html>", ""), ("plain " + PROSE, "plain " + PROSE),
    ("<nav><a>x</a></nav><div class=ad>Buy</div><article><h1>T &amp; U</h1><p>One\n  two<b>three<p>Four</article><footer>f</footer>",
     "T & U\n\nOne twothree\n\nFour"),
    ("<main><div class=breadcrumb>a</div><article><header><h1>T</h1></header><p>One<br>two &lt;b&gt; &nbsp; x</p>"
     "<script>var a='<p>'</script><!-- <p>no</p> --><ul><li>1</li><li>2</li></ul><form><label>q</label></form></article>"
     "<div>read more</div></main><div class=comments><article><p>" + PROSE + "</p></article></div>",
     "T\n\nOne two <b> x\n\n1\n\n2"),
    ("<body><div class=cookie-notice>" + PROSE + "</div><div id=content><h1>Title</h1><p>" + PROSE + "</p><p>Short.</p>"
     "<div class='ad'>Buy now</div><p>" + PROSE + "</p></div><aside>" + PROSE + "</aside><footer>(c)</footer>",
     "Title\n\n" + PROSE + "\n\nShort.\n\n" + PROSE),
    ("<div role=main><div><p>a</p></div><p>b</p></div><p>" + PROSE + "</p>", "a\n\nb"),
    ("<article><p>" + "w " * 60_000 + "</p></article>", ("w " * 60_000).strip()),
    ("<p>a < b", ""), ("<style>p{}</style><script>" + PROSE, ""),
    ("<article class=comment><p>no</p></article><article><p>yes</p></article>", "yes"),
])
def test_main_text(page, want):
    assert extract.main_text(page) == want


@pytest.mark.parametrize("page,want", [
    # prose beside teasers, whichever are more
    ("<main><p>" + PROSE + "</p><article class=card><p>Teaser one</p></article><p>" + PROSE + "</p>"
     "<article class=card><p>Teaser two</p></article></main>", PROSE + "\n\n" + PROSE),
    # marks without text
    ("<article></article><div><p>" + PROSE + "</p></div>", PROSE),
    # an article in furniture that ends, and in furniture that was left open
    ("<aside><article><p>Teaser</p></article></aside><div><p>" + PROSE + "</p></div>", PROSE),
    ("<aside><article><p>Teaser</aside><div><p>" + PROSE + "</p></div>", PROSE),
    ("<nav><a>x</a><article><p>one</p></article><article><p>two</p></article>", "one\n\ntwo"),
    # open p and li
    ("<article><p class=share>Share<p>one<ul><li class=ad>Buy<li>two</ul><ul><li class=ad>Buy<ul><li>Buy</ul></ul>three"
     "</article>", "one\n\ntwo\n\nthree"),
    ("<article><div><p class=share>Share</div><p>one</article>", "one"),
    # the windows decide on lines of links: none but those beside text
    ("<article><h1><a>Head</a></h1><p>one</p>" + "<p><a>more</a></p>" * 9 + "</article>", "Head\n\none\n\nmore\n\nmore"),
    ("<article><h1>T</h1><div itemprop=articleBody><p>one</p></div></article>", "T\n\none"),
    ("<article><a>Head</a></article>", "Head"),
])
def test_main_text_weighs_marks(page, want):
    assert extract.main_text(page) == want


def test_extracted_table(spark, tmp):
    rows = [(1, "u", "<article><p>é x</p></article>"), (1, "u", "<article><p>é x</p></article>"), (None, None, None), (2, "u", "")]
    pages = stored(spark.createDataFrame([(*r, "clash") for r in rows], "page_id BIGINT, url STRING, html STRING, text STRING"), tmp, "p")
    got = sorted((tuple(r) for r in extract.extracted(pages).collect()), key=str)
    assert got == sorted([(1, "u", "é x", 3), (1, "u", "é x", 3), (None, None, "", 0), (2, "u", "", 0)], key=str)
    assert extract.extracted(pages.limit(0)).collect() == []


@pytest.mark.parametrize("page,want", [
    ("<article><p class=x title=don't>First paragraph here.</p><p>It's the second one.</p></article>",
     "First paragraph here.\n\nIt's the second one."),
    ("<article><p title='a > b' data-x=\"c > d\" y = 'z>'>One</p><p a=\">Two</p></article>", "One\n\nTwo"),
    # A name with other words in it does not drop prose; thin containers with such names go.
    (f"<article><p>{PROSE}</p><section id='search-engines'><h2>Search engines</h2><p>{PROSE}</p></section>"
     f"<div class='social-widget-free'><p>{PROSE}</p></div><div class='free-social-kit'>Like us</div></article>",
     f"{PROSE}\n\nSearch engines\n\n{PROSE}\n\n{PROSE}"),
    (f"<article><p>{PROSE}</p><div class='a search-kit'><div>x</div><div><div>y</div></div></div><p>End.</p></article>", f"{PROSE}\n\nEnd."),
    # Reader comments stay furniture, also where each is an article, or a marked container is left open.
    (f"<article><p>{PROSE}</p><section class='comments'><article class='entry'><p>I read {PROSE}</p></article></section><p>End.</p></article>",
     f"{PROSE}\n\nEnd."),
    (f"<article><p>{PROSE}</p></article><div id=comments-list><article><p>{PROSE} {PROSE}</p></article><article><p>Me too {PROSE}</p></article></div>",
     PROSE),
    (f"<div class='post-comments'><main><p>{PROSE} {PROSE}</p></main></div><p>{PROSE}</p>", PROSE),
    # Furniture left open before the article still opens it.
    (f"<nav><ul><li>menu<article><p>{PROSE}</p></article>", PROSE),
])
def test_names_and_attributes(page, want):
    assert extract.main_text(page) == want


def plain_surged(length, surge, window=extract.WINDOW):
    """Every line of a run from text to a whole window without, if some window in the run reaches ``surge``."""
    keep, k = [False] * len(length), 0
    while k < len(length):
        if not length[k]:
            k += 1
            continue
        end = k
        while end < len(length) and any(length[end:end + window]):
            end += 1
        if any(sum(length[j:j + window]) >= surge for j in range(k, end)):
            keep[k:end] = [True] * (end - k)
        k = end + 1
    return keep


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 1, 5, 30, 79, 80, 200]), max_size=40), st.sampled_from([1, 80]))
def test_line_blocks_equal_plain(length, surge):
    assert extract._surged(np.array(length, int), surge).tolist() == plain_surged(length, surge)


def test_pages_without_their_names(spark):
    """Names taken away, the blocks that are kept are still those of the article."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    right = total = whole = 0
    for page in pages:
        want = extract.main_text(page).split("\n\n")
        got = extract.main_text(re.sub(r"\s(class|id|role)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page)).split("\n\n")
        right += len(set(got) & set(want))
        total += len(set(got) | set(want))
    assert right > 0.95 * total


# -- 7 -----------------------------------------------------------------------

def test_languages(spark, tmp):
    docs = stored(documents(spark, 200).drop("score", "lang_pred"), tmp, "documents")
    model = langid.fit(docs.where("doc_id % 4 <> 2"))
    assert model.languages == ["de", "en", "fr"]
    got = langid.predict(model, docs).select("text", "lang", "lang_pred", "score").collect()
    assert len(got) == docs.count()
    right = [r.lang == r.lang_pred for r in got if r.lang and r.text and len(r.text) > 40]
    assert sum(right) > 0.97 * len(right)
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))


def test_words_before_grams():
    tables = [{"ab": 0}, {"a": 0, "z": 1}, {" z": 0}, {}, {}]
    scores = [np.log([[0.9, 0.1]]), np.log([[0.5, 0.5], [0.1, 0.9]]), np.log([[0.3, 0.7]]), np.zeros((0, 2)), np.zeros((0, 2))]
    m = langid.Model(["x", "y"], tables, scores)
    assert m.predict("AB")[0] == "x"  # a known word
    assert np.allclose(m.back_off("zq"), np.log([0.3, 0.7]))  # its known 2-gram, not its characters
    assert np.allclose(m.back_off("qz"), np.log([0.1, 0.9]))  # no longer gram is known
    assert np.allclose(m.back_off("qq"), [0, 0])
    assert m.predict("qq") == ("x", 0.5)  # a tie: the first by code point
    assert m.predict(None) == m.predict("") == m.predict("12 _") == ("und", 0.0)
    assert m.predict("² ½ ① Ⅷ") == ("und", 0.0)  # numerals are no letters
    assert langid.words_of("Ab²c x½ ①Ⅷ é1ñ") == ["ab", "c", "x", "é", "ñ"]


def test_scores_do_not_depend_on_what_is_kept():
    rng = np.random.default_rng(0)
    letters = list("abcdefg")
    grams = [sorted({"".join(rng.choice(letters, n)) for _ in range(40)}) for n in (3, 1, 2, 3, 4)]
    tables = [{g: k for k, g in enumerate(own)} for own in grams]
    scores = [np.log(rng.random((len(own), 3)) + 0.01) for own in grams]
    texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 5))) for _ in range(60)) for _ in range(20)]
    m = langid.Model(["x", "y", "z"], tables, scores)
    few = langid.Model(["x", "y", "z"], tables, scores)
    few.KEEP = 7
    for t in texts:
        a, b = m.predict(t), few.predict(t)
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-9
    assert len(few.kept) <= 7


def plain_langid(train, max_words, max_grams, smoothing=0.1):
    """fit and predict over all rows, written plainly."""
    languages = sorted({lang for lang, _ in train})
    counts = {n: {} for n in range(5)}
    for lang, text in train:
        for w in langid.words_of(text):
            for n, grams in [(0, [w])] + [(n, langid.grams_of(w, n)) for n in range(1, 5)]:
                for g in grams:
                    counts[n].setdefault(g, {}).setdefault(lang, 0)
                    counts[n][g][lang] += 1
    model = {}
    for n, table in counts.items():
        most, keep = (max_grams if n else max_words) // len(languages), set()
        for lang in languages:
            own = sorted((c[lang] for c in table.values() if lang in c), reverse=True)
            least = own[-1] if len(own) <= most else min((c for c in own if sum(x >= c for x in own) <= most), default=1 << 62)
            keep |= {g for g, c in table.items() if c.get(lang, 0) >= least}
        total = {lang: sum(table[g].get(lang, 0) for g in keep) for lang in languages}
        model[n] = {g: [np.log((table[g].get(x, 0) + smoothing) / (total[x] + smoothing * max(1, len(keep)))) for x in languages] for g in keep}

    def predict(text):
        words = langid.words_of(text)
        if not words:
            return "und", 0.0
        s = np.zeros(len(languages))
        for w in words:
            if w in model[0]:
                s += model[0][w]
                continue
            for n in range(4, 0, -1):
                found = [model[n][g] for g in langid.grams_of(w, n) if g in model[n]]
                if found:
                    s += np.mean(found, axis=0)
                    break
        return languages[int(s.argmax())], float(1 / np.exp(s - s.max()).sum())
    return predict


@pytest.mark.parametrize("options", [{}, {"max_words": 60, "max_grams": 30}])
def test_fit_and_predict_equal_plain(spark, tmp, options):
    docs = stored(documents(spark).where("text IS NULL OR length(text) < 20000"), tmp, "documents")
    rows = docs.select("text", "lang", "doc_id").distinct().collect()
    train = [(r.lang, r.text) for r in rows if r.lang and r.text is not None]
    plain = plain_langid(train, options.get("max_words", 60_000), options.get("max_grams", 20_000))
    model = langid.fit(docs, **options)
    for r in rows:
        (a, x), (b, y) = model.predict(r.text), plain(r.text)
        assert abs(x - y) < 1e-6 and (a == b or x < 0.51)


def test_a_language_with_few_rows_keeps_its_words(spark):
    rows = [(i, "the cat sat on the mat " * 20 + " ".join(f"w{'abcdefgh'[i % 8]}{'abcdefgh'[j % 8]}{'xyz'[j % 3]}" for j in range(60)), "en")
            for i in range(200)]
    rows += [(1000 + i, "quu xoo zee", "rare") for i in range(3)]
    rows += [(None, "same row", "en")] * 50
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    model = langid.fit(docs, docs_per_language=20, max_words=40, max_grams=60)
    assert {"quu", "xoo", "zee"} <= set(model.tables[0])
    assert model.predict("quu zee")[0] == "rare"


def test_no_labelled_rows(spark, tmp):
    docs = stored(documents(spark, empty=True), tmp, "documents")
    model = langid.fit(docs)
    assert model.languages == [] and model.predict("word") == ("und", 0.0)
    assert langid.predict(model, docs.select("doc_id", "text")).collect() == []


# -- 8 -----------------------------------------------------------------------

def plain_fingerprint(text, n):
    w = split(text)
    parts = [b" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, radius):
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(fps))]


def test_near_duplicates(spark, tmp):
    docs = stored(documents(spark, 120), tmp, "documents")
    rows = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text, 3) for r in rows]
    roots = plain_components(fps, 2)
    least = defaultdict(list)
    for r, root in zip(rows, roots):
        least[root] += [r.doc_id] if r.doc_id is not None else []
    want = sorted(((r.doc_id, f"{f:016x}", min(least[root], default=None)) for r, f, root in zip(rows, fps, roots)), key=str)
    got = simhash.near_duplicates(docs).select("id", simhash.fingerprint_text("fp").alias("f"), "component").collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_dense_groups_over_tiles(spark, radius):
    """Chains and clusters of fingerprints, in tiles far smaller than the groups."""
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(500):
        fps.append(fps[rng.randrange(len(fps))] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted({x - (1 << 64) if x >> 63 else x for x in fps} | {0, -1, 1, 3, 7, 15, 31})
    classes = spark.createDataFrame([(x,) for x in fps], "fp BIGINT").repartition(3)
    found = simhash.components(simhash.links(classes, radius, tile_rows=8))
    root = {r.node: r.root for r in found.collect()}
    unsigned = [x & (1 << 64) - 1 for x in fps]
    want = [fps[r] for r in plain_components(unsigned, radius)]
    assert [root.get(x, x) for x in fps] == want


def test_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1000), (7, 7)], "a BIGINT, b BIGINT")
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    assert root == {**{k: 0 for k in range(1, 301)}, 1001: 1000}


# -- 9 -----------------------------------------------------------------------

def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def labelled(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id BIGINT, quality INT, toxic INT, kept STRING")


def test_counts(spark, tmp):
    rng = random.Random(8)
    docs = documents(spark).select("doc_id", "text", "lang").collect()
    docs += [(1000 + k, " ".join(rng.choice("ab c# d |x".split()) for _ in range(rng.randint(0, 120))) + rng.choice(["", "\n", "\n\n a"]), "en")
             for k in range(60)]
    docs = stored(spark.createDataFrame([tuple(r) for r in docs], "doc_id BIGINT, text STRING, lang STRING"), tmp, "documents")
    got = quality.judged(docs, labelled(spark, []))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = sorted(((r.doc_id, *plain_counts(r.text)) for r in docs.collect()), key=str)
    assert sorted((tuple(r) for r in got.select(cols).collect()), key=str) == want
    # Without labels nothing beside the base is rejected.
    assert got.where("kept = base_failed").count() == 0
    assert quality.judged(docs.limit(0), labelled(spark, [(1, 1, 0)])).collect() == []


def binomial_cdf(n, k, p):
    from math import comb
    return sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))


def test_binomial_tail(spark):
    rows = [(n, k) for n in (0, 1, 7, 50, 400) for k in (0, 1, 3, 7) if k <= n]
    df = spark.createDataFrame(rows, "n BIGINT, k BIGINT")
    for p in (0.005, 0.1):
        got = df.select("n", "k", F.exp(quality.log_binomial_cdf(F.col("n"), F.col("k"), p)).alias("x")).collect()
        assert all(abs(r.x - binomial_cdf(r.n, r.k, p)) < 1e-9 for r in got)
    big = spark.createDataFrame([(10_000_000, 49_000)], "n BIGINT, k BIGINT")
    x = big.select(quality.log_binomial_cdf(F.col("n"), F.col("k"), 0.005).alias("x")).first().x
    assert -20 < x < -5  # far below what a float holds term by term, yet a number


def test_thresholds_keep_good_documents(spark, tmp):
    """A rule bites where good documents show it may, and is off where labels are too few."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(3000):
        few = i % 100 == 0
        bad = i % 3 == 0
        text = " ".join("w%d%s" % (rng.randrange(10**6), "##" if bad else "") for _ in range(60))
        rows.append((i, text, "few" if few else "many" if i % 2 else None))
        labels.append((i, 0 if bad else 1, 0))
    rows.append((9999, "## ".join(map(str, range(60))), "other"))
    docs = stored(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING"), tmp, "documents")
    got = {r.doc_id: r.kept for r in quality.judged(docs, labelled(spark, labels), max_false=0.06).collect()}
    for i, _, lang in rows[:-1]:
        assert got[i] == (i % 3 != 0 or lang == "few"), i
    assert got[9999]


def plain_kept(rows, good, max_false, error):
    """kept by the fixed-sequence test, written plainly: (row number: verdict)."""
    counts = [plain_counts(t) for _, t, _ in rows]
    lines = [len([x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]) for _, t, _ in rows]
    rates = [{"symbol_rate": c[2] / c[0] if c[0] else 0, "dup_line_share": c[3] / n if n else 0,
              "repeat_share": c[4] / c[0] if c[0] else 0, "word_length": c[1] / c[0] if c[0] else 0} for c, n in zip(counts, lines)]
    holdout = [k for k, (i, _, _) in enumerate(rows) if i in good and not counts[k][5]]
    strata = {rows[k][2] for k in holdout}
    cuts = {}
    for s in strata:
        own, at = [rates[k] for k in holdout if rows[k][2] == s], {}
        cuts[s] = {}
        for rule, cut in quality.PATH:
            at[rule] = cut
            k = sum(any(r[x] >= c for x, c in at.items()) for r in own)
            if binomial_cdf(len(own), k, max_false) > error / len(strata):
                break
            cuts[s] = dict(at)
    return [not counts[k][5] and not any(rates[k][x] >= c for x, c in cuts.get(s, {}).items()) for k, (_, _, s) in enumerate(rows)], cuts


def test_kept_equals_plain_with_rules_on(spark, tmp):
    rng = random.Random(4)
    rows, good = [], set()
    for i in range(900):
        marks = rng.choice([0, 0, 0, 1, 5, 30])
        w = [f"w{rng.randrange(10**5)}" for _ in range(60)] + ["#"] * marks + ["a b c"] * (rng.choice([0, 0, 4]) if marks >= 5 else 0)
        rng.shuffle(w)
        breaks = rng.choice(["", "\nsame\nsame"]) if marks >= 5 else ""
        rows.append((i, " ".join(w) + breaks * rng.randint(1, 5), rng.choice(["en", "en", "fr", None])))
        if i % 3 and marks < 5:
            good.add(i)
    rows += [(5, None, "en"), (None, "x " * 70, None), (7, rows[7][1], "xx")]
    docs = stored(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING").repartition(3), tmp, "documents")
    got = quality.judged(docs, labelled(spark, [(i, 1, 0) for i in good]), max_false=0.12, error=0.1)
    want, cuts = plain_kept(rows, good, 0.12, 0.1)
    assert sorted(((r.doc_id, r.kept) for r in got.collect()), key=str) == sorted(((i, k) for (i, _, _), k in zip(rows, want)), key=str)
    assert all(cuts[s] for s in ("en", "fr", None)) and sum(want) < sum(not plain_counts(t)[5] for _, t, _ in rows) - 30


def test_thresholds_with_a_few_hundred_labels(spark, tmp):
    """300 good documents switch the rules on at the default risk, 200 do not; a step that rejects good ones ends the path."""
    good = {"on": 300, "few": 200, "tight": 600}
    rows = [(f, 0.0, 0.0, 0.6 if f == "tight" and k < 60 else 0.0, 5.0) for f, n in good.items() for k in range(n)]
    holdout = stored(spark.createDataFrame(rows, "stratum STRING, symbol_rate DOUBLE, dup_line_share DOUBLE, "
                                                 "repeat_share DOUBLE, word_length DOUBLE"), tmp, "rates")
    got = {r.stratum: r.asDict() for r in quality.thresholds(holdout, 0.02, 0.05).collect()}
    for rule, grid in quality.GRIDS.items():
        assert got["on"][f"cut_{rule}"] == grid[0] and got["few"][f"cut_{rule}"] is None
    assert got["tight"] == {"stratum": "tight", "cut_symbol_rate": None, "cut_dup_line_share": 0.75,
                            "cut_repeat_share": None, "cut_word_length": None}
    # What a step lets pass keeps to the exact bound for all rules together.
    assert binomial_cdf(300, 0, 0.02) <= 0.05 / 3 < binomial_cdf(200, 0, 0.02)
