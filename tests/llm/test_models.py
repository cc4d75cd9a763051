"""Language, toxicity, context trees, web pages, mixing, near copies, the pipeline."""

import html
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetgauge.llm import context_tree, html_text, language_id, mixing, near_dedup, queries, toxicity
from tests.conftest import SMALL
from tests.llm.helpers import ROWS, mixture_targets, near_components, none, odd, shingle_set

DOCS = f"{SMALL}/documents.parquet"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(DOCS).collect()


def test_language_of_held_out_texts(spark, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents}
    rows = queries.QUERIES["op3_language_id"](spark, SMALL).collect()
    assert len(rows) == len(lang) and all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    model = language_id.train(odd(spark))
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(odd(spark), model).collect()}
    assert {found[i] for i in (1, 2, 3, 9)} == {"und"} and found[8] == "de" and found[4] == "en"
    assert language_id.identify(none(spark), model).count() == 0
    empty = language_id.train(none(spark))
    assert {r["lang_pred"] for r in language_id.identify(odd(spark), empty).collect()} == {"und"}


def test_unseen_words_fall_back_to_the_longest_known_grams():
    found, grams = {"abc": [9, 1]}, {"ab": [1, 9], "a": [9, 1], "<": [1, 1]}
    held = language_id.Counts.of(grams, 2)
    places = {gram: int(held.find(np.array([language_id.name_hash(gram)], np.uint64))[0]) for gram in grams}
    model = language_id.Model(["x", "y"], language_id.Counts.of(found, 2), held, places)
    assert model.predict("abc")[0] == "x" and model.predict("abz")[0] == "y" and model.predict("az")[0] == "x"


def plain_language(train, text):
    """Word-first backoff by its definition, in dictionaries: (language, score)."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    languages = sorted({lang for lang, _ in train})
    if not letters or not languages:
        return "und", 0.0
    found, grams = {}, {}
    for lang, body in train:
        for word in "".join(c if c.isalpha() else " " for c in body.lower()).split():
            found.setdefault(word, Counter())[lang] += 1
    for word, by in found.items():
        x = f"<{word}>"
        for gram in {x[i:i + n] for n in range(1, language_id.LONGEST + 1) for i in range(max(1, len(x) - n + 1))}:
            grams.setdefault(gram, Counter()).update(by)

    def log(counts, name, lang):
        spread = sum(counts[name].values()) / sum(sum(c.values()) for c in counts.values())
        return math.log((counts[name][lang] + spread) / (sum(c[lang] for c in counts.values()) + 1))

    total = dict.fromkeys(languages, 0.0)
    for word in letters:
        names, counts, at = [word], found, 0
        if word not in found:
            x, names, counts = f"<{word}>", [], grams
            while at < len(x):
                size = next((n for n in range(min(language_id.LONGEST, len(x) - at), 0, -1) if x[at:at + n] in grams), 0)
                names += [x[at:at + size]] if size else []
                at += size or 1
        for name in names:
            for lang in languages:
                total[lang] += log(counts, name, lang)
    best = max(languages, key=lambda lang: total[lang])
    return best, 1 / sum(math.exp(total[lang] - total[best]) for lang in languages)


def test_language_against_the_definition(spark):
    bodies = [("de", "Der Hund läuft über die Straße und bellt."), ("de", "Die Katze schläft, der Hund wacht."),
              ("en", "The dog runs over the street and barks."), ("fr", "Le chien court dans la rue et aboie."), ("fr", None),
              ("xx", "½ ² Ⅷ 12")]
    rows = [(i, body, lang) for i, (lang, body) in enumerate(bodies)]
    rows += [(10, "Der Strassenhund schlief", None), (11, "streets and dogs Ⅷx½y", None), (12, "½ ² Ⅷ", None), (13, "rue chienne", None),
             (14, "Hund dog chien", None), (15, "zzz qqq", None), (16, "", None), (17, "straße " * 3000 + "Straßen " * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.identify(docs, language_id.train(docs)).collect()}
    for doc_id, text, _ in rows:
        want = plain_language([(lang, body or "") for lang, body in bodies], text or "")
        assert got[doc_id]["lang_pred"] == want[0] and got[doc_id]["score"] == pytest.approx(want[1], abs=1e-5), text
    assert got[12]["lang_pred"] == got[5]["lang_pred"] == "und"


def test_a_model_beyond_its_stated_size_is_an_error(spark):
    docs = spark.createDataFrame([(1, "one two three", "en")], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="entries"):
        language_id.train(docs, max_entries=2)


def test_restoring_noisy_words():
    counts = Counter()
    for word in ["idiot", "loser", "trash", "clown", "the", "and", "a", "of", "that", "stupid"] * 20:
        marked = f" {word} "
        counts.update(marked[i:i + n] for n in range(1, toxicity.ORDER + 1) for i in range(len(marked) - n + 1))
    restorer = toxicity.Restorer(toxicity.CharacterModel(counts))
    for noisy, word in {"1d10t": "idiot", "i d i o t": "idiot", "l0s3r": "loser", "tr@$h": "trash", "trashhhhh!!": "trash",
                        "c.l.o.w.n": "clown", "sssttttupid": "stupid", "the": "the", "I-D-I-O-T": "idiot"}.items():
        assert word in restorer.words(f"and {noisy} of"), noisy
    assert restorer.words("") == set() and restorer.words("12 34 !? ...") == set()


def test_restoring_signs_at_the_edges_of_words():
    counts = Counter()
    for word in ["idiot", "loser", "trash", "clown", "shit", "ass", "as", "the", "and", "a", "of", "that", "stupid"] * 20:
        marked = f" {word} "
        counts.update(marked[i:i + n] for n in range(1, toxicity.ORDER + 1) for i in range(len(marked) - n + 1))
    restorer = toxicity.Restorer(toxicity.CharacterModel(counts))
    for noisy, words in {"sh!+": {"shit"}, "(lown": {"clown"}, "!diot": {"idiot"}, "+rash": {"trash"}, "|oser": {"loser"}, "tra$#": {"trash"},
                         "@$$": {"ass"}, "455": {"ass"}, "<l0wn!": {"clown"}, "(that": {"that"}, "loser!": {"loser"}, "###and": {"and"},
                         "(and)": {"and"}, "1990": set(), "!!": set(), "12": set(), "": set()}.items():
        assert restorer.words(noisy) == words, noisy


def test_toxicity_of_held_out_texts(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.QUERIES["op5_toxicity"](spark, sf).collect()
    assert len(rows) == 1000 and all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(r["score"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    high, low = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([a > b for a in high for b in low]) >= 0.7


def test_toxicity_learns_from_every_labelled_row(spark):
    """The words of single rows among many: whatever rows a sample left out, their words would be missed."""
    rows = [(i, f"plain text number{'abcdefghij'[i % 10]} says {'badly ' if i % 2 else ''}things{i // 10}", i % 2) for i in range(21_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    scorer = toxicity.train(frame, frame)
    # Every text is distinct, so the count of a word is the number of rows it was learned from.
    assert scorer.counts[" pla"] == len(rows) and scorer.counts[" bad"] == len(rows) // 2
    scores = {r["doc_id"]: r["score"] for r in toxicity.rate(frame.limit(50), scorer).collect()}
    assert all((s >= 0.5) == (i % 2 == 1) for i, s in scores.items())


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, "x"), (5, 1, "x"), (8, 0, "x"), (8, 0, "x"), (1, None, "x"), (None, 1, "x"), (99, 0, "x")],
                                   "doc_id long, toxic int, text string")
    scorer = toxicity.train(odd(spark), labels)
    rows = toxicity.rate(odd(spark), scorer).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.rate(none(spark), scorer).count() == 0
    alone = toxicity.train(none(spark), labels.filter("toxic = 0"))
    assert all(r["score"] < 0.01 for r in toxicity.rate(odd(spark), alone).collect())


def brute_chance(stream, training, depth):
    """log10 of a stream's probability by context trees of byte decisions, straight from the definition."""
    counts = {}
    for text in training:
        padded = b"\n" * depth + text
        for at in range(depth, len(padded)):
            for d in range(depth + 1):
                for bit in range(8):
                    key = (d, padded[at - d:at], (padded[at] | 256) >> (8 - bit))
                    counts.setdefault(key, [0, 0])[(padded[at] >> (7 - bit)) & 1] += 1
    children = {}
    for d, context, prefix in counts:
        if d:
            children.setdefault((d - 1, context[1:], prefix), []).append((d, context, prefix))
    weighted = {}

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    def weigh(key):
        if key not in weighted:
            own = kt(*counts[key])
            weighted[key] = (own, 1.0) if key[0] == depth else None
            if weighted[key] is None:
                both = np.logaddexp(own, sum(weigh(c)[0] for c in children.get(key, []))) - math.log(2)
                weighted[key] = (both, math.exp(own - math.log(2) - both))
        return weighted[key]

    def chance(d, context, prefix, bit):
        key = (d, context[len(context) - d:], prefix)
        own = (counts.get(key, [0, 0])[bit] + 0.5) / (sum(counts.get(key, [0, 0])) + 1)
        if d == depth or (d + 1, context[len(context) - d - 1:], prefix) not in counts:
            return own
        share = weigh(key)[1]
        return share * own + (1 - share) * chance(d + 1, context, prefix, bit)

    padded, total = b"\n" * depth + stream, 0.0
    for at in range(depth, len(padded)):
        for bit in range(8):
            total += math.log10(chance(0, padded[at - depth:at], (padded[at] | 256) >> (8 - bit), (padded[at] >> (7 - bit)) & 1))
    return total


def test_context_trees_against_the_definition(spark, documents):
    words = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in documents}
    short = sorted(words, key=lambda i: len(words[i]))[:25]
    frame = spark.read.parquet(DOCS).filter(F.col("doc_id").isin(short))
    learn = [i for i in short if fold(i, 7) != 2]
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    training = [context_tree.stream(words[i]) for i in learn]
    counted = Counter(w for i in learn for w in words[i])
    n, v = sum(counted.values()) + len(learn), len(counted) + 1
    # With room for few grams and words, most take the way through the joins.
    for limits in ({}, {"max_words": 20, "max_grams": 50, "task_words": 30, "piece_bytes": 40}):
        rows = context_tree.score(frame, ~held_out, **limits).collect()
        assert len(rows) == len(short)
        for row in rows:
            mine = words[row["doc_id"]]
            base = sum(math.log10(counted[w] + 1) for w in mine) + math.log10(len(learn) + 1) - (len(mine) + 1) * math.log10(n + v + 1)
            assert row["base_score"] == pytest.approx(base, rel=1e-9)
            assert (row["n_tokens"], row["train_tokens"]) == (len(mine) + 1, n)
            assert row["n_known"] == sum(counted[w] > 0 for w in mine) + 1
            assert row["score"] == pytest.approx(brute_chance(context_tree.stream(mine), training, context_tree.DEPTH), rel=1e-6)


def test_a_context_gives_all_bytes_a_probability_of_one_together():
    grams, _ = context_tree.grams([*context_tree.pieces(b"abracadabra\n", 4), *context_tree.pieces(b"abba\n")])
    assert sorted(grams) == sorted(context_tree.grams([*context_tree.pieces(b"abba\n"), *context_tree.pieces(b"abracadabra\n")])[0])
    found, n = np.unique(grams, return_counts=True)
    base = int(found[3]) >> 8 << 8
    asked = np.arange(base, base + 256)
    every = np.union1d(found, asked)
    times = np.zeros(len(every), np.int64)
    times[np.searchsorted(every, found)] = n
    trees = context_tree._trees(every, times)
    nodes = trees[-1]
    keys, at = np.unique(((nodes.keys >> 8) & 255) << 8 | nodes.keys & 255, return_inverse=True)
    top = context_tree.Top(pa.table([keys, *(np.bincount(at, x, len(keys)) for x in (
        nodes.zeros, nodes.ones, nodes.weighted))], names=["key", "zeros", "ones", "children"]))
    bit, chance = ((every & 255)[:, None] >> (7 - np.arange(8))) & 1 == 1, None
    for nodes in trees:
        chance = nodes.chance(bit, chance)
    whole = top.chance(every, bit, trees[-1], chance).prod(1)
    assert whole[np.searchsorted(every, asked)].sum() == pytest.approx(1)


def test_counts_of_words_and_grams_are_merged_by_run():
    texts = [(1, b"to be or not to be"), (0, b"to be"), (1, b""), (0, b"or else")] * 3
    keys, n = context_tree._merged([context_tree._run(np.array(x)) for x in ([5, 3, 5], [7, 3], [5])])
    assert keys.tolist() == [3, 5, 7] and n.tolist() == [2, 3, 1]
    words, found = (Counter(), Counter()), (Counter(), Counter())
    for fold, text in texts:
        tokens = text.split()
        mine = context_tree.grams([*context_tree.pieces(context_tree.stream(tokens))])[0].tolist()
        for told, seen in ((words, tokens), (found, mine)):
            told[1].update(seen)
            if fold:
                told[0].update(seen)
    for limit, size in ((1000, 1000), (2, 7)):  # one batch of counts, and one every few words
        record = pa.RecordBatch.from_arrays([pa.array([f for f, _ in texts]), pa.array([t for _, t in texts], pa.binary())], ["train", "text"])
        counted = [row for out in context_tree._count(limit, size)(iter([record])) for row in out.to_pylist()]
        for name, (train, every) in (("word", words), ("gram", found)):
            sums = Counter(), Counter()
            for row in counted:
                if row[name] is not None:
                    sums[0][row[name]] += row["n_train"]
                    sums[1][row[name]] += row["n_all"]
            assert +sums[0] == train and sums[1] == every


def test_grams_are_looked_up_in_place():
    keys, logs = np.array([2, 4, 9]), np.array([-1.0, -2.0, -3.0], np.float32)
    value, known = context_tree.looked_up(np.array([9, 1, 4, 9, 10, 2]), keys, logs)
    assert value.tolist() == [-3, 0, -2, -3, 0, -1] and known.tolist() == [True, False, True, True, False, True]
    assert not context_tree.looked_up(np.array([1, 2]), keys[:0], logs[:0])[1].any()


def test_context_trees_of_odd_rows(spark):
    rows = context_tree.score(odd(spark), F.col("doc_id") > 3).collect()
    assert len(rows) == len(ROWS) and all(r["score"] < 0 and r["base_score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert context_tree.score(none(spark)).count() == 0
    untrained = context_tree.score(odd(spark), F.lit(False)).collect()
    assert all(r["base_score"] == 0 and r["n_known"] == 0 and r["bits_per_byte"] == pytest.approx(8) for r in untrained)


def test_main_text_of_pages(spark):
    rows = {r["page_id"]: r for r in queries.QUERIES["op10_html_text"](spark, SMALL).collect()}
    for page in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", page["html"] or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", article[1] if article else "")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
        got = rows[page["page_id"]]
        assert got["text"] == "\n\n".join(b for b in blocks if b)
        assert (got["url"], got["n_chars"]) == (page["url"], len(got["text"]))


BODY = "Long running text that makes up the article and goes on for a while, with commas."


@pytest.mark.parametrize(("page", "text"), [
    (f"<nav><a>Home</a></nav><div class='sidebar'><p>{BODY}</p></div><div><h1>T</h1><p>{BODY}</p><p>{BODY}</p></div>",
     f"T\n\n{BODY}\n\n{BODY}"),
    (f"<article><header><h1>Head</h1></header><p>A &amp; b<br>c&nbsp;d</p><p>x<div class='comments'><p>{BODY}</p></div></article>",
     "Head\n\nA & b c d\n\nx"),
    (f"<main><p>{BODY}<form><p>{BODY}</p></form><aside>{BODY}</aside><p>Short.</main><footer>{BODY}</footer>", f"{BODY}\n\nShort."),
    (f"<article><p>{BODY}</p><p>broken off <a hre", f"{BODY}\n\nbroken off"),
    ("<div id='cookie-notice'>We use cookies</div><script>if (a<b) {'</p>'}</script><!-- <p>no</p> --><p>Just this</p>", "Just this"),
    (f"<article><p>{BODY}</p><section id='discussion-comments'><article class='comment'>{BODY}</article></section></article>"
     f"<article class='comment odd'><p>{BODY}</p></article>", BODY),
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p></p><ul></ul>", ""), ("<<>>< <p", "<<>><"),
])
def test_main_text_of_odd_pages(spark, page, text):
    rows = html_text.extract(spark.createDataFrame([(1, None, page, "x")], "page_id long, url string, html string, text string"))
    assert [tuple(r) for r in rows.collect()] == [(1, None, text, len(text))]


def test_short_lines_at_both_edges_of_the_text():
    page = (f"<div><p>Site</p><p>Slogan</p></div><div><h1>Title</h1><p>By A</p><p>May 1</p><p>{BODY}</p><p>{BODY}</p><p>So.</p>"
            "<p>It goes.</p><p>End.</p></div><div><p>x</p><p>One</p><p>Two</p></div>")
    got = html_text.main_text(page).split("\n\n")
    assert got == ["Title", "By A", "May 1", BODY, BODY, "So.", "It goes.", "End."]
    nested = f"<div><h1>Title</h1><p>By A</p><div><p>{BODY}</p><p>{BODY}</p></div></div>"
    assert html_text.main_text(nested).split("\n\n") == ["Title", "By A", BODY, BODY]


def test_line_blocks_cut_adverts_at_the_edges_of_an_article():
    advert = "<div class='x1'><p>Buy now</p><p>Cheap shoes</p><p>Only today</p></div>"
    page = (f"<article>{advert}<h1>Title</h1><p>By A</p><p>May 1</p><div><p>{BODY}</p><p>{BODY}</p></div><p>So.</p>"
            f"<section><h2>Last</h2><p>Words.</p></section>{advert}</article>")
    assert html_text.main_text(page).split("\n\n") == ["Title", "By A", "May 1", BODY, BODY, "So.", "Last", "Words."]
    split = f"<main><div><h1>Title</h1><p>By A</p></div><div><p>{BODY}</p><p>{BODY}</p><p>So.</p><p>End.</p></div></main>"
    assert html_text.main_text(split).split("\n\n") == ["Title", "By A", BODY, BODY, "So.", "End."]


def test_names_inside_an_article_drop_only_what_is_no_text():
    page = (f"<article><header class='entry-header'><h1>Title</h1></header><p>{BODY}</p><p class='notice-text'>Take note.</p>"
            "<section id='related-work'><h2>Related work</h2><p>Older.</p></section><section id='social-history'><p>Past.</p>"
            "</section><h2 id='notice-periods'>Notice periods</h2><div id='comment-syntax'><p>Lines of signs.</p></div>"
            f"<pre>x <span class='token comment'># why</span></pre><p>{BODY}</p><div class='ad-box'><p>{BODY}</p></div>"
            f"<div class='wide related'><p>{BODY}</p></div><div class='social'><p>{BODY}</p></div></article>")
    assert html_text.main_text(page).split("\n\n") == [
        "Title", BODY, "Take note.", "Related work", "Older.", "Past.", "Notice periods", "Lines of signs.", "x # why", BODY]
    assert html_text.main_text(f"<div class='page-header'><p>{BODY}</p></div><p>{BODY} {BODY}</p>") == f"{BODY} {BODY}"


def test_an_article_bounds_the_text_however_short():
    comments = "".join(f"<p>{BODY} Says reader {i}.</p>" for i in range(8))
    short = f"<article><h1>Title</h1><p>First, short.</p></article><div class='x9'>{comments}</div>"
    assert html_text.main_text(short).split("\n\n") == ["Title", "First, short."]
    page = (f"<article><h1>Title</h1><p>{BODY}</p><div class='notice-box'><p>We use cookies. {BODY}</p></div><section class='social history'>"
            f"<h2>Social history</h2><p>{BODY}</p></section><section class='comments wide'><p>{BODY}</p></section>"
            f"<div id='related-links'><p>{BODY}</p></div><section class='related'><p>{BODY}</p></section><p>End.</p></article><p>{BODY}</p>")
    assert html_text.main_text(page).split("\n\n") == ["Title", BODY, "Social history", BODY, "End."]


def test_links_that_are_text():
    page = (f"<h1><a href='/'>Title</a></h1><p>{BODY}</p><p><a href='x'>A linked paragraph.</a></p><p>see <a>A&nbsp;&amp;&nbsp;B</a></p>"
            f"<p>{BODY}</p><ul><li><a>One</a></li><li>&middot; <a>Two</a></li><li><a>Three</a></li></ul><p>{BODY}</p>")
    want = ["Title", BODY, "A linked paragraph.", "see A & B", BODY, BODY]
    for around in ("article", "div"):
        assert html_text.main_text(f"<{around}>{page}</{around}>").split("\n\n") == want
    line = html_text.lines("<p>see <a>A&nbsp;&amp;&nbsp;<b>B</b></a> and <a> C </a></p>")[0]
    assert (line.text, line.links, line.bare) == ("see A & B and C", 6, False)


def test_no_pages(spark):
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def check_mixture(rows, sizes, sources):
    whole = Counter()
    for key, n in sizes.items():
        whole[sources[key]] += n
    goal, taken, longest = mixture_targets(dict(whole)), Counter(), max(sizes.values())
    for r in rows:
        key = r["doc_id"]
        assert (r["size"], r["source_size"]) == (sizes[key], whole[sources[key]])
        assert r["target"] == pytest.approx(float(goal[sources[key]])) and r["taken"] in (0, r["size"], 2 * r["size"])
        taken[sources[key]] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= longest for s in whole)


def test_mixture(spark, documents):
    sizes = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in documents}
    sources = {r["doc_id"]: r["source"] for r in documents}
    first = queries.QUERIES["op4_mixing"](spark, SMALL).collect()
    check_mixture(first, sizes, sources)
    assert sorted(first) == sorted(queries.QUERIES["op4_mixing"](spark, SMALL).collect())


def test_mixture_of_odd_rows(spark):
    rows = [r for r in ROWS if r[0] not in (None, 8)]
    frame = odd(spark).filter("doc_id <> 8")
    check_mixture(mixing.mix(frame, weights=[3, 1, 2]).collect(), {r[0]: len((r[1] or "").encode().split()) for r in rows},
                  {r[0]: r[3] for r in rows})
    assert mixing.mix(odd(spark), weights=[3, 1, 2]).count() == len(ROWS)
    assert mixing.mix(none(spark), weights=[1]).count() == 0
    blank = mixing.mix(odd(spark).filter("doc_id < 4"), weights=[1, 2]).collect()
    assert {r["taken"] for r in blank} == {0}


def check_near(rows, texts):
    want = near_components(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {
        i: (len(shingle_set(t)), want[i], want[i] == i) for i, t in texts.items()}


def test_near_copies(spark, documents):
    check_near(queries.QUERIES["op9_near_dedup"](spark, SMALL).collect(), {r["doc_id"]: r["text"] for r in documents})


def test_near_copies_in_large_groups_and_slices(spark, monkeypatch):
    rng, texts = np.random.default_rng(5), {}
    shared = [f"s{i}" for i in range(40)]
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(120)]
        for _ in range(60):
            words = list(base)
            for at in rng.integers(0, 120, rng.integers(0, 5)):
                words[at] = f"x{rng.integers(0, 1000)}"
            texts[len(texts)] = " ".join(words)
    for i in range(60):  # unrelated texts that share a passage
        texts[len(texts)] = " ".join([*shared, *(f"u{i}n{j}" for j in range(60))])
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_near(near_dedup.near_duplicates(frame).collect(), texts)
    monkeypatch.setattr(near_dedup, "SLICE", 16)
    check_near(near_dedup.near_duplicates(frame).collect(), texts)


def test_unlike_texts_of_one_passage_meet_by_two_slices(spark, monkeypatch):
    rng, texts, cross = np.random.default_rng(6), {}, near_dedup._cross
    shared = [f"s{i}" for i in range(60)]
    for i in range(200):
        words = [*shared, *(f"u{i}n{j}" for j in range(40))]
        texts[len(texts)] = " ".join(words)
        if i % 8 == 0:
            for n in range(3):
                words[int(rng.integers(0, 100))] = f"x{i}n{n}"
                texts[len(texts)] = " ".join(words)

    def bounded(percent):
        merge = cross(percent)

        def rows(records):
            held = list(records)
            sizes = Counter(pair for r in held for pair in zip(r["token"].to_pylist(), r["slice"].to_pylist(), strict=True))
            assert max(sizes.values(), default=0) <= 64, "a group of more than two slices"
            return merge(iter(held))

        return rows

    monkeypatch.setattr(near_dedup, "_cross", bounded)
    monkeypatch.setattr(near_dedup, "SLICE", 16)
    check_near(near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect(), texts)


def test_sketches_of_few_hashes_do_not_refuse_pairs_at_the_threshold():
    def missed(hashes):  # fewer than the least number of shared hashes, of so many kept at 0.75
        least = math.ceil((0.75 - near_dedup.MARGIN) * hashes)
        return sum(math.comb(hashes, n) * 0.75**n * 0.25**(hashes - n) for n in range(least))

    assert missed(near_dedup.SKETCH // 2) < 1e-7
    hashes = np.arange(0, 200, 2, dtype="<u4")  # 64 shared of a union of 100, both thinned out once
    sketches = [hashes[:82].tobytes(), hashes[18:].tobytes()]
    members = near_dedup.Members([1, 2], [b"\0" * 64] * 2, [1, 1], sketches, 75)
    assert members.like(0)[0][1] == pytest.approx(0.64) and members.like(0)[2].tolist() == [False, True]


def test_near_copies_of_odd_rows(spark):
    rows = near_dedup.near_duplicates(odd(spark)).collect()
    assert len(rows) == len(ROWS)
    found = {r["doc_id"]: r for r in rows}
    assert [found[i]["component_id"] for i in range(1, 11)] == [1, 2, 3, 4, 4, 6, 6, 8, 9, 10]
    assert [found[i]["n_shingles"] for i in (1, 2, 3, 8)] == [0, 0, 0, 1]
    assert found[None]["component_id"] is None and not found[None]["kept"]
    assert near_dedup.near_duplicates(none(spark)).count() == 0


def test_pipeline_stage_by_stage(spark, documents):
    docs, columns = spark.read.parquet(DOCS), corpus_pipeline.DOCUMENT
    left = {r["doc_id"]: r for r in documents}
    step = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        rows = out.collect()
        if name != "sequences":
            assert out.columns == columns
            assert all(tuple(r) == tuple(left[r["doc_id"]][c] for c in columns) for r in rows)
            docs = spark.createDataFrame(rows, docs.schema)
        step[name] = [r["doc_id"] for r in rows]
    sure = {i for i, r in left.items() if any(c.isalpha() for c in r["text"] or "")}
    assert set(step["language"]) <= sure and len(step["language"]) >= 0.97 * len(sure)
    first = {}
    for i in sorted(step["language"]):
        first.setdefault((left[i]["text"] or "").encode().lower(), i)
    assert sorted(step["exact copies"]) == sorted(first.values())
    near = near_components({i: left[i]["text"] for i in step["exact copies"]})
    assert sorted(step["near copies"]) == sorted(set(near.values()))
    times = Counter(step["mixture"])
    words = {i: len((left[i]["text"] or "").encode().split()) for i in step["near copies"]}
    assert set(times) <= set(words) and set(times.values()) <= {1, 2}
    assert sum(words[i] * n for i, n in times.items()) == pytest.approx(1.5 * sum(words.values()), rel=0.05)
    assert set(step["sequences"]) == set(times)


def test_pipeline_rows_that_share_an_id(spark):
    def docs(*rows):
        return spark.createDataFrame([(i, text, "en", "s", n) for n, (i, text) in enumerate(rows)],
                                     "doc_id long, text string, lang string, source string, n_chars long")

    def left(stage, *rows):
        return sorted((r["doc_id"], r["text"], r["n_chars"]) for r in stage(spark, docs(*rows), SMALL).collect())

    assert left(corpus_pipeline.language, (1, "words of a text"), (1, "12 ½"), (2, "more words")) == [
        (1, "words of a text", 0), (2, "more words", 2)]
    assert left(corpus_pipeline.exact_copies, (1, "a"), (1, "a"), (2, "b"), (2, "A"), (3, "B"), (2, "c")) == [
        (1, "a", 0), (2, "b", 2), (2, "c", 5)]
    same, near = "a b c d e f g h i j k l m n o p q r s t", "a b c d e f g h i j k l m n o p q r s x"
    assert left(corpus_pipeline.near_copies, (1, same), (1, same), (2, near), (3, "another text")) == [
        (1, same, 0), (3, "another text", 3)]


def test_pipeline_over_nothing_and_oddities(spark):
    for docs in (none(spark), odd(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            if name != "sequences":
                assert docs.columns == corpus_pipeline.DOCUMENT
                docs = spark.createDataFrame(docs.collect(), docs.schema)
        docs.collect()
