"""BPE, token counts, quality rules, page text and language-model scores."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import MEDIUM
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewmill.llm import class_lm, url_reputation
from reviewmill.llm.bpe import Encoder, bpe_decode, bpe_encode, decode, default_vocabulary
from reviewmill.llm.class_lm import class_lm_scores
from reviewmill.llm.html_text import extract_text, main_text
from reviewmill.llm.mixing import mix_sources
from reviewmill.llm.quality import line_quality, quality_rules
from reviewmill.llm.token_counts import at_limits, length_histogram, limit_totals
from reviewmill.llm.url_reputation import domain_of, judge_urls, suffix_of

DOCS = "doc_id bigint, text string"
LETTERS = [*"abcXYZ019 '.,!\n\t\r\x0b\x00\x1céüß|#*中文🙂", "'s", "'ll", " ", "  ", "<|endoftext|>", "\n\n",
           "the ", " and", "́", "՘", "\U000105c0", "\U0001ccf0", " "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def vocabulary():
    return default_vocabulary()


def test_bpe_equals_the_library_on_odd_texts(library, vocabulary):
    rng = random.Random(2)
    texts = ["".join(rng.choices(LETTERS, k=rng.randrange(40))) for _ in range(4000)]
    texts += ["", "x" * 3000, "ab" * 2000, "é" * 300, " " * 200 + "a", "ẞ" * 70]
    encoder, start = Encoder(vocabulary), 0
    ids, ends = encoder.encode(texts)
    for text, end, wanted in zip(texts, ends.tolist(), library.encode_batch(texts, add_special_tokens=False)):
        assert ids[start:end].tolist() == wanted.ids, repr(text)
        assert decode(vocabulary, ids[start:end]) == library.decode(wanted.ids, skip_special_tokens=False)
        start = end


def test_forgetting_words_changes_nothing(vocabulary, monkeypatch):
    from reviewmill.llm import bpe

    texts = [f"word{i} and {i % 7} more" for i in range(50)]
    whole = Encoder(vocabulary).encode(texts)[0].tolist()
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    encoder = Encoder(vocabulary)
    assert [i for t in texts for i in encoder.encode([t])[0].tolist()] == whole


def test_decoding_bytes_that_are_no_text(library, vocabulary):
    ids = [i for i in range(256)]
    assert decode(vocabulary, np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_columns_nulls_and_clashing_names(spark, library, vocabulary):
    rows = [(1, "Hello  world", 3), (1, "Hello  world", 3), (2, None, 4), (None, "", 5)]
    docs = spark.createDataFrame(rows, f"{DOCS}, n_tokens int")
    encoded = bpe_encode(docs, vocabulary)
    assert encoded.columns == ["doc_id", "text", "n_tokens", "tokens"]
    found = sorted(map(tuple, bpe_decode(encoded, vocabulary).collect()), key=str)
    ids = np.array(library.encode("Hello  world").ids, "<u4").tobytes()
    assert found == sorted([(1, "Hello  world", 3, ids, "Hello  world")] * 2
                           + [(2, None, 0, b"", ""), (None, "", 0, b"", "")], key=str)
    assert bpe_encode(docs.where("doc_id > 9"), vocabulary).count() == 0


def test_length_totals_answer_every_limit(spark, library, vocabulary):
    texts = ["a " * (k * 7 % 23) for k in range(60)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    totals = limit_totals(length_histogram(docs, vocabulary))
    lengths = [len(library.encode(t or "").ids) for t in texts]
    for r in totals.collect():
        limit = r.context_limit
        assert r.docs_upto == sum(n <= limit for n in lengths)
        assert r.tokens_kept == sum(min(n, limit) for n in lengths)
        assert r.tokens_cut == sum(lengths) - r.tokens_kept
        assert r.quantile == r.docs_upto / len(lengths)
    for r in at_limits(totals, [0, 3, 10, 999]).collect():
        assert (r.docs_upto, r.tokens_kept) == (
            sum(n <= r.limit for n in lengths), sum(min(n, r.limit) for n in lengths)
        )
    assert limit_totals(length_histogram(docs.where("doc_id < 0"), vocabulary)).count() == 0


def brute_quality(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(inside),
    )


def test_quality_counts_match_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["a", "bb", "c#c", "é", "\n", "d|"], k=rng.randrange(90))) for _ in range(60)]
    texts += [None, "", "\n \n", "a b c a b c", "a a a a", "x\n" * 5000, "a b c d"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], f"{DOCS}, source string")
    for r in line_quality(docs).collect():
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == brute_quality(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def quality_docs(spark):
    def own(i, n):
        return " ".join(f"w{i}x{k}" for k in range(n))

    menu = " ".join(f"menu{k}" for k in range(60))
    rows = [(i, f"{own(i, 80)}\n {menu.upper()} ", "h") for i in range(30)]
    rows += [(100 + i, f"{menu}\n{own(i, 5)}", "h") for i in range(3)]
    rows += [(200 + i, own("same", 90), "h") for i in range(40)]
    rows += [(300, own(300, 70), None), (301, menu, "other"), (302, None, "h"), (None, own(1, 60), "h")]
    return spark.createDataFrame(rows, f"{DOCS}, source string"), menu


def test_boilerplate_goes_and_depleted_documents_too(spark):
    docs, menu = quality_docs(spark)
    verdicts = {r.doc_id: r for r in line_quality(docs).collect()}
    assert all(verdicts[i].kept and verdicts[i].removed_words == 60 for i in range(30))
    assert not any(verdicts[100 + i].kept for i in range(3))
    # Copies of a document are not boilerplate, and another host's lines are counted apart.
    assert all(verdicts[200 + i].kept for i in range(40))
    assert verdicts[300].kept and verdicts[301].kept and not verdicts[302].kept
    kept = quality_rules(docs)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert all(menu.upper() not in texts[i] for i in range(30)) and len(texts) == 30 + 40 + 3
    assert quality_rules(docs.where("doc_id < 0")).count() == 0


def test_mixing_reaches_target_weights_and_repeats_itself(spark):
    rows = [(i, "x" * 100, "big" if i % 10 else "small") for i in range(4000)]
    rows += [(5000, None, "empty"), (5001, "x" * 50, None), (None, "y", "big")]
    docs = spark.createDataFrame(rows, f"{DOCS}, source string")
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    mixed = mix_sources(docs, weights)
    chars = {r.source: r.n for r in mixed.groupBy("source").agg({"text": "count"}).toDF("source", "n").collect()}
    assert 2.7 < chars["small"] / chars["big"] < 3.3
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mix_sources(docs.repartition(5), weights).collect()))
    # Numbered copies, each as often as it says.
    for r in mixed.groupBy("doc_id").agg({"copy": "max", "n_copies": "max", "*": "count"}).collect():
        assert r["max(copy)"] == r["max(n_copies)"] == r["count(1)"]
    assert mix_sources(docs.where("doc_id < 0")).count() == 0


def test_large_repetition_rates_have_poisson_mean_and_spread(spark):
    rows = [(i, "x", "tiny") for i in range(400)] + [(1000, "y" * 400_000, "huge")]
    docs = spark.createDataFrame(rows, f"{DOCS}, source string")
    weights = spark.createDataFrame([("tiny", 1.0), ("huge", 1.0)], "source string, weight double")
    counts = [r.n for r in mix_sources(docs, weights).where("source = 'tiny'").groupBy("doc_id")
              .count().toDF("doc_id", "n").collect()]
    mean = sum(counts) / 400
    assert abs(mean - 500.5) < 5 and 0.7 < np.var(counts) / mean < 1.4


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1><nav><ul><li><a href=x>Menu</a></li></ul></nav></header><div class="ad">Buy</div>
<div id="cookie-notice">We use cookies</div><article><header><h1>Title &amp; more</h1></header>
<p><b>First   long paragraph of the article with many words in it.<br><p>Second &eacute;&#8212; one.
<div class="advert">Buy more</div><form><input name=a><label>Name</label></form><ul><li>Item one<li>Item two</ul>
<p>Ti.</p><aside>Side</aside></article><section class="comments"><p>Great post, I agree with all of it.</p></section>
<footer>&copy; me</footer></body>"""


def test_page_text_is_the_article(spark):
    wanted = ("Title & more\nFirst long paragraph of the article with many words in it.\n"
              "Second é— one.\nItem one\nItem two\nTi.")
    assert main_text(PAGE) == wanted
    rows = [(1, "u", PAGE, 0), (1, "u", PAGE, 0), (2, None, None, 0), (3, "v", "", 0), (None, "w", "<p>Only", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    found = sorted(map(tuple, extract_text(pages).collect()), key=str)
    assert found == sorted([(1, "u", wanted, len(wanted))] * 2 + [(2, None, "", 0), (3, "v", "", 0),
                                                              (None, "w", "Only", 4)], key=str)
    assert extract_text(pages.where("page_id > 9")).count() == 0


LONG = "A sentence of this part of the page with quite a few words in it, as articles have. "
MENU = "<div>" + "".join(f"<ul><li><a href=x>Link {i}</a></li></ul>" for i in range(12)) + "</div>"


@pytest.mark.parametrize("body, wanted", [
    # Two articles of 60 and 40 percent.
    (f"{MENU}<article><p>{LONG * 6}</p></article><article><p>{LONG * 4}</p></article>",
     [LONG * 6, LONG * 4]),
    # An introduction in main before a nested article.
    (f"{MENU}<main><p>{LONG * 4}</p><article><h2>Head</h2><p>{LONG * 6}</p></article></main>",
     [LONG * 4, "Head", LONG * 6]),
    # Heading, lead and last part in siblings of the container with nearly all content.
    (f"{MENU}<div><h1>Head</h1></div><div><p>{LONG}</p></div><div><p>{LONG * 9}</p><p>{LONG * 9}</p></div>"
     f"<div><p>{LONG[:-1]}!</p></div>", ["Head", LONG, LONG * 9, LONG * 9, LONG[:-1] + "!"]),
    # Words of other things inside names of the article's own parts.
    (f"<div class='content-sidebar-wrap'><div class='x no-sidebar'><h2 id='side-effects'>Side effects</h2>"
     f"<p>{LONG}</p></div></div>", ["Side effects", LONG]),
    (f"<article><section id='side-effects'><p>{LONG}</p></section><h2 id=share>Share</h2><p>{LONG * 2}</p></article>",
     [LONG, "Share", LONG * 2]),
    # A part named as something else that holds the content, beside one that does not.
    (f"<div class='widget'><p>{LONG * 5}</p><p>{LONG * 5}</p></div><div class='comments'><p>{LONG}</p></div>",
     [LONG * 5, LONG * 5]),
    # An advert that is longer than the article stays dark.
    (f"<div class='ad'>{LONG * 3}</div><article><p>{LONG}</p></article>", [LONG]),
])
def test_page_text_has_all_parts_of_the_article(body, wanted):
    assert main_text(f"<html><body>{body}</body></html>").split("\n") == [w.strip() for w in wanted]


def test_page_text_survives_broken_markup():
    rng = random.Random(6)
    pieces = ["<p>", "</div>", "<![CDATA[", "<!-", "<a href='", "&#x110000;", "&", "<", "text ", "</", "<br/>",
              "<script>", "<td>", "]]>", "<!DOCTYPE", "\x00", "<svg/>", "é"]
    for _ in range(2000):
        main_text("".join(rng.choices(pieces, k=12)))
    assert main_text("<div>" * 3000 + "deep" + "</div>") == "deep"


def brute_lm(rows):
    def tokens(text):
        return [*(text or "").encode().lower().split(), b""]

    def out(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    counts = Counter(t for i, text in rows if not out(i) for t in tokens(text))
    total, types = sum(counts.values()), len(counts)
    return {
        i: (out(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
            sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in tokens(t)))
        for i, t in rows
    }


def test_language_model_counts_and_gain(spark):
    """Texts in two invented languages: knowing the class of the last word must help."""
    rng, rows = random.Random(8), []
    for number in range(500):
        tongue = "ab"[number % 2]
        words = [f"{tongue}{min(int(rng.expovariate(0.05)), 300)}" for _ in range(60)]
        rows.append((number, " ".join(words)))
    rows += [(900, None), (901, ""), (902, "unseen words only"), (903, "A1 b2 " * 3000)]
    found = {r.doc_id: r for r in class_lm_scores(spark.createDataFrame(rows, DOCS)).collect()}
    for i, (out, n, known, total, base) in brute_lm(rows).items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    held = [r for r in found.values() if r.held_out and r.doc_id < 500]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def brute_scores(rows, classes, counts):
    """Scores from given classes of all training words, straight from the definition."""
    def tokens(text):
        return [*text.split(), ""]

    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    matrix = np.zeros((66, 65))
    for text in train:
        last, was_once = 65, False
        for word in tokens(text):
            own, once = classes[word], counts[word] == 1
            matrix[last, own] += 1
            if once:
                matrix[last, 64] += 1
            if was_once:
                matrix[64, own] += 1
            if once and was_once:
                matrix[64, 64] += 1
            last, was_once = own, once
    overall = (matrix.sum(axis=0) + 1) / (matrix.sum() + 65)
    p = (matrix + 20 * overall) / (matrix.sum(axis=1, keepdims=True) + 20)
    sizes = Counter()
    for word, n in counts.items():
        sizes[classes[word]] += n
    once = sum(n == 1 for n in counts.values())
    found = {}
    for i, text in rows:
        last, score = 65, 0.0
        for word in tokens(text):
            own = classes.get(word, 64)
            inside = counts[word] / sizes[own] if word in classes else 1 / (once + 1)
            score += math.log10(p[last, own] * inside)
            last = own
        found[i] = score
    return found


def test_language_model_scores_by_neighbours(spark, monkeypatch):
    """The score is that of the classes chosen, with neighbouring tokens as contexts, rare ones too."""
    rng, held = random.Random(5), {}
    rows = [(i, " ".join(f"w{min(int(rng.expovariate(0.02)), 600)}" for _ in range(rng.randrange(40))))
            for i in range(400)]
    kept = class_lm.rare_words

    def watched(tokens, words, rest):
        held.update(zip(words[0].tolist(), words[2].tolist()))
        held.update({r["hash"]: r["class"] for r in rest.collect()})
        return kept(tokens, words, rest)

    monkeypatch.setattr(class_lm, "rare_words", watched)
    monkeypatch.setattr(class_lm, "HELD_LEAST", 12)
    found = {r.doc_id: r.score for r in class_lm_scores(spark.createDataFrame(rows, DOCS)).collect()}
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in [*t.split(), ""])
    hashes = {w: int(np.uint64(xxhash.xxh3_64_intdigest(w.encode())).astype(np.int64)) for w in counts}
    assert set(held) == set(hashes.values())
    assert any(n == 1 for n in counts.values())
    classes = {w: held[h] for w, h in hashes.items()}
    assert found == pytest.approx(brute_scores(rows, classes, counts), rel=1e-9)


def test_language_model_without_training_rows(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(60)], DOCS)
    only = docs.where("crc32(cast(doc_id as string)) % 7 = 2")
    assert {r.train_tokens for r in class_lm_scores(only).collect()} == {0}
    assert class_lm_scores(docs.where("doc_id < 0")).count() == 0


def test_url_rules_and_reputation(spark):
    urls = ["http://WWW.Example.com/en/a?x#y", "https://example.com/en", "http://a.example.com/en/", "x.net/es/",
            "ftp://q.net/es/1", "http://q.net#/fr/", None, "http://", "http://com/", "http://examplecom/en/"]
    rows = [(i, u) for i, u in enumerate(urls)]
    rows += [(100 + i, f"http://bad.org/{i}") for i in range(300)] + [(500 + i, f"http://ok.org/{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame(
        [(100 + i, int(i % 10 > 0)) for i in range(300)] + [(500 + i, int(i % 50 == 0)) for i in range(300)]
        + [(3, 1), (6, None), (999, 1)], "page_id bigint, bad int")
    found = {r.page_id: r for r in judge_urls(pages, labels).collect()}
    assert len(found) == len(rows)
    got = [(found[i].host, found[i].path, found[i].rule, found[i].verdict) for i in range(10)]
    assert got == [
        ("www.example.com", "/en/a", "www.example.com/en/", "allow"), ("example.com", "/en", "com/", "allow"),
        ("a.example.com", "/en/", "example.com/en/", "block"), ("", "", None, "allow"),
        ("q.net", "/es/1", "net/es/", "block"), ("q.net", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("com", "/", "com/", "allow"), ("examplecom", "/en/", None, "allow"),
    ]
    assert {found[100 + i].verdict for i in range(300)} == {"block"}
    assert {found[500 + i].verdict for i in range(300)} == {"allow"}
    assert judge_urls(pages.where("page_id < 0"), labels).count() == 0
    assert {r.verdict for r in judge_urls(pages, labels.where("bad > 5")).where("page_id > 9").collect()} == {"allow"}


def test_hosts_without_labels_follow_domain_suffix_and_all_pages(spark):
    """Two hosts of a bad domain have labels; the third one, with a page of its own, has none."""
    urls = [(i, f"http://h{i % 2}.bad.org/{i}") for i in range(300)]
    urls += [(300 + i, f"http://h{i % 2}.ok.org/{i}") for i in range(300)]
    rows = [*urls, (900, "http://new.bad.org/"), (901, "http://new.ok.org/"), (902, "http://new.other.org/"),
            (903, "http://new.other.info/"), (904, "no host")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(600)], "page_id bigint, bad int")
    found = {r.page_id: r for r in judge_urls(pages, labels).collect()}
    assert len(found) == len(rows)
    assert found[900].verdict == "block" and found[900].n_labelled == 0 and found[900].bad_rate > 0.95
    assert found[901].verdict == "allow" and found[901].bad_rate < 0.05
    # Nothing is known of these but the rates of suffix and of all pages, and those vary too much.
    assert all(found[i].verdict == "allow" and found[i].bad_rate == pytest.approx(0.5) for i in (902, 903))
    assert found[904].bad_rate is None and found[904].verdict == "allow"


def test_repeated_page_ids_count_a_label_once_per_host(spark):
    rows = [(1, "http://a.org/1"), (1, "http://a.org/2"), (1, "http://b.org/"), (2, "http://a.org/3"), (None, "http://a.org/4")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1)], "page_id bigint, bad int")
    found = judge_urls(pages, labels).collect()
    assert sorted((r.page_id or 0, r.host, r.n_labelled) for r in found) == [
        (0, "a.org", 3), (1, "a.org", 3), (1, "a.org", 3), (1, "b.org", 2), (2, "a.org", 3)]


def test_suffixes_by_shape_and_by_list(spark):
    hosts = ["x.y.co.uk", "co.uk", "uk", "a.b.github.io", "b.com.br", "a.news", "a.b.xx", "localhost", ""]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    host = F.col("host")
    shown = frame.select(suffix_of(host, ["github.io"]).alias("s"),
                         domain_of(host, suffix_of(host, ["github.io"])).alias("d")).collect()
    assert [r.s for r in shown] == ["co.uk", "co.uk", "uk", "github.io", "com.br", "news", "xx", "localhost", ""]
    assert [r.d for r in shown] == ["y.co.uk", "co.uk", "uk", "b.github.io", "b.com.br", "a.news", "b.xx", "localhost", ""]


def test_both_verdicts_without_a_rule(spark):
    query = url_reputation.QUERIES["op6_judge_urls"](spark, MEDIUM).where("rule IS NULL")
    assert {r.verdict for r in query.select("verdict").distinct().collect()} == {"allow", "block"}


@pytest.mark.parametrize("bad_pages", [1, 2])
def test_a_few_bad_pages_of_a_domains_only_host_block_nothing(spark, bad_pages):
    """Domains of one host each and very different rates: the suffix has a mean of 0.2 and is weak."""
    labels = [(f"h.d{d}.org", int(d < 2)) for d in range(10) for _ in range(100)]
    labels += [("h.single.org", 1)] * bad_pages
    rows = [(i, f"http://{host}/", bad) for i, (host, bad) in enumerate(labels)]
    both = spark.createDataFrame([*rows, (5000, "http://h.single.org/new", None)],
                                 "page_id bigint, url string, bad int")
    found = {r.page_id: r for r in judge_urls(both.select("page_id", "url"), both.select("page_id", "bad")).collect()}
    # Posterior of 0.2 with strength 1: the host's pages count once.
    mean = (0.2 + bad_pages) / (1 + bad_pages)
    new = found[5000]
    assert new.n_labelled == bad_pages and new.bad_rate == pytest.approx(mean, abs=2e-3)
    low = mean - 1.645 * math.sqrt(mean * (1 - mean) / (2 + bad_pages))
    assert new.bad_rate_low == pytest.approx(low, abs=5e-3)
    assert new.verdict == ("block" if low > 0.3 else "allow")
    assert {found[i].verdict for i in range(200)} == {"block"}


def test_hashes_of_the_bpe_query(spark, library):
    from conftest import SMALL

    from reviewmill.llm.bpe import op2_bpe

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in op2_bpe(spark, SMALL).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
