"""Operators 3 to 9 against plain Python versions."""

import hashlib
import zlib

import llm_fixture as fx
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mallscope.llm import host_rules, licenses, main_text, secrets, toxicity
from mallscope.llm.common import remainder, scratch
from mallscope.llm.packing import hilbert_key, pack_along_curve
from mallscope.llm.token_orc import read_token_orc, token_digests, write_token_orc
from mallscope.llm.tokens import TOKENIZER, TextEncoder

ENCODER = TextEncoder()


def ids_of(text, end):
    found = ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
    return np.array(found, dtype="<u4")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBé́İΣ \t\n\x1c\x85.,'s1#<|>endoftext你😀̸क़"), max_size=25), max_size=6))
def test_encoder_equals_the_tokenizer(texts):
    ids, n = ENCODER.encode([t.encode() for t in texts], 2)
    want = [ids_of(t, 2) for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [x for w in want for x in w.tolist()]


def test_encoder_on_texts_beyond_a_chunk_and_special_tokens():
    long = ("Lorem ipsum, dolor! " * 150_000) + "x" * 50
    odd = ["<|endoftext|> a", "A<|EndOfText|>", "", long, "z" * 3000]
    ids, n = ENCODER.encode([t.encode() for t in odd], 7)
    want = [ids_of(t, 7) for t in odd]
    assert n.tolist() == [len(w) for w in want]
    assert zlib.crc32(ids.tobytes()) == zlib.crc32(b"".join(w.tobytes() for w in want))


def test_encoder_starts_anew_when_full():
    small = TextEncoder(max_pieces=50)
    texts = [t for _, t, _ in fx.rows() if t][:40]
    for _ in range(2):
        for t in texts:
            assert small.encode([t.encode()], 1)[0].tolist() == ids_of(t, 1).tolist()
    assert len(small.keys) < 30_000


# --- 5: ORC -------------------------------------------------------------------

def test_token_orc_round_trip(spark):
    path = scratch(spark, "t-orc")
    write_token_orc(fx.docs(spark).repartition(5), path, index_stride=1000)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32)
                 for r in token_digests(read_token_orc(spark, path)).collect())
    assert sum(r[2] for r in got) == sum(len(ids_of(t, 2)) for _, t, _ in fx.rows())
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    ids = [r[1] for r in got]
    assert ids == [None] + sorted(i for i in ids if i is not None)
    want = sorted((-1 if i is None else i, len(x := ids_of(t, 2)), zlib.crc32(x.tobytes())) for i, t, _ in fx.rows())
    assert sorted((-1 if i is None else i, n, c) for _, i, n, c in got) == want


def test_token_orc_lookup_reads_by_id(spark):
    path = scratch(spark, "t-orc")
    write_token_orc(fx.docs(spark), path)
    all_rows = {r.doc_id: (r.start, list(r.ids)) for r in read_token_orc(spark, path).collect() if r.doc_id is not None}
    df = read_token_orc(spark, path, doc_ids=[3, 205, 99999])
    assert {r.doc_id: (r.start, list(r.ids)) for r in df.collect()} == {k: all_rows[k] for k in (3, 205)}
    assert "PushedFilters: [In(doc_id, [" in df._jdf.queryExecution().executedPlan().toString()


def test_token_orc_files_hold_stripes_indexes_and_bloom_filters(spark):
    path = scratch(spark, "t-orc")
    docs = spark.range(0, 60_000, 2).selectExpr("id as doc_id", "concat('number ', id, ' of many ', id * 7) as text")
    write_token_orc(docs, path, stripe_bytes=1 << 16, index_stride=1000)
    jvm = spark._jvm
    files = [f for f in spark.read.orc(path).inputFiles()]
    stripes = 0
    for f in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(
            jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
        assert reader.getRowIndexStride() == 1000
        column = list(reader.getSchema().getFieldNames()).index("doc_id") + 1
        rows = reader.rows()
        for stripe in reader.getStripes():
            streams = rows.readStripeFooter(stripe).getStreamsList()
            kinds = {s.getKind().toString() for s in streams if s.getColumn() == column}
            assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds, kinds
            stripes += 1
        rows.close()
    assert stripes > len(files)

    def rows_read(df):
        found = df.collect()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return len(found), leaf.metrics().apply("numOutputRows").value()

    raw = spark.read.orc(path).select("doc_id", "ids")
    assert rows_read(raw) == (30_000, 30_000)
    # only the row groups that the statistics and filters leave are read; odd
    # ids lie between others, so the Bloom filters alone can tell
    hit, read = rows_read(raw.filter("doc_id = 30000"))
    assert hit == 1 and read <= 2000, read
    miss = [rows_read(raw.filter(f"doc_id = {k}"))[1] for k in range(10_001, 20_001, 2000)]
    assert sorted(miss)[len(miss) // 2] == 0, miss


def test_token_orc_parts_are_in_order_whatever_the_files_are_called(spark):
    path = scratch(spark, "t-orc")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")       # several ranges
        spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")    # and several files of each
        write_token_orc(fx.docs(spark), path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    raw = spark.read.orc(path)
    assert raw.select("part").distinct().count() > 2 and len(raw.inputFiles()) > raw.select("part").distinct().count()
    tokens = read_token_orc(spark, path)
    at = 0
    for r in sorted(tokens.collect(), key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(tokens.collect(), key=lambda r: r.start)]
    assert ids == [None] + sorted(i for i in ids if i is not None)
    assert "BroadcastHashJoin" in tokens._jdf.queryExecution().executedPlan().toString()


def test_token_orc_of_an_empty_table(spark):
    path = scratch(spark, "t-orc")
    write_token_orc(fx.empty(spark), path)
    assert token_digests(read_token_orc(spark, path)).collect() == []


# --- 4: packing ---------------------------------------------------------------

def test_hilbert_curve_visits_neighbours():
    side = 8
    points = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    key = hilbert_key(points, 3)
    assert sorted(key.tolist()) == list(range(side ** 3))
    walk = points[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_packing_covers_every_id_once(spark):
    got = pack_along_curve(fx.docs(spark).repartition(3), seq_len=64).toPandas()
    size = got.groupby("sequence_id").length.sum()
    assert ((size == 64) | (size.map(int.bit_count) == 1)).all()
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    data = fx.rows()
    texts = {i: t for i, t, _ in data}
    for doc_id, part in got[got.doc_id.notna()].groupby("doc_id"):
        ids = ids_of(texts[int(doc_id)], 1)
        times = sum(i == doc_id for i, _, _ in data)
        assert part.length.sum() == times * len(ids) and set(part.doc_tokens) == {len(ids)}
        for p in part.itertuples():
            assert zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32
    assert len(got[got.doc_id.isna()]) >= 1
    assert got.length.sum() == sum(len(ids_of(t, 1)) for _, t, _ in data)
    assert pack_along_curve(fx.empty(spark)).collect() == []


# --- 7: host rules ------------------------------------------------------------

def test_host_rules_equal_plain_version(spark):
    data = fx.rows() + [(300 + k, "bad " * 3, "spam") for k in range(30)] + [(400, fx.rows()[0][1], "spam")]
    got = host_rules.judge(fx.docs(spark, data)).toPandas()
    key = lambda i, t: (-1 if i is None or i != i else int(i), hashlib.sha1((t or "").encode()).hexdigest())
    want = sorted((key(i, t)[0], *[fx.measures(t)[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], *v)
                  for (i, t, _), v in zip(data, fx.verdicts(data), strict=True))
    have = sorted((key(r.doc_id, "")[0], r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                  for r in got.itertuples())
    assert have == want
    assert not got[got.doc_id == 400].kept.any() and set(got[got.host == "spam"].host_verdict) == {"rejected"}
    assert host_rules.judge(fx.empty(spark)).collect() == []


def test_small_hosts_shrink_more_than_large_ones(spark):
    m = spark.createDataFrame([("big", i < 45) for i in range(60)] + [("one", True)] + [("ok", i < 3) for i in range(60)],
                              "host string, failed boolean")
    rate = {r.host: r.rate for r in host_rules.host_rates(m).collect()}
    assert 0.05 < rate["ok"] < 0.2 and 0.6 < rate["big"] < 0.75 and rate["big"] < rate["one"] < 1


def test_repeated_words_with_equal_hashes():
    # windows that share a hash by force are told apart word by word
    ids = np.arange(40, dtype=np.uint64) % np.uint64(7)
    doc = np.zeros(40, dtype=np.int64)
    assert host_rules.repeated_words(ids, doc, 1)[0] == 40
    assert host_rules.repeated_words(np.arange(40, dtype=np.uint64), doc, 1)[0] == 0


# --- 8: licences --------------------------------------------------------------

def test_automaton_gives_the_longest_matches():
    import random
    rnd = random.Random(3)
    for _ in range(30):
        templates = [("t", " ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9)))) for _ in range(3)]
        auto = licenses.LicenseAutomaton(templates, [("a b", "p")])
        texts = [t.split() for _, t in templates] + [["a", "b"]]
        subs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        words = [rnd.choice("abc") for _ in range(25)]
        numbers = [auto.number.get(w.encode(), -1) for w in words]
        for i, (_, n) in enumerate(auto.stream(numbers)):
            assert n == max([k for k in range(i + 2) if k == 0 or tuple(words[i + 1 - k:i + 1]) in subs])


def test_licences_equal_plain_version(spark):
    full = dict((label, text) for label, text in reversed(licenses.TEMPLATES) if len(text) > 150)
    data = fx.rows() + [
        (500, "Intro words. " + full["mit"] + " And more.", "s"), (501, full["bsd"].replace("source and", "source or"), "s"),
        (502, "MIT license; the GENERAL public License, apache-license mit mit license", "s"), (503, " ".join(full["gpl"].split()[:20]), "s")]
    got = {r.doc_id: r for r in licenses.license_scan(fx.docs(spark, data)).collect()}
    for i, t, _ in data:
        w = fx.ALNUM.findall(fx.lower(t))
        hits = [(s, label) for phrase, label in licenses.PHRASES for s in range(len(w))
                if w[s:s + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(hits), ",".join(sorted({h[1] for h in hits}))), i
        assert (r.first_word, r.last_word) == (min((h[0] for h in hits), default=None), max((h[0] for h in hits), default=None))
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
    assert got[500].labels == "mit" and got[500].score == 1 and got[500].spans.startswith("mit:2:")
    assert got[501].labels == "bsd" and 0.8 < got[501].score < 1
    assert got[502].base_labels == "apache,gpl,mit" and got[502].n_base == 4
    assert got[503].labels == "" and 0 < got[503].score < 0.5
    assert (got[200].n_words, got[200].labels, got[200].score, got[200].first_word) == (0, "", 0.0, None)
    assert licenses.license_scan(fx.empty(spark)).collect() == []


def test_whole_licences_among_other_words(spark):
    texts = {f"{label}{i}": (label, text) for i, (label, text) in enumerate(licenses.full_texts())}
    assert {label for label, _ in texts.values()} == {"apache", "artistic", "bsd", "cc0", "gfdl", "gpl", "lgpl", "mpl"}
    data, want = [], {}
    for k, (label, text) in enumerate(texts.values()):
        words = text.split()
        words[len(words) // 2:len(words) // 2] = ["oddword"] * 8
        data += [(2 * k, "foo " * 50 + " ".join(words) + " bar", "s"), (2 * k + 1, " ".join(text.split()[:len(words) // 3]), "s")]
        want[2 * k] = label
    got = {r.doc_id: r for r in licenses.license_scan(fx.docs(spark, data)).collect()}
    for k, label in want.items():
        assert label in got[k].labels.split(",") and got[k].score > 0.95, (k, label, got[k].labels, got[k].score)
    for k, r in got.items():
        # a third of a text is not the text: at most a notice in it is found
        spans = [s.split(":") for s in r.spans.split(",") if s] if k % 2 else []
        assert all(int(b) - int(a) < r.n_words / 2 for _, a, b in spans), (k, r.spans)


def test_phrases_of_one_word(spark):
    data = [(1, "agpl", "s"), (2, "x agpl y agpl the terms of agpl", "s"), (3, "gpl", "s"), (4, "", "s")]
    got = licenses.license_scan(fx.docs(spark, data), [("t", "under the terms of agpl here")], [("agpl", "agpl")]).collect()
    assert {r.doc_id: (r.n_base, r.first_word, r.last_word) for r in got} == {
        1: (1, 0, 0), 2: (3, 1, 7), 3: (0, None, None), 4: (0, None, None)}


def chained(template, words, min_match, max_gap):
    """Covered spans of one template, from all its common runs with ``words``."""
    ends = []                   # longest run ending at each word, and where it ends in the template
    for i in range(len(words)):
        run = {}
        for e in range(len(template)):
            n = 0
            while n <= min(i, e) and words[i - n] == template[e - n]:
                n += 1
            run[e] = n
        n = max(run.values())
        ends.append((n, sorted(e for e in run if run[e] == n)))
    out, chain = [], None
    for i, (n, at) in enumerate(ends):
        if n < min_match or (i + 1 < len(ends) and ends[i + 1][0] > n):
            continue
        start = i - n + 1
        if chain:
            shared = max(0, chain[1] - start + 1)
            later = [e for e in at if e - n + 1 > chain[2] - shared]
            if later and start - chain[1] - 1 <= max_gap:
                chain = [chain[0], i, min(later), chain[3] + n - shared]
                continue
            out.append(chain)
        chain = [start, i, min(at), n]
    return [(a, b, min(1.0, c / len(template))) for a, b, _, c in out + [chain] * bool(chain)]


def test_chains_equal_plain_version():
    import random
    rnd = random.Random(5)
    seen = 0
    for _ in range(200):
        template = [rnd.choice("abcdef") for _ in range(rnd.randint(3, 25))]
        words = []
        for _ in range(rnd.randint(1, 4)):
            a = rnd.randrange(len(template))
            words += template[a:a + rnd.randint(1, 12)] + [rnd.choice("abcxyz") for _ in range(rnd.randint(0, 4))]
        auto = licenses.LicenseAutomaton([("t", " ".join(template))], [])
        numbers = [auto.number.get(w.encode(), 0) for w in words]
        _, matches = licenses._scan_runs(auto, [(0, numbers)], 3)
        got = [(a, b, share) for _, a, b, share in licenses._chain(auto, matches, 2)]
        assert got == chained(template, words, 3, 2), (template, words)
        seen += len(got) > 1
    assert seen > 10


# --- 9: main text -------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No &amp; title</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><a href="/">Logo</a></header><nav><ul><li><a href="/a">One</a></li><li>Two</li></ul></nav>
<!-- ad --><div class="cookie-notice">We use cookies on this site, please accept all of them now.</div>
<div class="ad">Buy now, a very cheap offer for you and all of your friends today.</div>
<article><h1>The  title</h1><p><b>First
 paragraph &amp;amp; more &eacute;.<br>Second line.<p>Short.</p><ul><li>An item of the article</li></ul>
<div class="comments"><p>I think this is a comment of some reader, and quite a long one as well.</p></div></article>
<aside>Related things to read after this one.</aside><form><label>Name</label><input><button>Send it</button></form>
<footer>&copy; 2024 somebody. All rights reserved for ever and ever.</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text.page_text(PAGE) == "The title\nFirst paragraph &amp; more é. Second line.\nShort.\nAn item of the article"


def test_pages_without_article_and_odd_pages():
    text = "This is a long enough paragraph of plain prose, with a full stop at its end and some more words."
    page = f"<body><div id='menu'><a href='x'>Home</a></div><div><p>{text}</p><p>{text}</p></div><div class=footer>Imprint</div>"
    assert main_text.page_text(page) == f"{text}\n{text}"
    assert main_text.page_text("") == "" and main_text.page_text("<") == "<" * 0 + main_text.page_text("<")
    for odd in ("<p", "<a href='", "<!-- never closed", "<script>x", "</p></div>", "plain", "<p>a<div", "&#0;&bogus;", "<b " * 2000):
        assert isinstance(main_text.page_text(odd), str)


def test_elements_without_end_tags_lose_no_text():
    a, b = (f"This is the {n} paragraph of the article, long enough to be told from anything else here." for n in ("first", "second"))
    want = f"{a}\n{b}"
    for head in ("<head><title>t</title><meta charset=utf-8>", "<head><title>t</title></head>", "<title>t</title>"):
        assert main_text.page_text(f"<html>{head}<body><article><p>{a}</p><p>{b}</p></article>") == want
        assert main_text.page_text(f"<html>{head}<article><p>{a}</p><p>{b}</p></article>") == want
    for odd in ("<svg viewBox='0 0 1 1'/>", '<svg width="1" />', "<svg>", "<select>", "<object data=x>", "<template>", "<iframe src=x>",
                "<noscript>", "<svg-icon></svg-icon>", "<svg><svg><path/></svg>gone</svg>", "<svg><text>gone</text></svg>",
                "<select><option>gone</select>", "<object><object></object>gone</object>", "<script>'<svg>gone'</script>",
                "<svg><script>'</svg>'</script>", "<!-- <template> -->"):
        assert main_text.page_text(f"<article><p>{a}</p>{odd}<p>{b}</p></article>") == want, odd
        assert main_text.page_text(f"<article><p>{a}</p>{odd}<p>{b}</p></article><svg><text>x</text></svg>") == want, odd
    for odd in ("<script>", "<style>", "<textarea>", "<!--"):
        assert main_text.page_text(f"<article><p>{a}</p><p>{b}</p>{odd}<p>gone</p></article>") == want, odd
    assert len(main_text.blocks("<p>x</p><svg><select>" * 20000)) == 20000


def test_article_resets_the_names_around_it():
    text = "This is a long enough paragraph of plain prose, with a full stop at its end and some more words."
    for tag in ("article", "main"):
        page = f"<body><div class='sidebar menu'><{tag}><p>{text}</p><div class=comments><article><p>No. {text}</p></article></div></{tag}></div>"
        assert main_text.page_text(page) == text
    assert main_text.page_text(f"<body><aside><article><p>{text}</p></article></aside>") == ""


@pytest.mark.parametrize("piece", ["<b ", '<a "x', "<a ='x", '<a ="x', "if a <b and c <d then ", "<!x", "<!--", "</p>",
                                   "<div>", "<div></p>", "<p><ul><li></div>", "<script ", "<svg><title", "< ", "=\" <i "])
def test_work_grows_with_the_page_however_malformed(piece):
    import time
    page = f"<article><p>A first sentence of the page.</p>{piece * ((1 << 18) // len(piece))}"
    t = time.process_time()
    main_text.blocks(page)
    small = time.process_time() - t
    t = time.process_time()
    main_text.blocks(page * 4)
    assert time.process_time() - t < 10 * small + 3      # in proportion; a square would be 16 times


def test_a_sign_that_starts_no_tag_is_text():
    text = "Here if a <b and c <d then the sum is <5 for all of them, as the table says."
    assert main_text.page_text(f"<article><p>{text}</p></article>") == text
    page = '<article><p title="a > b" data-x=\'<p>\'>Some text of the article, that goes on.</p></article>'
    assert main_text.page_text(page) == "Some text of the article, that goes on."


def test_min_cut_is_minimal():
    import itertools
    import random
    rnd = random.Random(5)
    for _ in range(60):
        n = rnd.randint(1, 8)
        score = [rnd.choice([-1, 1]) * rnd.randint(0, 9) for _ in range(n)]
        edges = [(a, b, rnd.randint(1, 5)) for a in range(n) for b in range(a + 1, n) if rnd.random() < 0.5]

        def cost(label):
            return (sum(max(s, 0) for s, x in zip(score, label, strict=True) if not x)
                    + sum(max(-s, 0) for s, x in zip(score, label, strict=True) if x)
                    + sum(w for a, b, w in edges if label[a] != label[b]))

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert cost(main_text.min_cut([float(s) for s in score], edges)) == pytest.approx(best)


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 5), (2, None, None, 5), (None, "v", "", 5), (1, "u", PAGE, 5)],
                                  "page_id long, url string, html string, n_chars int")
    got = main_text.extract_main_text(pages).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert sorted(r.n_chars > 0 for r in got) == [False, False, True, True]
    assert main_text.extract_main_text(pages.limit(0)).collect() == []


# --- 6: secrets ---------------------------------------------------------------

def test_trigram_queries():
    q = secrets.trigram_query
    assert q("abcd") == [frozenset({"abc", "bcd"})]
    assert set(q("(?:foo|bar)x")) == {frozenset({"foo", "oox"}), frozenset({"bar", "arx"})}
    assert q("ab") == q("[0-9a-f]{24,}") == q("x*abc|y") == [frozenset()]
    assert q("abc.*def") == [frozenset({"abc", "def"})]
    assert set(q("AB_?C")) == {frozenset({"abc"}), frozenset({"ab_", "b_c"})}


def test_secrets_equal_plain_version(spark):
    got = [r for r in secrets.secret_report(fx.docs(spark).repartition(3)).collect()]
    assert len(got) == len(fx.rows())
    texts = {}
    for i, t, _ in fx.rows():
        texts.setdefault(i, t)
    for r in got:
        found = fx.secrets(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(f[3] == k for f in found) for k in ("assign", "access", "hex"))
        spans = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(spans.split(",")) - {""} <= set(r.spans.split(","))
    # leftmost and not overlapping: the second "token: abcdefgh" begins inside a dropped match
    assert [f[3] for f in fx.secrets(texts[206])] == ["assign"]
    assert secrets.secret_report(fx.empty(spark)).collect() == []


def test_more_rules_and_redaction(spark):
    key = "ghp_" + "Ab1" * 12
    data = [(1, f"x {key} y", "s"), (2, "-----BEGIN RSA PRIVATE KEY-----", "s"), (3, "ftp://joe:hunter22@host/x", "s"),
            (4, "clean", "s"), (5, None, "s"), (6, f"token={key};{key}", "s"), (6, f"token={key};{key}", "s")]
    kinds = {r.doc_id: r.spans for r in secrets.secret_report(fx.docs(spark, data)).collect()}
    assert kinds[1] == f"github:2:{2 + len(key)}" and kinds[2].startswith("private_key:0:") and kinds[3].startswith("url_login:0:")
    out = secrets.redact(fx.docs(spark, data))
    assert out.columns == fx.docs(spark, data).columns
    clean = sorted((r.doc_id, r.text, r.n_chars) for r in out.collect() if r.doc_id != 5)
    mask = "[secret]"
    assert clean == [(1, f"x {mask} y", 12), (2, mask, 8), (3, mask + "host/x", 14), (4, "clean", 5),
                     (6, f"{mask};{mask}", 17), (6, f"{mask};{mask}", 17)]


def test_index_holds_every_trigram_and_serves_later_rules(spark, monkeypatch):
    monkeypatch.setattr(secrets, "PIECE_CHARS", 7)      # texts of many pieces
    data = [(1, "Zürich pass ZÜR-9911 \U0001F600ab", "s"), (2, "zür 12", "s"), (3, "ab", "s"), (4, None, "s"),
            (5, "x" * 30 + "QRS-77" + "y" * 30, "s"), (6, "abcdef" * 9, "s"), (6, "abcdef" * 9, "s")]
    docs = fx.docs(spark, data)
    index = secrets.build_index(docs)
    every = {t[i:i + 3] for _, t, _ in data if t for t in [t.lower()] for i in range(len(t) - 2)}
    named = spark.createDataFrame([(t,) for t in every], "t string").selectExpr("t", "xxhash64(t) as trigram")
    held = {(r.t, r.text_hash) for r in index.join(named, "trigram").collect()}
    of = {r.text_hash: r.text.lower() for r in secrets._keyed(docs).collect()}
    assert held == {(t, h) for t in every for h, text in of.items() if t in text}
    assert index.select("trigram").distinct().count() == len(every)
    # rules made after the index
    later = [secrets.Rule("badge", r"QRS-[0-9]{2}"), secrets.Rule("seven", "(?:cdefab){2}")]
    want = sorted(map(tuple, secrets.find_secrets(docs, later).collect()))
    monkeypatch.setattr(secrets, "build_index", None)
    assert sorted(map(tuple, secrets.find_secrets(docs, later, index).collect())) == want
    assert sorted((k, i, a, b) for k, i, _, a, b in want) == [
        ("badge", 5, 30, 36), ("seven", 6, 2, 14), ("seven", 6, 14, 26), ("seven", 6, 26, 38), ("seven", 6, 38, 50)]


# --- 3: toxicity --------------------------------------------------------------

def test_toxicity_learns_from_positives_and_unlabelled(spark):
    import random
    rnd = random.Random(1)
    data, toxic = [], {}
    for k in range(900):
        words = fx._words(rnd, rnd.randint(20, 60))
        toxic[k] = k % 9 == 0
        if toxic[k]:
            words[3:3] = rnd.sample(fx.TOXIC, 2)
        data.append((k, " ".join(words), "s"))
    data += [(2000, None, "s"), (2001, "", "s"), (None, "idiot moron", "s"), (2002, "idiot moron scum clown", "s"),
             (2002, "idiot moron scum clown", "s")]
    labels = spark.createDataFrame([(k, int(v), 1) for k, v in toxic.items() if k % 2 == 0] + [(None, 1, 1), (5000, 1, 1), (7, None, 1)],
                                   "doc_id long, toxic int, score int")
    training = lambda c: remainder(c, 5) != 0
    got = toxicity.toxicity(fx.docs(spark, data), labels, training, buckets=1 << 16).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [(toxic[r.doc_id], r.predicted) for r in got if r.doc_id is not None and r.doc_id < 900 and fx.crc(r.doc_id, 5) == 0]
    right = sum(t == bool(p) for t, p in held) / len(held)
    recall = sum(p for t, p in held if t) / sum(t for t, _ in held)
    assert right > 0.97 and recall > 0.9, (right, recall)
    assert {r.predicted for r in got if r.doc_id == 2002} == {1} and {r.predicted for r in got if r.doc_id in (2000, 2001)} == {0}


def test_risk_and_gradient_of_positive_unlabelled_learning():
    rnd = np.random.default_rng(2)

    def part(n, share):
        dense = rnd.random((n, 4)) < share
        r, c = np.nonzero(dense)
        return dense, (r, c, n)

    (dp, xp), (du, xu) = part(6, 0.6), part(11, 0.3)
    turned = 0
    for _ in range(40):
        w, b, prior = rnd.normal(size=4) * 3, float(rnd.normal()), float(rnd.uniform(0.05, 0.9))

        def parts(w, b):
            loss = lambda s, y: np.log1p(np.exp(-y * s))
            sp, su = dp @ w + b, du @ w + b
            return (loss(su, -1).mean() - prior * loss(sp, -1).mean(), prior * loss(sp, 1).mean())

        negative, positive = parts(w, b)
        got = toxicity.nnpu_risk(xp, xu, w, b, prior)
        assert np.isclose(got[0], negative) and np.isclose(got[1], positive + max(0.0, negative))
        # the step goes down the whole risk, or up its negative part where that is below 0
        goal = (lambda w, b: sum(parts(w, b))) if negative >= 0 else (lambda w, b: -parts(w, b)[0])
        h = 1e-6
        slope = [(goal(w + h * e, b) - goal(w - h * e, b)) / (2 * h) for e in np.eye(4)]
        slope.append((goal(w, b + h) - goal(w, b - h)) / (2 * h))
        assert np.allclose(got[2], slope, atol=1e-5)
        turned += negative < 0
    assert 0 < turned < 40


def test_features_chosen_are_typical_of_positives():
    use = toxicity.choose_features(np.array([50, 50, 10, 50]), np.array([60, 900, 12, 55]), 50, 1000, 0.05, max_features=2)
    assert use.tolist() == [3, 0]


def test_toxicity_learns_from_one_row_of_an_id(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(toxicity, "fit_nnpu", lambda p, u, *_: drawn.append((len(p), len(u))) or (np.zeros(1 << 20), 0.0))
    data = [(i, f"text number {i}", "s") for i in range(8)] + [(3, "text number 3", "s")] * 50 + [(4, "another text", "s")]
    docs = fx.docs(spark, data)
    toxicity.fit(docs, docs.filter("doc_id in (3, 5)").select("doc_id"), docs.select("doc_id"), 0.1)
    assert drawn == [(2, 8)]


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(fx.docs(spark), none, lambda c: F.lit(True)).collect()
    assert len(got) == len(fx.rows()) and not any(r.predicted for r in got)
    assert toxicity.toxicity(fx.empty(spark), none, lambda c: F.lit(True)).collect() == []


def test_tokenizer_file_is_not_copied():
    assert "site-packages" in TOKENIZER or TOKENIZER.startswith("/opt")
