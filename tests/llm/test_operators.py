"""Operators on small tables with odd cases, each against a brute-force version."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymark.llm import (
    bpe,
    decontamination,
    edit_distance,
    html_extraction,
    jaccard_join,
    line_dedup,
    links,
    lm_scoring,
    quality,
    sharding,
    toxicity,
    warc,
    words,
)
from tallymark.llm.shipping import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars int, block string, node long, size int"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words_of(text):
    return WORD.findall(lower(text or ""))


def prose(generator, n):
    return " ".join(generator.choice("alpha Beta gamma delta été 東京 x, y. 9".split()) + str(generator.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    g = random.Random(4)
    base = [prose(g, n) for n in (1, 3, 5, 8, 60, 90, 200, 1500)]
    near = [base[5] + " more words here", lower(base[6]), " ".join(base[6].split()[:-9])]
    lines = ["\n".join(prose(g, 12) for _ in range(6)) for _ in range(5)]
    lines += [lines[0].replace("alpha", "alpna", 1), lines[1] + "\n" + lines[2].split("\n")[0]]
    return [None, "", " \n\t ", *base, *near, *lines, base[7], base[7], "x" * 40_000, "a b " * 400]


@pytest.fixture(scope="module")
def docs(spark, texts):
    ship(spark)
    rows = [(i, t, "en", "host" if i % 3 else None, 0, "b", 7, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < 0")


def test_empty_tables_give_no_rows(spark, none):
    path, pattern = __import__("public_tokenizers").path("byte_bpe_50k.tiktoken"), __import__("public_tokenizers").PATTERN
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    made = [
        lm_scoring.score_texts(none, F.lit(False)),
        decontamination.contaminated(none, items),
        decontamination.clean(none, items),
        line_dedup.report(none),
        line_dedup.filtered(none),
        html_extraction.extract(pages),
        toxicity.score_texts(none, labels, F.lit(False)),
        quality.assess(none),
        quality.filtered(none),
        jaccard_join.components(none),
        jaccard_join.one_of_each(none),
        bpe.encode_texts(none, path, pattern),
        warc.read_archives(warc.write_archives(pages)),
        sharding.shard_texts(none),
    ]
    assert [df.count() for df in made] == [0] * len(made)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 3000, "bucket_entries": 300}])
def test_lm_scores(docs, texts, sizes):
    held = {i for i in range(len(texts)) if i % 4 == 1}
    one, two = Counter(), Counter()
    for i, t in enumerate(texts):
        if i not in held:
            tokens = ["$", *words_of(t), "$"]
            one.update(tokens[1:])
            two.update(zip(tokens, tokens[1:]))
    total, distinct = sum(one.values()), len(one)
    ones, twos = (sum(c == k for c in one.values()) for k in (1, 2))
    discount, prior = ones / (ones + 2 * twos), 8.0
    rows = lm_scoring.score_texts(docs, F.col("doc_id") % 4 == 1, prior=prior, **sizes).collect()
    assert len(rows) == len(texts)
    for r in rows:
        tokens = ["$", *words_of(texts[r.doc_id]), "$"]
        base = score = 0.0
        for u, v in zip(tokens, tokens[1:]):
            p = (one[v] - discount) / total if one[v] else discount * distinct / total
            score += math.log10((two[u, v] + prior * p) / (one[u] + prior))
            base += math.log10((one[v] + 1) / (total + distinct + 1))
        assert (r.n_tokens, r.n_known) == (len(tokens) - 1, sum(one[t] > 0 for t in tokens[1:]))
        assert (r.held_out, r.train_tokens) == (r.doc_id in held, total)
        assert r.score == pytest.approx(score) and r.base_score == pytest.approx(base)


def test_lm_scores_without_pairs_of_equal_words(spark):
    ship(spark)
    rows = spark.createDataFrame([(1, "all words differ"), (2, "differ otherwise")], "doc_id long, text string")
    found = lm_scoring.score_texts(rows, F.col("doc_id") == 2).collect()
    assert len(found) == 2 and all(-20 < r.score < 0 for r in found)


def test_leaks_with_substitutions(spark, docs):
    g = random.Random(8)
    item = [f"w{g.randint(0, 10**6)}" for _ in range(40)]
    some = list(item)
    for k in (3, 12, 20, 31):
        some[k] = "other"
    half = [w if k % 2 else "other" for k, w in enumerate(item)]
    short = ["only", "four", "short", "words"]
    items = [(1, " ".join(item)), (2, " ".join(item).upper()), (3, " ".join(short)), (4, ""), (5, None)]
    texts = {
        0: f"before {' '.join(item)} after",
        1: f"x y z {' '.join(some)}",
        2: f"x {' '.join(half)} y",
        3: " ".join(item[:15]),
        4: f"here stand {' '.join(short)} too",
        5: None,
        6: "nothing of the kind",
    }
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bank = spark.createDataFrame(items, "item_id long, text string")
    for slice_bytes in (1 << 20, 30):
        found = decontamination.contaminated(table, bank, slice_bytes=slice_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in found} == {(0, 1), (0, 2), (1, 1), (1, 2), (4, 3)}
        assert {r.equal_words for r in found if r.doc_id == 1} == {36}
        assert {r.doc_id for r in decontamination.clean(table, bank, slice_bytes=slice_bytes).collect()} == {2, 3, 5, 6}


def test_every_leak_with_substitutions_has_a_hit():
    g = random.Random(2)
    for n in (15, 16, 17, 18, 19, 20, 33, 59):
        item = [f"w{k}" for k in range(n)]
        texts = [[w if k % p != phase else "other" for k, w in enumerate(item)] for p in (4, 5) for phase in range(p)]
        texts += [[w if g.random() > q else "other" for w in item] for q in (0.1, 0.2) for _ in range(300)]
        index = decontamination.Index.build([" ".join(item)])
        (part,) = words.slices(pa.array([" ".join(t) for t in texts]))
        found = {row[0] for row in decontamination.leaks(index, part, 0.7, 40)}
        split = words.words(part, lower=True)
        expected = {i for i in range(len(texts)) if index.overlap(split, i, 0, 0)[0] >= min(0.7 * n, 40)}
        assert found == expected and len(found) > 50


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("band", [0, 1, 2, 5])
def test_banded_edit_distance(band):
    g = random.Random(band)
    pairs = []
    for _ in range(600):
        a = [g.choice("abé") for _ in range(g.randint(0, 16))]
        b = list(a)
        for _ in range(g.randint(0, 6)):
            at = g.randint(0, len(b))
            b[at : at + g.randint(0, 1)] = g.choice(["", "a", "z"])
        pairs.append(("".join(a), "".join(b)))
    sides = [[np.frombuffer(p[k].encode("utf-32-le"), np.uint32) for p in pairs] for k in (0, 1)]
    assert edit_distance.within(*sides, band).tolist() == [edits(a, b) <= band for a, b in pairs]


def test_an_edit_turns_few_parities():
    g = random.Random(9)
    bits = lambda marks: "".join(f"{int(m) & (1 << 64) - 1:064b}" for m in np.atleast_1d(marks))
    for _ in range(500):
        a = [ord(g.choice("abcé")) for _ in range(g.randint(1, 40))]
        b = list(a)
        at = g.randrange(len(b))
        b[at : at + g.randint(0, 1)] = g.choice([[], [ord("a")], [ord("z")]])
        for marks, most in ((line_dedup.parities, 2), (line_dedup.pair_parities, 4)):
            one, two = (bits(marks(np.array(x, dtype=np.uint32))) for x in (a, b or [1]))
            assert not b or sum(x != y for x, y in zip(one, two)) <= most


def removed_lines(texts, most=2, least=24):
    """The lines that go, by document: a line stays if it is the first of its class."""
    places, order = {}, []
    for i, text in enumerate(texts):
        for n, line in enumerate((text or "").split("\n")):
            normal = " ".join(words_of(line))
            if normal:
                order.append((i, n, normal))
                places.setdefault(normal, normal)

    def find(x):
        while places[x] != x:
            x = places[x]
        return x

    unique = list(places)
    for a in unique:
        for b in unique:
            if a < b and min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= most and edits(a, b) <= most:
                places[find(a)] = find(b)
    seen, gone = set(), defaultdict(list)
    for i, n, normal in order:
        if find(normal) in seen:
            gone[i].append(n)
        seen.add(find(normal))
    return gone


def test_lines_within_two_edits(spark):
    ship(spark)
    g = random.Random(5)
    lines = [" ".join(f"{g.choice(['Aa', 'bé', 'c'])}{g.randint(0, 99)}" for _ in range(8)) for _ in range(25)]
    texts = [None, "", "\n \n", "short\nshort\nshort"]
    for _ in range(40):
        part = []
        for line in g.sample(lines, 5):
            chars = list(line)
            for _ in range(g.randint(0, 3)):
                at = g.randrange(len(chars))
                chars[at : at + g.randint(0, 1)] = g.choice(["", "q", "é"])
            part.append("".join(chars))
        texts.append("\n".join(part))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = removed_lines(texts)
    rows = line_dedup.report(table).collect()
    assert {r.doc_id: r.removed_lines for r in rows} == {i: expected.get(i, []) for i in range(len(texts))}
    kept = {r.doc_id: r.text for r in line_dedup.filtered(table).collect()}
    for i, text in enumerate(texts):
        left = [x for n, x in enumerate((text or "").split("\n")) if n not in expected.get(i, [])]
        had = any(words_of(x) for x in (text or "").split("\n"))
        if had and not any(words_of(x) for x in left):
            assert i not in kept
        else:
            assert (kept[i] or "") == "\n".join(left)


def test_line_classes_of_the_general_tables(docs, texts):
    assert {r.doc_id: r.n_removed for r in line_dedup.report(docs).collect()} == {
        i: len(removed_lines([t if t is None or len(t) < 30_000 else "x" for t in texts]).get(i, [])) for i in range(len(texts))
    }


def test_html_pages(spark):
    ship(spark)
    article = "<article class='post'><header><h1>A &amp; B</h1></header><p>one<br> two<p>three <b>four</article>"
    extra = "<nav>menu</nav><header>site</header><div id=sidebar>side</div><div class='cookie-notice'>notice</div>"
    tail = "<div class=comments>said</div><form>f</form><aside>z</aside><footer>&copy;</footer>"
    page = f"<html><head><title>t</title><style>p{{}}</style><script>'</p>'</script></head><body>{extra}{article}{tail}"
    stamp = "<div class=stamp>always the same words</div>"
    rows = [(1, "http://a/x", page), (2, None, None), (3, "http://a/y", ""), (4, "http://a/z", "plain &lt;text")]
    rows += [(100 + i, "http://b/", f"<body>{stamp}<p>text {i}</p>") for i in range(30)]
    rows += [(200 + i, "http://c/", f"<body>{stamp}<p>text {i}</p>") for i in range(3)]
    found = {r.page_id: r for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1].text == "A & B\n\none two\n\nthree four"
    assert (found[2].text, found[3].text, found[4].text) == ("", "", "plain <text")
    assert found[105].text == "text 5"  # the host's thirty pages show that the stamp is no content
    assert found[201].text == "always the same words\n\ntext 1"  # three pages show nothing
    assert all(r.n_chars == len(r.text) for r in found.values())


def test_listed_kinds_that_hold_the_content_stay():
    text = lambda html: html_extraction.main_text(html_extraction.parse(html), set())
    body = "<p>first long paragraph of it</p><p>second long paragraph of it</p>"
    for wrapper in ("has-sidebar", "no-sidebar", "content-with-banner", "sidebar"):
        assert text(f"<div class='{wrapper}'>{body}</div>") == "first long paragraph of it\n\nsecond long paragraph of it"
    assert text(f"<form id=aspnetForm><nav>menu</nav>{body}</form>").startswith("first long")
    assert text(f"<form><article>{body}</article></form>").startswith("first long")
    inside = "<header class='entry-header'><h1>Title</h1></header><section class='related-work'>Work</section>"
    assert text(f"<article>{inside}{body}</article>").startswith("Title\n\nWork\n\nfirst long")
    said = "<div class=comments>" + "<article class=comment-body><p>said</p></article>" * 40 + "</div>"
    rest = "<div class='cookie-notice'><p>notice</p></div><div class='left-sidebar'>side</div><form>find</form>"
    assert text(f"<article>{body}</article>{said}{rest}") == "first long paragraph of it\n\nsecond long paragraph of it"


def test_copies_of_pages_count_once(spark):
    ship(spark)
    page = "<body><div class=stamp>always the same words</div><p>text {}</p>"
    rows = [(i, "http://equal/", page.format(0)) for i in range(30)]
    rows += [(1000 + i, "http://mixed/", page.format(0)) for i in range(970)]
    rows += [(2000 + i, "http://mixed/", page.format(i)) for i in range(1, 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {r.page_id: r.text for r in html_extraction.extract(pages).collect()}
    assert len(found) == len(rows)
    assert {found[i] for i in range(30)} == {"always the same words\n\ntext 0"}  # one page shows nothing
    assert {found[1000 + i] for i in range(970)} == {"text 0"}
    assert all(found[2000 + i] == f"text {i}" for i in range(1, 30))


def test_breaks_part_words_on_large_hosts(spark):
    ship(spark)
    rows = [(i, "http://a/", f"<body><p>Jane{i}<br>May 3</p>") for i in range(30)]
    found = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {i: f"Jane{i} May 3" for i in range(30)}


def test_toxic_texts(spark):
    ship(spark)
    g = random.Random(3)
    syllables = "ta ri mo le ven sol kar bi".split()

    def text(toxic):
        made = ["".join(g.choices(syllables, k=g.randint(1, 3))) for _ in range(g.randint(20, 120))]
        for _ in range(3 * toxic):
            made.insert(g.randrange(len(made)), g.choice(["grobian", "schurke"]))
        return " ".join(made)

    rows = [(i, text(i % 5 == 0)) for i in range(800)] + [(9000, None), (9001, "")]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(800)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = toxicity.score_texts(docs, labels, F.col("doc_id") % 4 == 1).collect()
    held = [r for r in found if r.held_out and r.doc_id < 800]
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held) / len(held)
    assert len(found) == 802 and right > 0.95 and all(0 <= r.score <= 1 for r in found)
    flat = toxicity.score_texts(docs, labels.where("toxic = 0"), F.lit(False)).collect()
    assert {r.predicted for r in flat} == {0}


def test_toxic_texts_without_common_terms():
    g = random.Random(13)
    mild = [a + b + c for a in "ta ri mo le".split() for b in "ven sol kar bi".split() for c in "na zu".split()]
    rare = ["".join(g.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(400)]

    def text(part):
        return " ".join(g.choice(mild if g.random() > part else rare) for _ in range(80)).encode()

    toxic, ordinary = [text(0.25) for _ in range(30)], [text(0) for _ in range(120)]
    assert not toxicity.toxic_passages(toxic, ordinary)  # each rare word is in too few texts
    model = toxicity.fit(toxic, ordinary, 0.2)
    low, high = model.score([text(0) for _ in range(20)]), model.score([text(0.25) for _ in range(20)])
    assert low.max() < toxicity.THRESHOLD < high.min()


def test_quality_figures(docs, texts):
    for r in quality.assess(docs).collect():
        text = texts[r.doc_id] or ""
        found = WORD.findall(text)
        triples = Counter(zip(found, found[1:], found[2:]))
        cover = {i + k for i in range(len(found) - 2) if triples[tuple(found[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected = (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(found) < 50 or 100 * len(cover) > 50 * len(found))
        assert not (r.base_failed and r.kept)


def test_boilerplate_goes_but_copies_stay(spark):
    ship(spark)
    g = random.Random(6)
    own = [" ".join(f"w{g.randint(0, 10**6)}" for _ in range(60)) for _ in range(40)]
    rows = [(i, "Same  line on every page of this host\n" + t, "h") for i, t in enumerate(own)]
    rows += [(100 + i, "Same line on every page of this host\n" * 3 + "few words\n" + f"u{i} v{i}", "h") for i in range(5)]
    rows += [(200 + i, own[0] + "\n" + own[1], "k") for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in quality.assess(table, quality.Rules(min_words=10)).collect()}
    assert all(found[i].kept and found[i].removed_words == 8 for i in range(40))
    assert not any(found[100 + i].kept for i in range(5))
    assert all(found[200 + i].kept and found[200 + i].removed_words == 0 for i in range(50))
    kept = {r.doc_id: r.text for r in quality.filtered(table, quality.Rules(min_words=10)).collect()}
    assert kept[3] == own[3] and kept[201] == rows[-1][1] and 100 not in kept


def test_boilerplate_of_several_lines_and_beside_many_copies(spark):
    ship(spark)
    g = random.Random(16)
    own = [" ".join(f"w{g.randint(0, 10**6)}" for _ in range(60)) for _ in range(40)]
    rows = [(i, t + "\nfirst of the footer\nsecond of it\nlast line of it", "footer") for i, t in enumerate(own)]
    rows += [(100 + i, "stands on every page\n" + t, "copies") for i, t in enumerate(own)]
    rows += [(200 + i, rows[40][1].replace(" ", "  " if i % 2 else " "), "copies") for i in range(90)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in quality.assess(table, quality.Rules(min_words=10)).collect()}
    assert {found[i].removed_words for i in range(40)} == {11}
    assert {found[i].removed_words for i in (*range(100, 140), *range(200, 290))} == {4}
    assert all(r.kept for r in found.values())
    wide = quality.assess(table, quality.Rules(min_words=10, min_host_share=1.0)).collect()
    assert not any(r.removed_words for r in wide)  # the limit grows with the host


def shingles(text):
    found = words_of(text)
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)} if len(found) >= 5 else ({tuple(found)} if found else set())


def component_ids(texts):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for b in range(len(texts)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize("sizes", [{}, {"cell_points": 3, "bucket_entries": 200, "unit_rows": 5}])
def test_jaccard_components(spark, docs, texts, sizes):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(docs, **sizes).collect()}
    assert found == component_ids(texts)
    g = random.Random(12)
    base = [f"t{k}" for k in range(60)]
    many = []
    for _ in range(60):  # a group around the threshold: some links, some not
        some = list(base)
        for _ in range(g.randint(0, 4)):
            some[g.randrange(60)] = f"z{g.randint(0, 3)}"
        many.append(" ".join(some[: g.randint(45, 60)]))
    table = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(table, **sizes).collect()}
    assert found == component_ids(many)


def test_one_document_of_each_group_stays(docs, texts):
    twice = docs.unionByName(docs)
    groups = component_ids(texts)
    kept = [r.doc_id for r in jaccard_join.one_of_each(twice).collect()]
    assert sorted(kept) == sorted(i for i, (_, c) in groups.items() if c == i)


def test_components_of_chains_and_stars(spark):
    ship(spark)
    pairs = [(i, i + 1) for i in range(0, 50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    found = {r.node: r.label for r in links.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 51)} | {100 + i: 100 for i in range(1, 40)}


@pytest.mark.parametrize("sizes", [{}, {"chunk_chars": 64, "overlap_chars": 16}])
def test_byte_bpe(docs, texts, sizes):
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoding, _ = bpe.load(path, pattern)
    rows = bpe.encode_texts(docs, path, pattern, **sizes).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = encoding.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_warc_round_trip(spark):
    ship(spark)
    big = "é<p>\r\n\r\n" * 700
    rows = [(1, "http://a/", big), (2, "http://b c/\r\nX: y", big), (3, None, None), (4, "u", "tiny"), (5, "u", "tiny"), (6, "u", big[:-1]), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(pages, chunk_bytes=97, archive_bytes=4000)
    files = defaultdict(bytes)
    for r in archives.orderBy("archive", "record", "chunk").collect():
        assert len(r.data) < 97 + 1500
        files[r.archive] += bytes(r.data)
    stored = sum(f.count(big.encode()) for f in files.values())
    assert stored == 1 and all(f.startswith(b"WARC/1.0\r\n") and f.endswith(b"\r\n\r\n") for f in files.values())
    found = {r.page_id: r for r in warc.read_archives(archives).collect()}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        kind, refers = ("revisit", 2) if payload == big.encode() and page_id != 2 else ("response", None)
        r = found[page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert (r.record_type, r.refers_to) == (kind, refers)


def test_shards(spark, docs, texts):
    g = random.Random(1)
    rows = [(i, "x" * g.randint(0, 300), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for shards in (16, 5):
        found = sharding.shard_texts(table, shards=shards, slot_rows=50).collect()
        sizes, slots = Counter(), defaultdict(list)
        for r in found:
            sizes[r.shard] += r.size
            slots[r.shard].append(r.slot)
        assert set(sizes) == set(range(shards)) and max(sizes.values()) - min(sizes.values()) <= 4 * 301
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    found = {r.doc_id: r for r in sharding.shard_texts(docs).collect()}
    assert all(found[i].size == len((t or "").encode()) + 1 for i, t in enumerate(texts))
    assert {r.law for r in found.values()} == {"bytes"} and {r.grown_shard for r in found.values()} == {None}


def test_long_words_do_not_join_the_chunks_behind_them(spark):
    import public_tokenizers

    ship(spark)
    g = random.Random(31)
    words_ = ["".join(g.choice("abc12é!'") for _ in range(g.randint(1, 9))) for _ in range(400)]
    long_ = ["".join(g.choice("xyz0123456789+/") for _ in range(n)) for n in (40, 60, 90, 300)]
    cases = [" ".join(words_), "7" * 1000 + " end"]
    cases += [" ".join([*words_[:at], x, *words_[at:]]) for at in (3, 57, 200) for x in long_]
    cases += ["\n\n ".join([*words_[:20], long_[0], long_[1], *words_[20:]]), " " * 500 + "a" + "\n" * 300]
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoding, _ = bpe.load(path, pattern)
    table = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for r in bpe.encode_texts(table, path, pattern, chunk_chars=64, overlap_chars=16).collect():
        ids = encoding.encode_ordinary(cases[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_chunks_are_cut_where_neighbours_agree():
    assert list(bpe.stitch([3, 40, 0], 64)) == [(0, 0, 0, 64), (1, 0, 0, 3), (1, 1, 3, 64), (2, 1, 0, 40), (2, 2, 40, 64), (3, 3, 0, 64)]
    assert [p[1] for p in bpe.stitch([3, None, 0], 64)] == [0, 0, 1, 1, 1]
    one, two = "ab " * 20 + "w" * 30, "w" * 26 + " ab" * 20
    batch = pa.RecordBatch.from_pydict({"row": [0], "chunk": pa.array([0], pa.int32()), "text": [one[:64]], "next": [two]})
    out = next(bpe._compare_whole(r" ?\w+|\s+", 64)(iter([batch])))
    assert out.column("later").to_pylist() == [26]  # the word is longer than an overlap of 16


@pytest.mark.parametrize("band", [0, 1, 2, 5])
def test_edit_distance_of_long_pairs(band):
    g = random.Random(band)
    pairs = []
    for _ in range(25):
        a = [g.choice("abé") for _ in range(g.randint(255, 330))]
        b = list(a)
        for _ in range(g.randint(0, 6)):
            at = g.choice([0, 1, len(b) // 2, len(b) - 1, len(b)])
            b[at : at + g.randint(0, 1)] = g.choice(["", "a", "z"])
        pairs.append(("".join(a), "".join(b)))
    pairs += [("a" * 300, "a" * n) for n in (298, 299, 300, 301, 305)]
    sides = [[np.frombuffer(p[k].encode("utf-32-le"), np.uint32) for p in pairs] for k in (0, 1)]
    assert edit_distance.within(*sides, band).tolist() == [edits(a, b) <= band for a, b in pairs]
