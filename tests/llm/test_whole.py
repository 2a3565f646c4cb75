"""Parts of the job that an operator once left out."""

import collections
import itertools
import math
import random
import struct
from fractions import Fraction

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from strataprop.llm import decontaminate, language, ngram_join, toxicity, words
from strataprop.llm.components import components
from strataprop.llm.decontaminate import find_contamination
from strataprop.llm.language import fit_language, predict_language
from strataprop.llm.pii import find_pii, redact
from strataprop.llm.sharding import shard_records
from strataprop.llm.toxicity import fit_toxicity, score_toxicity
from strataprop.llm.url_filter import filter_urls
from strataprop.operators import joins

SF_DIR = "/root/testdata/sf0.01"


# --- op1 ----------------------------------------------------------------------------------------


def test_homepages_of_one_suffix_one_big_host_and_null_urls_are_spread(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    rules = [("net", "/", "block"), ("big.net", "/a/", "allow"), ("org", "/x", "block")]
    urls = [f"http://h{k}.net/" for k in range(400)] + [f"http://big.net/{'ab'[k % 2]}/{k}" for k in range(400)]
    urls += [None] * 400 + ["http://one.org/x?q"] * 200
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        judged = filter_urls(frame, spark.createDataFrame(rules, "host string, path string, verdict string"))
        sizes = [r["count"] for r in judged.groupBy(F.spark_partition_id()).count().collect()]
        found = {r["page_id"]: (r["rule"], r["verdict"]) for r in judged.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert found == {k: brute.url_rule(url, rules) for k, url in enumerate(urls)}
    # a third of the 1400 rows has no url; 24 tasks of 58 rows each on average
    assert max(sizes) < 250


# --- op3 ----------------------------------------------------------------------------------------


def test_copies_of_one_text_leave_room_for_all_languages(spark):
    rng = random.Random(3)
    words = {"aa": "bada gaba daba", "bb": "zizo wizo kiwo", "cc": "mule nule lume"}

    def texts(language, n):
        return [" ".join(rng.choices(words[language].split(), k=9)) for _ in range(n)]

    rows = [(text, language) for language, n in (("aa", 300), ("bb", 60), ("cc", 30)) for text in texts(language, n)]
    frame = spark.createDataFrame(rows, "text string, language string")
    # the text that comes first among its language's is the one that is repeated
    first = frame.filter("language = 'aa'").orderBy(F.shiftrightunsigned(F.xxhash64("text", F.lit(17)), 11)).first()[0]
    copied = frame.union(spark.createDataFrame([(first, "aa")] * 600, frame.schema))
    model = fit_language(copied, "text", "language", max_rows=60)
    fresh = [(language, text) for language in words for text in texts(language, 20)]
    found = predict_language(spark.createDataFrame(fresh, "key string, text string"), model, "key", "text").collect()
    assert len(found) == 60 and all(r["key"] == r["lang_pred"] for r in found)


def test_language_learns_the_weights_of_a_plain_trainer(spark, monkeypatch):
    """Multinomial logistic regression by FTRL, feature by feature, with the temperature from a grid."""
    monkeypatch.setattr(language, "EPOCHS", 2)
    rng = random.Random(9)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "efgha"}
    rows = sorted({("".join(rng.choices(own, k=rng.randrange(3, 25))), lang) for lang, own in alphabets.items() for _ in range(40)})
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    model = fit_language(frame, "text", "lang", max_rows=90)

    place = F.shiftrightunsigned(F.xxhash64("text", F.lit(17)), 11)
    ordered = [tuple(r) for r in frame.select(place.alias("place"), "lang", "text").orderBy("place", "lang").collect()]
    chosen = sorted(row for lang in alphabets for row in [r for r in ordered if r[1] == lang][:30])

    def grams(text):
        block = next(words.blocks(pa.array([text])))
        return collections.Counter(next(language._per_text(block)).tolist())

    documents = collections.Counter(f for text, _ in rows for f in grams(text))
    idf = {f: language.SCALE * math.log((1 + len(rows)) / (1 + n)) for f, n in documents.items()}
    examples = []
    for _, lang, text in chosen:
        own = grams(text)
        examples.append(({f: n / own.total() * idf[f] for f, n in own.items()}, sorted(alphabets).index(lang)))
    held = [e for k, e in enumerate(examples) if k % 5 == 4]
    learnt = [e for k, e in enumerate(examples) if k % 5 != 4]
    pull, squares = collections.defaultdict(float), collections.defaultdict(float)

    def weight(f, c):
        l1, l2 = (0, 0) if f < 0 else (language.L1, language.L2)
        z = pull[f, c]
        if abs(z) <= l1:
            return 0.0
        return (math.copysign(l1, z) - z) / ((language.BETA + math.sqrt(squares[f, c])) / language.ALPHA + l2)

    def shares(x, divisor=1.0):
        scores = [sum(v * weight(f, c) for f, v in x.items()) + weight(-1, c) for c in range(3)]
        powers = [math.exp((s - max(scores)) / divisor) for s in scores]
        return [p / sum(powers) for p in powers]

    shuffled = np.random.default_rng(7)
    for _ in range(2):
        for k in shuffled.permutation(len(learnt)):
            x, target = learnt[k]
            p = shares(x)
            before = {(f, c): weight(f, c) for f in [*x, -1] for c in range(3)}
            for (f, c), w in before.items():
                slope = (p[c] - (c == target)) * x.get(f, 1.0)
                pull[f, c] += slope - (math.sqrt(squares[f, c] + slope**2) - math.sqrt(squares[f, c])) / language.ALPHA * w
                squares[f, c] += slope**2
    plain = np.array([[weight(f, c) * idf[f] for c in range(3)] for f in sorted(idf)])
    assert np.allclose(plain, model.weights[sorted(idf)], rtol=1e-4, atol=1e-6) and np.count_nonzero(plain) > 20
    assert np.allclose([weight(-1, c) for c in range(3)], model.bias)
    assert np.count_nonzero(np.delete(model.weights, sorted(idf), axis=0)) == 0

    def loss(divisor):
        return -sum(math.log(max(shares(x, divisor)[c], 1e-12)) for x, c in held)

    assert loss(model.temperature) <= min(loss(0.05 * 1.05**k) for k in range(122)) + 1e-6


# --- op4 ----------------------------------------------------------------------------------------


def test_recall_and_precision_of_identifiers_that_no_fixed_pattern_knows(spark):
    """Identifiers planted behind contexts of the four kinds, and the same tokens behind other words."""
    rng = random.Random(12)
    contexts = {"phone": ["call me at", "my mobile number is"], "email": ["write me at my mail address", "send it over to"],
                "card": ["the payment card", "charged to account"], "ip": ["log in from host", "server with address"]}
    fixed = {"phone": lambda: f"+1 555 {rng.randrange(100, 999)} {rng.randrange(1000, 9999)}",
             "email": lambda: f"user{rng.randrange(10**6)}@example.org",
             "card": lambda: next(n for n in iter(lambda: str(rng.randrange(10**15, 10**16)), "") if brute.luhn(n)),
             "ip": lambda: ".".join(str(rng.randrange(256)) for _ in range(4))}
    unseen = {"phone": lambda: f"0{rng.randrange(10**8, 10**9)}", "email": lambda: f"user{rng.randrange(10**6)}@localhost",
              "card": lambda: f"AC-{rng.randrange(10**6, 10**7)}", "ip": lambda: f"node{rng.randrange(10**4)}.lan7"}
    filler = "the green river runs slowly past our old house and nobody there minds it".split()
    others = ["in the year", "a batch of", "see section", "about page", "version", "room"]

    def around(*middle):
        return " ".join([*rng.choices(filler, k=rng.randrange(2, 9)), *middle, *rng.choices(filler, k=rng.randrange(2, 9))])

    rows, planted, clean = [], {}, set()
    for k in range(1600):
        kind = rng.choice(sorted(contexts))
        if k % 4 == 0:
            token = unseen[kind]()
            text = around(rng.choice(contexts[kind]), token)
            planted[k] = (kind, text.index(token), text.index(token) + len(token))
        elif k % 4 == 1:
            token = rng.choice([str(rng.randrange(1900, 2030)), unseen[kind]()])
            text = around(rng.choice(others), token)
            clean.add(k)
        else:
            text = around(rng.choice(contexts[kind]), fixed[kind]())
        rows.append((k, text))
    found = {r["doc_id"]: [tuple(s) for s in r["spans"] if not s["base"]]
             for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = sum(span[:3] in {s[:3] for s in found[k]} for k, span in planted.items())
    wrong = sum(len(found[k]) for k in found if k not in planted)
    print(f"planted {len(planted)}, found {hit}, false {wrong} in {len(clean)} clean texts")
    assert hit >= 0.9 * len(planted) and wrong <= 0.02 * len(clean)


def test_unseen_identifiers_in_groups_and_behind_numbers_are_found(spark):
    rows = [(k, f"Hello my phone number: +1 (555) 010-{1000 + k}") for k in range(20)]
    rows += [(50 + k, f"we met on level 7 desk: +1 (555) 020-{1000 + k}") for k in range(20)]
    rows += [(100, "my phone number: 555 123 4567, ok"), (101, "my phone number: GB29 NWBK 6016 1331 9268 19 is it"),
             (102, "room 8 desk: 12345x"), (103, "my phone number: 7 12345678"), (104, "my street number: 555 123 4567"),
             (105, "on level 7 desk: 123-45x"), (106, "my phone number: 123 45. 678 left")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marked = {r["doc_id"]: r["text"] for r in redact(frame).collect() if r["doc_id"] >= 100}
    assert marked == {
        100: "my phone number: [phone], ok", 101: "my phone number: [phone] is it", 102: "room 8 desk: 12345x",
        103: "my phone number: [phone]", 104: "my street number: 555 123 4567", 105: "on level 7 desk: [phone]",
        106: "my phone number: [phone]. 678 left"}
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in find_pii(frame).collect()}
    assert spans[100] == [("phone", 17, 29, False)] and spans[103] == [("phone", 17, 27, False)]


@pytest.mark.parametrize("words, between", [
    ("phone number:", " " * 90), ("phone number:", "\n" * 5000), ("phone" + " " * 300 + "number:", "\t \n" * 100),
    ("p" * 200 + " " + "n" * 300 + ":", " "), ("p" * 39 + " " + "n" * 39 + ":", "  ")])
def test_the_two_words_before_count_however_far_they_are(spark, words, between):
    plain = " ".join(words.split())
    rows = [(k, f"call my {plain} +1 (555) 010-{1000 + k}") for k in range(20)]
    rows += [(100, f"call 12a 7b {words}{between}12-77x"), (101, f"call street name:{between}12-77x"), (102, f"{words}{between}12-77x{between}ok")]
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in find_pii(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for key in (100, 102):
        start = dict(rows)[key].index("12-77x")
        assert found[key] == [("phone", start, start + 6, False)], key
    assert found[101] == []


def test_context_of_matches_side_by_side_in_one_word(spark):
    rows = [(k, f"my servers 10.0.0.{k},10.0.1.{k} and host list: 10.1.2.{k}") for k in range(20)]
    rows += [(100, "and host list: node7"), (101, "and host table: node7")]
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in find_pii(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[100] == [("ip", 15, 20, False)] and found[101] == []
    assert [s[0] for s in found[3]] == ["ip"] * 3


# --- op6 ----------------------------------------------------------------------------------------


def test_edited_copies_are_found_beside_many_exact_ones(spark):
    rng = random.Random(5)
    kinds = [(length, every) for length in (15, 30, 59) for every in (3, 4, 5, 6)]
    items = {k: [f"w{rng.randrange(10**6)}" for _ in range(length)] for k, (length, _) in enumerate(kinds)}
    rows = [(1000 * k + j, " ".join(item)) for k, item in items.items() for j in range(1, 41)]
    for k, (_, every) in enumerate(kinds):
        edited = [w if j % every else f"e{j}" for j, w in enumerate(items[k], 1)]
        rows.append((1000 * k + 500, " ".join(["x", *edited, "y"])))
    found = find_contamination(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")).collect()
    scores = {(r["doc_id"], r["item_id"]): r["score"] for r in found}
    assert set(scores) == {(key, key // 1000) for key, _ in rows}
    assert all((score == 1.0) == (key % 1000 != 500) for (key, _), score in scores.items())


def test_short_items_are_found_as_they_are(spark):
    docs = spark.createDataFrame([(1, "a golden zebra ran"), (2, "a golden, ZEBRA"), (3, "golden ran zebra"), (4, "zebra"), (5, "Quagga?")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "Golden zebra"), (2, "quagga"), (3, "a golden zebra")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in find_contamination(docs, items).collect()}
    assert found == {(1, 1), (2, 1), (5, 2), (1, 3), (2, 3)}


def test_a_phrase_that_all_share_joins_no_text_to_an_item(spark, monkeypatch):
    rng = random.Random(8)

    def text(n):
        return " ".join(f"w{rng.randrange(10**7)}" for _ in range(n))

    docs = [(k, f"{text(8)} which of the following {text(8)}") for k in range(2000)]
    items = [(k, f"{text(6)} which of the following {text(12)}") for k in range(400)]
    docs += [(5000 + k, f"{text(5)} {items[k][1]} {text(5)}") for k in range(20)]
    candidates = []
    written = decontaminate.stage
    monkeypatch.setattr(decontaminate, "stage", lambda df: candidates.append(written(df)) or candidates[-1])
    found = find_contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in found} == {(5000 + k, k, 1.0) for k in range(20)}
    sizes = [df.count() for df in candidates if "band" in df.columns or "part" in df.columns]
    assert len(sizes) == 2 and max(sizes) < 100


def test_nearly_all_pairs_that_align_are_found(spark):
    """Against every pair of a text and an item of the given tables, and edited copies beside them."""
    rng = random.Random(12)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    for k in range(60):
        words = items[k % len(items)][1].split()
        edited = [f"e{rng.randrange(10**6)}" if rng.random() < 0.25 else w for w in words]
        docs.append((10**6 + k, " ".join([*docs[k][1].split()[:30], *edited, *docs[k + 1][1].split()[:30]])))
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    hashed = {k: [dict(zip([key for key, _ in rows], [
        words[a:b] for _, words, bounds in decontaminate._word_hashes(pa.array([t for _, t in rows]))
        for a, b in zip(bounds, bounds[1:])]))][0] for k, rows in (("docs", docs), ("items", items))}
    expected = {}
    for doc, text in hashed["docs"].items():
        for item, words in hashed["items"].items():
            if np.isin(words, text).sum() / len(words) >= 0.5:
                score = decontaminate.align(words, text)[0] / (2 * len(words))
                if score >= 0.5:
                    expected[doc, item] = score
    assert set(found) <= set(expected) and all(abs(found[p] - expected[p]) < 1e-9 for p in found)
    assert len(expected) > 30 and len(found) >= 0.9 * len(expected)


# --- op8 ----------------------------------------------------------------------------------------


def test_toxicity_does_not_depend_on_how_rows_are_dealt_out(spark):
    rng = random.Random(3)
    rows = [(k % 150, " ".join(rng.choices(["bad", "vile", "nice", "good", "the", "a"], k=12))) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(200)] + [(7, 1), (7, 0)], "doc_id long, toxic long")
    seen = set()
    for parts in (1, 3, 7):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        seen.add(tuple(sorted((r["doc_id"], r["score"]) for r in score_toxicity(frame, labels).collect())))
    assert len(seen) == 1


def test_toxicity_learns_the_weights_of_a_plain_trainer(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choices(["bad", "vile", "nice", "good", "the", "a", "of"], k=rng.randrange(15)))) for k in range(200)]
    labels = [(k, int("bad" in t.split())) for k, t in rows]
    used, weights, bias = fit_toxicity(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
        spark.createDataFrame(labels, "doc_id long, toxic long"), "doc_id", "text", "toxic")

    order = [r[0] for r in spark.range(200).select("id").orderBy(F.xxhash64("id"), "id").collect()]
    blocks = next(words.blocks(pa.array([rows[k][1] for k in order])))
    features, text = toxicity._features(blocks)
    examples = [np.unique(features[text == k]).tolist() for k in range(200)]
    pull, squares, bias_at = collections.defaultdict(float), collections.defaultdict(float), -1

    def weight(f):
        l1, l2 = (0, 0) if f == bias_at else (toxicity.L1, toxicity.L2)
        z = pull[f]
        if abs(z) <= l1:
            return 0.0
        return (math.copysign(l1, z) - z) / ((toxicity.BETA + math.sqrt(squares[f])) / toxicity.ALPHA + l2)

    shuffled = np.random.default_rng(7)
    for _ in range(toxicity.EPOCHS):
        for k in shuffled.permutation(200):
            own = [*examples[k], bias_at]
            now = {f: weight(f) for f in own}
            slope = 1 / (1 + math.exp(-sum(now.values()))) - labels[order[k]][1]
            for f in own:
                pull[f] += slope - (math.sqrt(squares[f] + slope**2) - math.sqrt(squares[f])) / toxicity.ALPHA * now[f]
                squares[f] += slope**2
    plain = {f: weight(f) for f in pull if f != bias_at and weight(f)}
    assert plain.keys() == set(used.tolist())
    assert np.allclose([plain[f] for f in used.tolist()], weights) and math.isclose(bias, weight(bias_at), rel_tol=1e-6)


def test_hot_patterns_and_values_change_nothing(spark, no_broadcast, monkeypatch):
    rows = [(k, f"please call my phone number: +1 555 010 {1000 + k}") for k in range(40)]
    rows += [(100 + k, f"{'my phone number:' if k % 2 else f'see v{k} part:'} {'12-34' if k % 3 else f'99-{k}'}") for k in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def spans():
        return sorted((r["doc_id"], tuple(map(tuple, r["spans"]))) for r in find_pii(frame).collect())

    usual = spans()
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    assert spans() == usual and sum(len(s) for _, s in usual) > 60


# --- op5 ----------------------------------------------------------------------------------------


def test_pairs_across_components_are_those_of_all_pairs_in_parts_of_a_token(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_ROWS", 10)
    rng = random.Random(5)
    t = Fraction(3, 4)
    rows = set()
    for k in range(150):
        size = rng.choice([3, 4, 16, 20, 21, 27, 28, 36, 37, 100])
        rank = rng.randrange(max(1, size // 4))
        rows |= {(7, k, (rank << 32) + size, k % 40)} | ({(8, k, size, k % 40)} if k % 5 == 0 else set())
    frame = spark.createDataFrame(sorted(rows), "token long, class long, place long, root long").repartition(5)
    found = ngram_join._across_pairs(frame, t)
    expected = set()
    for (token, a, place, root), (token2, b, place2, root2) in itertools.combinations(sorted(rows), 2):
        (x, i), (y, j) = ((p & 0xFFFFFFFF, p >> 32) for p in (place, place2))
        if token == token2 and root != root2 and min(x - i, y - j) * 7 >= (x + y) * 3:
            expected.add((min(a, b), max(a, b)))
    pairs = [tuple(r) for r in found.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected and len(expected) > 500


def test_sets_whose_sizes_are_a_fourth_apart_lie_in_neighbouring_bands(spark):
    sizes = spark.range(1, 200_000).select(F.col("id").alias("x"), F.floor(F.col("id") * 4 / 3).alias("y"))
    far = sizes.select(ngram_join._band("x", Fraction(3, 4)).alias("of_x"), ngram_join._band("y", Fraction(3, 4)).alias("of_y"))
    assert far.filter("of_y - of_x > 1 or of_y < of_x").count() == 0


def test_one_component_and_one_text_of_a_third_of_all_rows(spark, no_broadcast, monkeypatch):
    """All joins spread their hot keys; the rows are those of brute force."""
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    monkeypatch.setattr(ngram_join, "HOT_ROWS", 5)
    rng = random.Random(6)
    base = [f"w{k}" for k in range(50)]
    rows = [(k, " ".join(base)) for k in range(60)] + [(60 + k, None) for k in range(60)]
    for k in range(60):
        copy = list(base)
        copy[rng.randrange(50)] = f"x{k}"
        rows.append((200 + k, " ".join(copy)))
    rows += [(300 + k, f"{' '.join(base[:9])} " + " ".join(f"y{k}_{j}" for j in range(20))) for k in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = ngram_join.near_duplicates(frame)
        assert "__salt" in found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(tuple(r) for r in found.collect()) == sorted(brute.near_duplicates(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_components_with_hot_nodes(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    edges = [(0, k) for k in range(1, 300)] + [(500 + k, 501 + k) for k in range(40)] + [(299, 500)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {n: 0 for e in edges for n in e}


# --- op9 ----------------------------------------------------------------------------------------


def test_shards_are_those_of_a_plain_draw(spark):
    """Each shard's draw from the public 64-bit hash of key and number; the smallest wins."""
    weights = [1.0, 2.5, 0.5, 1.0, 1.0]

    def shard(key, weights):
        draws = []
        for number, weight in enumerate(weights):
            of_key = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
            bits = xxhash.xxh64_intdigest(struct.pack("<q", number), of_key) >> 11
            draws.append((-math.log((bits + 0.5) / 2.0**53) / weight, number))
        return min(draws)[1]

    keys = [None, 0, -1, 2**62, *range(1, 500)]
    frame = spark.createDataFrame([(k, "text") for k in keys], "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in shard_records(frame, weights=weights, new_weight=3.0).collect()}
    assert found == {k: (shard(k, weights), shard(k, [*weights, 3.0])) for k in keys}
